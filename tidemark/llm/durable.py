"""Lineage cuts that survive lost executors: those of the core."""

from tidemark.sources.durable import remove_stored, shared_dir, stored

__all__ = ["remove_stored", "shared_dir", "stored"]
