"""Ports that stand in for services."""

from __future__ import annotations

import json
from collections.abc import Callable

from tidemark.sources.paged import Fetch, Page, Request


def generated(sizes: Callable[[str], int], per_page: int, numbers: bool) -> Fetch:
    """A port for tests and examples: term t has sizes(t) items {"id": k}; pages by number or by cursor, totals with both."""

    def fetch(r: Request) -> Page:
        size = sizes(r.term)
        if r.only_total:
            return Page("", 0, None, size)
        at = int(r.cursor or 0) * (per_page if numbers else 1)
        ids = range(at, min(at + per_page, size))
        after = at + len(ids)
        body = json.dumps({"hits": [{"id": k, "who": {"name": f"{r.term}-{k}"}, "until": r.last} for k in ids]})
        return Page(body, len(ids), (str(after // per_page) if numbers else str(after)) if after < size else None, size)

    return fetch
