"""Semi-structured payloads: JSON paths, inverted abstracts, canonical encoding, identities."""

from __future__ import annotations

import hashlib
import json
import uuid
from decimal import Decimal

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def path(payload: Column, at: str, kind: str = "string") -> Column:
    """A typed value of a JSON text, null where it is missing or of another kind."""
    return F.try_variant_get(F.try_parse_json(payload), at, kind)


def sum_of_values(counts: Column) -> Column:
    """Sum of a map's values; null counts as 0."""
    return F.aggregate(F.map_values(F.coalesce(counts, F.create_map().cast("map<string,bigint>"))), F.lit(0).cast("bigint"), lambda a, x: a + F.coalesce(x, F.lit(0)))


def abstract(inverted: Column) -> Column:
    """Strict reconstruction of a JSON inverted index: words by (position, word).

    Any position that is not an integer, an empty index and an empty result give null.
    """
    index = F.from_json(inverted, "map<string,array<bigint>>")
    entries = F.flatten(F.transform(F.map_entries(index), lambda e: F.transform(e["value"], lambda p: F.struct(p.alias("p"), e["key"].alias("w")))))
    bad = F.exists(F.map_values(index), lambda v: v.isNull() | F.exists(v, lambda p: p.isNull()))
    text = F.trim(F.array_join(F.transform(F.array_sort(entries), lambda e: e["w"]), " "))
    return F.when(index.isNotNull() & ~bad & (text != ""), text)


@F.pandas_udf(StringType())
def lenient_abstract(inverted: pd.Series) -> pd.Series:
    """Lenient reconstruction: other than integer positions are skipped, an empty index gives an empty text."""

    def words(raw: str | None) -> str | None:
        try:
            index = json.loads(raw) if raw is not None else None
        except ValueError:
            return None
        if not isinstance(index, dict):
            return None
        placed = [(p, w) for w, at in index.items() if isinstance(at, list) for p in at if isinstance(p, int)]
        return " ".join(w for _, w in sorted(placed))

    return inverted.map(words)


#: Digits that a number of a payload may have once it is written without an exponent.
MOST_DIGITS = 10_000


def _plain(number: str) -> str:
    value = Decimal(number)
    if abs(value.adjusted()) > MOST_DIGITS:
        raise ValueError(f"a number of more than {MOST_DIGITS} digits")
    digits = f"{value:f}"
    whole, _, rest = digits.partition(".")
    rest = rest.rstrip("0")
    return "0" if not whole.strip("-0") and not rest else f"{whole}.{rest}" if rest else whole


class _Number(str):
    """A number with a point or exponent as it stood; a type of its own, so no string of a payload can be taken for one."""


def _refuse(name: str) -> str:
    raise ValueError(f"{name} is not finite")


def _written(value: object) -> str:
    if isinstance(value, _Number):
        return _plain(value)
    if isinstance(value, dict):
        return "{" + ",".join(f"{json.dumps(k, ensure_ascii=False)}:{_written(value[k])}" for k in sorted(value)) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(_written, value)) + "]"
    return json.dumps(value, ensure_ascii=False)


def canonical_json(text: str) -> str:
    """The JSON text with sorted keys and no space; numbers without exponents or trailing zeros.

    Numbers that are not finite, or would have more than MOST_DIGITS digits, are errors.
    """
    return _written(json.loads(text, parse_float=_Number, parse_constant=_refuse))


@F.pandas_udf(StringType())
def canonical(payload: pd.Series) -> pd.Series:
    """Canonical text of a JSON payload; null where it is null."""
    return payload.map(lambda t: None if t is None else canonical_json(t))


def quoted(text: Column) -> Column:
    """A text as a JSON string."""
    return F.regexp_extract(F.to_json(F.struct(text.alias("x"))), r'(?s)^\{"x":(.*)\}$', 1)


def spaced_list(texts: Column) -> Column:
    """An array of texts as a JSON list with a space after each comma."""
    return F.concat(F.lit("["), F.array_join(F.transform(texts, quoted), ", "), F.lit("]"))


def spaced_object(parts: Column) -> Column:
    """A map of names to JSON texts as an object with sorted names, and spaces after commas and colons."""
    entries = F.transform(F.array_sort(F.map_entries(parts)), lambda e: F.concat(quoted(e["key"]), F.lit(": "), e["value"]))
    return F.concat(F.lit("{"), F.array_join(entries, ", "), F.lit("}"))


def content_identity(entity: Column, canonical_text: Column, version: int = 2) -> Column:
    """struct(content_hash, version_id): the payload's hash and that of (kind, entity, canonicalisation version, hash)."""
    content = F.sha2(canonical_text, 256)
    return F.struct(content.alias("content_hash"), F.sha2(F.concat(F.lit('["works",'), quoted(entity), F.lit(f',{version},"'), content, F.lit('"]')), 256).alias("version_id"))


NAMESPACE = uuid.NAMESPACE_URL


@F.pandas_udf(StringType())
def name_uuid(name: pd.Series) -> pd.Series:
    """Version-5 UUID of a name, the identity of a cached vector."""
    return name.map(lambda n: None if n is None else str(uuid.uuid5(NAMESPACE, n)))


def cache_name(text: Column, model: str, revision: str, layout: str) -> Column:
    """The name that identifies an embedding: text hash, model, revision, layout."""
    return F.concat_ws("|", F.sha2(text, 256), F.lit(model), F.lit(revision), F.lit(layout))


def request_hash(request: dict) -> str:
    """Identity of a request on the driver: SHA-256 of its JSON with sorted keys."""
    return hashlib.sha256(json.dumps(request, sort_keys=True, ensure_ascii=False).encode()).hexdigest()
