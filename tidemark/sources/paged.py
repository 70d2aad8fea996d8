"""Paged APIs as Python data sources: page numbers or cursors, totals first, bounds, caps and page checks.

A port fetches one page; the source asks for pages by the rules of the API and returns their bodies as
they came, one row a page, so that they can be kept. Items are read out of the bodies by SQL functions.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition
from pyspark.sql.window import Window as W


@dataclass(frozen=True)
class Request:
    """One page of a term: bounds as the API takes them, the cursor (or page number as text) of the page, a source-side predicate."""

    term: str
    first: str
    last: str
    cursor: str | None
    predicate: str
    only_total: bool = False


@dataclass(frozen=True)
class Page:
    """What came: the body, its number of items, where the next page is (None: this is the last), and the total if the API gives one."""

    body: str
    items: int
    after: str | None = None
    total: int | None = None


@dataclass(frozen=True)
class Rules:
    """cap: most items of a term. pages: most pages. total_first: the total is asked for before any body, and zero ends the
    scan. inclusive: the API's upper bound counts, so the day before the exclusive end is sent. has_total: pages carry a
    total, which must not change."""

    cap: int = 1 << 62
    pages: int = 1 << 62
    total_first: bool = False
    inclusive: bool = False
    has_total: bool = False


#: Page numbers, at most a thousand hits. A total first, then bodies, with an inclusive bound. Cursors without totals. One page.
PAGE_NUMBERS = Rules(cap=1000, has_total=True)
TOTAL_FIRST = Rules(total_first=True, inclusive=True, has_total=True)
CURSORS = Rules()
ONE_PAGE = Rules(cap=250, pages=1)

SCHEMA = "term string, page int, cursor string, total bigint, n int, last boolean, body string"
PAGES = pa.schema([("term", pa.string()), ("page", pa.int32()), ("cursor", pa.string()), ("total", pa.int64()), ("n", pa.int32()), ("last", pa.bool_()), ("body", pa.string())])
Fetch = Callable[[Request], Page]


class PageError(ValueError):
    """A page breaks the API's rules: a changed total, a repeated cursor, or an empty page before the last."""


def _end(last: str, rules: Rules) -> str:
    """The upper bound as the API takes it."""
    return (dt.date.fromisoformat(last) - dt.timedelta(days=1)).isoformat() if last and rules.inclusive else last


def scan(fetch: Fetch, rules: Rules, term: str, first: str, last: str, predicate: str) -> Iterator[tuple]:
    """The rows of SCHEMA for one term; [first, last) are ISO days or empty."""
    end = _end(last, rules)
    ask = lambda cursor, only_total=False: fetch(Request(term, first, end, cursor, predicate, only_total))
    total = ask(None, True).total if rules.total_first else None
    if rules.total_first and not total:
        return
    cursor, seen, number, got = None, set(), 0, 0
    while number < rules.pages and got < rules.cap:
        page = ask(cursor)
        if rules.has_total:
            if total is not None and page.total != total:
                raise PageError(f"total of {term} changed from {total} to {page.total}")
            total = page.total
        if page.after is not None and (page.after in seen or page.after == cursor):
            raise PageError(f"cursor {page.after} of {term} is repeated")
        if page.items == 0 and page.after is not None:
            raise PageError(f"page {number} of {term} is empty but not the last")
        done = page.after is None or number + 1 >= rules.pages or got + page.items >= rules.cap
        yield term, number, cursor, total, page.items, done, page.body
        if page.after is None:
            return
        seen.add(page.after)
        cursor, number, got = page.after, number + 1, got + page.items


#: Bytes of bodies in a batch that goes to Spark.
BATCH_BYTES = 4 << 20


def batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """Rows of SCHEMA in Arrow batches by bytes, as pages may be large and Spark's own batches go by rows."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[6] or "")
        if size >= BATCH_BYTES:
            yield _batch(PAGES, held)
            held, size = [], 0
    if held:
        yield _batch(PAGES, held)


def _batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


class _Term(InputPartition):
    def __init__(self, term: str):
        self.term = term


class _Reader(DataSourceReader):
    """One task a term."""

    def __init__(self, fetch: Fetch, rules: Rules, options: dict[str, str]):
        self.fetch, self.rules, self.options = fetch, rules, options
        self.terms = options["terms"].split("|")

    def partitions(self) -> list[InputPartition]:
        return [_Term(t) for t in self.terms]

    def rows(self, term: str) -> Iterator[tuple]:
        o = self.options
        return scan(self.fetch, self.rules, term, o.get("first", ""), o.get("last", ""), o.get("predicate", ""))

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        yield from batches(self.rows(partition.term))


class _PruningReader(_Reader):
    """Takes conditions on the term, so other terms are not asked for, and one on the predicate, which goes out with each request;
    needs spark.sql.python.filterPushdown.enabled."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802 - a name of the interface
        asked = [f.value for f in filters if isinstance(f, EqualTo) and f.attribute == ("predicate",)]
        if asked and not self.options.get("predicate"):
            self.options = self.options | {"predicate": asked[0]}
        for f in filters:
            if isinstance(f, (EqualTo, In)) and f.attribute == ("term",):
                wanted = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.terms = [t for t in self.terms if t in wanted]
            else:
                yield f  # also the predicate: rows carry the one they were asked with, so a second one leaves none

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        predicate = self.options.get("predicate", "")
        yield from ((*row, predicate) for row in self.rows(partition.term))


def api_source(name: str, fetch: Fetch, rules: Rules, pushdown: bool = False) -> type[DataSource]:
    """A data source of page bodies; options: terms ("a|b"), first, last (ISO days, the end excluded), predicate.

    Register it with ``spark.dataSource.register``. pushdown: conditions on the term reach the source, and rows have a further
    column ``predicate``, whose wanted value reaches the source too.
    """

    class Api(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return f"{SCHEMA}, predicate string" if pushdown else SCHEMA

        def reader(self, schema) -> DataSourceReader:
            return (_PruningReader if pushdown else _Reader)(fetch, rules, dict(self.options))

    return Api


def projected(bodies: DataFrame, items: str, columns: dict[str, tuple[str, str]], cap: int | None = None) -> DataFrame:
    """term, page, position and the columns (name -> path in the item, type) of the items at a path of each body.

    With a cap, items beyond the first ``cap`` of a term are left out, as the API does not vouch for them.
    """
    parsed = F.from_json(F.get_json_object("body", f"$.{items}"), "array<string>")
    rows = bodies.select("term", "page", F.posexplode(parsed).alias("position", "item"))
    if cap is not None:
        before = F.sum("n").over(W.partitionBy("term").orderBy("page").rowsBetween(W.unboundedPreceding, -1))
        starts = bodies.select("term", "page", F.coalesce(before, F.lit(0)).alias("start"))
        rows = rows.join(starts, ["term", "page"]).where(F.col("start") + F.col("position") < cap)
    return rows.select("term", "page", "position", *(_typed(path, kind).alias(name) for name, (path, kind) in columns.items()))


def _typed(path: str, kind: str) -> Column:
    return F.get_json_object("item", f"$.{path}").try_cast(kind)


def volumes(windows: DataFrame, fetch: Fetch, rules: Rules = TOTAL_FIRST) -> DataFrame:
    """windows with ``total``: what the API counts for each term in [first, last); no body is asked for.

    windows: term, first, last (ISO days, the end excluded) and any further columns. A null term or bound has a null total.
    """
    names = windows.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            asked = [_total(fetch, rules, *row) for row in zip(part["term"], part["first"], part["last"])]
            yield part.assign(total=pd.array(asked, "Int64"))[[*names, "total"]]

    return windows.mapInPandas(run, T.StructType([*windows.schema.fields, T.StructField("total", T.LongType())]))


def _total(fetch: Fetch, rules: Rules, term: str | None, first: str | None, last: str | None) -> int | None:
    if term is None or first is None or last is None:
        return None
    return fetch(Request(term, first, _end(last, rules), None, "", True)).total


def items(ids: DataFrame, fetch: Callable[[str], str | None]) -> DataFrame:
    """id, body of every distinct id (text); the body is null where the API has no such item. Nulls are not asked for."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            yield part.assign(body=[fetch(k) for k in part["id"]])

    return ids.select(F.col("id").cast("string").alias("id")).where("id is not null").distinct().mapInPandas(run, "id string, body string")
