"""Scans of paged APIs behind ports: each kind of API serves a given table, page by page."""

from __future__ import annotations

import functools
import json
from bisect import bisect_right
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.registry import query, table
from tidemark.sources import paged as P
from tidemark.sources.cursors import cursor_stream
from tidemark.sources.durable import work_dir
from tidemark.sources.files import page_defects


#: Rows of a file of a served table: what a port holds at a time.
SEGMENT = 1 << 17


@dataclass(frozen=True)
class TableApi:
    """A served table (:func:`_served`) behind a paged API: items of a term ascend by key.

    numbers: cursors are page numbers, else the last key that came. day: bounds of a request hold for the days of items, the
    upper one included. A predicate "a|b" is answered by items that hold one of its words. A port holds one file of the table, and
    of each file that has items of a term their number by day, so its memory does not grow with the items.
    """

    path: str
    per_page: int
    numbers: bool = False
    day: bool = False

    def __call__(self, r: P.Request) -> P.Page:
        asked = self.path, r.term, r.first, r.last, r.predicate
        files, ends = _matched(*asked)
        total = int(ends[-1])
        if r.only_total:
            return P.Page("", 0, None, total)
        at = 0 if not r.cursor else int(r.cursor) * self.per_page if self.numbers else self._after(int(r.cursor), files, ends, asked)
        end = min(at + self.per_page, total)
        keys, days = [], []
        k = int(np.searchsorted(ends, at, "right")) - 1
        while at + len(keys) < end:
            own, when = _hits(self.path, files[k].path, *asked[1:])
            part = slice(at + len(keys) - int(ends[k]), end - int(ends[k]))
            keys += own[part].tolist()
            days += [None if d == "NaT" else d for d in np.datetime_as_string(when[part]).tolist()] if self.day else [None] * (len(keys) - len(days))
            k += 1
        body = json.dumps({"hits": [{"id": i, "at": {"day": d}} for i, d in zip(keys, days)]})
        after = None if end == total else end // self.per_page if self.numbers else keys[-1]
        return P.Page(body, end - at, None if after is None else str(after), total)

    def _after(self, key: int, files: list[_File], ends: np.ndarray, asked: tuple) -> int:
        """How many of the items asked for have no greater key."""
        k = bisect_right([f.last for f in files], key)
        return int(ends[k]) + (int(np.searchsorted(_hits(self.path, files[k].path, *asked[1:])[0], key, "right")) if k < len(files) else 0)


class _File(NamedTuple):
    """A file's items of one term: how many, the greatest key, and their number up to each of their days."""

    path: str
    n: int
    last: int
    days: np.ndarray
    upto: np.ndarray


@functools.lru_cache(8)
def _paths(at: str) -> list[tuple[str, str | None, str | None]]:
    """The files of a served table with their least and greatest term."""
    system, folder = fs.FileSystem.from_uri(at)
    found = []
    for info in system.get_file_info(fs.FileSelector(folder)):
        if info.path.endswith(".parquet"):
            meta = pq.read_metadata(info.path, filesystem=system)
            stats = [meta.row_group(g).column(0).statistics for g in range(meta.num_row_groups)]
            known = stats and all(x is not None and x.has_min_max for x in stats)
            found.append((info.path, min(x.min for x in stats) if known else None, max(x.max for x in stats) if known else None))
    return found


@functools.lru_cache(2)
def _rows(at: str, path: str, term: str) -> tuple[np.ndarray, np.ndarray, pa.ChunkedArray]:
    """Keys, days and words of a file's items of a term, by key."""
    system, _ = fs.FileSystem.from_uri(at)
    rows = pq.read_table(path, filters=[("term", "==", term)], filesystem=system, use_threads=False).sort_by("key")
    return rows["key"].to_numpy(), rows["day"].to_numpy().astype("datetime64[D]"), rows["word"]


@functools.lru_cache(8)
def _files(at: str, term: str) -> list[_File]:
    """The files that hold a term, by key; a process reads them once for this."""
    found = []
    for path, least, greatest in _paths(at):
        if least is None or least <= term <= greatest:
            keys, days, _ = _rows(at, path, term)
            if len(keys):
                day, n = np.unique(days[~np.isnat(days)], return_counts=True)
                found.append(_File(path, len(keys), int(keys[-1]), day, np.concatenate(([0], np.cumsum(n)))))
    return sorted(found, key=lambda f: f.last)


def _inside(days: np.ndarray, first: str, last: str) -> np.ndarray:
    return (days >= np.datetime64(first or "0001-01-01")) & (days <= np.datetime64(last or "9999-12-31"))


@functools.lru_cache(2)
def _hits(at: str, path: str, term: str, first: str, last: str, predicate: str) -> tuple[np.ndarray, np.ndarray]:
    """Keys and days of a file's items that answer a request."""
    keys, days, words = _rows(at, path, term)
    good = np.ones(len(keys), bool)
    if predicate:
        found = (pc.fill_null(pc.match_substring(words, w), False) for w in predicate.split("|"))
        good &= functools.reduce(pc.or_, found).to_numpy()
    if first or last:
        good &= _inside(days, first, last)
    return keys[good], days[good]


@functools.lru_cache(8)
def _matched(at: str, term: str, first: str, last: str, predicate: str) -> tuple[list[_File], np.ndarray]:
    """The files of a term, and how many items before each, and in all, answer a request."""
    files = _files(at, term)
    if predicate:
        n = [len(_hits(at, f.path, term, first, last, predicate)[0]) for f in files]
    elif first or last:
        n = [int(f.upto[np.searchsorted(f.days, np.datetime64(last or "9999-12-31"), "right")] - f.upto[np.searchsorted(f.days, np.datetime64(first or "0001-01-01"))]) for f in files]
    else:
        n = [f.n for f in files]
    return files, np.concatenate(([0], np.cumsum(n))).astype(np.int64)


def _served(spark: SparkSession, sf_dir: str, name: str, term: str, key: str, per_page: int, day: str | None = None, word: str | None = None, numbers: bool = False) -> TableApi:
    """A table laid out as a service has it: in files of SEGMENT rows by term and key, in the shared folder, so that ports need
    neither Spark nor the store of the table."""
    kind = lambda c, t: (F.col(c) if c else F.lit(None)).cast(t)
    rows = table(spark, sf_dir, name).select(kind(term, "string").alias("term"), kind(key, "long").alias("key"), kind(day, "date").alias("day"), kind(word, "string").alias("word")).where("term is not null")
    at = work_dir(spark, "api")
    rows.repartitionByRange("term", "key").sortWithinPartitions("term", "key").write.option("maxRecordsPerFile", SEGMENT).parquet(at)
    return TableApi(at, per_page, numbers, day is not None)


def _terms(spark: SparkSession, sf_dir: str, name: str, column: str) -> str:
    """The option ``terms``: few kinds, as a scan names each."""
    return "|".join(sorted(r[0] for r in table(spark, sf_dir, name).select(column).distinct().collect()))


def _orders(spark: SparkSession, sf_dir: str, **kind) -> TableApi:
    return _served(spark, sf_dir, "orders", "o_orderpriority", "o_orderkey", 500, day="o_orderdate", **kind)


def _scanned(spark: SparkSession, name: str, api: TableApi, rules: P.Rules, terms: str, **options: str) -> DataFrame:
    spark.dataSource.register(P.api_source(name, api, rules))
    return spark.read.format(name).options(terms=terms, **options).load()


ITEM = {"id": ("id", "bigint"), "day": ("at.day", "string")}


@query("src08_page_numbers", """SELECT term, count(*) AS n, max(id) AS greatest, max(day) AS newest FROM (SELECT o_orderpriority AS term, o_orderkey AS id, strftime(o_orderdate, '%Y-%m-%d') AS day, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS k FROM orders)
 WHERE k <= 1000 GROUP BY 1""")
def src08_page_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by priority, pages by number; the API ends a term's hits at a thousand."""
    bodies = _scanned(spark, "api_numbers", _orders(spark, sf_dir, numbers=True), P.PAGE_NUMBERS, _terms(spark, sf_dir, "orders", "o_orderpriority"))
    return P.projected(bodies, "hits", ITEM, cap=P.PAGE_NUMBERS.cap).groupBy("term").agg(F.count("*").alias("n"), F.max("id").alias("greatest"), F.max("day").alias("newest"))


@query("src08_volumes", """WITH t AS (SELECT DISTINCT o_orderpriority AS term FROM orders), m AS (SELECT DISTINCT date_trunc('month', o_orderdate)::DATE AS first FROM orders)
 SELECT term, strftime(first, '%Y-%m-%d') AS first, count(o_orderkey) AS total FROM t CROSS JOIN m LEFT JOIN orders ON o_orderpriority = term AND date_trunc('month', o_orderdate) = first GROUP BY ALL""")
def src08_volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many orders each priority has each month, by one request for the total; the exclusive end goes out as an inclusive bound."""
    orders = table(spark, sf_dir, "orders")
    months = orders.select(F.trunc(F.col("o_orderdate").cast("date"), "MM").alias("month")).distinct()
    windows = orders.select(F.col("o_orderpriority").alias("term")).distinct().crossJoin(months)  # the grid that is asked for: priorities by months
    asked = windows.select("term", F.col("month").cast("string").alias("first"), F.add_months("month", 1).cast("string").alias("last"))
    return P.volumes(asked.repartition("term"), _orders(spark, sf_dir)).drop("last")


@query("src08_single_items", "SELECT DISTINCT s_nationkey + k AS nation, n_name FROM supplier CROSS JOIN (VALUES (0), (20)) t(k) LEFT JOIN nation ON n_nationkey = s_nationkey + k")
def src08_single_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers' nations, and keys beyond them of which some do not exist, each asked for once by its id."""
    names = dict(table(spark, sf_dir, "nation").select("n_nationkey", "n_name").collect())  # 25 nations, as a service has them

    def fetch(key: str) -> str | None:
        name = names.get(int(key))
        return None if name is None else json.dumps({"name": name})

    ids = table(spark, sf_dir, "supplier").select(F.explode(F.array("s_nationkey", F.col("s_nationkey") + 20)).alias("id"))
    return P.items(ids, fetch).select(F.col("id").cast("int").alias("nation"), F.get_json_object("body", "$.name").alias("n_name"))


@query("src09_total_then_bodies", "SELECT o_orderpriority AS term, o_orderkey AS id, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1998-02-01'")
def src09_total_then_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The total comes first, and no body is read where it is zero; the exclusive end goes out as an inclusive bound."""
    terms = _terms(spark, sf_dir, "orders", "o_orderpriority") + "|0-NONE"
    bodies = _scanned(spark, "api_totals", _orders(spark, sf_dir, numbers=True), P.TOTAL_FIRST, terms, first="1996-01-01", last="1998-02-01")
    return P.projected(bodies, "hits", ITEM).drop("page", "position")


@query("src10_cursors", "SELECT event_type AS term, CAST(ceil(count(*) / 250.0) AS BIGINT) AS pages, count(*) AS n FROM events GROUP BY 1")
def src10_cursors(spark: SparkSession, sf_dir: str) -> DataFrame:
    api = _served(spark, sf_dir, "events", "event_type", "event_id", 250)
    return _scanned(spark, "api_cursors", api, P.CURSORS, _terms(spark, sf_dir, "events", "event_type")).groupBy("term").agg(F.count("*").alias("pages"), F.sum("n").alias("n"))


@query("src11_one_page", "SELECT p_brand AS term, 'red|blue' AS predicate, least(250, count(*) FILTER (contains(p_name, 'red') OR contains(p_name, 'blue')))::INTEGER AS n FROM part WHERE p_brand IN ('Brand#7', 'Brand#12', 'Brand#21') GROUP BY 1")
def src11_one_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page a term of what answers the keywords, be it empty; conditions on the term and on the keywords both reach the source, for which
    a session of its own lets Python sources take filters."""
    own = spark.newSession()
    own.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    own.dataSource.register(P.api_source("api_one_page", _served(spark, sf_dir, "part", "p_brand", "p_partkey", 250, word="p_name"), P.ONE_PAGE, True))
    bodies = own.read.format("api_one_page").option("terms", _terms(spark, sf_dir, "part", "p_brand")).load()
    return bodies.where(F.col("term").isin("Brand#7", "Brand#12", "Brand#21") & (F.col("predicate") == "red|blue")).select("term", "predicate", "n")


@query("src07_stable_counts", "SELECT p_type AS term, count(*) AS total FROM part GROUP BY 1")
def src07_stable_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scans of the parts by type whose pages are without defects: one total, cursors that differ, no empty page before the last; and all items there."""
    bodies = _scanned(spark, "api_stable", _served(spark, sf_dir, "part", "p_type", "p_partkey", 100), P.Rules(has_total=True), _terms(spark, sf_dir, "part", "p_type"))
    receipts = bodies.select(F.col("term").alias("scan_id"), "page", "total", "cursor", "n", "last")
    whole = bodies.groupBy("term").agg(F.max("total").alias("total"), F.sum("n").alias("n")).where("total = n")
    return whole.join(page_defects(receipts).select(F.col("scan_id").alias("term")), "term", "left_anti").select("term", "total")


PAGED = "SELECT o_orderpriority AS term, CAST(ceil(count(*) / 500.0) AS BIGINT) AS pages, count(*) AS n, sum(o_orderkey)::BIGINT AS keys FROM orders GROUP BY 1"


def _counted(bodies: DataFrame) -> DataFrame:
    pages = bodies.groupBy("term").agg(F.count("*").alias("pages"))
    items = P.projected(bodies, "hits", {"id": ("id", "bigint")}).groupBy("term").agg(F.count("*").alias("n"), F.sum("id").alias("keys"))
    return pages.join(items, "term")


@query("src10_paged_orders", PAGED)
def src10_paged_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders by priority behind a cursor API: a task a priority, cursors checked, items read from the kept bodies."""
    return _counted(_scanned(spark, "api_orders", _orders(spark, sf_dir), P.Rules(has_total=True), _terms(spark, sf_dir, "orders", "o_orderpriority")))


@query("src06_resumed_stream", PAGED)
def src06_resumed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same API as a stream that stops after its first batch and goes on from the checkpoint: no page is lost or repeated."""
    at = work_dir(spark, "cursors")
    spark.dataSource.register(cursor_stream("api_orders_stream", _orders(spark, sf_dir)))
    terms = _terms(spark, sf_dir, "orders", "o_orderpriority")
    for once in (True, False):
        rows = spark.readStream.format("api_orders_stream").options(terms=terms, pages=4, cursors=f"{at}/cursors").load()
        out = rows.writeStream.format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/check")
        q = (out.trigger(once=True) if once else out).start()
        if once:
            q.awaitTermination()
        else:
            q.processAllAvailable()
            q.stop()
    return _counted(spark.read.schema(P.SCHEMA).parquet(f"{at}/out"))
