"""File sources: guarded records, lookups, manifests, validation, retained pages, cached reads."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.durable import spread

#: Bytes of fetched files that a task holds before it hands them on.
HELD = 16 << 20
MAX_RECORD, MAX_TOTAL = 1 << 20, 16 << 20


def json_records(df: DataFrame, max_record: int = MAX_RECORD) -> DataFrame:
    """One JSON text a row; a record above the limit raises."""
    body = F.to_json(F.struct("*"))
    rows = df.select(body.alias("record")).withColumn("size", F.octet_length("record"))
    return rows.select(F.when(F.col("size") > max_record, F.raise_error(F.lit("expanded record exceeds limit")).cast("string")).otherwise(F.col("record")).alias("record"), "size")


def size_guard(df: DataFrame, max_record: int = MAX_RECORD, max_total: int = MAX_TOTAL) -> DataFrame:
    """One row: total and greatest record size, and whether both are within bounds."""
    size = F.octet_length(F.to_json(F.struct("*")))
    out = df.agg(F.coalesce(F.sum(size), F.lit(0)).cast("bigint").alias("total"), F.coalesce(F.max(size), F.lit(0)).alias("greatest"))
    return out.withColumn("ok", (F.col("total") <= max_total) & (F.col("greatest") <= max_record))


def point_lookup(spark: SparkSession, paths: list[str], key: str, value) -> DataFrame:
    """Rows of many files with one key value, with the file each comes from; statistics prune files and row groups."""
    return spark.read.parquet(*paths).select("*", F.col("_metadata.file_path").alias("filename")).where(F.col(key) == value)


def inventory(manifest: DataFrame) -> DataFrame:
    """url, bytes, rows, checksum, updated_date of a manifest's files, newest first; manifest: one row with an array ``entries``.

    Duplicate urls, missing sizes and totals that do not add up raise.
    """
    files = manifest.select(F.explode("entries").alias("e"), "total_bytes", "total_rows").select("e.*", "total_bytes", "total_rows")
    facts = files.agg(F.count("*").alias("n"), F.countDistinct("url").alias("urls"), F.sum("bytes").alias("b"), F.sum("rows").alias("r"), F.max("total_bytes").alias("tb"), F.max("total_rows").alias("tr"), F.max(F.col("bytes").isNull() | F.col("rows").isNull()).alias("lost")).first()
    if facts["n"] != facts["urls"] or facts["lost"] or facts["b"] != facts["tb"] or facts["r"] != facts["tr"]:
        raise ValueError("invalid manifest")
    day = F.try_to_date(F.regexp_extract("url", r"updated_date=(\d{4}-\d{2}-\d{2})", 1), "yyyy-MM-dd")
    return files.withColumn("updated_date", day).drop("total_bytes", "total_rows").orderBy(F.desc("updated_date"), "url")


def validate_files(spark: SparkSession, path: str, manifest: DataFrame) -> DataFrame:
    """name, size_ok, checksum_ok (and rows_ok) for files against manifest rows: name, bytes, sha256 or md5, and rows of Parquet files if asked for.

    Counts come from the footers. A file that is missing is wrong in everything.
    """
    name = lambda c: F.element_at(F.split(c, "/"), -1).alias("name")
    kind = "md5" if "md5" in manifest.columns else "sha256"
    content = F.md5("content") if kind == "md5" else F.sha2("content", 256)
    files = spark.read.format("binaryFile").load(path).select(name(F.col("path")), F.col("length").alias("size"), content.alias("found"))
    same = lambda a, b: F.coalesce(F.col(a) == F.col(b), F.lit(False))
    out = manifest.join(files, "name", "left")
    checks = ["name", same("size", "bytes").alias("size_ok"), same("found", kind).alias("checksum_ok")]
    if "rows" in manifest.columns:
        counts = spark.read.parquet(path).groupBy(name(F.col("_metadata.file_path"))).agg(F.count("*").alias("have"))
        out, checks = out.join(counts, "name", "left"), [*checks, same("have", "rows").alias("rows_ok")]
    return out.select(*checks)


def acquire(manifest: DataFrame, receipts: DataFrame, fetch: Callable[[str], bytes], attempts: int = 3, most: int = 1 << 30) -> DataFrame:
    """name, content, size, adopted, defect of a manifest's files, fetched by a port, which raises OSError to be tried again.

    manifest: name, bytes, sha256. receipts: name, sha256 of what is already kept. A file whose receipt has the manifest's
    checksum is adopted and not fetched (its content is null). defect: ``unreachable``, ``size`` (also above ``most`` bytes
    or of no stated size, which are not asked for) or ``checksum``; null for a good file. Files are dealt to tasks evenly; a
    task holds files of HELD bytes together, or one that is larger.
    """
    kept = receipts.select("name", "sha256").distinct().withColumn("adopted", F.lit(True))
    rows = manifest.select("name", "bytes", "sha256").join(kept, ["name", "sha256"], "left")

    def got(name: str, size: int | None, sha: str | None, adopted: bool | None) -> tuple:
        if adopted:
            return name, None, size, True, None
        if size is None or size > most:
            return name, None, None, False, "size"
        content = None
        for _ in range(attempts):
            try:
                content = fetch(name)
                break
            except OSError:
                continue
        good = content is not None and len(content) == size
        defect = "unreachable" if content is None else "size" if not good else None if hashlib.sha256(content).hexdigest() == sha else "checksum"
        return name, content, None if content is None else len(content), False, defect

    schema = pa.schema([("name", pa.string()), ("content", pa.binary()), ("size", pa.int64()), ("adopted", pa.bool_()), ("defect", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            found, held = [], 0
            for asked in zip(*(part.column(c).to_pylist() for c in ("name", "bytes", "sha256", "adopted"))):
                found.append(got(*asked))
                held += len(found[-1][1] or b"")
                if held >= HELD:
                    yield _batch(schema, found)
                    found, held = [], 0
            if found:
                yield _batch(schema, found)

    return spread(rows).mapInArrow(run, "name string, content binary, size bigint, adopted boolean, defect string")


def _batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def pages(bodies: DataFrame, items: str, schema: str) -> DataFrame:
    """Items of retained JSON pages; bodies: page, body. Works for any page layout whose items lie at one path."""
    parsed = F.from_json(F.get_json_object("body", f"$.{items}"), f"array<struct<{schema}>>")
    return bodies.select("page", F.explode(parsed).alias("item")).select("page", "item.*")


def page_defects(receipts: DataFrame) -> DataFrame:
    """scan_id, defect of a paged scan: unstable_count, repeated_cursor, empty_page; receipts: scan_id, page, total, cursor, n, last."""
    rows = receipts.groupBy("scan_id").agg((F.countDistinct("total") > 1).alias("unstable_count"), (F.count("cursor") > F.countDistinct("cursor")).alias("repeated_cursor"), F.max((F.col("n") == 0) & ~F.col("last")).alias("empty_page"))
    names = ("unstable_count", "repeated_cursor", "empty_page")
    return rows.select("scan_id", F.explode(F.array_compact(F.array(*(F.when(F.col(n), n) for n in names)))).alias("defect"))


def read_or(spark: SparkSession, path: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The Parquet table at a path; where there is none, what ``make`` gives, which is written there first."""
    from tidemark.sources.sinks import _exists

    if not _exists(spark.range(0), f"{path}/_SUCCESS"):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
