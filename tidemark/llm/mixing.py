"""Mixing sources to target weights with a low-discrepancy schedule (DataFrame functions only).

Sources are ordered by code point, a null source last, and weigh ``weights`` in turn. Together they
get ``share`` of all words by weight; a source's target stops at ``max_epochs`` times its size and
the excess is shared again by weight until no source is above its stop (one water level, found by
ordering sources by stop over weight).

Schedule: slot i stands at the i-th point of a golden-ratio rotation, i * A mod 2**31 over 2**31.
The point is looked up in the cumulative targets, which names the slot's source; slots are ranked
per source. Each source's documents, shuffled by a hash of their id, are laid end to end and cut
into blocks of ``block`` words; the slot of rank r takes block r mod (number of blocks), and the
source's last slot only what its target still lacks. Where the rotation gives a source a few slots
more than its target needs these stay unused; where it gives fewer, the rest follow at the end.

No step orders or sums a whole source, or all sources, in one task: running positions (of documents,
of slots and of sources) are taken in two levels.

Defined cases: null text has size 0; documents of size 0 take nothing; null doc_ids are shuffled
by a hash of their text; repeated doc_ids and rows are separate documents; a source of size 0 has
target 0; an empty table gives an empty mix; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tidemark.llm.durable import stored

#: The golden ratio's fraction over 2**31, made odd, so the rotation visits every point.
GOLDEN = 1327217885
PERIOD = 1 << 31
#: Least number of cells in which points look up their source; many sources get four cells each.
CELLS = 4096


def size_of(text: Column) -> Column:
    """Number of words: runs of anything but space, tab, newline, vertical tab, form feed, return."""
    plain = F.trim(F.translate(text, "\t\n\x0b\f\r", "     "))
    return F.coalesce(F.size(F.filter(F.split(plain, " "), lambda w: w != "")), F.lit(0)).cast("long")


def _before(df: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """df with, per name, the sum of a value over the rows that stand before in the order, in two levels.

    Rows are dealt out by ranges of the order, so only one row a range meets the others in one task.
    """
    named = df.withColumns({f"_o{k}": c for k, c in enumerate(order)} | {f"_v_{n}": v for n, v in sums.items()})
    keys = [f"_o{k}" for k in range(len(order))]
    dealt = stored(named.repartitionByRange(*keys).withColumn("_range", F.spark_partition_id()), "ranges")
    whole = dealt.groupBy(F.col("_range").alias("_r")).agg(*(F.sum(f"_v_{n}").alias(f"_s_{n}") for n in sums))
    earlier = W.orderBy("_r").rowsBetween(W.unboundedPreceding, -1)
    base = whole.select("_r", *(F.coalesce(F.sum(f"_s_{n}").over(earlier), F.lit(0)).alias(f"_b_{n}") for n in sums))
    inner = W.partitionBy("_range").orderBy(*keys).rowsBetween(W.unboundedPreceding, -1)
    own = dealt.withColumns({f"_i_{n}": F.coalesce(F.sum(f"_v_{n}").over(inner), F.lit(0)) for n in sums})
    return own.join(base, F.col("_range") == F.col("_r")).select(*df.columns, *((F.col(f"_b_{n}") + F.col(f"_i_{n}")).cast("long").alias(n) for n in sums))


def source_targets(sizes: DataFrame, weights: tuple[int, ...], max_epochs: int, share: float) -> DataFrame:
    """source, source_size, target, s (the source's number from 1); sizes: source and source_size, one row per source."""
    by_name = [F.col("source").isNull(), F.col("source")]
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("s") - 1) % len(weights) + 1).cast("int")).cast("long")
    stop = F.col("source_size") * max_epochs
    weighed = _before(sizes, by_name, {"s": F.lit(1)}).withColumn("s", F.col("s") + 1).withColumn("w", weight).withColumn("stop", stop)
    level = stored(_before(weighed, [F.col("stop") / F.col("w"), *by_name], {"full": F.col("stop"), "full_w": F.col("w")}), "levels")
    total, all_w = level.agg(F.sum("source_size"), F.sum("w")).first()
    own = (F.lit(total).cast("long") * F.lit(float(share)) - F.col("full")) / (F.lit(all_w).cast("long") - F.col("full_w"))
    water = level.select(F.max(F.when(own <= F.col("stop") / F.col("w"), own))).first()[0]
    full = F.col("stop").cast("double")
    target = full if water is None else F.least(full, F.lit(water) * F.col("w"))
    return level.select("source", "source_size", target.alias("target"), "s")


def _root(n: int) -> int:
    """A power of two at or above the square root of n."""
    return 1 << max(0, (max(n, 1) - 1).bit_length() + 1 >> 1)


def _running(df: DataFrame, by: str, bucket: str, order: list, value: Column, name: str) -> DataFrame:
    """df with the sum of value over the rows of the same ``by`` that stand before, in two levels."""
    first = df.groupBy(by, bucket).agg(F.sum(value).alias("_s"))
    base = first.select(F.col(by).alias("_by"), F.col(bucket).alias("_b"), F.coalesce(F.sum("_s").over(W.partitionBy(by).orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
    inner = F.coalesce(F.sum(value).over(W.partitionBy(by, bucket).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    own = df.withColumn("_inner", inner)
    return own.join(base, (own[by] == base["_by"]) & (own[bucket] == base["_b"])).withColumn(name, (F.col("_base") + F.col("_inner")).cast("long")).drop("_by", "_b", "_base", "_inner")


def mix(docs: DataFrame, *, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3, share: float = 1.0, block: int = 1024) -> tuple[DataFrame, DataFrame]:
    """(documents, schedule).

    documents: s, start, doc_id, source, size, source_size, target; s numbers the sources and start
    is the document's place among the words of its source, so (s, start) names a document that has
    words, also where rows repeat. schedule: slot, s, rank, epoch, block, start, doc_id, first, words
    - the pieces of documents that each slot takes, where first is the first word within the document.
    """
    keyed = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("null"), F.coalesce(F.col("text").cast("string"), F.lit("")))))
    sized = stored(docs.select("doc_id", "source", size_of(F.col("text").cast("string")).alias("size"), keyed.alias("k")), "sizes", wide=True)
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    plan = source_targets(per.select("source", "source_size"), weights, max_epochs, share)
    need = F.round("target").cast("long")
    plan = plan.withColumn("need", F.least(need, F.col("source_size") * max_epochs))
    blocks = F.ceil(F.col("source_size") / block).cast("long")
    plan = plan.withColumn("blocks", blocks).withColumn("epochs", F.when(F.col("source_size") > 0, F.expr("need div source_size")).otherwise(F.lit(0)))
    plan = plan.withColumn("rest", F.col("need") - F.col("epochs") * F.col("source_size"))
    plan = stored(plan.withColumn("slots", F.col("epochs") * F.col("blocks") + F.ceil(F.col("rest") / block).cast("long")), "plan")
    totals = plan.agg(F.sum("slots").alias("slots"), F.sum("need").alias("need")).first()
    n_docs = sized.count()

    # documents of each source, shuffled and laid end to end
    bits = _root(n_docs).bit_length() - 1
    sources = plan.select("s", F.col("source").alias("_source"), "source_size", "target")
    laid = sized.join(sources, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    bucket = F.shiftrightunsigned(F.conv(F.substring("k", 1, 8), 16, 10).cast("long"), 32 - bits)
    laid = _running(laid.withColumn("bucket", bucket), "s", "bucket", ["k", "doc_id", "size"], F.col("size"), "start")
    laid = stored(laid.select("doc_id", "source", "s", "size", "source_size", "target", "start"), "laid")
    last = F.expr(f"(start + size - 1) div {block}")
    pieces = laid.where("size > 0").select("doc_id", "s", "start", "size", F.explode(F.sequence(F.expr(f"start div {block}"), last)).alias("block"))

    # slots: points of the rotation looked up in cumulative targets
    spark = docs.sparkSession
    n_slots, total = int(totals["slots"] or 0), int(totals["need"] or 0)
    ranges = _before(plan.where("need > 0").select("s", "need", "blocks", "epochs", "rest", "slots"), [F.col("s")], {"lo": F.col("need")})
    ranges = stored(ranges.withColumn("hi", F.col("lo") + F.col("need")).drop("need"), "shares")
    n_cells = max(CELLS, 4 * ranges.count())
    scale = F.lit(max(total, 1) / PERIOD)
    width = F.lit(max(total, 1) / n_cells)
    cells = ranges.withColumn("cell", F.explode(F.sequence(F.floor(F.col("lo") / width).cast("long"), F.least(F.floor(F.col("hi") / width).cast("long"), F.lit(n_cells)))))
    chunk_bits = _root(n_slots).bit_length() - 1
    points = spark.range(n_slots).select(F.col("id").alias("slot"), (((F.col("id") % PERIOD) * GOLDEN % PERIOD) * scale).alias("at"))
    points = points.withColumn("cell", F.floor(F.col("at") / width).cast("long"))
    slots = points.join(cells, "cell").where("at >= lo and at < hi").select("slot", "s", F.shiftright("slot", chunk_bits).alias("chunk"))
    ranked = _running(slots, "s", "chunk", ["slot"], F.lit(1), "rank")
    given = stored(ranked.select("slot", "s", "rank"), "slots")
    have = given.groupBy("s").agg(F.count("*").alias("have"))
    late = ranges.join(have, "s", "left").withColumn("have", F.coalesce("have", F.lit(0))).where("have < slots")
    late = late.select("s", F.explode(F.sequence("have", F.col("slots") - 1)).alias("rank"))
    late = _before(late, [F.col("rank"), F.col("s")], {"slot": F.lit(1)}).select((F.col("slot") + n_slots).alias("slot"), "s", "rank")
    used = given.unionByName(late).join(ranges.drop("lo", "hi"), "s").where("rank < slots")
    used = used.select("slot", "s", "rank", F.expr("rank div blocks").alias("epoch"), F.expr("rank % blocks").alias("block"), F.when(F.expr("rank div blocks") < F.col("epochs"), F.lit(block)).otherwise(F.least(F.lit(block), F.col("rest") - F.expr("rank % blocks") * block)).alias("take"))

    lo = F.greatest(F.col("start"), F.col("block") * block)
    hi = F.least(F.col("start") + F.col("size"), F.col("block") * block + F.col("take"))
    schedule = used.join(pieces, ["s", "block"]).select("slot", "s", "rank", "epoch", "block", "start", "doc_id", (lo - F.col("start")).alias("first"), (hi - lo).cast("long").alias("words")).where("words > 0")
    return laid, schedule


def digest(docs: DataFrame, **options) -> DataFrame:
    """The columns of query op1: what the mix takes of each document, and in how many slots, from which to which."""
    laid, schedule = mix(docs, **options)
    slots = [F.min("slot").alias("first_slot"), F.max("slot").alias("last_slot"), F.count("*").alias("n_slots")]
    taken = schedule.groupBy(F.col("s").alias("_s"), F.col("start").alias("_start")).agg(F.sum("words").alias("taken"), *slots)
    sums = laid.join(taken, (F.col("s") == F.col("_s")) & (F.col("start") == F.col("_start")) & (F.col("size") > 0), "left")
    none = F.lit(0).cast("long")
    return sums.select("doc_id", "size", "source_size", "target", F.coalesce("taken", none).alias("taken"), "first_slot", "last_slot", F.coalesce("n_slots", none).alias("n_slots"))
