"""Quality rules: robust multivariate outliers per language and source (DataFrame functions only).

Base statistics of each whole text are counted exactly; four of them, transformed, form a vector
(:data:`VECTOR`). For every (lang, source), every lang and all rows together a minimum-covariance-
determinant estimate is taken. Its ``STARTS`` starts are the coordinate medians with median
deviations, the mean and covariance of all rows, and those of two halves of the cells (below; by the
parity of their indices' sum). Each
is concentrated - the ``h`` share of rows nearest by Mahalanobis distance gives the next mean and
covariance - until its determinant no longer falls, ``steps`` = 30 times at most; the least determinant wins, and its covariance is scaled
so that the median distance is at most that of a chi-square with four degrees.

A group's estimate is shrunk towards that of its language, and that towards all rows', with the
weight of ``own`` rows: mean and covariance are weighted by rows against ``own``. So each document is
judged by its own language and source, however few rows they have. Documents beyond ``cut``, the
chi-square's 99.9 % quantile, are rejected.

All rows are reduced to cells in one pass that adds up within partitions first: per group and per
box of 1 / ``GRID`` units, the number of rows and the sums of their vectors and products. What
follows works on cells, so no group's rows are gathered, reruns agree and ties fall together. Rows
that fail the base rules are judged by them alone and do not shape the estimates. A floor on
standard deviations (``floor``, in transformed units) keeps constant statistics harmless.

Defined cases: null text counts as empty and fails the base rules (under 50 words); null lang or
source form their own groups; repeated rows are judged alike; extra columns are ignored; without a
row that passes the base rules nothing is kept; empty table: empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tidemark.llm.durable import stored

WHITE = "\t\n\x0b\f\r "
VECTOR = ("word_size", "symbol_share", "same_line_share", "repeat_share")
P = len(VECTOR)
#: Least standard deviations. A repeated opening line makes up much of a short text, so the two shares of repetition
#: vary more freely; with CUT, two thirds of the lines or a third of the words still reject alone where nobody repeats.
FLOOR = (0.05, 0.05, 0.2, 0.2)
#: Median of the chi-square distribution with four degrees of freedom.
CHI2_MEDIAN = 3.3567
#: Its 99.9 % quantile: the greatest squared distance that is kept.
CUT = 18.4668
#: Bins per unit of a statistic, and of the logarithm of a squared distance.
GRID, DISTANCE_GRID = 32, 16
STARTS = 4
PAIRS = tuple((i, j) for i in range(P) for j in range(i + 1))
#: Columns of a cell that add up, and of an estimate.
SUMS = ("n", *(f"t{i}" for i in range(P)), *(f"c{i}{j}" for i, j in PAIRS))
ESTIMATE = (*(f"m{i}" for i in range(P)), *(f"v{i}{j}" for i, j in PAIRS))


def let(value: Column, body) -> Column:
    """body(value) with value computed once a row, also where body uses it in a lambda."""
    return F.transform(F.array(value), body)[0]


def repeat_words(w: Column) -> Column:
    """Number of words that lie in a 3-word window found twice or more in the array w."""

    def marked(keyed: Column) -> Column:
        def twin(x: Column, i: Column) -> Column:
            return F.coalesce(F.get(keyed, i - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(keyed, i + 1)["h"] == x["h"], F.lit(False))

        at = F.transform(F.filter(keyed, twin), lambda x: F.array(x["p"], x["p"] + 1, x["p"] + 2))
        return F.size(F.array_distinct(F.flatten(at))).cast("long")

    windows = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("p")))
    return F.when(F.size(w) < 4, F.lit(0).cast("long")).otherwise(let(F.sort_array(windows), marked))


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, base_failed."""
    raw = F.coalesce(F.col("text").cast("string"), F.lit(""))
    plain = F.trim(F.translate(raw, WHITE, " " * len(WHITE)))
    parts = F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " +"))
    lines = F.filter(F.split(raw, "\n"), lambda x: F.trim(F.translate(x, WHITE, " " * len(WHITE))) != "")
    counted = docs.select(
        "doc_id", F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"),
        F.length(F.translate(raw, WHITE, "")).cast("long").alias("word_chars"),
        (F.length(raw) - F.length(F.translate(raw, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"))).alias("l"),
        let(parts, lambda w: F.struct(F.size(w).cast("long").alias("n"), repeat_words(w).alias("again"))).alias("w"),
    )
    out = counted.select("doc_id", "lang", "source", F.col("w.n").alias("n_words"), "word_chars", "n_symbols", F.col("l.n").alias("n_lines"), F.col("l.dup").alias("n_dup_lines"), F.col("w.again").alias("n_repeat_words"))
    return out.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def transformed() -> list[Column]:
    """The vector of a row of :func:`statistics`."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    return [
        F.log(F.lit(1.0) + F.col("word_chars") / words),
        F.log1p(20 * F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1))),
        F.log1p(2 * F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))),
        F.log1p(4 * F.col("n_repeat_words") / words),
    ]


def levels() -> list[Column]:
    """The group of a row as JSON: of language and source, of language, of all."""
    own = lambda *c: F.to_json(F.struct(*c), {"ignoreNullFields": "false"})
    return [own("lang", "source"), own("lang"), F.lit("all")]


def cells(rows: DataFrame) -> DataFrame:
    """Per group of every level and box: b0..3, n, t0..3 (sums), c00..c33 (sums of products); rows: lang, source, x0..3."""
    boxes = [F.floor(F.col(f"x{k}") * GRID).cast("int").alias(f"b{k}") for k in range(P)]
    sums = [F.sum(f"x{i}").alias(f"t{i}") for i in range(P)] + [F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"c{i}{j}") for i, j in PAIRS]
    fine = rows.groupBy("lang", "source", *boxes).agg(F.count("*").alias("n"), *sums)
    return fine.withColumn("g", F.explode(F.array(*levels()))).groupBy("g", *(f"b{k}" for k in range(P))).agg(*(F.sum(c).alias(c) for c in SUMS))


def _quantile(df: DataFrame, keys: list[str], bin_: Column, q: float) -> DataFrame:
    """keys and ``bin``, the lowest at which at least the q share of a key's n is reached."""
    counts = df.groupBy(*keys, bin_.alias("bin")).agg(F.sum("n").alias("n"))
    order = W.partitionBy(*keys).orderBy("bin")
    run = counts.withColumn("upto", F.sum("n").over(order)).withColumn("all", F.sum("n").over(W.partitionBy(*keys)))
    return run.where(F.col("upto") >= F.col("all") * q).groupBy(*keys).agg(F.min("bin").alias("bin"))


def _medians(df: DataFrame, values: list[Column], name: str) -> DataFrame:
    """g and the coordinate medians {name}0..3, bin centres of values that are already scaled to bins."""
    long = df.select("g", "n", F.posexplode(F.array(*values)).alias("i", "v"))
    found = _quantile(long, ["g", "i"], F.floor("v"), 0.5)
    return found.groupBy("g").agg(*(F.max(F.when(F.col("i") == k, (F.col("bin") + 0.5) / GRID)).alias(f"{name}{k}") for k in range(P)))


def _factor(params: DataFrame, keys: list[str]) -> DataFrame:
    """keys, m0..3 and v00..v33 with the Cholesky factor l00..l33 and ``det``, the logarithm of the determinant."""
    for i, j in PAIRS:
        s = F.col(f"v{i}{j}")
        for k in range(j):
            s = s - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
        params = params.withColumn(f"l{i}{j}", F.sqrt(F.greatest(s, F.lit(1e-9))) if i == j else s / F.col(f"l{j}{j}"))
    det = reduce(lambda a, b: a + b, (2 * F.log(f"l{i}{i}") for i in range(P)))
    return params.select(*keys, *(f"m{k}" for k in range(P)), *(f"v{i}{j}" for i, j in PAIRS), *(f"l{i}{j}" for i, j in PAIRS), det.alias("det"))


def _estimated(df: DataFrame, keys: list[str], floor: tuple[float, ...]) -> DataFrame:
    """The mean and covariance, with the floor, of the rows that df's cells stand for."""
    sums = df.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in SUMS))
    means = sums.select("*", *((F.col(f"t{i}") / F.col("n")).alias(f"m{i}") for i in range(P)))
    return means.select(*keys, *(f"m{i}" for i in range(P)), *((F.col(f"c{i}{j}") / F.col("n") - F.col(f"m{i}") * F.col(f"m{j}") + F.lit(floor[i] ** 2 if i == j else 0.0)).alias(f"v{i}{j}") for i, j in PAIRS))


def _distance(point: list[Column]) -> list[tuple[str, Column]]:
    """Named columns y0..3 and d2, the squared Mahalanobis distance of a point by the factor and mean in the row."""
    out = []
    for i in range(P):
        s = point[i] - F.col(f"m{i}")
        for k in range(i):
            s = s - F.col(f"l{i}{k}") * F.col(f"y{k}")
        out.append((f"y{i}", s / F.col(f"l{i}{i}")))
    return [*out, ("d2", F.greatest(reduce(lambda a, b: a + b, (F.col(f"y{i}") * F.col(f"y{i}") for i in range(P))), F.lit(1e-6)))]


def _far(df: DataFrame, point: list[Column]) -> DataFrame:
    for name, value in _distance(point):
        df = df.withColumn(name, value)
    return df.drop(*(f"y{i}" for i in range(P)))


def robust(table: DataFrame, *, h: float = 0.75, steps: int = 30, floor: tuple[float, ...] = FLOOR) -> DataFrame:
    """Per group g of stored cells: rows, m0..3 and v00..v33 of the least determinant, scaled."""
    means = [F.col(f"t{k}") / F.col("n") for k in range(P)]
    centre = _medians(table, [F.col(f"b{k}") for k in range(P)], "m")
    spread = _medians(table.join(centre, "g"), [F.abs(means[k] - F.col(f"m{k}")) * GRID for k in range(P)], "s")
    medians = centre.join(spread, "g").select("g", F.lit(0).alias("start"), *(f"m{k}" for k in range(P)), *((F.pow(F.greatest(1.4826 * F.col(f"s{i}"), F.lit(floor[i])), F.lit(2.0)) if i == j else F.lit(0.0)).alias(f"v{i}{j}") for i, j in PAIRS))
    # the mean of all rows and of two halves of the cells
    half = 2 + F.pmod(reduce(lambda a, b: a + b, (F.col(f"b{k}") for k in range(P))), F.lit(2))
    others = _estimated(table.withColumn("start", F.explode(F.array(F.lit(1), half))), ["g", "start"], floor)
    keys = ["g", "start"]
    now = _factor(medians.unionByName(others), keys)
    files = 1 + table.select("g").distinct().count() * STARTS // 100_000
    point = F.floor(F.log("d2") * DISTANCE_GRID)

    def concentrated(params: DataFrame) -> DataFrame:
        near = _far(table.join(params, "g"), means).withColumn("at", point)
        kept = near.select(*keys, *SUMS, "at").join(_quantile(near, keys, F.col("at"), h), keys).where("at <= bin")
        return stored(_factor(_estimated(kept, keys, floor), keys).coalesce(files), "estimates")

    now, done = concentrated(stored(now.coalesce(files), "starts")), []
    for _ in range(steps):
        after = concentrated(now)
        lower = after.join(now.select(*keys, F.col("det").alias("old")), keys).where(F.col("det") < F.col("old") - 1e-9).select(*after.columns)
        done.append(now.join(lower.select(*keys), keys, "left_anti"))
        now = stored(lower.coalesce(files), "lower")
        if now.isEmpty():
            break
    now = stored(reduce(DataFrame.unionByName, done, now).coalesce(files), "settled")
    best = now.groupBy("g").agg(F.min(F.struct("det", "start")).alias("b")).select("g", F.col("b.start").alias("start"))
    best = stored(now.join(best, keys).coalesce(files), "least")
    half_way = _quantile(_far(table.join(best, "g"), means), ["g"], point, 0.5)
    scale = half_way.select("g", F.greatest(F.exp((F.col("bin") + 0.5) / DISTANCE_GRID) / CHI2_MEDIAN, F.lit(1.0)).alias("scale"))
    rows = table.groupBy("g").agg(F.sum("n").alias("rows"))
    return best.join(scale, "g").join(rows, "g").select("g", "rows", *(f"m{k}" for k in range(P)), *((F.col(f"v{i}{j}") * F.col("scale")).alias(f"v{i}{j}") for i, j in PAIRS))


def _shrunk(fine: DataFrame, coarse: DataFrame, up: str, own: float) -> DataFrame:
    """fine's estimates with ``own`` rows' weight of the coarse group named in column up."""
    other = coarse.select(F.col("g").alias("_up"), *(F.col(c).alias(f"_{c}") for c in ESTIMATE))
    share = F.lit(own) / (F.col("rows") + own)
    return fine.join(other, F.col(up) == F.col("_up")).select("g", "rows", *(c for c in fine.columns if c in ("up", "top")), *((F.col(c) + share * (F.col(f"_{c}") - F.col(c))).alias(c) for c in ESTIMATE))


def judge(docs: DataFrame, *, own: float = 50.0, cut: float = CUT, h: float = 0.75, steps: int = 30, floor: tuple[float, ...] = FLOOR) -> DataFrame:
    """The rows of :func:`statistics` with ``distance`` (squared, robust; null without a verdict) and ``kept``."""
    stats = stored(statistics(docs), "statistics", wide=True)
    x = stats.select("*", *(v.alias(f"x{k}") for k, v in enumerate(transformed())))
    judged = x.where("not base_failed")
    found = stored(robust(stored(cells(judged), "cells"), h=h, steps=steps, floor=floor), "robust")
    names = [c.alias(n) for c, n in zip(levels(), ("g", "up", "top"))]
    groups = judged.select("lang", "source").distinct().select(*names)
    middle = _shrunk(found.join(groups.select(F.col("up").alias("g"), "top").distinct(), "g"), found, "top", own)
    final = stored(_factor(_shrunk(found.join(groups.select("g", "up"), "g"), middle, "up", own), ["g"]), "shrunk")
    far = _far(judged.withColumn("g", levels()[0]).join(final, "g"), [F.col(f"x{k}") for k in range(P)]).withColumn("distance", F.col("d2"))
    rest = x.where("base_failed").withColumn("distance", F.lit(None).cast("double"))
    columns = [*stats.columns, "distance"]
    every = far.select(*columns).unionByName(rest.select(*columns))
    return every.withColumn("kept", ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= cut))


def digest(docs: DataFrame) -> DataFrame:
    """The columns of query op5."""
    return judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance")
