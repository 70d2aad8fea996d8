"""Quality classifier: regularised quadratic discriminant over document statistics.

Each whole text becomes a fixed vector of transformed statistics (:data:`FEATURES`; no words,
labels, ids, languages or sources). Per class the mean and covariance come from sums of vectors
and of their outer products, which partitions add up before anything is shuffled, so every
labelled learnable row counts and nothing is sampled. A class covariance is shrunk towards the
pooled one and that towards its diagonal:

    S_k = (1 - a) S_k + a S_pooled,   S = (1 - b) S + b diag(S) + ridge

with a = ``shrink`` / (1 + n_k / p) growing as rows get few, and b = ``diagonal``. The score is the
logistic of the difference of the log densities plus log priors, from Mahalanobis distances by
cached Cholesky factors, divided by ``temperature`` (features are not independent draws).

Defined cases: null and empty texts have the vector of an empty text and get a score; labels other
than 0 and 1 and null labels are not learned from; a repeated label row counts each time; if a
class has no rows, the score is the prior share of label 1 (0.5 without any rows); repeated
documents are judged alike; a null doc_id has no label and is not held out; extra columns pass
through (``features`` and ``score`` are replaced); empty table: empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import kernels as K
from tidemark.llm.durable import stored
from tidemark.llm.language import held_out, learnable

FEATURES = ("words", "word_bytes", "word_spread", "upper", "symbols", "bangs", "digits", "marks", "lines", "wide", "entropy", "distinct", "repeats", "same_lines", "bars", "short_words")
P = len(FEATURES)
_SYMBOLS = list(b"#*$%&<>@~^=+_\\/")
_MARKS = list(b".,;:?'\"()-")


def vectors(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of FEATURES per document."""
    n = len(offsets) - 1
    out = np.zeros((n, P))
    size = np.diff(offsets)
    doc = np.repeat(np.arange(n), size)
    hist = np.bincount(doc * 256 + data, minlength=n * 256).reshape(n, 256).astype(np.float64)
    letters = hist[:, 65:91].sum(1) + hist[:, 97:123].sum(1) + hist[:, 192:256].sum(1)
    space = hist[:, [0x20, 9, 10, 11, 12, 13]].sum(1)
    ink = np.maximum(size - space, 1)

    def part(x: np.ndarray, of: np.ndarray, scale: float) -> np.ndarray:
        return np.log1p(scale * x / np.maximum(of, 1))

    starts, ends, at = K.words(data, offsets, K.NOT_SPACE)
    count = np.diff(at)
    length = (ends - starts).astype(np.float64)
    own = np.repeat(np.arange(n), count)
    some = np.maximum(count, 1)
    mean = np.bincount(own, length, n) / some
    spread = np.sqrt(np.maximum(np.bincount(own, length**2, n) / some - mean**2, 0))
    share = hist / np.maximum(size, 1)[:, None]
    out[:, 0] = np.log1p(count)
    out[:, 1] = np.log1p(mean)
    out[:, 2] = np.log1p(spread)
    out[:, 3] = part(hist[:, 65:91].sum(1), letters, 20)
    out[:, 4] = part(hist[:, _SYMBOLS].sum(1), ink, 50)
    out[:, 5] = part(hist[:, ord("!")], ink, 50)
    out[:, 6] = part(hist[:, 48:58].sum(1), ink, 50)
    out[:, 7] = part(hist[:, _MARKS].sum(1), ink, 20)
    out[:, 8] = part(hist[:, 10], some, 50)
    out[:, 9] = part(hist[:, 128:192].sum(1), ink, 10)
    out[:, 10] = -(share * np.log(np.maximum(share, 1e-12))).sum(1)
    out[:, 14] = part(hist[:, ord("|")], ink, 50)
    out[:, 15] = part(np.bincount(own, length <= 2, n), some, 5)
    h = K.word_hashes(data, starts, ends)
    out[:, 11] = np.log1p(_distinct(h, own, n)) / np.log1p(some)
    grams = K.mix(K.rolling_hash(h, 3, K.BASE_A))
    ok = K.whole(at, len(h), 3)
    grams, gram_doc = grams[ok], own[: len(ok)][ok]
    total = np.bincount(gram_doc, minlength=n)
    out[:, 12] = part(total - _distinct(grams, gram_doc, n), total, 20)
    first, last, line_at = K.words(data, offsets, ~(np.arange(256) == 10))
    line_doc = np.repeat(np.arange(n), np.diff(line_at))
    lines = K.word_hashes(data, first, last)
    out[:, 13] = part(np.diff(line_at) - _distinct(lines, line_doc, n), np.diff(line_at), 20)
    return out


def _distinct(h: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Number of different values in each document; doc is sorted."""
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return np.bincount(doc[fresh], minlength=n)


def featurise(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """docs without the text, with ``features``, an array of doubles."""
    keep = docs.drop("features") if text != "features" else docs
    schema = T.StructType([*(f for f in keep.schema.fields if f.name != text), T.StructField("features", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets, _ = K.buffers(K.column(batch, text))
            x = np.concatenate([vectors(d, o) for _, _, d, o in K.blocks(data, offsets)] or [np.zeros((0, P))])
            arrays = {k: c for k, c in zip(batch.schema.names, batch.columns) if k != text}
            arrays["features"] = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * P), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays(list(arrays.values()), names=list(arrays))

    return keep.transform(K.mapped, run, schema)


class Discriminant:
    """Priors, means and Cholesky factors of the two classes."""

    def __init__(self, sums: dict[int, tuple[float, np.ndarray, np.ndarray]], *, shrink: float = 0.5, diagonal: float = 0.02, ridge: float = 1e-3, temperature: float = 2.0):
        self.temperature = temperature
        n = {k: sums[k][0] if k in sums else 0.0 for k in (0, 1)}
        total = n[0] + n[1]
        self.prior = n[1] / total if total else 0.5
        self.classes: list[tuple[float, np.ndarray, np.ndarray, float]] = []
        if not n[0] or not n[1]:
            return
        means = {k: sums[k][1] / n[k] for k in (0, 1)}
        scatter = {k: sums[k][2] - n[k] * np.outer(means[k], means[k]) for k in (0, 1)}
        pooled = (scatter[0] + scatter[1]) / total
        for k in (0, 1):
            a = shrink + (1 - shrink) / (1 + n[k] / P)
            cov = (1 - a) * scatter[k] / n[k] + a * pooled
            cov = (1 - diagonal) * cov + np.diag(diagonal * np.diag(cov) + ridge)
            low = np.linalg.cholesky(cov)
            self.classes.append((np.log(n[k] / total), means[k], np.linalg.inv(low), 2 * np.log(np.diag(low)).sum()))

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.classes:
            return np.full(len(x), self.prior)
        logs = []
        for prior, mean, inverse, det in self.classes:
            y = (x - mean) @ inverse.T
            logs.append(prior - 0.5 * ((y * y).sum(axis=1) + det))
        return 1 / (1 + np.exp(np.clip((logs[0] - logs[1]) / self.temperature, -700, 700)))


def fit(vectors_: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", label: str = "quality", **options: float) -> Discriminant:
    """Learns from all rows of vectors_ (doc_id, features) that are learnable and labelled 0 or 1."""
    marked = labels.select(F.col(doc_id), F.col(label).cast("int").alias("y")).where(F.col(label).isin(0, 1) & learnable(doc_id))
    rows = vectors_.select(doc_id, "features").join(marked, doc_id).select("y", "features")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {0: np.zeros(1 + P + P * P), 1: np.zeros(1 + P + P * P)}
        for batch in batches:
            y = np.asarray(batch.column(0))
            x = np.asarray(batch.column(1).flatten()).reshape(-1, P)
            for k in held:
                own = x[y == k]
                held[k] += np.concatenate(([len(own)], own.sum(axis=0), (own.T @ own).ravel()))
        yield pa.RecordBatch.from_arrays([pa.array([0, 1], pa.int32()), pa.array([held[0].tolist(), held[1].tolist()], pa.list_(pa.float64()))], names=["y", "s"])

    parts = rows.transform(K.mapped, sums, "y int, s array<double>")
    flat = parts.select("y", F.posexplode("s")).groupBy("y", "pos").agg(F.sum("col").alias("v"))
    totals = {k: np.zeros(1 + P + P * P) for k in (0, 1)}
    for r in flat.collect():  # two classes of 1 + P + P * P sums
        totals[r["y"]][r["pos"]] = r["v"]
    return Discriminant({k: (t[0], t[1 : 1 + P], t[1 + P :].reshape(P, P)) for k, t in totals.items() if t[0]}, **options)


def score(vectors_: DataFrame, model: Discriminant) -> DataFrame:
    """vectors_ with ``score`` in place of ``features``."""
    keep = vectors_.drop("score")
    schema = T.StructType([*(f for f in keep.schema.fields if f.name != "features"), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.asarray(K.column(batch, "features").flatten()).reshape(-1, P)
            arrays = {k: c for k, c in zip(batch.schema.names, batch.columns) if k != "features"}
            yield pa.RecordBatch.from_arrays([*arrays.values(), pa.array(model.score(x))], names=[*arrays, "score"])

    return keep.transform(K.mapped, run, schema)


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The columns of query op3."""
    x = stored(featurise(docs.select("doc_id", F.col("text").cast("string").alias("text"))), "vectors", wide=True)
    found = score(x, fit(x, labels))
    return found.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
