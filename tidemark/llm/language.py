"""Language identification with interpolated Kneser-Ney character models.

One model per language over character ``order``-grams (order 4), trained on at most ``per_lang``
whole texts a language: those with the smallest hashes among the rows that :func:`learnable` admits,
as long as they have at most ``max_bytes`` together. Learned are at most ``most`` = 1,000 languages, those of most such rows,
and together they share ``all_bytes`` = 32 MB, so from five languages on each has an equal part of that. Texts longer than a
language's bytes come last, and of a language that has only such ones the shortest is taken.
The alphabet is the 32,765 most frequent characters of the training texts (all of them, but for a
mixture of several scripts of ideographs); characters outside it are one class. A model's discounts are the usual
n1 / (n1 + 2 n2) per order; lower orders use continuation counts; the lowest interpolates with the
uniform distribution.

The n-grams seen in any of eight languages (:class:`Part`) are kept as one sorted array of 64-bit hashes (packed character
classes) with a row of log probabilities per language, resolved through all orders when the model
is fitted; an n-gram that none of them saw is looked up at the next lower order with the weight of
its context. Scoring a character is one binary search a part as a rule. Languages do not depend on each other, so parts
change no loss beyond rounding, and neither a table nor a block of texts grows with the square of the languages.

A text goes to the language of lowest cross-entropy per character. Rejection is calibrated on
training texts held out from counting: a text is rejected if its best cross-entropy exceeds the
largest held-out one of that language by ``slack`` = 0.5 nats and three standard errors, from the
spread of a character's loss in that language's held-out texts.
Score: the share of the chosen language in the softmax of the negative mean log losses, sharpened
by the number of characters up to 50.

Defined cases: a null text, or one without a letter, is ``und`` with score 0 and rejected; if
nothing can be learned every text is ``und``; repeated rows are judged alike; lang, source and
doc_id are never inputs of a prediction; a row with a null doc_id is not learned from and not held
out; extra columns pass through unless named as an added one, and names that begin with ``_tm_`` are
reserved; empty table: empty result. Whole texts are scored; memory is one block of texts and the model,
whose size is bounded by ``all_bytes``: at most four n-grams of eight log probabilities a training character.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from tidemark.llm import kernels as K
from tidemark.llm.durable import stored

#: Bits of a packed character class; four of them make a 64-bit gram.
BITS = 15
ORDER = 4
#: Languages whose log probabilities stand in one table: what a character costs in memory does not grow with the languages.
WIDTH = 8
#: Held-out characters from which the spread of losses is taken; with fewer it is 1.
LEAST_CHARS = 200
_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    """Which code points are letters."""
    global _letters
    if _letters is None:
        _letters = np.array([chr(c).isalpha() for c in range(0x110000)])
    return _letters


def learnable(doc_id: str = "doc_id") -> Column:
    """Rows from which may be learned: crc32 of the id as text leaves another remainder than 1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 != 1, F.lit(False))


def code_points(data: np.ndarray) -> np.ndarray:
    return np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)


def char_offsets(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where documents begin, counted in code points."""
    return np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))[offsets]


def _classes(alphabet: np.ndarray, points: np.ndarray) -> np.ndarray:
    """1 is the start of a text, 2 any other character, from 3 on the alphabet."""
    if not len(alphabet):
        return np.full(len(points), 2, np.int64)
    at = np.minimum(np.searchsorted(alphabet, points), len(alphabet) - 1)
    return np.where(alphabet[at] == points, at + 3, 2).astype(np.int64)


def _lower(points: np.ndarray) -> np.ndarray:
    out = points.copy()
    out[(points >= 65) & (points <= 90)] += 32
    return out


def _grams(classes: np.ndarray, offsets: np.ndarray, order: int) -> np.ndarray:
    """The packed n-gram that ends at each character; texts are padded with class 1."""
    n = len(classes)
    start = np.repeat(offsets[:-1], np.diff(offsets))
    out = np.zeros(n, np.int64)
    for back in range(order):
        c = np.ones(n, np.int64)
        c[back:] = classes[: n - back]
        c[np.arange(n) - back < start] = 1
        out |= c << (BITS * back)
    return out


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of texts and where each begins."""
    return np.frombuffer(b"".join(texts), np.uint8), np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)


class Part:
    """Models of up to WIDTH languages: log probabilities of all n-grams of every order that one of them has seen."""

    def __init__(self, counted: list[tuple[np.ndarray, np.ndarray]], size: int, order: int):
        self.order, self.width = order, len(counted)
        mask = [(1 << (BITS * n)) - 1 for n in range(order + 1)]
        levels: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(order)] + [[(gram, n.astype(np.float64)) for gram, n in counted]]
        for o in range(order - 1, 0, -1):  # continuation counts: distinct characters to the left
            for longer, _ in levels[o + 1]:
                gram, n = np.unique(longer & mask[o], return_counts=True)
                levels[o].append((gram.astype(np.int64), n.astype(np.float64)))
        self.keys: list[np.ndarray] = [np.zeros(1, np.int64)]
        self.logs: list[np.ndarray] = [np.full((1, self.width), -np.log(size), np.float32)]
        #: By order of the context: its key and the log weight it leaves to the lower order.
        self.contexts: list[np.ndarray] = []
        self.weights: list[np.ndarray] = []
        for o in range(1, order + 1):
            keys = np.unique(np.concatenate([gram for gram, _ in levels[o]]))
            heads = np.unique(keys >> BITS)
            prob = np.zeros((len(keys), self.width))
            left = np.ones((len(heads), self.width))
            down = np.searchsorted(self.keys[o - 1], keys & mask[o - 1])
            for k, (gram, n) in enumerate(levels[o]):
                once, twice = (n == 1).sum(), (n == 2).sum()
                d = float(np.clip(once / max(once + 2 * twice, 1), 0.1, 0.95))
                head, at = np.unique(gram >> BITS, return_inverse=True)
                total = np.bincount(at, n, len(head))
                kinds = np.bincount(at, minlength=len(head))
                left[np.searchsorted(heads, head), k] = d * kinds / total
                prob[np.searchsorted(keys, gram), k] = (n - d) / total[at]
            lower = np.exp(self.logs[o - 1][down].astype(np.float64))
            prob += left[np.searchsorted(heads, keys >> BITS)] * lower
            self.keys.append(keys)
            self.logs.append(np.log(prob).astype(np.float32))
            self.contexts.append(heads)
            self.weights.append(np.log(left).astype(np.float32))

    def log_prob(self, grams: np.ndarray, order: int) -> np.ndarray:
        """Log probability of each packed gram's last character in every language."""
        if order == 0:
            return np.repeat(self.logs[0], len(grams), axis=0)
        keys = self.keys[order]
        at = np.minimum(np.searchsorted(keys, grams), max(len(keys) - 1, 0))
        out = self.logs[order][at] if len(keys) else np.zeros((len(grams), self.width), np.float32)
        missing = np.flatnonzero(keys[at] != grams) if len(keys) else np.arange(len(grams))
        if len(missing):
            own = grams[missing]
            low = self.log_prob(own & ((1 << (BITS * (order - 1))) - 1), order - 1)
            heads, head = self.contexts[order - 1], own >> BITS
            if len(heads):
                h = np.minimum(np.searchsorted(heads, head), len(heads) - 1)
                low = low + np.where((heads[h] == head)[:, None], self.weights[order - 1][h], 0)
            out[missing] = low
        return out


class Model:
    """The languages' models in parts of WIDTH languages over one alphabet, and their calibrated limits."""

    def __init__(self, texts: dict[str, list[bytes]], order: int = ORDER, slack: float = 0.5):
        if BITS * order > 62:
            raise ValueError(f"grams of {order} characters do not fit 64 bits")
        self.langs = sorted(texts)
        self.order = order
        points = [p for own in texts.values() for t in own for p in [_lower(code_points(np.frombuffer(t, np.uint8)))]]
        seen, n = np.unique(np.concatenate(points or [np.zeros(0, np.uint32)]), return_counts=True)
        self.alphabet = np.sort(seen[np.argsort(-n, kind="stable")][: (1 << BITS) - 3])
        counted, held = [], []
        for lang in self.langs:
            own = texts[lang]
            cut = max(1, len(own) - max(1, len(own) // 5))
            held.append(own[cut:] or own)
            counted.append(np.unique(self._all_grams(*_joined(own[:cut])), return_counts=True))
        size = len(self.alphabet) + 2
        self.parts = [Part(counted[k : k + WIDTH], size, order) for k in range(0, len(counted), WIDTH)]
        #: Largest held-out cross-entropy per language, and the spread of a character's loss.
        self.limit = np.zeros(len(self.langs))
        self.spread = np.ones(len(self.langs))
        for k, own in enumerate(held):
            loss, chars, _ = self.losses(*_joined(own), self.parts[k // WIDTH : k // WIDTH + 1])
            loss, chars = loss[chars > 0, k % WIDTH], chars[chars > 0]
            mean = loss / chars
            self.limit[k] = (mean.max() if len(mean) else 0.0) + slack
            if chars.sum() >= LEAST_CHARS:
                self.spread[k] = np.sqrt((chars * (mean - loss.sum() / chars.sum()) ** 2).mean())

    def _all_grams(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return _grams(_classes(self.alphabet, _lower(code_points(data))), char_offsets(data, offsets), self.order)

    def log_prob(self, grams: np.ndarray, order: int) -> np.ndarray:
        """Log probability of each packed gram's last character in every language."""
        return np.concatenate([p.log_prob(grams, order) for p in self.parts], axis=1)

    def losses(self, data: np.ndarray, offsets: np.ndarray, parts: list[Part] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per document: summed loss by language (of the parts), code points, and whether it has a letter."""
        parts = self.parts if parts is None else parts
        points = code_points(data)
        at = char_offsets(data, offsets)
        chars = np.diff(at)
        grams = self._all_grams(data, offsets)
        full = np.flatnonzero(chars)
        out = np.zeros((len(chars), sum(p.width for p in parts)))
        has = np.zeros(len(chars), bool)
        if len(full):
            start = 0
            for p in parts:
                out[full, start : start + p.width] = -np.add.reduceat(p.log_prob(grams, self.order), at[full], axis=0, dtype=np.float64)
                start += p.width
            has[full] = np.logical_or.reduceat(letters()[points], at[full])
        return out, chars, has

    def judge(self, data: np.ndarray, offsets: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Per document: language, score, accepted."""
        n = len(offsets) - 1
        if not self.langs:
            return ["und"] * n, np.zeros(n), np.zeros(n, bool)
        loss, chars, has = self.losses(data, offsets)
        mean = loss / np.maximum(chars, 1)[:, None]
        best = mean.argmin(axis=1)
        least = mean[np.arange(n), best]
        share = 1 / np.exp(-(mean - least[:, None]) * np.minimum(chars, 50)[:, None]).sum(axis=1)
        accepted = has & (least <= self.limit[best] + 3 * self.spread[best] / np.sqrt(np.maximum(chars, 1)))
        return [self.langs[b] if ok else "und" for b, ok in zip(best, has)], np.where(has, share, 0.0), accepted


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether the remainder is 1; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", per_lang: int = 400, max_bytes: int = 8 << 20, most: int = 1000, all_bytes: int = 32 << 20) -> Model:
    """A model of the languages of docs, from at most per_lang texts and max_bytes bytes of text a language, ``most`` languages and
    all_bytes bytes together; what the driver holds is bounded by these and by the shortest text of a language that has only longer ones."""
    share = F.pmod(F.xxhash64(F.col(doc_id).cast("string"), F.lit("language")), F.lit(1 << 30)) / float(1 << 30)
    rows = docs.where(learnable(doc_id) & F.col(lang).isNotNull() & (F.length(text) > 0)).select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("binary").alias("t"), share.alias("share"))
    common = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(most).withColumnRenamed("lang", "own")
    counts = stored(common, "langs")
    own = min(max_bytes, all_bytes // max(counts.count(), 1))
    few = rows.join(F.broadcast(counts), F.col("lang") == F.col("own")).where(F.col("share") * F.col("n") < 1.3 * per_lang)
    long = F.when(F.length("t") > own, F.length("t")).otherwise(0)
    order = W.partitionBy("lang").orderBy(long, "share", "t")
    sized = few.withColumn("place", F.row_number().over(order)).withColumn("bytes", F.sum(F.length("t")).over(order.rowsBetween(W.unboundedPreceding, 0)))
    chosen = sized.where((F.col("place") <= per_lang) & ((F.col("place") == 1) | (F.col("bytes") <= own))).select("lang", "t", "place")
    texts: dict[str, dict[int, bytes]] = {}
    for r in chosen.toLocalIterator():
        texts.setdefault(r["lang"], {})[r["place"]] = bytes(r["t"])
    return Model({x: [found[k] for k in sorted(found)] for x, found in texts.items()})


def identify(docs: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """docs with ``lang_pred``, ``score`` and ``accepted``."""
    added = ("lang_pred", "score", "accepted")
    keep = docs.drop(*(c for c in added if c != text))
    schema = T.StructType([*keep.schema.fields, T.StructField("_tm_lang", T.StringType()), T.StructField("_tm_score", T.DoubleType()), T.StructField("_tm_ok", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets, _ = K.buffers(K.column(batch, text))
            found = [model.judge(d, o) for _, _, d, o in K.blocks(data, offsets)]
            columns = [pa.array([x for f in found for x in f[0]], pa.string())]
            columns += [pa.array(np.concatenate([f[k] for f in found] or [np.zeros(0, t)]).astype(t)) for k, t in ((1, np.float64), (2, bool))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=schema.names)

    out = keep.transform(K.mapped, run, schema)
    return out.drop(*(c for c in added if c == text)).withColumnsRenamed(dict(zip(("_tm_lang", "_tm_score", "_tm_ok"), added)))


def digest(docs: DataFrame) -> DataFrame:
    """The columns of query op9."""
    found = identify(docs.select("doc_id", F.col("text").cast("string").alias("text")), fit(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
