"""Vector code compression: product codes over integer components, learned by Hamerly's exact acceleration of Lloyd's rounds.

Rows whose vector is null or holds null or non-finite components are dropped. A component x becomes the integer
floor(1024 * x); vectors are cut into ``parts`` equal consecutive parts. Each part position has a codebook that starts as that part of
the ``entries`` smallest vec_ids. A round assigns every part to its nearest entry (squared Euclidean distance, ties to the
lower index) and replaces each entry by the componentwise floor of the mean of its parts; unused entries stay. After the last
round parts are assigned once more.

Beside its integers a stored row keeps, for each part, its entry, one upper bound of the distance to it and one lower bound
of the distance to the second-nearest entry. When the codebook has moved, the upper bound grows by its entry's move and the lower one
shrinks by the largest move of another entry. Only if the upper bound is strictly below the lower one (or below half the
distance from the entry to its nearest neighbour) is the entry kept unseen: then every other entry is strictly further away, so no
tie is decided by a bound. Else the upper bound is made exact, and if that fails too, all entries are compared by exact
integer distances. Bounds are rounded outwards. A task adds up its rows' new parts as it goes, so a round reads and writes the rows once
and shuffles a task's sums only; the driver holds the codebooks, ``entries`` times the vectors' width.

Integers are exact: distances are computed in doubles where these hold them (below 2**53), else in 64-bit integers;
components beyond +-2**27 / 1024 or whose distances would not fit raise an OverflowError.

Defined cases: null vec_ids come last among the smallest and keep a row of their own; repeated rows are rows of their own; fewer rows than
entries: a smaller codebook; vectors of different lengths, or of one that ``parts`` does not divide, raise a
ValueError; null labels are one label; extra columns are ignored; empty table: empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import kernels as K
from tidemark.llm.durable import stored
from tidemark.sources.durable import work_dir

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
#: Largest integer of a component.
MOST = 1 << 27
#: How far bounds are rounded outwards, relatively.
SLACK = 1e-9
#: Rows that are compared with all entries at once.
BLOCK = 1 << 12

Codebooks = list[np.ndarray]


def integers(column: pa.Array, parts: int) -> np.ndarray:
    """Lists of finite numbers as rows of integers."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    size = np.diff(np.asarray(column.offsets))
    if len(size) and (size != size[0]).any():
        raise ValueError("vectors of different lengths")
    if len(size) and size[0] % parts:
        raise ValueError(f"vectors of {size[0]} components cannot be cut into {parts} equal parts")
    scaled = np.floor(np.asarray(column.flatten(), dtype=np.float64) * SCALE)
    if len(scaled) and np.abs(scaled).max() > MOST:
        raise OverflowError(f"components beyond {MOST // SCALE} in size")
    return scaled.astype(np.int64).reshape(len(size), -1 if len(scaled) else 0)


def fits(x: np.ndarray, book: np.ndarray) -> bool:
    """Whether doubles hold all squared distances between the two."""
    most = float(max(np.abs(x).max(initial=0), np.abs(book).max(initial=0)))
    if 4 * most * most * x.shape[1] >= 2.0**63:
        raise OverflowError("squared distances do not fit into 64 bits")
    return 4 * most * most * x.shape[1] < 2.0**53


def distances(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """All squared distances, exactly."""
    if fits(x, book):
        a, b = x.astype(np.float64), book.astype(np.float64)
        return np.square(a).sum(axis=1)[:, None] + np.square(b).sum(axis=1)[None, :] - 2 * (a @ b.T)
    return np.stack([np.square(x - c).sum(axis=1) for c in book], axis=1)


def own_distances(x: np.ndarray, book: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Squared distances to the given entries, as integers."""
    fits(x, book)
    return np.square(x - book[code]).sum(axis=1)


def scanned(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(nearest entry, upper bound to it, lower bound to the second-nearest) of every row, by looking at all entries."""
    code, upper, lower = np.zeros(len(x), np.int64), np.zeros(len(x)), np.full(len(x), np.inf)
    for k in range(0, len(x), BLOCK):
        d = distances(x[k : k + BLOCK], book)
        rows = np.arange(len(d))
        best = d.argmin(axis=1)
        code[k : k + BLOCK], upper[k : k + BLOCK] = best, np.sqrt(d[rows, best].astype(np.float64)) * (1 + SLACK)
        if len(book) > 1:
            d = d.astype(np.float64)
            d[rows, best] = np.inf
            lower[k : k + BLOCK] = np.sqrt(d.min(axis=1)) * (1 - SLACK)
    return code, upper, lower


class Move:
    """What a change of one codebook does to the bounds."""

    def __init__(self, old: np.ndarray, new: np.ndarray) -> None:
        self.own = np.sqrt(np.square((new - old).astype(np.float64)).sum(axis=1)) * (1 + SLACK)
        order = np.argsort(-self.own, kind="stable")
        self.most = np.full(len(new), self.own[order[0]] if len(new) else 0.0)
        if len(new):
            self.most[order[0]] = self.own[order[1]] if len(new) > 1 else 0.0
        self.half = np.full(len(new), np.inf)
        if len(new) > 1:
            apart = distances(new, new).astype(np.float64)
            np.fill_diagonal(apart, np.inf)
            self.half = np.sqrt(apart.min(axis=1)) * (0.5 - SLACK)


def reassigned(x: np.ndarray, book: np.ndarray, move: Move, code: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(entry, upper bound, lower bound) of every row after a move, and how many rows had to look at all entries."""
    upper, lower, code = upper + move.own[code], np.maximum(lower - move.most[code], 0.0), code.copy()
    least = np.maximum(lower, move.half[code])
    open_ = np.flatnonzero(~(upper < least))
    upper[open_] = np.sqrt(own_distances(x[open_], book, code[open_]).astype(np.float64)) * (1 + SLACK)
    open_ = open_[~(upper[open_] < least[open_])]
    code[open_], upper[open_], lower[open_] = scanned(x[open_], book)
    return code, upper, lower, len(open_)


ROW = "vec_id {0}, label {1}, ints binary, code binary, upper binary, lower binary, part int, entry int, n long, total binary, kind int"
NAMES = ("vec_id", "label", "ints", "code", "upper", "lower", "part", "entry", "n", "total", "kind")


def _part(x: np.ndarray, p: int, parts: int) -> np.ndarray:
    width = x.shape[1] // parts
    return x[:, p * width : (p + 1) * width]


def _assign(books: Codebooks, moves: list[Move] | None, last: bool):
    """A round over rows: their entries and bounds, and (unless it is the last) at the task's end the sums of its parts by entry."""
    parts = len(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [(np.zeros(len(b), np.int64), np.zeros(b.shape, np.int64)) for b in books]
        scans = 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            if moves is None:
                x = integers(K.column(batch, "vec"), parts)
            else:
                x = np.frombuffer(b"".join(K.column(batch, "ints").to_pylist()), np.int32).reshape(n, -1).astype(np.int64)
                code, upper, lower = (np.frombuffer(b"".join(K.column(batch, c).to_pylist()), t).reshape(n, parts) for c, t in (("code", np.uint8), ("upper", np.float64), ("lower", np.float64)))
            if x.shape[1] != sum(b.shape[1] for b in books):
                raise ValueError("vectors of different lengths")
            found = []
            for p, book in enumerate(books):
                own = _part(x, p, parts)
                if moves is None:
                    found.append(scanned(own, book))
                else:
                    *now, seen = reassigned(own, book, moves[p], code[:, p].astype(np.int64), upper[:, p], lower[:, p])
                    found.append(now)
                    scans += seen
            codes = np.stack([f[0] for f in found], axis=1)
            if last:
                error = sum(own_distances(_part(x, p, parts), book, codes[:, p]) for p, book in enumerate(books))
                yield pa.RecordBatch.from_arrays([K.column(batch, "vec_id"), K.column(batch, "label"), pa.array([c.tobytes().hex() for c in codes.astype(np.uint8)], pa.string()), pa.array(error.astype(np.int64))], names=["vec_id", "label", "code", "error"])
                continue
            for p, (count, total) in enumerate(totals):
                np.add.at(count, codes[:, p], 1)
                np.add.at(total, codes[:, p], _part(x, p, parts))
            rows = [codes.astype(np.uint8), np.stack([f[1] for f in found], axis=1), np.stack([f[2] for f in found], axis=1)]
            packed = [pa.array([r.tobytes() for r in m], pa.binary()) for m in (x.astype(np.int32), *rows)]
            yield pa.RecordBatch.from_arrays([K.column(batch, "vec_id"), K.column(batch, "label"), *packed, *(pa.nulls(n, t) for t in (pa.int32(), pa.int32(), pa.int64(), pa.binary())), pa.array(np.zeros(n, np.int32))], names=NAMES)
        sums = [(p, e, int(count[e]), total[e].tobytes()) for p, (count, total) in enumerate(totals) for e in np.flatnonzero(count).tolist()]
        if sums and not last:
            # the empty rows of a batch have the types of the columns, which only Spark knows
            none = [batch.column(batch.schema.get_field_index(c)).slice(0, 0) for c in ("vec_id", "label")]
            void = [pa.nulls(len(sums), x.type) for x in none] + [pa.nulls(len(sums), pa.binary())] * 4
            yield pa.RecordBatch.from_arrays([*void, *(pa.array(c, t) for c, t in zip(zip(*sums), (pa.int32(), pa.int32(), pa.int64(), pa.binary()))), pa.array(np.ones(len(sums), np.int32))], names=NAMES)

    return run


def _merged(table: pa.Table) -> pa.Table:
    """The sums of all tasks for one entry of one part."""
    total = np.sum([np.frombuffer(x, np.int64) for x in K.column(table, "total").to_pylist()], axis=0, dtype=np.int64)
    count = int(np.sum(np.asarray(K.column(table, "n"))))
    return pa.table({"part": K.column(table, "part").slice(0, 1), "entry": K.column(table, "entry").slice(0, 1), "n": [count], "total": pa.array([total.tobytes()], pa.binary())})


def _moved(books: Codebooks, sums: DataFrame) -> Codebooks:
    """The codebooks with every used entry at the floor of its parts' mean."""
    out = [b.copy() for b in books]
    for r in sums.groupBy("part", "entry").applyInArrow(_merged, "part int, entry int, n long, total binary").collect():
        out[r["part"]][r["entry"]] = np.frombuffer(r["total"], np.int64) // r["n"]
    return out


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def finite(vectors: DataFrame, vector: str) -> DataFrame:
    """The rows whose vector has only finite components."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return vectors.where(F.col(vector).isNotNull() & ~F.exists(vector, bad))


def compress(vectors: DataFrame, vector: str = "embedding", key: str = "vec_id", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks]:
    """(key, label, code as hexadecimal, error: the squared distance to what the code stands for; the codebooks, one array a part)."""
    if not 1 <= entries <= 256:
        raise ValueError("an entry's index is one byte")
    spark, kinds = vectors.sparkSession, dict(vectors.dtypes)
    kept = finite(vectors, vector).select(F.col(key).alias("vec_id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("vec"))
    first = kept.orderBy(F.col("vec_id").isNull(), "vec_id", "vec").limit(entries).select("vec").collect()
    start = integers(pa.array([r["vec"] for r in first], pa.list_(pa.float64())), parts)
    books = [_part(start, p, parts).copy() for p in range(parts)]
    row, out = ROW.format(kinds[key], kinds[label]), "vec_id {}, label {}, code string, error long".format(kinds[key], kinds[label])
    now, moves, old = kept, None, ""
    for _ in range(rounds):
        if not first:
            break
        at = work_dir(spark, "codes")
        now.transform(K.mapped, _assign(books, moves, False), row).write.partitionBy("kind").parquet(at)
        if old:
            _delete(spark, old)  # all that it held stands in the new table
        sums = spark.read.schema("part int, entry int, n long, total binary").parquet(f"{at}/kind=1")
        moved = _moved(books, sums)
        moves, books, old = [Move(a, b) for a, b in zip(books, moved)], moved, at
        now = spark.read.schema(row.rpartition(",")[0]).parquet(f"{at}/kind=0").select("vec_id", "label", "ints", "code", "upper", "lower")
    return stored(now.transform(K.mapped, _assign(books, moves, True), out), "coded", wide=True), books


def decoded(codes: list[str], books: Codebooks) -> np.ndarray:
    """What codes stand for, as integers."""
    raw = np.array([list(bytes.fromhex(c)) for c in codes], dtype=np.int64).reshape(len(codes), len(books))
    return np.concatenate([b[raw[:, p]] for p, b in enumerate(books)], axis=1)


def books_hash(books: Codebooks) -> str:
    """SHA-256 of all entries' decimal components by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def digest(vectors: DataFrame) -> DataFrame:
    """The columns of query op12."""
    coded, books = compress(vectors)
    total = coded.groupBy(F.col("label").alias("own")).agg(F.sum("error").alias("label_error"))
    return coded.join(total, coded["label"].eqNullSafe(total["own"]), "left").select("vec_id", "code", "error", "label_error", F.lit(books_hash(books)).alias("codebooks_sha256"))
