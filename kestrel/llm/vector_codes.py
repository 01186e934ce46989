"""Vector code compression with Orchard search (operator 11).

Vectors become integers floor(``SCALE`` * x), are cut into ``parts`` equal
consecutive parts, and each part is replaced by the index of its codebook's
nearest entry. Codebooks start as the parts of the vectors with the smallest
ids and are moved to their parts' floored means in ``rounds`` passes; a pass
adds integers only, so the result does not depend on the order of the rows.

The nearest entry is found by Orchard's search: every entry holds a list of
all entries by rising distance from it. A query starts at a guess and walks
its entry's list; an entry that is nearer to the query (or as near, with a
lower index) becomes the current one and its list is walked from the start.
Entries once compared are marked and not compared again. The walk ends at the
first entry that is farther from the current one than twice the query's
distance: by the triangle inequality none behind it can be as near. All in
integers, so the answer is exact, ties included. A task walks the lists of
many queries at once, ``STEP`` entries a turn.

Codebooks (parts x entries x components) are the only thing that travels; a
task sends back one row of sums per codebook component.

Defined cases: rows whose vector is null or has null or non-finite components
are dropped; rows equal in id are all coded, and equal ids are ordered by
their vectors where codebooks start; a null id comes last there; fewer rows
than entries give smaller codebooks; an empty table gives no rows; vectors of
unequal length, of a length that the parts do not divide, or with components
of 2^19 and more (whose squared distances leave 64 bits) are an error; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.storage import materialize

PARTS, ENTRIES, ROUNDS = 16, 64, 2
SCALE = 256
#: entries of a list that a turn compares, and vectors walked at once
STEP, BATCH = 8, 4096
_LIMIT = 1 << 27
_BEYOND = np.iinfo(np.int64).max
_HEX = np.array([f"{i:02x}" for i in range(256)])


class Orchard:
    """Distance-sorted neighbour lists of the entries of one codebook."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.k = len(entries)
        d2 = ((entries[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
        order = np.argsort(d2, axis=1, kind="stable")
        # the lists end in places beyond any distance, so that a turn never leaves them
        self.near = np.pad(order, ((0, 0), (0, STEP)))
        self.far = np.pad(np.take_along_axis(d2, order, axis=1), ((0, 0), (0, STEP)), constant_values=_BEYOND)
        self.by_first = np.argsort(entries[:, 0], kind="stable")
        self.compared = 0

    def _guess(self, q: np.ndarray) -> np.ndarray:
        """The entry whose first component is the next one up."""
        at = np.searchsorted(self.entries[self.by_first, 0], q[:, 0])
        return self.by_first[np.minimum(at, self.k - 1)]

    def nearest(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of each row's nearest entry, ties to the
        lower index."""
        best = self._guess(q)
        d = ((q - self.entries[best]) ** 2).sum(axis=1)
        at = np.zeros(len(q), dtype=np.int64)
        marked = np.zeros((len(q), self.k), dtype=bool)
        marked[np.arange(len(q)), best] = True
        self.compared += len(q)
        live, ahead = np.arange(len(q)), np.arange(STEP)
        while live.size:
            now, places = best[live], at[live][:, None] + ahead
            e = self.near[now[:, None], places]
            within = self.far[now[:, None], places] <= 4 * d[live][:, None]
            row, col = np.nonzero(within & ~marked[live[:, None], e])
            who, which = live[row], e[row, col]
            marked[who, which] = True
            self.compared += len(who)
            found = np.full(within.shape, _BEYOND)
            found[row, col] = ((q[who] - self.entries[which]) ** 2).sum(axis=1)
            least = found.min(axis=1)
            # among the turn's nearest the lowest index
            index = np.where(found == least[:, None], e, self.k).min(axis=1)
            jump = (least < d[live]) | ((least == d[live]) & (index < now))
            best[live[jump]], d[live[jump]] = index[jump], least[jump]
            at[live] = np.where(jump, 0, at[live] + STEP)
            live = live[jump | within[:, -1]]
        return best, d


def integers(column: pa.Array, size: int) -> np.ndarray:
    """(rows x size) integer components of a list column."""
    lengths = np.diff(column.offsets.to_numpy())
    if len(lengths) and (lengths != size).any():
        raise ValueError(f"vectors of unequal length: {sorted({size, *lengths.tolist()})[:5]}")
    x = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * SCALE)
    if x.size and np.abs(x).max() >= _LIMIT:
        raise ValueError("a component of 2^19 or more: squared distances leave 64 bits")
    return x.astype(np.int64).reshape(-1, size)


def assign(x: np.ndarray, books: list[Orchard]) -> tuple[np.ndarray, np.ndarray]:
    """(rows x parts) indexes and squared distances."""
    width = x.shape[1] // len(books)
    found = [b.nearest(np.ascontiguousarray(x[:, p * width:(p + 1) * width])) for p, b in enumerate(books)]
    return np.stack([i for i, _ in found], axis=1), np.stack([d for _, d in found], axis=1)


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, embedding) of rows with finite components only."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.select("vec_id", "label", "embedding").where(F.col("embedding").isNotNull() & finite)


def first_codebooks(kept: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> np.ndarray | None:
    """(parts x entries x width) from the rows with the smallest ids."""
    rows = kept.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries).select("embedding").collect()
    if not rows:
        return None
    size = len(rows[0]["embedding"])
    if not size or size % parts:
        raise ValueError(f"{parts} equal parts of {size} components")
    x = integers(pa.array([r["embedding"] for r in rows], pa.list_(pa.float64())), size)
    return np.ascontiguousarray(x.reshape(len(rows), parts, size // parts).transpose(1, 0, 2))


def _batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in it:
        for at in range(0, b.num_rows, BATCH):
            yield b.slice(at, BATCH)


def moved(kept: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """Every entry at the floored mean of the parts assigned to it; entries
    without any stay. Each task adds up its rows first."""
    parts, k, width = codebooks.shape

    def sums(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = [Orchard(c) for c in codebooks]
        n, total = np.zeros((parts, k), dtype=np.int64), np.zeros((parts, k, width), dtype=np.int64)
        for b in _batches(it):
            x = integers(b.column("embedding"), parts * width)
            index, _ = assign(x, books)
            for p in range(parts):
                n[p] += np.bincount(index[:, p], minlength=k)
                np.add.at(total[p], index[:, p], x[:, p * width:(p + 1) * width])
        place = np.flatnonzero(np.repeat(n.ravel(), width))
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(np.repeat(n.ravel(), width)[place]), pa.array(total.ravel()[place])],
                                         names=["place", "n", "total"])

    # at most parts x entries x width rows come back
    found = (kept.select("embedding").mapInArrow(sums, "place long, n long, total long")
             .groupBy("place").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect())
    out = codebooks.copy().ravel()
    for r in found:
        out[r["place"]] = r["total"] // r["n"]
    return out.reshape(codebooks.shape)


def train(kept: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray | None:
    """Final codebooks; None without any row."""
    codebooks = first_codebooks(kept, parts, entries)
    for _ in range(rounds if codebooks is not None else 0):
        codebooks = moved(kept, codebooks)
    return codebooks


def encode(kept: DataFrame, codebooks: np.ndarray) -> DataFrame:
    """(vec_id, label, code, error): two hex digits a part, and the squared
    distance between the integer vector and its code's entries."""
    parts, k, width = codebooks.shape
    if k > 256:
        raise ValueError("a code has two hex digits a part")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = [Orchard(c) for c in codebooks]
        for b in _batches(it):
            index, d = assign(integers(b.column("embedding"), parts * width), books)
            code = ["".join(row) for row in _HEX[index].tolist()]
            yield pa.RecordBatch.from_arrays([b.column("vec_id").cast(pa.int64()), b.column("label").cast(pa.int64()),
                                              pa.array(code, pa.string()), pa.array(d.sum(axis=1))], names=["vec_id", "label", "code", "error"])

    return kept.mapInArrow(run, "vec_id long, label long, code string, error long")


def decode(code: str, codebooks: np.ndarray) -> np.ndarray:
    """The integer vector that a code stands for."""
    return np.concatenate([codebooks[p, int(code[2 * p:2 * p + 2], 16)] for p in range(len(codebooks))])


def fingerprint(codebooks: np.ndarray | None) -> str:
    """SHA-256 of all entries' components by part, entry and position."""
    parts = [] if codebooks is None else codebooks.ravel().tolist()
    return hashlib.sha256(",".join(map(str, parts)).encode()).hexdigest()


def with_total(rows: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """``rows`` with the sum of ``value`` over rows of equal ``key`` (nulls
    together). Keys with a thousandth of all rows, at most 1,000 of them, are
    broadcast; the others meet by shuffle, no large key among them."""
    totals = materialize(rows.groupBy(F.col(key).alias("_key")).agg(F.sum(value).alias(out), F.count(F.lit(1)).alias("_n")), "key-totals")
    n = totals.agg(F.sum("_n")).first()[0] or 0
    large = F.col("_n") * 1000 >= n
    hot = F.broadcast(totals.where(large).drop("_n"))
    same = F.col(key).eqNullSafe(F.col("_key"))
    parts = rows.join(hot, same).drop("_key")
    if totals.where(~large).isEmpty():
        return parts
    rest = rows.join(hot, same, "left_anti").join(totals.where(~large).drop("_n"), same).drop("_key")
    return parts.unionByName(rest)


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256, label)."""
    kept = usable(vectors)
    codebooks = train(kept, parts, entries, rounds)
    if codebooks is None:
        coded = vectors.sparkSession.createDataFrame([], "vec_id long, label long, code string, error long")
    else:
        coded = materialize(encode(kept, codebooks), "vector-codes")
    return with_total(coded, "label", "error", "label_error").select(
        "vec_id", "code", "error", "label_error", F.lit(fingerprint(codebooks)).alias("codebooks_sha256"), "label")
