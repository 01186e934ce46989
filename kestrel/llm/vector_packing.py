"""Vector bin packing of examples into training sequences (operator 13).

A sequence has three limits at once: tokens, segments (pieces of examples)
and loss-bearing tokens. Every task tokenizes its examples and packs them
block by block, a block holding about ``BLOCK_TOKENS`` ids, so no example
leaves its task and a task holds one block:

1. An example longer than a sequence gives full sequences from its start; its
   rest joins the block's pool.
2. Dot-product heuristic: one sequence is open at a time. Of the pooled
   examples that fit in every limit, the one goes in whose demand has the
   largest dot product with what the sequence has left; demands and
   remainders are shares of the limits, and each limit weighs by the pool's
   mean demand for it. Ties go to the longer example, then to the earlier
   one. Examples with equal demands are one class, so a choice looks at each
   different demand once.
3. Where nothing fits whole and ``MIN_CUT`` tokens or more are left, the
   longest example is cut to fill them (``cut=False`` leaves them empty);
   its rest goes back to the pool.
4. A block's last sequence isn't closed: its pieces join the next block's
   pool. So only the last sequence of a task has notable padding.

A token bears loss if something stands before it in its piece to predict it
from, and it isn't part of the prompt (a column of text put in front; without
one, every token of a piece but its first bears loss).

Defined cases: a null text or prompt is empty; an empty example is its end id
alone; repeated rows are packed each; null doc_ids stay null; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kestrel.llm.token_orc import worker_encoder
from kestrel.storage import broadcast_if_small, materialize

END_ID = 1
BLOCK_TOKENS = 1 << 22
MIN_CUT = 16
SCHEMA = ("part int, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence long, offset long, "
          "segment long, n_loss long")


@dataclass(frozen=True)
class Limits:
    tokens: int = 2048
    segments: int = 64
    loss: int = 2047

    def __post_init__(self):
        if self.tokens < 1 or self.segments < 1 or self.loss < self.tokens - 1:
            raise ValueError("a sequence must hold one piece of all its tokens")


class Piece(NamedTuple):
    """Ids start..start+length of example ``row``; ``prompt`` ids of the
    example bear no loss."""

    row: int
    start: int
    length: int
    prompt: int

    @property
    def loss(self) -> int:
        return self.start + self.length - max(self.start + 1, min(self.prompt, self.start + self.length))

    def split(self, at: int) -> tuple[Piece, Piece]:
        return self._replace(length=at), self._replace(start=self.start + at, length=self.length - at)


class Pool:
    """Pieces by demand (tokens, loss): one class a demand."""

    def __init__(self, pieces: list[Piece], limits: Limits):
        self.limits = limits
        self.number: dict[tuple[int, int], int] = {}
        self.members: list[list[Piece]] = []
        self.tokens, self.loss, self.left = (np.zeros(256, dtype=np.int64) for _ in range(3))
        self.n = 0
        for p in pieces:
            self.add(p)
        for m in self.members:
            m.reverse()  # taken from the end: the earliest first
        # mean share of a limit, times 1 / limit for the demand and for what is left
        n, tokens, loss = max(1, self.n), int((self.tokens * self.left).sum()), int((self.loss * self.left).sum())
        self.weight = tokens / n / limits.tokens ** 3, 1 / limits.segments ** 3, loss / n / limits.loss ** 3

    def add(self, p: Piece) -> None:
        key = p.length, p.loss
        c = self.number.get(key)
        if c is None:
            c = self.number[key] = len(self.members)
            self.members.append([])
            if c == len(self.tokens):
                self.tokens, self.loss, self.left = (np.concatenate([a, np.zeros_like(a)]) for a in (self.tokens, self.loss, self.left))
            self.tokens[c], self.loss[c] = key
        self.members[c].append(p)
        self.left[c] += 1
        self.n += 1

    def take(self, c: int) -> Piece:
        self.left[c] -= 1
        self.n -= 1
        return self.members[c].pop()

    def best(self, tokens: int, segments: int, loss: int) -> int | None:
        """Class of the fitting piece with the largest dot product."""
        k = len(self.members)
        t, b = self.tokens[:k], self.loss[:k]
        at = np.flatnonzero((self.left[:k] > 0) & (t <= tokens) & (b <= loss))
        if not at.size or not segments:
            return None
        w = self.weight
        dot = (w[0] * tokens) * t[at] + w[1] * segments + (w[2] * loss) * b[at]
        top = at[dot == dot.max()]
        return int(top[np.lexsort((top, -t[top]))[0]])

    def longest(self) -> int | None:
        k = len(self.members)
        t = np.where(self.left[:k] > 0, self.tokens[:k], 0)
        return int(t.argmax()) if k and t.max() > 0 else None


def pack_block(pieces: list[Piece], limits: Limits, cut: bool = True) -> tuple[list[list[Piece]], list[Piece]]:
    """(closed sequences, pieces of the last, open one)."""
    done, short = [], []
    for p in pieces:
        while p.length >= limits.tokens:
            full, p = p.split(limits.tokens)
            done.append([full])
        if p.length:
            short.append(p)
    pool = Pool(short, limits)
    while pool.n:
        sequence: list[Piece] = []
        tokens, segments, loss = limits.tokens, limits.segments, limits.loss
        while tokens and segments:
            c = pool.best(tokens, segments, loss)
            if c is not None:
                p = pool.take(c)
            elif cut and tokens >= MIN_CUT and loss >= tokens - 1 and (c := pool.longest()) is not None:
                p, rest = pool.take(c).split(tokens)
                pool.add(rest)
            else:
                break
            sequence.append(p)
            tokens, segments, loss = tokens - p.length, segments - 1, loss - p.loss
        if not pool.n and tokens:
            return done, sequence
        done.append(sequence)
    return done, []


def packed(examples: DataFrame, tokenizer_file: str, limits: Limits, cut: bool = True, prompt: str | None = None,
           block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Pieces with the number of their sequence in its task."""
    before = F.coalesce(F.col(prompt), F.lit("")) if prompt else F.lit("")
    rows = examples.select(F.spark_partition_id().alias("part"), F.col("doc_id").cast("long").alias("doc_id"),
                           F.coalesce("text", F.lit("")).alias("text"), before.alias("prompt"))
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    end = np.array([END_ID], dtype="<u4").tobytes()

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = worker_encoder(tokenizer_file)
        ids: dict[int, memoryview] = {}
        doc_id: dict[int, int | None] = {}
        pool: list[Piece] = []
        part, row, held, sequence = 0, 0, 0, 0

        def rows_of(sequences: list[list[Piece]]) -> Iterator[pa.RecordBatch]:
            nonlocal sequence
            out = []
            for s in sequences:
                offset = 0
                for k, p in enumerate(s):
                    x = ids[p.row]
                    out.append((part, doc_id[p.row], p.start, p.length, zlib.crc32(x[4 * p.start:4 * (p.start + p.length)]), len(x) // 4,
                                sequence, offset, k, p.loss))
                    offset += p.length
                sequence += 1
            if out:
                types = [pa.int32(), *[pa.int64()] * (len(names) - 1)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

        for whole in it:
            for at in range(0, whole.num_rows, 1000):
                b = whole.slice(at, 1000)
                part = b.column("part")[0].as_py()
                texts, fronts = b.column("text").to_pylist(), b.column("prompt").to_pylist()
                heads = enc.encode(fronts) if prompt else [b""] * len(texts)
                for key, head, tail in zip(b.column("doc_id").to_pylist(), heads, enc.encode(texts), strict=True):
                    x = memoryview(head + tail + end)
                    ids[row], doc_id[row] = x, key
                    pool.append(Piece(row, 0, len(x) // 4, len(head) // 4))
                    row, held = row + 1, held + len(x) // 4
                    if held >= block_tokens:
                        done, pool = pack_block(pool, limits, cut)
                        yield from rows_of(done)
                        ids, doc_id = ({p.row: d[p.row] for p in pool} for d in (ids, doc_id))
                        held = sum(p.length for p in pool)
        done, last = pack_block(pool, limits, cut)
        yield from rows_of([*done, last] if last else done)

    return rows.mapInArrow(run, SCHEMA)


def pack(examples: DataFrame, tokenizer_file: str, limits: Limits | None = None, cut: bool = True, prompt: str | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id (gapless from 0), offset, segment, n_loss."""
    pieces = materialize(packed(examples, tokenizer_file, limits or Limits(), cut, prompt), "packed")
    tasks = pieces.groupBy("part").agg((F.max("sequence") + 1).alias("_n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each task
    first = tasks.select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    return pieces.join(broadcast_if_small(first, 1_000_000), "part").select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("_first") + F.col("sequence")).alias("sequence_id"), "offset",
        "segment", "n_loss")


def padding(pieces: DataFrame, tokens: int = 2048) -> DataFrame:
    """One row: sequences, tokens and padding; a sequence is padded to
    ``tokens`` unless its length is a power of two."""
    s = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    full = F.col("n").bitwiseAND(F.col("n") - 1) == 0
    return s.agg(F.count(F.lit(1)).alias("sequences"), F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"),
                 F.coalesce(F.sum(F.when(full, 0).otherwise(tokens - F.col("n"))), F.lit(0)).alias("padding"))
