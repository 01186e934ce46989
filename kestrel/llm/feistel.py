"""Reproducible shuffle into shards by a Feistel permutation (operator 7).

Rows get global numbers 0..N-1 in (doc_id, text) order. A balanced Feistel
network on 2k bits (smallest 4^k >= N) with cycle walking permutes 0..N-1;
the permuted number p fixes shard = p mod shards and slot = p div shards, so
shard sizes differ by at most one row (law ``rows``) and slots are gapless.
``place`` and ``row_at`` compute either direction without any data.

Defined cases: a null text has size 8 and crc32 0; a null doc_id sorts
first; rows equal in doc_id and text are interchangeable and get consecutive
numbers; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.text import mix
from kestrel.operators.ordered import global_row_number

ROUNDS = 6
DEFAULT_KEY = 0x5EED


class Permutation:
    """Permutation of 0..n-1; the same (n, key) is the same permutation."""

    def __init__(self, n: int, key: int = DEFAULT_KEY):
        self.n = n
        self.half = max(1, ((max(n, 1) - 1).bit_length() + 1) // 2)
        self.keys = mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ np.uint64(key))

    def _once(self, x: np.ndarray, keys: np.ndarray) -> np.ndarray:
        h, mask = np.uint64(self.half), np.uint64((1 << self.half) - 1)
        left, right = x >> h, x & mask
        for k in keys:
            left, right = right, left ^ (mix(right ^ k) & mask)
        return (right << h) | left  # halves swapped back, so reversed keys invert

    def _walk(self, x: np.ndarray, keys: np.ndarray) -> np.ndarray:
        out = self._once(np.asarray(x, dtype=np.uint64), keys)
        out_of_range = np.flatnonzero(out >= self.n)
        while out_of_range.size:
            out[out_of_range] = self._once(out[out_of_range], keys)
            out_of_range = out_of_range[out[out_of_range] >= self.n]
        return out.astype(np.int64)

    def forward(self, x) -> np.ndarray:
        return self._walk(x, self.keys)

    def inverse(self, x) -> np.ndarray:
        return self._walk(x, self.keys[::-1])


def place(row: int, n: int, shards: int, key: int = DEFAULT_KEY) -> tuple[int, int]:
    """(shard, slot) of a global row number."""
    p = int(Permutation(n, key).forward(np.array([row]))[0])
    return p % shards, p // shards


def row_at(shard: int, slot: int, n: int, shards: int, key: int = DEFAULT_KEY) -> int:
    """Global row number stored at (shard, slot)."""
    return int(Permutation(n, key).inverse(np.array([slot * shards + shard]))[0])


def shard_documents(docs: DataFrame, shards: int, key: int = DEFAULT_KEY) -> DataFrame:
    """Shard and slot of every document; the text itself is not shuffled."""
    base = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).cast("long").alias("text_crc32"))
    numbered = global_row_number(base, "doc_id", "text_crc32", "size")
    n = numbered.count()

    def permute(it: Iterator[pd.Series]) -> Iterator[pd.Series]:
        perm = Permutation(n, key)
        for rows in it:
            yield pd.Series(perm.forward(rows.to_numpy()))

    p = F.pandas_udf(permute, "long")(F.col("row"))
    return (numbered.withColumn("_p", p)
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
                    F.pmod(F.col("_p"), F.lit(shards)).cast("int").alias("shard"),
                    F.expr(f"_p div {shards}").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard"),
                    "row"))
