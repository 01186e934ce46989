"""Toxicity by nearest labelled examples (operator 4).

1. Examples: a bounded sample of labelled training rows (``MAX_EXAMPLES``).
   Their texts become unit TF-IDF vectors over all their words; document
   frequencies count all documents.
2. A block-max inverted index holds the vectors: examples are ordered by
   likeness and cut into blocks of ``BLOCK``; the most frequent words of
   ``GROUP`` blocks, whose lists are long, are dense columns there and keep
   their largest weight in every block, all others are postings by word. A query sums the postings of its words, bounds
   each block's best possible cosine by its largest such sum and the columns'
   maxima, visits blocks from the highest bound down, some at a time, and stops
   when no block left can reach its k-th best. Rows are selected in single
   precision with room for its rounding, their cosines computed in double
   precision: the ``NEIGHBOURS`` nearest examples are exact.
3. Every text's neighbours vote, weighted by inverse cosine distance. Beside
   the vote stand the ``STRONGEST`` largest word scores of the text: how far
   a word's toxic examples exceed chance (hypergeometric z over distinct
   texts). No word is chosen or cut; a logistic regression on the examples'
   leave-one-out votes and word scores turns these into a calibrated score. A
   text equal to examples takes their smoothed rate. Evidence: the nearest toxic
   examples with their cosines.

Every text's words are split, hashed and looked up among the examples' words
once: places and counts go to the shared folder (a packed ``bag``), which the
document frequencies and the scores are read from.

The examples' arrays are broadcast once (bounded by ``MAX_EXAMPLES``); a Python
worker builds the index from them when it first needs it and keeps it for its
later tasks. The driver holds these arrays, no texts and no index; the
leave-one-out search is a Spark job too.

Defined cases: texts that share no word with an example get the examples'
smoothed rate; words of no example only lengthen a
text's vector, as if in no document; 64-bit hashes stand for words; rows
without a label, and held-out rows, are never learnt from; of several labels
of a doc_id the largest counts; repeated rows get equal scores; equal
similarities are ranked by example number; with labels of one kind only, or
none, every score is the smoothed rate; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import islice, pairwise

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm.text import WordHash, drawn, forget, keep
from kestrel.storage import materialize

FOLDS, HELD_OUT_FOLD = 5, 0
MAX_EXAMPLES = 20_000
BLOCK = 64
NEIGHBOURS = 50
STRONGEST = 3
EVIDENCE = 3
CUT = 0.5
#: words kept as dense columns of a group of blocks, the others are postings; blocks of a group
MAX_DENSE, GROUP = 256, 8
#: groups that examples are ordered by, and the words that this goes by
CLUSTERS, MAX_COMMON = 32, 256
#: vectors laid end to end at once, entries whose columns are looked up at once, parts of the vocabulary whose postings are sorted in turn
LAID, ENTRIES, PARTS = 1000, 1 << 19, 8
#: texts searched at once, blocks visited in a query's first turn, growth of the later turns, words counted on at once
BATCH, FIRST_TURN, TURN_GROWTH, CHUNK = 64, 4, 8, 65_536
#: more than rounding can move a single-precision cosine of MAX_DENSE columns; cosines up to TINY count as 0
SLACK, TINY = 2e-5, 1e-12
#: texts whose vectors are held at once
PIECE = 512
#: multiplications up to which a matrix product stays on one thread
ONE_THREAD = 1 << 17
#: scores that a worker remembers by vector
MAX_SCORED = 5_000
#: cosines from here on are those of equal vectors
EQUAL = 1 - 1e-9

_WORD = re.compile(r"[^\W\d_]+")
_LETTERS = bytes(c if c > 127 or chr(c).isalpha() else 32 for c in range(256))
_SINGLE = os.environ.get("OMP_NUM_THREADS") == "1"

Vector = tuple[np.ndarray, np.ndarray]


def fold(doc_id: str = "doc_id", folds: int = FOLDS) -> Column:
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(folds))


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(fold(doc_id) == HELD_OUT_FOLD, F.lit(False))


def training_sample(labels: DataFrame, label: str, train: Column, limit: int) -> DataFrame:
    """(doc_id, y) of about ``limit`` training labels at most, drawn by a hash
    of doc_id (every label, if there are fewer)."""
    y = (labels.where(train & F.col("doc_id").isNotNull() & F.col(label).isNotNull())
         .groupBy("doc_id").agg(F.max(F.col(label)).cast("int").alias("y")))
    y = materialize(y, "train-labels")
    n = y.count()
    sample = y.where(drawn(F.xxhash64("doc_id", F.lit(17)), n, limit))
    if n > limit and sample.isEmpty():
        raise ValueError(f"no training label drawn from {n}")
    return sample


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def _utf8_words(text: str | None) -> list[bytes] | list[str]:
    """``words_of``, as UTF-8 where a byte table can split: every character
    beyond ASCII is a letter."""
    if not text:
        return []
    text = text.lower()
    if text.isascii() or _WORD.fullmatch("".join([c for c in set(text) if c > "\x7f"])):
        return text.encode().translate(_LETTERS).split()
    return _WORD.findall(text)


def distinct_words(text: str | None, known: WordHash) -> np.ndarray:
    """Ascending hashes of the text's distinct words."""
    return np.sort(known.fresh(set(_utf8_words(text))))


def word_counts(text: str | None, known: WordHash) -> tuple[np.ndarray, np.ndarray]:
    """(ascending hashes of the text's distinct words, their counts)."""
    n = Counter(_utf8_words(text))
    h = known.fresh(n)
    by = h.argsort()
    return h[by], np.fromiter(n.values(), dtype=np.int64, count=len(n))[by]


def positions(h: np.ndarray, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which of ``h`` are in the ascending vocabulary, their places there)."""
    at = np.minimum(np.searchsorted(vocabulary, h), max(0, len(vocabulary) - 1))
    here = vocabulary[at] == h if len(vocabulary) else np.zeros(len(h), dtype=bool)
    return here, at[here]


def bag(h: np.ndarray, c: np.ndarray, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """(vocabulary positions of a text's words, their counts, squared length
    of its other words by their counts alone)."""
    here, at = positions(h, vocabulary)
    return at, c[here], float(((1 + np.log(c[~here])) ** 2).sum())


def narrowest(x: np.ndarray) -> np.ndarray:
    """Numbers from 0 on in the smallest integers that hold them."""
    return x.astype(np.min_scalar_type(int(x.max(initial=0))))


def packed(at: np.ndarray, c: np.ndarray, other: float) -> bytes:
    """A ``bag`` as bytes: gaps between positions and counts in the narrowest
    integers that hold them."""
    gaps, c = narrowest(np.diff(at, prepend=0)), narrowest(c)
    return struct.pack("<dBB", other, gaps.itemsize, c.itemsize) + gaps.tobytes() + c.tobytes()


def unpacked(x: bytes) -> tuple[np.ndarray, np.ndarray, float]:
    other, i, j = struct.unpack_from("<dBB", x)
    n = (len(x) - 10) // (i + j)
    return np.cumsum(np.frombuffer(x, f"<u{i}", n, 10), dtype=np.int64), np.frombuffer(x, f"<u{j}", n, 10 + i * n).astype(np.int64), other


class Examples:
    """The bounded example set in plain arrays: doc_id, label, and the words'
    vocabulary positions and counts, example after example."""

    def __init__(self, doc_id: list[int], y: list[int], words: list[np.ndarray], counts: list[np.ndarray]):
        self.doc_id, self.y = np.array(doc_id, dtype=np.int64), np.array(y, dtype=float)
        # some examples at a time: all their hashes, sorted, would be several times the arrays that stay
        self.vocabulary = np.empty(0, np.uint64)
        for at in range(0, len(words), LAID):
            self.vocabulary = np.union1d(self.vocabulary, np.concatenate(words[at:at + LAID]))
        self.word = np.concatenate([np.empty(0, np.int32), *(np.searchsorted(self.vocabulary, h).astype(np.int32) for h in words)])
        self.count = narrowest(np.concatenate([np.empty(0, np.int32), *counts]))
        self.start = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)
        self.idf, self.unseen = np.ones(len(self.vocabulary)), 1.0

    def __len__(self) -> int:
        return len(self.y)

    def weigh(self, n: int, df: np.ndarray) -> None:
        """Inverse document frequencies from those of all n documents."""
        self.idf, self.unseen = np.log((1 + n) / (1 + df)) + 1, float(np.log(1 + n) + 1)

    def vector(self, i: int) -> Vector:
        a, z = self.start[i], self.start[i + 1]
        w = (1 + np.log(self.count[a:z].astype(np.int64))) * self.idf[self.word[a:z]]
        return self.word[a:z], w / np.sqrt((w * w).sum()) if z > a else w

    def query(self, h: np.ndarray, c: np.ndarray) -> Vector:
        """Unit vector of any text over the vocabulary; its other words count
        in its length."""
        return self.unit(*bag(h, c, self.vocabulary))

    def unit(self, at: np.ndarray, c: np.ndarray, other: float) -> Vector:
        """``query`` of a ``bag``."""
        w = (1 + np.log(c)) * self.idf[at]
        length = np.sqrt((w * w).sum() + other * self.unseen ** 2)
        return at, w / length if len(at) else w


def read_examples(examples: DataFrame) -> Examples:
    """Words of every example, a partition at a time in the driver's JVM."""
    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forget()
        known = WordHash()
        for b in it:
            found = [word_counts(t, known) for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"], "y": b["y"], "h": [h.tobytes() for h, _ in found], "c": [c.astype(np.int32).tobytes() for _, c in found]})

    found = examples.select("doc_id", "y", "text").mapInPandas(run, "doc_id long, y int, h binary, c binary")
    rows = sorted((r["doc_id"], r["y"], bytes(r["h"]), bytes(r["c"])) for r in found.toLocalIterator())
    return Examples([r[0] for r in rows], [r[1] for r in rows], [np.frombuffer(r[2], np.uint64) for r in rows], [np.frombuffer(r[3], np.int32) for r in rows])


def bags_of(docs: DataFrame, vocabulary: np.ndarray) -> Column:
    """The packed ``bag`` of each text: words are split and looked up once, for
    the document frequencies and for the scores."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        forget()
        known, words = _worker_words(), shared.value
        for texts in batches:
            yield pd.Series([packed(*bag(*word_counts(t, known), words)) for t in texts], dtype=object)

    return F.pandas_udf(run, "binary")(docs["text"])


def document_frequencies(bags: DataFrame, size: int) -> tuple[int, np.ndarray]:
    """Number of documents, and of those with each of the ``size`` words of the
    vocabulary; counted per task, so a chunk of words is one row a task."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = np.zeros(size + 1, dtype=np.int64)
        for b in batches:
            for x in b["bag"]:
                n[unpacked(x)[0]] += 1
            n[-1] += len(b)
        at = range(0, len(n), CHUNK)
        yield pd.DataFrame({"chunk": [a // CHUNK for a in at], "n": [n[a:a + CHUNK].tobytes() for a in at]})

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(x, np.int64) for x in pdf["n"])
        return pd.DataFrame({"chunk": pdf["chunk"].iloc[:1], "n": [total.tobytes()]})

    schema = "chunk int, n binary"
    rows = bags.select("bag").mapInPandas(run, schema).groupBy("chunk").applyInPandas(add, schema).collect()
    if not rows:
        return 0, np.zeros(size, dtype=np.int64)
    n = np.concatenate([np.frombuffer(r["n"], np.int64) for r in sorted(rows, key=lambda r: r["chunk"])])
    return int(n[-1]), n[:-1]


def like_order(dense: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, centres): an order of the rows that puts like ones beside each
    other: clusters by two turns of k-means on directions, within one by
    closeness to its centre."""
    length = np.sqrt((dense * dense).sum(axis=1))
    unit = dense / np.where(length > 0, length, 1)[:, None]
    centres = unit[np.linspace(0, len(unit) - 1, min(CLUSTERS, len(unit))).astype(int)]
    for _ in range(2):
        near = (unit @ centres.T).argmax(axis=1)
        sums = np.stack([unit[near == c].sum(axis=0) for c in range(len(centres))])
        size = np.sqrt((sums * sums).sum(axis=1))
        centres = np.where(size[:, None] > 0, sums / np.where(size > 0, size, 1)[:, None], centres)
    close = unit @ centres.T
    near = close.argmax(axis=1)
    return np.lexsort((np.arange(len(unit)), -close[np.arange(len(unit)), near], near)), centres


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b.T``; unless the matrix library is held to one thread, as Spark's
    workers are, in slices too small for it to wake further threads, which a
    task has no cores for."""
    if _SINGLE:
        return a @ b.T
    width = max(1, ONE_THREAD // max(1, len(a) * len(b)))
    out = a[:, :width] @ b[:, :width].T
    for at in range(width, a.shape[1], width):
        out += a[:, at:at + width] @ b[:, at:at + width].T
    return out


def most_frequent(word: np.ndarray, n_words: int, most: int) -> np.ndarray:
    counts = np.bincount(word, minlength=n_words)
    return np.argpartition(-counts, most)[:most].copy() if n_words > most else np.arange(n_words)  # no view of the whole order


def laid(vectors: Iterable[Vector]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(words, weights, lengths) of the vectors end to end, ``LAID`` at a time."""
    vectors = iter(vectors)
    while some := list(islice(vectors, LAID)):
        yield np.concatenate([t for t, _ in some]).astype(np.int32), np.concatenate([w for _, w in some]), np.array([len(t) for t, _ in some])


class BlockMaxIndex:
    """Unit vectors (words, weights) as blocks of rows. ``GROUP`` blocks share
    dense columns of the words that are most frequent in them, with each
    column's largest weight in each block; the other words are postings. The
    dense columns lie there twice: in single precision to bound and to select,
    in double precision for the cosines. Built a part at a time where a step
    would need several times the memory of what stays."""

    def __init__(self, vectors: Iterable[Vector], n_words: int):
        word, weight, lengths = map(np.concatenate, zip((np.empty(0, np.int32), np.empty(0), np.empty(0, np.int64)), *laid(vectors), strict=True))
        self.n, self.n_blocks = len(lengths), max(1, -(-len(lengths) // BLOCK))
        row = np.repeat(np.arange(self.n, dtype=np.int32), lengths)
        # rows in an order that puts like ones beside each other
        frequent = most_frequent(word, n_words, MAX_COMMON)
        self.common = np.full(n_words, -1, dtype=np.int16)
        self.common[frequent] = np.arange(len(frequent))
        order, centres = self._order(row, word, weight)
        self.centres = np.ascontiguousarray(centres.T)
        self.number = np.full(self.n_blocks * BLOCK, -1, dtype=np.int64)  # place -> row
        self.number[:self.n] = order
        self.place = np.empty(self.n, dtype=np.int32)
        self.place[order] = np.arange(self.n)
        at = self.place[row]
        del row
        often = self._add_columns(word, weight, at, n_words)
        often = ~often
        word = word[often]
        weight = weight[often]
        at = at[often]
        self._add_postings(word, weight, at, n_words)
        self.visited = self.searched = 0

    def _order(self, row: np.ndarray, word: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not self.n:
            return np.empty(0, dtype=np.int64), np.zeros((1, MAX_COMMON), np.float32)
        column = self.common[word]
        often = column >= 0
        dense = np.zeros((self.n, MAX_COMMON), np.float32)
        dense[row[often], column[often]] = weight[often]
        return like_order(dense)

    def _add_columns(self, word: np.ndarray, weight: np.ndarray, at: np.ndarray, n_words: int) -> np.ndarray:
        """Lays the dense columns; which entries are in them."""
        group, n = (at // (BLOCK * GROUP)).astype(np.int16), -(-self.n_blocks // GROUP)
        frequent = [most_frequent(word[group == g], n_words, MAX_DENSE) for g in range(n)]
        # a word's columns lie together; the words without any share the first line
        used = np.unique(np.concatenate(frequent))
        self.line = np.zeros(n_words, dtype=np.int32)
        self.line[used] = np.arange(1, len(used) + 1)
        self.columns = np.full((len(used) + 1, n), -1, dtype=np.int16)
        for g, words in enumerate(frequent):
            self.columns[self.line[words], g] = np.arange(len(words))
        often = np.empty(len(word), dtype=bool)
        self.dense = np.zeros((self.n_blocks * BLOCK, MAX_DENSE))
        for a in range(0, len(word), ENTRIES):
            here = slice(a, a + ENTRIES)
            column = self.columns[self.line[word[here]], group[here]]
            often[here] = some = column >= 0
            self.dense[at[here][some], column[some]] = weight[here][some]
        self.rough = self.dense.astype(np.float32).reshape(self.n_blocks, BLOCK, MAX_DENSE)
        self.rough_max = self.rough.max(axis=1)
        return often

    def _add_postings(self, word: np.ndarray, weight: np.ndarray, at: np.ndarray, n_words: int) -> None:
        """Lays the postings, by word, then place."""
        self.postings_of = np.concatenate([[0], np.cumsum(np.bincount(word, minlength=n_words))])
        self.weight, self.at = np.empty(len(word)), np.empty(len(word), np.int32)
        edges = np.searchsorted(self.postings_of, np.linspace(0, len(word), PARTS + 1)).tolist()
        for a, z in pairwise([0, *edges[1:-1], n_words]):
            some = np.flatnonzero((word >= a) & (word < z))
            some = some[np.lexsort((at[some], word[some]))]
            here = slice(self.postings_of[a], self.postings_of[z])
            self.weight[here], self.at[here] = weight[some], at[some]

    def nearest(self, queries: list[Vector], k: int, but: list[int] | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        """(rows, cosines) of the k nearest of each query with a cosine above
        0, by falling cosine, then row; without row ``but[i]`` for query i."""
        # like queries visit the same blocks: they are searched together
        by = np.argsort([self._cluster(q) for q in queries], kind="stable").tolist()
        out: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0, np.int64), np.empty(0))] * len(queries)
        for a in range(0, len(by), BATCH):
            some = by[a:a + BATCH]
            found = self._some([queries[i] for i in some], k, None if but is None else [but[i] for i in some])
            for i, f in zip(some, found, strict=True):
                out[i] = f
        return out

    def _cluster(self, query: Vector) -> int:
        """The nearest of the groups that the examples are ordered by."""
        column = self.common[query[0]]
        often = column >= 0
        return int((query[1][often] @ self.centres[column[often]]).argmax())

    def _rare(self, word: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """What the words' postings add to the cosine, by place."""
        first = self.postings_of[word]
        size = self.postings_of[word + 1] - first
        p = np.repeat(first - np.cumsum(size) + size, size)
        p += np.arange(len(p))
        w = np.repeat(weight, size)
        w *= self.weight[p]
        return np.bincount(self.at[p], w, self.n_blocks * BLOCK)

    def _some(self, queries: list[Vector], k: int, but: list[int] | None) -> list[tuple[np.ndarray, np.ndarray]]:
        m, blocks = len(queries), self.n_blocks
        q, rare = np.zeros((self.columns.shape[1], m, MAX_DENSE)), np.empty((m, blocks * BLOCK))
        for i, (word, weight) in enumerate(queries):
            line = self.line[word]
            often = np.flatnonzero(line)
            column = self.columns[line[often]]
            j, group = np.nonzero(column >= 0)
            q[group, i, column[j, group]] = weight[often[j]]
            rare[i] = self._rare(word, weight)
        rough_q, rough_rare = q.astype(np.float32), rare.astype(np.float32).reshape(m, blocks, BLOCK)
        bound = np.concatenate([product(rough_q[g], self.rough_max[g * GROUP:(g + 1) * GROUP]) for g in range(len(q))], axis=1)
        bound = (bound + rough_rare.max(axis=2)) * (1 + SLACK) + SLACK
        order = np.argsort(-bound, axis=1, kind="stable")
        bound = np.take_along_axis(bound, order, axis=1)
        rough = np.full((m, blocks, BLOCK), -1, dtype=np.float32)  # cosines with the rows of the blocks visited
        flat = rough.reshape(m, -1)
        own = np.array([(i, self.place[r]) for i, r in enumerate(but or []) if r >= 0], dtype=np.int64).reshape(-1, 2).T
        # below this a row is not among the k nearest, however the sums round
        least = np.zeros(m)
        done, turn = 0, FIRST_TURN
        while done < blocks:
            go = bound[:, done:done + turn] >= np.maximum(least, TINY)[:, None]
            if not go.any():
                break
            who, block = np.nonzero(go)
            self._visit(rough_q, rough_rare, rough, who, order[who, done + block])
            flat[own[0], own[1]] = -1
            done, turn = done + turn, turn * TURN_GROWTH
            for i in range(m if done < blocks else 0):
                seen = rough[i, order[i, :done]].ravel()
                if len(seen) > k:
                    least[i] = max(least[i], np.partition(seen, -k)[-k] - 2 * SLACK)
        if blocks > k:  # the k best blocks hold k rows
            least = np.maximum(least, np.partition(rough.max(axis=2), -k, axis=1)[:, -k] - 2 * SLACK)
        self.searched += m
        return [self._best(flat[i], least[i], rare[i], q[:, i], k) for i in range(m)]

    def _visit(self, q: np.ndarray, rare: np.ndarray, rough: np.ndarray, who: np.ndarray, block: np.ndarray) -> None:
        """Rough cosines of pairs of a query and a block, block by block."""
        by = np.argsort(block, kind="stable")
        who, block = who[by], block[by]
        self.visited += len(who)
        edges = np.flatnonzero(np.diff(block, prepend=-1, append=-1))
        for a, z in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            some, b = who[a:z], int(block[a])
            rough[some, b] = product(q[b // GROUP, some], self.rough[b]) + rare[some, b]

    def _best(self, rough: np.ndarray, least: float, rare: np.ndarray, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k nearest by exact cosines of the rows that can be among them."""
        at = np.flatnonzero((rough > 0) & (rough >= least))
        if len(at) > k:
            near = rough[at]
            at = at[near >= np.partition(near, -k)[-k] - 2 * SLACK]
        rows, sims = self.number[at], rare[at] + (self.dense[at] * q[at // (BLOCK * GROUP)]).sum(axis=1)
        by = np.lexsort((rows, -np.round(sims, 9)))[:k]
        by = by[sims[by] > TINY]
        return rows[by], sims[by]


def vote(y: np.ndarray, sims: np.ndarray) -> float:
    votes = 1 / (1.05 - np.minimum(sims, 1))
    return float((votes * y).sum() / votes.sum())


class WordScores:
    """How far each word's toxic examples exceed chance, over distinct
    (label, text)."""

    def __init__(self, examples: Examples):
        seen, size = set(), len(examples.vocabulary)
        self.toxic, self.clean, self.n = np.zeros(size), np.zeros(size), [0, 0]
        for i in range(len(examples)):
            a, z = examples.start[i], examples.start[i + 1]
            key = examples.y[i], xxhash.xxh3_128_digest(examples.word[a:z].tobytes() + examples.count[a:z].tobytes())
            if key not in seen:
                seen.add(key)
                (self.toxic if examples.y[i] else self.clean)[examples.word[a:z]] += 1
                self.n[int(examples.y[i])] += 1

    def strongest(self, words: np.ndarray, own: float | None = None) -> list[float]:
        """The largest scores among the words; without the text itself, if it
        is an example of label ``own``."""
        toxic, clean, (n0, n1) = self.toxic[words], self.clean[words], self.n
        if own is not None:
            toxic, clean, n0, n1 = toxic - own, clean - (1 - own), n0 - (1 - own), n1 - own
        df, n = toxic + clean, n0 + n1
        share = n1 / n if n else 0.0
        var = df * share * (1 - share) * (n - df) / max(n - 1, 1)
        z = np.where(var > 0, (toxic - df * share - 0.5) / np.sqrt(np.where(var > 0, var, 1)), 0)
        top = np.sort(np.append(z, np.zeros(STRONGEST)))[::-1][:STRONGEST]
        return top.tolist()


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(centre, scale, weights) of a ridge logistic regression by Newton's
    steps; the first weight is the intercept."""
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([np.ones(len(x)), (x - centre) / scale])
    ridge = np.diag([1e-6, *np.ones(x.shape[1])])
    w = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge, z.T @ (p - y) + ridge @ w)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return centre, scale, w


class _Searcher:
    """What a Python worker builds from the broadcast examples."""

    def __init__(self, examples: Examples):
        self.examples = examples
        self.index = BlockMaxIndex(map(examples.vector, range(len(examples))), len(examples.vocabulary))
        self.words = WordScores(examples)
        self.scored: dict[bytes, tuple[float, list[dict]]] = {}

    def features(self, queries: list[Vector], but: list[int] | None = None) -> Iterator[tuple[list[float], np.ndarray, np.ndarray]]:
        """([vote, word scores], neighbours, cosines) of each query, the vote
        NaN without any neighbour; with ``but`` each is an example that leaves
        itself and its copies out."""
        y = self.examples.y
        found = self.index.nearest(queries, NEIGHBOURS, but)
        for i, ((words, _), (rows, sims)) in enumerate(zip(queries, found, strict=True)):
            voters = sims < EQUAL if but is not None else np.ones(len(sims), dtype=bool)
            v = vote(y[rows[voters]], sims[voters]) if voters.any() else float("nan")
            yield [v, *self.words.strongest(words, None if but is None else y[but[i]])], rows, sims


_words: dict[str, WordHash] = {}


def _searcher(name: str, shared) -> _Searcher:
    """The searcher of one fit; a worker keeps the last one, until another
    operator's tasks begin."""
    return keep("toxicity", name, lambda: _Searcher(shared.value))


def _worker_words() -> WordHash:
    return _words.setdefault("", WordHash())


class ToxicityModel:
    """A broadcast example set and the regression on its votes."""

    def __init__(self, spark: SparkSession, examples: Examples):
        self.name, self.shared = uuid.uuid4().hex, spark.sparkContext.broadcast(examples)
        n, toxic = len(examples), float(examples.y.sum())
        self.rate = (toxic + 0.5) / (n + 5)
        self.steps = self._calibrate(spark, n, examples.y) if 0 < toxic < n else None

    def __getstate__(self) -> dict:
        return {"name": self.name, "shared": self.shared, "rate": self.rate, "steps": self.steps}

    def _calibrate(self, spark: SparkSession, n: int, y: np.ndarray):
        name, shared = self.name, self.shared

        def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            s = _searcher(name, shared)
            for b in it:
                own = b["id"].tolist()
                yield pd.DataFrame({"id": own, "x": [x for x, _, _ in s.features([s.examples.vector(i) for i in own], own)]})

        parts = max(1, min(n // 200, 2 * spark.sparkContext.defaultParallelism))
        rows = spark.range(0, n, 1, parts).mapInPandas(run, "id long, x array<double>").collect()  # one row an example
        x = np.empty((n, 1 + STRONGEST))
        for r in rows:
            x[r["id"]] = r["x"]
        voted = ~np.isnan(x[:, 0])
        return logistic(x[voted], y[voted]) if voted.any() else None

    def scores(self, bags: pd.Series) -> list[tuple[float, list[dict]]]:
        """Score and evidence of the text of each packed ``bag``."""
        if self.steps is None:
            return [(self.rate, [])] * len(bags)
        return [x for at in range(0, len(bags), PIECE) for x in self._piece(bags.iloc[at:at + PIECE])]

    def _piece(self, bags: pd.Series) -> list[tuple[float, list[dict]]]:
        s = _searcher(self.name, self.shared)
        centre, scale, w = self.steps
        e = s.examples
        queries = [e.unit(*unpacked(x)) for x in bags]
        keys = [xxhash.xxh3_128_digest(w.tobytes() + x.tobytes()) for w, x in queries]
        # copies of a text, in this batch or an earlier one, are scored once
        new = {key: q for key, q in zip(keys, queries, strict=True) if key not in s.scored}
        if len(s.scored) > MAX_SCORED:
            s.scored.clear()
            new = dict(zip(keys, queries, strict=True))
        for key, (x, rows, sims) in zip(new, s.features(list(new.values())), strict=True):
            same = sims >= EQUAL
            if not len(rows):
                score = self.rate
            elif same.any():
                score = float((e.y[rows[same]].sum() + 0.1) / (same.sum() + 0.2))
            else:
                score = float(1 / (1 + np.exp(-np.clip(w[0] + ((np.array(x) - centre) / scale) @ w[1:], -30, 30))))
            toxic = np.flatnonzero(e.y[rows])[:EVIDENCE]
            s.scored[key] = (score, [{"doc_id": int(e.doc_id[rows[k]]), "label": 1, "similarity": round(float(sims[k]), 6)} for k in toxic])
        return [s.scored[key] for key in keys]


def fit(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    return _fit(docs, labels, "doc_id")[0]


def _fit(docs: DataFrame, labels: DataFrame, *columns: str | Column) -> tuple[ToxicityModel, DataFrame]:
    """(model, ``columns`` and the ``bag`` of every document)."""
    sample = materialize(training_sample(labels, "toxic", ~held_out(), MAX_EXAMPLES), "toxic-sample")
    picked = F.broadcast(sample)  # at most about MAX_EXAMPLES rows
    examples = read_examples(materialize(docs.select("doc_id", "text").join(picked, "doc_id"), "toxic-examples"))
    bags = materialize(docs.select(*columns, bags_of(docs, examples.vocabulary).alias("bag")), "toxic-bags")
    if len(examples):
        examples.weigh(*document_frequencies(bags, len(examples.vocabulary)))
    return ToxicityModel(docs.sparkSession, examples), bags


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted, evidence) of every document."""
    model, bags = _fit(docs, labels, "doc_id")

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for some in batches:
            out = model.scores(some)
            yield pd.DataFrame({"score": [x[0] for x in out], "evidence": [x[1] for x in out]})

    scorer = F.pandas_udf(run, "score double, evidence array<struct<doc_id: long, label: int, similarity: double>>")
    s = bags.select("doc_id", scorer(F.col("bag")).alias("s"))
    return s.select("doc_id", held_out().alias("held_out"), "s.score", (F.col("s.score") >= CUT).cast("int").alias("predicted"), "s.evidence")


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not predicted toxic, columns unchanged."""
    model, bags = _fit(docs, labels, F.struct("*").alias("doc"))

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for some in batches:
            yield pd.Series([x[0] for x in model.scores(some)], dtype=float)

    return bags.where(F.pandas_udf(run, "double")(F.col("bag")) < CUT).select("doc.*")
