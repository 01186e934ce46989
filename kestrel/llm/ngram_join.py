"""Similarity join on word 5-grams: Jaccard >= 0.8 by MinHash banding
(operator 6).

1. Texts with the same words collapse to one representative by a 128-bit key.
2. Every text gets MinHash values of its 5-gram set (a text of fewer words is
   one gram); the number of rows a band and of bands follows from the
   threshold and the target recall (``choose_bands``).
3. Band hashes are shuffled; each member of a shared bucket is linked to the
   bucket's smallest key - a star, never its pairs - and the connected
   components of these candidate links are the candidate groups.
4. Candidate groups are verified on the full 5-gram sets. Small groups are
   packed together into tasks; a larger group is cut into blocks and each pair
   of blocks is a task of bounded size, so a group of any size is spread over
   the cluster. A task counts links and reports, per text, its number of links
   and one root; pairs never become rows.
5. Components of the verified links are the classes.

Result: one row per document: class_id, the smallest doc_id of its class, and
n_links, the number of other documents with a similarity of at least 0.8
(copies included). All pairs that share a band are verified, and so are all
other pairs of the candidate group.

Defined cases: texts without a word have no link and are their own class
(class_id = doc_id); repeated rows are copies; a null doc_id counts as a copy
but never names a class unless the whole class has none; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.components import connected_components, join_groups
from kestrel.llm.text import WordHash, forget, mix, split_words, words_key
from kestrel.storage import broadcast_if_small, materialize

GRAM = 5
THRESHOLD = 0.8
TARGET_RECALL = 0.999
MAX_HASHES = 256
#: texts in one block; a task compares two blocks at most
BLOCK = 256
MAX_BROADCAST_ROWS = 50_000


def choose_bands(threshold: float, recall: float, max_hashes: int) -> tuple[int, int]:
    """(bands, rows): the most selective banding (largest rows) that finds a
    pair at ``threshold`` with probability ``recall`` within ``max_hashes``."""
    best = None
    for rows in range(1, max_hashes + 1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold ** rows)) if threshold < 1 else 1
        if bands * rows > max_hashes:
            break
        best = bands, rows
    if best is None:
        raise ValueError(f"recall {recall} needs more than {max_hashes} hashes")
    return best


def gram_hashes(words: list[str], known: WordHash) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's 5-grams (of all its words,
    if fewer)."""
    h = known.array(words)
    size = min(GRAM, len(h))
    n = len(h) - size + 1
    g = np.full(n, size, dtype=np.uint64)
    for k in range(size):
        g = mix(g ^ h[k:k + n]) + np.uint64(k)
    return np.unique(g)


def _signatures(texts: list[str], known: WordHash, bands: int, rows: int) -> np.ndarray:
    """Band hashes (texts x bands, int64). Every text has a word."""
    grams = [gram_hashes(split_words(t), known) for t in texts]
    flat = np.concatenate(grams)
    starts = np.concatenate([[0], np.cumsum([len(g) for g in grams])[:-1]])
    odd = mix(np.arange(1, bands * rows + 1, dtype=np.uint64)) | np.uint64(1)
    out = np.empty((len(texts), bands), dtype=np.uint64)
    for b in range(bands):
        acc = np.full(len(texts), b + 1, dtype=np.uint64)
        for r in range(rows):
            acc = mix(acc ^ np.minimum.reduceat(flat * odd[b * rows + r], starts))
        out[:, b] = acc
    return out.view(np.int64)


def band_table(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    """(doc_id, key, bands) of every document with a word; key is its word
    sequence's 128-bit hash."""
    def sign(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forget()
        known = WordHash()
        for whole in it:
            for at in range(0, len(whole), 250):
                b = whole.iloc[at:at + 250]
                s = _signatures(b["text"].tolist(), known, bands, rows)
                yield pd.DataFrame({"doc_id": b["doc_id"].to_numpy(), "key": b["key"].to_numpy(), "bands": list(s)})

    keyed = docs.select(F.col("doc_id").cast("string").alias("doc_id"), words_key(F.col("text")).alias("key"), "text").where("key IS NOT NULL")
    out = keyed.mapInPandas(sign, "doc_id string, key string, bands array<long>")
    return out.select(F.col("doc_id").cast("long").alias("doc_id"), "key", "bands")


def candidate_groups(reps: DataFrame) -> DataFrame:
    """(key, grp) of the representatives that share a bucket with another."""
    rows = reps.select("key", F.explode("bands").alias("bucket"))
    shared = materialize(rows.groupBy("bucket").agg(F.min("key").alias("least"), F.max("key").alias("most"))
                         .where("least <> most").select("bucket", "least"), "buckets")
    star = rows.join(shared, "bucket").where("key <> least").select(F.col("key").alias("a"), F.col("least").alias("b"))
    cc = connected_components(star)
    return materialize(cc.select(F.col("node").alias("key"), F.col("root").alias("grp")), "candidate-groups")


def _links(left: list[np.ndarray], right: list[np.ndarray], same: bool, threshold: float) -> Iterator[tuple[int, np.ndarray]]:
    """For each text of ``left`` the indexes of the linked texts of ``right``
    (after it, if both sides are the same block)."""
    flat = np.concatenate(right)
    values, where = np.unique(flat, return_inverse=True)
    sizes = np.array([len(x) for x in right])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    mark = np.zeros(len(values), dtype=np.int32)
    for i, a in enumerate(left):
        at = np.searchsorted(values, a)
        a_in, at = a[at < len(values)], at[at < len(values)]
        at = at[values[at] == a_in]
        mark[at] = 1
        common = np.add.reduceat(mark[where], starts)
        mark[at] = 0
        linked = common >= threshold * (len(a) + sizes - common) - 1e-9
        if same:
            linked[:i + 1] = False
        yield i, np.flatnonzero(linked)


def _verify(pdf: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Links inside one task: rows of whole small groups, or of a pair of
    blocks of one large group."""
    keys, copies = pdf["key"].tolist(), pdf["copies"].to_numpy()
    sets = [np.frombuffer(x, dtype=np.uint64) for x in pdf["grams"]]
    links, parent = np.zeros(len(keys), dtype=np.int64), list(range(len(keys)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for idx in pdf.groupby("grp", sort=False).indices.values():
        side = pdf["side"].to_numpy()[idx]
        sides = [idx[side == s] for s in (0, 1)]
        same = len(sides[1]) == 0
        a, b = sides[0], sides[0] if same else sides[1]
        if len(a) == 0 or (same and len(a) < 2):
            continue
        for i, found in _links([sets[k] for k in a], [sets[k] for k in b], same, threshold):
            x = a[i]
            for y in b[found]:
                links[x] += copies[y]
                links[y] += copies[x]
                p, q = find(x), find(y)
                if p != q:
                    parent[max(p, q, key=keys.__getitem__)] = min(p, q, key=keys.__getitem__)
    hit = np.flatnonzero(links)
    # text also where the task has no link: an empty list would be a column of numbers, which Spark does not take as text
    text = {"key": [keys[i] for i in hit], "root": [keys[find(i)] for i in hit]}
    return pd.DataFrame({**{c: pd.Series(v, dtype=object) for c, v in text.items()}, "links": links[hit]})


def verified(docs: DataFrame, reps: DataFrame, groups: DataFrame, threshold: float) -> DataFrame:
    """(key, root, links) by task; root links the key to its task's class."""
    sizes = groups.groupBy("grp").agg(F.count(F.lit(1)).alias("size"))
    total = groups.count()
    packs = max(1, math.ceil(total / BLOCK))
    sizes = broadcast_if_small(materialize(sizes, "group-sizes"), MAX_BROADCAST_ROWS)
    members = materialize(groups.join(sizes, "grp").join(reps.select("key", "doc_id", "copies"), "key"), "members")

    known = docs.select("doc_id", words_key(F.col("text")).alias("key"), "text").alias("d")
    m = broadcast_if_small(members, MAX_BROADCAST_ROWS).alias("m")
    texts = known.join(m, (F.col("d.key") == F.col("m.key")) & F.col("d.doc_id").eqNullSafe(F.col("m.doc_id")))
    texts = texts.select("d.key", "grp", "size", "copies", "text")

    def grams(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forget()
        known = WordHash()
        for b in it:
            b["grams"] = [gram_hashes(split_words(t), known).tobytes() for t in b.pop("text")]
            yield b

    sets = texts.mapInPandas(grams, "key string, grp string, size long, copies long, grams binary")
    sets = sets.groupBy("key", "grp", "size", "copies").agg(F.first("grams").alias("grams"))  # repeated rows

    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("key"), blocks).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    spread = (sets.withColumn("blocks", blocks).withColumn("mine", mine).withColumn("other", other)
              .withColumn("lo", F.least("mine", "other")).withColumn("hi", F.greatest("mine", "other"))
              .withColumn("side", (F.col("mine") > F.col("other")).cast("int"))
              .withColumn("task", F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("grp"), F.lit(packs)).cast("string"))
                          .otherwise(F.concat_ws("/", "grp", "lo", "hi"))))
    return (spread.select("task", "key", "grp", "copies", "side", "grams").groupBy("task")
            .applyInPandas(lambda pdf: _verify(pdf, threshold), "key string, root string, links long"))


def similar_documents(docs: DataFrame, threshold: float = THRESHOLD, recall: float = TARGET_RECALL) -> DataFrame:
    """(doc_id, key, root, class_id, n_links) of every document; root, the
    least key of its class, tells classes apart even where doc_ids repeat."""
    bands, rows = choose_bands(threshold, recall, MAX_HASHES)
    signed = materialize(band_table(docs, bands, rows), "bands")
    reps = materialize(signed.groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"),
                                                 F.first("bands").alias("bands")), "representatives")
    groups = candidate_groups(reps)
    found = materialize(verified(docs, reps, groups, threshold), "links")
    links = found.groupBy("key").agg(F.sum("links").alias("links"))
    roots = connected_components(found.select(F.col("key").alias("a"), F.col("root").alias("b")))
    named = materialize(roots.join(reps.select(F.col("key").alias("node"), "doc_id"), "node")
                        .groupBy("root").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("_n")), "class-names")
    linked = materialize(join_groups(roots, named, "root").select(F.col("node").alias("key"), "root", "class_id").join(links, "key"), "classes")
    per_key = materialize(reps.select("key", "doc_id", "copies").join(linked, "key", "left").select(
        "key", F.coalesce("root", "key").alias("root"), F.coalesce("class_id", "doc_id").alias("class_id"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "per-key")

    base = docs.select("doc_id", words_key(F.col("text")).alias("key"))
    return base.join(per_key, "key", "left").select(
        "doc_id", "key", "root", F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))


def keep_one_of_each(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one document of each class and all texts without words;
    columns unchanged. Of a class the smallest doc_id stays (nulls last, then
    the least key); classes are told apart by their root, so unlike texts
    under one doc_id both stay. Of rows that repeat both doc_id and text, the
    one with the least other columns stays."""
    s = materialize(similar_documents(docs, threshold).where(F.col("key").isNotNull()).select("doc_id", "key", "root"), "similar")
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc"), F.col("key").alias("least"))
    classes = materialize(s.groupBy("root").agg(F.count(F.lit(1)).alias("_n"), F.min(order).alias("first")).where("_n > 1"), "larger-classes")
    stays = F.col("doc_id").eqNullSafe(F.col("first.doc")) & (F.col("key") == F.col("first.least"))
    gone = join_groups(s, classes, "root").where(~stays).select("doc_id", "key").distinct()
    gone = materialize(gone.select(F.col("doc_id").alias("gone_doc"), F.col("key").alias("gone_key")), "gone")
    gone = broadcast_if_small(gone, MAX_BROADCAST_ROWS)
    on = docs["doc_id"].eqNullSafe(gone["gone_doc"]) & (words_key(docs["text"]) == gone["gone_key"])
    left = docs.join(gone, on, "left_anti")
    twice = s.groupBy("doc_id", "key").count().where("count > 1")
    if twice.isEmpty():
        return left
    # the very same row more than once: only these are brought together
    twice = broadcast_if_small(materialize(twice.select(F.col("doc_id").alias("twice_doc"), F.col("key").alias("twice_key")), "twice"), MAX_BROADCAST_ROWS)
    on = left["doc_id"].eqNullSafe(twice["twice_doc"]) & (words_key(left["text"]) == twice["twice_key"])
    repeated = left.join(twice, on, "left_semi")
    once = repeated.groupBy(repeated["doc_id"], words_key(repeated["text"]).alias("once_key")).agg(
        F.min(F.struct(*[repeated[c] for c in docs.columns])).alias("once_row"))
    return left.join(twice, on, "left_anti").unionByName(once.select("once_row.*"))
