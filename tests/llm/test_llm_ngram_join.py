import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from edge_data import SCHEMA, corpus, edge_rows, frame
from kestrel.llm import ngram_join as j
from kestrel.llm.components import connected_components, join_groups

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, threshold=0.8):
    sets = []
    for _, t, *_ in rows:
        w = WORD.findall(t or "")
        n = min(5, len(w))
        sets.append({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if n else set())
    links = [[k for k, b in enumerate(sets) if k != i and a and b and len(a & b) >= threshold * len(a | b)] for i, a in enumerate(sets)]
    cls = list(range(len(rows)))
    for _ in rows:
        cls = [min([cls[i], *(cls[k] for k in links[i])]) for i in range(len(rows))]
    ids = {}
    for i, c in enumerate(cls):
        if rows[i][0] is not None:
            ids[c] = min(ids.get(c, rows[i][0]), rows[i][0])
    return [(r[0], ids.get(cls[i]), len(links[i])) for i, r in enumerate(rows)]


def _sorted(x):
    return sorted(map(tuple, x), key=str)


def test_classes_and_links_match_brute_force(spark):
    got = j.similar_documents(frame(spark)).select("doc_id", "class_id", "n_links").collect()
    assert _sorted(got) == _sorted(brute(edge_rows()))


def test_large_group_is_cut_into_blocks(spark, monkeypatch):
    """A chain of drifting near copies, more than one block of them."""
    monkeypatch.setattr(j, "BLOCK", 8)
    words = corpus(1, 9)[0].split() + [f"t{i}" for i in range(300)]
    rows = []
    for i in range(45):
        words = list(words)
        words[(i * 7) % len(words)] = f"new{i}"
        rows.append((i, " ".join(words), *edge_rows()[0][2:]))
    got = j.similar_documents(spark.createDataFrame(rows, SCHEMA)).select("doc_id", "class_id", "n_links").collect()
    want = brute(rows)
    assert max(w[2] for w in want) > 12
    assert _sorted(got) == _sorted(want)


def test_task_without_any_link(spark, monkeypatch):
    """Unlike texts of one candidate group: no pair of blocks has a link."""
    monkeypatch.setattr(j, "BLOCK", 2)
    rows = [(i, " ".join(f"w{i}-{x}" for x in range(30)), *edge_rows()[0][2:]) for i in range(9)]
    docs = spark.createDataFrame(rows, SCHEMA)
    reps = j.band_table(docs, 2, 2).withColumn("copies", F.lit(1).cast("long"))
    assert j.verified(docs, reps, reps.select("key", F.lit("g").alias("grp")), 0.8).count() == 0


def test_empty_table(spark):
    assert j.similar_documents(frame(spark, [])).count() == 0


def test_one_document_of_each_class_stays(spark):
    docs = frame(spark)
    got = j.keep_one_of_each(docs)
    assert got.columns == docs.columns
    want = {(d, c) for d, c, _ in brute(edge_rows())}
    kept = [r.doc_id for r in got.collect()]
    no_words = [r for r in edge_rows() if not WORD.search(r[1] or "")]
    named = {c for (d, c), r in zip([(x[0], x[1]) for x in brute(edge_rows())], edge_rows()) if WORD.search(r[1] or "")}
    # 108 names two classes: unlike texts under one doc_id
    assert len(kept) == len(named) + 1 + len(no_words)
    assert {k for k in kept if k is not None} >= {c for _, c in want if c is not None}


def test_banding_reaches_the_target():
    for t, recall in ((0.8, 0.999), (0.7, 0.99), (0.9, 0.9999)):
        b, r = j.choose_bands(t, recall, 256)
        assert b * r <= 256 and 1 - (1 - t ** r) ** b >= recall
    with pytest.raises(ValueError):
        j.choose_bands(0.1, 0.9999, 16)


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 50), (50, 70), (200, 200)] + [(300, k) for k in range(301, 340)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {i: 0 for i in range(31)} | {50: 50, 70: 50, 100: 50} | {k: 300 for k in range(300, 340)}


def test_links_between_two_blocks_just_below_the_threshold():
    """79 common of 99 grams; several grams of a alone fall into one gap of b."""
    step = np.uint64(10 ** 15)
    common, b_only = np.arange(1, 80, dtype=np.uint64) * step, np.arange(101, 110, dtype=np.uint64) * step
    a = np.sort(np.concatenate([common, b_only[4] - np.arange(1, 12, dtype=np.uint64)]))
    b = np.sort(np.concatenate([common, b_only]))
    assert [f.tolist() for _, f in j._links([a], [b], False, 0.8)] == [[]]
    assert [f.tolist() for _, f in j._links([a], [b], False, 0.79)] == [[0]]


def test_unlike_texts_under_one_doc_id_both_stay(spark):
    r = random.Random(8)
    texts = [" ".join(f"{x}{r.randrange(10**6)}" for _ in range(40)) for x in "abc"]
    rest = edge_rows()[0][2:]
    rows = [(5, texts[0], *rest), (5, texts[1], *rest), (6, texts[2], *rest), (7, texts[2], *rest), (None, texts[1], *rest)]
    got = j.keep_one_of_each(frame(spark, rows)).collect()
    assert sorted((r.doc_id, r.text) for r in got) == sorted([(5, texts[0]), (5, texts[1]), (6, texts[2])])


def test_large_groups_are_joined_apart(spark):
    rows = spark.range(5000).selectExpr("CASE WHEN id < 4000 THEN 0 ELSE id END AS root", "id AS node")
    groups = rows.groupBy("root").agg(F.count(F.lit(1)).alias("_n"), F.max("node").alias("most"))
    got = join_groups(rows, groups, "root").collect()
    assert sorted((r.node, r.most) for r in got) == [(i, 3999 if i < 4000 else i) for i in range(5000)]
