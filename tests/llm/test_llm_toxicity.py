import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from edge_data import SCHEMA, edge_rows, frame
from kestrel.llm import toxicity as t
from kestrel.llm.text import drawn

LABELS = "doc_id long, quality int, toxic int, terms string"


def _unit(r, n, vocab, size):
    out = []
    for _ in range(n):
        terms = np.sort(r.choice(vocab, min(vocab, int(r.integers(1, size))), replace=False, p=_zipf(vocab)))
        w = r.random(len(terms))
        out.append((terms, w / np.linalg.norm(w)))
    return out


def _zipf(n):
    p = 1 / np.arange(1, n + 1)
    return p / p.sum()


@pytest.mark.parametrize("n,vocab,size,k", [(700, 40, 8, 15), (300, 900, 60, 50), (2000, 3000, 40, 50), (3, 5, 4, 50), (64, 10, 5, 1), (130, 400, 30, 129)])
def test_block_max_search_is_exact(n, vocab, size, k):
    r = np.random.default_rng(n)
    rows = _unit(r, n, vocab, size)
    index = t.BlockMaxIndex(rows, vocab)
    dense = np.zeros((n, vocab))
    for i, (a, w) in enumerate(rows):
        dense[i, a] = w
    queries = rows + [(np.empty(0, np.int64), np.empty(0))] + _unit(r, 40, vocab, size)
    but = [*range(n), *[-1] * 41]
    for i, (got, s) in enumerate(index.nearest(queries, k, but)):
        v = np.zeros(vocab)
        v[queries[i][0]] = queries[i][1]
        sims = dense @ v
        want = [j for j in np.lexsort((np.arange(n), -np.round(sims, 9))) if sims[j] > 1e-12 and j != but[i]][:k]
        assert got.tolist() == want
        assert np.allclose(s, sims[want])


def test_far_blocks_are_not_visited():
    r = np.random.default_rng(9)
    rows = [(g * 50 + a, w) for g in range(8) for a, w in _unit(r, 400, 50, 12)]
    index = t.BlockMaxIndex(rows, 400)
    index.nearest(rows[::7], 15)
    assert index.visited < 0.25 * index.searched * index.n_blocks


def test_word_scores_against_direct_counts():
    texts = [("a a b", 1), ("a a b", 1), ("a c", 1), ("b c d", 0), ("d d", 0), ("c", 0)]
    known = t.WordHash()
    words = [t.word_counts(x, known) for x, _ in texts]
    e = t.Examples(list(range(6)), [y for _, y in texts], [h for h, _ in words], [c.astype(np.int32) for _, c in words])
    s = t.WordScores(e)
    assert s.n == [3, 2]  # equal texts count once
    place = {w: int(np.searchsorted(e.vocabulary, known[w])) for w in "abcd"}
    assert [(s.toxic[place[w]], s.clean[place[w]]) for w in "abcd"] == [(2, 0), (1, 1), (1, 2), (0, 2)]
    df, share, n = 2, 2 / 5, 5
    want = (2 - df * share - 0.5) / (df * share * (1 - share) * (n - df) / (n - 1)) ** 0.5
    assert np.isclose(s.strongest(np.array([place["a"]]))[0], want)
    # left out, the text no longer counts
    own = s.strongest(np.array([place["a"]]), own=1.0)
    df, share, n = 1, 1 / 4, 4
    assert np.isclose(own[0], (1 - df * share - 0.5) / (df * share * (1 - share) * (n - df) / (n - 1)) ** 0.5)


def _plain_scores(rows, labels):
    """The whole rule by dictionaries: TF-IDF cosines with every example."""
    import collections
    import math

    texts = {i: x for i, x, *_ in rows}
    bag = {i: collections.Counter(t.words_of(x)) for i, x in texts.items()}
    n = len(rows)
    df = collections.Counter(w for b in bag.values() for w in b)
    train = sorted((i, y) for i, _, y, _ in labels if zlib.crc32(str(i).encode()) % 5)
    vocabulary = {w for i, _ in train for w in bag[i]}
    idf = lambda w: math.log((1 + n) / (1 + df[w])) + 1 if w in vocabulary else math.log(1 + n) + 1

    def unit(b):
        v = {w: (1 + math.log(c)) * idf(w) for w, c in b.items()}
        size = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / size for w, x in v.items()}

    vec = {i: unit(b) for i, b in bag.items() if b}
    out = {}
    for i in bag:
        sims = sorted(((-round(sum(x * vec[j].get(w, 0) for w, x in vec[i].items()), 9), k, y) for k, (j, y) in enumerate(train)))[:t.NEIGHBOURS]
        out[i] = [(-s, y) for s, _, y in sims if s < -1e-12]
    return out


def test_votes_come_from_exact_neighbours(spark):
    rows, labels = _labelled(150)
    docs = spark.createDataFrame(rows, SCHEMA)
    want = _plain_scores(rows, labels)
    model = t.fit(docs, spark.createDataFrame(labels, LABELS))
    s = t._searcher(model.name, model.shared)
    known = t.WordHash()
    queries = [s.examples.query(*t.word_counts(x, known)) for _, x, *_ in rows]
    for (i, *_), (x, found, sims) in zip(rows, s.features(queries)):
        assert np.allclose(sims, [a for a, _ in want[i]], atol=1e-8)
        if len(sims):
            near = np.array([a for a, _ in want[i]]), np.array([y for _, y in want[i]])
            weight = 1 / (1.05 - np.minimum(near[0], 1))
            # neighbours tied at the end may differ in label, not in cosine
            if len(set(np.round(near[0], 9))) == len(near[0]):
                assert np.isclose(x[0], (weight * near[1]).sum() / weight.sum())


def test_logistic_regression_is_calibrated():
    r = np.random.default_rng(4)
    x = r.normal(size=(4000, 2))
    p = 1 / (1 + np.exp(-(x @ [2.0, -1.0] - 0.5)))
    y = (r.random(4000) < p).astype(float)
    centre, scale, w = t.logistic(x, y)
    got = 1 / (1 + np.exp(-(w[0] + (x - centre) / scale @ w[1:])))
    assert abs(got.mean() - y.mean()) < 1e-3 and np.abs(got - p).mean() < 0.02


def _labelled(n=400):
    r = random.Random(2)
    rows, labels = [], []
    for i in range(n):
        words = ["".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(40)]
        bad = i % 4 == 0
        if bad:
            words[r.randrange(40)] = r.choice(("idiot", "Scum", "trash"))
        rows.append((i, " ".join(words), *edge_rows()[0][2:]))
        labels.append((i, 1, int(bad), "x"))
    return rows, labels


def test_held_out_accuracy_and_fold(spark):
    rows, labels = _labelled()
    got = t.score(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, LABELS)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) == int(r.doc_id % 4 == 0)
        assert all(e.doc_id % 4 == 0 for e in r.evidence)


def test_labels_of_held_out_rows_are_never_used(spark):
    rows, labels = _labelled()
    flipped = [(i, q, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y, x) for i, q, y, x in labels]
    docs = spark.createDataFrame(rows, SCHEMA)
    a = t.score(docs, spark.createDataFrame(labels, LABELS)).select("doc_id", "score").collect()
    b = t.score(docs, spark.createDataFrame(flipped, LABELS)).select("doc_id", "score").collect()
    assert sorted(a) == sorted(b)


def test_edge_cases_and_columns(spark):
    rows, labels = _labelled(200)
    docs = frame(spark, rows + [(r[0] + 10_000 if r[0] is not None else None, *r[1:]) for r in edge_rows()])
    lab = spark.createDataFrame(labels + [(None, 1, 1, ""), (3, 0, None, ""), (4, 0, 0, ""), (4, 1, 1, "")], LABELS)
    assert t.score(docs, lab).count() == docs.count()
    kept = t.drop_toxic(docs, lab)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.where("doc_id < 200").select("doc_id").collect()) == [i for i in range(200) if i % 4]


@pytest.mark.parametrize("labels", [[], [(1, 1, 0, "")], [(None, None, None, None)]])
def test_without_usable_labels(spark, labels):
    got = t.score(frame(spark), spark.createDataFrame(labels, LABELS)).collect()
    assert len(got) == len(edge_rows()) and all(r.predicted == 0 for r in got)


def test_empty_documents(spark):
    assert t.score(frame(spark, []), spark.createDataFrame(_labelled(20)[1], LABELS)).count() == 0


def test_equal_texts_take_their_examples_rate(spark):
    clean = [(i, f"plain words of text {'abcdefgh'[i % 8]}", *edge_rows()[0][2:]) for i in range(1, 30)]
    odd = "quite another rarity"
    ids = [i for i in range(100, 130) if zlib.crc32(str(i).encode()) % 5][:1]
    docs = frame(spark, [*clean, (ids[0], odd, *edge_rows()[0][2:]), (900, odd, *edge_rows()[0][2:]), (901, None, *edge_rows()[0][2:])])
    labels = spark.createDataFrame([(i, 1, 0, "") for i in range(1, 30)] + [(ids[0], 1, 1, "")], LABELS)
    got = {r.doc_id: r for r in t.score(docs, labels).collect()}
    assert got[900].predicted == 1 and [(e.doc_id, e.label) for e in got[900].evidence] == [(ids[0], 1)]
    assert got[901].predicted == 0 and not any(got[i].predicted for i in range(1, 30))
    assert 900 not in {r.doc_id for r in t.drop_toxic(docs, labels).collect()}


def test_six_thousand_labels_are_all_examples(spark):
    labels = spark.range(6000).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic", "'' AS terms")
    assert t.training_sample(labels, "toxic", F.lit(True), t.MAX_EXAMPLES).count() == 6000
    assert t.MAX_EXAMPLES == 20_000


def test_samples_of_huge_tables_are_not_empty(spark):
    # 2,000 of 4e9 rows are less than one in a million
    n = spark.range(20_000_000).where(drawn(F.xxhash64("id"), 4_000_000_000, 2000)).count()
    assert 1 <= n <= 40
    labels = spark.range(10).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic", "'' AS terms")
    with pytest.raises(ValueError):
        t.training_sample(labels, "toxic", F.lit(True), 0)


def test_each_group_of_blocks_has_its_own_dense_words():
    # four languages of 250 words: 256 columns for all rows would leave most words to postings
    r = np.random.default_rng(3)
    rows = [(g * 250 + a, w) for g in range(4) for a, w in _unit(r, t.BLOCK * t.GROUP, 250, 30)]
    index = t.BlockMaxIndex(rows, 1000)
    assert len(index.weight) < 0.1 * sum(len(a) for a, _ in rows)
    dense = np.zeros((len(rows), 1000))
    for i, (a, w) in enumerate(rows):
        dense[i, a] = w
    some = list(range(0, len(rows), 97))
    for i, (got, s) in zip(some, index.nearest([rows[i] for i in some], 50, some)):
        sims = dense @ dense[i]
        want = [j for j in np.lexsort((np.arange(len(rows)), -np.round(sims, 9))) if sims[j] > 1e-12 and j != i][:50]
        assert got.tolist() == want and np.allclose(s, sims[want], atol=1e-12)


def test_cosines_closer_than_single_precision_are_ranked():
    r = np.random.default_rng(5)
    base = r.random(300) + 0.1
    rows = []
    for i in r.permutation(400):
        w = base.copy()
        w[0] += i * 1e-6
        rows.append((np.arange(300), w / np.linalg.norm(w)))
    query = np.arange(300), base / np.linalg.norm(base)
    sims = np.array([w @ query[1] for _, w in rows])
    [(got, s)] = t.BlockMaxIndex(rows, 300).nearest([query], 50)
    assert got.tolist() == np.lexsort((np.arange(400), -np.round(sims, 9)))[:50].tolist() and np.allclose(s, sims[got], atol=1e-14)


@pytest.mark.parametrize("text", [None, "", "one Two two", "don't 4x4 a_b", "Über Maß straße", "naïve – “quoted” naïve", "İstanbul I", "русский текст, текст", "x² ½ ٣ 中文 字", "\U0001f600 smile", "a\x00b\x85c\xa0d", "é"])
def test_words_split_by_bytes_are_those_of_the_pattern(text):
    known = t.WordHash()
    h, n = np.unique(known.array(t.words_of(text)), return_counts=True)
    got, counts = t.word_counts(text, known)
    assert got.tolist() == h.tolist() and counts.tolist() == n.tolist()
    assert t.distinct_words(text, known).tolist() == h.tolist()


@pytest.mark.parametrize("at,n", [([], []), ([0], [1]), ([3, 258, 259], [255, 1, 256]), ([70_000, 5_000_000_000], [1, 70_000])])
def test_bags_come_back_from_their_bytes(at, n):
    got = t.unpacked(t.packed(np.array(at, dtype=np.int64), np.array(n, dtype=np.int64), 2.5))
    assert got[0].tolist() == at and got[1].tolist() == n and got[2] == 2.5


def test_words_are_split_once(spark):
    rows, labels = _labelled(50)
    docs, labels = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, LABELS)
    for got in t.score(docs, labels), t.drop_toxic(docs, labels):  # both score what was written beside the document frequencies
        assert got.inputFiles() and all("toxic-bags" in f for f in got.inputFiles())


def test_bags_give_the_vectors_of_their_texts():
    known = t.WordHash()
    words = [t.word_counts(x, known) for x in ("a a b c", "b d")]
    e = t.Examples([0, 1], [0, 1], [h for h, _ in words], [c.astype(np.int32) for _, c in words])
    e.weigh(4, np.array([1, 2, 3, 1]))
    h, c = t.word_counts("a b b z z z y", known)
    at, w = e.unit(*t.unpacked(t.packed(*t.bag(h, c, e.vocabulary))))
    place = [int(np.searchsorted(e.vocabulary, known[x])) for x in "ab"]
    a, b = e.idf[place[0]], (1 + np.log(2)) * e.idf[place[1]]
    size = np.sqrt(a * a + b * b + ((1 + np.log(3)) ** 2 + 1) * e.unseen ** 2)
    assert dict(zip(at.tolist(), w.tolist())) == pytest.approx({place[0]: a / size, place[1]: b / size})


def test_counts_are_held_narrow_and_weighed_in_double_precision():
    h = np.array([1, 2], dtype=np.uint64)
    for many, size in ((200, 1), (40_000, 2), (70_000, 4)):
        e = t.Examples([0], [0], [h], [np.array([1, many], dtype=np.int32)])
        assert e.count.itemsize == size
        w = np.array([1, 1 + np.log(many)])
        assert np.allclose(e.vector(0)[1], w / np.sqrt((w * w).sum()), rtol=1e-15)
