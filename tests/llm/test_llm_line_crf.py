import itertools
import random
import zlib

import numpy as np
import pytest

from edge_data import SCHEMA, edge_rows, frame
from kestrel.llm import line_crf as c

LABELS = "doc_id long, quality int, toxic int, score string"


def test_marginals_and_expectations_match_enumeration():
    r = np.random.default_rng(0)
    crf = c.LineCrf(r.normal(size=c.N_FEATURES), r.normal(size=(2, 2)))
    seqs = [r.random((n, c.N_FEATURES)).astype(np.float32) for n in (1, 2, 5, 7)]
    got = crf.marginals(seqs)
    for s, g in zip(seqs, got):
        total, good = 0.0, np.zeros(len(s))
        for y in itertools.product((0, 1), repeat=len(s)):
            v = np.exp(sum(float(s[i] @ crf.w) * y[i] for i in range(len(s))) + sum(crf.t[a, b] for a, b in zip(y[:-1], y[1:])))
            total += v
            good += v * np.array(y)
        assert np.allclose(g, good / total, atol=1e-6)


def _labelled(n=300):
    r = random.Random(4)
    rows, labels = [], []
    for i in range(n):
        lines = [" ".join("".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(r.randint(5, 30))) for _ in range(4)]
        bad = i % 4 == 0
        if bad:
            for k in (1, 2, 3):
                lines[k] = " ".join(w + "###" for w in lines[k].split())
        rows.append((i, "\n".join(lines), *edge_rows()[0][2:]))
        labels.append((i, int(not bad), 0, "x"))
    return rows, labels


def test_held_out_accuracy_and_edge_cases(spark):
    rows, labels = _labelled()
    docs = frame(spark, rows + [(r[0] + 10_000 if r[0] is not None else None, *r[1:]) for r in edge_rows()])
    lab = spark.createDataFrame(labels + [(None, 1, 1, ""), (3, None, 0, ""), (8, 0, 0, "")], LABELS)
    got = c.score(docs, lab).collect()
    assert len(got) == len(rows) + len(edge_rows())
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        if r.doc_id is not None and r.doc_id < 300:
            assert r.predicted == int(r.doc_id % 4 != 0)


def test_bad_lines_of_a_bad_document_are_found(spark):
    rows, labels = _labelled()
    model = c.fit(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, LABELS))
    x, _ = c.line_features(rows[4][1])
    p = model.crf.marginals([x])[0]
    assert p[2] < 0.5 and p[3] < 0.5 and p[0] > p[2]


def test_held_out_labels_are_never_used(spark):
    rows, labels = _labelled(120)
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 4 == 2 else q, y, s) for i, q, y, s in labels]
    docs = spark.createDataFrame(rows, SCHEMA)
    a = c.score(docs, spark.createDataFrame(labels, LABELS)).collect()
    b = c.score(docs, spark.createDataFrame(flipped, LABELS)).collect()
    assert sorted(a) == sorted(b)


@pytest.mark.parametrize("labels", [[], [(1, 1, 0, "")], [(None, None, None, None)]])
def test_without_usable_labels(spark, labels):
    got = c.score(frame(spark), spark.createDataFrame(labels, LABELS)).collect()
    assert len(got) == len(edge_rows()) and len({r.score for r in got}) == 1


def test_empty_documents(spark):
    assert c.score(frame(spark, []), spark.createDataFrame(_labelled(8)[1], LABELS)).count() == 0
