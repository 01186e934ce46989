import numpy as np

from kestrel.llm import pii, text


def test_every_document_is_learnt_from(spark, monkeypatch):
    # a bound of one document, where there is any, would leave nothing to learn
    monkeypatch.setattr(pii, "MAX_TRAIN_DOCS", 1, raising=False)
    docs = spark.createDataFrame([(i, f"some words of text {i} and more of them, no {i}") for i in range(120)], "doc_id long, text string")
    model = pii.fit(docs)
    (base, found), = model.spans(["call (212) 555-0123 before noon"])
    assert len(found) > len(base)


def test_thresholds_keep_whole_ties(spark):
    rows = [(0, 0.9, 1.0)] * 99 + [(0, 0.8, 0.0)] + [(0, 0.8, 1.0)] + [(0, 0.7, 0.0)] * 2 + [(1, 0.9, 0.0)] + [(2, 0.4, 1.0)]
    got = pii._thresholds(spark.createDataFrame(rows, "kind int, p double, label double"))
    assert np.allclose(got, [0.8, 2.0, 2.0, 2.0])


def test_a_worker_keeps_only_the_last_users_state():
    built = []
    for user, name in (("a", "1"), ("a", "1"), ("b", "1"), ("a", "1")):
        text.keep(user, name, lambda: built.append((user, name)))
    assert built == [("a", "1"), ("b", "1"), ("a", "1")] and list(text._kept) == ["a"]
    text.forget()
    assert not text._kept
