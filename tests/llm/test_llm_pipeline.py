"""Every stage of the pipeline on sf0.001, against its own input."""

import re

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from kestrel.llm import pii
from kestrel.llm.sentencepiece_viterbi import Encoder
from kestrel.sources.tables import load
from kestrel.storage import materialize
from test_llm_decontaminate import brute as contaminated
from test_llm_ngram_join import brute as classes

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = load(spark, SF, "documents")
    out = [docs.collect()]
    for k, (_, f) in enumerate(corpus_pipeline.STAGES):
        docs = materialize(f(spark, docs, SF), f"test-stage-{k}")
        out.append(docs.collect())
    return out


def test_columns_are_kept(spark, stages):
    want = load(spark, SF, "documents").columns
    assert all(list(rows[0].asDict()) == want for rows in stages[:-1])


def test_toxicity_drops_toxic_words_only(stages):
    before, after = stages[0], {r.doc_id for r in stages[1]}
    gone = [r for r in before if r.doc_id not in after]
    assert 0 < len(gone) < 0.3 * len(before)
    words = re.compile(r"(?i)\b(trash|pathetic|idiot|worthless|disgusting|stupid|clown|scum|loser|moron)\b")
    with_words = {r.doc_id for r in before if len(words.findall(r.text)) > 1}
    assert len(with_words - {r.doc_id for r in gone}) <= 0.2 * len(with_words)


def test_one_document_of_each_class_stays(stages):
    want = {c for _, c, _ in classes([tuple(r) for r in stages[1]])}
    assert {r.doc_id for r in stages[2]} == want


def test_contaminated_documents_go(spark, stages):
    items = [tuple(r) for r in load(spark, SF, "benchmark").collect()]
    report = contaminated([tuple(r) for r in stages[2]], items)
    assert {r.doc_id for r in stages[3]} == {r[0] for r in report if not r[5]}


def test_personal_data_is_redacted(stages):
    before = {r.doc_id: r.text for r in stages[3]}
    assert len(stages[4]) == len(before)
    for r in stages[4]:
        assert r.n_chars == len(r.text)
        assert not pii.base_spans(r.text)
        if not pii.base_spans(before[r.doc_id]) and not pii.proposals(before[r.doc_id]):
            assert r.text == before[r.doc_id]


def test_ids_decode_to_the_redacted_text(stages):
    enc = Encoder(public_tokenizers.path("piece_bpe_32k.model"))
    text = {r.doc_id: r.text for r in stages[4]}
    assert len(stages[5]) == len(text)
    for r in stages[5]:
        assert r.n_tokens == len(r.ids)
        assert enc.decode(np.array(r.ids, dtype="<u4").tobytes()) == text[r.doc_id]
