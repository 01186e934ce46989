import re

import numpy as np
import pytest

from edge_data import SCHEMA, edge_rows, frame
from kestrel.llm import quality_rules as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    words = WORD.findall(text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    where = {}
    for i in range(len(words) - 4):
        where.setdefault(tuple(words[i:i + 5]), []).append(i)
    rep = {p for v in where.values() if len(v) > 1 for i in v for p in range(i, i + 5)}
    n = len(words)
    return (n, sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), dup, len(rep), n < 10 or 100 * len(rep) > 20 * n)


def test_counts_match_brute_force_on_edge_cases(spark):
    got = q.judge(frame(spark)).collect()
    want = sorted((r[0] is None, r[0] or 0, *base(r[1])) for r in edge_rows())
    assert sorted((r.doc_id is None, r.doc_id or 0, *r[1:7]) for r in got) == want
    assert all(not r.kept for r in got if r.base_failed)


def test_empty_table_and_groups_without_words(spark):
    assert q.judge(frame(spark, [])).count() == 0
    blank = [(i, t, "xx", "s", 0, *edge_rows()[0][5:]) for i, t in enumerate((None, "", " \n"))]
    assert [r.kept for r in q.judge(frame(spark, blank)).collect()] == [False] * 3


def test_outliers_go_and_clean_rows_stay(spark):
    r = np.random.default_rng(0)
    vocab = ["".join(r.choice(list("abcdefgh"), r.integers(2, 9))) for _ in range(500)]
    rows = []
    for i in range(300):
        words = list(r.choice(vocab, 150))
        words[0] = words[0].capitalize()
        if i % 10 == 0:
            words = [w + "###" for w in words]
        elif i % 10 == 1:
            words = [w.upper() for w in words]
        rows.append((i, " ".join(words), "en", "s", 0, *edge_rows()[0][5:]))
    got = {x.doc_id: x.kept for x in q.judge(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(got[i] == (i % 10 > 1) for i in got)


def _mcd(x, steps=q.STEPS):
    """Plain MCD with the module's bins, target and starts."""
    def reg(m, c, n):
        w = n / (n + q.PSEUDO_ROWS)
        return m, w * c + np.diag((1 - w) * np.array(q.TARGET_SD) ** 2 + np.array(q.FLOOR_SD) ** 2)

    p25, p50, p75 = (np.sort(x, 0)[int(np.ceil(len(x) * f)) - 1] for f in (0.25, 0.5, 0.75))
    starts = [(p50, np.diag(((p75 - p25) / 1.349) ** 2 + np.array(q.FLOOR_SD) ** 2)), reg(x.mean(0), np.cov(x.T, bias=True), len(x))]
    out = []
    for m, c in starts:
        for _ in range(steps):
            d = np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m)
            b = np.floor(np.log1p(d) * q.BINS_PER_UNIT)
            edge = np.sort(b)[int(np.ceil(len(x) * q.SUBSET)) - 1]
            near = x[b <= edge]
            m, c = reg(near.mean(0), np.cov(near.T, bias=True), len(near))
        out.append((np.linalg.slogdet(c)[1], m, c))
    _, m, c = min(out, key=lambda t: t[0])
    return np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m)


def test_mcd_matches_numpy(spark):
    r = np.random.default_rng(3)
    x = np.concatenate([r.normal(size=(400, 5)) @ r.normal(size=(5, 5)) * 100, r.normal(3000, 50, (60, 5))]).round()
    pdf = spark.createDataFrame([(i, "g", *map(float, v)) for i, v in enumerate(x)], "id long, grp string, " + ", ".join(f"x{i} double" for i in range(5)))
    got = [v.d for v in pdf.join(q.mcd(pdf.drop("id")), "grp").select("id", q._distance().alias("d")).orderBy("id").collect()]
    want = _mcd(x / 1000)
    assert np.allclose(got, want, rtol=1e-6)
    assert min(got[400:]) > max(got[:400])


def test_consistency_factor():
    assert q.chi2_cdf(11.0705, 5) == pytest.approx(0.95, abs=1e-5)
    assert q.consistency(0.999999) == pytest.approx(1, abs=1e-3)
