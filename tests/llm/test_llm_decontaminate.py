import hashlib
import random
import re

from edge_data import SCHEMA, corpus, edge_rows, frame
from kestrel.llm import decontaminate as d

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return WORD.findall((t or "").translate(LOWER))


def brute(docs, items):
    out = []
    for doc_id, text, *_ in docs:
        w = words(text)
        hit, found = set(), set()
        for item, t, *_ in items:
            v = words(t)
            n = min(10, len(v))
            windows = {tuple(v[i:i + n]) for i in range(len(v) - n + 1)} if n else set()
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    hit.update(range(i, i + n))
                    if item is not None:
                        found.add(str(item))
        names = ",".join(sorted(found))
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), bool(hit)))
    return out


def items():
    texts = corpus()
    r = [(1, " ".join(texts[0].split()[:25])), (2, texts[3].replace("\n", " -- ").upper()), (10, texts[3].replace("\n", " ")), (3, "one two three"), (4, None),
         (5, ""), (6, "!!!"), (7, "again"), (8, "again and again and again and again and again and again"), (9, "absent words only here"), (None, "one two three four"),
         (11, "one two three"), (11, "one two three"), (12, "中\U0001F600"), (13, "w5x5 w6x6 w7x7 w8x8 w9x9 w10x10 w11x11 w12x12 w13x13 w14x14 w15x15 w16x16")]
    return [(*x, "term", 1) for x in r]


def bench(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string, term string, start int")


def _sorted(rows):
    return sorted(map(tuple, rows), key=str)


def test_scan_matches_brute_force_on_edge_cases(spark):
    got = d.scan(frame(spark), bench(spark, items())).collect()
    assert _sorted(got) == _sorted(brute(edge_rows(), items()))


def test_random_small_vocabulary(spark):
    """Few words: every window has many candidate starts."""
    r = random.Random(5)
    docs = [(i, " ".join(r.choice("abc") for _ in range(r.randint(0, 200))), *edge_rows()[0][2:]) for i in range(30)]
    its = [(i, " ".join(r.choice("abc") for _ in range(r.choice((3, 6, 10, 12)))), "t", 0) for i in range(12)]
    got = d.scan(spark.createDataFrame(docs, SCHEMA), bench(spark, its)).collect()
    assert _sorted(got) == _sorted(brute(docs, its))


def test_empty_tables(spark):
    assert d.scan(frame(spark, []), bench(spark, items())).count() == 0
    got = d.scan(frame(spark), bench(spark, [])).collect()
    assert len(got) == len(edge_rows()) and not any(r.contaminated for r in got)


def test_drop_contaminated_keeps_columns_and_clean_rows(spark):
    docs = frame(spark)
    got = d.drop_contaminated(docs, bench(spark, items()))
    assert got.columns == docs.columns
    clean = [r[0] for r in brute(edge_rows(), items()) if not r[5]]
    assert sorted(map(str, (r.doc_id for r in got.collect()))) == sorted(map(str, clean))


def test_proximity(spark):
    rows = [(i, t, *edge_rows()[0][2:]) for i, t in enumerate(["alpha beta gamma delta", "alpha x beta gamma delta", "alpha " + "x " * 50 + "beta gamma", "beta"])]
    got = d.proximity_matches(spark.createDataFrame(rows, SCHEMA), bench(spark, [(1, "alpha beta gamma", "t", 0)]), n_terms=3, slop=2).collect()
    assert sorted(r.doc_id for r in got) == [0, 1]


def test_near_report_uses_every_offset_and_lists_every_document(spark):
    # 'rare' recurs; the document quotes only the end of item 1, with a word changed
    its = [(1, "rare x x x x x x x x x x x alpha beta rare", "t", 0), (2, "beta missing gone", "t", 0), (None, "alpha beta", "t", 0)]
    docs = [(0, "alpha CHANGED rare"), (1, "alpha beta rare"), (2, "beta"), (3, None), (1, "beta rare")]
    rows = [(i, t, *edge_rows()[0][2:]) for i, t in docs]
    got = _sorted(d.near_report(spark.createDataFrame(rows, SCHEMA), bench(spark, its)).collect())
    one, none = hashlib.sha256(b"1").hexdigest(), hashlib.sha256(b"").hexdigest()
    assert got == _sorted([(0, 0, none), (1, 1, one), (2, 0, none), (3, 0, none), (1, 0, none)])


def near_brute(docs, items, n_terms=3, slop=5):
    """Items by document, from the rule: the rarest terms' starts within one stretch."""
    counts = {}
    for _, text, *_ in docs:
        for w in words(text):
            counts[w] = counts.get(w, 0) + 1
    out = []
    for doc_id, text, *_ in docs:
        w, found = words(text), set()
        for item, t, *_ in items:
            offsets = {}
            for off, term in enumerate(words(t)):
                offsets.setdefault(term, set()).add(off)
            rare = sorted((counts[x], x) for x in offsets if x in counts)[:n_terms]
            if not offsets or len(rare) < min(len(offsets), n_terms):
                continue
            starts = [(p - off, x) for _, x in rare for p, y in enumerate(w) if y == x for off in offsets[x]]
            if any({x for s, x in starts if low <= s <= low + slop} == {x for _, x in rare} for low, _ in starts) and item is not None:
                found.add(str(item))
        names = ",".join(sorted(found))
        out.append((doc_id, len(found), hashlib.sha256(names.encode()).hexdigest()))
    return out


def test_near_report_against_brute_force(spark):
    r = random.Random(11)
    vocab = [f"t{i}" for i in range(25)]
    docs = [(i, " ".join(r.choice(vocab) for _ in range(r.choice((0, 1, 5, 40, 300)))), *edge_rows()[0][2:]) for i in range(25)]
    docs += [docs[3], (3, "another text t1 t2 t3", *docs[0][2:]), (None, "t1 t2 t3 t4", *docs[0][2:]), (99, None, *docs[0][2:])]
    # one row an item: rows of one item_id are one item
    its = [(i, " ".join(r.choice(vocab) for _ in range(r.choice((1, 2, 3, 8, 20)))), "t", 0) for i in range(15)] + [(50, None, "t", 0), (51, "absent t1", "t", 0)]
    got = d.near_report(spark.createDataFrame(docs, SCHEMA), bench(spark, its)).collect()
    assert _sorted(got) == _sorted(near_brute(docs, its))
