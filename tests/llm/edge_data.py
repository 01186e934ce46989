"""Small documents with every awkward case, and a numpy-free random corpus."""

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, key string, terms string, tf int, score double, "
          "part int, row long, v string, grp string, words string, phrase string, h long")


def _row(doc_id, text, lang="en", source="s0"):
    return (doc_id, text, lang, source, len(text or ""), "k", "t", 1, 0.5, 7, 8, "v", "g", "w", "p", 9)


def corpus(n=60, seed=1, vocab=400):
    """Random prose with exact copies, near copies and repeated lines."""
    r = random.Random(seed)
    words = ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 8))) for _ in range(vocab)]
    texts = []
    for i in range(n):
        kind = i % 6
        if kind == 1 and texts:
            texts.append(texts[-1])
        elif kind == 2 and texts:
            t = texts[-1].split(" ")
            t[r.randrange(len(t))] = "changed"
            texts.append(" ".join(t))
        else:
            lines = [" ".join(r.choice(words) for _ in range(r.randint(1, 40))) for _ in range(r.randint(1, 6))]
            texts.append("\n".join(lines + lines[:1] * (kind == 3)))
    return texts


def edge_rows():
    long_text = " ".join(f"w{i % 977}x{i}" for i in range(20_000))
    rows = [_row(i, t, ("en", "de", None)[i % 3], ("s0", "s1", None)[i % 3 if i % 5 else 0]) for i, t in enumerate(corpus())]
    rows += [_row(100, None), _row(101, ""), _row(102, " \t\n\x0b\x0c\r "), _row(103, "one"), _row(104, "one two three four"),
             _row(105, "one two three four"), _row(106, long_text), _row(107, long_text), _row(None, "null id text with six words"),
             _row(None, None), _row(108, "same row"), _row(108, "same row"), _row(108, "same id other text here now"),
             _row(109, "a" * 100_000), _row(110, "é中\U0001F600 ▁   x\x1cy  z\r\n"), _row(111, "again and " * 3000),
             _row(112, "MIXED Case, punctuation... <|endoftext|> don't ''quote'' 3.14"), _row(113, "text", None, None)]
    return rows


def frame(spark, rows=None):
    return spark.createDataFrame(edge_rows() if rows is None else rows, SCHEMA)
