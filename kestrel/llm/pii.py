"""Personal data by gradient-boosted candidate spans (operator 3).

Four kinds, in this order: email, ip, card, phone. The base rules find each
kind's plain spans; those are always kept. High-recall generators propose
further, overlapping spans (spelled-out emails, IPv6 and odd dotted numbers,
digit chains with other separators, national and 00-prefixed phone numbers);
boosted trees score every proposal by its format and context, and thresholds
calibrated per kind select among them: best score first, no overlap with a
span already selected.

The trees (``pyspark.ml`` GBTClassifier) learn from one half of all documents:
proposals found in their texts, labelled by the base rules, and personal data
and look-alikes planted into them in many written forms. The other half sets,
per kind, the lowest threshold with ``MIN_PRECISION``.

Defined cases: null and empty texts have no spans; proposals of the same
score are taken by start and kind; repeated rows get equal results; an empty
table gives no rows (and trains nothing); spans count code points, end
exclusive; other columns are ignored (``redact`` keeps them).
"""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.text import forget
from kestrel.operators.ordered import ordered_cumsum
from kestrel.storage import materialize

KINDS = ("email", "ip", "card", "phone")
#: strings planted into a training document
PLANTED = 12
TREES, DEPTH = 20, 5
MIN_PRECISION = 0.99
MIN_THRESHOLD = 0.5

Span = tuple[int, int, int]  # start, kind, end

_ANY = re.compile(r"[0-9@]|[\[({]at[\])}]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# possessive runs and the look-behind only spare retries that cannot match; a look-behind stands after the first
# character, since the library looks for a first character much faster than it tries each place
_IP = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

_SPELLED = re.compile(r"[A-Za-z0-9._%+-]++ ?[\[({]at[\])}] ?[A-Za-z0-9-]++(?: ?(?:[\[({]dot[\])}]|\.) ?[A-Za-z0-9-]++)+")
_AT = re.compile(r"[\[({]at[\])}]")
_IP6 = re.compile(r"[0-9A-Fa-f](?<![0-9A-Fa-f:][0-9A-Fa-f])[0-9A-Fa-f]{0,3}:(?:[0-9A-Fa-f]{1,4}:){3,6}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")
_DOTTED = re.compile(r"[0-9](?<![0-9.][0-9])[0-9]{0,3}(?:\.[0-9]{1,4}){3,5}(?![0-9])")
_CHAIN = re.compile(r"[0-9](?<![0-9][0-9])(?:[ ._-]?[0-9]){11,18}(?![0-9])")
_NATIONAL = re.compile(r"[(0-9](?<![0-9][(0-9])(?:(?<=\()[0-9]{3}|(?<=[0-9])[0-9]{2})\)?[ ./-]{1,2}[0-9]{3}[ .-][0-9]{4}(?![0-9])")
_PREFIXED = re.compile(r"00(?<![0-9]00)[1-9][0-9 ().-]{7,16}[0-9](?![0-9])")
_OTHERS, _RUN = re.compile(r"[^0-9]+"), re.compile(r"[0-9]+")
_HINTS = (re.compile(r"mail|contact|write", re.I), re.compile(r"\bip\b|host|server|addr", re.I), re.compile(r"card|visa|credit|pay", re.I),
          re.compile(r"phone|tel|call|mobil|fax", re.I), re.compile(r"order|version|isbn|serial|invoice|part|date|\bid\b|\bno\b|\bv$", re.I))


_ONE_OF = tuple(tuple(float(kind == k) for k in range(len(KINDS))) for kind in range(len(KINDS)))
_DOUBLED = bytes.maketrans(b"0123456789", b"0246813579")


def _hints(before: str) -> list[float]:
    """Which hints are in the words before a span."""
    if not before.isascii():
        return [float(bool(h.search(before))) for h in _HINTS]
    low = before.lower()
    # for ASCII, plain words are found without the patterns
    return [float("mail" in low or "contact" in low or "write" in low),
            float("host" in low or "server" in low or "addr" in low or "ip" in low and bool(_HINTS[1].search(before))),
            float("card" in low or "visa" in low or "credit" in low or "pay" in low),
            float("phone" in low or "tel" in low or "call" in low or "mobil" in low or "fax" in low),
            float("order" in low or "version" in low or "isbn" in low or "serial" in low or "invoice" in low or "part" in low or "date" in low
                  or ("id" in low or "no" in low or low[-2:].rstrip().endswith("v")) and bool(_HINTS[4].search(before)))]


def luhn(digits: str) -> bool:
    d = digits.encode()
    return (sum(d[::-2]) + sum(d[-2::-2].translate(_DOUBLED)) - 48 * len(d)) % 10 == 0


def _only_digits(s: str) -> str:
    return _OTHERS.sub("", s)


def _spelled(text: str) -> Iterator[Span]:
    """Spelled-out emails: each starts where the run of characters before its
    at begins."""
    free = 0  # end of the last match
    for at in _AT.finditer(text):
        start = at.start() - (text[max(0, at.start() - 1):at.start()] == " ")
        while start > 0 and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _SPELLED.match(text, start) if start >= free else None
        if m:
            yield m.start(), 0, m.end()
            free = m.end()


def base_spans(text: str) -> list[Span]:
    """Spans of the base rules, by start and kind."""
    out: list[Span] = []
    at, free = text.find("@"), 0  # free: end of the last match
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            out.append((start, 0, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        d = _only_digits(m.group())
        if 14 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_only_digits(m.group())) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def proposals(text: str) -> list[Span]:
    """High-recall, overlapping spans."""
    found = {(m.start(), k, m.end()) for k, rx in ((1, _DOTTED), (2, _CHAIN), (3, _NATIONAL), (3, _PREFIXED)) for m in rx.finditer(text)}
    found.update(_spelled(text))
    if text.count(":") >= 4:
        found |= {(m.start(), 1, m.end()) for m in _IP6.finditer(text)}
    return sorted(found)


def features(text: str, span: Span) -> list[float]:
    start, kind, end = span
    s, before, after = text[start:end], text[max(0, start - 24):start], text[end:end + 12]
    d = _only_digits(s)
    seps = [c for c in s if not c.isalnum()]
    groups = _RUN.findall(s)
    octets = s.split(".")
    near = text[max(0, start - 40):start] + text[end:end + 40]
    return [
        *_ONE_OF[kind], float(len(s)), float(len(d)), len(d) / len(s), float(len(seps)), float(len(set(seps))),
        float(s[0] == "+"), float(s[0] == "("), float(s.startswith("00")), float(bool(d) and luhn(d)), float(len(set(d))),
        float(len(groups)), float(max(map(len, groups), default=0)),
        float(len(octets) == 4 and all(o.isascii() and o.isdigit() and len(o) <= 3 and int(o) <= 255 for o in octets)),
        float(any(len(g) > 1 and g[0] == "0" for g in groups)), float("@" in s), float("at" in s), float("dot" in s), float(s.count(":")),
        float(before[-1:].isalnum()), float(before[-1:].isspace() or not before), float(before[-1:] in ".-/_"), float(after[:1].isalnum()),
        float(after[:1] in "-/_" and bool(after)), float(after[:1] == "."),
        *_hints(before), len(_only_digits(near)) / max(1, len(near))]


# ---- training -----------------------------------------------------------------

def _planted(r: random.Random) -> tuple[str, str, int, int]:
    """(words before, string, kind, label) of one planted string."""
    digits = lambda n: "".join(map(r.choice, ["0123456789"] * n))
    word = lambda: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(3, 9)))
    hint = lambda *w: r.choice(w) if r.random() < 0.4 else ""

    def card(ok: bool) -> str:
        body = r.choice("3456") + digits(r.choice((14, 14, 13)))
        last = next(c for c in "0123456789" if luhn(body + c))
        d = body + (last if ok else str((int(last) + r.randint(1, 9)) % 10))
        sep = r.choice(("", ".", "_", " ", "-"))
        return sep.join(d[i:i + 4] for i in range(0, len(d), 4))

    form = r.randrange(11)
    if form < 2:
        o, c = r.choice(("[]", "()", "{}"))
        sp = r.choice((" ", ""))
        dot = r.choice((f"{sp}{o}dot{c}{sp}", "."))
        return hint("mail", "contact"), f"{word()}{sp}{o}at{c}{sp}{word()}{dot}{r.choice(('com', 'org', 'net', 'de', 'example.com'))}", 0, 1
    if form == 2:
        return hint("host", "server"), ":".join(f"{r.randrange(1, 16 ** r.randint(1, 4)):x}" for _ in range(8)), 1, 1
    if form == 3:
        return hint("version", "v", "part"), ".".join(str(r.randrange(0, r.choice((4, 20, 99)))) for _ in range(r.choice((5, 6)))), 1, 0
    if form == 4:
        return hint("version", "serial"), ".".join(str(r.randrange(256, 3000)) for _ in range(4)), 1, 0
    if form == 5:
        return hint("card", "visa", "credit"), card(True), 2, 1
    if form == 6:
        return hint("order", "serial", "invoice"), card(False), 2, 0
    if form == 7:
        a, b, c = digits(3), digits(3), digits(4)
        return r.choice(("call", "phone", "tel", "mobile")), r.choice((f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"{a} {b} {c}")), 3, 1
    if form == 8:
        a, b, c = digits(3), digits(3), digits(4)
        return hint("order", "part", "id", "invoice"), r.choice((f"{a}-{b}-{c}", f"{a} {b} {c}", f"{a}.{b}.{c}")), 3, 0
    if form == 9:
        return hint("call", "tel"), f"00{r.randrange(1, 99)} {digits(3)} {digits(3)} {digits(4)}", 3, 1
    return hint("date", "no"), digits(r.randint(12, 19)), 2, 0


def training_rows(text: str) -> Iterator[tuple[int, float, list[float]]]:
    """(kind, label, features) of the proposals in the text with strings
    planted into it, the same for the same text."""
    r = random.Random(zlib.crc32(text.encode("utf-8", "replace")))
    words = text.split(" ")
    truth: dict[str, tuple[int, int]] = {}
    for _ in range(PLANTED):
        lead, s, kind, label = _planted(r)
        words.insert(r.randint(0, len(words)), f"{lead} {s}" if lead else s)
        truth[s] = kind, label
    planted = " ".join(words)
    base = set(base_spans(planted))
    covered = [(a, b) for a, _, b in base]
    for span in proposals(planted):
        kind, label = truth.get(planted[span[0]:span[2]], (None, None))
        if kind == span[1]:
            yield span[1], float(label), features(planted, span)
        elif span in base:
            yield span[1], 1.0, features(planted, span)
        elif not any(a < span[2] and span[0] < b for a, b in covered):
            yield span[1], 0.0, features(planted, span)


class SpanModel:
    """Boosted trees as arrays, and a threshold for each kind."""

    def __init__(self, trees: list[tuple[float, list[tuple[int, float, int, int, float]]]], thresholds: list[float]):
        # a node: feature (-1: leaf), threshold, left, right, value
        self.trees = [(w, *(np.array(c) for c in zip(*nodes, strict=True))) for w, nodes in trees]
        self.thresholds = thresholds

    def probability(self, x: np.ndarray) -> np.ndarray:
        margin = np.zeros(len(x))
        for w, feature, cut, left, right, value in self.trees:
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(DEPTH):
                f = feature[at]
                down = np.where(x[np.arange(len(x)), np.maximum(f, 0)] <= cut[at], left[at], right[at])
                at = np.where(f < 0, at, down)
            margin += w * value[at]
        return 1 / (1 + np.exp(-2 * margin))

    def spans(self, texts: list[str]) -> list[tuple[list[Span], list[Span]]]:
        """(base spans, all spans) of each text, by start and kind."""
        base = [base_spans(t) if t and _ANY.search(t) else [] for t in texts]
        if not self.trees:
            return [(b, b) for b in base]
        more = [(i, p) for i, t in enumerate(texts) if t and _ANY.search(t) for p in proposals(t) if p not in base[i]]
        chosen: list[list[Span]] = [list(b) for b in base]
        if more:
            prob = self.probability(np.array([features(texts[i], p) for i, p in more]))
            for k in np.lexsort((range(len(more)), -prob)):
                i, (a, kind, b) = more[k]
                if prob[k] >= self.thresholds[kind] and not any(x < b and a < y for x, _, y in chosen[i]):
                    chosen[i].append((a, kind, b))
        return [(b, sorted(c)) for b, c in zip(base, chosen, strict=True)]


def _nodes(root) -> list[tuple[int, float, int, int, float]]:
    """A fitted tree of the library as a list of nodes."""
    out: list = []

    def visit(n) -> int:
        me = len(out)
        out.append(None)
        if n.subtreeDepth() == 0:
            out[me] = (-1, 0.0, 0, 0, float(n.prediction()))
        else:
            s = n.split()
            left, right = visit(n.leftChild()), visit(n.rightChild())
            out[me] = (int(s.featureIndex()), float(s.threshold()), left, right, 0.0)
        return me

    visit(root)
    return out


def fit(docs: DataFrame) -> SpanModel:
    """Trees from one half of all documents, thresholds from the other."""
    h = F.xxhash64(F.coalesce("text", F.lit("")), F.lit(3))
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"), F.pmod(h, F.lit(2)).cast("int").alias("part"))

    def rows(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forget()
        for pdf in it:
            found = [(part, *row) for text, part in zip(pdf["text"], pdf["part"], strict=True) for row in training_rows(text)]
            yield pd.DataFrame(found, columns=["part", "kind", "label", "x"])

    cand = materialize(texts.mapInPandas(rows, "part int, kind int, label double, x array<double>"), "spans")
    train = cand.where("part = 0").select("label", array_to_vector("x").alias("features"))
    if train.select("label").distinct().count() < 2:
        return SpanModel([], [1.0] * len(KINDS))
    gbt = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7, maxBins=32).fit(train)
    trees = [(float(w), _nodes(t._call_java("rootNode"))) for w, t in zip(gbt.treeWeights, gbt.trees, strict=True)]
    model = SpanModel(trees, [1.0] * len(KINDS))

    def judged(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            if len(pdf):
                p = model.probability(np.stack(pdf["x"].to_list()))
                yield pd.DataFrame({"kind": pdf["kind"], "p": p, "label": pdf["label"]})

    held = cand.where("part = 1").select("kind", "label", "x").mapInPandas(judged, "kind int, p double, label double")
    found = _thresholds(held)
    if found is not None:
        model.thresholds = found
    return model


def _thresholds(judged: DataFrame) -> list[float] | None:
    """For each kind the lowest score, MIN_THRESHOLD at least, from which the
    precision of all higher scores is MIN_PRECISION; above 1 if there is none.
    ``judged``: kind, p, label. None without any row."""
    ties = judged.groupBy("kind", "p").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("good"))  # whole ties only
    sums = ordered_cumsum(ties, ["kind"], "p", ["n", "good"], descending=True)
    ok = (F.col("cum_good") / F.col("cum_n") >= MIN_PRECISION) & (F.col("p") >= MIN_THRESHOLD)
    rows = sums.groupBy("kind").agg(F.min(F.when(ok, F.col("p"))).alias("p")).collect()  # a row a kind
    by_kind = {r["kind"]: r["p"] for r in rows}
    return [2.0 if by_kind.get(k) is None else float(by_kind[k]) for k in range(len(KINDS))] if rows else None


# ---- application --------------------------------------------------------------

def _written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def find(docs: DataFrame, model: SpanModel | None = None) -> DataFrame:
    """Counts and hash of the base spans, and all spans, of every document."""
    model = model or fit(docs)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            out = model.spans([t or "" for t in texts])
            cols = {f"n_{k}": [sum(s[1] == i for s in b) for b, _ in out] for i, k in enumerate(KINDS)}
            yield pd.DataFrame(cols | {"base_sha256": [hashlib.sha256(_written(b).encode()).hexdigest() for b, _ in out],
                                       "spans": [_written(c) for _, c in out]})

    schema = ", ".join([*(f"n_{k} long" for k in KINDS), "base_sha256 string", "spans string"])
    return docs.select("doc_id", F.pandas_udf(run, schema)(F.col("text")).alias("v")).select("doc_id", "v.*")


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each span, overlapping ones as one, as [KIND]."""
    out, done, kind = [], 0, None
    for a, k, b in spans:
        if kind is not None and a < done:
            done = max(done, b)
            continue
        out += [text[done:a], f"[{KINDS[k].upper()}]"]
        done, kind = b, k
    return "".join(out) + text[done:]


def redact(docs: DataFrame, model: SpanModel | None = None) -> DataFrame:
    """``docs`` with all spans redacted in ``text``; null texts stay null."""
    model = model or fit(docs)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        forget()
        for texts in batches:
            found = model.spans([t or "" for t in texts])
            yield pd.Series([None if t is None else redacted(t, c) if c else t for t, (_, c) in zip(texts, found, strict=True)], dtype=object)

    return docs.withColumn("text", F.pandas_udf(run, "string")(F.col("text")))
