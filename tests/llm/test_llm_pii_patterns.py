import random
import re
import time

from kestrel.llm import pii

#: the generators as one would write them, each place of a text tried
PLAIN = (
    (0, re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?[\[({]at[\])}] ?[A-Za-z0-9-]++(?: ?(?:[\[({]dot[\])}]|\.) ?[A-Za-z0-9-]++)+")),
    (1, re.compile(r"(?<![0-9.])[0-9]{1,4}(?:\.[0-9]{1,4}){3,5}(?![0-9])")),
    (1, re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){4,7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")),
    (2, re.compile(r"(?<![0-9])[0-9](?:[ ._-]?[0-9]){11,18}(?![0-9])")),
    (3, re.compile(r"(?<![0-9])\(?[0-9]{3}\)?[ ./-]{1,2}[0-9]{3}[ .-][0-9]{4}(?![0-9])")),
    (3, re.compile(r"(?<![0-9])00[1-9][0-9 ().-]{7,16}[0-9](?![0-9])")))
BITS = ["[at]", "(at)", "{at}", "[dot]", "(dot)", " ", ".", "a", "b1", "-", "00", "0", "12", "345", "6789", "(", ")", ":", "cafe:", "1.2.3.4", "+", "_",
        "x.com", "@", "/", "%", "\n", "é"]


def plain(text):
    return sorted({(m.start(), k, m.end()) for k, rx in PLAIN for m in rx.finditer(text)})


def test_proposals_are_those_of_the_plain_patterns():
    r = random.Random(5)
    texts = ["".join(r.choice(BITS) for _ in range(r.randint(1, 30))) for _ in range(5000)]
    assert [pii.proposals(t) for t in texts] == [plain(t) for t in texts]
    assert sum(bool(pii.proposals(t)) for t in texts) > 500


def test_prose_is_not_tried_place_by_place():
    text = "some words of plain prose without any number, " * 20_000

    def seconds(f):
        t0 = time.perf_counter()
        f(text)
        return time.perf_counter() - t0

    assert min(seconds(pii.proposals) for _ in range(3)) < 0.5 * min(seconds(plain) for _ in range(3))


def test_hints_and_luhn_as_by_the_patterns():
    r = random.Random(6)
    bits = ["Mail", "contact", "ip", "IP ", "host", "id", "no", "v", "V\n", " ", "order", "ſerial", "Kard", "é", "-", "tel", "x"]
    for _ in range(5000):
        t = "".join(r.choice(bits) for _ in range(r.randint(0, 6)))
        assert pii._hints(t) == [float(bool(h.search(t))) for h in pii._HINTS]
        d = "".join(r.choice("0123456789") for _ in range(r.randint(0, 20)))
        twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(d))]
        assert pii.luhn(d) == (sum(x - 9 if x > 9 else x for x in twice) % 10 == 0)
