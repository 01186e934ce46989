import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from kestrel.llm import conversation_repair as c

SCHEMA = "conv_id long, turn long, role string, text string, row long, cost long, audit string, p int, first long, part int, digest string"
KINDS = "xsuaoSUAO"


def plain(pattern):
    """Every edit of every row with up to two inserted turns at each place:
    (cost, audit) of the cheapest."""
    best = None
    places = list(itertools.product(*[range(3)] * (len(pattern) + 1)))
    for edits in itertools.product("KRD", repeat=len(pattern)):
        if any(k == "x" and e != "D" for k, e in zip(pattern, edits)):
            continue
        cost = sum({"K": 0, "R": 1, "D": 2}[e] + 5 * (e != "D" and k.isupper()) for k, e in zip(pattern, edits))
        if best is not None and cost > best[0]:
            continue
        for inserts in places:
            total = cost + 5 * sum(inserts)
            if best is not None and total > best[0]:
                continue
            audit, shape = "", ""
            for i, n in enumerate(inserts):
                audit, shape = audit + "I" * n, shape + "." * n
                if i < len(pattern):
                    e = edits[i]
                    audit += e
                    shape += {"K": pattern[i].lower(), "R": ".", "D": ""}[e]
            # a free place is u or a
            if re.fullmatch(r"(s?([u.][a.])+)?", shape) and (best is None or (total, audit) < best):
                best = total, audit
    return best


def test_every_short_pattern_against_enumeration():
    for n in range(4):
        for pattern in itertools.product(KINDS, repeat=n):
            p = "".join(pattern)
            assert c.parse(p) == plain(p), p


def chart(pattern):
    """CYK over all cuts of the whole row of cells, nothing remembered."""
    n = len(pattern)
    if not n:
        return c.cheapest(c.NOTHING)
    cell = {(i, i + 1): c.row_cells(k) for i, k in enumerate(pattern)}
    for length in range(2, n + 1):
        for i in range(n - length + 1):
            out = {}
            for cut in range(i + 1, i + length):
                c.combine(cell[i, cut], cell[cut, i + length], out)
            cell[i, i + length] = out
    return c.cheapest(cell[0, n])


@pytest.mark.parametrize("seed", range(8))
def test_blocks_equal_the_whole_chart(seed):
    r = random.Random(seed)
    for n in (5, 16, 17, 33, 40):
        p = "".join(r.choice("uauauauaxsoUA") for _ in range(n))
        assert c.parse(p) == chart(p)


def hurt(rows):
    out = []
    for i, t, role, text in rows:
        key = f"{' ' if i is None else i}:{' ' if t is None else t}"
        h = zlib.crc32(key.encode()) % 20
        role, text = role if role is not None else " ", text if text is not None else " "
        if h:
            row = (i, t, "user" if h == 4 else role, "" if h == 1 else re.sub(r"[.!?]", "", text) if h == 2 else text)
            out += [row] * (2 if h == 3 else 1)
    return out


def brute(original, rows):
    out = []
    for conv in {r[0] for r in original}:
        mine = sorted((r for r in rows if r[0] == conv),
                      key=lambda r: (r[1] is not None, r[1], r[2], hashlib.md5(r[3].encode()).hexdigest()))
        seen, pattern, n = set(), "", {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, _, role, text in mine:
            shown = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not shown else "duplicate" if (role, text) in seen else "" if shown[-1] in ".!?" else "truncated"
            seen.add((role, text))
            if fault:
                n[fault] += 1
            k = role[:1] if role[:1] in ("s", "u", "a") else "o"
            pattern += "x" if fault in ("blank", "duplicate") else k.upper() if fault else k
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        turns = [r[1] for r in mine if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        cost, audit = chart(pattern)
        lines, at, rest = [], 0, iter(mine)
        shape = []
        for e in audit:
            row = next(rest) if e != "I" else None
            if e != "D":
                shape.append((e, row))
        first_pair = 1 if shape and shape[0][0] == "K" and shape[0][1][2][0] == "s" else 0
        for at, (e, row) in enumerate(shape):
            role = row[2] if e == "K" else ("user", "assistant")[(at - first_pair) % 2]
            lines.append(f"{role}:{row[3] if row else ''}")
        out.append((conv, gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "a", 3, 4, 5, "d") for r in rows], SCHEMA)


def by_key(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: (r[0] is None, r[0]))


def talk(n=60, seed=3):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        system = r.random() < 0.3
        for t in range(r.choice((0, 1, 2, 3, 6, 9, 40))):
            role = "system" if system and t == 0 else ("user", "assistant")[(t - system) % 2]
            role = r.choice((role,) * 12 + ("user", "assistant", "tool", "", "system", None))
            text = r.choice((f"text {r.random()}.",) * 8 + ("same.", "cut off", "", " \t", None, "end! \n", "é中\U0001F600?"))
            rows.append((i, r.choice((t,) * 15 + (None, t + 1)), role, text))
    rows += rows[5:9]
    rows += [(None, 0, "user", "hi."), (None, None, "assistant", "yes."), (None, 3, None, None), (900, None, "user", "a."), (900, None, "assistant", "b."),
             (901, 5, "user", "x" * 200_000 + "."), (901, 6, "assistant", "again and again. " * 5000)]
    return rows


def test_report_against_brute_force(spark):
    rows = talk()
    docs = frame(spark, rows)
    got = c.report(docs, c.damage(docs)).collect()
    assert by_key(got) == by_key(brute(rows, hurt(rows)))


def test_damage(spark):
    rows = talk(20, 4)
    got = c.damage(frame(spark, rows)).collect()
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(hurt(rows), key=key)


def test_one_conversation_over_many_tasks(spark):
    r = random.Random(9)
    rows = [(1, t, ("user", "assistant")[t % 2] if r.random() < 0.9 else "user", r.choice((f"t {t}.",) * 6 + ("same.", "", f"cut {t}")))
            for t in range(3000)] + [(2, 0, "user", "a."), (2, 1, "assistant", "b.")]
    docs = frame(spark, rows)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        _over_many_tasks(docs)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def _over_many_tasks(docs):
    fault = c.faults(c.prepared(docs))
    parts = fault.repartitionByRange("row").select(F.spark_partition_id().alias("p"), "conv_id").where("conv_id = 1").distinct().count()
    assert parts > 1
    pattern = {r.row: r for r in fault.collect()}
    text = "".join("x" if x.fault in ("blank", "duplicate") else x.initial.upper() if x.fault else x.initial for _, x in sorted(pattern.items()) if x.conv_id == 1)
    got = {r.conv_id: r for r in c.audits(docs).collect()}
    assert (got[1].cost, got[1].audit) == c.parse(text) and got[1].n == 3000
    assert (got[2].cost, got[2].audit) == (0, "KK")


def test_repaired_rows_follow_the_grammar(spark):
    rows = talk(40, 5)
    _, turns = c.repair(frame(spark, rows))
    by = {}
    for r in turns.collect():
        by.setdefault(r.conv_id, []).append(r)
    for conv in by.values():
        conv.sort(key=lambda r: r.position)
        assert [r.position for r in conv] == list(range(len(conv)))
        assert re.fullmatch("s?(ua)+", "".join(r.role[0] for r in conv))


def test_empty_table(spark):
    docs = frame(spark, [])
    assert c.report(docs, c.damage(docs)).count() == 0


def test_conversation_that_loses_every_row(spark):
    conv = next(i for i in range(500) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    docs = frame(spark, [(conv, 0, "user", "gone.")])
    assert tuple(c.report(docs, c.damage(docs)).first()) == (conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
