"""Conversation structure repair by weighted CYK interval parsing (operator 12).

A repaired conversation has the role initials ``(s?(ua)+)?``. Its rows are
kept (0), given the other role (1) or deleted (2; required for blank and
repeated rows), empty turns are inserted anywhere (5), and a truncated row
that isn't deleted adds 5. Of the cheapest repairs the one with the least
audit string (a letter an edit: K, R, D, I) is taken.

Repair grammar, in Chomsky normal form. Its nonterminals are the fragments
[p, q] of a sentence that lead from point p to point q of ``POINTS``; every
binary rule is [p, q] -> [p, r] [r, q], a row derives the fragments its edits
allow, and the insertion closure puts what inserted turns alone derive around
every cell. A span's cells hold the minimum (cost, audit) of each fragment,
and spans are combined bottom-up by length, over all cuts, within blocks of
``WIDTH`` rows. Cells of equal row patterns are equal and are remembered,
a bounded number of them, by each Python worker.

Because fragments are closed under cutting, a longer conversation needs no cut
inside its blocks: neighbouring blocks are combined pairwise, span length
doubling, first by the tasks that hold the rows (in global order, so a
conversation of any size is dealt over many tasks), then across tasks, where
one row of cells a task is left of it. Two minimal strings of one span can't be
a prefix of each other (the difference would be inserted turns, which cost),
so least audits combine to least audits.

Order within a conversation: by turn (nulls first), then role, then the MD5
of the text; rows equal in all are interchangeable. Repaired rows come out of
a task that reads a conversation in order, row by row, after its audit.

Defined cases: null roles and texts are one space (so such a text is blank and
such a role must change); an empty role has no initial; a null conv_id is a
conversation of its own; turns may repeat or be null; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm.text import SPACE_CHARS
from kestrel.operators.ordered import global_row_number
from kestrel.storage import materialize

RETYPE, DELETE, INSERT, CUT_OFF = 1, 2, 5, 5
WIDTH = 16
MAX_PATTERNS = 30_000

START, SYSTEM, USER, PAIR = POINTS = range(4)
#: sentence fragments of one turn: point, initial, next point
STEPS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): PAIR, (PAIR, "u"): USER}
ENDS = (START, PAIR)
#: initial -> role that an edit can write
ROLES = {"u": "user", "a": "assistant"}

Cells = dict[tuple[int, int], tuple[int, str]]


def put(cells: Cells, at: tuple[int, int], cost: int, audit: str) -> None:
    old = cells.get(at)
    if old is None or (cost, audit) < old:
        cells[at] = cost, audit


def combine(left: Cells, right: Cells, into: Cells | None = None) -> Cells:
    """Binary rules: [p, q] -> [p, r] [r, q]."""
    out: Cells = {} if into is None else into
    for (p, r), (c, a) in left.items():
        for q in POINTS:
            other = right.get((r, q))
            if other is not None:
                cost, old = c + other[0], out.get((p, q))
                if old is None or cost < old[0] or (cost == old[0] and a + other[1] < old[1]):
                    out[p, q] = cost, a + other[1]
    return out


def _inserted() -> Cells:
    """What inserted turns alone derive: the cells of an empty span."""
    cells: Cells = {(p, p): (0, "") for p in POINTS}
    one: Cells = {}
    for (p, initial), q in STEPS.items():
        if initial in ROLES:
            put(one, (p, q), INSERT, "I")
    for _ in POINTS:
        cells = combine(cells, one, dict(cells))
    return cells


NOTHING = _inserted()


def row_cells(kind: str) -> Cells:
    """Cells of one row: ``x`` must be deleted, else its initial (``o``: no
    initial of the grammar), in capitals if the text is cut off."""
    cells: Cells = {(p, p): (DELETE, "D") for p in POINTS}
    if kind != "x":
        more = CUT_OFF if kind.isupper() else 0
        for (p, initial), q in STEPS.items():
            if initial == kind.lower():
                put(cells, (p, q), more, "K")
            if initial in ROLES:
                put(cells, (p, q), RETYPE + more, "R")
    return combine(combine(NOTHING, cells), NOTHING)


_patterns: dict[str, Cells] = {}


def block_cells(pattern: str) -> Cells:
    """Cells of a block of rows: all its spans by rising length, each over all
    cuts."""
    if len(_patterns) > MAX_PATTERNS:
        _patterns.clear()
    known = _patterns
    for length in range(1, len(pattern) + 1):
        for at in range(len(pattern) - length + 1):
            span = pattern[at:at + length]
            if span not in known:
                if length == 1:
                    known[span] = row_cells(span)
                else:
                    out: Cells = {}
                    for cut in range(1, length):
                        combine(known[span[:cut]], known[span[cut:]], out)
                    known[span] = out
    return known[pattern]


class Spans:
    """Cells of a growing row of blocks, neighbours of equal length combined."""

    def __init__(self):
        self.stack: list[tuple[int, Cells]] = []

    def add(self, cells: Cells) -> None:
        size = 1
        while self.stack and self.stack[-1][0] == size:
            cells = combine(self.stack.pop()[1], cells)
            size *= 2
        self.stack.append((size, cells))

    def cells(self) -> Cells:
        return reduce(lambda right, left: combine(left, right), (c for _, c in reversed(self.stack)), NOTHING)


def parse(pattern: str) -> tuple[int, str]:
    """(cost, audit) of a whole conversation."""
    spans = Spans()
    for at in range(0, len(pattern), WIDTH):
        spans.add(block_cells(pattern[at:at + WIDTH]))
    return cheapest(spans.cells())


def cheapest(cells: Cells) -> tuple[int, str]:
    return min(cells[START, q] for q in ENDS if (START, q) in cells)


class Run:
    """Some consecutive rows of one conversation."""

    FIELDS = ("first long, n long, turns long, low long, high long, first_turn long, last_turn long, first_initial string, "
              "last_initial string, illegal long, blank long, duplicate long, truncated long")

    def __init__(self, first: int):
        self.v = {f.split()[0]: 0 for f in self.FIELDS.split(", ")}
        self.v |= {"first": first, "low": None, "high": None, "first_turn": None, "last_turn": None, "first_initial": None, "last_initial": None}
        self.pattern, self.spans = "", Spans()

    def row(self, turn: int | None, initial: str, fault: str) -> None:
        one = Run(self.v["first"])
        one.v |= {"n": 1, "turns": int(turn is not None), "low": turn, "high": turn, "first_turn": turn, "last_turn": turn,
                  "first_initial": initial, "last_initial": initial, **({fault: 1} if fault else {})}
        self._join(one.v)
        kind = initial if initial and initial in "sua" else "o"
        self.pattern += "x" if fault in ("blank", "duplicate") else kind.upper() if fault == "truncated" else kind
        if len(self.pattern) == WIDTH:
            self.spans.add(block_cells(self.pattern))
            self.pattern = ""

    def _join(self, b: dict) -> None:
        a = self.v
        if a["n"]:
            same_turn = a["last_turn"] is not None and a["last_turn"] == b["first_turn"]
            legal = a["last_initial"] + b["first_initial"] in ("su", "ua", "au")
            a["turns"] += b["turns"] - same_turn
            a["illegal"] += b["illegal"] + (not legal)
        else:
            a |= {"first_turn": b["first_turn"], "first_initial": b["first_initial"], "turns": b["turns"], "illegal": b["illegal"]}
        for f in ("n", "blank", "duplicate", "truncated"):
            a[f] += b[f]
        a["last_turn"], a["last_initial"] = b["last_turn"], b["last_initial"]
        a["low"] = min((x for x in (a["low"], b["low"]) if x is not None), default=None)
        a["high"] = max((x for x in (a["high"], b["high"]) if x is not None), default=None)

    def run(self, v: dict, cells: Cells) -> None:
        """The rows that follow, as another task left them."""
        self._join(v)
        self.spans.add(cells)

    def cells(self) -> Cells:
        if self.pattern:
            self.spans.add(block_cells(self.pattern))
            self.pattern = ""
        return self.spans.cells()


def prepared(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, digest), without nulls in role and text."""
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    return conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), F.md5(text).alias("digest"))


def faults(rows: DataFrame) -> DataFrame:
    """(row, conv_id, turn, initial, fault): global row numbers in order, and
    the first fault of each row or ''. The earliest row of equal role and text
    is found by an aggregate and comes back by row number, so no key is hot."""
    shown = F.btrim("text", F.lit(SPACE_CHARS))
    slim = rows.select("conv_id", "turn", "role", "digest", F.substring("role", 1, 1).alias("initial"), (shown == "").alias("blank"),
                       (~F.substring(shown, -1, 1).isin(".", "!", "?")).alias("cut"))
    slim = global_row_number(slim, "conv_id", "turn", "role", "digest")
    first = slim.groupBy("conv_id", "role", "digest").agg(F.min("row").alias("row")).select("row", F.lit(True).alias("is_first"))
    fault = (F.when(F.col("blank"), "blank").when(F.col("is_first").isNull(), "duplicate").when(F.col("cut"), "truncated").otherwise(""))
    return slim.join(first, "row", "left").select("row", "conv_id", "turn", "initial", fault.alias("fault"))


def audits(conversations: DataFrame) -> DataFrame:
    """A row per conversation: conv_id, n, gaps, blank, duplicate, truncated,
    illegal, cost, audit."""
    rows = faults(prepared(conversations))
    kind = rows.schema["conv_id"].dataType.simpleString()
    cells = "cells array<struct<p: int, q: int, cost: bigint, audit: string>>"
    names = [f.split()[0] for f in Run.FIELDS.split(", ")]

    def by_rows(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, conv = None, None
        for b in it:
            out = []
            for row, key, turn, initial, fault in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if run is None or key != conv:
                    if run is not None:
                        out.append((conv, run))
                    run, conv = Run(row), key
                run.row(turn, initial, fault)
            if out:
                yield _batch(out, b.schema.field("conv_id").type)
            last_type = b.schema.field("conv_id").type
        if run is not None:
            yield _batch([(conv, run)], last_type)

    def by_runs(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, conv = None, None
        for b in it:
            out = []
            for r in b.to_pylist():
                if run is None or r["conv_id"] != conv:
                    if run is not None:
                        out.append((conv, run))
                    run, conv = Run(r["first"]), r["conv_id"]
                run.run({f: r[f] for f in names}, {(c["p"], c["q"]): (c["cost"], c["audit"]) for c in r["cells"]})
            if out:
                yield _results(out, b.schema.field("conv_id").type)
            last_type = b.schema.field("conv_id").type
        if run is not None:
            yield _results([(conv, run)], last_type)

    in_order = rows.repartitionByRange("row").sortWithinPartitions("row").select("row", "conv_id", "turn", "initial", "fault")
    runs = in_order.mapInArrow(by_rows, f"conv_id {kind}, {Run.FIELDS}, {cells}")
    runs = runs.repartition("conv_id").sortWithinPartitions("conv_id", "first")
    return runs.mapInArrow(by_runs, f"conv_id {kind}, {RESULTS}")


RESULTS = "n long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _batch(runs: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    names = [f.split() for f in Run.FIELDS.split(", ")]
    types = {"long": pa.int64(), "string": pa.string()}
    cell = pa.list_(pa.struct([("p", pa.int32()), ("q", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
    cells = [[{"p": p, "q": q, "cost": c, "audit": a} for (p, q), (c, a) in r.cells().items()] for _, r in runs]
    columns = [pa.array([k for k, _ in runs], kind), *(pa.array([r.v[f] for _, r in runs], types[t]) for f, t in names), pa.array(cells, cell)]
    return pa.RecordBatch.from_arrays(columns, names=["conv_id", *(f for f, _ in names), "cells"])


def _results(runs: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    rows = []
    for key, r in runs:
        v, (cost, audit) = r.v, cheapest(r.cells())
        gaps = 0 if v["low"] is None else v["high"] - v["low"] + 1 - v["turns"]
        rows.append((key, v["n"], gaps, v["blank"], v["duplicate"], v["truncated"], v["illegal"], cost, audit))
    types = [kind, *[pa.int64()] * 7, pa.string()]
    names = ["conv_id", *(f.split()[0] for f in RESULTS.split(", "))]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


def repaired(conversations: DataFrame, found: DataFrame) -> DataFrame:
    """(conv_id, position, role, text, edit) of the repaired conversations,
    given their ``audits``. A task reads a conversation's audit, then its rows
    in order, and writes them as it goes; the rows stay in that order."""
    rows = prepared(conversations)
    kind = rows.schema["conv_id"].dataType.simpleString()
    none = F.lit(None).cast("string")
    heads = found.select("conv_id", F.lit(0).alias("part"), F.lit(None).cast("long").alias("turn"), none.alias("role"), none.alias("text"),
                         none.alias("digest"), "audit")
    both = heads.unionByName(rows.withColumns({"part": F.lit(1), "audit": none}))
    both = both.repartition("conv_id").sortWithinPartitions("conv_id", "part", "turn", "role", "digest").select("conv_id", "part", "role", "text", "audit")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, audit, at, point, position, out = None, "", 0, START, 0, []

        def turn(role: str, text: str, edit: str) -> None:
            nonlocal point, position
            out.append((conv, position, role, text, edit))
            point, position = STEPS[point, role[0]], position + 1

        def wanted() -> str:
            return ROLES["a" if point == USER else "u"]

        def inserts() -> None:
            nonlocal at
            while at < len(audit) and audit[at] == "I":
                turn(wanted(), "", "I")
                at += 1

        id_type = None
        for b in it:
            id_type = b.schema.field("conv_id").type
            for key, part, role, text, new_audit in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if part == 0:
                    inserts()
                    conv, audit, at, point, position = key, new_audit, 0, START, 0
                    continue
                inserts()
                edit = audit[at]
                at += 1
                if edit != "D":
                    turn(role if edit == "K" else wanted(), text, edit)
            if out:
                yield _turns(out, id_type)
                out.clear()
        inserts()
        if out:
            yield _turns(out, id_type)

    return both.mapInArrow(run, f"conv_id {kind}, position long, role string, text string, edit string")


def _turns(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    types = [kind, pa.int64(), pa.string(), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                                      names=["conv_id", "position", "role", "text", "edit"])


def digests(turns: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of ``repaired`` rows, in the order in which
    they come: the hash goes on from row to row, nothing is gathered."""
    kind = turns.schema["conv_id"].dataType.simpleString()

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, sha, id_type = None, None, None
        for b in it:
            id_type, out = b.schema.field("conv_id").type, []
            for key, position, role, text in zip(*(b.column(c).to_pylist() for c in ("conv_id", "position", "role", "text")), strict=True):
                if position == 0:
                    if sha is not None:
                        out.append((conv, sha.hexdigest()))
                    conv, sha = key, hashlib.sha256()
                sha.update(f"{chr(10) if position else ''}{role}:{text}".encode())
            if out:
                yield _pairs(out, id_type)
        if sha is not None:
            yield _pairs([(conv, sha.hexdigest())], id_type)

    return turns.mapInArrow(run, f"conv_id {kind}, repaired_sha256 string")


def _pairs(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], kind), pa.array([r[1] for r in rows], pa.string())],
                                      names=["conv_id", "repaired_sha256"])


def repair(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(audits, repaired rows)."""
    found = materialize(audits(conversations), "conversation-audits")
    return found, repaired(conversations, found)


def damage(conversations: DataFrame) -> DataFrame:
    """Test damage by crc32(``conv_id:turn``) mod 20: 0 drops a row, 1 empties
    it, 2 removes its sentence ends, 3 repeats it, 4 makes it the user's."""
    key = F.concat(_or_space(F.col("conv_id")), F.lit(":"), _or_space(F.col("turn")))
    h = F.crc32(key.cast("binary")) % 20
    text = F.coalesce("text", F.lit(" "))
    d = conversations.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), text.alias("text"), h.alias("h")).where("h <> 0")
    d = d.select("conv_id", "turn", F.when(F.col("h") == 4, "user").otherwise(F.col("role")).alias("role"),
                 F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
                 F.explode(F.when(F.col("h") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
    return d.drop("copy")


def _or_space(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(" "))


def report(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """A row for every conv_id of ``conversations``: the audit of its ``rows``
    and the digest of the repaired ones."""
    found, turns = repair(rows)
    sha = digests(turns)
    ids = conversations.select(F.col("conv_id").alias("id")).distinct()
    longs = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    both = found.join(sha.withColumnRenamed("conv_id", "sha_id"), F.col("conv_id").eqNullSafe(F.col("sha_id")), "left")
    return ids.join(both, F.col("id").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("id").alias("conv_id"), *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in longs),
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
