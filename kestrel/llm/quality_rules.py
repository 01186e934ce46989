"""Quality rules with robust multivariate outliers (operator 1).

Every document gets simple text statistics; a base rule rejects very short and
very repetitive texts. The statistics are transformed to a vector of five
numbers, and for each (lang, source) the minimum covariance determinant (MCD)
gives a robust centre and covariance; a document is rejected when its squared
Mahalanobis distance exceeds a chi-square quantile.

MCD by concentration steps: from two deterministic starts (medians with
quartile spreads; mean and covariance) each step takes the 75% of a group's
rows with the smallest distances and estimates centre and covariance on them;
the start with the smaller determinant wins. A step is one aggregation of
sums per (group, distance bin) - 2% wide bins, so the 75% is reached to within
one bin - and a running sum over a group's bins. Rows of a group are never
brought together; a group that holds a third of all rows is summed where its
rows are. Only DataFrame functions run on the executors.

Defined cases: null and empty texts have no words and fail the base rule; a
null lang or source is a group of its own; a small group's covariance leans
on the fixed target spreads (``PSEUDO_ROWS``); repeated rows are judged alike;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kestrel.llm.text import SPACE_CHARS, let, plain_words
from kestrel.storage import broadcast_if_small, materialize

SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
SPAN = 5
SUBSET = 0.75
STEPS = 5
BINS_PER_UNIT = 50.0
#: squared distance above which a document goes: chi-square with 5 degrees of freedom, upper tail 1e-6
CUTOFF = 35.9
#: words at the usual rate that are added to a text, so that short texts aren't judged by chance
PSEUDO_WORDS = 50.0
#: weight, in rows, of the target covariance
PSEUDO_ROWS = 20.0
#: target standard deviations of the vector's components, also a floor through PSEUDO_ROWS
TARGET_SD = (0.08, 0.08, 0.20, 0.20, 0.06)
FLOOR_SD = tuple(x / 2 for x in TARGET_SD)
P = len(TARGET_SD)
PAIRS = [(i, j) for i in range(P) for j in range(i + 1)]
MAX_BROADCAST_ROWS = 20_000


def repeated_words(words: Column) -> Column:
    """Number of words inside a 5-word window that the text has twice or more."""
    def from_hashes(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def starts(s: Column) -> Column:
            same = lambda x, i: F.coalesce(F.get(s, i)["h"] == x["h"], F.lit(False))
            return F.sort_array(F.transform(F.filter(s, lambda x, i: same(x, i - 1) | same(x, i + 1)), lambda x: x["i"]))

        def covered(p: Column) -> Column:
            gaps = F.transform(p, lambda x, i: F.least(F.lit(SPAN), F.coalesce(F.get(p, i + 1) - x, F.lit(SPAN))))
            return F.aggregate(gaps, F.lit(0), lambda a, x: a + x)

        once = F.size(F.array_distinct(h)) == F.size(h)
        return F.when(once, 0).otherwise(let(let(ordered, starts), covered))

    n = F.size(words)
    windows = let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: F.transform(
        F.sequence(F.lit(0), n - SPAN), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(SPAN)])))
    return F.when(n >= SPAN, let(windows, from_hashes)).otherwise(0)


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, group, the contract's counts and the further counts that the
    vector needs, over whole texts."""
    text = F.coalesce("text", F.lit(""))
    t = docs.select("doc_id", F.to_json(F.struct("lang", "source")).alias("grp"), text.alias("text"),
                    plain_words(F.col("text")).alias("words"))
    lines = let(F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(SPACE_CHARS)) != ""),
                lambda ls: F.struct(F.size(ls).alias("n"), (F.size(ls) - F.size(F.array_distinct(ls))).alias("dup")))
    without = lambda chars: F.length("text") - F.length(F.translate("text", chars, ""))
    t = t.select(
        "doc_id", "grp", F.size("words").cast("long").alias("n_words"),
        F.length(F.translate("text", SPACE_CHARS, "")).cast("long").alias("word_chars"),
        without(SYMBOLS).cast("long").alias("n_symbols"), lines.alias("lines"),
        repeated_words(F.col("words")).cast("long").alias("n_repeat_words"),
        without(UPPER).cast("long").alias("n_upper"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return t.select("doc_id", "grp", "n_words", "word_chars", "n_symbols", F.col("lines.dup").cast("long").alias("n_dup_lines"),
                    "n_repeat_words", F.col("lines.n").cast("long").alias("n_lines"), "n_upper", failed.alias("base_failed"))


def vectors(stats: DataFrame) -> DataFrame:
    """Adds x0..x4: log mean word length, and square roots of the rates of
    symbols, equal lines, repeated words and capitals."""
    rates = stats.groupBy("grp").agg(F.try_divide(F.sum("word_chars"), F.sum("n_words")).alias("g_len"),
                                     F.try_divide(F.sum("n_upper"), F.sum("word_chars")).alias("g_upper"))
    s = stats.join(broadcast_if_small(materialize(rates, "rates"), MAX_BROADCAST_ROWS), "grp")
    n = F.col("n_words") + PSEUDO_WORDS
    length = (F.col("word_chars") + PSEUDO_WORDS * F.coalesce("g_len", F.lit(1.0))) / n
    upper = (F.col("n_upper") + PSEUDO_WORDS * F.coalesce(F.col("g_upper") * F.col("g_len"), F.lit(0.0))) / (n * length)
    x = [F.log(length), F.sqrt(F.col("n_symbols") / n), F.sqrt(F.col("n_dup_lines") / (F.col("n_lines") + 5.0)),
         F.sqrt(F.col("n_repeat_words") / n), F.sqrt(upper)]
    # whole thousandths, so that sums don't depend on the order of the rows
    return s.select("*", *[F.round(c * 1000).alias(f"x{i}") for i, c in enumerate(x)]).drop("g_len", "g_upper")


def _moments() -> list[Column]:
    """Count, sums and sums of products of x0..x4."""
    return [F.count(F.lit(1)).alias("n"), *[F.sum(f"x{i}").alias(f"s{i}") for i in range(P)],
            *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"q{i}{j}") for i, j in PAIRS]]


def _estimate(m: DataFrame, keys: list[str]) -> DataFrame:
    """Centre, inverse covariance and its log determinant from the sums. The
    covariance is mixed with the target and has a floor, so it is regular."""
    mean = {i: F.col(f"s{i}") / F.col("n") / 1000 for i in range(P)}
    cov = {(i, j): (F.col(f"q{i}{j}") / F.col("n") / 1e6 - mean[i] * mean[j]) for i, j in PAIRS}
    w = F.col("n") / (F.col("n") + PSEUDO_ROWS)
    out = m.select(*keys, *[mean[i].alias(f"m{i}") for i in range(P)], *[
        (w * cov[i, j] + ((1 - w) * TARGET_SD[i] ** 2 + FLOOR_SD[i] ** 2 if i == j else F.lit(0.0))).alias(f"c{i}{j}") for i, j in PAIRS],
        F.lit(0.0).alias("logdet"))
    return _inverse(out, [*keys, *[f"m{i}" for i in range(P)]])


def _inverse(m: DataFrame, keep: list[str]) -> DataFrame:
    """c -> inverse of c by P symmetric sweeps, and the log determinant."""
    c = lambda i, j: F.col(f"c{max(i, j)}{min(i, j)}")
    for k in range(P):
        d = c(k, k)
        new = {(i, j): c(i, j) - c(i, k) * c(k, j) / d if k not in (i, j) else -1 / d if i == j else c(i, j) / d for i, j in PAIRS}
        m = m.select(*keep, *[v.alias(f"c{i}{j}") for (i, j), v in new.items()], (F.col("logdet") + F.log(d)).alias("logdet"))
    return m.select(*keep, *[(-F.col(f"c{i}{j}")).alias(f"c{i}{j}") for i, j in PAIRS], "logdet")


def _distance() -> Column:
    d = [F.col(f"x{i}") / 1000 - F.col(f"m{i}") for i in range(P)]
    return F.greatest(F.lit(0.0), sum((F.col(f"c{i}{j}") * d[i] * d[j] * (1 if i == j else 2) for i, j in PAIRS), F.lit(0.0)))


def _concentrate(rows: DataFrame, params: DataFrame) -> DataFrame:
    """One step: estimates on the nearest SUBSET of each (grp, start)."""
    d = rows.join(broadcast_if_small(params, MAX_BROADCAST_ROWS), "grp").withColumn(
        "bin", F.floor(F.log1p(_distance()) * BINS_PER_UNIT))
    bins = d.groupBy("grp", "start", "bin").agg(*_moments())
    group = Window.partitionBy("grp", "start")  # a group's bins: a few hundred rows at most
    upto = group.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    near = (bins.withColumn("all", F.sum("n").over(group)).withColumn("before", F.coalesce(F.sum("n").over(upto), F.lit(0)))
            .where(F.col("before") < F.ceil(F.col("all") * SUBSET)))
    sums = [c for c in bins.columns if c not in ("grp", "start", "bin")]
    return _estimate(near.groupBy("grp", "start").agg(*[F.sum(c).alias(c) for c in sums]), ["grp", "start"])


def chi2_cdf(x: float, k: int) -> float:
    """Chi-square distribution function, by the series of the incomplete gamma function."""
    a, y = k / 2, x / 2
    term = total = 1 / a
    for n in range(1, 500):
        term *= y / (a + n)
        total += term
    return total * math.exp(-y + a * math.log(y) - math.lgamma(a)) if x > 0 else 0.0


def consistency(subset: float = SUBSET, p: int = P) -> float:
    """Factor that makes the covariance of the nearest ``subset`` of normal rows that of all."""
    lo, hi = 0.0, 200.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi2_cdf(mid, p) < subset else (lo, mid)
    return subset / chi2_cdf(lo, p + 2)


def mcd(rows: DataFrame) -> DataFrame:
    """grp -> robust centre m*, inverse covariance c* of the rows x0..x4."""
    wide = rows.groupBy("grp").agg(
        *[F.percentile_approx(f"x{i}", F.array(*[F.lit(q) for q in (0.25, 0.5, 0.75)]), F.lit(1000)).alias(f"p{i}") for i in range(P)])
    iqr = {i: (F.col(f"p{i}")[2] - F.col(f"p{i}")[0]) / 1349 for i in range(P)}
    start0 = _inverse(wide.select("grp", F.lit(0).alias("start"), *[(F.col(f"p{i}")[1] / 1000).alias(f"m{i}") for i in range(P)], *[
        (iqr[i] * iqr[i] + FLOOR_SD[i] ** 2 if i == j else F.lit(0.0)).alias(f"c{i}{j}") for i, j in PAIRS], F.lit(0.0).alias("logdet")),
        ["grp", "start", *[f"m{i}" for i in range(P)]])
    start1 = _estimate(rows.groupBy("grp").agg(*_moments()).withColumn("start", F.lit(1)), ["grp", "start"])
    params = materialize(start0.unionByName(start1), "mcd-start")
    for step in range(STEPS):
        params = materialize(_concentrate(rows, params), f"mcd-{step}")
    cols = [c for c in params.columns if c not in ("grp", "start", "logdet")]
    best = params.groupBy("grp").agg(F.min(F.struct("logdet", "start", *cols)).alias("b"))
    return materialize(best.select("grp", *[F.col(f"b.{c}").alias(c) for c in cols]), "mcd")


def judge(docs: DataFrame) -> DataFrame:
    """The counts of every document and whether it is kept."""
    v = materialize(vectors(materialize(statistics(docs), "stats")), "vectors")
    good = v.where(~F.col("base_failed")).select("grp", *[f"x{i}" for i in range(P)])
    robust = mcd(good)
    j = v.join(broadcast_if_small(robust, MAX_BROADCAST_ROWS), "grp", "left")
    distance = _distance() / consistency()
    return j.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                    (~F.col("base_failed") & F.coalesce(distance <= CUTOFF, F.lit(False))).alias("kept"),
                    F.when(~F.col("base_failed"), F.round(distance, 6)).alias("distance"))
