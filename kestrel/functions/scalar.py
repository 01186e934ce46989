"""Scalar column functions (X1-X16), all native Spark expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text tokens read as missing, and the gap diagnosis labels.
NULL_TOKENS = ("nan", "None", "", "NULL", "NA")
GAP_HIGH = 0.10
GAP_LOW = 0.03
GAP_LABELS = ("posible overfitting", "sin brecha fuerte", "brecha moderada")
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# X1, X2
def upper(c: Column | str) -> Column:
    return F.upper(_c(c))


def trim(c: Column | str) -> Column:
    return F.trim(_c(c))


# X3
def nullify_tokens(c: Column | str, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    """Text values equal to one of ``tokens`` become NULL."""
    c = _c(c)
    return F.when(c.isin(*tokens), F.lit(None).cast("string")).otherwise(c)


def map_values(c: Column | str, mapping: Mapping, default=None) -> Column:
    """Dictionary lookup with a default for keys not in the mapping."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    out = m[_c(c)]
    return F.coalesce(out, F.lit(default)) if default is not None else out


# X4
def to_text(c: Column | str) -> Column:
    """Cast to string; NULL stays NULL (pandas would write 'nan')."""
    return _c(c).cast("string")


# X5
def fmt3(c: Column | str) -> Column:
    """Number with 3 decimals as text; NULL stays NULL."""
    c = _c(c)
    return F.when(c.isNotNull(), F.format_string("%.3f", c))


def join_parts(*parts: Column, sep: str = " | ") -> Column:
    """Join text parts with ``sep``, skipping NULL parts."""
    return F.concat_ws(sep, *parts)


# X6, X7
def epoch_seconds_to_ts(c: Column | str) -> Column:
    return F.timestamp_seconds(_c(c))


def text_to_ts(c: Column | str, fmt: str | None = None) -> Column:
    """Parse text to timestamp; unparseable text gives NULL (no ANSI error)."""
    c = _c(c)
    return F.try_to_timestamp(c, F.lit(fmt)) if fmt else F.try_to_timestamp(c)


# X8
def date_parts(c: Column | str, prefix: str) -> list[Column]:
    """year, month, day, weekday (Monday = 0) as int columns."""
    c = _c(c)
    return [F.year(c).alias(f"{prefix}_year"), F.month(c).alias(f"{prefix}_month"),
            F.dayofmonth(c).alias(f"{prefix}_day"), F.weekday(c).alias(f"{prefix}_dow")]


# X9
def now_iso() -> Column:
    return F.date_format(F.current_timestamp(), ISO_SECONDS)


# X10, X11, X12, X13
def ratio_plus_one(a: Column | str, b: Column | str) -> Column:
    """``a / (b + 1)``; division by zero gives NULL instead of an ANSI error."""
    return F.try_divide(_c(a).cast("double"), _c(b).cast("double") + 1)


def product(a: Column | str, b: Column | str) -> Column:
    return _c(a).cast("double") * _c(b).cast("double")


def difference(a: Column | str, b: Column | str) -> Column:
    return _c(a).cast("double") - _c(b).cast("double")


def log1p(c: Column | str) -> Column:
    return F.log1p(_c(c).cast("double"))


def round_to(c: Column | str, digits: int = 2) -> Column:
    return F.round(_c(c), digits)


# X14
def choose(cond: Column, a, b) -> Column:
    return F.when(cond, a).otherwise(b)


# X15
def gap_diagnosis(c: Column | str) -> Column:
    """>= 0.10 overfitting, <= 0.03 no strong gap, else moderate (NULL stays NULL)."""
    c = _c(c)
    return (F.when(c >= GAP_HIGH, F.lit(GAP_LABELS[0]))
            .when(c <= GAP_LOW, F.lit(GAP_LABELS[1]))
            .when(c.isNotNull(), F.lit(GAP_LABELS[2])))


# X16
def ordered_list_text(order: Column | str, value: Column | str) -> Column:
    """Aggregate: values ordered by ``order`` as a JSON-style list text ``[1, 0, 1]``."""
    s = F.array_sort(F.collect_list(F.struct(_c(order).alias("o"), _c(value).alias("v"))))
    return F.concat(F.lit("["), F.concat_ws(", ", F.transform(s, lambda e: e["v"].cast("string"))), F.lit("]"))
