"""Projections, filters, casts, imputation and outlier repair (C*, I*).

Fitted statistics (medians, modes, quartiles) are computed once, in one
aggregation, into a one-row (or one-row-per-group) table that is joined back;
no statistic is computed per column in its own job.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.functions.scalar import NULL_TOKENS, nullify_tokens
from kestrel.operators.quantiles import exact_quantiles, quantiles_long

# Fixed value: text filled into missing categorical cells by the cleanup recipe.
MISSING_TEXT = "Missing"


def _one_row_join(df: DataFrame, stats: DataFrame) -> DataFrame:
    """Attach a one-row statistics table (broadcast; size is one row)."""
    return df.join(F.broadcast(stats), F.lit(True), "left")


# C1
def strip_column_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


# C2
def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.drop(*[c for c in cols if c in df.columns])


def sparse_columns(df: DataFrame, threshold: float = 0.95) -> list[str]:
    """Columns whose null share is above ``threshold`` (one aggregation; the
    result has one value per column)."""
    row = df.agg(*[F.avg(F.col(f"`{c}`").isNull().cast("double")).alias(c) for c in df.columns]).first()
    return [c for c in df.columns if row[c] is not None and row[c] > threshold]


def drop_sparse_columns(df: DataFrame, threshold: float = 0.95) -> DataFrame:
    return df.drop(*sparse_columns(df, threshold))


# C3
def constant_columns(df: DataFrame) -> list[str]:
    """Columns with at most one distinct value counting null as a value.

    Uses min/max/null counts (one cheap pass) instead of distinct counts:
    nunique(dropna=False) <= 1  <=>  all null, or no null and min = max.
    """
    aggs = []
    for i, f in enumerate(df.schema.fields):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            continue
        aggs += [F.min(c).alias(f"mn{i}"), F.max(c).alias(f"mx{i}"), F.count_if(c.isNull()).alias(f"nn{i}")]
    row = df.agg(F.count(F.lit(1)).alias("_n"), *aggs).first()
    out = []
    for i, f in enumerate(df.schema.fields):
        if f"nn{i}" not in row.asDict():
            continue
        nn, n = row[f"nn{i}"], row["_n"]
        if nn == n or (nn == 0 and row[f"mn{i}"] == row[f"mx{i}"]):
            out.append(f.name)
    return out


def drop_constant_columns(df: DataFrame) -> DataFrame:
    return df.drop(*constant_columns(df))


# C4
def select_existing(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Wanted columns in the wanted order, skipping those that do not exist."""
    return df.select(*[c for c in wanted if c in df.columns])


# C5, C6, C7
def filter_greater(df: DataFrame, col: str, k: float) -> DataFrame:
    """Keep rows with ``col > k`` (NULL fails the test)."""
    return df.where(F.col(col) > k)


def filter_open_band(df: DataFrame, col: Column | str, lo: float, hi: float) -> DataFrame:
    c = F.col(col) if isinstance(col, str) else col
    return df.where((c > lo) & (c < hi))


def filter_target(df: DataFrame, target: str, option: str | int = "all") -> DataFrame:
    """``option`` 'all' keeps everything; 0 / 1 keep that class."""
    if option in ("all", None):
        return df
    return df.where(F.col(target) == int(option))


# C8
def coerce_target(df: DataFrame, target: str) -> DataFrame:
    """Target to number (bad text -> NULL), drop NULL rows, cast to int."""
    num = F.col(target).try_cast("double")
    return df.withColumn(target, num).where(F.col(target).isNotNull()).withColumn(
        target, F.col(target).cast("int"))


# C9
def cast_columns(df: DataFrame, numeric: Sequence[str] = (), category: Sequence[str] = (),
                 flags: Sequence[str] = ()) -> DataFrame:
    """numbers with coercion, categories (and ids) as text, flags as int."""
    m = {c: F.col(c).try_cast("double") for c in numeric}
    m.update({c: F.col(c).cast("string") for c in category})
    m.update({c: F.col(c).try_cast("double").cast("int") for c in flags})
    return df.withColumns(m)


# C11
def split_xy(df: DataFrame, target: str) -> tuple[DataFrame, DataFrame]:
    return df.drop(target), df.select(target)


def head(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """First ``n`` rows in an explicit order (top-k, not a global sort)."""
    return df.orderBy(*order).limit(n)


# C13
def with_constants(df: DataFrame, values: Mapping[str, object], first: bool = False) -> DataFrame:
    cols = [F.lit(v).alias(k) for k, v in values.items()]
    rest = [c for c in df.columns if c not in values]
    return df.select(*cols, *rest) if first else df.select(*rest, *cols)


# I1
def fill_constant(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.fillna(dict(values))


# I3
def median_stats(df: DataFrame, cols: Sequence[str], where: Column | None = None) -> DataFrame:
    """One-row table ``{col}`` = exact median of each column (optional row filter
    applied per column)."""
    src = df
    if where is not None:
        src = df.select(*[F.when(where, F.col(c)).alias(c) for c in cols])
    q = exact_quantiles(src, cols, [0.5])
    return q.groupBy().pivot("column_name", list(cols)).agg(F.first("value"))


def fill_median(df: DataFrame, cols: Sequence[str], stats: DataFrame | None = None) -> DataFrame:
    """NULL -> exact median of the column (numeric columns become double)."""
    cols = list(cols)
    if not cols:
        return df
    stats = stats if stats is not None else median_stats(df, cols)
    stats = stats.select(*[F.col(c).alias(f"_med_{c}") for c in cols])
    j = _one_row_join(df, stats)
    return j.select(*[
        F.coalesce(F.col(c).cast("double"), F.col(f"_med_{c}")).alias(c) if c in cols else F.col(c)
        for c in df.columns])


# I2
def repair_zeros(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """0 -> median of the values > 0, per column."""
    cols = list(cols)
    src = df.select(*[F.when(F.col(c) > 0, F.col(c)).alias(c) for c in cols])
    q = exact_quantiles(src, cols, [0.5])
    stats = q.groupBy().pivot("column_name", cols).agg(F.first("value"))
    stats = stats.select(*[F.col(c).alias(f"_med_{c}") for c in cols])
    j = _one_row_join(df, stats)
    return j.select(*[
        F.when(F.col(c) == 0, F.col(f"_med_{c}")).otherwise(F.col(c).cast("double")).alias(c)
        if c in cols else F.col(c) for c in df.columns])


# I4
def fill_group_median(df: DataFrame, col: str, group: str, low_to_null: float | None = 1.0) -> DataFrame:
    """Values <= ``low_to_null`` become NULL, NULLs take the median of their
    group, what is still NULL takes the global median of the group-filled
    column. Rows with a NULL group key keep their present values."""
    x = F.col(col).cast("double")
    if low_to_null is not None:
        x = F.when(x > low_to_null, x)
    base = df.withColumn(col, x)
    long = base.select(group, F.col(col).alias("x")).where(F.col("x").isNotNull() & F.col(group).isNotNull())
    gmed = quantiles_long(long, [group], "x", [0.5]).select(group, F.col("value").alias("_gmed"))
    # one row per group; sort-merge or broadcast is left to the planner
    filled = base.join(gmed, group, "left").withColumn(col, F.coalesce(F.col(col), F.col("_gmed"))).drop("_gmed")
    glob = exact_quantiles(filled, [col], [0.5]).select(F.col("value").alias("_glob"))
    out = _one_row_join(filled, glob).withColumn(col, F.coalesce(F.col(col), F.col("_glob"))).drop("_glob")
    return out.select(*df.columns)


# I5
def mode_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``column_name, mode`` (as text) per column: most frequent non-null value,
    smallest on ties (numeric order for numbers). Two aggregations with
    partial results, no per-column map in one task and no join."""
    rows = []
    num = [c for c in cols if isinstance(df.schema[c].dataType, T.NumericType)]
    txt = [c for c in cols if c not in num]
    for group, cast in ((num, "double"), (txt, "string")):
        if not group:
            continue
        long = df.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.col(c).cast(cast).alias("v")) for c in group
        ]))).where(F.col("v").isNotNull())
        vc = long.groupBy("column_name", "v").agg(F.count(F.lit(1)).alias("_n"))
        top = vc.groupBy("column_name").agg(F.min(F.struct(-F.col("_n"), "v")).alias("_top"))
        rows.append(top.select("column_name", F.col("_top.v").cast("string").alias("mode")))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def _from_text(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.NumericType):
        return c.cast("double").cast(dtype)
    return c.cast(dtype)


def fill_mode(df: DataFrame, cols: Sequence[str], stats: DataFrame | None = None) -> DataFrame:
    cols = list(cols)
    stats = stats if stats is not None else mode_stats(df, cols)
    wide = stats.groupBy().pivot("column_name", cols).agg(F.first("mode"))
    wide = wide.select(*[F.col(c).alias(f"_mode_{c}") for c in cols])
    j = _one_row_join(df, wide)
    return j.select(*[
        F.coalesce(F.col(c), _from_text(F.col(f"_mode_{c}"), df.schema[c].dataType)).alias(c)
        if c in cols else F.col(c)
        for c in df.columns])


# I7, I8
def with_overprice(df: DataFrame, cost: str, ref: str, out: str = "Sobrecosto") -> DataFrame:
    return df.withColumn(out, F.col(cost) - F.col(ref))


def recompute_age(df: DataFrame, date_col: str, year_col: str, out: str = "edad_calculada") -> DataFrame:
    return df.withColumn(out, (F.year(date_col) - F.col(year_col)).cast("int"))


# I9
def winsorize_iqr(df: DataFrame, cols: Sequence[str], k: float = 1.5) -> DataFrame:
    """Clip each column to [q1 - k*iqr, q3 + k*iqr]; NULL stays NULL."""
    cols = list(cols)
    q = exact_quantiles(df, cols, [0.25, 0.75])
    names = [f"{c}__{t}" for c in cols for t in ("q1", "q3")]
    tag = F.concat(F.col("column_name"), F.when(F.col("q") == 0.25, F.lit("__q1")).otherwise(F.lit("__q3")))
    stats = q.withColumn("_t", tag).groupBy().pivot("_t", names).agg(F.first("value"))
    j = _one_row_join(df, stats)
    out = []
    for c in df.columns:
        if c in cols:
            q1, q3 = F.col(f"{c}__q1"), F.col(f"{c}__q3")
            lo, hi = q1 - k * (q3 - q1), q3 + k * (q3 - q1)
            x = F.col(c).cast("double")
            out.append(F.when(x.isNotNull(), F.greatest(F.least(x, hi), lo)).alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out)


# C12
def basic_text_cleanup(df: DataFrame, numeric: Sequence[str], text: Sequence[str],
                       tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """Trim text, null tokens -> NULL, text NULL -> 'Missing', numeric NULL -> median."""
    stripped = strip_column_names(df)
    cleaned = stripped.withColumns({c: nullify_tokens(F.trim(F.col(c).cast("string")), tokens) for c in text})
    cleaned = cleaned.fillna({c: MISSING_TEXT for c in text})
    return fill_median(cleaned, numeric)


# D1 guard
def require_date_spread(df: DataFrame, date_col: str, min_years: int = 2) -> DataFrame:
    """Fail when the dates fall in fewer than ``min_years`` distinct years:
    the symptom of epoch seconds parsed with the wrong unit."""
    n = df.agg(F.count_distinct(F.year(date_col)).alias("n")).first()["n"]
    if n < min_years:
        raise ValueError(f"{date_col} spans {n} distinct year(s); check the epoch unit of the source")
    return df
