"""Type correction (B3-B6, B11) and cleaning.

Statistics are gathered with as few aggregate passes as possible (one pass
for all numeric columns' counts, skews and means, one for all the medians
that are needed) and applied with one ``select``. The decisions made are
kept as audit rows so the cleaning can be reported (C9).
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel import schemas as SC
from kestrel.functions.casts import epoch_micros, ip_to_int, nan_to_null, to_double, to_timestamp_utc
from kestrel.functions.stats import DIRECT_MAX, adjusted_skew, column_quantiles, exact_median

UNKNOWN = "Unknown"
DATETIME_DROP_RATE = 0.05
SKEW_LIMIT = 1.0

AUDIT_SCHEMA = "step string, column_name string, n_rows bigint, method string, fill_value double"


# Types (B3-B6, B11) -----------------------------------------------------------
def _fields(df):
    return {f.name: f.dataType for f in df.schema.fields}


def correct_data_types(df: DataFrame, dataset_type: str | None = None) -> DataFrame:
    """Cast the columns of a raw table.

    ``'ecommerce'``: the two datetimes, purchase_value and age as doubles, and
    ip_address parsed to its integer value (a dotted address is never lost).
    ``'bank'``: Time, Amount, V1..V28 as doubles. Otherwise (generic): a name
    containing 'date' or 'time' becomes a UTC timestamp; numbers stay numbers.
    Absent columns are skipped. Unparseable values become NULL.
    """
    types = _fields(df)
    casts = {}
    if dataset_type == "ecommerce":
        for c in SC.ECOM_DATETIME:
            if c in types:
                casts[c] = to_timestamp_utc(F.col(c), types[c])
        for c in SC.ECOM_NUMERIC:
            if c in types:
                casts[c] = to_double(F.col(c), types[c])
        if "ip_address" in types:
            casts["ip_address"] = ip_to_int(F.col("ip_address"), types["ip_address"])
    elif dataset_type == "bank":
        for c in SC.BANK_NUMERIC:
            if c in types:
                casts[c] = to_double(F.col(c), types[c])
    else:
        for c, t in types.items():
            if "date" in c.lower() or "time" in c.lower():
                casts[c] = to_timestamp_utc(F.col(c), t)
            elif isinstance(t, (T.FloatType, T.DoubleType)):
                casts[c] = nan_to_null(F.col(c))
    return df.withColumns(casts) if casts else df


# Pandas dtype names accepted in a cast mapping and their Spark type.
PANDAS_TYPES = {
    "datetime64[ns]": "timestamp", "datetime64": "timestamp", "datetime": "timestamp",
    "float64": "double", "float32": "float", "float": "double", "Float64": "double",
    "int64": "bigint", "int32": "int", "int": "bigint", "Int64": "bigint",
    "object": "string", "str": "string", "string": "string", "category": "string",
    "bool": "boolean",
}


def cast_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Cast by a ``{column: dtype}`` mapping (pandas or Spark type names);
    values that do not convert become NULL; absent columns are skipped."""
    types = _fields(df)
    casts = {}
    for c, name in mapping.items():
        if c not in types:
            continue
        target = PANDAS_TYPES.get(name, name)
        if target == "timestamp":
            casts[c] = to_timestamp_utc(F.col(c), types[c])
        elif target in ("double", "float"):
            casts[c] = to_double(F.col(c), types[c]).cast(target)
        elif target in ("bigint", "int"):
            x = F.col(c)
            if isinstance(types[c], T.StringType):
                x = to_double(x, types[c])
            casts[c] = x.try_cast(target)
        else:
            casts[c] = F.col(c).try_cast(target)
    return df.withColumns(casts) if casts else df


def type_report(df: DataFrame) -> DataFrame:
    """Number of columns per data type (built from the schema)."""
    counts: dict[str, int] = {}
    for f in df.schema.fields:
        counts[f.dataType.simpleString()] = counts.get(f.dataType.simpleString(), 0) + 1
    return df.sparkSession.createDataFrame(sorted(counts.items()), "dtype string, n_columns bigint")


# Missing values (C1-C4) --------------------------------------------------------
@dataclass
class CleaningReport:
    rows: list = field(default_factory=list)

    def add(self, step, column, n, method, value=None):
        self.rows.append((step, column, int(n), method,
                          None if value is None else float(value)))

    def to_df(self, spark) -> DataFrame:
        return spark.createDataFrame(self.rows, AUDIT_SCHEMA)


def impute_datetimes(df: DataFrame, columns=SC.ECOM_DATETIME,
                     drop_rate: float = DATETIME_DROP_RATE,
                     report: CleaningReport | None = None) -> DataFrame:
    """Per datetime column, in order: a null rate above ``drop_rate`` drops
    the rows, otherwise nulls take the median time. Each column's decision
    sees the rows left by the previous one.

    Two passes whatever the number of columns up to four: the first counts,
    for every column and every possible set of earlier dropped columns, the
    rows kept and the nulls among them; the decisions then follow in order
    on the driver, and the second pass computes all needed medians (each over
    the rows its column keeps)."""
    from itertools import combinations
    cols = [c for c in columns if c in df.columns]
    if not cols:
        return df
    df = df.withColumns({c: to_timestamp_utc(F.col(c), df.schema[c].dataType) for c in cols})
    if len(cols) > 4:
        for c in cols:
            df = impute_datetimes(df, [c], drop_rate, report)
        return df

    def kept(dropped):
        cond = F.lit(True)
        for d in dropped:
            cond = cond & F.col(d).isNotNull()
        return cond

    aggs, keys = [], {}
    for j, c in enumerate(cols):
        for r in range(j + 1):
            for dropped in combinations(cols[:j], r):
                i = len(keys)
                keys[(c, dropped)] = i
                aggs += [F.count_if(kept(dropped)).alias(f"n{i}"),
                         F.count_if(kept(dropped) & F.col(c).isNull()).alias(f"z{i}")]
    st = df.agg(*aggs).first()
    dropped_so_far: tuple = ()
    fills = {}
    for c in cols:
        i = keys[(c, dropped_so_far)]
        n, nulls = st[f"n{i}"], st[f"z{i}"]
        if nulls == 0 or n == 0:
            continue
        if nulls / n > drop_rate:
            if report is not None:
                report.add("datetime_drop", c, nulls, "drop")
            dropped_so_far = dropped_so_far + (c,)
        else:
            fills[c] = (nulls, n, dropped_so_far)
    # Each median is taken over the rows its column sees: those kept by the
    # drops decided before it, not by later ones.
    base = df
    if dropped_so_far:
        df = df.where(kept(dropped_so_far))
    if not fills:
        return df
    meds = {}
    if all(n <= DIRECT_MAX for _, n, _ in fills.values()):
        row = base.agg(*[F.percentile(F.when(kept(dr), epoch_micros(F.col(c))).cast("double"), 0.5)
                         .alias(c) for c, (_, _, dr) in fills.items()]).first()
        meds = {c: row[c] for c in fills}
    else:
        for c, (_, n, dr) in fills.items():
            meds[c] = exact_median(base.where(kept(dr)), epoch_micros(F.col(c)), n_upper=n)
    out = {}
    for c, (nulls, _, _) in fills.items():
        if meds[c] is None:
            continue
        us = math.floor(meds[c])
        out[c] = F.coalesce(F.col(c), F.timestamp_micros(F.lit(us)))
        if report is not None:
            report.add("datetime_fill", c, nulls, "median", us)
    return df.withColumns(out) if out else df


def impute_numeric(df: DataFrame, protect=SC.PROTECTED, skew_limit: float = SKEW_LIMIT,
                   report: CleaningReport | None = None) -> DataFrame:
    """Numeric nulls take the median when |adjusted skew| > ``skew_limit``,
    else the mean. Keys and labels in ``protect`` are left alone. Fewer than
    three values or a constant column count as not skewed; an all-null
    column stays null."""
    cols = SC.numeric_columns(df, exclude=set(protect))
    if not cols:
        return df
    aggs = [F.count("*").alias("__n")]
    for i, c in enumerate(cols):
        x = nan_to_null(F.col(c).cast("double"))
        aggs += [F.count(x).alias(f"c{i}"), adjusted_skew(x).alias(f"s{i}"),
                 F.avg(x).alias(f"m{i}")]
    st = df.agg(*aggs).first()
    n = st["__n"]
    plan = {}
    for i, c in enumerate(cols):
        nulls = n - st[f"c{i}"]
        if nulls == 0:
            continue
        sk = st[f"s{i}"]
        skewed = sk is not None and not math.isnan(sk) and abs(sk) > skew_limit
        plan[c] = ("median" if skewed else "mean", nulls, st[f"m{i}"])
    meds = [c for c, p in plan.items() if p[0] == "median"]
    if meds:
        q = column_quantiles(df, meds, [0.5], n_upper=n)
        for c in meds:
            plan[c] = ("median", plan[c][1], q[c][0])
    fills = {}
    for c, (method, nulls, value) in plan.items():
        if report is not None:
            report.add("numeric_fill", c, nulls, method, value)
        if value is None:
            continue
        fills[c] = F.coalesce(nan_to_null(F.col(c).cast("double")), F.lit(float(value)))
    return df.withColumns(fills) if fills else df


def fit_numeric_fills(df: DataFrame, protect=SC.PROTECTED, skew_limit: float = SKEW_LIMIT) -> dict:
    """C2's fill value of every numeric column, whether or not it has nulls now:
    for rows that arrive later. Columns without a value have none."""
    cols = SC.numeric_columns(df, exclude=set(protect))
    if not cols:
        return {}
    x = {c: nan_to_null(F.col(c).cast("double")) for c in cols}
    st = df.agg(*[a for i, c in enumerate(cols) for a in (adjusted_skew(x[c]).alias(f"s{i}"), F.avg(x[c]).alias(f"m{i}"))]).first()
    skews = {c: st[f"s{i}"] for i, c in enumerate(cols)}
    fills = {c: st[f"m{i}"] for i, c in enumerate(cols)}
    skewed = [c for c in cols if skews[c] is not None and not math.isnan(skews[c]) and abs(skews[c]) > skew_limit]
    if skewed:
        fills.update({c: q[0] for c, q in column_quantiles(df, skewed, [0.5]).items()})
    return {c: float(v) for c, v in fills.items() if v is not None}


def fit_datetime_fills(df: DataFrame, cols=SC.ECOM_DATETIME) -> dict:
    """The median of each datetime column in whole epoch microseconds."""
    cols = [c for c in cols if c in df.columns]
    if not cols:
        return {}
    micros = df.select(*[F.unix_micros(F.col(c).cast("timestamp")).cast("double").alias(c) for c in cols])
    return {c: math.floor(q[0]) for c, q in column_quantiles(micros, cols, [0.5]).items() if q[0] is not None}


def impute_categorical(df: DataFrame, fill: str = UNKNOWN, protect=(),
                       report: CleaningReport | None = None) -> DataFrame:
    """Text nulls become 'Unknown'."""
    cols = SC.string_columns(df, exclude=set(protect))
    if not cols:
        return df
    if report is not None:
        st = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols]).first()
        for c in cols:
            if st[c]:
                report.add("categorical_fill", c, st[c], "constant")
    return df.na.fill(fill, subset=cols)


def handle_missing_values(df: DataFrame, protect=SC.PROTECTED,
                          datetime_cols=SC.ECOM_DATETIME,
                          report: CleaningReport | None = None) -> DataFrame:
    """C4 = C1 -> C2 -> C3, each on the result of the previous step."""
    df = impute_datetimes(df, datetime_cols, report=report)
    df = impute_numeric(df, protect, report=report)
    return impute_categorical(df, report=report)


# Per-column strategies (C5) ----------------------------------------------------
def column_mode(df: DataFrame, c: str):
    """Most frequent non-null value; ties go to the smallest value."""
    top = (df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count("*").alias("__n"))
           .orderBy(F.desc("__n"), F.asc(c)).limit(1).first())
    return None if top is None else top[0]


def impute_with_strategy(df: DataFrame, strategy: str, columns) -> DataFrame:
    """``'mean'`` / ``'median'`` / ``'mode'`` fill, or ``'drop'`` the rows."""
    columns = [c for c in columns if c in df.columns]
    if not columns:
        return df
    if strategy == "drop":
        return df.na.drop(subset=columns)
    if strategy == "mean":
        st = df.agg(*[F.avg(nan_to_null(F.col(c).cast("double"))).alias(c)
                      for c in columns]).first()
        values = {c: st[c] for c in columns}
    elif strategy == "median":
        values = {c: v[0] for c, v in column_quantiles(df, columns, [0.5]).items()}
    elif strategy == "mode":
        values = {c: column_mode(df, c) for c in columns}
    else:
        raise ValueError(f"unknown strategy {strategy!r}; use mean, median, mode or drop")
    fills = {c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items() if v is not None}
    return df.withColumns(fills) if fills else df


# Duplicates (C6) ---------------------------------------------------------------
def remove_duplicates(df: DataFrame, report: CleaningReport | None = None) -> DataFrame:
    """Drop repeated rows (all columns, NULLs equal).

    A hash aggregate on all columns: duplicates collapse map-side, so even
    one value repeated across a third of the rows stays a small partial row
    per task.
    """
    out = df.dropDuplicates()
    if report is not None:
        n0, n1 = df.count(), out.count()
        report.add("duplicates", None, n0 - n1, "drop")
    return out


# Whole cleaning (C7, C8) -------------------------------------------------------
def clean_ecommerce_data(df: DataFrame, protect=SC.PROTECTED,
                         report: CleaningReport | None = None) -> DataFrame:
    """Types -> missing values -> duplicates."""
    typed = correct_data_types(df, "ecommerce")
    if report is not None and "ip_address" in df.columns:
        n_bad =(df.select(F.col("ip_address").isNotNull().alias("has"),
                           ip_to_int(F.col("ip_address"), df.schema["ip_address"].dataType)
                           .isNull().alias("bad"))
                 .agg(F.count_if(F.col("has") & F.col("bad")).alias("n")).first()["n"])
        report.add("invalid_ip", "ip_address", n_bad, "null")
    out = handle_missing_values(typed, protect, report=report)
    return remove_duplicates(out, report=report)


def clean_bank_data(df: DataFrame, protect=SC.PROTECTED,
                    report: CleaningReport | None = None) -> DataFrame:
    """The same steps for card data (no datetime columns)."""
    typed = correct_data_types(df, "bank")
    out = handle_missing_values(typed, protect, datetime_cols=(), report=report)
    return remove_duplicates(out, report=report)
