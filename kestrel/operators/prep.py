"""Split, scaling and encoding.

Fitted state (means, deviations, category lists) is a handful of driver-side
scalars per column; every row-level step is a Column expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel import schemas as SC

MAX_CATEGORIES = 10_000


# F1 -----------------------------------------------------------------------------
NULL_KEY = "\\N"
_DIGIT, _KEY_CHARS = 4, 32      # hex characters a level looks at; length of an md5


def split_hash(key_cols, seed: int = 42):
    """md5 of '<seed>:<k1>:<k2>...' as hex text: the order that decides the split.
    A null key part counts as the text \\N, so it differs from an absent one."""
    keys = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(NULL_KEY)) for c in key_cols])
    return F.md5(F.concat(F.lit(f"{seed}:"), keys))


def _row_hash(columns):
    """md5 of all columns: orders rows that share their key."""
    return F.md5(F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns]), {"ignoreNullFields": "false"}))


def stratified_split(df: DataFrame, label_col: str, key_cols, test_size: float = 0.2,
                     seed: int = 42, out_col: str = "split", hash_col: str | None = None) -> DataFrame:
    """Stratified split: per class, the round(test_size * n) rows with the
    smallest md5('<seed>:<key>') are 'test', the rest 'train'. Rows that share a
    key are ordered by an md5 of the whole row; fully identical rows are
    interchangeable and are split by count. Rows without a label are 'train'.

    No sort and no per-class row window: hashes are uniform, so a count per
    (class, first 16 bits) names the bucket in which a class's cut lies, and
    only that bucket is counted again by the next 16 bits, until it is cut
    cleanly or holds identical rows only. Two levels suffice up to billions of
    rows with unique keys. One row per class reaches the driver a level.

    ``hash_col`` names a column that holds ``split_hash`` already, written with the
    rows, so that no pass computes it again; the result is without it.
    """
    names = [c for c in df.columns if c != hash_col]
    keyed = df.select(*[F.col(f"`{c}`") for c in names], (split_hash(key_cols, seed) if hash_col is None else F.col(hash_col)).alias("__h"))
    cuts: dict = {}                 # class -> (prefix, rows of it that are test, rows of it)
    open_: dict | None = None       # class -> (prefix, rows wanted of it)
    for level in range(2 * _KEY_CHARS // _DIGIT):
        if level * _DIGIT == _KEY_CHARS:
            keyed = keyed.withColumn("__h", F.concat("__h", _row_hash(names)))
        if open_ is None:
            part, wanted = keyed.where(F.col(label_col).isNotNull()), None
        else:
            at, wanted = F.lit(False), F.lit(None).cast("bigint")
            for c, (prefix, want) in open_.items():
                here = (F.col(label_col) == F.lit(c)) & F.col("__h").startswith(prefix)
                at = at | F.coalesce(here, F.lit(False))
                wanted = F.when(F.col(label_col) == F.lit(c), F.lit(want)).otherwise(wanted)
            part = keyed.where(at)
        bucket = F.substring("__h", 1, (level + 1) * _DIGIT).alias("prefix")
        counts = part.groupBy(label_col, bucket).agg(F.count("*").alias("rows"))
        per = Window.partitionBy(label_col)
        upto = F.sum("rows").over(per.orderBy("prefix").rowsBetween(Window.unboundedPreceding, 0))
        if wanted is None:
            wanted = F.floor(F.lit(float(test_size)) * F.sum("rows").over(per) + 0.5)
        cut = (counts.select(label_col, "prefix", "rows", upto.alias("upto"), wanted.alias("want"))
               .where((F.col("want") > 0) & (F.col("upto") >= F.col("want")))
               .groupBy(label_col).agg(F.min(F.struct("prefix", "rows", "upto", "want")).alias("x"))
               .select(label_col, "x.*").collect())
        open_ = {}
        for r in cut:
            inside = r["want"] - (r["upto"] - r["rows"])
            if inside == r["rows"]:
                cuts[r[label_col]] = (r["prefix"], None, None)
            else:
                open_[r[label_col]] = (r["prefix"], inside)
        if not open_:
            break
    test, tied = F.lit(False), F.lit(False)
    for c, (prefix, _, _) in cuts.items():
        test = test | ((F.col(label_col) == F.lit(c)) & (F.substring("__h", 1, len(prefix)) <= F.lit(prefix)))
    for c, (prefix, _) in open_.items():
        in_c = F.col(label_col) == F.lit(c)
        test = test | (in_c & (F.col("__h") < F.lit(prefix)))
        tied = tied | (in_c & (F.col("__h") == F.lit(prefix)))
    side = F.when(F.coalesce(test, F.lit(False)), "test").otherwise("train").alias(out_col)
    columns = [F.col(f"`{c}`") for c in names]
    if not open_:
        return keyed.select(*columns, side)
    # Identical rows across a cut: one row per group with its count, expanded
    # again in chunks spread over tasks; the first copies are 'test'.
    tied = F.coalesce(tied, F.lit(False))
    need = F.lit(0).cast("bigint")
    for c, (_, inside) in open_.items():
        need = F.when(F.col(label_col) == F.lit(c), F.lit(inside)).otherwise(need)
    groups = keyed.where(tied).groupBy(*names).agg(F.count("*").alias("__copies")).withColumn("__need", need)
    rows = expand_copies(groups, names)
    taken = F.when(F.col("copy") < F.col("__need"), "test").otherwise("train").alias(out_col)
    return keyed.where(~tied).select(*columns, side).unionByName(rows.select(*columns, taken))


COPY_CHUNK = 10_000


def expand_copies(rows: DataFrame, key_cols, chunk: int = COPY_CHUNK) -> DataFrame:
    """One row per (row, copy) for copy in 0..__copies-1. A row with many copies
    is first cut into chunks of ``chunk`` copies that are spread over tasks, so
    no task expands one row alone."""
    rows = rows.where(F.col("__copies") > 0)     # sequence(0, -1) would yield [0, -1]
    n_chunks = F.ceil(F.col("__copies") / F.lit(chunk)).cast("int")
    parts = rows.select("*", F.explode(F.sequence(F.lit(0), n_chunks - 1)).alias("__c"))
    if (rows.agg(F.max("__copies")).first()[0] or 0) > chunk:
        parts = parts.repartition(*[F.col(f"`{c}`") for c in key_cols], "__c")
    size = F.least(F.lit(chunk), F.col("__copies") - F.col("__c") * chunk).cast("int")
    return (parts.select("*", F.explode(F.sequence(F.lit(0), size - 1)).alias("__j"))
            .withColumn("copy", F.col("__c") * chunk + F.col("__j"))
            .drop("__c", "__j", "__copies"))


# F2 -----------------------------------------------------------------------------
@dataclass
class ScalerModel:
    means: dict
    stds: dict

    def transform(self, df: DataFrame, prefix: str = "", keep=()) -> DataFrame:
        cols = {}
        for c in self.means:
            m, s = self.means[c], self.stds[c]
            x = F.col(c).cast("double")
            cols[prefix + c] = (x - F.lit(m)) / F.lit(s) if m is not None else F.lit(None).cast("double")
        if prefix:
            return df.select(*keep, *[v.alias(k) for k, v in cols.items()])
        return df.withColumns(cols)


def fit_standard_scaler(train: DataFrame, cols) -> ScalerModel:
    """mean and population deviation per column (scikit-learn's
    StandardScaler); a zero deviation is taken as 1. One aggregate pass."""
    if not cols:
        return ScalerModel({}, {})
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"m{i}"), F.stddev_pop(x).alias(f"s{i}")]
    row = train.agg(*aggs).first()
    means, stds = {}, {}
    for i, c in enumerate(cols):
        means[c] = row[f"m{i}"]
        s = row[f"s{i}"]
        stds[c] = 1.0 if s is None or s == 0 or math.isnan(s) else s
    return ScalerModel(means, stds)


# F3 / F4 ------------------------------------------------------------------------
@dataclass
class OneHotModel:
    categories: dict  # column -> sorted list of values seen in training

    def transform(self, df: DataFrame, prefix: str = "", drop: bool = True, keep=None) -> DataFrame:
        cols = {}
        for c, values in self.categories.items():
            for v in values:
                cols[f"{prefix}{c}_{v}"] = F.when(F.col(c) == F.lit(v), 1.0).otherwise(0.0)
        if keep is not None:
            return df.select(*keep, *[v.alias(k) for k, v in cols.items()])
        out = df.withColumns(cols)
        return out.drop(*self.categories) if drop else out


class TooManyCategories(ValueError):
    """A text column has more values than should become columns."""


def fit_one_hot(train: DataFrame, cols, max_categories: int = MAX_CATEGORIES) -> OneHotModel:
    """the sorted distinct non-null values per column. Values not seen
    here (and NULL) encode as all zeros. Raises ``TooManyCategories`` when a column
    has more than ``max_categories`` values; ``operators.sparse`` has no such limit."""
    cats = {}
    for c in cols:
        d = train.where(F.col(c).isNotNull()).select(c).distinct()
        vals = [r[0] for r in d.limit(max_categories + 1).collect()]
        if len(vals) > max_categories:
            raise TooManyCategories(f"{c} has more than {max_categories} categories; use fit_sparse_transformer")
        cats[c] = sorted(vals)
    return OneHotModel(cats)


def encode_categorical_features(df: DataFrame, cols) -> DataFrame:
    """wide one-hot columns ``<col>_<value>`` (0/1); originals dropped."""
    model = fit_one_hot(df, cols)
    out = model.transform(df, drop=True)
    return out.withColumns({k: F.col(k).cast("int") for c, vs in model.categories.items()
                            for k in [f"{c}_{v}" for v in vs]})


def one_hot_vector_pipeline(cols, output_col: str = "cat_features") -> Pipeline:
    """F3 for Spark ML: StringIndexer (alphabetical, unseen/NULL kept as an extra
    index) + OneHotEncoder (dropLast), so unseen values and NULL give zeros."""
    idx = [StringIndexer(inputCol=c, outputCol=f"{c}__idx", handleInvalid="keep",
                         stringOrderType="alphabetAsc") for c in cols]
    enc = OneHotEncoder(inputCols=[f"{c}__idx" for c in cols],
                        outputCols=[f"{c}__vec" for c in cols], dropLast=True, handleInvalid="keep")
    asm = VectorAssembler(inputCols=[f"{c}__vec" for c in cols], outputCol=output_col)
    return Pipeline(stages=[*idx, enc, asm])


# F5 -----------------------------------------------------------------------------
@dataclass
class ColumnTransformerModel:
    scaler: ScalerModel
    encoder: OneHotModel

    @property
    def feature_names(self) -> list[str]:
        return ([f"scaler__{c}" for c in self.scaler.means]
                + [f"encoder__{c}_{v}" for c, vs in self.encoder.categories.items() for v in vs])

    def transform(self, df: DataFrame, keep=()) -> DataFrame:
        cols = []
        for c in self.scaler.means:
            m, s = self.scaler.means[c], self.scaler.stds[c]
            x = F.col(c).cast("double")
            e = (x - F.lit(m)) / F.lit(s) if m is not None else F.lit(None).cast("double")
            cols.append(e.alias(f"scaler__{c}"))
        for c, vs in self.encoder.categories.items():
            for v in vs:
                cols.append(F.when(F.col(c) == F.lit(v), 1.0).otherwise(0.0)
                            .alias(f"encoder__{c}_{v}"))
        return df.select(*keep, *cols)


def fit_column_transformer(train: DataFrame, drop=(), max_categories: int = MAX_CATEGORIES) -> ColumnTransformerModel:
    """numeric columns scaled, text columns one-hot encoded, the rest
    (and ``drop``) left out; names ``scaler__x`` and ``encoder__c_v``."""
    num = SC.numeric_columns(train, exclude=set(drop))
    cat = SC.string_columns(train, exclude=set(drop))
    return ColumnTransformerModel(fit_standard_scaler(train, num), fit_one_hot(train, cat, max_categories))


# F8 -----------------------------------------------------------------------------
def class_shares(df: DataFrame, label_col: str = "class") -> DataFrame:
    """Rows and normalized share per class (the total is a window over the
    few class rows, not over the data)."""
    from pyspark.sql import Window
    counts = df.groupBy(label_col).agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))
