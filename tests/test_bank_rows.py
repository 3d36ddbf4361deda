"""The cleaned card rows are written with their split hash."""

from pyspark.sql import functions as F

from kestrel.operators import prep as PR
from kestrel.plans import jobs as PL


def _rows(spark):
    """Keys repeat and are null; one row occurs many times."""
    some = [(None if i % 13 == 0 else i // 2, str(i % 7 / 10), str(float(i % 5)), int(i % 4 == 0)) for i in range(300)]
    return spark.createDataFrame(some + [(1000, "0.5", "2.0", 1)] * 40, "k long, V1 string, Amount string, Class int")


def test_split_by_a_given_hash_is_the_split_by_the_keys(spark):
    rows = _rows(spark)
    alone = PR.stratified_split(rows, "Class", ["k"])
    given = PR.stratified_split(rows.withColumn("hash", PR.split_hash(["k"])), "Class", ["k"], hash_col="hash")
    assert given.columns == alone.columns
    assert sorted(map(str, given.collect())) == sorted(map(str, alone.collect()))


def test_passes_over_the_split_card_rows_do_not_hash_them_again(spark):
    """Every fit and statistic hashed all keys anew."""
    rows = _rows(spark)
    res = PL.run_bank_pipeline(rows, key_cols=["k"], protect=("k", "Class"), keep=["k"], balance=False, columnar=True)
    assert "md5" not in res.processed._jdf.queryExecution().optimizedPlan().toString()
    assert res.processed.columns == ["k", "Class", "split", "scaler__V1", "scaler__Amount"]
    lazy = PL.run_bank_pipeline(rows, key_cols=["k"], protect=("k", "Class"), keep=["k"], balance=False, checkpoint=False)
    near = [F.round(f"scaler__{c}", 9).alias(c) for c in ("V1", "Amount")]
    assert sorted(map(str, res.processed.select("k", "Class", "split", *near).collect())) == sorted(map(str, lazy.processed.select("k", "Class", "split", *near).collect()))
