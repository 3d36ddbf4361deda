"""Sinks, persistence, the job entry, tuning and the card stream."""

import os

from pyspark.sql import functions as F

from kestrel import schemas as SC
from kestrel.operators import prep as PR
from kestrel.plans import models as ML
from kestrel.plans import jobs as PL
from kestrel.sources import artifacts as AR
from kestrel.sources import files as FS
from kestrel.sources import testviews as TV
from kestrel.streaming import scoring as SS

SF = "/root/testdata/sf0.001"
KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
FEATS = ["Time", "V1", "V2", "V3", "V4", "Amount"]


def _bank_sets(spark):
    sp = PR.stratified_split(TV.bank_tx(spark, SF), "Class", KEYS)
    model = PR.fit_column_transformer(sp.where("split = 'train'"), drop=KEYS + ["Class", "split"])
    return model, model.transform(sp, keep=[*KEYS, "Class", "split"])


def test_write_and_read_sets(spark, tmp_dir):
    _, processed = _bank_sets(spark)
    FS.write_sets(processed, f"{tmp_dir}/sets")
    assert {"split=test", "split=train"} <= set(os.listdir(f"{tmp_dir}/sets"))
    test = FS.read_set(spark, f"{tmp_dir}/sets", "test", label_col="Class")
    assert test.columns[0] == "Class"
    assert test.count() == processed.where("split = 'test'").count()
    assert "PartitionFilters: [isnotnull(split" in test._jdf.queryExecution().executedPlan().toString()


def test_preprocessor_and_model_round_trip(spark, tmp_dir):
    model, processed = _bank_sets(spark)
    AR.save_preprocessor(spark, model, f"{tmp_dir}/pre", threshold=0.6)
    again, doc = AR.load_preprocessor(spark, f"{tmp_dir}/pre")
    assert doc["threshold"] == 0.6 and again.feature_names == model.feature_names
    train = processed.where("split = 'train'")
    lr = ML.fit(ML.logistic_regression("Class", train.count()), train, model.feature_names)
    AR.save_model(lr, f"{tmp_dir}/lr")
    a = ML.score(lr, processed, keep=KEYS).orderBy(*KEYS).collect()
    b = ML.score(AR.load_model(f"{tmp_dir}/lr"), processed, keep=KEYS).orderBy(*KEYS).collect()
    assert a == b


def test_grid_search_runs(spark):
    model, processed = _bank_sets(spark)
    train = processed.where("split = 'train'")
    cv = ML.grid_search_boosted(train, model.feature_names, "Class", folds=2,
                                grid={"maxIter": [3], "maxDepth": [2, 3]})
    assert len(cv.avgMetrics) == 2 and all(0 <= m <= 1 for m in cv.avgMetrics)


def test_train_compare_explain_save(spark, tmp_dir):
    model, processed = _bank_sets(spark)
    res = PL.train_compare_explain_save(processed.where("split = 'train'"),
                                        processed.where("split = 'test'"), model.feature_names,
                                        "Class", out_dir=f"{tmp_dir}/models", key_cols=KEYS,
                                        tune_grid={"maxIter": [3], "maxDepth": [2]}, folds=2,
                                        explain_rows=5)
    assert res["comparison"].count() == 3
    assert res["explanations"].count() > 0
    assert os.path.isdir(f"{tmp_dir}/models/random_forest")
    chosen = AR.load_json(spark, f"{tmp_dir}/models/chosen")
    assert chosen == {"model": res["best"], "threshold": res["threshold"], "features": list(model.feature_names)}
    test = processed.where("split = 'test'")
    n = res["comparison"].select(F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")).distinct().collect()
    assert [r[0] for r in n] == [test.count()]     # every test row once, equal ones too


def test_job_entry_on_csv_sources(spark, tmp_dir):
    raw = TV.tx_raw(spark, SF).select(*[f.name for f in SC.ECOM_RAW.fields])
    raw.coalesce(1).write.option("header", True).csv(f"{tmp_dir}/fraud")
    TV.ip_ranges(spark, SF).coalesce(1).write.option("header", True).csv(f"{tmp_dir}/ranges")
    bank = TV.bank_tx(spark, SF).withColumns({f"V{i}": F.lit(0.0) for i in range(5, 29)})
    bank.select(*SC.BANK_FEATURES, "Class").coalesce(1).write.option("header", True).csv(f"{tmp_dir}/card")
    PL.main([f"{tmp_dir}/fraud", f"{tmp_dir}/ranges", f"{tmp_dir}/card", f"{tmp_dir}/out"])
    for name in ("ecommerce", "bank"):
        sets = spark.read.parquet(f"{tmp_dir}/out/{name}_sets")
        assert {r.split for r in sets.select("split").distinct().collect()} == {"train", "test"}
        assert AR.load_json(spark, f"{tmp_dir}/out/{name}_preprocessor")["feature_names"]


def test_bank_stream_scores_every_record(spark, tmp_dir):
    model, processed = _bank_sets(spark)
    b = TV.bank_tx(spark, SF).limit(300)
    src = f"{tmp_dir}/card_in"
    (b.select(F.concat_ws("-", *KEYS).alias("transaction_id"), *FEATS, "Class")
     .coalesce(2).write.json(src))
    with open(f"{src}/zz-bad.json", "w") as fh:
        fh.write("{oops\n")
    scorer = SS.linear_scorer({"scaler__Amount": 0.5}, -2.0)
    q = SS.start_bank_scoring(spark, src, f"{tmp_dir}/card_out", f"{tmp_dir}/card_rej", {}, model,
                              scorer, checkpoint=f"{tmp_dir}/card_ck")
    q.awaitTermination()
    out = spark.read.parquet(f"{tmp_dir}/card_out")
    assert out.count() == 300
    assert spark.read.parquet(f"{tmp_dir}/card_rej").count() == 1
    assert {r.decision for r in out.select("decision").distinct().collect()} <= {
        "approve", "manual_review", "auto_decline"}
