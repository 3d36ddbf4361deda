"""Time slices of a stream's input."""

from pyspark.sql import functions as F

from kestrel.streaming import scoring as SS


def test_time_slices_run_the_input_once(spark, tmp_dir, monkeypatch):
    """each slice ran the input's joins again, in one task."""
    monkeypatch.setattr(SS, "SLICE_ROWS", 50)
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for pdf in batches:
            seen.add(len(pdf))
            yield pdf

    rows = spark.range(400).selectExpr("id event_id", "timestamp_seconds(if(id % 9 = 0, 1000, id)) purchase_time")
    SS.write_in_time_order(rows.mapInPandas(counted, rows.schema), f"{tmp_dir}/in", 4)
    assert seen.value == 400
    back = spark.read.json(f"{tmp_dir}/in")
    assert back.count() == 400 and back.select("event_id").distinct().count() == 400
    per = back.groupBy(F.input_file_name().alias("f")).agg(F.min("purchase_time").alias("lo"), F.max("purchase_time").alias("hi")).orderBy("lo").collect()
    assert len(per) >= 7 and all(a["hi"] < b["lo"] for a, b in zip(per, per[1:]))
