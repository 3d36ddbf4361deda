"""The pipeline bounds its Arrow batches before its first stage."""

import corpus_pipeline

LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def test_batches_are_bounded_from_the_first_stage_on(spark, monkeypatch):
    seen = []

    def probe(spark, docs, sf_dir):
        seen.append(spark.conf.get(LIMIT, None))
        return docs.limit(1)

    before = spark.conf.get(LIMIT, None)
    spark.conf.unset(LIMIT)
    monkeypatch.setattr(corpus_pipeline, "STAGES", [("probe", probe)])
    try:
        assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() == 1
        assert seen == ["4m"]
    finally:
        if before is not None:
            spark.conf.set(LIMIT, before)
