import corpus_pipeline as P


def test_stages_keep_the_columns_and_run(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    n = docs.count()
    for _, stage in P.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, "/root/testdata/sf0.001").collect(), docs.select(*P.COLUMNS).schema)
        assert docs.columns == P.COLUMNS and 0 < docs.count() <= n
        n = docs.count()
    out = P.run(spark, "/root/testdata/sf0.001")
    assert out.count() == n and out.where("NOT round_trip").count() == 0


def test_stages_hand_few_texts_to_python_at_once(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    try:
        for given, used in (("10000", P.BATCH_ROWS), ("0", P.BATCH_ROWS), ("300", 300)):
            spark.conf.set(name, given)
            P.quality(spark, spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), "/root/testdata/sf0.001")
            assert int(spark.conf.get(name)) == used
    finally:
        spark.conf.set(name, before)
