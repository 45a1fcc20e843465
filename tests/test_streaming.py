from lexiforge.operators import chunking as C
from lexiforge.streaming import documents as S

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def test_micro_batches_give_the_batch_result(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs.repartition(4).write.parquet(str(tmp_path / "in"))
    chunk = lambda df: C.chunk_documents(df)
    stream = S.landing(spark, str(tmp_path / "in"), DOCS, files_per_batch=2)
    S.each_batch(stream, chunk, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).drop("batch")
    assert sorted(map(str, got.collect())) == sorted(map(str, chunk(docs).select(got.columns).collect()))
    # nothing new, nothing twice
    S.each_batch(stream, chunk, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == got.count()


def test_profiles_and_windows(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs.write.parquet(str(tmp_path / "in"))
    q = S.profiles(S.landing(spark, str(tmp_path / "in"), DOCS)).writeStream.format("memory").queryName("profiles").start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("profiles").count() == docs.count()
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.coalesce(1).sortWithinPartitions("ts").write.parquet(str(tmp_path / "events"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "events"))
    q = S.event_counts(stream).writeStream.format("memory").queryName("counts").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("counts").agg({"n": "sum"}).first()[0] == events.count()
