import os
import tempfile

from tessera.operators import KMeans, KNeighborsRegressor
from tessera.streaming import parquet_stream, score_stream, write_batches


def test_stream_scoring_matches_batch(spark):
    root = tempfile.mkdtemp(prefix="tessera-stream-")
    src = os.path.join(root, "src")
    rows = [(i, float(i % 7), float((i * 5) % 11)) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, a double, b double")
    df.repartition(3).write.parquet(src)
    model = KMeans(3, 50, 1e-9).fit(df, ["a", "b"], seed=7)
    batch = {r["id"]: r["cluster"] for r in model.predict(df, ["a", "b"]).collect()}

    stream = parquet_stream(spark, src, df.schema)
    q = score_stream(stream, model, ["a", "b"]).writeStream.format("memory").queryName("km_scores").start()
    q.processAllAvailable()
    q.stop()
    streamed = {r["id"]: r["cluster"] for r in spark.sql("SELECT id, cluster FROM km_scores").collect()}
    assert streamed == batch

    knn = KNeighborsRegressor(2).fit(df.withColumn("y", df.a + df.b), ["a", "b"], "y")
    out = os.path.join(root, "knn")
    q = write_batches(
        parquet_stream(spark, src, df.schema),
        lambda b: knn.predict(b, ["a", "b"], validate=False),
        out,
        "knn_scores",
        checkpoint=os.path.join(root, "ckpt"),
        trigger_once=True,
    )
    q.awaitTermination(120)
    got = {r["query_id"]: r["prediction"] for r in spark.read.parquet(out).collect()}
    want = {r["query_id"]: r["prediction"] for r in knn.predict(df, ["a", "b"]).collect()}
    assert got == want


def test_file_sink_and_checkpoint_dir(spark):
    from tessera.operators import LinearRegression
    from tessera.session import ensure_checkpoint_dir
    from tessera.streaming import checkpoint_location, write_scores

    folder = ensure_checkpoint_dir(spark)
    assert folder and spark.sparkContext.getCheckpointDir()
    assert ensure_checkpoint_dir(spark) == folder  # reads the session's setting, never replaces it
    assert checkpoint_location(spark, "x").endswith("/streams/x")
    root = tempfile.mkdtemp(prefix="tessera-sink-")
    src = os.path.join(root, "src")
    df = spark.createDataFrame([(i, float(i), 2.0 * i + 1) for i in range(20)], "id long, a double, y double")
    df.write.parquet(src)
    model = LinearRegression(0.01, 200).fit(df, ["a"], "y")
    scored = score_stream(parquet_stream(spark, src, df.schema), model, ["a"])
    q = write_scores(scored, os.path.join(root, "out"), "lin_scores", checkpoint=os.path.join(root, "ck"), trigger_once=True)
    q.awaitTermination(120)
    got = {r["id"]: r["prediction"] for r in spark.read.parquet(os.path.join(root, "out")).collect()}
    want = {r["id"]: r["prediction"] for r in model.predict(df, ["a"]).collect()}
    assert got == want


def test_transform_models_on_a_stream(spark):
    from tessera.operators import PCA, Standardiser

    root = tempfile.mkdtemp(prefix="tessera-pca-")
    src = os.path.join(root, "src")
    df = spark.createDataFrame([(i, float(i), float(i * i % 7)) for i in range(30)], "id long, a double, b double")
    df.write.parquet(src)
    for model, col in ((PCA(2).fit(df, ["a", "b"]), "pc1"), (Standardiser().fit(df, ["a", "b"]), "a")):
        batch = {r["id"]: r[col] for r in model.transform(df, ["a", "b"]).collect()}
        name = f"scores_{col}"
        q = score_stream(parquet_stream(spark, src, df.schema), model, ["a", "b"]).writeStream.format("memory").queryName(name).start()
        q.processAllAvailable()
        q.stop()
        assert {r["id"]: r[col] for r in spark.sql(f"SELECT * FROM {name}").collect()} == batch
