from pyspark.sql import functions as F

from storyflow.common import load
from storyflow.operators.identity import fold_clusters
from storyflow.streaming import progress as P

from .conftest import SF


def test_first_deliveries_over_two_batches(spark, tmp_path):
    rows = load(spark, SF, "pass1_progress")
    twice = tmp_path / "in"
    rows.where("ev_i % 2 = 0").coalesce(1).write.parquet(str(twice))
    run = lambda: P.write_deduplicated(P.read_progress(spark, str(twice)), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    run()
    rows.coalesce(1).write.mode("append").parquet(str(twice))
    run()
    out = spark.read.parquet(str(tmp_path / "out"))
    keys = ["run_id", "chunk_i", "ev_i"]
    assert out.count() == out.select(*keys).distinct().count() == rows.select(*keys).distinct().count()


def test_arrivals_match_batch(spark, tmp_path):
    rows = load(spark, SF, "pass1_progress")
    rows.write.parquet(str(tmp_path / "in"))
    q = P.arrivals(P.read_progress(spark, str(tmp_path / "in")), "1 day").writeStream.format("memory").queryName("arrivals").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.sql("SELECT sum(n_events) FROM arrivals").first()[0] == rows.count()


def test_stateful_fold_equals_batch(spark, tmp_path):
    data = [("r", i, m, c) for i, (m, c) in enumerate([("NEW", None), ("cluster_0001", 70), ("cluster_0002", 90), ("cluster_0002", 40), ("cluster_0003", 99), ("x", 1)])] + [("s", 0, "cluster_0001", 99)]
    cols = "run_id string, p int, match_result string, confidence_score int"
    want = sorted(tuple(r) for r in fold_clusters(spark.createDataFrame(data, cols)).collect())
    path = str(tmp_path / "d")
    for part in (data[:3], data[3:]):
        spark.createDataFrame(part, cols).coalesce(1).write.mode("append").parquet(path)
        s = P.fold_stream(spark.readStream.schema(cols).parquet(path)).writeStream.format("parquet").option("path", str(tmp_path / "o")).option("checkpointLocation", str(tmp_path / "c")).outputMode("append").trigger(availableNow=True).start()
        s.awaitTermination()
    got = sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "o")).select("run_id", "p", "cluster_id", "is_new", "low_conf").collect())
    assert got == want
    assert spark.read.parquet(str(tmp_path / "o")).where(F.col("low_conf")).count() == 1
