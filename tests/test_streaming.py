import tempfile

from pyspark.sql import functions as F

from tenderlens.streaming.upsert import latest_snapshot, start_upsert_stream


def test_upsert_stream_available_now(spark):
    src = tempfile.mkdtemp(prefix="tl-src-")
    out = tempfile.mkdtemp(prefix="tl-out-") + "/coll"
    ck = tempfile.mkdtemp(prefix="tl-ck-")
    spark.createDataFrame([("k1", 1, 10), ("k2", 2, 20)], "k string, seq int, a int").write.mode("append").parquet(src)
    stream = spark.readStream.schema("k string, seq int, a int").parquet(src)
    start_upsert_stream(stream, out, ["k"], ck, order="seq").awaitTermination()
    spark.createDataFrame([("k1", 3, 11), ("k3", 4, 30)], "k string, seq int, a int").write.mode("append").parquet(src)
    start_upsert_stream(spark.readStream.schema("k string, seq int, a int").parquet(src), out, ["k"], ck,
                        order="seq").awaitTermination()
    snap = {r["k"]: r["a"] for r in latest_snapshot(spark, out, ["k"]).collect()}
    assert snap == {"k1": 11, "k2": 20, "k3": 30}
