import os

from curlew.streaming.projections import curate_stream, read_documents_stream

SF = "/root/testdata/sf0.001"


def test_stream_projection_matches_batch(spark, tmp_path):
    s = curate_stream(read_documents_stream(spark, SF))
    q = s.writeStream.format("memory").queryName("curated_stream") \
        .option("checkpointLocation", os.path.join(str(tmp_path), "ck")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = spark.sql("select count(*) c, sum(n_bits) b from curated_stream").first()
    batch = curate_stream(spark.read.parquet(f"{SF}/documents.parquet"))
    want = batch.selectExpr("count(*) c", "sum(n_bits) b").first()
    assert (got.c, got.b) == (want.c, want.b)
