"""Resume-by-key as a Structured Streaming query: each input file is handled once."""
import os

import pytest
from pyspark.sql import functions as F

from trackwise.operators import embed as E
from trackwise.operators.describe import build_prompts, describe
from trackwise.streaming import resume
from trackwise.streaming.resume import resume_stream


def test_resume_stream_processes_new_files_once(spark, tmpdir_path):
    src, out, ck = (os.path.join(tmpdir_path, x) for x in ("src", "out", "ck"))
    spark.range(0, 50).withColumnRenamed("id", "k").write.mode("append").parquet(src)
    produce = lambda d: d.withColumn("v", F.col("k") * 2)
    a = resume_stream(spark, src, "k long", "k", out, ck, produce).count()
    spark.range(40, 80).withColumnRenamed("id", "k").write.mode("append").parquet(src)
    b = resume_stream(spark, src, "k long", "k", out, ck, produce)
    assert a == 50
    assert b.count() == 80 and b.select("k").distinct().count() == 80


def test_equal_keys_of_one_batch_and_of_an_earlier_output(spark, tmpdir_path):
    src, out, ck = (os.path.join(tmpdir_path, x) for x in ("src", "out", "ck"))
    spark.range(5).withColumnRenamed("id", "k").withColumn("v", F.lit(0)).write.parquet(out)  # written before the stream
    spark.createDataFrame([(3,), (7,), (7,), (8,), (7,)], "k long").repartition(3).write.parquet(src)
    produce = lambda d: d.withColumn("v", F.lit(1))
    got = resume_stream(spark, src, "k long", "k", out, ck, produce)
    assert sorted((r.k, r.v) for r in got.collect()) == [(i, 0) for i in range(5)] + [(7, 1), (8, 1)]
    spark.createDataFrame([(4,), (8,), (9,)], "k long").write.mode("append").parquet(src)
    got = resume_stream(spark, src, "k long", "k", out, ck, produce)
    assert sorted(r.k for r in got.collect()) == [0, 1, 2, 3, 4, 7, 8, 9]


def test_crash_after_the_write_adds_nothing(spark, tmpdir_path, monkeypatch):
    """The batch was written but not committed: it runs again and replaces its rows."""
    src, out, ck = (os.path.join(tmpdir_path, x) for x in ("src", "out", "ck"))
    spark.range(30).withColumnRenamed("id", "k").write.parquet(src)
    whole = resume.write_batch

    def dies(rows, path):
        whole(rows, path)
        raise RuntimeError("killed")

    monkeypatch.setattr(resume, "write_batch", dies)
    with pytest.raises(Exception, match="killed"):
        resume_stream(spark, src, "k long", "k", out, ck, lambda d: d)
    monkeypatch.setattr(resume, "write_batch", whole)
    assert resume.read_output(spark, out).count() == 30
    assert sorted(r.k for r in resume_stream(spark, src, "k long", "k", out, ck, lambda d: d).collect()) == list(range(30))


def test_a_batch_does_not_read_the_output(spark, tmpdir_path, monkeypatch):
    src, out, ck = (os.path.join(tmpdir_path, x) for x in ("src", "out", "ck"))
    seen = []
    whole = resume.write_batch
    monkeypatch.setattr(resume, "write_batch", lambda rows, path: (seen.append(rows.inputFiles()), whole(rows, path)))
    for i in range(3):
        spark.range(10 * i, 10 * i + 15).withColumnRenamed("id", "k").write.mode("append").parquet(src)
        assert resume_stream(spark, src, "k long", "k", out, ck, lambda d: d).count() == 10 * i + 15
    assert len(seen) == 3 and not any(f"{out}/" in f for files in seen for f in files)


def test_custom_provider_gets_prompts(spark):
    from datetime import datetime, timedelta
    t0 = datetime(2024, 1, 1, 8)
    rows = [("a", 1, t0 + timedelta(seconds=10 * i), 39.9 + i * 1e-4, 116.3, 0.0, "bus") for i in range(12)]
    clean = spark.createDataFrame(rows, "unique_id string, user_id int, ts timestamp_ntz, lat double, lon double, "
                                        "altitude double, transport_mode string")
    p = build_prompts(clean).first()
    assert "(39.900000, 116.300000, 2024-01-01 08:00:00)" in p.prompt
    provider = E.batched_provider(lambda texts: [[float(len(t))] for t in texts], "unique_id", "prompt",
                                  "trajectory_id string, embedding array<float>")
    out, rej = describe(clean, provider=lambda df: provider(df).select(
        F.col("trajectory_id").alias("unique_id"), F.col("embedding")[0].cast("string").alias("text_information")))
    assert out.first().text_information == str(float(len(p.prompt)))
    assert rej.count() == 0
    _, rej2 = describe(clean, provider=lambda df: df, max_chars=100)
    assert rej2.first().reason == "context_length"
