"""Batch equals stream for the stateless path; file sources and sinks."""

from __future__ import annotations

import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from stressframe.operators.features import CLIP_V2, ClipLimits
from stressframe.sources.derive import stress_statement
from stressframe.sources.files import read_any, read_customers, read_statements
from stressframe.sources.sinks import run_id, save_if_goal, write_table
from stressframe.streaming.stream import score_statements, start_to_parquet, statement_stream
from tests.conftest import SMALL


def test_batch_equals_stream(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    stress_statement(spark, SMALL).repartition(4).write.parquet(src)
    batch_in = spark.read.parquet(src)
    caps = ClipLimits(inputCols=list(CLIP_V2)).fit(batch_in)
    batch = score_statements(batch_in, caps)
    stream = score_statements(statement_stream(spark, src, max_files_per_trigger=1), caps)
    q = start_to_parquet(stream, os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ckpt"))
    q.awaitTermination(300)
    streamed = spark.read.parquet(os.path.join(tmp_dir, "out"))
    cols = ["statement_id", "final_probability", "risk_tier", "verdict"]
    a = batch.select(*cols).exceptAll(streamed.select(*cols)).count()
    b = streamed.select(*cols).exceptAll(batch.select(*cols)).count()
    assert a == 0 and b == 0
    assert streamed.count() == batch.count() > 0


def test_csv_reader_nan_and_target(spark, tmp_dir):
    path = os.path.join(tmp_dir, "cust.csv")
    with open(path, "w") as f:
        f.write("customer_id,credit_score,emi_to_income_ratio,default_next_30_days\n")
        f.write("1,720,NaN,1\n2,650,0.3,0\n")
    df = read_customers(spark, path, fmt="csv")
    rows = {r.customer_id: r for r in df.collect()}
    assert rows[1].emi_to_income_ratio is None and rows[2].emi_to_income_ratio == 0.3
    anydf, target = read_any(spark, path, fmt="csv")
    assert target == "default_next_30_days"
    with pytest.raises(AnalysisException):
        read_statements(spark, os.path.join(tmp_dir, "missing.parquet")).count()


def test_write_table_by_run(spark, tmp_dir):
    df = spark.range(5).withColumn("x", F.col("id") * 2)
    out = os.path.join(tmp_dir, "scored")
    write_table(df, out, run="20260101_000000")
    write_table(df.limit(2), out, run="20260102_000000")
    write_table(df.limit(3), out, run="20260101_000000")  # rerun replaces only its partition
    back = spark.read.parquet(out)
    counts = {r.run_id: r["count"] for r in back.groupBy("run_id").count().collect()}
    assert counts == {"20260101_000000": 3, "20260102_000000": 2}
    assert len(run_id()) == 15


def test_save_if_goal(spark, tmp_dir):
    model = ClipLimits(inputCols=["id"]).fit(spark.range(10))
    assert not save_if_goal(model, os.path.join(tmp_dir, "m1"), 0.6, 0.7)
    assert save_if_goal(model, os.path.join(tmp_dir, "m2"), 0.71, 0.7)
    assert os.path.isdir(os.path.join(tmp_dir, "m2")) and not os.path.exists(os.path.join(tmp_dir, "m1"))


def test_store_derived_prunes_weeks(spark, tmp_dir):
    from stressframe.sources.derive import store_derived

    paths = store_derived(spark, SMALL, tmp_dir)
    stored = read_statements(spark, paths["stress_statement"])
    assert stored.count() == stress_statement(spark, SMALL).count()
    week = stored.agg(F.min("week_number")).first()[0]
    one = stored.where(F.col("week_number") == week)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "week_number" in plan
    assert one.count() == stress_statement(spark, SMALL).where(F.col("week_number") == week).count()
    assert read_customers(spark, paths["risk_customer"]).count() > 0


def test_csv_stream_equals_batch(spark, tmp_dir):
    """Reordered columns bind by name and NaN is NULL, in the stream as in batch."""
    from pyspark.sql import types as T

    from stressframe.sources.files import malformed_counts, read_table

    schema = T.StructType([T.StructField("a", T.DoubleType()), T.StructField("b", T.IntegerType()), T.StructField("c", T.StringType())])
    src = os.path.join(tmp_dir, "csv")
    os.makedirs(src)
    with open(os.path.join(src, "one.csv"), "w") as f:
        f.write("b,a,c\n1,2.5,x\n2,NaN,y\n3,,z\nbad,4.5,w\n")
    batch = read_table(spark, src, schema, "csv")
    stream = statement_stream(spark, src, schema=schema, fmt="csv")
    out, ckpt = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ckpt")
    query = start_to_parquet(stream, out, ckpt)
    query.awaitTermination()
    got = sorted(map(tuple, spark.read.parquet(out).select("a", "b", "c").collect()), key=str)
    assert got == sorted(map(tuple, batch.select("a", "b", "c").collect()), key=str)
    assert (2.5, 1, "x") in got and (None, 2, "y") in got
    assert {r.column: r.malformed for r in malformed_counts(spark, src, schema).collect()} == {"a": 0, "b": 1, "c": 0}
