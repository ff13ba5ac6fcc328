"""CSV folders with differing headers; runs that become visible as a whole."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import types as T

from stressframe.sources.files import malformed_counts, read_customers, read_table
from stressframe.sources.landing import column_names, read_landing
from stressframe.sources.publish import Publication

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("score", T.IntegerType()), T.StructField("name", T.StringType()), T.StructField("x", T.DoubleType())])


def put(folder, **files):
    os.makedirs(folder, exist_ok=True)
    for name, text in files.items():
        with open(os.path.join(folder, f"{name}.csv"), "w", encoding="utf-8") as f:
            f.write(text)
    return folder


def test_headers_in_any_order(spark, tmp_dir):
    """Two files with swapped columns: read by name, never by place."""
    src = put(os.path.join(tmp_dir, "swap"), a="customer_id,credit_score\n3,800\n", b="credit_score,customer_id\n800,3\n650,4\n")
    rows = read_table(spark, src, T.StructType([T.StructField("customer_id", T.LongType()), T.StructField("credit_score", T.IntegerType())]), fmt="csv")
    assert sorted((r.customer_id, r.credit_score) for r in rows.collect()) == [(3, 800), (3, 800), (4, 650)]
    with pytest.raises(ValueError):
        read_customers(spark, src, fmt="csv")  # no file has the target


def test_landing_and_quarantine(spark, tmp_dir):
    src = put(
        os.path.join(tmp_dir, "land"),
        a='id,score,name\n1,10,"x, y"\n2,bad,z\n3,7\n',
        b="﻿score, id,more\n5,4,m1\n,5,m2\n9,6,m3,m4\n",
        c="id,x\n7,nan\n8,0.5\nwhat,oops\n",
        d="id,score,name\n",
        e="",
    )
    rows, bad = read_landing(spark, src, SCHEMA)
    assert rows.columns == ["id", "score", "name", "x", "more", "source_file"]
    got = {tuple(r)[:5] for r in rows.collect()}
    assert got == {
        (1, 10, "x, y", None, None),
        (2, None, "z", None, None),
        (4, 5, None, None, "m1"),
        (5, None, None, None, "m2"),
        (7, None, None, None, None),
        (8, None, None, 0.5, None),
        (None, None, None, None, None),
    }
    assert rows.count() == 7
    held = {(os.path.basename(r.source_file), r.column, r.value) for r in bad.collect()}
    assert held == {("a.csv", "score", "bad"), ("c.csv", "id", "what"), ("c.csv", "x", "oops"), ("a.csv", None, None), ("b.csv", None, None)}
    assert {r.row for r in bad.where("column IS NULL").collect()} == {"3,7", "9,6,m3,m4"}
    assert {r.column: r.malformed for r in malformed_counts(spark, src, SCHEMA).collect()} == {"id": 1, "score": 1, "name": 0, "x": 1}
    assert read_landing(spark, src, SCHEMA, extra=False)[0].columns == ["id", "score", "name", "x", "source_file"]


def test_landing_special(spark, tmp_dir):
    nothing = put(os.path.join(tmp_dir, "none"), a="")
    rows, bad = read_landing(spark, nothing, SCHEMA)
    assert rows.collect() == [] and bad.collect() == [] and "id" in rows.columns
    with pytest.raises(ValueError, match="twice"):
        read_landing(spark, put(os.path.join(tmp_dir, "twice"), a="id,id\n1,2\n"), SCHEMA)
    assert column_names('﻿"a, b", c ') == ["a, b", "c"]


def test_publication(spark, tmp_dir):
    from pyspark.ml.feature import Bucketizer
    from pyspark.ml import Pipeline

    root = os.path.join(tmp_dir, "pub")
    pub = Publication(spark, root)
    assert pub.runs() == []
    with pytest.raises(LookupError):
        pub.table("scored")
    model = Pipeline(stages=[Bucketizer(splits=[-1.0, 0.0, 9.0], inputCol="x", outputCol="b")]).fit(spark.range(1).selectExpr("1.0 AS x"))
    assert pub.publish("one", {"scored": spark.range(3)}, {"m": model}, {"auc": 0.7})
    pub.write("two", {"scored": spark.range(99)})  # broke off before its manifest
    assert [r.run for r in pub.runs()] == ["one"] and pub.table("scored").count() == 3
    # a manifest that was being written when its job ended is not seen either
    os.makedirs(os.path.join(root, "manifests", "two", "_temporary", "0"))
    with open(os.path.join(root, "manifests", "two", "_temporary", "0", "part-0.json"), "w") as f:
        f.write('{"number":9,"run":"two"')
    assert [r.run for r in pub.runs()] == ["one"]
    assert pub.publish("two", {"scored": spark.range(5)}, metrics={"auc": 0.8})

    def never():
        raise AssertionError("built again")

    assert not pub.publish("two", {"scored": never})  # repeated: nothing is written
    assert pub.table("scored").count() == 5 and pub.table("scored", "one").count() == 3
    assert pub.metrics() == {"auc": 0.8} and pub.metrics("one") == {"auc": 0.7}
    assert pub.model("m", "one").transform(spark.createDataFrame([(3.0,)], "x double")).first().b == 1.0
    with pytest.raises(LookupError):
        pub.model("m")
    with pytest.raises(ValueError):
        pub.publish("../x", {})
