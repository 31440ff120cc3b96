import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from tidewell.operators import nested


def test_flatten_any_depth_and_null_structs(spark):
    df = spark.createDataFrame(
        [(1, (("x", 2), "y"), [1]), (2, None, None)],
        "id long, a struct<b:struct<c:string,d:long>,e:string>, l array<long>",
    )
    flat = nested.flatten_struct(df)
    assert flat.columns == ["id", "a_b_c", "a_b_d", "a_e", "l"]
    assert rows(flat, "id") == [(1, "x", 2, "y", [1]), (2, None, None, None, None)]
    assert nested.flatten_struct(flat).columns == flat.columns


def test_expand_keeps_nested_metadata_as_columns(spark):
    df = spark.createDataFrame(
        [("k", [("t", ("v", 1))])], "id string, events array<struct<t:string,metadata:struct<k:string,n:long>>>"
    )
    out = nested.expand_event(nested.explode_events(df))
    assert out.columns == ["id", "t", "metadata_k", "metadata_n"]


def test_nest_is_the_inverse_of_explode(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3)], "k string, v long")
    docs = nested.nest_events(df, ["k"], ["v"])
    assert rows(docs.select("k", "part", "events.v"), "k") == [("a", 0, [1, 2]), ("b", 0, [3])]
    back = nested.expand_event(nested.explode_events(docs.drop("part")))
    assert sorted(rows(back)) == sorted(rows(df))


def test_documents_of_whole_keys_meet_others_by_key_without_another_shuffle(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3)], "k string, v long")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs = nested.nest_events(df, ["k"], ["v"])
        joined = df.groupBy("k").agg(F.sum("v").alias("n")).join(docs, "k")
        assert plan(joined).count("Exchange hashpartitioning") == 2
        assert rows(joined.select("k", "n", "part", "events.v"), "k") == [("a", 3, 0, [1, 2]), ("b", 3, 0, [3])]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_parts_follow_the_content_and_nothing_is_lost(spark):
    hot = spark.range(9000).select(F.lit("hot").alias("k"), (F.col("id") % 4000).alias("v"))
    cold = spark.range(900).select(F.concat(F.lit("k"), F.col("id") % 300).alias("k"), F.col("id").alias("v"))
    df = hot.unionByName(cold)
    docs = nested.nest_events(df, ["k"], ["v"], part=F.col("v") % 10)
    sizes = [r.n for r in docs.filter("k = 'hot'").select(F.size("events").alias("n")).collect()]
    assert len(sizes) == 10 and sum(sizes) == 9000 and max(sizes) == 900
    back = nested.expand_event(nested.explode_events(docs.drop("part")))
    assert back.exceptAll(df).isEmpty() and df.exceptAll(back).isEmpty()


@pytest.mark.parametrize("files", [1, 7])
def test_documents_do_not_depend_on_the_files_of_copies(spark, files):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("b", 1)] * 10, "k string, v long")
    docs = nested.nest_events(df.repartition(files), ["k"], ["v"], part=F.col("v") % 3)
    got = rows(docs.select("k", "part", "events.v"), "k", "part")
    assert got == [("a", 1, [1] * 20), ("a", 2, [2] * 10), ("b", 1, [1] * 10)]


def test_no_job_runs_while_documents_are_planned(spark):
    df = spark.createDataFrame([("a", 1)], "k string, v long")
    poisoned = df.withColumn("v", F.raise_error(F.lit("read too early")).cast("long"))
    assert nested.nest_events(poisoned, ["k"], ["v"]).columns == ["k", "part", "events"]
