"""The table that tells which texts are asked for is small where the driver builds it."""

from pyspark.sql import functions as F

from terraflux.llm import substring_dedup as sd


def broadcasts(plan):
    """(rows, bytes) of each table that a finished plan has sent."""
    out = []
    if plan.nodeName() == "BroadcastExchange":
        out.append(tuple(plan.metrics().apply(k).value() for k in ("numOutputRows", "dataSize")))
    inner = "plan" if "QueryStage" in plan.nodeName() else "executedPlan" if plan.nodeName() == "AdaptiveSparkPlan" else None
    below = [getattr(plan, inner)()] if inner else [plan.children().apply(i) for i in range(plan.children().size())]
    return out + [x for p in below for x in broadcasts(p)]


def asked(spark, ids, wanted):
    docs = ids.select("doc_id", F.col("doc_id").cast("string").cast("binary").alias("text"))
    by = wanted.union(wanted)  # a text is asked for many times
    return sd._asked(docs, wanted.withColumn("wanted", F.array(F.col("doc_id") - 1)), by)


def test_many_asked_texts_are_sent_as_few_rows(spark):
    ids = spark.range(0, 400_000, 1, 4).withColumnRenamed("id", "doc_id")
    found = asked(spark, ids, ids.filter("doc_id % 2 = 0"))
    assert found.columns == ["doc_id", "text", "wanted"]
    rows = found.agg(F.count("*"), F.sum("doc_id"), F.sum(F.col("wanted")[0]), F.sum(F.col("text").cast("string").cast("long")))
    even = 200_000 * 199_999
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # the table is sent because the code says so
    try:
        assert [tuple(r) for r in rows.collect()] == [(200_000, even, even - 200_000, even)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    sent = broadcasts(rows._jdf.queryExecution().executedPlan())
    assert len(sent) == 1
    assert sent[0][0] <= sd._ASKED // 64 // 512
    assert sent[0][1] < 8_000_000


def test_few_none_and_negative_ids(spark):
    ids = spark.createDataFrame([(-5,), (0,), (7,), (1 << 62,)], "doc_id long")
    for own in ([], [(-5,)], [(1 << 62,), (0,)]):
        found = asked(spark, ids, spark.createDataFrame(own, "doc_id long"))
        assert sorted(r.doc_id for r in found.collect()) == sorted(x for (x,) in own)
