"""Round trips through files: CSV scans, sinks and stored models."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import query
from catalog.dashboards import _AVG
from catalog.inputs import RAW_COLUMNS, geo, raw, reviews, sql, sql_percent
from opinara.operators.aggregates import app_sentiment, country_app
from opinara.operators.clean import with_sentiment
from opinara.session import scratch_path
from opinara.sources import tables as tb

_FIELDS = list(RAW_COLUMNS)
_TOKENS = "(" + ", ".join(f"'{t}'" for t in tb.NULL_TOKENS) + ")"


@query(
    "s1_csv_scan",
    sql(
        "raw",
        f"""select reviewId, case when content not in {_TOKENS} then content end as content, score,
        case when doc % 13 <> 0 then gender end as gender, location,
        date, case when doc % 19 <> 0 then app end as app
        from (select *, cast(substr(reviewId, 2) as bigint) as doc from raw) where doc % 17 <> 0""",
    ),
)
def _(spark, sf):
    """Two header orders, one with a junk column; rows with a surplus field, rows that lack the last one."""
    doc = F.substring("reviewId", 2, 30).cast("bigint")
    df = raw(spark, sf).withColumn("gender", F.when(doc % 13 == 0, "NA").otherwise(F.col("gender")))
    df = df.withColumn("app", F.when(doc % 19 != 0, F.col("app")))
    options = {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    turned = ["Unnamed: 0", *reversed(_FIELDS)]
    df = df.withColumn("Unnamed: 0", doc.cast("string"))
    line = lambda names: F.to_csv(F.struct(*[F.col(f"`{c}`") for c in names]), options)
    full = F.when(doc % 2 == 0, F.when((doc % 19 == 0) & (doc % 17 != 0), line(_FIELDS[:-1])).otherwise(line(_FIELDS))).otherwise(line(turned))
    # One surplus field, empty or not; two, of which the first or both are empty.
    surplus = F.when(doc % 17 == 0, F.get(F.array(*[F.lit(x) for x in (",", ",surplus", ",,", ",,surplus")]), (doc % 4).cast("int"))).otherwise("")
    head = F.when(F.col("id") % 2 == 0, ",".join(_FIELDS)).otherwise(",".join(turned))
    body = df.select((doc % 8).alias("part"), F.lit(1).alias("ord"), F.concat(full, surplus).alias("value"))
    heads = spark.range(8).select(F.col("id").alias("part"), F.lit(0).alias("ord"), head.alias("value"))
    path = scratch_path(spark, "csv")
    lines = body.unionByName(heads).repartition("part").sortWithinPartitions("part", "ord")
    lines.select("part", "value").write.partitionBy("part").text(path)
    return tb.read_csv(spark, path, _FIELDS)


@query(
    "s4_multi_file_scan_with_tags",
    sql("reviews", "select app, sentiment as sentimiento_analisis, count(*) as n from reviews group by all"),
)
def _(spark, sf):
    root = scratch_path(spark, "segments")
    df = reviews(spark, sf)
    parts = df.select("reviewId", "content", F.concat_ws("_", F.lower("app"), "sentiment").alias("segment"))
    parts.write.partitionBy("segment").option("header", True).option("escape", '"').csv(root)
    wanted = [f"{root}/segment={a}_{s}" for a in ("appa", "appb", "appc") for s in ("negative", "neutral", "positive")]
    scan = tb.read_csv(spark, tb.existing_paths(spark, wanted), ["reviewId", "content"], with_file=True)
    tagged = tb.tag_from_file_name(scan, {"appa": "AppA"}, "AppB", level=2)
    return tagged.groupBy("app", "sentimiento_analisis").agg(F.count(F.lit(1)).alias("n"))


@query(
    "s5_table_sink",
    sql(
        "geo",
        f"""select app, sentiment, n, {sql_percent("n", "sum(n) over (partition by app)")} as pct_within_app
        from (select app, sentiment, count(*) as n from geo group by all)""",
    ),
)
def _(spark, sf):
    path = scratch_path(spark, "table")
    tb.write_table(app_sentiment(geo(spark, sf)), path, "csv")
    return spark.read.schema("app string, sentiment string, n bigint, pct_within_app double").option("header", True).csv(path)


@query(
    "s5_curated_reviews",
    sql("geo", f"select country, app, count(score) as n, {_AVG} as avg_score from geo where iso3 is not null group by all"),
)
def _(spark, sf):
    """The typed table is written once; aggregates then read only their columns."""
    path = scratch_path(spark, "curated")
    tb.write_partitioned(geo(spark, sf), path, ["app"])
    return country_app(spark.read.parquet(path)).select("country", "app", "n", "avg_score")


@query(
    "s7_sink_by_sentiment",
    sql(
        "scored",
        """select app, case when num <= 2 then 'negative' when num = 3 then 'neutral' else 'positive' end as sentiment,
        count(*) as n, sum(num) as total from scored where num is not null group by all""",
    ),
)
def _(spark, sf):
    path = scratch_path(spark, "by-sentiment")
    tb.write_by_sentiment(with_sentiment(raw(spark, sf), label="sentiment"), path)
    back = spark.read.parquet(path)
    return back.groupBy("app", "sentiment").agg(F.count(F.lit(1)).alias("n"), F.sum("score").alias("total"))
