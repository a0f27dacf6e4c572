"""Projection, filter and set operators on the raw and the unified reviews."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import query
from catalog.inputs import APPS, FILLED, SQL_CITY, SQL_COUNTRY, countries, geo, raw, reviews, sql, sql_percent
from opinara.functions.labels import class_label, sentiment, to_number
from opinara.operators import clean
from opinara.operators import geo as g


@query("s2_drop_junk_columns", "select doc_id, lang, source from documents")
def _(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", "source")
    return clean.drop_junk_columns(docs.withColumn("Unnamed: 0", F.col("doc_id")).withColumn("Unnamed: 7", F.lit(1)))


@query("s3_text_column_fallback", sql("raw", "select content as text_used from raw"))
def _(spark, sf):
    df = raw(spark, sf).select("content", "score")
    return df.select(F.col(clean.text_column(df, "review_text")).alias("text_used"))


@query("p1_coerce_score", sql("scored", "select reviewId, num as score from scored where num is not null"))
def _(spark, sf):
    return clean.coerce_score(raw(spark, sf)).select("reviewId", "score")


@query(
    "p2_score_range",
    sql("scored", "select reviewId, cast(trunc(num) as int) as score from scored where num between 1 and 5"),
)
def _(spark, sf):
    return clean.score_in_range(clean.coerce_score(raw(spark, sf))).select("reviewId", "score")


@query("p3_gender_in", sql("raw", "select reviewId, gender from raw where gender in ('male', 'female')"))
def _(spark, sf):
    return raw(spark, sf).where(F.col("gender").isin(*clean.VALID_GENDERS)).select("reviewId", "gender")


@query(
    "p4_coerce_date",
    sql(
        "raw",
        "select reviewId, cast(try_cast(date as date) as varchar) as date from raw where try_cast(date as date) is not null",
    ),
)
def _(spark, sf):
    df = raw(spark, sf).select("reviewId", clean.parse_date(F.col("date")).alias("date"))
    return df.where(F.col("date").isNotNull()).withColumn("date", F.col("date").cast("string"))


@query(
    "p5_nonblank_text",
    sql("raw", f"select reviewId, cast(length(content) as int) as n_chars from raw where regexp_matches(content, '{FILLED}')"),
)
def _(spark, sf):
    return raw(spark, sf).where(clean.nonblank(F.col("content"))).select("reviewId", F.length("content").alias("n_chars"))


@query(
    "p6_sentiment_case",
    sql(
        "scored",
        """select reviewId, num as score,
        case when num <= 2 then 'negative' when num = 3 then 'neutral' else 'positive' end as sentiment
        from scored where num is not null""",
    ),
)
def _(spark, sf):
    return clean.with_sentiment(raw(spark, sf), label="sentiment").select("reviewId", "score", "sentiment")


@query("p7_label_select", sql("labelled", "select reviewId, label from labelled"))
def _(spark, sf):
    return clean.with_label(raw(spark, sf)).select("reviewId", "label")


@query(
    "p8_split_location",
    sql(
        "raw",
        f"select reviewId, {SQL_CITY} as city, {SQL_COUNTRY} as country from raw",
    ),
)
def _(spark, sf):
    city, country = clean.split_location(F.col("location"))
    return raw(spark, sf).select("reviewId", city.alias("city"), country.alias("country"))


@query("p9_tag_app", sql("raw", "select reviewId, app from raw"))
def _(spark, sf):
    first, second = (raw(spark, sf).where(F.col("app") == a).drop("app").withColumn("app", F.lit(a)) for a in APPS)
    return first.union(second).select("reviewId", "app")


@query(
    "p10_date_parts",
    sql("reviews", """select reviewId, "year", year_month, "quarter", cast(month(date) as int) as "month" from reviews"""),
)
def _(spark, sf):
    return reviews(spark, sf).select("reviewId", "year", "year_month", "quarter", F.month("date").alias("month"))


@query("p11_text_lengths", sql("reviews", "select reviewId, content_length, word_count from reviews"))
def _(spark, sf):
    return reviews(spark, sf).select("reviewId", "content_length", "word_count")


_UNIFIED_SQL = """select reviewId, app, cast(date as varchar) as date, "year", "quarter", year_month, score, sentiment,
    gender, city, country, location, content, content_length, word_count from reviews"""


@query("p12_project_fixed", sql("reviews", _UNIFIED_SQL))
def _(spark, sf):
    wanted = [*clean.UNIFIED_COLUMNS, "not_there"]
    return clean.keep_present(reviews(spark, sf), wanted).withColumn("date", F.col("date").cast("string"))


@query("p13_rename", sql("raw", "select reviewId, content as texto_limpio from raw"))
def _(spark, sf):
    df = raw(spark, sf).select("reviewId", F.col("content").alias("text_final"))
    return clean.rename_if_present(clean.rename_if_present(df, "text_final", "texto_limpio"), "absent", "x")


@query(
    "p14_cast_target",
    sql("labelled", "select reviewId, label as label_int, cast(label as varchar) as label_text from labelled"),
)
def _(spark, sf):
    label = clean.with_label(raw(spark, sf)).select("reviewId", F.col("label").cast("string").alias("t"))
    return label.select("reviewId", F.col("t").cast("int").alias("label_int"), F.col("t").alias("label_text"))


@query(
    "p15_require_columns",
    sql("raw", "select app, count(*) as n, true as accepted, 'refused' as without_text from raw group by app"),
)
def _(spark, sf):
    """The check passes the raw table and refuses it without its text."""
    df = raw(spark, sf)
    groups = (("label", "score"), ("content",))
    try:
        clean.require_columns(df.drop("content"), *groups)
        outcome = "accepted"
    except ValueError:
        outcome = "refused"
    counted = clean.require_columns(df, *groups).groupBy("app").agg(F.count(F.lit(1)).alias("n"))
    return counted.select("app", "n", F.lit(True).alias("accepted"), F.lit(outcome).alias("without_text"))


@query(
    "p16_reject_report",
    sql(
        "raw scored",
        """select app, count(*) as n_before, count(*) filter (reason is null) as n_kept, count(reason) as n_dropped,
        count(*) filter (reason = 'score') as dropped_score, count(*) filter (reason = 'gender') as dropped_gender,
        count(*) filter (reason = 'date') as dropped_date, count(*) filter (reason = 'content') as dropped_content
        from tagged group by app""",
        tagged=f"""select app, case when not coalesce(num between 1 and 5, false) then 'score'
        when not coalesce(gender in ('male', 'female'), false) then 'gender'
        when try_cast(date as date) is null then 'date'
        when not coalesce(regexp_matches(content, '{FILLED}'), false) then 'content' end as reason from scored""",
    ),
)
def _(spark, sf):
    return clean.reject_report(raw(spark, sf))


@query(
    "p17_equality_filter",
    sql("reviews", "select reviewId, score from reviews where app = 'AppA' and sentiment = 'negative'"),
)
def _(spark, sf):
    hit = (F.col("app") == APPS[0]) & (F.col("sentiment") == "negative")
    return reviews(spark, sf).where(hit).select("reviewId", "score")


@query(
    "p6_four_labelers",
    sql(
        "scored",
        """select num as score, count(*) as n,
        max(case when num between 1 and 5 then case when trunc(num) <= 2 then 'negative' when trunc(num) = 3 then 'neutral'
            else 'positive' end end) as truncated,
        max(case when num <= 2 then 'negative' when num = 3 then 'neutral' else 'positive' end) as plain,
        max(case when num <= 2 then 0 when num = 3 then 1 when num >= 4 then 2 else 0 end) as label,
        max(case when num >= 4 then 'positive' when num = 3 then 'neutral' when num <= 2 then 'negative' end) as band
        from scored where num is not null group by num""",
    ),
)
def _(spark, sf):
    from opinara.functions.labels import score_band

    num = F.col("score")
    in_range = F.when(num.between(1, 5), sentiment(num.cast("int")))
    return clean.coerce_score(raw(spark, sf)).groupBy("score").agg(
        F.count(F.lit(1)).alias("n"),
        F.max(in_range).alias("truncated"),
        F.max(sentiment(num)).alias("plain"),
        F.max(class_label(num)).alias("label"),
        F.max(score_band(num)).alias("band"),
    )


@query("u1_union_apps", sql("reviews", "select reviewId, app, score from reviews"))
def _(spark, sf):
    df = raw(spark, sf)
    parts = [clean.load_reviews(df.where(F.col("app") == a).drop("app"), app=a) for a in APPS]
    return clean.union_apps(parts).select("reviewId", "app", "score")


@query(
    "u2_union_missing_columns",
    sql(
        "reviews",
        """select reviewId, content, score, gender from reviews
        union all select null, content, score, null from reviews where score = 3""",
    ),
)
def _(spark, sf):
    df = reviews(spark, sf).select("reviewId", "content", "score", "gender")
    return df.unionByName(df.where("score = 3").select("content", "score"), allowMissingColumns=True)


@query("u3_distinct_classes", sql("labelled", "select distinct label from labelled order by label"))
def _(spark, sf):
    return clean.with_label(raw(spark, sf)).select("label").distinct().orderBy("label")


# Country lookups.


@query("s11_dim_country", sql("dim_country", "select country, lat, lon, iso3, continent from dim_country"))
def _(spark, sf):
    from opinara.sources.tables import read_countries
    from opinara.session import scratch_path

    path = scratch_path(spark, "dim-country")
    countries(spark, sf).write.parquet(path)
    return read_countries(spark, path)


@query(
    "s12_dim_country_from_json",
    sql(
        "dim_country",
        """select name, iso3, lat, lon, continent from (
            select *, row_number() over (partition by name order by pos desc) as rn from (
                select country as name, iso3, lat, lon, continent, k as pos from numbered
                union all select 'Republic of ' || upper(left(country, 8)), iso3, lat, lon, continent, k from numbered)
            ) where rn = 1""",
        numbered="""select d.*, n_nationkey as k,
            from (select country, iso3, case when right(iso3, 1) <> '3' then lat end as lat,
                case when right(iso3, 1) <> '3' then lon end as lon, continent from dim_country) d
            join nation on n_name = country""",
    ),
)
def _(spark, sf):
    from opinara.sources.countries import index_from_json

    dim = countries(spark, sf).withColumn("k", F.substring("country", 8, 9).cast("int"))
    record = F.struct(
        F.struct(
            F.col("country").alias("common"),
            F.concat(F.lit("Republic of "), F.upper(F.substring("country", 1, 8))).alias("official"),
        ).alias("name"),
        F.col("iso3").alias("cca3"),
        F.when(~F.col("iso3").endswith("3"), F.array("lat", "lon")).alias("latlng"),
        F.col("continent").alias("region"),
    )
    # One JSON array per country file; the file's ordinal gives the record order.
    docs = dim.select(F.col("k").cast("bigint").alias("part"), F.to_json(F.array(record)).alias("json"))
    return index_from_json(docs, "json", "part")


_GEO_COLS = "reviewId, country, lat, lon, iso3, continent"


@query("j1_geo_enrich", sql("geo", f"select {_GEO_COLS} from geo"))
def _(spark, sf):
    return geo(spark, sf).select(*_GEO_COLS.split(", "))


@query(
    "j2_geo_missing_report",
    sql(
        "geo",
        f"""select count(*) as n, count(*) filter (lat is null) as n_missing,
        {sql_percent("count(*) filter (lat is null)", "count(*)")} as pct_missing from geo""",
    ),
)
def _(spark, sf):
    return g.geo_missing_summary(geo(spark, sf))


@query(
    "j2_geo_missing_countries",
    sql("geo", "select country, count(*) as n from geo where lat is null and country is not null group by country"),
)
def _(spark, sf):
    return g.geo_missing_countries(geo(spark, sf))


def _alias_tables(spark, sf):
    """Names to resolve come from the nations; some only match through an alias."""
    nation = spark.read.parquet(f"{sf}/nation.parquet")
    names = nation.select(
        F.when(F.col("n_nationkey") % 4 == 0, F.concat(F.lit("Old "), F.col("n_name"))).otherwise(F.col("n_name")).alias("name")
    )
    aliases = nation.where("n_nationkey % 8 = 0").select(
        F.concat(F.lit("Old "), F.col("n_name")).alias("alias"), F.col("n_name").alias("canonical")
    )
    index = countries(spark, sf).select(F.col("country").alias("name"), "iso3", "lat", "lon", "continent")
    return names, index, aliases


_ALIAS_CTES = {
    "names": "select case when n_nationkey % 4 = 0 then 'Old ' || n_name else n_name end as name from nation",
    "aliases": "select 'Old ' || n_name as alias, n_name as canonical from nation where n_nationkey % 8 = 0",
    "resolved": """select name, coalesce(d.iso3, v.iso3) as iso3, coalesce(d.lat, v.lat) as lat,
        coalesce(d.lon, v.lon) as lon, coalesce(d.continent, v.continent) as continent,
        coalesce(d.iso3, v.iso3) is not null as resolved
        from names left join dim_country d on name = d.country left join aliases on name = alias
        left join dim_country v on canonical = v.country""",
}


@query("j3_alias_resolve", sql("dim_country", "select * from resolved", **_ALIAS_CTES))
def _(spark, sf):
    return g.resolve_names(*_alias_tables(spark, sf))


@query("j4_unresolved_names", sql("dim_country", "select name from resolved where not resolved", **_ALIAS_CTES))
def _(spark, sf):
    return g.unresolved_names(g.resolve_names(*_alias_tables(spark, sf)))


@query(
    "j6_positional_concat",
    sql("geo", "select reviewId, content_length + word_count as size, lat + lon as place from geo"),
)
def _(spark, sf):
    return geo(spark, sf).select(
        "reviewId",
        (F.col("content_length") + F.col("word_count")).alias("size"),
        (F.col("lat") + F.col("lon")).alias("place"),
    )
