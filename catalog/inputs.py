"""Inputs of the catalogue: review-shaped views of the given tables.

The raw reviews and the country dimension are derived from the whole given
tables by expressions that read the same in Spark and in the SQL twins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from opinara.functions.text import SPACE, SPACE_CHARS
from opinara.operators.clean import load_reviews
from opinara.operators.geo import geo_enrich
from opinara.session import spread_small

APPS = ("AppA", "AppB")

RAW_COLUMNS = {
    "reviewId": "'r' || cast(doc_id as string)",
    "content": "case when doc_id % 59 = 0 then null when doc_id % 53 = 0 then ' \u00a0\u3000\t' else text end",
    "score": """case when doc_id % 41 = 0 then 'bad' when doc_id % 43 = 0 then '9' when doc_id % 47 = 0 then '2.5'
        when (doc_id * 7919) % 100 < 45 then '5' when (doc_id * 7919) % 100 < 60 then '4'
        when (doc_id * 7919) % 100 < 72 then '3' when (doc_id * 7919) % 100 < 80 then '2' else '1' end""",
    "gender": "case when doc_id % 31 = 0 then 'unknown' when doc_id % 3 = 0 then 'female' else 'male' end",
    "location": """case when doc_id % 29 = 0 then null
        when doc_id % 23 = 0 then 'NATION_' || cast(doc_id % 25 as string)
        else 'City_' || cast(doc_id % 7 as string) || case when doc_id % 11 = 0 then '\u00a0,\u3000NATION_' else ', NATION_' end || cast(doc_id % 25 as string) end""",
    "date": """case when doc_id % 37 = 0 then 'not a date'
        else cast(DATE '2013-02-01' + cast((doc_id * 17) % 4500 as int) as string) end""",
    "app": "case when (doc_id * 31) % 10 < 5 then 'AppA' else 'AppB' end",
}

COUNTRY_COLUMNS = {
    "country": "n_name",
    "lat": "cast(n_nationkey as double) * 3 - 36",
    "lon": "cast(n_nationkey as double) * 7 - 84",
    "iso3": "'N' || right('0' || cast(n_nationkey as string), 2)",
    "continent": "r_name",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread_small(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    return docs.selectExpr(*[f"{e} as {c}" for c, e in RAW_COLUMNS.items()])


def countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    joined = nation.join(region, nation.n_regionkey == region.r_regionkey).where("n_nationkey <> 24")
    return joined.selectExpr(*[f"{e} as {c}" for c, e in COUNTRY_COLUMNS.items()])


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_reviews(raw(spark, sf_dir))


def geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geo_enrich(reviews(spark, sf_dir), countries(spark, sf_dir))


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(reviewId, content, label) of the raw rows that have a numeric score."""
    from opinara.operators.clean import with_label

    return with_label(raw(spark, sf_dir)).select("reviewId", "content", "label")


# SQL twins, as named common table expressions.

def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^{SPACE}|{SPACE}$', '', 'g')"


FILLED = f"[^{SPACE_CHARS}]"

SQL_CITY = f"case when {sql_strip('location')} <> '' and contains(location, ',') then {sql_strip("split_part(location, ',', 1)")} end"
SQL_COUNTRY = f"case when {sql_strip('location')} <> '' then {sql_strip("split_part(location, ',', -1)")} end"

_CTES = {
    "raw": "select " + ", ".join(f"{e} as {c}" for c, e in RAW_COLUMNS.items()) + " from documents",
    "dim_country": "select " + ", ".join(f"{e} as {c}" for c, e in COUNTRY_COLUMNS.items())
    + " from nation join region on n_regionkey = r_regionkey where n_nationkey <> 24",
    "scored": "select *, try_cast(score as double) as num from raw",
    "valid": f"""select * exclude (score, date, num), cast(trunc(num) as int) as score, try_cast(date as date) as date
        from scored where num between 1 and 5 and gender in ('male', 'female')
        and try_cast(date as date) is not null and regexp_matches(content, '{FILLED}')""",
    "reviews": f"""select *,
        case when score <= 2 then 'negative' when score = 3 then 'neutral' else 'positive' end as sentiment,
        {SQL_CITY} as city,
        {SQL_COUNTRY} as country,
        cast(year(date) as int) as "year", strftime(date, '%Y-%m') as year_month,
        year(date) || 'Q' || quarter(date) as "quarter",
        cast(length(content) as int) as content_length,
        cast(len(regexp_extract_all(content, '{FILLED}+')) as int) as word_count
        from valid""",
    "geo": "select r.*, lat, lon, iso3, continent from reviews r left join dim_country d on r.country = d.country",
    "labelled": """select reviewId, content,
        case when num <= 2 then 0 when num = 3 then 1 when num >= 4 then 2 else 0 end as label
        from scored where num is not null""",
}

_NEEDS = {
    "scored": ["raw"],
    "valid": ["raw", "scored"],
    "reviews": ["raw", "scored", "valid"],
    "geo": ["raw", "dim_country", "scored", "valid", "reviews"],
    "labelled": ["raw", "scored"],
}


def sql(main: str, body: str, **more: str) -> str:
    """A twin query: the inputs that `main` needs, extra CTEs, then the body."""
    parts: list[str] = []
    for name in [n for m in main.split() for n in [*_NEEDS.get(m, []), m]]:
        text = f"{name} as ({_CTES[name]})"
        if text not in parts:
            parts.append(text)
    parts += [f"{n} as ({t})" for n, t in more.items()]
    return ("with " + ",\n".join(parts) + "\n" if parts else "") + body


def sql_percent(k: str, t: str) -> str:
    return f"(((20000 * cast({k} as bigint) + cast({t} as bigint)) // (2 * cast({t} as bigint))) / 100.0::double)"


def sql_units(s: str, n: str, digits: int = 3) -> str:
    return (
        f"((({2 * 10**digits} * cast({s} as bigint) + {n}) // (2 * {n})))"
    )


def sql_mean(s: str, n: str, digits: int = 3) -> str:
    return f"({sql_units(s, n, digits)} / {10**digits}.0::double)"

