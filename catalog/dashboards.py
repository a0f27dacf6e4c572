"""Aggregates, rankings and dashboard sheets over the geo-enriched reviews."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog import query
from catalog.inputs import geo, sql, sql_mean, sql_percent, sql_units
from opinara.operators import aggregates as a

_NEG = "count(*) filter (sentiment = 'negative')"
_POS = "count(*) filter (sentiment = 'positive')"
_AVG = sql_mean("sum(score)", "count(score)")


def _report(name: str, fn: Callable[[DataFrame], DataFrame], body: str, **ctes: str) -> None:
    query(name, sql("geo", body, **ctes))(lambda spark, sf: fn(geo(spark, sf)))


_report(
    "a1_app_sentiment",
    a.app_sentiment,
    f"""select app, sentiment, n, {sql_percent("n", "sum(n) over (partition by app)")} as pct_within_app
    from (select app, sentiment, count(*) as n from geo group by all)""",
)
_report(
    "a2_score_summary",
    a.score_summary,
    f"""select app, {_AVG} as mean, cast(median(score) as double) as median,
    floor(sqrt((sum(score * score)::double - sum(score)::double * sum(score)::double / count(*)::double)
        / (count(*) - 1)) * 1000.0::double + 0.5::double) / 1000.0::double as std, count(score) as "count"
    from geo group by app""",
)
_report(
    "a3_country_app",
    a.country_app,
    f"""select country, iso3, continent, app, count(score) as n, {_AVG} as avg_score,
    {sql_percent(_NEG, "count(*)")} as pct_negative, {sql_percent(_POS, "count(*)")} as pct_positive
    from geo where country is not null and iso3 is not null and continent is not null group by all""",
)
_report(
    "a4_evolution_monthly",
    a.evolution_monthly,
    "select year_month, app, sentiment, count(*) as n from geo group by all order by 1, 2, 3",
)
_report(
    "a5_evolution_yearly",
    a.evolution_yearly,
    f"""select "year", app, count(score) as n, {_AVG} as avg_score, {sql_percent(_NEG, "count(*)")} as pct_negative
    from geo group by all""",
)
_report(
    "a6_gender_sentiment",
    a.gender_sentiment,
    f"""select app, gender, sentiment, n,
    {sql_percent("n", "sum(n) over (partition by app, gender)")} as pct_within_app_gender
    from (select app, gender, sentiment, count(*) as n from geo group by all)""",
)
_report(
    "a7_length_by_sentiment",
    a.length_by_sentiment,
    f"""select app, sentiment, {sql_mean("sum(word_count)", "count(word_count)", 1)} as avg_words,
    {sql_mean("sum(content_length)", "count(content_length)", 1)} as avg_chars, count(word_count) as n
    from geo group by all""",
)

_TWO = """sum(score) filter (app = 'AppA') as sa, count(score) filter (app = 'AppA') as na,
    sum(score) filter (app = 'AppB') as sb, count(score) filter (app = 'AppB') as nb"""
_UA = f"case when na > 0 then {sql_units('sa', 'na')} end"
_UB = f"case when nb > 0 then {sql_units('sb', 'nb')} end"
_COMPARISON = f"""select country, iso3, continent, {_UA} / 1000.0::double as "avg_score_AppA",
    {_UB} / 1000.0::double as "avg_score_AppB", ({_UA} - {_UB}) / 1000.0::double as "delta_AppA_vs_AppB"
    from (select country, iso3, continent, {_TWO} from geo
        where country is not null and iso3 is not null and continent is not null group by all)"""
_report("a8_country_comparison", lambda d: a.country_comparison(d, "AppA", "AppB"), _COMPARISON)
_report(
    "a9_pct_negative_by_app",
    a.pct_negative_by_app,
    f"select app, {sql_percent(_NEG, 'count(*)')} as pct_negative from geo group by app",
)
_report(
    "a10_gender_bias",
    a.gender_bias,
    f"""select app, gender, {_AVG} as mean, count(score) as "count" from geo group by all""",
)
_report(
    "a11_seasonality",
    a.seasonality,
    f"""select app, cast(month(date) as int) as "month", count(score) as n, {_AVG} as avg_score,
    {sql_percent(_NEG, "count(*)")} as pct_negative from geo group by all""",
)
_report(
    "a12_length_with_median",
    a.length_with_median,
    f"""select app, sentiment, {sql_mean("sum(word_count)", "count(word_count)", 1)} as avg_words,
    cast(median(word_count) as double) as median_words, count(word_count) as n from geo group by all""",
)
_report(
    "a13_continent_comparison",
    lambda d: a.continent_comparison(d, "AppA", "AppB"),
    f"""select continent, {_UA} / 1000.0::double as "AppA", {_UB} / 1000.0::double as "AppB",
    ({_UA} - {_UB}) / 1000.0::double as delta
    from (select continent, {_TWO} from geo where continent is not null group by all)""",
)
_report(
    "a14_underrepresented",
    lambda d: a.underrepresented(d, "AppA"),
    """select country, count(*) as n_reviews from geo where app = 'AppA' and country is not null
    group by country having count(*) < 30""",
)
_report(
    "a15_negative_spikes",
    a.negative_spikes,
    """select app, year_month, count(*) as n_negative from geo where sentiment = 'negative'
    group by all order by n_negative desc, app, year_month limit 10""",
)
_report(
    "a16_polarization",
    a.polarization,
    f"""select app, {sql_percent("count(*) filter (score = 1)", "count(*)")} as pct_1_star,
    {sql_percent("count(*) filter (score = 5)", "count(*)")} as pct_5_star,
    {sql_percent("count(*) filter (score in (1, 5))", "count(*)")} as polarization from geo group by app""",
)
_report(
    "a17_sentiment_crosstab",
    a.sentiment_crosstab,
    f"""select app, {_NEG} as negative, count(*) filter (sentiment = 'neutral') as neutral, {_POS} as positive
    from geo group by app""",
)
_report(
    "a18_profile",
    a.profile,
    """select cast(count(*) as bigint) as n_rows, count(distinct app) as n_apps, cast(min(date) as varchar) as min_date,
    cast(max(date) as varchar) as max_date, count(distinct country) as n_countries from geo""",
)
_report("a18_rows_per_app", a.rows_per_app, "select app, count(*) as n from geo group by app")
_report(
    "a19_class_counts",
    lambda d: a.class_counts(d, "score"),
    "select score, n, max(n) over () as majority from (select score, count(*) as n from geo group by score)",
)
_report(
    "a20_score_bucket_counts",
    a.score_band_counts,
    """select *, greatest(negative, neutral, positive) as target from (
    select app, count(*) filter (score >= 4) as positive, count(*) filter (score = 3) as neutral,
    count(*) filter (score <= 2) as negative from geo group by app)""",
)
_report(
    "a21_continent_counts",
    a.continent_counts,
    "select continent, count(*) as n from geo where continent is not null group by continent",
)
_report(
    "w1_pct_within_group",
    lambda d: a.with_share(
        d.where(F.col("continent").isNotNull()).groupBy("continent", "sentiment").agg(F.count(F.lit(1)).alias("n")),
        ["continent"],
        "pct_within_continent",
    ),
    f"""select continent, sentiment, n,
    {sql_percent("n", "sum(n) over (partition by continent)")} as pct_within_continent
    from (select continent, sentiment, count(*) as n from geo where continent is not null group by all)""",
)
_report(
    "l1_top20_countries",
    a.top_countries,
    """select country, count(*) as n from geo where country is not null group by country
    order by n desc, country limit 20""",
)


def _deltas(largest: bool, k: int) -> Callable[[DataFrame], DataFrame]:
    return lambda d: a.extreme_deltas(
        a.country_comparison(d, "AppA", "AppB"), "delta_AppA_vs_AppB", k, largest
    )


def _deltas_sql(order: str, k: int) -> str:
    return f"""select * from comparison where "delta_AppA_vs_AppB" is not null
    order by "delta_AppA_vs_AppB" {order}, country limit {k}"""


_report("l2_top_delta", _deltas(True, 5), _deltas_sql("desc", 5), comparison=_COMPARISON)
_report("l2_bottom_delta", _deltas(False, 5), _deltas_sql("asc", 5), comparison=_COMPARISON)
_report(
    "l3_sort_multi",
    lambda d: d.select("app", "score", "reviewId").orderBy("app", F.desc("score"), "reviewId"),
    "select app, score, reviewId from geo order by app, score desc, reviewId",
)

# Dashboard sheets.

_report(
    "d1_kpi",
    lambda d: a.kpi(d, "AppA", "AppB"),
    f"""select n as total_reviews, {_UA} / 1000.0::double as "avg_score_AppA",
    {_UB} / 1000.0::double as "avg_score_AppB", ({_UA} - {_UB}) / 1000.0::double as delta
    from (select count(*) as n, {_TWO} from geo)""",
)
_report(
    "d2_country_map",
    lambda d: a.country_map(d, "AppA", ["ASIA", "EUROPE"]),
    f"""select country, iso3, lat, lon, count(*) as n, {_AVG} as avg_score from geo
    where app = 'AppA' and continent in ('ASIA', 'EUROPE') and country is not null and iso3 is not null group by all""",
)
_report(
    "d3_top_bottom_10_delta",
    lambda d: _deltas(True, 10)(d).withColumn("side", F.lit("top")).unionByName(
        _deltas(False, 10)(d).withColumn("side", F.lit("bottom"))
    ),
    f"""select *, 'top' as side from ({_deltas_sql("desc", 10)})
    union all select *, 'bottom' as side from ({_deltas_sql("asc", 10)})""",
    comparison=_COMPARISON,
)
_report(
    "d4_monthly_score",
    lambda d: a.monthly_score(d, "2015-01-01", "2020-12-31"),
    f"""select app, year_month, count(*) as n, {_AVG} as avg_score from geo
    where date between DATE '2015-01-01' and DATE '2020-12-31' group by all""",
)
_report(
    "d5_monthly_volume",
    lambda d: a.monthly_volume(d, "AppB"),
    "select year_month, sentiment, count(*) as n from geo where app = 'AppB' group by all",
)
_report(
    "d6_quarterly_negative",
    a.quarterly_negative,
    f"""select app, "quarter", count(*) as n, {sql_percent(_NEG, "count(*)")} as pct_negative from geo group by all""",
)
_report(
    "d7_length_boxplot",
    a.length_boxplot,
    """select sentiment, app, cast(min(word_count) as double) as min_words,
    cast(quantile_cont(word_count, 0.25) as double) as q1_words,
    cast(quantile_cont(word_count, 0.5) as double) as median_words,
    cast(quantile_cont(word_count, 0.75) as double) as q3_words,
    cast(max(word_count) as double) as max_words from geo group by all""",
)
_report(
    "d9_one_star_phase",
    lambda d: a.one_star_phase(d, above=3.5),
    """select app, cast(min(d) as varchar) as first_review,
    min(year_month) filter (s > 3.5 * n) as first_month_above,
    cast(date_diff('month', date_trunc('month', min(d)),
        strptime(min(year_month) filter (s > 3.5 * n) || '-01', '%Y-%m-%d')) as int) as months
    from (select app, year_month, min(date) as d, sum(score) as s, count(score) as n from geo group by all)
    group by app""",
)
_report(
    "d10_uniform_months",
    a.uniform_months,
    f"""select app, count(*) as n_months, count(*) filter (lo = hi) as n_uniform,
    {sql_percent("count(*) filter (lo = hi)", "count(*)")} as pct_uniform
    from (select app, year_month, min(score) as lo, max(score) as hi from geo group by all) group by app""",
)
_report(
    "d11_score_date_ranges",
    lambda d: a.score_date_ranges(d).select(
        "app", "score", "n", F.col("first_date").cast("string").alias("first_date"),
        F.col("last_date").cast("string").alias("last_date"),
    ),
    """select app, score, count(*) as n, cast(min(date) as varchar) as first_date,
    cast(max(date) as varchar) as last_date from geo group by all""",
)
_report(
    "d11_score_date_overlap",
    a.score_date_overlap,
    """select app, cast(lf as varchar) as low_first, cast(ll as varchar) as low_last, cast(hf as varchar) as high_first,
    cast(hl as varchar) as high_last, coalesce(lf <= hl and hf <= ll, false) as overlap from (
    select app, min(date) filter (score = 1) as lf, max(date) filter (score = 1) as ll,
    min(date) filter (score = 5) as hf, max(date) filter (score = 5) as hl from geo group by app)""",
)
