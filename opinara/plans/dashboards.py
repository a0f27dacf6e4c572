"""From raw reviews to every dashboard table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from opinara.operators import aggregates as a
from opinara.operators import words as w
from opinara.operators.clean import load_reviews, reject_report
from opinara.operators.geo import geo_enrich, geo_missing_countries
from opinara.sources.tables import write_partitioned, write_table


def dashboard_tables(geo: DataFrame, first: str, second: str) -> dict[str, DataFrame]:
    """All report tables over the geo-enriched reviews, still lazy."""
    comparison = a.country_comparison(geo, first, second)
    top = w.top_words_per_segment(geo, "content")
    segments = [(app, s) for app in (first, second) for s in a.SENTIMENTS]
    return {
        "app_sentiment": a.app_sentiment(geo),
        "score_summary": a.score_summary(geo),
        "country_app": a.country_app(geo),
        "evolution_monthly": a.evolution_monthly(geo),
        "evolution_yearly": a.evolution_yearly(geo),
        "gender_sentiment": a.gender_sentiment(geo),
        "top20_countries": a.top_countries(geo),
        "country_comparison": comparison,
        "length_by_sentiment": a.length_with_median(geo),
        "gender_bias": a.gender_bias(geo),
        "seasonality": a.seasonality(geo),
        "continent_comparison": a.continent_comparison(geo, first, second),
        "underrepresented_markets": a.underrepresented(geo, first),
        "negative_spikes": a.negative_spikes(geo),
        "polarization": a.polarization(geo),
        "missing_countries": geo_missing_countries(geo),
        "kpi": a.kpi(geo, first, second),
        "monthly_score": a.monthly_score(geo),
        "quarterly_negative": a.quarterly_negative(geo),
        "length_boxplot": a.length_boxplot(geo),
        "words_by_segment": top,
        "words_pivot": w.words_pivot(top, segments),
    }


def build_dashboards(
    raw: DataFrame, countries: DataFrame, out: str, first: str, second: str, fmt: str = "csv"
) -> list[str]:
    """Write the curated reviews once, then every table from them.

    The curated table is columnar and partitioned by app, so that each report
    reads only its columns and apps. Returns the names of the tables.
    """
    spark = raw.sparkSession
    curated = f"{out}/reviews_geo"
    write_partitioned(geo_enrich(load_reviews(raw), countries), curated, ["app"])
    tables = dashboard_tables(spark.read.parquet(curated), first, second)
    tables["reject_report"] = reject_report(raw)
    for name, df in tables.items():
        write_table(df, f"{out}/{name}", fmt)
    return sorted(tables)
