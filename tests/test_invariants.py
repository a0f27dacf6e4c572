"""Relations between the report tables that hold on any data."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from catalog import inputs
from opinara.operators import aggregates as a
from opinara.operators import words as w

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def geo(spark):
    df = inputs.geo(spark, SF).cache()
    yield df
    df.unpersist()


def table(df, keys, value="n"):
    return {tuple(r[k] for k in keys): r[value] for r in df.collect()}


def test_counts_add_up(geo):
    by_app = table(a.app_sentiment(geo), ["app", "sentiment"])
    for finer in (a.gender_sentiment(geo), a.evolution_monthly(geo)):
        assert table(finer.groupBy("app", "sentiment").agg(F.sum("n").alias("n")), ["app", "sentiment"]) == by_app
    monthly = a.evolution_monthly(geo).groupBy(F.substring("year_month", 1, 4).cast("int").alias("year"), "app")
    assert table(monthly.agg(F.sum("n").alias("n")), ["year", "app"]) == table(a.evolution_yearly(geo), ["year", "app"])


def test_country_tables_agree(geo):
    detail = a.country_app(geo)
    wide = {r["country"]: r for r in a.country_comparison(geo, "AppA", "AppB").collect()}
    for r in detail.collect():
        assert wide[r["country"]][f"avg_score_{r['app']}"] == r["avg_score"]
    for r in wide.values():
        x, y, d = r["avg_score_AppA"], r["avg_score_AppB"], r["delta_AppA_vs_AppB"]
        assert d is None if None in (x, y) else abs(d - (x - y)) < 1e-9
    mapped = detail.where("app = 'AppA' and n < 30").select("country")
    low = a.underrepresented(geo.where(F.col("iso3").isNotNull()), "AppA").select("country")
    assert sorted(mapped.collect()) == sorted(low.collect())


def test_spikes_are_the_top_negative_months(geo):
    negative = a.evolution_monthly(geo).where("sentiment = 'negative'")
    top = negative.orderBy(F.desc("n"), "app", "year_month").limit(10)
    assert table(top, ["app", "year_month"]) == table(a.negative_spikes(geo), ["app", "year_month"], "n_negative")


def test_percentages_sum_to_hundred(geo):
    shares = a.app_sentiment(geo).groupBy("app").agg(F.sum("pct_within_app").alias("s")).collect()
    assert all(abs(r["s"] - 100) <= 0.02 for r in shares)


def test_word_tables(geo):
    top = w.top_words_per_segment(geo, "content").collect()
    per = {}
    for r in top:
        per[(r["app"], r["sentiment"])] = per.get((r["app"], r["sentiment"]), 0) + 1
        assert abs(r["freq_per_review"] - r["freq"] / r["n_reviews_in_segment"]) <= 0.5e-4 + 1e-12
    assert len(per) == 6 and set(per.values()) == {30}


def test_plans_have_no_wide_surprises(spark):
    """The small dimension is broadcast and only the needed columns are read."""
    plan = a.country_app(inputs.geo(spark, SF))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "CartesianProduct" not in plan
    assert "struct<doc_id:bigint,text:string>" in plan
