"""Dashboard aggregates over the validated, geo-enriched reviews.

Every operator is one hash aggregation on its keys with map-side partial sums.
Percentages and windows run on the aggregated rows only, never on the reviews,
so a dominant app or country costs no more than its partial sums. Rows whose
grouping key is null are left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinara.functions.labels import SENTIMENTS, score_band
from opinara.functions.rounding import half_up, mean, mean_units, percent, sample_std


def _keyed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop rows with a null key: group-by keeps them, the reports do not."""
    for k in keys:
        df = df.where(F.col(k).isNotNull())
    return df


def _n() -> Column:
    return F.count(F.lit(1)).alias("n")


def _avg_score(digits: int = 3) -> Column:
    return mean(F.sum("score"), F.count("score"), digits)


def _pct(condition: Column) -> Column:
    return percent(F.count_if(condition), F.count(F.lit(1)))


def _is(sentiment: str) -> Column:
    return F.col("sentiment") == sentiment


def with_share(counts: DataFrame, within: Sequence[str], name: str) -> DataFrame:
    """Add each row's percent of n within its group. For aggregated rows only."""
    total = F.sum("n").over(Window.partitionBy(*within))
    return counts.withColumn(name, percent(F.col("n"), total))


def value_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float]) -> DataFrame:
    """Exact interpolated quantiles through a (keys, value) histogram.

    The histogram is pre-aggregated, so the final step per group sees distinct
    values with frequencies instead of rows.
    """
    hist = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("freq"))
    points = F.array(*[F.lit(float(p)) for p in probs.values()])
    out = hist.groupBy(*keys).agg(F.percentile(value, points, F.col("freq")).alias("_q"))
    return out.select(*keys, *[F.col("_q")[i].alias(n) for i, n in enumerate(probs)])


def app_sentiment(df: DataFrame) -> DataFrame:
    return with_share(df.groupBy("app", "sentiment").agg(_n()), ["app"], "pct_within_app")


def score_summary(df: DataFrame) -> DataFrame:
    """Mean, exact median, sample standard deviation and count by app.

    All four come from the (app, score) histogram, which has a handful of rows.
    """
    hist = _keyed(df, ["app", "score"]).groupBy("app", "score").agg(F.count(F.lit(1)).alias("freq"))
    s, f = F.col("score").cast("bigint"), F.col("freq")
    return hist.groupBy("app").agg(
        mean(F.sum(s * f), F.sum(f)).alias("mean"),
        F.percentile("score", F.lit(0.5), F.col("freq")).alias("median"),
        half_up(sample_std(F.sum(s * f), F.sum(s * s * f), F.sum(f)), 3).alias("std"),
        F.sum(f).alias("count"),
    )


def country_app(df: DataFrame) -> DataFrame:
    keys = ["country", "iso3", "continent", "app"]
    return _keyed(df, keys).groupBy(*keys).agg(
        F.count("score").alias("n"),
        _avg_score().alias("avg_score"),
        _pct(_is("negative")).alias("pct_negative"),
        _pct(_is("positive")).alias("pct_positive"),
    )


def evolution_monthly(df: DataFrame) -> DataFrame:
    keys = ["year_month", "app", "sentiment"]
    return df.groupBy(*keys).agg(_n()).orderBy(*keys)


def _period_scores(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count("score").alias("n"),
        _avg_score().alias("avg_score"),
        _pct(_is("negative")).alias("pct_negative"),
    )


def evolution_yearly(df: DataFrame) -> DataFrame:
    return _period_scores(df, ["year", "app"])


def seasonality(df: DataFrame) -> DataFrame:
    return _period_scores(df.withColumn("month", F.month("date")), ["app", "month"])


def gender_sentiment(df: DataFrame) -> DataFrame:
    counts = df.groupBy("app", "gender", "sentiment").agg(_n())
    return with_share(counts, ["app", "gender"], "pct_within_app_gender")


def length_by_sentiment(df: DataFrame) -> DataFrame:
    return df.groupBy("app", "sentiment").agg(
        mean(F.sum("word_count"), F.count("word_count"), 1).alias("avg_words"),
        mean(F.sum("content_length"), F.count("content_length"), 1).alias("avg_chars"),
        F.count("word_count").alias("n"),
    )


def length_with_median(df: DataFrame) -> DataFrame:
    """Mean and exact median words by (app, sentiment), from a word-count histogram."""
    hist = df.groupBy("app", "sentiment", "word_count").agg(F.count(F.lit(1)).alias("freq"))
    w, f = F.col("word_count").cast("bigint"), F.col("freq")
    return hist.groupBy("app", "sentiment").agg(
        mean(F.sum(w * f), F.sum(f), 1).alias("avg_words"),
        F.percentile("word_count", F.lit(0.5), F.col("freq")).alias("median_words"),
        F.sum(f).alias("n"),
    )


def compare_apps(
    df: DataFrame, keys: Sequence[str], first: str, second: str, prefix: str = "avg_score_", delta: str | None = None
) -> DataFrame:
    """Mean score per app side by side and the delta of the rounded means.

    Conditional sums in one aggregation; a key seen in one app only has a null
    delta.
    """
    sides = {}
    for app in (first, second):
        score = F.when(F.col("app") == app, F.col("score"))
        sides[app] = mean_units(F.sum(score), F.count(score))
    out = _keyed(df.where(F.col("app").isin(first, second)), keys).groupBy(*keys).agg(
        sides[first].alias("_a"), sides[second].alias("_b")
    )
    return out.select(
        *keys,
        (F.col("_a") / 1000.0).alias(f"{prefix}{first}"),
        (F.col("_b") / 1000.0).alias(f"{prefix}{second}"),
        ((F.col("_a") - F.col("_b")) / 1000.0).alias(delta or f"delta_{first}_vs_{second}"),
    )


def country_comparison(df: DataFrame, first: str, second: str) -> DataFrame:
    return compare_apps(df, ["country", "iso3", "continent"], first, second)


def continent_comparison(df: DataFrame, first: str, second: str) -> DataFrame:
    return compare_apps(df, ["continent"], first, second, prefix="", delta="delta").orderBy("delta", "continent")


def pct_negative_by_app(df: DataFrame) -> DataFrame:
    return df.groupBy("app").agg(_pct(_is("negative")).alias("pct_negative"))


def gender_bias(df: DataFrame) -> DataFrame:
    return df.groupBy("app", "gender").agg(_avg_score().alias("mean"), F.count("score").alias("count"))


def underrepresented(df: DataFrame, app: str, below: int = 30, name: str = "n_reviews") -> DataFrame:
    """Countries with fewer than `below` reviews of one app, smallest first."""
    counts = _keyed(df.where(F.col("app") == app), ["country"]).groupBy("country").agg(_n())
    return counts.where(F.col("n") < below).withColumnRenamed("n", name).orderBy(name, "country")


def negative_spikes(df: DataFrame, k: int = 10) -> DataFrame:
    """The k (app, month) pairs with most negative reviews."""
    counts = df.where(_is("negative")).groupBy("app", "year_month").agg(F.count(F.lit(1)).alias("n_negative"))
    return counts.orderBy(F.desc("n_negative"), "app", "year_month").limit(k)


def polarization(df: DataFrame) -> DataFrame:
    s = F.col("score")
    return df.groupBy("app").agg(
        _pct(s == 1).alias("pct_1_star"),
        _pct(s == 5).alias("pct_5_star"),
        _pct((s == 1) | (s == 5)).alias("polarization"),
    )


def sentiment_crosstab(df: DataFrame) -> DataFrame:
    return df.groupBy("app").agg(*[F.count_if(_is(s)).alias(s) for s in SENTIMENTS])


def profile(df: DataFrame) -> DataFrame:
    """Date range, distinct countries and rows, from one small (app, country) cut."""
    cut = df.groupBy("app", "country").agg(
        F.count(F.lit(1)).alias("n"), F.min("date").alias("lo"), F.max("date").alias("hi")
    )
    return cut.agg(
        F.sum("n").alias("n_rows"),
        F.count_distinct("app").alias("n_apps"),
        F.min("lo").cast("string").alias("min_date"),
        F.max("hi").cast("string").alias("max_date"),
        F.count_distinct("country").alias("n_countries"),
    )


def rows_per_app(df: DataFrame) -> DataFrame:
    return df.groupBy("app").agg(_n())


def class_counts(df: DataFrame, label: str) -> DataFrame:
    """Rows per class and the size of the largest class."""
    counts = _keyed(df, [label]).groupBy(label).agg(_n())
    return counts.withColumn("majority", F.max("n").over(Window.partitionBy()))


def score_band_counts(df: DataFrame) -> DataFrame:
    """Rows with score >= 4, == 3, <= 2 per app, and the largest of the three."""
    out = df.select("app", score_band(F.col("score")).alias("band")).groupBy("app").agg(
        *[F.count_if(F.col("band") == s).alias(s) for s in reversed(SENTIMENTS)]
    )
    return out.withColumn("target", F.greatest(*SENTIMENTS))


def continent_counts(df: DataFrame) -> DataFrame:
    return _keyed(df, ["continent"]).groupBy("continent").agg(_n()).orderBy(F.desc("n"), "continent")


def top_countries(df: DataFrame, k: int = 20) -> DataFrame:
    counts = _keyed(df, ["country"]).groupBy("country").agg(_n())
    return counts.orderBy(F.desc("n"), "country").limit(k)


def extreme_deltas(comparison: DataFrame, delta: str, k: int = 5, largest: bool = True) -> DataFrame:
    """k countries with the largest (or smallest) delta, null deltas left out."""
    order = F.desc(delta) if largest else F.asc(delta)
    return comparison.where(F.col(delta).isNotNull()).orderBy(order, "country").limit(k)


# Dashboard sheets that are not covered by the tables above.


def kpi(df: DataFrame, first: str, second: str) -> DataFrame:
    """Total reviews, mean score of two apps and their delta."""

    def units(app: str) -> Column:
        score = F.when(F.col("app") == app, F.col("score"))
        return mean_units(F.sum(score), F.count(score))

    return df.agg(_n().alias("total_reviews"), units(first).alias("_a"), units(second).alias("_b")).select(
        "total_reviews",
        (F.col("_a") / 1000.0).alias(f"avg_score_{first}"),
        (F.col("_b") / 1000.0).alias(f"avg_score_{second}"),
        ((F.col("_a") - F.col("_b")) / 1000.0).alias("delta"),
    )


def country_map(df: DataFrame, app: str, continents: Sequence[str] | None = None) -> DataFrame:
    """Mean score and volume by country of one app, optionally by continent."""
    df = df.where(F.col("app") == app)
    if continents is not None:
        df = df.where(F.col("continent").isin(*continents))
    keys = ["country", "iso3", "lat", "lon"]
    return _keyed(df, ["country", "iso3"]).groupBy(*keys).agg(_n(), _avg_score().alias("avg_score"))


def monthly_score(df: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Mean score per (app, month), with an inclusive date range."""
    if start is not None:
        df = df.where(F.col("date") >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(F.col("date") <= F.lit(end).cast("date"))
    return df.groupBy("app", "year_month").agg(_n(), _avg_score().alias("avg_score"))


def monthly_volume(df: DataFrame, app: str) -> DataFrame:
    return df.where(F.col("app") == app).groupBy("year_month", "sentiment").agg(_n())


def quarterly_negative(df: DataFrame) -> DataFrame:
    return df.groupBy("app", "quarter").agg(_n(), _pct(_is("negative")).alias("pct_negative"))


def length_boxplot(df: DataFrame) -> DataFrame:
    probs = {"min_words": 0.0, "q1_words": 0.25, "median_words": 0.5, "q3_words": 0.75, "max_words": 1.0}
    return value_quantiles(df, ["sentiment", "app"], "word_count", probs)


def one_star_phase(df: DataFrame, above: float = 1.0) -> DataFrame:
    """Months from an app's first review to the first month with mean score > above."""
    months = df.groupBy("app", "year_month").agg(
        F.min("date").alias("first_date"), F.sum("score").alias("s"), F.count("score").alias("n")
    )
    out = months.groupBy("app").agg(
        F.min("first_date").alias("first_review"),
        F.min(F.when(F.col("s") > above * F.col("n"), F.col("year_month"))).alias("first_month_above"),
    )
    start = F.trunc("first_review", "MM")
    end = F.to_date(F.concat("first_month_above", F.lit("-01")))
    return out.select(
        "app",
        F.col("first_review").cast("string").alias("first_review"),
        "first_month_above",
        F.months_between(end, start).cast("int").alias("months"),
    )


def uniform_months(df: DataFrame) -> DataFrame:
    """Share of months per app in which all reviews have the same score."""
    months = df.groupBy("app", "year_month").agg(F.min("score").alias("lo"), F.max("score").alias("hi"))
    return months.groupBy("app").agg(
        F.count(F.lit(1)).alias("n_months"),
        F.count_if(F.col("lo") == F.col("hi")).alias("n_uniform"),
        _pct(F.col("lo") == F.col("hi")).alias("pct_uniform"),
    )


def score_date_ranges(df: DataFrame) -> DataFrame:
    return df.groupBy("app", "score").agg(_n(), F.min("date").alias("first_date"), F.max("date").alias("last_date"))


def score_date_overlap(df: DataFrame, low: int = 1, high: int = 5) -> DataFrame:
    """Date range of two scores per app and whether the ranges overlap."""
    s, d = F.col("score"), F.col("date")
    spans = df.groupBy("app").agg(
        F.min(F.when(s == low, d)).alias("low_first"), F.max(F.when(s == low, d)).alias("low_last"),
        F.min(F.when(s == high, d)).alias("high_first"), F.max(F.when(s == high, d)).alias("high_last"),
    )
    overlap = (F.col("low_first") <= F.col("high_last")) & (F.col("high_first") <= F.col("low_last"))
    dates = [F.col(c).cast("string").alias(c) for c in spans.columns[1:]]
    return spans.select("app", *dates, F.coalesce(overlap, F.lit(False)).alias("overlap"))
