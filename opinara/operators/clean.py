"""Validation and derivation: raw review fields (all strings) to typed reviews."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.functions.labels import class_label, sentiment, to_number
from opinara.functions.text import SPACE_CHARS, strip_space

# Gender values that count as valid.
VALID_GENDERS = ("male", "female")

DATE_FORMATS = ("yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "yyyy/MM/dd", "MM/dd/yyyy")

# Output columns of the unified review table, in order.
UNIFIED_COLUMNS = (
    "reviewId", "app", "date", "year", "quarter", "year_month",
    "score", "sentiment", "gender",
    "city", "country", "location",
    "content", "content_length", "word_count",
)


_FILLED = f"[^{SPACE_CHARS}]"


def drop_junk_columns(df: DataFrame) -> DataFrame:
    """Drop unnamed index columns left by spreadsheet exports."""
    return df.select([F.col(f"`{c}`") for c in df.columns if not c.startswith("Unnamed")])


def text_column(df: DataFrame, wanted: str) -> str:
    """The wanted column, or the first one when it is missing."""
    return wanted if wanted in df.columns else df.columns[0]


def require_columns(df: DataFrame, *groups: Sequence[str]) -> DataFrame:
    """Fail at plan time unless each group has at least one column present."""
    for group in groups:
        if not any(c in df.columns for c in group):
            raise ValueError(f"need one of the columns {list(group)}, found {df.columns}")
    return df


def keep_present(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Project the wanted columns that exist, in the wanted order."""
    return df.select([c for c in wanted if c in df.columns])


def rename_if_present(df: DataFrame, old: str, new: str) -> DataFrame:
    return df.withColumnRenamed(old, new) if old in df.columns else df


def coerce_score(df: DataFrame, column: str = "score") -> DataFrame:
    """Non-numeric scores become null and the rows are dropped."""
    return df.withColumn(column, to_number(F.col(column))).where(F.col(column).isNotNull())


def score_in_range(df: DataFrame, column: str = "score", low: int = 1, high: int = 5) -> DataFrame:
    """Keep low <= score <= high, then truncate to int."""
    return df.where(F.col(column).between(low, high)).withColumn(column, F.col(column).cast("int"))


def parse_date(text: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """First matching format wins; unparseable text becomes null."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)).cast("date") for f in formats])


def nonblank(text: Column) -> Column:
    """True for text with a visible character; false for null."""
    return F.coalesce(text.rlike(_FILLED), F.lit(False))


def split_location(location: Column) -> tuple[Column, Column]:
    """'City, Country' to (city, country); one part is a country; blank is neither."""
    parts = F.split(location, ",")
    filled = strip_space(location) != ""
    city = F.when(filled & (F.size(parts) > 1), strip_space(F.element_at(parts, 1)))
    country = F.when(filled, strip_space(F.element_at(parts, -1)))
    return city, country


def reject_reason() -> Column:
    """The first rule a raw row breaks, or null for a valid row."""
    score = to_number(F.col("score"))
    return (
        F.when(~F.coalesce(score.between(1, 5), F.lit(False)), "score")
        .when(~F.coalesce(F.col("gender").isin(*VALID_GENDERS), F.lit(False)), "gender")
        .when(parse_date(F.col("date")).isNull(), "date")
        .when(~nonblank(F.col("content")), "content")
    )


def reject_report(raw: DataFrame, app: str = "app") -> DataFrame:
    """Rows before, kept and dropped per app and rule, in one pass."""
    reasons = ("score", "gender", "date", "content")
    tagged = raw.select(F.col(app).alias("app"), reject_reason().alias("reason"))
    return tagged.groupBy("app").agg(
        F.count(F.lit(1)).alias("n_before"),
        F.count_if(F.col("reason").isNull()).alias("n_kept"),
        F.count("reason").alias("n_dropped"),
        *[F.count_if(F.col("reason") == r).alias(f"dropped_{r}") for r in reasons],
    )


def validate(raw: DataFrame) -> DataFrame:
    """Keep the rows that pass every rule, with typed score and date.

    One filter per rule, so that Catalyst can push the plain ones to the scan.
    """
    return (
        raw.where(F.col("gender").isin(*VALID_GENDERS))
        .where(to_number(F.col("score")).between(1, 5))
        .where(parse_date(F.col("date")).isNotNull())
        .where(F.col("content").rlike(_FILLED))
        .withColumns({"score": to_number(F.col("score")).cast("int"), "date": parse_date(F.col("date"))})
    )


def derive(valid: DataFrame) -> DataFrame:
    """Add sentiment, place, calendar and length columns."""
    city, country = split_location(F.col("location"))
    date = F.col("date")
    return valid.withColumns(
        {
            "sentiment": sentiment(F.col("score")),
            "city": city,
            "country": country,
            "year": F.year(date),
            "year_month": F.date_format(date, "yyyy-MM"),
            "quarter": F.concat(F.year(date), F.lit("Q"), F.quarter(date)),
            "content_length": F.length("content"),
            "word_count": F.size(F.regexp_extract_all("content", F.lit(_FILLED + "+"), F.lit(0))),
        }
    )


def load_reviews(raw: DataFrame, app: str | None = None) -> DataFrame:
    """Raw strings to the unified review table. `app` tags a single-app input."""
    if app is not None:
        raw = raw.withColumn("app", F.lit(app))
    return derive(validate(raw)).select(*UNIFIED_COLUMNS)


def union_apps(tables: Sequence[DataFrame]) -> DataFrame:
    """Stack per-app tables by column name."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def with_label(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Add the 0/1/2 label from the score, only where no label column exists."""
    require_columns(df, (label, score))
    if label in df.columns:
        return df
    return coerce_score(df, score).withColumn(label, class_label(F.col(score)))


def with_sentiment(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Sentiment of the untruncated score; rows without a number are dropped."""
    return coerce_score(df, score).withColumn(label, sentiment(F.col(score)))
