"""Word counts and top words per group.

Words are exploded and counted with map-side partial sums: the text of a group
is never brought together, so a dominant group only adds partial counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinara.functions.rounding import half_up
from opinara.functions.text import latin_tokens, word_tokens


def count_words(df: DataFrame, keys: Sequence[str], tokens: Column, name: str = "freq") -> DataFrame:
    """Occurrences of each token per group."""
    words = df.select(*keys, F.explode(tokens).alias("word"))
    return words.groupBy(*keys, "word").agg(F.count(F.lit(1)).alias(name))


def word_counts(df: DataFrame, keys: Sequence[str], text: str, **options) -> DataFrame:
    for k in keys:
        df = df.where(F.col(k).isNotNull())
    return count_words(df, keys, word_tokens(F.col(text), **options))


def top_per_group(counts: DataFrame, keys: Sequence[str], k: int, freq: str = "freq") -> DataFrame:
    """The k most frequent words per group; ties go by the word.

    The rank limit is applied in the map tasks first, so at most k rows per
    group and task are shuffled.
    """
    w = Window.partitionBy(*keys).orderBy(F.desc(freq), "word")
    return counts.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= k).drop("_rank")


def top_words_per_topic(df: DataFrame, keys: Sequence[str], text: str, k: int = 50) -> DataFrame:
    return top_per_group(word_counts(df, keys, text), keys, k)


def top_words_per_segment(
    df: DataFrame, text: str, keys: Sequence[str] = ("app", "sentiment"), k: int = 30, stop_words: Sequence[str] = ()
) -> DataFrame:
    """Top words per segment with the segment's reviews and words per review."""
    tokens = F.filter(latin_tokens(F.col(text)), lambda w: ~w.isin(*stop_words)) if stop_words else latin_tokens(F.col(text))
    top = top_per_group(count_words(df, keys, tokens), keys, k)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_reviews_in_segment"))
    return top.join(sizes, list(keys)).withColumn(
        "freq_per_review", half_up(F.col("freq") / F.col("n_reviews_in_segment"), 4)
    )


def words_pivot(top: DataFrame, segments: Sequence[tuple[str, str]]) -> DataFrame:
    """Word by app_sentiment matrix of frequencies; a missing pair is 0.0."""

    def cell(app: str, sentiment: str) -> Column:
        hit = (F.col("app") == app) & (F.col("sentiment") == sentiment)
        return F.coalesce(F.sum(F.when(hit, F.col("freq"))).cast("double"), F.lit(0.0)).alias(f"{app}_{sentiment}")

    return top.groupBy("word").agg(*[cell(a, s) for a, s in segments]).orderBy("word")


def worst_words(df: DataFrame, text: str, app: str, sentiment: str, k: int = 10) -> DataFrame:
    """Top k words of one segment."""
    one = df.where((F.col("app") == app) & (F.col("sentiment") == sentiment))
    counts = count_words(one, [], latin_tokens(F.col(text)))
    return counts.orderBy(F.desc("freq"), "word").limit(k)
