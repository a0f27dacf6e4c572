"""From review texts to named topics and their words."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.functions.text import SPACE_CHARS, emoji_to_words, expand_contractions
from opinara.operators.clean import nonblank, rename_if_present, text_column
from opinara.operators.tokens import apply_phrases, join_tokens, learn_phrases, lemmatise, vocabulary
from opinara.operators.topics import topic_table
from opinara.operators.words import top_words_per_topic
from opinara.session import saved


def surface_tokens(df: DataFrame, text: str, emoji: Mapping[str, str], name: str = "tokens") -> DataFrame:
    """Words and single marks of the text after emoji naming and contractions."""
    plain = emoji_to_words(F.col(text), emoji) if emoji else F.col(text)
    pattern = f"[\\p{{L}}\\p{{N}}]+|[^\\p{{L}}\\p{{N}}{SPACE_CHARS}]"
    return df.withColumn(name, F.regexp_extract_all(expand_contractions(plain), F.lit(pattern), F.lit(0)))


def normalise_texts(
    df: DataFrame, lexicon: DataFrame, stop_words: Sequence[str], emoji: Mapping[str, str] | None = None,
    text: str = "content", min_count: int = 5, threshold: float = 10.0,
) -> tuple[DataFrame, DataFrame]:
    """(reviews with text_final, vocabulary): lemmas, negations and learned pairs.

    lexicon(token, lemma, pos) is user-supplied. The lemma lists are written
    once, since the pairs are learned from them and then applied to them.
    """
    column = text_column(df, text)
    rows = df.where(nonblank(F.col(column)))
    lemmas = lemmatise(surface_tokens(rows, column, emoji or {}), lexicon, stop_words)
    lemmas = saved(lemmas.drop("tokens").withColumnRenamed("lemmas", "tokens"), "lemmas")
    merged = apply_phrases(lemmas, learn_phrases(lemmas, "tokens", min_count, threshold))
    merged = saved(merged, "merged-tokens")
    return join_tokens(merged), vocabulary(merged)


def topic_report(
    normalised: DataFrame, segments: Sequence[tuple[str, str]], names: DataFrame, k: int = 50, **options
) -> tuple[DataFrame, DataFrame]:
    """(topic table, top words per app, sentiment and topic)."""
    texts = rename_if_present(normalised, "text_final", "texto_limpio")
    topics = saved(topic_table(texts, segments, names, **options), "topics")
    words = top_words_per_topic(topics, ["app", "sentimiento_analisis", "Tema_Nombre"], "texto_limpio", k)
    return topics, words
