"""TF-IDF and bag-of-words features.

Fitting is one aggregation by term. Transforming is narrow: terms are counted
inside each row against a vocabulary of bounded size, with no shuffle and no
join, so it runs at scan speed on any number of reviews.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara.functions.text import CLEANERS, feature_tokens
from opinara.operators.ngrams import Count, Cut, counted_terms, frequent_ngrams, gram_counts, ngram_weights
from opinara.session import saved


def _pairs(left: str, right: str, cut: int) -> Column:
    """Each entry of `left` joined with the entry of `right` `cut` places later."""
    n = F.greatest(F.size(right) - cut, F.lit(0))
    return F.zip_with(
        F.slice(left, F.lit(1), n), F.slice(right, F.lit(cut + 1), n), lambda x, y: F.concat_ws(" ", x, y)
    )


def with_terms(
    df: DataFrame, text: Column, ngram_range: tuple[int, int] = (1, 1), stop_words: Sequence[str] = (), name: str = "terms"
) -> DataFrame:
    """Add the list of terms of a text: blank-joined runs of low to high (<= 3) tokens."""
    return with_ngrams(df, feature_tokens(text, stop_words), ngram_range, name)


def with_ngrams(df: DataFrame, tokens: Column, ngram_range: tuple[int, int], name: str = "terms") -> DataFrame:
    """Add the list of n-grams of a token list."""
    low, high = ngram_range
    out = df.withColumn("_g1", tokens)
    if high > 1:
        out = out.withColumn("_g2", _pairs("_g1", "_g1", 1))
    if high > 2:
        out = out.withColumn("_g3", _pairs("_g2", "_g1", 2))
    lists = [f"_g{n}" for n in range(low, high + 1)]
    return out.withColumn(name, F.concat(*lists)).drop("_g1", "_g2", "_g3")


def term_stats(df: DataFrame, terms: str = "terms", keys: Sequence[str] = ()) -> DataFrame:
    """Corpus frequency and document frequency of every term, in each segment if there are keys.

    Without keys, tasks count a piece of the rows at a time and send each of its terms once.
    Else each list is sorted in its row, which marks a term's first occurrence; so
    one aggregation by term gives both counts, without a distinct per review.
    """
    if not keys:
        return counted_terms(df, terms).groupBy("term").agg(F.sum("ctf").alias("ctf"), F.sum("df").alias("df"))
    s = F.col("_s")
    ordered = df.select(*keys, F.sort_array(terms).alias("_s"))
    previous = F.concat(F.array(F.lit(None).cast("string")), F.slice(s, F.lit(1), F.greatest(F.size(s) - 1, F.lit(0))))
    marked = ordered.select(
        *keys, F.explode(F.zip_with(s, previous, lambda x, p: F.struct(x.alias("term"), (~x.eqNullSafe(p)).cast("int").alias("first")))).alias("t")
    ).where(F.col("t.term").isNotNull())
    return marked.groupBy(*keys, F.col("t.term").alias("term")).agg(
        F.count(F.lit(1)).alias("ctf"), F.sum("t.first").alias("df")
    )


@dataclass(frozen=True)
class Tfidf:
    """A fitted vocabulary with its inverse document frequencies."""

    terms: list[str]
    ctf: list[int]
    df: list[int]
    n_docs: int
    sublinear: bool = True
    idf: list[float] = field(default_factory=list)

    def __post_init__(self):
        object.__setattr__(self, "idf", [math.log((1 + self.n_docs) / (1 + d)) + 1.0 for d in self.df])

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [*zip(range(len(self.terms)), self.terms, self.ctf, self.df, self.idf)]
        return spark.createDataFrame(rows, "term_id int, term string, ctf bigint, df bigint, idf double")

    def weights(self, df: DataFrame, terms: str = "terms", name: str = "w") -> DataFrame:
        """Add a struct (indices, values): L2-normalised tf-idf of each row."""
        return _weights(df, terms, name, self.terms, self.idf, self.sublinear)

    def long(self, df: DataFrame, id_col: str = "reviewId", terms: str = "terms") -> DataFrame:
        """Long table (id, term, weight)."""
        return self._long(self.weights(df.select(id_col, terms), terms), id_col)

    def long_ngrams(self, df: DataFrame, tokens: Column, id_col: str = "reviewId") -> DataFrame:
        """Long table (id, term, weight) over the n-grams of a token list."""
        weights = ngram_weights(tokens, self.terms, self.idf, self.sublinear)
        return self._long(df.select(id_col, weights.alias("w")), id_col)

    def _long(self, w: DataFrame, id_col: str) -> DataFrame:
        names = F.lit(np.array(self.terms))
        pairs = w.select(id_col, F.explode(F.arrays_zip("w.indices", "w.values")).alias("p"))
        return pairs.select(id_col, F.get(names, F.col("p.indices")).alias("term"), F.col("p.values").alias("weight"))


def fit_tfidf(
    df: DataFrame, terms: str = "terms", max_features: int = 7000, min_df: int = 1, sublinear: bool = True
) -> Tfidf:
    """Keep the max_features terms with the highest corpus frequency.

    Ties go by the term. The kept vocabulary, of bounded size, comes to the
    driver in alphabetical order.
    """
    stats = term_stats(df, terms).where(F.col("df") >= min_df)
    rows = sorted(stats.orderBy(F.desc("ctf"), "term").limit(max_features).collect(), key=lambda r: r["term"])
    return Tfidf(
        [r["term"] for r in rows], [r["ctf"] for r in rows], [r["df"] for r in rows], df.count(), sublinear
    )


def least_texts(min_df: int | float, n_docs: int) -> int:
    """Number of texts a term has to lie in: min_df itself, or that share of all texts if it is a float."""
    return math.ceil(min_df * n_docs) if isinstance(min_df, float) else min_df


def fit_ngrams(
    df: DataFrame, tokens: Column, ngram_range: tuple[int, int] = (1, 3), max_features: int = 7000, min_df: int | float = 1,
    sublinear: bool = True,
) -> Tfidf:
    """As fit_tfidf over the n-grams of a token list, counted level by level.

    Without single words among the terms there is no bound to begin with; all n-grams are
    then counted at once. A float min_df is a share of the texts.
    """
    rows = df.select(tokens.alias("_tokens"))
    n_docs = df.count()
    min_df = least_texts(min_df, n_docs)
    if ngram_range[0] > 1:
        return fit_tfidf(with_ngrams(rows, F.col("_tokens"), ngram_range), "terms", max_features, min_df, sublinear)
    stats = saved(term_stats(rows, "_tokens"), "word-counts")
    return _fitted(frequent_ngrams(rows, "_tokens", stats, ngram_range, max_features, min_df), n_docs, sublinear)


def _fitted(counts: Sequence[Count], n_docs: int, sublinear: bool) -> Tfidf:
    found = sorted(counts)
    return Tfidf([c.term for c in found], [c.ctf for c in found], [c.df for c in found], n_docs, sublinear)


@dataclass(frozen=True)
class TermSetting:
    """Which terms a model uses: n-gram lengths, words left out, size, least number or share of texts."""

    ngram_range: tuple[int, int] = (1, 3)
    stop_words: tuple[str, ...] = ()
    max_features: int = 7000
    min_df: int | float = 1

    def cut(self, n_docs: int) -> Cut:
        return Cut(*self.ngram_range, self.max_features, least_texts(self.min_df, n_docs))


def fit_settings(df: DataFrame, tokens: str, settings: Sequence[TermSetting], sublinear: bool = True) -> list[Tfidf]:
    """One vocabulary per setting over the same token lists, all from one table of term statistics.

    Stop words have to be out of the lists already. Settings that begin with single words share
    one count by levels; the others share one aggregation over all n-grams they use.
    """
    n_docs = df.count()
    cuts = [s.cut(n_docs) for s in settings]
    counts: list[Count] = []
    if any(c.low == 1 for c in cuts):
        stats = saved(term_stats(df, tokens), "word-counts")
        counts = gram_counts(df, tokens, stats, [c for c in cuts if c.low == 1])
    longer = [c for c in cuts if c.low > 1]
    if longer:
        span = min(c.low for c in longer), max(c.high for c in longer)
        stats = term_stats(with_ngrams(df.select(tokens), F.col(tokens), span))
        stats = saved(stats.withColumn("words", F.size(F.split("term", " "))), "term-counts")

    def found(cut: Cut) -> list[Count]:
        if cut.low == 1:
            return cut.of(counts)
        mine = stats.where(F.col("words").between(cut.low, cut.high) & (F.col("df") >= cut.min_df))
        best = mine.orderBy(F.desc("ctf"), "term").limit(cut.max_features).collect()
        return [Count(r["term"], r["words"], r["ctf"], r["df"]) for r in best]

    return [_fitted(found(c), n_docs, sublinear) for c in cuts]


def count_terms(df: DataFrame, vocabulary: Sequence[str], terms: str, name: str = "counts") -> DataFrame:
    """Add the sparse vector of term counts against a fixed vocabulary."""
    model = CountVectorizerModel.from_vocabulary(list(vocabulary), inputCol=terms, outputCol=name)
    return model.transform(df)


def _weights(
    df: DataFrame, terms: str, name: str, vocabulary: Sequence[str], idf: Sequence[float], sublinear: bool
) -> DataFrame:
    if not len(vocabulary):
        empty = F.struct(
            F.array().cast("array<int>").alias("indices"), F.array().cast("array<double>").alias("values")
        )
        return df.withColumn(name, empty)
    idf_of = F.lit(np.array(idf, dtype="float64"))
    counted = count_terms(df, vocabulary, terms, "_cv").withColumn("_u", F.unwrap_udt("_cv")).drop("_cv")

    def weight(i: Column, tf: Column) -> Column:
        return (F.log(tf) + 1.0 if sublinear else tf) * F.get(idf_of, i)

    raw = counted.withColumn("_raw", F.zip_with("_u.indices", "_u.values", weight))
    # Two uses of the norm keep it a column of its own, computed once per row.
    normed = raw.withColumn("_l2", F.sqrt(F.aggregate("_raw", F.lit(0.0), lambda a, x: a + x * x)))
    l2 = F.col("_l2")
    values = F.when(l2 > 0, F.transform("_raw", lambda x: x / l2)).otherwise(F.col("_raw"))
    return normed.withColumn(
        name, F.struct(F.col("_u.indices").alias("indices"), values.alias("values"))
    ).drop("_u", "_raw", "_l2")


def pack_vector(indices: Column, values: Column, size: int) -> Column:
    """Sparse ML vector from index and value lists, batch-wise through Arrow."""

    @F.arrow_udf(VectorUDT())
    def pack(i: pa.Array, v: pa.Array) -> pa.Array:
        n = len(i)
        return pa.StructArray.from_arrays(
            [pa.array(np.zeros(n, "int8")), pa.array(np.full(n, size, "int32")), i, v],
            names=["type", "size", "indices", "values"],
        )

    return pack(indices, values)


class TfidfVectoriser(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Pipeline stage from raw text to an ML vector: cleaner, n-grams, tf-idf.

    The cleaner is part of the saved stage, so a stored pipeline always scores
    text the way it was trained.
    """

    inputCol = Param(Params._dummy(), "inputCol", "text column", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "vector column", TypeConverters.toString)
    cleaner = Param(Params._dummy(), "cleaner", "'letters' or 'ascii'", TypeConverters.toString)
    ngramRange = Param(Params._dummy(), "ngramRange", "lowest and highest n", TypeConverters.toListInt)
    stopWords = Param(Params._dummy(), "stopWords", "words left out", TypeConverters.toListString)
    vocabulary = Param(Params._dummy(), "vocabulary", "terms", TypeConverters.toListString)
    idf = Param(Params._dummy(), "idf", "weight per term", TypeConverters.toListFloat)
    sublinear = Param(Params._dummy(), "sublinear", "1 + ln(tf) instead of tf", TypeConverters.toBoolean)

    @keyword_only
    def __init__(
        self, *, inputCol=None, outputCol=None, cleaner=None, ngramRange=None, stopWords=None, vocabulary=None,
        idf=None, sublinear=None,
    ):
        super().__init__()
        self._setDefault(
            inputCol="content", outputCol="features", cleaner="letters", ngramRange=[1, 3], stopWords=[], sublinear=True
        )
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def tokens(self) -> Column:
        get = self.getOrDefault
        return feature_tokens(CLEANERS[get("cleaner")](F.col(get("inputCol"))), get("stopWords"))

    def fit(
        self, df: DataFrame, max_features: int = 7000, min_df: int | float = 1, tokens: Column | None = None
    ) -> TfidfVectoriser:
        """The vectoriser with its vocabulary, learned from the texts or from their tokens if they are there already."""
        get = self.getOrDefault
        found = self.tokens() if tokens is None else tokens
        return self.fitted(fit_ngrams(df, found, tuple(get("ngramRange")), max_features, min_df, get("sublinear")))

    def fitted(self, model: Tfidf) -> TfidfVectoriser:
        return self.copy()._set(vocabulary=model.terms, idf=model.idf)

    def weights(self, df: DataFrame, name: str = "w", tokens: Column | None = None) -> DataFrame:
        """The vector as a struct (indices, values), from the text or from its tokens if they are there already."""
        get = self.getOrDefault
        found = self.tokens() if tokens is None else tokens
        return df.withColumn(name, ngram_weights(found, get("vocabulary"), get("idf"), get("sublinear")))

    def _transform(self, df: DataFrame) -> DataFrame:
        size = len(self.getOrDefault("vocabulary"))
        out = self.weights(df, "_w")
        return out.withColumn(
            self.getOrDefault("outputCol"), pack_vector(F.col("_w.indices"), F.col("_w.values"), size)
        ).drop("_w")


def bag_of_words(df: DataFrame, tokens: str = "tokens", id_col: str = "reviewId") -> DataFrame:
    """Long table (id, term, n) over all terms of each review.

    The run lengths of the sorted list are the counts; nothing is shuffled.
    """
    s, at = F.col("_s"), F.col("_at")
    ordered = df.select(id_col, F.sort_array(tokens).alias("_s"))
    # An empty list gives one run of a null term, dropped after the explode.
    places = F.sequence(F.lit(1), F.greatest(F.size(s), F.lit(1)))
    starts = F.filter(places, lambda i: (i == 1) | (F.get(s, i - 1) != F.get(s, F.greatest(i - 2, F.lit(0)))))
    marked = ordered.withColumn("_at", starts)
    ends = F.concat(F.slice(at, F.lit(2), F.size(at) - 1), F.array(F.size(s) + 1))
    runs = F.zip_with(at, ends, lambda a, b: F.struct(F.get(s, a - 1).alias("term"), (b - a).cast("bigint").alias("n")))
    out = marked.select(id_col, F.explode(runs).alias("r")).select(id_col, "r.term", "r.n")
    return out.where(F.col("term").isNotNull())
