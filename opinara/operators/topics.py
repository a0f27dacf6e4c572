"""Topic models per segment: K-Means on TF-IDF, LDA on word counts."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinara.functions.text import feature_tokens, first_k, split_words
from opinara.operators.centroids import fit_clusters, segment_code
from opinara.operators.features import term_stats
from opinara.operators.lda import TopicModels, fit_topics
from opinara.operators.neighbours import nearest
from opinara.session import saved

# Topic names by sentiment and cluster.
TOPIC_NAMES = {
    "positive": (
        "Calidad de la Comunidad y Perfiles Auténticos",
        "Optimización del Tiempo y Éxito en Matches",
        "Buena Experiencia de Usuario",
        "Eficacia en el Descubrimiento de Personas",
    ),
    "negative": (
        "Problemas Críticos de Baneos y Gestión de Cuenta",
        "Barreras de Pago y Limitaciones de Monetización",
        "Inseguridad: Perfiles Falsos y Estafas",
        "Mala Comunicación y Mensajería",
    ),
    "neutral": (
        "Primeros Pasos e Introducción al Sistema",
        "Valoración del Modelo de Suscripción",
        "Opinión del Funcionamiento de la App",
        "Novedades y Actualizaciones en el Sistema de Pago",
    ),
}

# Columns of the topic table, in order.
TOPIC_COLUMNS = (
    "reviewId", "content", "score", "gender", "location", "date", "app",
    "sentimiento_analisis", "texto_limpio", "num_palabras", "Cluster_Dominante",
    "Tema_Nombre", "Prob_Topico_0", "Prob_Topico_1", "Prob_Topico_2", "Prob_Topico_3",
    "Palabras_Clave", "Modelo", "Longitud",
)

WORD_THRESHOLD = 10


def topic_names(spark) -> DataFrame:
    """The topic-name dimension: sentiment, cluster, name."""
    rows = [(s, i, n) for s, names in TOPIC_NAMES.items() for i, n in enumerate(names)]
    return spark.createDataFrame(rows, "sentiment string, cluster int, name string")


def name_topics(df: DataFrame, names: DataFrame, sentiment: str = "sentiment", cluster: str = "cluster") -> DataFrame:
    """Add Tema_Nombre by (sentiment, cluster); unknown pairs get null."""
    dim = names.select(
        F.col("sentiment").alias(sentiment), F.col("cluster").alias(cluster), F.col("name").alias("Tema_Nombre")
    )
    return df.join(dim, [sentiment, cluster], "left")


def dominant_topic(probabilities: Column) -> Column:
    """Index of the largest probability; the first one wins a tie."""
    return (F.array_position(probabilities, F.array_max(probabilities)) - 1).cast("int")


def hybrid_topic(words: Column, lda: Column, kmeans: Column, threshold: int = WORD_THRESHOLD) -> tuple[Column, Column]:
    """(cluster, model name): LDA for texts above the word threshold, else K-Means."""
    long = words > threshold
    return F.when(long, lda).otherwise(kmeans), F.when(long, F.lit("LDA")).otherwise(F.lit("K-Means"))


def segment_features(
    df: DataFrame, text: str, keys: Sequence[str] = (), max_features: int = 1000, stop_words: Sequence[str] = ()
) -> tuple[DataFrame, dict[tuple, list[str]]]:
    """df with `features`, unigram tf-idf with raw counts as struct (indices, values), and the vocabularies.

    Every segment (combination of keys) has its own vocabulary, its max_features most
    frequent terms in alphabetical order, and its own document frequencies.
    """
    rows = df.withColumn("_terms", F.coalesce(feature_tokens(F.col(text), stop_words), F.array().cast("array<string>")))
    stats = term_stats(rows, "_terms", keys)
    order = Window.partitionBy(*keys).orderBy(F.desc("ctf"), "term")
    kept = stats.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= max_features).drop("_r").collect()
    sizes = {tuple(r)[:-1]: r["n"] for r in rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).collect()}
    terms: dict[tuple, list] = {s: [] for s in sorted(sizes)}
    for r in sorted(kept, key=lambda r: r["term"]):
        terms[tuple(r)[: len(keys)]].append((r["term"], math.log((1 + sizes[tuple(r)[: len(keys)]]) / (1 + r["df"])) + 1.0))
    vocabularies = [pa.array([t for t, _ in rows_], pa.string()) for rows_ in terms.values()]
    idf = [np.array([w for _, w in rows_] + [0.0]) for rows_ in terms.values()]

    @F.arrow_udf("struct<indices: array<int>, values: array<double>>")
    def weigh(seg: pa.Array, lists: pa.Array) -> pa.Array:
        n = len(lists)
        seg = seg.to_numpy()
        owner = np.repeat(np.arange(n), lists.value_lengths().to_numpy())
        flat = lists.flatten()
        pairs, values = [], []
        for s in np.unique(seg).tolist():
            mine = np.flatnonzero(seg[owner] == s)
            code = pc.index_in(flat.take(pa.array(mine)), value_set=vocabularies[s])
            used = mine[code.is_valid().to_numpy(zero_copy_only=False)]
            found, count = np.unique(owner[used] * max_features + code.drop_null().to_numpy(), return_counts=True)
            pairs.append(found)
            values.append(count * idf[s][found % max_features])
        pair, value = np.concatenate([np.zeros(0, np.int64), *pairs]), np.concatenate([np.zeros(0), *values])
        order = np.argsort(pair)
        pair, value = pair[order], value[order]
        row = pair // max_features
        norm = np.sqrt(np.bincount(row, weights=value * value, minlength=n))
        offsets = pa.array(np.searchsorted(row, np.arange(n + 1)), pa.int32())
        return pa.StructArray.from_arrays(
            [
                pa.ListArray.from_arrays(offsets, pa.array(pair % max_features, pa.int32())),
                pa.ListArray.from_arrays(offsets, pa.array(value / norm[row])),
            ],
            ["indices", "values"],
        )

    out = rows.withColumn("features", weigh(segment_code(keys, list(terms)), F.col("_terms"))).drop("_terms")
    return out, {s: [t for t, _ in rows_] for s, rows_ in terms.items()}


def assign_to_centroids(
    df: DataFrame, centroids: DataFrame, dim: int, id_col: str, vector: str = "vector", cluster: str = "cluster"
) -> DataFrame:
    """(id, cluster, squared distance in nano units) for fixed centroids; ties to the lower cluster."""
    found = nearest(
        df.withColumnRenamed(id_col, "_id"), centroids.select(cluster, vector), 1, dim,
        query_id="_id", base_id=cluster, vector=vector, metric="euclidean",
    )
    return found.select(F.col("_id").alias(id_col), cluster, "dist_nano")


def with_topic_probabilities(df: DataFrame, models: TopicModels, k: int = 4) -> DataFrame:
    """Add lda_probs (array of k) by row id; a text without words gets 1 / k each."""
    found = models.probabilities(k).withColumnRenamed("probs", "lda_probs")
    flat = F.array(*[F.lit(1.0 / k)] * k)
    return df.join(found, models.row_id, "left").withColumn("lda_probs", F.coalesce("lda_probs", flat))


def topic_table(
    reviews: DataFrame, segments: Sequence[tuple[str, str]], names: DataFrame, app: str = "app",
    sentiment: str = "sentiment", text: str = "texto_limpio", k: int = 4, n_init: int = 10, passes: int = 10, seed: int = 42,
    stop_words: Sequence[str] = (), threshold: int = WORD_THRESHOLD, max_features: int = 1000,
) -> DataFrame:
    """Cluster every (app, sentiment) segment by its own models and add the topic columns.

    All segments are modelled together; the reviews are read once. A segment without rows
    gives none. Rows are told apart by a number of their own, so ids may repeat.
    """
    keys = [app, sentiment]
    # Other columns would be computed and written for nothing.
    reviews = reviews.select([c for c in reviews.columns if c in {*keys, text, *TOPIC_COLUMNS}])
    wanted = reviews.where(F.col(text).isNotNull() & (segment_code(keys, list(segments)) >= 0))
    rows = wanted.withColumns({"_row": F.monotonically_increasing_id(), "_tokens": split_words(F.col(text))})
    rows = saved(rows.withColumn("num_palabras", F.size("_tokens")), "segment-rows")
    features, _ = segment_features(rows, text, keys, max_features, stop_words)
    features = saved(features.drop("_tokens"), "segment-features")
    clusters = fit_clusters(features, "_row", max_features, keys, [k], n_init, seed)
    models = fit_topics(rows, "_tokens", "_row", keys, [k], passes, seed)
    scored = with_topic_probabilities(features.withColumn("kmeans_cluster", clusters.assign(F.col("features"), k)), models, k)
    cluster, used = hybrid_topic(
        F.col("num_palabras"), dominant_topic(F.col("lda_probs")), F.col("kmeans_cluster"), threshold
    )
    out = scored.withColumns(
        {
            "sentimiento_analisis": F.col(sentiment),
            "Cluster_Dominante": cluster,
            "Modelo": used,
            "Palabras_Clave": first_k(F.col(text)),
            "Longitud": F.col("num_palabras"),
            **{f"Prob_Topico_{i}": F.col("lda_probs")[i] for i in range(k)},
        }
    )
    out = name_topics(out, names, "sentimiento_analisis", "Cluster_Dominante")
    return out.select([c for c in TOPIC_COLUMNS if c in out.columns])
