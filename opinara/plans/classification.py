"""Sentiment models: training, comparison, storage and hold-out evaluation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinara.operators.evaluate import classification_report, macro_f1
from opinara.operators.features import TermSetting, TfidfVectoriser, fit_settings, pack_vector
from opinara.operators.hash_order import group_sizes
from opinara.operators.neighbours import knn_classify, knn_neighbours, smote
from opinara.operators.text_neighbours import nearest_texts
from opinara.session import saved

# Default class weights of the logistic regression.
CLASS_WEIGHTS = {0: 1.8, 1: 2.3, 2: 0.5}

_KNN_OPTIONS = "k int, metric string, weights string"


@dataclass(frozen=True)
class Knn:
    """Nearest-neighbour voting: metric 'cosine' or 'euclidean', weights 'distance' or 'uniform'."""

    k: int = 5
    metric: str = "cosine"
    weights: str = "distance"


@dataclass(frozen=True)
class Logistic:
    """Logistic regression; class weights by label, 'balanced' or None."""

    C: float = 0.5
    class_weights: Mapping[int, float] | str | None = field(default_factory=lambda: CLASS_WEIGHTS)
    max_iter: int = 5000
    tol: float = 1e-6


def _weight(label: Column, weights: Mapping[int, float]) -> Column:
    w = F.lit(1.0)
    for c, x in weights.items():
        w = F.when(label == c, float(x)).otherwise(w)
    return w


def balanced_weights(df: DataFrame, label: str = "label") -> dict[int, float]:
    """Weights under which all classes count the same: rows / (classes * rows of the class)."""
    sizes = group_sizes(df, label)
    return {int(c): sum(sizes.values()) / (len(sizes) * n) for c, n in sizes.items()}


def fit_logistic(
    df: DataFrame, features: str = "features", label: str = "label", C: float = 0.5,
    class_weights: Mapping[int, float] | str | None = CLASS_WEIGHTS, max_iter: int = 5000, tol: float = 1e-6,
):
    """Multinomial logistic regression with an L2 penalty of strength 1 / C.

    `class_weights` maps labels to weights; 'balanced' weighs every class by rows / (classes *
    rows of the class). The weighted training table is written once before the iterations start.
    """
    if class_weights == "balanced":
        class_weights = balanced_weights(df, label)
    rows = df.select(
        F.col(features).alias("features"), F.col(label).cast("double").alias("label"),
        _weight(F.col(label), class_weights or {}).alias("weight"),
    )
    rows = saved(rows, "training-rows")
    total = rows.agg(F.sum("weight")).first()[0]
    return LogisticRegression(
        featuresCol="features", labelCol="label", weightCol="weight", family="multinomial", standardization=False,
        regParam=1.0 / (C * total), elasticNetParam=0.0, maxIter=max_iter, tol=tol,
    ).fit(rows)


@dataclass
class LogisticText:
    """Vectoriser and logistic regression in one stored pipeline."""

    pipeline: PipelineModel
    kind: str = "LR"

    def predict(self, df: DataFrame, id_col: str = "reviewId", vector: str | None = None) -> DataFrame:
        """df with `prediction`; `vector` names the column of the vectors if they are there already."""
        if vector is None:
            out = self.pipeline.transform(df)
        else:
            vectoriser, fitted = self.pipeline.stages
            size = len(vectoriser.getOrDefault("vocabulary"))
            packed = pack_vector(F.col(f"{vector}.indices"), F.col(f"{vector}.values"), size)
            out = fitted.transform(df.withColumn(fitted.getFeaturesCol(), packed))
        return out.select(*df.columns, F.col("prediction").cast("int").alias("prediction"))

    def save(self, path: str) -> None:
        self.pipeline.write().overwrite().save(f"{path}/pipeline")


@dataclass
class KnnText:
    """Vectoriser and stored training vectors for nearest-neighbour voting."""

    vectoriser: TfidfVectoriser
    train: DataFrame
    k: int = 5
    metric: str = "cosine"
    weights: str = "distance"
    kind: str = "KNN"

    def predict(
        self, df: DataFrame, id_col: str = "reviewId", vector: str | None = None, found: DataFrame | None = None
    ) -> DataFrame:
        """df with `prediction`; `vector` names the column of the vectors, `found` holds the neighbours, if they are there already."""
        if vector is None:
            rows = self.vectoriser.weights(df.select(id_col, self.vectoriser.getOrDefault("inputCol")), "vector")
        else:
            rows = df.withColumnRenamed(vector, "vector")
        votes = knn_classify(
            rows.select(id_col, "vector"), self._base(id_col), self._dim(), id_col, "_l", k=self.k, search=nearest_texts,
            metric=self.metric, weights=self.weights, found=found,
        )
        return df.join(votes, id_col)

    def neighbours(self, df: DataFrame, k: int, id_col: str = "reviewId", vector: str = "vector") -> DataFrame:
        """The k nearest training rows of each row of df, for `predict`."""
        return knn_neighbours(
            df.select(id_col, F.col(vector).alias("vector")), self._base(id_col), self._dim(), id_col, "_l", k=k,
            search=nearest_texts, metric=self.metric,
        )

    def _base(self, id_col: str) -> DataFrame:
        return self.train.select(F.col("row_id").alias(id_col), F.col("label").alias("_l"), "vector")

    def _dim(self) -> int:
        return len(self.vectoriser.getOrDefault("vocabulary"))

    def save(self, path: str) -> None:
        self.vectoriser.write().overwrite().save(f"{path}/vectoriser")
        self.train.write.mode("overwrite").parquet(f"{path}/train")
        options = self.train.sparkSession.createDataFrame([(self.k, self.metric, self.weights)], _KNN_OPTIONS)
        options.write.mode("overwrite").json(f"{path}/options")


def load_model(spark: SparkSession, path: str, kind: str):
    """Read a model back that was stored with save()."""
    if kind == "LR":
        return LogisticText(PipelineModel.load(f"{path}/pipeline"))
    schema = T.StructType(
        [
            T.StructField("row_id", T.StringType()), T.StructField("label", T.IntegerType()),
            T.StructField("vector", T.StructType([
                T.StructField("indices", T.ArrayType(T.IntegerType())), T.StructField("values", T.ArrayType(T.DoubleType()))
            ])),
        ]
    )
    options = spark.read.schema(_KNN_OPTIONS).json(f"{path}/options").first().asDict()
    return KnnText(TfidfVectoriser.load(f"{path}/vectoriser"), spark.read.schema(schema).parquet(f"{path}/train"), **options)


def training_vectors(
    train: DataFrame, vectoriser: TfidfVectoriser, label: str = "label", id_col: str = "reviewId", oversample: bool = False,
    tokens: Column | None = None,
) -> DataFrame:
    """(row_id, label, vector) of the training rows, with SMOTE rows if asked for."""
    rows = vectoriser.weights(train.where(F.col(label).isNotNull()), "vector", tokens).select(
        F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("row-"), F.monotonically_increasing_id())).alias("row_id"),
        F.col(label).cast("int").alias("label"), "vector",
    )
    rows = saved(rows, "training-vectors")
    return with_synthetic(rows, vectoriser) if oversample else rows


def with_synthetic(rows: DataFrame, vectoriser: TfidfVectoriser) -> DataFrame:
    """The training vectors and SMOTE rows, which are written once for all models."""
    new = smote(rows, len(vectoriser.getOrDefault("vocabulary")), "row_id", "label")
    new = new.select(F.concat_ws("~", "row_id", F.col("copy").cast("string")).alias("row_id"), "label", "vector")
    return rows.unionByName(saved(new, "synthetic-vectors"))


def train_model(
    kind: str | Knn | Logistic, vectors: DataFrame, vectoriser: TfidfVectoriser, k: int = 5, **logistic
) -> LogisticText | KnnText:
    """Fit one model, given by its options or as 'KNN' or 'LR', on prepared training vectors."""
    model = {"KNN": Knn(k), "LR": Logistic(**logistic)}[kind] if isinstance(kind, str) else kind
    if isinstance(model, Knn):
        return KnnText(vectoriser, vectors, model.k, model.metric, model.weights)
    size = len(vectoriser.getOrDefault("vocabulary"))
    packed = vectors.select(
        "label", pack_vector(F.col("vector.indices"), F.col("vector.values"), size).alias("features")
    )
    fitted = fit_logistic(
        packed, C=model.C, class_weights=model.class_weights, max_iter=model.max_iter, tol=model.tol
    )
    return LogisticText(PipelineModel([vectoriser, fitted]))


def fit_vectorisers(
    table: DataFrame, settings: Mapping[str, TermSetting], text: str, cleaner: str, keep: Sequence[str]
) -> dict[str, tuple[TfidfVectoriser, DataFrame]]:
    """A vectoriser for each named setting, and the table with the tokens (`_tokens`) it was fitted on.

    Texts are read once for each list of stop words.
    """
    alike: dict[tuple[str, ...], list[str]] = {}
    for name, setting in settings.items():
        alike.setdefault(tuple(setting.stop_words), []).append(name)
    out = {}
    for stop_words, names in alike.items():
        blank = TfidfVectoriser(inputCol=text, cleaner=cleaner, stopWords=list(stop_words))
        rows = saved(table.select(*keep, blank.tokens().alias("_tokens")), "grid-tokens")
        models = fit_settings(rows, "_tokens", [settings[n] for n in names])
        for name, model in zip(names, models, strict=True):
            own = blank.copy()._set(ngramRange=list(settings[name].ngram_range))
            out[name] = (own.fitted(model), rows)
    return {name: out[name] for name in settings}


def _dev_tokens(
    dev: DataFrame, terms: Mapping[str, TermSetting], text: str, cleaner: str, id_col: str, label: str
) -> dict[tuple[str, ...], DataFrame]:
    """The dev rows with their tokens (`_tokens`), cut once for each list of stop words."""
    out: dict[tuple[str, ...], DataFrame] = {}
    for setting in terms.values():
        key = tuple(setting.stop_words)
        if key not in out:
            blank = TfidfVectoriser(inputCol=text, cleaner=cleaner, stopWords=list(key))
            out[key] = saved(dev.select(id_col, label, blank.tokens().alias("_tokens")), "dev-tokens")
    return out


def model_grid(
    tables: Mapping[str, DataFrame],
    dev: DataFrame,
    models: Sequence[str] | Mapping[str, Knn | Logistic] = ("KNN", "LR"),
    text: str = "content",
    label: str = "label",
    id_col: str = "reviewId",
    max_features: int = 7000,
    min_df: int | float = 1,
    cleaner: str = "letters",
    terms: Mapping[str, TermSetting] | None = None,
    **logistic,
):
    """Train every model with every term setting on every strategy's table and keep the best on dev.

    `tables` maps a strategy to its training table; under the key 'SMOTE' the
    table is oversampled after vectorising. `terms` and `models` map names to settings;
    without them there is one term setting of 1 to 3 words, and 'KNN' and 'LR' as they come.
    All term settings of a table come from one count of its texts; the vectors of the dev rows are
    written once for each of them, and models that vote share a search. Best means the strictly
    highest macro F1, in order of trial. Returns (results, best model or None).
    """
    spark = dev.sparkSession
    terms = terms or {"all": TermSetting(max_features=max_features, min_df=min_df)}
    if not isinstance(models, Mapping):
        plain = {"KNN": Knn(), "LR": Logistic(**logistic)}
        models = {name: plain[name] for name in models}
    # A model that votes needs the neighbours of the dev rows; those that differ in their votes share one search.
    farthest: dict[str, int] = {}
    for options in models.values():
        if isinstance(options, Knn):
            farthest[options.metric] = max(options.k, farthest.get(options.metric, 0))
    fitted: dict[int, dict[str, tuple[TfidfVectoriser, DataFrame]]] = {}
    plain_vectors: dict[tuple[int, str], tuple[DataFrame, DataFrame]] = {}
    asked = _dev_tokens(dev, terms, text, cleaner, id_col, label)
    results, best, best_f1 = [], None, 0.0
    for strategy, table in tables.items():
        if id(table) not in fitted:
            fitted[id(table)] = fit_vectorisers(table, terms, text, cleaner, [id_col, label])
        for setting, (vectoriser, rows) in fitted[id(table)].items():
            key = id(table), setting
            if key not in plain_vectors:
                weighed = vectoriser.weights(asked[tuple(terms[setting].stop_words)], "vector", F.col("_tokens"))
                plain_vectors[key] = (
                    training_vectors(rows, vectoriser, label, id_col, tokens=F.col("_tokens")),
                    saved(weighed.select(id_col, label, "vector"), "dev-vectors"),
                )
            vectors, asked_vectors = plain_vectors[key]
            if strategy == "SMOTE":
                vectors = with_synthetic(vectors, vectoriser)
            found: dict[str, DataFrame] = {}
            for name, options in models.items():
                model = train_model(options, vectors, vectoriser)
                near = {}
                if isinstance(options, Knn):
                    if options.metric not in found:
                        found[options.metric] = saved(model.neighbours(asked_vectors, farthest[options.metric], id_col), "dev-neighbours")
                    near = {"found": found[options.metric]}
                f1 = macro_f1(model.predict(asked_vectors, id_col, "vector", **near), label).first()["macro_f1"]
                results.append((strategy, setting, name, float(f1)))
                if f1 > best_f1:
                    best, best_f1 = model, f1
    first = next((i for i, r in enumerate(results) if r[3] == best_f1 and best_f1 > 0), None)
    scored = spark.createDataFrame(
        [(*r, i == first) for i, r in enumerate(results)],
        "strategy string, terms string, model string, macro_f1 double, best boolean",
    )
    return scored, best


def holdout_eval(spark: SparkSession, path: str, kind: str, test: DataFrame, label: str = "label", id_col: str = "reviewId") -> DataFrame:
    """Load a stored model, predict the test rows and report."""
    return classification_report(load_model(spark, path, kind).predict(test, id_col), label)
