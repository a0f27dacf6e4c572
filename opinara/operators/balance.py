"""Stratified split, class deficits and planned augmentation."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinara.functions.labels import score_band
from opinara.operators.hash_order import class_counts, cut_by_hash, numbered, share_out
from opinara.session import saved

SPLITS = ("train", "dev", "test")

# Score given to a template row and the word for its class.
BAND_SCORES = {"positive": 5, "negative": 1, "neutral": 3}
BAND_WORDS = {"positive": "POSITIVA", "negative": "NEGATIVA", "neutral": "NEUTRA"}

# Fixed value: text of a template row.
TEMPLATE = "New {kind} review generated for {app} by IA"


def split_sizes(sizes: DataFrame, label: str, rest_percent: int = 30) -> DataFrame:
    """(label, cuts) for train / dev / test from the class sizes (label, n).

    The rest is rest_percent of all rows, rounded up, and half of it (rounded
    up) is the test set. Each set is shared out over the classes in proportion.
    """
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    rest = -(-total * rest_percent // 100)
    train = share_out(sizes, label, "n", total - rest, "_train").withColumn("_left", F.col("n") - F.col("_train"))
    dev = share_out(train, label, "_left", rest - -(-rest // 2), "_dev")
    return dev.select(label, F.array("_train", F.col("_train") + F.col("_dev")).alias("cuts"))


def stratified_split(df: DataFrame, label: str = "label", id_col: str = "reviewId") -> DataFrame:
    """Add `split` in exact 70 / 15 / 15 class shares, in hash order of the id."""
    out = cut_by_hash(df, label, id_col, lambda sizes: split_sizes(sizes, label), "_segment")
    names = F.array(*[F.lit(s) for s in SPLITS])
    return out.withColumn("split", F.get(names, F.col("_segment"))).drop("_segment")


def sample_n(df: DataFrame, n: int = 100, id_col: str = "reviewId") -> DataFrame:
    """Exactly n rows, chosen by the hash of the id."""
    return df.orderBy(F.md5(F.col(id_col).cast("string")), id_col).limit(n)


def exemplars(df: DataFrame, label: str, text: str, order: str = "reviewId", k: int = 3) -> DataFrame:
    """The first k texts of each class joined by ' | '.

    The first rows are found by their order keys alone, with the rank limit
    applied before the shuffle; only then are their texts fetched.
    """
    some = df.where(F.col(text).isNotNull() & F.col(label).isNotNull())
    w = Window.partitionBy(label).orderBy(order)
    keys = some.select(label, order).withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k)
    first = some.select(label, text, order).join(keys.select(label, order).distinct(), [label, order])
    texts = F.slice(F.sort_array(F.collect_list(F.struct(order, text))), 1, k)[text]
    return first.groupBy(label).agg(F.array_join(texts, " | ").alias("exemplars"))


def class_deficit(df: DataFrame, label: str = "label", classes: Sequence | None = None) -> DataFrame:
    """Rows missing per class to reach the majority; an absent class has size 0."""
    sizes = saved(class_counts(df, label), "class-sizes")
    target = sizes.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    if classes is not None:
        schema = T.StructType([T.StructField(label, df.schema[label].dataType)])
        sizes = df.sparkSession.createDataFrame([(c,) for c in classes], schema).join(sizes, label, "left")
    n = F.coalesce("n", F.lit(0))
    return sizes.select(label, n.alias("n"), F.lit(target).cast("bigint").alias("majority"), (F.lit(target) - n).alias("deficit"))


def template_augment(df: DataFrame, app: str = "app", template: str = TEMPLATE) -> DataFrame:
    """Fill each app's smaller score bands with rows of a fixed text.

    The new rows carry content, score, sentiment and app; other columns are null.
    """
    counts = df.groupBy(app).agg(
        *[F.count_if(score_band(F.col("score")) == b).alias(b) for b in BAND_SCORES]
    )
    target = F.greatest(*BAND_SCORES)
    rows = counts.select(
        app,
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(b).alias("sentiment"),
                        F.lit(BAND_WORDS[b]).alias("kind"),
                        F.lit(s).alias("score"),
                        (target - F.col(b)).alias("deficit"),
                    )
                    for b, s in BAND_SCORES.items()
                ]
            )
        ).alias("c"),
    ).select(app, "c.*")
    pieces = template.replace("{kind}", "\0k\0").replace("{app}", "\0a\0").split("\0")
    text = F.concat(*[{"k": F.col("kind"), "a": F.col(app)}.get(p, F.lit(p)) for p in pieces])
    new = numbered(rows, F.col("deficit"), "_i").select(
        app, text.alias("content"), F.col("score").cast(df.schema["score"].dataType).alias("score"), "sentiment"
    )
    return df.unionByName(new, allowMissingColumns=True)


def number_requests(deficits: DataFrame, label: str, batch: int) -> DataFrame:
    """One row per request: class, request number and rows wanted.

    Requests of a class ask for `batch` rows each, the last one for the rest.
    deficits(label, deficit) has one row per class.
    """
    base = deficits.where("deficit > 0").select(label, "deficit")
    rows = numbered(base, F.ceil(F.col("deficit") / batch), "request_no")
    wanted = F.least(F.lit(batch).cast("bigint"), F.col("deficit") - F.col("request_no") * batch).cast("int")
    return rows.select(label, "request_no", wanted.alias("n_wanted"))


def with_prompts(requests: DataFrame, shown: DataFrame, label: str, prompt: Callable[[Column, Column, Column], Column]) -> DataFrame:
    """Add the prompt of each request. shown(label, exemplars) has one row per class."""
    rows = requests.join(shown, label, "left").withColumn("exemplars", F.coalesce("exemplars", F.lit("")))
    return rows.select(*requests.columns, prompt(F.col("n_wanted"), F.col(label), F.col("exemplars")).alias("prompt"))


def plan_requests(
    deficits: DataFrame, shown: DataFrame, label: str, prompt: Callable[[Column, Column, Column], Column], batch: int
) -> DataFrame:
    """One row per request: class, request number, rows wanted and prompt."""
    return with_prompts(number_requests(deficits, label, batch), shown, label, prompt)


def augment_requests(
    df: DataFrame,
    label: str,
    text: str,
    prompt: Callable[[Column, Column, Column], Column],
    classes: Sequence | None = None,
    batch: int = 5,
    k: int = 3,
    order: str = "reviewId",
) -> DataFrame:
    """Requests that would bring the classes to the size of the largest one."""
    deficits = class_deficit(df, label, classes)
    return plan_requests(deficits, exemplars(df, label, text, order, k), label, prompt, batch)
