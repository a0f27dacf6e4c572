"""Classification scores from the confusion table.

The predictions are read once, for the (label, prediction) counts; the rest
works on those few rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.functions.rounding import half_up


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    pair = df.select(F.col(label).cast("int").alias("label"), F.col(prediction).cast("int").alias("prediction"))
    return pair.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"))


def class_scores(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support of every class seen on either side.

    An empty denominator scores 0.
    """
    n, zero = F.col("n"), F.lit(0).cast("bigint")
    hit = F.when(F.col("label") == F.col("prediction"), n).otherwise(zero)
    sides = F.array(
        F.struct(F.col("label").alias("c"), n.alias("support"), zero.alias("predicted"), hit.alias("tp")),
        F.struct(F.col("prediction").alias("c"), zero.alias("support"), n.alias("predicted"), zero.alias("tp")),
    )
    per = (
        confusion(df, label, prediction)
        .select(F.explode(sides).alias("s"))
        .groupBy(F.col("s.c").alias("class"))
        .agg(*[F.sum(f"s.{c}").alias(c) for c in ("support", "predicted", "tp")])
    )

    def ratio(a: Column, b: Column) -> Column:
        return F.when(b > 0, a / b).otherwise(0.0)

    tp, support, predicted = F.col("tp"), F.col("support"), F.col("predicted")
    return per.select(
        "class",
        ratio(tp, predicted).alias("precision"),
        ratio(tp, support).alias("recall"),
        ratio(2 * tp, predicted + support).alias("f1"),
        "support",
        "tp",
    )


def macro_f1(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Unweighted mean of the per-class F1."""
    return class_scores(df, label, prediction).agg(half_up(F.avg("f1"), 6).alias("macro_f1"))


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Per-class rows, then accuracy, macro avg and weighted avg."""
    per = class_scores(df, label, prediction)
    total = F.sum("support")
    parts = ("precision", "recall", "f1")
    macro = [F.avg(p).alias(p) for p in parts]
    weighted = [(F.sum(F.col(p) * F.col("support")) / total).alias(p) for p in parts]
    summary = per.agg(
        F.array(
            F.struct(
                F.lit("accuracy").alias("row"), F.lit(None).cast("double").alias("precision"),
                F.lit(None).cast("double").alias("recall"), (F.sum("tp") / total).alias("f1"), total.alias("support"),
            ),
            F.struct(F.lit("macro avg").alias("row"), *macro, total.alias("support")),
            F.struct(F.lit("weighted avg").alias("row"), *weighted, total.alias("support")),
        ).alias("rows")
    ).select(F.inline("rows"))
    rows = per.select(F.col("class").cast("string").alias("row"), *parts, "support").unionByName(summary)
    return rows.select("row", *[half_up(F.col(p), 6).alias(p) for p in parts], "support")
