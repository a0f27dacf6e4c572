"""Exact ranks in hash order without bringing a group into one task.

Rows of a group are ordered by md5(id). A histogram over the leading hex digits
(65,536 buckets per group) tells in which bucket each cut falls, so a row's
place against a cut follows from its bucket alone. Only the rows of the buckets
that hold a cut are sorted: about 1 / 65,536 of a group per cut.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinara.session import saved

_DIGITS = 4


def hash_key(id_col: str) -> Column:
    return F.md5(F.col(id_col).cast("string"))


def class_counts(df: DataFrame, group: str) -> DataFrame:
    """(group, n): rows per group, null left out."""
    return df.where(F.col(group).isNotNull()).groupBy(group).agg(F.count(F.lit(1)).alias("n"))


def group_sizes(df: DataFrame, group: str) -> dict:
    """Rows per group as a dictionary, for jobs whose driver goes through the classes one by one."""
    return {r[group]: r["n"] for r in sorted(class_counts(df, group).collect(), key=lambda r: r[group])}


def cut_by_hash(
    df: DataFrame, group: str, id_col: str, plan: Callable[[DataFrame], DataFrame], name: str = "segment"
) -> DataFrame:
    """Number the rows of each group by the cuts they lie beyond.

    `plan` gets the group sizes (group, n) and returns (group, cuts), ascending cuts per
    group as an array; rows ranked 1..cuts[0] get segment 0, the next up to cuts[1] get 1,
    and so on. Rows with a null group, or with one that the plan leaves out, are left out.
    Sizes and cuts are tables, so that the number of groups has no bound.
    """
    keyed = df.where(F.col(group).isNotNull()).withColumn("_key", hash_key(id_col))
    keyed = keyed.withColumn("_bucket", F.substring("_key", 1, _DIGITS))
    hist = saved(keyed.groupBy(group, "_bucket").agg(F.count(F.lit(1)).alias("n")), "hash-histogram")
    sizes = saved(hist.groupBy(group).agg(F.sum("n").alias("n")), "hash-sizes")
    cuts = plan(sizes).select(F.col(group).alias("_g"), F.posexplode_outer("cuts").alias("_j", "_cut"))
    cuts = saved(cuts, "hash-cuts")

    upto = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = hist.withColumn("_before", F.coalesce(F.sum("n").over(upto), F.lit(0))).withColumnRenamed(group, "_h")
    falls = (F.col("_g") == F.col("_h")) & (F.col("_cut") > F.col("_before")) & (F.col("_cut") <= F.col("_before") + F.col("n"))
    # A cut at 0 has no bucket: every row lies beyond it.
    mark = F.struct(F.coalesce("_bucket", F.lit("")).alias("b"), F.coalesce(F.col("_cut") - F.col("_before"), F.lit(0)).alias("o"))
    marks = cuts.join(before, falls, "left").groupBy("_g").agg(F.collect_list(F.when(F.col("_j").isNotNull(), mark)).alias("_cuts"))
    placed = keyed.join(saved(marks, "hash-marks"), F.col(group) == F.col("_g")).drop("_g")
    split = F.exists("_cuts", lambda c: c["b"] == F.col("_bucket"))
    by_key = Window.partitionBy(group, "_bucket").orderBy("_key", id_col)
    inside = placed.where(split).withColumn("_rn", F.row_number().over(by_key))
    outside = placed.where(~split).withColumn("_rn", F.lit(0))
    beyond = lambda c: (F.col("_bucket") > c["b"]) | ((F.col("_bucket") == c["b"]) & (F.col("_rn") > c["o"]))
    segment = F.size(F.filter("_cuts", beyond))
    return outside.unionByName(inside).withColumn(name, segment).drop("_key", "_bucket", "_cuts", "_rn")


def in_order(df: DataFrame, *order: Column | str, name: str = "rank") -> DataFrame:
    """df with the place 1, 2, 3 ... of each row in the given order.

    Rows are sorted by ranges and numbered in their range; only the sizes of the ranges
    are summed up, one row for each partition of the sort.
    """
    place = F.monotonically_increasing_id()
    rows = saved(df.orderBy(*order).withColumn("_at", place), "in-order")
    rows = rows.withColumn("_range", F.shiftright("_at", 33)).withColumn("_at", F.col("_at").bitwiseAND((1 << 33) - 1))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    starts = starts.select("_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    return rows.join(starts, "_range").withColumn(name, F.col("_start") + F.col("_at") + 1).drop("_range", "_at", "_start")


def share_out(sizes: DataFrame, group: str, n: str, total: int, name: str) -> DataFrame:
    """sizes with a column that splits `total` over the classes in proportion to `n`.

    Whole parts first; the rest goes to the largest remainders, ties to the
    smaller class value. Without any row every part is 0.
    """
    everything = sizes.agg(F.coalesce(F.sum(n), F.lit(0))).first()[0]
    if everything == 0:
        return sizes.withColumn(name, F.lit(0).cast("bigint"))
    wide = "decimal(19,0)"
    product, whole = F.col(n).cast(wide) * F.lit(total).cast(wide), F.lit(everything).cast(wide)
    parts = sizes.withColumn("_part", F.call_function("div", product, whole)).withColumn("_rest", product % whole)
    left = total - parts.agg(F.sum("_part")).first()[0]
    ranked = in_order(parts, F.desc("_rest"), F.asc(group), name="_place")
    return ranked.withColumn(name, F.col("_part") + F.when(F.col("_place") <= left, 1).otherwise(0)).drop("_part", "_rest", "_place")


def numbered(df: DataFrame, count: Column, name: str, spread: bool = True, chunk: int = 1_000_000) -> DataFrame:
    """Repeat each row `count` times with `name` = 0 .. count - 1.

    With `spread`, rows are first cut into chunks that go to different tasks, so
    that one row with a huge count is expanded by the whole cluster.
    """
    n = count.cast("bigint")
    if not spread:
        some = df.withColumn("_n", n).where(F.col("_n") > 0)
        return some.withColumn(name, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_n") - 1))).drop("_n")
    chunks = (
        df.withColumn("_n", n)
        .where(F.col("_n") > 0)
        .withColumn("_c", F.explode(F.sequence(F.lit(0).cast("bigint"), F.call_function("div", F.col("_n") - 1, F.lit(chunk)))))
        .repartition(F.xxhash64("_c", "_n"))
    )
    first = F.col("_c") * chunk
    last = F.least(F.col("_n"), first + chunk) - 1
    return chunks.withColumn(name, F.explode(F.sequence(first, last))).drop("_c", "_n")
