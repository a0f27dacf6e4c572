"""Mixing sources to target weights by temperature.

Source weights are the token shares to the power of an exponent, normalised. The
exponent is bisected to meet a target entropy or a limit on repetition. The weights
become whole passes over every source in keyed permutations, and one part of a last
pass that ends at the source's token budget; positions interleave the sources evenly.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinara.session import saved

_ONE = 1 << 48


def weights_at(tokens: list[int], exponent: float) -> list[float]:
    """Normalised powers of the token shares."""
    total = sum(tokens)
    raw = [(n / total) ** exponent for n in tokens]
    return [x / sum(raw) for x in raw]


def entropy(weights: list[float]) -> float:
    return -sum(w * math.log(w) for w in weights if w > 0)


def _bisected(fits, steps: int = 60) -> float:
    """The smallest exponent in [0, 1] that fits, for a condition that holds above some value; 1 if none does."""
    if fits(0.0):
        return 0.0
    low, high = 0.0, 1.0
    for _ in range(steps):
        mid = (low + high) / 2
        if fits(mid):
            high = mid
        else:
            low = mid
    return high


def exponent_for(tokens: list[int], budget: int, entropy_share: float | None, max_repeats: float | None) -> float:
    """The exponent that meets both aims.

    entropy_share: the entropy of the weights is at most this share of its maximum
    (that of equal weights); the exponent nearest to equal weights that obeys. It is 1
    if even the natural shares lie above. max_repeats: no source is repeated
    more often, on average over its tokens, to fill its part of the budget. The larger
    of both exponents counts, 0 (equal weights) if neither aim is given.
    """
    exponent = 0.0
    if entropy_share is not None and len(tokens) > 1:
        aim = entropy_share * math.log(len(tokens))
        exponent = _bisected(lambda t: entropy(weights_at(tokens, t)) <= aim)
    if max_repeats is not None:
        fair = max(max_repeats, budget / max(1, sum(tokens)))
        obeys = lambda t: all(w * budget <= fair * n * (1 + 1e-12) for w, n in zip(weights_at(tokens, t), tokens, strict=True))
        exponent = max(exponent, _bisected(obeys))
    return exponent


def quotas(tokens: list[int], budget: int, exponent: float) -> list[int]:
    """Whole tokens for each source that add up to the budget (largest remainders, then order)."""
    exact = [w * budget for w in weights_at(tokens, exponent)]
    out = [int(x) for x in exact]
    rest = sorted(range(len(exact)), key=lambda k: (out[k] - exact[k], k))
    for k in rest[: budget - sum(out)]:
        out[k] += 1
    return out


def _place(seed: str, copy: Column) -> Column:
    """A row's place in the permutation of a pass: 0 .. 2^48 - 1, from its id and text."""
    text = F.concat_ws("|", F.lit(seed), copy.cast("string"), F.col("__key"))
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("long")


def _cut(rows: DataFrame, shift: int) -> DataFrame:
    """Per source: the block of places in which the running sum of tokens passes `rest`, and the rest at its start.

    rows: (__source, tokens, place, rest). Blocks are the 256 values of eight of the
    place's bits, so a source has few of them whatever its size.
    """
    blocks = rows.withColumn("block", F.shiftright("place", shift).cast("long")).groupBy("__source", "block")
    blocks = blocks.agg(F.sum("tokens").alias("n"), F.max("rest").alias("rest"))
    ordered = F.array_sort(F.collect_list(F.struct("block", "n")))
    lists = blocks.groupBy("__source").agg(ordered.alias("list"), F.max("rest").alias("rest"))
    start = F.struct(F.col("rest").alias("rest"), F.lit(None).cast("long").alias("block"))

    def step(s: Column, b: Column) -> Column:
        passed = s["block"].isNotNull() | (b["n"] > s["rest"])
        return F.struct(
            F.when(passed, s["rest"]).otherwise(s["rest"] - b["n"]).alias("rest"),
            F.when(s["block"].isNotNull(), s["block"]).when(passed, b["block"]).alias("block"),
        )

    return saved(lists.select("__source", F.aggregate("list", start, step).alias("c")).select("__source", "c.block", "c.rest"), "mix-cut")


def source_tokens(docs: DataFrame, source: str = "source", text: str = "text") -> DataFrame:
    """(source, tokens, rows): white-space separated tokens and rows of each source."""
    return docs.groupBy(F.col(f"`{source}`").alias("source")).agg(
        F.sum(_tokens(text)).alias("tokens"), F.count("*").alias("rows")
    )


def _tokens(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(f"`{text}`").cast("string"), F.lit(r"\S+")), F.lit(0)).cast("long")


def mixture(
    docs: DataFrame, entropy_share: float | None = 0.97, max_repeats: float | None = 4.0, budget: int | None = None, seed: str = "mix",
    source: str = "source", text: str = "text", max_sources: int = 1_000_000,
) -> DataFrame:
    """The rows of docs, all columns, as often as the mixture takes them, with `copy` and `position`.

    copy counts the passes over the source from 0; position in [0, 1) orders the
    mixture: rows sorted by it keep the target weights in every stretch. `budget` is
    in tokens (default: those of docs). A source's rows come in whole passes, then in the
    order of a last pass as long as its tokens stay within the source's quota, so no
    source exceeds its quota, and it falls short by less than a row (and rows of equal
    id and text, which stay together). Null is a source like others. A source
    without tokens is left out; null and empty texts of other sources count no tokens
    and take part in every pass. No rows give no rows. Columns named copy or position are replaced.

    One number for each source comes to the driver; above `max_sources` sources an error says so.
    """
    spark = docs.sparkSession
    names = [c for c in docs.columns if c not in ("copy", "position")]
    whole = F.col(f"`{text}`").cast("string")
    key = F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(F.coalesce(whole, F.lit(""))))
    row = F.struct(*[F.col(f"`{c}`") for c in names]).alias("row")
    keyed = docs.select(row, _tokens(text).alias("tokens"), key.alias("__key"), F.coalesce(F.concat(F.lit("s"), F.col(f"`{source}`").cast("string")), F.lit("null")).alias("__source"))
    narrow = saved(keyed.select("__source", "__key", "tokens"), "mix-tokens")
    sums = narrow.groupBy("__source").agg(F.sum("tokens").alias("n")).where("n > 0").orderBy("__source").limit(max_sources + 1).collect()
    if len(sums) > max_sources:
        raise ValueError(f"more than {max_sources} sources")
    tokens = [r.n for r in sums]
    if not tokens:
        return docs.limit(0).select(*[F.col(f"`{c}`") for c in names], F.lit(0).alias("copy"), F.lit(0.0).alias("position"))
    budget = sum(tokens) if budget is None else budget
    share = quotas(tokens, budget, exponent_for(tokens, budget, entropy_share, max_repeats))
    plan = [(r["__source"], q // r.n, q % r.n, q / r.n) for r, q in zip(sums, share, strict=True)]
    plan = spark.createDataFrame(plan, "__source string, passes long, rest long, stretch double")

    last = narrow.join(plan.where("rest > 0"), "__source")
    last = saved(last.select("__source", "tokens", "rest", _place(seed, F.col("passes")).alias("place")), "mix-last")
    for shift in (40, 32):
        inside = last.drop("rest").join(_cut(last, shift), "__source")
        last = saved(inside.where(F.shiftright("place", shift) == F.col("block")).select("__source", "tokens", "rest", "place"), "mix-inside")
    # Within 1/65536 of a source the rows themselves are summed; rows of one place stay together.
    fine = last.groupBy("__source", "place").agg(F.sum("tokens").alias("n"), F.max("rest").alias("rest"))
    running = F.sum("n").over(Window.partitionBy("__source").orderBy("place").rowsBetween(Window.unboundedPreceding, 0))
    ends = fine.withColumn("passed", running > F.col("rest")).where("passed").groupBy("__source").agg(F.min("place").alias("end"))
    plan = saved(plan.join(ends, "__source", "left"), "mix-plan")

    rule = plan.select("__source", *[F.col(c).alias(f"__{c}") for c in ("passes", "rest", "stretch", "end")])
    copies = keyed.drop("tokens").join(rule, "__source").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("__passes").cast("int"))))
    copies = copies.withColumn("__place", _place(seed, F.col("copy")))
    before_end = F.col("__end").isNull() | (F.col("__place") < F.col("__end"))
    taken = copies.where((F.col("copy") < F.col("__passes")) | ((F.col("__rest") > 0) & before_end))
    position = (F.col("copy") + F.col("__place") / F.lit(float(_ONE))) / F.col("__stretch")
    return taken.select(*[F.col(f"row.`{c}`").alias(c) for c in names], "copy", F.least(position, F.lit(1 - 2**-53)).alias("position"))
