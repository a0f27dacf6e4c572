"""Jobs around a user-supplied text model.

`reply` is any callable from a list of prompts to a list of replies. It is the
only Python code that sees rows; planning, parsing and counting stay in Spark.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinara.functions.text import parse_label, parse_replies, parse_replies_strict
from opinara.operators.balance import exemplars, number_requests, sample_n, with_prompts
from opinara.operators.hash_order import group_sizes
from opinara.session import saved, scratch_path
from opinara.sources.tables import existing_paths

Reply = Callable[[list[str]], list[str]]


def _answers(reply: Reply, prompts: list[str]) -> list[tuple[str | None, str | None]]:
    """(reply, error) of each prompt; a batch that fails is asked again one by one."""
    try:
        found = list(reply(prompts))
        if len(found) != len(prompts):
            raise ValueError(f"{len(found)} replies to {len(prompts)} prompts")
        return [(r, None) for r in found]
    except Exception as failure:  # noqa: BLE001
        if len(prompts) == 1:
            return [(None, f"{type(failure).__name__}: {failure}")]
        return [_answers(reply, [p])[0] for p in prompts]


def ask(
    requests: DataFrame, reply: Reply, prompt: str = "prompt", tasks: int | None = None, key: Sequence[str] = (),
    render: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Add `reply` and `error`, the text of what a prompt failed with. Requests are spread over all cores first.

    `render` adds the prompts to requests that have none: after the shuffle, which then
    carries the keys only, and not to the result.
    """
    n = tasks or requests.sparkSession.sparkContext.defaultParallelism * 4
    spread = requests.repartition(n, *(key or [prompt]))
    if render:
        spread = render(spread)
    kept = requests.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = _answers(reply, pdf[prompt].tolist())
            yield pdf[kept].assign(reply=[r for r, _ in found], error=[e for _, e in found])

    added = [T.StructField(c, T.StringType()) for c in ("reply", "error")]
    schema = T.StructType([*requests.schema.fields, *added])
    return spread.mapInPandas(run, schema)


def augment(
    df: DataFrame,
    label: str,
    text: str,
    reply: Reply,
    prompt: Callable[[Column, Column, Column], Column],
    classes: Sequence | None = None,
    strict: bool = True,
    batch: int = 5,
    k: int = 3,
    order: str = "reviewId",
    max_rounds: int = 20,
    path: str | None = None,
    commit_every: int = 500,
    max_commits: int = 100,
) -> DataFrame:
    """Append model-written rows until every wanted class has the majority size.

    The strict form keeps at most the wanted rows of a reply and so ends exactly
    at the target; the loose form keeps all of them and may overshoot. Classes
    that still lack rows are asked again; if some still do after max_rounds rounds, an
    error names them, and the replies stay stored.

    Replies are appended to the table at `path`, partitioned by class, after about every
    `commit_every` requests (more where a round would need over `max_commits` writes);
    a run that is started again with the same path asks only for what is not stored
    yet. A failing prompt is stored with the text of its error; a round in which every
    reply fails is an error. New rows get ids of their own where `order` is a text column.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, "replies")
    sizes = group_sizes(df, label)
    target = max(sizes.values(), default=0)
    wanted = sorted(sizes) if classes is None else list(classes)
    shown = None
    kind = df.schema[label].dataType
    stored = T.StructType(
        [
            T.StructField("round", T.IntegerType()),
            T.StructField("request_no", T.LongType()),
            T.StructField("n_wanted", T.IntegerType()),
            T.StructField("reply", T.StringType()),
            T.StructField("error", T.StringType()),
            T.StructField(label, kind),
        ]
    )
    deficit_schema = T.StructType([T.StructField(label, kind), T.StructField("deficit", T.LongType())])

    def replies() -> DataFrame:
        if existing_paths(spark, [path]):
            return spark.read.schema(stored).parquet(path)
        return spark.createDataFrame([], stored)

    def rows(answers: DataFrame) -> DataFrame:
        pieces = parse_replies_strict(F.col("reply"), F.col("n_wanted")) if strict else parse_replies(F.col("reply"))
        each = answers.select(label, "round", "request_no", F.posexplode(pieces).alias("_at", text))
        name = F.concat_ws("-", F.lit("new"), F.col(label).cast("string"), "round", "request_no", "_at")
        return each.withColumn(order, name)

    for turn in range(max_rounds + 1):
        got = group_sizes(rows(replies().where(F.col("round") < turn)), label)
        lack = [(c, target - sizes.get(c, 0) - got.get(c, 0)) for c in wanted]
        lack = [(c, n) for c, n in lack if n > 0]
        if not lack:
            break
        if turn == max_rounds:
            raise RuntimeError(f"classes still short after {max_rounds} rounds: {dict(lack)}; replies are kept in {path}")
        if shown is None:
            shown = saved(exemplars(df, label, text, order, k), "exemplars")
        requests = number_requests(spark.createDataFrame(lack, deficit_schema), label, batch)
        commits = max(1, min(max_commits, -(-sum(-(-n // batch) for _, n in lack) // commit_every)))
        done = replies().where(F.col("round") == turn).select(label, "request_no")
        open_ = requests.join(done, [label, "request_no"], "left_anti")
        open_ = saved(open_.withColumn("_part", F.pmod(F.xxhash64(label, "request_no"), F.lit(commits)).cast("int")), "requests")
        for part in sorted(r["_part"] for r in open_.select("_part").distinct().collect()):
            mine = open_.where(F.col("_part") == part).drop("_part")
            new = ask(mine, reply, key=[label, "request_no"], render=lambda d: with_prompts(d, shown, label, prompt))
            new.select(F.lit(turn).alias("round"), "request_no", "n_wanted", "reply", "error", label).write.mode(
                "append"
            ).partitionBy(label).parquet(path)
        if replies().where((F.col("round") == turn) & F.col("reply").isNotNull()).isEmpty():
            said = replies().where(F.col("round") == turn).agg(F.min("error")).first()[0]
            raise RuntimeError(f"no request of round {turn} got a reply: {said}")
    new = rows(replies()).select(text, label, order)
    if order not in df.columns or not isinstance(df.schema[order].dataType, T.StringType):
        new = new.drop(order)
    return df.unionByName(new, allowMissingColumns=True)


def classify_with_model(
    df: DataFrame, reply: Reply, prompt: Callable[[Column], Column], text: str = "content", id_col: str = "reviewId",
    n: int | None = 100, fallback: int = 1,
) -> DataFrame:
    """(text, prediction) of n sampled rows (all rows with n=None) by a text model."""
    rows = df.select(id_col, text) if n is None else sample_n(df.select(id_col, text), n, id_col)
    asked = ask(rows.withColumn("prompt", prompt(F.col(text))), reply, key=[id_col])
    return asked.select(text, parse_label(F.col("reply"), fallback).alias("prediction"))
