"""A corpus pipeline: toxic documents go, repeated lines go, one of each group of near
copies stays, documents that hold benchmark text go, and the sources are mixed.

Each stage takes (spark, docs, sf_dir) and returns the rows it keeps; all but the last
return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara.llm.common import unused
from opinara.llm.contamination import contamination
from opinara.llm.line_dedup import without_repeated_lines
from opinara.llm.mixing import mixture
from opinara.llm.order_minhash import deduplicated
from opinara.llm.toxicity import rejected, toxicity, train
from opinara.session import saved


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays below the threshold of their language (0.5 where it has none or is null).

    Null and empty texts score as a text without words; repeated rows go or stay together;
    without documents nothing is learnt and no row remains.
    """
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = unused(docs.columns, "toxicity")
    scored = toxicity(docs, model, out=score)
    return scored.where(~rejected(model, score)).select(*[f"`{c}`" for c in docs.columns])


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that repeat an earlier one; documents that this empties go.

    The line of the smallest (doc_id, line number) stays. Documents with null or empty text
    have no lines and stay; rows repeated in full count as one document and change alike.
    """
    return without_repeated_lines(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, that of the smallest doc_id.

    Documents without words, null texts among them, are alike to none and stay. Of rows
    that are repeated with their id one stays.
    """
    return deduplicated(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of the benchmark.

    Null and empty texts have no words and stay; repeated rows go or stay together; with an
    empty benchmark all stay.
    """
    hits = unused(docs.columns, "contamination")
    found = contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), out=hits)
    return found.where(F.col(hits)["n_hit"] == 0).select(*[f"`{c}`" for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, source, copy, position): the mixture at production parameters.

    Null is a source like others; texts without tokens, null among them, take part in every
    pass of their source; a source without any tokens is left out.
    """
    return mixture(docs).select("doc_id", "source", "copy", "position")


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("near-dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]

#: The stages train a model and search by hashing, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
