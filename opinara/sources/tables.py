"""Readers and writers of review tables and their dimensions."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinara.session import saved
from opinara.sources.records import crossing_records, lines_of, parse, scan_blocks, starts_inside, whole_records

# Field texts that count as null when a table is read from CSV.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

#: Added by read_csv: the file of each row.
FILE_PATH = "_file_path"


def read_csv(
    spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None, *, with_file: bool = False
) -> DataFrame:
    """Tolerant CSV scan by header name: every field a string, rows with surplus fields dropped.

    Each file's first record names its fields, so files may order them differently and
    have more of them. The result has the wanted `columns` (missing ones null), or all
    columns of all files without those left over from spreadsheets; of equal names the
    first counts. Short rows are padded with nulls; a row with more fields than its header
    goes, even if the surplus ones are empty; so do blank lines. Quoted fields may hold line
    breaks, and a file is still read in splits (see `records`). There is no schema inference.
    `with_file` adds the path of each row's file.

    Tasks read the headers. The driver gets the different ones, the files that do not have
    the commonest one, and the splits that begin inside a quoted field.
    """
    paths = [path] if isinstance(path, str) else list(path)
    lines = lines_of(spark, paths) if paths else spark.createDataFrame([], "file string, at bigint, line string")
    blocks = saved(scan_blocks(lines), "csv-blocks")
    named = blocks.where("at = 0 and header is not null")
    common = [r["header"] for r in named.groupBy("header").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "header").collect()]
    other = {r["file"]: r["header"] for r in named.where(F.col("header") != F.lit(common[0])).select("file", "header").collect()} if common else {}
    names = dict.fromkeys(c for h in sorted(common) for c in h if not c.startswith("Unnamed"))
    wanted = list(columns) if columns is not None else list(names)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*wanted, FILE_PATH]])
    if not common:
        return spark.createDataFrame([], schema if with_file else schema[:-1])
    inside = set(starts_inside(blocks))

    def make(file: str, rows: list[list[str]]) -> pa.RecordBatch:
        header = other.get(file, common[0])
        rows = [r for r in rows if len(r) <= len(header)]
        out = []
        for c in wanted:
            k = header.index(c) if c in header else len(header)
            values = (r[k] if k < len(r) else None for r in rows)
            out.append(pa.array([None if v in NULL_TOKENS else v for v in values], pa.string()))
        return pa.RecordBatch.from_arrays([*out, pa.array([file] * len(rows), pa.string())], schema=_arrow(schema))

    def parse_texts(batches):
        for batch in batches:
            for file, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                yield make(file, parse(text.split("\n")))

    out = whole_records(lines, inside, make, schema)
    if inside:
        out = out.unionByName(crossing_records(lines, inside).mapInArrow(parse_texts, schema))
    return out if with_file else out.drop(FILE_PATH)


def _arrow(schema: T.StructType) -> pa.Schema:
    return pa.schema([(f.name, pa.string()) for f in schema])


def existing_paths(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """The paths that exist, in order; missing ones are skipped."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def exists(p: str) -> bool:
        path = jvm.org.apache.hadoop.fs.Path(p)
        return path.getFileSystem(conf).exists(path)

    return [p for p in paths if exists(p)]


def tag_from_file_name(df: DataFrame, apps: dict[str, str], default_app: str, level: int = 1) -> DataFrame:
    """Add app and sentiment read from each row's file name, see read_csv(with_file=True).

    `apps` maps a lower-case fragment to an app name; the first hit wins. With
    level=2 the name of the file's folder is read instead.
    """
    name = F.lower(F.element_at(F.split(F.col(FILE_PATH), "/"), -level))
    app = F.lit(default_app)
    for fragment, label in reversed(apps.items()):
        app = F.when(F.contains(name, F.lit(fragment)), label).otherwise(app)
    sentiment = (
        F.when(F.contains(name, F.lit("positive")), "positive")
        .when(F.contains(name, F.lit("negative")), "negative")
        .otherwise("neutral")
    )
    return df.select("*", app.alias("app"), sentiment.alias("sentimiento_analisis")).drop(FILE_PATH)


def read_countries(spark: SparkSession, path: str) -> DataFrame:
    """Country dimension kept as Parquet: country, lat, lon, iso3, continent."""
    schema = "country string, lat double, lon double, iso3 string, continent string"
    return spark.read.schema(schema).parquet(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write a result table; 'csv' gives a header row for dashboard tools."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).option("escape", '"').csv(path)
    else:
        writer.format(fmt).save(path)


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], rows_per_file: int = 2_000_000) -> None:
    """One directory per value of `by`, in one pass over the data.

    No shuffle: each task writes its own rows to each directory, so a dominant
    value is spread over as many files as there are tasks.
    """
    df.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).partitionBy(*by).parquet(path)


def write_by_sentiment(df: DataFrame, path: str) -> None:
    write_partitioned(df, path, ["app", "sentiment"])


def write_by_split(df: DataFrame, path: str) -> None:
    write_partitioned(df, path, ["split"])
