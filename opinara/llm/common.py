"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

#: A-Z become a-z; 0-9, a-z and every byte above 0x7F stay; the rest become blanks.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b > 127 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)

#: The same words in text that has not been lower-cased, for offsets in the original.
WORD_PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased words of a UTF-8 text."""
    return text.translate(WORD_BYTES).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_remainder(column: Column | str, modulus: int) -> Column:
    """crc32 of the value as text, modulo; 0 for null."""
    value = F.col(column) if isinstance(column, str) else column
    return F.coalesce(F.crc32(value.cast("string").cast("binary")) % modulus, F.lit(0))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that a step holds few rows, however long they are."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def utf8(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8 bytes; null becomes empty."""
    return [b"" if v is None else v for v in column.cast(pa.binary()).to_pylist()]


def unused(names: list[str], name: str) -> str:
    """The name, with as many underscores added as it takes to differ from all names, whatever their case."""
    taken = {n.lower() for n in names}
    while name.lower() in taken:
        name += "_"
    return name


def add_column(
    df: DataFrame, name: str, ddl: str, build: Callable[[], Callable[[pa.RecordBatch], pa.Array]], reads: list[str]
) -> DataFrame:
    """df with one more column (a present one of that name is replaced), computed batch by batch.

    `build` runs once in a task; what it returns gets the batches of the columns in `reads`.
    """
    kept = [c for c in df.columns if c != name]
    source = df.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row") if kept else F.lit(None).alias("row"),
        F.struct(*[F.col(f"`{c}`") for c in reads]).alias("read"),
    )
    schema = StructType([source.schema["row"], StructField("added", DataType.fromDDL(ddl))])

    def run(batches):
        compute = build()
        for batch in slices(batches):
            read = pa.RecordBatch.from_struct_array(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), compute(read)], ["row", "added"])

    out = source.mapInArrow(run, schema)
    return out.select(*[F.col(f"row.`{c}`").alias(c) for c in kept], F.col("added").alias(name))
