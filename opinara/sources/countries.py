"""Country dimension from nested JSON records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RECORD_SCHEMA = (
    "array<struct<name:struct<common:string,official:string>,cca3:string,latlng:array<double>,region:string>>"
)


def index_from_json(docs: DataFrame, column: str = "json", part: str | None = None) -> DataFrame:
    """One row per country name from JSON arrays of country records.

    Each record is indexed under its common and its official name. Of several
    records with one name the last wins, by `part` (if given) and position.
    """
    order = F.col(part) if part else F.lit(0)
    records = docs.select(order.alias("part"), F.posexplode(F.from_json(column, RECORD_SCHEMA)).alias("pos", "r"))
    found = F.struct(
        F.col("r.cca3").alias("iso3"),
        F.get("r.latlng", F.lit(0)).alias("lat"),
        F.get("r.latlng", F.lit(1)).alias("lon"),
        F.col("r.region").alias("continent"),
    )
    named = records.select(
        F.explode(
            F.array(
                F.struct(F.col("r.name.common").alias("name"), F.lit(0).alias("which")),
                F.struct(F.col("r.name.official").alias("name"), F.lit(1).alias("which")),
            )
        ).alias("k"),
        F.struct("part", "pos").alias("at"),
        found.alias("found"),
    ).select(F.col("k.name").alias("name"), F.struct("at.part", "at.pos", "k.which").alias("at"), "found")
    return (
        named.where(F.coalesce(F.col("name"), F.lit("")) != "")
        .groupBy("name")
        .agg(F.max_by("found", "at").alias("found"))
        .select("name", "found.iso3", "found.lat", "found.lon", "found.continent")
    )
