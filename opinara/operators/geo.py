"""Country lookups. The dimensions are user-supplied tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.functions.rounding import percent

GEO_COLUMNS = ("lat", "lon", "iso3", "continent")


def unique(dim: DataFrame, key: str) -> DataFrame:
    """One row for each key: the smallest, so that a repeated name cannot multiply rows."""
    others = [c for c in dim.columns if c != key]
    return dim.groupBy(key).agg(F.min(F.struct(*others)).alias("r")).select(key, *[F.col(f"r.{c}").alias(c) for c in others])


def geo_enrich(reviews: DataFrame, countries: DataFrame) -> DataFrame:
    """Add lat, lon, iso3, continent by exact country name; keep unmatched rows."""
    dim = countries.select("country", *GEO_COLUMNS)
    return reviews.join(unique(dim, "country"), "country", "left")


def geo_missing_summary(geo: DataFrame) -> DataFrame:
    """Number and percent of rows without coordinates."""
    return geo.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("lat").isNull()).alias("n_missing")
    ).withColumn("pct_missing", percent(F.col("n_missing"), F.col("n")))


def geo_missing_countries(geo: DataFrame) -> DataFrame:
    """Unmatched country names with their row counts, most frequent first."""
    return (
        geo.where(F.col("lat").isNull() & F.col("country").isNotNull())
        .groupBy("country")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "country")
    )


def resolve_names(names: DataFrame, index: DataFrame, aliases: DataFrame) -> DataFrame:
    """Match `name` against the two-key index directly, else through its alias.

    names(name), index(name, iso3, lat, lon, continent), aliases(alias, canonical).
    """
    fields = ("iso3", "lat", "lon", "continent")
    found = F.struct(*fields)
    direct = unique(index.select("name", *fields), "name").select("name", found.alias("direct"))
    via = direct.select(F.col("name").alias("canonical"), F.col("direct").alias("via_alias"))
    hit = F.coalesce("direct", "via_alias")
    return (
        names.join(direct, "name", "left")
        .join(unique(aliases.select("alias", "canonical"), "alias"), F.col("name") == F.col("alias"), "left")
        .join(via, "canonical", "left")
        .select("name", *[hit[f].alias(f) for f in fields], hit.isNotNull().alias("resolved"))
    )


def unresolved_names(resolved: DataFrame) -> DataFrame:
    """Names that have no record."""
    return resolved.where(~F.col("resolved")).select("name").distinct()
