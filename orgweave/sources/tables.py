"""Scans of the three kinds of organization table, and the schema that they are brought to.

Column names of ids are parameters; everything else about the inputs is in the schemas below.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import metadata_fields, with_java_map

# DDL of the inputs, for readers that take a schema.
REFERENCE = (
    "org_id string, name string, type string, country_code string, geographic_location struct<city: string, latitude: double, longitude: double>, "
    "name_aliases array<string>, ids struct<ror: string, grid: string>, is_current boolean"
)
REGISTRY = (
    "id string, name string, aliases array<string>, acronyms array<string>, types array<string>, "
    "address struct<city: string, country_code: string, latitude: double, longitude: double>, "
    "external_ids struct<ror: struct<preferred: string, all: array<string>>>, organization_parent_ids array<string>, organization_child_ids array<string>, status string"
)
INCOMING = "mismatch_id string, name string, source_table string, source_entity_id string, metadata string"


def _limited(df: DataFrame, limit: int | None) -> DataFrame:
    return df if limit is None else df.limit(limit)


def scan_reference(df: DataFrame, limit: int | None = None, id_col: str = "org_id") -> DataFrame:
    """Current organizations, nested fields flattened; only the fields named are read."""
    place, ids = "geographic_location", "ids"
    out = df.where(F.col("is_current")).select(
        F.col(id_col).alias("source_id"), "name", "type", "country_code", F.col(f"{place}.city").alias("city"), F.col(f"{place}.latitude").alias("latitude"),
        F.col(f"{place}.longitude").alias("longitude"), "name_aliases", F.col(f"{ids}.ror").alias("ror_id"), F.col(f"{ids}.grid").alias("grid_id"), F.lit("dim_org").alias("source"),
    )
    return _limited(out, limit)


def scan_registry(df: DataFrame, limit: int | None = None) -> DataFrame:
    """Active entries; the preferred outside id, else the first of all."""
    ror = F.coalesce("external_ids.ror.preferred", F.try_element_at("external_ids.ror.all", F.lit(1)))
    out = df.where(F.col("status") == "active").select(
        F.col("id").alias("source_id"), "name", "aliases", "acronyms", "types", F.col("address.country_code").alias("country_code"), F.col("address.city").alias("city"),
        F.col("address.latitude").alias("latitude"), F.col("address.longitude").alias("longitude"), ror.alias("ror_id"), F.col("id").alias("grid_id"),
        "organization_parent_ids", "organization_child_ids", F.lit("grid").alias("source"),
    )
    return _limited(out, limit)


def scan_incoming(df: DataFrame, source_table: str | None = None, limit: int | None = None, per_source: int | None = None, seed: int = 42) -> DataFrame:
    """Incoming records with the fields of their metadata text; of one source, or so many of each."""
    if source_table is not None:
        df = df.where(F.col("source_table") == source_table)
    if per_source is not None:
        df = stratified(df, "source_table", "mismatch_id", per_source, seed)
    fields = metadata_fields(F.col("_metadata"))
    out = with_java_map(df, "metadata", "_metadata").select(F.col("mismatch_id").alias("source_id"), "name", "source_table", "source_entity_id", F.col("metadata").alias("raw_metadata"), *fields, F.lit("mismatched").alias("source"))
    return _limited(out, limit)


def stratified(df: DataFrame, by: str, key: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows of each stratum, chosen by a hash of the key, so that reruns agree."""
    order = Window.partitionBy(by).orderBy(sample_key(F.col(key), seed), key)
    return df.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= n).drop("_rank")


def sample_key(key: Column, seed: int = 42) -> Column:
    """A pseudo-random order that any engine with md5 can repeat."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string")).cast("binary"))


def source_counts(df: DataFrame, by: str = "source_table") -> DataFrame:
    return df.groupBy(by).agg(F.count("*").alias("n_records")).orderBy(F.desc("n_records"), by)
