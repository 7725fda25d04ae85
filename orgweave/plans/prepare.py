"""Plans: from scanned tables to features."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as t
from ..functions.similarity import add_metaphone
from ..operators.filters import filter_bad_records
from ..operators.tokens import add_token_sets, distinctive_tokens, token_idf

ID_PREFIX = {"dim_org": "dim_", "grid": "grid_", "mismatched": "mis_"}
UNIFIED = "unique_id name name_clean name_normalized name_prefix_5 name_prefix_10 all_names org_type country_code city latitude longitude ror_id grid_id source source_id".split()


def unify(df: DataFrame, source: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """A scanned table in the common schema.

    A column that is present is used even where it is null; only a missing one is derived. A null id becomes
    the text "None" behind its prefix. ``carry`` names further columns to keep.
    """
    have = set(df.columns)
    kinds = dict(df.dtypes)
    none = F.lit(None).cast("string")
    col = lambda c: F.col(c) if c in have else none
    name = F.col("name")
    clean = F.col("name_clean") if "name_clean" in have else t.clean_name(name)
    normal = F.col("name_normalized") if "name_normalized" in have else t.normalize_name(clean)
    aliases = next((c for c in ("name_aliases", "aliases") if c in have), None)
    if aliases:
        aliases = F.col(aliases) if kinds[aliases].startswith("array") else t.alias_text(F.col(aliases))
    kind = next((c for c in ("type", "types") if c in have), None)
    org_type = none if kind is None else F.array_join(kind, ", ") if kinds[kind].startswith("array") else F.col(kind)
    country = "country_code" if "country_code" in have else "country"
    return df.select(
        F.concat(F.lit(ID_PREFIX.get(source, "")), F.coalesce(F.col("source_id").cast("string"), F.lit("None"))).alias("unique_id"),
        "name", clean.alias("name_clean"), normal.alias("name_normalized"),
        (F.col("name_prefix_5") if "name_prefix_5" in have else t.prefix(normal, 5)).alias("name_prefix_5"),
        (F.col("name_prefix_10") if "name_prefix_10" in have else t.prefix(normal, 10)).alias("name_prefix_10"),
        t.name_array(name, aliases, F.col("acronyms") if "acronyms" in have else None).alias("all_names"),
        org_type.alias("org_type"), t.country_code(col(country)).alias("country_code"), col("city").alias("city"),
        t.safe_double(col("latitude")).alias("latitude"), t.safe_double(col("longitude")).alias("longitude"),
        col("ror_id").alias("ror_id"), col("grid_id").alias("grid_id"), F.lit(source).alias("source"), F.col("source_id").cast("string").alias("source_id"), *carry,
    )


def blocking_keys(df: DataFrame, phonetic: bool = True) -> DataFrame:
    """Prefixes, town key, significant first word and its phonetic codes; columns that are there stay."""
    name = F.col("name_normalized")
    derived = {"name_prefix_5": t.prefix(name, 5), "name_prefix_10": t.prefix(name, 10), "city_name3": t.city_name3(F.col("city"), name)}
    df = df.withColumns({k: v for k, v in derived.items() if k not in df.columns})
    df = df.withColumns({"name_first_word": t.first_significant_word(name), "country_code": F.upper(t.strip(F.col("country_code")))})
    df = df.withColumn("name_soundex", t.soundex(F.col("name_first_word")))
    return add_metaphone(df, "name_first_word", "name_metaphone") if phonetic else df


def features(df: DataFrame, idf: DataFrame) -> DataFrame:
    return add_token_sets(distinctive_tokens(blocking_keys(df), idf))


def prepare(tables: list[DataFrame], idf_from: list[DataFrame] | None = None) -> list[DataFrame]:
    """Filtered tables with features. IDF is of all tables together, or of those in ``idf_from``."""
    kept = [filter_bad_records(df)[0] for df in tables]
    corpus = kept if idf_from is None else idf_from
    idf = token_idf(reduce(DataFrame.unionByName, (df.select("name_normalized") for df in corpus)))
    return [features(df, idf) for df in kept]


def feature_rates(df: DataFrame) -> DataFrame:
    """Shares of rows with phonetic codes and distinctive tokens, and the mean number of tokens."""
    share = lambda c: F.avg(c.cast("double"))
    return df.agg(
        share(F.col("name_soundex").isNotNull()).alias("soundex_rate"), share(F.size("distinctive_tokens") > 0).alias("distinctive_rate"), F.avg("name_token_count").alias("mean_tokens")
    )
