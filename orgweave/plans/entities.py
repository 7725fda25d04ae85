"""Entity views: the driver tables seen as two tables of organizations, the same in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as t
from ..functions.places import stopwords
from ..operators.tokens import add_token_sets, distinctive_tokens, token_idf


#: Letters of a text that its first six words are looked for in, before the whole of it is.
HEAD = 256


def named(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's id, language and source, its name and the key over its whole text: all that the view takes from texts."""
    # a name is the first six words; the rest stays in one piece. If the head has a piece behind them, they are whole in it
    head, whole = (F.split(x, r"\s+", 7) for x in (F.ltrim(F.substring("text", 1, HEAD)), F.trim("text")))
    name = F.array_join(F.slice(F.when(F.size(head) == 7, head).otherwise(whole), 1, 6), " ")
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "source", name.alias("name"), F.md5(F.lower("text").cast("binary")).alias("ror_id"))


def described(df: DataFrame) -> DataFrame:
    """Rows of ``named`` as organization records; without its key over the texts they have none."""
    name = F.col("name")
    normal = t.normalize_name(name)
    four = F.array_join(F.slice(F.split(name, r"\s+"), 1, 4), " ")
    return df.select(
        "doc_id", F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("unique_id"), "name", t.clean_name(name).alias("name_clean"), normal.alias("name_normalized"),
        t.prefix(normal, 5).alias("name_prefix_5"), F.upper("lang").alias("country_code"), F.col("source").alias("city"), *(["ror_id"] if "ror_id" in df.columns else []),
        t.name_array(name, F.array(four)).alias("all_names"), (F.floor(F.col("doc_id") / 20) % 2).alias("side"), F.col("source").alias("source_table"),
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as an organization record with ``side`` 0 (reference) or 1 (incoming).

    Its name is the first six words of the text, so queries on this view read no more of it but for the key over the whole text.
    """
    return described(named(spark, sf_dir))


def sides(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return df.where("side = 0").drop("side"), df.where("side = 1").drop("side")


def with_tokens(df: DataFrame) -> DataFrame:
    return add_token_sets(distinctive_tokens(df, token_idf(df)))


def _list(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '{t.EDGES}', '', 'g')"


def sql_clean(x: str) -> str:
    return f"nullif({sql_strip(f"regexp_replace(lower({x}), '{t.BLANKS}', ' ', 'g')")}, '')"


def sql_normal(x: str) -> str:
    bare = f"regexp_replace(regexp_replace({sql_strip(x)}, '{t.PARENTHESES}', ''), '{t.LEGAL}', '')"
    kept = f"regexp_replace(lower({bare}), '{t.PUNCTUATION}', '', 'g')"
    return f"nullif({sql_strip(f"regexp_replace({kept}, '{t.BLANKS}', ' ', 'g')")}, '')"


def sql_words(x: str) -> str:
    return f"list_filter(string_split_regex(lower({x}), '{t.BLANKS}'), lambda w: w <> '')"


#: Common table expressions of the entity view.
SQL = rf"""
d AS (SELECT doc_id, lang, source, text, string_split_regex(trim(text), '\s+') AS words FROM documents),
n AS (SELECT *, array_to_string(list_slice(words, 1, 6), ' ') AS name, array_to_string(list_slice(words, 1, 4), ' ') AS name4 FROM d),
e AS (SELECT doc_id, 'doc_' || doc_id AS unique_id, name, {sql_clean("name")} AS name_clean, {sql_normal("name")} AS name_normalized, left({sql_normal("name")}, 5) AS name_prefix_5,
             upper(lang) AS country_code, source AS city, md5(lower(text)) AS ror_id,
             list_sort(list_distinct(list_filter([{sql_strip("name")}, {sql_strip("name4")}], lambda x: x <> ''))) AS all_names, (doc_id // 20) % 2 AS side, source AS source_table FROM n)
"""

#: The same with IDF, token sets and distinctive tokens, as ``f``.
SQL_TOKENS = rf"""{SQL},
w AS (SELECT DISTINCT name_normalized AS nm, {sql_words("name_normalized")} AS words FROM e WHERE name_normalized IS NOT NULL),
k AS (SELECT token, count(*) AS df, ln((SELECT count(*) FROM e WHERE name_normalized IS NOT NULL)::DOUBLE / count(*)) AS idf
      FROM (SELECT unnest(list_distinct({sql_words("name_normalized")})) AS token FROM e WHERE name_normalized IS NOT NULL) WHERE length(token) > 1 GROUP BY token),
c1 AS (SELECT nm, list_filter(words, lambda x: NOT list_contains({_list(stopwords())}, x)) AS fr FROM w),
c2 AS (SELECT nm, CASE WHEN len(list_filter(fr, lambda x: length(x) > 3)) > 0 THEN list_filter(fr, lambda x: length(x) > 3)
                       WHEN len(list_filter(fr, lambda x: length(x) >= 3)) > 0 THEN list_filter(fr, lambda x: length(x) >= 3)
                       WHEN length({sql_strip("nm")}) >= 3 THEN [lower({sql_strip("nm")})] ELSE [] END AS c FROM c1),
c3 AS (SELECT nm, unnest(c) AS token, unnest(range(1, len(c) + 1)) AS pos FROM c2),
c4 AS (SELECT nm, list_slice(list(c3.token ORDER BY coalesce(idf, 'inf'::DOUBLE) DESC, pos), 1, 3) AS toks FROM c3 LEFT JOIN k USING (token) GROUP BY nm),
f AS (SELECT e.*, coalesce(c4.toks, []) AS distinctive_tokens, c4.toks[1] AS distinctive_token,
             coalesce(list_sort(list_distinct(list_filter({sql_words("name_normalized")}, lambda x: NOT list_contains({_list(t.GRAMMAR_WORDS)}, x)))), []) AS name_tokens
      FROM e LEFT JOIN c4 ON e.name_normalized = c4.nm)
"""
