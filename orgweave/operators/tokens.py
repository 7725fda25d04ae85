"""Corpus statistics of name tokens, and the tokens that tell a name apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.places import stopwords
from ..functions.text import soundex, strip, token_set, words


def token_idf(names: DataFrame, name: str = "name_normalized") -> DataFrame:
    """``(token, df, idf)``: in how many names a token of over one letter stands, and ln(N / df)."""
    held = names.where(F.col(name).isNotNull()).select(F.array_distinct(words(F.col(name))).alias("w"))
    total = held.agg(F.count("*").alias("n"))
    each = held.select(F.explode("w").alias("token")).where(F.length("token") > 1).groupBy("token").agg(F.count("*").alias("df"))
    return each.crossJoin(F.broadcast(total)).select("token", "df", F.log(F.col("n") / F.col("df")).alias("idf"))


def corpus_stopwords(idf: DataFrame, percentile: float = 0.10) -> DataFrame:
    """The tokens whose IDF is at most that percentile of all, with linear interpolation."""
    bound = idf.agg(F.percentile("idf", F.lit(percentile)).alias("bound"))
    return idf.crossJoin(F.broadcast(bound)).where(F.col("idf") <= F.col("bound")).select("token", "df", "idf")


def candidate_tokens(name: Column, stops: list[str]) -> Column:
    """Tokens of over three letters that are no stopwords; if there are none, of three; if none, the whole name."""
    w = words(name)
    free = F.filter(w, lambda x: ~x.isin(stops)) if stops else w  # many literals become one hash set
    long, three = F.filter(free, lambda x: F.length(x) > 3), F.filter(free, lambda x: F.length(x) >= 3)
    whole = F.lower(strip(name))
    return F.when(F.size(long) > 0, long).when(F.size(three) > 0, three).when(F.length(whole) >= 3, F.array(whole)).otherwise(F.array().cast("array<string>"))


def distinctive_tokens(df: DataFrame, idf: DataFrame, name: str = "name_normalized", n: int = 3, stops: list[str] | None = None) -> DataFrame:
    """``df`` with ``distinctive_tokens``, ``distinctive_token`` and ``distinctive_soundex``.

    The ``n`` candidates of highest IDF; tokens that the corpus lacks come first, ties keep their order in
    the name, repeats stay. Each distinct name is looked up once. A null name has no tokens.
    """
    stops = stopwords() if stops is None else stops
    each = df.select(F.col(name).alias("_name")).where(F.col("_name").isNotNull()).distinct()
    each = each.select("_name", F.posexplode(candidate_tokens(F.col("_name"), stops)).alias("_pos", "token"))
    known = each.join(idf.select("token", "idf"), "token", "left")
    order = F.struct((-F.coalesce("idf", F.lit(float("inf")))).alias("w"), F.col("_pos"), F.col("token"))
    top = known.groupBy("_name").agg(F.slice(F.array_sort(F.collect_list(order)), 1, n).alias("_t")).select("_name", F.transform("_t", lambda x: x["token"]).alias("_t"))
    out = df.join(top, F.col(name) == F.col("_name"), "left").withColumn("distinctive_tokens", F.coalesce("_t", F.array().cast("array<string>"))).drop("_name", "_t")
    out = out.withColumn("distinctive_token", F.get("distinctive_tokens", F.lit(0)))
    return out.withColumn("distinctive_soundex", soundex(F.col("distinctive_token")))


def add_token_sets(df: DataFrame, name: str = "name_normalized") -> DataFrame:
    """``df`` with ``name_tokens``, sorted and distinct, and ``name_token_count``."""
    return df.withColumn("name_tokens", token_set(F.col(name))).withColumn("name_token_count", F.size("name_tokens"))
