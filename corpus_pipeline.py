"""A corpus pipeline: language ID, near-duplicates, repeated passages, source mixing and tokens, stage by stage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orgweave.llm.bpe import Bpe, encode_documents
from orgweave.llm.common import fresh, ready, stage
from orgweave.llm.langid import UNKNOWN, identify
from orgweave.llm.minhash import Near, near_rows
from orgweave.llm.mixing import mixed_documents
from orgweave.llm.substring import Spans, remove_repeats

#: Below this closeness to every profile a text is in none of the languages learned. Set from scores on held-out texts.
LEAST_SCORE = 0.2


def _packed(docs: DataFrame, *needed: str) -> DataFrame:
    """The needed columns, and the others in one struct: whatever a step adds clashes with none of them."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in needed]
    return docs.select(*needed, F.struct(F.lit(None).cast("int").alias("_none"), *others).alias("_row"))


def _unpacked(found: DataFrame, columns: list[str], **new) -> DataFrame:
    own = set(found.columns) - {"_row"}
    inside = set(found.schema["_row"].dataType.names)
    return found.select(*((new[c] if c in new else F.col("_row").getField(c) if c in inside else F.col(f"`{c}`")).alias(c) for c in columns if c in own | inside))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without letters, so null and empty texts too, and those near to no language.

    Ties go to the first language in code point order. Repeated rows are judged alike. An empty table gives no rows, as
    does one without labelled texts to learn from. Other columns stay as they are, whatever their names.
    """
    found = identify(_packed(docs, "doc_id", "text", "lang"))
    return _unpacked(found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SCORE)), docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group: shingles of five words, similarity of 0.8 or more.

    Every row is a document, so of rows that repeat an id or are equal one stays if their texts are linked. The one that
    stays has the smallest id, a null id coming last, and of equal ids the row that was read first. Texts
    without words are linked with nothing. An empty table gives no rows.
    """
    rid = fresh(docs, "rid")
    rows = stage(docs.withColumn(rid, F.monotonically_increasing_id()), "numbered")
    found = near_rows(rows.select(F.col(rid).alias("rid"), F.col("doc_id").cast("long").alias("doc"), "text"), Near(shingle=5, percent=80))
    one = found.groupBy("root").agg(F.min(F.struct(F.col("doc").isNull().alias("none"), "doc", "rid")).alias("x")).select(F.col("x.rid").alias(rid))
    return rows.join(one, rid, "left_semi").select(*(F.col(f"`{c}`") for c in docs.columns))


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts repeated passages out; a document of which nothing is left goes, and n_chars follows the text.

    The first occurrence by id stays. Null and empty texts are left as they are, as are equal rows of one id, of which the
    stage before leaves one. An empty table gives no rows.
    """
    cut = remove_repeats(_packed(docs, "doc_id", "text"), Spans())
    left = cut.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_sentences")))
    return _unpacked(left, docs.columns, n_chars=F.length("text").cast("long"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: rows without words never, a null source as the last source.

    Repeated rows are documents of their own. An empty table gives no rows.
    """
    return mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of token counts and digests for each document of the mix; a null text is empty, repeated rows give equal rows."""
    return encode_documents(docs, Bpe(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN))


STAGES = [("language_id", language), ("minhash_near_dedup", near), ("substring_dedup", passages), ("source_mixing", mixture), ("byte_bpe", tokens)]
#: SQL cannot express the stages; tests hold the result against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
