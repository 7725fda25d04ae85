"""Mixing sources to target weights by weighted fair queueing, with DataFrame operations only.

Sources share the budget (all words) by weight; a target stops at ``repeats`` times its source's size and
the excess is shared again. A source sends its documents in a shuffled order, ``repeats`` rounds of them
at most. Each sent document has a virtual finish time: the source's cumulative words, itself included,
divided by the source's target. The documents of all sources are taken in order of finish time until
the next would pass the budget.

Both running sums are made in two steps, over buckets and inside them, so that a source that holds most of
the rows is spread over many tasks. Texts are read once, for their sizes; the rest works on a slim table of ids,
sources and sizes. The sources' targets are broadcast after their number is checked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

WORD = r"[^\x20\x09-\x0D]+"
#: Hexadecimal digits of a document's hash that name its bucket: 4,096 in each source and round.
DIGITS = 3
#: Buckets of virtual time between 0 and 1.
TICKS = 4096
#: Sources whose targets are broadcast at most; more are joined by a shuffle.
BROADCAST = 1 << 16
#: Rows of equal id, source and size that are dealt out at once.
CHUNK = 1 << 10


def _key(source: Column) -> Column:
    return F.struct(source.isNull().alias("none"), F.coalesce(source, F.lit("")).alias("name"))


def targets(sizes: DataFrame, weights: tuple[int, ...], repeats: int) -> DataFrame:
    """``(source_key, source_size, target)`` from rows ``(source_key, size)``: one row for each source, water-filled."""
    s = sizes.groupBy("source_key").agg(F.sum("size").alias("source_size"))
    every = Window.orderBy("source_key")
    place = (F.row_number().over(every) - 1) % len(weights)
    s = s.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), place + 1).cast("long"))
    s = s.withColumn("cap", repeats * F.col("source_size"))
    by = Window.orderBy(F.col("cap") / F.col("w"), "source_key")
    below = by.rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumn("total", F.sum("source_size").over(Window.partitionBy()))
    s = s.withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(below), F.lit(0))) / F.sum("w").over(by.rowsBetween(0, Window.unboundedFollowing)))
    # sources below the first that its level doesn't fill are capped; the rest share at that level
    s = s.withColumn("open", F.min(F.when(F.col("level") * F.col("w") <= F.col("cap"), F.struct(F.col("cap") / F.col("w"), "source_key", "level"))).over(Window.partitionBy()))
    capped = F.col("open").isNull() | (F.struct(F.col("cap") / F.col("w"), "source_key") < F.struct(F.col("open.col1"), F.col("open.source_key")))
    return s.select("source_key", "source_size", F.when(capped, F.col("cap").cast("double")).otherwise(F.col("open.level") * F.col("w")).alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), repeats: int = 3, seed: str = "mix", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``(doc_id, source, ord, of, size, source_size, target, copies, taken)`` for every row of ``docs``.

    ``size`` is the number of words (a null text has none), ``copies`` how often the mix takes the
    document and ``taken`` its words in the mix. ``weights`` are dealt to the sources in code point order,
    a null source last, and repeat. ``ord`` counts the ``of`` rows of equal id, source and size, so repeated rows and
    null ids are documents of their own. Ties of finish times are broken by source, round, hash, id and ``ord``.
    Rows without words are never taken; an empty table gives no rows. Other columns aren't read.
    """
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    sizes = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), size.alias("size"))
    # equal rows are counted, not numbered by a window, so many of them don't meet in one sort
    groups = stage(sizes.groupBy("doc_id", "source", "size").agg(F.count("*").alias("of")), "sizes").withColumn("source_key", _key(F.col("source")))
    share = stage(targets(groups.select("source_key", (F.col("size") * F.col("of")).alias("size")), weights, repeats), "targets")
    share = F.broadcast(share) if share.count() <= BROADCAST else share
    rows = groups.join(share, "source_key").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.floor((F.col("of") - 1) / CHUNK))))
    ords = F.sequence(F.col("chunk") * CHUNK + 1, F.least((F.col("chunk") + 1) * CHUNK, F.col("of")))
    rows = stage(rows.withColumn("ord", F.explode(ords)).drop("chunk"), "documents")
    sent = rows.where("size > 0").withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1)))).where(F.col("round") * F.col("source_size") <= F.col("target"))
    name = F.concat_ws("|", F.lit(seed), F.col("round").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("ord").cast("string"))
    sent = sent.withColumn("hash", F.md5(name.cast("binary"))).withColumn("bucket", F.substring("hash", 1, DIGITS))
    queue = ["source_key", "round"]
    sums = sent.groupBy(*queue, "bucket").agg(F.sum("size").alias("words"))
    before = F.coalesce(F.sum("words").over(Window.partitionBy(*queue).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = sums.withColumn("before", before).drop("words")
    inside = Window.partitionBy(*queue, "bucket").orderBy("hash", "doc_id", "ord", "size").rowsBetween(Window.unboundedPreceding, 0)
    sent = sent.withColumn("inside", F.sum("size").over(inside)).join(sums, [*queue, "bucket"])
    sent = sent.withColumn("finish", (F.col("round") * F.col("source_size") + F.col("before") + F.col("inside")) / F.col("target"))
    sent = sent.withColumn("tick", F.floor(F.col("finish") * TICKS)).select("source_key", "doc_id", "ord", "size", "round", "hash", "finish", "tick")
    sent = stage(sent, "finish")
    ticks = sent.groupBy("tick").agg(F.sum("size").alias("words"))
    ticks = ticks.select("tick", F.coalesce(F.sum("words").over(Window.orderBy("tick").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    at = Window.partitionBy("tick").orderBy("finish", "source_key", "round", "hash", "doc_id", "ord", "size").rowsBetween(Window.unboundedPreceding, 0)
    budget = groups.agg(F.coalesce(F.sum(F.col("size") * F.col("of")), F.lit(0)).alias("budget"))
    taken = sent.withColumn("upto", F.sum("size").over(at)).join(ticks, "tick").crossJoin(F.broadcast(budget)).where("before + upto <= budget")
    copies = taken.groupBy("source_key", "doc_id", "ord", "size").agg(F.count("*").alias("copies"))
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"c.{c}")) for c in ("source_key", "doc_id", "ord", "size")]
    out = rows.alias("r").join(copies.alias("c"), same[0] & same[1] & same[2] & same[3], "left")
    n = F.coalesce(F.col("c.copies"), F.lit(0))
    return out.select("r.doc_id", "r.source", "r.ord", "r.of", "r.size", "r.source_size", "r.target", n.alias("copies"), (n * F.col("r.size")).alias("taken"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents that the mix takes, each as many times as it takes it, with the columns of ``docs``, whatever their names.

    Rows of equal id, source and size are told apart by their place in text order. An empty table gives no rows;
    a null text has no words and isn't taken.
    """
    id_col, text_col, source_col = (options.get(f"{k}_col", v) for k, v in (("id", "doc_id"), ("text", "text"), ("source", "source")))
    plan = stage(mix(docs, **options).where("copies > 0").select(F.col("doc_id").alias("pid"), F.col("source").alias("psource"), F.col("size").alias("psize"), "ord", "of", "copies"), "mix")
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    packed = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    d = docs.select(packed, F.col(id_col).alias("did"), F.col(source_col).cast("string").alias("dsource"), size.alias("dsize"))
    same = F.col("did").eqNullSafe(F.col("pid")) & F.col("dsource").eqNullSafe(F.col("psource")) & (F.col("dsize") == F.col("psize"))
    out = d.join(plan.where("of = 1").select("pid", "psource", "psize", "copies"), same).select("row", "copies")
    twins = plan.where("of > 1")
    if not twins.isEmpty():
        place = Window.partitionBy("did", "dsource", "dsize").orderBy(F.col("row").getField(text_col))
        several = d.join(twins.select("pid", "psource", "psize").distinct(), same, "left_semi").withColumn("place", F.row_number().over(place))
        out = out.unionByName(several.join(twins, same & (F.col("place") == F.col("ord"))).select("row", "copies"))
    return out.withColumn("copy", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).select(*(F.col("row").getField(c).alias(c) for c in docs.columns))
