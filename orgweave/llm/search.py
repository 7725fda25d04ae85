"""Exact top-k search by BM25, long queries by products of matrices, short ones by block-max WAND, merged by global statistics.

Document frequencies, the number of documents and their mean length are of the whole table, so scores of
different shards compare. A shard's inverted index keeps postings by term and document, parts its documents
into aligned blocks, and holds the largest impact of each term in each block and in the shard.

A query of many terms meets nearly every block, so skipping saves it little. Such queries are scored together: what the terms
that many of them share with many documents add is one product of matrices in single precision, the postings of all other terms
are added to it, and what comes within its bounded error of the k-th best score is scored again in double precision.

For a shorter query there is one threshold, the k-th best score found so far. As in WAND, terms whose largest impacts together stay
under it can't bring a document into the result alone, so only blocks that hold one of the other terms are looked at.
Those blocks are bounded by the sum of their terms' block maxima and read from the highest bound down; once a bound is
under the threshold, the postings of all blocks left are skipped (Broder et al. 2003; Ding and Suel 2011). Aligned
blocks take the place of single-document pivots, so that numpy handles many at once.

Every query is first asked of one shard. The threshold found there goes with it to all others, where it starts,
and only what reaches it comes back. Queries meet shards in groups: every group of queries is dealt to every
shard, in bounded blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textvec
from .common import ready, stage


@dataclass(frozen=True)
class Bm25:
    k: int = 10
    k1: float = 1.2
    b: float = 0.75
    #: documents and postings of a shard, queries and their terms of a group, about; documents of a block
    shard: int = 8192
    postings: int = 2_000_000
    group: int = 2048
    terms: int = 1_000_000
    block: int = 16
    #: terms from which on a query is scored together with others; terms and queries that one product holds at most
    long: int = 16
    columns: int = 1024
    rows: int = 128
    #: decimals to which scores are rounded before they are ranked
    digits: int = 6


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, texts in textvec.blocks(textvec.arrow_rows(batches, "rid", "text"), 1):
        w = textvec.words(texts)
        terms, counts, length = [], [], []
        for a, b in zip(w.first[:-1], w.first[1:], strict=True):
            t, n = np.unique(w.hash[a:b].view(np.int64), return_counts=True)
            terms.append(t)
            counts.append(n.astype(np.int32))
            length.append(b - a)
        off = np.concatenate([[0], np.cumsum([len(t) for t in terms])]).astype(np.int32)
        lists = [pa.ListArray.from_arrays(pa.array(off), pa.array(np.concatenate(x))) for x in (terms, counts)]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array(np.array(length, np.int64)), *lists], ["rid", "length", "terms", "tf"])


class Index:
    """An inverted index of one shard; documents are in the order of their numbers.

    Postings ``at[e]:at[e + 1]`` are of one term in one block, entries ``of[t]:of[t + 1]`` of one term.
    """

    def __init__(self, docs: np.ndarray, length: np.ndarray, term: np.ndarray, owner: np.ndarray, tf: np.ndarray, mean: float, p: Bm25):
        order = np.lexsort((owner, term))
        self.docs, self.p = docs, p
        norm = p.k1 * (1 - p.b + p.b * length / mean) if mean else np.ones(len(docs))
        # by document: postings from[d]:from[d + 1] are those of one document, whose rows are given in order
        self.own_term, self.own_impact = term, tf * (p.k1 + 1) / (tf + norm[owner])
        self.from_ = np.searchsorted(owner, np.arange(len(docs) + 1))
        self.owner, self.impact, term = owner[order], self.own_impact[order], term[order]
        self.blocks = -(-len(docs) // p.block)
        block = self.owner // p.block
        new_term = np.concatenate([[True], term[1:] != term[:-1]]) if len(term) else np.empty(0, bool)
        first = np.flatnonzero(new_term | np.concatenate([[True], block[1:] != block[:-1]])) if len(term) else np.empty(0, np.int64)
        self.at, self.block_of = np.append(first, len(term)), block[first]
        self.block_max = np.maximum.reduceat(self.impact, first) if len(first) else np.empty(0)
        head = np.flatnonzero(new_term[first])
        self.of, self.terms = np.append(head, len(first)), term[first[head]]
        self.most = np.maximum.reduceat(self.block_max, head) if len(head) else np.empty(0)
        #: postings of the terms asked for, and those of them that were read
        self.asked = self.read = 0

    def search(self, terms: np.ndarray, idf: np.ndarray, least: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
        """The best documents that score ``least`` or more, and their scores; of equal scores the smaller number first."""
        p, slack = self.p, 10.0**-self.p.digits
        best, score = np.empty(0, np.int64), np.empty(0)
        if not len(self.terms) or not len(terms):
            return best, score
        t = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        here = self.terms[t] == terms
        t, idf = t[here], idf[here]
        if not len(t):
            return best, score
        self.asked += int((self.at[self.of[t + 1]] - self.at[self.of[t]]).sum())
        # the pivot: terms before it can't reach the threshold together
        order = np.argsort(idf * self.most[t], kind="stable")
        t, idf = t[order], idf[order]
        pivot = int(np.searchsorted(np.cumsum(idf * self.most[t]) + slack, least)) if least else 0
        size = self.of[t + 1] - self.of[t]
        entry, weight = _ranges(self.of[t], size), np.repeat(idf, size)
        open_ = np.zeros(self.blocks, bool)
        open_[self.block_of[entry[int(size[:pivot].sum()) :]]] = True
        keep = open_[self.block_of[entry]]
        entry, weight = entry[keep], weight[keep]
        block = self.block_of[entry]
        bound = np.bincount(block, weight * self.block_max[entry], minlength=self.blocks) + slack
        queue = np.flatnonzero(open_ & (bound >= least))
        queue = queue[np.argsort(-bound[queue], kind="stable")]
        bound, done, step = bound[queue], 0, max(4, 2 * p.k // p.block)
        slot = np.full(self.blocks, -1)
        while done < len(queue) and bound[done] >= least:
            now = queue[done : done + step]
            now = now[bound[done : done + step] >= least]
            slot[now] = np.arange(len(now))
            mine = slot[block] >= 0
            e = entry[mine]
            n = self.at[e + 1] - self.at[e]
            post = _ranges(self.at[e], n)
            owner = self.owner[post]
            place = slot[owner // p.block] * p.block + owner % p.block
            got = np.round(np.bincount(place, np.repeat(weight[mine], n) * self.impact[post], minlength=len(now) * p.block), p.digits)
            self.read += len(post)
            hit = np.flatnonzero((got > 0) & (got >= least))
            best, score = np.concatenate([best, now[hit // p.block] * p.block + hit % p.block]), np.concatenate([score, got[hit]])
            top = np.lexsort((best, -score))[: p.k]
            best, score = best[top], score[top]
            if len(score) == p.k:
                least = max(least, score[-1])
            slot[now] = -1
            done, step = done + len(now), 2 * step
        return self.docs[best], score


    def search_many(self, queries: list[tuple[np.ndarray, np.ndarray, float]]) -> list[tuple[np.ndarray, np.ndarray]]:
        """What ``search`` gives for each of many ``(terms, idf, least)``; the sums of a document's terms are in its own order."""
        p, n, out = self.p, len(self.docs), []
        if not len(self.terms):
            return [(np.empty(0, np.int64), np.empty(0)) for _ in queries]
        met = []
        for terms, idf, _ in queries:
            t = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
            here = self.terms[t] == terms
            met.append((t[here], idf[here]))
        held = self.at[self.of[1:]] - self.at[self.of[:-1]]
        # a product costs a document and query about a hundredth of what a posting costs that is added alone
        shared = held * np.bincount(np.concatenate([t for t, _ in met]), minlength=len(self.terms))
        heavy = np.flatnonzero(100 * shared > n * len(queries))
        heavy = heavy[np.argsort(-shared[heavy], kind="stable")][: p.columns]
        column = np.full(len(self.terms), -1)
        column[heavy] = np.arange(len(heavy))
        dense = np.zeros((len(heavy), n), np.float32)
        for c, t in enumerate(heavy):
            post = slice(self.at[self.of[t]], self.at[self.of[t + 1]])
            dense[c, self.owner[post]] = self.impact[post]
        for start in range(0, len(queries), p.rows):
            now = range(start, min(start + p.rows, len(queries)))
            weights = np.zeros((len(now), len(heavy)), np.float32)
            for row, q in enumerate(now):
                c = column[met[q][0]]
                weights[row, c[c >= 0]] = met[q][1][c >= 0]
            for q, score in zip(now, weights @ dense, strict=True):
                t, idf = met[q]
                alone = column[t] < 0
                first, size = self.at[self.of[t[alone]]], held[t[alone]]
                post = _ranges(first, size)
                score += np.bincount(self.owner[post], np.repeat(idf[alone], size) * self.impact[post], minlength=n)
                # single precision's bound for a sum of so many products
                slack = 10.0**-p.digits + 2.0**-22 * (len(t) + 2) * (p.k1 + 1) * float(idf.sum())
                out.append(self._best(*queries[q], score, slack))
        return out

    def _best(self, terms: np.ndarray, idf: np.ndarray, least: float, about: np.ndarray, slack: float) -> tuple[np.ndarray, np.ndarray]:
        """The best documents by double precision, of those that ``about``, right but for ``slack``, leaves open."""
        k = self.p.k
        found = np.flatnonzero((about > 0) & (about >= least - slack))
        if len(found) > k:
            found = found[about[found] >= np.partition(about[found], len(found) - k)[len(found) - k] - 2 * slack]
        if not len(found) or not len(terms):
            return np.empty(0, np.int64), np.empty(0)
        order = np.argsort(terms, kind="stable")
        terms, idf = terms[order], idf[order]
        size = self.from_[found + 1] - self.from_[found]
        post = _ranges(self.from_[found], size)
        at = np.minimum(np.searchsorted(terms, self.own_term[post]), len(terms) - 1)
        asked = terms[at] == self.own_term[post]
        score = np.round(np.bincount(np.repeat(np.arange(len(found)), size)[asked], idf[at[asked]] * self.own_impact[post[asked]], minlength=len(found)), self.p.digits)
        hit = np.flatnonzero((score > 0) & (score >= least))
        top = hit[np.lexsort((found[hit], -score[hit]))][:k]
        return self.docs[found[top]], score[top]


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers from each start, as many as its size."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - ends + size, size)


def _flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """A list column as its lengths and its values."""
    x = column.combine_chunks()
    return np.diff(x.offsets.to_numpy()), x.flatten().to_numpy()


def _search(p: Bm25, mean: float):
    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if left.num_rows and right.num_rows:
            left = left.sort_by("rid")
            n, terms = _flat(left.column("terms"))
            tf = _flat(left.column("tf"))[1]
            index = Index(left.column("rid").to_numpy(), left.column("length").to_numpy(), terms, np.repeat(np.arange(left.num_rows), n), tf, mean, p)
            n, terms = _flat(right.column("terms"))
            idf = _flat(right.column("idf"))[1]
            end = np.cumsum(n)
            asked = [(terms[a:b], idf[a:b], least) for least, a, b in zip(right.column("least").to_pylist(), end - n, end, strict=True)]
            qid, long = right.column("qid").to_numpy(), n >= p.long
            found = [(k, index.search(*asked[k])) for k in np.flatnonzero(~long)]
            found += zip(np.flatnonzero(long), index.search_many([asked[k] for k in np.flatnonzero(long)]) if long.any() else [], strict=True)
            out = [(np.full(len(docs), qid[k]), docs, scores) for k, (docs, scores) in found]
        cols = [np.concatenate([np.empty(0, d), *(x[k] for x in out)]).astype(d) for k, d in enumerate((np.int64, np.int64, np.float64))]
        return pa.table(dict(zip(("qid", "rid", "score"), map(pa.array, cols), strict=True)))

    return run


def _numbered(rows: DataFrame, name: str, key: str) -> DataFrame:
    """Distinct rows ``(key, text)`` with numbers in that order."""
    rows = rows.where(F.col(key).isNotNull()).select(key, F.coalesce("text", F.lit("")).alias("text")).distinct()
    return stage(rows.orderBy(key, "text").withColumn("rid", F.monotonically_increasing_id()), name)


def top_k(docs: DataFrame, queries: DataFrame, params: Bm25 = Bm25()) -> DataFrame:
    """``(query, rank, doc, score)``: for each row ``(query, text)`` the best rows ``(doc, text)``.

    Terms are lower-cased words; a query's distinct terms count once. The score is the sum over them of
    ln(1 + (N - df + 0.5) / (df + 0.5)) * tf * (k1 + 1) / (tf + k1 * (1 - b + b * length / mean length)),
    rounded; of equal scores the smaller document comes first. ``query`` and ``doc`` are values of any type that
    Spark orders, structs too. Rows that are equal in both columns are one query or one document; rows of one
    ``doc`` and different texts are documents of their own, and likewise queries, each with its own ranks. A null
    text is empty: it is never found, finds nothing, and counts as a document of no words. Rows whose ``doc`` or
    ``query`` is null are left out. Empty tables give no rows. Other columns are not read.
    """
    ready(docs.sparkSession)
    p = params
    schema = "rid long, length long, terms array<long>, tf array<int>"
    named = _numbered(docs, "documents", "doc")
    asked = _numbered(queries, "asked", "query")
    d = stage(named.select("rid", "text").mapInArrow(_terms, schema), "postings")
    n, mean, postings = d.agg(F.count("*"), F.coalesce(F.avg("length"), F.lit(0.0)), F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()
    q = asked.select("rid", "text").mapInArrow(_terms, schema).select(F.col("rid").alias("qid"), F.explode("terms").alias("term"))
    df = d.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    weighed = q.join(df, "term").select("qid", F.struct("term", F.log(1 + (n - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf")).alias("x"))
    # a list for each query, of its own distinct terms
    weighed = weighed.groupBy("qid").agg(F.array_sort(F.collect_list("x")).alias("x")).select("qid", F.col("x.term").alias("terms"), F.col("x.idf").alias("idf"))
    weighed = stage(weighed, "queries")
    n_asked, n_terms = weighed.agg(F.count("*"), F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()
    shards = max(1, -(-n // p.shard), -(-postings // p.postings))
    groups = max(1, -(-n_asked // p.group), -(-n_terms // p.terms))
    home = F.pmod(F.xxhash64("qid"), F.lit(shards))
    left = d.withColumn("s", F.pmod(F.xxhash64("rid"), F.lit(shards)))
    hits = "qid long, rid long, score double"
    right = weighed.withColumn("s", home).withColumn("least", F.lit(0.0))
    found = stage(left.groupBy("s").cogroup(right.groupBy("s")).applyInArrow(_search(p, float(mean)), hits), "hits")
    if shards > 1:
        least = found.groupBy("qid").agg(F.when(F.count("*") >= p.k, F.min("score")).otherwise(0.0).alias("least"))
        others = F.filter(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long")), lambda s: s != F.col("home"))
        right = weighed.join(least, "qid", "left").withColumn("least", F.coalesce("least", F.lit(0.0))).withColumn("home", home)
        right = right.withColumn("g", F.pmod(F.xxhash64("qid"), F.lit(groups)).cast("int")).withColumn("s", F.explode(others)).drop("home")
        left = left.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
        found = found.unionByName(left.groupBy("s", "g").cogroup(right.groupBy("s", "g")).applyInArrow(_search(p, float(mean)), hits))
    best = Window.partitionBy("qid").orderBy(F.desc("score"), "rid")
    found = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= p.k)
    found = found.join(named.select("rid", "doc"), "rid").join(asked.select(F.col("rid").alias("qid"), "query"), "qid")
    return found.select("query", "rank", "doc", "score")
