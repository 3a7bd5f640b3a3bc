"""Rank documents for queries by lexical score, with the best position algorithm.

Documents are read once: those terms that some query has are kept with their counts, a row per
document, and stored. Counts of documents and terms give the weights. Then each task takes its rows
in shards of a bounded number of postings, and sorts each shard into impact lists: per term, its
documents by falling impact. For a query, a shard's lists are read by direct access from their best
positions on (the best position of a list: up to there, every entry has been seen, be it by reading
that list or by looking up a document that another list gave). A document seen is scored at once
over all lists, and its entries there count as seen. The sum of the impacts at the best positions
bounds every document not seen; as the lists' seen parts grow by look-ups too, it falls sooner than
the impacts last read would let it. When it is strictly below the least score among the best ``k``,
the shard has nothing more to give, equal scores included. A task hands the best ``k`` it has from
shard to shard, so that later shards stop sooner, and returns ``k`` rows a query.

Those rows are ranked within groups of tasks and then in all: no task sees more than ``k`` rows of
each of its group's members, and no posting is shuffled. The queries' terms are what is broadcast;
queries are taken in blocks whose terms fit ``BLOCK_BYTES``, a pass over the documents each.

Defined cases: a null text, or one without a term, has no document and no row; a query without a
term has no rows; queries that repeat an id are ranked one by one, as are rows that repeat a
``doc_id``; equal scores go by ``doc_id``, null last; a very long text is one row of counts; no
documents or no queries give no rows. Extra columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierforge.scratch import scratch_dir, stage, staging

# A term: ASCII letters and digits and whatever lies beyond ASCII. In UTF-8, the bytes from 0x80.
_TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
#: Bytes of distinct query terms that a pass over the documents handles.
BLOCK_BYTES = 32 << 20
#: Postings of a shard.
SHARD = 1 << 21
#: Entries read from each list before the bound is looked at again: the first, and the most.
STEP, MOST_STEP = 16, 512
#: Tasks whose results are ranked together first.
GROUP = 64


def terms(text: bytes) -> list[bytes]:
    return _TERM.findall(text.lower())


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """``(10**9 * tf) div (1000 * tf + 20 * m)``, without the weight of the term."""
    if len(lengths) and int(lengths.max()) * n_docs * 50 >= 1 << 63:
        norm = np.array([50 + 50 * n * n_docs // n_terms for n in lengths.tolist()], np.int64)
    else:
        norm = 50 + 50 * lengths * n_docs // max(n_terms, 1)
    return (1_000_000_000 * tf) // (1000 * tf + 20 * norm)


class Best:
    """The best ``k`` documents of a query so far: by falling score, then rising id, null last."""

    def __init__(self, k: int):
        self.k = k
        self.scores, self.ids = np.empty(0, np.int64), np.empty(0, np.int64)
        self.nulls = np.empty(0, bool)

    def add(self, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        some = scores >= max(self.least(), 1)
        if not some.any():
            return
        scores = np.concatenate([self.scores, scores[some]])
        ids, nulls = np.concatenate([self.ids, ids[some]]), np.concatenate([self.nulls, nulls[some]])
        order = np.lexsort((ids, nulls, -scores))[: self.k]
        self.scores, self.ids, self.nulls = scores[order], ids[order], nulls[order]

    def least(self) -> int:
        """The score at place ``k``; 0 while there are fewer."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 0


class Shard:
    """Impact lists over some documents, and each document's entries in them."""

    def __init__(
        self,
        ids: np.ndarray,
        nulls: np.ndarray,
        starts: np.ndarray,
        term: np.ndarray,
        impact: np.ndarray,
        n_terms: int,
    ):
        self.ids, self.nulls, self.starts, self.term, self.impact = ids, nulls, starts, term, impact
        doc = np.repeat(np.arange(len(ids), dtype=np.int32), np.diff(starts))
        # Entry e of the lists is posting order[e]; posting p is entry place[p].
        self.order = np.lexsort((-impact, term))
        self.place = np.empty(len(term), np.int64)
        self.place[self.order] = np.arange(len(term))
        self.doc = doc[self.order]
        self.listed = impact[self.order]
        self.bounds = np.searchsorted(term[self.order], np.arange(n_terms + 1))
        self.read = 0

    def search(self, query: np.ndarray, weights: np.ndarray, best: Best) -> None:
        """Read the lists of the query's terms until no unseen document can join ``best``."""
        first, last = self.bounds[query], self.bounds[query + 1]
        some = last > first
        query, first, last = query[some], first[some], last[some]
        if not len(query):
            return
        weight_of = np.zeros(len(self.bounds), np.int64)
        weight_of[query] = weights[query]
        offset = np.full(len(self.bounds), -1, np.int64)
        offset[query] = np.concatenate([[0], np.cumsum(last - first)[:-1]])
        begin = offset[query]
        seen_entry = np.zeros(int((last - first).sum()), bool)
        seen_doc = np.zeros(len(self.ids), bool)
        # Next unseen entry of each list: one behind its best position.
        position, step = first.copy(), STEP
        while True:
            docs = []
            for j in range(len(query)):
                left = begin[j] + position[j] - first[j]
                ahead = seen_entry[left : left + min(last[j] - position[j], 4 * step)]
                docs.append(self.doc[position[j] + np.flatnonzero(~ahead)[:step]])
            new = np.unique(np.concatenate(docs))
            new = new[~seen_doc[new]]
            seen_doc[new] = True
            # Direct access: all entries of the new documents in the query's lists.
            sizes = self.starts[new + 1] - self.starts[new]
            ends = np.cumsum(sizes)
            posting = np.arange(ends[-1] if len(ends) else 0) + np.repeat(
                self.starts[new] - (ends - sizes), sizes
            )
            row = np.repeat(np.arange(len(new)), sizes)
            term = self.term[posting]
            mine = offset[term] >= 0
            posting, row, term = posting[mine], row[mine], term[mine]
            scores = np.zeros(len(new), np.int64)
            np.add.at(scores, row, weight_of[term] * self.impact[posting])
            seen_entry[offset[term] + self.place[posting] - self.bounds[term]] = True
            self.read += len(posting)
            best.add(scores, self.ids[new], self.nulls[new])
            bound = 0
            for j in range(len(query)):
                size = last[j] - position[j]
                left = begin[j] + position[j] - first[j]
                unseen = seen_entry[left : left + size]
                ahead = int(unseen.argmin()) if size else 0
                position[j] += size if size and unseen[ahead] else ahead
                if position[j] < last[j]:
                    # At the best position; before the first, nothing has been seen.
                    at = max(int(position[j]) - 1, int(first[j]))
                    bound += int(weight_of[query[j]]) * int(self.listed[at])
            if bound < best.least() or not bound:
                return
            step = min(2 * step, MOST_STEP)


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about ``SHARD`` postings, or of one row that has more."""
    upto = batch.column("term").offsets.to_numpy()
    start = 0
    while start < batch.num_rows:
        end = max(start + 1, int(np.searchsorted(upto, upto[start] + SHARD, "right")) - 1)
        yield batch.slice(start, end - start)
        start = end


def _vocabulary(queries: DataFrame) -> DataFrame:
    """``item_id, terms`` with the distinct terms of each query, sorted; none without a term."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(set(terms(t.as_py() or b""))) for t in batch.column("text").cast(pa.large_binary())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id"), pa.array(found, pa.list_(pa.binary()))], ["item_id", "terms"]
            )

    kind = queries.schema["item_id"].dataType.simpleString()
    out = queries.select("item_id", "text").mapInArrow(work, f"item_id {kind}, terms array<binary>")
    return out.filter(F.size("terms") > 0)


def _counts(docs: DataFrame, numbers: dict[bytes, int]) -> DataFrame:
    """``doc_id, n, term, tf`` of documents with a term: its length, and its counts of known terms."""
    known = docs.sparkSession.sparkContext.broadcast(numbers)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = known.value
        for batch in batches:
            rows, lengths, ends, term, tf = [], [], [0], [], []
            for row, value in enumerate(batch.column("text").cast(pa.large_binary())):
                found = terms(value.as_py() or b"")
                if not found:
                    continue
                mine = sorted((numbers[t], c) for t, c in Counter(found).items() if t in numbers)
                rows.append(row)
                lengths.append(len(found))
                term += [t for t, _ in mine]
                tf += [c for _, c in mine]
                ends.append(len(term))
            ends = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(rows, pa.int64())),
                    pa.array(lengths, pa.int64()),
                    pa.ListArray.from_arrays(ends, pa.array(term, pa.int32())),
                    pa.ListArray.from_arrays(ends, pa.array(tf, pa.int32())),
                ],
                ["doc_id", "n", "term", "tf"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        work, "doc_id long, n long, term array<int>, tf array<int>"
    )


def _searched(
    counts: DataFrame, queries: list[np.ndarray], weights: np.ndarray, n_docs: int, n_terms: int, k: int
) -> DataFrame:
    """``query, doc_id, score``: the best of each task."""
    shared = counts.sparkSession.sparkContext.broadcast((queries, weights))

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[Shard]:
        held, postings = [], 0

        def make() -> Shard:
            ids = np.concatenate([h[0] for h in held])
            nulls = np.concatenate([h[1] for h in held])
            sizes = np.concatenate([h[3] for h in held])
            tf = np.concatenate([h[5] for h in held]).astype(np.int64)
            lengths = np.repeat(np.concatenate([h[2] for h in held]), sizes)
            return Shard(
                ids,
                nulls,
                np.concatenate([[0], np.cumsum(sizes)]),
                np.concatenate([h[4] for h in held]),
                impacts(tf, lengths, n_docs, n_terms),
                len(weights),
            )

        for batch in (piece for whole in batches for piece in _pieces(whole)):
            ids = batch.column("doc_id")
            held.append(
                (
                    ids.fill_null(0).to_numpy(zero_copy_only=False),
                    ids.is_null().to_numpy(zero_copy_only=False),
                    batch.column("n").to_numpy(zero_copy_only=False),
                    np.diff(batch.column("term").offsets.to_numpy()).astype(np.int64),
                    batch.column("term").flatten().to_numpy(zero_copy_only=False),
                    batch.column("tf").flatten().to_numpy(zero_copy_only=False),
                )
            )
            postings += len(held[-1][4])
            if postings >= SHARD:
                yield make()
                held, postings = [], 0
        if held:
            yield make()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, weights = shared.value
        best = [Best(k) for _ in queries]
        for shard in shards(batches):
            for query, found in zip(queries, best, strict=True):
                shard.search(query, weights, found)
        for number, found in enumerate(best):
            if len(found.ids):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(found.ids), number, np.int32)),
                        pa.array(found.ids, mask=found.nulls),
                        pa.array(found.scores),
                    ],
                    ["query", "doc_id", "score"],
                )

    return counts.mapInArrow(work, "query int, doc_id long, score long")


def _top(found: DataFrame, k: int, *by: str) -> DataFrame:
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    return found.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(
        F.col("rank") <= k
    )


def rank(docs: DataFrame, queries: DataFrame, k: int = 50, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``item_id, rank, doc_id, score``: each query's ``k`` best documents with a score above 0."""
    spark = docs.sparkSession
    path = scratch_dir(spark, "ranked")
    kind = queries.schema["item_id"].dataType.simpleString()
    schema = f"item_id {kind}, rank int, doc_id long, score long"
    spark.createDataFrame([], schema).write.parquet(path)
    with staging(spark):
        wanted = stage(_vocabulary(queries), "queries")
        size = F.aggregate("terms", F.lit(0).cast("long"), lambda a, t: a + F.octet_length(t) + 8)
        total = wanted.agg(F.sum(size)).first()[0] or 0
        blocks = -(-total // block_bytes)
        deal = F.pmod(F.xxhash64("terms"), F.lit(blocks)) if blocks > 1 else F.lit(0)
        for block in range(blocks):
            rows = wanted.filter(deal == block).toArrow()
            if rows.num_rows:
                _block(docs, rows, k, kind).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def _block(docs: DataFrame, rows: pa.Table, k: int, kind: str) -> DataFrame:
    spark = docs.sparkSession
    asked = rows.column("terms").to_pylist()
    numbers = {t: i for i, t in enumerate(sorted({t for q in asked for t in q}))}
    counts = stage(_counts(docs, numbers), "counts")
    n_docs, n_terms = counts.agg(F.count("n"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = counts.select(F.explode("term").alias("term")).groupBy("term").count().toArrow()
    weights = np.zeros(len(numbers), np.int64)
    for term, n in zip(df.column("term").to_pylist(), df.column("count").to_pylist(), strict=True):
        weights[term] = weight(n_docs, n)
    # A term without weight adds to no score.
    queries = [
        np.array([i for i in (numbers[t] for t in q) if weights[i] > 0], np.int64) for q in asked
    ]
    found = _searched(counts, queries, weights, n_docs, n_terms, k)
    groups = F.floor(F.spark_partition_id() / GROUP)
    near = _top(found.withColumn("group", groups), k, "query", "group").drop("rank", "group")
    ids = spark.createDataFrame(
        pa.table({"query": pa.array(range(rows.num_rows), pa.int32()), "item_id": rows.column("item_id")})
    )
    return (
        _top(near, k, "query")
        .join(F.broadcast(ids), "query")
        .select(F.col("item_id").cast(kind), "rank", "doc_id", "score")
    )
