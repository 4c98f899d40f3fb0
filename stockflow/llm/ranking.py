"""Operator 13: ranked lexical search, term at a time with limited accumulators.

Documents are an index of one row each: their length in terms and the counts of
the terms that queries ask for. Every task takes its documents in blocks, turns
a block into postings by term and ranks it for each item: rarest term first,
every posting adds to its document's accumulator. Once the terms that remain
cannot lift a new document to the k-th partial score, no accumulator is made any
more; those there are still get all that remains, so their scores are exact.
The best of all blocks meet in two rounds.

Only index rows with a query term are scored, and only the k best of a block
leave a task.
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

from stockflow.llm.bpe import windows
from stockflow.llm.storage import stored

K = 50
ASKED = 1 << 19
BLOCK = 1 << 16
TERM = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")
_LOWER = {c: c + 32 for c in range(65, 91)}
INDEX = "doc_id long, n long, terms array<int>, counts array<long>"
FOUND = "place int, doc_id long, score long"


def _lower(text: str) -> str:
    return text.lower() if text.isascii() else text.translate(_LOWER)


def term_counts(text: str | None) -> Counter[str]:
    """How often each term occurs; a term is a run of ASCII letters, digits and characters beyond ASCII."""
    counts: Counter[str] = Counter()
    for window in windows(text or ""):
        counts.update(TERM.findall(_lower(window)))
    return counts


def item_terms(items: DataFrame) -> DataFrame:
    """``item_id, term``, each once; rows that share an item_id (null is one) are one item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0), batch.column(1), strict=True):
                terms = list(term_counts(text.as_py()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item.as_py()] * len(terms), pa.int64()), pa.array(terms, pa.string())], ["item_id", "term"]
                )

    return items.select("item_id", "text").mapInArrow(run, "item_id long, term string").distinct()


def index(docs: DataFrame, terms: list[str]) -> DataFrame:
    """Per document: doc_id, its number of terms, places in ``terms`` of those it holds, and their counts."""
    place = {t: i for i, t in enumerate(terms)}
    shared = docs.sparkSession.sparkContext.broadcast(place)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                total, found, counts, ends = [], [], [], [0]
                for text in part.column(1):
                    seen = term_counts(text.as_py())
                    asked = sorted((place[t], c) for t, c in seen.items() if t in place)
                    total.append(seen.total())
                    found += [t for t, _ in asked]
                    counts += [c for _, c in asked]
                    ends.append(len(found))
                ends_ = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(total, pa.int64()),
                        pa.ListArray.from_arrays(ends_, pa.array(found, pa.int32())),
                        pa.ListArray.from_arrays(ends_, pa.array(counts, pa.int64())),
                    ],
                    ["doc_id", "n", "terms", "counts"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, INDEX)


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Postings:
    """Postings of a block of documents by term, each with what it adds to a score."""

    def __init__(self, n: np.ndarray, rows: np.ndarray, terms: np.ndarray, counts: np.ndarray, weights: np.ndarray, n_docs: int, n_terms: int) -> None:
        norm = 100 - 50 + (50 * n * n_docs) // n_terms
        adds = weights[terms] * ((1_000_000_000 * counts) // (1000 * counts + 20 * norm[rows]))
        order = np.argsort(terms, kind="stable")
        self.rows, self.adds, terms = rows[order], adds[order], terms[order]
        self.terms, self.start = np.unique(terms, return_index=True)
        self.end = np.append(self.start[1:], terms.size)
        self.most = np.maximum.reduceat(self.adds, self.start) if terms.size else np.empty(0, np.int64)
        self.size = n.size

    def best(self, asked: np.ndarray, k: int, reach: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and scores of all documents that can be among the k best, their scores exact.

        ``asked`` has terms, rarest first. Documents that cannot reach ``reach``,
        a score that k documents are known to have, may be left out.
        """
        at = np.searchsorted(self.terms, asked)
        held = at < self.terms.size
        held[held] = self.terms[at[held]] == asked[held]
        at = at[held]
        score = np.zeros(self.size, np.int64)
        # What a document without an accumulator can still get, before each term.
        most = self.most[at]
        rest = np.cumsum(most[::-1])[::-1]
        got = np.cumsum(most) - most
        made, open_ = 0, True
        for step, t in enumerate(at.tolist()):
            rows, adds = self.rows[self.start[t] : self.end[t]], self.adds[self.start[t] : self.end[t]]
            if open_:
                partial = reach
                if made >= k and got[step] > rest[step]:
                    partial = max(partial, int(np.partition(score, self.size - k)[self.size - k]))
                open_ = rest[step] >= partial
            if open_:
                made += int((score[rows] == 0).sum())
                score[rows] += adds
            else:
                alive = score[rows] > 0
                score[rows[alive]] += adds[alive]
        rows = np.flatnonzero(score >= max(1, reach))
        if rows.size > k:
            least = np.partition(score[rows], rows.size - k)[rows.size - k]
            rows = rows[score[rows] >= least]
        return rows, score[rows]


def _first(ids: np.ndarray, null: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k first by score, then id, null ids last."""
    return np.lexsort((ids, null, -scores))[:k]


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    held, rows = [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            part = batch.slice(at, size)
            held.append(part)
            rows += part.num_rows
            if rows >= size:
                yield pa.Table.from_batches(held)
                held, rows = [], 0
    if held:
        yield pa.Table.from_batches(held)


def local_best(indexed: DataFrame, items: list[np.ndarray], weights: np.ndarray, n_docs: int, n_terms: int, k: int, block: int) -> DataFrame:
    """``place`` (in ``items``), ``doc_id, score``: the k best of each task for each item."""
    shared = indexed.sparkSession.sparkContext.broadcast((items, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights = shared.value
        none = np.empty(0, np.int64)
        best = [(none, none.astype(bool), none)] * len(items)
        for table in _blocks(batches, block):
            table = table.combine_chunks()
            doc_id = table.column("doc_id")
            ids, null = doc_id.fill_null(0).to_numpy(), doc_id.is_null().to_numpy(zero_copy_only=False)
            lists = table.column("terms").chunk(0)
            rows = np.repeat(np.arange(table.num_rows), np.diff(lists.offsets.to_numpy()))
            postings = Postings(
                table.column("n").to_numpy(), rows, lists.flatten().to_numpy().astype(np.int64),
                table.column("counts").chunk(0).flatten().to_numpy(), weights, n_docs, n_terms,
            )
            for i, asked in enumerate(items):
                had = best[i]
                reach = int(had[2][-1]) if had[2].size == k else 0
                found, scores = postings.best(asked, k, reach)
                if found.size:
                    ids_, null_, scores = np.append(had[0], ids[found]), np.append(had[1], null[found]), np.append(had[2], scores)
                    top = _first(ids_, null_, scores, k)
                    best[i] = ids_[top], null_[top], scores[top]
        sizes = [b[0].size for b in best]
        if sum(sizes):
            ids, null, scores = (np.concatenate(c) for c in zip(*best, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.arange(len(items)), sizes), pa.int32()), pa.array(ids, mask=null), pa.array(scores)],
                ["place", "doc_id", "score"],
            )

    return indexed.filter("size(terms) > 0").mapInArrow(run, FOUND)


def _query_blocks(terms: DataFrame, asked: int, k: int) -> Iterator[list[tuple[int | None, list[str]]]]:
    """Items with their terms, in blocks of about ``asked`` terms and results: what a task has to hold.

    Items are numbered by slices of ids, so that no task has to see all of them.
    """
    upto = F.sum("size").over(Window.partitionBy("part").orderBy(F.col("item_id").asc_nulls_first()))
    sizes = terms.groupBy("item_id").agg((F.count("*") + k).alias("size")).repartitionByRange("item_id")
    placed = stored(sizes.withColumn("part", F.spark_partition_id()).withColumn("before", upto - F.col("size")), "query-sizes")
    start, blocks = 0, {}
    for part, size in sorted(map(tuple, placed.groupBy("part").agg(F.sum("size")).collect())):
        for block in range(start // asked, (start + size - 1) // asked + 1):
            blocks.setdefault(block, []).append((part, start))
        start += size
    for block, parts in blocks.items():
        mine = F.lit(False)
        for part, start in parts:
            first = block * asked - start
            mine |= (F.col("part") == part) & (F.col("before") >= first) & (F.col("before") < first + asked)
        some = placed.filter(mine).select(F.col("item_id").alias("item"))
        rows = terms.join(some, F.col("item_id").eqNullSafe(F.col("item")), "left_semi").groupBy("item_id").agg(F.collect_list("term"))
        yield sorted(map(tuple, rows.collect()), key=lambda r: (r[0] is not None, r[0] or 0))


def ranked(docs: DataFrame, items: DataFrame, k: int = K, asked: int = ASKED, block: int = BLOCK) -> DataFrame:
    """Each item's ``k`` highest-scoring documents: item_id, rank, doc_id, score.

    A document is a row of ``docs``: repeated rows count and rank each, equal
    scores come by ascending doc_id, rows without an id last, and equal ids get
    neighbouring ranks. A null or empty text has no term and is never found. An
    item without a term, or whose terms no document holds, has no row; items are
    rows of ``items`` put together by item_id, null being an id of its own. Other
    columns of both tables are ignored, and empty tables give no row. Texts are
    taken whole.

    Items are worked on in blocks of about ``asked`` terms, each of which reads
    the documents once and is sent to every task; a task holds the postings of
    ``block`` documents at a time.
    """
    spark = docs.sparkSession
    terms = stored(item_terms(items), "item-terms")
    out = None
    for some in _query_blocks(terms, asked, k):
        words = sorted({t for _, ts in some for t in ts})
        indexed = stored(index(docs, words), "index")
        n_docs, n_terms = indexed.agg(F.expr("count_if(n > 0)"), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not n_terms:
            break
        df = np.zeros(len(words), np.int64)
        for t, c in indexed.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
            df[t] = c
        weights = np.array([weight(n_docs, int(d)) for d in df], np.int64)
        place = {t: i for i, t in enumerate(words)}
        # A term that no document holds, or that weighs nothing, changes no score.
        of_items = [np.array([place[t] for t in ts], np.int64) for _, ts in some]
        of_items = [a[(df[a] > 0) & (weights[a] > 0)] for a in of_items]
        of_items = [a[np.lexsort((a, df[a]))] for a in of_items]
        best = local_best(indexed, of_items, weights, n_docs, n_terms, k, block)
        # A slice of the candidates first, so that no task gets all tasks' candidates for an item.
        by = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
        slice_ = F.pmod(F.xxhash64("doc_id", "score"), F.lit(16))
        best = best.withColumn("slice", slice_)
        best = best.withColumn("rank", F.row_number().over(Window.partitionBy("place", "slice").orderBy(*by))).filter(F.col("rank") <= k)
        best = best.withColumn("rank", F.row_number().over(Window.partitionBy("place").orderBy(*by))).filter(F.col("rank") <= k)
        names = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(some)], "place int, item_id long")
        part = best.join(F.broadcast(names), "place").select("item_id", "rank", "doc_id", "score")
        out = part if out is None else out.union(part)
    if out is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return out
