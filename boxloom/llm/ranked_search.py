"""Ranked lexical search without random access: NRA over impact-sorted lists.

Documents are cut into terms once; of each, its length and its counts of the items' terms are written.
From that table come the statistics, and the searches: a task takes a block of documents, sorts each
term's postings by impact, and for each item reads its terms' lists in step from the greatest impact
on. Every document met has a lower bound, the sum of what was read, and an upper one, which adds the
last impact read of each list that it was not met in. Reading goes on until the documents that may be
among the best have exact scores and no other, met or not, can reach or tie them. The best of all
blocks are then ranked.
"""

from __future__ import annotations

import math
from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from boxloom.llm.scratch import removed, written
from boxloom.llm.words import batches

_DEPTH = 128  # postings of a list that are read before bounds are first compared
_POSTINGS = 1 << 21  # of a block of documents
_BYTES = 1 << 22  # of texts that are cut at once
_LENGTH_SHARE = 75  # of 100: how much a document's length counts

_TABLE = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()


def terms_of(text: bytes | None) -> list[bytes]:
    """Maximal runs of ASCII letters and digits and of other than ASCII characters; only A-Z are lower-cased."""
    return (text or b"").translate(_TABLE).split()


class Lists:
    """The impact-sorted postings of a block of documents."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, n_terms: int):
        order = np.lexsort((doc, -impact, term))
        self.doc, self.impact = doc[order], impact[order]
        self.starts = np.searchsorted(term[order], np.arange(n_terms + 1))
        self.n_docs = int(doc.max()) + 1 if len(doc) else 0

    def best(self, weights: dict[int, int], top: int, ids: np.ndarray) -> list[tuple[int, int]]:
        """(document, score) of the highest scores above 0, equal ones by ``ids``, for terms with these weights."""
        lists = [(self.starts[t], self.starts[t + 1], w) for t, w in weights.items() if w > 0 and self.starts[t] < self.starts[t + 1]]
        lower = np.zeros(self.n_docs, np.int64)
        met = np.zeros((len(lists), self.n_docs), bool)
        depth, before = _DEPTH, 0
        while True:
            last = np.zeros(len(lists), np.int64)  # what a document not met in a list can get from it at most
            for j, (start, stop, w) in enumerate(lists):
                a, b = min(start + before, stop), min(start + depth, stop)
                docs = self.doc[a:b]
                lower[docs] += w * self.impact[a:b]
                met[j, docs] = True
                if b < stop:
                    last[j] = w * self.impact[b - 1]
            found = np.flatnonzero(lower)
            least = int(np.partition(lower[found], -top)[-top]) if len(found) >= top else 0
            rest = int(last.sum())
            if rest == 0 or rest < least:
                upper = lower[found] + rest
                for j in np.flatnonzero(last):
                    upper -= last[j] * met[j, found]
                able = (upper >= least) & (lower[found] > 0)
                if (upper[able] == lower[found[able]]).all():
                    own = found[able]
                    own = own[np.lexsort((ids[own], -lower[own]))][:top]
                    return list(zip(own.tolist(), lower[own].tolist(), strict=True))
            before, depth = depth, 2 * depth


def _postings(vocabulary: dict[bytes, int]):
    """A function of batches (doc_id, text): doc_id, number of terms, and the counts of known terms, of each text with a term."""

    def count(frames):
        for frame in frames:
            rows = zip(frame.column(0).to_pylist(), frame.column(1).cast(pa.binary()), strict=True)
            for some in batches(((i, t.as_py()) for i, t in rows), lambda x: len(x[1] or b"") + 64, _BYTES):
                ids, sizes, terms, counts = [], [], [], []
                for i, text in some:
                    words = terms_of(text)
                    if words:
                        known = np.fromiter((t for t in map(vocabulary.get, words) if t is not None), np.int32)
                        own, n = np.unique(known, return_counts=True)
                        ids.append(i)
                        sizes.append(len(words))
                        terms.append(own)
                        counts.append(n.astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32()))],
                    ["doc", "n", "terms", "counts"],
                )

    return count


def _search(queries: list[dict[int, int]], n_terms: int, n_docs: int, total: int, top: int):
    """A function of batches of postings: the best documents of their blocks for each query."""

    def blocks(frames):
        held, size = [], 0
        for frame in frames:
            for a in range(0, frame.num_rows, 4096):
                held.append(frame.slice(a, 4096))
                size += len(held[-1].column(2).flatten())
                if size >= _POSTINGS:
                    yield pa.Table.from_batches(held)
                    held, size = [], 0
        if held:
            yield pa.Table.from_batches(held)

    def search(frames):
        for block in blocks(frames):
            term, tf = (block.column(k).combine_chunks().flatten().to_numpy().astype(np.int64) for k in (2, 3))
            ids = block.column(0).to_numpy()  # with nulls a float, which only loses order beyond 2**53
            if block.column(0).null_count:
                order = np.argsort(np.array([(x is None, x or 0) for x in block.column(0).to_pylist()], "?,i8"), kind="stable")
                ids = np.empty(len(order), np.int64)
                ids[order] = np.arange(len(order))
            n = block.column(1).to_numpy()
            own = np.repeat(np.arange(len(n)), [len(x) for x in block.column(2)])
            m = 100 - _LENGTH_SHARE + _LENGTH_SHARE * n * n_docs // total
            lists = Lists(own, term, 1_000_000_000 * tf // (1000 * tf + 8 * m[own]), n_terms)
            out = [(k, d, score) for k, weights in enumerate(queries) for d, score in lists.best(weights, top, ids)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _, _ in out], pa.int32()), block.column(0).combine_chunks().take(pa.array([d for _, d, _ in out], pa.int64())), pa.array([s for _, _, s in out], pa.int64())],
                ["query", "doc", "score"],
            )

    return search


def rank_documents(
    docs: DataFrame, items: DataFrame, top: int = 10, text: str = "text", doc_id: str = "doc_id", item_text: str = "text", item_id: str = "item_id",
    block_bytes: int = 4 << 20,
) -> DataFrame:
    """``item_id``, ``rank`` (from 1), ``doc_id`` and ``score`` of each item's ``top`` documents with a score above 0.

    A term's weight is floor(1000 * ln((2N + 2) / (2df + 1))), and its impact in a document
    1000000000 * tf div (1000 * tf + 8m) with m = 25 + 75nN div L. Equal scores are ranked by ascending
    id, null ids last. Texts are read whole, whatever their length; null and empty ones have no terms
    and count nowhere. Repeated rows of documents are documents of their own; of items, one row of an
    id and text counts. Items without terms, and items or documents that are none, give no rows. Other columns, whatever their names, are not read. Items go to the tasks in blocks of ``block_bytes``.
    """
    items = items.select(F.col(item_id).cast("bigint").alias("item"), F.col(item_text).alias("body")).where("body IS NOT NULL").distinct()
    size = items.agg(F.sum(F.octet_length("body") + 64)).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc"), F.col(text).alias("text"))
    parts = []
    for b in range(blocks):
        block = items.where(F.pmod(F.xxhash64("item", "body"), F.lit(blocks)) == b)
        own = [(i, Counter(terms_of(body.encode()))) for i, body in block.collect()]
        vocabulary = {t: k for k, t in enumerate(sorted({t for _, counts in own for t in counts}))}
        held = written(rows.mapInArrow(_postings(vocabulary), "doc bigint, n bigint, terms array<int>, counts array<int>"))
        n_docs, total = held.agg(F.count("*"), F.sum("n")).first()
        found = dict(held.select(F.explode("terms").alias("t")).groupBy("t").count().collect())  # a number a term of the block
        weight = {k: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for k, df in found.items()}
        queries = [{vocabulary[t]: times * weight[vocabulary[t]] for t, times in counts.items() if vocabulary[t] in weight} for _, counts in own]
        best = held.where(F.size("terms") > 0).mapInArrow(_search(queries, len(vocabulary), n_docs, total or 1, top), "query int, doc bigint, score bigint")
        order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
        ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        ids = F.lit([i for i, _ in own] or [0]).cast("array<bigint>")
        parts.append(written(ranked.select(F.get(ids, F.col("query")).alias("item_id"), "rank", F.col("doc").alias("doc_id"), "score")))
        removed(held)
    return reduce(DataFrame.union, parts)
