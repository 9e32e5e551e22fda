"""Ranked lexical search: hashed max-sketches, batched upper bounds, exact rescoring in descending order of bound.

The index has a row per document: its length in terms, its distinct terms as
sorted 64-bit hashes with their counts, and a sketch.  In the sketch every term
falls on one coordinate of each of two rows by its hash, and a coordinate holds
the largest count that falls on it, coded upwards in a byte.  An impact grows
with the count at any document length, so the impact of the smaller of a query
term's two coordinates is at least the term's own; weighted and summed over the
terms it bounds the document's score from above.

A batch of queries is looked up in the sketches of many documents at once, which
gives all bounds by one matrix product.  For each query the documents of a batch
are then scored exactly from their term lists, the highest bound first, until
the bound falls below the query's tenth best score so far; that threshold is
carried from batch to batch of a task.  The tasks' best meet in one ranking.

A term's weight is floor(1000 ln((2N + 2) / (2 df + 1))), its impact in a document
(10^9 tf) div (1000 tf + 8 m) with m = 10 + (90 n N) div L: documents N, terms L in
all, n in this one, df documents with the term.

Queries are read in blocks of ``BLOCK_BYTES`` of text, each a pass over the index,
so what a task holds is bounded however many there are.  Nothing is cut off: a
document is passed over only where its bound shows that it cannot be among the best.

Cases: a null text, or one without terms, is in no ranking and counts for nothing;
queries without terms, or whose terms no document has, have no rows; repeated
documents are ranked as documents of their own, repeated queries (same id and
text) are one, and texts that share an item_id are ranked apart; equal scores go
by doc_id, a null one last; empty tables give an empty result; extra columns are
ignored; very long texts are indexed whole.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import LETTERS, cut, mix, text_slices, word_hashes, word_spans

K = 10
#: Text of queries that is looked up at once.
BLOCK_BYTES = 64 << 10
#: Coordinates of a sketch's row for each distinct term, at least, and the fewest of any.
SPREAD, NARROWEST = 2, 32
#: Documents whose bounds are worked out, and of one query rescored, at once.
CHUNK, STEP = 512, 16
#: Counts above this are coded in steps of this factor.
PLAIN, FACTOR = 31, 1.08
#: Shares that rounding in single precision may take off a bound.
ROUNDING = 1e-4

#: What a code stands for: counts up to PLAIN as they are, then the upper end of each step.
DECODED = np.concatenate([np.arange(PLAIN + 1), np.ceil(PLAIN * FACTOR ** np.arange(1, 256 - PLAIN))])
INDEX = "doc_id long, n long, sketch binary, terms binary, counts binary"


def encode(counts: np.ndarray) -> np.ndarray:
    """Codes that stand for at least the counts."""
    return np.searchsorted(DECODED, counts).astype(np.uint8)


def coordinates(terms: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The coordinates of terms in the two rows of a sketch of 2^bits each."""
    shift = np.uint64(64 - bits)
    return (terms >> shift).astype(np.int64), (mix(terms) >> shift).astype(np.int64)


def _binary(values: np.ndarray, at: np.ndarray) -> pa.Array:
    """Rows of bytes: values[at[i]:at[i + 1]]."""
    raw = np.ascontiguousarray(values).view(np.uint8)
    offs = (at * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(offs), pa.py_buffer(raw)])


def build_index(docs: DataFrame) -> DataFrame:
    """The index of the documents with terms; it knows of no query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, offs in text_slices(b, "text"):
                starts, ends, before = word_spans(data, offs, LETTERS)
                if not len(starts):
                    continue
                h = word_hashes(data, starts, ends, lower=True)
                of = np.repeat(np.arange(hi - lo), np.diff(before))
                order = np.lexsort((h, of))
                h, of = h[order], of[order]
                new = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (of[1:] != of[:-1])]))
                count = np.diff(np.append(new, len(h)))
                h, of = h[new], of[new]
                n = np.diff(before)
                rows = np.flatnonzero(n)
                at = np.searchsorted(of, np.append(rows, hi - lo))
                distinct = np.diff(at)
                bits = np.ceil(np.log2(np.maximum(SPREAD * distinct, NARROWEST))).astype(np.int64)
                begin = np.concatenate([[0], np.cumsum(2 << bits)])
                sketch = np.zeros(int(begin[-1]), np.uint8)
                row = np.repeat(np.arange(len(rows)), distinct)
                code = encode(count)
                shift = (64 - bits[row]).astype(np.uint64)
                for k, x in enumerate((h, mix(h))):
                    np.maximum.at(sketch, begin[row] + k * (1 << bits[row]) + (x >> shift).astype(np.int64), code)
                cols = [b.column("doc_id").slice(lo, hi - lo).take(pa.array(rows)), pa.array(n[rows]), _binary(sketch, begin), _binary(h, at), _binary(count.astype("<i4"), at)]
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "n", "sketch", "terms", "counts"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, INDEX)


def query_terms(texts: list[str]) -> list[np.ndarray]:
    """The distinct terms of each text."""
    data = [t.encode("utf-8") for t in texts]
    offs = np.concatenate([[0], np.cumsum([len(x) for x in data])]).astype(np.int64)
    raw = np.frombuffer(b"".join(data), np.uint8)
    starts, ends, before = word_spans(raw, offs, LETTERS)
    h = word_hashes(raw, starts, ends, lower=True)
    return [np.unique(h[x:y]) for x, y in zip(before[:-1], before[1:], strict=True)]


def document_frequencies(index: DataFrame, terms: np.ndarray) -> np.ndarray:
    """How many documents have each of the terms (sorted)."""
    held = index.sparkSession.sparkContext.broadcast(terms)  # of a block of queries

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = held.value
        maybe = np.zeros(1 << 20, bool)
        maybe[(terms >> np.uint64(44)).astype(np.int64)] = True
        total = np.zeros(len(terms), np.int64)
        for b in batches:
            for x in b.column("terms"):
                h = np.frombuffer(x.as_buffer(), np.uint64)
                h = h[maybe[(h >> np.uint64(44)).astype(np.int64)]]
                at = np.minimum(np.searchsorted(terms, h), len(terms) - 1)
                total[at[terms[at] == h]] += 1  # a document has a term once
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])], names=["term", "n"])

    counted = index.select("terms").mapInArrow(run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()  # a row a term
    out = np.zeros(len(terms), np.int64)
    out[counted["term"].to_numpy()] = counted["n"].to_numpy()
    return out


class Batch:
    """A block of queries: their terms, and which query takes each with what weight."""

    def __init__(self, names: list, queries: list[np.ndarray], terms: np.ndarray, df: np.ndarray, n_docs: int, n_terms: int):
        self.names, self.n_docs, self.n_terms = names, n_docs, n_terms
        live = df > 0
        self.terms = terms[live]
        weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df[live].tolist()], np.int64)
        self.queries, self.weights = [], []
        self.matrix = np.zeros((len(self.terms), len(queries)), np.float32)
        for q, t in enumerate(queries):
            at = np.flatnonzero(np.isin(self.terms, t))
            self.queries.append(self.terms[at])
            self.weights.append(weight[at])
            self.matrix[at, q] = weight[at]

    def slack(self, n: np.ndarray) -> np.ndarray:
        """m of documents with n terms."""
        return np.array([10 + 90 * x * self.n_docs // self.n_terms for x in n.tolist()], np.int64)

    def bounds(self, sketches: list[np.ndarray], m: np.ndarray) -> np.ndarray:
        """For each document and query a number that its score does not exceed."""
        out = np.zeros((len(sketches), len(self.queries)), np.float32)
        width = np.array([len(s) for s in sketches], np.int64)
        for w in np.unique(width).tolist():
            one, two = coordinates(self.terms, w.bit_length() - 2)
            rows = np.flatnonzero(width == w)
            for k in range(0, len(rows), CHUNK):
                at = rows[k : k + CHUNK]
                both = np.stack([sketches[i] for i in at])
                tf = DECODED.astype(np.float32)[np.minimum(both[:, one], both[:, w // 2 + two])]
                out[at] = (tf * np.float32(1e9) / (tf * np.float32(1000) + m[at, None].astype(np.float32) * np.float32(8))) @ self.matrix
        return out * np.float32(1 + ROUNDING)

    def score(self, q: int, terms: np.ndarray, counts: np.ndarray, m: int) -> int:
        """The score of a document with the terms (sorted) and their counts."""
        at = np.minimum(np.searchsorted(terms, self.queries[q]), len(terms) - 1)
        hit = terms[at] == self.queries[q]
        tf = counts[at[hit]].astype(np.int64)
        return int((self.weights[q][hit] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))).sum())


def best_of_tasks(index: DataFrame, batch: Batch, k: int) -> DataFrame:
    """(query, doc_id, score): the k best of each query in each task."""
    held = index.sparkSession.sparkContext.broadcast(vars(batch))  # a block of queries

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch = Batch.__new__(Batch)
        batch.__dict__.update(held.value)
        best: list[list[tuple]] = [[] for _ in batch.queries]  # heaps, the worst first
        for b in batches:
            ids = b.column("doc_id").to_pylist()
            m = batch.slack(b.column("n").to_numpy())
            # The order of ties: a document is better by a smaller id.
            key = [(0, -x) if x is not None else (-1, 0) for x in ids]
            bound = batch.bounds([np.frombuffer(x.as_buffer(), np.uint8) for x in b.column("sketch")], m)
            terms, counts = b.column("terms"), b.column("counts")
            for q, heap in enumerate(best):
                least = heap[0][0] if len(heap) == k else 1
                rows = np.flatnonzero(bound[:, q] >= least)
                for i in rows[np.argsort(-bound[rows, q], kind="stable")].tolist():
                    if bound[i, q] < (heap[0][0] if len(heap) == k else 1):
                        break
                    s = batch.score(q, np.frombuffer(terms[i].as_buffer(), np.uint64), np.frombuffer(counts[i].as_buffer(), "<i4"), int(m[i]))
                    if s > 0:
                        entry = (s, key[i])
                        if len(heap) < k:
                            heapq.heappush(heap, entry)
                        elif entry > heap[0]:
                            heapq.heapreplace(heap, entry)
        out = [(q, None if key[0] else -key[1], s) for q, heap in enumerate(best) for s, key in heap]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["query", "doc_id", "score"])

    return index.mapInArrow(run, "query long, doc_id long, score long")


def search(index: DataFrame, items: DataFrame, k: int = K, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents of the index that score highest for each item's text, above 0."""
    spark = index.sparkSession
    totals = index.agg(F.count("*"), F.sum("n")).first()
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where(F.octet_length("text") > 0).distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-int(size) // block_bytes))
    found = None
    for i in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == i).toArrow()  # about block_bytes of text
        queries = query_terms(rows["text"].to_pylist())
        terms = np.unique(np.concatenate([*queries, np.zeros(0, np.uint64)]))
        if not len(terms) or not totals[0]:
            continue
        batch = Batch(rows["item_id"].to_pylist(), queries, terms, document_frequencies(index, terms), totals[0], totals[1])
        part = best_of_tasks(index, batch, k)
        names = spark.createDataFrame(pa.table({"query": pa.array(range(len(queries)), pa.int64()), "item_id": pa.array(batch.names, pa.int64())}))
        order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
        part = part.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).join(F.broadcast(names), "query")
        part = part.select("item_id", "rank", "doc_id", "score")
        found = part if found is None else found.union(part)
    return found if found is not None else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")


def search_documents(docs: DataFrame, items: DataFrame, k: int = K, **kw) -> DataFrame:
    """The k best documents for each item, by an index made for the purpose."""
    return search(cut(build_index(docs), "index"), items, k, **kw)
