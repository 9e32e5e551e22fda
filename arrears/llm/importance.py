"""Importance resampling towards a target distribution: array-scored weights and a distributed LSD radix sort.

The words of every text (letters, digits and all beyond ASCII; A-Z folded) give
features, runs of up to ``n`` words, hashed into a fixed number of buckets.  A
bucket's gain is the logarithm of how much likelier the target is to use it than
the corpus; a document's weight is the mean gain of its features, read off one
array.  Gumbel noise from a hash of the doc_id is added, and the documents with
the highest sums are drawn, which is sampling without replacement in proportion
to the importance weights.

The order comes from a radix sort, least significant digit first, over the
composite key (score, doc_id, number of features).  Rows lie in blocks of
bounded size.  Each pass counts the digits of every block, adds the counts up
over digits and blocks, which gives each block the first place of each of its
digits, and moves every row straight to its place: stable, without comparisons,
and no task holds more than a block.  The place after the last pass is the rank.

Cases: a null or empty text has no features, weight 0 and no rank; a null doc_id
takes part with the noise of ``<seed>:null`` and stands last among equal scores;
repeated rows are rows of their own; an empty target or table gives defined
results (gains against no features, no rows); extra columns are ignored and kept
by ``draw_documents``; very long texts are scored whole, a stretch at a time.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import _LOWER, LETTERS, cut, text_slices, unused, word_spans

#: Bits of a digit of the sort, and bounds of the rows of a block.
DIGIT = 12
BLOCK = 1 << 12, 1 << 18
#: Features that are hashed at once, and bytes up to which they are hashed side by side.
STRETCH = 1 << 18
SHORT = 48


@dataclass(frozen=True)
class Resampling:
    """Features of 1 to ``n`` words in ``buckets``; of the documents with ``min_words`` words, ``num`` of ``den`` are drawn."""

    n: int = 1
    buckets: int = 10_000
    min_words: int = 20
    num: int = 10
    den: int = 100
    seed: int = 2024


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1).astype(np.uint32)
    return t


_CRC = _crc_table()


def crc32_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """crc32 of data[start:end] for each pair: a byte of all of them at a time, the longest first."""
    size = ends - starts
    order = np.argsort(-size, kind="stable")
    at, left = starts[order], -size[order]
    crc = np.full(len(order), 0xFFFFFFFF, np.uint32)
    for i in range(min(SHORT, int(-left[0])) if len(left) else 0):
        m = int(np.searchsorted(left, -i))  # those with more than i bytes
        crc[:m] = _CRC[(crc[:m] ^ data[at[:m] + i]) & np.uint32(255)] ^ (crc[:m] >> np.uint32(8))
    crc ^= np.uint32(0xFFFFFFFF)
    for k in range(int(np.searchsorted(left, -SHORT))):
        crc[k] = zlib.crc32(data[at[k] : at[k] - left[k]].tobytes())
    out = np.empty(len(order), np.uint32)
    out[order] = crc
    return out


def features(data: np.ndarray, offs: np.ndarray, spec: Resampling) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, bucket) of the features of the texts, a stretch of words at a time."""
    starts, ends, before = word_spans(data, offs, LETTERS)
    of = np.repeat(np.arange(len(offs) - 1), np.diff(before))
    for lo in range(0, len(starts), STRETCH):
        hi = min(len(starts), lo + STRETCH)
        more = min(len(starts), hi + spec.n - 1)  # words that runs from this stretch reach into
        s, e = starts[lo:more], ends[lo:more]
        size = e - s
        first = np.cumsum(size + 1) - (size + 1)
        plain = np.full(int((size + 1).sum()), 32, np.uint8)  # the words, one space after each
        plain[np.arange(int(size.sum())) + np.repeat(np.arange(len(size)), size)] = _LOWER[data[np.repeat(s - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))]]
        for k in range(spec.n):
            m = np.arange(max(0, min(hi, len(starts) - k) - lo))
            m = m[of[lo + m] == of[lo + m + k]]
            yield of[lo + m], (crc32_spans(plain, first[m], first[m + k] + size[m + k]) % np.uint32(spec.buckets)).astype(np.int64)


def n_features(words: np.ndarray, n: int) -> np.ndarray:
    """Features of texts with so many words."""
    return sum(np.maximum(words - k, 0) for k in range(n))


def bucket_counts(texts: DataFrame, spec: Resampling) -> np.ndarray:
    """How many features of all texts fall into each bucket: an array of fixed size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(spec.buckets, np.int64)
        for b in batches:
            for _, _, data, offs in text_slices(b, "text"):
                for _, bucket in features(data, offs, spec):
                    total += np.bincount(bucket, minlength=spec.buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], names=["bucket", "n"])

    counted = texts.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()  # a row a bucket
    out = np.zeros(spec.buckets, np.int64)
    out[counted["bucket"].to_numpy()] = counted["n"].to_numpy()
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A bucket's gain in thousandths: floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets))))."""
    n, s_all, t_all = len(corpus), int(corpus.sum()), int(target.sum())
    one = lambda s, t: math.floor(1000 * math.log(float((t + 1) * (s_all + n)) / float((s + 1) * (t_all + n))))
    return np.array([one(s, t) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def noise(doc_id: int | None, seed: int) -> int:
    """Gumbel noise of a document in thousandths."""
    h = int(hashlib.sha256(f"{seed}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weights(docs: DataFrame, target: DataFrame, spec: Resampling = Resampling()) -> DataFrame:
    """(doc_id, tag, words, n_features, weight, score) of each document; ``tag`` is the hash of its text."""
    gain = docs.sparkSession.sparkContext.broadcast(gains(bucket_counts(docs, spec), bucket_counts(target, spec)))  # a number a bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, offs in text_slices(b, "text"):
                total = np.zeros(hi - lo, np.int64)
                for of, bucket in features(data, offs, spec):
                    total += np.bincount(of, weights=gain.value[bucket], minlength=hi - lo).astype(np.int64)  # whole numbers below 2^53
                words = np.diff(word_spans(data, offs, LETTERS)[2])
                n = n_features(words, spec.n)
                weight = np.where(n > 0, total // np.maximum(n, 1), 0)
                ids = b.column("doc_id").slice(lo, hi - lo)
                score = weight + np.array([noise(x, spec.seed) for x in ids.to_pylist()], np.int64)
                yield pa.RecordBatch.from_arrays([ids, b.column("tag").slice(lo, hi - lo), *(pa.array(x, pa.int64()) for x in (words, n, weight, score))], names=["doc_id", "tag", "words", "n_features", "weight", "score"])

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tag"), "text")
    return src.mapInArrow(run, "doc_id long, tag long, words long, n_features long, weight long, score long")


def _digit(fields: list[np.ndarray], bits: list[int], low: int, digit: int) -> np.ndarray:
    """The digit from bit ``low`` on of the composite key; the last field has the lowest bits."""
    out, at = np.zeros(len(fields[0]), np.int64), 0
    for v, n in zip(reversed(fields), reversed(bits), strict=True):
        if at < low + digit and at + n > low:
            part = v.view(np.uint64) >> np.uint64(max(0, low - at))
            out |= ((part & np.uint64((1 << digit) - 1)) << np.uint64(max(0, at - low))).astype(np.int64) & ((1 << digit) - 1)
        at += n
    return out


def _lists(names: list[str], heads: list, parts: list[list[np.ndarray]]) -> pa.RecordBatch:
    """A row a block: its head columns, and of each field the list of its values."""
    cols = [pa.array(h, pa.int64()) for h in heads]
    for values in parts:
        at = np.concatenate([[0], np.cumsum([len(x) for x in values])])
        cols.append(pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(np.concatenate([*values, np.zeros(0, np.int64)]).astype(np.int64))))
    return pa.RecordBatch.from_arrays(cols, names=names)


def _values(b: pa.RecordBatch | pa.Table, name: str, row: int) -> np.ndarray:
    return b.column(name)[row].values.to_numpy(zero_copy_only=False)


def radix_sort(rows: DataFrame, bits: list[int], total: int, digit: int = DIGIT, block: tuple[int, int] = BLOCK) -> DataFrame:
    """The rows (f0, f1, ... and other long columns, none null) with ``place``, from 0, in the order of the fields.

    Field i holds unsigned numbers of ``bits[i]`` bits; f0 weighs most.  Blocks have a 64th of the ``total`` rows, within the
    bounds ``block``.
    """
    names = rows.columns
    keys = [f"f{i}" for i in range(len(bits))]
    size = int(np.clip(-(-total // 64), *block))
    packed = ", ".join(f"{c} array<long>" for c in names)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, k = TaskContext.get().partitionId(), 0
        for b in batches:
            for lo in range(0, b.num_rows, size):
                yield _lists(["block", *names], [[part << 40 | k]], [[b.column(c).slice(lo, size).to_numpy()] for c in names])
                k += 1

    blocks = cut(rows.mapInArrow(pack, f"block long, {packed}"), "blocks")
    for low in range(0, sum(bits), digit):

        def count(batches: Iterator[pa.RecordBatch], low=low) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for i, block in enumerate(b.column("block").to_pylist()):
                    d, n = np.unique(_digit([_values(b, c, i) for c in keys], bits, low, digit), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(d), block)), pa.array(d, pa.int32()), pa.array(n)], names=["block", "digit", "n"])

        counts = blocks.select("block", *keys).mapInArrow(count, "block long, digit int, n long")
        whole = counts.groupBy("digit").agg(F.sum("n").alias("all"))  # at most 2^digit rows
        whole = whole.select("digit", (F.sum("all").over(Window.orderBy("digit")) - F.col("all")).alias("smaller"))
        before = F.sum("n").over(Window.partitionBy("digit").orderBy("block")) - F.col("n")
        first = counts.withColumn("before", before).join(F.broadcast(whole), "digit")
        first = first.groupBy("block").agg(F.collect_list(F.struct("digit", (F.col("smaller") + F.col("before")).alias("first"))).alias("first"))

        def move(batches: Iterator[pa.RecordBatch], low=low) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for i in range(b.num_rows):
                    fields = {c: _values(b, c, i) for c in names}
                    d = _digit([fields[c] for c in keys], bits, low, digit)
                    base = np.zeros(1 << digit, np.int64)
                    firsts = b.column("first")[i].values
                    base[firsts.field("digit").to_numpy()] = firsts.field("first").to_numpy()
                    # Counting sort of the block: rows of a digit keep their order.
                    order = np.argsort(d.astype(np.uint16), kind="stable")
                    run = np.bincount(d, minlength=1 << digit)
                    place = base[d[order]] + np.arange(len(d)) - (np.cumsum(run) - run)[d[order]]
                    to = place // size
                    at = np.concatenate([np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]])), [len(to)]])
                    cut_up = lambda v: [v[x:y] for x, y in zip(at[:-1], at[1:], strict=True)]
                    yield _lists(["block", "spot", *names], [to[at[:-1]]], [cut_up(place % size), *(cut_up(fields[c][order]) for c in names)])

        def put(key: tuple, t: pa.Table) -> pa.Table:
            flat = {c: t[c].combine_chunks().flatten().to_numpy() for c in ("spot", *names)}
            out = {c: np.empty(len(flat["spot"]), np.int64) for c in names}
            for c in names:
                out[c][flat["spot"]] = flat[c]
            return pa.Table.from_batches([_lists(["block", *names], [[key[0].as_py()]], [[out[c]] for c in names])])

        moved = blocks.join(first, "block").mapInArrow(move, f"block long, spot array<long>, {packed}")
        blocks = cut(moved.groupBy("block").applyInArrow(put, f"block long, {packed}"), "blocks")

    flat = blocks.select((F.col("block") * size).alias("b"), F.posexplode(F.arrays_zip(*names)).alias("i", "x"))
    return flat.select((F.col("b") + F.col("i")).alias("place"), *[F.col(f"x.{c}").alias(c) for c in names])


def ranked(docs: DataFrame, target: DataFrame, spec: Resampling = Resampling()) -> DataFrame:
    """(doc_id, tag, n_features, weight, score, rank) of each document; only drawn documents have a rank."""
    rows = cut(weights(docs, target, spec), "weights")
    able = F.col("words") >= spec.min_words
    some = rows.where(able)
    r = some.agg(F.count("*").alias("n"), F.min("score").alias("low"), F.max("score").alias("high"), F.min("doc_id").alias("id_low"), F.max("doc_id").alias("id_high"), F.max("n_features").alias("most")).first()
    rest = rows.where(~able).select("doc_id", "tag", "n_features", "weight", "score", F.lit(None).cast("long").alias("rank"))
    if not r["n"]:
        return rest
    # Unsigned fields: the highest score first, a null doc_id after all others, negative ids by their flipped sign bit.
    signed = (r["id_low"] or 0) < 0
    code = F.col("doc_id").bitwiseXOR(F.lit(-(1 << 63))) if signed else F.col("doc_id")
    fields = [F.lit(r["high"]) - F.col("score"), F.col("doc_id").isNull(), F.coalesce(code, F.lit(0)), F.col("n_features")]
    bits = [(r["high"] - r["low"]).bit_length(), 1, 64 if signed else (r["id_high"] or 0).bit_length(), r["most"].bit_length()]
    order = radix_sort(some.select(*[f.cast("long").alias(f"f{i}") for i, f in enumerate(fields)], "weight", "tag"), bits, r["n"])
    take = spec.num * r["n"] // spec.den
    doc_id = F.when(F.col("f1") == 0, F.col("f2").bitwiseXOR(F.lit(-(1 << 63))) if signed else F.col("f2"))
    out = order.select(doc_id.alias("doc_id"), "tag", F.col("f3").alias("n_features"), "weight", (F.lit(r["high"]) - F.col("f0")).alias("score"), F.when(F.col("place") < take, F.col("place") + 1).alias("rank"))
    return out.unionByName(rest)


def resampling_report(docs: DataFrame, target: DataFrame, spec: Resampling = Resampling()) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every document."""
    return ranked(docs, target, spec).drop("tag")


def draw_documents(docs: DataFrame, target: DataFrame, spec: Resampling = Resampling()) -> DataFrame:
    """The drawn documents with all their columns; of rows equal in doc_id and text as many as were drawn."""
    d, t, k, nth = unused(docs, "drawn_id", "drawn_tag", "n_drawn", "nth")
    drawn = ranked(docs, target, spec).where("rank is not null").groupBy(F.col("doc_id").alias(d), F.col("tag").alias(t)).agg(F.count("*").alias(k))
    both = docs.join(drawn, F.col("doc_id").cast("long").eqNullSafe(F.col(d)) & (F.xxhash64("text") == F.col(t)))
    place = F.row_number().over(Window.partitionBy(d, t).orderBy(F.xxhash64(*[F.col(c) for c in docs.columns])))
    return both.withColumn(nth, place).where(F.col(nth) <= F.col(k)).select(*docs.columns)
