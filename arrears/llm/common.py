"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears.session import ensure_checkpoint_dir

#: Bytes of text that one task handles at once.
SLICE_BYTES = 1 << 20
#: White space between words, as a Java regular expression and as byte values.
WORD = r"[^\x20\x09-\x0D]+"
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[9, 10, 11, 12, 13, 32]] = False
#: Bytes of plain words: ASCII letters and digits, and all of other scripts.
LETTERS = np.array([chr(i).isalnum() or i > 127 for i in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_P = np.uint64(0x9E3779B97F4A7C15 | 1)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str = "step") -> DataFrame:
    """The same rows from a table written below the shared checkpoint folder, so later steps, and repeats after a lost
    executor, read them instead of computing them again.

    Unlike ``checkpoint()``, which computes its rows once to count and once to write them, this computes them once.
    The tables stay until the owner of the folder deletes them.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tidy(spark: SparkSession) -> None:
    """Free what finished steps leave behind: their plans on the driver, and with those their broadcasts and shuffle files.

    Spark drops broadcasts and shuffle files when the driver's garbage collector finds their plans unused.  A driver that
    only plans collects rarely, so over many steps its heap, and the executors' disks, would fill up to their bounds.
    """
    spark.sparkContext._jvm.System.gc()


def cut_and_tidy(df: DataFrame, name: str = "step") -> DataFrame:
    """``cut`` for operators of many steps: what the steps so far left behind is freed."""
    out = cut(df, name)
    tidy(df.sparkSession)
    return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores before them where ``df`` has such columns already."""
    out = []
    for name in names:
        while name in df.columns or name in out:
            name = f"_{name}"
        out.append(name)
    return out


_checked: dict[str, bool] = {}


def python_ready(spark: SparkSession) -> None:
    """Let Python tasks run where the executors cannot import this package: its functions then travel by value."""
    app = spark.sparkContext.applicationId
    if app in _checked:
        return

    def importable(batches):
        import importlib.util

        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([importlib.util.find_spec("arrears") is not None] * b.num_rows)], names=["here"])

    # Found out before any function of the package is sent.
    importable.__module__ = "__main__"
    here = spark.range(0, 64, 1, 8).mapInArrow(importable, "here boolean").agg(F.min("here")).first()[0]
    if not here:
        import arrears.llm as package

        cloudpickle.register_pickle_by_value(package)
    _checked[app] = bool(here)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit scramble (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _P)
_powers = np.ones(1, np.uint64)
_inverse = np.ones(1, np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """p^i and p^-i modulo 2^64 for i < n."""
    global _powers, _inverse
    if len(_powers) < n:
        m = max(n, 1 << 16)
        _powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(m - 1, _P, np.uint64)]), dtype=np.uint64)
        back = np.uint64(pow(int(_P), -1, 1 << 64))
        _inverse = np.cumprod(np.concatenate([[np.uint64(1)], np.full(m - 1, back, np.uint64)]), dtype=np.uint64)
    return _powers, _inverse


def range_hashes(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Hashes of values[lo:hi] for each pair; equal runs have equal hashes wherever they stand."""
    p, back = powers(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * p[: len(values)], out=total[1:])
    return mix((total[hi] - total[lo]) * back[lo] + (hi - lo).astype(np.uint64) * _BYTE[7])


def text_slices(batch: pa.RecordBatch | pa.Table, column: str, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows with about ``limit`` bytes; a null text is empty."""
    col = batch.column(column)
    col = pc.fill_null(col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col, "").cast(pa.large_binary())
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    n = len(col)
    if not n:
        return
    _, offs, data = col.buffers()
    offs = np.frombuffer(offs, np.int64)[col.offset : col.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1)
        yield lo, hi, data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
        lo = hi


def word_spans(data: np.ndarray, offs: np.ndarray, table: np.ndarray = NOT_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of each text, and for each text the number of words before it (n + 1 values)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    inside = table[data]
    first = np.zeros(len(data) + 1, bool)
    first[offs] = True  # a text's first byte begins a word even where the text before ends with one
    first = first[:-1]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1] | first[1:]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | first[1:]
    starts = np.flatnonzero(begin)
    ends = np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offs)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit hashes of the words; ``lower`` folds A-Z only."""
    out = np.zeros(len(starts), np.uint64)
    k = 0
    while k < len(starts):
        e = max(k + 1, int(np.searchsorted(ends, starts[k] + SLICE_BYTES, "right")))
        part = data[starts[k] : ends[e - 1]]
        values = _BYTE[_LOWER[part] if lower else part]
        out[k:e] = range_hashes(values, starts[k:e] - starts[k], ends[k:e] - starts[k])
        k = e
    return out


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each position on (len - n + 1 values)."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        out = out * _P + words[k : len(words) - n + 1 + k]  # an odd factor: no word loses bits
    return mix(out)


def components(edges: DataFrame, a: str = "a", b: str = "b", cut=cut) -> DataFrame:
    """(node, component) of every node of an edge list; the component is its smallest node.  ``cut`` writes a round's edges.

    Alternating large-star and small-star rounds: every round regroups the edges
    by node and links neighbours to the smallest one, so the number of edges
    never grows and the rounds stay few even on long chains.
    """
    e = cut(edges.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).where("u <> v").distinct())
    if e.isEmpty():
        return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    state = None
    while True:
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("m").alias("u"), "v").where("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(low, "u").select(F.col("m").alias("u"), "v").where("u <> v").union(low.select(F.col("m").alias("u"), F.col("u").alias("v")))
        e = cut(small.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    pairs = e.select(F.col("v").alias("node"), F.col("u").alias("component"))
    return pairs.union(e.select(F.col("u").alias("node"), F.col("u").alias("component"))).groupBy("node").agg(F.min("component").alias("component"))
