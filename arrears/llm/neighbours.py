"""Approximate nearest neighbours with an inverted multi-index.

A vector is cut in two halves, each quantised by its own k centroids; the pair
of centroids is its cell.  A query visits cells by the sum of its two halves'
distances, smallest first, until they hold enough candidates; those are
reranked by exact cosine on the original vectors.

How many are enough is measured in each run: a hash sample of the queries
(``MEASURED``) is compared with every row, and the visit is widened until it
holds ``RECALL`` of their true neighbours, up to all cells.  On vectors without
clusters that is a share of the table, on clustered ones a few cells.

The centroids are fitted on a bounded sample (``SAMPLE`` vectors by hash of the
id); every row is indexed.  Cells lie side by side in blocks of at most
``BLOCK`` rows, and a cell may reach over many, so a cell with a third of all
rows is many tasks' work, never one's.  A task compares one block with at most
about ``CHUNK`` queries.

Cases: vectors that are null, empty, zero, of another dimension than most of
the sample, or hold a null or non-finite component take no part; components may be
as large or small as doubles are; rows with one vec_id are one candidate, by its
nearest row, and one query, by its smallest vector; ties go to the smaller vec_id; fewer
candidates than k give all of them; empty tables give empty results; extra
columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, mix

SAMPLE = 20_000
#: Rows of a block and queries of a task, at most; both hold fewer where a vector has over 64 numbers.
BLOCK, CHUNK = 65_536, 16_384
#: A small table is dealt to this many blocks.
DEAL = 64
NEAREST = 5
#: Rows that a cell should hold on average.
PER_CELL = 100
#: Queries that are compared with every row, and the share of their true neighbours that the visit must hold.
MEASURED, RECALL = 200, 0.95
#: Candidates that a query visits, at least.
VISIT_LEAST = 3000


def valid(vectors: DataFrame, dim: int | None = None) -> DataFrame:
    """(vec_id, v array<double>) of the vectors that take part."""
    v = F.col("embedding").cast("array<double>")
    fine = F.col("v").isNotNull() & (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    out = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(F.col("vec_id").isNotNull()).where(F.coalesce(fine, F.lit(False)))
    out = out.where(F.exists("v", lambda x: x != 0))
    return out if dim is None else out.where(F.size("v") == dim)


def lloyd(x: np.ndarray, k: int, rounds: int = 15, seed: int = 3) -> np.ndarray:
    """k centroids of the rows of x."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), k, replace=len(x) < k)]
    for _ in range(rounds):
        near = nearest(x, c)
        n = np.bincount(near, minlength=k)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        c = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], x[rng.choice(len(x), k)])
    return c


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.argmin((c**2).sum(1) - 2 * (x @ c.T), axis=1)


def cells_by_distance(d1: np.ndarray, d2: np.ndarray, held: np.ndarray, enough: int) -> list[int]:
    """Cells in order of d1[i] + d2[j] until they hold ``enough`` rows; ``held`` has the rows of each cell.

    A pair enters the heap once its two smaller neighbours have left it.
    A cell counts for at most a fourth of the goal, so one crowded cell does not end the search.
    """
    a, b = np.argsort(d1, kind="stable"), np.argsort(d2, kind="stable")
    heap, seen, out, n = [(d1[a[0]] + d2[b[0]], 0, 0)], {(0, 0)}, [], 0
    while heap and n < enough:
        _, i, j = heapq.heappop(heap)
        cell = int(a[i]) * len(d2) + int(b[j])
        if held[cell]:
            out.append(cell)
            n += min(int(held[cell]), max(1, enough // 4))
        for p, q in ((i + 1, j), (i, j + 1)):
            if p < len(a) and q < len(b) and (p, q) not in seen and (p == 0 or (p - 1, q) in seen) and (q == 0 or (p, q - 1) in seen):
                seen.add((p, q))
                heapq.heappush(heap, (d1[a[p]] + d2[b[q]], p, q))
    return out


def cells_in_order(d1: np.ndarray, d2: np.ndarray, held: np.ndarray) -> np.ndarray:
    """All cells with rows by d1[i] + d2[j]."""
    cells = np.flatnonzero(held)
    return cells[np.argsort((d1[:, None] + d2).ravel()[cells], kind="stable")]


def counted_before(held: np.ndarray, enough: int) -> np.ndarray:
    """The rows that count before each cell of an order, as in ``cells_by_distance``; cells with fewer than ``enough`` are visited."""
    n = np.minimum(held, max(1, enough // 4))
    return np.cumsum(n) - n


def widened(orders: Iterator[tuple[np.ndarray, np.ndarray]], held: np.ndarray, least: int, recall: float) -> int:
    """The smallest tried budget whose visit holds ``recall`` of the true neighbours.

    ``orders`` has for each query the cells in order and the places in it of its true neighbours' cells.
    """
    tried = [least]
    while tried[-1] < 4 * held.sum():  # there every cell is visited
        tried.append(tried[-1] * 6 // 5 + 1)
    hit, every = np.zeros(len(tried), np.int64), 0
    for cells, at in orders:
        n = held[cells]
        hit += [int((counted_before(n, enough)[at] < enough).sum()) for enough in tried]
        every += len(at)
    return tried[int(np.argmax(hit >= recall * every))]


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times the power of two that brings their largest component to 0.5 to 1.

    That is exact and leaves cosines as they are, but no square overflows or vanishes.
    """
    return np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1])


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    return scaled(col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), dim))


def fit(rows: DataFrame, n: int, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray, int] | None:
    """Centroids of the two halves and the dimension, from at most ``sample`` vectors."""
    got = [np.array(r["v"]) for r in rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("v").toLocalIterator()]
    if not got:
        return None
    dims, counts = np.unique([len(x) for x in got], return_counts=True)
    dim = int(dims[np.argmax(counts)])
    x = scaled(np.array([v for v in got if len(v) == dim]))
    x /= np.sqrt((x**2).sum(1, keepdims=True))
    k = int(min(1024, max(1, np.sqrt(n / PER_CELL)), len(x)))
    cut_at = max(1, dim // 2)
    return lloyd(x[:, :cut_at], k), lloyd(x[:, cut_at:], k), dim


def search(vectors: DataFrame, is_query, k: int = NEAREST, visit: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each row that meets the condition ``is_query``.

    ``visit`` fixes the number of candidates that is otherwise measured.
    """
    spark = vectors.sparkSession
    rows = cut(valid(vectors))
    n = rows.count()
    model = fit(rows, n)
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if model is None:
        return empty
    c1, c2, dim = model
    k2 = len(c2)
    rows = rows.where(F.size("v") == dim)
    held = spark.sparkContext.broadcast((c1, c2))  # at most 1024 centroids a half

    def halves(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        u = v / np.sqrt((v**2).sum(1, keepdims=True))
        return u[:, : held.value[0].shape[1]], u[:, held.value[0].shape[1] :]

    def distances(v: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for a, z in zip(*halves(v), strict=True):
            yield ((held.value[0] - a) ** 2).sum(1), ((held.value[1] - z) ** 2).sum(1)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                a, z = halves(_matrix(b.column("v"), dim))
                yield b.append_column("cell", pa.array((nearest(a, held.value[0]) * k2 + nearest(z, held.value[1])).astype(np.int64)))

    index = cut(rows.mapInArrow(assign, "vec_id long, v array<double>, cell long"))
    sizes = index.groupBy("cell").agg(F.count("*").alias("n")).toArrow()  # a row for each of at most 2^20 cells
    count = np.zeros(len(c1) * k2, np.int64)
    count[sizes["cell"].to_numpy()] = sizes["n"].to_numpy()
    total = int(count.sum())
    narrow = max(1, dim // 64)
    size = max(1, min(BLOCK // narrow, -(-total // DEAL)))
    # All rows lie on a line, cell by cell, that is cut into blocks; a cell's rows are spread over its stretch of it.
    before = np.cumsum(count) - count
    first, last = before // size, (before + np.maximum(count, 1) - 1) // size
    low = np.searchsorted(last, np.arange(-(-total // size)))  # the cells that reach into each block, from low to high
    high = np.searchsorted(first, np.arange(len(low)), "right")
    line = spark.sparkContext.broadcast((count, before, first, last, low, high))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, before = line.value[:2]
        for b in batches:
            if b.num_rows:
                cell = b.column("cell").to_numpy()
                at = before[cell] + (mix(b.column("vec_id").to_numpy()) % count[cell].astype(np.uint64)).astype(np.int64)
                yield b.append_column("block", pa.array(at // size))

    blocks = index.mapInArrow(place, "vec_id long, v array<double>, cell long, block long")

    def rerank(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64()), ("cell", pa.int64())])
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        x, q = _matrix(left["v"].combine_chunks(), dim), _matrix(right["q"].combine_chunks(), dim)
        ids, of, cell = left["vec_id"].to_numpy(), right["query_id"].to_numpy(), left["cell"].to_numpy()
        bits, local = right["bits"].to_pylist(), cell - line.value[4][key[0].as_py()]
        norm = np.sqrt((x * x).sum(1))
        few = k * int(np.unique(ids, return_counts=True)[1].max())  # rows that hold k ids
        out = []
        tile = max(1, (1 << 21) // len(x))
        for t in range(0, len(q), tile):
            all_rough = (q[t : t + tile] @ x.T) / norm
            for i in range(t, min(t + tile, len(q))):
                near = np.flatnonzero(np.unpackbits(np.frombuffer(bits[i], np.uint8)).view(bool)[local] & (ids != of[i]))
                if len(near) > few:
                    rough = all_rough[i - t][near]
                    near = near[rough >= np.partition(rough, len(rough) - few)[len(rough) - few] - 1e-9 * np.abs(rough).max()]
                s = (x[near] * q[i]).sum(1) / (norm[near] * np.sqrt((q[i] * q[i]).sum()))
                best = np.lexsort((ids[near], -s))
                best = best[np.sort(np.unique(ids[near][best], return_index=True)[1])[:k]]  # an id by its nearest row
                out.append((np.full(len(best), of[i]), ids[near][best], s[best], cell[near][best]))
        return pa.Table.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], schema=schema)

    def candidates(asked: DataFrame, chunks: int, enough: int | None) -> DataFrame:
        """query_id, vec_id, score and cell of the k best of each block that a query visits; None: of all blocks."""

        def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            count, _, first, last, low, high = line.value
            for b in batches:
                if not b.num_rows:
                    continue
                v = _matrix(b.column("v"), dim)
                for i, (d1, d2) in enumerate(distances(v)):
                    cells = np.flatnonzero(count) if enough is None else np.array(cells_by_distance(d1, d2, count, enough), np.int64)
                    mask = np.zeros(len(count), bool)
                    mask[cells] = True
                    reach = np.bincount(first[cells], minlength=len(low) + 1) - np.bincount(last[cells] + 1, minlength=len(low) + 1)
                    to = np.flatnonzero(np.cumsum(reach)[:-1])
                    n = len(to)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([b.column("vec_id")[i].as_py()] * n, pa.int64()), pa.array([b.column("chunk")[i].as_py()] * n, pa.int32()), pa.array(to),
                        pa.array([v[i]] * n, pa.list_(pa.float64())), pa.array([np.packbits(mask[low[x] : high[x]]).tobytes() for x in to], pa.binary()),
                    ], names=["query_id", "chunk", "block", "q", "bits"])

        dealt = asked.withColumn("chunk", F.pmod(F.xxhash64("vec_id"), F.lit(chunks)).cast("int"))
        dealt = dealt.mapInArrow(visits, "query_id long, chunk int, block long, q array<double>, bits binary")
        every = F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))) if chunks > 1 else F.lit(0)
        return blocks.withColumn("chunk", every).groupBy("block", "chunk").cogroup(dealt.groupBy("block", "chunk")).applyInArrow(rerank, "query_id long, vec_id long, score double, cell long")

    def ranked(found: DataFrame) -> DataFrame:
        place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))  # k rows for each block that the query visits
        best = found.groupBy("query_id", "vec_id").agg(F.max(F.struct("score", "cell")).alias("b")).select("query_id", "vec_id", "b.*")
        return best.withColumn("rank", place).where(F.col("rank") <= k)

    asked = cut(rows.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v")).repartition(F.col("vec_id")))
    enough = visit
    if enough is None:
        some = cut(asked.orderBy(F.xxhash64("vec_id"), "vec_id").limit(MEASURED))
        true = ranked(candidates(some, 1, None)).groupBy("query_id").agg(F.collect_list("cell").alias("cells"))
        true = {r["query_id"]: r["cells"] for r in true.collect()}  # of MEASURED queries

        def orders() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for r in some.collect():  # MEASURED rows
                cells = cells_in_order(*next(distances(scaled(np.array([r["v"]])))), count)
                where = np.zeros(len(count), np.int64)
                where[cells] = np.arange(len(cells))
                yield cells, where[np.array(true.get(r["vec_id"], []), np.int64)]

        enough = widened(orders(), count, VISIT_LEAST, RECALL)
    found = candidates(asked, max(1, -(-asked.count() * narrow // CHUNK)), enough)
    return ranked(found).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def neighbours_report(vectors: DataFrame) -> DataFrame:
    """The five nearest of every row whose vec_id is divisible by 50."""
    return search(vectors, F.col("vec_id") % 50 == 0)
