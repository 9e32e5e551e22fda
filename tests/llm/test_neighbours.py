import numpy as np
import pytest
from helpers import SF
from pyspark.sql import functions as F

from arrears.llm import neighbours as N
from arrears.llm.common import table


def _exact(rows, k=5, every=50):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float64)
    norm = np.sqrt((x * x).sum(1))
    out = {}
    for q in np.flatnonzero(ids % every == 0):
        s = (x * x[q]).sum(1) / (norm * norm[q])
        own = ids != ids[q]
        order = np.lexsort((ids[own], -s[own]))[:k]
        out[int(ids[q])] = [(int(ids[own][o]), s[own][o]) for o in order]
    return out


def _found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


def _vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)


def test_recall_on_the_driver_table(spark):
    df = table(spark, "/root/testdata/sf0.1", "embeddings")
    want = _exact([(r.vec_id, r.embedding) for r in df.collect()])
    got = _found(N.neighbours_report(df))
    assert set(got) == set(want)
    recall = np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 5 for q in want])
    assert recall >= 0.9


def test_recall_in_clusters(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 16))
    rows = [(i, (centres[i % 40] + 0.3 * rng.normal(size=16)).tolist()) for i in range(6000)]
    want, got = _exact(rows), _found(N.search(_vectors(spark, rows), F.col("vec_id") % 50 == 0, visit=1200))
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 5 for q in want]) >= 0.9
    for q in got:
        assert [s for _, s in got[q]] == sorted((s for _, s in got[q]), reverse=True)


def test_recall_without_clusters(spark):
    """Vectors like the driver's, near to isotropic, and many times VISIT_LEAST rows, with the default parameters."""
    x = np.random.default_rng(5).normal(size=(24_000, 64)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    want, got = _exact([(i, x[i]) for i in range(len(x))]), _found(N.neighbours_report(_vectors(spark, rows)))
    assert set(got) == set(want)
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 5 for q in want]) >= 0.9


def test_many_chunks_of_queries_and_small_blocks(spark, monkeypatch):
    x = np.random.default_rng(6).normal(size=(2000, 8))
    df = _vectors(spark, [(i, v.tolist()) for i, v in enumerate(x)])
    one = _found(N.neighbours_report(df))
    monkeypatch.setattr(N, "BLOCK", 37)
    monkeypatch.setattr(N, "CHUNK", 7)
    assert _found(N.neighbours_report(df)) == one


def test_ties_and_a_cell_of_copies(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 64)  # the copies fill many blocks
    rng = np.random.default_rng(2)
    rows = [(i, [1.0, 2.0, 3.0, 4.0] if i % 3 == 0 else rng.normal(size=4).tolist()) for i in range(900)]
    got = _found(N.neighbours_report(_vectors(spark, rows)))
    same = [i for i in range(900) if i % 3 == 0]
    for q in (0, 150, 300):
        assert [i for i, _ in got[q]] == [i for i in same if i != q][:5]
        assert all(s == pytest.approx(1.0, abs=1e-12) for _, s in got[q])


def test_vectors_that_take_no_part(spark):
    bad = [(50, None), (100, [0.0, 0.0]), (150, [1.0, None]), (200, [float("nan"), 1.0]), (250, [float("inf"), 1.0]), (300, []), (350, [1.0, 2.0, 3.0]), (None, [1.0, 1.0])]
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0]), (2, [1.0, 1.0]), (400, [-1.0, 0.5])] + bad
    df = _vectors(spark, rows).withColumns({"cell": F.lit(1), "label": F.lit(2), "n": F.lit(3), "score": F.lit(0.1), "v": F.lit("x")})
    got = _found(N.neighbours_report(df))
    assert set(got) == {0, 400}
    assert [i for i, _ in got[0]] == [2, 1, 400]
    assert N.neighbours_report(_vectors(spark, [])).collect() == []
    assert N.neighbours_report(_vectors(spark, bad[:5])).collect() == []
    assert N.neighbours_report(_vectors(spark, [(0, [1.0])])).collect() == []


def test_cells_come_by_distance():
    rng = np.random.default_rng(3)
    d1, d2 = rng.random(7), rng.random(9)
    held = np.ones(63, np.int64)
    cells = N.cells_by_distance(d1, d2, held, 10 ** 6)
    sums = [d1[c // 9] + d2[c % 9] for c in cells]
    assert sorted(cells) == list(range(63)) and sums == sorted(sums)
    assert N.cells_by_distance(d1, d2, held, 5) == cells[:5]


def test_the_counted_order_is_that_of_the_heap():
    rng = np.random.default_rng(4)
    d1, d2 = rng.random(7), rng.random(9)
    held = rng.integers(0, 30, 63)
    for enough in (1, 50, 300, 10**6):
        cells = N.cells_in_order(d1, d2, held)
        assert sorted(cells[N.counted_before(held[cells], enough) < enough]) == sorted(N.cells_by_distance(d1, d2, held, enough))


def test_extreme_magnitudes_and_repeated_ids(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(1, 301)]
    plain = _found(N.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0))
    wide = [(i, np.ldexp(v, [600, -600, 1000, 0][i % 4]).tolist()) for i, v in rows]
    assert _found(N.search(spark.createDataFrame(wide, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0)) == plain
    near = plain[50][0][0]
    far = [-x for x in dict(rows)[50]]
    more = rows + [(near, dict(rows)[near])] * 12 + [(near, far)] * 3 + [(50, [9.0] + [0.0] * 7)]
    got = _found(N.search(spark.createDataFrame(more, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0))
    smallest = min([9.0] + [0.0] * 7, dict(rows)[50])
    if smallest == dict(rows)[50]:
        assert got[50] == plain[50]
    for q, found in got.items():
        assert len(found) == 5 and len({i for i, _ in found}) == 5 and all(np.isfinite(s) for _, s in found), q
