import random

import brute
import numpy as np
import pyarrow as pa
import pytest
from helpers import SF, documents, rows_of

from arrears.llm import minhash as M
from arrears.llm.common import table
from arrears.llm.ngram_join import Jaccard


def _groups(spark, rows, jac=M.NEAR, clash=False):
    return rows_of(M.groups_report(documents(spark, rows, clash), jac))


def _expected(rows, jac=M.NEAR):
    b = brute.jaccard_groups(rows, jac.n, jac.num, jac.den)
    return sorted(((rows[i][0], n, c, rows[i][0] == c) for i, (n, c) in b.items()), key=str)


def _edited(seed, n=300):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    base = [[rng.choice(vocabulary) for _ in range(rng.choice([1, 4, 8, 20, 40, 100, 250]))] for _ in range(40)]
    rows = []
    for i in range(n):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 4])):
            k = rng.randrange(len(w))
            w[k : k + rng.choice([0, 1])] = [rng.choice(vocabulary)]
        rows.append((i, " ".join(w).upper() if rng.random() < 0.1 else "  ".join(w)))
    return rows


def test_against_brute_force(spark):
    rows = _edited(1) + [(900, None), (901, ""), (902, " \n"), (903, "a b c d e f g"), (903, "a b c d e f g"), (None, "a b c d e f g"),
                         (None, "only here alone by itself now"), (7, "A B C D E F G"), (904, "É b c d"), (905, "é b c d")]
    assert _groups(spark, rows, clash=True) == _expected(rows)


def test_driver_table(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    assert rows_of(M.groups_report(table(spark, SF, "documents"))) == _expected(rows)


def _passage_and_copies(n=420):
    """A passage in two thirds of the texts, which are otherwise unlike, and a third near copies of one text, in chains."""
    rng = random.Random(3)
    common = [f"c{i}" for i in range(120)]
    rows, w = [], [f"b{i}" for i in range(200)]
    for i in range(n):
        if i % 3 == 0:
            for _ in range(2):
                w[rng.randrange(200)] = f"x{rng.randrange(10**9)}"
            rows.append((i, " ".join(common + w)))
        else:
            rows.append((i, " ".join(common + [f"u{i}_{k}" for k in range(rng.choice([5, 40, 120]))])))
    return rows


@pytest.mark.parametrize("work, side", [(1 << 22, 1 << 12), (50, 1 << 12), (50, 16)])
def test_hot_buckets(spark, monkeypatch, work, side):
    """Buckets dealt anew, and in chunks, give the same components."""
    monkeypatch.setattr(M, "WORK", work)
    monkeypatch.setattr(M, "SIDE", side)
    rows = _passage_and_copies()
    assert _groups(spark, rows) == _expected(rows)


def test_empty_table(spark):
    assert _groups(spark, []) == []
    assert _groups(spark, [(1, None), (2, "")]) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_one_of_each_group_stays(spark):
    rows = _edited(5, 150) + [(500, None), (501, ""), (5, _edited(5, 6)[5][1])]
    docs = documents(spark, rows, clash=True)
    jac = Jaccard(5, 80, 100)
    kept = M.keep_first(docs, jac)
    assert kept.columns == docs.columns and {r["_key"] for r in kept.collect()} == {1}
    groups = brute.jaccard_groups(rows, 5, 80, 100)
    want = sorted({c for n, c in groups.values() if n} | {rows[i][0] for i, (n, _) in groups.items() if not n})
    assert sorted(r["doc_id"] for r in kept.collect()) == want


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    h = rng.integers(0, 1 << 63, 3000).astype(np.uint64)
    a, b = h[:2000], h[500:2500]  # 1500 of 2500
    s = M.signatures(np.concatenate([a, b]), np.array([0, 2000, 4000]))
    assert abs((s[0] == s[1]).mean() - 0.6) < 0.15


def test_posterior_prunes_unlike_pairs_only():
    least = M.least_agreements(M.NEAR)
    assert (np.diff(least) >= 0).all() and least[16] > 0 and 0.55 * 128 < least[128] < 0.8 * 128
    rng = np.random.default_rng(2)
    one = rng.integers(0, 1 << 32, (4000, M.HASHES)).astype(np.uint32)
    for similarity, kept in ((0.85, 1.0), (0.3, 0.0)):
        two = np.where(rng.random(one.shape) < similarity, one, one + np.uint32(1))
        at = np.arange(len(one))
        assert abs(len(M.likely_pairs(_sketches(one), _sketches(two), at, at, least, M.NEAR)) / len(one) - kept) < 0.001


def _sketches(s, sizes=None, parity=None):
    n = len(s)
    return M.Sketches(pa.table({"signature": [x.tobytes() for x in s], "size": sizes or [100] * n, "parity": parity or [bytes(32)] * n}))


def test_parities_bound_the_difference():
    """Sets that link always pass, also with parities of two widths; sets far apart do not."""
    rng = np.random.default_rng(3)
    h = np.unique(rng.integers(0, 1 << 63, 700).astype(np.uint64))
    same = np.zeros((1, M.HASHES), np.uint32)
    for lo, size in ((0, 520), (20, 520), (29, 500), (50, 500), (57, 505), (150, 500), (100, 420)):
        a, b = h[:500], h[lo : lo + size]
        parity = [M.parities(x, np.zeros(len(x), np.int64), np.array([len(x)])) for x in (a, b)]
        o = len(np.intersect1d(a, b))
        at = np.array([0])
        got = M.likely_pairs(_sketches(same, [len(a)], parity[0]), _sketches(same, [len(b)], parity[1]), at, at, M.least_agreements(M.NEAR), M.NEAR)
        links = 100 * o >= 80 * (len(a) + len(b) - o)
        assert len(got) if links else (len(got) == 0 or o > 0.7 * len(np.union1d(a, b)))


def test_rows_of_a_bucket_over_several_batches():
    key, part = [1, 1, 1, 2, 2, 3], [0, 0, 1, 1, 1, 1]
    whole = pa.record_batch({"key": key, "part": part, "x": list(range(6))})
    for size in (1, 2, 3, 6):
        runs = [t["x"].to_pylist() for t in M._runs(whole.slice(k, size) for k in range(0, 6, size))]
        assert runs == [[0, 1], [2], [3, 4], [5]]
