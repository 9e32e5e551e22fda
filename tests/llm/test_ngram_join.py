import random

import brute
import pytest
from helpers import SF, documents, rows_of

from arrears.llm import ngram_join as J
from arrears.llm.common import components, table


def _groups(spark, rows, jac=J.Jaccard(), clash=False):
    return rows_of(J.groups_report(documents(spark, rows, clash), jac))


def _expected(rows, jac=J.Jaccard()):
    b = brute.jaccard_groups(rows, jac.n, jac.num, jac.den)
    return sorted(((rows[i][0], *v) for i, v in b.items()), key=str)


def _edited(seed, n=350):
    """Texts of all sizes with a few words changed, so that sizes on both sides of the boundary link."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    base = [[rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 4, 5, 8, 10, 14, 18, 24, 30, 40, 60, 200]))] for _ in range(45)]
    rows = []
    for i in range(n):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
            if w:
                k, r = rng.randrange(len(w)), rng.random()
                if r < 0.4:
                    w[k] = rng.choice(vocabulary)
                elif r < 0.7:
                    del w[k]
                else:
                    w.insert(k, rng.choice(vocabulary))
        rows.append((i, " ".join(w).upper() if rng.random() < 0.1 else "  ".join(w)))
    return rows


@pytest.mark.parametrize("jac", [J.Jaccard(), J.Jaccard(5, 80, 100), J.Jaccard(2, 60, 100)])
def test_against_brute_force(spark, jac):
    rows = _edited(1) + [(900, None), (901, ""), (902, "  \n"), (903, "a b c d e f g"), (903, "a b c d e f g"), (None, "a b c d e f g"),
                         (None, "only here alone by itself now"), (7, "A B C D E F G"), (904, "É b c d"), (905, "é b c d")]
    assert _groups(spark, rows, jac, clash=True) == _expected(rows, jac)


@pytest.mark.parametrize("small", [0, 12, 28])
def test_any_boundary_gives_the_same_links(spark, monkeypatch, small):
    monkeypatch.setattr(J, "boundary", lambda sets, freq, jac: small)
    rows = _edited(2, 250)
    assert _groups(spark, rows) == _expected(rows)


def test_driver_table(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    assert rows_of(J.groups_report(table(spark, SF, "documents"))) == _expected(rows)


def test_large_group_of_near_copies(spark):
    """A common passage in every text, a third of the rows near copies of one."""
    rng = random.Random(3)
    common = [f"c{i}" for i in range(60)]
    base = [f"b{i}" for i in range(200)]
    rows = []
    for i in range(450):
        if i % 3 == 0:
            w = list(base)
            for _ in range(3):
                w[rng.randrange(200)] = f"x{rng.randrange(10 ** 9)}"
        else:
            w = [f"u{i}_{k}" for k in range(rng.choice([5, 50, 150]))]
        rows.append((i, " ".join(common + w)))
    assert _groups(spark, rows) == _expected(rows)


def test_empty_table(spark):
    assert _groups(spark, []) == []
    assert _groups(spark, [(1, None), (2, "")]) == [(1, 0, 1), (2, 0, 2)]


def test_one_of_each_group_stays(spark):
    rows = _edited(5, 200) + [(500, None), (501, ""), (5, _edited(5, 6)[5][1])]
    docs = documents(spark, rows, clash=True)
    kept = J.keep_first(docs, J.Jaccard(5, 80, 100))
    assert kept.columns == docs.columns and {r["_key"] for r in kept.collect()} == {1}
    groups = brute.jaccard_groups(rows, 5, 80, 100)
    want = sorted({c for n, c in groups.values() if n} | {rows[i][0] for i, (n, _) in groups.items() if not n})
    assert sorted(r["doc_id"] for r in kept.collect()) == want


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 102), (200, 200), (300, 299), (102, 100)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100, 102: 100, 299: 299, 300: 299}


def test_boundary_by_cost():
    """Sizes whose subsets are few are enumerated, sizes with many are not worth it."""
    jac = J.Jaccard()
    assert [jac.overlap(7, 7), jac.overlap(6, 7), jac.least(20), jac.most(17)] == [7, 6, 17, 20]
    assert J.subset_cost(5, jac) == 1 and J.subset_cost(13, jac) < J.subset_cost(14, jac) < J.subset_cost(28, jac)
