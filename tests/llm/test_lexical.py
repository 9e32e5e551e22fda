import random
import re

import brute
import numpy as np
import pytest
from helpers import SF, documents, rows_of

from arrears.llm import lexical as L
from arrears.llm.common import cut, table


def _items(spark, rows, clash=False):
    df = spark.createDataFrame(rows, "item_id long, text string").repartition(2)
    return df.selectExpr("*", "1 AS rank", "2 AS query", "3 AS doc_id") if clash else df


def _search(spark, docs, items, clash=False, **kw):
    return rows_of(L.search_documents(documents(spark, docs, clash), _items(spark, items, clash), **kw))


def _corpus(seed, n=300, vocabulary=400):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)]
    pick = lambda k: [words[min(int(rng.paretovariate(0.6)), vocabulary) - 1] for _ in range(k)]
    docs = [(i, " ".join(pick(rng.choice([1, 5, 30, 200, 1500])))) for i in range(n)]
    items = [(i, " ".join(pick(rng.choice([1, 4, 20, 60])))) for i in range(25)]
    return docs, items


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    docs, items = _corpus(seed)
    assert _search(spark, docs, items, clash=True) == brute.search(docs, items)


def test_driver_table(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    assert rows_of(L.search_documents(table(spark, SF, "documents"), table(spark, SF, "benchmark"))) == brute.search(docs, items)


def test_edge_cases(spark):
    docs = [(1, "Alpha beta"), (2, "alpha BETA"), (3, None), (4, ""), (5, " . - "), (None, "alpha beta"), (6, "a" * 300_000 + " alpha"), (7, "É alpha"), (8, "é-alpha 1é"), (2, "alpha BETA")]
    docs += [(10 + i, "filler text of its own " + str(i)) for i in range(30)]
    items = [(1, "alpha"), (1, "alpha"), (2, None), (3, ""), (4, "nothing has this"), (5, "beta, Alpha! beta"), (6, "É"), (None, "alpha"), (7, "...")]
    assert _search(spark, docs, items, clash=True) == brute.search(docs, [x for x in items if x[1]])


def test_ties_among_many_copies(spark):
    """More equal documents than places: the smallest ids have them, whatever their order."""
    docs = [(i, "same words here") for i in range(200)] + [(500 + i, f"u{i}") for i in range(20)]
    got = _search(spark, docs, [(1, "words"), (2, "u3 u4")])
    assert sorted(r[2] for r in got if r[0] == 1) == list(range(10)) and got == brute.search(docs, [(1, "words"), (2, "u3 u4")])


def test_blocks_of_queries(spark):
    docs, items = _corpus(3, 120)
    assert _search(spark, docs, items, block_bytes=200) == brute.search(docs, items)
    assert _search(spark, docs, items, k=3) == brute.search(docs, items, 3)


def test_empty_tables(spark):
    assert _search(spark, [], [(1, "a")]) == [] and _search(spark, [(1, "a b")], []) == [] and _search(spark, [(1, None)], [(1, "a")]) == []


def test_bounds_hold_and_pass_documents_over(spark, monkeypatch):
    """No score exceeds its bound, and most documents are never scored."""
    docs, items = _corpus(4, 400, 2000)
    index = L.build_index(documents(spark, docs)).collect()
    queries = L.query_terms([t for _, t in items])
    terms = np.unique(np.concatenate(queries))
    held = [np.frombuffer(r["terms"], np.uint64) for r in index]
    df = np.array([sum(x in set(h.tolist()) for h in held) for x in terms.tolist()])
    batch = L.Batch(list(range(len(items))), queries, terms, df, len(index), sum(r["n"] for r in index))
    m = batch.slack(np.array([r["n"] for r in index]))
    bound = batch.bounds([np.frombuffer(r["sketch"], np.uint8) for r in index], m)
    score = np.array([[batch.score(q, h, np.frombuffer(r["counts"], "<i4"), int(x)) for q in range(len(items))] for r, h, x in zip(index, held, m, strict=True)])
    assert (bound >= score).all()
    tenth = -np.sort(-score, axis=0)[9]
    assert (bound >= np.maximum(tenth, 1)).mean() < 0.5


def test_codes_stand_for_at_least_their_counts():
    n = np.concatenate([np.arange(0, 3000), [10**6, 10**7]])
    decoded = L.DECODED[L.encode(n)]
    assert (decoded >= n).all() and (decoded <= np.maximum(n * L.FACTOR + 1, n)).all() and L.encode(np.array([0]))[0] == 0


def test_index_knows_no_query(spark):
    docs, items = _corpus(5, 60)
    index = cut(L.build_index(documents(spark, docs)))
    for part in (items[:5], items[5:]):
        assert rows_of(L.search(index, _items(spark, part))) == brute.search(docs, part)
    assert all(re.fullmatch(r"(doc_id|n|sketch|terms|counts)", c) for c in index.columns)
