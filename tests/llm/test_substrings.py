import random

import brute
import numpy as np
import pytest
from helpers import SF, documents, rows_of

from arrears.llm import repeats, suffix_array, suffix_tree
from arrears.llm.common import table
from arrears.llm.repeats import Windows


def _words(spark, rows, clash=False, win=suffix_tree.WINDOW):
    return rows_of(suffix_tree.windows_report(documents(spark, rows, clash), win))


def _bytes(spark, rows, clash=False, win=suffix_array.WINDOW):
    return rows_of(suffix_array.bytes_report(documents(spark, rows, clash), win))


def _texts(seed, n=121):
    """Passages shared at their ends, in the middle, twice in one text, and with edits."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdeé", k=rng.randint(1, 8)))
    passages = [[word() for _ in range(rng.choice([49, 50, 51, 80, 200]))] for _ in range(6)]
    rows = []
    for i in range(n):
        w = [word() for _ in range(rng.choice([0, 3, 60]))]
        for _ in range(rng.choice([0, 1, 1, 2, 3])):
            p = list(rng.choice(passages))
            if rng.random() < 0.5:
                p[rng.randrange(len(p))] = word()
            w += p[rng.choice([0, 0, 5]) : rng.choice([None, None, -7])] + [word() for _ in range(rng.choice([0, 0, 4]))]
        rows.append((i * 3 % n, (" " if i % 4 else "\n").join(w)))
    return rows


EDGES = [(1000, None), (1001, ""), (1002, " \n "), (1003, "one two")]


@pytest.mark.parametrize("seed", [1, 2])
def test_words_against_brute_force(spark, seed):
    rows = _texts(seed) + EDGES
    assert _words(spark, rows, clash=seed == 1) == sorted(brute.strip_words(rows), key=str)


@pytest.mark.parametrize("seed", [3, 4])
def test_bytes_against_brute_force(spark, seed):
    rows = _texts(seed) + EDGES + [(1004, "a" * 1000), (1005, "ab" * 300), (1006, "x" * 100), (1007, "x" * 99), (1008, "é" * 130)]
    assert _bytes(spark, rows, clash=seed == 3) == sorted(brute.strip_bytes(rows), key=str)


def test_driver_table(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    assert rows_of(suffix_tree.windows_report(table(spark, SF, "documents"))) == sorted(brute.strip_words(rows), key=str)
    assert rows_of(suffix_array.bytes_report(table(spark, SF, "documents"))) == sorted(brute.strip_bytes(rows), key=str)


def test_split_groups_give_the_same(spark, monkeypatch):
    """A common passage in different surroundings: its prefix group is split by longer contexts."""
    rng = random.Random(9)
    passage = [f"p{i}" for i in range(60)]
    rows = [(i, " ".join([f"u{rng.randrange(40)}" for _ in range(30)] + passage[rng.choice([0, 8]) : rng.choice([None, -9])] + [f"v{rng.randrange(3)}" for _ in range(30)])) for i in range(150)]
    for win in (suffix_tree.WINDOW, suffix_array.WINDOW):
        a = repeats.covered_ranges(repeats.keyed(documents(spark, rows)), win, suffix_tree.tree_order if win.words else suffix_array.array_order)
        assert a.count() > 0
    real = repeats.match_anchors

    def all_split(found, win):
        from pyspark.sql import functions as F

        return real(found, win).withColumn("hi", F.when(F.col("key").isNotNull(), 1).otherwise(F.col("hi")).cast("long"))

    monkeypatch.setattr(repeats, "match_anchors", all_split)
    assert _words(spark, rows) == sorted(brute.strip_words(rows), key=str)
    assert _bytes(spark, rows) == sorted(brute.strip_bytes(rows), key=str)


def test_repeated_rows_and_ids(spark):
    long = " ".join(f"w{i}" for i in range(70))
    rows = [(1, long), (1, long), (2, long), (None, long), (None, "a b")]
    assert _words(spark, rows) == sorted(brute.strip_words(rows), key=str)
    got = _bytes(spark, rows)
    n = len(long)
    assert [r[:3] for r in got] == sorted([(1, n, 0), (1, n, 0), (2, n, n), (None, n, n), (None, 3, 0)], key=str)
    assert _words(spark, []) == [] and _bytes(spark, []) == []


def test_a_very_long_text(spark):
    rng = random.Random(5)
    body = " ".join(f"t{rng.randrange(10 ** 6)}" for _ in range(60_000))
    rows = [(1, body), (2, "head " + body[1000:300_000] + " tail")]
    assert _words(spark, rows) == sorted(brute.strip_words(rows), key=str)
    assert _bytes(spark, rows) == sorted(brute.strip_bytes(rows), key=str)


def test_suffix_array_against_sorting():
    rng = random.Random(6)
    for _ in range(3000):
        s = [rng.randint(1, rng.choice([1, 2, 4])) for _ in range(rng.randint(0, 30))]
        assert suffix_array.suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])


def test_suffix_tree_nodes():
    """Every internal node is a longest common prefix of its leaves, and all that share one are below it."""
    rng = np.random.default_rng(7)
    for _ in range(60):
        right = rng.integers(0, 3, (rng.integers(1, 40), 8)).astype(np.int32)
        tree = suffix_tree.SuffixTree(right)
        assert sorted(map(tuple, right.tolist())) == [tuple(right[i].tolist()) for i in tree.order]
        rows = right[tree.order]
        for d, lo, hi in zip(tree.depth, tree.lo, tree.hi):
            assert (rows[lo:hi, :d] == rows[lo, :d]).all() and hi - lo > 1
            assert d == 8 or len({*rows[lo:hi, d].tolist()}) > 1
            assert lo == 0 or (rows[lo - 1, :d] != rows[lo, :d]).any()
            assert hi == len(rows) or (rows[hi, :d] != rows[lo, :d]).any()
        assert (tree.joined(0) == tree.lcp).all()


def test_anchors_of_equal_windows_agree():
    rng = np.random.default_rng(8)
    win = Windows(width=30, gram=8, words=False, strict=False)
    text = rng.integers(0, 3, 400).astype(np.uint64) + np.uint64(7)
    for _ in range(30):
        a = rng.integers(0, 370)
        lone = text[a : a + 30]
        pos, key = repeats.anchors(lone, np.array([0, 30]), win)
        whole, keys = repeats.anchors(text, np.array([0, 400]), win)
        inside = (whole >= a) & (whole <= a + 30 - 8)
        assert len(pos) and set(zip(pos.tolist(), key.tolist())) <= set(zip((whole[inside] - a).tolist(), keys[inside].tolist()))


def test_frequent_grams_are_dealt_out(spark, monkeypatch):
    """A passage in many surroundings: its grams are found in the sample and their anchors meet by segment."""
    monkeypatch.setattr(repeats, "FREQUENT", 5)
    rng = random.Random(11)
    passage = [f"p{i}" for i in range(70)]
    rows = [(i, " ".join([f"u{rng.randrange(9)}" for _ in range(30)] + passage[rng.choice([0, 9]) : rng.choice([None, -12])] + [f"v{rng.randrange(4)}" for _ in range(30)])) for i in range(200)]
    for win in (suffix_tree.WINDOW, suffix_array.WINDOW):
        assert len(repeats.frequent_grams(repeats.keyed(documents(spark, rows)), win)) > 0
    assert _words(spark, rows) == sorted(brute.strip_words(rows), key=str)
    assert _bytes(spark, rows) == sorted(brute.strip_bytes(rows), key=str)
