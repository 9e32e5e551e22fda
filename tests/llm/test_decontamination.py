import random

import numpy as np
from helpers import SF, documents

from arrears.llm import decontamination as D
from arrears.llm.common import table

RNG = random.Random(8)
V = [f"word{i}" for i in range(4000)]


def _item(n):
    return [RNG.choice(V) for _ in range(n)]


def _items(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")


def _plain(item, text):
    """Best local alignment, cell by cell."""
    h = [[0] * (len(text) + 1) for _ in range(len(item) + 1)]
    best = 0
    for i in range(1, len(item) + 1):
        for j in range(1, len(text) + 1):
            same = D.MATCH if item[i - 1] == text[j - 1] else D.MISMATCH
            h[i][j] = max(0, h[i - 1][j - 1] + same, h[i - 1][j] + D.GAP, h[i][j - 1] + D.GAP)
            best = max(best, h[i][j])
    return best


def test_alignment_against_cell_by_cell():
    rng = np.random.default_rng(2)
    for _ in range(150):
        item = rng.integers(1, 6, rng.integers(1, 12)).astype(np.uint64)
        texts = rng.integers(1, 6, (3, rng.integers(1, 20))).astype(np.uint64)
        best, end = D.align(item, texts)
        for k in range(3):
            assert best[k] == _plain(item.tolist(), texts[k].tolist())


def test_edited_copies_are_found_and_clean_texts_left(spark):
    items = [_item(RNG.choice([15, 30, 50])) for _ in range(40)]
    rows, leaks = [], set()
    for i in range(300):
        w = _item(RNG.choice([20, 200, 600]))
        if i % 3 == 0:
            k = i // 3 % 40
            copy = list(items[k])
            for _ in range(len(copy) // 8):  # an edit for every eight words
                p, r = RNG.randrange(len(copy)), RNG.random()
                if r < 0.5:
                    copy[p] = RNG.choice(V)
                elif r < 0.75:
                    copy.insert(p, RNG.choice(V))
                else:
                    del copy[p]
            at = RNG.randrange(len(w))
            w[at:at] = [x.upper() + "," if RNG.random() < 0.2 else x for x in copy]
            leaks.add((i, k))
        elif i % 3 == 1:  # a few words of an item are no leak
            w[3:3] = items[i % 40][:5]
        rows.append((i, " ".join(w)))
    got = D.contamination_report(documents(spark, rows, clash=True), _items(spark, [" ".join(x) for x in items])).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == leaks
    for r in got:
        assert r["score"] >= D.MIN_SCORE and 0 <= r["word_start"] < r["word_end"]


def test_span_of_a_verbatim_copy(spark):
    item = _item(20)
    got = D.contamination_report(documents(spark, [(1, " ".join(_item(50) + item + _item(50)))]), _items(spark, [" ".join(item)])).collect()
    assert [tuple(r) for r in got] == [(1, 0, 1.0, 50, 70)]


def test_a_passage_that_most_texts_hold(spark):
    item = _item(30)
    rows = [(i, " ".join(_item(30) + item + _item(30))) for i in range(400)] + [(999, " ".join(_item(90)))]
    got = D.contamination_report(documents(spark, rows), _items(spark, [" ".join(item)]))
    assert sorted(r["doc_id"] for r in got.collect()) == list(range(400))


def test_blocks_of_items(spark):
    items = [" ".join(_item(20)) for _ in range(12)]
    docs = documents(spark, [(i, " ".join(_item(20)) + " " + t) for i, t in enumerate(items)])
    one = D.contaminated(docs, _items(spark, items))
    many = D.contaminated(docs, _items(spark, items), block_bytes=300)
    key = lambda df: sorted((r["doc_id"], r["item_id"], r["score"]) for r in df.collect())
    assert key(one) == key(many) == [(i, i, 1.0) for i in range(12)]


def test_blocks_of_items_that_share_stock_phrases(spark):
    """What counts as rare does not depend on the block that an item is read in: edited copies whose last whole n-grams are stock phrases."""
    stock = [_item(6) for _ in range(4)]
    items = [_item(3) + stock[i % 4] + _item(3) + stock[(i + 1) % 4] + _item(2) for i in range(24)]
    rows = [(1000 + k, " ".join(_item(40) + stock[k % 4] + _item(40))) for k in range(80)]
    for i, x in enumerate(items):
        copy = [w if 3 <= p < 9 or 12 <= p < 18 else (RNG.choice(V) if p % 3 == 1 else w) for p, w in enumerate(x)]
        rows.append((i, " ".join(_item(30) + copy + _item(30))))
    docs = documents(spark, rows)
    texts = [" ".join(x) for x in items]
    key = lambda df: sorted((r["doc_id"], r["item_id"], r["score"]) for r in df.collect())
    one = key(D.contaminated(docs, _items(spark, texts)))
    assert {(i, i) for i in range(24)} <= {x[:2] for x in one}
    assert key(D.contaminated(docs, _items(spark, texts), block_bytes=300)) == one


def test_rarity_counts_occurrences(spark, monkeypatch):
    """An occurrence counts once, though several items hold the n-gram, and alike in every block."""
    seen = {}

    def rare(items, times, *a):
        for g, n in zip(items.distinct.tolist(), times.tolist(), strict=True):
            seen.setdefault(g, set()).add(n)
        return plain(items, times, *a)

    plain = D.rare_seeds
    monkeypatch.setattr(D, "rare_seeds", rare)
    stock = _item(4)
    items = [" ".join(_item(8) + stock + _item(8)) for _ in range(9)]
    docs = documents(spark, [(i, " ".join(_item(9) + stock + _item(9) + stock)) for i in range(5)])
    for block in (D.BLOCK_BYTES, 300):
        D.contaminated(docs, _items(spark, items), block_bytes=block)
    assert sorted(seen.values(), key=max)[-1] == {10} and all(len(x) == 1 for x in seen.values())


def test_nulls_short_items_and_repeats(spark):
    rows = [(1, None), (2, ""), (3, "one two three"), (4, "some two words"), (5, "x two three y"), (5, "x two three y"), (None, "two three")]
    docs = documents(spark, rows)
    got = D.contamination_report(docs, _items(spark, ["two three", None, "", "two three"])).collect()
    assert sorted((str(r["doc_id"]), r["item_id"]) for r in got) == sorted(
        [(d, i) for d in ("3", "5", "5", "None") for i in (0, 3)])
    assert D.contamination_report(docs, _items(spark, [])).collect() == []
    assert D.contamination_report(documents(spark, []), _items(spark, ["two three"])).collect() == []


def test_dropping(spark):
    item = _item(20)
    docs = documents(spark, [(1, " ".join(item)), (2, "clean " + " ".join(_item(9))), (2, " ".join(item)), (3, None)], clash=True)
    kept = D.drop_contaminated(docs, _items(spark, [" ".join(item)]))
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [2, 3]


def test_driver_table(spark):
    """Every document that holds an item's words in a row is found."""
    import re

    norm = lambda t: " " + " ".join(re.findall(r"[^\W_]+", t or "", re.UNICODE)).lower() + " "
    docs = [(r.doc_id, norm(r.text)) for r in table(spark, SF, "documents").collect()]
    items = [(r.item_id, norm(r.text)) for r in table(spark, SF, "benchmark").collect()]
    plain = {(d, i) for d, t in docs for i, x in items if x in t}
    got = {(r["doc_id"], r["item_id"]) for r in D.contamination_report(table(spark, SF, "documents"), table(spark, SF, "benchmark")).collect()}
    assert plain <= got and plain
