import random
import zlib

import brute
import numpy as np
import pytest
from helpers import SF, documents, rows_of

from arrears.llm import importance as I
from arrears.llm.common import table


def _report(spark, docs, target, spec=I.Resampling(), clash=False):
    t = spark.createDataFrame([(i, x) for i, x in enumerate(target)], "item_id long, text string")
    return rows_of(I.resampling_report(documents(spark, docs, clash), t, spec))


def _corpus(seed, n=400):
    rng = random.Random(seed)
    words = [f"W{i}" if i % 7 == 0 else f"w{i}é" for i in range(300)]
    text = lambda k: rng.choice([" ", ", ", "\n"]).join(rng.choice(words) for _ in range(k))
    docs = [(i, text(rng.choice([0, 3, 19, 20, 21, 60, 300]))) for i in range(n)]
    return docs, [text(25) for _ in range(20)]


@pytest.mark.parametrize("n", [1, 3])
def test_against_brute_force(spark, n):
    docs, target = _corpus(n)
    docs += [(900, None), (901, ""), (902, " - ."), (None, "w " * 30), (None, "w " * 40), (3, docs[3][1]), (4, "w1 " * 50), (-5, "w2 " * 25), (1 << 62, "w3 " * 25), (903, "x" * 200_000 + " y" * 30)]
    assert _report(spark, docs, target, I.Resampling(n=n), clash=True) == brute.resample(docs, target, n)


def test_driver_table(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    target = [r.text for r in table(spark, SF, "benchmark").collect()]
    assert rows_of(I.resampling_report(table(spark, SF, "documents"), table(spark, SF, "benchmark"))) == brute.resample(docs, target)


def test_empty_tables(spark):
    assert _report(spark, [], ["a b"]) == []
    docs = [(1, "a b c " * 10), (2, None)]
    assert _report(spark, docs, []) == brute.resample(docs, []) and _report(spark, docs, [None, ""]) == brute.resample(docs, [])


def test_radix_sort_over_many_blocks(spark):
    """Keys with ties and of full width, in blocks of seven rows."""
    rng = random.Random(5)
    rows = [(rng.randrange(4), rng.choice([-(1 << 63), -1, 0, 5, (1 << 63) - 1]), i) for i in range(300)]
    got = I.radix_sort(spark.createDataFrame(rows, "f0 long, f1 long, x long").repartition(5), [2, 64], len(rows), digit=11, block=(7, 7)).collect()
    key = lambda r: (r[0], r[1] % (1 << 64))
    assert sorted(r["place"] for r in got) == list(range(300)) and sorted((r["f0"], r["f1"], r["x"]) for r in got) == sorted(rows)
    assert [key((r["f0"], r["f1"])) for r in sorted(got, key=lambda r: r["place"])] == sorted(key(r) for r in rows)


def test_drawn_documents(spark):
    docs, target = _corpus(9, 300)
    docs += [(5, docs[5][1])] * 2 + [(None, "w1 " * 30)]
    frame = documents(spark, docs, clash=True)
    t = spark.createDataFrame([(i, x) for i, x in enumerate(target)], "item_id long, text string")
    got = I.draw_documents(frame, t)
    assert got.columns == frame.columns
    want = [r[0] for r in brute.resample(docs, target) if r[4]]
    assert sorted((r["doc_id"] for r in got.collect()), key=str) == sorted(want, key=str)


def test_crc_of_spans():
    data = np.frombuffer("ab é abcdefgh ".encode() * 20 + b"z" * 500, np.uint8)
    rng = np.random.default_rng(1)
    s = rng.integers(0, len(data) - 120, 200)
    e = s + rng.integers(0, 120, 200)
    assert I.crc32_spans(data, s, e).tolist() == [zlib.crc32(data[x:y].tobytes()) for x, y in zip(s, e, strict=True)]
    assert I.crc32_spans(data, s[:0], e[:0]).tolist() == []


def test_stretches_of_long_texts(monkeypatch):
    data = ("a bb ccc dddd " * 50).encode()
    raw, offs = np.frombuffer(data, np.uint8), np.array([0, 100, 100, len(data)])
    spec = I.Resampling(n=3)
    count = lambda: sorted(x for of, b in I.features(raw, offs, spec) for x in zip(of.tolist(), b.tolist(), strict=True))
    whole = count()
    monkeypatch.setattr(I, "STRETCH", 7)
    assert count() == whole
