import zlib

import numpy as np
from helpers import SF, documents, rows_of
from pyspark.sql import functions as F

from arrears.llm import quality as Q
from arrears.llm.common import table


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    known = {r.doc_id: r.quality for r in table(spark, d, "labels").collect()}
    got = Q.quality_scores(table(spark, d, "documents"), table(spark, d, "labels")).collect()
    held = [(r["predicted"], known[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in known]
    assert len(held) > 500
    assert np.mean([p == y for p, y in held]) >= 0.97
    assert np.mean([p for p, y in held if y == 1]) >= 0.99  # clean documents stay
    for r in got:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)


def _labelled(spark, n=120):
    rows = [(i, "plain words of a text " * 3 if i % 3 else "BUY!! NOW!! $$$ " * 3) for i in range(n)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(n)], "doc_id long, quality int")
    return rows, labels


def test_only_the_text_counts(spark):
    rows, labels = _labelled(spark)
    a = documents(spark, rows, clash=True)
    b = a.withColumns({"lang": F.lit("xx"), "source": F.lit(None).cast("string"), "n_chars": F.lit(0).cast("long")})
    assert rows_of(Q.quality_scores(a, labels)) == rows_of(Q.quality_scores(b, labels))


def test_held_out_labels_are_not_learned_from(spark):
    rows, labels = _labelled(spark)
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    docs = documents(spark, rows)
    assert rows_of(Q.quality_scores(docs, labels)) == rows_of(Q.quality_scores(docs, flipped))


def test_the_sample_is_bounded_and_deterministic(spark):
    rows, labels = _labelled(spark)
    docs = documents(spark, rows)
    some = Q.training_rows(docs, labels, max_train=20)
    ids = sorted(r["doc_id"] for r in some.collect())
    assert len(ids) == 20 and ids == sorted(r["doc_id"] for r in Q.training_rows(docs.repartition(5), labels, max_train=20).collect())


def test_nulls_empties_repeats_and_odd_labels(spark):
    rows, labels = _labelled(spark)
    odd = spark.createDataFrame([(1, 0), (None, 1), (2, None), (9999, 1)], "doc_id long, quality int")  # 1 contradicts itself
    docs = documents(spark, rows + [(500, None), (501, ""), (502, "x"), (502, "x"), (None, "text"), (503, "w " * 200_000)])
    got = Q.quality_scores(docs, labels.union(odd)).collect()
    assert len(got) == len(rows) + 6
    empty = {r["doc_id"]: r["score"] for r in got if r["doc_id"] in (500, 501)}
    assert empty[500] == empty[501]
    assert len({r["score"] for r in got if r["doc_id"] == 502}) == 1
    assert not next(r for r in got if r["doc_id"] is None)["held_out"]
    assert Q.quality_scores(documents(spark, []), labels).collect() == []
    one = Q.quality_scores(docs, labels.where("quality = 1")).collect()
    assert {r["score"] for r in one} == {0.5}


def test_keeping(spark):
    rows, labels = _labelled(spark)
    docs = documents(spark, rows, clash=True).withColumns({"_quality_score": F.lit("x"), "__quality_score": F.lit(1)})
    kept = Q.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, _ in rows if i % 3}


def test_dual_descent_separates_and_obeys_its_bounds():
    rng = np.random.default_rng(1)
    y = rng.random(300) < 0.5
    rows = [np.unique(np.concatenate([rng.integers(2, 50, 8), [int(v)]])) for v in y]
    ratio = Q.log_count_ratio(rows, y, 50)
    assert ratio[1] > 2 and ratio[0] < -2
    w, b = Q.dual_descent(rows, ratio, y)
    margin = np.array([w[x] @ ratio[x] / np.sqrt(len(x)) + b for x in rows])
    assert ((margin > 0) == y).mean() > 0.98


def test_indicators_are_distinct_and_per_text():
    texts = [b"aa aa aa", b"", b"aa aa aa", "é x".encode()]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offs = np.cumsum([0] + [len(t) for t in texts])
    f, at = Q.indicators(data, offs)
    parts = [f[at[i] : at[i + 1]] for i in range(4)]
    assert parts[0].tolist() == parts[2].tolist() == sorted(set(parts[0].tolist())) and len(parts[1]) == 0
    alone, _ = Q.indicators(np.frombuffer(texts[3], np.uint8), np.array([0, len(texts[3])]))
    assert parts[3].tolist() == alone.tolist()


def test_driver_query(spark):
    got = Q.quality_scores(table(spark, SF, "documents"), table(spark, SF, "labels"))
    assert got.columns == ["doc_id", "held_out", "score", "predicted"] and got.count() == table(spark, SF, "documents").count()
