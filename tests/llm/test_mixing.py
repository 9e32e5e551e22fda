from collections import Counter

import brute
import pytest
from helpers import SF, documents
from pyspark.sql import functions as F

from arrears.llm import mixing
from arrears.llm.common import table


def _check(rows, got):
    goal = brute.targets(rows)
    assert len(got) == len(rows)
    words = Counter((d, len(brute.words(t))) for d, t, _ in rows)
    assert words == Counter((r["doc_id"], r["size"]) for r in got)
    for r in got:
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 3
    return goal


def test_against_brute_force(spark):
    docs = table(spark, SF, "documents")
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    got = mixing.mix_report(docs).collect()
    goal = _check(rows, got)
    of = {d: s for d, _, s in rows}
    for r in got:
        size, target = goal[of[r["doc_id"]]]
        assert r["source_size"] == size and r["target"] == pytest.approx(target)
        assert r["copies"] in (int(target / size), int(target / size) + 1, round(target / size))


def test_taken_words_come_near_the_targets(spark):
    rows = [(i, "w " * (1 + i * i % 97), f"s{i % 4}") for i in range(4000)]
    got = mixing.mix_report(documents(spark, rows)).collect()
    taken, of = Counter(), {d: s for d, _, s in rows}
    for r in got:
        taken[of[r["doc_id"]]] += r["taken"]
    for s, (_, target) in brute.targets(rows).items():
        assert abs(taken[s] - target) <= 0.01 * target


def test_caps_and_null_source(spark):
    rows = [(1, "a b c", "x"), (2, "d", "y"), (3, None, "z"), (4, "", None), (5, "e f", None), (6, "g " * 40, "w"), (6, "g " * 40, "w")]
    got = {(r["doc_id"], r["size"]): r for r in mixing.mix_report(documents(spark, rows, clash=True)).collect()}
    goal = _check(rows, list(mixing.mix_report(documents(spark, rows)).collect()))
    assert goal["z"] == (0, 0.0) and got[(3, 0)]["copies"] == 0
    assert got[(2, 1)]["target"] == 3.0 and got[(2, 1)]["copies"] == 3  # stopped at three times its size
    assert got[(5, 2)]["source_size"] == 2 and got[(5, 2)]["target"] == goal[None][1]


def test_reruns_and_dealing_do_not_matter(spark):
    docs = table(spark, SF, "documents")
    a = sorted(map(tuple, mixing.mix_report(docs).collect()))
    assert a == sorted(map(tuple, mixing.mix_report(docs.repartition(7, F.rand(3))).collect()))


def test_empty_table(spark):
    empty = documents(spark, [])
    assert mixing.mix_report(empty).collect() == [] and mixing.mix_documents(empty).collect() == []
    assert mixing.mix_report(documents(spark, [(1, None), (2, "")])).agg(F.sum("copies")).first()[0] == 0


def test_mixed_corpus_is_what_was_drawn(spark):
    rows = [(i, "w " * (i % 9), f"s{i % 3}") for i in range(300)] + [(5, "w " * 5, "s2")] * 2 + [(None, "x y", None)]
    docs = documents(spark, rows, clash=True)
    drawn = Counter()
    for r in mixing.mix_report(docs).collect():
        drawn[(r["doc_id"], r["size"])] += r["copies"]
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns and {r["_k"] for r in mixed.collect()} == {6}
    assert Counter((r["doc_id"], len(brute.words(r["text"]))) for r in mixed.collect()) == +drawn


def test_only_native_operators(spark):
    plan = mixing.mix_documents(table(spark, SF, "documents"))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
