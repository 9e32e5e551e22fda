import uuid

import brute
import corpus_pipeline as P
from helpers import SF, documents
from tokenizers import Tokenizer

from arrears.llm.common import table
from arrears.llm.queries import QUERIES, SQL, tokenizer_path
from arrears.session import scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_in_order(spark):
    """Each stage over what the one before kept, held against a plain version of the stage."""
    docs = table(spark, SF, "documents")
    base = scratch_path(spark, "pipeline-test", uuid.uuid4().hex)
    seen = {}
    for name, stage in P.STAGES:
        stage(spark, docs, SF).write.parquet(f"{base}/{name}")
        before, docs = docs, spark.read.parquet(f"{base}/{name}")
        seen[name] = (before.collect(), docs.collect(), docs.columns)
    assert list(seen) == ["quality_classifier", "ngram_jaccard_join", "benchmark_decontamination", "mix_sources", "token_shards"]
    assert all(c == COLUMNS for n, (_, _, c) in seen.items() if n != "token_shards")

    before, after, _ = seen["quality_classifier"]
    known = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    kept = {r.doc_id for r in after}
    good = [d for d, q in known.items() if q == 1]
    assert sum(d in kept for d in good) >= 0.95 * len(good) and len(after) < len(before)

    before, after, _ = seen["ngram_jaccard_join"]
    groups = brute.jaccard_groups([(r.doc_id, r.text) for r in before], 5, 80, 100)
    assert sorted(r.doc_id for r in after) == sorted({c for _, c in groups.values()})

    before, after, _ = seen["benchmark_decontamination"]
    bad = {r.doc_id for r in before} - {r.doc_id for r in after}
    items = [" ".join(brute.words(r.text)) for r in table(spark, SF, "benchmark").collect()]
    verbatim = {r.doc_id for r in before if any(i in " ".join(brute.words(r.text)) for i in items)}
    assert verbatim <= bad

    before, after, _ = seen["mix_sources"]
    goal = brute.targets([(r.doc_id, r.text, r.source) for r in before])
    times = {d: sum(r.doc_id == d for r in after) for d in {r.doc_id for r in before}}
    for r in before:
        size, target = goal[r.source]
        assert abs(times[r.doc_id] - (target / size if size else 0)) < 1 + 1e-9

    before, after, _ = seen["token_shards"]
    want = brute.tokens([(r.doc_id, r.text) for r in before], Tokenizer.from_file(tokenizer_path()))
    assert sorted(map(tuple, after)) == sorted(want)


def test_run_equals_the_stages_and_is_registered(spark):
    import __spark_entry__ as E

    assert E.queries()["pipeline"] is P.run and "pipeline" not in E.oracle_sql() and P.ORACLE_SQL is None
    assert set(QUERIES) <= set(E.queries()) and set(SQL) <= set(E.oracle_sql())
    a = sorted(map(tuple, P.run(spark, SF).collect()))
    assert a and a == sorted(map(tuple, P.run(spark, SF).collect()))


def test_stages_take_empty_tables_and_nulls(spark):
    for rows in ([], [(1, None, None), (None, "", "a"), (2, "one two three four five six", None), (2, "one two three four five six", None)]):
        docs = documents(spark, rows)
        for name, stage in P.STAGES:
            out = stage(spark, docs, SF)
            assert out.count() <= 3 * len(rows), name
            assert name == "token_shards" or out.columns == COLUMNS
