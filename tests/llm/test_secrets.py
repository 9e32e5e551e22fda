import random
import string

import brute
from helpers import SF, documents, rows_of

from arrears.llm import secrets
from arrears.llm.common import table


def _find(spark, rows, clash=False):
    """(doc_id, text, owner) rows through the operator."""
    from pyspark.sql import functions as F

    df = documents(spark, rows, clash)
    return rows_of(secrets.find_secrets(df.withColumnsRenamed({"source": "owner"}).withColumn("repository", F.lit("r"))))


def test_against_brute_force(spark):
    docs = table(spark, SF, "documents")
    assert rows_of(secrets.document_secrets(docs)) == sorted(brute.secrets([(r.doc_id, r.text, r.source) for r in docs.collect()]), key=str)


def test_patterns_and_positions(spark):
    texts = [
        "password: token: abcdefgh", "PassWord='hunter22' api-key=zzzzzzzz API_KEY = \"abc.def/ghi=\"", "token=short secret==longer1", "äöü😀 secret: ünï secret: abcdef",
        "AKIA" + "A" * 15, "AKIA" + "A" * 16, "xAKIAAKIA" + "B" * 16, "f" * 23 + " " + "f" * 24 + "G" + "0123456789abcdef" * 2, "tokentoken:abcdef", "",
        None, "password:" + "x" * 5000, "a" * 100 + "AKIA" + "Z" * 40 + "=" * 9, "secret\n:\nabcdef", "token  :  abcdef", "token\t:abcdef", "token:'\"abcdef",
    ]
    rows = [(i, t, f"o{i}") for i, t in enumerate(texts)]
    assert _find(spark, rows, clash=True) == sorted(brute.secrets(rows), key=str)


def test_random_texts(spark):
    rng = random.Random(4)
    parts = ["password", "TOKEN", "secret", "api_key", "apikey", ":", "=", " ", "  ", "'", '"', "AKIA", "ABCDEF0123", "deadbeef", "0123456789abcdef", "x.y/z+", "é", "\n"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 30))), f"o{i % 5}") for i in range(400)]
    assert _find(spark, rows) == sorted(brute.secrets(rows), key=str)


def test_copied_values_are_examples(spark):
    live, copied = "Zk81" + "Qw9eRt" * 4, "Ex4mple" * 4
    rows = [(i, f"see {copied} here", f"o{i}") for i in range(5)] + [(9, f"mine {live} too", "o9"), (10, f"again {live}", "o9")]
    got = {r[0]: r for r in _find(spark, rows)}
    assert all(got[i][5] == "" and got[i][6] == 0 for i in range(5))
    assert got[9][5] == f"opaque:5:{5 + len(live)}" and got[10][6] == 1
    assert all(r[1:4] == (0, 0, 0) and r[4] == brute.sha("") for r in got.values())


def test_a_value_in_many_repositories_of_one_owner(spark):
    live, spread = "Zk81" + "Qw9eRt" * 4, "Ex4mple" * 4
    rows = [(i, spread, f"r{i % 6}", "o") for i in range(12)] + [(20, live, "r1", "o"), (21, live, "r2", "o"), (22, live, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, repository string, owner string")
    counts = {tuple(r)[1:] for r in secrets.ownership(secrets.scan(docs)).collect()}
    assert counts == {(6, 1), (3, 2)}
    got = {r["doc_id"]: (r["spans"] != "", r["n_live"]) for r in secrets.find_secrets(docs, max_repositories=2).collect()}
    assert got == {i: (i >= 20, int(i >= 20)) for i, *_ in rows}
    assert all(r["n_live"] == 1 for r in secrets.find_secrets(docs).collect())


def test_repeated_rows_and_nulls(spark):
    t = "x " + "".join(random.Random(1).choices(string.ascii_letters + string.digits, k=30)) + "1aA"
    rows = [(1, t, "a"), (1, t, "a"), (1, "other", "a"), (None, t, None), (2, None, "b")]
    got = _find(spark, rows)
    assert len(got) == 5 and got == sorted(brute.secrets(rows), key=str)
    assert _find(spark, []) == []


def test_only_native_operators(spark):
    plan = secrets.document_secrets(table(spark, SF, "documents"))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
