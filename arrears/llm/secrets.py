"""Secret scan with corpus-wide ownership frequency.

Three fixed kinds of span are always reported (``assign``, ``access``, ``hex``).
A fourth, ``opaque``, is decided by the corpus: long tokens that mix lower case,
upper case and digits are candidates; the values are hashed and counted by the
distinct repositories and owners that hold them.  A value that many owners hold
is a copied example, one that stays with few owners looks like a live credential
and its spans are added.  The same counts grade the fixed kinds
(``n_live``: values of any kind held by few owners).  With a bound on the
repositories of an owner, a value that spreads within one owner is an example too.

All work is DataFrame expressions: positions come from the lengths of the gaps
and matches that ``split`` and ``regexp_extract_all`` return.

Cases: a null text counts as empty; an empty or null text has no spans and the
hash of the empty string; rows that repeat (same id, same text) get the same
row each; a null repository or owner counts as one of its own; empty tables give
empty results; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The patterns of the three base kinds, in the order listed.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
ASSIGN_VALUE = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
OPAQUE = r"[A-Za-z0-9+/_-]{20,}"
KINDS = ("assign", "access", "hex", "opaque")
#: A value held by more owners than this is a copied example.
MAX_OWNERS = 2


def _found(text: Column, pattern: str, kind: int, keep) -> Column:
    """Array of (start, end, kind, value) of the leftmost non-overlapping matches that ``keep`` accepts."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    pairs = F.arrays_zip(F.slice(gaps, 1, F.size(whole)).alias("g"), whole.alias("m"))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<s:int,e:int,k:int,v:string>>").alias("out"))

    def step(acc, x):
        s = acc["at"] + x["g"]
        e = s + F.length(x["m"])
        one = F.array(F.struct(s.alias("s"), e.alias("e"), F.lit(kind).alias("k"), x["m"].alias("v")))
        return F.struct(e.alias("at"), F.when(keep(x["m"]), F.concat(acc["out"], one)).otherwise(acc["out"]).alias("out"))

    found = F.aggregate(pairs, zero, step, lambda acc: acc["out"])
    empty = F.array().cast("array<struct<s:int,e:int,k:int,v:string>>")
    return F.when(text.rlike(pattern), found).otherwise(empty)


def _value(x: Column) -> Column:
    """The credential itself: what follows the separator of an assignment."""
    return F.when(x["k"] == 0, F.regexp_extract(x["v"], ASSIGN_VALUE, 1)).otherwise(x["v"])


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    one = lambda x: F.concat(F.element_at(names, x["k"] + 1), F.lit(":"), x["s"].cast("string"), F.lit(":"), x["e"].cast("string"))
    return F.array_join(F.transform(F.array_sort(spans), one), ",")


def scan(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", repository: str = "repository", owner: str = "owner") -> DataFrame:
    """One row per document: doc_id, repository, owner, ``base`` spans and ``opaque`` candidates (arrays of s, e, k, v)."""
    t = F.coalesce(F.col(text), F.lit(""))
    base = F.concat(
        _found(t, ASSIGN, 0, lambda m: F.length(F.regexp_extract(m, ASSIGN_VALUE, 1)) >= 6),
        _found(t, ACCESS, 1, lambda m: F.lit(True)),
        _found(t, HEX, 2, lambda m: F.lit(True)),
    )
    varied = lambda m: m.rlike("[0-9]") & m.rlike("[a-z]") & m.rlike("[A-Z]")
    out = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(repository).alias("repository"), F.col(owner).alias("owner"),
        F.sha2(t, 256).alias("text_key"), base.alias("base"), _found(t, OPAQUE, 3, varied).alias("opaque"),
    )
    clear = F.filter("opaque", lambda x: ~F.exists("base", lambda y: (x["s"] < y["e"]) & (y["s"] < x["e"])))
    return out.withColumn("opaque", clear)


def ownership(found: DataFrame) -> DataFrame:
    """(value_key, n_repositories, n_owners) of every candidate value of a scan.

    The distinct (value, repository, owner) rows are formed before the shuffle,
    so a value copied into a third of the corpus costs a row per task and owner.
    """
    x = F.explode(F.concat("base", "opaque"))
    rows = found.where(F.size("base") + F.size("opaque") > 0).select("repository", "owner", x.alias("x"))
    rows = rows.select(F.sha2(_value(F.col("x")), 256).alias("value_key"), "repository", "owner").distinct()
    some = lambda c: F.struct(F.col(c))  # noqa: E731  a null counts too
    return rows.groupBy("value_key").agg(F.countDistinct(some("repository")).alias("n_repositories"), F.countDistinct(some("owner")).alias("n_owners"))


def find_secrets(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", repository: str = "repository", owner: str = "owner", max_owners: int = MAX_OWNERS, max_repositories: int | None = None) -> DataFrame:
    """One row per document: doc_id, counts and spans of the base kinds, all spans, and the number of live-looking spans.

    A value that more than ``max_repositories`` repositories for each of its owners hold is a copied example too.
    """
    found = scan(docs, text, doc_id, repository, owner)
    some = found.where(F.size("base") + F.size("opaque") > 0)
    rare = ownership(found).where(F.col("n_owners") <= max_owners)
    if max_repositories is not None:
        rare = rare.where(F.col("n_repositories") <= max_repositories * F.col("n_owners"))
    each = some.select("doc_id", "text_key", F.explode(F.concat("base", "opaque")).alias("x")).distinct()
    each = each.withColumn("value_key", F.sha2(_value(F.col("x")), 256))
    live = each.join(rare.select("value_key"), "value_key").groupBy(F.col("doc_id").alias("d"), F.col("text_key").alias("t"))
    live = live.agg(F.count("*").alias("n_live"), F.collect_list(F.when(F.col("x.k") == 3, F.col("x"))).alias("added"))  # bounded by the document
    out = found.drop("opaque").join(live, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("t")), "left")
    n = lambda k: F.size(F.filter("base", lambda x: x["k"] == k)).cast("long")
    none = F.array().cast("array<struct<s:int,e:int,k:int,v:string>>")
    every = F.concat("base", F.coalesce("added", none))
    in_order = lambda c: F.transform(c, lambda x: F.struct(x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e")))
    return out.select(
        "doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
        F.sha2(_listed(in_order(F.col("base"))), 256).alias("base_sha256"), _listed(in_order(every)).alias("spans"),
        F.coalesce("n_live", F.lit(0)).cast("long").alias("n_live"),
    )


def document_secrets(docs: DataFrame) -> DataFrame:
    """``find_secrets`` on the documents table: the source owns, and each language of a source is a repository of its own.

    The query's SQL decides by owners alone, so repositories have no bound here.
    """
    named = docs.select("doc_id", "text", F.concat_ws("/", F.coalesce("source", F.lit("")), F.coalesce("lang", F.lit(""))).alias("repository"), F.col("source").alias("owner"))
    return find_secrets(named)
