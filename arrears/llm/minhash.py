"""MinHash near-duplicates: banded candidates and sequential Bayesian verification.

A document's set of word shingles gets a signature of ``HASHES`` minima.  Sets
that agree on a band of ``ROWS`` of them share a bucket.  Candidates of a bucket
are compared signature batch by signature batch: the agreements seen so far give
a posterior of their similarity, and a pair whose chance to reach the threshold
is below ``MISS`` goes.  What is left is verified exactly: first by parities of
hashed shingles, which differ in no more bits than the sets differ in shingles,
then on the full sets.

Links are wanted as components, so no bucket is expanded into all its pairs.
Equal sets are one node.  Each bucket first links its members to its smallest
and its largest node, and in some bands to one at random.  After that only members outside the bucket's largest
component are compared with the others, inside Arrow batches, and only survivors
of the signature test become rows.  Where even that is too much work for a
bucket (many unlike texts with a passage in common), its members are dealt
anew by a further band beside the shared one: linked sets share many bands,
unlike ones few.  What is still too much after ``DEPTH`` such steps is dealt in
chunks that meet two by two, so every pair meets in the end.

Miss probability: at the threshold 0.8 a linked pair shares no band with
probability (1 - 0.8^4)^32 = 5e-8, is pruned with at most about ``MISS``, and, where
all its buckets are dealt anew, shares no two bands within ``REACH`` with less
than 1e-4; pairs more alike, or joined through others, are missed far less often.

Cases: a null text, or one without words, has an empty set and links with
nothing; a text shorter than a shingle is one shingle; repeated rows get equal
results, each its row; a null doc_id takes part but never names a component
unless its component has no other id, and is kept only then; an empty table gives
an empty result; extra columns are ignored, and kept by ``keep_first``; very long
texts are taken whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _BYTE, components, cut, mix, text_slices, unused
from .ngram_join import Jaccard, node_sets, shingles, verified

HASHES, ROWS = 128, 4
BANDS = HASHES // ROWS
#: Signature values that are compared before the posterior is asked again.
BATCH = 16
#: A pair goes when its chance to reach the threshold is below this.
MISS = 1e-6
#: A bucket with more comparisons left than this is dealt anew.
WORK = 1 << 22
#: Members, and outsiders, of a bucket that meet in one part of it.
SIDE = 1 << 12
#: Times that a bucket is dealt anew, and the next bands that are tried for that.
DEPTH, REACH = 2, 8
#: Bands whose buckets also have a centre at random: one in so many.
RANDOM_CENTRES = 8
#: Bits of a set's parities: the power of two from twice its size on, within these bounds.
PARITY = 1 << 8, 1 << 14
#: Signature values held at once while pairs are compared.
CELLS = 1 << 22

SKETCH = ["size", "signature", "parity"]
NEAR = Jaccard(n=4, num=80, den=100)
_FACTORS = mix(np.arange(1, HASHES + 1, dtype=np.uint64) * _BYTE[21]) | np.uint64(1)


def signatures(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A row of HASHES minima for each non-empty run h[at[i]:at[i + 1]] of shingles."""
    out = np.empty((len(at) - 1, HASHES), np.uint32)
    for k in range(HASHES if len(out) else 0):
        out[:, k] = np.minimum.reduceat(h * _FACTORS[k], at[:-1]) >> np.uint64(32)
    return out


def least_agreements(jac: Jaccard, miss: float = MISS) -> np.ndarray:
    """For each number of compared values the agreements below which a pair goes.

    With an even prior the chance that the similarity reaches t after k agreements of
    m is that of at most k successes in m + 1 trials of probability t.
    """
    t = jac.num / jac.den
    out = np.zeros(HASHES + 1, np.int64)
    for m in range(1, HASHES + 1):
        chance, k = 0.0, 0
        while k <= m:
            chance += comb(m + 1, k) * t**k * (1 - t) ** (m + 1 - k)
            if chance >= miss:
                break
            k += 1
        out[m] = k
    return out


def parities(h: np.ndarray, t: np.ndarray, n: np.ndarray) -> list[bytes]:
    """For each set, of size n and with the shingles h of text t, the bits that an odd number of them fall on."""
    bits = np.clip(1 << np.ceil(np.log2(np.maximum(2 * n, 2))).astype(np.int64), *PARITY)
    at = np.concatenate([[0], np.cumsum(bits)])
    cell = at[t] + (mix(h + _BYTE[20]) & (bits[t] - 1).astype(np.uint64)).astype(np.int64)
    raw = np.packbits((np.bincount(cell, minlength=int(at[-1])) & 1).astype(bool)).tobytes()
    return [raw[x:y] for x, y in zip((at[:-1] // 8).tolist(), (at[1:] // 8).tolist(), strict=True)]


class Sketches:
    """Signatures, sizes and parities of the sets in columns of a table."""

    def __init__(self, t: pa.RecordBatch | pa.Table, of: str = ""):
        col = lambda c: x.combine_chunks() if isinstance(x := t[f"{of}{c}"], pa.ChunkedArray) else x
        self.s = np.frombuffer(b"".join(x.as_py() for x in col("signature")), np.uint32).reshape(-1, HASHES)
        self.n = col("size").to_numpy()
        self.parity = [np.frombuffer(x.as_py(), np.uint8) for x in col("parity")]
        self.width = np.array([len(x) for x in self.parity], np.int64)

    def folded(self, rows: np.ndarray, width: int) -> np.ndarray:
        """The parities of the rows in ``width`` bytes, none of theirs being narrower."""
        out = np.empty((len(rows), width), np.uint8)
        for i, r in enumerate(rows.tolist()):
            out[i] = np.bitwise_xor.reduce(self.parity[r].reshape(-1, width), axis=0)
        return out.view(np.uint64)


def likely_pairs(one: Sketches, two: Sketches, left: np.ndarray, right: np.ndarray, least: np.ndarray, jac: Jaccard) -> np.ndarray:
    """Which pairs (one[left], two[right]) may link: by size, every batch of the signatures, and parities."""
    a, b = one.n[left], two.n[right]
    alive = np.flatnonzero(jac.den * np.minimum(a, b) >= jac.num * np.maximum(a, b))
    same = np.zeros(len(left), np.int64)
    for m in range(0, HASHES, BATCH):
        for k in range(0, len(alive), CELLS // BATCH):
            x = alive[k : k + CELLS // BATCH]
            same[x] += (one.s[left[x], m : m + BATCH] == two.s[right[x], m : m + BATCH]).sum(1)
        alive = alive[same[alive] >= least[m + BATCH]]
    kept = [np.zeros(0, np.int64)]
    width = np.minimum(one.width[left[alive]], two.width[right[alive]])
    for w in np.unique(width).tolist():
        x = alive[width == w]
        l, at_l = np.unique(left[x], return_inverse=True)
        r, at_r = np.unique(right[x], return_inverse=True)
        p, q = one.folded(l, w), two.folded(r, w)
        for k in range(0, len(x), max(1, CELLS // w)):
            y = slice(k, k + max(1, CELLS // w))
            differ = np.bitwise_count(p[at_l[y]] ^ q[at_r[y]]).sum(1, dtype=np.int64)
            both = a[x[y]] + b[x[y]]
            kept.append(x[y][differ <= both - 2 * jac.overlap(a[x[y]], b[x[y]])])
    return np.sort(np.concatenate(kept))


def _matrix(col: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(x.as_py() for x in col), np.uint32).reshape(-1, HASHES)


def document_signatures(docs: DataFrame, jac: Jaccard) -> DataFrame:
    """(doc_id, tag, n, k1, k2, signature, parity) of each document: size and hashes of its set; an empty set has no signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, offs in text_slices(b, "text"):
                h, t = shingles(data, offs, jac.n)
                n = np.bincount(t, minlength=hi - lo)
                k1, k2 = np.zeros(hi - lo, np.uint64), np.zeros(hi - lo, np.uint64)
                np.add.at(k1, t, mix(h + _BYTE[11]))
                np.add.at(k2, t, mix(h + _BYTE[12]))
                rows = np.flatnonzero(n)
                sig: list[bytes | None] = [None] * (hi - lo)
                for i, s in zip(rows.tolist(), signatures(h, np.concatenate([[0], np.cumsum(n[rows])])), strict=True):
                    sig[i] = s.tobytes()
                cols = [b.column(c).slice(lo, hi - lo) for c in ("doc_id", "tag")]
                cols += [pa.array(n, pa.int64()), pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)), pa.array(sig, pa.binary()), pa.array(parities(h, t, n), pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "tag", "n", "k1", "k2", "signature", "parity"])

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tag"), "text")
    return src.mapInArrow(run, "doc_id long, tag long, n long, k1 long, k2 long, signature binary, parity binary")


def band_hashes(s: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of each signature."""
    pairs = np.ascontiguousarray(s).view(np.uint64).reshape(len(s), BANDS, ROWS // 2)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64) * _BYTE[22], (len(s), BANDS)).copy()
    for k in range(ROWS // 2):
        key = mix(key + mix(pairs[:, :, k] + _BYTE[23 + k]))
    return key


def band_keys(nodes: DataFrame) -> DataFrame:
    """(key, band, node): the bucket of each node in each band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key = band_hashes(_matrix(b.column("signature")))
            node = np.repeat(b.column("node").to_numpy(), BANDS)
            band = np.tile(np.arange(BANDS, dtype=np.int32), b.num_rows)
            yield pa.RecordBatch.from_arrays([pa.array(key.ravel().view(np.int64)), pa.array(band), pa.array(node)], names=["key", "band", "node"])

    return nodes.select("node", "signature").mapInArrow(run, "key long, band int, node long")


def further_keys(entries: DataFrame) -> DataFrame:
    """The entries (key, band, node, of, signature) under keys of their bucket and one of the next bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hashes = band_hashes(_matrix(b.column("signature")))
            band = (b.column("band").to_numpy()[:, None] + np.arange(1, REACH + 1)) % BANDS
            key = mix(b.column("key").to_numpy().view(np.uint64)[:, None] + mix(hashes[np.arange(len(band))[:, None], band] + _BYTE[25]))
            again = lambda c: pa.array(np.repeat(b.column(c).to_numpy(), REACH))  # noqa: B023, E731
            yield pa.RecordBatch.from_arrays([pa.array(key.ravel().view(np.int64)), pa.array(band.ravel().astype(np.int32)), again("node"), again("of")], names=["key", "band", "node", "of"])

    return entries.mapInArrow(run, "key long, band int, node long, of long")


def pass_signature_test(pairs: DataFrame, nodes: DataFrame, jac: Jaccard) -> DataFrame:
    """The pairs (a, b) of nodes that may link."""
    least = least_agreements(jac)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = np.arange(b.num_rows)
            kept = pa.array(likely_pairs(Sketches(b, "a_"), Sketches(b, "b_"), at, at, least, jac))
            yield pa.RecordBatch.from_arrays([b.column("a").take(kept), b.column("b").take(kept)], names=["a", "b"])

    sketch = lambda x: nodes.select(F.col("node").alias(x), *[F.col(c).alias(f"{x}_{c}") for c in SKETCH])
    return pairs.join(sketch("a"), "a").join(sketch("b"), "b").mapInArrow(run, "a long, b long")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each (key, part), which stand together."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        key, part = b.column("key").to_numpy(), b.column("part").to_numpy()
        new = np.flatnonzero((key[1:] != key[:-1]) | (part[1:] != part[:-1])) + 1
        if held and (held[-1].column("key")[-1].as_py(), held[-1].column("part")[-1].as_py()) != (key[0], part[0]):
            new = np.concatenate([[0], new])
        at = 0
        for k in new.tolist():
            held.append(b.slice(at, k - at))
            yield pa.Table.from_batches([x for x in held if x.num_rows])
            held, at = [], k
        held.append(b.slice(at))
    if held:
        yield pa.Table.from_batches(held)


def outsider_pairs(entries: DataFrame, jac: Jaccard) -> DataFrame:
    """Pairs (a, b) that pass the signature test, of an outsider and another member of a bucket.

    Outsiders and members of a bucket are each dealt to chunks of about ``SIDE``, and every chunk of the
    one meets every chunk of the other in a part of its own.
    """
    least = least_agreements(jac)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = [], []
        for t in _runs(batches):
            node, of, out, probe = (t[c].to_numpy() for c in ("node", "of", "outsider", "probe"))
            left, right = np.flatnonzero(probe), np.flatnonzero(~probe)
            s = Sketches(t)
            step = max(1, CELLS // BATCH // max(1, len(right)))
            for k in range(0, len(left), step):
                x, y = np.repeat(left[k : k + step], len(right)), np.tile(right, len(left[k : k + step]))
                m = (of[x] != of[y]) & ((node[x] < node[y]) | ~out[y])  # two outsiders meet once
                x, y = x[m], y[m]
                m = likely_pairs(s, s, x, y, least, jac)
                a.append(np.minimum(node[x[m]], node[y[m]]))
                b.append(np.maximum(node[x[m]], node[y[m]]))
            if sum(map(len, a)) >= 1 << 16:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in (a, b)], names=["a", "b"])
                a, b = [], []
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in (a, b)], names=["a", "b"])

    chunks = lambda n: F.ceil(n / F.lit(SIDE)).cast("int")
    chunk = lambda n: F.pmod(F.xxhash64("node"), chunks(n)).cast("int")
    part = lambda i, j: i * chunks(F.col("all")) + j
    some = [F.col(c) for c in ("key", "node", "of", "outsider", *SKETCH)]
    probes = entries.where("outsider").withColumn("i", chunk(F.col("outside")))
    probes = probes.select(*some, F.lit(True).alias("probe"), F.explode(F.transform(F.sequence(F.lit(0), chunks(F.col("all")) - 1), lambda j: part(F.col("i"), j))).alias("part"))
    others = entries.withColumn("j", chunk(F.col("all")))
    others = others.select(*some, F.lit(False).alias("probe"), F.explode(F.transform(F.sequence(F.lit(0), chunks(F.col("outside")) - 1), lambda i: part(i, F.col("j")))).alias("part"))
    dealt = probes.union(others).repartition("key", "part").sortWithinPartitions("key", "part")
    return dealt.mapInArrow(run, "a long, b long")


def open_buckets(entries: DataFrame) -> DataFrame:
    """The entries (key, band, node, of) of buckets with several components, with ``outsider`` (not of the bucket's largest one),
    ``all`` and ``outside`` (how many members and outsiders it has)."""
    by_component = entries.groupBy("key", "of").agg(F.count("*").alias("k"))
    b = by_component.groupBy("key").agg(F.sum("k").alias("all"), F.max("k").alias("k"), F.max_by("of", F.struct("k", "of")).alias("home")).where(F.col("all") > F.col("k"))
    b = b.select("key", "home", "all", (F.col("all") - F.col("k")).alias("outside"))
    return entries.join(b, "key").withColumn("outsider", F.col("of") != F.col("home")).drop("home")


def similar_groups(docs: DataFrame, jac: Jaccard = NEAR) -> DataFrame:
    """A row per document: doc_id, tag (hash of the text), n_shingles, component_id, group (null for an empty set)."""
    rows = cut(document_signatures(docs, jac), "signatures")
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("tag"))
    nodes = rows.where("n > 0").groupBy("k1", "k2", F.col("n").alias("size")).agg(F.min(order).alias("r"), F.first("signature").alias("signature"), F.first("parity").alias("parity"))
    nodes = cut(nodes.select("k1", "k2", "size", F.monotonically_increasing_id().alias("node"), "r.doc_id", "r.tag", "signature", "parity"), "nodes")
    entries = band_keys(nodes)
    some = F.min_by("node", F.when(F.col("band") % RANDOM_CENTRES == 0, F.xxhash64("node", "key")))
    shared = entries.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi"), some.alias("some")).where("lo < hi")
    live = cut(entries.join(shared, "key"), "buckets")
    ends = F.explode(F.array("lo", "hi", "some"))
    star = live.select("node", ends.alias("end")).where("node <> end").select(F.least("node", "end").alias("a"), F.greatest("node", "end").alias("b")).distinct()
    star = cut(pass_signature_test(star, nodes, jac), "pairs")
    met = live.select("node").distinct()
    sets = cut(node_sets(docs, nodes.select("node", "doc_id", "tag").join(met, "node"), jac).select("node", "s"), "sets")
    first = cut(verified(star, sets, jac), "links")
    of = components(first)
    left = live.select("key", "band", "node").join(of, "node", "left").select("key", "band", "node", F.coalesce("component", "node").alias("of"))
    sketches = nodes.select("node", *SKETCH)
    found = None
    for depth in range(DEPTH + 1):
        left = cut(open_buckets(left).join(sketches, "node"), "open")
        much = F.col("all") * F.col("outside") > WORK
        last = depth == DEPTH or left.where(much).isEmpty()
        pairs = cut(outsider_pairs(left if last else left.where(~much), jac).distinct(), "pairs")
        found = pairs if found is None else found.union(pairs)
        if last:
            break
        left = further_keys(left.where(much).select("key", "band", "node", "of", "signature"))
    of = components(first.union(verified(found.distinct(), sets, jac)))
    node = rows.where("n > 0").join(nodes.select("k1", "k2", F.col("size").alias("n"), "node"), ["k1", "k2", "n"])
    node = node.join(of, "node", "left").select("doc_id", "tag", "n", F.coalesce("component", "node").alias("group"))
    node = cut(node, "groups")
    least = node.groupBy("group").agg(F.min("doc_id").alias("component_id"))
    named = node.join(least, "group").select("doc_id", "tag", F.col("n").alias("n_shingles"), "component_id", "group")
    empty = rows.where("n = 0").select("doc_id", "tag", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(None).cast("long").alias("group"))
    return named.union(empty)


def groups_report(docs: DataFrame, jac: Jaccard = NEAR) -> DataFrame:
    """doc_id, n_shingles, component_id and kept (the document names its component) of every document."""
    return similar_groups(docs, jac).select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_first(docs: DataFrame, jac: Jaccard = NEAR) -> DataFrame:
    """One document of each group of near copies, the one with the smallest doc_id; those without words are in no group and stay."""
    d, t = unused(docs, "kept_id", "kept_tag")
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("tag"))
    kept = similar_groups(docs, jac).where("group is not null").groupBy("group").agg(F.min(order).alias("k"))
    kept = kept.select(F.col("k.doc_id").alias(d), F.col("k.tag").alias(t))
    bare = ~F.coalesce(F.regexp_like("text", F.lit(r"[^\x20\x09-\x0D]")), F.lit(False))
    # Rows equal in id and text are in one group: of those one stays.
    one = docs.where(~bare).join(kept, F.col("doc_id").cast("long").eqNullSafe(F.col(d)) & (F.xxhash64("text") == F.col(t))).dropDuplicates([d, t])
    return one.select(*docs.columns).union(docs.where(bare))
