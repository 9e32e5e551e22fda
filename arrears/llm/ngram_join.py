"""N-gram Jaccard join: a size-aware heavy-light join on sets of word shingles.

Two documents link when ``den * |A & B| >= num * |A | B|``.  Small sets are
joined by enumeration: two sets of sizes a and b link exactly when they share a
subset of the overlap that these sizes need, so every small set lists its
subsets of each needed size and equal subsets meet.  Large sets are joined by
scanning inverted lists: the rarest shingles of a set are its list entries, and
pairs that share one are verified in full.  The boundary between small and
large is the size at which enumeration and scanning cost least in all, both
estimated from the sets at hand.

Before that, documents that cannot link are set aside: of the smallest-hash
shingles of both partners a known number must agree, so a document too few of
whose smallest shingles occur anywhere else has no partner.  Equal sets are one
node.  Links are needed as components, so no group is expanded into all its
pairs: equal subsets link to one of their sets, and inverted lists are first
linked to their centre; only pairs of different components so far are looked
at again, and of those only the ones whose signatures (parities of hashed
shingles, a lower bound of the difference) leave a link possible.

Shingles are 64-bit hashes of the word hashes.

Cases: a null text, or one without words, has an empty set and links with
nothing; a text shorter than a shingle is one shingle; repeated rows get equal
results, each its row; a null doc_id takes part but never names a component
unless its component has no other id; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _BYTE, components, cut_and_tidy, gram_hashes, mix, range_hashes, text_slices, unused, word_hashes, word_spans

#: Cells of the fixed-size count of shingles that orders them by frequency.
CELLS = 1 << 20
#: Parts of that count that are added up apart.
PARTS = 64
#: Sets whose ids (24 bytes each) are broadcast to find their texts, so that the other texts stay where they are.
BROADCAST_NODES = 250_000
#: Bits of a set's signature.
SIGNATURE = 512
#: Sets above this size are never enumerated.
LARGEST_SMALL = 28
#: Shingles of both partners' smallest ones that must agree, as a share of a set (in percent).
AGREE = 10
#: Buckets of the lists of smallest shingles: four for each task that reads the texts, between 2^4 and 2^18.
BUCKET_BITS = 4, 18


@dataclass(frozen=True)
class Jaccard:
    """Shingles of ``n`` words; sets link when den * intersection >= num * union."""

    n: int = 4
    num: int = 85
    den: int = 100

    def overlap(self, a, b):
        """Smallest intersection that links sets of sizes a and b."""
        return -(-self.num * (a + b) // (self.num + self.den))

    def least(self, a):
        """Smallest partner of a set of size a, which is also its smallest overlap with any partner."""
        return -(-self.num * a // self.den)

    def most(self, a):
        return self.den * a // self.num


def shingles(data: np.ndarray, offs: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, text of each): the distinct shingles of each text in order of hash."""
    starts, ends, before = word_spans(data, offs)
    words = word_hashes(data, starts, ends, lower=True)
    of = np.repeat(np.arange(len(offs) - 1), np.diff(before))
    g = gram_hashes(words, n)
    fits = of[: len(g)] == of[n - 1 :] if len(g) else np.zeros(0, bool)
    h, t = g[fits], of[: len(g)][fits]
    size = np.diff(before)
    short = np.flatnonzero((size > 0) & (size < n))
    if len(short):
        whole = range_hashes(words, before[:-1][short], before[1:][short]) ^ _BYTE[9]
        h, t = np.concatenate([h, whole]), np.concatenate([t, short])
    order = np.lexsort((h, t))
    h, t = h[order], t[order]
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (t[1:] != t[:-1])]) if len(h) else np.zeros(0, bool)
    return h[new], t[new]


def _first(t: np.ndarray, n_texts: int, take: np.ndarray) -> np.ndarray:
    """Which entries are among the first ``take`` of their text (entries stand by text)."""
    at = np.searchsorted(t, np.arange(n_texts))
    return np.arange(len(t)) - at[t] < take[t]


def document_sets(docs: DataFrame, jac: Jaccard) -> DataFrame:
    """A row per document: rid (a number of its own), doc_id, tag, n, k1 and k2 (hash of the set), likely (may link).

    ``likely``: enough of its smallest shingles occur in other documents.
    """
    bits = int(np.clip(np.ceil(np.log2(4 * max(1, docs.rdd.getNumPartitions()))), *BUCKET_BITS))

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, k = TaskContext.get().partitionId(), 0
        for b in batches:
            for first, last, data, offs in text_slices(b, "text", 8 << 20):
                for lo in range(0, last - first, 1 << 15):
                    hi = min(last - first, lo + (1 << 15))
                    batch = part << 31 | k
                    k += 1
                    part_offs = offs[lo : hi + 1] - offs[lo]
                    h, t = shingles(data[offs[lo] : offs[hi]], part_offs, jac.n)
                    n = np.bincount(t, minlength=hi - lo)
                    k1, k2 = np.zeros(hi - lo, np.uint64), np.zeros(hi - lo, np.uint64)
                    np.add.at(k1, t, mix(h + _BYTE[11]))
                    np.add.at(k2, t, mix(h + _BYTE[12]))
                    agree = -(-AGREE * n // 100)
                    m = _first(t, hi - lo, n - jac.least(n) + agree)
                    h, t = h[m], t[m]
                    order = np.argsort(h, kind="stable")
                    h, t = h[order], t[order]
                    new = np.concatenate([[True], h[1:] != h[:-1], [True]]) if len(h) else np.ones(1, bool)
                    alone = new[:-1] & new[1:]
                    local = np.bincount(t[~alone], minlength=hi - lo)
                    ids = b.column("doc_id").slice(first + lo, hi - lo)
                    # The documents of the batch, and its lists by bucket: a shingle once, with its text or 65535 for several.
                    own = pa.StructArray.from_arrays([ids, b.column("tag").slice(first + lo, hi - lo), pa.array(n, pa.int64()), pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)), pa.array(local, pa.int64())], names=["doc_id", "tag", "n", "k1", "k2", "local"])
                    yield _lists([None], [batch], [None], [None], [own.to_pylist()])
                    once = new[:-1]
                    h, t = h[once], np.where(alone[once], t[once], 0xFFFF).astype("<u2")
                    edges = np.searchsorted(h >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
                    low = (h & np.uint64((1 << 48) - 1)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
                    rows = [(i, batch, np.ascontiguousarray(low[x:y]).tobytes(), t[x:y].tobytes(), None) for i, (x, y) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)) if y > x]
                    if rows:
                        yield _lists(*map(list, zip(*rows, strict=True)))

    def _lists(*cols):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _LIST_TYPES, strict=True)], names=["bucket", "batch", "h", "t", "own"])

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Counts, for each batch, of the listed shingles that other batches have too; the documents pass through."""
        held: dict[int, list[tuple[int, bytes, bytes]]] = {}
        for b in batches:
            through = b.column("bucket").is_null().to_numpy(zero_copy_only=False)
            if through.any():
                m = b.filter(pa.array(through))
                yield pa.RecordBatch.from_arrays([m.column("batch"), pa.nulls(m.num_rows, pa.binary()), m.column("own")], names=["batch", "counts", "own"])
            m = b.filter(pa.array(~through))
            for bucket, batch, h, t in zip(*[m.column(c).to_pylist() for c in ("bucket", "batch", "h", "t")], strict=True):
                held.setdefault(bucket, []).append((batch, h, t))
        total: dict[int, np.ndarray] = {}
        for bucket in list(held):
            rows = held.pop(bucket)
            raw = np.zeros((sum(len(x[2]) // 2 for x in rows), 8), np.uint8)
            raw[:, :6] = np.frombuffer(b"".join(x[1] for x in rows), np.uint8).reshape(-1, 6)
            h = raw.view("<u8").ravel()
            t = np.frombuffer(b"".join(x[2] for x in rows), "<u2")
            of = np.repeat(np.arange(len(rows)), [len(x[2]) // 2 for x in rows])
            order = np.argsort(h)
            s = h[order]
            new = np.concatenate([[True], s[1:] != s[:-1], [True]])
            many = order[~(new[:-1] & new[1:])]
            many = many[t[many] != 0xFFFF]
            many = many[np.argsort(of[many], kind="stable")]
            at = np.searchsorted(of[many], np.arange(len(rows) + 1))
            for i in range(len(rows)):
                if at[i + 1] > at[i]:
                    c = np.bincount(t[many[at[i] : at[i + 1]]]).astype(np.int32)
                    old = total.get(rows[i][0])
                    if old is not None:
                        if len(old) > len(c):
                            c, old = old, c
                        c[: len(old)] += old
                    total[rows[i][0]] = c
        for k in range(0, len(total), 256):
            items = list(total.items())[k : k + 256]
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in items], pa.int64()), pa.array([c.astype("<i4").tobytes() for _, c in items], pa.binary()), pa.nulls(len(items), _OWN)], names=["batch", "counts", "own"])

    def likely(key: tuple, t: pa.Table) -> pa.Table:
        own = next(x for x in t["own"].to_pylist() if x is not None)
        n = np.array([x["n"] for x in own], np.int64)
        got = np.array([x["local"] for x in own], np.int64)
        for x in t["counts"]:
            if x.is_valid:
                c = np.frombuffer(x.as_buffer(), "<i4")
                got[: len(c)] += c
        # The partner may be smaller, down to ``least``: so many must agree at least.
        need = -(-AGREE * jac.least(n) // 100)
        rid = (int(key[0].as_py()) << 16) + np.arange(len(own))
        cols = [pa.array(rid, pa.int64())] + [pa.array([x[c] for x in own], ty) for c, ty in (("doc_id", pa.int64()), ("tag", pa.int64()), ("n", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()))]
        return pa.Table.from_arrays([*cols, pa.array((n > 0) & (got >= need))], names=["rid", "doc_id", "tag", "n", "k1", "k2", "likely"])

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tag"), F.coalesce("text", F.lit("")).alias("text"))
    own = "own array<struct<doc_id:long,tag:long,n:long,k1:long,k2:long,local:long>>"
    found = src.mapInArrow(lists, f"bucket int, batch long, h binary, t binary, {own}")
    found = found.repartition(F.coalesce("bucket", F.hash("batch"))).mapInArrow(shared, f"batch long, counts binary, {own}")
    return found.groupBy("batch").applyInArrow(likely, "rid long, doc_id long, tag long, n long, k1 long, k2 long, likely boolean")


_OWN = pa.list_(pa.struct([(c, pa.int64()) for c in ("doc_id", "tag", "n", "k1", "k2", "local")]))
_LIST_TYPES = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), _OWN]


def signatures(h: np.ndarray, t: np.ndarray, n_sets: int) -> np.ndarray:
    """64 bytes for each set: of ``SIGNATURE`` bits, those that an odd number of its shingles fall on.

    Two sets differ in at least as many shingles as their signatures in bits.
    """
    bit = (mix(h + _BYTE[16]) & np.uint64(SIGNATURE - 1)).astype(np.int64)
    odd = np.zeros(n_sets * SIGNATURE, bool)
    cell, times = np.unique(t * SIGNATURE + bit, return_counts=True)
    odd[cell[times % 2 == 1]] = True
    return np.packbits(odd.reshape(n_sets, SIGNATURE), axis=1).view("<i8")


def node_sets(docs: DataFrame, nodes: DataFrame, jac: Jaccard) -> DataFrame:
    """(node, n, s array of shingles, g signature): the sets of the nodes (node, doc_id, tag)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, offs in text_slices(b, "text"):
                h, t = shingles(data, offs, jac.n)
                at = np.searchsorted(t, np.arange(hi - lo + 1))
                s = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(h.view(np.int64)))
                g = pa.array(signatures(h, t, hi - lo).tolist(), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([b.column("node").slice(lo, hi - lo), pa.array(np.diff(at), pa.int64()), s, g], names=["node", "n", "s", "g"])

    some_id = lambda c: F.coalesce(c.cast("long"), F.lit(-(1 << 63)))
    keyed = nodes.select("node", some_id(F.col("doc_id")).alias("d"), F.col("tag").alias("t"))
    if nodes.count() <= BROADCAST_NODES:  # else both sides are shuffled
        keyed = F.broadcast(keyed)
    text = docs.select(some_id(F.col("doc_id")).alias("d"), F.xxhash64("text").alias("t"), "text")
    rows = text.join(keyed, ["d", "t"]).groupBy("d", "t", "node").agg(F.first("text").alias("text"))  # rows that repeat
    return rows.select("node", "text").mapInArrow(run, "node long, n long, s array<long>, g array<long>")


def _cell(h: np.ndarray) -> np.ndarray:
    return (mix(h) & np.uint64(CELLS - 1)).astype(np.int64)


def _sets(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, row of each, size of each row) of a batch of sets."""
    col = b.column("s")
    h = col.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    n = b.column("n").to_numpy()
    return h, np.repeat(np.arange(len(n)), n), n


def frequencies(sets: DataFrame) -> np.ndarray:
    """How often the shingles of each of ``CELLS`` cells occur: a table of fixed size, whatever the corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CELLS, "<i8")
        for b in batches:
            if b.num_rows:
                total += np.bincount(_cell(_sets(b)[0]), minlength=CELLS)
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array(range(PARTS), pa.int32()), pa.array([x.tobytes() for x in np.split(total, PARTS)], pa.binary())], names=["part", "k"])

    def add(t: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(x.as_buffer(), "<i8") for x in t["k"]], axis=0)
        return pa.Table.from_arrays([t["part"][:1], pa.array([total.astype("<i8").tobytes()], pa.binary())], names=["part", "k"])

    counted = sets.select("n", "s").mapInArrow(run, "part int, k binary").groupBy("part").applyInArrow(add, "part int, k binary")
    out = np.zeros(CELLS, np.int64)
    for r in counted.toArrow().to_pylist():
        out[r["part"] * (CELLS // PARTS) : (r["part"] + 1) * (CELLS // PARTS)] = np.frombuffer(r["k"], "<i8")
    return out


def by_rarity(h: np.ndarray, t: np.ndarray, freq: np.ndarray) -> np.ndarray:
    """Entries by set and in it by frequency, then hash: one order of all shingles everywhere."""
    return np.lexsort((h, freq[_cell(h)], t))


def subset_cost(a: int, jac: Jaccard) -> int:
    """Subsets that a set of size a lists."""
    return sum(comb(a, int(jac.overlap(a, b))) for b in range(int(jac.least(a)), int(jac.most(a)) + 1))


def boundary(sets: DataFrame, freq, jac: Jaccard) -> int:
    """The size up to which sets are enumerated: where enumerating and scanning cost least together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            h, t, n = _sets(b)
            order = by_rarity(h, t, freq.value)
            h, t = h[order], t[order]
            m = _first(t, len(n), n - jac.least(n) + 1)
            scan = np.bincount(t[m], weights=freq.value[_cell(h[m])], minlength=len(n))
            size = np.minimum(n, LARGEST_SMALL + 1)
            k = np.unique(size)
            yield pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(np.array([(size == x).sum() for x in k]), pa.int64()), pa.array(np.array([scan[size == x].sum() for x in k]))], names=["size", "sets", "scan"])

    rows = {int(r["size"]): r for r in sets.select("n", "s").mapInArrow(run, "size long, sets long, scan double").groupBy("size").agg(F.sum("sets").alias("sets"), F.sum("scan").alias("scan")).toArrow().to_pylist()}
    get = lambda x, c: float(rows[x][c]) if x in rows else 0.0
    costs = []
    for x in range(LARGEST_SMALL + 1):
        light = sum(get(a, "sets") * subset_cost(a, jac) for a in range(1, x + 1))
        heavy = sum(get(a, "scan") for a in range(x + 1, LARGEST_SMALL + 2))
        costs.append(light + heavy)
    return int(np.argmin(costs))


def light_links(sets: DataFrame, x: int, jac: Jaccard) -> DataFrame:
    """Links (a, b) among sets of at most x shingles, by equal subsets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key, node, size, least = [], [], [], []
            for i, s in zip(b.column("node").to_pylist(), b.column("s").to_pylist(), strict=True):
                a = len(s)
                s = np.sort(np.array(s, np.int64)).view(np.uint64)
                by_size: dict[int, np.ndarray] = {}
                for p in range(int(jac.least(a)), min(x, int(jac.most(a))) + 1):
                    o = int(jac.overlap(a, p))
                    if o not in by_size:
                        # Leaving out a - o of the shingles: the sum of hashes of what stays names the subset.
                        one, two = mix(s + _BYTE[13]), mix(s + _BYTE[14])
                        out = np.array(list(combinations(range(a), a - o)), np.int64).reshape(comb(a, o), a - o)
                        by_size[o] = mix(one.sum() - one[out].sum(1)) + two.sum() - two[out].sum(1)
                    lo, hi = min(a, p), max(a, p)
                    k = mix(by_size[o] + np.uint64((lo << 20 | hi << 8 | o) * int(_BYTE[15]) & (1 << 64) - 1))
                    key.append(k.view(np.int64))
                    node.append(np.full(len(k), i))
                    size.append(np.full(len(k), a))
                    least.append(np.full(len(k), lo))
            if key:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in (key, node, size, least)], names=["key", "node", "size", "least"])

    listed = sets.where(F.col("n") <= x).select("node", "s").mapInArrow(run, "key long, node long, size long, least long")
    centre = listed.groupBy("key").agg(F.min(F.struct("size", "node")).alias("c"), F.count("*").alias("k")).where("k > 1")
    # A subset of sizes a < b links all its sets to one of size a; without one of those nothing links.
    both = listed.join(centre, "key").where((F.col("c.size") == F.col("least")) & (F.col("node") != F.col("c.node")))
    return both.select(F.col("node").alias("a"), F.col("c.node").alias("b")).distinct()


def entries(sets: DataFrame, x: int, freq, jac: Jaccard) -> DataFrame:
    """Inverted lists (h, node, n, at, short) of the sets that can link with one of more than x shingles.

    ``at``: place of the shingle among the set's, rarest first; ``short``: within what
    a set needs to meet partners of its own size or larger.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            h, t, n = _sets(b)
            order = by_rarity(h, t, freq.value)
            h, t = h[order], t[order]
            at = np.arange(len(t)) - np.searchsorted(t, np.arange(len(n)))[t]
            m = at < (n - jac.least(n) + 1)[t]
            short = at < (n - jac.overlap(n, n) + 1)[t]
            node = b.column("node").to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(h[m].view(np.int64)), pa.array(node[t[m]]), pa.array(n[t[m]], pa.int64()), pa.array(at[m], pa.int64()), pa.array(short[m])], names=["h", "node", "n", "at", "short"])

    large = sets.where(F.col("n") >= int(jac.least(x + 1)))
    return large.select("node", "n", "s").mapInArrow(run, "h long, node long, n long, at long, short boolean")


def _may_link(a: str, b: str, x: int, jac: Jaccard):
    """Condition on two list entries: sizes, one of them large, the smaller one's entry short, and enough shingles left."""
    lo, hi = F.least(f"{a}.n", f"{b}.n"), F.greatest(f"{a}.n", f"{b}.n")
    need = F.ceil(F.lit(jac.num) * (lo + hi) / F.lit(jac.num + jac.den))
    left = F.least(F.col(f"{a}.n") - F.col(f"{a}.at"), F.col(f"{b}.n") - F.col(f"{b}.at")) + F.least(f"{a}.at", f"{b}.at")
    short = ((F.col(f"{a}.n") <= F.col(f"{b}.n")) & F.col(f"{a}.short")) | ((F.col(f"{b}.n") <= F.col(f"{a}.n")) & F.col(f"{b}.short"))
    return (jac.den * lo >= jac.num * hi) & (hi > x) & short & (left >= need)


def _alike(a: str, b: str, jac: Jaccard):
    """Condition on two rows with signatures: they differ in no more bits than linked sets differ in shingles."""
    both = F.col(f"{a}.n") + F.col(f"{b}.n")
    need = F.ceil(F.lit(jac.num) * both / F.lit(jac.num + jac.den))
    bits = [F.bit_count(F.col(f"{a}.g")[i].bitwiseXOR(F.col(f"{b}.g")[i])) for i in range(SIGNATURE // 64)]
    return sum(bits[1:], bits[0]) <= both - 2 * need


def verified(pairs: DataFrame, sets: DataFrame, jac: Jaccard) -> DataFrame:
    """The pairs (a, b) whose sets link."""
    one = pairs.join(sets.select(F.col("node").alias("a"), F.col("s").alias("sa")), "a")
    two = one.join(sets.select(F.col("node").alias("b"), F.col("s").alias("sb")), "b")
    both = F.size(F.array_intersect("sa", "sb"))
    return two.withColumn("o", both).where(jac.den * F.col("o") >= jac.num * (F.size("sa") + F.size("sb") - F.col("o"))).select("a", "b")


def heavy_links(sets: DataFrame, x: int, freq, jac: Jaccard, known: DataFrame) -> DataFrame:
    """Links (a, b) that join the components of all pairs with a set of more than x shingles; ``known``: links found already."""
    lists = cut_and_tidy(entries(sets, x, freq, jac), "lists")
    e = lists.alias("e")
    centre = lists.groupBy("h").agg(F.min(F.struct((~F.col("short")).alias("long"), F.col("node"), F.col("n"), F.col("at"), F.col("short"))).alias("c"), F.count("*").alias("k"))
    centre = centre.where("k > 1 and not c.long").select("h", "c.*", "k").drop("long").alias("c")
    star = e.join(centre, "h").where("e.node <> c.node").where(_may_link("e", "c", x, jac))
    star = star.select(F.least("e.node", "c.node").alias("a"), F.greatest("e.node", "c.node").alias("b")).distinct()
    known_n = sets.select("node", "n", "g")
    star = star.join(known_n.alias("l"), F.col("a") == F.col("l.node")).join(known_n.alias("r"), F.col("b") == F.col("r.node")).where(_alike("l", "r", jac)).select("a", "b")
    first = cut_and_tidy(verified(star, sets, jac).union(known))
    of = components(first, cut=cut_and_tidy)
    # Lists again: an entry whose component is that of its list's centre has met the others of it.
    # Pairs whose signatures differ too much are left out where they arise.
    shared = lists.join(centre.select("h", F.col("c.node").alias("centre")), "h")
    mine = sets.select("node", "g").join(of, "node", "left").withColumn("of", F.coalesce("component", "node")).drop("component")
    of_centre = of.select(F.col("node").alias("centre"), F.col("component").alias("centre_of"))
    live = shared.join(mine, "node").join(of_centre, "centre", "left").withColumn("centre_of", F.coalesce("centre_of", "centre"))
    live = cut_and_tidy(live, "lists")
    other = live.where("of <> centre_of").alias("p")
    pairs = other.join(live.alias("q"), "h").where("p.of <> q.of and p.node <> q.node").where(_may_link("p", "q", x, jac) & _alike("p", "q", jac))
    pairs = pairs.select(F.least("p.node", "q.node").alias("a"), F.greatest("p.node", "q.node").alias("b")).distinct()
    return first.union(verified(pairs, sets, jac))


def similar_groups(docs: DataFrame, jac: Jaccard = Jaccard()) -> DataFrame:
    """A row per document: doc_id, tag (hash of the text), n_shingles, component_id, group (number of its component)."""
    rows = cut_and_tidy(document_sets(docs, jac), "sets")
    some = rows.where("likely")
    nodes = some.groupBy("k1", "k2", "n").agg(F.min_by(F.struct("rid", "doc_id", "tag"), "rid").alias("r"))
    nodes = cut_and_tidy(nodes.select("k1", "k2", F.col("n").alias("n_of"), F.col("r.rid").alias("node"), F.col("r.doc_id").alias("doc_id"), F.col("r.tag").alias("tag")), "nodes")
    sets = cut_and_tidy(node_sets(docs, nodes, jac), "shingles")
    spark = docs.sparkSession
    freq = spark.sparkContext.broadcast(frequencies(sets))  # CELLS numbers
    x = boundary(sets, freq, jac)
    links = heavy_links(sets, x, freq, jac, light_links(sets, x, jac))
    of = components(links, cut=cut_and_tidy)
    freq.unpersist()
    # The smallest doc_id of each component, over all rows of its sets.
    node = some.join(nodes.select("k1", "k2", F.col("n_of").alias("n"), "node"), ["k1", "k2", "n"]).select("rid", "doc_id", "node")
    node = node.join(of, "node", "left").withColumn("c", F.coalesce("component", "node"))
    least = node.groupBy("c").agg(F.min("doc_id").alias("component_id"))
    named = node.join(least, "c").select("rid", "component_id", F.col("c").alias("group"))
    out = rows.join(named, "rid", "left").withColumn("component_id", F.when(F.col("likely"), F.col("component_id")).otherwise(F.col("doc_id")))
    return out.select("doc_id", "tag", F.col("n").alias("n_shingles"), "component_id", F.coalesce("group", "rid").alias("group"))


def groups_report(docs: DataFrame, jac: Jaccard = Jaccard()) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    return similar_groups(docs, jac).select("doc_id", "n_shingles", "component_id")


def keep_first(docs: DataFrame, jac: Jaccard = Jaccard()) -> DataFrame:
    """One document of each group of similar ones, the one with the smallest doc_id, with all its columns.

    Documents without words are in no group and stay.
    """
    key, d, t, groups, rows = unused(docs, "text_key", "kept_id", "kept_key", "n_groups", "n_rows")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tag")
    kept = similar_groups(docs, jac).groupBy("group").agg(F.min(order).alias("k"), F.count("*").alias("n"))
    kept = kept.groupBy(F.col("k.doc_id").alias(d), F.col("k.tag").alias(t)).agg(F.count("*").alias(groups), F.max("n").alias(rows))
    out = docs.withColumn(key, F.xxhash64("text"))
    out = out.join(kept, F.col("doc_id").cast("long").eqNullSafe(F.col(d)) & (F.col(key) == F.col(t)))
    # Rows equal in id and text are in one group: of those one stays. Without words each is its own group.
    again = (F.col(rows) > 1) & (F.col(groups) == 1)
    one = out.where(again).dropDuplicates(["doc_id", key])
    return out.where(~again).select(*docs.columns).union(one.select(*docs.columns))
