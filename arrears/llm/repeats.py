"""Where texts repeat: sampled suffixes that can share a window, dealt to groups.

Both substring operators ask for windows of ``width`` symbols (words or bytes)
that also start somewhere earlier.  Comparing all suffixes would move the corpus
many times over, so suffixes are sampled by content: within every window the
smallest hashes of its ``gram``-symbol grams are anchors.  Equal windows have
equal anchors at equal offsets, so no repeat is lost, and only about two in
``width - gram + 2`` suffixes stay.

0. A small sample of the texts shows which grams are anchors of many different
   segments (a passage that a third of the documents hold, say). Their anchors
   are dealt out by segment, and all their segments are split as in step 3.
1. Every task finds the anchors of its texts, with a hash of the segment that
   all windows around an anchor can reach.  Of anchors with equal segments
   among those sent together only the earliest goes on; the others are covered by it.
2. Anchors meet by gram.  Grams that occur once end here.  Later occurrences of
   an equal segment are covered whole.  The first ones of grams with different
   segments are asked for.
3. The segments asked for are cut out of the texts and meet by prefix group; a
   group with more than ``GROUP`` segments is split into finer ones by longer
   contexts, each responsible for a range of window offsets.
4. The operator orders the suffixes of its groups; windows of one class lie
   together, and all but the earliest are covered.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _BYTE, cut, mix, range_hashes, text_slices, word_hashes, word_spans

#: Anchors of one task that are compared before they are sent on.
AT_ONCE = 1 << 18
#: Segments that a prefix group may hold before it is split.
GROUP = 20_000
#: Window offsets that one group of a split prefix answers for.
ROUTE = 8
#: The sample: anchors it should hold, and different segments in it that make a gram a frequent one (a thousandth).
SAMPLE, FREQUENT = 1 << 18, 1 << 8
#: Parts that the anchors of a frequent gram are dealt to.
SALT = 64


@dataclass(frozen=True)
class Windows:
    """Windows of ``width`` symbols; anchors are grams of ``gram`` symbols. ``words``: symbols are words, else bytes.

    ``strict``: a window counts as repeated only where it starts in an earlier document, not earlier in its own.
    """

    width: int
    gram: int
    words: bool
    strict: bool

    @property
    def offsets(self) -> int:
        """Positions that an anchor can have in a window."""
        return self.width - self.gram + 1


def sliding(x: np.ndarray, n: int, best: np.ufunc) -> np.ndarray:
    """best(x[i : i + n]) for every i."""
    k = 1
    while 2 * k <= n:
        x = best(x[:-k], x[k:])
        k *= 2
    return best(x[: len(x) - (n - k)], x[n - k :]) if n > k else x


def anchors(values: np.ndarray, before: np.ndarray, win: Windows) -> tuple[np.ndarray, np.ndarray]:
    """(positions, gram hashes) of the anchors of texts that stand one after the other; ``before``: where each begins."""
    if len(values) < win.width:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.arange(len(values) - win.gram + 1)
    hashes = range_hashes(values, at, at + win.gram)
    order = (hashes >> np.uint64(33)).astype(np.uint32) + np.uint32(1)
    low = sliding(order, win.offsets, np.minimum)
    inside = np.zeros(len(low) + 1, np.int32)  # windows that lie in one text
    size = np.diff(before)
    fine = size >= win.width
    np.add.at(inside, before[:-1][fine], 1)
    np.add.at(inside, before[1:][fine] - win.width + 1, -1)
    low[np.cumsum(inside[:-1]) == 0] = 0
    pad = np.zeros(win.offsets - 1, np.uint32)
    top = sliding(np.concatenate([pad, low, pad]), win.offsets, np.maximum)
    pos = np.flatnonzero(top == order)
    return pos, hashes[pos]


def symbols(data: np.ndarray, offs: np.ndarray, win: Windows) -> tuple[np.ndarray, np.ndarray]:
    """(value of each symbol, number of symbols before each text)."""
    if not win.words:
        return _BYTE[data], offs
    starts, ends, before = word_spans(data, offs)
    return word_hashes(data, starts, ends), before


def _earliest(key: np.ndarray, seg: np.ndarray, doc: np.ndarray, tag: np.ndarray, pos: np.ndarray, strict: bool) -> tuple[np.ndarray, np.ndarray]:
    """(order, covered): rows sorted by key, segment and place, and whether an equal segment stands before each."""
    order = np.lexsort((pos, tag, doc, seg, key))
    k, s, d = key[order], seg[order], doc[order]
    new = np.concatenate([[True], (k[1:] != k[:-1]) | (s[1:] != s[:-1])]) if len(k) else np.zeros(0, bool)
    first = np.maximum.accumulate(np.where(new, np.arange(len(k)), 0)) if len(k) else np.zeros(0, np.int64)
    if strict:
        return order, d > d[first]
    t, p = tag[order], pos[order]
    return order, (d != d[first]) | (t != t[first]) | (p != p[first])  # a row that repeats is the same place


_ROWS = "key long, salt int, seg long, doc long, tag int, at long"
_ROW_NAMES = ["key", "salt", "seg", "doc", "tag", "at"]


def _pack(pos: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return pos << 16 | left << 8 | right


def frequent_grams(docs: DataFrame, win: Windows) -> np.ndarray:
    """Grams (sorted) that are anchors of at least ``FREQUENT`` different segments in a sample of the texts.

    At most ``SAMPLE / FREQUENT`` or so, however large the corpus. The sample only steers
    where rows go; grams that it misses are matched in one task each.
    """
    each = 2.0 / (win.offsets + 1)
    rows, symbols_in_all = docs.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    anchors_in_all = (symbols_in_all or 0) * each / (6 if win.words else 1)
    if not anchors_in_all:
        return np.zeros(0, np.int64)
    some = docs if anchors_in_all <= SAMPLE else docs.sample(SAMPLE / anchors_in_all, seed=7)
    kinds = find_anchors(some, win, None).where("seg is not null").select("key", "seg").distinct().groupBy("key").agg(F.count("*").alias("n"))
    got = kinds.where(F.col("n") >= FREQUENT).select("key").toArrow()
    return np.sort(got["key"].to_numpy())


def find_anchors(docs: DataFrame, win: Windows, frequent: np.ndarray | None) -> DataFrame:
    """Anchors of the texts: key (gram), salt (0, or the part of a frequent gram), seg (segment hash; null: already
    covered), doc, tag, at (position and reach)."""
    many = docs.sparkSession.sparkContext.broadcast(np.zeros(0, np.int64) if frequent is None else frequent)  # see frequent_grams

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got, n = [], 0
        for b in batches:
            doc_id, tag = b.column("doc").to_numpy(), b.column("tag").to_numpy()
            for first, _, data, offs in text_slices(b, "text"):
                values, before = symbols(data, offs, win)
                pos, key = anchors(values, before, win)
                text = np.searchsorted(before, pos, "right") - 1
                lo, hi = np.maximum(before[text], pos - win.offsets + 1), np.minimum(before[text + 1], pos + win.width)
                seg = mix(mix(range_hashes(values, lo, pos) + _BYTE[3]) + range_hashes(values, pos, hi))
                got.append((key, seg, doc_id[first + text], tag[first + text], pos - before[text], pos - lo, hi - pos))
                n += len(key)
                if n >= AT_ONCE:
                    yield from send(got)
                    got, n = [], 0
        yield from send(got)

    def send(got: list[tuple]) -> Iterator[pa.RecordBatch]:
        if not got:
            return
        key, seg, doc, mark, pos, left, right = (np.concatenate(c) for c in zip(*got, strict=True))
        order, covered = _earliest(key, seg, doc, mark, pos, win.strict)
        key[order[covered]] = mix(doc[order[covered]].astype(np.uint64))  # these only pass through
        null = np.zeros(len(key), bool)
        null[order[covered]] = True
        known = many.value
        at = np.minimum(np.searchsorted(known, key.view(np.int64)), max(0, len(known) - 1))
        salt = np.where(known[at] == key.view(np.int64), (seg % np.uint64(SALT)).astype(np.int32) + 1, 0).astype(np.int32) if len(known) else np.zeros(len(key), np.int32)
        for k in range(0, len(key), 1 << 16):
            s = slice(k, k + (1 << 16))
            yield pa.RecordBatch.from_arrays([pa.array(key[s].view(np.int64)), pa.array(salt[s]), pa.array(seg[s].view(np.int64), mask=null[s]), pa.array(doc[s]), pa.array(mark[s]), pa.array(_pack(pos[s], left[s], right[s]))], names=_ROW_NAMES)

    return docs.mapInArrow(run, _ROWS)


def match_anchors(found: DataFrame, win: Windows) -> DataFrame:
    """Covered ranges (key null; lo, hi) and segments asked for (key, lo: position; hi: 1 where the group is to be split)."""
    out_names = ["key", "doc", "tag", "lo", "hi"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = []
        for b in batches:
            through = b.column("seg").is_null().to_numpy(zero_copy_only=False)
            if through.any():
                t = b.filter(pa.array(through))
                at = t.column("at").to_numpy()
                yield pa.RecordBatch.from_arrays([pa.nulls(len(at), pa.int64()), t.column("doc"), t.column("tag"), pa.array((at >> 16) - (at >> 8 & 255)), pa.array((at >> 16) + (at & 255))], names=out_names)
            if not through.all():
                kept.append(b.filter(pa.array(~through)))
        if not kept:
            return
        t = pa.Table.from_batches(kept)
        kept.clear()
        key, salt, seg, doc, tag, at = (t[c].to_numpy() for c in _ROW_NAMES)
        del t
        by = np.argsort(key)
        new = np.concatenate([[True], key[by][1:] != key[by][:-1], [True]])
        alone = new[:-1] & new[1:] & (salt[by] == 0)  # of a frequent gram other parts hold the rest
        some = by[~alone]
        key, salt, seg, doc, tag, at = key[some], salt[some], seg[some], doc[some], tag[some], at[some]
        order, covered = _earliest(key, seg, doc, tag, at, win.strict)
        key, salt, seg, doc, tag, at = key[order], salt[order], seg[order], doc[order], tag[order], at[order]
        pos, left, right = at >> 16, at >> 8 & 255, at & 255
        if covered.any():
            c = covered
            yield from _split(pa.RecordBatch.from_arrays([pa.nulls(int(c.sum()), pa.int64()), pa.array(doc[c]), pa.array(tag[c]), pa.array((pos - left)[c]), pa.array((pos + right)[c])], names=out_names))
        # Of what is left, grams with different segments have something to compare.
        r = ~covered
        key, salt, seg, doc, tag, pos = key[r], salt[r], seg[r], doc[r], tag[r], pos[r]
        if not len(key):
            return
        new = np.concatenate([[True], key[1:] != key[:-1]])
        group = np.cumsum(new) - 1
        varied = np.zeros(group[-1] + 1, bool)
        other = doc if win.strict else seg
        differs = ~new & np.concatenate([[False], seg[1:] != seg[:-1]])
        np.logical_or.at(varied, group[differs], True)
        if win.strict:  # in one document only: nothing is earlier
            lo, hi = np.full(len(varied), np.iinfo(np.int64).max), np.full(len(varied), np.iinfo(np.int64).min)
            np.minimum.at(lo, group, other)
            np.maximum.at(hi, group, other)
            varied &= lo < hi
        large = np.bincount(group) > GROUP
        large[group[salt > 0]] = True
        varied |= large
        m = varied[group]
        if m.any():
            yield from _split(pa.RecordBatch.from_arrays([pa.array(key[m]), pa.array(doc[m]), pa.array(tag[m]), pa.array(pos[m]), pa.array(large[group][m].astype(np.int64))], names=out_names))

    return found.repartition("key", "salt").mapInArrow(run, "key long, doc long, tag int, lo long, hi long")


def _split(b: pa.RecordBatch, n: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    for k in range(0, b.num_rows, n):
        yield b.slice(k, n)


def cut_segments(asked: DataFrame, docs: DataFrame, win: Windows) -> DataFrame:
    """The segments asked for: group (prefix), first and last window offset it answers for, place, symbols left of the anchor, segment.

    A words segment is its words with a space after each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            doc_id, tag = b.column("doc").to_pylist(), b.column("tag").to_pylist()
            wants = b.column("wants").to_pylist()
            out = []
            for first, last, data, offs in text_slices(b, "text"):
                raw = data.tobytes()
                for i in range(first, last):
                    text = raw[offs[i - first] : offs[i - first + 1]]
                    parts = text.split() if win.words else text
                    for w in wants[i]:
                        p = w["lo"]
                        left = parts[max(0, p - win.offsets + 1) : p]
                        right = parts[p : p + win.width]
                        for group, lo, hi in _routes(w["key"], bool(w["hi"]), left, right, win):
                            out.append((group, lo, hi, doc_id[i], tag[i], p, len(left), b" ".join([*left, *right]) if win.words else left + right))
                    if len(out) >= 4096:
                        yield _segments(out)
                        out = []
            if out:
                yield _segments(out)

    wants = asked.groupBy("doc", "tag").agg(F.collect_list(F.struct("key", "lo", "hi")).alias("wants"))  # bounded by the document
    return docs.join(wants, ["doc", "tag"]).select("doc", "tag", "text", "wants").mapInArrow(run, _SEGMENT)


_SEGMENT = "prefix long, r_lo int, r_hi int, doc long, tag int, pos long, n_left int, segment binary"


def _segments(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=["prefix", "r_lo", "r_hi", "doc", "tag", "pos", "n_left", "segment"])


def _routes(key: int, split: bool, left, right, win: Windows) -> Iterator[tuple[int, int, int]]:
    """(group, first offset, last offset): one group, or for a split prefix one for each range of offsets.

    Windows with offset r reach r symbols to the left and width - r to the right, so
    those of a range share the least of both; equal windows come to equal groups.
    """
    if not split:
        yield key, 0, win.offsets - 1
        return
    import xxhash

    sep = b"\x00" if win.words else b""
    for lo in range(0, win.offsets, ROUTE):
        hi = min(lo + ROUTE, win.offsets) - 1
        if lo <= len(left) and win.width - hi <= len(right):  # else the text has no window with these offsets
            context = (*left[len(left) - lo :], b"|", *right[: win.width - hi]) if win.words else left[len(left) - lo :] + b"|" + right[: win.width - hi]
            raw = sep.join(context) if win.words else context
            yield xxhash.xxh64(raw, seed=lo).intdigest() - (1 << 63), lo, hi


def repeated_offsets(rank: np.ndarray, lcp: np.ndarray, left: np.ndarray, n_left: np.ndarray, n_right: np.ndarray, r_lo: np.ndarray, r_hi: np.ndarray, place: np.ndarray, win: Windows) -> tuple[np.ndarray, np.ndarray]:
    """(smallest, largest) window offset at which each segment's window stands earlier; largest -1: none.

    ``rank``: segments in order of their right contexts, ``lcp`` of neighbours in it;
    ``left``: matrix of symbols left of the anchor, nearest first; ``place``: a smaller one is earlier.

    Cutting the ordered suffixes where less than ``width - r`` symbols agree gives the
    classes of what follows the anchor; the r symbols before it split them further.
    """
    n = len(rank)
    low, high = np.full(n, win.width, np.int64), np.full(n, -1, np.int64)
    before = np.zeros(n, np.uint64)
    for r in range(win.offsets):
        if r:
            before = mix(before + mix(left[:, r - 1].astype(np.uint64) + _BYTE[5]))
        cls = np.empty(n, np.int64)
        cls[rank] = np.concatenate([[0], np.cumsum(lcp < win.width - r)])
        rows = np.flatnonzero((n_left >= r) & (n_right >= win.width - r) & (r_lo <= r) & (r <= r_hi))
        if len(rows) < 2:
            continue
        c = mix(mix(cls[rows].astype(np.uint64) + _BYTE[6]) + before[rows])
        order = np.argsort(c, kind="stable")
        c, rows = c[order], rows[order]
        new = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]]))
        least = np.minimum.reduceat(place[rows], new)
        hit = rows[place[rows] > np.repeat(least, np.diff(np.append(new, len(rows))))]
        low[hit] = np.minimum(low[hit], r)
        high[hit] = r
    return low, high


def compare_segments(segments: DataFrame, win: Windows, suffix_order: Callable) -> DataFrame:
    """Covered ranges (doc, tag, lo, hi) of the segments' windows; ``suffix_order`` gives (rank, lcp) of a group's right contexts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(b) if (b := [x for x in batches if x.num_rows]) else None
        if t is None:
            return
        doc, tag, pos, n_left = t["doc"].to_numpy(), t["tag"].to_numpy(), t["pos"].to_numpy(), t["n_left"].to_numpy().astype(np.int64)
        left, right, n_right = _matrices(t["segment"], n_left, win)
        rank, lcp = suffix_order(right, n_right, t["prefix"].to_numpy())
        if win.strict:
            place = doc
        else:
            place = np.empty(len(doc), np.int64)
            place[np.lexsort((pos, tag, doc))] = np.arange(len(doc))
            # one segment may be here for several ranges of offsets: the same place
            o = np.lexsort((pos, tag, doc))
            same = np.concatenate([[False], (doc[o][1:] == doc[o][:-1]) & (tag[o][1:] == tag[o][:-1]) & (pos[o][1:] == pos[o][:-1])])
            place[o] = np.cumsum(~same)
        low, high = repeated_offsets(rank, lcp, left, n_left, n_right, t["r_lo"].to_numpy(), t["r_hi"].to_numpy(), place, win)
        hit = np.flatnonzero(high >= 0)
        # Every window holds the anchor, so those of one segment cover one range; between its ends all offsets are looked at here.
        yield from _split(pa.RecordBatch.from_arrays([pa.array(doc[hit]), pa.array(tag[hit]), pa.array(pos[hit] - high[hit]), pa.array(pos[hit] - low[hit] + win.width)], names=["doc", "tag", "lo", "hi"]))

    return segments.repartition("prefix").mapInArrow(run, "doc long, tag int, lo long, hi long")


def _matrices(col: pa.ChunkedArray, n_left: np.ndarray, win: Windows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(left contexts nearest first, right contexts, sizes of the right ones); -1 stands where there is no symbol."""
    n = len(col)
    parts = col.to_pylist()
    if win.words:
        ids: dict[bytes, int] = {}
        flat = [ids.setdefault(w, len(ids)) for x in parts for w in x.split()]
        size = np.array([x.count(b" ") + 1 for x in parts], np.int64)
        flat = np.array(flat, np.int32)
    else:
        size = np.array([len(x) for x in parts], np.int64)
        flat = np.frombuffer(b"".join(parts), np.uint8).astype(np.int16)
    at = np.cumsum(size) - size
    left = np.full((n, win.offsets - 1), -1, flat.dtype)
    right = np.full((n, win.width), -1, flat.dtype)
    for r in range(win.offsets - 1):
        m = n_left > r
        left[m, r] = flat[at[m] + n_left[m] - 1 - r]
    n_right = size - n_left
    for r in range(win.width):
        m = n_right > r
        right[m, r] = flat[at[m] + n_left[m] + r]
    return left, right, n_right


def neighbour_lcp(right: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Symbols that neighbours in the order have in common."""
    out = np.empty(max(0, len(rank) - 1), np.int64)
    for k in range(0, len(out), 1 << 14):
        a, b = right[rank[k : k + (1 << 14)]], right[rank[k + 1 : k + (1 << 14) + 1]]
        differs = a[: len(b)] != b
        out[k : k + len(b)] = np.where(differs.any(1), differs.argmax(1), right.shape[1])
    return out


def keyed(docs: DataFrame) -> DataFrame:
    """(doc, tag, text): the id (a null is the last) and a hash of the text that tells rows of one id apart."""
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("doc"), F.hash("text").alias("tag"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def covered_ranges(docs: DataFrame, win: Windows, suffix_order: Callable) -> DataFrame:
    """(doc, tag, ranges array of lo, hi) of what repeats in the rows of ``keyed``."""
    met = cut(match_anchors(find_anchors(docs, win, frequent_grams(docs, win)), win), "anchors")
    asked = met.where("key is not null")
    more = compare_segments(cut_segments(asked, docs, win), win, suffix_order)
    every = met.where("key is null").select("doc", "tag", "lo", "hi").union(more)
    return every.groupBy("doc", "tag").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges"))  # bounded by the document


def marked(n: int, ranges: list[dict] | None) -> np.ndarray:
    """Which of n symbols the ranges cover."""
    edge = np.zeros(n + 1, np.int64)
    if ranges:
        np.add.at(edge, [x["lo"] for x in ranges], 1)
        np.add.at(edge, [x["hi"] for x in ranges], -1)
    return np.cumsum(edge[:-1]) > 0
