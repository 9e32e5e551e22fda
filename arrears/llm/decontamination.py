"""Benchmark decontamination: rare n-gram seeds and Smith-Waterman alignment.

Texts and test items become words (letters and digits, A-Z folded).  The n-grams
of the items are looked up in every text; n-grams that occur often in the corpus
beside those of the same item are dropped, the rare ones are seeds.  Every
occurrence counts once, however many items or blocks share the n-gram.  Around the
seeds of an item a window of the text is aligned with the whole item word by
word; edits and paraphrases cost score, unrelated words on either side do not.
A text is contaminated where the best local alignment reaches ``MIN_SCORE`` of
what a verbatim copy gets.

The items are read in blocks of ``BLOCK_BYTES`` of text, each a pass over the
documents, so what every task holds is bounded however large the benchmark is.

Cases: null or empty texts and items match nothing; an item shorter than n words
is its own seed; repeated documents give a row each, repeated items (same id and text) one; an
empty table gives an empty result; extra columns are ignored; very long texts
and items are aligned whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LETTERS, cut, gram_hashes, text_slices, unused, word_hashes, word_spans

N = 4
MIN_SCORE = 0.6
MATCH, MISMATCH, GAP = 2, -1, -1
#: Text of test items that is held at once.
BLOCK_BYTES = 16 << 20
#: A seed occurs at most this many times as often as its item's median n-gram.
RARE = 2
#: Stands for the item in rows that hold a task's n-grams and how often they occur.
COUNTS = -1
_NEAR = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("text_key", pa.int64()), ("item", pa.int64()), ("start", pa.int64()), ("words", pa.binary()), ("grams", pa.binary())])


class Items:
    """The items of a block: words of each, and its n-grams in order of their hash."""

    def __init__(self, ids: list, texts: list[str | None], n: int = N):
        data = [(t or "").encode("utf-8") for t in texts]
        offs = np.concatenate([[0], np.cumsum([len(x) for x in data])]).astype(np.int64)
        raw = np.frombuffer(b"".join(data), np.uint8)
        starts, ends, before = word_spans(raw, offs, LETTERS)
        words = word_hashes(raw, starts, ends, lower=True)
        self.words = [words[before[i] : before[i + 1]] for i in range(len(ids))]
        self.ids = ids
        grams, item, at, length = [], [], [], []
        for i, w in enumerate(self.words):
            g = gram_hashes(w, min(n, len(w))) if len(w) else np.zeros(0, np.uint64)
            grams.append(g)
            item.append(np.full(len(g), i))
            at.append(np.arange(len(g)))
            length.append(np.full(len(g), min(n, len(w))))
        g = np.concatenate([*grams, np.zeros(0, np.uint64)])
        order = np.argsort(g, kind="stable")
        self.gram, self.item, self.at = g[order], *(np.concatenate([*x, np.zeros(0, np.int64)]).astype(np.int64)[order] for x in (item, at))
        self.lengths = sorted(set(np.concatenate([*length, np.zeros(0, np.int64)]).astype(int).tolist()))
        self.distinct = np.unique(self.gram)
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.distinct >> np.uint64(44)).astype(np.int64)] = True

    @classmethod
    def of(cls, state: dict) -> Items:
        """The same block from its ``vars``, which travel as plain values."""
        items = cls.__new__(cls)
        items.__dict__.update(state)
        return items

    def hits(self, words: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, word position in all, gram) of the item n-grams in the texts."""
        out = []
        of = np.repeat(np.arange(len(before) - 1), np.diff(before))
        for k in self.lengths:
            g = gram_hashes(words, k)
            if not len(g):
                continue
            p = np.flatnonzero(self.maybe[(g >> np.uint64(44)).astype(np.int64)])
            p = p[of[p] == of[p + k - 1]]
            at = np.minimum(np.searchsorted(self.distinct, g[p]), len(self.distinct) - 1)
            fine = self.distinct[at] == g[p]
            out.append((p[fine], at[fine]))
        p = np.concatenate([x for x, _ in out]) if out else np.zeros(0, np.int64)
        g = np.concatenate([x for _, x in out]) if out else np.zeros(0, np.int64)
        order = np.argsort(p, kind="stable")
        return of[p[order]] if len(p) else p, p[order], g[order]


def windows(items: Items, pos: np.ndarray, gram: np.ndarray, lo: int, hi: int) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """(item, start, end, n-grams hit) of the windows of one text (words lo to hi) around its hits."""
    a = np.searchsorted(items.gram, items.distinct[gram], "left")
    b = np.searchsorted(items.gram, items.distinct[gram], "right")
    n = b - a
    which = np.repeat(np.arange(len(gram)), n)
    entry = np.repeat(a - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    item, off = items.item[entry], items.at[entry]
    m = np.array([len(w) for w in items.words], np.int64)[item]
    slack = m // 4 + 2
    s, e = np.maximum(lo, pos[which] - off - slack), np.minimum(hi, pos[which] - off + m + slack)
    order = np.lexsort((s, item))
    item, s, e, g = item[order], s[order], e[order], gram[which[order]]
    k = 0
    while k < len(item):
        j, end = k + 1, e[k]
        while j < len(item) and item[j] == item[k] and s[j] <= end:
            end = max(end, e[j])
            j += 1
        yield int(item[k]), int(s[k]), int(end), np.unique(g[k:j])
        k = j


def align(item: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best Smith-Waterman score of the item in each row of ``texts`` and the column where it ends.

    A row of the table is one step for all texts: gaps along it are a running
    maximum, because a gap costs the same for every word.
    """
    n, width = texts.shape
    ramp = np.arange(width, dtype=np.int32) * -GAP
    before = np.zeros((n, width + 1), np.int32)
    best, end = np.zeros(n, np.int32), np.zeros(n, np.int64)
    for w in item:
        now = before[:, :-1] + np.where(texts == w, np.int32(MATCH), np.int32(MISMATCH))
        np.maximum(now, before[:, 1:] + GAP, out=now)
        np.maximum(now, 0, out=now)
        now = np.maximum.accumulate(now + ramp, axis=1) - ramp
        at = now.argmax(axis=1)
        top = now[np.arange(n), at]
        end = np.where(top > best, at, end)
        best = np.maximum(best, top)
        before[:, 1:] = now
    return best, end


def _batches(found: list[tuple[int, np.ndarray]], cells: int = 1 << 21) -> Iterator[list[int]]:
    """Indices of windows of one item each, similar in length, about ``cells`` words in all."""
    order = sorted(range(len(found)), key=lambda i: (found[i][0], len(found[i][1])))
    k = 0
    while k < len(order):
        j = k + 1
        while j < len(order) and found[order[j]][0] == found[order[k]][0] and (j + 1 - k) * len(found[order[j]][1]) <= cells and len(found[order[j]][1]) <= 2 * len(found[order[k]][1]):
            j += 1
        yield order[k:j]
        k = j


_NO_WORD = np.uint64(0)


def align_all(items: list[np.ndarray], found: list[tuple[int, np.ndarray]]) -> list[tuple[float, int, int]]:
    """(score from 0 to 1, first word, end) of each (item, window words)."""
    out: list = [None] * len(found)
    for rows in _batches(found):
        item = items[found[rows[0]][0]]
        size = np.array([len(found[i][1]) for i in rows])
        texts = np.full((len(rows), int(size.max())), _NO_WORD)
        back = texts.copy()
        for r, i in enumerate(rows):
            texts[r, : size[r]] = found[i][1]
            back[r, : size[r]] = found[i][1][::-1]
        best, end = align(item, texts)
        _, start = align(item[::-1], back)
        for r, i in enumerate(rows):
            out[i] = (float(best[r]) / (MATCH * len(item)), int(size[r] - 1 - start[r]), int(end[r]) + 1)
    return out


def contaminated(docs: DataFrame, items: DataFrame, n: int = N, min_score: float = MIN_SCORE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """A row per contaminated document and item: doc_id, text_key, item_id, score, word_start, word_end (words of letters and digits)."""
    spark = docs.sparkSession
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text")).where(F.col("text").isNotNull()).distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-int(size) // block_bytes))
    found = None
    for k in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).toArrow()  # about block_bytes of text
        part = _block(docs, Items(rows["item_id"].to_pylist(), rows["text"].to_pylist(), n), min_score)
        found = part if found is None else found.union(part)
    best = found.groupBy("doc_id", "row", "text_key", "item_id").agg(F.max_by(F.struct("score", "word_start", "word_end"), F.struct("score", -F.col("word_start"))).alias("x"))
    return best.select("doc_id", "text_key", "item_id", "x.*")


def _block(docs: DataFrame, items: Items, min_score: float) -> DataFrame:
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(vars(items))

    def seek(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items.of(held.value)
        total = np.zeros(len(items.distinct), np.int64)
        for b in batches:
            ids, keys, line = b.column("doc_id"), b.column("text_key"), b.column("row")
            for first, _, data, offs in text_slices(b, "text"):
                starts, ends, before = word_spans(data, offs, LETTERS)
                words = word_hashes(data, starts, ends, lower=True)
                of, pos, gram = items.hits(words, before)
                at, times = np.unique(gram, return_counts=True)
                total[at] += times
                out = []
                bounds = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1], [True]])) if len(of) else []
                for x, y in zip(bounds[:-1], bounds[1:], strict=True):
                    t = int(of[x])
                    lo, hi = int(before[t]), int(before[t + 1])
                    for item, s, e, g in windows(items, pos[x:y], gram[x:y], lo, hi):
                        out.append((ids[first + t].as_py(), line[first + t].as_py(), keys[first + t].as_py(), item, s - lo, words[s:e].tobytes(), g.astype("<i8").tobytes()))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["doc_id", "row", "text_key", "item", "start", "words", "grams"])
        seen = np.flatnonzero(total)
        for k in range(0, len(seen), 1 << 16):  # the occurrences of the task, beside its windows
            at = seen[k : k + (1 << 16)]
            yield pa.RecordBatch.from_pylist([{"item": COUNTS, "words": total[at].astype("<i8").tobytes(), "grams": at.astype("<i8").tobytes()}], _NEAR)

    near = cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.xxhash64("text").alias("text_key"), "text").mapInArrow(seek, "doc_id long, row long, text_key long, item long, start long, words binary, grams binary"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for g, n in zip(b.column("grams"), b.column("words"), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(x.as_buffer(), "<i8")) for x in (g, n)], names=["gram", "n"])

    times = np.zeros(len(items.distinct), np.int64)
    counted = near.where(F.col("item") == COUNTS).select("grams", "words").mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()  # the n-grams of a block
    times[counted["gram"].to_numpy()] = counted["n"].to_numpy()
    seeds = spark.sparkContext.broadcast(rare_seeds(items, times))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, rare = Items.of(held.value), seeds.value
        for b in batches:
            if not b.num_rows:
                continue
            item = b.column("item").to_numpy()
            kept = [i for i, x in enumerate(b.column("grams")) if rare[item[i]].intersection(np.frombuffer(x.as_buffer(), "<i8").tolist())]
            got = align_all(items.words, [(int(item[i]), np.frombuffer(b.column("words")[i].as_buffer(), np.uint64)) for i in kept])
            out = [(i, *x) for i, x in zip(kept, got, strict=True) if x[0] >= min_score]
            if out:
                i, s, lo, hi = (list(c) for c in zip(*out, strict=True))
                at = b.column("start").to_numpy()[i]
                yield pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(i)), b.column("row").take(pa.array(i)), b.column("text_key").take(pa.array(i)), pa.array([items.ids[item[k]] for k in i], pa.int64()), pa.array(s), pa.array(at + lo), pa.array(at + hi)], names=["doc_id", "row", "text_key", "item_id", "score", "word_start", "word_end"])

    return near.where(F.col("item") != COUNTS).repartition("doc_id", "item").mapInArrow(score, "doc_id long, row long, text_key long, item_id long, score double, word_start long, word_end long")


def rare_seeds(items: Items, times: np.ndarray, rare: float = RARE) -> list[set[int]]:
    """For each item the n-grams that the corpus holds at most ``rare`` times as often as its median one."""
    out: list[set[int]] = [set() for _ in items.words]
    own = np.searchsorted(items.distinct, items.gram)
    order = np.argsort(items.item, kind="stable")
    at = np.searchsorted(items.item[order], np.arange(len(items.words) + 1))
    for i in range(len(items.words)):
        g = own[order[at[i] : at[i + 1]]]
        if len(g):
            out[i] = set(g[times[g] <= rare * max(1.0, float(np.median(times[g])))].tolist())
    return out


def contamination_report(docs: DataFrame, items: DataFrame) -> DataFrame:
    return contaminated(docs, items).drop("text_key")


def drop_contaminated(docs: DataFrame, items: DataFrame, **kw) -> DataFrame:
    """The documents without the contaminated ones, with all their columns."""
    d, k = unused(docs, "bad_id", "bad_key")
    bad = contaminated(docs.select("doc_id", "text"), items, **kw).select(F.col("doc_id").alias(d), F.col("text_key").alias(k)).distinct()
    return docs.join(bad, F.col("doc_id").cast("long").eqNullSafe(F.col(d)) & (F.xxhash64("text") == F.col(k)), "left_anti")
