"""Substring dedup over bytes with suffix arrays built by linear grouping.

Sampled suffixes meet in groups (``repeats.py``).  Each task writes what follows
its suffixes as one string over ranks of ``PIECE``-byte pieces, sorts that
string's suffixes in linear time, and reads the order of its suffixes off the
array.  Neighbours in it share the longest prefixes, so repeated windows are
runs of the array; of each class all but the earliest are removed.

The sort (``suffix_array``) has two phases.  First the suffixes are grouped by
their longest Lyndon prefix: groups are taken in descending order, and the
previous smaller suffix of each member moves up within its own group, further
the more members point to it.  Then each group's order is emitted by one
ascending pass: the suffixes whose next smaller suffix has just been placed take
the next places of their groups.  Nothing is renamed and nothing recurses.

Cases: a null text is empty; a text shorter than a window keeps all; copies and
overlaps within one text count; rows with one doc_id are ordered by a hash of
their text, rows equal in id and text are each as if they were that one row; a
null doc_id counts as the largest; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .repeats import Windows, covered_ranges, keyed, marked, neighbour_lcp

WINDOW = Windows(width=100, gram=24, words=False, strict=False)
#: Bytes of a symbol of the sorted string.
PIECE = 25


def lyndon_groups(s: list[int]) -> tuple[list[int], list[int], list[int]]:
    """(suffixes by group, first place of each suffix's group, previous smaller suffix or -1).

    ``s`` ends with a symbol smaller than all others.
    """
    n = len(s)
    sa = sorted(range(n), key=s.__getitem__)  # by first symbol: the groups to begin with
    place = [0] * n
    start = [0] * n
    size = [0] * n  # of the group that begins here
    g = 0
    for k in range(n):
        i = sa[k]
        if s[i] != s[sa[g]]:
            g = k
        place[i] = k
        start[i] = g
        size[g] += 1
    prev = [-1] * n
    end = n
    while end > 0:
        first = start[sa[end - 1]]
        members = sorted(sa[first:end]) if end - first > 1 else sa[first:end]
        count: dict[int, int] = {}
        for i in members:
            j = i - 1
            while j >= 0 and place[j] >= first:  # this group or a higher one: not smaller
                j = prev[j]
            prev[i] = j
            if j >= 0:
                count[j] = count.get(j, 0) + 1
        # Move the ones pointed to up in their groups; those pointed to more often end higher.
        moved: dict[int, dict[int, list[int]]] = {}
        for j, c in count.items():
            moved.setdefault(start[j], {}).setdefault(c, []).append(j)
        for g, levels in moved.items():
            top = g + size[g]
            for c in sorted(levels, reverse=True):
                js = levels[c]
                for j in js:
                    top -= 1
                    k, other = place[j], sa[top]
                    sa[k], sa[top] = other, j
                    place[other], place[j] = k, top
                for j in js:
                    start[j] = top
                size[top] = len(js)
            if top > g:
                size[g] = top - g
        end = first
    return sa, start, prev


def suffix_array(symbols: list[int]) -> list[int]:
    """Suffixes of a list of positive integers in ascending order; a suffix that is another's prefix comes first."""
    s = [*symbols, 0]
    sa, start, prev = lyndon_groups(s)
    n = len(s)
    nxt = start  # the next free place of each group, kept at the group's first place
    free = list(range(n))
    out = [-1] * n
    done = [False] * n
    out[0] = n - 1
    done[n - 1] = True
    for k in range(n):
        j = out[k] - 1
        while j >= 0 and not done[j]:
            g = nxt[j]
            out[free[g]] = j
            free[g] += 1
            done[j] = True
            j = prev[j]
    return out[1:]


def array_order(right: np.ndarray, n_right: np.ndarray, prefix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order of the suffixes by what follows them, symbols that neighbours share)."""
    n, width = right.shape
    wide = np.zeros((n, -(-width // PIECE) * PIECE), np.int16)
    wide[:, :width] = right + 1
    pieces = np.ascontiguousarray(wide.astype(">u2")).view(f"V{2 * PIECE}")
    _, rank = np.unique(pieces.ravel(), return_inverse=True)
    per = pieces.shape[1]
    string = np.ones((n, per + 1), np.int64)  # 1 ends each suffix's piece of the string
    string[:, :per] = rank.reshape(n, per) + 2
    order = np.array([i // (per + 1) for i in suffix_array(string.ravel().tolist()) if i % (per + 1) == 0], np.int64)
    return order, neighbour_lcp(right, order)


def dedup_bytes(docs: DataFrame, win: Windows = WINDOW) -> DataFrame:
    """doc_id, text, ranges: the byte ranges of each row that repeat an earlier window."""
    rows = keyed(docs)
    out = rows.join(covered_ranges(rows, win, array_order), ["doc", "tag"], "left")
    return out.select(F.when(F.col("doc") != (1 << 63) - 1, F.col("doc")).alias("doc_id"), "text", "ranges")


def strip_bytes(text: bytes, ranges: list[dict] | None) -> tuple[int, int, int, bytes]:
    """(bytes, bytes removed, removed runs, what is kept)."""
    if not ranges:
        return len(text), 0, 0, text
    gone = marked(len(text), ranges)
    runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return len(text), int(gone.sum()), runs, np.frombuffer(text, np.uint8)[~gone].tobytes()


def bytes_report(docs: DataFrame, win: Windows = WINDOW) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for t, ranges in zip(b.column("text"), b.column("ranges").to_pylist(), strict=True):
                n, gone, runs, kept = strip_bytes(t.as_py().encode("utf-8"), ranges)
                out.append((n, gone, runs, hashlib.sha256(kept).hexdigest()))
            if out:
                n, gone, runs, digest = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(runs, pa.int64()), pa.array(digest)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return dedup_bytes(docs, win).mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
