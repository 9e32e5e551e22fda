"""Substring dedup over words with prefix-partitioned suffix trees.

Suffixes are dealt to groups by prefixes of variable length (``repeats.py``:
a gram of words, lengthened where a group would not fit in memory).  Every
group's suffixes form one compressed tree; an internal node is a word sequence
that all leaves below share, as long as the node is deep.  The tree gives the
suffixes' order and common prefixes only; the repeats are the hashed classes of
windows that ``repeats.py`` forms from those, with the words to the left of the
sampled suffixes, and of the windows in a class all but those of the smallest
doc_id are removed.

Cases: a null or empty text has no words; a text shorter than a window keeps
all; copies (also of the same id with another text) are compared like any other
rows, rows equal in id and text get equal results; a null doc_id counts as the
largest; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .repeats import Windows, covered_ranges, keyed, marked, neighbour_lcp

WINDOW = Windows(width=50, gram=14, words=True, strict=True)


class SuffixTree:
    """The compressed tree of a group's suffixes, built from their order in one pass.

    Node k spans the leaves ``lo[k]`` to ``hi[k]`` (exclusive, in order), and all share ``depth[k]`` symbols.
    """

    def __init__(self, right: np.ndarray):
        rows = np.ascontiguousarray(right.astype(">u4"))
        flat = rows.tobytes()
        step = rows.shape[1] * 4
        self.order = np.array(sorted(range(len(rows)), key=lambda i: flat[i * step : (i + 1) * step]), np.int64)
        self.lcp = neighbour_lcp(right, self.order)
        self.depth, self.lo, self.hi = self._nodes()

    def _nodes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Internal nodes: the rightmost path stands on a stack, a shallower neighbour closes what is deeper."""
        depth, lo, hi = [], [], []
        stack = [(0, 0)]
        for i, d in enumerate([*self.lcp.tolist(), 0], 1):
            start = i - 1
            while stack and stack[-1][0] > d:
                k, start = stack.pop()
                depth.append(k)
                lo.append(start)
                hi.append(i)
            if not stack or stack[-1][0] < d:
                stack.append((d, start))
        return np.array(depth, np.int64), np.array(lo, np.int64), np.array(hi, np.int64)

    def joined(self, least: int) -> np.ndarray:
        """For each pair of neighbours what they share below the nodes at least ``least`` deep, else 0."""
        out = np.zeros(len(self.lcp), np.int64)
        deep = np.flatnonzero(self.depth >= least)
        for k in deep[np.argsort(self.depth[deep], kind="stable")]:  # deeper nodes are inside and come later
            out[self.lo[k] : self.hi[k] - 1] = self.depth[k]
        return out


def tree_order(right: np.ndarray, n_right: np.ndarray, prefix: np.ndarray, win: Windows = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(order of the suffixes, depth of the node that joins neighbours) of the groups of a task: their trees hang under one root."""
    tree = SuffixTree(right)
    return tree.order, tree.joined(win.gram)


def dedup_windows(docs: DataFrame, win: Windows = WINDOW) -> DataFrame:
    """doc_id, text, ranges: the word ranges of each row that repeat a window of a smaller doc_id."""
    rows = keyed(docs)
    found = covered_ranges(rows, win, lambda right, n_right, prefix: tree_order(right, n_right, prefix, win))
    out = rows.join(found, ["doc", "tag"], "left")
    return out.select(F.when(F.col("doc") != (1 << 63) - 1, F.col("doc")).alias("doc_id"), "text", "ranges")


def strip_words(text: bytes, ranges: list[dict] | None) -> tuple[int, int, bytes]:
    """(words, words removed, what is kept joined by a space)."""
    words = text.split()
    if not ranges:
        return len(words), 0, b" ".join(words)
    gone = marked(len(words), ranges)
    return len(words), int(gone.sum()), b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g])


def windows_report(docs: DataFrame, win: Windows = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for t, ranges in zip(b.column("text"), b.column("ranges").to_pylist(), strict=True):
                n, gone, kept = strip_words(t.as_py().encode("utf-8"), ranges)
                out.append((n, gone, hashlib.sha256(kept).hexdigest()))
            if out:
                n, gone, digest = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(digest)], names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    return dedup_windows(docs, win).mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")
