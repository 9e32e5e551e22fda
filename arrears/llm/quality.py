"""Quality classifier: naive Bayes support vectors.

Texts become indicators of hashed n-grams (bytes and words).  Every indicator is
scaled by the class log-count ratio of its n-gram, and a linear hinge-loss model
is fitted on the scaled indicators by dual coordinate descent.  A logistic curve
fitted on the same rows turns margins into scores between 0 and 1.

The fit sees a bounded sample of the labelled rows, ``MAX_TRAIN`` of them picked
by hash of the id (a documented parameter); all documents are scored.  Only the
text is an input of a score.

Cases: a null or empty text has no indicators and is scored by the intercept;
labels that contradict each other for one id, null labels and ids without a
document are not learned from; repeated rows are scored alike, each with its
row; without labels of both classes every score is 0.5; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from .common import _BYTE, cut, gram_hashes, mix, text_slices, unused, word_hashes, word_spans

#: Labelled rows that the fit may use at most.
MAX_TRAIN = 10_000
#: Bits of the hashed n-gram space.
BITS = 18
#: A document is kept where its score is at least this.
THRESHOLD = 0.3
COST = 1.0


def indicators(data: np.ndarray, offs: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(features, offsets): the distinct hashed n-grams of each text, sorted.

    Byte n-grams of 1 to 4, word n-grams of 1 and 2, and n-grams of 1 to 6 of the
    pattern that tells of each word whether it repeats the word before; one space for all.
    """
    n = len(offs) - 1
    doc = np.repeat(np.arange(n), np.diff(offs))
    shift = np.uint64(64 - bits)
    parts = []
    v = np.zeros(len(data), np.uint64)
    for k in range(1, 5):
        if len(data) < k:
            break
        v = v[: len(data) - k + 1] * np.uint64(257) + data[k - 1 :].astype(np.uint64) + np.uint64(1)
        h = (mix(v + _BYTE[k]) >> shift).astype(np.int64) if k > 2 else (mix(np.arange(1 << (9 * k), dtype=np.uint64) + _BYTE[k]) >> shift).astype(np.int64)[v.astype(np.int64)]
        same = doc[: len(h)] == doc[k - 1 :]
        parts.append(_distinct((doc[: len(h)] << bits | h)[same]))
    starts, ends, before = word_spans(data, offs)
    words = word_hashes(data, starts, ends)
    of = np.repeat(np.arange(n), np.diff(before))
    for k in (1, 2):
        h = (mix(gram_hashes(words, k) + _BYTE[8 + k]) >> shift).astype(np.int64)
        m = of[: len(h)] == of[k - 1 :] if len(h) else np.zeros(0, bool)
        parts.append(_distinct((of[: len(h)] << bits | h)[m]))
    again = np.zeros(len(words), np.uint64)
    again[1:] = words[1:] == words[:-1]
    pattern = np.zeros(len(words), np.int64)
    for k in range(1, 7):  # a text's first word repeats none, so its patterns begin with the second
        pattern = pattern[: len(words) - k] * 2 + again[k:].astype(np.int64) if len(words) > k else pattern[:0]
        h = (mix(np.arange(1 << k, dtype=np.uint64) + _BYTE[16 + k]) >> shift).astype(np.int64)[pattern]
        m = of[: len(h)] == of[k:] if len(h) else np.zeros(0, bool)
        parts.append(_distinct((of[: len(h)] << bits | h)[m]))
    key = _distinct(np.concatenate(parts)) if parts else np.zeros(0, np.int64)
    return key & ((1 << bits) - 1), np.searchsorted(key, np.arange(n + 1, dtype=np.int64) << bits)


def _distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x


def log_count_ratio(rows: list[np.ndarray], y: np.ndarray, size: int) -> np.ndarray:
    """log of (share of the n-gram in class 1 / share in class 0), counts smoothed by one."""
    good, bad = np.ones(size), np.ones(size)
    for x, label in zip(rows, y, strict=True):
        (good if label else bad)[x] += 1
    return np.log(good / good.sum()) - np.log(bad / bad.sum())


def dual_descent(rows: list[np.ndarray], ratio: np.ndarray, y: np.ndarray, cost: float = COST, rounds: int = 12, seed: int = 5) -> tuple[np.ndarray, float]:
    """Weights (for scaled indicators) and intercept of the hinge-loss model, by coordinate descent on its dual.

    A row's indicators are scaled by ``ratio`` and the root of their number.  Each
    step sets one row's multiplier to its best value between 0 and the cost while
    the weights are kept up.
    """
    rng = np.random.default_rng(seed)
    w, b = np.zeros(len(ratio)), 0.0
    sign = np.where(y, 1.0, -1.0)
    alpha = np.zeros(len(y))
    norm = np.array([max(1.0, np.sqrt(len(x))) for x in rows])
    square = np.array([float(ratio[x] @ ratio[x]) / r**2 + 1.0 for x, r in zip(rows, norm, strict=True)])
    for _ in range(rounds):
        moved = 0.0
        for i in rng.permutation(len(y)):
            x = rows[i]
            scaled = ratio[x] / norm[i]
            g = sign[i] * (float(w[x] @ scaled) + b) - 1.0
            new = min(max(alpha[i] - g / square[i], 0.0), cost)
            d = (new - alpha[i]) * sign[i]
            if d:
                w[x] += d * scaled
                b += d
                alpha[i] = new
                moved = max(moved, abs(d))
        if moved < 1e-3 * cost:
            break
    return w, b


def logistic_curve(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(a, c) of 1 / (1 + exp(-(a m + c))) by Newton steps on the smoothed labels."""
    t = np.where(y, (y.sum() + 1) / (y.sum() + 2), 1 / ((~y).sum() + 2))
    a, c = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + c, -40, 40)))
        r, h = p - t, np.maximum(p * (1 - p), 1e-9)
        grad = np.array([r @ margin + 1e-3 * a, r.sum()])
        hess = np.array([[h @ margin**2 + 1e-3, h @ margin], [h @ margin, h.sum() + 1e-9]])
        step = np.linalg.solve(hess, grad)
        size = min(1.0, 2.0 / (np.abs(step).max() + 1e-12))
        a, c = a - size * step[0], c - size * step[1]
        if np.abs(step).max() < 1e-6:
            break
    return max(float(a), 1e-6), float(c)


def _rows(data: np.ndarray, offs: np.ndarray, bits: int) -> list[np.ndarray]:
    f, at = indicators(data, offs, bits)
    return [f[at[i] : at[i + 1]] for i in range(len(at) - 1)]


def fit(train: DataFrame, bits: int = BITS, cost: float = COST) -> dict | None:
    """Model of (doc_id, text, label) rows, at most ``MAX_TRAIN`` of them; None without both classes.

    Many tasks make the indicators; one takes the bounded sample's and descends. The driver gets the model alone.
    """

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, offs in text_slices(b, "text"):
                blobs = [x.astype("<i4").tobytes() for x in _rows(data, offs, bits)]
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(lo, hi - lo), b.column("label").slice(lo, hi - lo), pa.array(blobs, pa.binary())], names=["doc_id", "label", "f"])

    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = sorted(((d, label, np.frombuffer(f, "<i4")) for b in batches for d, label, f in zip(*[b.column(c).to_pylist() for c in ("doc_id", "label", "f")], strict=True)), key=lambda r: r[0])
        y = np.array([label == 1 for _, label, _ in got], bool)
        if not len(y) or y.all() or not y.any():
            return
        rows = [x for _, _, x in got]
        ratio = log_count_ratio(rows, y, 1 << bits)
        w, c0 = dual_descent(rows, ratio, y, cost)
        weights = w * ratio
        margin = np.array([float(weights[x].sum()) / max(1.0, np.sqrt(len(x))) + c0 for x in rows])
        a, c = logistic_curve(margin, y)
        yield pa.RecordBatch.from_arrays([pa.array([weights.astype("<f4").tobytes()], pa.binary()), pa.array([c0]), pa.array([a]), pa.array([c])], names=["weights", "b", "a", "c"])

    sample = train.mapInArrow(features, "doc_id long, label int, f binary").repartition(1)
    model = sample.mapInArrow(descend, "weights binary, b double, a double, c double").first()
    if model is None:
        return None
    return {"weights": np.frombuffer(bytes(model["weights"]), "<f4"), "b": model["b"], "a": model["a"], "c": model["c"], "bits": bits}


def training_rows(docs: DataFrame, labels: DataFrame, label: str = "quality", max_train: int = MAX_TRAIN) -> DataFrame:
    """(doc_id, text, label) of the bounded sample: ids whose crc32 modulo 5 is not 0, smallest hashes first."""
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    known = known.agg(F.min(label).alias("label"), F.max(label).alias("_hi")).where("label = _hi").drop("_hi")
    known = known.where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    picked = cut(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train).select("doc_id", F.col("label").cast("int").alias("label")))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(picked), "doc_id")  # at most max_train ids
    return texts.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label"))


def score(docs: DataFrame, model: dict | None, name: str = "score") -> DataFrame:
    """``docs`` with the score in a column ``name``."""
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for b in batches:
            out = np.full(b.num_rows, 0.5)
            if m is not None:
                for lo, hi, data, offs in text_slices(b, "text"):
                    f, at = indicators(data, offs, m["bits"])
                    total = np.concatenate([[0.0], np.cumsum(m["weights"][f], dtype=np.float64)])
                    n = np.diff(at)
                    margin = (total[at[1:]] - total[at[:-1]]) / np.maximum(1.0, np.sqrt(n)) + m["b"]
                    out[lo:hi] = 1 / (1 + np.exp(-np.clip(m["a"] * margin + m["c"], -40, 40)))
            yield b.append_column(name, pa.array(out))

    if name in docs.columns:
        raise ValueError(f"the documents have a column {name}; give the score another name")
    return docs.mapInArrow(run, StructType([*docs.schema.fields]).add(name, DoubleType()))


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    model = fit(training_rows(docs, labels))
    s = score(docs.select("doc_id", "text"), model)
    out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    return s.select("doc_id", F.coalesce(out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the classifier accepts, with all their columns, whatever these are called."""
    (own,) = unused(docs, "_quality_score")
    return score(docs, fit(training_rows(docs, labels)), own).where(F.col(own) >= threshold).drop(own)
