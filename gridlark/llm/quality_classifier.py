"""Quality classifier: random Fourier features, ridge regression from summed normal equations, isotonic calibration.

Each text becomes ``len(STATS)`` whole-text statistics, standardized by the training rows. ``FEATURES`` random Fourier features
approximate a Gaussian kernel on them; nothing but these features and a constant enters the regression. Each partition sums its normal equations for each of
``FOLDS`` folds of the training rows (matrices of fixed size, independent of the rows), the sums are added in a tree, and the ridge weights are
solved on the driver: of all rows, and of all but each fold. Raw scores of each fold's rows, by the weights that haven't seen it, are counted in
``SCORE_BINS`` fixed bins with their labels, and pool-adjacent-violators over the bins gives the calibration. Each bin holds ``PSEUDO`` of a row at the
labels' mean beforehand, so the curve never decreases and a score is never quite 0 or 1.

Labels are learned from rows whose ``crc32(doc_id as text) mod 3`` is not 1. Language, source, id and labels are never inputs of a score.

Defined cases: a null text is empty and is scored as such; a null label or id doesn't train, and a row without an id is scored, as not held out; a document
labelled twice trains twice; repeated rows are scored each; extra columns are ignored; without training rows (or none of one label) every score is
0.5; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, raw_texts, slices

FEATURES = 256
GAMMA = 0.05  # of the kernel exp(-gamma |x-y|^2) on standardized statistics
RIDGE = 1.0
SCORE_BINS = 512
FOLDS = 4
PSEUDO = 1 / 64
STATS = ["log_words", "log_chars", "upper", "digit", "symbol", "punct", "exclaim", "newline", "space", "high", "word_len", "word_len_sd", "distinct", "distinct_pairs", "distinct_lines", "top_word", "entropy", "adjacent_equal"]

_CLASS = np.zeros(256, np.int64)  # 0: other
for _k, _chars in enumerate([b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#*$%&|<>@^~=+_\\{}[]/", b".,;:?'\"()-", b"!", b"\n", b" \t\r\x0b\x0c", bytes(range(128, 256))], 1):
    for _c in _chars:
        _CLASS[_c] = _k


def _counts(keys: np.ndarray) -> np.ndarray:
    """How often each distinct key occurs."""
    if not len(keys):
        return np.zeros(0, np.int64)
    s = np.sort(keys)
    at = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1], [True]]))
    return np.diff(at)


def text_stats(text: bytes) -> np.ndarray:
    """The statistics of a whole text; zeros where it has no words."""
    out = np.zeros(len(STATS))
    words = text.split()
    if not words:
        return out
    data = np.frombuffer(text, np.uint8)
    histogram = np.bincount(data, minlength=256)
    kinds = np.bincount(_CLASS, weights=histogram, minlength=9) / len(data)
    p = histogram[histogram > 0] / len(data)
    h = np.fromiter(map(hash_word, words), np.int64, len(words))
    length = np.fromiter(map(len, words), np.int64, len(words))
    counts = _counts(h)
    pairs = _counts(h[1:] * 31 + h[:-1])
    lines = [x for x in text.split(b"\n") if x.strip()]
    out[:2] = np.log1p(len(words)), np.log1p(len(data))
    out[2:10] = kinds[1:9]
    out[10:12] = length.mean(), length.std()
    out[12] = len(counts) / len(words)
    out[13] = len(pairs) / max(1, len(words) - 1)
    out[14] = len(set(lines)) / len(lines)
    out[15] = counts.max() / len(words)
    out[16] = -(p * np.log2(p)).sum()
    out[17] = (h[1:] == h[:-1]).mean() if len(h) > 1 else 0
    return out


def hash_word(word: bytes) -> int:
    from xxhash import xxh3_64_intdigest

    return xxh3_64_intdigest(word) >> 1


def _stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text"):
            x = [text_stats(t) for t in raw_texts(batch)]
            yield pa.record_batch([batch.column("doc_id"), pa.array(x, pa.list_(pa.float64()))], names=["doc_id", "x"])


def fourier(seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.normal(size=(len(STATS), FEATURES)) * np.sqrt(2 * GAMMA), rng.uniform(0, 2 * np.pi, FEATURES)


def _lift(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    w, b = fourier()
    z = np.clip((x - mean) / scale, -8, 8)
    return np.concatenate([np.cos(z @ w + b) * np.sqrt(2 / FEATURES), np.ones((len(x), 1))], 1)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.asarray(batch.column("x").flatten()).reshape(-1, len(STATS))


def _summed(rows: DataFrame, per_batch, size: int) -> np.ndarray:
    """Sum over all batches of ``per_batch(batch)``, a vector of fixed size: by partition, then in groups of partitions, then on the driver."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += per_batch(batch)
        yield pa.record_batch([pa.array([total.tobytes()], pa.binary())], names=["v"])

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for v in batch.column("v").to_pylist():
                total += np.frombuffer(v)
        yield pa.record_batch([pa.array([total.tobytes()], pa.binary())], names=["v"])

    parts = rows.mapInArrow(partial, "v binary")
    width = max(1, int(np.sqrt(max(1, rows.rdd.getNumPartitions()))))
    sums = parts.repartition(width).mapInArrow(merged, "v binary")
    return sum((np.frombuffer(r.v) for r in sums.toLocalIterator()), np.zeros(size))


def isotonic(total: np.ndarray, good: np.ndarray) -> np.ndarray:
    """Non-decreasing means by pool-adjacent-violators, each bin holding ``PSEUDO`` of a row at the mean besides its own."""
    mean = good.sum() / total.sum() if total.sum() else 0.5
    blocks: list[tuple[float, float, int]] = []
    for n, g in zip(total + PSEUDO, good + PSEUDO * mean, strict=True):
        k = 1
        while blocks and blocks[-1][0] * n >= g * blocks[-1][1]:
            g2, n2, k2 = blocks.pop()
            g, n, k = g + g2, n + n2, k + k2
        blocks.append((g, n, k))
    return np.maximum.accumulate(np.concatenate([np.full(k, g / n) for g, n, k in blocks]))


def solved(sums: np.ndarray) -> np.ndarray:
    """Ridge weights from summed normal equations; the constant isn't penalized."""
    size = FEATURES + 1
    penalty = np.full(size, RIDGE)
    penalty[-1] = 1e-6
    return np.linalg.solve(sums[: size * size].reshape(size, size) + np.diag(penalty), sums[size * size :])


def _bin(raw: np.ndarray) -> np.ndarray:
    return np.clip(((raw + 0.5) / 2 * SCORE_BINS).astype(np.int64), 0, SCORE_BINS - 1)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def classify(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each document; labels are ``(doc_id, quality)``."""
    scratch = Scratch(spark, "classifier")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    stats = scratch.save(rows.mapInArrow(_stats, "doc_id long, x array<double>"), "stats")
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("y")).where("y is not null and doc_id is not null")
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).alias("fold")
    train = scratch.save(stats.join(known.where(~held_out(F.col("doc_id"))), "doc_id").select("x", "y", fold), "train")
    d = len(STATS)

    def moments(batch: pa.RecordBatch) -> np.ndarray:
        x, y = _matrix(batch), np.asarray(batch.column("y"))
        return np.concatenate([[len(x), y.sum()], x.sum(0), (x * x).sum(0)])

    n, positive, *rest = _summed(train, moments, 2 + 2 * d)
    fallback = n == 0 or positive in (0, n)
    mean, square = np.array(rest[:d]) / max(n, 1), np.array(rest[d:]) / max(n, 1)
    scale = np.sqrt(np.maximum(square - mean * mean, 1e-12)) + 1e-6
    size = FEATURES + 1
    # Labels weigh as if both were equally many, so a rare label isn't drowned.
    weight = np.array([n / max(2 * (n - positive), 1), n / max(2 * positive, 1)])

    def equations(batch: pa.RecordBatch) -> np.ndarray:
        z, y, fold = _lift(_matrix(batch), mean, scale), np.asarray(batch.column("y")), np.asarray(batch.column("fold"))
        zw = z * weight[(y > 0.5).astype(int)][:, None]
        return np.concatenate([part for k in range(FOLDS) for part in ((z[fold == k].T @ zw[fold == k]).ravel(), zw[fold == k].T @ y[fold == k])])

    beta, curve = np.zeros(size), np.full(SCORE_BINS, 0.5)
    if not fallback:
        sums = _summed(train, equations, FOLDS * (size * size + size)).reshape(FOLDS, -1)
        beta, unseen = solved(sums.sum(0)), np.stack([solved(sums.sum(0) - x) for x in sums])

        def tally(batch: pa.RecordBatch) -> np.ndarray:
            z, y, fold = _lift(_matrix(batch), mean, scale), np.asarray(batch.column("y")), np.asarray(batch.column("fold"))
            at = _bin((z * unseen[fold]).sum(1))
            return np.concatenate([np.bincount(at, minlength=SCORE_BINS), np.bincount(at, weights=y, minlength=SCORE_BINS)])

        counts = _summed(train, tally, 2 * SCORE_BINS)
        curve = isotonic(counts[:SCORE_BINS], counts[SCORE_BINS:])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                s = curve[_bin(_lift(_matrix(batch), mean, scale) @ beta)]
                yield pa.record_batch([batch.column("doc_id"), pa.array(s)], names=["doc_id", "score"])

    scored = stats.mapInArrow(score, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
