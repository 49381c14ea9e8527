"""Quality scores: a regularised quadratic discriminant over transformed statistics of whole texts."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.session import materialize

STATISTICS = [
    "length", "words", "word_length", "word_spread", "upper", "digits", "symbols", "marks", "bars", "wide", "distinct_words", "top_word",
    "words_per_line", "distinct_lines", "ends_with_symbol", "sentence_ends", "capitals",
]
_UPPER, _DIGIT, _SPACE = slice(65, 91), slice(48, 58), [9, 10, 11, 12, 13, 32]
_SYMBOLS, _MARKS = list(b"#$%&*+<=>@\\^_`~{}[]"), list(b".,;:!?\"'()-/")


def statistics(text: str | None) -> list[float]:
    """Statistics of a whole text, each transformed to be roughly normal: logarithms of counts, square roots of shares.

    A null or empty text has the statistics of a text without words (all zero).
    """
    if not text:
        return [0.0] * len(STATISTICS)
    data = np.frombuffer(text.encode("utf-8"), np.uint8)
    seen = np.bincount(data, minlength=256)
    words = text.split()
    lines = text.split("\n")
    n, size = max(1, len(words)), len(data)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1)
    share = lambda x, of=size: math.sqrt(x / of)
    common = Counter(words)
    ends = Counter([w[-1] for w in words])
    symbols = set(map(chr, _SYMBOLS)) | {"!", "|"}
    return [
        math.log1p(len(text)), math.log1p(len(words)), math.log1p(float(sizes.mean())), math.log1p(float(sizes.std())), share(seen[_UPPER].sum()),
        share(seen[_DIGIT].sum()), share(seen[_SYMBOLS].sum()), share(seen[_MARKS].sum()), share(seen[124]), share(seen[128:].sum()),
        share(len(common), n), share(max(common.values(), default=0), n), math.log(n / len(lines)), share(len(set(lines)), len(lines)),
        share(sum(v for k, v in ends.items() if k in symbols), n), share(ends["."], n), share(sum(w[0].isupper() for w in words), n),
    ]


class Discriminant:
    """Two Gaussian densities with shrunk covariances; Cholesky factors are computed once.

    The covariance of a class is ``(1 - pooling - ridge) S_class + pooling S_pooled + ridge * diag(S_pooled)``, plus a
    tiny multiple of the identity. With no labelled row of one class all scores are the share of class 1 (0.5 with no
    labels at all).
    """

    def __init__(self, moments: dict[int, tuple[float, np.ndarray, np.ndarray]], pooling: float = 0.1, ridge: float = 0.05):
        counts = {c: moments[c][0] if c in moments else 0.0 for c in (0, 1)}
        total = counts[0] + counts[1]
        self.prior = counts[1] / total if total else 0.5
        self.classes = []
        if min(counts.values()) < 2:
            return
        means = {c: moments[c][1] / counts[c] for c in (0, 1)}
        scatter = {c: moments[c][2] - counts[c] * np.outer(means[c], means[c]) for c in (0, 1)}
        pooled = (scatter[0] + scatter[1]) / total
        for c in (0, 1):
            cov = (1 - pooling - ridge) * scatter[c] / counts[c] + pooling * pooled + ridge * np.diag(np.diag(pooled)) + 1e-6 * np.eye(len(pooled))
            factor = np.linalg.cholesky(cov)
            self.classes.append((means[c], factor, 2 * np.log(np.diag(factor)).sum(), math.log(counts[c] / total)))

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Probability of class 1: half the difference of Mahalanobis distances and log-determinants, plus the log prior ratio."""
        if not self.classes:
            return np.full(len(rows), self.prior)
        logs = []
        for mean, factor, determinant, prior in self.classes:
            z = np.linalg.solve(factor, (rows - mean).T)
            logs.append(prior - 0.5 * (np.square(z).sum(axis=0) + determinant))
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


def with_statistics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key and statistics of every row, written once, as fitting and scoring both read them."""
    kind = docs.schema[key].dataType.simpleString()

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [statistics(value.as_py()) for value in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.float64()))], [key, "statistics"])

    return materialize(docs.select(key, text).mapInArrow(measure, f"`{key}` {kind}, statistics array<double>"), "statistics")


def fit(measured: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", **shrinkage: float) -> Discriminant:
    """Moments of each class over all labelled rows in one aggregation; the fit itself needs only those sums."""
    d = len(STATISTICS)
    known = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).select(key, F.col(label).cast("int").alias("class"))
    x = [F.col("statistics")[i] for i in range(d)]
    sums = [F.sum(x[i]).alias(f"s{i}") for i in range(d)] + [F.sum(x[i] * x[j]).alias(f"s{i}_{j}") for i in range(d) for j in range(i, d)]
    moments = {}
    for row in measured.join(known, key).groupBy("class").agg(F.count(F.lit(1)).alias("n"), *sums).collect():
        square = np.zeros((d, d))
        for i in range(d):
            for j in range(i, d):
                square[i, j] = square[j, i] = row[f"s{i}_{j}"]
        moments[row["class"]] = (float(row["n"]), np.array([row[f"s{i}"] for i in range(d)]), square)
    return Discriminant(moments, **shrinkage)


def score(measured: DataFrame, model: Discriminant, key: str = "doc_id") -> DataFrame:
    """``measured`` with a column score: the probability of class 1."""
    kind = measured.schema[key].dataType.simpleString()

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(1).flatten().to_numpy().reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(rows), pa.float64())], [key, "score"])

    return measured.select(key, "statistics").mapInArrow(apply, f"`{key}` {kind}, score double")


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, folds: int = 4, held: int = 2, key: str = "doc_id") -> DataFrame:
    """Quality of every whole text, learnt from the labelled rows outside the held-out fold.

    A row is held out if crc32 of its key as text leaves ``held`` modulo ``folds``. Labels, language, source and key are
    never inputs. Every label row counts once, also where a key has several; labels other than 0 and 1 and null
    keys are left out of the fit. Rows without key are scored and not held out. Empty and null texts get the
    score of a text without words. Repeated rows stay, other columns are ignored, an empty table gives an empty result.
    Returns the key, held_out, score and predicted (1 from ``threshold`` on).
    """
    fold = lambda column: F.coalesce(F.crc32(F.col(column).cast("string")) % folds == held, F.lit(False))
    measured = with_statistics(docs, key)
    model = fit(measured, labels.where(~fold(key)), key)
    scored = score(measured, model, key)
    return scored.select(key, fold(key).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
