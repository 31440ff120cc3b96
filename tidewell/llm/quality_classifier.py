"""Quality classifier: regularised quadratic discriminant analysis over document statistics.

Statistics of the text alone (shares of character classes, word and line lengths, repetition) are made
roughly normal: shares by ``log(share + 0.001)``, sizes by ``log(1 + size)``. For each class, the labelled
training rows give a count, a mean and a covariance; Spark adds them up, so only these sums reach the driver,
whatever the number of labels. A covariance is shrunk twice: towards the pooled covariance of both classes,
and then towards its own diagonal plus a small ridge. The Cholesky factors are computed once and travel with
the scoring function. A text's score comes from the difference of its two log densities (squared Mahalanobis
distances and log determinants) plus the log odds of the classes.

Densities of many statistics are far too sure of themselves, so the difference goes through a one-dimensional
logistic curve fitted to the training rows, counted in a fixed number of bins.

Defined results: a null text counts as empty, and an empty one has a score like any other; labels that are
null or without a document teach nothing; a document with labels of both kinds counts once in each class;
repeated label rows count once; a class with too few rows (under 2) or no labels at all gives every text the
share of class 1 (0.5 where there is none); an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.llm.common import map_rows, packed, stored
from tidewell.llm.quality_rules import CLASSES, class_counts

#: Statistics and their transforms: "size" or "share".
STATISTICS = {
    "chars": "size",
    "words": "size",
    **{f"{c}_share": "share" for c in CLASSES},
    "word_length": "size",
    "word_length_spread": "size",
    "different_words": "share",
    "long_words": "share",
    "capital_words": "share",
    "shouted_words": "share",
    "words_ending_in_sign": "share",
    "bare_sign_words": "share",
    "line_words": "size",
    "repeated_lines": "share",
    "most_frequent_word": "share",
    "repeated_sign_pairs": "share",
    "compressed": "share",
}
_SMALL = 0.001
_BLOCK_BYTES = 65536
# Bytes that are signs: visible ASCII that is neither a letter nor a digit.
_SIGN = np.array([32 < b < 127 and not chr(b).isalnum() for b in range(256)])


def compressed_share(data: bytes) -> float:
    """Compressed size over size, in blocks, so that a long text needs no more memory than a block."""
    if not data:
        return 1.0
    return sum(len(zlib.compress(data[k : k + _BLOCK_BYTES], 1)) for k in range(0, len(data), _BLOCK_BYTES)) / len(data)


def statistics(text: str | None) -> np.ndarray:
    """The transformed statistics of a text, in the order of ``STATISTICS``."""
    data = (text or "").encode("utf-8", "surrogatepass")
    classes = class_counts(data)
    chars = max(1, int(classes.sum()))
    words = data.split()
    n = max(1, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    # The letter of each word that the counts below look at: first, second and last byte.
    starts = np.frombuffer(bytes(w[0] for w in words), np.uint8)
    seconds = np.frombuffer(bytes(w[1] if len(w) > 1 else 0 for w in words), np.uint8)
    ends = np.frombuffer(bytes(w[-1] for w in words), np.uint8)
    capital = (starts >= 65) & (starts <= 90)
    lines = [x for x in data.split(b"\n") if x.strip()]
    flat = np.frombuffer(data, np.uint8)
    pairs = int((_SIGN[flat[1:]] & (flat[1:] == flat[:-1])).sum())
    times = Counter(words)
    values = {
        "chars": chars,
        "words": len(words),
        **{f"{c}_share": k / chars for c, k in zip(CLASSES, classes.tolist())},
        "word_length": lengths.mean(),
        "word_length_spread": lengths.std(),
        "different_words": len(times) / n,
        "long_words": float((lengths > 12).sum()) / n,
        "capital_words": float(capital.sum()) / n,
        "shouted_words": float((capital & (seconds >= 65) & (seconds <= 90)).sum()) / n,
        "words_ending_in_sign": float(_SIGN[ends].sum()) / n,
        "bare_sign_words": float((_SIGN[starts] & (lengths[: len(words)] == 1)).sum()) / n,
        "line_words": len(words) / max(1, len(lines)),
        "repeated_lines": 1 - len(set(lines)) / len(lines) if lines else 0.0,
        "most_frequent_word": max(times.values(), default=0) / n,
        "repeated_sign_pairs": pairs / chars,
        "compressed": compressed_share(data),
    }
    return np.array([np.log1p(values[k]) if kind == "size" else np.log(values[k] + _SMALL) for k, kind in STATISTICS.items()])


@dataclass(frozen=True)
class Model:
    """Means, lower Cholesky factors and log determinants of both classes; log odds; the logistic curve."""

    means: tuple[np.ndarray, np.ndarray]
    factors: tuple[np.ndarray, np.ndarray]
    log_dets: tuple[float, float]
    log_odds: float
    slope: float = 1.0
    offset: float = 0.0

    def difference(self, x: np.ndarray) -> np.ndarray:
        """Log density of class 1 less that of class 0, plus the log odds, for rows of statistics."""
        logs = []
        for mean, factor, log_det in zip(self.means, self.factors, self.log_dets):
            apart = np.linalg.solve(factor, (x - mean).T)
            logs.append(-0.5 * (apart**2).sum(0) - 0.5 * log_det)
        return logs[1] - logs[0] + self.log_odds

    def score(self, x: np.ndarray) -> np.ndarray:
        # The root keeps order and sign and tames differences of thousands before the curve.
        d = squashed(self.difference(x))
        return 1 / (1 + np.exp(-np.clip(self.slope * d + self.offset, -30, 30)))


def squashed(d: np.ndarray) -> np.ndarray:
    return np.sign(d) * np.sqrt(np.abs(d))


def shrunk(covariance: np.ndarray, pooled: np.ndarray, to_pooled: float, to_diagonal: float, ridge: float) -> np.ndarray:
    mixed = (1 - to_pooled) * covariance + to_pooled * pooled
    return (1 - to_diagonal) * mixed + to_diagonal * np.diag(np.diag(mixed)) + ridge * np.eye(len(mixed))


def _moments(labels: pa.Array, vectors: pa.Array):
    """Per class: count, sums and sums of products of these rows."""
    y = labels.to_numpy(zero_copy_only=False)
    x = vectors.flatten().to_numpy().reshape(len(y), -1)
    out = [[], [], [], []]
    for c in np.unique(y):
        rows = x[y == c]
        for column, value in zip(out, (int(c), len(rows), rows.sum(0), (rows.T @ rows).ravel())):
            column.append(value)
    return out


def fit(training: DataFrame, to_pooled: float = 0.1, to_diagonal: float = 0.1, ridge: float = 0.01) -> Model | float:
    """A model from rows of ``label`` (0 or 1) and ``x``; the share of class 1 where a class is too small."""
    width = len(STATISTICS)
    sums = map_rows(training.select("label", "x"), _moments, "label int, n long, s array<double>, p array<double>", rows=8192)
    # One row for each class and batch; added up place by place, so at most 2 * width^2 numbers arrive.
    added = lambda c: F.posexplode(c).alias("place", "value")
    counts = {r[0]: r[1] for r in sums.groupBy("label").agg(F.sum("n")).collect()}
    if min(counts.get(0, 0), counts.get(1, 0)) < 2:
        n = sum(counts.values())
        return counts.get(1, 0) / n if n else 0.5
    total = {}
    for name in ("s", "p"):
        for label, place, value in sums.select("label", added(name)).groupBy("label", "place").agg(F.sum("value")).collect():
            total.setdefault((label, name), {})[place] = value
    means, covariances = [], []
    for c in (0, 1):
        s = np.array([total[c, "s"][k] for k in range(width)])
        p = np.array([total[c, "p"][k] for k in range(width * width)]).reshape(width, width)
        means.append(s / counts[c])
        covariances.append((p - np.outer(s, s) / counts[c]) / (counts[c] - 1))
    n = counts[0] + counts[1]
    pooled = sum((counts[c] - 1) * covariances[c] for c in (0, 1)) / (n - 2)
    factors = [np.linalg.cholesky(shrunk(covariances[c], pooled, to_pooled, to_diagonal, ridge)) for c in (0, 1)]
    log_dets = [2 * float(np.log(np.diag(f)).sum()) for f in factors]
    model = Model(tuple(means), tuple(factors), tuple(log_dets), float(np.log(counts[1] / counts[0])))
    return calibrated(model, training)


_BINS = 400


def calibrated(model: Model, training: DataFrame) -> Model:
    """The model with its logistic curve: Newton steps on the training rows, counted in bins of the difference."""

    def binned(labels: pa.Array, vectors: pa.Array):
        x = vectors.flatten().to_numpy().reshape(len(labels), -1)
        return labels, np.clip(np.rint(squashed(model.difference(x)) * 10), -_BINS, _BINS).astype(np.int32)

    bins = map_rows(training.select("label", "x"), binned, "label int, b int", rows=8192).groupBy("label", "b").count()
    rows = np.array([tuple(r) for r in bins.collect()], float)  # 2 * (2 * _BINS + 1) rows at most
    y, d, n = rows[:, 0], rows[:, 1] / 10, rows[:, 2]
    design = np.column_stack([d, np.ones(len(d))])
    beta, keep = np.array([0.1, 0.0]), np.diag([0.1, 0.1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = design.T @ (n * (y - p)) - keep @ beta
        step = np.linalg.solve((design * (n * p * (1 - p))[:, None]).T @ design + keep, slope)
        beta = beta + np.clip(step, -2, 2)
    return Model(model.means, model.factors, model.log_dets, model.log_odds, float(beta[0]), float(beta[1]))


def held_out(id_column: Column, folds: int = 5) -> Column:
    """Rows kept out of training: ``crc32`` of the id as text is divisible by ``folds``. Not for a null id."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % folds == 0, F.lit(False))


def score_documents(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    folds: int = 5,
    carry: list[str] | None = None,
    **shrinkage: float,
) -> DataFrame:
    """``row`` (the input, or its ``carry`` columns), ``held_out`` and ``score`` (0 to 1)."""
    frame = packed(docs, carry, id=F.col(f"`{id_col}`"), text=F.col(f"`{text_col}`"))
    schema = T.StructType().add("row", frame.schema["row"].dataType).add("id", frame.schema["id"].dataType)

    def described(rows: pa.Array, ids: pa.Array, texts: pa.Array):
        return rows, ids, [statistics(t) for t in texts.to_pylist()]

    known = stored(map_rows(frame, described, schema.add("x", T.ArrayType(T.DoubleType())), rows=256), "statistics")
    known = known.withColumn("held_out", held_out(F.col("id"), folds))
    taught = labels.select(F.col(f"`{id_col}`").alias("label_id"), F.col(f"`{label_col}`").cast("int").alias("label"))
    taught = taught.filter("label IN (0, 1)").distinct()
    training = known.filter(~F.col("held_out")).join(taught, F.col("id") == F.col("label_id")).select("label", "x")
    model = fit(stored(training, "training"), **shrinkage)

    def scored(rows: pa.Array, outs: pa.Array, vectors: pa.Array):
        if isinstance(model, float):
            return rows, outs, np.full(len(outs), model)
        return rows, outs, model.score(vectors.flatten().to_numpy().reshape(len(outs), -1))

    result = T.StructType().add("row", frame.schema["row"].dataType).add("held_out", "boolean").add("score", "double")
    return map_rows(known.select("row", "held_out", "x"), scored, result, rows=4096)
