"""Score the quality of texts by histogram gradient-boosted trees over statistics of each text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from martkit.llm.common import Words, byte_texts, columns_of, steps

# Labelled rows that a model is trained on, at most; a larger set of labels gives a sample by hash of the key.
TRAINING_ROWS = 20_000
TREES, DEPTH, BINS, RATE, LEAST_ROWS, SHRINK = 80, 4, 64, 0.1, 10, 1.0

_GROUPS = ("upper", "lower", "digit", "space", "line", "stop", "comma", "other_mark", "symbol", "wide")
_CLASS = np.full(256, _GROUPS.index("other_mark"), np.int64)
for _name, _bytes in {
    "upper": range(65, 91),
    "lower": range(97, 123),
    "digit": range(48, 58),
    "space": b" \t\r\x0b\x0c",
    "line": b"\n",
    "stop": b".?!",
    "comma": b",;:",
    "symbol": b"#$%&*+<=>@\\^_`{|}~/",
    "wide": range(128, 256),
}.items():
    _CLASS[list(_bytes)] = _GROUPS.index(_name)

_IS_WORD = np.ones(256, bool)
_IS_WORD[list(b" \t\r\n\x0b\x0c")] = False
_NOT_BREAK = np.ones(256, bool)
_NOT_BREAK[10] = False

FEATURES = (
    "log_bytes", "log_words", "word_length", "words_per_stop", *[f"share_{g}" for g in _GROUPS],
    "distinct_words", "top_word", "repeated_pairs", "distinct_lines", "line_length", "next_same",
)


def _share_distinct(hashes: np.ndarray) -> float:
    return len(np.unique(hashes)) / len(hashes) if len(hashes) else 1.0


def statistics(texts: list[bytes]) -> np.ndarray:
    """One row of ``FEATURES`` per text, all finite, from whole texts; an empty text has zeros and ones."""
    words, lines = Words(texts, _IS_WORD), Words(texts, _NOT_BREAK)
    pairs = words.windows(2)
    raw = np.frombuffer(words.data, np.uint8)
    n = len(texts)
    sizes = np.diff(words.offset)
    owner = np.repeat(np.arange(n), sizes)
    counts = np.bincount(owner * len(_GROUPS) + _CLASS[raw], minlength=n * len(_GROUPS)).reshape(n, -1).astype(float)
    counts[:, _GROUPS.index("line")] -= 1  # the break put after each text
    size = np.maximum(sizes - 1, 0).astype(float)
    out = np.zeros((n, len(FEATURES)))
    n_words = np.diff(words.first).astype(float)
    inside = np.maximum(size - counts[:, _GROUPS.index("space")] - counts[:, _GROUPS.index("line")], 0)
    out[:, 0], out[:, 1] = np.log1p(size), np.log1p(n_words)
    out[:, 2] = inside / np.maximum(n_words, 1)
    out[:, 3] = n_words / (counts[:, _GROUPS.index("stop")] + 1)
    out[:, 4 : 4 + len(_GROUPS)] = counts / np.maximum(size, 1)[:, None]
    at = 4 + len(_GROUPS)
    for i in range(n):
        a, b = words.first[i], words.first[i + 1]
        own = words.hash[a:b]
        c, d = lines.first[i], lines.first[i + 1]
        if b > a:
            _, each = np.unique(own, return_counts=True)
            out[i, at] = len(each) / (b - a)
            out[i, at + 1] = each.max() / (b - a)
            out[i, at + 5] = (own[1:] == own[:-1]).sum() / (b - a)
        else:
            out[i, at] = 1.0
        out[i, at + 2] = 1 - _share_distinct(pairs[a : max(a, b - 1)])
        out[i, at + 3] = _share_distinct(lines.hash[c:d])
        out[i, at + 4] = np.log1p(size[i] / max(1, d - c))
    return out


@dataclass(frozen=True)
class Forest:
    """Boosted trees as arrays, one row a tree: split feature (-1 at a leaf), threshold, children, leaf value."""

    start: float
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row; all rows walk down a tree together."""
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for feature, threshold, left, right, value in zip(
            self.feature, self.threshold, self.left, self.right, self.value, strict=True
        ):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                f = feature[node]
                down = np.where(x[rows, f] <= threshold[node], left[node], right[node])
                node = np.where(f >= 0, down, node)
            total += value[node]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _histograms(bins: np.ndarray, rows: np.ndarray, gradient: np.ndarray, curvature: np.ndarray) -> np.ndarray:
    """Per feature and bin: sums of gradient and curvature, and rows."""
    features = bins.shape[1]
    flat = (bins[rows] + np.arange(features) * BINS).ravel()
    out = [
        np.bincount(flat, np.repeat(w, features) if w is not None else None, minlength=features * BINS)
        for w in (gradient[rows], curvature[rows], None)
    ]
    return np.stack(out).reshape(3, features, BINS)


def train_forest(x: np.ndarray, y: np.ndarray) -> Forest:
    """Boost trees on binned features for the logistic loss.  Without rows of both labels all scores are alike."""
    mean = float(np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3))
    start = float(np.log(mean / (1 - mean)))
    size = 2 ** (DEPTH + 1) - 1
    if len(y) == 0 or y.min() == y.max():
        none = np.full((0, size), -1, np.int64)
        return Forest(start, none, none.astype(float), none, none, none.astype(float))
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    bins = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)
    total = np.full(len(y), start)
    trees = []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-total))
        gradient, curvature = y - p, p * (1 - p)
        feature, threshold = np.full(size, -1, np.int64), np.zeros(size)
        left, right, value = np.zeros(size, np.int64), np.zeros(size, np.int64), np.zeros(size)
        level = [(0, np.arange(len(y)))]
        used = 1
        for depth in range(DEPTH + 1):
            following = []
            for node, rows in level:
                g, h = gradient[rows].sum(), curvature[rows].sum()
                value[node] = RATE * g / (h + SHRINK)
                if depth == DEPTH or len(rows) < 2 * LEAST_ROWS:
                    total[rows] += value[node]
                    continue
                sums = np.cumsum(_histograms(bins, rows, gradient, curvature), axis=2)
                gl, hl, nl = sums[0], sums[1], sums[2]
                gain = gl**2 / (hl + SHRINK) + (g - gl) ** 2 / (h - hl + SHRINK) - g**2 / (h + SHRINK)
                gain[(nl < LEAST_ROWS) | (len(rows) - nl < LEAST_ROWS)] = -np.inf
                best = int(np.argmax(gain))
                f, b = divmod(best, BINS)
                if gain.flat[best] <= 1e-6 or b >= len(edges[f]):
                    total[rows] += value[node]
                    continue
                goes = bins[rows, f] <= b
                feature[node], threshold[node], left[node], right[node] = f, edges[f][b], used, used + 1
                following += [(used, rows[goes]), (used + 1, rows[~goes])]
                used += 2
            level = following
        trees.append((feature, threshold, left, right, value))
    return Forest(start, *[np.stack(a) for a in zip(*trees, strict=True)])


def labelled_sample(labels: DataFrame, label: str, held_out, rows: int, key: str = "doc_id") -> DataFrame:
    """``(doc_id, y)`` of at most ``rows`` labelled keys that are not held out, by hash of the key.

    A null key or label counts for nothing; a key labelled twice counts with its mean label, rounded.
    """
    usable = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull() & ~held_out)
    one = usable.groupBy(F.col(key).alias("doc_id")).agg(F.round(F.avg(label)).cast("int").alias("y"))
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def _features(docs: DataFrame) -> DataFrame:
    """``docs`` of key, text and label as key, label and statistics."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches):
            rows = statistics(byte_texts(part.column(1)))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(2), pa.array(rows.tolist(), pa.list_(pa.float64()))], names=["doc_id", "y", "x"]
            )

    of_key = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {of_key}, y int, x array<double>")


def learn_quality(docs: DataFrame, sample: DataFrame, key: str = "doc_id", text: str = "text") -> Forest:
    """Train on the texts of a ``labelled_sample``; its rows are few by construction, so they may be broadcast."""
    joined = columns_of(docs, key, text).join(F.broadcast(sample), "doc_id")
    rows = _features(joined.select("doc_id", "text", "y")).select("doc_id", "x", "y").toPandas().sort_values("doc_id")
    x = np.stack(rows["x"].to_numpy()) if len(rows) else np.zeros((0, len(FEATURES)))
    return train_forest(x, rows["y"].to_numpy(float))


def score_quality(docs: DataFrame, forest: Forest, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, score)`` of each row, from the whole text alone; a null text counts as empty and has a score too."""
    frame = columns_of(docs, key, text)
    shared = frame.sparkSession.sparkContext.broadcast(forest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches):
            scores = shared.value.scores(statistics(byte_texts(part.column(1))))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores)], names=["doc_id", "score"])

    return frame.mapInArrow(run, f"doc_id {frame.schema['doc_id'].dataType.simpleString()}, score double")


def quality_report(docs: DataFrame, labels: DataFrame, held_out, threshold: float = 0.3, rows: int = TRAINING_ROWS) -> DataFrame:
    """Learn from labels that are not held out and score all rows; 1 from the threshold on."""
    forest = learn_quality(docs, labelled_sample(labels, "quality", held_out, rows))
    return score_quality(docs, forest).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"),
    )
