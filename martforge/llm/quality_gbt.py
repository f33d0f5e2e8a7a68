"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics are taken from whole texts inside the tasks. Training reads the statistics of
a bounded sample of labelled documents (``max_rows``, smallest hashes of the id first), bins
each statistic at quantiles and grows depth-wise trees on gradient histograms
of the logistic loss. The trees are then flattened into arrays (statistic, threshold,
children, value), and a batch of documents walks all trees at once in numpy, one step
of depth at a time.

Defined results: null and empty texts have zero statistics and are scored like any
other; repeated rows come out repeated; an empty table gives an empty result; labels
of one kind only (or none) give the share of label 1 (0 without any).
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge.llm.common import texts

STATISTICS = (
    "log_bytes", "log_words", "word_length", "word_length_sd", "longest_word", "upper", "digits", "punctuation",
    "symbols", "exclamations", "bars", "spaces", "beyond_ascii", "byte_entropy", "log_lines", "line_length",
    "repeated_lines", "repeated_words", "commonest_word", "repeated_trigrams", "short_words", "closed_lines", "capital_words",
)

_UPPER = np.arange(ord("A"), ord("Z") + 1)
_DIGITS = np.arange(ord("0"), ord("9") + 1)
_LETTERS = np.concatenate((_UPPER, _UPPER + 32))
_SYMBOLS = np.frombuffer(b"#*$%&|<>{}[]~^_=+\\@", dtype=np.uint8)
_POINTS = np.frombuffer(b".,;:!?'\"-()", dtype=np.uint8)
_SPACES = np.frombuffer(b" \t\n\r\x0b\x0c", dtype=np.uint8)


def statistics(text: str) -> list[float]:
    """The values of ``STATISTICS`` for one whole text."""
    raw = text.encode("utf-8", "surrogatepass")
    n = len(raw)
    words = text.split()
    if not n or not words:
        return [float(np.log1p(n))] + [0.0] * (len(STATISTICS) - 1)
    hist = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    part = hist[hist > 0] / n
    lengths = np.fromiter(map(len, words), dtype=np.float64, count=len(words))
    lines = [s for s in text.split("\n") if s.strip()]
    count = Counter(words)
    letters = hist[_LETTERS].sum() + hist[128:].sum()
    grams = len(words) - 2
    return [
        float(np.log1p(n)),
        float(np.log1p(len(words))),
        float(lengths.mean()),
        float(lengths.std()),
        float(np.log1p(lengths.max())),
        float(hist[_UPPER].sum() / max(1, letters)),
        float(hist[_DIGITS].sum() / n),
        float(hist[_POINTS].sum() / n),
        float(hist[_SYMBOLS].sum() / n),
        float(hist[ord("!")] / n),
        float(hist[ord("|")] / n),
        float(hist[_SPACES].sum() / n),
        float(hist[128:].sum() / n),
        float(-(part * np.log2(part)).sum()),
        float(np.log1p(len(lines))),
        float(np.log1p(n / len(lines))),
        1.0 - len(set(lines)) / len(lines),
        1.0 - len(count) / len(words),
        max(count.values()) / len(words),
        1.0 - len(set(zip(words, words[1:], words[2:]))) / grams if grams > 0 else 0.0,
        float((lengths <= 2).mean()),
        sum(s.rstrip().endswith((".", "!", "?", '"', ":")) for s in lines) / len(lines),
        sum(map(str.istitle, words)) / len(words),
    ]


def with_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, x): the statistics as an array of doubles."""
    base = texts(docs)
    kind = base.schema["doc_id"].dataType.simpleString()

    def batches(it):
        for batch in it:
            rows = [statistics(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float64()))], ["doc_id", "x"])

    return base.mapInArrow(batches, f"doc_id {kind}, x array<double>")


@dataclass
class Forest:
    """Flattened trees: node arrays with a tree's root at ``roots``; leaves point at themselves."""

    base: float
    roots: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))
    statistic: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))
    threshold: np.ndarray = field(default_factory=lambda: np.zeros(0))
    left: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))
    right: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))
    value: np.ndarray = field(default_factory=lambda: np.zeros(0))
    depth: int = 0

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Sum of leaf values: all rows walk all trees together."""
        if not len(self.roots):
            return np.full(len(x), self.base)
        at = np.tile(self.roots, (len(x), 1))
        row = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            go_left = x[row, self.statistic[at]] <= self.threshold[at]
            at = np.where(go_left, self.left[at], self.right[at])
        return self.base + self.value[at].sum(1)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.margin(x), -35, 35)))


def train(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, l2: float = 1.0, least: float = 5.0) -> Forest:
    """Boost ``trees`` depth-wise trees on binned statistics (logistic loss)."""
    n = len(y)
    share = float(y.mean()) if n else 0.0
    if share in (0.0, 1.0):
        return Forest(base=35.0 if share else -35.0)
    base = float(np.log(share / (1 - share)))
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(edges[j], x[:, j], side="left") for j in range(x.shape[1])], axis=1)
    margin = np.full(n, base)
    roots, stat, thr, left, right, value = [], [], [], [], [], []

    def node() -> int:
        for column, v in ((stat, 0), (thr, np.inf), (left, len(left)), (right, len(right)), (value, 0.0)):
            column.append(v)
        return len(stat) - 1

    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, np.maximum(p * (1 - p), 1e-12)
        roots.append(root := node())
        level = {root: np.arange(n)}
        for _ in range(depth):
            below = {}
            for at, rows in level.items():
                split = _best_split(binned[rows], g[rows], h[rows], bins, l2, least)
                if split is None:
                    continue
                j, cut_at = split
                if cut_at >= len(edges[j]):
                    continue
                goes = binned[rows, j] <= cut_at
                stat[at], thr[at] = j, float(edges[j][cut_at])
                a, b = node(), node()
                left[at], right[at] = a, b
                below[a], below[b] = rows[goes], rows[~goes]
                for side, mine in ((a, rows[goes]), (b, rows[~goes])):
                    value[side] = float(-rate * g[mine].sum() / (h[mine].sum() + l2))
            for at, rows in level.items():
                if left[at] == at:  # a leaf: its rows take its value
                    margin[rows] += value[at]
            level = below
        for at, rows in level.items():
            margin[rows] += value[at]
    return Forest(base, *(np.array(c) for c in (roots, stat, thr, left, right, value)), depth=depth)


def _best_split(binned, g, h, bins, l2, least):
    """(statistic, last bin that goes left) of the largest gain, or None."""
    total_g, total_h = g.sum(), h.sum()
    best, found = 1e-6, None
    for j in range(binned.shape[1]):
        left_g = np.cumsum(np.bincount(binned[:, j], weights=g, minlength=bins))[:-1]
        left_h = np.cumsum(np.bincount(binned[:, j], weights=h, minlength=bins))[:-1]
        left_n = np.cumsum(np.bincount(binned[:, j], minlength=bins))[:-1]
        right_h = total_h - left_h
        gain = left_g**2 / (left_h + l2) + (total_g - left_g) ** 2 / (right_h + l2) - total_g**2 / (total_h + l2)
        gain[(left_n < least) | (len(g) - left_n < least)] = 0
        if len(gain) and gain.max() > best:
            best, found = float(gain.max()), (j, int(gain.argmax()))
    return found


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = 20_000, **options) -> Forest:
    """Forest from at most ``max_rows`` labelled documents.

    One label holds per document (the largest, if several disagree); null labels
    and ids are ignored.
    """
    marks = (
        labels.select("doc_id", F.col(label).cast("double").alias("y"))
        .filter("y IN (0, 1) AND doc_id IS NOT NULL")
        .groupBy("doc_id").agg(F.max("y").alias("y"))
    )
    known = docs.select("doc_id").join(marks, "doc_id").select(F.xxhash64("doc_id").alias("h")).distinct()
    last = known.orderBy("h").limit(max_rows).agg(F.max("h")).first()[0]
    if last is None:
        return train(np.zeros((0, len(STATISTICS))), np.zeros(0), **options)
    chosen = marks.filter(F.xxhash64("doc_id") <= last)
    # of several texts of one id the smallest statistics stand for it, whatever order the rows come in
    sample = with_statistics(docs.join(chosen, "doc_id", "left_semi")).groupBy("doc_id").agg(F.min("x").alias("x")).join(chosen, "doc_id")
    rows = sample.select("doc_id", "x", "y").orderBy("doc_id").toPandas()  # bounded by max_rows
    return train(np.array(rows["x"].tolist(), dtype=np.float64).reshape(-1, len(STATISTICS)), rows["y"].to_numpy(), **options)


def score(docs: DataFrame, forest: Forest, threshold: float = 0.7) -> DataFrame:
    """doc_id, score and predicted (1: score at or above the threshold)."""
    base = texts(docs)
    kind = base.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(forest)

    def batches(it):
        for batch in it:
            x = np.array([statistics(t) for t in batch.column(1).to_pylist()], dtype=np.float64).reshape(-1, len(STATISTICS))
            p = shared.value.probability(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(p), pa.array((p >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"]
            )

    return base.mapInArrow(batches, f"doc_id {kind}, score double, predicted int")


def keep_good(docs: DataFrame, forest: Forest, threshold: float = 0.7) -> DataFrame:
    """The documents (all their columns) that score at or above the threshold."""
    shared = docs.sparkSession.sparkContext.broadcast(forest)

    @F.pandas_udf("double")
    def probability(text: pd.Series) -> pd.Series:
        x = np.array([statistics(t or "") for t in text], dtype=np.float64).reshape(-1, len(STATISTICS))
        return pd.Series(shared.value.probability(x))

    return docs.filter(probability(F.col("text")) >= threshold)
