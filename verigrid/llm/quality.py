"""Quality rules: fixed base rules, then gradient-boosted trees over document statistics.

The trees are grown in numpy on histograms of a bounded sample of labelled documents and laid out
flat in arrays (feature, threshold, children, value), so a batch of documents walks all trees with
array lookups. Chosen features have monotonic constraints: more of them never raises the score.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, LongType, StructField, StructType

from verigrid.llm.common import BLANKS, begin_without_tables, give_back, parts, texts_of

SYMBOLS = b"#*$%&|<>"
_UPPER, _DIGITS = bytes(range(65, 91)), bytes(range(48, 58))
_MARKS = b"!?.,;:'\"()[]{}-_/\\@^~`+="
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: The statistics that trees see, and the direction in which each may move the score (0: any).
FEATURES = {
    "log_words": 0, "chars_per_word": 0, "symbol_share": -1, "dup_line_share": -1, "repeat_share": -1,
    "upper_share": 0, "digit_share": 0, "mark_share": 0, "unique_share": 0, "top_word_share": -1, "words_per_line": 0,
}


def repeated_words(ids: np.ndarray, window: int = 5) -> int:
    """Words inside windows that occur twice or more; ``ids`` numbers the words from 0.

    Windows are compared exactly: pairs are numbered anew until one number stands for a window.
    """
    n = ids.size - window + 1
    if n < 2:
        return 0
    code, width, base = ids.astype(np.int64), 1, int(ids.max()) + 1
    while width < window:
        step = min(width, window - width)
        if int(code.max()) * base >= 2**62 or step > 1:
            code = np.unique(code, return_inverse=True)[1].astype(np.int64)
        if step == 1:
            tail = ids[width:].astype(np.int64)
            code = code[: tail.size] * base + tail
        else:
            code = code[: code.size - step] * (int(code.max()) + 1) + code[step:]
        width += step
    order = np.argsort(code, kind="stable")
    same = code[order][1:] == code[order][:-1]
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    covered = np.zeros(ids.size, bool)
    for k in range(window):
        covered[k : k + n] |= twice
    return int(covered.sum())


def statistics(text: str) -> tuple[list[int], list[float]]:
    """The counts of ``COUNTS`` and the features of one text."""
    data = text.encode()
    words = data.split()
    n = len(words)
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, n)
    without = lambda drop: len(data) - len(data.translate(None, drop))
    blank = without(BLANKS)
    lines = [line for line in data.split(b"\n") if line.strip()]
    dup = len(lines) - len(set(lines))
    repeats, symbols, chars = repeated_words(ids), without(SYMBOLS), len(text) - blank
    some, size = max(n, 1), max(chars, 1)
    features = [
        float(np.log1p(n)), chars / some, symbols / size, dup / max(len(lines), 1), repeats / some,
        without(_UPPER) / size, without(_DIGITS) / size, without(_MARKS) / size, len(known) / some,
        float(np.bincount(ids).max()) / some if n else 0.0, n / max(len(lines), 1),
    ]
    return [n, chars, symbols, dup, repeats], features


def with_statistics(df: DataFrame) -> DataFrame:
    """``COUNTS`` and ``features`` beside ``doc_id`` and the other columns but ``text``."""
    kept = [f for f in df.schema.fields if f.name != "text"]
    schema = StructType([*kept, *[StructField(c, LongType()) for c in COUNTS]])
    schema = schema.add("features", ArrayType(DoubleType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin_without_tables()
        for batch in parts(batches):
            found = [statistics(text) for text in texts_of(batch)]
            counts = np.array([x[0] for x in found], np.int64).reshape(-1, len(COUNTS))
            columns = [batch.column(f.name) for f in kept]
            columns += [pa.array(counts[:, k]) for k in range(len(COUNTS))]
            columns.append(pa.array([x[1] for x in found], pa.list_(pa.float64())))
            yield pa.RecordBatch.from_arrays(columns, schema.names)
        give_back()

    return df.mapInArrow(run, schema)


@dataclass
class Trees:
    """All trees in flat arrays; a leaf is its own child, so every walk has the same length."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of good quality for rows of features."""
        rows = np.arange(len(x))[:, None]
        node = np.broadcast_to(self.roots, (len(x), len(self.roots)))
        for _ in range(self.depth):
            goes_left = x[rows, self.feature[node]] <= self.threshold[node]
            node = np.where(goes_left, self.left[node], self.right[node])
        return 1 / (1 + np.exp(-(self.base + self.value[node].sum(axis=1))))


def grow(
    x: np.ndarray, y: np.ndarray, directions: Sequence[int], rounds: int = 60, depth: int = 3, rate: float = 0.2,
    bins: int = 64, least: int = 20, smooth: float = 1.0,
) -> Trees:
    """Logistic boosting with histogram splits.

    A split on a constrained feature must order its two values, and the values below it are kept on
    their side of the middle, so the whole tree is monotonic in that feature.
    """
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    cell = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    base = float(np.log(share / (1 - share)))
    nodes: list[list[float]] = []  # feature, threshold, left, right, value
    roots, raw = [], np.full(len(y), base)

    def best_split(at, g, h, low, high):
        total_g, total_h, best = g[at].sum(), h[at].sum(), None
        whole = total_g**2 / (total_h + smooth)
        for f, e in enumerate(edges):
            size = len(e) + 1
            if size == 1:
                continue
            gl, hl, nl = (np.cumsum(np.bincount(cell[at, f], w, size))[:-1] for w in (g[at], h[at], None))
            gr, hr = total_g - gl, total_h - hl
            left, right = (np.clip(-a / (b + smooth), low, high) for a, b in ((gl, hl), (gr, hr)))
            gain = gl**2 / (hl + smooth) + gr**2 / (hr + smooth) - whole
            gain[(nl < least) | (at.size - nl < least) | (directions[f] * (right - left) < 0)] = -np.inf
            k = int(np.argmax(gain))
            if gain[k] > 1e-9 and (best is None or gain[k] > best[0]):
                best = (gain[k], f, k, left[k], right[k])
        return best

    def build(at, g, h, low, high, level):
        here = len(nodes)
        value = float(np.clip(-g[at].sum() / (h[at].sum() + smooth), low, high))
        nodes.append([0, np.inf, here, here, rate * value])
        found = best_split(at, g, h, low, high) if level < depth and at.size >= 2 * least else None
        if found is None:
            raw[at] += rate * value
            return here
        _, f, k, left, right = found
        middle = (left + right) / 2
        bounds = [(low, high), (low, high)]
        if directions[f]:
            bounds = [(low, middle), (middle, high)] if directions[f] > 0 else [(middle, high), (low, middle)]
        goes_left = cell[at, f] <= k
        a = build(at[goes_left], g, h, *bounds[0], level + 1)
        b = build(at[~goes_left], g, h, *bounds[1], level + 1)
        nodes[here] = [f, edges[f][k], a, b, 0.0]
        return here

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-raw))
        roots.append(build(np.arange(len(y)), p - y, p * (1 - p), -np.inf, np.inf, 0))
    table = np.array(nodes, float)
    whole = [table[:, k].astype(np.int64) for k in (0, 2, 3)]
    return Trees(whole[0], table[:, 1], whole[1], whole[2], table[:, 4], np.array(roots), depth, base)


def fit(docs: DataFrame, labels: DataFrame, sample: int = 20_000, **options) -> Trees | None:
    """Trees from at most ``sample`` labelled documents (those with the smallest hash of their id).

    The bound holds for what reaches the driver: a row of features and a label per sampled
    document. None if the labels do not show both classes.
    """
    usable = labels.select("doc_id", "quality").dropna().dropDuplicates(["doc_id"])
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most `sample` rows
    rows = with_statistics(found).select("doc_id", "quality", "features").dropDuplicates(["doc_id"]).orderBy("doc_id").collect()
    y = np.array([row["quality"] for row in rows], float)
    if len(set(y)) < 2:
        return None
    return grow(np.array([row["features"] for row in rows]), y, list(FEATURES.values()), **options)


def judge(docs: DataFrame, trees: Trees | None, threshold: float = 0.5) -> DataFrame:
    """The columns of ``docs`` with the counts, ``base_failed``, ``score`` and ``kept``.

    A null or empty text has no words and fails the base rules. Without trees every document that
    passes the base rules has score 1 and is kept. Rows are judged one by one, repeated or not;
    columns of ``docs`` with the added names are replaced.
    """
    added = [*COUNTS, "base_failed", "score", "kept"]
    docs = docs.drop(*added)
    kinds = [LongType()] * len(COUNTS) + [BooleanType(), DoubleType(), BooleanType()]
    schema = StructType([*docs.schema.fields, *[StructField(c, k) for c, k in zip(added, kinds, strict=True)]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin_without_tables()
        for batch in parts(batches):
            found = [statistics(text) for text in texts_of(batch)]
            counts = np.array([x[0] for x in found], np.int64).reshape(-1, len(COUNTS))
            x = np.array([x[1] for x in found]).reshape(-1, len(FEATURES))
            n, repeats = counts[:, 0], counts[:, 4]
            failed = (n < 10) | (100 * repeats > 20 * n)
            score = trees.score(x) if trees is not None else np.ones(len(x))
            columns = [*batch.columns, *[pa.array(counts[:, k]) for k in range(len(COUNTS))]]
            columns += [pa.array(failed), pa.array(score), pa.array(~failed & (score >= threshold))]
            yield pa.RecordBatch.from_arrays(columns, schema.names)
        give_back()

    return docs.mapInArrow(run, schema)
