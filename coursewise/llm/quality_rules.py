"""Quality rules: gradient-boosted trees over document statistics.

One pass turns every whole text into a row of statistics. The trees are fitted to labels on a
bounded sample of those rows and flattened into numpy node arrays (feature, threshold, left,
right, value), which score a batch level by level. Chosen features are monotone: more symbols,
more repeated lines or more repeated words never raise the score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from coursewise.llm.common import hash_sample, held_out, map_texts, texts_as_bytes
from coursewise.sources.staging import staged

SPACES = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(65, 91))
DIGITS = bytes(range(48, 58))
MARKS = b"!?.,;:-_=+()[]{}\"'/\\~^@"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
EXTRA = ["n_lines", "n_upper", "n_digits", "n_marks", "n_distinct"]
#: name, and the sign in which the score may move with it (0: freely)
FEATURES = {
    "log_words": 0,
    "word_length": 0,
    "symbol_rate": -1,
    "dup_line_rate": -1,
    "repeat_rate": -1,
    "upper_rate": 0,
    "digit_rate": 0,
    "mark_rate": 0,
    "distinct_rate": 0,
}
TRAIN_ROWS = 10_000  # of a class
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


def repeated_words(words: list[bytes]) -> tuple[int, int]:
    """Words in three-word windows that occur twice or more, and distinct words."""
    names: dict[bytes, int] = {}
    ids = np.fromiter((names.setdefault(w, len(names)) for w in words), np.int64, len(words))
    if len(ids) < 3:
        return 0, len(names)
    pair = np.unique(ids[:-1] * len(names) + ids[1:], return_inverse=True)[1]
    triple = pair[:-1] * len(names) + ids[2:]
    _, place, times = np.unique(triple, return_inverse=True, return_counts=True)
    inside = np.zeros(len(ids), bool)
    starts = np.flatnonzero(times[place] > 1)
    for shift in range(3):
        inside[starts + shift] = True
    return int(inside.sum()), len(names)


def statistics_of(text: bytes) -> tuple[int, ...]:
    """The counts named by COUNTS and EXTRA."""
    words = text.split()
    bare = text.translate(None, SPACES)
    lines = [line for line in text.split(b"\n") if line.strip(SPACES)]
    repeats, distinct = repeated_words(words)
    count = lambda chars: len(bare) - len(bare.translate(None, chars))
    return (
        len(words),
        len(bare.decode("utf-8", "replace")),
        count(SYMBOLS),
        len(lines) - len(set(lines)),
        repeats,
        len(lines),
        count(UPPER),
        count(DIGITS),
        count(MARKS),
        distinct,
    )


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the counts of every whole text; a null or empty text has zeros."""
    names = [*COUNTS, *EXTRA]

    def build(batch: pa.RecordBatch) -> dict:
        rows = np.array([statistics_of(t) for t in texts_as_bytes(batch)], np.int64).reshape(-1, len(names))
        return {"doc_id": batch.column("doc_id")} | {n: pa.array(rows[:, i]) for i, n in enumerate(names)}

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, " + ", ".join(f"{n} long" for n in names)
    return map_texts(docs.select("doc_id", "text"), schema, build)


def feature_matrix(c: dict[str, np.ndarray]) -> np.ndarray:
    words, chars, lines = (np.maximum(c[n], 1) for n in ("n_words", "word_chars", "n_lines"))
    return np.column_stack(
        [
            np.log1p(c["n_words"]),
            c["word_chars"] / words,
            c["n_symbols"] / chars,
            c["n_dup_lines"] / lines,
            c["n_repeat_words"] / words,
            c["n_upper"] / chars,
            c["n_digits"] / chars,
            c["n_marks"] / chars,
            c["n_distinct"] / np.sqrt(words),
        ]
    )


@dataclass
class Forest:
    """All trees in one set of node arrays; a leaf points to itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        rows = np.arange(len(x))[:, None]
        at = np.broadcast_to(self.roots, (len(x), len(self.roots)))
        for _ in range(self.depth):
            at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
        return 1 / (1 + np.exp(-(self.base + self.value[at].sum(1))))


def fit_forest(
    x: np.ndarray, y: np.ndarray, signs: list[int], trees: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 64, l2: float = 1.0
) -> Forest:
    """Boost regression trees on the logistic loss over binned features.

    A split on a signed feature has to order its children's values by the sign, and the midpoint
    of the two bounds what may grow below either child, so the whole score is monotone.
    """
    n, width = x.shape
    prior = np.clip(y.mean() if n else 0.5, 0.01, 0.99)
    base, nodes, roots = float(np.log(prior / (1 - prior))), [], []
    if n == 0 or y.min() == y.max():
        trees = 0
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins)[1:-1])) if n else np.zeros(0) for f in range(width)]
    codes = np.column_stack([np.searchsorted(cuts[f], x[:, f], side="left") for f in range(width)]) if n else np.zeros((0, width), int)
    raw = np.full(n, base)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = y - p, np.maximum(p * (1 - p), 1e-6)

        def grow(rows: np.ndarray, level: int, low: float, high: float) -> int:
            me = len(nodes)
            value = float(np.clip(g[rows].sum() / (h[rows].sum() + l2), low, high))
            nodes.append([0, 0.0, me, me, rate * value])
            best = (1e-3, None)
            if level:
                total_g, total_h = g[rows].sum(), h[rows].sum()
                for f in range(width):
                    size = len(cuts[f]) + 1
                    gl = np.cumsum(np.bincount(codes[rows, f], g[rows], size))[:-1]
                    hl = np.cumsum(np.bincount(codes[rows, f], h[rows], size))[:-1]
                    gr, hr = total_g - gl, total_h - hl
                    vl, vr = (np.clip(a / (b + l2), low, high) for a, b in ((gl, hl), (gr, hr)))
                    gain = 2 * (gl * vl + gr * vr) - (hl + l2) * vl**2 - (hr + l2) * vr**2
                    gain -= 2 * total_g * value - (total_h + l2) * value**2
                    bad = (hl < 0.5) | (hr < 0.5) | (signs[f] * (vr - vl) < 0)
                    gain[bad] = 0
                    if len(gain) and gain.max() > best[0]:
                        k = int(gain.argmax())
                        best = (gain[k], (f, k, vl[k], vr[k]))
            if best[1]:
                f, k, vl, vr = best[1]
                mid, goes = (vl + vr) / 2, codes[rows, f] <= k
                bounds = {0: ((low, high), (low, high)), 1: ((low, mid), (mid, high)), -1: ((mid, high), (low, mid))}[signs[f]]
                left = grow(rows[goes], level - 1, *bounds[0])
                nodes[me] = [f, float(cuts[f][k]), left, grow(rows[~goes], level - 1, *bounds[1]), 0.0]
            else:
                raw[rows] += rate * value
            return me

        roots.append(grow(np.arange(n), depth, -np.inf, np.inf))
    if not nodes:
        nodes, roots = [[0, 0.0, 0, 0, 0.0]], [0]
    feature, threshold, left, right, value = map(np.array, zip(*nodes, strict=True))
    return Forest(feature, threshold, left, right, value, np.array(roots), depth, base)


def fit_rules(stats: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Forest:
    """Fit on at most ``train_rows`` different labelled rows of either class that are not held out (their statistics only)."""
    known = labels.where("quality in (0, 1)").groupBy("doc_id").agg(F.max("quality").alias("label"))
    joined = stats.where(~held_out(F.col("doc_id"))).join(known, "doc_id")
    sample = hash_sample(joined.select("label", "doc_id", *COUNTS, *EXTRA), train_rows, "label")
    rows = sample.select("label", *COUNTS, *EXTRA).toPandas()
    x = feature_matrix({n: rows[n].to_numpy(float) for n in [*COUNTS, *EXTRA]})
    order = np.lexsort((*x.T, rows["label"].to_numpy()))  # the fit doesn't depend on the order of rows
    return fit_forest(x[order], rows["label"].to_numpy(float)[order], list(FEATURES.values()))


def judge(stats: DataFrame, forest: Forest, threshold: float = 0.5) -> DataFrame:
    """The counts with base_failed, score and kept (false where base_failed)."""

    def build(batch: pa.RecordBatch) -> dict:
        c = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in [*COUNTS, *EXTRA]}
        failed = (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > MAX_REPEAT_PERCENT * c["n_words"])
        score = forest.score(feature_matrix(c))
        return {n: batch.column(n) for n in ["doc_id", *COUNTS]} | {
            "base_failed": pa.array(failed),
            "score": pa.array(score),
            "kept": pa.array(~failed & (score >= threshold)),
        }

    kind = stats.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, " + ", ".join(f"{n} long" for n in COUNTS) + ", base_failed boolean, score double, kept boolean"
    return map_texts(stats, schema, build)


def quality_table(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """One row per document: doc_id, counts, base_failed, score, kept.

    Null and empty texts have zero counts and fail the base rule. Repeated rows are judged alike,
    each for itself. Without labels, or with one class only, the score is the clipped share of
    label 1 (0.5 without labels) and the base rule decides. Other columns are not looked at.
    """
    stats = staged(document_statistics(docs), "statistics")
    return judge(stats, fit_rules(stats, labels, **settings))


def keep_good(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """The documents that the rules keep, in their own columns, read once more and judged in place."""
    forest = fit_rules(staged(document_statistics(docs), "statistics"), labels, **settings)
    names = [*COUNTS, *EXTRA]

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                texts = texts_as_bytes(batch)
                rows = np.array([statistics_of(t) for t in texts], np.int64).reshape(-1, len(names))
                c = {n: rows[:, i] for i, n in enumerate(names)}
                good = (c["n_words"] >= MIN_WORDS) & (100 * c["n_repeat_words"] <= MAX_REPEAT_PERCENT * c["n_words"])
                yield batch.filter(pa.array(good & (forest.score(feature_matrix(c)) >= 0.5)))

    return docs.mapInArrow(run, docs.schema)
