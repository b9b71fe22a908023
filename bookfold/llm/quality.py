"""Quality rules: base rules on document statistics, then boosted trees over them with monotonic constraints.

Statistics of each whole text are found in one pass of numpy work per document. The trees are trained on labelled
documents, at most ``max_labelled`` of them (those of smallest id hash), and scored over every document.

A document fails the base rules if it has fewer than 50 words, or more than half of its words stand in three-word
windows that occur twice or more. It is kept if it passes them and the trees' probability of good quality is at
least ``least_probability``.

Edge cases: a null text has no words and fails. Labels that are null or of unknown documents are left out; of
repeated labels each counts; repeated rows get equal verdicts. Without labels of both classes there are no trees, and
the base rules decide. Other columns play no part; their names do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookfold.llm.boosting import BoostedTrees, train_boosted_trees
from bookfold.llm.common import arrow_rows, only, shingle_sequence

SYMBOLS = "#*$%&|<>"
_SPACES = " \t\n\x0b\x0c\r"
_STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Features of the trees and the direction in which quality may move with each: 1 up, -1 down, 0 either.
FEATURES = {
    "log_words": 0,
    "mean_word_chars": 0,
    "symbol_share": -1,
    "dup_line_share": -1,
    "repeat_share": -1,
    "distinct_share": 0,
    "digit_share": -1,
    "upper_share": -1,
    "words_per_line": 0,
    "stop_share": 1,
    "longest_word": -1,
}
_ROWS = 512


def _encoded(text: str) -> bytes:
    return text.encode("utf-8", "replace")


def document_statistics(text: str | None) -> tuple[list[int], list[float]]:
    """The five base statistics (see _STATS) and the features of FEATURES, from the whole text."""
    text = text or ""
    words = _encoded(text).split()
    n = len(words)
    n_chars = len(text) - sum(map(text.count, _SPACES))
    n_symbols = sum(map(text.count, SYMBOLS))
    lines = [line for line in text.split("\n") if line.strip(_SPACES)]
    n_dup_lines = len(lines) - len(set(lines))
    n_repeat = 0
    if n > 2:
        windows = shingle_sequence(words, 3)
        _, group, sizes = np.unique(windows, return_inverse=True, return_counts=True)
        twice = sizes[group] > 1
        covered = np.zeros(n, bool)
        for k in range(3):
            covered[k : k + len(twice)] |= twice
        n_repeat = int(covered.sum())
    per = max(n, 1)
    chars = max(n_chars, 1)
    short = sum(len(w) <= 3 for w in words)
    features = [
        float(np.log1p(n)),
        n_chars / per,
        n_symbols / chars,
        n_dup_lines / max(len(lines), 1),
        n_repeat / per,
        len(set(words)) / per,
        sum(map(text.count, "0123456789")) / chars,
        sum(1 for w in words if w[:1].isupper()) / per,
        n / max(len(lines), 1),
        short / per,
        float(np.log1p(max(map(len, words), default=0))),
    ]
    return [n, n_chars, n_symbols, n_dup_lines, n_repeat], features


def base_failed(stats: list[int]) -> bool:
    n_words, n_repeat = stats[0], stats[4]
    return n_words < 50 or 100 * n_repeat > 50 * n_words


def train_quality(docs: DataFrame, labels: DataFrame, max_labelled: int = 10_000, label_column: str = "quality") -> BoostedTrees | None:
    """Trees from at most ``max_labelled`` labelled documents; None unless both classes occur."""
    marks = only(labels, doc_id="doc_id", label=label_column).dropna().filter(F.col("label").isin(0, 1))
    # Bounded by max_labelled rows of 16 bytes.
    marks = marks.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(max_labelled)
    rows = only(docs, doc_id="doc_id", text="text").join(F.broadcast(marks), "doc_id").select("text", "label")

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_rows(batches, _ROWS):
            features = [document_statistics(t)[1] for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("label").cast(pa.int32()), pa.array(features, pa.list_(pa.float64()))], names=["label", "x"])

    sample = rows.mapInArrow(featured, "label int, x array<double>").collect()
    y = np.array([r["label"] for r in sample], np.float64)
    if len(set(y)) < 2:
        return None
    x = np.array([r["x"] for r in sample])
    order = np.lexsort([y, *x.T])  # the same trees whatever order rows arrive in
    return train_boosted_trees(x[order], y[order], list(FEATURES.values()))


def judge_quality(docs: DataFrame, trees: BoostedTrees | None, least_probability: float = 0.5) -> DataFrame:
    """Per row: doc_id, the statistics, base_failed, probability (null without trees) and kept."""
    rows = only(docs, doc_id="doc_id", text="text")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_rows(batches, _ROWS):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *_verdicts(batch.column("text"), trees, least_probability)], names=["doc_id", *_VERDICT])

    return rows.mapInArrow(judged, f"doc_id {kind}, " + ", ".join(f"{s} long" for s in _STATS) + ", base_failed boolean, probability double, kept boolean")


def keep_good(docs: DataFrame, trees: BoostedTrees | None, least_probability: float = 0.5) -> DataFrame:
    """The rows that are kept, all columns as they are."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_rows(batches, _ROWS):
            yield batch.filter(_verdicts(batch.column(place), trees, least_probability)[-1])

    place = docs.columns.index("text")
    return docs.mapInArrow(kept, docs.schema)


_VERDICT = [*_STATS, "base_failed", "probability", "kept"]


def _verdicts(texts: pa.Array, trees: BoostedTrees | None, least_probability: float) -> list[pa.Array]:
    found = [document_statistics(t) for t in texts.to_pylist()]
    failed = np.array([base_failed(s) for s, _ in found], bool)
    kept = ~failed
    probability = pa.nulls(len(found), pa.float64())
    if trees is not None and found:
        p = trees.probability(np.array([x for _, x in found]))
        kept &= p >= least_probability
        probability = pa.array(p)
    stats = [pa.array([s[k] for s, _ in found], pa.int64()) for k in range(len(_STATS))]
    return [*stats, pa.array(failed), probability, pa.array(kept)]
