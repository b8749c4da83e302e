"""Quality by co-training two views of a document: its text and its page's metadata.

Each view has a naive Bayes classifier over a fixed number of features that are
there or not: hashed words and binned statistics of the text, or language, source
and length. The words of a text speak for much the same thing, so their evidence is
averaged and counts as ``VOICES`` features, however many they are. In each round a view's confident verdicts on documents without a label train the other
view. A view's log odds are calibrated on labelled documents held out from
training; in the end the calibrated log odds of both are combined and calibrated
again, and score every document.

A round is two aggregates over the features table, by feature and by bin of the
log odds; the driver sees the sums (a few thousand numbers of fixed count), so all
labelled and all confident documents train, whatever their number.

Defined results: null text has no words; null language, source or length is a
feature of its own. Labels that are null, or for no document, are left out; a
document with several labels goes by their mean, ties to good. Without labels of
both kinds every probability is one half. Repeated rows are scored alike. An empty
table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnworks.llm.quality_rules import text_counts
from tarnworks.llm.text import documents
from tarnworks.session import staged

QUERY = "op4_quality_classifier"

#: Features of the text: hashed words, then eight bins for each statistic; and of the metadata.
WORDS = 2048
BINNED = 64
META = 1024
VOICES = 4.0
ROUNDS = 3
SURE = 0.95
#: A feature counts when its log ratio is so many standard errors from 0.
CLEAR = 3.0
#: Of the labelled documents, one in so many calibrates.
HOLD_OUT = 5
_BINS = 256
_REACH = 64.0


def _bin(value: float, edges: tuple[float, ...]) -> int:
    return sum(value >= e for e in edges)


def text_features(text: str | None) -> list[int]:
    """Distinct hashed words below WORDS, and one feature for the bin of each statistic from there on."""
    n, chars, symbols, dup_lines, repeats, lines = text_counts(text)
    words = max(n, 1)
    found = {xxhash.xxh3_64_intdigest(w) % WORDS for w in set(text.encode("utf-8", "surrogatepass").lower().split())} if text else set()
    length = max(len(text or ""), 1)
    upper = sum(map(str.isupper, text)) / length if text else 0.0
    digits = sum(map(str.isdigit, text)) / length if text else 0.0
    stats = (
        _bin(n, (1, 10, 30, 60, 120, 250, 500)),
        _bin(chars / words, (3, 4, 4.5, 5, 5.5, 6, 7)),
        _bin(symbols / words, (0.001, 0.01, 0.05, 0.1, 0.3, 0.6, 1)),
        _bin(dup_lines / max(lines, 1), (0.001, 0.05, 0.1, 0.2, 0.3, 0.5, 0.7)),
        _bin(repeats / words, (0.001, 0.02, 0.05, 0.1, 0.2, 0.4, 0.7)),
        _bin(upper, (0.005, 0.01, 0.02, 0.05, 0.1, 0.2, 0.4)),
        _bin(digits, (0.0001, 0.001, 0.005, 0.01, 0.05, 0.1, 0.3)),
    )
    return [*found, *(WORDS + 8 * k + b for k, b in enumerate(stats))]


def meta_features(lang: str | None, source: str | None, n_chars: int | None) -> list[int]:
    size = "null" if n_chars is None else str(int(math.log2(max(n_chars, 1))))
    said = (f"lang {lang!r}", f"source {source!r}", f"size {size}", f"both {lang!r} {source!r}")
    return [xxhash.xxh3_64_intdigest(s) % META for s in said]


def _bits(lists: list[list[int]], size: int) -> pa.Array:
    """A row of bits for each list, as bytes."""
    table = np.zeros((len(lists), size), np.uint8)
    for row, found in zip(table, lists):
        row[found] = 1
    return pa.array([row.tobytes() for row in np.packbits(table, axis=1)], pa.binary())


def _table(view: pa.Array) -> np.ndarray:
    """Rows of 0 and 1 from a column of bits."""
    rows = [np.frombuffer(b.as_py(), np.uint8) for b in view]
    return np.unpackbits(np.stack(rows), axis=1) if rows else np.zeros((0, 8), np.uint8)


#: Rows whose bits are spread out at a time.
_ROWS = 1024


def features(docs: DataFrame) -> DataFrame:
    """doc_id, text_view, meta_view: the features of both views as bits."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, _ROWS):
                part = batch.slice(start, _ROWS)
                texts = [text_features(t.as_py()) for t in part.column(1)]
                metas = [meta_features(*row) for row in zip(*[part.column(k).to_pylist() for k in (2, 3, 4)])]
                yield pa.RecordBatch.from_arrays([part.column(0), _bits(texts, WORDS + BINNED), _bits(metas, META)], names=["doc_id", "text_view", "meta_view"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "lang", "source", F.col("n_chars").cast("bigint").alias("n_chars"))
    return rows.mapInArrow(extract, "doc_id bigint, text_view binary, meta_view binary")


@dataclass
class View:
    """Log odds of features, and the line that calibrates their sum."""

    weights: np.ndarray
    bias: float
    words: int
    slope: float = 1.0
    offset: float = 0.0

    def odds(self, table: np.ndarray) -> np.ndarray:
        words = table[:, : self.words]
        said = words @ self.weights[: self.words] * (VOICES / np.maximum(words.sum(axis=1, dtype=np.int64), VOICES))
        return said + table[:, self.words :] @ self.weights[self.words :] + self.bias

    def calibrated(self, table: np.ndarray) -> np.ndarray:
        return self.slope * self.odds(table) + self.offset


def _sure(odds: np.ndarray) -> np.ndarray:
    """1, 0 or -1: confidently good or bad, or neither."""
    edge = math.log(SURE / (1 - SURE))
    return np.where(odds >= edge, 1, np.where(odds <= -edge, 0, -1))


def _bayes(counts: np.ndarray, totals: np.ndarray, words: int) -> View:
    """counts: feature by class; totals: documents by class; words: features that are averaged."""
    rate = (counts + 0.5) / (totals + 1.0)
    ratio = np.log(rate[:, 1] / rate[:, 0])
    error = np.sqrt((1 / (counts + 0.5)).sum(axis=1))
    return View(np.where(np.abs(ratio) >= CLEAR * error, ratio, 0.0), math.log((totals[1] + 1) / (totals[0] + 1)), words)


def _line(x: np.ndarray, good: np.ndarray, bad: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic line through binned log odds, by Newton steps with a weak pull to (1, 0)."""
    slope, offset = 1.0, 0.0
    n = good + bad
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * x + offset, -500, 500)))
        g = np.array([((good - n * p) * x).sum() - (slope - 1), (good - n * p).sum() - offset])
        w = n * p * (1 - p)
        h = np.array([[(w * x * x).sum() + 1, (w * x).sum()], [(w * x).sum(), w.sum() + 1]])
        step = np.clip(np.linalg.solve(h, g), -1, 1)
        slope, offset = slope + step[0], offset + step[1]
        if np.abs(step).max() < 1e-9:
            break
    return max(float(slope), 0.0), float(offset)


def _training_sums(rows: DataFrame, text: View | None, meta: View | None) -> tuple[np.ndarray, ...]:
    """Counts by feature and class, and documents by class, for both views."""
    sizes = (WORDS + BINNED, META)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, totals = [np.zeros((n, 2)) for n in sizes], np.zeros((2, 2))
        for batch in _parts(batches):
            label = batch.column(2).to_numpy(zero_copy_only=False)
            tables = [_table(batch.column(0)), _table(batch.column(1))]
            teachers = (meta, text)  # each view learns from the other's verdicts
            for k in (0, 1):
                y = label
                if teachers[k] is not None:
                    y = np.where(label >= 0, label, _sure(teachers[k].calibrated(tables[1 - k])))
                for c in (0, 1):
                    sums[k][:, c] += tables[k][y == c].sum(axis=0, dtype=np.int64)
                    totals[k, c] += (y == c).sum()
        every = np.concatenate([*sums, totals])
        for c in (0, 1):
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(every))), pa.array(np.full(len(every), c)), pa.array(every[:, c])], names=["feature", "class", "n"])

    found = rows.select("text_view", "meta_view", "label").mapInArrow(count, "feature bigint, class bigint, n double").groupBy("feature", "class").agg(F.sum("n").alias("n"))
    every = np.zeros((sum(sizes) + 2, 2))
    for r in found.collect():  # two numbers a feature
        every[r.feature, r["class"]] = r.n
    return every[: sizes[0]], every[sizes[0] : -2], every[-2], every[-1]


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, _ROWS):
            yield batch.slice(start, _ROWS)


def _calibration(held: DataFrame, odds: list[Callable]) -> list[tuple[float, float]]:
    """The calibrating line of each function from the two views' features to log odds."""
    centre = (np.arange(_BINS) + 0.5) * (2 * _REACH / _BINS) - _REACH

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(odds), 2, _BINS))
        for batch in _parts(batches):
            label = batch.column(2).to_numpy(zero_copy_only=False)
            tables = _table(batch.column(0)), _table(batch.column(1))
            for k, f in enumerate(odds):
                at = np.clip((f(*tables) + _REACH) / (2 * _REACH) * _BINS, 0, _BINS - 1).astype(int)
                for c in (0, 1):
                    sums[k, c] += np.bincount(at[label == c], minlength=_BINS)
        k, c, b = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(c), pa.array(b), pa.array(sums[k, c, b])], names=["line", "class", "bin", "n"])

    table = held.select("text_view", "meta_view", "label").mapInArrow(count, "line bigint, class bigint, bin bigint, n double")
    sums = np.zeros((len(odds), 2, _BINS))
    for r in table.groupBy("line", "class", "bin").agg(F.sum("n").alias("n")).collect():  # a number a bin
        sums[r["line"], r["class"], r["bin"]] = r.n
    return [_line(centre, good, bad) for bad, good in sums]


def train(rows: DataFrame) -> tuple[View, View, tuple[float, float]] | None:
    """The two views, and the line over the sum of their calibrated log odds."""
    fit = rows.where("held IS NULL")
    held = rows.where("held IS NOT NULL").withColumn("label", F.col("held"))
    text = meta = None
    for _ in range(ROUNDS):
        text_sums, meta_sums, text_total, meta_total = _training_sums(fit, text, meta)
        if not text_total.all() or not meta_total.all():
            return None
        text, meta = _bayes(text_sums, text_total, WORDS), _bayes(meta_sums, meta_total, 0)
        lines = _calibration(held, [lambda t, m: text.odds(t), lambda t, m: meta.odds(m)])  # noqa: B023
        (text.slope, text.offset), (meta.slope, meta.offset) = lines
    return text, meta, _calibration(held, [lambda t, m: text.calibrated(t) + meta.calibrated(m)])[0]


def with_labels(found: DataFrame, labels: DataFrame) -> DataFrame:
    """``found`` with label: 1, 0, or -1 without one, and held: the label if it calibrates."""
    quality = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("bigint").alias("l_id")).agg((F.avg("quality") >= 0.5).cast("int").alias("quality"))
    rows = found.join(quality, F.col("doc_id") == F.col("l_id"), "left")
    held = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % HOLD_OUT == 0, F.col("quality"))
    return rows.select("doc_id", "text_view", "meta_view", F.coalesce("quality", F.lit(-1)).cast("int").alias("label"), held.alias("held"))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row for each row of ``docs``: doc_id, p_text, p_meta, p_good and good."""
    rows = staged(with_labels(features(docs), labels), "cotrain-features")
    model = train(rows)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            if model is None:
                odds = [np.zeros(batch.num_rows)] * 3
            else:
                text, meta, (slope, offset) = model
                odds = [text.calibrated(_table(batch.column(1))), meta.calibrated(_table(batch.column(2)))]
                odds.append(slope * (odds[0] + odds[1]) + offset)
            shares = [1 / (1 + np.exp(-np.clip(o, -500, 500))) for o in odds]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, shares), pa.array(shares[2] >= 0.5)], names=["doc_id", "p_text", "p_meta", "p_good", "good"])

    return rows.select("doc_id", "text_view", "meta_view").mapInArrow(score, "doc_id bigint, p_text double, p_meta double, p_good double, good boolean")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
