"""Toxicity by cumulative-link ordinal regression.

Documents get a severity grade 0..3.  The labels tell toxic from clean only, so the grades of the
labelled sample are: 0 for clean documents, and 1 to 3 for toxic ones by the number of their words
that hardly occur in clean ones.  One weight vector is shared by the three thresholds:
``P(grade > k) = sigmoid(score - threshold[k])``; the output is the expected severity.

Features are sparse: the log counts of selected words and of the first ``PREFIX`` bytes of longer
words, looked up by 64-bit hash.  Selection and fitting use a sample of at most ``SAMPLE`` labelled
documents of either class, chosen by a hash of the id; scoring reads every whole text.

Defined results: a null or empty text has no features and gets the severity of that; rows with the
same id are scored one by one; without labels of both classes every document has severity 0 and none
is toxic.  Of the documents only ``keep``, the id and the text are read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.llm.words import FOLDED_VALUES, Hasher, flat, mix, pieces, signed, word_bounds

SAMPLE = 2000
FEATURES = 4096
MIN_DOCUMENTS = 3
PREFIX = 5
GRADES = 3
STEPS, RATE, RIDGE = 400, 0.5, 1e-3
TOXIC_FROM = 0.5

# Letters, digits and everything beyond ASCII.
LETTERS = np.zeros(256, dtype=bool)
LETTERS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
PREFIX_MARK = np.uint64(0x5851F42D4C957F2D)


def features(column: pa.Array, hasher: Hasher) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of words and of prefixes of longer words, and the row of each."""
    data, offsets = flat(column)
    starts, ends, first = word_bounds(LETTERS[data], offsets)
    sums = hasher.totals(data)
    row = np.repeat(np.arange(len(column)), np.diff(first))
    whole = hasher.ranges(sums, starts, ends)
    long = ends - starts > PREFIX
    heads = mix(hasher.ranges(sums, starts[long], starts[long] + PREFIX) ^ PREFIX_MARK)
    return np.concatenate((whole, heads)), np.concatenate((row, row[long]))


@dataclass
class OrdinalModel:
    """Weights of the hashed features (sorted), one set for all thresholds."""

    hashes: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def severity(self, column: pa.Array, hasher: Hasher) -> np.ndarray:
        found, row = features(column, hasher)
        at = np.searchsorted(self.hashes, found)
        known = at < len(self.hashes)
        known[known] = self.hashes[at[known]] == found[known]
        at, row = at[known], row[known]
        place, counts = np.unique(row * max(len(self.hashes), 1) + at, return_counts=True)
        value = np.log1p(counts) * self.weights[place % max(len(self.hashes), 1)]
        score = np.bincount(place // max(len(self.hashes), 1), value, minlength=len(column))
        return sigmoid(score[:, None] - self.thresholds[None, :]).sum(axis=1)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def no_model() -> OrdinalModel:
    return OrdinalModel(np.zeros(0, np.uint64), np.zeros(0), np.full(GRADES, 60.0))


def fit_ordinal(hashes: list[np.ndarray], counts: list[np.ndarray], toxic: np.ndarray) -> OrdinalModel:
    """Fit on documents given as feature hashes with counts."""
    if not toxic.any() or toxic.all():
        return no_model()
    flat_hashes = np.concatenate(hashes)
    row = np.repeat(np.arange(len(hashes)), [len(h) for h in hashes])
    names, feature = np.unique(flat_hashes, return_inverse=True)
    bad = np.bincount(feature, toxic[row], minlength=len(names))
    good = np.bincount(feature, ~toxic[row], minlength=len(names))
    odds = np.log((bad + 0.5) / (toxic.sum() + 1)) - np.log((good + 0.5) / ((~toxic).sum() + 1))
    often = bad + good >= MIN_DOCUMENTS
    strength = np.where(often, np.abs(odds) * np.sqrt(bad + good), -1)
    chosen = np.sort(np.argsort(-strength, kind="stable")[:FEATURES])
    chosen = chosen[strength[chosen] > 0]
    column = np.full(len(names), -1)
    column[chosen] = np.arange(len(chosen))
    value = np.log1p(np.concatenate(counts).astype(float))
    used = column[feature] >= 0
    row, col, value = row[used], column[feature][used], value[used]
    # Grades of the toxic documents by the words that clean documents hardly have.
    telling = (odds > 2)[chosen][col]
    evidence = np.bincount(row[telling], value[telling], minlength=len(toxic))
    cuts = np.quantile(evidence[toxic], np.arange(1, GRADES) / GRADES)
    grade = np.where(toxic, 1 + np.searchsorted(cuts, evidence, side="left"), 0)
    return _descend(row, col, value, grade, names[chosen])


def _descend(row, col, value, grade, names) -> OrdinalModel:
    """Batch gradient steps with per-weight scaling on the cumulative log loss."""
    n = len(grade)
    above = (grade[:, None] > np.arange(GRADES)[None, :]).astype(float)
    share = np.clip(above.mean(axis=0), 1e-3, 1 - 1e-3)
    thresholds = np.log((1 - share) / share)
    weights = np.zeros(len(names))
    seen_w, seen_t = np.full(len(names), 1e-8), np.full(GRADES, 1e-8)
    for _ in range(STEPS):
        score = np.bincount(row, value * weights[col], minlength=n)
        error = sigmoid(score[:, None] - thresholds[None, :]) - above
        slope_w = np.bincount(col, value * error.sum(axis=1)[row], minlength=len(names)) / n + RIDGE * weights
        slope_t = -error.mean(axis=0)
        seen_w += slope_w**2
        seen_t += slope_t**2
        weights -= RATE * slope_w / np.sqrt(seen_w)
        thresholds -= RATE * slope_t / np.sqrt(seen_t)
        thresholds = np.maximum.accumulate(thresholds)
    return OrdinalModel(names, weights, thresholds)


def fit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic") -> OrdinalModel:
    """Fit on at most ``SAMPLE`` labelled documents of either class.

    Only their hashed features with counts reach the driver.
    """
    labels = labels.select(F.col(id).alias("_id"), (F.col(label) > 0).alias("_toxic")).where(
        F.col("_id").isNotNull() & F.col("_toxic").isNotNull()
    )
    order = [F.xxhash64("_id"), F.col("_id")]
    taken = [
        labels.where(F.col("_toxic") == wanted).distinct().orderBy(*order).limit(SAMPLE)
        for wanted in (True, False)
    ]
    ids = docs.sparkSession.createDataFrame(
        [tuple(r) for part in taken for r in part.collect()], labels.schema
    )
    sample = docs.select(F.col(id).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(ids), "_id")
    # Repeated ids may bring more rows than there are labels.
    sample = sample.select("_toxic", "_text").limit(2 * SAMPLE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(FOLDED_VALUES)
        for batch in batches:
            for at, column in pieces(batch.column(1)):
                found, row = features(column, hasher)
                hashes, counts = [], []
                for k in range(len(column)):
                    h, c = np.unique(found[row == k], return_counts=True)
                    hashes.append(signed(h))
                    counts.append(c)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(column)),
                        pa.array(hashes, pa.list_(pa.int64())),
                        pa.array(counts, pa.list_(pa.int64())),
                    ],
                    names=["toxic", "hashes", "counts"],
                )

    rows = sample.mapInArrow(run, "toxic boolean, hashes array<long>, counts array<long>").toArrow()
    if not rows.num_rows:
        return no_model()
    # Views of the Arrow buffers: lists of Python numbers would take some times their size.
    hashes = [h.values.to_numpy().view(np.uint64) for h in rows["hashes"]]
    counts = [c.values.to_numpy() for c in rows["counts"]]
    model = fit_ordinal(hashes, counts, np.array(rows["toxic"].to_pylist(), dtype=bool))
    del rows, hashes, counts
    pa.default_memory_pool().release_unused()
    return model


def score(
    df: DataFrame, model: OrdinalModel, text: str = "text", keep: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """``keep, severity, grade, toxic``: expected severity, rounded to a grade, of every row."""
    more = [("severity", T.DoubleType()), ("grade", T.LongType()), ("toxic", T.BooleanType())]
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(*m) for m in more])
    place = list(keep).index(text) if text in keep else len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(FOLDED_VALUES)
        for batch in batches:
            for at, column in pieces(batch.column(place)):
                severity = model.severity(column, hasher)
                taken = batch.slice(at, len(column))
                yield pa.RecordBatch.from_arrays(
                    [
                        *taken.columns[: len(keep)],
                        pa.array(severity),
                        pa.array(np.rint(severity).astype(np.int64)),
                        pa.array(severity >= TOXIC_FROM),
                    ],
                    names=[*keep, *(m[0] for m in more)],
                )

    # A text that is kept anyway is read from there, and not sent twice.
    read = [] if text in keep else [F.col(text).alias("_read")]
    return df.select(*keep, *read).mapInArrow(run, schema)
