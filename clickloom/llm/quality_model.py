"""Quality classifier: learned vectors of hashed words and character n-grams, averaged per document, and a softmax.

Training: a bounded sample of labelled rows (about ``per_label`` of each label, at most twice that) is turned
into bucket counts by Spark tasks and fitted on the driver by numpy stochastic gradient descent. Scoring: the output
layer is linear in the average, so each bucket's vector is folded into one number per label difference; a task sums
these over whole texts and nothing is shuffled.

Features of a text: its words, its byte n-grams, and a marker for each word equal to the word before it. Labels, languages, sources and ids are no inputs.

Defined cases: a null or empty text has no feature and gets the score of the bias; without labelled rows all scores are
0.5; null labels and ids are not learned from; other columns pass through; an empty table gives no rows.
"""

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType

from clickloom.llm.common import annotated, bounded_sample, free_name, same_columns
from clickloom.llm.word_ids import joined, mixed, span_hashes, spans

BUCKETS = 1 << 16
DIMENSIONS = 16
GRAMS = (3, 4, 5)
PER_LABEL = 1000
SAMPLE_TASKS = 8
EPOCHS = 6
RATE = 0.5
STEP_BYTES = 2 << 20
COLUMN = "quality_score"
IN_WORD = np.ones(256, bool)
IN_WORD[[0x20, *range(0x09, 0x0E)]] = False


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all features of all texts, and the text of each."""
    width = max(GRAMS)
    data, offsets = joined(texts, b"\n" * width)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(offsets))
    starts, ends = spans(IN_WORD[data])
    hashes = span_hashes(data, starts, ends)
    of = owner[starts] if len(starts) else np.empty(0, np.int32)
    buckets, owners = [(hashes >> np.uint64(40)).astype(np.uint32) % BUCKETS], [of]
    again = np.flatnonzero((hashes[1:] == hashes[:-1]) & (of[1:] == of[:-1])) if len(starts) else starts
    buckets.append(np.zeros(len(again), np.uint32))
    owners.append(of[again] if len(again) else np.empty(0, np.int32))
    rolling = np.zeros(len(data), np.uint32)
    text_end = (offsets[1:] - width)[owner]
    place = np.arange(len(data))
    for n in range(1, width + 1):
        # The hash of the n bytes from each place on; places near the end have fewer and are not used.
        rolling[:len(data) - n + 1] = rolling[:len(data) - n + 1] * np.uint32(0x01000193) ^ data[n - 1:]
        if n in GRAMS:
            used = np.flatnonzero(place + n <= text_end)
            spread = (rolling[used] ^ np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
            buckets.append((spread ^ spread >> np.uint32(15)) % np.uint32(BUCKETS))
            owners.append(owner[used])
    return np.concatenate(buckets), np.concatenate(owners)


def parts(texts: list[str | None], limit: int = STEP_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Groups of texts of about ``limit`` bytes; a longer text comes in pieces, so that memory stays bounded."""
    group, first, size = [], 0, 0
    for i, text in enumerate(texts):
        body = (text or "").encode()
        if group and size + len(body) > limit:
            yield first, group
            group, size = [], 0
        if not group:
            first = i
        while len(body) > limit:
            yield i, [body[:limit]]
            body = body[limit - max(GRAMS) + 1:]
        if not group:
            first = i
        group.append(body)
        size += len(body)
    if group:
        yield first, group


@dataclass(frozen=True)
class Model:
    """weights[b] is what bucket b adds, on average, to the log-odds of label 1."""
    weights: np.ndarray
    bias: float

    def log_odds(self, texts: list[str | None]) -> np.ndarray:
        total, count = np.zeros(len(texts)), np.zeros(len(texts))
        for first, group in parts(texts):
            buckets, owners = features(group)
            total[first:first + len(group)] += np.bincount(owners, self.weights[buckets], len(group))
            count[first:first + len(group)] += np.bincount(owners, minlength=len(group))
        return self.bias + total / np.maximum(count, 1)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.log_odds(texts), -500, 500)))


def counted(rows: DataFrame) -> DataFrame:
    """label, and the distinct buckets of each text with their shares of its features, as arrays."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                counts = np.zeros(BUCKETS)
                for _, group in parts([text]):
                    counts += np.bincount(features(group)[0], minlength=BUCKETS)
                at = np.flatnonzero(counts)
                out.append((at.astype("<u2").tobytes(), (counts[at] / counts.sum()).astype("<f4").tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), *(pa.array([x[i] for x in out], pa.binary()) for i in range(2))],
                ["label", "buckets", "shares"])

    return rows.select("label", "text").mapInArrow(run, "label int, buckets binary, shares binary")


def sample(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> DataFrame:
    """About ``per_label`` rows (label int, text) of each label 0 and 1. ``labels`` has doc_id and label."""
    chosen = None
    for value in (0, 1):
        ids = labels.where((F.col("label") == value) & F.col("doc_id").isNotNull()).select("doc_id").distinct()
        some = bounded_sample(ids, per_label, "doc_id").withColumn("label", F.lit(value))
        chosen = some if chosen is None else chosen.unionByName(some)
    # Ids may repeat in docs: the limit holds for rows, too.
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("label", "text").limit(
        4 * per_label).repartition(SAMPLE_TASKS)


def train(rows: list[tuple[int, np.ndarray, np.ndarray]], epochs: int = EPOCHS, rate: float = RATE,
          seed: int = 0) -> Model:
    """Fit vectors and output layer by stochastic gradient descent, one document a step."""
    draw = np.random.default_rng(seed)
    vectors = draw.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS))
    output, bias = np.zeros((DIMENSIONS, 2)), np.zeros(2)
    for epoch in range(epochs if {label for label, _, _ in rows} == {0, 1} else 0):
        step = rate * (1 - epoch / epochs)
        for i in draw.permutation(len(rows)):
            label, buckets, shares = rows[i][0], rows[i][1].astype(np.int64), rows[i][2].astype(float)
            mean = shares @ vectors[buckets]
            logits = mean @ output + bias
            logits -= logits.max()
            error = np.exp(logits) / np.exp(logits).sum()
            error[label] -= 1
            back = output @ error
            output -= step * np.outer(mean, error)
            bias -= step * error
            # Rare shares move little; scaled so that a document moves its average by a whole step.
            vectors[buckets] -= (step / max(float(shares @ shares), 1e-3)) * np.outer(shares, back)
    side = output[:, 1] - output[:, 0]
    return Model(vectors @ side, float(bias[1] - bias[0]))


def fit(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL, epochs: int = EPOCHS, seed: int = 0) -> Model:
    # Views of the collected bytes, six a bucket: the sample takes some 30 kB a document on the driver.
    rows = [(label, np.frombuffer(buckets, "<u2"), np.frombuffer(shares, "<f4"))
            for label, buckets, shares in counted(sample(docs, labels, per_label)).collect()]
    rows.sort(key=lambda row: (row[0], len(row[1]), row[1].tobytes(), row[2].tobytes()))
    model = train(rows, epochs, seed=seed)
    known = dict(labels.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)).groupBy("label")
                 .agg(F.count_distinct("doc_id")).collect())
    seen = Counter(label for label, _, _ in rows)
    if len(seen) < 2:
        return model
    # The sample has about as many rows of either label; the bias is set back to how frequent the labels are.
    return Model(model.weights, model.bias + math.log(known[1] / known[0] * seen[0] / seen[1]))


def score(docs: DataFrame, model: Model, column: str = COLUMN) -> DataFrame:
    """The documents with all their columns and ``column``, the probability of label 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return annotated(docs, column, DoubleType(), lambda texts: pa.array(shared.value.scores(texts), pa.float64()))


def keep_good(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The documents with a score of ``least`` or more, with the columns they came with."""
    column = free_name(docs, COLUMN)
    return same_columns(score(docs, model, column).where(F.col(column) >= least), docs)
