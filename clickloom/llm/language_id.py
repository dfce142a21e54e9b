"""Language identification by a byte convolutional network: filters of several widths, max pooling, softmax.

A text is cut into windows of a fixed number of bytes that overlap by the widest filter, so that no n-gram is missed and
memory does not grow with the text. All windows of a batch go through the network together; a document's logits are the
average of its windows' by bytes. Training takes a bounded sample of labelled rows (about ``rows``, at most twice that,
``per_text`` windows of each, spread over the whole text) to the driver and fits in numpy.

Defined cases: null texts and texts without a letter are ``und`` with score 0, and so is every text when no row has a
language; rows without a language are not learned from; other columns pass through; an empty table gives no rows.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from clickloom.llm.common import annotated, bounded_sample

WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 16
DEPTH = 8
SAMPLE_ROWS, SAMPLE_WINDOWS = 3000, 4
EPOCHS, BATCH, RATE = 6, 64, 0.01
STEP_WINDOWS = 256
UNKNOWN = "und"
COLUMN = "language"
FIELDS = StructType([StructField("lang", StringType()), StructField("score", DoubleType())])
STRIDE = WINDOW - max(WIDTHS) + 1


def windows(body: bytes) -> tuple[np.ndarray, np.ndarray]:
    """All windows of a text, the last filled with zeros, and the bytes that each adds."""
    n = max(1, -(-(len(body) - (WINDOW - STRIDE)) // STRIDE))
    data = np.zeros(n * STRIDE + WINDOW - STRIDE, np.uint8)
    data[:len(body)] = np.frombuffer(body, np.uint8)
    sizes = np.full(n, STRIDE)
    sizes[-1] = len(body) - STRIDE * (n - 1)
    return np.lib.stride_tricks.sliding_window_view(data, WINDOW)[::STRIDE], sizes


class Network:
    """Parameters as arrays; ``langs`` names the outputs."""

    def __init__(self, langs: list[str], seed: int = 0):
        draw = np.random.default_rng(seed)
        self.langs = langs
        self.embedding = draw.normal(0, 0.5, (256, DEPTH)).astype(np.float32)
        self.filters = [draw.normal(0, (w * DEPTH) ** -0.5, (w, DEPTH, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.biases = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        self.output = draw.normal(0, 0.1, (FILTERS * len(WIDTHS), len(langs))).astype(np.float32)
        self.bias = np.zeros(len(langs), np.float32)
        self.tables = None

    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, *self.filters, *self.biases, self.output, self.bias]

    def fold(self) -> "Network":
        """Embedding and filters as one table per tap: what a byte at that place adds to every filter."""
        self.tables = [[np.ascontiguousarray(self.embedding @ f[k]) for k in range(f.shape[0])] for f in self.filters]
        return self

    def pooled(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The largest response of each filter in each window, and where it begins."""
        best, where = [], []
        for taps, bias in zip(self.tables, self.biases):
            n = WINDOW - len(taps) + 1
            response = taps[0][data[:, :n]]
            for k in range(1, len(taps)):
                response += taps[k][data[:, k:k + n]]
            at = response.argmax(1)
            best.append(np.take_along_axis(response, at[:, None], 1)[:, 0] + bias)
            where.append(at)
        return np.concatenate(best, 1), np.concatenate(where, 1)

    def logits(self, data: np.ndarray) -> np.ndarray:
        best = []
        for taps, bias in zip(self.tables, self.biases):
            n = WINDOW - len(taps) + 1
            response = taps[0][data[:, :n]]
            for k in range(1, len(taps)):
                response += taps[k][data[:, k:k + n]]
            best.append(response.max(1) + bias)
        return np.maximum(np.concatenate(best, 1), 0) @ self.output + self.bias

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Language and probability of each text."""
        known = [i for i, text in enumerate(texts) if self.langs and any(map(str.isalpha, text or ""))]
        out = [(UNKNOWN, 0.0)] * len(texts)
        total = np.zeros((len(texts), len(self.langs)))
        rows, sizes, owners, held = [], [], [], 0

        def run():
            data, weight = np.concatenate(rows), np.concatenate(sizes)
            np.add.at(total, np.concatenate(owners), self.logits(data) * weight[:, None])

        for i in known:
            data, size = windows(texts[i].encode())
            for at in range(0, len(data), STEP_WINDOWS):
                rows.append(data[at:at + STEP_WINDOWS])
                sizes.append(size[at:at + STEP_WINDOWS])
                owners.append(np.full(len(rows[-1]), i))
                held += len(rows[-1])
                if held >= STEP_WINDOWS:
                    run()
                    rows, sizes, owners, held = [], [], [], 0
        if held:
            run()
        for i in known:
            mean = total[i] / len(texts[i].encode())
            share = np.exp(mean - mean.max())
            best = int(share.argmax())
            out[i] = (self.langs[best], float(share[best] / share.sum()))
        return out


def train(data: np.ndarray, labels: np.ndarray, langs: list[str], epochs: int = EPOCHS, seed: int = 0) -> Network:
    """Fit by mini-batch gradient descent with adaptive moments; the gradient of max pooling goes to the best place."""
    net, draw = Network(langs, seed).fold(), np.random.default_rng(seed)
    first = [np.zeros_like(p) for p in net.parameters()]
    second = [np.zeros_like(p) for p in net.parameters()]
    step = 0
    for _ in range(epochs if len(data) else 0):
        order = draw.permutation(len(data))
        for at in range(0, len(order), BATCH):
            rows = order[at:at + BATCH]
            x, y = data[rows], labels[rows]
            pooled, where = net.pooled(x)
            hidden = np.maximum(pooled, 0)
            logits = hidden @ net.output + net.bias
            share = np.exp(logits - logits.max(1, keepdims=True))
            error = share / share.sum(1, keepdims=True)
            error[np.arange(len(y)), y] -= 1
            error /= len(y)
            back = (error @ net.output.T) * (pooled > 0)
            gradients = [np.zeros_like(net.embedding)]
            filters, biases = [], []
            for k, taps in enumerate(net.filters):
                part = slice(k * FILTERS, (k + 1) * FILTERS)
                grad, gain = np.zeros_like(taps), back[:, part]
                for tap in range(len(taps)):
                    seen = np.take_along_axis(x, where[:, part] + tap, 1)
                    grad[tap] = np.einsum("bfd,bf->df", net.embedding[seen], gain)
                    np.add.at(gradients[0], seen, gain[:, :, None] * taps[tap].T[None])
                filters.append(grad)
                biases.append(gain.sum(0))
            gradients += [*filters, *biases, hidden.T @ error, error.sum(0)]
            step += 1
            for p, g, m, v in zip(net.parameters(), gradients, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
            net.fold()
    return net


def sample(docs: DataFrame, rows: int = SAMPLE_ROWS, per_text: int = SAMPLE_WINDOWS) -> DataFrame:
    """About ``rows`` rows (lang, windows): the ``per_text`` windows of a text are spread over all of it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                data, _ = windows(text.encode())
                at = np.unique(np.linspace(0, len(data) - 1, per_text).astype(int))
                out.append(data[at].tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(out, pa.binary())], ["lang", "windows"])

    labelled = bounded_sample(docs.where(F.col("lang").isNotNull()), rows, "doc_id", "text")
    return labelled.where(F.col("text").rlike(r"\p{L}")).select("lang", "text").mapInArrow(
        run, "lang string, windows binary")


def fit(docs: DataFrame, rows: int = SAMPLE_ROWS, epochs: int = EPOCHS, seed: int = 0) -> Network:
    """Learn from doc_id (for the choice of the sample only), lang and text."""
    found = sorted(sample(docs, rows).collect())
    langs = sorted({lang for lang, _ in found})
    parts = [np.frombuffer(body, np.uint8).reshape(-1, WINDOW) for _, body in found]
    labels = [np.full(len(part), langs.index(lang)) for part, (lang, _) in zip(parts, found)]
    data = np.concatenate(parts) if parts else np.empty((0, WINDOW), np.uint8)
    return train(data, np.concatenate(labels) if labels else np.empty(0, int), langs, epochs, seed)


def identify(docs: DataFrame, network: Network) -> DataFrame:
    """The documents with all their columns and ``language`` (lang, score)."""
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def compute(texts: list) -> pa.Array:
        found = shared.value.predict(texts)
        return pa.StructArray.from_arrays([pa.array([x[0] for x in found], pa.string()),
                                           pa.array([x[1] for x in found], pa.float64())], FIELDS.names)

    return annotated(docs, COLUMN, FIELDS, compute)
