"""Quality scores from random-indexing word vectors and a two-layer network.

Random indexing gives every token a fixed sparse vector of +1 and -1; the vector of a word is the sum
of those of its neighbours over the whole corpus. A document is pooled from its words'
vectors: their mean, their spread, and how alike neighbours are. A small network learns the label from a bounded sample, and a temperature fitted on
rows it has not seen makes its outputs probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arborsync.llm.words import hash_runs, slices
from arborsync.staging import stage

BUCKETS = 4096  # words share a vector by hash; bounds what is gathered and sent
DIMENSIONS = 32
SPARSE = 4  # entries of a token's fixed vector
REACH = 2  # neighbours on either side
SAMPLE_ROWS = 6000  # labelled rows the network is fitted on (in expectation)
HIDDEN = 24
EPOCHS = 300

# 1: letters, digits and non-ASCII; 2: other printable ASCII; 0: white space and control.
_CLASS = np.zeros(256, dtype=np.int8)
_CLASS[0x21:0x7F] = 2
for _low, _high in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
    _CLASS[_low:_high] = 1


def tokens(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each token, bounds of each text); a token is a run of word or of punctuation characters."""
    plain = [t or b"" for t in texts]
    raw = np.frombuffer(b"\n".join([*plain, b"\0" * 8]), dtype=np.uint8)
    kind = _CLASS[raw]
    edges = np.flatnonzero(np.diff(kind, prepend=0, append=0))
    starts, lengths = edges[:-1], np.diff(edges)
    inside = kind[starts] > 0 if len(starts) else np.zeros(0, dtype=bool)
    starts, lengths = starts[inside], lengths[inside]
    text_starts = np.concatenate(([0], np.cumsum([len(t) + 1 for t in plain])))
    return (hash_runs(raw, starts, lengths) % np.uint64(BUCKETS)).astype(np.int64), np.searchsorted(starts, text_starts)


def _index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the fixed vector of each bucket."""
    draw = np.random.default_rng(41)
    places = np.argsort(draw.random((BUCKETS, DIMENSIONS)), axis=1)[:, :SPARSE]
    return places, draw.choice([-1.0, 1.0], size=(BUCKETS, SPARSE))


def context_sums(texts: list[bytes | None]) -> np.ndarray:
    """BUCKETS x DIMENSIONS sums of the neighbours' vectors; neighbours are within one text."""
    places, signs = _index_vectors()
    bucket, bounds = tokens(texts)
    text = np.repeat(np.arange(len(texts)), np.diff(bounds))
    total = np.zeros(BUCKETS * DIMENSIONS)
    for step in range(1, REACH + 1):
        together = np.flatnonzero(text[step:] == text[:-step])
        one, other = bucket[together], bucket[together + step]
        for word, near in ((one, other), (other, one)):
            row = word * DIMENSIONS
            for entry in range(SPARSE):
                total += np.bincount(row + places[near, entry], signs[near, entry], len(total))
    return total.reshape(BUCKETS, DIMENSIONS)


def word_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Word vectors from every text of ``docs``: centred, of length one (zero for buckets never met)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BUCKETS, DIMENSIONS))
        for batch in batches:
            for _, texts in slices(batch, "_bytes"):
                total += context_sums(texts)
        met = np.flatnonzero(total.any(axis=1))
        offsets = np.arange(len(met) + 1, dtype=np.int32) * DIMENSIONS
        sums = pa.array(total[met].astype(np.int64).ravel())
        yield pa.RecordBatch.from_arrays(
            [pa.array(met), pa.ListArray.from_arrays(pa.array(offsets), sums)], names=["bucket", "sums"])

    body = docs.select(F.col(f"`{text}`").cast("binary").alias("_bytes"))
    sums = body.mapInArrow(run, "bucket bigint, sums array<bigint>")
    added = sums.groupBy("bucket").agg(F.array(*[F.sum(F.col("sums")[i]) for i in range(DIMENSIONS)]).alias("sums"))
    vectors = np.zeros((BUCKETS, DIMENSIONS))
    for row in added.collect():  # at most BUCKETS rows
        vectors[row["bucket"]] = row["sums"]
    vectors -= vectors.sum(axis=0) / max(np.abs(vectors).sum(), 1.0) * np.abs(vectors).sum(axis=1, keepdims=True)
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.divide(vectors, length, out=np.zeros_like(vectors), where=length > 0).astype(np.float32)


def pool(texts: list[bytes | None], vectors: np.ndarray) -> np.ndarray:
    """Per text the mean and the spread of its tokens' vectors, how alike neighbours are, and the
    logarithm of the number of tokens."""
    bucket, bounds = tokens(texts)
    size = np.diff(bounds)
    total, square = np.zeros((2, len(texts), DIMENSIONS))
    alike = np.zeros(len(texts))
    text = np.repeat(np.arange(len(texts)), size)
    for begin in range(0, len(bucket), 1 << 18):
        end = min(begin + (1 << 18), len(bucket))
        own, row = text[begin:end], vectors[bucket[begin:end]]
        first = np.flatnonzero(np.diff(own, prepend=-1))
        total[own[first]] += np.add.reduceat(row, first, axis=0)
        square[own[first]] += np.add.reduceat(row * row, first, axis=0)
        inner = np.flatnonzero(text[begin + 1 : end + 1] == text[begin : min(end, len(text) - 1)])
        near = vectors[bucket[begin + 1 : end + 1][inner]]
        alike += np.bincount(own[inner], np.einsum("ij,ij->i", row[inner], near), len(texts))
    count = np.maximum(size, 1)[:, None]
    mean = total / count
    spread = np.sqrt(np.maximum(square / count - mean**2, 0))
    return np.hstack((mean, spread, (alike / count[:, 0])[:, None], np.log1p(size)[:, None])).astype(np.float32)


@dataclass
class Network:
    centre: np.ndarray
    scale: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: float
    temperature: float = 1.0

    def logit(self, features: np.ndarray) -> np.ndarray:
        inner = np.tanh((features - self.centre) / self.scale @ self.hidden + self.hidden_bias)
        return inner @ self.out + self.out_bias

    def probability(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(features) / self.temperature, -40, 40)))


def _loss(logit: np.ndarray, label: np.ndarray, temperature: float) -> float:
    z = logit / temperature
    return float(np.mean(np.logaddexp(0, z) - label * z))


def fit(features: np.ndarray, label: np.ndarray, epochs: int = EPOCHS, seed: int = 3) -> Network:
    """Fit on four fifths of the rows by full gradient steps, the temperature on the rest."""
    draw = np.random.default_rng(seed)
    order = draw.permutation(len(label))
    held, own = order[: len(order) // 5], order[len(order) // 5 :]
    centre, scale = features[own].mean(axis=0), features[own].std(axis=0) + 1e-3
    x, y = (features[own] - centre) / scale, label[own].astype(float)
    weights = [draw.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN), draw.normal(0, 0.3, HIDDEN), np.zeros(1)]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for epoch in range(1, epochs + 1):
        inner = np.tanh(x @ weights[0] + weights[1])
        error = (1 / (1 + np.exp(-np.clip(inner @ weights[2] + weights[3], -40, 40))) - y) / len(y)
        back = np.outer(error, weights[2]) * (1 - inner**2)
        slopes = [x.T @ back + 1e-4 * weights[0], back.sum(axis=0), inner.T @ error + 1e-4 * weights[2], error.sum(keepdims=True)]
        for i, slope in enumerate(slopes):
            first[i] = 0.9 * first[i] + 0.1 * slope
            second[i] = 0.99 * second[i] + 0.01 * slope**2
            weights[i] -= 0.02 * (first[i] / (1 - 0.9**epoch)) / (np.sqrt(second[i] / (1 - 0.99**epoch)) + 1e-8)
    net = Network(centre, scale, weights[0], weights[1], weights[2], float(weights[3][0]))
    if len(held):
        logit = net.logit(features[held])
        net.temperature = min(np.geomspace(0.3, 5, 41).tolist(), key=lambda t: _loss(logit, label[held], t))
    return net


def _pooled(docs: DataFrame, text: str, vectors: np.ndarray) -> DataFrame:
    """``docs`` without ``text``, with _features."""
    shipped = docs.sparkSession.sparkContext.broadcast(vectors)  # BUCKETS x DIMENSIONS floats

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, texts in slices(batch, "_bytes"):
                features = pool(texts, shipped.value)
                offsets = np.arange(len(texts) + 1, dtype=np.int32) * features.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(begin, len(texts)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(features.ravel()))],
                    names=["_row", "_features"],
                )

    others = [F.col(f"`{c}`") for c in docs.columns if c != text]
    packed = docs.select(F.struct(*others).alias("_row"), F.col(f"`{text}`").cast("binary").alias("_bytes"))
    row = packed.schema["_row"].dataType.simpleString()
    return packed.mapInArrow(run, f"_row {row}, _features array<float>").select("_row.*", "_features")


def score_quality(
    docs: DataFrame, labels: DataFrame, learn: Column, id: str = "doc_id", text: str = "text", label: str = "quality",
    rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """``docs`` without ``text``, with score: the probability that ``label`` is 1.

    Word vectors come from all texts. The network learns from about ``rows`` rows of ``labels``, chosen
    by a hash of the id among those where ``learn`` holds and the label is 0 or 1; labels of unknown
    documents are of no use. An id that stands in several documents, or is labelled several times, gives a row to
    learn from for each pair; equal rows get equal scores. Null and empty texts are scored as texts of no tokens. Without two
    classes to learn from, every score is the share of label 1 (0.5 without any label).
    """
    pooled = stage(_pooled(docs, text, word_vectors(docs, text)), "pooled")
    usable = labels.where(learn & F.col(f"`{label}`").isin(0, 1)).select(
        F.col(f"`{id}`").alias("_id"), F.col(f"`{label}`").cast("int").alias("_label"))
    count = usable.count()
    place = F.pmod(F.xxhash64(F.lit("sample"), "_id"), F.lit(1 << 20)) / F.lit(1 << 20)
    sample = usable.where(place < rows / max(count, 1))
    known = sample.join(pooled.select(F.col(f"`{id}`").alias("_id"), "_features"), "_id").orderBy("_id", "_label", "_features")
    found = known.select("_label", "_features").collect()  # about ``rows`` rows of a fixed width
    y = np.array([r["_label"] for r in found])
    net = fit(np.array([r["_features"] for r in found], dtype=np.float32), y) if len(set(y.tolist())) == 2 else None
    flat = float(y.mean()) if len(y) else 0.5

    @F.arrow_udf("double")
    def probability(features):
        if net is None:
            return pa.array(np.full(len(features), flat))
        return pa.array(net.probability(features.flatten().to_numpy().reshape(len(features), -1).astype(float)))

    return pooled.withColumn("score", probability("_features")).drop("_features")
