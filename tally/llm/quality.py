"""Document quality from random-indexing word vectors and a small calibrated network.

A token's index vector is a fixed sparse random one. A word's vector adds up the index
vectors of its neighbours over the training texts. A document is the mean of the vectors of
its words and of their forms (case, marks, length), so unseen words count by their form. A
two-layer network gives a logit, and one temperature, fitted on rows kept back from the
training, turns logits into calibrated probabilities.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.llm.groups import Emitter, carried, map_batches, map_groups, refuse_clash
from tally.llm.storage import stored
from tally.llm.words import U64, Words, mixed, words_of

_FORMS = 2048  # buckets of word forms, before the buckets of words
_KINDS = np.full(256, 4, np.uint8)  # other ASCII
_KINDS[97:123], _KINDS[65:91], _KINDS[48:58], _KINDS[128:] = 0, 1, 2, 3


@dataclass(frozen=True)
class Settings:
    """``rows`` labelled rows train the model at most; ``buckets`` and ``dim`` bound its size."""

    rows: int = 8000
    buckets: int = 16384
    dim: int = 96
    reach: int = 2
    hidden: int = 32
    epochs: int = 60
    seed: int = 11


def token_ids(words: Words, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """A bucket for each word, and one for its form: case, marks, length, and whether it repeats the word before."""
    size = words.end - words.start
    first, last = words.data[words.start], words.data[words.end - 1]
    second = words.data[np.minimum(words.start + 1, words.end - 1)]
    final = np.where(_KINDS[last] == 4, 5 + last, _KINDS[last]).astype(U64)  # marks stand for themselves
    grade = np.searchsorted(np.array([2, 3, 6, 10, 16, 32]), size, side="right").astype(U64)
    form = ((_KINDS[first].astype(U64) * U64(8) + _KINDS[second]) * U64(8) + grade) * U64(512) + final
    again = np.zeros(len(size), U64)
    again[1:] = words.hash[1:] == words.hash[:-1]
    again[words.first[:-1][words.first[:-1] < len(size)]] = 0
    form = form * U64(2) + again
    form = (mixed(form + U64(1)) % U64(_FORMS)).astype(np.int64)
    word = (words.hash % U64(buckets - _FORMS)).astype(np.int64) + _FORMS
    return word, form


def index_vectors(buckets: int, dim: int, seed: int) -> np.ndarray:
    """Sparse random vectors: eight places of each hold +1 or -1."""
    draw = np.random.default_rng(seed)
    out = np.zeros((buckets, dim), np.float32)
    for _ in range(8):
        out[np.arange(buckets), draw.integers(0, dim, buckets)] += draw.choice([-1.0, 1.0], buckets)
    return out


def pooled(ids: np.ndarray, text: np.ndarray, count: int, vectors: np.ndarray) -> np.ndarray:
    """Mean vector of the tokens of each of ``count`` texts; zeros where there are none."""
    out = np.zeros((count, vectors.shape[1]))
    first = np.searchsorted(text, np.arange(count + 1))
    for i in range(count):
        own = ids[first[i] : first[i + 1]]
        if len(own):
            which, often = np.unique(own, return_counts=True)
            out[i] = often @ vectors[which] / len(own)
    return out


def features(words: Words, vectors: np.ndarray) -> np.ndarray:
    """Pooled word and form vectors of each text, and whether it has words."""
    count = len(words.first) - 1
    text = np.repeat(np.arange(count), np.diff(words.first))
    word, form = token_ids(words, len(vectors))
    some = (np.diff(words.first) > 0).astype(float)[:, None]
    return np.hstack([pooled(word, text, count, vectors), pooled(form, text, count, vectors), some])


def _neighbours(texts: DataFrame, settings: Settings) -> DataFrame:
    """``bucket, around``: sums of the neighbours' index vectors, a row per bucket and batch."""

    def work(batch, out: Emitter):
        index = index_vectors(settings.buckets, settings.dim, settings.seed)
        total = np.zeros_like(index)
        for words in words_of(batch.column("text")):
            text = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
            word, form = token_ids(words, settings.buckets)
            for step in range(1, settings.reach + 1):
                near = text[step:] == text[:-step]
                a, b = np.flatnonzero(near), np.flatnonzero(near) + step
                for left, right in ((word, word), (word, form), (form, form)):
                    _add(total, left[a], right[b], index)
                    _add(total, right[b], left[a], index)
        seen = np.flatnonzero(np.abs(total).any(axis=1))
        out.add(bucket=seen.astype(np.int64), around=[row.tobytes() for row in total[seen]])

    return map_batches(texts, work, "bucket bigint, around binary")


def _add(total: np.ndarray, to: np.ndarray, of: np.ndarray, index: np.ndarray) -> None:
    pair, often = np.unique(to * len(index) + of, return_counts=True)
    to, of = pair // len(index), pair % len(index)
    starts = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]])) if len(to) else to
    if len(to):
        total[to[starts]] += np.add.reduceat(index[of] * often[:, None].astype(np.float32), starts, axis=0)


def _summed(partial: DataFrame, dim: int) -> DataFrame:
    def work(key, rows, out: Emitter):
        parts = [np.frombuffer(x, np.float32) for x in rows.column("around").to_pylist()]
        out.add(bucket=np.array([key[0]]), around=[np.sum(parts, axis=0).tobytes()])

    return map_groups(partial, ["bucket"], work, "bucket bigint, around binary")


@dataclass
class Network:
    mean: np.ndarray
    scale: np.ndarray
    layers: list[np.ndarray]
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.tanh(((x - self.mean) / self.scale) @ w1 + b1) @ w2 + b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -50, 50)))


def train(x: np.ndarray, y: np.ndarray, hidden: int, epochs: int, seed: int) -> Network:
    """Fit by Adam on four fifths of the rows, calibrate the temperature on the others."""
    draw = np.random.default_rng(seed)
    order = draw.permutation(len(x))
    held, own = order[: len(x) // 5], order[len(x) // 5 :]
    held = held if len(held) else own
    mean, scale = x[own].mean(axis=0), x[own].std(axis=0) + 1e-6
    z = (x - mean) / scale
    w = [draw.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], hidden)), np.zeros(hidden), draw.normal(0, 0.1, hidden), np.zeros(1)]
    m, v, at = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w], 0
    for _ in range(epochs):
        draw.shuffle(own)
        for low in range(0, len(own), 128):
            rows = own[low : low + 128]
            h = np.tanh(z[rows] @ w[0] + w[1])
            error = (1 / (1 + np.exp(-np.clip(h @ w[2] + w[3], -50, 50))) - y[rows]) / len(rows)
            back = error[:, None] * w[2] * (1 - h * h)
            grads = [z[rows].T @ back + 1e-4 * w[0], back.sum(axis=0), h.T @ error + 1e-4 * w[2], error.sum(keepdims=True)]
            at += 1
            for i, g in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                w[i] = w[i] - 3e-3 * (m[i] / (1 - 0.9**at)) / (np.sqrt(v[i] / (1 - 0.999**at)) + 1e-8)
    net = Network(mean, scale, w, 1.0)
    logits = net.logits(x[held])
    choices = np.exp(np.linspace(np.log(0.25), np.log(8), 71))
    losses = [np.mean(np.logaddexp(0, logits / t) - y[held] * logits / t) for t in choices]
    net.temperature = float(choices[int(np.argmin(losses))])
    return net


@dataclass
class Quality:
    """A fitted model; ``constant`` stands in where the labels could not teach a network."""

    vectors: np.ndarray
    network: Network | None
    constant: float

    @property
    def fitted(self) -> bool:
        """Whether labels of both kinds taught it to tell texts apart."""
        return self.network is not None

    def score(self, words: Words) -> np.ndarray:
        if self.network is None:
            return np.full(len(words.first) - 1, self.constant)
        return self.network.score(features(words, self.vectors))


def fit(docs: DataFrame, labels: DataFrame, learn: Column, settings: Settings = Settings()) -> Quality:
    """Learn from at most ``settings.rows`` labelled documents where ``learn`` (of doc_id) is true.

    ``labels(doc_id, quality)``; rows without a label of 0 or 1, and ids with both, teach
    nothing. The sample is drawn by the hash of the id. What comes to the driver is bounded by
    the settings: one vector per bucket and one feature row per sampled document. Without
    labels every score is 0.5, with labels of one kind the smoothed share of 1.
    """
    spark = docs.sparkSession
    known = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).where(learn)
        .groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("other"))
        .where("quality = other").drop("other")
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.rows)
    )
    sample = docs.select("doc_id", "text").where("text IS NOT NULL").join(F.broadcast(known), "doc_id")
    # Rows that repeat an id could be many: again at most ``rows`` of them.
    sample = sample.orderBy(F.xxhash64("doc_id"), "text").limit(settings.rows)
    sample = stored(sample.repartition(spark.sparkContext.defaultParallelism, "text"), "sample")
    if not sample.count():
        return Quality(np.zeros((1, 1)), None, 0.5)
    around = _summed(_neighbours(sample, settings), settings.dim).collect()
    vectors = np.zeros((settings.buckets, settings.dim), np.float32)
    for row in around:
        vectors[row.bucket] = np.frombuffer(row.around, np.float32)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True) + 1e-9

    def described(batch, out: Emitter):
        quality, ids = batch.column("quality").to_numpy().astype(np.int64), batch.column("doc_id").to_numpy()
        for words in words_of(batch.column("text")):
            found = features(words, vectors)
            out.add(doc_id=ids[words.rows], quality=quality[words.rows], x=[row.tobytes() for row in found])

    rows = map_batches(sample, described, "doc_id bigint, quality bigint, x binary").collect()
    rows.sort(key=lambda row: (row.doc_id, row.x))
    x, y = np.array([np.frombuffer(row.x) for row in rows]), np.array([row.quality for row in rows], float)
    if y.min() == y.max():
        return Quality(vectors, None, float((y.sum() + 1) / (len(y) + 2)))
    network = train(x, y, settings.hidden, settings.epochs, settings.seed)
    return Quality(vectors, network, float(y.mean()))


def scored(docs: DataFrame, model: Quality, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``*carry, score``: the probability of label 1 from the whole text of each row.

    Only ``text`` is read for the score. A null or empty text counts as one without words,
    which has a score as well. Very long texts are read whole. Other columns are ignored;
    ``carry`` may not name the output.
    """
    refuse_clash(carry, ("score",))
    columns = [c for c in dict.fromkeys(carry)]
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}

    def work(batch, out: Emitter):
        for words in words_of(batch.column("text")):
            out.add(
                **carried(batch, columns, words.rows), score=model.score(words)
            )

    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in columns), "score double"])
    return map_batches(docs.select(*dict.fromkeys([*columns, "text"])), work, schema)
