"""A quality classifier: a byte-level convolutional network in numpy."""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelhouse.llm.common import giving_back, id_and_text, table
from parcelhouse.llm.labelled import held_out, training_sample

CHUNK, OVERLAP = 192, 8
WIDTH, STRIDE = 8, 4
EMBED, FILTERS, HIDDEN = 8, 32, 16
CHUNKS_AT_ONCE = 512
# The sample the network is fitted on: at most so many documents of at most so many bytes.
SAMPLE_ROWS, SAMPLE_BYTES = 6000, 16_384
EPOCHS = 5


def _chunks(text: bytes) -> np.ndarray:
    """Overlapping chunks that cover all bytes; the last one is filled up with zeros."""
    step = CHUNK - OVERLAP
    n = max(1, -(-(len(text) - OVERLAP) // step))
    data = np.zeros((n - 1) * step + CHUNK, np.uint8)
    data[:len(text)] = np.frombuffer(text, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(data, CHUNK)[::step]


@dataclass
class Network:
    """bytes -> embedding -> convolution -> ReLU -> maximum per chunk -> mean and maximum over
    the chunks of a document -> hidden layer -> probability."""

    weights: dict[str, np.ndarray]

    @classmethod
    def start(cls, seed: int = 1) -> Network:
        rng = np.random.default_rng(seed)

        def normal(*shape: int, scale: float) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        embed = normal(256, EMBED, scale=0.5)
        embed[0] = 0
        return cls({
            "embed": embed,
            "conv": normal(WIDTH * EMBED, FILTERS, scale=(WIDTH * EMBED) ** -0.5),
            "conv_bias": np.zeros(FILTERS, np.float32),
            "hidden": normal(2 * FILTERS, HIDDEN, scale=(2 * FILTERS) ** -0.5),
            "hidden_bias": np.zeros(HIDDEN, np.float32),
            "out": normal(HIDDEN, scale=HIDDEN ** -0.5),
            "out_bias": np.zeros(1, np.float32),
        })

    def _windows(self, chunks: np.ndarray) -> np.ndarray:
        """The embedded bytes under each filter position, (chunk, position, width * embedding)."""
        embedded = self.weights["embed"][chunks].reshape(len(chunks), CHUNK * EMBED)
        view = np.lib.stride_tricks.sliding_window_view(embedded, WIDTH * EMBED, axis=1)
        return view[:, ::STRIDE * EMBED]

    def pooled(self, chunks: np.ndarray, where: bool = False):
        """Per chunk and filter the largest response, and at which position if asked."""
        w, found, places = self.weights, [], []
        for at in range(0, len(chunks), CHUNKS_AT_ONCE):
            windows = self._windows(chunks[at:at + CHUNKS_AT_ONCE])
            n, positions, width = windows.shape
            flat = np.ascontiguousarray(windows).reshape(n * positions, width)
            response = (flat @ w["conv"]).reshape(n, positions, FILTERS)
            if where:
                places.append(response.argmax(axis=1))
            found.append(np.maximum(response.max(axis=1) + w["conv_bias"], 0))
        return np.concatenate(found), np.concatenate(places) if where else None

    def _head(self, features: np.ndarray):
        w = self.weights
        hidden = np.maximum(features @ w["hidden"] + w["hidden_bias"], 0)
        logit = hidden @ w["out"] + w["out_bias"][0]
        return hidden, 1 / (1 + np.exp(-np.clip(logit, -30, 30)))

    def score(self, texts: list[bytes]) -> np.ndarray:
        """Probability of label 1 for each whole text; memory is bounded for any length."""
        features = np.zeros((len(texts), 2 * FILTERS), np.float32)
        group: list[np.ndarray] = []
        owners: list[int] = []
        sums = np.zeros((len(texts), FILTERS), np.float64)
        tops = np.zeros((len(texts), FILTERS), np.float32)
        counts = np.zeros(len(texts), np.int64)

        def flush() -> None:
            if group:
                found, _ = self.pooled(np.concatenate(group))
                np.add.at(sums, owners, found)
                np.maximum.at(tops, owners, found)
                group.clear()
                owners.clear()

        for i, text in enumerate(texts):
            chunks = _chunks(text)
            counts[i] = len(chunks)
            for at in range(0, len(chunks), CHUNKS_AT_ONCE):
                part = chunks[at:at + CHUNKS_AT_ONCE]
                group.append(part)
                owners.extend([i] * len(part))
                if len(owners) >= CHUNKS_AT_ONCE:
                    flush()
        flush()
        features[:, :FILTERS] = sums / np.maximum(counts, 1)[:, None]
        features[:, FILTERS:] = tops
        return self._head(features)[1]

    def _gradients(self, texts: list[bytes], labels: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        chunks = [_chunks(t) for t in texts]
        counts = np.array([len(c) for c in chunks])
        starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
        owner = np.repeat(np.arange(len(texts)), counts)
        data = np.concatenate(chunks)
        found, places = self.pooled(data, where=True)
        mean = np.add.reduceat(found, starts) / counts[:, None]
        top = np.maximum.reduceat(found, starts)
        features = np.concatenate([mean, top], axis=1)
        hidden, p = self._head(features)
        d_logit = ((p - labels) / len(texts)).astype(np.float32)
        d_hidden = d_logit[:, None] * w["out"] * (hidden > 0)
        d_features = d_hidden @ w["hidden"].T
        is_top = found == top[owner]
        is_top = is_top / np.add.reduceat(is_top, starts, dtype=np.float32)[owner]
        d_found = d_features[owner, :FILTERS] / counts[owner, None] + is_top * d_features[owner, FILTERS:]
        d_found = (d_found * (found > 0)).astype(np.float32)
        # Only the position of each maximum takes part in the gradient.
        at = places[..., None] * STRIDE + np.arange(WIDTH)
        under = np.take_along_axis(data[:, None, :], at.reshape(len(data), 1, -1), axis=2)
        under = under.reshape(len(data), FILTERS, WIDTH)
        windows = w["embed"][under].reshape(len(data), FILTERS, WIDTH * EMBED)
        d_conv = np.einsum("nfw,nf->wf", windows, d_found, optimize=True)
        d_windows = d_found[..., None] * w["conv"].T[None]
        d_embed = np.zeros_like(w["embed"])
        np.add.at(d_embed, under.ravel(), d_windows.reshape(-1, EMBED))
        d_embed[0] = 0
        return {
            "embed": d_embed, "conv": d_conv, "conv_bias": d_found.sum(axis=0),
            "hidden": features.T.astype(np.float32) @ d_hidden, "hidden_bias": d_hidden.sum(axis=0),
            "out": hidden.T @ d_logit, "out_bias": d_logit.sum(keepdims=True),
        }

    @classmethod
    def fit(cls, texts: list[bytes], labels: list[int], epochs: int = EPOCHS, seed: int = 1):
        """Adam on batches of documents of similar length, in an order that `seed` fixes."""
        net, rng = cls.start(seed), np.random.default_rng(seed)
        target = np.array(labels, np.float32)
        if len(set(labels)) < 2:
            # Nothing to tell apart: the only label's side for all, or undecided without any.
            net.weights["out"][:] = 0
            net.weights["out_bias"][:] = 0 if not labels else 5 if labels[0] else -5
            return net
        moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.weights.items()}
        step = 0
        order = np.argsort([len(t) for t in texts], kind="stable")
        batches = [order[i:i + 32] for i in range(0, len(order), 32)]
        # Long batches are cut so that memory stays bounded.
        parts: list[np.ndarray] = []
        for batch in batches:
            longest = max(len(texts[i]) for i in batch)
            size = max(4, min(32, 200_000 // max(1, longest)))
            parts += [batch[i:i + size] for i in range(0, len(batch), size)]
        total = epochs * len(parts)
        for _ in range(epochs):
            for k in rng.permutation(len(parts)):
                step += 1
                rate = 0.01 * (1 - step / (total + 1))
                batch = parts[k]
                grads = net._gradients([texts[i] for i in batch], target[batch])
                for name, grad in grads.items():
                    m, v = moments[name]
                    m += 0.1 * (grad - m)
                    v += 0.01 * (grad * grad - v)
                    net.weights[name] -= (
                        rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-7)
                    ).astype(np.float32)
        return net


def fit_quality(
    docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id",
    text_col: str = "text", rows: int = SAMPLE_ROWS, most_bytes: int = SAMPLE_BYTES,
) -> Network:
    """A network fitted on a bounded sample of labelled documents that are not held out.

    One task fits it, which a lost executor only repeats; the driver receives the weights.
    """
    sample = training_sample(docs, labels, label, rows, most_bytes, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: list[bytes] = []
        targets: list[int] = []
        for batch in batches:
            texts += [t.as_buffer().to_pybytes() for t in batch.column("text")]
            targets += batch.column("label").to_pylist()
        stored = io.BytesIO()
        np.savez(stored, **Network.fit(texts, targets).weights)
        yield pa.RecordBatch.from_arrays([pa.array([stored.getvalue()], pa.binary())], ["weights"])

    found = sample.coalesce(1).mapInArrow(run, "weights binary").collect()
    if not found:
        return Network.fit([], [])
    return Network(dict(np.load(io.BytesIO(found[0]["weights"]))))


def score_quality(
    docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """id and score of every row, from its whole text and nothing else.

    Null texts are empty texts; these have a score too. Rows that repeat an id are scored
    each on its own; ids may be null. Extra columns are ignored; an empty table gives an
    empty one.
    """
    rows = id_and_text(docs, id_col, text_col)
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_buffer().to_pybytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(net.score(texts), pa.float64())], ["id", "score"])

    return rows.mapInArrow(run, f"id {id_type}, score double")


def keep_good(
    docs: DataFrame, net: Network, least: float = 0.7, text_col: str = "text"
) -> DataFrame:
    """The documents the network scores `least` or higher, with all their columns."""
    columns = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = columns.index(text_col)
        for batch in batches:
            texts = [
                t.as_buffer().to_pybytes() if t.is_valid else b"" for t in batch.column(at)]
            yield batch.filter(pa.array(net.score(texts) >= least))

    return docs.mapInArrow(giving_back(run), docs.schema)


def op8_quality(spark, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    net = fit_quality(docs, table(spark, folder, "labels"))
    return score_quality(docs, net).select(
        F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"))
