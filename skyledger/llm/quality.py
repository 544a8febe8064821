"""Quality of texts by a convolutional network over bytes, in numpy.

A text is cut into overlapping chunks of ``CHUNK`` bytes, ``STEP`` apart, which cover it
whole. Bytes are embedded, learned filters slide over each chunk, and each filter's largest
response in the chunk is kept. The chunks' responses are averaged over the text and, with
the logarithm of its length, combined by a small hidden layer into one probability.

The network is fitted on at most ``FIT_ROWS`` labelled rows of each class, the smallest by a
hash of their id. Of each it sees ``FIT_CHUNKS`` chunks, evenly spread from the first to the last, or
all if there are no more, and the length of the whole text; so neither a long text nor many of
them grow what reaches the driver. It scores whole texts, a bounded number of chunks at a time.

Null and empty texts are one chunk of padding and get a score like any other. Rows without a
label teach nothing. If a class has no rows, every score is the share of the other class. A
repeated id is scored as often as it occurs; if it is labelled twice, it counts twice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import fold_of, ids_and_texts, small_batches, texts_of

FIT_ROWS, FIT_CHUNKS = 2_500, 16
CHUNK, STEP = 256, 192
WIDTH, STRIDE, EMBEDDED, FILTERS, HIDDEN = 8, 2, 4, 32, 16
EPOCHS, BATCH, RATE = 10, 32, 0.004
CHUNKS_AT_ONCE = 128


def chunks_of(text: bytes) -> np.ndarray:
    """The chunks of a text as rows of bytes; the last is padded with zeros."""

    count = 1 + max(0, -(-(len(text) - CHUNK) // STEP))
    flat = np.zeros((count - 1) * STEP + CHUNK, np.uint8)
    flat[:len(text)] = np.frombuffer(text, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(flat, CHUNK)[::STEP]


def spread_chunks(text: bytes, most: int) -> np.ndarray:
    """``most`` chunks of a text, evenly spread from the first to the last; all of them, if there are no more."""

    cut = chunks_of(text)
    if len(cut) > most:
        cut = cut[np.arange(most) * (len(cut) - 1) // max(1, most - 1)]
    return np.ascontiguousarray(cut)


class Network:
    """Embedding, filters, largest responses, hidden layer, probability."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        draw = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        self.values = {
            "embed": draw(256, EMBEDDED, scale=0.5), "filters": draw(WIDTH * EMBEDDED, FILTERS, scale=0.25),
            "bias": np.zeros(FILTERS, np.float32), "hidden": draw(FILTERS + 1, HIDDEN, scale=0.25),
            "hidden_bias": np.zeros(HIDDEN, np.float32), "out": draw(HIDDEN, scale=0.25), "out_bias": np.zeros(1, np.float32),
        }

    def pooled(self, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The largest response of each filter in each chunk, and where it was."""

        v = self.values
        best = np.empty((len(chunks), FILTERS), np.float32)
        where = np.empty((len(chunks), FILTERS), np.int64)
        for at in range(0, len(chunks), CHUNKS_AT_ONCE):
            part = chunks[at:at + CHUNKS_AT_ONCE]
            embedded = v["embed"][part].reshape(len(part), CHUNK * EMBEDDED)
            seen = np.lib.stride_tricks.sliding_window_view(embedded, WIDTH * EMBEDDED, axis=1)[:, ::STRIDE * EMBEDDED]
            response = np.ascontiguousarray(seen).reshape(-1, WIDTH * EMBEDDED) @ v["filters"]
            response = response.reshape(len(part), -1, FILTERS)
            place = response.argmax(1)
            where[at:at + len(part)] = place
            best[at:at + len(part)] = np.take_along_axis(response, place[:, None], 1)[:, 0]
        return np.maximum(best + v["bias"], 0), where

    def heads(self, pooled: np.ndarray, owner: np.ndarray, length: np.ndarray) -> dict:
        """From chunks to texts: ``owner`` names each chunk's text, ``length`` is in bytes."""

        v, count = self.values, np.bincount(owner, minlength=len(length)).astype(np.float32)
        mean = np.zeros((len(length), FILTERS), np.float32)
        np.add.at(mean, owner, pooled)
        mean = np.concatenate([mean / count[:, None], np.log1p(length)[:, None].astype(np.float32) / 10], axis=1)
        hidden = np.maximum(mean @ v["hidden"] + v["hidden_bias"], 0)
        return {"count": count, "mean": mean, "hidden": hidden, "p": 1 / (1 + np.exp(-(hidden @ v["out"] + v["out_bias"][0])))}

    def score(self, texts: list[bytes]) -> np.ndarray:
        sums = []
        for text in texts:  # one text at a time: memory holds the chunks of one
            pooled, _ = self.pooled(chunks_of(text))
            sums.append(pooled.mean(0))
        length = np.array([len(t) for t in texts])
        return self.heads(np.array(sums, np.float32).reshape(-1, FILTERS), np.arange(len(texts)), length)["p"]

    def slopes(self, texts: list[np.ndarray], length: np.ndarray, label: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        v = self.values
        chunks, owner = np.concatenate(texts), np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        pooled, where = self.pooled(chunks)
        f = self.heads(pooled, owner, length)
        wrong = ((f["p"] - label) * weight / len(label)).astype(np.float32)
        back = wrong[:, None] * v["out"] * (f["hidden"] > 0)
        to_pool = (back @ v["hidden"].T)[:, :FILTERS] / f["count"][:, None]
        to_pool = to_pool[owner] * (pooled > 0)
        # Only the place of each largest response takes part.
        bytes_ = chunks[np.arange(len(chunks))[:, None, None], where[:, :, None] * STRIDE + np.arange(WIDTH)]
        seen = v["embed"][bytes_].reshape(len(chunks), FILTERS, -1)
        embed = np.zeros_like(v["embed"])
        np.add.at(embed, bytes_, (to_pool[:, :, None] * v["filters"].T).reshape(*bytes_.shape, EMBEDDED))
        return {"embed": embed, "filters": np.einsum("cf,cfk->kf", to_pool, seen), "bias": to_pool.sum(0),
                "hidden": f["mean"].T @ back, "hidden_bias": back.sum(0), "out": f["hidden"].T @ wrong,
                "out_bias": wrong.sum(keepdims=True)}

    def fit(self, cut: list[np.ndarray], length: np.ndarray, labels: np.ndarray, epochs: int = EPOCHS, seed: int = 11) -> None:
        """Learn from the chunks, the length in bytes and the label of each text."""

        rng = np.random.default_rng(seed)
        share = np.bincount(labels, minlength=2) / len(labels)
        weight = 0.5 / share[labels]
        moments = {k: [np.zeros_like(x), np.zeros_like(x)] for k, x in self.values.items()}
        step, last = 0, epochs * -(-len(cut) // BATCH)
        for _ in range(epochs):
            order = rng.permutation(len(cut))
            for at in range(0, len(order), BATCH):
                rows, step = order[at:at + BATCH], step + 1
                slopes = self.slopes([cut[r] for r in rows], length[rows], labels[rows], weight[rows])
                rate = RATE * min(1, 2 * (1 - step / (last + 1)))
                for name, slope in slopes.items():
                    first, second = moments[name]
                    first += 0.1 * (slope - first)
                    second += 0.01 * (slope * slope - second)
                    self.values[name] -= rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-7)
        # Classes weigh the same while fitting; the share of each moves the probability back.
        self.values["out_bias"] += np.float32(np.log(share[1] / share[0]))


class Constant:
    """The answer where only one class, or none, has labels."""

    def __init__(self, p: float):
        self.p = p

    def score(self, texts: list[bytes]) -> np.ndarray:
        return np.full(len(texts), self.p)


def _cutter(most: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, cut = [], []
            for text in texts_of(batch.column(2)):
                length.append(len(text))
                cut.append(spread_chunks(text, most).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(length, pa.int64()), pa.array(cut, pa.binary())],
                names=["id", "label", "length", "chunks"])

    return run


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
                rows: int = FIT_ROWS, chunks: int = FIT_CHUNKS, folds: int = 3, held_fold: int | None = 1):
    """A network fitted on a bounded sample of the labelled rows outside ``held_fold``."""

    marked = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("int").alias("label")).filter(
        F.col("label").isin(0, 1) & F.col("id").isNotNull())
    if held_fold is not None:
        marked = marked.filter(fold_of(F.col("id"), folds) != held_fold)
    shares = {r["label"]: r["count"] for r in marked.groupBy("label").count().collect()}
    if len(shares) < 2:
        return Constant(float(next(iter(shares), 0.5)))
    chosen = None
    for label in (0, 1):
        part = marked.filter(F.col("label") == label).orderBy(F.xxhash64("id"), "id").limit(rows)
        chosen = part if chosen is None else chosen.union(part)
    # At most 2 x rows ids, so this side is small whatever the input.
    pairs = ids_and_texts(docs, id_col, text_col).join(F.broadcast(chosen), "id")
    small_batches(docs.sparkSession)
    key = pairs.schema["id"].dataType.simpleString()
    cut = pairs.select("id", "label", "text").mapInArrow(_cutter(chunks), f"id {key}, label int, length long, chunks binary")
    # Ids that repeat may bring more rows than the sample holds.
    sample = cut.orderBy(F.xxhash64("id"), "id", "length", "chunks").limit(2 * rows).collect()
    seen = np.array([r["label"] for r in sample], np.int64)
    if len(set(seen.tolist())) < 2:
        return Constant(float(max(shares, key=shares.get)))
    network = Network()
    network.fit([np.frombuffer(r["chunks"], np.uint8).reshape(-1, CHUNK) for r in sample],
                np.array([r["length"] for r in sample], np.int64), seen)
    # The sample is balanced by class; the labelled rows are not.
    sampled = np.bincount(seen, minlength=2)
    network.values["out_bias"] += np.float32(np.log(shares[1] / shares[0]) - np.log(sampled[1] / sampled[0]))
    return network


def _scorer(shared) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = shared.value.score(list(texts_of(batch.column(1))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores.astype(np.float64))], names=["id", "score"])

    return run


def score_quality(docs: DataFrame, network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every text."""

    small_batches(docs.sparkSession)
    pairs = ids_and_texts(docs, id_col, text_col)
    return pairs.mapInArrow(_scorer(docs.sparkSession.sparkContext.broadcast(network)), f"id {pairs.schema['id'].dataType.simpleString()}, score double")
