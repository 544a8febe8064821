"""The byte network against plain convolution, its chunks, and its answers where rows or labels lack."""

import math
import random

import numpy as np
import pytest

from skyledger.llm import quality
from skyledger.llm.quality import CHUNK, EMBEDDED, FILTERS, STEP, STRIDE, WIDTH

LABELS = "doc_id long, quality int, id string"


def plain_chunks(text):
    found = [text[:CHUNK]]
    while (len(found) - 1) * STEP + CHUNK < len(text):
        at = len(found) * STEP
        found.append(text[at:at + CHUNK])
    return [c + b"\0" * (CHUNK - len(c)) for c in found]


def plain_score(network, text):
    """The probability by loops over chunks, places and filters."""

    v = {name: value.astype(float) for name, value in network.values.items()}
    chunks = plain_chunks(text)
    mean = np.zeros(FILTERS)
    for chunk in chunks:
        for f in range(FILTERS):
            best = max(
                sum(v["embed"][chunk[at + w], e] * v["filters"][w * EMBEDDED + e, f] for w in range(WIDTH) for e in range(EMBEDDED))
                for at in range(0, CHUNK - WIDTH + 1, STRIDE))
            mean[f] += max(0.0, best + v["bias"][f]) / len(chunks)
    given = np.append(mean, math.log1p(len(text)) / 10)
    hidden = [max(0.0, given @ v["hidden"][:, h] + v["hidden_bias"][h]) for h in range(v["hidden"].shape[1])]
    return 1 / (1 + math.exp(-(np.array(hidden) @ v["out"] + v["out_bias"][0])))


@pytest.mark.parametrize("length", [0, 1, CHUNK - 1, CHUNK, CHUNK + 1, CHUNK + STEP, 3 * STEP + 7])
def test_chunks_cover_the_text(length):
    text = bytes(random.Random(length).choices(range(1, 256), k=length))
    assert [bytes(c) for c in quality.chunks_of(text)] == plain_chunks(text)


def test_scores_equal_plain_convolution():
    network = quality.Network(seed=3)
    texts = [b"", b"a", "naïve 日本".encode(), bytes(random.Random(1).choices(range(256), k=600))]
    got = network.score(texts)
    assert got == pytest.approx([plain_score(network, t) for t in texts], abs=1e-5)


def test_chunks_for_fitting_reach_both_ends():
    text = bytes(random.Random(2).choices(range(1, 256), k=50_000))
    every = quality.chunks_of(text)
    some = quality.spread_chunks(text, 16)
    assert len(some) == 16 and (some[0] == every[0]).all() and (some[-1] == every[-1]).all()
    places = [next(i for i, c in enumerate(every) if (c == s).all()) for s in some]
    gaps = np.diff(places)
    assert gaps.max() - gaps.min() <= 1
    assert (quality.spread_chunks(text[:700], 16) == quality.chunks_of(text[:700])).all()
    assert len(quality.spread_chunks(text, 1)) == 1


def test_slopes_equal_differences():
    """The gradients against finite differences of the loss."""

    network, rng = quality.Network(seed=5), random.Random(5)
    network.values = {name: value.astype(np.float64) for name, value in network.values.items()}
    texts = [bytes(rng.choices(range(256), k=n)) for n in (300, 40, 700)]
    cut, length = [quality.chunks_of(t) for t in texts], np.array([len(t) for t in texts])
    label, weight = np.array([1, 0, 1]), np.array([1.0, 2.0, 0.5])

    def loss():
        p = network.score(texts)
        return -sum(w * (y * math.log(q) + (1 - y) * math.log(1 - q)) for q, y, w in zip(p, label, weight)) / len(label)

    slopes = network.slopes(cut, length, label, weight)
    for name in ("out", "hidden", "hidden_bias", "out_bias", "bias", "filters"):
        flat = network.values[name].reshape(-1)
        at = int(np.abs(slopes[name].reshape(-1)).argmax())
        kept = flat[at]
        flat[at] = kept + 1e-3
        above = loss()
        flat[at] = kept - 1e-3
        below = loss()
        flat[at] = kept
        assert slopes[name].reshape(-1)[at] == pytest.approx((above - below) / 2e-3, rel=0.05, abs=1e-4)


def test_learns_what_marks_the_classes(spark):
    """A mark in the last words of long texts decides; a network that saw beginnings only could not tell."""

    rng = random.Random(7)

    def text(good):
        return " ".join(rng.choices(["lorem", "ipsum", "dolor"], k=400)) + (" zebra quartz" * 40 if good else " <<##>>" * 70)

    rows = [(i, text(i % 2), "x") for i in range(240)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label string")
    labels = spark.createDataFrame([(i, i % 2, "y") for i in range(160)], LABELS)
    network = quality.fit_quality(docs, labels, held_fold=None)
    scores = {r.id: r.score for r in quality.score_quality(docs, network).collect()}
    held = range(160, 240)
    assert sum((scores[i] >= 0.5) == bool(i % 2) for i in held) / len(held) > 0.9


def test_one_class_and_none(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None), (2, None), (None, "")], "doc_id long, text string")
    for labels, expected in (([], 0.5), ([(1, 1, "x"), (2, 1, "x")], 1.0), ([(2, 0, "x")], 0.0), ([(1, None, "x"), (None, 1, "x"), (1, 7, "x")], 0.5)):
        network = quality.fit_quality(docs, spark.createDataFrame(labels, LABELS), held_fold=None)
        rows = quality.score_quality(docs, network).collect()
        assert len(rows) == 4 and {r.score for r in rows} == {expected}


def test_null_empty_and_repeated_rows_get_scores(spark):
    rows = [(1, "good words here " * 30, 1), (2, "%%%% " * 90, 2), (3, None, 3), (4, "", 4), (4, "", 4), (None, "x", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int")
    labels = spark.createDataFrame([(1, 1, "a"), (2, 0, "a"), (2, 0, "a"), (3, 1, "a"), (9, 0, "a")], LABELS)
    network = quality.fit_quality(docs, labels, held_fold=None)
    got = sorted(((r.id, r.score) for r in quality.score_quality(docs, network).collect()), key=str)
    assert len(got) == len(rows) and all(0 <= s <= 1 for _, s in got)
    by_id = [s for i, s in got if i in (3, 4)]
    assert len(set(by_id)) == 1
    assert quality.score_quality(docs.limit(0), network).collect() == []
