"""Context-tree weighting over bytes, learned from a corpus, as code length of whole texts.

A text is the byte sequence of its lower-cased words with single blanks between them and a
line feed at the end. Each byte is eight binary decisions; a decision is made in the contexts
of the last 0 to ``DEPTH`` bytes. Every context node holds counts of zeros and ones with
their Krichevsky-Trofimov probability, and weighs it against its children one half to one
half. After training, that gives each node its posterior share, and the probability of a
decision is the mixture over all depths. A context that training never met adds nothing: its
share goes to the longest one that was met. The probabilities of a decision add up to one.

The corpus is handled in blocks of some megabytes of text. A block lists its different words
and its different (context, byte) grams with counts, cut by hash into buckets; buckets of all
blocks meet, and answer each block with one number for each of its words and grams; then the
block adds them up over its texts. Nothing of corpus size is held in one place: the words and
grams of a bucket shrink with the number of buckets, and only the nodes of at most two bytes
of context (a fixed alphabet's worth) pass through the driver.

Null and empty texts are the end alone. Repeated ids give repeated rows. Without training
texts every decision has probability one half and the word counts are zero.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import fold_of, ids_and_texts, lower_words, small_batches, texts_of
from skyledger.session import materialize

DEPTH = 5
TOP = 2
BLOCK_BYTES = 12_000_000
SLICE_BYTES = 2_000_000
END = b"\n"
TEXTS, WORDS, GRAMS = 0, 1, 2
LOG_HALF = float(np.log(0.5))


def squeezed(values: np.ndarray, ordered: bool = False) -> bytes:
    """Whole numbers as compressed bytes; numbers in order are kept as steps."""

    steps = np.diff(values, prepend=values.dtype.type(0)) if ordered else values
    # Bytes of the same weight lie together, so that the many zeros among them do too.
    planes = np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def restored(data: bytes, kind, ordered: bool = False) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    values = np.ascontiguousarray(planes.T).reshape(-1).view(kind)
    return np.cumsum(values, dtype=kind) if ordered else values


def line_of(text: bytes) -> bytes:
    """What is scored of a text, without its end."""

    return b" ".join(lower_words(text))


# --- grams -------------------------------------------------------------------------------------------


def codes_of(lines: list[bytes], depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """A code for each byte to predict (the last byte first, then older ones, then the byte itself), and line starts."""

    pad = END * depth
    flat = np.frombuffer(b"".join([pad + line + END for line in lines]), np.uint8).astype(np.uint64)
    sizes = np.array([len(line) + 1 for line in lines], np.int64)
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    place = np.arange(sizes.sum()) + np.repeat((np.arange(len(lines)) + 1) * depth, sizes)
    code = np.zeros(len(flat), np.uint64)
    for back in range(1, depth + 1):
        code[back:] |= flat[:-back] << np.uint64(8 * (depth + 1 - back))
    code |= flat
    return code[place], starts


def slices_of(lines: list[bytes], most: int = SLICE_BYTES) -> Iterator[list[bytes]]:
    part, size = [], 0
    for line in lines:
        part.append(line)
        size += len(line)
        if size >= most:
            yield part
            part, size = [], 0
    if part:
        yield part


def merged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys in order, with the sums of their counts."""

    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def grams_of(lines: list[bytes], trains: list[bool]) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for wanted in (True, False):
        for part in slices_of([line for line, t in zip(lines, trains) if t is wanted]):
            found, times = np.unique(codes_of(part)[0], return_counts=True)
            keys.append(found)
            counts.append(times if wanted else np.zeros_like(times))
    return merged(np.concatenate(keys), np.concatenate(counts))


def placed_grams(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different grams of some lines in order, the place of each byte's gram among them, and line starts."""

    code, starts = codes_of(lines)
    order = np.argsort(code)
    code = code[order]
    new = np.concatenate(([True], code[1:] != code[:-1]))
    place = np.empty(len(code), np.int32)
    place[order] = np.cumsum(new, dtype=np.int32) - 1
    return code[new], place, starts


def gram_buckets(keys: np.ndarray, buckets: int) -> np.ndarray:
    """By the last two bytes of context, so that all nodes below them meet."""

    top = keys >> np.uint64(8 * (DEPTH + 1 - TOP))
    mixed = (top + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed ^ mixed >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def words_of(lines: list[bytes], trains: list[bool]) -> dict[bytes, int]:
    counts: dict[bytes, int] = {}
    for line, train in zip(lines, trains):
        for word in line.split(b" ") if line else ():
            counts[word] = counts.get(word, 0) + train
    return counts


def word_bucket(word: bytes, buckets: int) -> int:
    return xxhash.xxh3_64_intdigest(word) % buckets


# --- the tree ----------------------------------------------------------------------------------------


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series, after raising small arguments."""

    shift, x = np.zeros(len(x)), np.asarray(x, float).copy()
    for _ in range(8):
        small = x < 8
        shift[small] -= np.log(x[small])
        x[small] += 1
    r = 1 / (x * x)
    return shift + (x - 0.5) * np.log(x) - x + 0.9189385332046727 + (1 / 12 - r * (1 / 360 - r * (1 / 1260 - r / 1680))) / x


def log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    return log_gamma(n0 + 0.5) + log_gamma(n1 + 0.5) - np.log(np.pi) - log_gamma(n0 + n1 + 1.0)


def decisions(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each gram its eight nodes (context, bits so far) with the counts of zeros and ones."""

    byte = keys & np.uint64(255)
    nodes, zeros, ones = [], [], []
    for i in range(8):
        prefix = np.uint64(1 << i) | byte >> np.uint64(8 - i)
        bit = (byte >> np.uint64(7 - i)).astype(np.int64) & 1
        nodes.append((keys & ~np.uint64(255)) | prefix)
        zeros.append(counts * (1 - bit))
        ones.append(counts * bit)
    return np.concatenate(nodes), np.concatenate(zeros), np.concatenate(ones)


class Level:
    """Nodes of one depth: keys in order, counts, weighted log probability, and the place of each node's parent."""

    def __init__(self, key, n0, n1, below):
        self.key, self.n0, self.n1 = key, n0, n1
        self.own = log_kt(n0, n1)
        self.weighted = self.own if below is None else np.logaddexp(LOG_HALF + self.own, LOG_HALF + below)
        self.up = None

    def share(self, leaf: bool) -> np.ndarray:
        return np.ones(len(self.key)) if leaf else np.exp(LOG_HALF + self.own - self.weighted)


def shorter(key: np.ndarray) -> np.ndarray:
    """The same decision with the oldest byte of the context left out."""

    return (key >> np.uint64(16)) << np.uint64(8) | key & np.uint64(255)


def parents(level: Level) -> Level:
    key, level.up = np.unique(shorter(level.key), return_inverse=True)
    add = lambda v: np.bincount(level.up, v, len(key))
    return Level(key, add(level.n0), add(level.n1), add(level.weighted))


def grown(level: Level, to_depth: int, depth: int) -> list[Level]:
    """Levels from ``depth`` down to ``to_depth`` bytes of context."""

    levels = [level]
    while depth > to_depth:
        levels.append(parents(levels[-1]))
        depth -= 1
    return levels


def mixed_down(levels: list[Level], state: tuple[np.ndarray, ...], bottom_is_leaf: bool) -> tuple[np.ndarray, ...]:
    """(mass left, probability so far, last estimate) below the deepest level; ``state`` is that of the shortest one."""

    mass, sum_, last = state
    for depth in range(len(levels) - 1, -1, -1):
        level = levels[depth]
        if depth < len(levels) - 1:
            mass, sum_, last = mass[level.up], sum_[level.up], last[level.up]
        seen = level.n0 + level.n1 > 0
        one = (level.n1 + 0.5) / (level.n0 + level.n1 + 1.0)
        share = level.share(bottom_is_leaf and depth == 0)
        # A node without counts hands what is left to the last estimate above it.
        last = np.where(seen, one, last)
        part = np.where(seen, mass * share, mass)
        sum_, mass = sum_ + part * last, mass - part
    return mass, sum_, last


def leaf_level(keys: np.ndarray, counts: np.ndarray) -> tuple[Level, np.ndarray]:
    node, n0, n1 = decisions(keys, counts)
    key, place = np.unique(node, return_inverse=True)
    return Level(key, np.bincount(place, n0, len(key)), np.bincount(place, n1, len(key)), None), place


def log10_of_grams(keys: np.ndarray, counts: np.ndarray, state_of: Callable) -> np.ndarray:
    """The log10 probability of the byte of each gram in its context; ``state_of`` gives the mixture above depth TOP."""

    leaf, place = leaf_level(keys, counts)
    levels = grown(leaf, TOP, DEPTH)
    _, one, _ = mixed_down(levels, state_of(levels[-1].key), True)
    p1 = one[place].reshape(8, -1)
    byte = (keys & np.uint64(255)).astype(np.int64)
    total = np.zeros(len(keys))
    for i in range(8):
        total += np.log10(np.where(byte >> (7 - i) & 1, p1[i], 1 - p1[i]))
    return total


class Summit:
    """Nodes with at most TOP bytes of context: bounded by the alphabet, whatever the corpus."""

    def __init__(self, key, n0, n1, weighted):
        order = np.argsort(key)
        below = Level.__new__(Level)
        below.key, below.n0, below.n1, below.weighted, below.up = key[order].astype(np.uint64), n0[order], n1[order], weighted[order], None
        levels = grown(below, 0, TOP)
        root = levels[-1]
        start = (np.ones(len(root.key)), np.zeros(len(root.key)), np.full(len(root.key), 0.5))
        state = mixed_down(levels[1:], start, False)
        self.key, self.state = below.key, tuple(v[below.up] for v in state)

    def __call__(self, key: np.ndarray) -> tuple[np.ndarray, ...]:
        place = np.searchsorted(self.key, key)
        return tuple(v[place] for v in self.state)


# --- Spark -------------------------------------------------------------------------------------------

LISTED = "block string, bucket int, kind int, ids array<{id}>, held array<boolean>, data binary, counts binary"


def _lister(buckets: int, block_bytes: int, id_type: pa.DataType) -> Callable:
    def rows_of(block: str, ids: list, held: list[bool], lines: list[bytes]) -> list[tuple]:
        trains = [not h for h in held]
        packed = zstandard.ZstdCompressor(level=3).compress(END.join(lines))
        rows = [(block, 0, TEXTS, ids, held, packed, None)]
        words = words_of(lines, trains)
        parts: list[list[bytes]] = [[] for _ in range(buckets)]
        for word in words:
            parts[word_bucket(word, buckets)].append(word)
        for bucket, part in enumerate(parts):
            if part:
                rows.append((block, bucket, WORDS, None, None, b" ".join(part), squeezed(np.array([words[w] for w in part], np.int64))))
        keys, counts = grams_of(lines, trains)
        own = gram_buckets(keys, buckets)
        for bucket in np.unique(own):
            mine = own == bucket
            rows.append((block, int(bucket), GRAMS, None, None, squeezed(keys[mine], True), squeezed(counts[mine])))
        return rows

    kinds = (pa.string(), pa.int32(), pa.int32(), pa.list_(id_type), pa.list_(pa.bool_()), pa.binary(), pa.binary())
    names = ("block", "bucket", "kind", "ids", "held", "data", "counts")

    def packed(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(rows), 64):
            part = rows[at:at + 64]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in part], kind) for k, kind in enumerate(kinds)], names=list(names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        ids, held, lines, size = [], [], [], 0
        for batch in batches:
            for key, text, out in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), batch.column(2).to_pylist()):
                ids.append(key)
                held.append(out)
                lines.append(line_of(text))
                size += len(lines[-1]) + 1
                if size >= block_bytes:
                    yield from packed(rows_of(f"{task}-{number}", ids, held, lines))
                    ids, held, lines, size, number = [], [], [], 0, number + 1
        if ids:
            yield from packed(rows_of(f"{task}-{number}", ids, held, lines))

    return run


ANSWER = "block string, bucket int, kind int, values binary, tokens long, known long"


def _answers(rows: list[tuple]) -> pa.Table:
    kinds = (("block", pa.string()), ("bucket", pa.int32()), ("kind", pa.int32()), ("values", pa.binary()), ("tokens", pa.int64()), ("known", pa.int64()))
    return pa.table({name: pa.array([r[k] for r in rows], kind) for k, (name, kind) in enumerate(kinds)})


def _count_words(rows: pa.Table) -> pa.Table:
    """The counts of a bucket's words over all blocks, given back to each block in its own order."""

    total: dict[bytes, int] = {}
    lists = []
    for data, counts in zip(rows["data"].to_pylist(), rows["counts"].to_pylist()):
        words = data.split(b" ")
        lists.append(words)
        for word, n in zip(words, restored(counts, np.int64).tolist()):
            total[word] = total.get(word, 0) + n
    out = [(block, bucket, WORDS, squeezed(np.array([total[w] for w in words], np.int64)), 0, 0)
           for block, bucket, words in zip(rows["block"].to_pylist(), rows["bucket"].to_pylist(), lists)]
    known = sum(n > 0 for n in total.values())
    first = out[0]
    out[0] = (*first[:4], sum(total.values()), known)
    return _answers(out)


def _bucket_grams(rows: pa.Table) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    lists = [restored(d, np.uint64, True) for d in rows["data"].to_pylist()]
    counts = [restored(c, np.int64) for c in rows["counts"].to_pylist()]
    return lists, *merged(np.concatenate(lists), np.concatenate(counts))


def _summit_rows(rows: pa.Table) -> pa.Table:
    _, keys, counts = _bucket_grams(rows)
    level = grown(leaf_level(keys, counts)[0], TOP, DEPTH)[-1]
    return pa.table({"key": level.key.astype(np.int64), "n0": level.n0, "n1": level.n1, "weighted": level.weighted})


def _score_grams(shared) -> Callable:
    def run(rows: pa.Table) -> pa.Table:
        lists, keys, counts = _bucket_grams(rows)
        value = log10_of_grams(keys, counts, shared.value)
        return _answers([(block, bucket, GRAMS, value[np.searchsorted(keys, own)].astype(np.float32).tobytes(), 0, 0)
                         for block, bucket, own in zip(rows["block"].to_pylist(), rows["bucket"].to_pylist(), lists)])

    return run


def _score_block(buckets: int, train_tokens: int, known: int, end_count: int) -> Callable:
    floor = float(np.log10(train_tokens + 0.1 * (known + 1)))

    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        ids, held = texts["ids"].combine_chunks().values, texts["held"].combine_chunks().values.to_pylist()
        lines = zstandard.ZstdDecompressor().decompress(texts["data"][0].as_py()).split(END)
        trains = [not h for h in held]
        given = {(k, b): v for k, b, v in zip(answers["kind"].to_pylist(), answers["bucket"].to_pylist(), answers["values"].to_pylist())}
        words = list(words_of(lines, trains))
        parts: list[list[bytes]] = [[] for _ in range(buckets)]
        for word in words:
            parts[word_bucket(word, buckets)].append(word)
        value = {}
        for bucket, part in enumerate(parts):
            if part:
                value.update(zip(part, np.log10(restored(given[WORDS, bucket], np.int64) + 0.1).tolist()))
        met = {w for w, v in value.items() if v > 0}  # a count of one or more
        end = float(np.log10(end_count + 0.1))
        found = [placed_grams(part) for part in slices_of(lines)]
        keys = np.unique(np.concatenate([f[0] for f in found]))
        own, by_key = gram_buckets(keys, buckets), np.zeros(len(keys))
        for bucket in np.unique(own):
            by_key[own == bucket] = np.frombuffer(given[GRAMS, int(bucket)], np.float32)
        n_tokens, n_known, base, scores = [], [], [], []
        for part, (seen, place, starts) in zip(slices_of(lines), found):
            # Grams in order are looked up side by side, and each byte then has the place of its own.
            scores.append(np.add.reduceat(by_key[np.searchsorted(keys, seen)][place], starts))
            for line in part:
                mine = line.split(b" ") if line else []
                n_tokens.append(len(mine) + 1)
                n_known.append(sum(map(met.__contains__, mine)) + (end_count > 0))
                base.append(sum(map(value.__getitem__, mine)) + end - (len(mine) + 1) * floor)
        return pa.table({"id": ids, "held_out": pa.array(held), "n_tokens": pa.array(n_tokens, pa.int64()),
                         "n_known": pa.array(n_known, pa.int64()), "base_score": pa.array(base, pa.float64()),
                         "score": pa.array(np.concatenate(scores), pa.float64()),
                         "n_bytes": pa.array([len(line) + 1 for line in lines], pa.int64())})

    return run


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 10, held_fold: int = 0,
                block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte) of every text.

    Rows whose fold is ``held_fold`` teach the model nothing; scores are log10 probabilities.
    """

    spark = docs.sparkSession
    small_batches(spark)
    pairs = ids_and_texts(docs, id_col, text_col).withColumn("held", fold_of(F.col("id"), folds) == held_fold)
    kind = pairs.schema["id"].dataType
    buckets = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    id_type = pa.from_numpy_dtype("int64") if kind.simpleString() == "bigint" else pa.int32() if kind.simpleString() == "int" else pa.string()
    listed = materialize(pairs.mapInArrow(_lister(buckets, block_bytes, id_type), LISTED.format(id=kind.simpleString())), "blocks")
    named = listed.filter(F.col("kind") != TEXTS).select("block", "bucket", "kind", "data", "counts")
    words = materialize(named.filter(F.col("kind") == WORDS).groupBy("bucket").applyInArrow(_count_words, ANSWER), "words")
    grams = named.filter(F.col("kind") == GRAMS)
    top = grams.groupBy("bucket").applyInArrow(_summit_rows, "key long, n0 double, n1 double, weighted double").toPandas()
    shared = spark.sparkContext.broadcast(Summit(*(top[c].to_numpy() for c in ("key", "n0", "n1", "weighted"))) if len(top) else None)
    scored = grams.groupBy("bucket").applyInArrow(_score_grams(shared), ANSWER)
    sums = words.agg(F.sum("tokens"), F.sum("known")).first()
    ends = listed.filter(F.col("kind") == TEXTS).agg(
        F.sum(F.aggregate("held", F.lit(0), lambda n, h: n + F.when(h, 0).otherwise(1)))).first()[0] or 0
    tokens, known = (sums[0] or 0) + ends, (sums[1] or 0) + (ends > 0)
    texts = listed.filter(F.col("kind") == TEXTS).select("block", "ids", "held", "data")
    answers = words.select("block", "bucket", "kind", "values").union(scored.select("block", "bucket", "kind", "values"))
    schema = f"id {kind.simpleString()}, held_out boolean, n_tokens long, n_known long, base_score double, score double, n_bytes long"
    result = texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _score_block(buckets, tokens, known, ends), schema)
    return result.select("id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score",
                         "score", "n_bytes", (-F.col("score") / F.log10(F.lit(2.0)) / F.col("n_bytes")).alias("bits_per_byte"))
