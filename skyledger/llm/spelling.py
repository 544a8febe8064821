"""Spelling variants: words one edit apart, found by asymmetric q-chunks, and the form each one belongs to."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import small_batches, texts_of
from skyledger.session import materialize

LEAST_LENGTH, LEAST_COUNT = 5, 3
#: One run in so many is read with one letter left out, by its checksum; None reads all as they are.
DAMAGED_EVERY = 97
#: Distinct words that a task counts before it hands them on.
COUNTED_WORDS = 200_000
#: A chunk is halved so often, or until no more than OPEN letters lie outside all chunks that are kept.
DEPTH, OPEN = 3, 2


def count_words(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT, damaged_every: int | None = DAMAGED_EVERY,
) -> DataFrame:
    """``word, n`` of all words that are long and frequent enough.

    Only the first 26 capitals become small letters. Each task adds up its words before they are shuffled, so a frequent
    word is a row a task. A null text holds no word, a null id reads as an empty one.
    """

    small_batches(docs.sparkSession)
    run_pattern = re.compile("[A-Za-zÀ-ÿ]{%d,}" % least_length)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for row_id, text in zip(batch.column(0), texts_of(batch.column(1))):
                start = zlib.crc32(f"{row_id.as_py()}:".encode())
                for run, n in Counter(run_pattern.findall(text.lower().decode("utf-8", "replace"))).items():
                    if damaged_every:
                        h = zlib.crc32(run.encode(), start)
                        if h % damaged_every == 0:
                            cut = h % len(run)
                            run = run[:cut] + run[cut + 1:]
                            if len(run) < least_length:
                                continue
                    counts[run] += n
            if len(counts) > COUNTED_WORDS:
                yield _counts_batch(counts)
                counts.clear()
        yield _counts_batch(counts)

    texts = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("id"), F.col(f"`{text_col}`").alias("text"))
    parts = texts.mapInArrow(counted, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def _counts_batch(counts: Counter[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])


def holes(length: int) -> list[tuple[int, int]]:
    """The parts of a word of this length that the choices of chunks leave open.

    A word is two disjoint chunks, of which one edit spares at least one. The rest is again a shorter word with one
    edit, and again gives two chunks. What is open in the end holds the edit for at least one way of choosing.
    """

    found = [(0, length)]
    for _ in range(DEPTH):
        if found[0][1] - found[0][0] <= OPEN:
            break
        half = (found[0][1] - found[0][0]) // 2
        found = [part for s, e in found for part in ((s + half, e), (s, e - half))]
    return sorted(set(found))


def chunk_keys(word: str) -> tuple[list[int], list[int]]:
    """Keys of a word's own chunks, and of the grams at which a word shorter by one letter has its chunks.

    A key names the length of the chunks' word, the places of the chunks and their letters. Grams stand at the
    chunk's place before the edit and one further after it.
    """

    def key(length: int, start: int, stop: int) -> int:
        kept = f"{length}:{start}:{word[:start]}\0{word[len(word) - (length - stop):]}"
        return xxhash.xxh64_intdigest(kept.encode()) - (1 << 63)

    own = [key(len(word), s, e) for s, e in holes(len(word))]
    return own, [key(len(word) - 1, s, e) for s, e in holes(len(word) - 1)]


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, longer, at = [], [], []
        for i, word in enumerate(batch.column(0)):
            own, grams = chunk_keys(word.as_py())
            keys += own + grams
            longer += [False] * len(own) + [True] * len(grams)
            at += [i] * (len(own) + len(grams))
        picked = pa.array(at, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int64()), pa.array(longer, pa.bool_()), batch.column(0).take(picked), batch.column(1).take(picked)],
            ["key", "longer", "word", "n"])


def near_pairs(words: DataFrame) -> DataFrame:
    """``a, n_a, b, n_b`` of all pairs of distinct words that differ by one inserted, deleted or replaced letter, once each.

    The shorter word of a pair, or the first one of equal length, gives its chunks, the other one its grams. Chunks cover
    all but an eighth of a word, or but two letters, so a key is shared by few words whatever the size of the
    vocabulary. Each pair found is verified.
    """

    keys = materialize(words.select("word", "n").mapInArrow(_keys, "key long, longer boolean, word string, n long"), "chunks")
    chunks = keys.filter("not longer").select("key", F.col("word").alias("a"), F.col("n").alias("n_a"))
    grams = keys.select("key", "longer", F.col("word").alias("b"), F.col("n").alias("n_b"))
    met = chunks.join(grams, "key").filter(F.col("longer") | (F.col("a") < F.col("b")))
    return met.filter(F.levenshtein("a", "b", 1) == 1).select("a", "n_a", "b", "n_b").distinct()


def spelling_forms(words: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of each row of ``words`` (word, n; words are unique).

    A word's form is its most frequent near word (the first in code-point order of equals), if that is at least twice as
    frequent; following forms leads to its root. Counts at least double on the way, so there are no circles, and
    the rounds grow with the logarithm of that way's length. Without words there are no rows.
    """

    words = materialize(words.select("word", "n"), "words")
    pairs = near_pairs(words)
    sides = pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("near_n")))).alias("s")).select("s.*")
    best = sides.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    chosen = words.join(best, "word", "left")
    strong = -F.col("best.less") >= 2 * F.col("n")
    formed = materialize(chosen.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(strong, F.col("best.near")).alias("form"), F.when(strong, -F.col("best.less")).alias("form_n")), "forms")
    return formed.join(_roots(formed), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(formed: DataFrame) -> DataFrame:
    """(word, root) of words that have a form; each round doubles the steps taken."""

    steps = formed.filter("form is not null").select("word", F.col("form").alias("root"))
    while True:
        further = steps.select(F.col("word").alias("_from"), F.col("root").alias("_to"))
        walked = steps.join(further, steps["root"] == further["_from"], "left")
        steps = materialize(
            walked.select("word", F.coalesce("_to", "root").alias("root"), F.col("_to").isNotNull().alias("_moved")), "roots")
        if steps.filter("_moved").isEmpty():
            return steps.select("word", "root")
        steps = steps.select("word", "root")
