"""Benchmark passages in documents, found by one Aho-Corasick automaton.

Words are lower-cased runs of ASCII letters, digits and non-ASCII characters. Every run of
``window`` words of an item (or the whole item, if it is shorter) is a pattern; a document
is scanned once, and each hit is mapped back to its words and to bytes of the original.

The items are gathered on the driver only up to ``max_bytes`` of text, which is checked
first; more items are scanned in blocks of that size, one after the other, and the marks of
all blocks are put together by document.

Null and empty texts have no words and no hits; items without words are never found;
repeated items are found under each of their ids; repeated documents are separate rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import ids_and_texts, small_batches, texts_of
from skyledger.session import materialize

WINDOW = 10
#: Item text that one automaton may hold.
BLOCK_BYTES = 16_000_000

_KEPT = bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
#: Lower case for A to Z, a blank for every ASCII byte that no word holds.
_TABLE = bytes(c if c in _KEPT else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256))
SCHEMA = "id {id}, n_words long, hit_words array<int>, hit_starts array<int>, hit_ends array<int>, items array<string>"


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


def windows_of(text: bytes, window: int = WINDOW) -> set[bytes]:
    words = words_of(text)
    if not words:
        return set()
    return {b" ".join(words[k:k + window]) for k in range(max(1, len(words) - window + 1))}


def automaton_of(items: list[tuple[str, bytes]], window: int = WINDOW):
    """The automaton over all windows; a pattern carries its word count and its item ids."""

    owners: dict[bytes, list[str]] = {}
    for name, text in items:
        for pattern in windows_of(text, window):
            owners.setdefault(pattern, []).append(name)
    found = ahocorasick.Automaton()
    for pattern, names in owners.items():
        # Blanks around it keep a hit on whole words; Latin-1 keeps one character for each byte.
        found.add_word(f" {pattern.decode('latin-1')} ", (pattern.count(b" ") + 1, tuple(sorted(set(names)))))
    if len(found):
        found.make_automaton()
    return found


def scan(text: bytes, found) -> tuple[int, np.ndarray, np.ndarray, np.ndarray, list[str]]:
    """Words of a text, the hit words, their byte spans in the text, and the items found."""

    mapped = text.translate(_TABLE)
    words = mapped.split()
    none = np.zeros(0, np.int32)
    if not words or not len(found):
        return len(words), none, none, none, []
    line = f" {b' '.join(words).decode('latin-1')} "
    hits = list(found.iter(line))
    if not hits:
        return len(words), none, none, none, []
    # The word that ends before each blank: number of blanks up to a hit's end, less one.
    blanks = np.cumsum(np.frombuffer(line.encode("latin-1"), np.uint8) == 0x20)
    edges, names = np.zeros(len(words) + 1, np.int64), set()
    for end, (size, owners) in hits:
        last = int(blanks[end]) - 1
        edges[last - size] += 1
        edges[last] -= 1
        names.update(owners)
    marked = np.flatnonzero(np.cumsum(edges)[:-1] > 0)
    inside = np.frombuffer(mapped, np.uint8) != 0x20
    turns = np.flatnonzero(np.diff(np.concatenate(([0], inside.view(np.int8), [0]))))
    starts, ends = turns[0::2], turns[1::2]
    return len(words), marked.astype(np.int32), starts[marked].astype(np.int32), ends[marked].astype(np.int32), sorted(names)


def _scanner(shared, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = automaton_of(shared.value, window)
        kinds = [pa.int64(), *[pa.list_(pa.int32())] * 3, pa.list_(pa.string())]
        for batch in batches:
            rows = [scan(text, found) for text in texts_of(batch.column(1))]
            columns = [pa.array([row[k] for row in rows], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns], names=["id", "n_words", "hit_words", "hit_starts", "hit_ends", "items"])

    return run


def item_blocks(items: DataFrame, block_bytes: int) -> Iterator[list[tuple[str, bytes]]]:
    """Items, streamed in blocks whose text is no longer than ``block_bytes`` (or one item each)."""

    block, size = [], 0
    for row in items.toLocalIterator():
        data = (row["text"] or "").encode()
        if block and size + len(data) > block_bytes:
            yield block
            block, size = [], 0
        block.append((str(row["id"]), data))
        size += len(data)
    yield block


def find_passages(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(id, n_words, hit_words, hit_starts, hit_ends, items) of every document.

    ``hit_words`` are word positions from 0, the spans are bytes of the original text, and
    ``items`` are ids as text in order. The documents are read once for each block of items.
    """

    spark = docs.sparkSession
    small_batches(spark)
    pairs = ids_and_texts(docs, id_col, text_col)
    shared = [spark.sparkContext.broadcast(block)
              for block in item_blocks(ids_and_texts(items, item_col, item_text_col), block_bytes)]
    if len(shared) == 1:
        return pairs.mapInArrow(_scanner(shared[0], window), SCHEMA.format(id=pairs.schema["id"].dataType.simpleString()))
    # Rows get a number that stays: documents may repeat, and every block marks the same row.
    rows = materialize(pairs.select(F.monotonically_increasing_id().alias("row"), "id", "text"), "documents")
    every = None
    for block in shared:
        part = rows.select("row", "text").mapInArrow(_scanner(block, window), SCHEMA.format(id="bigint"))
        every = part if every is None else every.union(part)
    marks = every.groupBy("id").agg(
        F.max("n_words").alias("n_words"),
        # One list for each block. A hit word is one position with its span, so all three sort alike.
        *[F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c)
          for c in ("hit_words", "hit_starts", "hit_ends", "items")])
    return rows.select("row", "id").join(marks.withColumnRenamed("id", "row"), "row").drop("row")


def passage_digests(found: DataFrame) -> DataFrame:
    """The counts and the digest of the items found, one row for each document."""

    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        F.size("hit_words").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.size("hit_words") > 0).alias("contaminated"),
    )
