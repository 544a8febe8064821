"""Jaccard join of word shingles, with signature trees, into linked components.

Shingles become 63-bit keys that sort rare ones first: the upper bits say how common the
three words are, the rest is a hash. Two sets can only link if they share one of their
first ``n - ceil(t n) + 1`` keys, so documents meet under those keys alone.

1. *Sets.* Each text gives its set size, a 128-bit digest of the set, those first keys and a
   bitmap of the whole set. Equal sets become one node.
2. *Signature trees.* Nodes under a shared key form a tree by size: each tree node holds the
   OR of the bitmaps below it and their range of sizes. A dual traversal drops pairs of tree
   nodes whose sizes or largest possible overlap rule out a link, down to pairs of sets. What
   remains is only kept as a spanning forest: no group gives all its pairs.
3. *Verification.* Sets that may link, directly or through others, meet in one place again
   with their whole sets, and overlaps are counted exactly.
4. *Components.* The exact links give the components; equal sets share theirs.

Keys and clusters that hold very many sets are cut into blocks, and each pair of blocks is a
task of its own, so no task holds an unbounded group. Nothing is dropped.

Null and empty texts have an empty set and link with nothing; texts of one or two words have
one shingle. Rows with the same id are separate rows of the result; a null id is never the
smallest unless all of its component are null. An empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.common import ids_and_texts, lower_words, small_batches, texts_of
from skyledger.llm.components import roots
from skyledger.session import materialize

SHINGLE = 3
PERCENT = 90
#: Words whose counts order the shingles (any order gives the same result), and words a task counts at once.
COMMON_WORDS, COUNTED_WORDS = 65_536, 400_000
#: Sets under one key or in one cluster that a task takes; more are cut into blocks of this size.
BLOCK_SETS = 3_000
#: Key entries of one bucket, and shingles of one pack, on average.
BUCKET_ENTRIES, PACK_SHINGLES = 30_000, 2_000_000
LEAF, FANOUT, CHUNK = 8, 8, 200_000
HASH_BITS = 57


def prefix_size(n, percent: int):
    """How many of a set's first keys have to be shared with any set that it may link to."""

    return n + (-percent * n) // 100 + 1


# --- counts of common words -------------------------------------------------------------------------


def _count_words(batches: Iterator[pa.RecordBatch], most: int = COMMON_WORDS, held: int = COUNTED_WORDS) -> Iterator[pa.RecordBatch]:
    """The most frequent words of a task, from counters of bounded size."""

    counts: Counter = Counter()
    for batch in batches:
        for text in texts_of(batch.column(0)):
            counts.update(lower_words(text))
            if len(counts) > 2 * held:
                counts = Counter(dict(counts.most_common(held)))
    top = [(w, c) for w, c in counts.most_common(most) if c > 1 and len(w) <= 64]
    yield pa.RecordBatch.from_pydict({"word": pa.array([w for w, _ in top], pa.binary()), "n": pa.array([c for _, c in top], pa.int64())})


def common_words(texts: DataFrame, most: int = COMMON_WORDS) -> dict[bytes, int]:
    """A level from 1 (rarest) to 15 for each of the most frequent words; others are at level 0."""

    counted = texts.select("text").mapInArrow(partial(_count_words, most=most), "word binary, n long")
    top = counted.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(most).collect()
    least = top[-1]["n"] if top else 1
    return {bytes(r["word"]): 1 + min(14, int(np.log2(r["n"] / least))) for r in top}


# --- sets ------------------------------------------------------------------------------------------


class Shingler:
    """Sorted keys of the shingles of a text."""

    def __init__(self, levels: dict[bytes, int], size: int = SHINGLE):
        self.levels, self.size, self.known = levels, size, {}

    def _code(self, word: bytes) -> tuple[int, int]:
        found = self.known.get(word)
        if found is None:
            found = xxhash.xxh3_64_intdigest(word), self.levels.get(word, 0)
            if len(word) <= 64:
                if len(self.known) > 500_000:
                    self.known.clear()
                self.known[word] = found
        return found

    def keys(self, text: bytes) -> np.ndarray:
        words = lower_words(text)
        if not words:
            return np.zeros(0, np.int64)
        codes = [self._code(w) for w in words]
        hashes = np.array([h for h, _ in codes], np.uint64)
        levels = np.array([c for _, c in codes], np.uint64)
        size, count = min(self.size, len(words)), max(1, len(words) - self.size + 1)
        mixed, common = np.full(count, size, np.uint64), np.zeros(count, np.uint64)
        for k in range(size):
            mixed = (mixed ^ hashes[k:k + count]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
            common += levels[k:k + count]
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(32)
        return np.unique((common << np.uint64(HASH_BITS) | mixed >> np.uint64(64 - HASH_BITS)).astype(np.int64))


def size_class(n: int) -> int:
    return int(n).bit_length() - 1


def bitmap(keys: np.ndarray) -> np.ndarray:
    """A bit for each key, in 4 * 2 ^ class bits: 2 to 4 bits for each key."""

    bits = 4 << size_class(len(keys))
    out = np.zeros(max(8, bits // 8), np.uint8)
    place = keys & (bits - 1)
    np.bitwise_or.at(out, place >> 3, (1 << (place & 7)).astype(np.uint8))
    return out


def digest(keys: np.ndarray) -> tuple[int, int]:
    whole = xxhash.xxh3_128_intdigest(keys.tobytes())
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    return signed(whole >> 64), signed(whole & (1 << 64) - 1)


SETS = "id {id}, n int, h1 long, h2 long, firsts array<long>, bits binary"


def _sets(shared, percent: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(shared.value)
        for batch in batches:
            out = []
            for text in texts_of(batch.column(1)):
                keys = shingler.keys(text)
                if len(keys):
                    out.append((len(keys), *digest(keys), keys[:prefix_size(len(keys), percent)], bitmap(keys).tobytes()))
                else:
                    out.append((0, 0, 0, None, None))
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary())
            columns = [pa.array([row[k] for row in out], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["id", "n", "h1", "h2", "firsts", "bits"])

    return run


# --- signature trees -------------------------------------------------------------------------------


class Forest:
    """Which sets are already together."""

    def __init__(self, count: int):
        self.parent = np.arange(count)
        self.kept: list[tuple[int, int]] = []

    def find(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return int(x)

    def apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        parent = self.parent
        while True:
            upper = parent[parent]
            if np.array_equal(upper, parent):
                break
            parent = upper
        self.parent = parent
        return parent[a] != parent[b]

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        for x, y in zip(a.tolist(), b.tolist()):
            u, v = self.find(x), self.find(y)
            if u != v:
                self.parent[max(u, v)] = min(u, v)
                self.kept.append((x, y))


def _may_link(overlap, a, b, percent):
    return overlap * (100 + percent) >= percent * (a + b)


def tree_levels(group: np.ndarray, size: np.ndarray, bits: np.ndarray) -> list[dict]:
    """Levels from the entries (sorted by group and size) up to one root for each group."""

    levels = [{"group": group, "low": size, "high": size, "bits": bits,
               "slack": size - np.bitwise_count(bits).sum(1).astype(np.int64), "start": None}]
    while True:
        below = levels[-1]
        turn = np.concatenate(([True], below["group"][1:] != below["group"][:-1]))
        if turn.all():
            return levels
        place = np.arange(len(turn)) - np.maximum.accumulate(np.where(turn, np.arange(len(turn)), 0))
        start = np.flatnonzero(turn | (place % (LEAF if len(levels) == 1 else FANOUT) == 0))
        levels.append({
            "group": below["group"][start], "low": np.minimum.reduceat(below["low"], start),
            "high": np.maximum.reduceat(below["high"], start), "bits": np.bitwise_or.reduceat(below["bits"], start, axis=0),
            "slack": np.maximum.reduceat(below["slack"], start), "start": np.append(start, len(turn)),
        })


def _children(level: dict, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of children of pairs of tree nodes, each unordered pair once."""

    start = level["start"]
    na, nb = start[a + 1] - start[a], start[b + 1] - start[b]
    count = na * nb
    pair = np.repeat(np.arange(len(a)), count)
    k = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    left, right = start[a][pair] + k // nb[pair], start[b][pair] + k % nb[pair]
    once = (a[pair] != b[pair]) | (left <= right)
    return left[once], right[once]


def traverse(group: np.ndarray, size: np.ndarray, bits: np.ndarray, member: np.ndarray, forest: Forest, percent: int) -> None:
    """Join in ``forest`` the members of entries that share a group and may link, by a dual traversal."""

    levels = tree_levels(group, size, bits)
    top = len(levels) - 1
    stack = [(top, np.arange(len(levels[top]["low"])), np.arange(len(levels[top]["low"])))]
    while stack:
        depth, a, b = stack.pop()
        if len(a) > CHUNK:
            stack.append((depth, a[CHUNK:], b[CHUNK:]))
            a, b = a[:CHUNK], b[:CHUNK]
        here = levels[depth]
        if depth == 0:
            apart = (a != b) & forest.apart(member[a], member[b])
            a, b = a[apart], b[apart]
        low, high = here["low"], here["high"]
        fits = (100 * high[b] >= percent * low[a]) & (100 * high[a] >= percent * low[b])
        a, b = a[fits], b[fits]
        if not len(a):
            continue
        x, y = here["bits"][a], here["bits"][b]
        shared = np.bitwise_count(x & y).sum(1).astype(np.int64)
        if depth:
            most = np.minimum(shared + np.minimum(here["slack"][a], here["slack"][b]), np.minimum(high[a], high[b]))
        else:  # of single sets: a key whose bit the other lacks is not in the other
            most = np.minimum(low[a] - np.bitwise_count(x).sum(1) + shared, low[b] - np.bitwise_count(y).sum(1) + shared)
        keep = _may_link(most, low[a], low[b], percent)
        a, b = a[keep], b[keep]
        if depth == 0:
            forest.add(member[a], member[b])
        elif len(a):
            stack.append((depth - 1, *_children(here, a, b)))


def candidate_forest(key: np.ndarray, member: np.ndarray, size: np.ndarray, bits: list[bytes], percent: int) -> list[tuple[int, int]]:
    """Pairs of members that tie together all that may link; ``key`` and ``member`` are entries, the rest is by member."""

    forest = Forest(len(size))
    classes = np.frompyfunc(size_class, 1, 1)(size).astype(np.int64)
    for c in np.unique(classes):
        # Sets of one class, and sets on both sides of its lower end, whose bitmaps are folded to the narrower width.
        near = (classes == c) & (percent * size <= 100 << c) | (classes == c - 1) & (100 * size >= percent << c)
        for chosen, width in ((classes == c, max(8, (4 << c) // 8)), (near, max(8, (2 << c) // 8))):
            if c == 0 and chosen is near or chosen.sum() < 2:
                continue
            rows = np.flatnonzero(chosen)
            place = np.full(len(size), -1)
            place[rows] = np.arange(len(rows))
            table = np.zeros((len(rows), width), np.uint8)
            for k, row in enumerate(rows):
                whole = np.frombuffer(bits[row], np.uint8)
                table[k] = whole if len(whole) == width else np.bitwise_or.reduce(whole.reshape(-1, width), axis=0)
            entry = np.flatnonzero(chosen[member])
            order = entry[np.lexsort((size[member[entry]], key[entry]))]
            if len(order):
                words = table.view(np.uint64)[place[member[order]]]
                traverse(key[order], size[member[order]].astype(np.int64), words, member[order], forest, percent)
    return forest.kept


def _links(pairs: list[tuple[int, int]], names: np.ndarray) -> pa.Table:
    ends = np.array(pairs, np.int64).reshape(-1, 2)
    return pa.table({"a": pa.array(names[ends[:, 0]], pa.int64()), "b": pa.array(names[ends[:, 1]], pa.int64())})


def _bucket(percent: int) -> Callable:
    def run(rows: pa.Table) -> pa.Table:
        keys = rows["keys"].combine_chunks()
        member = np.repeat(np.arange(rows.num_rows), np.diff(keys.offsets.to_numpy()))
        found = candidate_forest(keys.flatten().to_numpy(), member, rows["n"].to_numpy().astype(np.int64), rows["bits"].to_pylist(), percent)
        return _links(found, rows["node"].to_numpy())

    return run


# --- exact verification -----------------------------------------------------------------------------


def exact_forest(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int, block: int = 512) -> list[tuple[int, int]]:
    """A spanning forest of the exact links between the left and the right sets (which may be the same)."""

    forest = Forest(len(sets))
    size = np.array([len(s) for s in sets], np.int64)
    left, right = left[np.argsort(size[left], kind="stable")], right[np.argsort(size[right], kind="stable")]
    for at in range(0, len(left), block):
        a = left[at:at + block]
        low, high = size[a[0]], size[a[-1]]
        near = right[(100 * size[right] >= percent * low) & (percent * size[right] <= 100 * high)]
        for to in range(0, len(near), block):
            b = near[to:to + block]
            if a is b or not len(b):
                continue
            # Only keys on both sides count; each becomes a column.
            shared = np.intersect1d(np.concatenate([sets[i] for i in a]), np.concatenate([sets[i] for i in b]))
            if not len(shared):
                continue
            overlap = np.zeros((len(a), len(b)), np.int64)
            for start in range(0, len(shared), 8192):
                part = shared[start:start + 8192]
                overlap += (_columns(sets, a, part) @ _columns(sets, b, part).T).astype(np.int64)
            i, j = np.nonzero(_may_link(overlap, size[a][:, None], size[b][None, :], percent))
            i, j = a[i], b[j]
            apart = (i != j) & forest.apart(i, j)
            forest.add(i[apart], j[apart])
    return forest.kept


def _columns(sets: list[np.ndarray], chosen: np.ndarray, keys: np.ndarray) -> np.ndarray:
    out = np.zeros((len(chosen), len(keys)), np.float32)
    for row, k in enumerate(chosen):
        own = sets[k]
        own = own[np.searchsorted(own, keys[0]):np.searchsorted(own, keys[-1], "right")]
        place = np.searchsorted(keys, own)
        out[row, place[keys[np.minimum(place, len(keys) - 1)] == own]] = 1
    return out


def _pack(percent: int) -> Callable:
    def run(rows: pa.Table) -> pa.Table:
        table = rows.select(["cluster", "i", "j", "block", "node"]).to_pandas()
        table["row"] = np.arange(len(table))
        keys = rows["keys"].combine_chunks()
        offsets, flat = keys.offsets.to_numpy(), keys.values.to_numpy()
        names, found = table["node"].to_numpy(), []
        for (_, i, j), part in table.drop_duplicates(["cluster", "i", "j", "node"]).groupby(["cluster", "i", "j"], sort=False):
            row = part["row"].to_numpy()
            block = part["block"].to_numpy()
            sets = [flat[offsets[r]:offsets[r + 1]] for r in row]
            links = exact_forest(sets, np.flatnonzero(block == i), np.flatnonzero(block == j), percent)
            found.extend((row[a], row[b]) for a, b in links)
        return _links(found, names)

    return run


def _whole_sets(shared) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(shared.value)
        for batch in batches:
            h1, h2 = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            rows, sets = [], []
            for k, text in enumerate(texts_of(batch.column(0))):
                keys = shingler.keys(text)
                if len(keys) and digest(keys) == (h1[k], h2[k]):  # not another row with the same id
                    rows.append(k)
                    sets.append(keys)
            yield pa.RecordBatch.from_arrays(
                [batch.column(1).take(pa.array(rows, pa.int32())), batch.column(4).take(pa.array(rows, pa.int32())),
                 pa.array(sets, pa.list_(pa.int64()))], names=["node", "cluster", "keys"])

    return run


def _blocks(rows: DataFrame, count, node: str = "node") -> DataFrame:
    """Rows of a group of ``count`` sets, once for each pair of blocks (i, j) that its own block is in."""

    spread = rows.withColumn("cuts", F.ceil(count / BLOCK_SETS).cast("int")).withColumn(
        "block", F.pmod(F.xxhash64(node), F.col("cuts")).cast("int"))
    return spread.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1))).withColumn(
        "i", F.least("block", "other").cast("int")).withColumn("j", F.greatest("block", "other").cast("int")).drop("other", "cuts")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """(id, n_shingles, component_id) of every document; ids are compared as they are, so take numbers."""

    spark = docs.sparkSession
    small_batches(spark)
    pairs = ids_and_texts(docs, id_col, text_col)
    kind = pairs.schema["id"].dataType.simpleString()
    shared = spark.sparkContext.broadcast(common_words(pairs))
    sets = materialize(pairs.mapInArrow(_sets(shared, percent), SETS.format(id=kind)), "sets")
    same = Window.partitionBy("h1", "h2", "n").orderBy(F.asc_nulls_last("id"))
    # Spark drops later copies within each task before the shuffle.
    firsts = sets.filter("n > 0").withColumn("copy", F.row_number().over(same)).filter("copy = 1").drop("copy")
    nodes = materialize(firsts.withColumn("node", F.monotonically_increasing_id()), "nodes")

    entries = nodes.select("node", F.explode("firsts").alias("key"))
    met = materialize(entries.groupBy("key").agg(F.count(F.lit(1)).alias("count")).filter("count > 1"), "keys")
    total = met.agg(F.sum("count")).first()[0] or 0
    buckets = max(1, -(-total // BUCKET_ENTRIES))
    split = _blocks(entries.join(met, "key"), F.col("count"))
    placed = split.select("node", F.xxhash64("key", "i", "j").alias("key")).withColumn(
        "bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int"))
    # A node has no more keys in a bucket than first keys.
    gathered = placed.groupBy("node", "bucket").agg(F.collect_list("key").alias("keys"))
    candidates = gathered.join(nodes.select("node", "n", "bits"), "node").groupBy("bucket").applyInArrow(_bucket(percent), "a long, b long")
    clusters = materialize(roots(candidates).withColumnRenamed("root", "cluster"), "clusters")

    sizes = clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("count"))
    suspects = clusters.join(nodes.select("node", "id", "h1", "h2", "n"), "node")
    shingles = suspects.agg(F.sum("n")).first()[0] or 0
    packs = max(1, -(-shingles // PACK_SHINGLES))
    wanted = suspects.select(F.col("id").alias("wanted"), "node", "h1", "h2", "cluster")
    whole = pairs.join(wanted, pairs["id"].eqNullSafe(wanted["wanted"])).select("text", "node", "h1", "h2", "cluster").mapInArrow(
        _whole_sets(shared), "node long, cluster long, keys array<long>")
    packed = _blocks(whole.join(sizes, "cluster"), F.col("count")).withColumn(
        "pack", F.pmod(F.xxhash64("cluster", "i", "j"), F.lit(packs)).cast("int"))
    links = packed.select("cluster", "i", "j", "block", "node", "keys", "pack").groupBy("pack").applyInArrow(_pack(percent), "a long, b long")
    linked = roots(links)

    smallest = nodes.select("node", "h1", "h2", "n", "id").join(linked, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = smallest.groupBy("root").agg(F.min("id").alias("component_id"))
    of_set = smallest.join(named, "root").select("h1", "h2", "n", "component_id")
    return sets.select("id", "n", "h1", "h2").join(of_set, ["h1", "h2", "n"], "left").select(
        "id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"))
