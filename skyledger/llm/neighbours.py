"""Nearest neighbours by inner product, through learned partitions.

1. *Sample.* At most ``sample_rows`` distinct vectors (the smallest by a hash of their id)
   are used to fit the index; every vector is indexed.
2. *Graph.* Each sampled vector is joined to its nearest sampled neighbours.
3. *Balanced partitioning.* The graph is cut in two again and again: a start from its
   slowest mode, split at the median, then exchanges of vertices between the halves, as
   many each way, while they save cut edges. All parts have the same size, give or take one.
4. *Classifier.* A softmax classifier learns, for a vector, how its neighbours spread over
   the parts. Vectors go to the most probable part; a query goes to the several most
   probable ones, until they hold ``mass`` of the probability (``least`` parts or more).
5. *Reranking.* Candidates of the parts are compared with the query by the exact inner
   product in double precision on the original vectors.

Equal vectors are one candidate with a list of ids. Any answer has at most k + 1 of them
(the query itself is left out), so only their k + 1 smallest ids are kept; and equal queries
are searched once. That keeps answers whole however often a vector occurs. A part that
holds many vectors is cut into pieces of at most ``piece_rows`` on average, searched apart.

Vectors that are null, zero, or hold null or non-finite numbers take no part; nor do those
whose length is not the most frequent one (the greater of two as frequent). A null id takes
no part. Rows with equal id and vector count once. Fewer candidates than k give all of them;
an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.session import materialize

SAMPLE_ROWS = 6_000
GRAPH_NEIGHBOURS = 12
#: Sampled vectors of one part.
PART_SAMPLES = 60
MASS, LEAST = 0.96, 4
PIECE_ROWS = 4_000
#: Bound of a component while routing; scores are of the vectors as they are.
LARGEST = 1e15


def neighbour_graph(x: np.ndarray, k: int, block: int = 512) -> np.ndarray:
    """For each row the k rows with the largest inner product, itself left out."""

    k = min(k, len(x) - 1)
    out = np.empty((len(x), k), np.int64)
    for at in range(0, len(x), block):
        near = x[at:at + block] @ x.T
        near[np.arange(len(near)), np.arange(at, at + len(near))] = -np.inf
        out[at:at + block] = np.argpartition(-near, k - 1, axis=1)[:, :k] if k else 0
    return out


def _halves(members: np.ndarray, graph: np.ndarray, x: np.ndarray, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Two halves of the members with few graph edges between them."""

    place = np.full(len(graph), -1)
    place[members] = np.arange(len(members))
    ends = place[graph[members]]
    rows, cols = np.nonzero(ends >= 0)
    heads, tails = rows, ends[rows, cols]
    degree = np.bincount(heads, minlength=len(members)) + np.bincount(tails, minlength=len(members)) + 1e-9
    # The slowest mode of the graph by repeated averaging over neighbours, away from the constant.
    mode = (x[members] - x[members].mean(0)) @ np.linalg.svd(x[members] - x[members].mean(0), full_matrices=False)[2][0]
    for _ in range(60):
        spread = np.bincount(heads, mode[tails], len(members)) + np.bincount(tails, mode[heads], len(members))
        mode = 0.5 * mode + 0.5 * spread / degree
        mode -= (mode * degree).sum() / degree.sum()
        mode /= np.abs(mode).max() + 1e-12
    side = np.zeros(len(members), bool)
    side[np.argsort(mode, kind="stable")[len(members) // 2:]] = True
    for _ in range(rounds):
        signs = np.where(side, 1.0, -1.0)
        pull = np.bincount(heads, signs[tails], len(members)) + np.bincount(tails, signs[heads], len(members))
        gain = -pull * signs
        left, right = np.flatnonzero(~side), np.flatnonzero(side)
        left, right = left[np.argsort(-gain[left], kind="stable")], right[np.argsort(-gain[right], kind="stable")]
        size = min(len(left), len(right))
        # Half of the paying exchanges at a time, since neighbours that move together gain nothing.
        pays = int((gain[left[:size]] + gain[right[:size]] > 0).sum()) // 2
        if not pays:
            break
        side[left[:pays]], side[right[:pays]] = True, False
    return members[~side], members[side]


def balanced_parts(graph: np.ndarray, x: np.ndarray, part_rows: int) -> np.ndarray:
    """The part of each vertex: halves of halves until none has more than ``part_rows``."""

    label, open_, count = np.zeros(len(graph), np.int64), [np.arange(len(graph))], 0
    while open_:
        members = open_.pop()
        if len(members) <= part_rows or len(members) < 4:
            label[members] = count
            count += 1
        else:
            open_.extend(_halves(members, graph, x))
    return label


@dataclass
class Router:
    """A softmax classifier over the parts."""

    weights: np.ndarray
    bias: np.ndarray

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        z = x @ self.weights + self.bias
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)

    def home(self, x: np.ndarray) -> np.ndarray:
        return np.argmax(x @ self.weights + self.bias, axis=1)

    def routes(self, x: np.ndarray, mass: float, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, part) pairs: for each row its most probable parts until they hold ``mass``."""

        p = self.probabilities(x)
        order = np.argsort(-p, axis=1, kind="stable")
        before = np.cumsum(np.take_along_axis(p, order, 1), axis=1) - np.take_along_axis(p, order, 1)
        taken = before < mass
        taken[:, :least] = True
        rows, columns = np.nonzero(taken)
        return rows, order[rows, columns]


def fit_router(x: np.ndarray, graph: np.ndarray, label: np.ndarray, rounds: int = 150, rate: float = 0.1) -> Router:
    """Learn how the neighbours of a vector spread over the parts (its own part counts as one more)."""

    parts = int(label.max()) + 1
    target = np.zeros((len(x), parts), np.float32)
    np.add.at(target, (np.repeat(np.arange(len(x)), graph.shape[1]), label[graph].ravel()), 1.0)
    target[np.arange(len(x)), label] += 1.0
    target /= target.sum(1, keepdims=True)
    router = Router(np.zeros((x.shape[1], parts), np.float32), np.zeros(parts, np.float32))
    moments = [[np.zeros_like(v), np.zeros_like(v)] for v in (router.weights, router.bias)]
    for step in range(1, rounds + 1):
        wrong = (router.probabilities(x) - target) / len(x)
        for value, slope, (first, second) in zip((router.weights, router.bias), (x.T @ wrong, wrong.sum(0)), moments):
            first += 0.1 * (slope - first)
            second += 0.01 * (slope * slope - second)
            value -= rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-8)
    return router


def _routable(x: np.ndarray) -> np.ndarray:
    """Single precision for routing only; what is too large for sums of squares there is clipped."""

    return np.ascontiguousarray(np.clip(x, -LARGEST, LARGEST), np.float32)


def fit_index(x: np.ndarray, part_rows: int = PART_SAMPLES, k: int = GRAPH_NEIGHBOURS) -> Router:
    x = _routable(x)
    if len(x) <= part_rows:
        return Router(np.zeros((x.shape[1], 1), np.float32), np.zeros(1, np.float32))
    graph = neighbour_graph(x, k)
    return fit_router(x, graph, balanced_parts(graph, x, part_rows))


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vec) of the rows that take part, each once; single-precision vectors stay so, others are doubles."""

    kind = "array<float>" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "array<double>"
    named = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").cast(kind).alias("vec"))
    sound = named.filter(
        F.col("id").isNotNull() & F.forall("vec", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
        & F.exists("vec", lambda v: v != 0)).dropDuplicates(["id", "vec"])
    sizes = sound.groupBy(F.size("vec").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    return sound.filter(F.size("vec") == (sizes["size"] if sizes else 0))


def distinct_vectors(sound: DataFrame, keep: int) -> DataFrame:
    """(rep, vec, ids): each vector once with its ``keep`` smallest ids; rep is the smallest."""

    # Spark limits the rows of a vector within each task before they are shuffled.
    ranked = sound.withColumn("n", F.row_number().over(Window.partitionBy("vec").orderBy("id"))).filter(F.col("n") <= keep)
    return ranked.groupBy("vec").agg(F.array_sort(F.collect_list("id")).alias("ids")).select(F.col("ids")[0].alias("rep"), "vec", "ids")


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.combine_chunks().flatten() if isinstance(column, pa.ChunkedArray) else column.flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _router_over(shared, mass: float | None, least: int) -> Callable:
    """Rows (rep, vec) with their home part, or with each part that a query is routed to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        router = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _routable(_matrix(batch.column(1)))
            rows, parts = (np.arange(len(x)), router.home(x)) if mass is None else router.routes(x, mass, least)
            taken = batch.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([taken.column(0), taken.column(1), pa.array(parts.astype(np.int32))], names=["rep", "vec", "part"])

    return run


def _compare(keep: int, block: int = 256) -> Callable:
    """The ``keep`` candidates of one piece nearest to each of the queries routed to it."""

    def run(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        out = {"query": [], "rep": [], "score": []}
        if queries.num_rows and candidates.num_rows:
            q, v = (_matrix(t["vec"]).astype(np.float64) for t in (queries, candidates))
            names, reps = queries["rep"].to_numpy(), candidates["rep"].to_numpy()
            for at in range(0, len(q), block):
                rough = q[at:at + block] @ v.T
                last = np.partition(rough, max(0, rough.shape[1] - keep), axis=1)[:, max(0, rough.shape[1] - keep)]
                # All that tie with the last one, and what rounding may have put below it.
                rows, columns = np.nonzero(rough >= last[:, None] - 1e-9 * (1 + np.abs(last[:, None])))
                exact = np.zeros(len(rows))
                for d in range(q.shape[1]):  # one order of summation for all, so equal vectors score the same
                    exact += q[at + rows, d] * v[columns, d]
                order = np.lexsort((reps[columns], -exact, rows))
                rows, columns, exact = rows[order], columns[order], exact[order]
                rank = np.arange(len(rows)) - np.searchsorted(rows, rows)
                good = rank < keep
                out["query"].append(names[at + rows[good]])
                out["rep"].append(reps[columns[good]])
                out["score"].append(exact[good])
        join = lambda name, kind: pa.array(np.concatenate(out[name]) if out[name] else np.zeros(0), kind)
        return pa.table({"query": join("query", pa.int64()), "rep": join("rep", pa.int64()), "score": join("score", pa.float64())})

    return run


def nearest(vectors: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
            sample_rows: int = SAMPLE_ROWS, part_rows: int = PART_SAMPLES, mass: float = MASS, least: int = LEAST,
            piece_rows: int = PIECE_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score) of the rows for which ``is_query`` (a function of the id column) holds."""

    spark: SparkSession = vectors.sparkSession
    sound = usable(vectors, id_col, vector_col)
    groups = materialize(distinct_vectors(sound, k + 1), "vectors")
    sample = groups.select("rep", "vec").orderBy(F.xxhash64("rep"), "rep").limit(sample_rows).toPandas()
    if sample.empty:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    shared = spark.sparkContext.broadcast(fit_index(np.stack(sample["vec"].to_numpy()), part_rows))
    schema = f"rep long, vec {groups.schema['vec'].dataType.simpleString()}, part int"
    homes = materialize(groups.select("rep", "vec").mapInArrow(_router_over(shared, None, least), schema), "homes")
    sizes = {r["part"]: r["count"] for r in homes.groupBy("part").count().collect()}  # a row for each part
    pieces = np.ones(max(sizes) + 1, int)
    for part, size in sizes.items():
        pieces[part] = -(-size // piece_rows)
    count = F.array(*[F.lit(int(n)) for n in pieces])
    placed = homes.withColumn("piece", F.pmod(F.xxhash64("rep"), F.element_at(count, F.col("part") + 1)).cast("int"))
    asked = sound.filter(is_query(F.col("id"))).join(groups.select("vec", "rep"), "vec").select(F.col("id").alias("query_id"), "rep")
    asked = materialize(asked, "queries")
    routed = groups.select("rep", "vec").join(asked.select("rep").distinct(), "rep", "left_semi").mapInArrow(
        _router_over(shared, mass, least), schema)
    filled = F.array(*[F.sequence(F.lit(0), F.lit(int(pieces[p]) - 1)) if p in sizes else F.array().cast("array<int>")
                       for p in range(len(pieces))])
    # Each query goes to every piece of its parts; parts without vectors have none.
    spread = routed.filter(F.col("part") < len(pieces)).withColumn("piece", F.explode(F.element_at(filled, F.col("part") + 1)))
    found = spread.groupBy("part", "piece").cogroup(placed.groupBy("part", "piece")).applyInArrow(
        _compare(k + 1), "query long, rep long, score double")
    near = Window.partitionBy("query").orderBy(F.desc("score"), "rep")
    best = found.withColumn("n", F.row_number().over(near)).filter(F.col("n") <= k + 1).drop("n")
    each = best.join(groups.select("rep", "ids"), "rep").select("query", "score", F.explode("ids").alias("vec_id"))
    ids = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    listed = each.withColumn("n", F.row_number().over(ids)).filter(F.col("n") <= k + 1).groupBy("query").agg(
        F.array_sort(F.collect_list(F.struct("n", "vec_id", "score"))).alias("near"))
    answers = asked.join(listed, asked["rep"] == listed["query"]).select("query_id", F.slice(F.filter(
        "near", lambda c: c["vec_id"] != F.col("query_id")), 1, k).alias("near"))
    return answers.select("query_id", F.posexplode("near")).select(
        "query_id", (F.col("pos") + 1).cast("int").alias("rank"), "col.vec_id", "col.score")
