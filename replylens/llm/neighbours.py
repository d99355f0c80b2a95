"""Approximate nearest neighbours with learned partitions.

The neighbour graph of a sample is cut into balanced parts, so that near vectors share a
part. A small classifier learns the part of a vector; it gives every vector its part, and each
query the parts in which its neighbours most probably are. Vectors of those parts are compared
with the query exactly. How many parts a query tries is measured on vectors held out of the
sample: as few as find the wanted share of true neighbours.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from replylens.llm.common import map_batches, same, store

NEAREST = 5
QUERY_EVERY = 50
SAMPLE = 16_384  # vectors that the index is fitted on, at most
HELD_OUT = 10  # every tenth of them only measures how many parts to try
RECALL = 0.95  # that must be found among the held-out vectors
PART_VECTORS = 512  # wanted in a part, as far as the sample can tell parts apart
LEAST_NODES = 64  # of the sample in a part
LINKS = 10  # neighbours of a node of the graph
UNEVEN = 1.05  # a part's size against the mean

HIDDEN, EPOCHS, BATCH, RATE = 128, 30, 256, 2e-3
BLOCK_CANDIDATES, BLOCK_QUERIES = 8_192, 1_024

Matrix = np.ndarray


def unit_rows(vectors: Matrix) -> Matrix:
    """Rows of length one, in 32 bits: good for finding, not for the score."""
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)
    return (scaled / np.linalg.norm(scaled, axis=1, keepdims=True)).astype(np.float32)


def nearest_rows(queries: Matrix, vectors: Matrix, k: int, own: Matrix | None = None) -> Matrix:
    """For each row of ``queries`` the ``k`` rows of ``vectors`` with the largest product,
    without the row numbered ``own``."""
    found = []
    for at in range(0, len(queries), 512):
        scores = queries[at : at + 512] @ vectors.T
        if own is not None:
            scores[np.arange(len(scores)), own[at : at + 512]] = -np.inf
        best = np.argpartition(-scores, k - 1, axis=1)[:, :k]
        found.append(np.take_along_axis(best, np.argsort(-np.take_along_axis(scores, best, 1), axis=1), 1))
    return np.concatenate(found) if found else np.zeros((0, k), np.int64)


def neighbour_graph(spark, nodes: Matrix, k: int) -> Matrix:
    """The ``k`` nearest other nodes of each node; blocks of nodes are searched side by side.
    What tasks get is the sample, whose size is bounded."""
    block = 1_024
    shared = spark.sparkContext.broadcast(nodes)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in batch.column(0).to_pylist():
                rows = np.arange(start, min(start + block, len(shared.value)))
                found = nearest_rows(shared.value[rows], shared.value, k, rows)
                lists = pa.array(found.tolist(), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), lists], ["node", "links"])

    starts = spark.range(0, len(nodes), block, numPartitions=-(-len(nodes) // block))
    found = starts.mapInArrow(search, "node long, links array<long>").toPandas().sort_values("node")
    return np.stack(found["links"].to_numpy()).astype(np.int64)


def _bisected(size: int, u: Matrix, v: Matrix, rng: np.random.Generator) -> Matrix:
    """Halves a graph by the second eigenvector of its random walk; True for one half."""
    degree = np.maximum(np.bincount(u, minlength=size), 1).astype(float)
    root = np.sqrt(degree)
    first = root / np.linalg.norm(root)
    x = rng.standard_normal(size)
    for _ in range(60):
        x -= first * (first @ x)
        walked = np.bincount(u, weights=(x / root)[v], minlength=size) / root
        x = (x + walked) / 2  # the shift keeps the smallest eigenvalue from leading
        x /= np.linalg.norm(x) or 1.0
    half = np.zeros(size, bool)
    half[np.argsort(x / root, kind="stable")[size // 2 :]] = True
    return half


def balanced_parts(links: Matrix, parts: int, seed: int = 0) -> Matrix:
    """The part of each node: halved ``log2(parts)`` times, then nodes move to the part that
    holds most of their neighbours while parts stay nearly even."""
    size = len(links)
    u = np.repeat(np.arange(size), links.shape[1])
    v = links.ravel()
    u, v = np.concatenate([u, v]), np.concatenate([v, u])
    rng = np.random.default_rng(seed)
    part, number = np.zeros(size, np.int64), 1
    while number < parts:
        for p in range(number):
            nodes = np.flatnonzero(part == p)
            place = np.full(size, -1)
            place[nodes] = np.arange(len(nodes))
            inside = (place[u] >= 0) & (place[v] >= 0)
            half = _bisected(len(nodes), place[u[inside]], place[v[inside]], rng)
            part[nodes[half]] += number
        number *= 2
    most, least = int(np.ceil(size / parts * UNEVEN)), int(size / parts / UNEVEN)
    for _ in range(10):
        around = np.bincount(u * parts + part[v], minlength=size * parts).reshape(size, parts)
        wanted = around.argmax(1)
        gain = around[np.arange(size), wanted] - around[np.arange(size), part]
        sizes, moved = np.bincount(part, minlength=parts), 0
        for node in np.argsort(-gain, kind="stable")[: int((gain > 0).sum())]:
            old, new = part[node], wanted[node]
            if sizes[new] < most and sizes[old] > least:
                part[node], moved = new, moved + 1
                sizes[new], sizes[old] = sizes[new] + 1, sizes[old] - 1
        if not moved:
            break
    return part


@dataclass
class Router:
    """A network with one hidden layer, and how many parts are tried."""

    weights: list[Matrix]
    parts: int
    tries: int = 1

    def scores(self, vectors: Matrix) -> Matrix:
        a, b, c, d = self.weights
        return np.maximum(vectors @ a + b, 0) @ c + d

    def part(self, vectors: Matrix) -> Matrix:
        return self.scores(vectors).argmax(1)

    def order(self, vectors: Matrix) -> Matrix:
        """All parts, the most probable first."""
        return np.argsort(-self.scores(vectors), axis=1, kind="stable")


def train_router(vectors: Matrix, targets: Matrix, seed: int = 0) -> Router:
    """Fits the parts' probabilities ``targets`` by Adam on the cross entropy."""
    rng = np.random.default_rng(seed)
    width, parts = vectors.shape[1], targets.shape[1]
    shapes = [(width, HIDDEN), (HIDDEN,), (HIDDEN, parts), (parts,)]
    weights = [
        (rng.standard_normal(s) * np.sqrt(2 / s[0]) if len(s) == 2 else np.zeros(s)).astype(np.float32) for s in shapes
    ]
    mean, square, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        order = rng.permutation(len(vectors))
        for at in range(0, len(order), BATCH):
            rows = order[at : at + BATCH]
            x, hidden = vectors[rows], np.maximum(vectors[rows] @ weights[0] + weights[1], 0)
            logits = hidden @ weights[2] + weights[3]
            logits -= logits.max(1, keepdims=True)
            guess = np.exp(logits)
            guess /= guess.sum(1, keepdims=True)
            error = (guess - targets[rows]) / len(rows)
            back = (error @ weights[2].T) * (hidden > 0)
            step += 1
            for i, slope in enumerate((x.T @ back, back.sum(0), hidden.T @ error, error.sum(0))):
                mean[i] = 0.9 * mean[i] + 0.1 * slope
                square[i] = 0.999 * square[i] + 0.001 * slope * slope
                size = np.sqrt(square[i] / (1 - 0.999**step)) + 1e-8
                weights[i] = weights[i] - (rate / (1 - 0.9**step) * mean[i] / size).astype(np.float32)
    return Router(weights, parts)


def fit_router(spark, sample: Matrix, vectors: int, nearest: int = NEAREST) -> Router:
    """The router of an index over ``vectors`` vectors, learned from the rows of ``sample``."""
    unit = unit_rows(sample)
    held = np.arange(len(unit)) % HELD_OUT == HELD_OUT - 1
    nodes, queries = unit[~held], unit[held]
    wanted = max(2, 2 ** round(np.log2(max(2, vectors / PART_VECTORS))))
    parts = max(1, min(wanted, 2 ** int(np.log2(max(1, len(nodes) / LEAST_NODES)))))
    links = min(LINKS, len(nodes) - 1)
    if parts == 1 or len(queries) == 0:
        shapes = [(unit.shape[1], 1), (1,), (1, 1), (1,)]
        return Router([np.zeros(s, np.float32) for s in shapes], 1)
    graph = neighbour_graph(spark, nodes, links)
    part = balanced_parts(graph, parts)
    # A node's target is its own part and those of its neighbours.
    around = np.concatenate([np.repeat(part[:, None], links, 1), part[graph]], axis=1)
    flat = (np.arange(len(nodes))[:, None] * parts + around).ravel()
    targets = np.bincount(flat, minlength=len(nodes) * parts).reshape(len(nodes), parts) / around.shape[1]
    router = train_router(nodes, targets.astype(np.float32))
    # Held-out vectors: in how many parts must one look for the true neighbours?
    home = router.part(nodes)[nearest_rows(queries, nodes, min(nearest, len(nodes)))]
    rank = np.argsort(router.order(queries), axis=1)
    needed = np.take_along_axis(rank, home, 1).ravel() + 1
    reached = np.cumsum(np.bincount(needed, minlength=parts + 1)) / len(needed)
    router.tries = int(np.argmax(reached >= RECALL))
    return router


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, vector`` of the rows that take part, in 64 bits."""
    rows = df.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector")
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    return rows.filter(F.col("vector").isNotNull() & finite & F.exists("vector", lambda x: x != 0))


def _exact(q: Matrix, vectors: Matrix) -> Matrix:
    """Cosines in double precision; a row's result does not depend on the other rows."""
    return (vectors * q).sum(1) / np.sqrt((q * q).sum() * (vectors * vectors).sum(1))


def _scaled(vectors: Matrix) -> Matrix:
    """Rows divided by a power of two, which changes no digit and keeps squares in range."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(1))[1][:, None])


def best_rows(query: int, q: Matrix, approximate: Matrix, numbers: Matrix, ids: list, vectors: Matrix, k: int) -> list:
    """The ``k`` nearest rows to one query; each vector stands for rows with ``ids``."""
    short = np.flatnonzero(approximate >= np.partition(approximate, -min(k, len(approximate)))[-min(k, len(approximate))] - 1e-9)
    scores = _exact(q, vectors[short])
    rows = [
        (-score, vec_id is None, vec_id or 0, int(numbers[at]) == query)
        for score, at in zip(scores.tolist(), short.tolist())
        for vec_id in ids[at]
    ]
    return sorted(rows)[:k]


def _compare(k: int) -> Callable:
    """Queries and candidates of one block of a part: the nearest rows to each query."""

    def compare(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if queries.num_rows and candidates.num_rows:
            width = len(queries["vector"][0])
            table = lambda t: t["vector"].combine_chunks().flatten().to_numpy().reshape(-1, width)
            q, c = _scaled(table(queries)), _scaled(table(candidates))
            near = (q / np.linalg.norm(q, axis=1, keepdims=True)) @ (c / np.linalg.norm(c, axis=1, keepdims=True)).T
            ids, numbers = candidates["ids"].to_pylist(), candidates["number"].to_numpy()
            for i, number in enumerate(queries["number"].to_pylist()):
                for score, missing, vec_id, own in best_rows(number, q[i], near[i], numbers, ids, c, k):
                    found.append((number, -score, None if missing else vec_id, own))
        columns = list(zip(*found)) if found else [()] * 4
        kinds = [pa.int64(), pa.float64(), pa.int64(), pa.bool_()]
        return pa.table([pa.array(c, kind) for c, kind in zip(columns, kinds)], ["number", "score", "vec_id", "own"])

    return compare


def _batch_vectors(batch: pa.RecordBatch) -> Matrix:
    column = batch.column(batch.schema.get_field_index("vector"))
    return unit_rows(column.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1))


def _with_part(distinct: DataFrame, router: Router) -> DataFrame:
    def make() -> Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]:
        def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            part = router.part(_batch_vectors(batch)) if batch.num_rows else []
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(part, pa.int32())], [*batch.schema.names, "part"]
            )

        return each

    return map_batches(distinct, make, "number long, vector array<double>, ids array<long>, rows long, part int")


def _routed(queries: DataFrame, router: Router, rows: dict[int, int], k: int) -> DataFrame:
    """A row for each part that a query tries: the most probable ones, and as many as hold
    ``k`` rows at least."""
    held = np.array([rows.get(p, 0) for p in range(router.parts)])

    def make() -> Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]:
        def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            if batch.num_rows == 0:
                return
            order = router.order(_batch_vectors(batch))
            enough = (np.cumsum(held[order], axis=1) < k).sum(1) + 1
            tries = np.minimum(np.maximum(router.tries, enough), router.parts)
            at = np.repeat(np.arange(batch.num_rows), tries)
            parts = np.concatenate([o[:t] for o, t in zip(order, tries)])
            yield pa.RecordBatch.from_arrays(
                [*(c.take(pa.array(at)) for c in batch.columns), pa.array(parts, pa.int32())], ["number", "vector", "part"]
            )

        return each

    return map_batches(queries.select("number", "vector"), make, "number long, vector array<double>, part int")


def _in_blocks(blocks: dict[int, int]) -> Column:
    """For each part, at most ``SAMPLE / LEAST_NODES`` of them, its number of blocks."""
    return F.coalesce(F.element_at(F.create_map(*(F.lit(x) for e in blocks.items() for x in e)), F.col("part")), F.lit(1))


def nearest_neighbours(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    nearest: int = NEAREST,
    query_every: int = QUERY_EVERY,
    sample: int = SAMPLE,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row whose id is divisible by ``query_every``
    the ``nearest`` other rows by cosine that were found, ties by the smaller id.

    Vectors that are null, empty, zero or hold a null or non-finite component take no
    part, nor do those of another length than the most frequent one (of equally frequent ones
    the longest). Rows without id are candidates, after all others in a tie, and no
    queries. Rows repeated are rows like any other: a query leaves out itself, not its copies.
    With fewer candidates than wanted all are returned, with none the query has no row; an empty
    table gives no rows. Other columns are not read.

    Equal vectors are one entry of the index with the ids that can be among the nearest, so
    a vector with a third of all rows is one entry. Parts are dealt into blocks of bounded size,
    and so are the queries that try them. The index is fitted on ``sample`` vectors at most,
    drawn by hash, and holds every vector.
    """
    spark, keep = df.sparkSession, nearest + 1
    rows = usable(df, id_col, vector_col)
    nothing = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    lengths = rows.groupBy(F.size("vector").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    if lengths is None:
        return nothing
    rows = store(rows.filter(F.size("vector") == lengths["width"]), "vectors")

    smallest = Window.partitionBy("vector").orderBy(F.col("vec_id").asc_nulls_last())
    few = rows.withColumn("place", F.row_number().over(smallest)).filter(F.col("place") <= keep)
    distinct = few.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("known"), F.count("*").alias("rows"))
    unknown = F.array_repeat(F.lit(None).cast("long"), (F.col("rows") - F.size("known")).cast("int"))
    distinct = store(
        distinct.select(
            F.monotonically_increasing_id().alias("number"), "vector", F.concat("known", unknown).alias("ids"), "rows"
        ),
        "distinct_vectors",
    )
    total = distinct.count()
    drawn = F.xxhash64("vector", F.lit(13))
    some = distinct.filter(F.pmod(drawn, F.lit(1 << 30)) < int(min(1.0, 1.5 * sample / total) * (1 << 30)))
    fitted = some.orderBy(drawn, "number").limit(sample).select("vector").toArrow()["vector"].combine_chunks()
    router = fit_router(spark, fitted.flatten().to_numpy().reshape(len(fitted), -1), total, nearest)

    index = store(_with_part(distinct, router), "index")
    sizes = index.groupBy("part").agg(F.count("*").alias("vectors"), F.sum("rows").alias("rows")).collect()
    asked = rows.filter(F.col("vec_id") % query_every == 0)
    # Equal queries are searched once.
    asked = store(asked.join(distinct.select("vector", "number"), "vector").select("vec_id", "number"), "queries")
    queries = distinct.join(asked.select("number").distinct(), "number", "left_semi")
    routed = store(_routed(queries, router, {r["part"]: r["rows"] for r in sizes}, keep), "routed")
    tried = routed.groupBy("part").count().collect()
    if not tried:
        return nothing

    candidate_blocks = _in_blocks({r["part"]: -(-r["vectors"] // BLOCK_CANDIDATES) for r in sizes})
    query_blocks = _in_blocks({r["part"]: -(-r["count"] // BLOCK_QUERIES) for r in tried})
    mine = F.pmod(F.xxhash64("number"), F.col("blocks")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("others") - 1))
    counted = {"candidates": candidate_blocks, "questions": query_blocks}
    left = routed.select("*", counted["questions"].alias("blocks"), counted["candidates"].alias("others")).select(
        "part", mine.alias("question"), every.alias("candidate"), "number", "vector"
    )
    right = index.select("*", counted["candidates"].alias("blocks"), counted["questions"].alias("others")).select(
        "part", mine.alias("candidate"), every.alias("question"), "number", "vector", "ids"
    )
    block = ["part", "question", "candidate"]
    compared = left.groupBy(*block).cogroup(right.groupBy(*block)).applyInArrow(
        _compare(keep), "number long, score double, vec_id long, own boolean"
    )
    best = Window.partitionBy("number").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    ranked = compared.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= keep)
    lists = ranked.groupBy("number").agg(
        F.sort_array(F.collect_list(F.struct("place", "vec_id", "score", "own"))).alias("found")
    )
    itself = F.array_position(
        F.transform("found", lambda x: x["own"] & same(x["vec_id"], F.col("query_id"))), F.lit(True)
    )
    others = F.filter("found", lambda x: x["place"] != F.col("itself"))
    return (
        asked.withColumnRenamed("vec_id", "query_id").join(lists, "number")
        .withColumn("itself", itself)
        .select("query_id", F.posexplode(F.slice(others, 1, nearest)).alias("place", "row"))
        .select("query_id", (F.col("place") + 1).alias("rank"), "row.vec_id", "row.score")
    )
