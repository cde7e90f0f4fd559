"""Approximate nearest neighbours by learned partitions.

On a bounded sample a graph of nearest neighbours is cut into balanced parts, and a small
classifier learns to which parts a vector's neighbours belong. Every row is filed under its
most probable part. A query goes to as many of its most probable parts as it took, on
sample rows kept out of the training, to find ``TARGET`` of the true neighbours; what is
filed there is compared exactly.

Parts are dealt out in chunks of bounded size on both sides, by the place of a row and not by
what it holds, so neither a large part nor a row that a third of all rows repeat meets in one
task. Copies of a query are asked once.

Defined results: vectors that are null, zero, of another size than most, or hold null or
non-finite components take no part; equal distances go to smaller ids; rows that repeat an
id count by their nearest vector, once; a query finds every row if there are no more than
``K`` others; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlake.session import scratch_path, staged

K = 10
#: Rows the graph and the classifier are made from, at most: those of smallest id hash.
SAMPLE = 8192
#: Rows of a part that are aimed at, and most parts: as many as the sample can tell apart, with
#: 16 of its rows each. Beyond MOST_PARTS * PART_ROWS rows parts grow and take more chunks.
PART_ROWS, MOST_PARTS = 1000, 512
#: Rows and queries that one task compares at a time.
CHUNK_ROWS, CHUNK_QUERIES = 8192, 2048
TARGET = 0.97
HIDDEN = 64
EPOCHS = 25


def usable(column: str) -> Column:
    """Whether a vector takes part."""
    real = F.coalesce(
        F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x) < float("inf"))), F.lit(False)
    )
    return real & F.exists(column, lambda x: x != 0)


def nearest(vectors: np.ndarray, others: np.ndarray, k: int) -> np.ndarray:
    """Indexes of the ``k`` nearest others of each vector."""
    out = []
    for part in np.array_split(vectors, max(1, len(vectors) * len(others) // 1_000_000)):
        d = (part**2).sum(1)[:, None] - 2 * part @ others.T + (others**2).sum(1)
        out.append(np.argpartition(d, min(k, len(others) - 1), axis=1)[:, :k].copy())
    return np.concatenate(out)


def balanced_parts(vectors: np.ndarray, graph: np.ndarray, parts: int, sweeps: int = 8) -> np.ndarray:
    """A part for each row: halves along the longest axis, then moves towards the neighbours.

    A row moves where most of its neighbours are while that part has room.
    """
    label = np.zeros(len(vectors), np.int64)

    def halve(rows: np.ndarray, first: int, n: int) -> None:
        label[rows] = first
        if n == 1 or len(rows) < 2:
            return
        centred = vectors[rows] - vectors[rows].mean(0)
        axis = np.linalg.svd(centred[:2000], full_matrices=False)[2][0]
        order = rows[np.argsort(centred @ axis, kind="stable")]
        cut = len(order) * (n // 2) // n
        halve(order[:cut], first, n // 2)
        halve(order[cut:], first + n // 2, n - n // 2)

    halve(np.arange(len(vectors)), 0, parts)
    room = math.ceil(1.1 * len(vectors) / parts)
    source = np.repeat(np.arange(len(graph)), graph.shape[1])
    both = np.concatenate([source, graph.ravel()]), np.concatenate([graph.ravel(), source])
    for _ in range(sweeps):
        near = np.bincount(both[0] * parts + label[both[1]], minlength=len(label) * parts).reshape(-1, parts)
        wanted = near.argmax(1)
        gain = near[np.arange(len(label)), wanted] - near[np.arange(len(label)), label]
        size = np.bincount(label, minlength=parts)
        for row in np.argsort(-gain, kind="stable"):
            if gain[row] <= 0:
                break
            if size[wanted[row]] < room:
                size[label[row]] -= 1
                size[wanted[row]] += 1
                label[row] = wanted[row]
    return label


class Router:
    """A network of one hidden layer: vector to probabilities of parts."""

    def __init__(self, size: int, parts: int, random: np.random.Generator):
        self.weights = [
            random.normal(0, 1 / math.sqrt(size), (size, HIDDEN)), np.zeros(HIDDEN),
            random.normal(0, 1 / math.sqrt(HIDDEN), (HIDDEN, parts)), np.zeros(parts),
            random.normal(0, 0.1, (size, parts)),
        ]

    def logits(self, x: np.ndarray) -> np.ndarray:
        a, b, c, d, e = self.weights
        return np.maximum(x @ a + b, 0) @ c + d + x @ e

    def learn(self, x: np.ndarray, target: np.ndarray, random: np.random.Generator) -> None:
        moments = [(np.zeros_like(w), np.zeros_like(w)) for w in self.weights]
        step = 0
        for epoch in range(EPOCHS):
            for rows in np.array_split(random.permutation(len(x)), max(1, len(x) // 128)):
                a, b, c, _, _ = self.weights
                hidden = np.maximum(x[rows] @ a + b, 0)
                logits = self.logits(x[rows])
                p = np.exp(logits - logits.max(1, keepdims=True))
                error = (p / p.sum(1, keepdims=True) - target[rows]) / len(rows)
                back = (error @ c.T) * (hidden > 0)
                step += 1
                grads = (x[rows].T @ back, back.sum(0), hidden.T @ error, error.sum(0), x[rows].T @ error)
                for w, (m, v), g in zip(self.weights, moments, grads, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    w -= 0.005 * (1 - epoch / EPOCHS) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)


def fit(sample: np.ndarray, parts: int, seed: int = 3) -> tuple[Router, np.ndarray, np.ndarray, int]:
    """The router, its centre and scale, and how many parts a query is sent to."""
    random = np.random.default_rng(seed)
    centre, scale = sample.mean(0), np.maximum(sample.std(), 1e-12)
    x = (sample - centre) / scale
    tests = np.arange(0, len(x), max(2, len(x) // 512))
    learned = np.setdiff1d(np.arange(len(x)), tests)
    graph = nearest(x[learned], x[learned], K + 1)
    label = balanced_parts(x[learned], graph, parts)
    target = np.zeros((len(learned), parts))
    np.add.at(target, (np.repeat(np.arange(len(graph)), graph.shape[1]), label[graph.ravel()]), 1 / graph.shape[1])
    router = Router(x.shape[1], parts, random)
    router.learn(x[learned], target, random)
    filed = router.logits(x[learned]).argmax(1)
    true = nearest(x[tests], x[learned], min(K, len(learned)))
    order = np.argsort(-router.logits(x[tests]), axis=1, kind="stable")
    rank = np.argsort(order, axis=1)
    found = rank[np.arange(len(tests))[:, None], filed[true]]
    for n in range(1, parts + 1):
        if (found < n).mean() >= TARGET:
            break
    return router, centre, scale, min(parts, n + 1)


def _exact(rows: pd.DataFrame, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    """The ``k`` nearest of a chunk's ids for each of its queries, in double precision."""
    rows = rows.sort_values("vec_id", kind="stable")
    base = np.stack(rows["vector"].to_numpy()).astype(np.float64)
    ids = rows["vec_id"].to_numpy()
    first = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
    squares = (base**2).sum(1)
    out = []
    for query_id, vector in zip(queries["query_id"], queries["vector"], strict=True):
        q = np.asarray(vector, np.float64)
        rough = squares - 2 * (base @ q)
        rough[ids == query_id] = np.inf
        # An id counts by its nearest row, so that copies of a row crowd out no other id.
        each = np.minimum.reduceat(rough, first)
        if not np.isfinite(each).any():
            continue
        # The exact distance is taken of all that rounding could bring among the nearest.
        last = min(4 * k, len(each)) - 1
        limit = np.partition(each, last)[last]
        near = np.flatnonzero((rough <= limit + 1e-9 * (np.abs(limit) + q @ q + 1)) & (ids != query_id))
        exact = np.sqrt(((base[near] - q) ** 2).sum(1))
        order = np.lexsort((exact, ids[near]))
        order = order[np.append(True, ids[near[order[1:]]] != ids[near[order[:-1]]])]
        kept = order[np.lexsort((ids[near[order]], exact[order]))[:k]]
        out.append(pd.DataFrame({"query_id": query_id, "vec_id": ids[near[kept]], "score": exact[kept]}))
    if not out:
        return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})
    return pd.concat(out)


def search(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """``query_id, rank, vec_id, score`` from ``vec_id, embedding`` and ``query_id, embedding``."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vector"))
    rows = rows.where(usable("vector") & F.col("vec_id").isNotNull())
    common = rows.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "size").first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if common is None:
        return empty
    rows = rows.where(F.size("vector") == common["size"])
    asked = queries.select(F.col("query_id").cast("long").alias("query_id"), F.col("embedding").alias("vector"))
    asked = asked.where(usable("vector") & F.col("query_id").isNotNull() & (F.size("vector") == common["size"])).distinct()
    parts = int(min(MOST_PARTS, max(1, common["n"] // PART_ROWS)))
    # Ids are drawn, not rows, so that copies of a row take one place in the sample.
    ids = rows.select("vec_id").distinct().orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE)
    drawn = rows.join(F.broadcast(ids), "vec_id").groupBy("vec_id").agg(F.min("vector").alias("vector"))
    drawn = drawn.orderBy("vec_id").select("vector").toArrow()
    flat = drawn.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    sample = flat.astype(np.float64).reshape(drawn.num_rows, -1)
    if parts > 1 and len(sample) > 4 * K:
        router, centre, scale, probes = fit(sample, parts)
    else:
        router, centre, scale, probes, parts = None, 0.0, 1.0, 1, 1
    model = spark.sparkContext.broadcast((router, centre, scale))

    def routed(n: int, key: str):
        def run(batches):
            router, centre, scale = model.value
            for batch in batches:
                column = batch.column(batch.schema.get_field_index("vector"))
                data = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
                if router is None or n >= parts > 1 and n > 1:
                    best = np.tile(np.arange(n), (len(data), 1))
                else:
                    logits = router.logits((data - centre) / scale)
                    best = np.argsort(-logits, axis=1, kind="stable")[:, :n]
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(data) + 1, dtype=np.int32) * best.shape[1]), pa.array(best.ravel().astype(np.int32))
                )
                yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(key)), column, lists], [key, "vector", "parts"])

        return run

    kind = vectors.schema["embedding"].dataType.simpleString()
    filed = rows.mapInArrow(routed(1, "vec_id"), f"vec_id long, vector {kind}, parts array<int>")
    # The place of a row is written with it: copies of a row go to different chunks, and a
    # repeated task finds them in the same ones.
    filed = filed.select("vec_id", "vector", F.col("parts")[0].alias("part"), F.monotonically_increasing_id().alias("place"))
    filed = staged(filed, scratch_path(spark, "parts"))
    sizes = filed.groupBy("part").agg(F.count("*").alias("n"))
    sizes = sizes.select("part", F.ceil(F.col("n") / CHUNK_ROWS).cast("int").alias("chunks"))

    def answered(some: DataFrame, n: int) -> DataFrame:
        sent = some.mapInArrow(routed(n, "query_id"), f"query_id long, vector {kind}, parts array<int>")
        sent = sent.select("query_id", "vector", F.explode("parts").alias("part"))
        groups = sent.groupBy("part").agg(F.ceil(F.count("*") / CHUNK_QUERIES).cast("int").alias("lots"))
        # One row per part, of which there are at most MOST_PARTS.
        plan = F.broadcast(sizes.join(groups, "part"))
        left = filed.join(plan, "part").select(
            "part", F.pmod(F.xxhash64("place"), "chunks").cast("int").alias("chunk"),
            F.explode(F.sequence(F.lit(0), F.col("lots") - 1)).alias("lot"), "vec_id", "vector",
        )
        right = sent.join(plan, "part").select(
            "part", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"),
            F.pmod(F.xxhash64("query_id", "vector"), "lots").cast("int").alias("lot"), "query_id", "vector",
        )
        keys = ["part", "chunk", "lot"]

        def compare(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
            if not len(a) or not len(b):
                return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
            return _exact(a, b, k)

        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
            compare, "query_id long, vec_id long, score double"
        )

    first = staged(answered(asked, min(probes, parts)), scratch_path(spark, "found"))
    if probes < parts:
        # Whoever found fewer than it could asks all parts.
        others = min(k, int(rows.select("vec_id").distinct().count()) - 1)
        enough = first.groupBy("query_id").agg(F.count_distinct("vec_id").alias("n")).where(F.col("n") >= others)
        short = asked.join(enough.select("query_id"), "query_id", "left_anti")
        first = first.unionByName(answered(short, parts))
    best = first.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def self_search(embeddings: DataFrame, every: int = 100) -> DataFrame:
    """The rows whose id is divisible by ``every``, each against all other rows."""
    queries = embeddings.where(F.col("vec_id") % every == 0)
    return search(embeddings, queries.select(F.col("vec_id").alias("query_id"), "embedding"))
