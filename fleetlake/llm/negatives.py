"""Hard negatives by inner product, from lists that clusters of anchors share.

Anchors are clustered by direction. For every cluster all rows are put once into a list, in
the order of an upper bound of their product with any member: with the angle t between row
and centre, and r the widest angle of a member, a member of length 1 cannot do better than
``|row| * cos(max(0, t - r))``. Each member walks its cluster's list from the top, keeps the best
rows it has met, and stops once the bound of the next row, times the member's length, is
below the last of them: nothing further down can count, so the result is exact.

The lists are cut into waves whose sizes grow by a factor, so that each wave is walked by
the members that the waves before it could not certify, with the thresholds found there. A wave
is dealt out in chunks of rows and lots of members, both of bounded size whatever the data; in
a chunk the walk goes by the bound again. What a chunk returns is at most what is asked for
per member.

The same walk serves twice: for the positives, the best rows of an anchor's own label, and
then for the rows of other labels in a window of scores that each positive gives.

Defined results: rows with a null id or label, a null vector, or null or non-finite
components take no part, nor do vectors of another size than most (the smaller size of a
tie); components beyond 2**25 after scaling count as that. Equal rows count once; rows
that share an id are told apart by label and vector, and an anchor's own id is never found
for it. Equal scores go to smaller ids. Zero vectors take part, with products of 0. An
anchor without positives, and a positive without rows in its window, give no rows, as does
an empty table.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlake.llm.common import Scratch
from fleetlake.llm.vectors import common_size, lists, matrix, whole_numbers
from fleetlake.session import scratch_path

SCALE, LIMIT = 256.0, 1 << 25
#: Clusters of anchors, each with a list of its own of all rows.
CLUSTERS = 8
#: Anchors that the centres are found from, at most: those of smallest hash. All are assigned.
SAMPLE = 4096
#: Rows of a list's first wave, and by how much the walked part grows with each wave.
HEAD, GROWTH = 4096, 4
#: Rows and members that one task compares at a time, and rows of a step of the walk.
CHUNK_ROWS, CHUNK_MEMBERS, STEP = 4096, 512, 256
POSITIVES, NEGATIVES = 5, 10
#: Room for rounding in angles and bounds.
SLACK = 1e-6

RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def units(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of length 1, zero ones as they are, and the lengths."""
    v = v.astype(np.float64)
    length = np.sqrt((v**2).sum(1))
    return v / np.where(length > 0, length, 1)[:, None], length


def centres(sample: np.ndarray, n: int, rounds: int = 12) -> np.ndarray:
    """Up to ``n`` directions that the sample gathers around."""
    unit, length = units(sample)
    unit = unit[length > 0]
    if not len(unit):
        return np.zeros((1, sample.shape[1]))
    chosen = unit[:1]
    while len(chosen) < min(n, len(unit)):
        nearest = (unit @ chosen.T).max(1)
        chosen = np.concatenate([chosen, unit[nearest.argmin()][None]])
    for _ in range(rounds):
        own = (unit @ chosen.T).argmax(1)
        total = np.zeros_like(chosen)
        np.add.at(total, own, unit)
        moved, size = units(total)
        chosen = np.where(size[:, None] > 0, moved, chosen)
    return chosen


def angles(v: np.ndarray, centre: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Angles of vectors to centres, 0 for zero vectors, and the vectors' lengths."""
    unit, length = units(v)
    angle = np.arccos(np.clip(unit @ centre.T, -1, 1))
    angle[length == 0] = 0
    return angle, length


def upper_bounds(v: np.ndarray, centre: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """Per vector and cluster, what no product with a member of length 1 exceeds."""
    angle, length = angles(v, centre)
    return length[:, None] * (np.cos(np.maximum(angle - radius - SLACK, 0)) + 1e-9)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers."""
    top = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    if top < 1 << 53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


@dataclass(frozen=True)
class Asked:
    """What a member looks for: rows of its own or of other labels, this many."""

    same_label: bool
    need: int


FOUND = pa.schema([("anchor_id", pa.int64()), ("k", pa.int64()), ("low", pa.int64()), ("high", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def walk(rows: pa.Table, members: pa.Table, size: int, asked: Asked) -> pa.Table:
    """The best rows of a chunk for every member row, each with a window ``low`` to ``high``.

    ``floor`` is the smallest score that still counts; it rises as rows are found. Members
    leave the walk once the next bound stays below it.
    """
    if not rows.num_rows or not members.num_rows:
        return FOUND.empty_table()
    column = lambda t, name: t.column(name).to_numpy()
    order = np.argsort(-column(rows, "bound"), kind="stable")
    bound, ids, label = (column(rows, name)[order] for name in ("bound", "vec_id", "label"))
    v = matrix(rows.column("v"), size)[order].astype(np.int64)
    anchor, own, low, high = (column(members, name) for name in ("anchor_id", "own", "low", "high"))
    floor = column(members, "floor").copy()
    # Members of one anchor share its products.
    _, first, of = np.unique(np.stack([anchor, column(members, "k")]), axis=1, return_index=True, return_inverse=True)
    vectors = matrix(members.column("v"), size)[first].astype(np.int64)
    length = units(vectors)[1]
    of = of.ravel()
    best = np.zeros((3, 0), np.int64)
    for start in range(0, len(ids), STEP):
        reach = bound[start] * length[of]
        walking = np.flatnonzero(reach + 1e-9 * np.abs(reach) + 1e-6 >= floor)
        if not len(walking):
            break
        step = slice(start, start + STEP)
        seen, place = np.unique(of[walking], return_inverse=True)
        score = products(vectors[seen], v[step])[place]
        fits = (score >= floor[walking, None]) & (score <= high[walking, None])
        fits &= (label[step] == own[walking, None]) == asked.same_label
        fits &= ids[step] != anchor[walking, None]
        member, row = np.nonzero(fits)
        best = np.concatenate([best, np.stack([walking[member], score[member, row], ids[step][row]])], axis=1)
        best = best[:, np.lexsort((best[2], -best[1], best[0]))]
        rank = np.arange(best.shape[1]) - np.searchsorted(best[0], best[0])
        full = rank == asked.need - 1
        floor[best[0][full]] = best[1][full]
        best = best[:, rank < asked.need]
    member = best[0]
    return pa.table([anchor[member], column(members, "k")[member], low[member], high[member], best[2], best[1]], schema=FOUND)


class Lists:
    """The lists of all clusters, cut into waves, in a table partitioned by wave."""

    def __init__(self, scratch: Scratch, rows: DataFrame, size: int, centre: np.ndarray, radius: dict[int, float]):
        self.scratch, self.size = scratch, size
        self.spark = rows.sparkSession
        clusters = np.array(sorted(radius))
        shared = self.spark.sparkContext.broadcast((clusters, centre[clusters], np.array([radius[c] for c in clusters])))

        def bounds(batches):
            names, middle, wide = shared.value
            for batch in batches:
                found = upper_bounds(matrix(batch.column(2), size), middle, wide)
                yield pa.RecordBatch.from_arrays([*batch.columns, lists(found, pa.float64())], ["vec_id", "label", "v", "bounds"])

        each = rows.select("vec_id", "label", "v").mapInArrow(bounds, "vec_id long, label long, v array<int>, bounds array<double>")
        each = each.select("vec_id", "label", "v", F.posexplode("bounds").alias("at", "bound"))
        names = F.array(*(F.lit(int(c)) for c in clusters))
        each = each.select(F.get(names, F.col("at")).alias("cluster"), "bound", "vec_id", "label", "v")
        total, cuts = rows.count(), []
        while HEAD * GROWTH ** len(cuts) < total:
            cuts.append(1 - HEAD * GROWTH ** len(cuts) / total)
        self.edges: dict[int, list[float]] = {int(c): [] for c in clusters}
        if cuts:
            # The cuts only say where waves end; what lies in them is told by comparing.
            found = each.groupBy("cluster").agg(F.percentile_approx("bound", cuts, 10000).alias("edges"))
            self.edges = {r.cluster: list(r.edges) for r in found.collect()}
        wave = F.lit(0)
        for w in range(len(cuts)):
            edge = self._by_cluster({c: e[w] for c, e in self.edges.items()})
            wave = wave + (F.col("bound") < edge).cast("int")
        self.path = scratch_path(self.spark, "lists")
        each.withColumn("wave", wave).write.partitionBy("wave").parquet(self.path)
        self.table = self.spark.read.schema("cluster int, bound double, vec_id long, label long, v array<int>, wave int").parquet(self.path)
        counted = self.table.groupBy("wave", "cluster").agg(F.count("*").alias("n")).collect()
        self.rows = {(r.wave, r.cluster): r.n for r in counted}
        self.waves = len(cuts) + 1

    @staticmethod
    def _by_cluster(values: dict[int, float]) -> Column:
        """A value for each cluster, of which there are at most ``CLUSTERS``."""
        pairs = [F.lit(x) for c, value in values.items() for x in (c, value)]
        return F.create_map(*pairs)[F.col("cluster")]

    def _wave(self, wave: int, members: DataFrame, asked: Asked) -> DataFrame:
        """What the members find in one wave."""
        waiting = {r.cluster: r.n for r in members.groupBy("cluster").agg(F.count("*").alias("n")).collect()}
        here = {c: (n, self.rows[wave, c]) for c, n in waiting.items() if (wave, c) in self.rows}
        empty = self.spark.createDataFrame([], "anchor_id long, k long, low long, high long, vec_id long, score long")
        if not here:
            return empty
        lots = self._by_cluster({c: math.ceil(n / CHUNK_MEMBERS) for c, (n, _) in here.items()})
        chunks = self._by_cluster({c: math.ceil(n / CHUNK_ROWS) for c, (_, n) in here.items()})
        walked = F.col("cluster").isin(list(here))
        keys = ["cluster", "chunk", "lot"]
        every = lambda n: F.explode(F.sequence(F.lit(0), n.cast("int") - 1))
        rows = self.table.where((F.col("wave") == wave) & walked).select(
            "cluster", F.pmod(F.xxhash64("vec_id", "label", "v"), chunks).cast("int").alias("chunk"), every(lots).alias("lot"),
            "bound", "vec_id", "label", "v",
        )
        asking = members.where(walked).select(
            "cluster", every(chunks).alias("chunk"), F.pmod(F.xxhash64("anchor_id", "k"), lots).cast("int").alias("lot"),
            "anchor_id", "k", "own", "v", "low", "high", "floor",
        )
        size = self.size
        return rows.groupBy(*keys).cogroup(asking.groupBy(*keys)).applyInArrow(
            lambda a, b: walk(a, b, size, asked), empty.schema
        )

    def best(self, members: DataFrame, asked: Asked) -> DataFrame:
        """The best rows of every member: ``anchor_id, k, low, high, rank, vec_id, score``."""
        member = ["anchor_id", "k", "low", "high"]
        order = Window.partitionBy(*member).orderBy(F.desc("score"), "vec_id")
        found, walking = None, members.withColumn("floor", F.col("low"))
        for wave in range(self.waves):
            new = self._wave(wave, walking, asked)
            both = new if found is None else new.unionByName(found.drop("rank"))
            kept = both.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= asked.need)
            kept = self.scratch.keep(kept, "found")
            if found is not None:
                self.scratch.drop(found)
            found = kept
            if wave + 1 == self.waves:
                break
            # All that follows in a list is below the edge of this wave.
            last = found.where(F.col("rank") == asked.need).select(*member, F.col("score").alias("last"))
            edge = self._by_cluster({c: e[wave] for c, e in self.edges.items()})
            reach = edge * F.col("length")
            rest = members.join(last, member, "left").withColumn("floor", F.coalesce("last", "low")).drop("last")
            rest = self.scratch.keep(rest.where(F.col("floor") <= reach + F.abs(reach) * 1e-9 + 1e-6), "walking")
            if wave:
                self.scratch.drop(walking)
            walking = rest
            if walking.isEmpty():
                break
        return found


def clustered(anchors: DataFrame, size: int) -> tuple[DataFrame, np.ndarray]:
    """Anchors with their cluster, their angle to its centre and their length; the centres."""
    drawn = anchors.orderBy(F.xxhash64("anchor_id", "k"), "anchor_id", "k").limit(SAMPLE).select("v").toArrow()
    centre = centres(matrix(drawn.column("v"), size), CLUSTERS)
    shared = anchors.sparkSession.sparkContext.broadcast(centre)
    schema = "anchor_id long, k long, own long, v array<int>, cluster int, angle double, length double"

    def run(batches):
        for batch in batches:
            angle, length = angles(matrix(batch.column(3), size), shared.value)
            cluster = angle.argmin(1) if len(angle) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cluster, pa.int32()), pa.array(angle[np.arange(len(angle)), cluster]), pa.array(length)],
                ["anchor_id", "k", "own", "v", "cluster", "angle", "length"],
            )

    return anchors.mapInArrow(run, schema), centre


def mine(embeddings: DataFrame, anchor: Column) -> DataFrame:
    """Hard negatives of each anchor and positive, by ``vec_id, label, embedding``.

    Labels are whole numbers. A positive's window goes from 30 to 90 percent of its score.
    """
    spark = embeddings.sparkSession
    scratch = Scratch(spark)
    named = embeddings.select(F.col("vec_id").cast("long"), F.col("label").cast("long").alias("label"), "embedding")
    rows = whole_numbers(named.dropna(subset=["vec_id", "label"]), SCALE, LIMIT).distinct()
    rows = scratch.keep(rows, "whole")
    size = common_size(rows)
    nothing = spark.createDataFrame([], RESULT)
    if size is None:
        return nothing
    rows = rows.where(F.size("v") == size)
    anchors = rows.where(anchor).select(F.col("vec_id").alias("anchor_id"), F.xxhash64("label", "v").alias("k"), F.col("label").alias("own"), "v")
    if anchors.isEmpty():
        return nothing
    anchors, centre = clustered(anchors, size)
    anchors = scratch.keep(anchors, "anchors")
    radius = {r.cluster: r.angle for r in anchors.groupBy("cluster").agg(F.max("angle").alias("angle")).collect()}
    shared = Lists(scratch, rows, size, centre, radius)

    widest = 2**62
    whole = anchors.withColumns({"low": F.lit(-widest), "high": F.lit(widest)})
    positives = shared.best(whole, Asked(True, POSITIVES)).select("anchor_id", "k", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    # Scores below 0 have empty windows: 30 percent of them lie above 90 percent.
    positives = positives.where("positive_score >= 0").withColumns(
        {"low": F.expr("(30 * positive_score + 99) div 100"), "high": F.expr("90 * positive_score div 100")}
    )
    windows = positives.where("low <= high").select("anchor_id", "k", "low", "high").distinct()
    windows = scratch.keep(anchors.join(windows, ["anchor_id", "k"]), "windows")
    if windows.isEmpty():
        return nothing
    negatives = shared.best(windows, Asked(False, NEGATIVES)).withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"})
    joined = positives.join(negatives, ["anchor_id", "k", "low", "high"])
    return joined.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def hard_negatives(embeddings: DataFrame, every: int = 100) -> DataFrame:
    """Mines with the anchors whose id is divisible by ``every``; ids divisible by 7 take the
    next of ten labels first."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(embeddings.withColumn("label", moved), F.col("vec_id") % every == 0)
