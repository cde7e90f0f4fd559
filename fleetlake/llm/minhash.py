"""Near-duplicates by ProbMinHash signatures, banding and exact verification.

Similarity is the probability Jaccard index of the texts' weighted shingles of five words
(weight: how often a shingle occurs), the quantity whose registers ProbMinHash estimates.
Each shingle is a Poisson process of arrivals whose rate is its weight; an arrival falls to
one of the registers and stays if it is the earliest there. A shingle whose next arrival
comes after all registers' times is finished, which ends a document early.

Bands of registers give buckets. Copies with the same words are one node. In a bucket every
node is first compared with one member drawn at random for that bucket, so a bucket of any
size costs one comparison per member; bands come in waves, and from the second on, only nodes
that are not yet linked to the drawn member are compared. Comparisons are exact.

Then the buckets that still hold more than one class are open, and every near pair of their
nodes is found: the index is at most the common mass of the two distributions, so in any
order of all shingles the first common one has ``THRESHOLD`` of the mass from it on in both
texts. Pairs of different classes that share such a leading shingle are compared, unless the bits
that sum up their shingles differ in more places than near texts can; rare shingles lead, so
what many texts share by a template seldom does.

Defined results: null counts as empty; rows without a word are near-duplicates of each
other only; texts under five words have one shingle; repeated rows fall into one class; the
class is named by its smallest doc_id (null if it has none).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import chunks, free_names, lowered, mixed, powers, row_keys, shingle_hashes, slices, text_buffer, word_hashes
from fleetlake.llm.graph import components
from fleetlake.session import scratch_path, staged

BANDS, ROWS = 32, 6
REGISTERS = BANDS * ROWS
WAVES = 2
THRESHOLD = 0.8
#: Counters that order shingles by how common they are; they stay this many.
COUNTERS = 1 << 20
#: Texts with at most this share of their mass in repeated shingles are even.
EVEN = 0.01
#: Words of 64 parity bits that a text is summed up in.
PARITIES = 16


def weighted(hashes: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes of each row, how often they occur, and where each row's begin."""
    row = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
    order = np.lexsort((hashes, row))
    hashes, row = hashes[order], row[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(new)
    counts = np.diff(np.append(at, len(hashes)))
    return hashes[at], counts, np.searchsorted(row[at], np.arange(len(begin)))


def signatures(hashes: np.ndarray, weights: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Registers of each row: the shingle that arrived first; rows without shingles hold 0."""
    rows = len(begin) - 1
    time = np.full(rows * REGISTERS, np.inf)
    holder = np.zeros(rows * REGISTERS, np.uint64)
    row = np.repeat(np.arange(rows), np.diff(begin))
    element, drawn, clock = np.arange(len(hashes)), np.zeros(len(hashes), np.int64), np.zeros(len(hashes))
    while len(element):
        # As many arrivals at once as fill the registers a few times over, if all are new.
        active = np.bincount(row[element], minlength=rows)
        many = np.maximum(1, 2 * REGISTERS // np.maximum(active, 1))[row[element]]
        which = np.repeat(np.arange(len(element)), many)
        first = np.cumsum(many) - many
        counter = drawn[element][which] + np.arange(len(which)) - first[which]
        random = mixed(hashes[element][which] + (counter.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
        wait = -np.log1p(-(random >> np.uint64(11)).astype(np.float64) * 2.0**-53) / weights[element][which]
        total = np.cumsum(wait)
        arrival = clock[element][which] + total - (total - wait)[first][which]
        register = mixed(random) % np.uint64(REGISTERS)
        slot = row[element][which] * REGISTERS + register.astype(np.int64)
        early = arrival < time[slot]
        slot, arrival, which_early = slot[early], arrival[early], which[early]
        order = np.lexsort((arrival, slot))
        slot, arrival, which_early = slot[order], arrival[order], which_early[order]
        first_in = np.ones(len(slot), bool)
        first_in[1:] = slot[1:] != slot[:-1]
        time[slot[first_in]] = arrival[first_in]
        holder[slot[first_in]] = hashes[element[which_early[first_in]]]
        last = first + many - 1
        clock[element] += total[last] - (total - wait)[first]
        drawn[element] += many
        latest = time.reshape(rows, REGISTERS).max(axis=1)
        element = element[clock[element] < latest[row[element]]]
    return holder.reshape(rows, REGISTERS)


def band_hashes(registers: np.ndarray) -> np.ndarray:
    base = powers(ROWS + 1)[0][1 : ROWS + 1]
    sums = (registers.reshape(len(registers), BANDS, ROWS) * base).sum(axis=2, dtype=np.uint64)
    return mixed(sums + np.arange(BANDS, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def sketches(docs: DataFrame) -> DataFrame:
    """``doc_id, k1, k2, node, bands``: node is a digest of the text's words, in order."""
    keyed = docs.select("doc_id", *row_keys(), "text")

    def run(batches):
        for batch in batches:
            keys = [batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "k1", "k2")]
            for first, last, data, bounds in slices(lowered(batch.column(batch.schema.get_field_index("text")))):
                word, at = word_hashes(data, bounds)
                hashes, begin = shingle_hashes(word, at)
                bands = band_hashes(signatures(*weighted(hashes, begin))).astype(np.int64)
                empty = np.diff(begin) == 0
                # Two sums over the words in order; two texts of equal words agree in both.
                spread = np.arange(len(word)) - np.repeat(at[:-1], np.diff(at))
                base = powers(len(word) + 1)
                pair = []
                for factor in base:
                    sums = np.concatenate([[np.uint64(0)], np.cumsum(mixed(word ^ factor[1]) * factor[spread])])
                    pair.append(mixed(sums[at[1:]] - sums[at[:-1]] + np.diff(at).astype(np.uint64)))
                node = np.stack(pair, axis=1).tobytes()
                sizes = np.where(empty, 0, BANDS)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(k.slice(first, last - first) for k in keys),
                        pa.array([node[k : k + 16] for k in range(0, len(node), 16)], pa.binary()),
                        pa.ListArray.from_arrays(
                            pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)),
                            pa.array(bands[~empty].ravel()),
                        ),
                    ],
                    ["doc_id", "k1", "k2", "node", "bands"],
                )

    return keyed.mapInArrow(run, "doc_id long, k1 long, k2 long, node binary, bands array<long>")


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """The exact index of two weighted sets (sorted distinct hashes, weights)."""
    _, in_a, in_b = np.intersect1d(*(x[0] for x in (a, b)), assume_unique=True, return_indices=True)
    if not len(in_a):
        return 0.0
    x, y = a[1][in_a].astype(float), b[1][in_b].astype(float)
    order = np.argsort(-(x / y), kind="stable")
    x, y = x[order], y[order]
    # Elements of a ratio as large or larger count by x, the others by y.
    only_a, only_b = a[1].sum() - x.sum(), b[1].sum() - y.sum()
    upto = np.cumsum(x) + only_a
    after = y.sum() - np.cumsum(y) + only_b
    return float((1 / (upto / x + after / y)).sum())


def _similar(batches):
    for batch in batches:
        sides = []
        for name in ("text_u", "text_v"):
            parts = []
            for _, _, data, bounds in slices(lowered(batch.column(batch.schema.get_field_index(name)))):
                hashes, counts, begin = weighted(*shingle_hashes(*word_hashes(data, bounds)))
                parts += [(hashes[i:j], counts[i:j]) for i, j in zip(begin[:-1], begin[1:], strict=True)]
            sides.append(parts)
        near = [probability_jaccard(a, b) for a, b in zip(*sides, strict=True)]
        keep = pa.array([s >= THRESHOLD - 1e-9 for s in near])
        u, v = (batch.column(batch.schema.get_field_index(c)).filter(keep) for c in ("u", "v"))
        yield pa.RecordBatch.from_arrays([u, v, pa.array(near, pa.float64()).filter(keep)], ["u", "v", "similarity"])


def classes(docs: DataFrame) -> DataFrame:
    """``doc_id, k1, k2, node, class_node, class_id, keep`` for every row.

    ``keep`` marks one row of each class: of the smallest doc_id, then of the smallest key.
    It is true for all rows that equal the kept one, so callers drop repeated rows.
    """
    spark = docs.sparkSession
    rows = staged(sketches(docs), scratch_path(spark, "sketches"))
    # The smallest row of a node stands for it; partial sums make a hot node one row a task.
    nodes = rows.groupBy("node").agg(F.min(F.struct("k1", "k2")).alias("key"), F.first("bands").alias("bands"))
    band = nodes.select("node", F.posexplode("bands").alias("band", "bucket"))
    band = staged(band, scratch_path(spark, "bands"))
    linked = None
    links = spark.createDataFrame([], "u binary, v binary")
    texts = None
    for wave in range(WAVES):
        own = band.where((F.col("band") % WAVES) == wave).select("node", "bucket")
        drawn = own.groupBy("bucket").agg(
            F.min_by("node", F.xxhash64("node", "bucket")).alias("v"), F.count("*").alias("n")
        )
        pairs = own.join(drawn.where("n > 1").drop("n"), "bucket").where("node <> v")
        pairs = pairs.select(F.greatest("node", "v").alias("u"), F.least("node", "v").alias("v")).distinct()
        if linked is not None:
            named = [linked.select(F.col("node").alias(c), F.col("component").alias(f"c{c}")) for c in "uv"]
            pairs = pairs.join(named[0], "u", "left").join(named[1], "v", "left")
            pairs = pairs.where("not coalesce(cu = cv, false)").select("u", "v")
        pairs = staged(pairs, scratch_path(spark, "pairs"))
        if texts is None:
            texts = _texts(docs, rows, band)
        found = _verified(pairs, texts)
        links = staged(links.unionByName(found), scratch_path(spark, "verified"))
        linked = staged(components(links), scratch_path(spark, "classes"))
    pairs = open_pairs(band, linked, texts)
    if pairs is not None:
        found = _verified(pairs, texts)
        links = staged(links.unionByName(found), scratch_path(spark, "verified"))
        linked = staged(components(links), scratch_path(spark, "classes"))
    placed = rows.drop("bands").join(linked, "node", "left")
    placed = placed.withColumn("class_node", F.coalesce("component", "node")).drop("component")
    heads = placed.groupBy("class_node").agg(
        F.min(F.struct("k1", "k2")).alias("head"), F.min("doc_id").alias("class_id")
    )
    return placed.join(heads, "class_node").select(
        "doc_id", "k1", "k2", "node", "class_node", "class_id",
        ((F.col("k1") == F.col("head.k1")) & (F.col("k2") == F.col("head.k2"))).alias("keep"),
    )


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs ``u, v`` that are as similar as ``THRESHOLD``."""
    sides = [texts.select(F.col("node").alias(c), F.col("text").alias(f"text_{c}")) for c in "uv"]
    checked = pairs.join(sides[0], "u").join(sides[1], "v").select("u", "v", "text_u", "text_v")
    return checked.mapInArrow(_similar, "u binary, v binary, similarity double").select("u", "v")


def _bags(batches):
    """Node and component columns of a chunk of rows with their weighted shingles."""
    for batch in batches:
        named = [batch.column(batch.schema.get_field_index(c)) for c in ("node", "component")]
        for first, last, data, bounds in slices(lowered(batch.column(batch.schema.get_field_index("text")))):
            yield [c.slice(first, last - first) for c in named], weighted(*shingle_hashes(*word_hashes(data, bounds)))


def _counter(hashes: np.ndarray) -> np.ndarray:
    return (mixed(hashes) % np.uint64(COUNTERS)).astype(np.int64)


def _counted(batches):
    """How many nodes of the task hold a shingle of each counter."""
    times = np.zeros(COUNTERS, np.int64)
    for _, (hashes, _, _) in _bags(batches):
        np.add.at(times, _counter(hashes), 1)
    used = np.flatnonzero(times)
    for part in np.array_split(used, max(1, len(used) // 100_000)):
        yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(times[part])], ["counter", "n"])


MASKS = [f"mask{k}" for k in range(PARITIES)]
LEADING = "token long, node binary, component binary, size long, even boolean, inner boolean, repeated double, " + ", ".join(f"{m} long" for m in MASKS)


def parities(hashes: np.ndarray, weights: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """For each row, whether the shingles that fall to a bit are odd in number.

    Two rows differ in at most as many bits as units of weight, so the bits in which they
    differ bound the distance of the rows from below.
    """
    row = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
    bit = mixed(hashes ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(64 * PARITIES)
    odd = weights % 2 == 1
    out = np.zeros((len(begin) - 1, PARITIES), np.uint64)
    np.bitwise_xor.at(out, (row[odd], (bit // np.uint64(64)).astype(np.int64)[odd]), np.uint64(1) << (bit[odd] % np.uint64(64)))
    return out


def repeated_share(weights: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """The share of each row's mass in repeated shingles."""
    sums = [np.concatenate([[0], np.cumsum(w)]) for w in (weights, np.where(weights > 1, weights, 0))]
    size, repeated = (x[begin[1:]] - x[begin[:-1]] for x in sums)
    return repeated / np.maximum(size, 1)


def far_apart() -> Column:
    """Whether sizes and parities of rows ``_a`` and ``_b`` rule out that they are near.

    With the common weight c and the distance d = |a| + |b| - 2c, what is not repeated adds at
    most c / (|a| + |b| - c) to the index and the rest at most its mass, so near rows need
    c >= t / (1 + t) * (|a| + |b|) for t = ``THRESHOLD`` less both repeated shares; they also need a
    common mass, which is at most c / min(|a|, |b|), of ``THRESHOLD``.
    """
    differing = sum((F.bit_count(F.col(f"{m}_a").bitwiseXOR(F.col(f"{m}_b"))) for m in MASKS), F.lit(0))
    both, shorter = F.col("size_a") + F.col("size_b"), F.least("size_a", "size_b")
    t = F.lit(THRESHOLD) - F.col("repeated_a") - F.col("repeated_b")
    no_index = (t > 0) & (differing > (1 - t) / (1 + t) * both + 1e-6)
    return no_index | (both - differing < (2 * THRESHOLD - 1e-6) * shorter)


def leading(hashes: np.ndarray, weights: np.ndarray, begin: np.ndarray, times: np.ndarray):
    """Leading shingles of each row, rare ones first: place, row, size of the row, even, inner.

    A row's leading shingles are those with ``THRESHOLD`` of its mass from them on. Two even
    rows share ``2 t / (1 + t)`` of the shorter one's mass for ``t = THRESHOLD - 2 EVEN``: what
    is not repeated has the plain Jaccard index, the rest adds at most its mass. Shingles
    with that much from them on are ``inner``.
    """
    row = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
    order = np.lexsort((hashes, times[_counter(hashes)], row))
    weight = weights[order].astype(np.int64)
    total = np.concatenate([[0], np.cumsum(weight)])
    size = total[begin[1:]] - total[begin[:-1]]
    onward = total[begin[row + 1]] - total[:-1]
    repeated = np.concatenate([[0], np.cumsum(np.where(weight > 1, weight, 0))])
    even = repeated[begin[1:]] - repeated[begin[:-1]] <= EVEN * size
    t = THRESHOLD - 2 * EVEN
    at = np.flatnonzero(onward >= (THRESHOLD - 1e-6) * size[row])
    inner = onward[at] >= (2 * t / (1 + t) - 1e-6) * size[row[at]]
    return order[at], row[at], size[row[at]], even[row[at]], inner


def open_pairs(band: DataFrame, linked: DataFrame, texts: DataFrame) -> DataFrame | None:
    """Pairs ``u, v`` of different classes, among them all near ones that share a bucket."""
    spark = band.sparkSession
    named = band.join(linked, "node", "left").select("node", "bucket", F.coalesce("component", "node").alias("component"))
    mixed_buckets = named.groupBy("bucket").agg(F.min("component").alias("a"), F.max("component").alias("b"))
    nodes = named.join(mixed_buckets.where("a <> b").select("bucket"), "bucket", "left_semi")
    nodes = staged(nodes.select("node", "component").distinct(), scratch_path(spark, "open"))
    if nodes.isEmpty():
        return None
    own = texts.join(nodes, "node").select("node", "component", "text")
    counts = own.mapInArrow(_counted, "counter long, n long").groupBy("counter").agg(F.sum("n").alias("n")).toArrow()
    times = np.zeros(COUNTERS, np.int64)
    times[counts.column("counter").to_numpy()] = counts.column("n").to_numpy()
    shared = spark.sparkContext.broadcast(times)

    def run(batches):
        for names, (hashes, weights, begin) in _bags(batches):
            at, row, size, even, inner = leading(hashes, weights, begin, shared.value)
            # A shingle that its counter saw once is in one text only.
            also = shared.value[_counter(hashes[at])] > 1
            take = pa.array(row[also])
            repeated = repeated_share(weights, begin)[row[also]]
            masks = parities(hashes, weights, begin).view(np.int64)[row[also]]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(hashes[at][also].view(np.int64)), *(c.take(take) for c in names),
                    pa.array(size[also]), pa.array(even[also]), pa.array(inner[also]), pa.array(repeated),
                    *(pa.array(np.ascontiguousarray(masks[:, k])) for k in range(PARITIES)),
                ],
                [field.split()[0] for field in LEADING.split(", ")],
            )

    tokens = staged(own.mapInArrow(run, LEADING), scratch_path(spark, "leading"))
    # The class that holds a shingle most often is only compared with the others.
    most = tokens.groupBy("token", "component").agg(F.count("*").alias("n")).groupBy("token").agg(
        F.max_by("component", F.struct("n", "component")).alias("most"), F.count("*").alias("classes")
    )
    most = staged(most.where("classes > 1").select("token", "most"), scratch_path(spark, "common"))
    own_columns = tokens.columns[1:]
    tokens = tokens.join(most, "token")
    left, right = (tokens.select("token", "most", *(F.col(c).alias(f"{c}_{s}") for c in own_columns)) for s in "ab")
    pairs = left.where("component_a <> most").join(right.drop("most"), "token").where("component_a <> component_b")
    plain = ~(F.col("even_a") & F.col("even_b"))
    shorter = (F.col("inner_a") | (F.col("size_a") > F.col("size_b"))) & (F.col("inner_b") | (F.col("size_b") > F.col("size_a")))
    # Texts of one template share all of it; in the join, parities leave those of them that can be near.
    pairs = pairs.where((plain | shorter) & ~far_apart())
    pairs = pairs.select(F.greatest("node_a", "node_b").alias("u"), F.least("node_a", "node_b").alias("v")).distinct()
    return staged(pairs, scratch_path(spark, "pairs"))


def _texts(docs: DataFrame, rows: DataFrame, band: DataFrame) -> DataFrame:
    """The text of every node that shares a bucket with another, ``node, text``."""
    spark = docs.sparkSession
    shared = band.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    wanted = band.join(shared, "bucket", "left_semi").select("node").distinct()
    heads = rows.groupBy("node").agg(F.min(F.struct("k1", "k2")).alias("key"))
    heads = heads.join(wanted, "node", "left_semi").select("node", "key.k1", "key.k2")
    keyed = docs.select(*row_keys(), "text")
    # Rows of one key have one text.
    found = heads.join(keyed, ["k1", "k2"]).groupBy("node").agg(F.first("text").alias("text"))
    return staged(found, scratch_path(spark, "texts"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document with its class."""
    return classes(docs).select("doc_id", "class_id", "keep")


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each class, all columns kept."""
    own = free_names(docs, "__k1", "__k2")
    kept = classes(docs).where("keep").select(F.col("k1").alias(own[0]), F.col("k2").alias(own[1])).distinct()
    keyed = docs.select("*", *(k.alias(n) for k, n in zip(row_keys(), own, strict=True)))
    out = keyed.join(kept, own, "left_semi")
    return out.dropDuplicates(own).drop(*own)
