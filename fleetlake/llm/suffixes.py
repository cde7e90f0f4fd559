"""Removal of repeated passages by anchor fingerprints in a logarithmic family of levels.

Every string of ``LENGTH`` bytes has an anchor: the place where a hash of the next ``SEED``
bytes is smallest. Equal strings have it at the same offset, so the suffixes that begin at
anchors, about one byte in 85, are enough to find every repeat. No suffix array is built: a
batch's level holds the hashes of the anchors' seeds, that is of their first bytes, and how
often each occurs; the stretches of text whose strings share an anchor are kept beside it.

A new batch's level is merged with the levels that exist. Levels of equal size merge into
one of twice the size, like the digits of a binary counter, so an entry moves as often as
the logarithm of the number of batches. In the merged order equal seeds are neighbours:
those are the matches of at least ``SEED`` bytes. Where a whole stretch occurs again, all its
strings are repeats. Where only the seed does, one copy of each stretch is cut into blocks of
``BLOCK`` strings. All strings of a block hold its core, the bytes they have in common, and
differ by at most ``BLOCK - 1`` bytes on either side of it. So a block is a 128-bit digest of
its core and two integers for the bytes beside it; equal blocks repeat all their strings, and
only blocks whose core occurs in another block are taken apart into strings. The result is
exact, up to collisions of digests.

Defined results: null counts as empty; texts shorter than ``LENGTH`` bytes lose nothing; a
repeated row repeats all its strings; overlaps inside one document count; an empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import Scratch, free_names, mixed, powers, row_keys, slices, text_buffer
from fleetlake.session import scratch_path, staged
from fleetlake.sources.paths import remove

LENGTH = 200
SEED = 32
BATCHES = 4
#: Words of the filter that thins out what cannot match before a shuffle; it stays this size.
FILTER_WORDS = 1 << 18
#: Strings of a block, by their distance from the anchor; at most 8, so that the bytes beside a core fit an integer.
BLOCK = 8
#: Stretches that are cut into blocks at a time.
EDGES = 5000

_PLACE = np.uint64((1 << 28) - 1)


def seeds(data: np.ndarray) -> np.ndarray:
    """Hash of the ``SEED`` bytes that begin at each place."""
    h = mixed(data.astype(np.uint64) + np.uint64(1))
    width = 1
    base = powers(SEED + 1)[0]
    while width < SEED:
        h = h[:-width] * base[width] + h[width:]
        width *= 2
    return mixed(h)


def anchors(data: np.ndarray, bounds: np.ndarray, length: int = LENGTH):
    """Stretches: row, first string, number of strings, and where their anchor is, with its seed."""
    none = np.empty(0, np.int64)
    if len(data) < length:
        return none, none, none, none, none.astype(np.uint64)
    seed = seeds(data)
    window = length - SEED + 1
    least = (seed & ~_PLACE) | np.arange(len(seed), dtype=np.uint64)
    reach = 1
    while reach * 2 <= window:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if reach < window:
        least = np.minimum(least[: len(least) - (window - reach)], least[window - reach :])
    place = (least & _PLACE).astype(np.int64)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[: len(place)]
    whole = np.arange(len(place)) + length <= bounds[row + 1]
    start = whole.copy()
    start[1:] &= ~whole[:-1] | (place[1:] != place[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(start)
    stop = whole.copy()
    stop[:-1] &= ~whole[1:] | (place[1:] != place[:-1]) | (row[1:] != row[:-1])
    count = np.flatnonzero(stop) + 1 - first
    return row[first], first, count, place[first], seed[place[first]]


ENTRY = "seed long, stretch long, k1 long, k2 long, start int, strings short, ahead short"


def suffix_entries(docs: DataFrame) -> DataFrame:
    """The sampled suffixes of all texts, ``ENTRY``.

    ``stretch`` is a digest of the stretch's bytes and of where the anchor is in it;
    ``start`` is the first string's place, ``ahead`` the anchor's distance from it.
    """
    keyed = docs.select(*row_keys(), "text")

    def run(batches):
        for batch in batches:
            k1, k2, text = (batch.column(batch.schema.get_field_index(c)) for c in ("k1", "k2", "text"))
            for at, last, data, bounds in slices(text):
                row, first, count, place, seed = anchors(data, bounds)
                raw = memoryview(np.ascontiguousarray(data))
                digest = xxhash.xxh3_64_intdigest
                ahead = place - first
                stretch = np.fromiter(
                    (
                        digest(raw[a:b], seed=c)
                        for a, b, c in zip(
                            first.tolist(), (first + count + LENGTH - 1).tolist(), ahead.tolist(), strict=True
                        )
                    ),
                    np.uint64,
                    len(first),
                )
                rows = pa.array(row + at)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(seed.view(np.int64)),
                        pa.array(stretch.view(np.int64)),
                        k1.take(rows),
                        k2.take(rows),
                        pa.array((first - bounds[row]).astype(np.int32)),
                        pa.array(count.astype(np.int16)),
                        pa.array(ahead.astype(np.int16)),
                    ],
                    ["seed", "stretch", "k1", "k2", "start", "strings", "ahead"],
                )

    return keyed.mapInArrow(run, ENTRY)


class IndexFamily:
    """Counts of the batches' seeds, merged geometrically, in the shared folder.

    A level is a table ``seed, n`` in the order of its seeds: how many suffixes begin so.
    """

    def __init__(self, scratch: Scratch):
        self.scratch = scratch
        self.levels: list[tuple[int, DataFrame]] = []
        self.matches: list[DataFrame] = []

    def add(self, entries: DataFrame, size: int = 1) -> None:
        """Takes in a batch, and notes the seeds that it makes occur more than once."""
        new = entries.groupBy("seed").agg(F.count("*").alias("n"))
        new = self._stored(new)
        self.matches.append(self._found(new.where("n > 1").select("seed")))
        scanned = len(self.levels)
        while scanned:
            scanned -= 1
            level_size, level = self.levels[scanned]
            merged = level.select("seed", "n").unionByName(new.select("seed", "n"))
            merged = merged.groupBy("seed").agg(F.sum("n").alias("n"), F.count("*").alias("sides"))
            if level_size == size and scanned == len(self.levels) - 1:
                older = new
                new, size = self._stored(merged), size * 2
                self.levels.pop()
                self.scratch.drop(older, level)
                self.matches.append(self._found(new.where("sides > 1").select("seed")))
            else:
                self.matches.append(self._found(merged.where("sides > 1").select("seed")))
        self.levels.append((size, new))

    def repeated(self) -> DataFrame:
        """``seed``, once each, of all that occur more than once in what was added."""
        out = self.matches[0]
        for found in self.matches[1:]:
            out = out.unionByName(found)
        out = self.scratch.keep(out.distinct(), "repeats")
        self.scratch.drop(*self.matches)
        self.matches = []
        return out

    def close(self) -> None:
        """Drops the levels, once all batches are in."""
        self.scratch.drop(*(level for _, level in self.levels))
        self.levels = []

    def _found(self, seeds_: DataFrame) -> DataFrame:
        return self.scratch.keep(seeds_, "matches")

    def _stored(self, level: DataFrame) -> DataFrame:
        return self.scratch.keep(level.sortWithinPartitions("seed"), "level")


def thinned(df: DataFrame, keys: DataFrame, key: Column, words: int = FILTER_WORDS) -> DataFrame:
    """Rows of ``df`` that may have a key in ``keys``: all that have, and few others.

    A filter of at most ``words`` 64-bit words is broadcast, whatever the number of keys.
    """
    hashed = F.xxhash64(key)
    word, bit = F.pmod(hashed, F.lit(words)), F.pmod(F.shiftright(hashed, 40), F.lit(64)).cast("int")
    bits = (
        keys.select(word.alias("__word"), bit.alias("__bit"))
        .groupBy("__word")
        .agg(F.bit_or(F.expr("shiftleft(1L, __bit)")).alias("__bits"))
    )
    marked = df.withColumns({"__word": word, "__bit": bit})
    kept = marked.join(F.broadcast(bits), "__word")
    return kept.where("shiftrightunsigned(__bits, __bit) & 1 = 1").drop("__word", "__bit", "__bits")


PART = "k1 long, k2 long, start int, strings int, skip int, core1 long, core2 long, left long, right long"
_PART_NAMES = [field.split()[0] for field in PART.split(", ")]


def _packed(data: np.ndarray, place: np.ndarray, count: np.ndarray, step: int) -> np.ndarray:
    """Up to ``BLOCK - 1`` bytes from ``place`` on, going by ``step``, the first one lowest."""
    out = np.zeros(len(place), np.int64)
    for k in range(BLOCK - 1):
        there = count > k
        out[there] |= data[place[there] + step * k].astype(np.int64) << (8 * k)
    return out


def blocks_of(data: np.ndarray, anchor: np.ndarray, far: np.ndarray, near: np.ndarray):
    """Blocks of stretches whose strings begin ``near`` to ``far`` bytes before their anchors.

    Gives, for each block, its stretch, its first string's place, the number of its strings, how many strings
    of a whole block are missing at the near end, two halves of its core's digest, and the bytes before and behind the core.
    """
    number = far // BLOCK - near // BLOCK + 1
    edge = np.repeat(np.arange(len(anchor)), number)
    inner = np.arange(len(edge)) - np.repeat(np.cumsum(number) - number, number)
    low = (near[edge] // BLOCK + inner) * BLOCK
    close, away = np.maximum(near[edge], low), np.minimum(far[edge], low + BLOCK - 1)
    core = anchor[edge] - low
    width = LENGTH - BLOCK + 1
    raw = memoryview(np.ascontiguousarray(data))
    digest = xxhash.xxh3_128_digest
    digests = b"".join([digest(raw[c : c + width], seed=o) for c, o in zip(core.tolist(), low.tolist(), strict=True)])
    pair = np.frombuffer(digests, np.int64).reshape(-1, 2)
    left = _packed(data, core - 1, away - low, -1)
    right = _packed(data, core + width, BLOCK - 1 - (close - low), 1)
    return edge, anchor[edge] - away, away - close + 1, close - low, pair[:, 0], pair[:, 1], left, right


def _edge_blocks(batches):
    """Blocks of the texts' edge stretches."""
    for batch in batches:
        k1, k2, text, edges = (batch.column(batch.schema.get_field_index(c)) for c in ("k1", "k2", "text", "edges"))
        data, bounds = text_buffer(text)
        at = np.asarray(edges.offsets)
        inner = edges.flatten()
        owner = np.repeat(np.arange(len(text)), np.diff(at))
        start, strings, ahead = (inner.field(c).to_numpy().astype(np.int64) for c in ("start", "strings", "ahead"))
        anchor = start + bounds[owner] + ahead
        for rows in np.array_split(np.arange(len(owner)), max(1, math.ceil(len(owner) / EDGES))):
            edge, place, *numbers = blocks_of(data, anchor[rows], ahead[rows], (ahead - strings + 1)[rows])
            of = owner[rows][edge]
            take = pa.array(of)
            counts = [pa.array(n.astype(np.int32)) for n in (place - bounds[of], *numbers[:2])]
            longs = [pa.array(np.ascontiguousarray(n)) for n in numbers[2:]]
            yield pa.RecordBatch.from_arrays([k1.take(take), k2.take(take), *counts, *longs], _PART_NAMES)


def repeated_strings(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """``k1, k2, starts, strings``: per key, runs of places where repeated strings begin."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "suffixes")
    batch = F.pmod(F.xxhash64("k1"), F.lit(batches)).cast("int").alias("batch")
    suffix_entries(docs).select("*", batch).write.partitionBy("batch").parquet(folder)
    entries = spark.read.schema(f"{ENTRY}, batch int").parquet(folder)
    scratch = Scratch(spark)
    family = IndexFamily(scratch)
    for k in range(batches):
        family.add(entries.where(F.col("batch") == k))
    seeds_ = family.repeated()
    family.close()
    # Only suffixes whose seed occurs again are shuffled, but for the filter's few mistakes.
    likely = thinned(entries.drop("batch"), seeds_, F.col("seed")).join(seeds_, "seed", "left_semi")
    likely = staged(likely, scratch_path(spark, "likely"))
    scratch.drop(seeds_)
    remove(spark, folder)
    stretches = likely.groupBy("seed", "stretch").agg(
        F.count("*").alias("n"), F.min(F.struct("k1", "k2", "start", "strings", "ahead")).alias("one")
    )
    stretches = staged(stretches, scratch_path(spark, "stretches"))
    whole = likely.join(stretches.where("n > 1").select("seed", "stretch"), ["seed", "stretch"], "left_semi")
    whole = whole.select("k1", "k2", "start", F.col("strings").cast("int").alias("strings"))
    # One copy of each stretch that differs from another of its seed is compared.
    mixed_seeds = stretches.groupBy("seed").agg(F.count("*").alias("kinds")).where("kinds > 1")
    edges = stretches.join(mixed_seeds, "seed", "left_semi").select(
        "one.k1", "one.k2",
        F.struct("one.start", F.col("one.strings").cast("int").alias("strings"), F.col("one.ahead").cast("int").alias("ahead")).alias("edge"),
    )
    per_text = edges.groupBy("k1", "k2").agg(F.collect_list("edge").alias("edges"))
    per_text = scratch.keep(per_text, "edges")
    blocks = scratch.keep(_with_texts(docs, per_text).mapInArrow(_edge_blocks, PART), "blocks")
    scratch.drop(per_text)
    # What has a core of its own shares no string; the rest is a small part.
    halves = scratch.keep(blocks.groupBy("core1").agg(F.count("*").alias("n")).where("n > 1").select("core1"), "cores")
    likely_blocks = thinned(blocks, halves, F.col("core1")).join(halves, "core1", "left_semi").select(*_PART_NAMES)
    recurring = staged(likely_blocks, scratch_path(spark, "recurring"))
    scratch.drop(blocks, halves)
    content = ["core1", "core2", "skip", "strings", "left", "right"]
    kinds = recurring.groupBy(*content).agg(F.count("*").alias("n"), F.min(F.struct("k1", "k2", "start")).alias("one"))
    kinds = staged(kinds, scratch_path(spark, "kinds"))
    again = recurring.join(kinds.where("n > 1").select(*content), content, "left_semi").select("k1", "k2", "start", "strings")
    cores = kinds.groupBy("core1", "core2").agg(F.count("*").alias("blocks")).where("blocks > 1")
    strings = kinds.join(cores, ["core1", "core2"], "left_semi")
    # String j of a block takes j bytes before the core and the rest behind it.
    strings = strings.select("*", F.explode(F.sequence(F.col("skip"), F.col("skip") + F.col("strings") - 1)).alias("j")).select(
        "n", "one.k1", "one.k2", (F.col("one.start") + F.col("skip") + F.col("strings") - 1 - F.col("j")).alias("start"), "core1", "core2", "j",
        F.expr("`left` & (shiftleft(1L, 8 * j) - 1)").alias("before"),
        F.expr(f"`right` & (shiftleft(1L, 8 * ({BLOCK - 1} - j)) - 1)").alias("behind"),
    )
    one_string = ["core1", "core2", "j", "before", "behind"]
    twice = strings.groupBy(*one_string).agg(F.count("*").alias("times")).where("times > 1").select(*one_string)
    single = strings.where("n = 1").join(twice, one_string, "left_semi").select("k1", "k2", "start", F.lit(1).alias("strings"))
    runs = whole.unionByName(again).unionByName(single)
    # Rows of one key have the same runs: a task sends each once, whatever the number of copies.
    runs = runs.groupBy("k1", "k2").agg(F.collect_set(F.struct("start", "strings")).alias("runs"))
    return runs.select("k1", "k2", F.col("runs.start").alias("starts"), F.col("runs.strings").alias("strings"))


def _with_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The texts of the keys of ``wanted``, beside its columns; one row a key."""
    keyed = docs.select(*row_keys(), "text").where(F.octet_length("text") >= LENGTH)
    likely = thinned(keyed, wanted, F.struct("k1", "k2")).dropDuplicates(["k1", "k2"])
    return likely.join(wanted, ["k1", "k2"])


def removed_runs(starts: np.ndarray, strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of bytes covered by strings that begin at runs of places."""
    order = np.argsort(starts, kind="stable")
    begin = starts[order].astype(np.int64)
    end = np.maximum.accumulate(begin + strings[order] + LENGTH - 1)
    new = np.ones(len(begin), bool)
    new[1:] = begin[1:] > end[:-1]
    first = np.flatnonzero(new)
    return begin[first], end[np.append(first[1:], len(begin)) - 1] if len(first) else end[:0]


def kept_bytes(text: bytes, begin: np.ndarray, end: np.ndarray) -> bytes:
    stops, starts = [*begin.tolist(), len(text)], [0, *end.tolist()]
    return b"".join(text[a:b] for a, b in zip(starts, stops, strict=True))


def _cut(batches):
    """Digests and texts of what is left of each row."""
    for batch in batches:
        text, starts, strings = (
            batch.column(batch.schema.get_field_index(c)) for c in ("text", "starts", "strings")
        )
        data, bounds = text_buffer(text)
        raw = memoryview(np.ascontiguousarray(data))
        at = np.asarray(starts.offsets)
        first, count = np.asarray(starts.values), np.asarray(strings.values)
        removed, spans, sha, left = [], [], [], []
        for r in range(len(text)):
            begin, end = removed_runs(first[at[r] : at[r + 1]], count[at[r] : at[r + 1]])
            kept = kept_bytes(bytes(raw[bounds[r] : bounds[r + 1]]), begin, end)
            removed.append(int((end - begin).sum()))
            spans.append(len(begin))
            sha.append(hashlib.sha256(kept).hexdigest())
            # Half a character is no text: what is left of one that was cut goes too.
            left.append(kept.decode("utf-8", "ignore"))
        keys = [batch.column(batch.schema.get_field_index(c)) for c in ("k1", "k2")]
        yield pa.RecordBatch.from_arrays(
            [*keys, pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(sha), pa.array(left)],
            ["k1", "k2", "n_removed", "n_spans", "kept_sha256", "left"],
        )


CUT = "k1 long, k2 long, n_removed long, n_spans long, kept_sha256 string, left string"


def cuts(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """``CUT`` for the keys that lose something, one row each."""
    spark = docs.sparkSession
    runs = staged(repeated_strings(docs, batches), scratch_path(spark, "runs"))
    return _with_texts(docs, runs).mapInArrow(_cut, CUT)


def removals(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """Per document how much goes, in how many runs, and a digest of the rest."""
    found = cuts(docs, batches).drop("left")
    plain = docs.select(
        "doc_id",
        *row_keys(),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha"),
    )
    return plain.join(found, ["k1", "k2"], "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
        F.coalesce("kept_sha256", "sha").alias("kept_sha256"),
    )


def without_repeats(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """``docs`` with repeated passages cut out of ``text`` and ``n_chars`` counted anew."""
    k1, k2, left, cut = free_names(docs, "__k1", "__k2", "__left", "__cut")
    found = staged(cuts(docs, batches).select("k1", "k2", "left"), scratch_path(docs.sparkSession, "cut"))
    found = found.select(F.col("k1").alias(k1), F.col("k2").alias(k2), F.col("left").alias(left), F.lit(True).alias(cut))
    keyed = docs.select("*", *(k.alias(n) for k, n in zip(row_keys(), (k1, k2), strict=True)))
    joined = keyed.join(found, [k1, k2], "left")
    out = joined.withColumn("text", F.when(F.col(cut), F.col(left)).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        counted = F.when(F.col(cut), F.length("text").cast("long")).otherwise(F.col("n_chars"))
        out = out.withColumn("n_chars", counted)
    return out.select(*(F.col(f"`{c}`") for c in docs.columns))
