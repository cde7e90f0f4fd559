"""Benchmark decontamination: SimHash of item-sized windows under a multi-index.

For each size that benchmark items have in words, the windows of that size in a document get
a 64-bit SimHash of their weighted shingles. The items' fingerprints are indexed by four
blocks of 16 bits: within ``RADIUS`` bits of each other, two fingerprints differ in at most
a quarter of that in one block, so each item is filed under all block values that near, and
every fingerprint within the radius is found. Similar windows may lie further apart, so a
window is also a candidate for each item of which it holds enough shingles. A candidate counts if the weighted Jaccard
similarity of its shingles with the item's is ``THRESHOLD`` or more, computed exactly.

Windows are fingerprinted only where enough of their shingles occur in the benchmark at all:
a similarity of ``THRESHOLD`` needs that, so nothing is lost by it. A text of fewer words
than an item is its one window, whole.

The benchmark is the query set. It is taken in blocks of bounded bytes and rows, each sent
to all tasks; documents are never shuffled.

Defined results: null counts as empty; items and texts without a word match nothing; an
item under five words is one shingle of all its words and matches where they occur in a
row; repeated rows and items are judged each for itself.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake.llm.common import SHINGLE, extended, lowered, mixed, powers, shingle_hashes, slices, word_hashes

THRESHOLD = 0.8
RADIUS = 15
BLOCKS = 4
#: Most rows and bytes of the benchmark that are sent to the tasks at once.
BLOCK_ITEMS, BLOCK_BYTES = 4000, 16 << 20

_MASKS = np.array(
    [
        sum(1 << b for b in bits)
        for n in range(RADIUS // BLOCKS + 1)
        for bits in itertools.combinations(range(64 // BLOCKS), n)
    ],
    np.int64,
)


def _signs(hashes: np.ndarray) -> np.ndarray:
    """One row of 64 times +1 or -1 for each hash."""
    bits = np.unpackbits(np.ascontiguousarray(hashes).view(np.uint8).reshape(-1, 8), axis=1)
    return bits.astype(np.int32) * 2 - 1


def simhash(sums: np.ndarray) -> np.ndarray:
    """Fingerprints from rows of 64 sums."""
    return np.packbits(sums > 0, axis=1).reshape(-1, 8).view(np.uint64).ravel()


def gram_hashes(word: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the ``n`` words from each place on, as ``shingle_hashes`` makes them."""
    size = max(len(word) - n + 1, 0)
    out = np.zeros(size, np.uint64)
    for k in range(n):
        out += word[k : k + size] * powers(n + 1)[0][k]
    return mixed(out if n == SHINGLE else out + np.uint64(n))


class Items:
    """A block of the benchmark, by size in words."""

    def __init__(self, ids: list, texts: pa.Array):
        self.ids: list = []
        self.sizes: list[int] = []
        self.bags: list[tuple[np.ndarray, np.ndarray]] = []
        prints = []
        at_item = 0
        for _, _, data, bounds in slices(lowered(texts)):
            word, at = word_hashes(data, bounds)
            hashes, begin = shingle_hashes(word, at)
            for r in range(len(bounds) - 1):
                if at[r + 1] > at[r]:
                    own = hashes[begin[r] : begin[r + 1]]
                    self.ids.append(ids[at_item])
                    self.sizes.append(int(at[r + 1] - at[r]))
                    self.bags.append(np.unique(own, return_counts=True))
                    prints.append(simhash(_signs(own).sum(axis=0)[None])[0])
                at_item += 1
        self.prints = np.array(prints, np.uint64)
        self.size = np.array(self.sizes, np.int64)
        keys = [np.empty(0, np.int64)]
        for b in range(BLOCKS):
            value = ((self.prints >> np.uint64(16 * b)) & np.uint64(0xFFFF)).astype(np.int64)
            keys.append(((value[:, None] ^ _MASKS) | (b << 16)).ravel())
        keys = np.concatenate(keys)
        order = np.argsort(keys, kind="stable")
        self.starts = np.searchsorted(keys[order], np.arange((BLOCKS << 16) + 1)).astype(np.int32)
        self.owners = np.tile(np.repeat(np.arange(len(self.ids)), len(_MASKS)), BLOCKS)[order].astype(np.int32)
        self.known = {
            n: np.unique(np.concatenate([b[0] for b, s in zip(self.bags, self.sizes, strict=True) if min(s, SHINGLE) == n]))
            for n in sorted({min(s, SHINGLE) for s in self.sizes})
        }
        # The items that hold each known shingle.
        self.holders = {}
        for n, known in self.known.items():
            own = [k for k, s in enumerate(self.sizes) if min(s, SHINGLE) == n]
            place = np.searchsorted(known, np.concatenate([self.bags[k][0] for k in own]))
            holder = np.repeat(own, [len(self.bags[k][0]) for k in own])
            order = np.argsort(place, kind="stable")
            self.holders[n] = np.searchsorted(place[order], np.arange(len(known) + 1)), holder[order]

    def matches(self, word: np.ndarray) -> list[tuple]:
        """``(item, similarity, first word, windows)`` of a text: its best window for each item."""
        best: dict[int, list] = {}
        for n, known in self.known.items():
            gram = gram_hashes(word, n)
            if not len(gram):
                continue
            hit = known[np.minimum(np.searchsorted(known, gram), len(known) - 1)] == gram
            if not hit.any():
                continue
            for size in sorted({s for s in self.sizes if min(s, SHINGLE) == n and s <= len(word)}):
                self._of_size(size, size - n + 1, gram, hit, best)
            if n == SHINGLE:
                self._longer(len(word), gram, hit, best)
        return [(self.ids[k], *v) for k, v in sorted(best.items())]

    def _held(self, n: int, gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of known shingles, and the items that hold each, in order of the places."""
        starts, holders = self.holders[n]
        at = np.searchsorted(self.known[n], gram)
        many = starts[at + 1] - starts[at]
        which = np.repeat(np.arange(len(gram)), many)
        return which, holders[starts[at][which] + np.arange(len(which)) - (np.cumsum(many) - many)[which]]

    def _longer(self, length: int, gram: np.ndarray, hit: np.ndarray, best: dict) -> None:
        """Items of more words than the text: all of it is their one window."""
        if hit.sum() < 2 * len(gram) * THRESHOLD / (1 + THRESHOLD) - 1e-9 or length >= self.size.max():
            return
        _, item = self._held(SHINGLE, gram[hit])
        shared = np.bincount(item, minlength=len(self.ids))
        least = (len(gram) + self.size - SHINGLE + 1) * THRESHOLD / (1 + THRESHOLD) - 1e-9
        own = np.unique(gram, return_counts=True)
        for k in np.flatnonzero((self.size > length) & (shared >= least)).tolist():
            similarity = weighted_jaccard(own, self.bags[k])
            if similarity >= THRESHOLD - 1e-9:
                best[k] = [similarity, 0, 1]

    def _counted(self, size: int, span: int, gram: np.ndarray, hit: np.ndarray, part: np.ndarray, least: int) -> np.ndarray:
        """Windows with enough shingles of an item, as ``window * items + item``; none that counts is left out."""
        at = part[0] + np.flatnonzero(hit[part[0] : part[-1] + span])
        which, item = self._held(min(size, SHINGLE), gram[at])
        own = self.size[item] == size
        place, item = at[which[own]], item[own]
        often = np.bincount(item, minlength=len(self.ids))
        found = [np.empty(0, np.int64)]
        for k in np.flatnonzero(often >= least).tolist():
            there = place[item == k]
            shared = np.searchsorted(there, part + span) - np.searchsorted(there, part)
            found.append(np.flatnonzero(shared >= least) * len(self.ids) + k)
        return np.concatenate(found)

    def _of_size(self, size: int, span: int, gram: np.ndarray, hit: np.ndarray, best: dict) -> None:
        total = np.concatenate([[0], np.cumsum(hit)])
        # c shared of span shingles on either side: c / (2 span - c) >= THRESHOLD.
        least = math.ceil(2 * span * THRESHOLD / (1 + THRESHOLD) - 1e-9)
        window = np.flatnonzero(total[span:] - total[:-span] >= least)
        for part in np.split(window, np.flatnonzero(np.diff(window) > span) + 1):
            if not len(part):
                continue
            first = part[0]
            sums = np.cumsum(_signs(gram[first : part[-1] + span]), axis=0)
            sums = np.concatenate([np.zeros((1, 64), sums.dtype), sums])
            prints = simhash(sums[part - first + span] - sums[part - first])
            pairs = []
            for b in range(BLOCKS):
                value = ((prints >> np.uint64(16 * b)) & np.uint64(0xFFFF)).astype(np.int64) | (b << 16)
                n = self.starts[value + 1] - self.starts[value]
                which = np.repeat(np.arange(len(part)), n)
                inner = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
                pairs.append(which * len(self.ids) + self.owners[self.starts[value][which] + inner])
            pair = np.unique(np.concatenate(pairs))
            which, item = pair // len(self.ids), pair % len(self.ids)
            near = (self.size[item] == size) & (np.bitwise_count(prints[which] ^ self.prints[item]) <= RADIUS)
            counted = self._counted(size, span, gram, hit, part, least)
            pair = np.unique(np.concatenate([pair[near], counted]))
            for w, k in zip((pair // len(self.ids)).tolist(), (pair % len(self.ids)).tolist(), strict=True):
                own, n = np.unique(gram[part[w] : part[w] + span], return_counts=True)
                similarity = weighted_jaccard((own, n), self.bags[k])
                if similarity >= THRESHOLD - 1e-9:
                    entry = best.setdefault(k, [0.0, 0, 0])
                    entry[2] += 1
                    if similarity > entry[0]:
                        entry[:2] = similarity, int(part[w])


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    _, in_a, in_b = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = int(np.minimum(a[1][in_a], b[1][in_b]).sum())
    return shared / (int(a[1].sum()) + int(b[1].sum()) - shared)


MATCH = T.ArrayType(
    T.StructType(
        [
            T.StructField("item_id", T.LongType()),
            T.StructField("similarity", T.DoubleType()),
            T.StructField("word", T.LongType()),
            T.StructField("windows", T.LongType()),
        ]
    )
)


def _item_blocks(benchmark: DataFrame) -> list[DataFrame]:
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("text"))
    n, size = items.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(1, math.ceil(n / BLOCK_ITEMS * 1.25) if n > BLOCK_ITEMS else 1, math.ceil(size / BLOCK_BYTES))
    if blocks == 1:
        return [items]
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    return [items.where(block == k) for k in range(blocks)]


def matched(docs: DataFrame, benchmark: DataFrame, into: str = "matches") -> DataFrame:
    """``docs`` with the benchmark items that occur in each text; a column of that name is replaced."""
    spark = docs.sparkSession
    docs = docs.drop(into)
    names = docs.columns
    out = docs
    for number, block in enumerate(_item_blocks(benchmark)):
        rows = block.toArrow().combine_chunks()
        texts = rows.column("text").chunk(0) if rows.num_rows else pa.array([], pa.string())
        shared = spark.sparkContext.broadcast(Items(rows.column("item_id").to_pylist(), texts))
        out = out.mapInArrow(_matcher(shared, [*names, *([into] if number else [])], into, number > 0), extended(docs, (into, MATCH)))
    return out


def _matcher(shared, names: list[str], into: str, more: bool):
    def run(batches):
        items = shared.value
        kind = pa.list_(
            pa.struct([("item_id", pa.int64()), ("similarity", pa.float64()), ("word", pa.int64()), ("windows", pa.int64())])
        )
        for batch in batches:
            found = []
            for _, _, data, bounds in slices(lowered(batch.column(batch.schema.get_field_index("text")))):
                word, at = word_hashes(data, bounds)
                for r in range(len(bounds) - 1):
                    rows = items.matches(word[at[r] : at[r + 1]])
                    found.append([dict(zip(("item_id", "similarity", "word", "windows"), m, strict=True)) for m in rows])
            columns = list(batch.columns)
            if more:
                before = columns.pop(names.index(into)).to_pylist()
                found = [a + b for a, b in zip(before, found, strict=True)]
            kept = [n for n in names if n != into]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, kind)], [*kept, into])

    return run


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and benchmark item in it: the best window and how many count."""
    rows = matched(docs.select("doc_id", "text"), benchmark)
    return rows.select("doc_id", F.explode("matches").alias("m")).select("doc_id", "m.*")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without those that hold a benchmark item."""
    return matched(docs, benchmark, "__matches").where(F.size("__matches") == 0).drop("__matches")
