"""Vector codes: integer codebooks per part, learned with adaptive distance bounds.

A vector's whole numbers are cut into equal parts, and a codebook of up to ``ENTRIES``
entries is learned for each part by rounds of assigning and averaging over all rows.

Between rounds a table keeps, for every row and part, the entry it is assigned to with an
upper bound of its distance, the ``b`` next closest entries in order, each with a lower
bound, and one outer bound below the distances of all other entries. When the entries have
moved, bounds give way by as much. A part whose upper bound stays below its first lower
bound keeps its entry unseen; one that stays below the z-th is compared with the entries
before it; only where even the outer bound fails are all entries tried. ``b`` starts at
``MOST`` and shrinks to what nearly all compared parts needed. Bounds are rounded outwards, and
whatever they leave open is decided by exact integer distances, so results are those of
plain rounds.

What reaches the driver are the codebooks and their sums, of a size that the number of
entries and components gives. Each round reads a table in the shared folder and writes the
next one, so a lost executor repeats its tasks only.

Defined results: null vectors and those with null or non-finite components are left out,
as are vectors of another size than most (the smaller size of a tie); components beyond
2**26 after scaling count as that. An id that repeats gives one first entry, that of its smallest
vector; rows without an id are coded and come last for first entries. Parts that differ in
size, where the size isn't divisible, have the larger ones first. Rows that repeat are coded
each; fewer rows than entries make smaller codebooks; an empty table gives no rows. Errors
beyond a long's range count as its largest value.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake.llm.common import Scratch
from fleetlake.llm.vectors import common_size, lists, matrix, whole_numbers
from fleetlake.operators.skew import left_join_unique

SCALE, LIMIT = 1024.0, 1 << 26
PARTS, ENTRIES, ROUNDS = 4, 256, 4
#: Entries kept with a bound of their own: at first, and at least.
MOST, LEAST = 16, 4
#: Share of the compared parts for which the next round's ``b`` has to do.
COVERED = 0.99
#: Rows that numpy works on at a time.
ROWS = 2048


def part_bounds(size: int, parts: int) -> list[tuple[int, int]]:
    cuts = np.cumsum([0, *(len(x) for x in np.array_split(np.arange(size), parts))])
    return list(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))


def _exact_in_float(v: np.ndarray, entries: np.ndarray) -> bool:
    top = max(int(np.abs(v).max(initial=0)), int(np.abs(entries).max(initial=0)))
    return (2 * top) ** 2 * max(v.shape[1], 1) < 1 << 53


def all_distances(v: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of every row to every entry, as int64."""
    if _exact_in_float(v, entries):
        # Sums of whole numbers below 2**53 are exact in any order.
        a, e = v.astype(np.float64), entries.astype(np.float64)
        return ((a**2).sum(1)[:, None] - 2 * (a @ e.T) + (e**2).sum(1)).astype(np.int64)
    return (v**2).sum(1)[:, None] - 2 * (v @ entries.T) + (entries**2).sum(1)


def some_distances(v: np.ndarray, entries: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Exact squared distances of every row to its chosen entries."""
    return ((v[:, None, :] - entries[chosen]) ** 2).sum(2)


def _above(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x.astype(np.float32), np.float32(np.inf))


def _below(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x.astype(np.float32), np.float32(-np.inf))


@dataclass
class Kept:
    """What is persisted of one part: assigned entries, closest others, bounds, and how many
    bounds a row needed (0: none, b + 1: all entries were tried)."""

    code: np.ndarray
    upper: np.ndarray
    near: np.ndarray
    low: np.ndarray
    outer: np.ndarray
    need: np.ndarray


def from_scratch(v: np.ndarray, entries: np.ndarray, b: int) -> Kept:
    """The state of rows by trying all entries; ties go to the lower index."""
    d = all_distances(v, entries)
    code = d.argmin(1)
    row = np.arange(len(v))
    upper = _above(np.sqrt(d[row, code]))
    d[row, code] = -1
    width = min(b + 2, len(entries))
    order = np.argpartition(d, width - 1, axis=1)[:, :width] if width < len(entries) else np.tile(np.arange(width), (len(v), 1))
    order = np.take_along_axis(order, np.argsort(np.take_along_axis(d, order, 1), axis=1, kind="stable"), 1)[:, 1:]
    low = _below(np.sqrt(np.take_along_axis(d, order, 1)))
    outer = low[:, b] if low.shape[1] > b else np.full(len(v), np.inf, np.float32)
    return Kept(code, upper, order[:, :b], low[:, :b], outer, np.full(len(v), b + 1))


def moved(kept: Kept, v: np.ndarray, entries: np.ndarray, moves: np.ndarray) -> Kept:
    """The state of rows after the entries moved by at most ``moves`` each."""
    b = kept.near.shape[1]
    code, near, low = kept.code.copy(), kept.near.copy(), kept.low
    bounds = np.concatenate([low - moves[near], (kept.outer - moves.max())[:, None]], axis=1)
    bounds = _below(np.minimum.accumulate(bounds[:, ::-1], axis=1)[:, ::-1])
    upper = _above(kept.upper + moves[code])
    open_rows = np.flatnonzero(bounds[:, 0] <= upper)
    upper[open_rows] = _above(np.sqrt(some_distances(v[open_rows], entries, code[open_rows, None])[:, 0]))
    need = (bounds <= upper[:, None]).sum(1)
    out = Kept(code, upper, near, bounds[:, :b].copy(), bounds[:, b].copy(), need)
    for few, many in ((1, min(LEAST, b)), (min(LEAST, b) + 1, b)):
        rows = np.flatnonzero((need >= few) & (need <= many))
        if not len(rows):
            continue
        tried = np.concatenate([code[rows, None], near[rows, :many]], axis=1)
        d = some_distances(v[rows], entries, tried)
        order = np.lexsort((tried, d), axis=1)
        tried, d = np.take_along_axis(tried, order, 1), np.take_along_axis(d, order, 1)
        out.code[rows], out.upper[rows] = tried[:, 0], _above(np.sqrt(d[:, 0]))
        out.near[rows, :many], out.low[rows, :many] = tried[:, 1:], _below(np.sqrt(d[:, 1:]))
    rest = np.flatnonzero(need > b)
    if len(rest):
        new = from_scratch(v[rest], entries, b)
        for name in ("code", "upper", "near", "low", "outer", "need"):
            getattr(out, name)[rest] = getattr(new, name)
    return out


def narrowed(kept: Kept, b: int) -> Kept:
    """The state with ``b`` bounds; the dropped ones fall under the outer bound."""
    outer = np.minimum(kept.outer, kept.low[:, b:].min(axis=1, initial=np.inf))
    return Kept(kept.code, kept.upper, kept.near[:, :b], kept.low[:, :b], outer, kept.need)


@dataclass(frozen=True)
class Round:
    """What a round needs: codebooks, how far their entries moved, bounds kept before and from now on."""

    books: list[np.ndarray]
    moves: list[np.ndarray] | None
    had: list[int]
    keep: list[int]


STATE = "code array<smallint>, upper array<float>, near array<smallint>, low array<float>, outer array<float>, need array<smallint>"


def _assigned(batch: pa.RecordBatch, size: int, now: Round) -> tuple[np.ndarray, list[Kept]]:
    v = matrix(batch.column(2), size).astype(np.int64)
    cuts = part_bounds(size, len(now.books))
    if now.moves is not None:
        code, upper, near, low, outer = (
            matrix(batch.column(3 + k), width) for k, width in enumerate((len(cuts), len(cuts), sum(now.had), sum(now.had), len(cuts)))
        )
        at = np.cumsum([0, *now.had])
    out = []
    for p, (first, last) in enumerate(cuts):
        part, entries = v[:, first:last], now.books[p]
        if now.moves is None:
            out.append(from_scratch(part, entries, now.keep[p]))
            continue
        between = slice(at[p], at[p + 1])
        kept = Kept(code[:, p].astype(np.int64), upper[:, p], near[:, between].astype(np.int64), low[:, between], outer[:, p], None)
        out.append(narrowed(moved(kept, part, entries, now.moves[p]), now.keep[p]))
    return v, out


def _batches(batches):
    for batch in batches:
        for first in range(0, batch.num_rows, ROWS):
            yield batch.slice(first, ROWS)


def assign(rows: DataFrame, size: int, now: Round) -> DataFrame:
    """``rows`` with the state of this round."""
    shared = rows.sparkSession.sparkContext.broadcast(now)
    plain = rows.select("vec_id", "label", "v").schema
    schema = T.StructType([*plain.fields, *T.DataType.fromDDL(STATE).fields])

    def run(batches):
        for batch in _batches(batches):
            _, parts = _assigned(batch, size, shared.value)
            side = lambda name: np.stack([getattr(x, name) for x in parts], axis=1)
            joined = lambda name: np.concatenate([getattr(x, name) for x in parts], axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:3],
                    lists(side("code").astype(np.int16), pa.int16()), lists(side("upper"), pa.float32()),
                    lists(joined("near").astype(np.int16), pa.int16()), lists(joined("low").astype(np.float32), pa.float32()),
                    lists(side("outer").astype(np.float32), pa.float32()), lists(side("need").astype(np.int16), pa.int16()),
                ],
                schema.names,
            )

    return rows.mapInArrow(run, schema)


def sums(state: DataFrame, size: int, entries: int) -> dict[tuple[int, int, int], int]:
    """(part, entry, component) to the sum over the parts assigned; after the components comes
    their count, and entry ``entries + z`` counts the parts that needed z bounds.

    Every task adds up its rows first, so the shuffle carries codebooks, not rows.
    """
    cuts = part_bounds(size, PARTS)

    def run(batches):
        totals = [np.zeros((entries, last - first + 1), np.int64) for first, last in cuts]
        needs = np.zeros((len(cuts), MOST + 2), np.int64)
        for batch in _batches(batches):
            v, code, need = (matrix(batch.column(k), w).astype(np.int64) for k, w in ((0, size), (1, len(cuts)), (2, len(cuts))))
            for p, (first, last) in enumerate(cuts):
                np.add.at(totals[p], code[:, p], np.concatenate([v[:, first:last], np.ones((len(v), 1), np.int64)], axis=1))
                needs[p] += np.bincount(need[:, p], minlength=MOST + 2)
        found = [(p, e, row) for p, total in enumerate(totals) for e, row in enumerate(total) if row[-1]]
        found += [(p, entries + z, [n]) for p, row in enumerate(needs) for z, n in enumerate(row) if n]
        yield pa.RecordBatch.from_pylist(
            [{"part": p, "entry": e, "sums": [int(x) for x in row]} for p, e, row in found],
            pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("sums", pa.list_(pa.int64()))]),
        )

    partial = state.select("v", "code", "need").mapInArrow(run, "part int, entry int, sums array<long>")
    each = partial.select("part", "entry", F.posexplode("sums").alias("at", "x"))
    total = each.groupBy("part", "entry", "at").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x"))
    return {(r.part, r.entry, r.at): int(r.x) for r in total.collect()}


def averaged(books: list[np.ndarray], total: dict[tuple[int, int, int], int]) -> list[np.ndarray]:
    """Entries replaced by the floors of their parts' means; unused ones stay."""
    out = []
    for p, entries in enumerate(books):
        new, size = entries.copy(), entries.shape[1]
        for e in range(len(entries)):
            n = total.get((p, e, size), 0)
            if n:
                new[e] = [total[p, e, k] // n for k in range(size)]
        out.append(new)
    return out


def fewer_bounds(had: int, needs: dict[int, int]) -> int:
    """How many bounds to keep: as many as nearly all parts needed that were compared with some."""
    compared = sum(n for z, n in needs.items() if 1 <= z <= had)
    covered, b = 0, 0
    while compared and covered < COVERED * compared and b < had:
        b += 1
        covered += needs.get(b, 0)
    return min(had, max(LEAST, b)) if compared else had


def first_entries(rows: DataFrame, parts: int, entries: int) -> list[np.ndarray]:
    """The parts of the vectors of the smallest ids, one vector an id."""
    ids = [r.vec_id for r in rows.select("vec_id").distinct().orderBy(F.col("vec_id").asc_nulls_last()).limit(entries).collect()]
    chosen = F.col("vec_id").isin([i for i in ids if i is not None])
    if None in ids:
        chosen = chosen | F.col("vec_id").isNull()
    found = rows.where(chosen).groupBy("vec_id").agg(F.min("v").alias("v")).collect()
    by_id = {r.vec_id: r.v for r in found}
    whole = np.array([by_id[i] for i in ids], np.int64)
    return [whole[:, first:last] for first, last in part_bounds(whole.shape[1], parts)]


def _moves(old: np.ndarray, new: np.ndarray) -> np.ndarray:
    return _above(np.sqrt(((new - old) ** 2).sum(1))).astype(np.float64)


def compress(embeddings: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, list[np.ndarray]]:
    """``vec_id, label, code, error`` of every usable row, and the final codebooks."""
    scratch = Scratch(embeddings.sparkSession)
    rows = scratch.keep(whole_numbers(embeddings, SCALE, LIMIT), "whole")
    size = common_size(rows)
    label = rows.schema["label"]
    schema = T.StructType([rows.schema["vec_id"], label, *T.DataType.fromDDL("code string, error long").fields])
    if size is None:
        return rows.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")).limit(0), []
    state = rows.where(F.size("v") == size)
    books = first_entries(state, PARTS, ENTRIES)
    entries, moves = len(books[0]), None
    keep = [min(MOST, max(entries - 1, 0))] * PARTS
    written = rows
    had = keep
    for _ in range(rounds):
        now = Round(books, moves, had, keep)
        state = scratch.keep(assign(state, size, now), "bounds")
        scratch.drop(written)
        written = state
        total = sums(state, size, entries)
        new = averaged(books, total)
        moves = [_moves(a, b) for a, b in zip(books, new, strict=True)]
        books, had = new, keep
        keep = [
            fewer_bounds(had[p], {e - entries: n for (q, e, _), n in total.items() if q == p and e >= entries}) for p in range(PARTS)
        ]
    last = Round(books, moves, had, had)
    shared = embeddings.sparkSession.sparkContext.broadcast(last)

    def run(batches):
        cuts = part_bounds(size, PARTS)
        for batch in _batches(batches):
            v, parts = _assigned(batch, size, shared.value)
            error = sum(
                some_distances(v[:, a:b], shared.value.books[p], parts[p].code[:, None])[:, 0] for p, (a, b) in enumerate(cuts)
            )
            code = np.stack([x.code for x in parts], axis=1).astype(np.uint8)
            text = code.tobytes().hex()
            width = 2 * PARTS
            codes = [text[k : k + width] for k in range(0, len(text), width)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(codes), pa.array(error)], schema.names)

    coded = scratch.keep(state.mapInArrow(run, schema), "codes")
    scratch.drop(written)
    return coded, books


def digest(books: list[np.ndarray]) -> str:
    """All entries' components, by part, entry and position."""
    return hashlib.sha256(",".join(str(x) for entries in books for x in entries.ravel().tolist()).encode()).hexdigest()


def _as_long(total: Column) -> Column:
    return F.least(total, F.lit(2**63 - 1).cast("decimal(38,0)")).cast("long")


def coded_vectors(embeddings: DataFrame) -> DataFrame:
    """Per vector its code and error, the error of its label, and a digest of the codebooks."""
    coded, books = compress(embeddings)
    keys = {"unlabelled": F.col("label").isNull(), "named": F.coalesce(F.col("label").cast("string"), F.lit(""))}
    coded = coded.select(*(c.alias(n) for n, c in keys.items()), "vec_id", "code", "error")
    totals = coded.groupBy(*keys).agg(_as_long(F.sum(F.col("error").cast("decimal(38,0)"))).alias("label_error"))
    joined = left_join_unique(coded, totals, [*keys], ["vec_id", "code"])
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
