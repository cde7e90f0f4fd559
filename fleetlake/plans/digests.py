"""Which days of bronze are known to be in silver, so that unchanged days are not read again.

A small state table per table holds one row per layer and day: a fingerprint of the day's
files (names, lengths, times of change), the rows and an order-free digest of them, and for
bronze the fingerprint of the silver day that was found to hold all of it. Four questions
are asked in turn, each only of the days that the one before left open:

1. Are the files of both layers those of the last proof? This lists files and opens none.
2. Has silver fewer rows? Then it is sure to lack some. Counts come from file footers.
3. Do both days have as many rows and the same sum of 128-bit row hashes? This scans the
   days whose files changed, without a shuffle; each task sends a row per day.
4. Which rows does silver lack? Only here are rows compared.

Whoever writes to either layer needs to know nothing of this: new files change the fingerprint.
Losing the state table costs one scan. Equal sums of hashes stand for equal rows, which is
wrong once in about 2**128 comparisons.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.plans.compaction import unarchived
from fleetlake.sources.layers import Lake, read_table, stored_days
from fleetlake.sources.paths import STAGED, exists, recover, split, swap_in

STATE = "layer string, day string, files string, n bigint, digest string, proven string"


@dataclass(frozen=True)
class DayState:
    """One layer's day; ``n`` and ``digest`` are None until somebody needed them."""

    files: str
    n: int | None = None
    digest: str | None = None
    proven: str | None = None


def file_fingerprints(spark: SparkSession, folders: Iterable[str]) -> dict[str, str]:
    """A fingerprint of the files in each folder, by its path; no file is opened for its rows."""
    by_name = {"/".join(folder.split("/")[-3:]): folder for folder in folders}
    if not by_name:
        return {}
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(sorted(by_name.values()))
    parts = F.split("path", "/")
    hashed = F.sum(F.xxhash64(F.element_at(parts, -1), "length", "modificationTime").cast("decimal(38,0)"))
    # Layer, table and day; a row per calendar day and layer.
    folder = F.array_join(F.slice(parts, -4, 3), "/").alias("folder")
    found = files.groupBy(folder).agg(F.count(F.lit(1)).alias("n"), hashed.alias("h"))
    return {by_name[r["folder"]]: f"{r['n']}:{r['h']}" for r in found.collect()}


def row_digest(rows: DataFrame) -> Column:
    """The order-free sum of 128-bit row hashes, as an aggregate ``digest``.

    The hash functions pass over NULLs, so a mask says which columns hold one.
    """
    columns = sorted(c for c in rows.columns if c != "dt")
    mask = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns])
    halves = [F.sum(F.xxhash64(F.lit(seed), mask, *columns).cast("decimal(38,0)")).cast("string") for seed in (1, 2)]
    return F.concat_ws(":", *halves).alias("digest")


def _by_day(rows: DataFrame, days: list[str], wanted: Column) -> dict[str, int | str]:
    """An aggregate of the rows of each day."""
    found = rows.where(F.col("dt").isin(days)).groupBy(F.col("dt").cast("string").alias("day")).agg(wanted.alias("x"))
    return {r["day"]: r["x"] for r in found.collect()}  # a row per calendar day


class Archive:
    """What is known of bronze and silver of one table, day by day."""

    def __init__(self, spark: SparkSession, lake: Lake, table: str):
        self.spark, self.table = spark, table
        self.paths = {layer: lake.path(layer, table) for layer in ("bronze", "silver")}
        self.state_path = lake.path("state", table)
        #: Days whose rows were read, by layer; for tests and logs.
        self.scanned: dict[str, list[str]] = {"bronze": [], "silver": []}
        recover(spark, self.state_path)
        self._known: dict[tuple[str, str], DayState] = {}
        if exists(spark, self.state_path):
            # Two rows per calendar day of the hot window.
            self._known = {
                (r["layer"], r["day"]): DayState(r["files"], r["n"], r["digest"], r["proven"])
                for r in spark.read.schema(STATE).parquet(self.state_path).collect()
            }
        self._saved = dict(self._known)
        self.days = stored_days(spark, self.paths["bronze"])
        for path in self.paths.values():
            recover(spark, path)
        self.refresh(self.days)

    def refresh(self, days: Iterable[str]) -> None:
        """List the files of ``days`` anew; what is known of changed ones is forgotten."""
        days = set(days)
        folders = {
            f"{path}/dt={day}": (layer, day)
            for layer, path in self.paths.items()
            for day in days & stored_days(self.spark, path)
        }
        listed = {folders[f]: files for f, files in file_fingerprints(self.spark, folders).items()}
        for at in ((layer, day) for layer in self.paths for day in days):
            files = listed.get(at, "")
            if at not in self._known or self._known[at].files != files:
                self._known[at] = DayState(files) if files else DayState("", 0, "")

    def _table(self, layer: str) -> DataFrame:
        return read_table(self.spark, self.paths[layer], self.table)

    def _count(self, layer: str, days: Iterable[str]) -> None:
        wanted = [d for d in sorted(days) if self._known[layer, d].n is None]
        found = _by_day(self._table(layer), wanted, F.count(F.lit(1))) if wanted else {}
        for day in wanted:
            self._known[layer, day] = replace(self._known[layer, day], n=found.get(day, 0))

    def _scan(self, layer: str, days: Iterable[str]) -> None:
        wanted = [d for d in sorted(days) if self._known[layer, d].digest is None]
        self.scanned[layer] += wanted
        rows = self._table(layer)
        found = _by_day(rows, wanted, row_digest(rows)) if wanted else {}
        for day in wanted:
            self._known[layer, day] = replace(self._known[layer, day], digest=found.get(day, ""))

    def is_proven(self, day: str) -> bool:
        return self._known["bronze", day].proven == self._known["silver", day].files

    def prove(self, days: Iterable[str]) -> None:
        """Note that silver holds all rows that bronze has of ``days``."""
        for day in days:
            known = self._known["bronze", day]
            self._known["bronze", day] = replace(known, proven=self._known["silver", day].files)

    def lacking(self, days: Iterable[str] | None = None) -> dict[str, int]:
        """Days of which silver lacks rows, with at least how many; the others are proven."""
        unsure = sorted(d for d in (self.days if days is None else set(days) & self.days) if not self.is_proven(d))
        known = self._known
        for layer in self.paths:
            self._count(layer, unsure)
        short = {d: known["bronze", d].n - known["silver", d].n for d in unsure if known["bronze", d].n > known["silver", d].n}
        alike = [d for d in unsure if d not in short and known["bronze", d].n]
        for layer in self.paths:
            self._scan(layer, alike)
        same = lambda d: (known["bronze", d].n, known["bronze", d].digest) == (known["silver", d].n, known["silver", d].digest)
        differing = [d for d in alike if not same(d)]
        if differing:
            rows, stored = (self._table(layer).where(F.col("dt").isin(differing)) for layer in self.paths)
            short |= {r["dt"].isoformat(): r["n"] for r in unarchived(rows, stored).collect()}  # a row per calendar day
        self.prove(set(unsure) - set(short))
        return short

    def compacted(self, days: Iterable[str]) -> int:
        """Note that ``days`` were merged into silver just now; returns the rows that silver gained."""
        days = sorted(days)
        before = sum(self._known["silver", day].n for day in days)
        self.refresh(days)
        self.prove(days)
        self._count("silver", days)
        return sum(self._known["silver", day].n for day in days) - before

    def purged(self) -> None:
        """Note that proven days of bronze lost rows or went as a whole just now."""
        kept = {day for day in self.days if self.is_proven(day)}
        self.days = stored_days(self.spark, self.paths["bronze"])
        self.refresh(self.days)
        self.prove(kept & self.days)

    def save(self) -> None:
        """Store what is known of the days that bronze has; nothing is written if nothing changed."""
        kept = {(layer, day): state for (layer, day), state in self._known.items() if day in self.days}
        if kept == self._saved:
            return
        rows = [(layer, day, s.files, s.n, s.digest, s.proven) for (layer, day), s in sorted(kept.items())]
        parent, name = split(self.state_path)
        staged = f"{parent}/{STAGED}/{name}"
        self.spark.createDataFrame(rows, STATE).coalesce(1).write.mode("overwrite").parquet(staged)
        swap_in(self.spark, staged, self.state_path)
        self._saved = kept
