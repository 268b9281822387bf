"""Tables that are updated in place by key.

The rows are stored in ranges of a unique key (a versioned table, one part per
range, whose name holds its least and greatest key). An update finds, from the
names alone, the ranges that its keys fall into, rewrites these and keeps all
other files; readers see it whole or not at all. A new key goes to the range at
its place. A range that outgrows ``rows_per_range`` twice over is cut.

The list of ranges is the only thing that passes through the driver: a few
numbers per range.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlens.session import shared_dir
from wardlens.sources.versions import VersionedTable


class KeyedTable:
    """Rows of ``schema`` under ``root`` by the long column ``key``."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, key: str,
                 rows_per_range: int = 5_000_000):
        self.spark, self.schema, self.key = spark, schema, key
        self.rows_per_range = rows_per_range
        self.table = VersionedTable(spark, root)

    @staticmethod
    def _range(name: str) -> tuple[int, int]:
        low, high, _ = name.split("_")
        return int(low), int(high)

    def ranges(self, version: int | None = None) -> list[str]:
        """The parts in the order of their keys."""
        return sorted(self.table.parts(version), key=self._range)

    def read(self, low: int | None = None, high: int | None = None,
             version: int | None = None) -> DataFrame:
        """All rows, or those of a range of keys, for which only the parts that
        can hold them are listed."""
        parts = [p for p in self.ranges(version) if (low is None or self._range(p)[1] >= low)
                 and (high is None or self._range(p)[0] <= high)]
        rows = self.table.read(self.schema, parts, version)
        if low is not None:
            rows = rows.where(F.col(self.key) >= low)
        return rows if high is None else rows.where(F.col(self.key) <= high)

    def _write(self, rows: DataFrame, part: Column) -> tuple[DataFrame, list[Row]]:
        """Write rows by a part number; what was written, and for each part its
        folder, least and greatest key and number of rows."""
        folder = self.table.new_folder()
        named = self.schema.names
        (rows.withColumn("part", part).select(*named, "part").hint("rebalance", "part")
         .write.partitionBy("part").parquet(self.table.path(folder)))
        written = self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField(
            "part", T.IntegerType())])).parquet(self.table.path(folder))
        made = written.groupBy("part").agg(F.min(self.key).alias("lo"), F.max(self.key).alias("hi"),
                                           F.count(F.lit(1)).alias("n"))
        at = F.concat(F.lit(f"{folder}/part="), F.col("part").cast("string"))
        return written, made.withColumn("folder", at).collect()

    @staticmethod
    def _named(made: list[Row]) -> dict[str, str]:
        return {f"{r['lo']}_{r['hi']}_{uuid.uuid4().hex}": r["folder"] for r in made}

    def _check(self, rows: DataFrame) -> None:
        """A null or repeated key is an error."""
        twice = rows.groupBy(self.key).count().where(F.col(self.key).isNull() | (F.col("count") > 1))
        if not twice.isEmpty():
            raise ValueError(f"{self.key} is not a unique key")

    def _cuts(self, rows: DataFrame, part: Column) -> list[int]:
        """Keys that cut each part into pieces of about ``rows_per_range``. Parts
        of as many pieces are cut in one pass."""
        sizes = rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
        pieces: dict[int, list[int]] = {}
        for r in sizes.collect():
            if r["n"] > 2 * self.rows_per_range:
                pieces.setdefault(-(-r["n"] // self.rows_per_range), []).append(r["part"])
        cuts: list[int] = []
        for k, parts in pieces.items():
            found = rows.where(part.isin(parts)).groupBy(part.alias("part")).agg(F.percentile_approx(
                self.key, [i / k for i in range(1, k)], 10_000).alias("q"))
            cuts += [c + 1 for r in found.collect() for c in r["q"]]
        return cuts

    def build(self, rows: DataFrame) -> int:
        """Store rows in place of what is stored."""
        base = self.table.newest()
        cuts = sorted(set(self._cuts(rows, F.lit(0))))
        written, made = self._write(rows, self._place(cuts))
        self._check(written)
        return self.table.commit(base, dict.fromkeys(self.table.parts(base)) | self._named(made))

    @staticmethod
    def _longs(numbers: Iterable[int]) -> Column:
        """An array of constants, which the optimizer makes one literal."""
        return F.split(F.lit(",".join(map(str, numbers))), ",").cast("array<long>")

    def _place(self, starts: list[int]) -> Column:
        """How many of the starts, which are sorted, are not above the key: found
        by a binary search, so that a row does not meet all ranges."""
        if not starts:
            return F.lit(0)
        at, key = self._longs(starts), F.col(self.key)
        steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(starts).bit_length()))])
        return F.aggregate(steps, F.lit(0), lambda n, step: n + F.when(
            F.get(at, n + step - 1) <= key, step).otherwise(0))

    def update(self, upserts: DataFrame | None = None, removed: DataFrame | None = None) -> list[str]:
        """Replace or insert the rows of ``upserts`` and remove the keys of
        ``removed``; returns the parts that were rewritten."""
        base = self.table.newest()
        names = self.ranges(base)
        work = shared_dir(self.spark, None)
        new = upserts if upserts is not None else self.spark.createDataFrame([], self.schema)
        new = self._keep(new.select(*self.schema.names), f"{work}/new")
        # Stored keys are unique, and leave before the new rows of the same keys
        # enter: the rewritten ranges' keys are unique if the new ones are.
        self._check(new)
        keys = new.select(self.key)
        if removed is not None:
            gone = self._keep(removed.select(self.key).where(F.col(self.key).isNotNull()), f"{work}/gone")
            keys = keys.unionByName(gone)
        starts = [self._range(n)[0] for n in names][1:]
        place = self._place(starts)
        touched: list[int] = []
        if names:
            hit = new.select(place.alias("at"))
            if removed is not None:  # a key between two ranges is in neither
                lows, highs = (self._longs(x) for x in zip(*map(self._range, names)))
                inside = F.col(self.key).between(F.get(lows, F.col("at")), F.get(highs, F.col("at")))
                hit = hit.unionByName(gone.withColumn("at", place).where(inside).select("at"))
            touched = sorted(r["at"] for r in hit.distinct().collect())  # at most one number per range
            if not touched:
                return []
        old = [names[i] for i in touched]
        rows = self.table.read(self.schema, old, base).join(keys, self.key, "left_anti").unionByName(new)
        _, made = self._write(rows, place)
        large = [r for r in made if r["n"] > 2 * self.rows_per_range]
        if large:
            rows = self.spark.read.schema(self.schema).parquet(*[self.table.path(r["folder"]) for r in large])
            cuts = sorted({*starts, *self._cuts(rows, place)})
            made = [r for r in made if r["n"] <= 2 * self.rows_per_range]
            made += self._write(rows, self._place(cuts))[1]
        self.table.commit(base, dict.fromkeys(old) | self._named(made))
        for path in [work, *[self.table.path(r["folder"]) for r in large]]:
            where, files = self.table._at(path)
            files.delete(where, True)
        return old

    def _keep(self, rows: DataFrame, path: str) -> DataFrame:
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)


def replay_updates(table: KeyedTable, rows: DataFrame) -> DataFrame:
    """Bring ``rows`` into the table by way of updates: a first state without
    every seventh key of them and with the last column of the upper third of the
    keys missing; then the gaps and the missing values are filled."""
    key, last = table.key, table.schema.names[-1]
    top = rows.agg(F.max(key).alias("k")).first()["k"] or 0
    upper = F.col(key) > top * 2 / 3
    gap = F.pmod(F.col(key), F.lit(7)) == 0
    table.build(rows.where(~gap).withColumn(last, F.when(~upper, F.col(last))))
    table.update(upserts=rows.where(gap))
    table.update(upserts=rows.where(upper & ~gap))
    return table.read()
