"""Key and reference checks that are kept up to date batch by batch.

The index holds, for every key that the model declares, how often each value
occurs: in the rows that own the key and in the rows of each column that refers
to it. Values are dealt to buckets by a hash (a versioned table, one part per
key and bucket). A batch of inserted and deleted rows is counted per value
first, and then meets only the buckets of its own values: their counts are
changed, and the verdicts — duplicate values, rows without a key, rows whose
parent is missing — move by the difference that the batch's values make. Verdicts
and counts become visible in one step.

The verdicts equal ``key_report`` and ``foreign_key_report`` over all rows.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlens.fixed_values import FOREIGN_KEYS, PRIMARY_KEYS, UNIQUE_KEYS
from wardlens.session import shared_dir
from wardlens.sources.model import Tables
from wardlens.sources.versions import VersionedTable

OWN = "own"
_INDEX = "target string, role string, value string, n long"
_TOTALS = "verdict string, target string, role string, n long"


def _keys() -> list[tuple[str, str, list[str], str]]:
    """(target, table, columns, kind) of the primary and unique keys."""
    return [(f"{t}.{','.join(k)}", t, k, kind)
            for kind, keys in (("primary", PRIMARY_KEYS), ("unique", UNIQUE_KEYS))
            for t, k in keys.items()]


def _text(columns: list[str]) -> Column:
    """A key's value as text, null if a part is null. Names ignore case."""
    parts = [F.lower(c) if c == "SupplyName" else F.col(c).cast("string") for c in columns]
    if len(parts) == 1:
        return parts[0]
    whole = functools.reduce(lambda a, b: a & b, [p.isNotNull() for p in parts])
    return F.when(whole, F.to_json(F.array(*parts)))


def _uses() -> list[tuple[str, str, str, list[str]]]:
    """(target, role, table, columns) of every declared use of a key; those of
    a target are neighbours, its own first."""
    return [use for target, t, cols, _ in _keys() for use in
            [(target, OWN, t, cols), *[(target, f"{ct}.{cc}", ct, [cc])
                                       for ct, cc, pt, pc in FOREIGN_KEYS if f"{pt}.{pc}" == target]]]


_USES = _uses()
_TARGETS = list(dict.fromkeys(u[0] for u in _USES))
# Places of a target's first use, and how many uses a target has at most.
_FIRST = [[u[0] for u in _USES].index(t) for t in _TARGETS]
_SLOTS = max(b - a for a, b in zip(_FIRST, [*_FIRST[1:], len(_USES)]))
_GONE = "gone"


def _nth(values: list, index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index)


class KeyIndex:
    # Counts that one task merges at a time.
    ROWS_PER_PIECE = 1_000_000

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.spark, self.buckets = spark, buckets
        self.table = VersionedTable(spark, root)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("value"), F.lit(self.buckets)).cast("int")

    @staticmethod
    def _part(target: Column, bucket: Column) -> Column:
        """The part's name: the key and the bucket."""
        return F.concat_ws("-", _nth([t.translate(str.maketrans(".,", "__")) for t in _TARGETS], target),
                           F.format_string("%05d", bucket))

    @staticmethod
    def _counts(tables: Tables, sign: int) -> list[DataFrame]:
        """(use, value, n) of each row's keys: a table is read once for all of them."""
        out = []
        for name in tables.names():
            uses = [F.struct(F.lit(i).alias("use"), _text(cols).alias("value"))
                    for i, (_, _, t, cols) in enumerate(_USES) if t == name]
            if uses:
                out.append(getattr(tables, name).select(F.inline(F.array(*uses)))
                           .select("use", "value", F.lit(sign).cast("long").alias("n")))
        return out

    def _keep(self, rows: DataFrame, path: str) -> DataFrame:
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def _delta(self, rows: list[DataFrame]) -> DataFrame:
        """(use, value, n, target, bucket): what a batch adds to each value's count."""
        counts = (functools.reduce(DataFrame.unionByName, rows).groupBy("use", "value")
                  .agg(F.sum("n").alias("n")).where("n <> 0"))
        return counts.withColumns({
            "target": _nth([_TARGETS.index(u[0]) for u in _USES], F.col("use")),
            "bucket": self._bucket()})

    def _merged(self, before: DataFrame, delta: DataFrame, pieces: list[int]) -> DataFrame:
        """(target, role, value, n, moved, part) of every value of ``before`` and
        ``delta``: its new counts and by how much they move the verdicts. A count
        of which nothing is left is in the part ``gone``. A value's counts meet
        in one shuffle, a bucket in as many pieces as its key has in ``pieces``."""
        none = F.lit(0).cast("long")
        use = F.coalesce(*[F.when((F.col("target") == t) & (F.col("role") == r), F.lit(i))
                           for i, (t, r, _, _) in enumerate(_USES)])
        old = before.select(use.alias("use"), "value", F.col("n").alias("old"), none.alias("new"))
        rows = old.unionByName(delta.select("use", "value", none.alias("old"), F.col("n").alias("new")))
        target = _nth([_TARGETS.index(u[0]) for u in _USES], F.col("use"))
        slot = _nth([i - _FIRST[_TARGETS.index(u[0])] for i, u in enumerate(_USES)], F.col("use"))
        rows = rows.select(target.alias("t"), slot.alias("slot"), "value", "old", "new",
                           self._bucket().alias("bucket"))
        piece = F.pmod(F.xxhash64("value", F.lit(1)), _nth(pieces, F.col("t")).cast("long"))
        met = (rows.withColumn("piece", piece.cast("int")).repartition("t", "bucket", "piece")
               .groupBy("t", "bucket", "piece", "value")
               .agg(*[F.coalesce(F.sum(F.when(F.col("slot") == i, F.col(c))), none).alias(f"{c}{i}")
                      for i in range(_SLOTS) for c in ("old", "new")])
               .withColumns({f"new{i}": F.col(f"old{i}") + F.col(f"new{i}") for i in range(_SLOTS)}))

        def verdict(c: str, i: int) -> Column:
            if i == 0:
                return (F.col(f"{c}0") > 1).cast("long")
            return F.when(F.col(f"{c}0") > 0, none).otherwise(F.col(f"{c}{i}"))
        found = met.select("t", "bucket", "value", F.inline(F.array(*[
            F.struct(F.lit(i).alias("slot"), F.col(f"new{i}").alias("n"),
                     (verdict("new", i) - verdict("old", i)).alias("moved"))
            for i in range(_SLOTS)]))).where("n <> 0 OR moved <> 0")
        return found.select(
            _nth(_TARGETS, F.col("t")).alias("target"),
            _nth([u[1] for u in _USES], _nth(_FIRST, F.col("t")) + F.col("slot")).alias("role"),
            "value", "n", "moved",
            F.when(F.col("n") == 0, F.lit(_GONE)).otherwise(self._part(F.col("t"), F.col("bucket")))
            .alias("part"))

    def apply(self, inserted: Tables | None = None, deleted: Tables | None = None) -> list[str]:
        """Add a batch's rows to the index and take its deleted rows out;
        returns the parts that were read and rewritten."""
        base, work = self.table.newest(), shared_dir(self.spark, None)
        counts = [c for t, s in ((inserted, 1), (deleted, -1)) if t is not None
                  for c in self._counts(t, s)]
        if not counts:
            return []
        delta = self._keep(self._delta(counts), f"{work}/delta")
        named = delta.where("value IS NOT NULL")
        # At most one row per key and bucket comes to the driver.
        sizes = (named.groupBy("target", "bucket").count()
                 .select("target", self._part(F.col("target"), F.col("bucket")), "count").collect())
        touched = sorted(r[1] for r in sizes)
        live = self.table.parts(base)
        before = self.table.read(self.spark.createDataFrame([], _INDEX).schema, touched, base)
        rows = dict.fromkeys(_TARGETS, 0)
        for t, _, n in sizes:
            rows[_TARGETS[t]] += n
        for t, n in before.groupBy("target").count().collect():
            rows[t] += n
        pieces = [1 + n // (self.ROWS_PER_PIECE * self.buckets) for n in rows.values()]
        folder = self.table.new_folder()
        self._merged(before, named, pieces).write.partitionBy("part").parquet(self.table.path(folder))
        written = {n.removeprefix("part=") for n, _ in self.table._names(self.table.path(folder))}
        verdict = F.when(F.col("role") == OWN, F.lit("duplicate")).otherwise(F.lit("orphan"))
        moved = (self.spark.read.schema(_INDEX + ", moved long").parquet(self.table.path(folder))
                 .select(verdict.alias("verdict"), "target", "role", F.col("moved").alias("n")))
        nulls = delta.where("value IS NULL").select(
            F.lit("null").alias("verdict"), _nth(_TARGETS, F.col("target")).alias("target"),
            _nth([u[1] for u in _USES], F.col("use")).alias("role"), "n").where(F.col("role") == OWN)
        totals = self.table.new_folder()
        earlier = self.table.read(self.spark.createDataFrame([], _TOTALS).schema, ["totals"], base)
        (earlier.unionByName(moved).unionByName(nulls).groupBy("verdict", "target", "role")
         .agg(F.sum("n").alias("n"))
         .coalesce(1).write.parquet(self.table.path(totals)))  # one row per declared check
        self.table.commit(base, {
            "totals": totals, **{p: f"{folder}/part={p}" if p in written else None
                                 for p in touched if p in written or p in live}})
        for path in (work, self.table.path(f"{folder}/part={_GONE}")):
            where, files = self.table._at(path)
            files.delete(where, True)
        return touched

    def _totals(self) -> DataFrame:
        return self.table.read(self.spark.createDataFrame([], _TOTALS).schema, ["totals"])

    def key_report(self) -> DataFrame:
        """TableName, KeyColumns, KeyKind, DuplicateKeys, NullKeyRows."""
        rows = [(target, t, ", ".join(k), kind) for target, t, k, kind in _keys()]
        names = self.spark.createDataFrame(
            rows, "target string, TableName string, KeyColumns string, KeyKind string")
        sums = (self._totals().where("role = 'own'").groupBy("target").agg(
            F.sum(F.when(F.col("verdict") == "duplicate", F.col("n"))).alias("d"),
            F.sum(F.when(F.col("verdict") == "null", F.col("n"))).alias("z")))
        none = F.lit(0).cast("long")
        return names.join(sums, "target", "left").select(
            "TableName", "KeyColumns", "KeyKind", F.coalesce("d", none).alias("DuplicateKeys"),
            F.when(F.col("KeyKind") == "primary", F.coalesce("z", none)).otherwise(none)
            .alias("NullKeyRows"))

    def foreign_key_report(self) -> DataFrame:
        """ChildTable, ChildColumn, ParentTable, Orphans."""
        rows = [(f"{pt}.{pc}", f"{ct}.{cc}", ct, cc, pt) for ct, cc, pt, pc in FOREIGN_KEYS]
        names = self.spark.createDataFrame(
            rows, "target string, role string, ChildTable string, ChildColumn string, ParentTable string")
        orphans = self._totals().where("verdict = 'orphan'").select("target", "role", "n")
        return names.join(orphans, ["target", "role"], "left").select(
            "ChildTable", "ChildColumn", "ParentTable",
            F.coalesce("n", F.lit(0).cast("long")).alias("Orphans"))


def _some(tables: Tables, low: int, high: int) -> Tables:
    """The rows of every table whose key falls into some tenths."""
    out = Tables()
    for name in tables.names():
        if name in PRIMARY_KEYS:
            part = F.pmod(F.xxhash64(*PRIMARY_KEYS[name]), F.lit(10))
            setattr(out, name, getattr(tables, name).where((part >= low) & (part < high)))
    return out


def replay_batches(index: KeyIndex, tables: Tables) -> None:
    """All rows of all tables, in batches: most children come before some of
    their parents, a tenth is deleted and comes back."""
    index.apply(inserted=_some(tables, 0, 7))
    index.apply(inserted=_some(tables, 7, 10), deleted=_some(tables, 2, 3))
    index.apply(inserted=_some(tables, 2, 3))
