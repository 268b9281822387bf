"""Readmission flags that are kept up to date when encounters change.

The encounters and their flag are stored in buckets of patients (a versioned
table, see ``wardlens.sources.versions``). A batch of new, changed and removed
encounters can only change the flag of encounters that start within the window
after the discharge of a stay that was added, changed or removed, and of the new
rows themselves. These (patient, day) keys are derived from the batch, decided
again against the patients' stays, and only the buckets of touched patients are
rewritten; all other files stay as they are. Readers see a batch whole or not at
all, and of two batches on one bucket that start from the same version one
fails.

A patient's rows need not fit a task: they meet the decided keys by a join on
(patient, day) whose sides are written tables, so adaptive execution can split
it, and are written after a rebalancing that splits large buckets. Rows without
a patient, which are never flagged, are spread over the buckets by their id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlens import schemas
from wardlens.functions.columns import yes_no
from wardlens.operators.derive import (PRIOR_STAY_TYPE, READMISSION_WINDOW_DAYS,
                                       readmission_days, with_readmission_flag)
from wardlens.session import shared_dir
from wardlens.sources.versions import VersionedTable

KEYS = ["PatientID", "EncounterDate"]


class FlagStore:
    """Encounters with their flag under ``root``, in ``buckets`` buckets."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64,
                 window_days: int = READMISSION_WINDOW_DAYS,
                 prior_type: str = PRIOR_STAY_TYPE):
        self.spark, self.buckets = spark, buckets
        self.window_days, self.prior_type = window_days, prior_type
        self.table = VersionedTable(spark, root)
        self.base = T.StructType(list(schemas.ENCOUNTERS.fields))
        self.schema = T.StructType([*self.base.fields, T.StructField("IsReadmission", T.StringType())])

    def _bucket(self) -> Column:
        key = F.coalesce("PatientID", "EncounterID")
        return F.format_string("%05d", F.pmod(F.xxhash64(key), F.lit(self.buckets)))

    def _write(self, rows: DataFrame, base: int, touched: list[str] | None) -> int:
        """Write rows by bucket and make them live; touched buckets without
        rows go."""
        folder = self.table.new_folder()
        (rows.select(*self.schema.names).withColumn("bucket", self._bucket())
         .hint("rebalance", "bucket").write.partitionBy("bucket").parquet(self.table.path(folder)))
        written = {n.removeprefix("bucket=") for n, _ in self.table._names(self.table.path(folder))
                   if n.startswith("bucket=")}
        names = written if touched is None else set(touched) | written
        return self.table.commit(base, {
            b: f"{folder}/bucket={b}" if b in written else None for b in names})

    def build(self, encounters: DataFrame) -> int:
        """Flag and store all encounters, in place of what is stored."""
        base = self.table.newest()
        flagged = with_readmission_flag(encounters.select(*self.base.names),
                                        window_days=self.window_days, prior_type=self.prior_type)
        return self._write(flagged, base, list(self.table.parts(base)))

    def read(self, buckets: list[str] | None = None, version: int | None = None) -> DataFrame:
        return self.table.read(self.schema, buckets, version)

    def apply(self, upserts: DataFrame | None = None, removed: DataFrame | None = None) -> list[str]:
        """Insert or replace the encounters of ``upserts`` and remove those of
        ``removed`` (EncounterID; unknown ids do nothing, an id in both is
        replaced). Returns the buckets that were rewritten. An id that
        ``upserts`` holds twice is an error."""
        base = self.table.newest()
        work = shared_dir(self.spark, None)
        empty = self.spark.createDataFrame([], self.base)
        new = self._keep((upserts if upserts is not None else empty).select(*self.base.names),
                         f"{work}/new")
        if not new.groupBy("EncounterID").count().where("count > 1").isEmpty():
            raise ValueError("an encounter is given twice")
        ids = new.select("EncounterID")
        if removed is not None:
            ids = ids.unionByName(removed.select("EncounterID"))
        ids = self._keep(ids.where("EncounterID is not null").distinct(), f"{work}/ids")
        old = self._keep(self.read(version=base).join(ids, "EncounterID", "left_semi"), f"{work}/old")
        changed = old.select(*self.base.names).unionByName(new)
        touched = sorted(r[0] for r in changed.select(self._bucket()).distinct().collect())
        if not touched:  # at most one name per bucket came to the driver
            return []
        stored = self.read(touched, base).join(ids, "EncounterID", "left_anti")
        rows = self._keep(stored.unionByName(new.withColumn("IsReadmission", F.lit(None).cast("string"))),
                          f"{work}/rows")
        # Days that the changed stays, as they were or as they are, can flag.
        due = readmission_days(rows, changed, self.window_days, self.prior_type)
        due = due.unionByName(new.select(*KEYS)).where(
            F.col("PatientID").isNotNull() & F.col("EncounterDate").isNotNull()).distinct()
        due = self._keep(due, f"{work}/due")
        own = rows.join(due.select("PatientID").distinct(), "PatientID", "left_semi")
        hits = readmission_days(due, own, self.window_days, self.prior_type, distinct_days=True)
        decided = self._keep(due.join(hits.withColumn("hit", F.lit(True)), KEYS, "left")
                             .select(*KEYS, yes_no(F.col("hit")).alias("now")), f"{work}/decided")
        flagged = rows.join(decided, KEYS, "left").withColumn(
            "IsReadmission", F.coalesce("now", "IsReadmission", F.lit("No")))
        self._write(flagged, base, touched)
        self._discard(work)
        return touched

    def _keep(self, rows: DataFrame, path: str) -> DataFrame:
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def _discard(self, path: str) -> None:
        where, files = self.table._at(path)
        files.delete(where, True)


def replay_changes(store: FlagStore, encounters: DataFrame) -> DataFrame:
    """Bring ``encounters`` into the store by way of changes over the whole
    table: a first state without a tenth of the rows, with a tenth discharged
    later and of another type, and with a tenth twice; then the missing rows
    come, the false ones are corrected and the surplus ones removed."""
    part = F.pmod(F.xxhash64("EncounterID"), F.lit(10))
    full = encounters.select(*store.base.names)
    wrong = full.where(part == 1).withColumns({
        "DischargeDate": F.date_add("DischargeDate", 12),
        "EncounterType": F.when(F.col("EncounterType") == PRIOR_STAY_TYPE, "outpatient")
        .otherwise(PRIOR_STAY_TYPE)})
    surplus = full.where(part == 2).withColumns({
        "EncounterID": -1 - F.col("EncounterID"), "EncounterType": F.lit(PRIOR_STAY_TYPE)})
    store.build(full.where(part > 1).unionByName(wrong).unionByName(surplus))
    store.apply(upserts=full.where(part == 0))
    store.apply(upserts=full.where(part == 1))
    store.apply(removed=surplus.select("EncounterID"))
    return store.read()
