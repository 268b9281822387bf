"""Readers for the model tables, always with the declared schema."""

from __future__ import annotations

import warnings
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlens import schemas


@dataclass
class Tables:
    """The model: one DataFrame per table (any may be ``None`` if unused)."""

    departments: DataFrame | None = None
    patients: DataFrame | None = None
    staff: DataFrame | None = None
    supplies: DataFrame | None = None
    encounters: DataFrame | None = None
    referrals: DataFrame | None = None
    billing_claims: DataFrame | None = None
    satisfaction_surveys: DataFrame | None = None
    # Written by the library; given only to be checked.
    quality_indicators: DataFrame | None = None

    def names(self) -> list[str]:
        return [f.name for f in fields(self) if getattr(self, f.name) is not None]


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select exactly the schema's columns in its order and types; columns the
    frame lacks become typed nulls."""
    have = set(df.columns)
    cols = []
    for f in schema.fields:
        c = F.col(f.name) if f.name in have else F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def read_table(spark: SparkSession, path: str, name: str, fmt: str = "parquet",
               with_derived: bool = False, **options: str) -> DataFrame:
    """Read one model table from files (parquet, orc, csv, json) with its
    declared schema. CSV needs a header (unless ``header="false"`` is given, for
    files in the declared order); its columns are found by name, in any order,
    others are left out, and a missing one is an error. ``with_derived`` keeps
    the stored derived columns (``schemas.DERIVED``) that the files really have:
    one read as all null would be taken for a stored value."""
    fields = list(schemas.MODEL[name].fields)
    header = fmt == "csv" and str(options.get("header", "true")).lower() == "true"
    if fmt == "csv":
        options = {"header": "true", **options}
    derived = schemas.DERIVED.get(name, []) if with_derived else []
    if derived or header:
        present = spark.read.format(fmt).options(**options).load(path).columns
        fields += [f for f in derived if f.name in present]
    wanted = T.StructType(fields)
    schema = wanted
    if header:
        missing = [f.name for f in fields if f.name not in present]
        if missing:
            raise ValueError(f"{path}: no column {', '.join(missing)}")
        schema = T.StructType([wanted[c] if c in wanted.names else T.StructField(c, T.StringType())
                               for c in present])
    reader = spark.read.schema(schema).format(fmt).options(**options)
    return reader.load(path).select(*wanted.names)


def read_tables(spark: SparkSession, root: str, fmt: str = "parquet",
                names: list[str] | None = None, suffix: str = "",
                missing_ok: bool = False, with_derived: bool = False,
                **options: str) -> Tables:
    """Read ``{root}/{table}{suffix}`` for each model table; with
    ``missing_ok`` a table whose folder does not exist is left ``None``, with a
    warning that names it (any other fault is raised); ``with_derived`` keeps
    stored derived columns, which the operators then use instead of deriving
    them."""
    out = Tables()
    for name in names or list(schemas.MODEL):
        path = f"{root.rstrip('/')}/{name}{suffix}"
        if missing_ok:
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            files = where.getFileSystem(spark._jsc.hadoopConfiguration())
            if not files.exists(where):
                warnings.warn(f"table {name} is missing: no {path}", stacklevel=2)
                continue
        setattr(out, name, read_table(spark, path, name, fmt, with_derived, **options))
    return out


def read_jdbc(spark: SparkSession, url: str, name: str, properties: dict[str, str],
              partition_column: str | None = None, lower: int | None = None,
              upper: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """Read one model table from a relational database over JDBC.

    Pass ``partition_column`` (usually the table key) with ``lower``, ``upper``
    and ``num_partitions`` so the read is split into parallel range queries;
    without it one task pulls the whole table.
    """
    if partition_column and (lower is None or upper is None):
        raise ValueError("partition_column needs lower and upper")
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", name)
    for k, v in properties.items():
        reader = reader.option(k, v)
    if partition_column:
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", str(lower)).option("upperBound", str(upper))
                  .option("numPartitions", str(num_partitions or 8)))
    return conform(reader.load(), schemas.MODEL[name])


def write_tables(tables: Tables, root: str, mode: str = "overwrite",
                 cluster_by: dict[str, str] | None = None,
                 files: dict[str, int] | None = None) -> None:
    """Write every table to ``{root}/{name}`` as Parquet.

    ``cluster_by={"encounters": "EncounterDate"}`` range-partitions that table
    on the column and sorts each file by it, so the Parquet min/max statistics
    of files and row groups let range filters on the column (reporting
    periods) skip most of the data. ``files`` sets the number of output files
    per clustered table (default: ``spark.sql.shuffle.partitions``).
    """
    for name in tables.names():
        df = getattr(tables, name)
        col = (cluster_by or {}).get(name)
        if col:
            n = (files or {}).get(name)
            df = (df.repartitionByRange(n, col) if n else df.repartitionByRange(col))
            df = df.sortWithinPartitions(col)
        df.write.mode(mode).parquet(f"{root.rstrip('/')}/{name}")


# Join keys the reports shuffle on most: claims and surveys meet encounters on
# EncounterID (after a per-encounter aggregate), patients meet on PatientID.
BUCKET_KEYS = {"encounters": "EncounterID", "billing_claims": "EncounterID",
               "satisfaction_surveys": "EncounterID", "patients": "PatientID"}


def save_bucketed(tables: Tables, database: str, buckets: int,
                  keys: dict[str, str] | None = None, location: str | None = None) -> None:
    """Save the model as catalog tables, bucketed (and sorted) on its join
    keys, so joins and aggregates on those keys read co-partitioned buckets
    instead of shuffling. All bucketed tables share ``buckets``; ``location``
    places the database in shared storage."""
    keys = BUCKET_KEYS if keys is None else keys
    names = tables.names()
    if not names:
        return
    spark = getattr(tables, names[0]).sparkSession
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{where}")
    for name in names:
        w = getattr(tables, name).write.mode("overwrite").format("parquet")
        if name in keys:
            w = w.bucketBy(buckets, keys[name]).sortBy(keys[name])
        w.saveAsTable(f"{database}.{name}")


def read_catalog(spark: SparkSession, database: str) -> Tables:
    """The model tables of a catalog database (bucketing is kept)."""
    out = Tables()
    for name in schemas.MODEL:
        if spark.catalog.tableExists(f"{database}.{name}"):
            setattr(out, name, spark.table(f"{database}.{name}"))
    return out
