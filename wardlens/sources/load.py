"""Loading raw text files into the model with a quarantine for bad rows.

One pass reads a table's CSV or JSON files as text columns, casts every column
to its declared type and tests the declared constraints (not null, string
lengths). A row that passes goes to the table, any other to the rejects, with
its raw values, its file and all reasons. Both are written from the same pass;
rows in are rows out plus rejects. Lines that are no records at all (broken
JSON) are rejects too. The load fails, and the table is left as it was, if the
rejects exceed a share of the rows that the caller states.

Text that is empty or only blanks is null for every type but string. Numbers,
dates and truth values are cast as Spark casts them; a value that does not cast
is a reason of its own, and is not at the same time a missing value.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlens import schemas
from wardlens.sources.versions import VersionedTable

RAW_LINE = "_line"
REJECTS = T.StructType([
    T.StructField("TableName", T.StringType()), T.StructField("File", T.StringType()),
    T.StructField("Reasons", T.ArrayType(T.StringType())),
    T.StructField("Row", T.MapType(T.StringType(), T.StringType()))])


class TooManyRejects(ValueError):
    """More rows were rejected than the caller allows."""


@dataclass(frozen=True)
class Loaded:
    rows_in: int
    rows_out: int
    rejects: int
    folder: str


def read_raw(spark: SparkSession, path: str, name: str, fmt: str = "csv",
             **options: str) -> DataFrame:
    """The table's columns as text, the line of a broken record in ``_line``,
    and the file. CSV columns are found by their header."""
    fields = [T.StructField(f.name, T.StringType()) for f in schemas.MODEL[name].fields]
    if fmt == "csv":
        options = {"header": "true", **options}
        header = spark.read.format("csv").options(**{**options, "inferSchema": "false"}).load(path).columns
        missing = [f.name for f in fields if f.name not in header]
        if missing:
            raise ValueError(f"{path}: no column {', '.join(missing)}")
        fields = [T.StructField(c, T.StringType()) for c in header]
    elif fmt != "json":
        raise ValueError("raw files are csv or json")
    schema = T.StructType([*fields, T.StructField(RAW_LINE, T.StringType())])
    rows = (spark.read.format(fmt).schema(schema).options(**options)
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RAW_LINE).load(path))
    wanted = [f.name for f in schemas.MODEL[name].fields]
    return rows.select(*wanted, RAW_LINE, F.col("_metadata.file_path").alias("_file"))


def _value(f: T.StructField) -> tuple[Column, Column]:
    """A column's typed value, and whether its text is there but does not cast."""
    raw = F.col(f.name)
    if isinstance(f.dataType, T.StringType):
        return raw, F.lit(False)
    text = F.when(F.trim(raw) != "", F.trim(raw))
    value = text.try_cast(f.dataType)
    return value, text.isNotNull() & value.isNull()


def checked(raw: DataFrame, name: str) -> DataFrame:
    """The typed columns, and ``_reasons``: what each row violates, in the order
    of the columns (empty: the row is good)."""
    limits = schemas.VARCHAR_LIMITS.get(name, {})
    reasons = [F.when(F.col(RAW_LINE).isNotNull(), F.lit("not a record"))]
    typed = []
    for f in schemas.MODEL[name].fields:
        value, broken = _value(f)
        kind = f.dataType.simpleString()
        reasons.append(F.when(broken, F.lit(f"{f.name} is no {kind}")))
        if not f.nullable:
            reasons.append(F.when(value.isNull() & ~broken, F.lit(f"{f.name} is missing")))
        if f.name in limits:
            reasons.append(F.when(F.char_length(value) > limits[f.name],
                                  F.lit(f"{f.name} is longer than {limits[f.name]}")))
        typed.append(value.alias(f.name))
    row = F.map_from_arrays(
        F.array(*[F.lit(c) for c in (*schemas.MODEL[name].names, RAW_LINE)]),
        F.array(*[F.col(c) for c in (*schemas.MODEL[name].names, RAW_LINE)]))
    return raw.select(*typed, F.array_compact(F.array(*reasons)).alias("_reasons"),
                      F.col("_file"), row.alias("_row"))


def load_table(spark: SparkSession, path: str, name: str, root: str, fmt: str = "csv",
               max_reject_share: float = 0.0, part: str | None = None, **options: str) -> Loaded:
    """Load files into the versioned table ``{root}/{name}`` as one part (named
    ``part``, new by default; a load under a known name replaces it) and their
    rejects into ``{root}/{name}_rejects``. Both become visible after the share
    of rejects has been checked; beyond it ``TooManyRejects`` names the most
    frequent reasons and nothing changes but the rejects, which stay to be read.
    """
    good, bad = (VersionedTable(spark, f"{root.rstrip('/')}/{n}") for n in (name, f"{name}_rejects"))
    part, folder = part or uuid.uuid4().hex, good.new_folder()
    bases = good.newest(), bad.newest()
    rows = checked(read_raw(spark, path, name, fmt, **options), name)
    split = rows.withColumn("good", F.size("_reasons") == 0)
    split.write.partitionBy("good").parquet(good.path(f"{folder}/all"))
    read = spark.read.schema(split.schema).parquet(good.path(f"{folder}/all"))
    counts = {r["good"]: r["n"] for r in read.groupBy("good").agg(F.count(F.lit(1)).alias("n")).collect()}
    out, rejected = counts.get(True, 0), counts.get(False, 0)
    if rejected:
        refused = bad.new_folder()
        read.where("not good").select(F.lit(name).alias("TableName"), F.col("_file").alias("File"),
                                      F.col("_reasons").alias("Reasons"), F.col("_row").alias("Row")) \
            .write.parquet(bad.path(refused))
        bad.commit(bases[1], {part: refused})
    if rejected > max_reject_share * (out + rejected):
        top = (read.where("not good").select(F.explode("_reasons").alias("r")).groupBy("r").count()
               .orderBy(F.desc("count"), "r").limit(5).collect())
        raise TooManyRejects(f"{rejected} of {out + rejected} rows of {path} rejected: "
                             + "; ".join(f"{r['r']} ({r['count']})" for r in top))
    live = f"{folder}/all/good=true"
    good.commit(bases[0], {part: live if out else None})
    return Loaded(out + rejected, out, rejected, good.path(live))


def read_loaded(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The good rows of all loads of a table."""
    return VersionedTable(spark, f"{root.rstrip('/')}/{name}").read(
        T.StructType([T.StructField(f.name, f.dataType) for f in schemas.MODEL[name].fields]))


def read_rejects(spark: SparkSession, root: str, name: str) -> DataFrame:
    """TableName, File, Reasons, Row (raw text by column) of all rejected rows."""
    return VersionedTable(spark, f"{root.rstrip('/')}/{name}_rejects").read(REJECTS)
