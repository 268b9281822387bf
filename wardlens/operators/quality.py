"""Data-quality checks that replace the source's declared constraints:
primary and unique keys, foreign keys, NOT NULL, and string lengths.

Each check is a distributed job over whole tables: keys are counted with a
partial (map-side) aggregate, references are tested with an anti join, and
nulls and lengths are measured for all columns of a table in one pass.
"""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlens import schemas
from wardlens.fixed_values import FOREIGN_KEYS, NATURAL_KEYS, PRIMARY_KEYS, UNIQUE_KEYS
from wardlens.sources.model import Tables


def duplicate_keys(df: DataFrame, keys: Sequence[str | Column],
                   nulls_are_violations: bool = True) -> DataFrame:
    """Key values that occur more than once (and, for a primary key, keys
    with a null part).

    → the key columns, Occurrences
    """
    cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    counted = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("Occurrences"))
    names = [c for c in counted.columns if c != "Occurrences"]
    bad = F.col("Occurrences") > 1
    if nulls_are_violations:
        for n in names:
            bad = bad | F.col(n).isNull()
    return counted.where(bad)


def orphans(child: DataFrame, parent: DataFrame, child_key: str,
            parent_key: str | None = None) -> DataFrame:
    """Child rows whose non-null ``child_key`` has no parent row."""
    pk = parent_key or child_key
    keys = parent.select(F.col(pk).alias("_pk"))
    return (child.where(F.col(child_key).isNotNull())
            .join(keys, F.col(child_key) == F.col("_pk"), "left_anti"))


def foreign_key_report(tables: Tables,
                       foreign_keys: Sequence[tuple[str, str, str, str]] = tuple(FOREIGN_KEYS)
                       ) -> DataFrame:
    """One row per foreign key: how many child rows reference a missing parent.

    Every child table is read once: a row is turned into one (key, value) row
    per foreign key, and these are counted before they meet the parents (a
    map-side partial aggregate), so the join moves one row per distinct key and
    a key held by a third of all child rows costs one row. The parents of all
    keys are one table, shuffled once.

    → ChildTable, ChildColumn, ParentTable, Orphans
    """
    known = [k for k in foreign_keys
             if getattr(tables, k[0], None) is not None and getattr(tables, k[2], None) is not None]
    counted = []
    for child_t in dict.fromkeys(k[0] for k in known):
        pairs = [F.struct(F.lit(i).alias("fk"), F.lit(f"{k[2]}.{k[3]}").alias("target"),
                          F.col(k[1]).cast("string").alias("value"))
                 for i, k in enumerate(known) if k[0] == child_t]
        counted.append(getattr(tables, child_t).select(F.inline(F.array(*pairs)))
                       .where("value IS NOT NULL")
                       .groupBy("fk", "target", "value").agg(F.count(F.lit(1)).alias("n")))
    parents = [getattr(tables, t).select(F.lit(f"{t}.{c}").alias("target"),
                                         F.col(c).cast("string").alias("value"))
               for t, c in dict.fromkeys((k[2], k[3]) for k in known)]
    missing = (functools.reduce(DataFrame.unionByName, counted)
               .join(functools.reduce(DataFrame.unionByName, parents), ["target", "value"], "left_anti")
               .groupBy("fk").agg(F.sum("n").alias("Orphans")))
    names = F.array(*[F.struct(F.lit(i).alias("fk"), F.lit(k[0]).alias("ChildTable"),
                               F.lit(k[1]).alias("ChildColumn"), F.lit(k[2]).alias("ParentTable"))
                      for i, k in enumerate(known)])
    spark = getattr(tables, known[0][0]).sparkSession
    return (spark.range(1).select(F.inline(names)).join(missing, "fk", "left")
            .select("ChildTable", "ChildColumn", "ParentTable",
                    F.coalesce("Orphans", F.lit(0)).cast("long").alias("Orphans")))


def _q(name: str) -> str:
    """A column name quoted for a SQL expression."""
    return "`" + name.replace("`", "``") + "`"


def _lit_sql(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


# The per-column reports below build one SQL expression per (column, measure)
# and pass the whole list in a single ``selectExpr``: one plan-building call
# instead of several JVM round trips per column.

def _unpivot(one_row: DataFrame, names: Sequence[str], fields: Sequence[str],
             key_name: str) -> DataFrame:
    """Turn a one-row frame with ``{field}__{name}`` columns into one row per name."""
    structs = ", ".join(
        "struct(" + ", ".join([f"{_lit_sql(n)} AS {_q(key_name)}"]
                              + [f"{_q(f + '__' + n)} AS {_q(f)}" for f in fields]) + ")"
        for n in names)
    return one_row.selectExpr(f"inline(array({structs}))")


def null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null count of each column, measured in one pass.

    → ColumnName, NullCount
    """
    row = df.selectExpr(*[f"count_if({_q(c)} IS NULL) AS {_q('NullCount__' + c)}"
                          for c in columns])
    return _unpivot(row, columns, ["NullCount"], "ColumnName")


def length_violations(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """Per string column: values longer than the declared limit (characters)
    and the longest value seen, in one pass.

    → ColumnName, MaxAllowed, Violations, MaxLength
    """
    aggs = []
    for c, n in limits.items():
        aggs += [f"CAST({int(n)} AS INT) AS {_q('MaxAllowed__' + c)}",
                 f"count_if(length({_q(c)}) > {int(n)}) AS {_q('Violations__' + c)}",
                 f"max(length({_q(c)})) AS {_q('MaxLength__' + c)}"]
    row = df.selectExpr(*aggs)
    return _unpivot(row, list(limits), ["MaxAllowed", "Violations", "MaxLength"],
                    "ColumnName")


def not_null_report(tables: Tables) -> DataFrame:
    """``null_violations`` for every column declared NOT NULL in the model.

    → TableName, ColumnName, NullCount
    """
    parts = []
    for name in tables.names():
        cols = [f.name for f in schemas.CHECKED[name].fields if not f.nullable]
        if cols:
            parts.append(null_violations(getattr(tables, name), cols)
                         .select(F.lit(name).alias("TableName"), "*"))
    return functools.reduce(DataFrame.unionByName, parts)


def length_report(tables: Tables,
                  limits: Mapping[str, Mapping[str, int]] = schemas.VARCHAR_LIMITS
                  ) -> DataFrame:
    """``length_violations`` for every declared string length of the model,
    and of the derived columns that are stored.

    → TableName, ColumnName, MaxAllowed, Violations, MaxLength
    """
    parts = []
    for name in tables.names():
        df = getattr(tables, name)
        stored = {c: n for c, n in schemas.DERIVED_LIMITS.get(name, {}).items() if c in df.columns}
        own = {**limits.get(name, {}), **stored}
        if own:
            parts.append(length_violations(df, own)
                         .select(F.lit(name).alias("TableName"), "*"))
    return functools.reduce(DataFrame.unionByName, parts)


def key_report(tables: Tables) -> DataFrame:
    """Per primary / unique / natural key: distinct key values held by more than
    one row, and rows with a null key part (a violation for primary keys only;
    in a natural key null is a value like others).

    → TableName, KeyColumns, KeyKind, DuplicateKeys, NullKeyRows
    """
    parts = []
    checks = ([(t, k, "primary") for t, k in PRIMARY_KEYS.items()]
              + [(t, k, "unique") for t, k in UNIQUE_KEYS.items()]
              + [(t, k, "natural") for t, k in NATURAL_KEYS.items()])
    for name, keys, kind in checks:
        df = getattr(tables, name, None)
        if df is None:
            continue
        cols = [F.lower(k).alias(k) if k == "SupplyName" else F.col(k) for k in keys]
        counted = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
        any_null = functools.reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
        parts.append(counted.agg(
            F.count_if((F.col("_n") > 1) & (F.lit(kind == "natural") | ~any_null)).alias("DuplicateKeys"),
            (F.coalesce(F.sum(F.when(any_null, F.col("_n"))), F.lit(0))
             if kind == "primary" else F.lit(0).cast("long")).alias("NullKeyRows"))
            .select(F.lit(name).alias("TableName"), F.lit(", ".join(keys)).alias("KeyColumns"),
                    F.lit(kind).alias("KeyKind"), "DuplicateKeys", "NullKeyRows"))
    return functools.reduce(DataFrame.unionByName, parts)
