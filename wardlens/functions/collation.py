"""Text that is compared without regard to case and accents.

The source's tables collate all text so: ``Denied``, ``DÉNIED`` and ``denied``
are one value in ``=``, ``IN``, ``LIKE``, joins, grouping and unique keys. Spark
has such strings as a type; casting a table's string columns to it
(``with_collation``) makes every operator of the library compare that way,
because Spark takes the collation of a column over that of a literal.

What it costs: an equality on a collated column is not pushed into the Parquet
reader as a statistics filter, groups on collated keys are sorted rather than
hashed, and joins compare collation keys. A group is shown by one of its
spellings; ``plain`` turns collated results back into ordinary strings.
Collations compare values of a group, not files: tables are stored as before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlens import schemas
from wardlens.sources.model import Tables

COLLATION = "UNICODE_CI_AI"


def collated(df: DataFrame, columns: list[str] | None = None, collation: str = COLLATION) -> DataFrame:
    """``df`` with its string columns (or the named ones) collated."""
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)
               and (columns is None or f.name in columns)]
    return df.withColumns({c: F.collate(F.col(c), collation) for c in strings}) if strings else df


def plain(df: DataFrame) -> DataFrame:
    """``df`` with ordinary strings."""
    return collated(df, collation="UTF8_BINARY")


def with_collation(tables: Tables, collation: str = COLLATION) -> Tables:
    """The tables with all their text collated."""
    return Tables(**{n: collated(getattr(tables, n), collation=collation) for n in tables.names()})


def collated_schema(name: str, collation: str = COLLATION) -> T.StructType:
    """The declared schema of a table with collated strings, to read or create
    it so."""
    return T.StructType([
        T.StructField(f.name, T.StringType(collation) if isinstance(f.dataType, T.StringType)
                      else f.dataType, f.nullable) for f in schemas.CHECKED[name].fields])
