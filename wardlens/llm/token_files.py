"""Token ids in Parquet: list columns, delta-encoded, in document order.

``write_tokens`` range-partitions the texts by document id, sorts each part and
encodes it with the tokenizers library; a document's ids and the end id are one
list value. Rows carry the part, the row within it and the number of ids, so
metadata can be read without the ids. The files are written with the Parquet
v2 encodings (delta for numbers that dictionaries do not suit), small row groups and
pages and the page index, so a read for some documents skips the pages of the
others.

``read_tokens`` reads chosen columns of chosen documents. ``with_starts`` adds
the number of ids in all documents before each one: totals of the parts (one
row per part) are summed in order, and rows within a part by a window on it.

Defined cases: null text counts as empty and has the end id alone; rows with a
null id come first; rows that share an id stay separate rows in the order of
their texts; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardlens.llm.common import Workspace, ship_package
from wardlens.llm.tokens import cut, gather, library_encoder, steps

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 0
# Text bytes that are cut and encoded at a time.
STEP_BYTES = 8 << 20
FILE_OPTIONS = {"parquet.writer.version": "v2", "parquet.block.size": str(16 << 20),
                "parquet.page.size": str(256 << 10), "compression": "zstd"}
_ROWS = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()),
                   ("ids", pa.list_(pa.int32()))])


def _encode(tokenizer: str, end_id: int, plain: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, row = library_encoder(tokenizer, plain), 0
        for batch in batches:
            for a, b in steps(batch.column(1), STEP_BYTES):
                ids, texts = batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a)
                pieces, doc_ptr = cut(texts)
                coded = pieces.dictionary_encode()
                flat, starts = gather(*encoder.ids(coded.dictionary),
                                      coded.indices.to_numpy(zero_copy_only=False))
                ends = starts[doc_ptr]
                values = np.insert(flat.astype(np.int32), ends[1:], end_id)
                ends = ends + np.arange(len(ends))
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.arange(row, row + b - a), pa.int64()), ids.cast(pa.int64()),
                    pa.array(np.diff(ends), pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))],
                    schema=_ROWS)
                row += b - a
    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str = TOKENIZER, end_id: int = END_ID,
                 id_col: str = "doc_id", text_col: str = "text", plain: bool = False,
                 **options: str) -> None:
    """Write part, row, doc_id, n_tokens and ids of every row in order of id. A
    special token's string in a text gives that token, as the library does by
    default, or is ordinary text if ``plain`` (no document may then write a
    control token into the files)."""
    spark = docs.sparkSession
    ship_package(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    ordered = texts.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    (ordered.mapInArrow(_encode(tokenizer, end_id, plain),
                        "row long, doc_id long, n_tokens long, ids array<int>")
     .select(F.spark_partition_id().alias("part"), "*")
     .write.mode("overwrite").options(**FILE_OPTIONS | options).parquet(path))


def read_tokens(spark: SparkSession, path: str, columns: list[str] | None = None,
                ids: list[int] | None = None) -> DataFrame:
    """Chosen columns, and the rows of chosen documents, of written token files."""
    rows = spark.read.schema(
        "part int, row long, doc_id long, n_tokens long, ids array<int>").parquet(path)
    if ids is not None:
        rows = rows.where(F.col("doc_id").isin(ids))
    return rows.select(*columns) if columns else rows


def with_starts(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """Adds ``start``; ``parts`` holds (part, n_tokens) of all rows."""
    totals = parts.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = totals.select("part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("first"))
    above = Window.partitionBy("part").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    return (rows.withColumn("within", F.coalesce(F.sum("n_tokens").over(above), F.lit(0)))
            .join(first, "part").withColumn("start", F.col("first") + F.col("within"))
            .drop("first", "within"))


def checksums(rows: DataFrame) -> DataFrame:
    """(part, row, doc_id, n_tokens, ids_crc32), counted from the ids read."""
    schema = pa.schema([("part", pa.int32()), ("row", pa.int64()), ("doc_id", pa.int64()),
                        ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(3)
            ends = column.offsets.to_numpy()
            values = column.values.to_numpy(zero_copy_only=False).astype("<u4")
            yield pa.RecordBatch.from_arrays([
                *batch.columns[:3], pa.array(np.diff(ends), pa.int64()),
                pa.array([zlib.crc32(values[a:b].tobytes()) for a, b in zip(ends, ends[1:])],
                         pa.int64())], schema=schema)

    return rows.select("part", "row", "doc_id", "ids").mapInArrow(
        run, "part int, row long, doc_id long, n_tokens long, ids_crc32 long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7: all documents, written and read back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = Workspace(spark, "token-files").path("tokens")
    write_tokens(docs, path)
    read = checksums(read_tokens(spark, path))
    return (with_starts(read, read_tokens(spark, path, ["part", "n_tokens"]))
            .select("doc_id", "start", "n_tokens", "ids_crc32"))
