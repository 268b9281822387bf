"""Token counts by source, language and tokenizer version, kept by deltas.

The ledger is a list of committed batches. A batch is a table of signed
changes: +1 for a document that comes, -1 for one that goes; a revised count is
its old count with -1 and its new one with +1. A commit adds the changes up
(partial sums per task first, so a source with a third of all rows is no hot
task) and stores one row per source, language and tokenizer. As counts are
additive, totals are the sum over committed batches, in any order.

Commits are idempotent by batch id: a batch is written aside, and then the list
of batches with its id is put in place of the list without it in one step
(``wardlens.sources.versions``). If the id is there already, or comes by another
writer, nothing is added. A failed commit leaves no part of itself in the totals,
and can be repeated. ``compact`` folds all batches into one table, so totals need
not read all of history, and keeps their ids.

Defined cases: null text counts 0 tokens and 1 document; null source or language
is a group of its own; repeated rows count as often as they occur; an empty
batch is committed and changes nothing; groups whose documents have all gone
have no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlens.llm.common import Workspace, ship_package
from wardlens.llm.tokens import cut, rank_encoder, steps
from wardlens.sources.versions import Conflict, VersionedTable

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
VERSION = "byte_bpe_50k"
STEP_BYTES = 8 << 20
GROUP = ["source", "lang", "tokenizer"]


def count_tokens(docs: DataFrame, ranks: str = RANKS, pattern: str = PATTERN,
                 version: str = VERSION) -> DataFrame:
    """(doc_id, source, lang, tokenizer, n_tokens) of every document row."""
    ship_package(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("source", pa.string()), ("lang", pa.string()),
                        ("n_tokens", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = rank_encoder(ranks, pattern)
        for batch in batches:
            for a, b in steps(batch.column(3), STEP_BYTES):
                part = batch.slice(a, b - a)
                pieces, ptr = cut(part.column(3))
                coded = pieces.dictionary_encode()
                sizes = np.diff(encoder.ids(coded.dictionary)[1])
                index = coded.indices.to_numpy(zero_copy_only=False)
                total = np.concatenate(([0], np.cumsum(sizes[index])))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], pa.array(np.diff(total[ptr]), pa.int64())], schema=schema)

    return (docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"),
                        F.col("lang").cast("string"), "text")
            .mapInArrow(run, "doc_id long, source string, lang string, n_tokens long")
            .select("doc_id", "source", "lang", F.lit(version).alias("tokenizer"), "n_tokens"))


def inserts(counts: DataFrame) -> DataFrame:
    return counts.select(*GROUP, "n_tokens", F.lit(1).alias("sign"))


def deletes(counts: DataFrame) -> DataFrame:
    return counts.select(*GROUP, "n_tokens", F.lit(-1).alias("sign"))


def revisions(old: DataFrame, new: DataFrame) -> DataFrame:
    """The changes that replace the ``old`` counts of documents by the ``new``."""
    return deletes(old).unionByName(inserts(new))


class Ledger:
    """Committed batches of signed changes in a folder that executors share."""

    SCHEMA = "source string, lang string, tokenizer string, n_docs long, n_tokens long"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.table = spark, VersionedTable(spark, path)

    def is_committed(self, batch_id: str) -> bool:
        return batch_id in self.table.parts()

    def _write(self, rows: DataFrame) -> str:
        folder = self.table.new_folder()
        rows.write.parquet(self.table.path(folder))
        return folder

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Add a batch; False if it had been committed before, or is by another
        writer meanwhile."""
        if not batch_id or not all(c.isalnum() or c in "-_." for c in batch_id) or batch_id[0] in "._":
            raise ValueError("a batch id is letters, digits, '-', '_' and '.', not '.' or '_' first")
        base = self.table.newest()
        if batch_id in self.table.parts(base):
            return False
        folder = self._write(
            changes.groupBy(*GROUP)
            .agg(F.sum("sign").cast("long").alias("n_docs"),
                 F.sum(F.col("sign") * F.col("n_tokens")).alias("n_tokens")))
        try:
            self.table.commit(base, {batch_id: folder})
        except Conflict:
            return False
        return True

    def _sums(self, version: int) -> DataFrame:
        folders = sorted({f for f in self.table.parts(version).values() if f})
        if not folders:
            return self.spark.createDataFrame([], self.SCHEMA)
        rows = self.spark.read.schema(self.SCHEMA).parquet(*map(self.table.path, folders))
        return (rows.groupBy(*GROUP)
                .agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
                .where("n_docs <> 0 or n_tokens <> 0"))

    def compact(self) -> None:
        """Fold the committed batches into one table; their ids stay known.
        Batches that are committed meanwhile stay as they are."""
        base = self.table.newest()
        batches = sorted(b for b, f in self.table.parts(base).items() if f)
        if len(batches) > 1:
            folder = self._write(self._sums(base))
            self.table.commit(base, {b: folder if i == 0 else "" for i, b in enumerate(batches)})

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer, n_docs, n_tokens) over committed batches."""
        return self._sums(self.table.newest())


def replay(ledger: Ledger, counts: DataFrame) -> None:
    """Commit ``counts`` in batches over four parts of the documents, dealt by
    id: two loads, the second with part 3 counted with an end token each; part
    1 goes, part 3 is revised to its counts, part 1 comes back. Some batches
    are sent twice. The totals are those of ``counts``."""
    part = F.pmod(F.xxhash64("doc_id"), F.lit(4))
    gone, revised = counts.where(part == 1), counts.where(part == 3)
    provisional = revised.withColumn("n_tokens", F.col("n_tokens") + 1)
    batches = [
        ("load-1", inserts(counts.where(part < 2))),
        ("load-2", inserts(counts.where(part == 2)).unionByName(inserts(provisional))),
        ("delete-1", deletes(gone)),
        ("revise-1", revisions(provisional, revised)),
        ("load-3", inserts(gone)),
    ]
    for batch_id, changes in batches:
        ledger.commit(batch_id, changes)
    ledger.compact()
    for batch_id, changes in batches[:3]:
        ledger.commit(batch_id, changes)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9: all documents, committed in loads, deletes and revisions; the totals."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    work = Workspace(spark, "token-counts")
    ledger = Ledger(spark, work.path("ledger"))
    replay(ledger, work.keep(count_tokens(docs), "counts"))
    return ledger.totals()
