"""Approximate nearest neighbours by multiprobe p-stable hashing.

A table hashes a vector to ``HASHES`` cells floor((a.v + b) / w) with Gaussian
a, which preserves Euclidean distance in expectation (2-stable); the cells
together name a bucket. A query visits its own bucket and, in the order of
estimated success, perturbed ones: moving hash i by one cell costs the squared
distance of the query's projection to that cell's edge, and the ``PROBES``
combinations of least total cost are visited. The candidates of all tables are
merged and ranked by the exact distance in double precision.

Equal vectors are one class with its ``K + 1`` smallest ids: all members have
the same distance and ties go to the smaller id, so no other member can enter a
result (a query's own row takes one place at most). Buckets are dealt to
groups of ``GROUP_ROWS`` rows or so; a bucket that is larger is split over
several groups by id, and probes of it go to each. Every group returns its
``K + 1`` best classes per query, however many tables name them, never all
pairs. A query with fewer than ``K`` neighbours found is searched again over all
rows; ``search`` names these queries apart.

The projections depend on the dimension alone; the width follows the root mean
square length of a bounded sample of ``SAMPLE`` vectors.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components take no part, as query or candidate; rows without id neither; vectors
are compared with those of the same length only; repeated ids are one candidate
at the nearest of their vectors; extra columns are ignored.
"""

from __future__ import annotations

import itertools
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardlens.llm.common import Workspace

K = 10
TABLES = 4
HASHES = 8
WIDTH = 2.0  # times the root mean square length
PROBES = 400
GROUP_ROWS = 20_000
SAMPLE = 1_000
SALTS = 32


@lru_cache(maxsize=16)
def _projections(dim: int, table: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng((dim, table))
    return (rng.normal(size=(dim, HASHES)), rng.uniform(size=HASHES),
            rng.integers(1, 1 << 62, HASHES, dtype=np.int64))


@lru_cache(maxsize=1)
def _moves() -> np.ndarray:
    return np.array(list(itertools.product((-1, 0, 1), repeat=HASHES)), dtype=np.int64)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _by_dimension(batch: pa.RecordBatch, name: str):
    column = batch.column(batch.schema.get_field_index(name))
    sizes = np.diff(column.offsets.to_numpy())
    for dim in np.unique(sizes):
        rows = np.flatnonzero(sizes == dim)
        part = batch.take(pa.array(rows))
        yield int(dim), part, _matrix(part.column(part.schema.get_field_index(name)), int(dim))


def _place(vectors: np.ndarray, dim: int, table: int, width: float) -> np.ndarray:
    a, b, _ = _projections(dim, table)
    return vectors.astype(np.float64) @ a / width + b


def _bucket(cells: np.ndarray, dim: int, table: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (cells * _projections(dim, table)[2]).sum(axis=-1) * 31 + dim


def _hash_rows(width: float):
    schema = pa.schema([("class", pa.int64()), ("tab", pa.int32()), ("bucket", pa.int64())])

    def run(batches):
        for batch in batches:
            for dim, part, vectors in _by_dimension(batch, "vec"):
                for table in range(TABLES):
                    cells = np.floor(_place(vectors, dim, table, width)).astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0), pa.array(np.full(len(vectors), table), pa.int32()),
                         pa.array(_bucket(cells, dim, table))], schema=schema)
    return run


def _probe_rows(width: float):
    schema = pa.schema([("query_id", pa.int64()), ("tab", pa.int32()), ("bucket", pa.int64())])

    def run(batches):
        moves = _moves()
        n = min(PROBES, len(moves))
        for batch in batches:
            for dim, part, vectors in _by_dimension(batch, "vec"):
                for table in range(TABLES):
                    place = _place(vectors, dim, table, width)
                    cells = np.floor(place)
                    inside = place - cells
                    cost = np.stack([inside ** 2, np.zeros_like(inside), (1 - inside) ** 2])
                    cells = cells.astype(np.int64)
                    for q in range(len(vectors)):
                        total = cost[moves + 1, q, np.arange(HASHES)].sum(axis=1)
                        first = np.argpartition(total, n - 1)[:n]
                        keys = np.unique(_bucket(cells[q] + moves[first], dim, table))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(keys), part.column(0)[q].as_py()), pa.int64()),
                             pa.array(np.full(len(keys), table), pa.int32()), pa.array(keys)],
                            schema=schema)
    return run


_BEST = "query_id long, class long, distance double"


def _rank(index: pd.DataFrame, probes: pd.DataFrame, exact: bool) -> pd.DataFrame:
    """The ``K + 1`` nearest classes of each query in one group of rows: a class
    takes one place, though every table brings a row of it. The columns come as
    index: class, bucket, vec; probes: query_id, buckets, qvec."""
    out = []
    sizes = index["vec"].map(len).to_numpy()
    for dim in np.unique(sizes):
        part = index[sizes == dim]
        classes, first, owner = np.unique(part["class"].to_numpy(), return_index=True,
                                          return_inverse=True)
        vectors = np.stack(part["vec"].to_numpy()[first]).astype(np.float64)
        order = np.argsort(part["bucket"].to_numpy(), kind="stable")
        buckets, owner = part["bucket"].to_numpy()[order], owner[order]
        for query_id, wanted, vec in zip(probes["query_id"], probes["buckets"], probes["qvec"]):
            if len(vec) != dim:
                continue
            if exact:
                rows = np.arange(len(classes))
            else:
                lo = np.searchsorted(buckets, wanted, "left")
                size = np.searchsorted(buckets, wanted, "right") - lo
                at = np.repeat(lo - np.cumsum(size) + size, size) + np.arange(size.sum())
                hit = np.zeros(len(classes), dtype=bool)
                hit[owner[at]] = True
                rows = np.flatnonzero(hit)
            if not len(rows):
                continue
            distance = np.sqrt(((vectors[rows] - np.asarray(vec, np.float64)) ** 2).sum(axis=1))
            best = np.lexsort((classes[rows], distance))[:K + 1]
            out.append(pd.DataFrame({"query_id": query_id, "class": classes[rows][best],
                                     "distance": distance[best]}))
    if not out:
        return pd.DataFrame({"query_id": pd.Series(dtype="int64"), "class": pd.Series(dtype="int64"),
                             "distance": pd.Series(dtype="float64")})
    return pd.concat(out, ignore_index=True)


def _best(index: DataFrame, probes: DataFrame, exact: bool = False) -> DataFrame:
    """(query_id, class, distance): the best classes of each group, merged."""
    def run(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return _rank(left, right, exact)

    found = index.groupBy("slot").cogroup(probes.groupBy("slot")).applyInPandas(run, _BEST)
    found = found.groupBy("query_id", "class").agg(F.min("distance").alias("distance"))
    nearest = Window.partitionBy("query_id").orderBy("distance", "class")
    return (found.withColumn("n", F.row_number().over(nearest)).where(F.col("n") <= K + 1)
            .drop("n"))


def _usable(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    vec = F.col(vec_col)
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (rows.where(F.col(id_col).isNotNull() & vec.isNotNull() & finite
                       & F.exists(vec, lambda x: x != 0))
            .select(F.col(id_col).cast("long").alias("vec_id"), vec.cast("array<double>").alias("vec")))


def _classes(rows: DataFrame, work: Workspace) -> DataFrame:
    """(class, ids, vec): equal vectors with their smallest ids; class is the
    smallest. The smallest are taken per salt first."""
    salted = Window.partitionBy("vec", "salt").orderBy("vec_id")
    few = (rows.distinct().withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)))
           .withColumn("n", F.row_number().over(salted)).where(F.col("n") <= K + 1))
    ids = F.slice(F.array_sort(F.collect_list("vec_id")), 1, K + 1)
    grouped = few.groupBy("vec").agg(ids.alias("ids"), F.xxhash64(F.min("vec_id"), "vec").alias("class"))
    return work.keep(grouped, "classes")


def nearest_neighbours(rows: DataFrame, work: Workspace, is_query, id_col: str = "vec_id",
                       vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) of the rows that satisfy ``is_query``
    (a condition on vec_id) against all others."""
    return search(rows, work, is_query, id_col, vec_col)[0]


def search(rows: DataFrame, work: Workspace, is_query, id_col: str = "vec_id",
           vec_col: str = "embedding") -> tuple[DataFrame, DataFrame]:
    """The neighbours, and the queries (query_id, vec) that the buckets left
    with fewer than ``K``: those were answered by an exact scan."""
    usable = work.keep(_usable(rows, id_col, vec_col), "usable")
    classes = _classes(usable, work)
    length = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda t, x: t + x * x))
    mean = (usable.orderBy(F.xxhash64("vec_id")).limit(SAMPLE)
            .agg(F.sqrt(F.avg(length * length))).first()[0])
    width = WIDTH * (mean or 1.0)
    # An id with several vectors asks with each of them; the nearest counts.
    named = work.keep(usable.where(is_query).select(
        F.xxhash64("vec_id", "vec").alias("asked"), F.col("vec_id").alias("query_id"), "vec").distinct(),
        "named")
    queries = work.keep(named.select(F.col("asked").alias("query_id"), "vec"), "queries")
    names = named.select("asked", F.col("query_id").alias("name"))

    def by_id(found: DataFrame) -> DataFrame:
        return found.join(names, F.col("query_id") == F.col("asked")).select(
            F.col("name").alias("query_id"), "class", "distance")


    hashed = work.keep(classes.select("class", "vec").mapInArrow(
        _hash_rows(width), "class long, tab int, bucket long"), "hashed")
    spots = queries.select("query_id", "vec").mapInArrow(
        _probe_rows(width), "query_id long, tab int, bucket long")
    total = hashed.count()
    slots = max(1, -(-total // GROUP_ROWS))
    large = work.keep(hashed.groupBy("tab", "bucket").agg(F.count("*").alias("n"))
                      .where(F.col("n") > GROUP_ROWS)
                      .select("tab", "bucket", F.ceil(F.col("n") / GROUP_ROWS).alias("parts")),
                      "large")
    slot = F.pmod(F.xxhash64("tab", "bucket", "part"), F.lit(slots))
    parts = F.coalesce("parts", F.lit(1)).cast("long")
    index = (hashed.join(large, ["tab", "bucket"], "left")
             .withColumn("part", F.pmod(F.xxhash64("class"), parts))
             .select("class", "bucket", slot.alias("slot")).join(classes.select("class", "vec"), "class"))
    probes = (spots.join(large, ["tab", "bucket"], "left")
              .withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
              .groupBy(slot.alias("slot"), "query_id")
              .agg(F.array_sort(F.collect_set("bucket")).alias("buckets"))
              .join(queries.select("query_id", F.col("vec").alias("qvec")), "query_id"))
    found = work.keep(_best(index, probes), "found")
    ranked = work.keep(_ranked(by_id(found), classes), "ranked")
    short = work.keep(named.join(ranked.where(F.col("rank") == K), "query_id", "left_anti"),
                      "short")
    if short.isEmpty():
        return ranked, short
    every = (classes.withColumn("slot", F.pmod(F.xxhash64("class"), F.lit(slots)))
             .select("class", F.lit(0).cast("long").alias("bucket"), "slot", "vec"))
    asked = short.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slots - 1).cast("long")))
                         .alias("slot"), F.col("asked").alias("query_id"),
                         F.array(F.lit(0).cast("long")).alias("buckets"), F.col("vec").alias("qvec"))
    again = _ranked(by_id(_best(every, asked, exact=True)), classes)
    return ranked.join(short.select("query_id"), "query_id", "left_anti").unionByName(again), short


def _ranked(found: DataFrame, classes: DataFrame) -> DataFrame:
    nearest = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (found.join(classes.select("class", "ids"), "class")
            .select("query_id", F.explode("ids").alias("vec_id"), F.col("distance").alias("score"))
            .where("vec_id <> query_id")
            .groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
            .withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= K)
            .select("query_id", "rank", "vec_id", "score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6: vectors whose id is divisible by 100 against all others."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest_neighbours(rows, Workspace(spark, "ann"), F.col("vec_id") % 100 == 0)
