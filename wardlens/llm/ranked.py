"""Ranked lexical search over K2-treaps of the term-document grid.

Documents are cut into blocks of a bounded number of text bytes. A block's grid
has a row for each of its terms, the most frequent first, and a column for each
of its documents; a cell holds the impact of the term in the document. The grid
is a compressed quadtree: every node keeps four bits for its non-empty quadrants
and, as the difference to its parent, the greatest impact below it.

A search descends the row paths of all terms of an item together. A state is a
range of documents with one tree node per term that occurs in it; the weighted
sum of the nodes' maxima bounds the score of every document of the range, and
is the score itself at a single document. States are opened in order of their
bounds, a batch at a time and all items of a chunk side by side; a state goes
when its bound is below the item's k-th score so far, which the searches of a
task hand on from block to block. The best of all blocks are ranked by a window.

Impacts are integers that depend on two totals of the corpus, so the blocks'
postings are written first and the trees are built when the totals are known.
Document frequencies are summed for the items' terms alone. Items meet blocks
in chunks over an equi-join on buckets.

Defined cases: null and empty texts have no terms; documents without an id
cannot be named and are left out of all counts; rows that share a document id
are documents of their own; rows that share an item id are one item with all
their terms, rows without one are left out; equal scores are ranked by document
id; an item that nothing matches has no rows; a text longer than a block is a
block of its own; extra columns are ignored; empty tables give empty results.
"""

from __future__ import annotations

import hashlib
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardlens.llm.common import Workspace, ascii_lower, give_back, split_words
from wardlens.llm.tokens import steps

SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TOP = 20
# Text bytes of a block, and items that are searched side by side.
BLOCK_BYTES = 8 << 20
CHUNK_ITEMS = 128
# States opened per item in a round: while the first ones go down, and at most.
FIRST_BATCH, MOST_BATCH = 32, 1024

_WORD = np.ones(256, dtype=bool)
_WORD[:128] = [chr(b) in string.ascii_letters + string.digits for b in range(128)]
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_BITS = np.array([bin(i).count("1") for i in range(16)], dtype=np.int64)

_POSTINGS = "block long, n_docs long, n_terms long, terms array<string>, df array<int>, body binary"
_POSTINGS_SCHEMA = pa.schema([
    ("block", pa.int64()), ("n_docs", pa.int64()), ("n_terms", pa.int64()),
    ("terms", pa.list_(pa.string())), ("df", pa.list_(pa.int32())), ("body", pa.binary())])


def pack(*arrays: np.ndarray) -> bytes:
    """Integer arrays, each as compressed planes of bytes."""
    parts = []
    for a in arrays:
        planes = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T
        data = pa.compress(planes.tobytes(), codec="zstd", asbytes=True)
        parts.append(f"{a.dtype.str},{len(a)},{len(data)};".encode() + data)
    return b"".join(parts)


def unpack(packed: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(packed):
        end = packed.index(b";", at)
        kind, n, size = packed[at:end].decode().split(",")
        dtype, n, at = np.dtype(kind), int(n), end + 1 + int(size)
        raw = pa.decompress(packed[end + 1:at], n * dtype.itemsize, codec="zstd", asbytes=True)
        planes = np.frombuffer(raw, np.uint8).reshape(dtype.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).view(dtype).reshape(n))
    return out


def text_terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """The text and the term of every occurrence, and the distinct terms."""
    column = pa.array(pc.fill_null(texts.cast(pa.large_binary()), b""))
    offsets = np.frombuffer(column.buffers()[1], np.int64)[
        column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw if raw is not None else b"", np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    inside = np.zeros(len(data) + 1, dtype=bool)
    inside[:-1] = _WORD[data]
    joined = np.zeros(len(data) + 1, dtype=bool)  # to the byte before
    joined[1:-1] = inside[1:-1] & inside[:-2]
    joined[offsets] = False
    starts = np.flatnonzero(inside & ~joined)
    kept = inside[:-1]
    ptr = np.append(np.cumsum(kept)[starts] - 1, np.count_nonzero(kept)) if len(starts) \
        else np.zeros(1, np.int64)
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts),
        [None, pa.py_buffer(ptr.astype(np.int64)), pa.py_buffer(_LOWER[data[kept]])])
    coded = words.dictionary_encode()
    doc = np.searchsorted(offsets, starts, side="right") - 1
    return doc, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), \
        coded.dictionary.to_pylist()


def _to_postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per block: its terms, and its (term, document, count) cells."""
    for batch in batches:
        for a, b in steps(batch.column(1), BLOCK_BYTES):
            ids = batch.column(0).slice(a, b - a).to_numpy(zero_copy_only=False).astype(np.int64)
            doc, term, names = text_terms(batch.column(1).slice(a, b - a))
            if not len(names):
                continue
            length = np.bincount(doc, minlength=len(ids))
            cell, tf = np.unique(doc * len(names) + term, return_counts=True)
            doc, term = np.divmod(cell, len(names))
            df = np.bincount(term, minlength=len(names))
            order = np.lexsort((np.arange(len(names)), -df))
            row = np.empty(len(names), dtype=np.int64)
            row[order] = np.arange(len(names))
            body = pack(ids, length, row[term].astype(np.uint32), doc.astype(np.uint32),
                        tf.astype(np.int64))
            name = hashlib.blake2b(body, digest_size=8).digest()
            yield pa.RecordBatch.from_arrays([
                pa.array([int.from_bytes(name, "little", signed=True)], pa.int64()),
                pa.array([int(np.count_nonzero(length))], pa.int64()),
                pa.array([int(length.sum())], pa.int64()),
                pa.array([[names[i].decode("utf-8", "replace") for i in order]],
                         pa.list_(pa.string())),
                pa.array([df[order].tolist()], pa.list_(pa.int32())),
                pa.array([body], pa.binary())], schema=_POSTINGS_SCHEMA)


def _spread(x: np.ndarray) -> np.ndarray:
    """Bits of 32-bit numbers on the even places of 64-bit ones."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
                        (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


def build_tree(row: np.ndarray, col: np.ndarray, value: np.ndarray) -> bytes:
    """The packed quadtree of a grid's cells (each at most once): its height and
    greatest value, the quadrant bits of all inner nodes from the root down, and
    what each other node's maximum is below its parent's."""
    height = max(int(max(row.max(), col.max())).bit_length(), 1)
    code = (_spread(row) << np.uint64(1)) | _spread(col)
    order = np.argsort(code)
    code, value = code[order], value[order]
    quadrants, below = [], []
    for _ in range(height):
        up = code >> np.uint64(2)
        fresh = np.ones(len(up), dtype=bool)
        fresh[1:] = up[1:] != up[:-1]
        starts = np.flatnonzero(fresh)
        top = np.maximum.reduceat(value, starts)
        below.append(np.repeat(top, np.diff(np.append(starts, len(up)))) - value)
        quadrants.append(np.add.reduceat(
            np.left_shift(1, (code & np.uint64(3)).astype(np.uint8)).astype(np.uint8), starts))
        code, value = up[starts], top
    return pack(np.array([height, int(value[0])], np.int64),
                np.concatenate(quadrants[::-1]).astype(np.uint8),
                np.concatenate(below[::-1]).astype(np.uint32))


class Tree:
    """A quadtree ready to be descended. Nodes are numbered level by level; the
    children of inner node v are first[v] and the numbers after it."""

    def __init__(self, packed: bytes):
        (self.height, top), self.quadrants, below = unpack(packed)
        self.height = int(self.height)
        sizes = _BITS[self.quadrants]
        self.first = np.empty(len(sizes) + 1, dtype=np.int64)
        self.first[0] = 1
        np.cumsum(sizes, out=self.first[1:])
        self.first[1:] += 1
        self.greatest = np.empty(len(below) + 1, dtype=np.int64)
        self.greatest[0] = top
        a, b = 0, 1  # the nodes of a level
        for _ in range(self.height):
            c = int(self.first[b])
            self.greatest[b:c] = np.repeat(self.greatest[a:b], sizes[a:b]) - below[b - 1:c - 1]
            a, b = b, c

    def children(self, nodes: np.ndarray, quadrant: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which nodes have that quadrant, and the children of those."""
        bits = self.quadrants[nodes].astype(np.int64)
        has = (bits >> quadrant) & 1 == 1
        bits, quadrant = bits[has], quadrant[has]
        return has, self.first[nodes[has]] + _BITS[bits & ((1 << quadrant) - 1)]


def _best(group: np.ndarray, *keys: np.ndarray, most: int) -> np.ndarray:
    """Places of the first ``most`` of every group by ascending keys."""
    order = np.lexsort((*keys[::-1], group))
    sorted_group = group[order]
    fresh = np.ones(len(order), dtype=bool)
    fresh[1:] = sorted_group[1:] != sorted_group[:-1]
    starts = np.flatnonzero(fresh)
    rank = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
    return order[rank < most]


def search(tree: Tree, row: np.ndarray, weight: np.ndarray, item: np.ndarray, least: np.ndarray,
           ids: np.ndarray, top: int = TOP) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(item, column, score) of each item's best columns. ``row``, ``weight``
    and ``item`` list the terms of all items, in order of item; ``least`` holds
    for every item a score below which nothing is wanted, ``ids`` breaks ties."""
    least = np.maximum(least, 1)
    found = tuple(np.zeros(0, np.int64) for _ in range(3))
    # States: an item, a depth, a column prefix, a bound and a run of (node, term).
    owner, size = np.unique(item, return_counts=True)
    depth, col = np.zeros(len(owner), np.int64), np.zeros(len(owner), np.int64)
    node, term = np.zeros(len(item), np.int64), np.arange(len(item))
    bound = np.bincount(item, weight, len(least)).astype(np.int64)[owner] * tree.greatest[0]
    batch, rounds = FIRST_BATCH, 0
    while len(owner):
        opened = np.zeros(len(owner), dtype=bool)
        opened[_best(owner, -bound, most=batch)] = True
        runs = np.repeat(opened, size)
        closed = (owner[~opened], depth[~opened], col[~opened], bound[~opened], size[~opened])
        closed_runs = node[~runs], term[~runs]
        owner, depth, col, size = owner[opened], depth[opened], col[opened], size[opened]
        node, term = node[runs], term[runs]
        state = np.repeat(np.arange(len(owner)), size)
        high = (row[term] >> (tree.height - 1 - depth[state])) & 1
        states, run_parts = [closed], [closed_runs]
        for side in (0, 1):
            has, child = tree.children(node, 2 * high + side)
            at, t = state[has], term[has]
            count = np.bincount(at, minlength=len(owner))
            total = np.concatenate(([0], np.cumsum(weight[t] * tree.greatest[child])))
            ends = np.cumsum(count)
            score = total[ends] - total[ends - count]
            good = (count > 0) & (score >= least[owner])
            leaf = good & (depth + 1 == tree.height)
            if leaf.any():
                found = tuple(np.concatenate(x) for x in zip(
                    found, (owner[leaf], 2 * col[leaf] + side, score[leaf])))
            good &= ~leaf
            states.append((owner[good], depth[good] + 1, 2 * col[good] + side, score[good],
                           count[good]))
            run_parts.append((child[good[at]], t[good[at]]))
        if len(found[0]):
            kept = _best(found[0], -found[2], ids[found[1]], most=top)
            found = tuple(x[kept] for x in found)
            held = np.bincount(found[0], minlength=len(least))
            lowest = np.full(len(least), np.iinfo(np.int64).max)
            np.minimum.at(lowest, found[0], found[2])
            least = np.where(held >= top, np.maximum(least, lowest), least)
        owner, depth, col, bound, size = (np.concatenate(x) for x in zip(*states))
        node, term = (np.concatenate(x) for x in zip(*run_parts))
        alive = bound >= least[owner]
        runs = np.repeat(alive, size)
        owner, depth, col, bound, size = (x[alive] for x in (owner, depth, col, bound, size))
        node, term = node[runs], term[runs]
        rounds += 1
        if rounds > tree.height:
            batch = min(2 * batch, MOST_BATCH)
    return found


def _to_trees(n_docs: int, n_terms: int):
    """Impacts, now that the corpus's totals are known, and their trees."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, terms, body in zip(*batch.columns):
                ids, length, row, doc, tf = unpack(body.as_py())
                m = 75 + (25 * length[doc] * n_docs) // n_terms
                impact = (1_000_000_000 * tf) // (1000 * tf + 12 * m)
                yield pa.RecordBatch.from_arrays([
                    pa.array([block.as_py()], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, len(terms)], pa.int32()), terms.values),
                    pa.array([pack(ids)], pa.binary()),
                    pa.array([build_tree(row, doc, impact)], pa.binary())],
                    names=["block", "terms", "ids", "tree"])
    return run


def build_index(docs: DataFrame, work: Workspace, id_col: str = "doc_id",
                text_col: str = "text") -> tuple[DataFrame, DataFrame, int]:
    """The trees (block, terms, ids, tree), the frequencies (terms, df) of each
    block's terms, and the number of documents that have terms."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                        F.col(text_col).alias("text")).where("doc_id is not null")
    postings = work.keep(texts.mapInArrow(give_back(_to_postings), _POSTINGS), "postings")
    total = postings.agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("l")).first()
    trees = postings.select("block", "terms", "body").mapInArrow(
        give_back(_to_trees(total["n"] or 0, total["l"] or 0)),
        "block long, terms array<string>, ids binary, tree binary")
    return work.keep(trees, "trees"), postings.select("terms", "df"), total["n"] or 0


def item_terms(items: DataFrame, frequencies: DataFrame, n_docs: int, work: Workspace,
               id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, term, weight): an item's distinct terms that documents hold,
    each with its weight times its occurrences in the item."""
    words = split_words(ascii_lower(F.col(text_col)), SEPARATORS)
    counted = work.keep(
        items.select(F.col(id_col).cast("long").alias("item_id"), F.explode(words).alias("term"))
        .where("item_id is not null").groupBy("item_id", "term").agg(F.count("*").alias("qtf")),
        "item-terms")
    df = (frequencies.select(F.explode(F.arrays_zip("terms", "df")).alias("t"))
          .select(F.col("t.terms").alias("term"), F.col("t.df").alias("df"))
          .join(counted.select("term").distinct(), "term", "left_semi")
          .groupBy("term").agg(F.sum("df").alias("df")))
    weight = F.floor(1000 * F.log((2 * F.lit(n_docs) + 2) / (2 * F.col("df") + 1)))
    return counted.join(df, "term").select(
        "item_id", "term", (weight * F.col("qtf")).cast("long").alias("weight"))


def _search_blocks(top: int):
    """Each row is a block with a chunk of items; scores already reached by an
    item in this task bound its search in the next block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, tree, ids, reached = None, None, None, {}
        for batch in batches:
            for block, terms, docs, packed, names, sizes, words, weights in zip(*batch.columns):
                if held != block.as_py():
                    held, tree = block.as_py(), Tree(packed.as_py())
                    ids = unpack(docs.as_py())[0]
                names = names.values.to_numpy()
                row = pc.index_in(words.values, value_set=terms.values)
                there = row.is_valid().to_numpy(zero_copy_only=False)
                item = np.repeat(np.arange(len(names)), sizes.values.to_numpy())[there]
                least = np.array([reached[n][0] if len(reached.get(n, ())) >= top else 0
                                  for n in names.tolist()], np.int64)
                owner, col, score = search(
                    tree, row.drop_null().to_numpy(zero_copy_only=False).astype(np.int64),
                    weights.values.to_numpy()[there], item, least, ids, top)
                for i in np.unique(owner).tolist():
                    name = int(names[i])
                    scores = np.concatenate((reached.get(name, []), score[owner == i]))
                    reached[name] = np.sort(scores.astype(np.int64))[-top:]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[owner]), pa.array(ids[col]), pa.array(score)],
                    names=["item_id", "doc_id", "score"])
    return run


def rank(docs: DataFrame, items: DataFrame, work: Workspace, top: int = TOP,
         id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
         item_text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): each item's highest-scoring documents."""
    spark = work.spark
    trees, frequencies, n_docs = build_index(docs, work, id_col, text_col)
    terms = work.keep(item_terms(items, frequencies, n_docs, work, item_col, item_text_col)
                      .groupBy("item_id").agg(F.collect_list("term").alias("terms"),
                                              F.collect_list("weight").alias("weights")),
                      "items")
    chunks = -(-terms.count() // CHUNK_ITEMS) or 1
    buckets = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    packed = work.keep(
        terms.groupBy(F.pmod(F.xxhash64("item_id"), F.lit(chunks)).alias("chunk"))
        .agg(F.collect_list(F.struct("item_id", "terms", "weights")).alias("i"))
        .select(F.col("i.item_id").alias("names"),
                F.transform("i", lambda x: F.size(x["terms"])).alias("sizes"),
                F.flatten("i.terms").alias("words"), F.flatten("i.weights").alias("weights")),
        "chunks")
    asked = packed.select(F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("bucket"), "*")
    # The copies of the items, one per bucket, are far larger than their table,
    # by which Spark would choose to broadcast them: both sides are shuffled.
    rows = trees.withColumn("bucket", F.pmod("block", F.lit(buckets)).cast("int")).join(
        asked.hint("merge"), "bucket")
    found = rows.select("block", "terms", "ids", "tree", "names", "sizes", "words", "weights") \
        .mapInArrow(give_back(_search_blocks(top)), "item_id long, doc_id long, score long")
    place = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id"))
    return (found.withColumn("rank", place).where(F.col("rank") <= top)
            .select("item_id", "rank", "doc_id", "score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op11: all benchmark items against all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return rank(docs, items, Workspace(spark, "ranked"))


SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
s AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d WHERE len(w) > 0),
p AS (
  SELECT doc_id, len(w) AS n, term, count(*) AS tf
  FROM (SELECT doc_id, w, unnest(w) AS term FROM d) GROUP BY doc_id, len(w), term),
f AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS weight
  FROM (SELECT term, count(*) AS df FROM p GROUP BY term), s),
r AS (
  SELECT item_id, doc_id,
    CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms))))
         AS BIGINT) AS score
  FROM b JOIN f USING (term) JOIN p USING (term), s GROUP BY item_id, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
      FROM r WHERE score > 0)
WHERE rank <= 20
"""
