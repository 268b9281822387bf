"""MinHash near-duplicate removal with b-bit signatures.

Each document becomes the set of its five-word shingles (as 64-bit hashes).
Documents with equal sets are collapsed to one representative first, so a
group of exact copies, however large, is one row from then on. Of each
representative's minima, ``BANDS`` bands of ``ROWS`` minima give the candidate
buckets, and the low ``BITS`` bits of every minimum are packed into a
signature: the share of equal bit groups, corrected for chance collisions
(1/2**BITS), estimates the similarity of a candidate pair by bit counts. Pairs
whose estimate is not clearly below the threshold are confirmed on the full
sets.

No bucket emits all its pairs. In each round every bucket whose documents are
not yet in one component pairs one document per component with the bucket's
smallest document; confirmed pairs merge components, until a round confirms
nothing. Copies at the fringe of a large group may then still share buckets with
thousands of documents they are not similar to. The documents of such buckets
are compared across components by an exact join on prefixes: with the shingles
of each set in order of rarity, two sets of similarity 0.75 must share one at
ranks that leave room for the overlap they need. Shingles that only a fringe
copy has fill its prefix, so the pairs it does not link to are never formed.

At similarity 0.75 a pair misses all bands with probability
(1 - 0.75**5)**48 = 2.3e-6, and the estimate falls below its cut-off of 0.58
(about 6 standard deviations) with probability under 1e-8.

Defined cases: null or blank text has an empty set (n_shingles 0), is linked
with nothing and kept; a text of one to four words is one shingle; rows
without ``doc_id`` are left out; rows that share a ``doc_id`` and a set are one
document, and with different sets each row is linked on its own under that id;
empty tables give empty results; other columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlens.llm.common import Workspace, give_back
from wardlens.llm.components import connected_components

WORDS = 5
SIMILAR = 75
ROWS, BANDS = 5, 48
BITS = 4
ESTIMATE_FLOOR = 0.58
# Text bytes that one vectorised step works on.
STEP_BYTES = 4 << 20

_PERMS = ROWS * BANDS
_rng = np.random.default_rng(20260101)
_MUL = _rng.integers(0, 1 << 32, _PERMS, dtype=np.uint32) | np.uint32(1)
_ADD = _rng.integers(0, 1 << 32, _PERMS, dtype=np.uint32)
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]  # A-Z count as a-z
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[32, *range(9, 14)]] = True
_RADIX = np.uint64(0x9E3779B97F4A7C15 | 1)
_UNRADIX = np.uint64(pow(int(_RADIX), -1, 1 << 64))
_PLACE = _rng.integers(0, 1 << 63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    p = np.full(n, base, dtype=np.uint64)
    if n:
        p[0] = 1
    return np.cumprod(p, dtype=np.uint64)


def shingle_hashes(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the word shingles of consecutive texts.

    ``data``: the UTF-8 bytes of all texts; ``ends``: where each text starts,
    and the end of the last. Returns the sorted distinct hashes of all texts
    one after another and, as ``ends``, where each text's hashes start.
    """
    n_docs = len(ends) - 1
    blank = _BLANK[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[ends] = True
    inner = ~blank
    before = np.concatenate(([True], blank[:-1])) if len(data) else blank
    starts = np.flatnonzero(inner & (before | edge[:-1]))
    after = np.concatenate((blank[1:], [True])) if len(data) else blank
    stops = np.flatnonzero(inner & (after | edge[1:])) + 1
    # Word hash: a polynomial in the word's bytes, from differences of a running sum.
    run = np.concatenate((np.zeros(1, np.uint64),
                          np.cumsum(_BYTE[data] * _powers(_RADIX, len(data)), dtype=np.uint64)))
    word = _mix((run[stops] - run[starts]) * _powers(_UNRADIX, len(data) + 1)[starts]
                + (stops - starts).astype(np.uint64))
    first = np.searchsorted(starts, ends)  # words before each text
    count = np.diff(first)
    full = np.maximum(count - WORDS + 1, 0)
    short = (count > 0) & (count < WORDS)
    sizes = full + short
    ptr = np.concatenate(([0], np.cumsum(sizes)))
    at = np.arange(ptr[-1]) - np.repeat(ptr[:-1] - first[:-1], sizes)  # first word of each
    length = np.minimum(np.repeat(count, sizes), WORDS)
    out = np.zeros(len(at), dtype=np.uint64)
    for i in range(WORDS):
        has = length > i
        out[has] += word[at[has] + i] * _PLACE[i]
    out = _mix(out + length.astype(np.uint64))
    doc = np.repeat(np.arange(n_docs), sizes)
    order = np.lexsort((out, doc))
    out, doc = out[order], doc[order]
    fresh = np.ones(len(out), dtype=bool)
    fresh[1:] = (out[1:] != out[:-1]) | (doc[1:] != doc[:-1])
    return out[fresh], np.searchsorted(doc[fresh], np.arange(n_docs + 1))


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """(doc ids, text bytes, starts) in steps of bounded size; a text is never cut."""
    for batch in batches:
        ids = batch.column(0).to_pylist()
        text = batch.column(1).cast(pa.large_binary())
        lengths = np.diff(np.frombuffer(text.buffers()[1], np.int64)[
            text.offset:text.offset + len(text) + 1]) if len(text) else np.zeros(0, np.int64)
        step = np.cumsum(lengths) // STEP_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(step)) + 1).tolist(), len(ids)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            part = text.slice(a, b - a)
            offsets = np.frombuffer(part.buffers()[1], np.int64)[part.offset:part.offset + b - a + 1]
            raw = part.buffers()[2]
            data = (np.frombuffer(raw, np.uint8)[offsets[0]:offsets[-1]] if raw is not None
                    else np.zeros(0, np.uint8))
            yield ids[a:b], data, offsets - offsets[0]


_SIGNED = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()),
                     ("print", pa.binary()), ("bands", pa.list_(pa.int64())),
                     ("sig", pa.list_(pa.int64()))])
SIGNED = "doc_id long, n_shingles long, print binary, bands array<long>, sig array<long>"
_SETS = pa.schema([("doc_id", pa.int64()), ("print", pa.binary()), ("shingles", pa.list_(pa.int64()))])


def _prints(hashes: np.ndarray, ptr: np.ndarray) -> list[bytes]:
    return [hashlib.blake2b(hashes[a:b].tobytes(), digest_size=16).digest()
            for a, b in zip(ptr, ptr[1:])]


def _minima(hashes: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """(documents, permutations) minima of non-empty sets."""
    lanes = (hashes.astype(np.uint32), (hashes >> np.uint64(32)).astype(np.uint32))
    out = np.empty((_PERMS, len(ptr) - 1), dtype=np.uint32)
    for p in range(_PERMS):
        out[p] = np.minimum.reduceat(lanes[p % 2] * _MUL[p] + _ADD[p], ptr[:-1])
    return out.T


def _lists(rows: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(
        pa.array(np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32)),
        pa.array(np.ascontiguousarray(rows).reshape(-1)))


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, data, ends in _steps(batches):
        hashes, ptr = shingle_hashes(data, ends)
        size = np.diff(ptr)
        some = np.flatnonzero(size)
        if not len(some):
            continue
        starts = np.append(ptr[some], ptr[-1])
        minima = _minima(hashes, starts)
        bands = np.zeros((len(some), BANDS), dtype=np.uint64)
        for i in range(ROWS):
            bands = _mix(bands + minima[:, i::ROWS].astype(np.uint64) + np.uint64(1))
        bands = _mix(bands + np.arange(BANDS, dtype=np.uint64))
        low = (minima & np.uint32((1 << BITS) - 1)).astype(np.uint64)
        per = 64 // BITS
        sig = np.zeros((len(some), _PERMS // per), dtype=np.uint64)
        for i in range(per):
            sig |= low[:, i::per] << np.uint64(BITS * i)
        yield pa.RecordBatch.from_arrays([
            pa.array([ids[i] for i in some], pa.int64()), pa.array(size[some], pa.int64()),
            pa.array(_prints(hashes, starts), pa.binary()),
            _lists(bands.view(np.int64)), _lists(sig.view(np.int64))], schema=_SIGNED)


def _collect_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, data, ends in _steps(batches):
        hashes, ptr = shingle_hashes(data, ends)
        yield pa.RecordBatch.from_arrays([
            pa.array(ids, pa.int64()), pa.array(_prints(hashes, ptr), pa.binary()),
            pa.ListArray.from_arrays(pa.array(ptr, pa.int32()), pa.array(hashes.view(np.int64)))],
            schema=_SETS)


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, print, bands, sig) of every (doc_id, text) row that
    has words; print identifies the set."""
    return docs.mapInArrow(give_back(_sign), SIGNED)


def estimated_similarity(a: str, b: str):
    """Collision-corrected similarity of two packed signatures: a bit group is
    equal when the OR of the bits of its XOR is 0."""
    ones = int("0" * (BITS - 1) + "1", 2)
    mask = sum(ones << (BITS * i) for i in range(64 // BITS))
    mask = mask - (1 << 64) if mask >= 1 << 63 else mask

    def differing(x, y):
        d = x.bitwiseXOR(y)
        folded = d
        for i in range(1, BITS):
            folded = folded.bitwiseOR(F.shiftrightunsigned(d, i))
        return F.bit_count(folded.bitwiseAND(F.lit(mask).cast("long")))

    apart = F.aggregate(F.zip_with(a, b, differing), F.lit(0), lambda t, x: t + x)
    chance = 1 / (1 << BITS)
    return ((1 - apart / _PERMS) - chance) / (1 - chance)


def _confirm(pairs: DataFrame, reps: DataFrame, sets: DataFrame, work: Workspace,
             name: str) -> DataFrame:
    """The pairs (a, b) of representatives that are similar on their full sets.
    A pair is estimated on its signatures first."""
    a = reps.select(F.col("doc").alias("a"), F.col("sig").alias("sig_a"), F.col("n").alias("n_a"))
    b = reps.select(F.col("doc").alias("b"), F.col("sig").alias("sig_b"), F.col("n").alias("n_b"))
    likely = work.keep(
        pairs.join(a, "a").join(b, "b")
        .where((F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * SIMILAR)
               & (estimated_similarity("sig_a", "sig_b") >= ESTIMATE_FLOOR))
        .select("a", "b"), f"likely-{name}")
    set_a = sets.select(F.col("doc").alias("a"), F.col("shingles").alias("set_a"))
    set_b = sets.select(F.col("doc").alias("b"), F.col("shingles").alias("set_b"))
    both = F.size(F.array_intersect("set_a", "set_b"))
    return work.keep(
        likely.join(set_a, "a").join(set_b, "b")
        .where(both * 100 >= (F.size("set_a") + F.size("set_b") - both) * SIMILAR)
        .select("a", "b"), f"links-{name}")


def near_duplicates(docs: DataFrame, work: Workspace, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (the smallest doc_id that
    links of similarity 0.75 or more reach), kept (it is that document)."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                        F.col(text_col).alias("text")).where("doc_id is not null")
    signed = work.keep(signatures(texts), "signed")
    # One representative per set.
    prints = work.keep(signed.groupBy("print").agg(F.min("doc_id").alias("doc")), "prints")
    reps = (signed.join(prints.select(F.col("print"), F.col("doc").alias("doc_id")),
                        ["print", "doc_id"], "left_semi")
            .dropDuplicates(["print"]))
    reps = work.keep(reps.select(F.xxhash64("print").alias("doc"), "print", "doc_id",
                                 F.col("n_shingles").alias("n"), "bands", "sig"), "reps")
    keys = reps.select("doc", F.explode("bands").alias("key"))
    shared = work.keep(keys.groupBy("key").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi"))
                       .where("lo <> hi").select("key"), "shared")
    members = work.keep(keys.join(shared, "key"), "members")
    roots = _merge(members, reps, texts, work)
    named = (reps.join(roots, reps["doc"] == roots["node"], "left")
             .select("print", "doc_id", F.coalesce("root", "doc").alias("root")))
    named = work.keep(named, "named")
    smallest = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    classes = work.keep(named.join(smallest, "root").select("print", "component_id"), "classes")
    rows = signed.join(classes, "print").groupBy("doc_id").agg(
        F.max("n_shingles").alias("n_shingles"), F.min("component_id").alias("component_id"))
    ids = texts.select("doc_id").distinct()
    component = F.coalesce("component_id", "doc_id")
    return ids.join(rows, "doc_id", "left").select(
        "doc_id", F.coalesce("n_shingles", F.lit(0)).cast("long").alias("n_shingles"),
        component.alias("component_id"), (component == F.col("doc_id")).alias("kept"))


def _prefix_pairs(placed: DataFrame, sets: DataFrame, work: Workspace) -> DataFrame:
    """Pairs (a, b) of documents in different components that may be similar:
    all that are, and few others. ``placed``: (doc, comp)."""
    of = work.keep(sets.join(placed, "doc").select(
        "doc", "comp", F.size("shingles").alias("n"), F.explode("shingles").alias("s")), "tokens")
    rarity = work.keep(of.groupBy("s").agg(F.count("*").alias("df")).where("df > 1"), "rarity")
    listed = F.array_sort(F.collect_list(F.struct(F.coalesce("df", F.lit(1)).alias("df"), "s")))
    prefix = (of.join(rarity, "s", "left").groupBy("doc", "comp", "n").agg(listed.alias("list"))
              .select("doc", "comp", "n", F.posexplode(F.slice(
                  "list", F.lit(1), F.col("n") - F.ceil(F.col("n") * SIMILAR / 100) + 1))
                  .alias("at", "token"))
              .where("token.df > 1").select("doc", "comp", "n", "at", "token.s"))
    a = work.keep(prefix, "prefixes")
    b = a.select("s", *[F.col(c).alias(f"{c}_b") for c in ("doc", "comp", "n", "at")])
    room = F.least(F.col("n") - F.col("at"), F.col("n_b") - F.col("at_b"))
    fits = ((F.col("comp") < F.col("comp_b"))
            & (F.least("n", "n_b") * 100 >= F.greatest("n", "n_b") * SIMILAR)
            & (room * (100 + SIMILAR) >= (F.col("n") + F.col("n_b")) * SIMILAR))
    return a.join(b, (a["s"] == b["s"]) & fits).select(F.col("doc").alias("a"), F.col("doc_b").alias("b"))


def _merge(members: DataFrame, reps: DataFrame, texts: DataFrame, work: Workspace) -> DataFrame:
    """(node, root) of the representatives that have a link."""
    candidates = members.select("doc").distinct()
    wanted = work.keep(reps.join(candidates, "doc", "left_semi").select("doc", "doc_id", "print"),
                       "wanted")
    sets = texts.join(wanted.select("doc_id").distinct(), "doc_id", "left_semi").mapInArrow(
        give_back(_collect_sets), "doc_id long, print binary, shingles array<long>")
    sets = work.keep(sets.join(wanted.select("doc", "doc_id", "print"), ["doc_id", "print"])
                     .dropDuplicates(["doc"]).select("doc", "shingles"), "sets")
    links: DataFrame | None = None
    tested: DataFrame | None = None
    turn, last = 0, False
    placed = members.withColumn("comp", F.col("doc"))
    while True:
        mixed = work.keep(placed.groupBy("key").agg(F.min("comp").alias("lo"),
                                                    F.max("comp").alias("hi"))
                          .where("lo <> hi").select("key", "lo"), f"mixed-{turn}")
        here = placed.join(mixed, "key")
        if last:
            pairs = _prefix_pairs(here.select("doc", "comp").distinct(), sets, work)
        else:
            one = work.keep(here.groupBy("key", "lo", "comp").agg(F.min("doc").alias("doc")),
                            f"one-{turn}")
            pivot = one.where("comp = lo").select("key", F.col("doc").alias("a"))
            pairs = one.where("comp <> lo").select("key", F.col("doc").alias("b")).join(pivot, "key")
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = work.keep(pairs, f"pairs-{turn}")
        found = _confirm(pairs, reps, sets, work, str(turn))
        news = not found.isEmpty()
        links = found if links is None else links.unionByName(found)
        tested = pairs if tested is None else tested.unionByName(pairs)
        if news or last:
            roots = connected_components(links, work, f"cc-{turn}")
        if last:
            return roots
        placed = members.join(roots, members["doc"] == roots["node"], "left").select(
            "key", "doc", F.coalesce("root", "doc").alias("comp")) if news else placed
        last = not news
        turn += 1


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8: all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs, Workspace(spark, "neardup"))


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(w[s:s + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS s
        FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM sh x JOIN sh y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
pair AS (
  SELECT a, b FROM common JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * c >= 75 * (na.n + nb.n - c)),
link AS (SELECT a, b FROM pair UNION SELECT b, a FROM pair),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT reach.doc_id, link.b FROM reach JOIN link ON reach.other = link.a),
comp AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT comp.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id,
       comp.doc_id = component_id AS kept
FROM comp LEFT JOIN n USING (doc_id)
"""
