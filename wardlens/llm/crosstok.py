"""Cross-tokenizer alignment with corpus-wide counts of linked id pairs.

Tokenizer A is a byte-level BPE file, B a SentencePiece model. Both cover the
bytes of a blank and the text. Places where tokens of both end cut the bytes
into groups; an A and a B token are linked where their bytes overlap.

Neither tokenizer looks across a single blank between two characters that are
not white space (no piece of B holds the blank mark after another character,
which is checked when the model is loaded), so texts are cut there and each
distinct piece of a block of documents is tokenised and aligned once.

The documents are aligned once. Every task gives its distinct linked pairs with
the number of its documents that hold them, dealt to shards by a hash of the
pair, and every block its documents and the pairs that it asks of each shard. A
minimal perfect hash function is built for the distinct pairs of every shard. The
tasks' counts become dense vectors indexed by it, summed by branches of a shard
and then over the branches. Then a shard compares every asked pair with the one
stored in its slot, and the counts return to the block.

No task holds more than the distinct pairs of its shards; requests stream past
them. The highest count of each A id is one number per entry of A's vocabulary,
which bounds what passes through the driver and to the tasks.

Defined cases: null and empty texts, and texts that B's tokens do not spell out
(a literal U+2581), have no tokens and count for no pair; strings of special
tokens are plain text; every row is a document and gives one row, rows with null
or repeated ids included; a very long text is a block of its own; extra columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlens.llm.common import Workspace, give_back
from wardlens.llm.ranked import pack, unpack
from wardlens.llm.tokens import PieceEncoder, cut, gather, library_encoder, steps

MODEL_A = public_tokenizers.path("byte_bpe_50k.json")
MODEL_B = public_tokenizers.path("piece_bpe_32k.model")
MARK = "▁"  # stands for a blank in the pieces of B
# Text bytes of a block, distinct pairs that a task gathers before it hands
# them on, and branches of a shard's sum.
BLOCK_BYTES = 4 << 20
GATHERED = 2_000_000
BRANCHES = 8
STRINGS = 1 << 14  # pieces whose groups are written at a time
_DOCUMENTS, _ASKED, _PAIRS = range(3)  # kinds of rows that the alignment gives


class Names(NamedTuple):
    """The byte lengths of a vocabulary's tokens, and their bytes."""
    length: np.ndarray
    flat: np.ndarray
    ptr: np.ndarray


def _names(names: list[bytes]) -> Names:
    length = np.array([len(n) for n in names], np.int64)
    return Names(length, np.frombuffer(b"".join(names), np.uint8),
                 np.concatenate(([0], np.cumsum(length))))


@lru_cache(maxsize=2)
def names_a(path: str) -> Names:
    """Byte-level entries: printable Latin-1 letters stand for themselves, the
    other bytes, in order, for the letters from 256 on."""
    from tokenizers import Tokenizer
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    byte = {chr(b): b for b in shown}
    byte |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in byte.values())}
    vocabulary = Tokenizer.from_file(path).get_vocab()
    names = [b""] * (max(vocabulary.values()) + 1)
    for name, i in vocabulary.items():
        names[i] = bytes(byte[c] for c in name)
    return _names(names)


@lru_cache(maxsize=2)
def encoder_a(path: str) -> PieceEncoder:
    """If the file splits by the known pattern alone and its merges make its
    tokens in the order of their ids, the ids are ranks and the faster library
    for ranks gives the same ids; else the file's own library is used."""
    with open(path, encoding="utf-8") as text:
        spec = json.load(text)
    vocabulary, splitter = spec["model"]["vocab"], spec["pre_tokenizer"] or {}
    merges = [m if isinstance(m, str) else " ".join(m) for m in spec["model"]["merges"]]
    made = [vocabulary.get(m.replace(" ", "")) for m in merges]
    if (spec["normalizer"] is not None or splitter.get("type") != "ByteLevel"
            or splitter.get("add_prefix_space") or not splitter.get("use_regex", True)
            or made != list(range(256, 256 + len(made)))):
        return library_encoder(path, True)
    import tiktoken
    names = names_a(path)
    raw, at = names.flat.tobytes(), names.ptr.tolist()
    ranks = {raw[at[i]:at[i + 1]]: i for i in range(256 + len(made))}
    encoding = tiktoken.Encoding("merges", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                 special_tokens={})
    return PieceEncoder(lambda texts: [encoding.encode_ordinary(t) for t in texts],
                        {i: b for b, i in ranks.items()})


@lru_cache(maxsize=2)
def model_b(path: str):
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    if any(MARK in p.lstrip(MARK) for p in pieces):
        raise ValueError("pieces of the model go across blanks")
    names = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace(MARK, " ").encode()
             for i, p in enumerate(pieces)]
    return model, _names(names)


class Aligned(NamedTuple):
    """A block: its documents as runs of pieces, and its distinct pieces. Pieces
    that B does not spell out are not ``good`` and hold nothing."""
    doc_ptr: np.ndarray
    index: np.ndarray
    good: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    link_ptr: np.ndarray
    links: np.ndarray  # A id in the high, B id in the low 32 bits
    groups: list[bytes]


def _spelled(ids: np.ndarray, ptr: np.ndarray, names: Names, pieces: list[bytes]) -> np.ndarray:
    data, starts = gather(names.flat, names.ptr, ids)
    raw, at = data.tobytes(), starts[ptr].tolist()
    return np.array([raw[a:b] == p for a, b, p in zip(at, at[1:], pieces)], dtype=bool)


def align_block(texts: pa.Array, path_a: str, path_b: str, groups: bool) -> Aligned:
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    empty, blank = (pa.scalar(x, pa.large_string()) for x in ("", " "))
    spaced = pc.if_else(pc.equal(pc.binary_length(texts), 0), empty,
                        pc.binary_join_element_wise(empty, texts, blank))
    pieces, doc_ptr = cut(spaced)
    coded = pieces.dictionary_encode()
    index = coded.indices.to_numpy(zero_copy_only=False)
    flat_a, ptr_a = encoder_a(path_a).ids(coded.dictionary)
    names = coded.dictionary.to_pylist()
    model, shown_b = model_b(path_b)
    shown_a = names_a(path_a)
    after = pc.utf8_slice_codeunits(coded.dictionary.cast(pa.large_string()), 1)  # B adds the blank
    lists = model.encode(after.to_pylist(), num_threads=1)
    ptr_b = np.concatenate(([0], np.cumsum([len(x) for x in lists], dtype=np.int64)))
    flat_b = np.fromiter(chain.from_iterable(lists), np.int64, ptr_b[-1])
    good = (_spelled(flat_b, ptr_b, shown_b, names) & _spelled(flat_a, ptr_a, shown_a, names))
    a, a_ptr = _only(flat_a, ptr_a, good)
    b, b_ptr = _only(flat_b, ptr_b, good)
    n = len(names)
    a_end, b_end = np.cumsum(shown_a.length[a]), np.cumsum(shown_b.length[b])
    a_piece, b_piece = np.repeat(np.arange(n), np.diff(a_ptr)), np.repeat(np.arange(n), np.diff(b_ptr))
    met = np.intersect1d(a_end, b_end, assume_unique=True)
    n_groups = np.bincount(a_piece[np.searchsorted(a_end, met)], minlength=n)
    first = np.searchsorted(b_end, a_end - shown_a.length[a], side="right")
    after = np.searchsorted(b_end - shown_b.length[b], a_end, side="left")
    size = after - first
    other = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size - first, size)
    links = (np.repeat(a.astype(np.int64), size) << 32) | b[other]
    link_ptr = np.concatenate(([0], np.cumsum(size)))[a_ptr]
    shown: list[bytes] = []
    if groups:
        order = np.argsort(np.concatenate((2 * np.searchsorted(met, a_end),
                                           2 * np.searchsorted(met, b_end) + 1)), kind="stable")
        last_a, last_b = np.isin(a_end, met), np.isin(b_end, met)
        signs, sign_ptr, n_a, n_b = _signs(len(shown_a.length), len(shown_b.length))
        sign = np.concatenate((a + n_a * last_a, 2 * n_a + b + n_b * last_b))[order]
        bounds = a_ptr + b_ptr
        for x in range(0, n, STRINGS):
            y = min(x + STRINGS, n)
            data, starts = gather(signs, sign_ptr, sign[bounds[x]:bounds[y]])
            raw, at = data.tobytes(), starts[bounds[x:y + 1] - bounds[x]].tolist()
            shown += [raw[u:v] for u, v in zip(at, at[1:])]
    return Aligned(doc_ptr, index, good, np.diff(a_ptr), np.diff(b_ptr), n_groups, link_ptr, links,
                   shown)


def _only(flat: np.ndarray, ptr: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lists of the good; those of others are empty."""
    size = np.diff(ptr)
    kept = flat[np.repeat(good, size)].astype(np.int64)
    return kept, np.concatenate(([0], np.cumsum(size * good)))


@lru_cache(maxsize=2)
def _signs(n_a: int, n_b: int) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Every id written within, and at the end of, its part of a group."""
    shown = [f"{i}{end}".encode() for n, ends in ((n_a, ",|"), (n_b, ",;")) for end in ends
             for i in range(n)]
    names = _names(shown)
    return names.flat, names.ptr, n_a, n_b


def _doc_sums(per_piece: np.ndarray, block: Aligned) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(per_piece[block.index])))[block.doc_ptr]
    return np.diff(total)


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    """64-bit finaliser of keys and a seed."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15) % (1 << 64))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return (_mix(keys, 0) % np.uint64(shards)).astype(np.int64)


class PerfectHash:
    """A minimal perfect hash function of distinct keys. Each level has two bits
    per key that is left; a key that has a bit to itself sets it, the others go
    to the next level. A key's slot is the number of bits set before its own."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray):
        self.sizes = sizes
        self.bits = np.unpackbits(bits, count=int(sizes.sum())).astype(bool)
        self.rank = np.cumsum(self.bits) - 1

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        sizes, levels, left = [], [], keys
        while len(left):
            size = 2 * len(left) + 1
            at = (_mix(left, len(sizes) + 1) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            levels.append(alone)
            left = left[~alone[at]]
        bits = np.concatenate(levels) if levels else np.zeros(0, bool)
        return cls(np.array(sizes, np.int64), np.packbits(bits))

    def packed(self) -> bytes:
        return pack(self.sizes, np.packbits(self.bits))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """A slot for every key of the set; any slot, or -1, for others."""
        out = np.full(len(keys), -1, np.int64)
        left, first = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes.tolist()):
            at = first + (_mix(keys[left], level + 1) % np.uint64(size)).astype(np.int64)
            there = self.bits[at]
            out[left[there]] = self.rank[at[there]]
            left, first = left[~there], first + size
        return out


def _sum_equal(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    names, at = np.unique(keys, return_inverse=True)
    sums = np.zeros(len(names), np.int64)
    np.add.at(sums, at, counts)
    return names, sums


def _distinct(x: np.ndarray) -> np.ndarray:
    """The distinct numbers in order; ``np.unique`` hashes them, which takes longer."""
    x = np.sort(x)
    return x[np.diff(x, prepend=x[:1] - 1) != 0]


def _holders(block: Aligned, whole: np.ndarray, link_ptr: np.ndarray, code: np.ndarray,
             n_names: int) -> np.ndarray:
    """How many of the ``whole`` documents hold each distinct link."""
    doc = np.repeat(np.arange(len(whole)), np.diff(block.doc_ptr))
    held = whole[doc]
    piece = _distinct(doc[held] * len(block.good) + block.index[held])
    doc, piece = np.divmod(piece, max(len(block.good), 1))
    out = np.zeros(n_names, np.int64)
    # Whole documents, about a million links at a time.
    step = np.cumsum(np.diff(link_ptr)[piece]) >> 20
    cuts = np.flatnonzero(np.diff(step)) + 1
    cuts = np.unique(np.searchsorted(doc, doc[cuts])) if len(cuts) else cuts
    for some in np.split(np.arange(len(piece)), cuts):
        flat, ptr = gather(code, link_ptr, piece[some])
        cell = _distinct(np.repeat(doc[some], np.diff(ptr)) * n_names + flat)
        out += np.bincount(cell % max(n_names, 1), minlength=n_names)
    return out


_BLOCKS = "block long, shard int, head binary, body binary"
_BLOCK_SCHEMA = pa.schema([("block", pa.int64()), ("shard", pa.int32()),
                           ("head", pa.binary()), ("body", pa.binary())])
# Of pairs, the block is the branch, the head the keys and the body the counts.
_ALIGNED = f"{_BLOCKS}, kind int"
_ALIGNED_SCHEMA = _BLOCK_SCHEMA.append(pa.field("kind", pa.int32()))
_FACTS = pa.schema([("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
                    ("n_groups", pa.int64()), ("n_links", pa.int64()), ("n_best", pa.int64()),
                    ("count_sum", pa.int64()), ("groups_sha256", pa.string()), ("groups", pa.string())])
FACTS = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, "
         "count_sum long, groups_sha256 string, groups string")


def _row(*values: int | bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([v], f.type) for v, f in zip(values, _ALIGNED_SCHEMA)], schema=_ALIGNED_SCHEMA)


def _by_shard(keys: np.ndarray, shards: int) -> Iterator[tuple[int, np.ndarray]]:
    """The shards of the keys, and the places of each one's."""
    shard = shard_of(keys, shards)
    order = np.argsort(shard, kind="stable")
    cuts = np.flatnonzero(np.diff(shard[order])) + 1
    return ((int(shard[part[0]]), part) for part in np.split(order, cuts) if len(part))


def _facts(doc_ids: pa.Array, block: Aligned, whole: np.ndarray, groups: bool) -> bytes:
    """What is known of a block's documents before the counts."""
    facts = [_doc_sums(n, block) * whole for n in
             (block.n_a, block.n_b, block.n_groups, np.diff(block.link_ptr))]
    digests, texts = [], []
    for a, b, w in zip(block.doc_ptr, block.doc_ptr[1:], whole):
        text = b"".join([block.groups[i] for i in block.index[a:b].tolist()])[:-1] if w else b""
        digests.append(hashlib.sha256(text).hexdigest() if text else "")
        texts.append(text.decode() if groups else None)
    nothing = pa.nulls(len(doc_ids), pa.int64())
    head = pa.RecordBatch.from_arrays([
        doc_ids.cast(pa.int64()), *[pa.array(f) for f in facts], nothing, nothing,
        pa.array(digests, pa.string()), pa.array(texts, pa.string())], schema=_FACTS)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, _FACTS, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(head)
    return sink.getvalue().to_pybytes()


def _aligned(path_a: str, path_b: str, shards: int, documents: bool, groups: bool):
    """The tasks' pairs and, if ``documents``, each block's documents and what it
    asks of each shard."""
    def rows(doc_ids: pa.Array, texts: pa.Array):
        """Gives a block's rows; returns its distinct pairs and their counts."""
        block = align_block(texts, path_a, path_b, groups=documents)
        whole = _doc_sums(~block.good, block) == 0
        head = _facts(doc_ids, block, whole, groups) if documents else b""
        block.groups.clear()
        # Pieces of documents without tokens ask and count for nothing.
        used = np.zeros(len(block.good), bool)
        used[block.index[np.repeat(whole, np.diff(block.doc_ptr))]] = True
        links, link_ptr = _only(block.links, block.link_ptr, used)
        names, code = np.unique(links, return_inverse=True)
        held = _holders(block, whole, link_ptr, code, len(names))
        if documents:
            body = pack(block.doc_ptr.astype(np.int64), block.index.astype(np.uint32),
                        whole.astype(np.uint8), link_ptr.astype(np.int64), code.astype(np.uint32))
            block_id = int.from_bytes(hashlib.blake2b(
                head + body, digest_size=8).digest(), "little", signed=True)
            yield _row(block_id, -1, head, body, _DOCUMENTS)
            for shard, part in _by_shard(names, shards):
                yield _row(block_id, shard, pack(part.astype(np.uint32)), pack(names[part]), _ASKED)
        return names, held

    def pairs(keys: np.ndarray, counts: np.ndarray, branch: int) -> Iterator[pa.RecordBatch]:
        for shard, part in _by_shard(keys, shards):
            yield _row(branch, shard, pack(keys[part]), pack(counts[part]), _PAIRS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, branch = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        for batch in batches:
            for x, y in steps(batch.column(1), BLOCK_BYTES):
                names, held = yield from rows(*(c.slice(x, y - x) for c in batch.columns))
                keys, counts = _sum_equal(np.concatenate((keys, names)), np.concatenate((counts, held)))
                branch = int(_mix(np.array([y - x + len(keys)]), 7)[0] % np.uint64(BRANCHES))
                if len(keys) > GATHERED:
                    yield from pairs(keys, counts, branch)
                    keys, counts = keys[:0], counts[:0]
        yield from pairs(keys, counts, branch)
    return run


def _functions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The function of each shard's distinct keys, and the keys in its order."""
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        for shard, keys in zip(batch.column(0).to_pylist(), batch.column(1)):
            new = unpack(keys.as_py())[0]
            held[shard] = np.union1d(held[shard], new) if shard in held else np.unique(new)
    for shard, keys in held.items():
        function = PerfectHash.build(keys)
        placed = np.empty_like(keys)
        placed[function.slots(keys)] = keys
        yield pa.RecordBatch.from_arrays(
            [pa.array([shard], pa.int32()), pa.array([function.packed()], pa.binary()),
             pa.array([pack(placed)], pa.binary())], names=["shard", "function", "keys"])


def _branch_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Dense counts of each (shard, branch); its function comes before its rows."""
    at, function, counts = None, None, None

    def done() -> Iterator[pa.RecordBatch]:
        if at is not None and counts is not None:
            yield pa.RecordBatch.from_arrays([pa.array([at[0]], pa.int32()),
                                              pa.array([pack(counts)], pa.binary())],
                                             names=["shard", "counts"])

    for batch in batches:
        for shard, branch, kind, first, second in zip(*(c for c in batch.columns)):
            key = shard.as_py(), branch.as_py()
            if kind.as_py() == 0:
                yield from done()
                at, function = key, PerfectHash(*unpack(first.as_py()))
                counts = None
                continue
            if key != at:
                raise RuntimeError("counts without their shard's function")
            if counts is None:
                counts = np.zeros(int(function.bits.sum()), np.int64)
            counts[function.slots(unpack(first.as_py())[0])] += unpack(second.as_py())[0]
    yield from done()


def _sum_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for shard, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
            new = unpack(counts.as_py())[0]
            total[shard] = total[shard] + new if shard in total else new
    for shard, counts in total.items():
        yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()),
                                          pa.array([pack(counts)], pa.binary())],
                                         names=["shard", "counts"])


def count_pairs(docs: DataFrame, work: Workspace, path_a: str = MODEL_A, path_b: str = MODEL_B,
                text_col: str = "text") -> DataFrame:
    """The counts of all linked pairs by shard: (shard, function, keys, counts),
    keys and counts in the order of the function's slots."""
    texts = docs.select(F.lit(0).cast("long"), F.col(text_col).alias("text"))
    return _counts(_write_aligned(texts, work, path_a, path_b, documents=False), work)


def _write_aligned(texts: DataFrame, work: Workspace, path_a: str, path_b: str, documents: bool,
                   groups: bool = False) -> DataFrame:
    shards = int(work.spark.conf.get("spark.sql.shuffle.partitions"))
    run = give_back(_aligned(path_a, path_b, shards, documents, groups))
    texts.mapInArrow(run, _ALIGNED).write.mode("overwrite").partitionBy("kind") \
        .parquet(work.path("aligned"))
    return work.spark.read.schema(_ALIGNED).parquet(work.path("aligned"))


def _counts(aligned: DataFrame, work: Workspace) -> DataFrame:
    shards = int(work.spark.conf.get("spark.sql.shuffle.partitions"))
    pairs = aligned.where(F.col("kind") == _PAIRS).select(
        "shard", F.col("block").cast("int").alias("branch"), F.col("head").alias("keys"),
        F.col("body").alias("counts"))
    functions = work.keep(
        pairs.select("shard", "keys").repartition(shards, "shard")
        .mapInArrow(_functions, "shard int, function binary, keys binary"), "functions")
    branches = F.explode(F.array(*[F.lit(i) for i in range(BRANCHES)]))
    both = (functions.select("shard", branches.alias("branch"), F.lit(0).alias("kind"),
                             F.col("function").alias("first"), F.lit(None).cast("binary").alias("second"))
            .unionByName(pairs.select("shard", "branch", F.lit(1).alias("kind"),
                                      F.col("keys").alias("first"), F.col("counts").alias("second"))))
    sums = (both.repartition(shards, "shard", "branch")
            .sortWithinPartitions("shard", "branch", "kind")
            .mapInArrow(_branch_vectors, "shard int, counts binary")
            .repartition(shards, "shard").mapInArrow(_sum_vectors, "shard int, counts binary"))
    return work.keep(functions.join(sums, "shard").select("shard", "function", "keys", "counts"),
                     "counts")


def pair_table(counts: DataFrame) -> DataFrame:
    """(a, b, n_docs) of every linked pair."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, n in zip(*batch.columns):
                keys, n = unpack(keys.as_py())[0], unpack(n.as_py())[0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array((keys >> 32).astype(np.int32)),
                     pa.array((keys & 0xFFFFFFFF).astype(np.int32)), pa.array(n)],
                    names=["a", "b", "n_docs"])
    return counts.select("keys", "counts").mapInArrow(run, "a int, b int, n_docs long")


def _highest(counts: DataFrame, vocabulary: int) -> np.ndarray:
    """The highest count of each A id: one number per entry of A's vocabulary."""
    rows = pair_table(counts).groupBy("a").agg(F.max("n_docs").alias("n")).collect()
    out = np.zeros(vocabulary, np.int64)
    for r in rows:
        out[r["a"]] = r["n"]
    return out


def _answers(highest: np.ndarray):
    """Counts for what blocks ask; a shard's table comes before the requests."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, function, keys, counts = None, None, None, None
        for batch in batches:
            for shard, kind, block, first, second, third in zip(*batch.columns):
                if kind.as_py() == 0:
                    at, function = shard.as_py(), PerfectHash(*unpack(first.as_py()))
                    keys, counts = unpack(second.as_py())[0], unpack(third.as_py())[0]
                    continue
                asked = unpack(second.as_py())[0]
                slot = function.slots(asked) if at == shard.as_py() else np.full(len(asked), -1)
                if (slot < 0).any() or (keys[slot] != asked).any():
                    raise RuntimeError("a pair was not counted")
                n = counts[slot]
                yield pa.RecordBatch.from_arrays([
                    pa.array([block.as_py()], pa.int64()), pa.array([at], pa.int32()),
                    pa.array([first.as_py()], pa.binary()),
                    pa.array([pack(n, (n == highest[asked >> 32]).astype(np.uint8))], pa.binary())],
                    schema=_BLOCK_SCHEMA)
    return run


def _finish(documents: pa.Table, answers: pa.Table) -> pa.Table:
    out = []
    at = [unpack(h)[0] for h in answers.column("head").to_pylist()]
    got = [unpack(b) for b in answers.column("body").to_pylist()]
    for head, body in zip(documents.column("head").to_pylist(), documents.column("body").to_pylist()):
        facts = pa.ipc.open_stream(head).read_all()
        doc_ptr, index, whole, link_ptr, code = unpack(body)
        # Blocks of equal content share a name and have the same answers.
        n = np.full((2, int(code.max()) + 1 if len(code) else 0), -1, np.int64)
        for place, (count, best) in zip(at, got):
            n[0, place], n[1, place] = best, count
        if (n < 0).any():
            raise RuntimeError("a block's counts did not come back")
        for name, values in (("n_best", n[0]), ("count_sum", n[1])):
            pieces = np.diff(np.concatenate(([0], np.cumsum(values[code])))[link_ptr])
            total = np.concatenate(([0], np.cumsum(pieces[index])))[doc_ptr]
            facts = facts.set_column(facts.schema.get_field_index(name), name,
                                     pa.array(np.diff(total) * whole))
        out.append(facts)
    return pa.concat_tables(out) if out else _FACTS.empty_table()


def align(docs: DataFrame, work: Workspace, path_a: str = MODEL_A, path_b: str = MODEL_B,
          id_col: str = "doc_id", text_col: str = "text", groups: bool = False) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256 and, on demand, groups (the groups' ids as text)."""
    shards = int(work.spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    aligned = _write_aligned(texts, work, path_a, path_b, True, groups)
    counts = _counts(aligned, work)
    highest = _highest(counts, len(names_a(path_a).length))
    none = F.lit(None).cast("binary")
    tables = counts.select("shard", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("block"),
                           F.col("function").alias("first"), F.col("keys").alias("second"),
                           F.col("counts").alias("third"))
    asked = aligned.where(F.col("kind") == _ASKED).select(
        "shard", F.lit(1).alias("kind"), "block", F.col("head").alias("first"),
        F.col("body").alias("second"), none.alias("third"))
    answers = (tables.unionByName(asked).repartition(shards, "shard")
               .sortWithinPartitions("shard", "kind").mapInArrow(give_back(_answers(highest)), _BLOCKS))
    documents = aligned.where(F.col("kind") == _DOCUMENTS).drop("kind")
    return (documents.groupBy("block").cogroup(answers.groupBy("block"))
            .applyInArrow(_finish, FACTS))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op13: all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return align(docs, Workspace(spark, "crosstok")).drop("groups")
