"""Byte-level BPE encoding and decoding over a global shuffle of distinct words.

``encode`` works on blocks of documents (a bounded number of text bytes). A
block lists its distinct pre-tokens and writes each document as positions into
that list. The lists are shuffled by pre-token, so that every distinct
pre-token of the whole corpus reaches one task and is encoded once; its ids
travel back to the blocks that asked, which put the ids together in the order
of the positions. What moves is one entry per distinct pre-token and block and
a packed position per occurrence, never the occurrences' text. Frequent words
do not make a hot task: a block asks for a word once however often it holds it.

``decode`` joins the table of token bytes (as long as the vocabulary) to ids
inside each task.

Blocks are cut twice, once for the lists and once for the documents: that costs
CPU time, but neither the text nor the positions are written or shuffled more
than once. A block is named by its content, so both passes and a recomputed
task name it alike; a block whose ids do not come back fails the job.

Defined cases: null text counts as empty and has no ids; every input row gives
one output row, rows with null or repeated ids included; very long texts make a
block of their own; an empty table gives an empty result. Extra columns of the
input are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlens.llm.common import give_back, hand_back, ship_package
from wardlens.llm.tokens import cut, distinct, gather, rank_encoding, rank_table, steps

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
# Text bytes of a block.
BLOCK_BYTES = 8 << 20
# Text bytes that are cut at one time.
CUT_BYTES = 1 << 20
# Marks that form one pre-token after letters, and the end of the Latin letters.
MARKS = ".,;:!?"
LATIN_END = "\u0250"
# Words that are Python objects at one time.
OBJECTS = 1 << 14
# Token ids decoded in one vectorised step.
DECODE_STEP = 1 << 20

_BLOCKS = "block long, bucket int, head binary, body binary"
_BLOCK_SCHEMA = pa.schema([("block", pa.int64()), ("bucket", pa.int32()),
                           ("head", pa.binary()), ("body", pa.binary())])
_SEQUENCE = -1  # bucket of the row that holds a block's documents


def pack(numbers: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers as four compressed planes of bytes."""
    planes = np.ascontiguousarray(numbers.astype("<u4")).view(np.uint8).reshape(-1, 4).T
    raw = planes.tobytes()
    return len(numbers).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(packed: bytes) -> np.ndarray:
    n = int.from_bytes(packed[:8], "little")
    raw = pa.decompress(packed[8:], decompressed_size=4 * n, codec="zstd", asbytes=True)
    planes = np.frombuffer(raw, np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1)


def _to_ipc(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    with pa.ipc.new_stream(sink, batch.schema, options=options) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _from_ipc(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


def _lists(column: pa.Array) -> Iterator[list[bytes]]:
    """The values of a column, a bounded number at a time."""
    return (column.slice(s, OBJECTS).to_numpy(zero_copy_only=False).tolist()
            for s in range(0, len(column), OBJECTS))


def _pieces(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Index of each piece into the distinct pieces, these, and where each
    text's pieces start. Some texts are cut at a time."""
    parts, starts, n = [], [np.zeros(1, dtype=np.int64)], 0
    for a, b in steps(texts, CUT_BYTES):
        pieces, ptr = cut(texts.slice(a, b - a))
        parts.append(pieces)
        starts.append(n + ptr[1:])
        n += len(pieces)
    return *distinct(pa.chunked_array(parts, pa.large_binary())), np.concatenate(starts)


def _pretokens(pieces: pa.Array, pattern: str) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """The pre-tokens of each piece as indices into the distinct ones."""
    import regex
    find = regex.compile(pattern).findall
    found, sizes = [], np.zeros(len(pieces), dtype=np.int64)
    at = 0
    for part in _lists(pieces):
        words = []
        for i, piece in enumerate(part, at):
            before = len(words)
            text = piece.decode("utf-8", "replace")
            # A blank, Latin letters and at most some closing marks need no search.
            stem = text.rstrip(MARKS) if pattern == PATTERN and text[:1] == " " else ""
            if stem[1:].isalpha() and max(stem) < LATIN_END:
                words.append(stem)
                if len(stem) < len(text):
                    words.append(text[len(stem):])
            else:
                words += find(text)
            sizes[i] = len(words) - before
        found.append(pa.array(words, pa.large_string()).cast(pa.large_binary()))
        at += len(part)
    index, names = distinct(pa.chunked_array(found, pa.large_binary()))
    return index, np.concatenate(([0], np.cumsum(sizes))), names


def _block(ids: pa.Array, texts: pa.Array, pattern: str) -> tuple[int, bytes, bytes, pa.Array]:
    """A block's name, its documents and their number of words, the packed
    positions of these in the list of distinct words, and that list."""
    piece_index, names, doc_ptr = _pieces(texts)
    flat, ptr, words = _pretokens(names, pattern)
    sequence, starts = gather(flat, ptr, piece_index)
    sizes = np.diff(starts[doc_ptr])
    del names, flat, ptr, piece_index, starts
    head = _to_ipc(pa.RecordBatch.from_arrays(
        [ids.cast(pa.int64()), pa.array(sizes, pa.int64())], names=["doc_id", "n"]))
    body = pack(sequence)
    name = hashlib.blake2b(head + body, digest_size=8)
    for part in _lists(words):
        name.update(b"\0".join(part))
    return int.from_bytes(name.digest(), "little", signed=True), head, body, words


def _listed(block: int, words: pa.Array, buckets: int) -> list[tuple]:
    """The rows of a block's word list, one for each bucket."""
    bucket = np.fromiter((zlib.crc32(w) % buckets for part in _lists(words) for w in part),
                         np.int32, len(words))
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    return [(block, int(bucket[part[0]]), pack(part),
             _to_ipc(pa.RecordBatch.from_arrays([words.take(pa.array(part)).cast(pa.binary())],
                                                names=["word"])))
            for part in (np.split(order, cuts) if len(order) else [])]


def _to_blocks(pattern: str, buckets: int, documents: bool):
    """Rows of the blocks' documents, or of their word lists by bucket. What a
    block took is handed back before the next is cut."""
    def rows(ids: pa.Array, texts: pa.Array) -> list[tuple]:
        block, head, body, words = _block(ids, texts, pattern)
        return [(block, _SEQUENCE, head, body)] if documents else _listed(block, words, buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in steps(batch.column(1), BLOCK_BYTES):
                yield from _block_rows(rows(batch.column(0).slice(a, b - a),
                                            batch.column(1).slice(a, b - a)))
                hand_back()
            del batch
    return run


def _block_rows(rows: list[tuple], at_once: int = 64) -> Iterator[pa.RecordBatch]:
    for r in range(0, len(rows), at_once):
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*rows[r:r + at_once]), _BLOCK_SCHEMA)],
            schema=_BLOCK_SCHEMA)


def _encode_words(ranks: str, pattern: str):
    """Each distinct word of this task is encoded once, whatever the number of
    blocks that list it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = rank_encoding(ranks, pattern).encode_ordinary
        known: dict[bytes, bytes] = {}
        for batch in batches:
            for row in range(batch.num_rows):
                block, bucket, head, body = (c[row].as_py() for c in batch.columns)
                parts = []
                for words in _lists(_from_ipc(body).column(0).combine_chunks()):
                    for w in words:
                        if w not in known:
                            known[w] = np.array(encode(w.decode("utf-8", "replace")),
                                                "<u4").tobytes()
                    parts += [known[w] for w in words]
                sizes = np.array([len(p) // 4 for p in parts])
                ids = np.frombuffer(b"".join(parts), "<u4")
                sized = pack(sizes)
                yield from _block_rows([(block, bucket, head, len(sized).to_bytes(8, "little")
                                         + sized + pack(ids))])
    return run


_ENCODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])


def _reassemble(documents: pa.Table, lists: pa.Table) -> pa.Table:
    at, sizes, flat = [], [], []
    for head, body in zip(lists.column("head").to_pylist(), lists.column("body").to_pylist()):
        n = int.from_bytes(body[:8], "little")
        at.append(unpack(head))
        sizes.append(unpack(body[8:8 + n]))
        flat.append(unpack(body[8 + n:]))
    out = []
    if at:
        position, size, ids = np.concatenate(at), np.concatenate(sizes), np.concatenate(flat)
        ptr = np.zeros(len(size) + 1, dtype=np.int64)
        np.cumsum(size, out=ptr[1:])
        place = np.zeros(int(position.max()) + 1, dtype=np.int64)
        place[position] = np.arange(len(position))
    for head, body in zip(documents.column("head").to_pylist(),
                          documents.column("body").to_pylist()):
        docs = _from_ipc(head)
        sequence = unpack(body)
        starts = np.concatenate(([0], np.cumsum(docs.column("n").to_numpy())))
        if len(sequence):
            if not at:
                raise RuntimeError("a block's ids did not come back: its texts changed between reads")
            values, word_ptr = gather(ids, ptr, place[sequence])
            ends = word_ptr[starts]
        else:
            values, ends = np.zeros(0, np.int32), starts
        column = pa.ListArray.from_arrays(pa.array(ends, pa.int32()),
                                          pa.array(values.astype(np.int32)))
        out.append(pa.Table.from_arrays([docs.column("doc_id").combine_chunks(), column],
                                        schema=_ENCODED))
    return pa.concat_tables(out) if out else _ENCODED.empty_table()


def encode(docs: DataFrame, ranks: str = RANKS, pattern: str = PATTERN, id_col: str = "doc_id",
           text_col: str = "text", decoded: bool = False) -> DataFrame:
    """(doc_id, ids) of every row: byte-level BPE by the ranks in a file, each
    match of ``pattern`` on its own, without special tokens. With ``decoded``
    the rows are those of ``decode``, whose work is done by the same Python
    workers: one in each task more would stay with its memory after the job."""
    spark = docs.sparkSession
    ship_package(spark)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    lists = (texts.mapInArrow(give_back(_to_blocks(pattern, buckets, documents=False)), _BLOCKS)
             .repartitionById(buckets, F.col("bucket"))
             .mapInArrow(give_back(_encode_words(ranks, pattern)), _BLOCKS))
    documents = texts.mapInArrow(give_back(_to_blocks(pattern, buckets, documents=True)), _BLOCKS)
    met = documents.groupBy("block").cogroup(lists.groupBy("block"))
    if decoded:
        return met.applyInArrow(_reassemble_and_decode(ranks), _DECODED)
    return met.applyInArrow(_reassemble, "doc_id long, ids array<int>")


def _reassemble_and_decode(ranks: str):
    def run(documents: pa.Table, lists: pa.Table) -> pa.Table:
        batches = _reassemble(documents, lists).to_batches()
        schema = pa.schema([*_ENCODED, pa.field("decoded", pa.binary())])
        return pa.Table.from_batches(give_back(_decode(ranks))(iter(batches)), schema=schema)
    return run


@lru_cache(maxsize=1)
def _token_table(ranks: str) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all tokens end to end, and where each id's start."""
    table = rank_table(ranks)
    names = [b""] * (max(table.values()) + 1)
    for token, i in table.items():
        names[i] = token
    ptr = np.zeros(len(names) + 1, dtype=np.int64)
    np.cumsum([len(t) for t in names], out=ptr[1:])
    return np.frombuffer(b"".join(names), np.uint8), ptr


def decoded_bytes(column: pa.Array, flat: np.ndarray, ptr: np.ndarray) -> Iterator[bytes]:
    """The bytes of each list of ids, in bounded steps of whole lists."""
    ends = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)
    step = (ends[1:] - ends[0]) // DECODE_STEP
    cuts = [0, *(np.flatnonzero(np.diff(step)) + 1).tolist(), len(column)]
    for a, b in zip(cuts, cuts[1:]):
        data, starts = gather(flat, ptr, values[ends[a]:ends[b]])
        raw, at = data.tobytes(), starts[ends[a:b + 1] - ends[a]]
        for x, y in zip(at, at[1:]):
            yield raw[x:y]


_DECODED = "doc_id long, ids array<int>, decoded binary"


def _decode(ranks: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, ptr = _token_table(ranks)
        for batch in batches:
            raw = pa.array(decoded_bytes(batch.column(1), flat, ptr), pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, raw], names=["doc_id", "ids", "decoded"])
    return run


def decode(encoded: DataFrame, ranks: str = RANKS) -> DataFrame:
    """(doc_id, ids, decoded): the bytes that the ids stand for."""
    ship_package(encoded.sparkSession)
    return encoded.select("doc_id", "ids").mapInArrow(give_back(_decode(ranks)), _DECODED)


def digests(encoded: DataFrame, ranks: str = RANKS) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of encoded documents."""
    ship_package(encoded.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()),
                        ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, ptr = _token_table(ranks)
        for batch in batches:
            column = batch.column(1)
            ends = column.offsets.to_numpy()
            values = column.values.to_numpy(zero_copy_only=False).astype("<u4")
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(np.diff(ends), pa.int64()),
                pa.array([hashlib.sha256(values[a:b].tobytes()).hexdigest()
                          for a, b in zip(ends, ends[1:])], pa.string()),
                pa.array([hashlib.sha256(d).hexdigest()
                          for d in decoded_bytes(column, flat, ptr)], pa.string())],
                schema=schema)

    return encoded.select("doc_id", "ids").mapInArrow(
        give_back(run), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5: all documents, encoded and decoded."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return digests(encode(docs))
