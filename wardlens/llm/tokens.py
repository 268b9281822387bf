"""Cutting texts where byte-level BPE pre-tokenisation cannot look across, and
encoding each distinct piece once.

The pre-tokeniser's pattern never matches across a single space that stands
between two characters that are not white space: the match before ends there
and the next one begins with the space, whatever surrounds them. A text may
therefore be cut before every such space; the ids of the whole are the ids of
the pieces, one after another. Words repeat, so the pieces of a batch are
dictionary-encoded in Arrow and only the distinct ones are encoded.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = 0x20
# Lists that ``gather`` puts together in one vectorised step.
GATHER_STEP = 1 << 14


def steps(column: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts hold about ``most`` bytes; a text is never cut."""
    lengths = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    step = np.cumsum(lengths.astype(np.int64)) // most
    cuts = [0, *(np.flatnonzero(np.diff(step)) + 1).tolist(), len(column)]
    return ((a, b) for a, b in zip(cuts, cuts[1:]) if a < b)


def cut(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Pieces of ``texts`` (null counts as empty) and where each text's start."""
    column = pa.array(pc.fill_null(texts.cast(pa.large_binary()), b""))
    offsets = np.frombuffer(column.buffers()[1], np.int64)[
        column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw if raw is not None else b"", np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    bound = np.zeros(len(data) + 1, dtype=bool)
    bound[offsets] = True
    at = np.flatnonzero(data == SPACE)
    at = at[~(bound[at] | bound[at + 1])]
    before, after = data[at - 1], data[at + 1]
    safe = (before > SPACE) & (after > SPACE) & (after != 0xC2) & ~_wide(after)
    # Characters beyond ASCII that may be white space start with C2 or E1-E3.
    beyond = np.flatnonzero(safe & (before >= 0x80))
    lead = at[beyond]
    safe[beyond] = (data[lead - 2] != 0xC2) & ~_wide(data[np.maximum(lead - 3, 0)])
    bound[at[safe]] = True
    bounds = np.flatnonzero(bound)
    if not len(data):
        bounds = np.zeros(1, dtype=np.int64)
    pieces = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(bounds) - 1,
        [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))])
    return pieces, np.searchsorted(bounds, offsets)


def _wide(byte: np.ndarray) -> np.ndarray:
    return (byte >= 0xE1) & (byte <= 0xE3)


def distinct(pieces: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, pa.Array]:
    """Index of each piece into the distinct pieces, and these."""
    if isinstance(pieces, pa.ChunkedArray):
        coded = pieces.dictionary_encode().unify_dictionaries().combine_chunks()
        if isinstance(coded, pa.ChunkedArray):
            coded = coded.chunk(0)
    else:
        coded = pieces.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary


def gather(flat: np.ndarray, ptr: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lists ``flat[ptr[i]:ptr[i + 1]]`` for each i in ``index``, end to
    end, and where each starts. The places in ``flat`` are made for some lists
    at a time: for all they would take several times the memory of the result."""
    out = np.zeros(len(index) + 1, dtype=np.int64)
    np.cumsum(np.diff(ptr)[index], out=out[1:])
    values = np.empty(out[-1], flat.dtype)
    for a in range(0, len(index), GATHER_STEP):
        ends = out[a:a + GATHER_STEP + 1]
        first = ptr[:-1][index[a:a + GATHER_STEP]]
        at = np.arange(ends[0], ends[-1]) + np.repeat(first - ends[:-1], np.diff(ends))
        values[ends[0]:ends[-1]] = flat[at]
    return values, out


def _plain(pieces: pa.Array) -> np.ndarray:
    """Which pieces hold one blank, in front, and no white space after it or at
    the end: these may be joined and told apart again by their blanks. The same
    bytes as in ``cut`` are taken for white space."""
    offsets = _offsets(pieces)
    raw = pieces.buffers()[2]
    data = np.frombuffer(raw if raw is not None else b"", np.uint8)
    size = np.diff(offsets)
    out = size > 1
    start, end = offsets[:-1][out], offsets[1:][out]
    blanks = np.concatenate(([0], np.cumsum(data == SPACE)))
    after, last = data[start + 1], data[end - 1]
    fine = (data[start] == SPACE) & (blanks[end] - blanks[start] == 1)
    fine &= (after > SPACE) & (after != 0xC2) & ~_wide(after) & (last > SPACE)
    fine &= (last < 0x80) | ((data[end - 2] != 0xC2) & ~_wide(data[np.maximum(end - 3, 0)]))
    out[out] = fine
    return out


def _offsets(pieces: pa.Array) -> np.ndarray:
    return np.frombuffer(pieces.buffers()[1], np.int64)[pieces.offset:pieces.offset + len(pieces) + 1]


def encode_pieces(pieces: pa.Array, encode: Callable[[list[str]], list[list[int]]],
                  begins: Callable[[np.ndarray], np.ndarray],
                  group: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """The ids of every piece, end to end, and where each piece's start. Plain
    pieces are encoded many at a time; ``begins`` marks the ids that start with
    a blank, one per piece."""
    plain = _plain(pieces)
    order, flats, sizes = [], [], []
    joined = np.flatnonzero(plain)
    alone = [np.flatnonzero(~plain)]
    for g in range(0, len(joined), group):
        some = joined[g:g + group]
        taken = pieces.take(pa.array(some))
        ends = _offsets(taken)
        text = taken.buffers()[2].to_pybytes()[ends[0]:ends[-1]].decode("utf-8", "replace")
        ids = np.array(encode([text])[0], np.int64)
        starts = np.flatnonzero(begins(ids))
        if len(starts) == len(some) and starts[0] == 0:
            order.append(some)
            flats.append(ids)
            sizes.append(np.diff(np.append(starts, len(ids))))
        else:
            alone.append(some)
    rest = np.concatenate(alone)
    texts = [p.decode("utf-8", "replace") for p in pieces.take(pa.array(rest)).to_pylist()]
    lists = encode(texts) if texts else []
    order.append(rest)
    flats.append(np.fromiter(chain.from_iterable(lists), np.int64))
    sizes.append(np.array([len(x) for x in lists], np.int64))
    place = np.empty(len(pieces), np.int64)
    place[np.concatenate(order)] = np.arange(len(pieces))
    ptr = np.concatenate(([0], np.cumsum(np.concatenate(sizes))))
    return gather(np.concatenate(flats), ptr, place)


class PieceEncoder:
    """Ids of the distinct pieces of a block. Up to ``keep`` parts of pieces are
    remembered with their ids for the next block."""

    def __init__(self, encode: Callable[[list[str]], list[list[int]]],
                 token_bytes: dict[int, bytes], keep: int = 400_000):
        self.encode, self.keep = encode, keep
        self.known = pa.array([], pa.large_binary())
        self.flat, self.ptr = np.zeros(0, np.uint32), np.zeros(1, np.int64)
        self.spaced = np.zeros(max(token_bytes) + 1, dtype=bool)
        self.spaced[[i for i, b in token_bytes.items() if b[:1] == b" "]] = True

    def _ids_of(self, names: pa.Array) -> np.ndarray:
        """The places among the known parts of distinct ones, after those that
        are new have been encoded."""
        at = pc.index_in(names, value_set=self.known)
        new = at.is_null().to_numpy(zero_copy_only=False)
        place = pc.fill_null(at, 0).to_numpy(zero_copy_only=False).astype(np.int64)
        if len(self.known) + at.null_count > self.keep:
            # Parts that this block uses stay.
            used = place[~new]
            self.known = self.known.take(pa.array(used))
            self.flat, self.ptr = gather(self.flat, self.ptr, used)
            place[~new] = np.arange(len(used))
        place[new] = len(self.known) + np.arange(np.count_nonzero(new))
        if new.any():
            parts = names.filter(pa.array(new))
            flat, ptr = encode_pieces(parts, self.encode, lambda x: self.spaced[x])
            self.known = pa.concat_arrays([self.known, parts])
            self.ptr = np.concatenate((self.ptr, ptr[1:] + len(self.flat)))
            self.flat = np.concatenate((self.flat, flat.astype(np.uint32)))
        return place

    def ids(self, pieces: pa.Array | list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces end to end, and where each piece's start. Words
        are encoded apart from the marks that close them, each once."""
        if isinstance(pieces, list):
            pieces = pa.array(pieces, pa.large_binary())
        parts, first = _words_and_marks(pieces)
        coded = parts.dictionary_encode()
        place = self._ids_of(coded.dictionary)
        flat, starts = gather(self.flat, self.ptr,
                              place[coded.indices.to_numpy(zero_copy_only=False)])
        return flat, starts[first]


def _words_and_marks(pieces: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The pieces with the marks after a word of plain letters cut off, as the
    pattern cuts between letters and marks, and where each piece's parts start."""
    text = pieces.cast(pa.large_string())
    word = pc.utf8_rtrim(text, characters=".,;:!?")
    plain = pc.and_(pc.starts_with(word, " "), pc.utf8_is_alpha(pc.utf8_slice_codeunits(word, 1)))
    size = pc.binary_length(text).to_numpy(zero_copy_only=False).astype(np.int64)
    stem = pc.binary_length(word).to_numpy(zero_copy_only=False).astype(np.int64)
    closed = plain.to_numpy(zero_copy_only=False) & (stem < size)
    offsets = _offsets(pieces)
    bounds = np.sort(np.concatenate((offsets, (offsets[:-1] + stem)[closed])))
    parts = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(bounds) - 1,
        [None, pa.py_buffer(bounds), pieces.buffers()[2] or pa.py_buffer(b"")])
    first = np.concatenate(([0], np.cumsum(1 + closed)))
    return parts, first


@lru_cache(maxsize=4)
def rank_table(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a rank file (base64 token, blank, id per line)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


@lru_cache(maxsize=4)
def rank_encoding(path: str, pattern: str):
    import tiktoken
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=rank_table(path),
                             special_tokens={})


@lru_cache(maxsize=4)
def rank_encoder(path: str, pattern: str) -> PieceEncoder:
    encoding = rank_encoding(path, pattern)
    return PieceEncoder(lambda texts: [encoding.encode_ordinary(t) for t in texts],
                        {i: b for b, i in rank_table(path).items()})


@lru_cache(maxsize=4)
def library_encoder(path: str, plain: bool) -> PieceEncoder:
    """Of a byte-level BPE file of the tokenizers library. The strings of special
    tokens in a text are ordinary text if ``plain``, else, as by the library's
    default, these tokens."""
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = plain

    def encode(texts: list[str]) -> list[list[int]]:
        return [x.ids for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    # A leading space is written as this letter in the file's tokens.
    return PieceEncoder(encode, {i: t.replace("Ġ", " ").encode()
                                 for t, i in tokenizer.get_vocab().items()})
