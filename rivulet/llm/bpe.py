"""Byte-level BPE encoding and decoding by a global shuffle of distinct words.

Encoding: every text is cut into pre-tokens; a chunk of documents becomes its
list of distinct pre-tokens plus, per document, the positions packed as ranks
into that list.  The distinct pre-tokens of all chunks meet in one shuffle on
the word, where each distinct word is encoded once; the ids return to their
chunk and are put back by position.  Only (word, chunk) pairs and the packed
positions are shuffled, never one row per pre-token, so the most frequent word
is one row per chunk.

Decoding joins ids with the token-byte table (a position is the id).

Defined cases: a null text counts as empty; an empty text gives no ids and
decodes to no bytes; repeated rows are encoded each; a null id column value is
passed through; other columns are ignored (join them back on the id).  An
empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import sys
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from rivulet.llm.util import by_value, row_chunks

#: Characters of text per chunk: bounds what one task holds at a time.  A
#: larger chunk sends fewer (word, chunk) pairs.
CHUNK_CHARS = 14_000_000
#: Characters cut at a time within a chunk.
PIECE_CHARS = 1_000_000
#: Pre-tokens put back by position at a time.
PIECE_WORDS = 200_000
#: Distinct words returned per packed row.
PACK_WORDS = 100_000

_OTHER, _LETTER, _NUMBER, _SPACE = 0, 1, 2, 3
# White_Space of Unicode (fixed values).
_WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
          0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def _classes(points: np.ndarray) -> np.ndarray:
    """Class of each code point: letter, number, white space or other."""
    kind = {"L": _LETTER, "N": _NUMBER}
    table = np.zeros(sys.maxunicode + 1, np.uint8)
    table[points] = 1
    for c in np.flatnonzero(table).tolist():
        table[c] = kind.get(unicodedata.category(chr(c))[0], _OTHER)
    table[_WHITE] = _SPACE
    return table[points]


def pretoken_starts(points: np.ndarray, doc_starts: np.ndarray) -> np.ndarray:
    """Start of each pre-token of concatenated texts (code points), by the
    rules of the public pattern ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+|
    ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``.

    Runs of one class are tokens, with three amendments: of white space before
    something else the last character stands alone, a plain space joins what
    follows it, and an apostrophe that starts a token takes a contraction's
    letters with it.
    """
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    cls = _classes(points)
    first = np.zeros(n + 1, bool)
    first[doc_starts] = True  # an empty text's start is its successor's
    new = first[:n].copy()
    new[1:] |= cls[1:] != cls[:-1]
    run = np.flatnonzero(new)
    end = np.append(run[1:], n)
    followed = np.append(~first[run[1:]], False)  # by a run of the same text
    white = (cls[run] == _SPACE) & followed
    token = new
    token[end[white] - 1] = True
    joined = white & (points[end - 1] == 0x20)
    token[end[joined]] = False

    quote = np.flatnonzero((points == 0x27) & token)
    if len(quote):
        padded = np.append(points, [0, 0, 0])
        edge = np.append(first, [True, True])  # text ends at n too
        edge[n] = True
        a, b = padded[quote + 1], padded[quote + 2]
        one = np.isin(a, [ord(c) for c in "stmd"]) & ~edge[quote + 1]
        two = (((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))) \
            & ~edge[quote + 1] & ~edge[quote + 2]
        for at, size in ((quote[one], 2), (quote[two & ~one], 3)):
            token[at + 1] = False
            stop = at + size
            stop = stop[stop < n]
            token[stop] = True
    return np.flatnonzero(token)


def _cut(texts: list[str]) -> tuple[pa.Array, np.ndarray]:
    """The pre-tokens of texts in order, and their number in each text."""
    whole = "".join(texts)
    points = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
    doc = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))])
    starts = pretoken_starts(points, doc[:-1])
    counts = np.diff(np.searchsorted(starts, doc))
    wide = 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)
    offsets = np.concatenate([[0], np.cumsum(wide)])
    cuts = np.append(offsets[starts], offsets[-1]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(starts),
                                 [None, pa.py_buffer(cuts), pa.py_buffer(whole.encode())]), counts


def _words(rows: list[tuple]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct pre-tokens of a chunk (most frequent first), the rank of each
    pre-token, and the number of pre-tokens of each text."""
    pieces, counts, texts, size = [], [], [], 0
    for k, (_, t) in enumerate(rows):
        texts.append(t)
        size += len(t)
        if size >= PIECE_CHARS or k == len(rows) - 1:
            words, n = _cut(texts)
            pieces.append(words)
            counts.append(n)
            texts, size = [], 0
    coded = pa.chunked_array(pieces, pa.large_binary()).dictionary_encode().unify_dictionaries()
    words = coded.chunk(0).dictionary if coded.num_chunks else pa.array([], pa.large_binary())
    codes = np.concatenate([c.indices.to_numpy() for c in coded.chunks] or [np.zeros(0, np.int32)])
    often = np.bincount(codes, minlength=len(words))
    order = np.argsort(-often, kind="stable")
    rank = np.empty(len(order), np.uint32)
    rank[order] = np.arange(len(order), dtype=np.uint32)
    return words.take(pa.array(order)), rank[codes], np.concatenate(counts or [np.zeros(0, np.int64)])


def _chunk_id(rows: list[tuple]) -> int:
    """Name of a chunk by its content, the same in every execution."""
    h = hashlib.blake2b(digest_size=8)
    for i, t in rows:
        b = t.encode()
        h.update(f"{i!r}:{len(b)}:".encode())
        h.update(b)
    return int.from_bytes(h.digest(), "little", signed=True)


def _planes(values: np.ndarray, width: int) -> bytes:
    """Unsigned numbers as compressed byte planes."""
    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :width].T)
    if len(values) and int(values.max()) >> 8 * width:
        raise ValueError(f"a number does not fit {width} bytes")
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unplanes(data: bytes, width: int) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(width, -1)
    return sum((planes[k].astype(np.uint32) << np.uint32(8 * k) for k in range(1, width)), planes[0].astype(np.uint32))


def _encoder(ranks_path: str):
    import tiktoken
    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    # the whole string is one piece: words come ready cut
    return tiktoken.Encoding("byte_bpe", pat_str="(?s:.+)", mergeable_ranks=ranks, special_tokens={})


def _token_table(ranks_path: str) -> pa.Array:
    """Bytes of each token, at the position of its id."""
    with open(ranks_path, "rb") as f:
        table = {int(b): base64.b64decode(a) for a, b in map(bytes.split, f)}
    return pa.array([table.get(i) for i in range(max(table) + 1)], pa.binary())


def _bytes_of(ids: bytes, tokens: pa.Array) -> bytes:
    """Ids joined with the token-byte table."""
    got = tokens.take(pa.array(np.frombuffer(ids, "<u4")))
    if got.null_count:
        raise ValueError("an id is not in the vocabulary")
    if not len(got):
        return b""
    ends = np.frombuffer(got.buffers()[1], np.int32)[: len(got) + 1]
    return bytes(memoryview(got.buffers()[2])[ends[0]:ends[-1]])


def encode(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text",
           chunk_chars: int = CHUNK_CHARS, decoded: bool = False) -> DataFrame:
    """``(id_col, ids binary)``: one row per input row, ids as little-endian
    unsigned 32-bit integers.  ``decoded`` adds ``bytes``, the ids decoded as
    by :func:`decode`, without another pass through Python.

    ``docs`` is read by two branches, so it should be a stored table (or
    staged first); should they ever cut different chunks, the job fails
    instead of giving wrong ids.
    """
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = src.schema["id"].dataType.simpleString()
    id_kind = pa.list_(to_arrow_type(src.schema["id"].dataType))

    def vocabulary(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in row_chunks(batches, chunk_chars):
            words, _, _ = _words(rows)
            chunk = _chunk_id(rows)
            order = pc.sort_indices(words)  # neighbours compress well
            for at in range(0, len(words), PACK_WORDS):
                part = order.slice(at, PACK_WORDS)
                yield pa.RecordBatch.from_arrays(
                    [words.take(part).cast(pa.binary()), pa.array(np.full(len(part), chunk, np.int64)),
                     part.cast(pa.int32())], ["word", "chunk", "rank"])

    def positions(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in row_chunks(batches, chunk_chars):
            words, ranks, counts = _words(rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array([_chunk_id(rows)], pa.int64()),
                 pa.array([[i for i, _ in rows]], id_kind),
                 pa.array([counts.astype(np.int32)]),
                 pa.array([len(words)], pa.int32()),
                 pa.array([_planes(ranks, 3)], pa.binary())],
                ["chunk", "ids", "counts", "n_words", "seq"])

    def encode_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by word: each distinct word is encoded at its first
        row; what one chunk gets back travels as one row."""
        enc = _encoder(ranks_path)
        last, coded, held = None, (), {}
        n = 0

        def flush():
            keys = list(held)
            ranks, sizes, ids = [], [], []
            for k in keys:
                r, c = held[k]
                order = sorted(range(len(r)), key=r.__getitem__)
                r = np.array(r, np.int64)[order]
                ranks.append(_planes(np.diff(r, prepend=0), 3))
                sizes.append(_planes(np.array([len(c[j]) for j in order], np.int64), 3))
                ids.append(_planes(np.array([x for j in order for x in c[j]], np.int64), 3))
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), *(pa.array(x, pa.binary()) for x in (ranks, sizes, ids))],
                ["chunk", "ranks", "sizes", "coded"])

        for b in batches:
            for word, chunk, rank in zip(*(b.column(k).to_pylist() for k in range(3))):
                if word != last:
                    last, coded = word, enc.encode_ordinary(word.decode())
                got = held.get(chunk)
                if got is None:
                    got = held[chunk] = ([], [])
                got[0].append(rank)
                got[1].append(coded)
                n += 1
                if n >= PACK_WORDS:
                    yield flush()
                    n = 0
        if held:
            yield flush()

    def reassemble(key, left, right):
        """Ids of one chunk's documents, by position."""
        tokens = _token_table(ranks_path) if decoded else None
        ids, out = [], []
        if left.num_rows:
            n_words = left.column("n_words")[0].as_py()
            where = np.full(n_words, -1, np.int64)
            sizes, coded, base = [], [], 0
            for r, s, c in zip(*(right.column(k).to_pylist() for k in ("ranks", "sizes", "coded"))):
                r = np.cumsum(_unplanes(r, 3), dtype=np.int64)
                where[r] = np.arange(base, base + len(r))
                base += len(r)
                sizes.append(_unplanes(s, 3))
                coded.append(_unplanes(c, 3))
            # chunks of equal content share a name, and each sent its words
            if base != n_words * left.num_rows or n_words and (where < 0).any():
                raise RuntimeError("the words of a chunk do not match: the documents changed between two reads")
            sizes = np.concatenate(sizes or [np.zeros(0, np.uint32)]).astype(np.int64)
            coded = np.concatenate(coded or [np.zeros(0, np.uint32)])
            begin = np.cumsum(sizes) - sizes
            for i, c, _, seq in zip(*(left.column(k).to_pylist() for k in ("ids", "counts", "n_words", "seq"))):
                ids += i
                seq, bound = _unplanes(seq, 3), np.concatenate([[0], np.cumsum(c)])
                doc = 0
                while doc < len(c):  # documents of about PIECE_WORDS together
                    stop = max(doc + 1, int(np.searchsorted(bound, bound[doc] + PIECE_WORDS, "right")) - 1)
                    at = where[seq[bound[doc]:bound[stop]]]
                    end = np.cumsum(sizes[at])
                    flat = coded[np.repeat(begin[at] - end + sizes[at], sizes[at]) + np.arange(end[-1] if len(end) else 0)]
                    cut = np.concatenate([[0], end])[bound[doc:stop + 1] - bound[doc]]
                    out += [flat[a:b].astype("<u4").tobytes() for a, b in zip(cut[:-1], cut[1:])]
                    doc = stop
        kind = left.schema.field("ids").type.value_type
        cols = {"id": pa.array(ids, kind), "ids": pa.array(out, pa.binary())}
        if decoded:
            cols["bytes"] = pa.array((_bytes_of(x, tokens) for x in out), pa.binary())
        return pa.table(cols)

    words = src.mapInArrow(vocabulary, "word binary, chunk bigint, rank int")
    words = words.repartition("word").sortWithinPartitions("word")
    coded = words.mapInArrow(encode_words, "chunk bigint, ranks binary, sizes binary, coded binary")
    seqs = src.mapInArrow(positions, f"chunk bigint, ids array<{id_type}>, counts array<int>, n_words int, seq binary")
    out = seqs.groupBy("chunk").cogroup(coded.groupBy("chunk")).applyInArrow(
        reassemble, f"id {id_type}, ids binary" + ", bytes binary" * decoded)
    return out.withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, ranks_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``(id_col, ids_col, bytes binary)``: each id joined with its bytes.
    The token-byte table has one row per token of the fixed vocabulary."""
    id_type = encoded.schema[id_col].dataType.simpleString()

    def join_bytes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _token_table(ranks_path)
        for b in batches:
            for at in range(0, b.num_rows, 64):  # bounded pieces of possibly long texts
                part = b.slice(at, 64)
                whole = [_bytes_of(ids or b"", tokens) for ids in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(whole, pa.binary())],
                                                 [id_col, ids_col, "bytes"])

    return encoded.select(id_col, ids_col).mapInArrow(
        join_bytes, f"`{id_col}` {id_type}, `{ids_col}` binary, bytes binary")


by_value(__name__)
