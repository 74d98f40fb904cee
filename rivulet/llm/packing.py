"""Sequence packing by non-negative least squares on the length histogram.

A document is its token ids and an end id.  Windows of ``window`` tokens are cut
off its front; the remainder (shorter than a window) is what is to be packed.

1. The histogram of remainder lengths (at most ``window - 1`` bins) is all that
   the driver sees.
2. *Combinations*: every way to fill a window with one to ``DEPTH`` remainders
   whose lengths occur.
3. *Non-negative least squares*: repeat counts whose lengths add up to the
   histogram, by multiplicative updates (each keeps the counts non-negative and
   lowers the squared error).
4. *Rounding*: counts are rounded with their error carried on from combination
   to combination, never beyond the remainders that are there.
5. *Residuals*: greedy, on counts of lengths, not on rows: the longest length
   first, then the longest that fits; what is left of the window is cut off the
   longest remainder there is, and its rest goes back to the counts.  A pattern
   is repeated as often as its lengths allow at once, so a length that a third
   of all documents share takes a few steps.  The last windows are powers of
   two, which need no padding.

The plan says for each length which ranks go where.  A remainder's rank among
those of its length is a per-task running number (stored with the ids) and the
numbers of the tasks before: a prefix sum over tasks, not over rows.  No row
meets another one: every task cuts its own documents.

Defined cases: a null text counts as empty (the end id alone); repeated rows are
packed each; a null id stays null; an empty table gives no rows; texts of any
length are encoded whole; special tokens in a text are ordinary text; other
columns are ignored (join them back on the id).
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterable, Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from rivulet.llm.bpe import _words
from rivulet.llm.util import by_value, row_chunks, stage

#: Remainders in a combination that least squares plans, at most.
DEPTH = 3
#: Multiplicative updates.
UPDATES = 150
#: Characters encoded at a time, and distinct pre-tokens whose ids a task keeps.
CHUNK_CHARS = 4_000_000
KNOWN = 500_000
#: Distinct pre-tokens that the library gets in one string, and pre-tokens whose ids are put in place at a time.
LINE = 200
PIECE_WORDS = 50_000
#: Tokens of documents that are cut at a time.
CUT_TOKENS = 1_000_000

#: A plan: for ranks ``[start, stop)`` of a length, the first sequence, the
#: offset there, the tokens taken, and the length (0: none) and first rank of
#: what the cut leaves.
PLAN = ("length", "start", "stop", "sequence", "offset", "take", "rest", "rest_start")


def combinations(lengths: np.ndarray, window: int) -> np.ndarray:
    """``(count, DEPTH)`` lengths that add up to ``window``, falling, zeros
    where there are fewer; at most about ``window ** 2 / 12``."""
    has = np.zeros(window + 1, bool)
    has[lengths] = True
    out = []
    a = np.flatnonzero(has)
    b = window - a
    pair = (b > 0) & (b <= a)
    pair &= has[np.where(pair, b, 0)]
    out.append(np.stack([a[pair], b[pair], np.zeros(pair.sum(), int)], 1))
    for x in a.tolist():
        y = a[(a <= x) & (a < window - x)]
        z = window - x - y
        fit = (z <= y) & has[z]
        out.append(np.stack([np.full(fit.sum(), x), y[fit], z[fit]], 1))
    return np.concatenate(out) if out else np.zeros((0, DEPTH), int)


def repeats(combos: np.ndarray, histogram: np.ndarray, updates: int = UPDATES) -> np.ndarray:
    """Non-negative least squares: counts x with ``sum of x by length`` close
    to the histogram."""
    if not len(combos):
        return np.zeros(0)
    size = len(histogram)
    weight = np.ones(size)
    weight[0] = 0  # places that a combination leaves empty
    goal = histogram * weight

    def back(v):
        return (v * weight)[combos].sum(axis=1)

    def lengths(x):
        return np.bincount(combos.ravel(), np.repeat(x, DEPTH), size) * weight

    target = back(goal)
    x = target / max(target.sum(), 1) * histogram[1:].sum() / 2
    for _ in range(updates):
        x = x * target / np.maximum(back(lengths(x)), 1e-300)
    return x


def rounded(combos: np.ndarray, x: np.ndarray, histogram: np.ndarray) -> np.ndarray:
    """Whole counts: the error is carried on, no length is used up twice."""
    left, carry = histogram.tolist(), 0.0
    out = np.zeros(len(x), np.int64)
    order = np.argsort(-x, kind="stable")
    for i, v in zip(order.tolist(), x[order].tolist()):
        carry += v
        want = int(carry)
        if want < 1:
            continue
        need: dict[int, int] = {}
        for n in combos[i].tolist():
            if n:
                need[n] = need.get(n, 0) + 1
        got = min(want, *(left[n] // c for n, c in need.items()))
        for n, c in need.items():
            left[n] -= got * c
        carry -= want
        out[i] = got
    return out


def plan(histogram: np.ndarray, window: int) -> tuple[np.ndarray, int]:
    """Plan rows (columns :data:`PLAN`) that place every remainder counted in
    ``histogram`` (by length, 0 to ``window - 1``), and the number of
    sequences."""
    left = histogram.astype(np.int64).tolist()
    made = [0] * len(left)  # ranks given out
    rows: list[tuple] = []
    sequence = 0

    def put(pieces: list[tuple[int, int]], times: int) -> None:
        """``pieces``: length, tokens taken (less: the rest goes back)."""
        nonlocal sequence
        offset = 0
        for length, take in pieces:
            start, rest = made[length], length - take
            rows.append((length, start, start + times, sequence, offset, take, rest, made[rest] + left[rest] if rest else 0))
            made[length] += times
            left[length] -= times
            if rest:
                left[rest] += times
            offset += take
        sequence += times

    combos = combinations(np.flatnonzero(histogram), window)
    counts = rounded(combos, repeats(combos, histogram.astype(float)), histogram)
    for c, times in zip(combos[counts > 0].tolist(), counts[counts > 0].tolist()):
        put([(n, n) for n in c if n], times)

    tokens = sum(n * c for n, c in enumerate(left))
    while tokens:
        room = window if tokens >= window else 1 << (tokens.bit_length() - 1)
        held = [n for n in range(len(left) - 1, 0, -1) if left[n]]
        used: dict[int, int] = {}
        pieces, space = [], room
        for n in held:
            fit = min(space // n, left[n])
            if fit:
                used[n] = fit
                pieces += [(n, n)] * fit
                space -= fit * n
            if not space:
                break
        if space:  # cut the longest remainder that is left over
            cut = next(n for n in held if left[n] > used.get(n, 0))
            used[cut] = used.get(cut, 0) + 1
            pieces.append((cut, space))
        times = min(left[n] // c for n, c in used.items()) if room == window else 1
        put(pieces, times)
        tokens -= room * times
    return np.array(rows, np.int64).reshape(-1, len(PLAN)), sequence


class Places:
    """A plan as tasks read it: by length, then by rank."""

    def __init__(self, rows: np.ndarray):
        rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
        self.length, self.start, self.stop = rows[:, 0], rows[:, 1], rows[:, 2]
        self.rest = rows[:, 3:]
        self.span = int(self.stop.max(initial=0)) + 1
        self.key = self.length * self.span + self.start

    def pieces(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, ...]:
        """Remainder (its number here), sequence, offset and tokens of each
        piece of these remainders; those of one in the order of its tokens."""
        out = [(np.zeros(0, np.int64),) * 4]
        own = np.flatnonzero(length)
        length, rank = length[own], rank[own]
        while len(own):
            i = np.searchsorted(self.key, length * self.span + rank, "right") - 1
            if (i < 0).any() or (self.length[i] != length).any() or (rank >= self.stop[i]).any():
                raise RuntimeError("a document is not in the plan: the stored ids changed between two reads")
            nth = rank - self.start[i]
            sequence, offset, take, rest, rest_start = self.rest[i].T
            out.append((own, sequence + nth, offset, take))
            more = rest > 0
            own, length, rank = own[more], rest[more], (rest_start + nth)[more]
        return tuple(map(np.concatenate, zip(*out)))


class Coder:
    """Ids of texts by the tokenizers library: each distinct pre-token of a
    chunk is encoded once, and the last ``KNOWN`` ones are kept.  The library
    gets ``LINE`` of them in one string, where its own pattern cuts them off from
    each other; the bytes of the tokens tell whose they are, and should they not
    fit, the pre-tokens are encoded one by one.  A text with a code point that
    this Python's Unicode tables do not have (which may be cut otherwise by the
    library's) is encoded whole."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers
        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True  # their strings in a text are ordinary text
        cut = self.tok.pre_tokenizer
        self.joins = isinstance(cut, pre_tokenizers.ByteLevel) and cut.use_regex and not cut.add_prefix_space \
            and self.tok.normalizer is None
        vocab = self.tok.get_vocab()
        self.wide = np.zeros(max(vocab.values()) + 1, np.int64)  # bytes of each token: a character stands for one
        self.wide[np.fromiter(vocab.values(), np.int64, len(vocab))] = np.fromiter(map(len, vocab), np.int64, len(vocab))
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}  # a word's place in begin and size
        self.begin = self.size = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _places(self, words: pa.Array) -> np.ndarray:
        """Where ``begin`` and ``size`` have the words, new ones learnt."""
        if len(self.known) > KNOWN:  # a chunk's words may go beyond it
            self._forget()
        at = np.fromiter(map(self.known.get, _list(words), repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(at < 0)
        fresh = words.take(pa.array(new))
        alone = np.ones(len(new), bool)
        for end, fit in self._joinable(fresh):
            part = np.flatnonzero(fit)
            if len(part) and self._learn_lines(fresh.take(pa.array(part)), end):
                alone[part] = False
                at[new[part]] = np.arange(len(self.begin) - len(part), len(self.begin))
        part = np.flatnonzero(alone)
        own = _list(fresh.take(pa.array(part)))
        coded = self._batch([w.decode() for w in own])
        size = np.fromiter(map(len, coded), np.int64, len(coded))
        self._add(own, np.fromiter(chain.from_iterable(coded), np.uint32, int(size.sum())), np.cumsum(size) - size, size)
        at[new[part]] = np.arange(len(self.begin) - len(part), len(self.begin))
        return at

    def _joinable(self, words: pa.Array) -> list[tuple[bytes, np.ndarray]]:
        """Words that the library cuts off from each other if these bytes come
        after each: a space and a plain character (after anything), or a plain
        character (after a line break)."""
        if not self.joins or not len(words):
            return []
        begin, data = _buffers(words)
        first, second = data[begin[:-1]], data[np.minimum(begin[:-1] + 1, len(data) - 1)]

        def plain(x: np.ndarray) -> np.ndarray:  # no white space: ASCII, and two bytes from U+00C0 on
            return (x > 0x20) & (x < 0x7F) | (x >= 0xC3) & (x < 0xE0)
        return [(b"", (first == 0x20) & (np.diff(begin) > 1) & plain(second)), (b"\n", plain(first))]

    def _learn_lines(self, words: pa.Array, end: bytes) -> bool:
        """Words encoded ``LINE`` at a time, each with ``end`` after it; false,
        and nothing learnt, if a token is not of one word alone."""
        joined = pc.binary_join_element_wise(words, pa.scalar(b"", words.type), pa.scalar(end, words.type)) if end else words
        begin, data = _buffers(joined)
        text = data.tobytes()
        cuts = begin[[*range(0, len(words), LINE), len(words)]].tolist()
        ids = np.concatenate([np.array(x, np.uint32) for x in self._batch([text[a:b].decode() for a, b in zip(cuts, cuts[1:])])])
        edge = np.concatenate([[0], np.cumsum(self.wide[ids])])
        stop = begin[1:] - len(end)
        a, b = np.searchsorted(edge, begin[:-1]), np.searchsorted(edge, stop)
        if edge[-1] != begin[-1] or (edge[a] != begin[:-1]).any() or (edge[b] != stop).any():
            return False
        self._add(_list(words), ids, a, b - a)
        return True

    def _add(self, words: list[bytes], ids: np.ndarray, begin: np.ndarray, size: np.ndarray) -> None:
        self.known.update(zip(words, range(len(self.begin), len(self.begin) + len(words))))
        self.begin = np.append(self.begin, len(self.ids) + begin)
        self.size = np.append(self.size, size)
        self.ids = np.append(self.ids, ids)

    def _batch(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        odd = _unassigned(texts)
        whole = {k: np.array(x, np.uint32) for k, x in zip(odd, self._batch([texts[k] for k in odd]))}
        rows = [(k, "" if k in whole else t) for k, t in enumerate(texts)]
        words, ranks, counts = _words(rows)
        at = self._places(words)
        begin, size = self.begin[at], self.size[at]
        out: list[np.ndarray] = []
        bound = np.concatenate([[0], np.cumsum(counts)])
        while len(out) < len(texts):  # texts of about PIECE_WORDS together
            doc = len(out)
            stop = max(doc + 1, int(np.searchsorted(bound, bound[doc] + PIECE_WORDS, "right")) - 1)
            r = ranks[bound[doc]:bound[stop]]
            n = size[r]
            end = np.concatenate([[0], np.cumsum(n)])
            ids = self.ids[np.repeat(begin[r] - end[:-1], n) + np.arange(end[-1])]
            edge = end[bound[doc:stop + 1] - bound[doc]].tolist()
            out += [ids[a:b] for a, b in zip(edge, edge[1:])]
        for k, x in whole.items():
            out[k] = x
        return out


def _buffers(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where each word begins (and the last ends), and the bytes of all."""
    if not len(words):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    begin = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
    return begin - begin[0], np.frombuffer(words.buffers()[2], np.uint8)[begin[0]:begin[-1]]


def _list(words: pa.Array) -> list[bytes]:
    begin, data = _buffers(words)
    text, begin = data.tobytes(), begin.tolist()
    return [text[a:b] for a, b in zip(begin, begin[1:])]


def _unassigned(texts: list[str]) -> list[int]:
    """Texts with a code point that is not assigned here."""
    table = np.zeros(sys.maxunicode + 1, bool)
    for t in texts:
        if not t.isascii():
            table[np.frombuffer(t.encode("utf-32-le"), np.uint32)] = True
    strange = {chr(c) for c in np.flatnonzero(table).tolist() if unicodedata.category(chr(c)) == "Cn"}
    return [k for k, t in enumerate(texts) if not strange.isdisjoint(t)] if strange else []


def _tokens(path: str, window: int, end_id: int, kind: str, id_kind: pa.DataType):
    """Ids of every text, with the running numbers that ranks are made of."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from pyspark import TaskContext
        coder, end = Coder(path), np.array([end_id], kind).tobytes()
        part, seen, full = TaskContext.get().partitionId(), [0] * window, 0
        for rows in row_chunks(batches, CHUNK_CHARS):
            ids, size, nth, before = [], [], [], []
            for x in coder([t for _, t in rows]):
                n = len(x) + 1
                ids.append(x.astype(kind).tobytes() + end)
                size.append(n)
                nth.append(seen[n % window])
                before.append(full)
                seen[n % window] += 1
                full += n // window
            yield pa.RecordBatch.from_arrays(
                [pa.array([i for i, _ in rows], id_kind), pa.array(ids), pa.array(size, pa.int64()),
                 pa.array([part] * len(rows), pa.int32()), pa.array([n % window for n in size], pa.int32()),
                 pa.array(nth, pa.int64()), pa.array(before, pa.int64())],
                ["id", "ids", "size", "part", "rest", "nth", "before"])
    return run


def _cut(shared, window: int, first: int, kind: str):
    """The pieces of every document; ``first``: the sequences of whole
    windows."""
    names = ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]

    def pieces(b: pa.RecordBatch) -> pa.RecordBatch:
        size, rest, rank, whole = (b.column(k).to_numpy().astype(np.int64) for k in range(2, 6))
        own, sequence, offset, take = shared.value.pieces(rest, rank)
        full = size // window
        doc = np.repeat(np.arange(b.num_rows), full)
        nth = np.arange(len(doc)) - (np.cumsum(full) - full)[doc]
        order = np.argsort(np.concatenate([doc, own]), kind="stable")  # by document, whole windows first
        sequence = np.concatenate([whole[doc] + nth, first + sequence])[order]
        offset = np.concatenate([np.zeros_like(doc), offset])[order]
        take = np.concatenate([np.full_like(doc, window), take])[order]
        doc = np.concatenate([doc, own])[order]
        end = np.cumsum(take)  # the pieces of a document are its ids in order
        x = np.frombuffer(b"".join(b.column(1).to_pylist()), kind).astype("<u4")
        if end[-1] != len(x):
            raise RuntimeError("a document is not in the plan: the stored ids changed between two reads")
        ids = pa.Array.from_buffers(pa.binary(), len(doc), [
            None, pa.py_buffer(np.concatenate([[0], 4 * end]).astype(np.int32)), pa.py_buffer(x)])
        start = end - take - (np.cumsum(size) - size)[doc]
        return pa.RecordBatch.from_arrays(
            [b.column(0).take(pa.array(doc)), *map(pa.array, (start, take)), ids,
             *map(pa.array, (size[doc], sequence, offset))], names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bound = np.concatenate([[0], np.cumsum(b.column(2).to_numpy())])
            doc = 0
            while doc < b.num_rows:  # documents of about CUT_TOKENS together
                stop = max(doc + 1, int(np.searchsorted(bound, bound[doc] + CUT_TOKENS, "right")) - 1)
                yield pieces(b.slice(doc, stop - doc))
                doc = stop
    return run


def pack(docs: DataFrame, tokenizer_path: str, window: int = 2048, end_id: int = 1, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per piece: ``id_col``, ``start`` (ids of its document before
    it), ``length``, ``ids`` (little-endian unsigned 32-bit), ``doc_tokens``
    (with the end id), ``sequence_id`` (dense from 0) and ``offset``.

    A sequence holds ``window`` ids or, at the very end, a power of two.
    ``tokenizer_path``: a file of the public tokenizers library.
    """
    from pyspark.sql.pandas.types import to_arrow_type
    from tokenizers import Tokenizer
    spark = docs.sparkSession
    src = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    id_type = src.schema["id"].dataType
    id_kind = to_arrow_type(id_type)
    small = max(Tokenizer.from_file(tokenizer_path).get_vocab_size() - 1, end_id) < 2 ** 16
    kind = "<u2" if small else "<u4"
    coded = stage(src.mapInArrow(
        _tokens(tokenizer_path, window, end_id, kind, id_kind),
        f"id {id_type.simpleString()}, ids binary, size bigint, part int, rest int, nth bigint, before bigint"), "packing-ids")

    # Remainders by task and length (length -1: whole windows), and how many the tasks before have.
    counts = coded.groupBy("part", "rest").agg(F.count("*").alias("n"), F.sum(F.expr(f"size div {window}")).alias("whole"))
    counts = counts.select("part", F.explode(F.array(F.struct("rest", "n"), F.struct(
        F.lit(-1).alias("rest"), F.col("whole").alias("n")))).alias("c")).groupBy("part", "c.rest").agg(F.sum("c.n").alias("n"))
    before = Window.partitionBy("rest").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = stage(counts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0).cast("bigint"))), "packing-bases")
    histogram = np.zeros(window, np.int64)
    whole = 0
    for rest, n in bases.groupBy("rest").agg(F.sum("n")).collect():  # at most window + 1 rows
        if rest < 0:
            whole = n
        else:
            histogram[rest] = n
    rows, _ = plan(histogram, window)
    shared = spark.sparkContext.broadcast(Places(rows))  # at most window ** 2 / 4 rows and those of the residuals

    base = (bases.where("rest >= 0").select("part", "rest", "base")
            .join(bases.where("rest < 0").select("part", F.col("base").alias("whole")), "part"))
    placed = coded.join(base, ["part", "rest"]).select(
        "id", "ids", "size", "rest", (F.col("base") + F.col("nth")).alias("rank"), (F.col("whole") + F.col("before")).alias("whole"))
    out = placed.mapInArrow(_cut(shared, window, whole, kind),
                            f"id {id_type.simpleString()}, start bigint, length bigint, ids binary, doc_tokens bigint, "
                            "sequence_id bigint, offset bigint")
    return out.withColumnRenamed("id", id_col)


by_value(__name__)
