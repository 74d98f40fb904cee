"""Exact repeated-passage removal by super-k-mer partitioning.

A window is ``k`` consecutive words of one text.  Its minimiser is the least
hash among its ``m``-word grams; consecutive windows with one minimiser travel
as one packed string (their words, joined by single spaces) to the minimiser's
bucket, where equal windows always meet.  In a bucket:

* a string that occurs earlier is repeated as a whole: all its windows are;
* the windows of different strings are sorted by exact ranks of their word
  sequences (rank doubling over a dictionary of the words, no hashes) and all
  but the earliest of each sequence are repeated.

Within a chunk of documents equal strings are combined before the shuffle, so
a passage that a third of all documents share is sent once per chunk.  A
bucket that outgrows ``BUCKET_BYTES`` (a common gram in many contexts) is not
held: its windows go on as rows, counted by a plain aggregate.  The word
ranges found return to their document, whose text is cut.

Order is that of (id, start).  Defined cases: a null or empty text, or one
with fewer than ``k`` words, loses nothing; a null id comes before all others;
rows that repeat an id are judged by (id, start), so equal rows under one id
do not remove each other, and each row gets its own result; other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from rivulet.llm.util import by_value, row_chunks, stage

WINDOW = 20
#: Words of a gram.  Short grams make long super-k-mers, so less is sent twice.
GRAM = 2
#: Grams with fewer bytes per word than this are common words: they come last
#: in the minimisers' order, so that no bucket gathers a common phrase.
PLAIN_BYTES = 5
#: Characters of text per chunk of the first step.
CHUNK_CHARS = 4_000_000
#: Windows that one packed string holds at most (runs of one repeated word).
RUN = 256
#: Packed bytes of one bucket held in a task; a larger bucket goes on as rows.
BUCKET_BYTES = 32_000_000

_LEAST = -(1 << 63)  # stands for a null id
_TWICE = 1 << 30


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values."""
    step, out = 1, x
    while step * 2 <= width:
        out = np.minimum(out[:-step], out[step:])
        step *= 2
    rest = width - step
    return np.minimum(out[:len(out) - rest], out[rest:]) if rest else out


def _word_array(line: bytes, sizes: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The words of single-spaced ``line`` without copying, and their starts."""
    cuts = np.concatenate([[0], np.cumsum(sizes + 1)])
    words = pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(cuts.astype(np.int64)),
                                                                 pa.py_buffer(line)])  # each with its space
    return words, cuts[:-1]


def superkmers(texts: list[str], k: int, m: int):
    """``(doc index, first word, windows, minimiser, packed, twice)`` of all
    texts; ``twice``: the minimiser occurs more than once in the string, so
    its own windows may be equal."""
    import xxhash
    lists = [t.encode().split() for t in texts]
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    flat = [w for x in lists for w in x]
    none = np.zeros(0, np.int64)
    if len(flat) < k:
        return none, none, none, none, pa.array([], pa.binary()), none.astype(bool)
    line = b" ".join(flat) + b" "
    sizes = np.fromiter(map(len, flat), np.int64, len(flat))
    words, at = _word_array(line, sizes)
    coded = words.dictionary_encode()
    table = np.array([xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()], np.uint64)
    hashes = table[coded.indices.to_numpy()]
    grams = len(flat) - m + 1
    gram = np.zeros(grams, np.uint64)
    for j in range(m):
        gram = _mix(gram * np.uint64(0xD6E8FEB86659FD93) + hashes[j:j + grams])
    length = np.concatenate([[0], np.cumsum(sizes)])
    plain = length[m:] - length[:-m] < PLAIN_BYTES * m
    gram = gram >> np.uint64(1) | plain.astype(np.uint64) << np.uint64(63)
    least = sliding_min(gram, k - m + 1)  # of the window at each word
    stop = np.cumsum(counts)
    doc = np.repeat(np.arange(len(lists)), counts)[:len(least)]
    place = np.arange(len(least))
    valid = place + k <= stop[doc]
    new = valid.copy()
    new[1:] &= ~valid[:-1] | (least[1:] != least[:-1])
    first = np.flatnonzero(new)
    if not len(first):
        return none, none, none, none, pa.array([], pa.binary()), none.astype(bool)
    ends = np.flatnonzero(valid & ~np.append(valid[1:] & ~new[1:], False)) + 1
    long_ = ends - first > RUN
    if long_.any():
        parts = -(-(ends - first) // RUN)
        base = np.repeat(first, parts)
        nth = np.arange(len(base)) - np.repeat(np.cumsum(parts) - parts, parts)
        ends = np.minimum(np.repeat(ends, parts), base + (nth + 1) * RUN)
        first = base + nth * RUN
    last = ends + k - 2  # last word of the last window
    lo, hi = at[first].tolist(), (at[last] + sizes[last]).tolist()
    packed = pa.array([line[a:b] for a, b in zip(lo, hi)], pa.binary())
    mini, runs = least[first], ends - first
    seen = np.zeros(len(first), np.int64)
    for j in range(min(int(runs.max()), k - m + 1) + k - m):
        inside = np.flatnonzero(j < runs + k - m)
        seen[inside] += gram[first[inside] + j] == mini[inside]
    owner = doc[first]
    return owner, first - (stop - counts)[owner], runs, (mini >> np.uint64(16)).view(np.int64), packed, (seen > 1) | (runs > k - m + 1)


def window_ranks(codes: np.ndarray, k: int) -> np.ndarray:
    """Equal numbers for equal sequences of ``k`` codes, by rank doubling."""
    def join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.unique(a[:len(b)].astype(np.int64) << 32 | b.astype(np.int64), return_inverse=True)[1]

    out, have, step, power = None, 0, 1, codes
    while True:
        if k & step:
            out, have = (power, step) if out is None else (join(out, power[have:]), have + step)
        if step * 2 > k:
            return out
        power = join(power, power[step:])
        step *= 2


def repeated_windows(group: np.ndarray, packed: pa.Array, ids: np.ndarray, starts: np.ndarray,
                     k: int) -> tuple[np.ndarray, np.ndarray]:
    """String index and offset of every window whose sequence occurs earlier
    in its group of strings."""
    lists = pc.split_pattern(packed, b" ")
    size = np.diff(lists.offsets.to_numpy()).astype(np.int64)
    codes = lists.values.dictionary_encode().indices.to_numpy()
    ranks = window_ranks(codes, k)
    owner = np.repeat(np.arange(len(packed)), size - k + 1)
    begin = np.cumsum(size) - size
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(size - k + 1) - (size - k + 1), size - k + 1)
    rank = ranks[begin[owner] + offset]
    order = np.lexsort((starts[owner] + offset, ids[owner], rank, group[owner]))
    g, r = group[owner][order], rank[order]
    i, s = ids[owner][order], (starts[owner] + offset)[order]
    head = np.ones(len(order), bool)
    head[1:] = (g[1:] != g[:-1]) | (r[1:] != r[:-1])
    lead = np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))
    again = (i > i[lead]) | (s > s[lead])  # equal (id, start): the same place
    return owner[order][again], offset[order][again]


_OUT = pa.schema([("id", pa.int64()), ("h", pa.int64()), ("ranges", pa.binary()), ("win", pa.binary()),
                  ("start", pa.int32())])
_OUT_DDL = "id bigint, h bigint, ranges binary, win binary, start int"


def _ranges(ids, hs, lo, hi) -> pa.RecordBatch:
    """One row per run of equal (id, h), with its word ranges packed."""
    if not len(ids):
        return pa.RecordBatch.from_pylist([], schema=_OUT)
    order = np.lexsort((lo, hs, ids))
    ids, hs = ids[order], hs[order]
    pairs = np.stack([lo[order], hi[order]], 1).astype("<i4")
    head = np.flatnonzero(np.append(True, (ids[1:] != ids[:-1]) | (hs[1:] != hs[:-1])))
    tail = np.append(head[1:], len(ids))
    n = len(head)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids[head]), pa.array(hs[head]),
         pa.array([pairs[a:b].tobytes() for a, b in zip(head.tolist(), tail.tolist())], pa.binary()),
         pa.nulls(n, pa.binary()), pa.nulls(n, pa.int32())], schema=_OUT)


def _split_texts(k: int, m: int, chunk_chars: int):
    # start: with _TWICE where the minimiser occurs twice; null where packed
    # holds ranges that are known already
    schema = pa.schema([("mini", pa.int64()), ("packed", pa.binary()), ("id", pa.int64()), ("h", pa.int64()),
                        ("start", pa.int32())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = (pa.RecordBatch.from_arrays([pa.StructArray.from_arrays([b.column(0), b.column(1)], ["id", "h"]),
                                             b.column(2)], ["key", "text"]) for b in batches)
        for rows in row_chunks(pairs, chunk_chars):
            doc, start, n, mini, packed, twice = superkmers([t for _, t in rows], k, m)
            if not len(doc):
                continue
            ids = np.array([r["id"] for r, _ in rows], np.int64)[doc]
            hs = np.array([r["h"] for r, _ in rows], np.int64)[doc]
            # equal strings of a chunk: the first goes on, the others are repeats
            code = packed.dictionary_encode().indices.to_numpy()
            order = np.lexsort((start, ids, code))
            head = np.ones(len(order), bool)
            c = code[order]
            head[1:] = c[1:] != c[:-1]
            lead = np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))
            i, s = ids[order], start[order]
            again = order[(i > i[lead]) | (s > s[lead])]
            keep = np.ones(len(order), bool)
            keep[again] = False
            keep = np.flatnonzero(keep)
            for at in range(0, len(keep), 50_000):
                p = keep[at:at + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(mini[p]), packed.take(pa.array(p)), pa.array(ids[p]), pa.array(hs[p]),
                     pa.array((start[p] + twice[p] * _TWICE).astype(np.int32))], schema=schema)
            known = _ranges(ids[again], hs[again], start[again], start[again] + n[again] + k - 1)
            if known.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(known.column(0).to_numpy() ^ known.column(1).to_numpy()), known.column(2),
                     known.column(0), known.column(1), pa.nulls(known.num_rows, pa.int32())], schema=schema)

    return run


def _judge_buckets(k: int, bucket_bytes: int):
    def judge(t: pa.Table) -> pa.RecordBatch:
        """Complete buckets, sorted by (mini, packed, id, start)."""
        mini = t["mini"].to_numpy()
        ids, hs, marked = t["id"].to_numpy(), t["h"].to_numpy(), t["start"].to_numpy().astype(np.int64)
        start = marked % _TWICE
        packed = t["packed"].combine_chunks()
        code = packed.dictionary_encode().indices.to_numpy()
        spaces = pc.count_substring(packed, b" ").to_numpy().astype(np.int64)
        head = np.ones(len(mini), bool)
        head[1:] = (mini[1:] != mini[:-1]) | (code[1:] != code[:-1])
        lead = np.maximum.accumulate(np.where(head, np.arange(len(mini)), 0))
        again = (ids > ids[lead]) | (start > start[lead])
        one = np.flatnonzero(~again)
        out = [(ids[again], hs[again], start[again], start[again] + spaces[again] + 1)]
        new = np.append(True, mini[one][1:] != mini[one][:-1])
        group = np.cumsum(new) - 1
        many = (np.bincount(group)[group] > 1) | (marked[one] >= _TWICE)
        # equal strings of equal place (rows that repeat an id) stay together
        if many.any():
            part = one[many]
            who, off = repeated_windows(group[many], packed.take(pa.array(part)), ids[part], start[part], k)
            who = part[who]
            out.append((ids[who], hs[who], start[who] + off, start[who] + off + k))
        return _ranges(*(np.concatenate(x) for x in zip(*out)))

    def as_rows(t: pa.Table) -> Iterator[pa.RecordBatch]:
        """Windows of a bucket too large to hold."""
        rows = t.select(["packed", "id", "h", "start"]).to_pylist()
        for at in range(0, len(rows), 2_000):
            got = []
            for r in rows[at:at + 2_000]:
                words = r["packed"].split(b" ")
                start = r["start"] % _TWICE
                got += [{"id": r["id"], "h": r["h"], "ranges": None, "win": b" ".join(words[j:j + k]),
                         "start": start + j} for j in range(len(words) - k + 1)]
            yield pa.RecordBatch.from_pylist(got, schema=_OUT)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size, large = 0, None
        for b in batches:
            done = b.filter(pc.is_null(b["start"]))
            if done.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [done["id"], done["h"], done["packed"], pa.nulls(done.num_rows, pa.binary()),
                     pa.nulls(done.num_rows, pa.int32())], schema=_OUT)
            b = b.filter(pc.is_valid(b["start"]))
            if large is not None:
                same = pc.equal(b["mini"], large)
                rest = b.filter(same)
                yield from as_rows(pa.Table.from_batches([rest]))
                b = b.filter(pc.invert(same))
                if not b.num_rows:
                    continue
                large = None
            if not b.num_rows:
                continue
            held.append(b)
            size += b.nbytes
            if size < bucket_bytes // 4:
                continue
            t = pa.Table.from_batches(held)
            mini = t["mini"].to_numpy()
            cut = int(np.searchsorted(mini, mini[-1]))  # the last bucket may go on
            if cut:
                yield judge(t.slice(0, cut))
            t = t.slice(cut)
            if t.nbytes > bucket_bytes:
                large = t["mini"][0]
                yield from as_rows(t)
                held, size = [], 0
            else:
                held, size = t.to_batches(), t.nbytes if cut else size
        if held:
            yield judge(pa.Table.from_batches(held))

    return run


def _cut(id_type: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept, words, removed = [], [], []
            for text, ranges in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                w = (text or "").encode().split()
                n = len(w)
                if ranges:
                    edge = np.zeros(n + 1, np.int64)
                    pairs = np.frombuffer(b"".join(ranges), "<i4").reshape(-1, 2)
                    np.add.at(edge, pairs[:, 0], 1)
                    np.add.at(edge, pairs[:, 1], -1)
                    w = [w[i] for i in np.flatnonzero(np.cumsum(edge[:n]) == 0).tolist()]
                kept.append(b" ".join(w).decode())
                words.append(n)
                removed.append(n - len(w))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(kept, pa.string()), pa.array(words, pa.int64()),
                                              pa.array(removed, pa.int64())], ["id", "kept", "n_words", "n_removed"])
    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = WINDOW,
                   m: int = GRAM, chunk_chars: int = CHUNK_CHARS, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``(id_col, kept, n_words, n_removed)``, one row per input row: the
    text's words that no repeated window covers, joined by one space.
    ``id_col`` is an integer column."""
    src = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    src = src.select(F.coalesce("id", F.lit(_LEAST)).alias("id"), F.xxhash64("text").bitwiseAND(F.lit(0xFFFFFFFF)).alias("h"),
                     "text")  # h tells apart rows that repeat an id
    id_type = docs.schema[id_col].dataType.simpleString()

    sent = src.mapInArrow(_split_texts(k, m, chunk_chars),
                          "mini bigint, packed binary, id bigint, h bigint, start int")
    buckets = sent.repartition("mini").sortWithinPartitions("mini", "packed", "id", "start")
    found = stage(buckets.mapInArrow(_judge_buckets(k, bucket_bytes), _OUT_DDL), "repeats")
    ranges = found.where("ranges is not null").select("id", "h", "ranges")
    rows = found.where("win is not null").select("win", "id", "h", "start")
    if not rows.isEmpty():
        low = rows.groupBy("win").agg(F.min("id").alias("i"))
        low = rows.join(low, "win").where("id = i").groupBy("win", "i").agg(F.min("start").alias("s"))
        again = rows.join(low, "win").where("id > i or start > s")
        ranges = ranges.union(again.select("id", "h", _pair(F.col("start"), F.col("start") + F.lit(k))))
    ranges = ranges.groupBy("id", "h").agg(F.collect_list("ranges").alias("ranges"))
    out = (src.join(ranges, ["id", "h"], "left").select("id", "text", "ranges")
           .mapInArrow(_cut(id_type), "id bigint, kept string, n_words bigint, n_removed bigint"))
    return out.select(F.nullif("id", F.lit(_LEAST)).cast(id_type).alias(id_col), "kept", "n_words", "n_removed")


def _pair(lo, hi):
    """Two ints as the 8 bytes that a packed range has (little-endian)."""
    def le(c):
        return F.unhex(F.concat(*[F.lpad(F.hex(F.shiftright(c, 8 * i).bitwiseAND(F.lit(255)).cast("bigint")), 2, "0")
                                  for i in range(4)]))
    return F.concat(le(lo.cast("int")), le(hi.cast("int"))).alias("ranges")


by_value(__name__)
