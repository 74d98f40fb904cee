"""Benchmark decontamination by SimHash windows under a multi-index, in DataFrame
functions only.

Words are runs of letters and digits, lower-cased.  A window has as many words as
a benchmark item and may begin at every word of a text; it gets a 64-bit SimHash
over its two-word grams (each occurrence counts), and so does every item.

1. *Windows.*  A window of similarity ``THRESHOLD`` to an item of its length shares
   at least ``THRESHOLD * (a + b) / (1 + THRESHOLD)`` of its ``a`` shingles with it
   (``b``: the item's).  Every position of every text is looked up among the
   shingles of all items of a length, and every window with so many positions found
   is laid, whatever its start.  The others cannot be similar to any item: nothing
   is sampled or stepped over.
2. *Multi-index.*  The fingerprints of all windows laid (equal ones once) are looked
   up among those of all items of the length: 64 bits are cut into ``BLOCKS`` blocks
   of 16, and two fingerprints within ``RADIUS`` bits have a block in which they
   differ by at most ``RADIUS // BLOCKS``.  Both sides list the values near their own
   in each block (items within two bits, windows within one), so that all such pairs
   meet in an equi-join.
3. *Verdict.*  Pairs within the radius are verified exactly: weighted (multiset)
   Jaccard similarity of shingles of ``SHINGLE`` words, ``THRESHOLD`` or more.

At similarity 0.8 the grams of window and item agree in at least 0.92 (a cut edge;
an edit inside costs more shingles and so agrees more): 8.2 bits on average,
deviation 2.7, so the radius of 15 keeps over 99 of 100 of the worst pairs.

Texts are scanned once for the shingles, and once more for the words of texts with
windows.  The shingles of the items are broadcast up to ``PART_CHARS`` characters of
item texts; beyond that they are joined by a shuffle.

Defined cases: null or empty texts match nothing; an item shorter than a shingle
is one shingle, so that its words must occur as they are; items without words
match nothing; a text shorter than an item is one window; repeated rows and items
each count; a null id keeps its row; other columns are ignored (``clean`` passes
them on, clashing names included); empty tables give an empty result.

:func:`search` does the same over a list of texts in one process, fingerprinting
every window by running bit counts; tests hold the two against each other.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from rivulet.llm.host_quality import let
from rivulet.llm.util import free, stage

SHINGLE = 5
THRESHOLD = 0.8
RADIUS = 15
BLOCKS = 4
#: Characters of distinct item texts whose shingles are broadcast.
PART_CHARS = 32_000_000
#: Windows whose places in the texts are broadcast.
FEW_WINDOWS = 500_000
#: Block tables that a search keeps.
TABLE_BYTES = 96_000_000
#: Words in a chunk, and windows whose bit counts are taken at a time.
CHUNK, STEP = 65_536, 8_192
#: Characters whose words are cut at a time.
SLICE = 200_000
#: Distinct words whose hashes a search remembers.
MEMORY = 1_000_000

_WORD = re.compile(r"[^\W_]+")
_GAP = re.compile(r"[\W_]")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def shingles_of(w: list[str], size: int) -> Counter:
    """Shingles with their weights (numbers of occurrences)."""
    if len(w) < size:
        return Counter([tuple(w)] if w else [])
    return Counter(zip(*[w[j:] for j in range(size)]))


def similarity(a: Counter, b: Counter) -> float:
    both = sum(min(n, b[s]) for s, n in a.items() if s in b)
    return both / (a.total() + b.total() - both) if both else 0.0


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hashes(dict):
    """64-bit hashes of words, remembered up to ``MEMORY`` words."""

    def __missing__(self, word: str) -> int:
        if len(self) >= MEMORY:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


class Counts:
    """Running bit counts of the two-word grams of a chunk of words."""

    def __init__(self, words: list[str], hashes: Hashes):
        self.words = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
        grams = _mix(self.words[:-1] * np.uint64(0x9E3779B97F4A7C15) + self.words[1:])
        self.bits = np.unpackbits(grams.view(np.uint8)).reshape(-1, 64)
        self.out = {}
        self.sums: dict[type, np.ndarray] = {}

    def _sum(self, dtype: type) -> np.ndarray:
        if dtype not in self.sums:
            out = np.zeros((len(self.words), 64), dtype)
            np.cumsum(self.bits, axis=0, dtype=dtype, out=out[1:])  # wraps; differences do not
            self.sums[dtype] = out
        return self.sums[dtype]

    def windows(self, first: int, last: int, size: int, step: int = 1) -> np.ndarray:
        """Fingerprints of the windows of ``size`` words that start at
        ``first`` and each ``step`` words after it, before ``last``."""
        if size == 1:
            return _mix(self.words[first:last:step])
        s = self._sum(np.uint8 if size <= 256 else np.uint32)
        lo, hi = s[first:last:step], s[first + size - 1:last + size - 1:step]
        if s.dtype not in self.out:  # the same memory for each length
            self.out[s.dtype] = np.empty((STEP, 64), s.dtype), np.empty((STEP, 64), bool)
        n, bit = (x[:len(lo)] for x in self.out[s.dtype])
        np.subtract(hi, lo, out=n)
        np.greater(n, (size - 1) // 2, out=bit)
        return np.packbits(bit.ravel()).view(np.uint64)


def fingerprint(words: list[str]) -> int:
    return int(Counts(words, Hashes()).windows(0, 1, len(words))[0])


def block_tables(fps: np.ndarray, radius: int) -> np.ndarray:
    """For each block and each of its values, the mask of fingerprints (at
    most 64) that differ there by ``radius // BLOCKS`` bits at most."""
    kind = next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if len(fps) <= 8 * np.dtype(t).itemsize)
    tables = np.zeros((BLOCKS, 1 << 16), kind)
    values = np.arange(1 << 16, dtype=np.uint16)
    for b in range(BLOCKS):
        own = (fps >> np.uint64(16 * b)).astype(np.uint16)
        for j, v in enumerate(own):
            tables[b] |= (np.bitwise_count(values ^ v) <= radius // BLOCKS).astype(kind) << kind(j)
    return tables


def near(tables: np.ndarray, fps: np.ndarray, windows: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs within ``radius``: positions of windows, numbers of fingerprints."""
    blocks = windows.view(np.uint16).reshape(-1, BLOCKS)
    mask = tables[0].take(blocks[:, 0], mode="clip")
    for b in range(1, BLOCKS):
        mask |= tables[b].take(blocks[:, b], mode="clip")
    some = np.flatnonzero(mask)
    at, j = np.divmod(np.flatnonzero(np.unpackbits(mask[some].view(np.uint8), bitorder="little")), 8 * mask.itemsize)
    at = some[at]
    close = np.bitwise_count(windows[at] ^ fps[j]) <= radius
    return at[close], j[close]


class Index:
    """Items of one part, grouped by length, with their block tables."""

    def __init__(self, items: list[tuple[int, str]], shingle: int, radius: int):
        self.radius, self.shingle = radius, shingle
        by_size = defaultdict(list)
        for key, text in items:
            if w := words_of(text):
                by_size[len(w)].append((key, fingerprint(w), shingles_of(w, shingle)))
        self.groups = [(n, own[k:k + 64]) for n, own in sorted(by_size.items()) for k in range(0, len(own), 64)]
        self.longest = max(by_size, default=0)
        self._kept: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self._bytes = 0

    def tables(self, g: int) -> tuple[np.ndarray, np.ndarray]:
        if g in self._kept:
            return self._kept[g]
        fps = np.array([fp for _, fp, _ in self.groups[g][1]], np.uint64)
        out = fps, block_tables(fps, self.radius)
        if self._bytes + out[1].nbytes <= TABLE_BYTES:
            self._kept[g] = out
            self._bytes += out[1].nbytes
        return out


def slices(text: str | None) -> Iterator[list[str]]:
    """Words of a text, cut at a time from about ``SLICE`` characters."""
    text = (text or "").lower()
    at = 0
    while at < len(text):
        gap = _GAP.search(text, min(at + SLICE, len(text)))
        end = gap.start() if gap else len(text)
        yield _WORD.findall(text, at, end)
        at = end


def chunks_of(rows: Iterable[str | None], longest: int) -> Iterator[tuple[list[str], list[tuple[int, int, int, bool]]]]:
    """Words of texts in chunks, with pieces ``(row, start in the chunk,
    first word's place in the text, whether the text is whole)``."""
    limit = max(CHUNK, 4 * longest)
    words: list[str] = []
    pieces: list[tuple[int, int, int, bool]] = []
    for row, text in enumerate(rows):
        place, begin = 0, len(words)
        for cut in slices(text):
            while len(words) + len(cut) > limit:
                room = limit - len(words)
                words += cut[:room]
                cut = cut[room:]
                pieces.append((row, begin, place, False))
                yield words, pieces
                keep = min(limit - begin, longest - 1)
                place += limit - begin - keep
                words, pieces, begin = words[limit - keep:], [], 0
            words += cut
        if len(words) > begin:
            pieces.append((row, begin, place, place == 0))
    if pieces:
        yield words, pieces


def search(index: Index, rows: Iterable[str | None], threshold: float) -> dict[tuple[int, int], tuple[float, int]]:
    """Best ``(similarity, -start)`` of each ``(row, item key)``."""
    best: dict[tuple[int, int], tuple[float, int]] = {}
    hashes = Hashes()

    def verify(words: list[str], piece: tuple, start: int, size: int, item: tuple) -> None:
        row, begin, place, _ = piece
        s = similarity(shingles_of(words[start:start + size], index.shingle), item[2])
        if s >= threshold:
            new = (s, -(place + start - begin))
            best[row, item[0]] = max(best.get((row, item[0]), new), new)

    for words, pieces in chunks_of(rows, index.longest):
        counts = Counts(words, hashes)
        begins = np.array([p[1] for p in pieces])
        ends = np.append(begins[1:], len(words))
        whole = np.array([p[3] for p in pieces])
        short = {int(i): counts.windows(int(begins[i]), int(begins[i]) + 1, int(ends[i] - begins[i]))[0]
                 for i in np.flatnonzero(whole & (ends - begins < index.longest))}
        for g, (size, items) in enumerate(index.groups):
            fps, tables = index.tables(g)
            for first in range(0, len(words) - size + 1, STEP):
                last = min(first + STEP, len(words) - size + 1)
                at, js = near(tables, fps, counts.windows(first, last, size), index.radius)
                at = at + first
                own = np.searchsorted(begins, at, "right") - 1
                inside = at + size <= ends[own]  # the others run over into another text
                for a, i, j in zip(at[inside].tolist(), own[inside].tolist(), js[inside].tolist()):
                    verify(words, pieces[i], a, size, items[j])
            # a text shorter than the item is one window; it cannot be similar with too few shingles
            few = [i for i in short if ends[i] - begins[i] < size
                   and ends[i] - begins[i] - index.shingle + 1 >= threshold * (size - index.shingle + 1) > 0]
            if few:
                at, js = near(tables, fps, np.array([short[i] for i in few], np.uint64), index.radius)
                for i, j in zip((few[a] for a in at), js):
                    verify(words, pieces[i], int(begins[i]), int(ends[i] - begins[i]), items[j])
    return best


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def _gram(w: Column, p: Column, size: int) -> Column:
    """Hash of ``size`` words from the one numbered ``p``."""
    return F.xxhash64(*[F.get(w, p + j) for j in range(size)])


def _simhash(w: Column) -> Column:
    """64-bit SimHash of a word array over its two-word grams (of the word, if
    it is a single one)."""
    grams = F.when(F.size(w) == 1, F.array(F.xxhash64(F.get(w, F.lit(0))))).otherwise(
        F.transform(F.sequence(F.lit(0), F.greatest(F.size(w) - 2, F.lit(0))), lambda p: _gram(w, p, 2)))

    def bits(h: Column) -> Column:
        def one(b: Column) -> Column:
            n = F.aggregate(h, F.lit(0), lambda s, x: s + F.getbit(x, b).cast("int"))
            return F.when(2 * n > F.size(h), F.call_function("shiftleft", F.lit(1).cast("bigint"), b)).otherwise(
                F.lit(0).cast("bigint"))
        return F.aggregate(F.transform(F.sequence(F.lit(0), F.lit(63)), one), F.lit(0).cast("bigint"),
                           lambda s, x: s.bitwiseOR(x))

    return let(grams, bits)


def _shingles(w: Column, size: Column) -> Column:
    """Shingles of a word array, each with the number of its occurrence."""
    plain = F.transform(F.sequence(F.lit(0), F.size(w) - size), lambda p: F.array_join(F.slice(w, p + 1, size), " "))

    def numbered(s: Column) -> Column:
        nth = F.transform(s, lambda x, j: F.concat_ws(" ", x, F.size(F.filter(F.slice(s, 1, j), lambda y: y == x))
                                                      .cast("string")))
        return F.when(F.size(F.array_distinct(s)) == F.size(s), F.transform(s, lambda x: F.concat(x, F.lit(" 0")))) \
            .otherwise(nth)

    return let(plain, numbered)


def _near_values(df: DataFrame, fp: str, bits: int) -> DataFrame:
    """A row for each block ``b`` and each of its values ``v`` within ``bits``
    bits of the fingerprint's own."""
    width = 64 // BLOCKS
    masks = [sum(1 << k for k in c) for n in range(bits + 1) for c in combinations(range(width), n)]
    blocks = [F.struct(F.lit(b).alias("b"), F.shiftrightunsigned(F.col(fp), width * b).bitwiseAND(F.lit((1 << width) - 1))
                       .cast("int").alias("own")) for b in range(BLOCKS)]
    df = df.select("*", F.inline(F.array(*blocks)))
    return df.select("*", F.explode(F.lit(masks)).alias("mask")).withColumn("v", F.col("own").bitwiseXOR(F.col("mask"))) \
        .drop("own", "mask")


def near_pairs(windows: DataFrame, items: DataFrame, radius: int) -> DataFrame:
    """``(wkey, n, ikey)`` of the fingerprints ``fp`` of ``windows`` and ``ifp``
    of ``items`` with equal ``n`` that differ by ``radius`` bits at most."""
    bits = radius // BLOCKS
    left = _near_values(windows.select("wkey", "n", "fp"), "fp", bits // 2)
    right = _near_values(items.select("ikey", "n", "ifp"), "ifp", bits - bits // 2)
    close = F.bit_count(F.col("fp").bitwiseXOR(F.col("ifp"))) <= radius
    return left.join(right, ["n", "b", "v"]).where(close).select("wkey", "n", "ikey").distinct()


def _lay(found: DataFrame, threshold: float) -> DataFrame:
    """All windows ``(id, h, n, start, size)`` that can be similar to an item of
    ``n`` words, from the places ``ps`` of its length's shingles (``k`` words
    each) in a text of ``len`` words.  A window belongs to the first place in it."""
    a = F.least("n", "len") - F.col("k") + 1
    need = F.ceil((a + F.col("n") - F.col("k") + 1) * F.lit(threshold / (1 + threshold)) - 1e-9)
    df = found.select("*", a.alias("a"), F.greatest(need.cast("int"), F.lit(1)).alias("need")).where("size(ps) >= need")
    df = df.select("*", F.posexplode("ps").alias("i", "p"))
    df = df.select("*", F.get("ps", F.col("i") - 1).alias("before"), F.get("ps", F.col("i") + F.col("need") - 1).alias("last"))
    low = F.greatest(F.coalesce(F.col("before") + 1, F.lit(0)), F.col("last") - F.col("a") + 1, F.lit(0))
    high = F.least(F.col("p"), F.col("len") - F.least("n", "len"))
    df = df.where(F.col("last").isNotNull()).select("*", low.alias("low"), high.alias("high")).where("low <= high")
    return df.select("id", "h", "n", F.explode(F.sequence("low", "high")).alias("start"), F.least("n", "len").alias("size"))


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            item_col: str = "item_id", item_text: str = "text", threshold: float = THRESHOLD,
            radius: int = RADIUS, shingle: int = SHINGLE, part_chars: int = PART_CHARS) -> DataFrame:
    """``(id_col, h, item_col, start, similarity)``: the best window of every
    text and item with a similarity of ``threshold`` or more; ``h`` is the
    text's xxhash64, ``start`` the window's first word."""
    items = benchmark.select(F.col(item_col).alias("item"), _words(F.col(item_text).cast("string")).alias("iw"))
    items = stage(items.where(F.size("iw") > 0).select("*", F.xxhash64("iw").alias("ikey")), "benchmark")
    texts = items.groupBy("ikey").agg(F.first("iw").alias("iw")).withColumn("n", F.size("iw"))
    texts = texts.withColumn("k", F.least("n", F.lit(shingle)))
    texts = stage(texts.select("ikey", "n", "k", "iw", _simhash(F.col("iw")).alias("ifp"),
                               _shingles(F.col("iw"), F.col("k")).alias("ish")), "benchmark-texts")
    sizes = sorted(k for k, in texts.select("k").distinct().collect()) or [shingle]  # at most ``shingle``
    chars = texts.agg(F.sum(F.length(F.array_join("iw", " ")))).first()[0] or 0

    def held(df: DataFrame, small: bool) -> DataFrame:
        return F.broadcast(df) if small else df

    grams = reduce(DataFrame.union, [
        texts.where(F.col("k") == k).select("n", "k", F.explode(F.transform(
            F.sequence(F.lit(0), F.col("n") - k), lambda p: _gram(F.col("iw"), p, k))).alias("g"))
        for k in sizes]).distinct()

    # The places of every text whose shingle is one of an item, by the item's length.
    src = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("h"),
                      F.col(text_col).cast("string").alias("text"))
    src = src.where(F.col("text").isNotNull())
    w = F.col("w")
    at = src.select("id", "h", _words(F.col("text")).alias("w"))
    at = at.select("id", "h", "w", F.posexplode(F.slice(w, 1, F.greatest(F.size(w) - (sizes[0] - 1), F.lit(0)))).alias("p", "x"))
    if len(sizes) == 1:
        at = at.select("id", "h", F.size(w).alias("len"), "p", _gram(w, F.col("p"), sizes[0]).alias("g"))
    else:
        at = at.select("id", "h", F.size(w).alias("len"), "p", F.explode(F.array(*[
            F.when(F.col("p") + k <= F.size(w), _gram(w, F.col("p"), k)) for k in sizes])).alias("g"))
    found = at.join(held(grams, chars <= part_chars), "g").groupBy("id", "h", "n", "k").agg(
        F.sort_array(F.collect_set("p")).alias("ps"), F.max("len").alias("len"))
    laid = stage(_lay(found, threshold), "windows")

    # Their words, by a second scan of the texts that have windows.
    places = laid.groupBy("id", "h").agg(F.collect_list(F.struct("n", "start", "size")).alias("at")) \
        .select(F.col("id").alias("id2"), F.col("h").alias("h2"), "at")
    own = src.join(held(places, laid.count() <= FEW_WINDOWS), (F.col("h") == F.col("h2")) & F.col("id").eqNullSafe(F.col("id2")))
    own = own.select("id", "h", "at", _words(F.col("text")).alias("w"))
    own = own.select("id", "h", "w", F.inline("at"))
    own = own.select("id", "h", "n", "start", F.slice(w, F.col("start") + 1, F.col("size")).alias("win"))
    own = stage(own.withColumn("wkey", F.xxhash64("win")), "window-words")
    wins = own.groupBy("wkey", "n").agg(F.first("win").alias("win"))
    wins = stage(wins.withColumn("fp", _simhash(F.col("win"))), "fingerprints")

    pairs = stage(near_pairs(wins, texts, radius), "near")
    both = F.size(F.array_intersect("wsh", "ish"))
    similar = pairs.join(wins.select("wkey", "n", "win"), ["wkey", "n"]).join(texts.select("ikey", "k", "ish"), "ikey")
    similar = similar.withColumn("wsh", _shingles(F.col("win"), F.col("k"))).select(
        "wkey", "n", "ikey", (both / (F.size("wsh") + F.size("ish") - both)).alias("similarity"))
    similar = stage(similar.where(F.col("similarity") >= threshold), "similar")

    out = own.select("id", "h", "n", "start", "wkey").join(similar, ["wkey", "n"]).join(items.select("item", "ikey"), "ikey")
    top = F.max(F.struct("similarity", (-F.col("start")).alias("s"))).alias("best")
    return out.groupBy("id", "h", "item").agg(top).select(
        F.col("id").alias(id_col), "h", F.col("item").alias(item_col), (-F.col("best.s")).alias("start"),
        F.col("best.similarity").alias("similarity"))


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """The documents without a benchmark passage, with their own columns."""
    one, two = free(docs, "__id", "__h")
    bad = stage(matches(docs, benchmark, id_col, text_col, **kw)
                .select(F.col(id_col).alias(one), F.col("h").alias(two)).distinct(), "contaminated")
    return docs.join(bad, docs[id_col].eqNullSafe(bad[one]) & (F.xxhash64(docs[text_col]) == bad[two]), "left_anti")
