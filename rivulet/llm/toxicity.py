"""Toxicity by multiple-instance learning over sentences.

A document is toxic if one of its sentences is: sentence probabilities are
combined by noisy-or, ``P = 1 - prod(1 - p_s)``, and the sentence model (a
logistic one over words and word beginnings) is trained from document labels
alone.  The same model then gives every document's score and the sentences
that caused it.

Training uses a bounded sample: about ``TRAIN_ROWS`` labelled documents,
chosen by a hash of the id.  Their features are counted by label in a partial
aggregate and the ``FEATURES`` that tell the labels apart best are kept; only
those leave the executors.  Scoring covers every document; the model is a
table of at most ``FEATURES`` weights.

Defined cases: a null or empty text has no sentence and score 0; rows with a
null label are not learned from; an id that is labelled more than once has the
majority's label (a tie counts as toxic); without labels of both classes every
score is the share of toxic labels (smoothed); repeated rows are each scored;
a null id keeps its row; other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rivulet.llm.util import by_value, stage

#: Labelled documents learned from, at most (in expectation).
TRAIN_ROWS = 20_000
#: Features of the model, at most.
FEATURES = 8192
#: Documents that a feature must be in.
MIN_DOCS = 3
#: Lengths of word beginnings.
BEGINNINGS = (4, 5)
#: Words remembered per task while scoring.
MEMO = 500_000
#: Features of sentences that a step of the fit handles at a time.
CHUNK = 1 << 20

_SENTENCE = re.compile(r"[^.!?\n]+")
_BEYOND = re.compile(r"[^\x00-\x7f]")
# Byte table: sentence ends to ".", other ASCII than letters to a space.
_LETTERS = bytes([*range(65, 91), *range(97, 123), *range(128, 256)])
_PARTED = bytes(b if b in _LETTERS else 46 if b in b".!?\n" else 32 for b in range(256))


def lower(text: str) -> str:
    """Lower case of equal length (some capitals lower to two characters)."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def plain(text: str) -> str:
    """``text`` in lower case, with a space for each character beyond ASCII
    that is neither a letter nor a mark on one (quotes, dashes, digits ...);
    of equal length."""
    low = lower(text)
    if low.isascii():
        return low
    odd = [c for c in set(_BEYOND.findall(low)) if unicodedata.category(c)[0] not in "LM"]
    if len(odd) > 8:
        return low.translate({ord(c): " " for c in odd})
    for c in odd:
        low = low.replace(c, " ")
    return low


def bags(text: str) -> list[set[bytes]]:
    """The words, in UTF-8, of each sentence of a :func:`plain` text that has any."""
    return [set(w) for w in map(bytes.split, text.encode().translate(_PARTED).split(b".")) if w]


def features(word: bytes) -> list[str]:
    w = word.decode()
    return [w, *(w[:n] + "-" for n in BEGINNINGS if len(w) > n)]


def sentences(text: str) -> list[tuple[int, int]]:
    """Start and end of each of :func:`bags`."""
    return [m.span() for m in _SENTENCE.finditer(text) if bags(m.group())]


class Known:
    """Numbers of a word's features, by word; remembers ``MEMO`` words."""

    def __init__(self, index: dict[str, int]):
        self.index, self.memo = index, {}

    def __call__(self, bag: set[bytes]) -> set[int]:
        memo, out = self.memo, set()
        for w in bag:
            got = memo.get(w)
            if got is None:
                if len(memo) >= MEMO:
                    memo.clear()
                got = memo[w] = tuple(self.index[f] for f in features(w) if f in self.index)
            if got:
                out.update(got)
        return out


def held_out(id_: Column) -> Column:
    return F.crc32(id_.cast("string").cast("binary")) % 5 == 0


def _counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each label that a feature is in."""
    count: dict[str, list[int]] = {}

    def flush():
        out = pa.RecordBatch.from_arrays([pa.array(list(count), pa.string()),
                                          pa.array([v[0] for v in count.values()], pa.int64()),
                                          pa.array([v[1] for v in count.values()], pa.int64())], ["feature", "neg", "pos"])
        count.clear()
        return out

    for b in batches:
        for text, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            for f in {f for w in set().union(*bags(plain(text or ""))) for f in features(w)}:
                count.setdefault(f, [0, 0])[y] += 1
            if len(count) > 300_000:
                yield flush()
    if count:
        yield flush()


def _bags(index: dict[str, int]):
    """Label, number of sentences, and the known features of the sentences
    that have any: how many in each, and all of them in one array."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Known(index)
        for b in batches:
            rows = []
            for text, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                found = bags(plain(text or ""))
                some = [f for f in map(known, found) if f]
                rows.append((y, len(found), [len(f) for f in some], [x for f in some for x in sorted(f)]))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()),
                                              pa.array([r[2] for r in rows], pa.list_(pa.int32())),
                                              pa.array([r[3] for r in rows], pa.list_(pa.int32()))], ["y", "n", "many", "f"])
    return run


def fit_noisy_or(y: np.ndarray, n: np.ndarray, some: np.ndarray, many: np.ndarray, feat: np.ndarray, size: int,
                 steps: int = 400, ridge: float = 1e-5) -> tuple[np.ndarray, float]:
    """Weights and bias that maximise the likelihood of document labels; Adam
    over all rows.  ``n``, ``some``: sentences of each document, and those with
    a known feature; ``many``: features of each of the latter; ``feat``: the
    features, one sentence after the other."""
    owner = np.repeat(np.arange(len(y)), some)
    rest = n - some  # sentences without a known feature
    start = np.cumsum(many, dtype=np.int64) - many
    cuts = np.unique(np.searchsorted(start, np.arange(0, len(feat), CHUNK))) if len(many) else np.zeros(0, np.int64)
    parts = [(k, m, start[k], start[m] if m < len(many) else len(feat)) for k, m in zip(cuts, [*cuts[1:], len(many)])]
    w, b = np.zeros(size), -4.0
    m1, m2 = np.zeros(size + 1), np.zeros(size + 1)
    z = np.zeros(len(many))
    for t in range(1, steps + 1):
        for k, m, i, j in parts:
            z[k:m] = b + np.add.reduceat(w[feat[i:j]], start[k:m] - i)
        p = 1 / (1 + np.exp(-z))
        p0 = 1 / (1 + np.exp(-b))
        none = np.bincount(owner, -np.logaddexp(0, z), len(y)) - rest * np.logaddexp(0, b)  # log prod(1 - p)
        clean = np.exp(none)
        up = np.where(y == 1, clean / np.maximum(1 - clean, 1e-9), -1.0)  # d log-likelihood / d z_s = up * p_s
        g = up[owner] * p
        grad = np.zeros(size + 1)
        for k, m, i, j in parts:
            grad[:-1] += np.bincount(feat[i:j], np.repeat(g[k:m], many[k:m]), size)
        grad[-1] = g.sum() + (up * rest).sum() * p0
        grad /= len(y)
        grad[:-1] -= ridge * w
        m1 = 0.9 * m1 + 0.1 * grad
        m2 = 0.999 * m2 + 0.001 * grad * grad
        move = 0.1 * (m1 / (1 - 0.9 ** t)) / (np.sqrt(m2 / (1 - 0.999 ** t)) + 1e-8)
        w += move[:-1]
        b += float(move[-1])
    return w, b


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          rows: int = TRAIN_ROWS, size: int = FEATURES) -> tuple[dict[str, float], float]:
    """Feature weights and bias, from labelled documents not held out."""
    y = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    y = y.groupBy(F.col(id_col).alias("id")).agg((F.avg(F.col(label_col).cast("double")) >= 0.5).cast("int").alias("y"))
    y = stage(y, "toxic-labels")
    total = y.count()
    if total > rows:  # by hash: the same rows everywhere, whatever the partitioning
        y = y.where(F.pmod(F.xxhash64("id"), F.lit(1 << 32)) < int((1 << 32) * rows / total))
    text = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    sample = stage(text.join(F.broadcast(y), "id").select("text", "y"), "toxic-sample")  # bounded by rows
    sides = {r["y"]: r["count"] for r in sample.groupBy("y").count().collect()}
    neg, pos = sides.get(0, 0), sides.get(1, 0)
    if not neg or not pos:
        share = (pos + 1) / (neg + pos + 2)
        return {}, float(np.log(share / (1 - share)))
    a, c = F.col("pos") + 0.5, F.col("neg") + 0.5
    odds = F.log(a / (pos - F.col("pos") + 0.5)) - F.log(c / (neg - F.col("neg") + 0.5))
    best = (sample.mapInArrow(_counts, "feature string, neg bigint, pos bigint").groupBy("feature")
            .agg(F.sum("neg").alias("neg"), F.sum("pos").alias("pos")).where(F.col("neg") + F.col("pos") >= MIN_DOCS)
            .withColumn("z", F.abs(odds) / F.sqrt(1 / a + 1 / c)).orderBy(F.desc("z"), "feature").limit(size))
    names = [r["feature"] for r in best.select("feature").collect()]
    if not names:  # no feature is in enough documents
        share = (pos + 1) / (neg + pos + 2)
        return {}, float(np.log(share / (1 - share)))
    index = {f: k for k, f in enumerate(names)}
    t = sample.mapInArrow(_bags(index), "y int, n int, many array<int>, f array<int>").toArrow()
    flat = {c: np.concatenate([x.flatten().to_numpy() for x in t[c].chunks]) for c in ("many", "f")}
    some = np.concatenate([x.value_lengths().to_numpy(zero_copy_only=False) for x in t["many"].chunks]).astype(np.int64)
    y, n = t["y"].to_numpy(), t["n"].to_numpy().astype(np.int64)
    del t
    w, b = fit_noisy_or(y, n, some, flat["many"], flat["f"], len(names))
    return {f: float(x) for f, x in zip(names, w) if x}, b


def score(docs: DataFrame, model: tuple[dict[str, float], float], id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """``(id_col, score, offending)``: noisy-or score, and the sentences with
    probability 0.5 or more as (start, end, p), positions in code points."""
    weights, bias = model
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Known({f: k for k, f in enumerate(weights)})
        weight = list(weights.values()).__getitem__
        p0 = 1 / (1 + np.exp(-bias))
        rest = float(np.logaddexp(0, bias))

        def one(text: str) -> tuple[float, list]:
            if not weights:
                return (float(p0), []) if text else (0.0, [])
            low = plain(text)
            none, found = 0.0, []
            for k, bag in enumerate(bags(low)):
                f = known(bag)
                if not f:
                    none -= rest
                    continue
                z = bias + math.fsum(map(weight, f))  # the same in any order
                none -= max(z, 0.0) + math.log1p(math.exp(-abs(z)))
                if z >= 0:
                    found.append((k, z))
            if found:
                spans = sentences(low)
                found = [{"start": spans[k][0], "end": spans[k][1], "p": 1 / (1 + math.exp(-z))} for k, z in found]
            return 1 - math.exp(none), found

        for b in batches:
            got = [one(t or "") for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([g[0] for g in got], pa.float64()),
                 pa.array([g[1] for g in got], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()),
                                                                  ("p", pa.float64())])))], ["id", "score", "offending"])

    out = docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(
        run, f"id {id_type}, score double, offending array<struct<start:int,end:int,p:double>>")
    return out.withColumnRenamed("id", id_col)


by_value(__name__)
