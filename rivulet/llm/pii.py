"""Personal data spans by weak supervision, in DataFrame functions only.

Base spans come from strict patterns (leftmost, not overlapping, per kind) and
always stay.  Looser candidates (numbers without a plus sign, addresses
spelled out, eight-group IP addresses, card-like numbers) are voted on by four
labelers: *pattern* (for a strict form, against a bare number), *gazetteer* (known endings, prefixes and
codes), *context* (words before the span) and *edges* (what touches it).  The
votes of all documents, base spans included, are counted by vote pattern;
expectation-maximisation over those counts (at most 4 x 3^4 rows, whatever the
corpus size) estimates each labeler's reliability per kind, and a logistic
span classifier is trained on the posteriors.  A candidate that overlaps no
base span is added if the classifier gives 0.5 or more.  One hard rule
remains: a bare number, which nothing but digits, spaces and hyphens between
the digits of a card marks as its kind (see ``OWN``), also needs a word of the
kind before it.

Positions count code points.  All patterns are possessive or start at a run's
first character, so long texts cost linear time and no deep recursion.

Defined cases: a null or empty text has no spans; repeated rows are each
counted; a null id keeps its row; other columns are ignored (``redact`` passes
them on); an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from rivulet.llm.host_quality import let
from rivulet.llm.util import free, stage

KINDS = ("email", "ip", "card", "phone")
_NAME = "[A-Za-z0-9._%+-]"

# Strict patterns.  Each starts where its leftmost match would: at the first
# character of a run, or where the match before it ended (\G).
STRICT = {
    "email": rf"(?:(?<!{_NAME})|\G){_NAME}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+",
    "card": r"[0-9](?<![0-9][0-9])(?<![0-9][\x20-][0-9])(?:[\x20-]?+[0-9]){13,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Looser candidates, and patterns one of which must be in a text that has any.
LOOSE = {
    "email": (rf"(?i)(?<!{_NAME}){_NAME}++ ?[\[(]at[\])] ?[a-z0-9-]++(?: ?(?:[\[(]dot[\])]|\.) ?[a-z0-9-]++)++",
              (r"(?i)[\[(]at[\])]",)),
    "ip": (r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}+[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])", (":",)),
    "card": (STRICT["card"], ()),
    "phone": (r"(?<![0-9+.(-])\(?[0-9]{2,4}\)?[\x20.-][0-9]{3,4}[\x20.-][0-9]{4}(?![0-9])", ()),
}
# What marks a looser candidate as one of its kind; others are bare numbers.
OWN = {
    "email": r"@|(?i)\bat\b",
    "ip": r"[A-Fa-f]|[0-9]{3}",
    "card": r"(?!)",  # its check digit is wrong, or it were a base span
    "phone": r"^[(0]|[.-]",
}
# Words before a span that speak for its kind, and those against all kinds
# (English, German, French, Spanish).
FOR = {
    "email": r"(?i)e-?mail|contact|write|kontakt|schreib|courriel|correo|escrib",
    "ip": r"(?i)\bip\b|address|host|server|adresse|serveur|servidor|direcci",
    "card": r"(?i)card|visa|credit|payment|karte|zahlung|carte|paiement|tarjeta|pago",
    "phone": r"(?i)phone|\btel|call|fax|mobile|anruf|handy|appel|portable|llam|m[oó]vil",
}
AGAINST = r"(?i)order|isbn|issn|version|invoice|serial|bestell|rechnung|commande|facture|pedido|factura|\bref\b|\bid\b"
# Known endings, prefixes and codes.
GAZETTEER = {
    "email": r"(?i)[. ](com|org|net|edu|gov|info|io|de|fr|es|uk|eu|at|ch|it|nl)$",
    "ip": r"^(?!0|127\.|255\.)",
    "card": r"^(?:4|5[1-5]|2[2-7]|3[4-7]|6)",
    "phone": r"^(?:\+[1-9]|\(?0[0-9]|\(?[2-9][0-9]{2}\)?[\x20.-][2-9])",
}
LABELERS = ("pattern", "gazetteer", "context", "edges")
CONTEXT_CHARS = 40


#: Matches whose spans are put together in one step: what is copied per match
#: does not grow with a text's matches.
STEP = 256


def _placed(text: Column, pattern: str, keep: Callable[[Column], Column], kind: int) -> Column:
    """Spans of a pattern: matches and the gaps between them, summed up - for
    steps of matches first, then within each step."""
    none = F.array().cast("array<struct<s:int,k:int,e:int,v:string>>")

    def step(acc: Column, x: Column) -> Column:
        s = acc["at"] + x["g"]
        e = s + F.char_length(x["v"])
        one = F.struct(s.alias("s"), F.lit(kind).alias("k"), e.alias("e"), x["v"].alias("v"))
        return F.struct(e.alias("at"), F.concat(acc["all"], F.when(keep(x["v"]), F.array(one)).otherwise(none)).alias("all"))

    def within(matches: Column, start: Column) -> Column:
        return F.aggregate(matches, F.struct(start.alias("at"), none.alias("all")), step, lambda a: a["all"])

    def stepwise(matches: Column) -> Column:
        steps = F.transform(F.sequence(F.lit(0), F.floor((F.size(matches) - 1) / STEP).cast("int")),
                            lambda i: F.slice(matches, i * STEP + 1, F.lit(STEP)))
        wide = F.transform(steps, lambda b: F.aggregate(b, F.lit(0), lambda n, x: n + x["g"] + F.char_length(x["v"])))
        starts = F.aggregate(wide, F.array(F.lit(0)), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)))
        return let(starts, lambda at: F.flatten(F.transform(steps, lambda b, i: within(b, F.get(at, i)))))

    def spans(hits: Column) -> Column:
        gaps = F.transform(F.split(text, pattern, -1), lambda x: F.char_length(x))
        zipped = F.arrays_zip(F.slice(gaps, 1, F.size(hits)).alias("g"), hits.alias("v"))
        return F.when(F.size(hits) == 0, none).when(F.size(hits) <= STEP, within(zipped, F.lit(0))).otherwise(
            let(zipped, stepwise))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), spans)


def _digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def _small_parts(v: Column) -> Column:
    """All parts at most 255, however many zeros lead."""
    def ok(p: Column) -> Column:
        p = F.regexp_replace(p, "^0+", "")
        return (F.length(p) <= 3) & (F.coalesce(F.try_to_number(p, F.lit("999")).cast("int"), F.lit(0)) <= 255)
    return F.forall(F.split(v, r"\."), ok)


def _luhn(v: Column) -> Column:
    def total(d: Column) -> Column:
        n = F.length(d)

        def term(i: Column) -> Column:
            x = F.substring(d, n - i, F.lit(1)).cast("int")
            y = 2 * x
            return F.when(i % 2 == 0, x).otherwise(F.when(y > 9, y - 9).otherwise(y))
        return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda s, i: s + term(i)) % 10 == 0
    return let(_digits(v), total)


def _valid(kind: str) -> Callable[[Column], Column]:
    return {
        "email": lambda v: F.lit(True),
        "ip": _small_parts,
        "card": _luhn,
        "phone": lambda v: F.length(_digits(v)).between(10, 15),
    }[kind]


def _gate(text: Column, marks: tuple[str, ...], value: Column) -> Column:
    if not marks:
        return value
    has = F.lit(False)
    for m in marks:
        has = has | F.rlike(text, F.lit(m))
    return F.when(has, value).otherwise(F.array().cast("array<struct<s:int,k:int,e:int,v:string>>"))


def base_spans(text: Column) -> Column:
    """Array of (s, k, e, v) by start, then kind."""
    mark = {"email": ("@",), "phone": (r"\+",)}
    return F.sort_array(F.concat(*[_gate(text, mark.get(kind, ()), _placed(text, STRICT[kind], _valid(kind), k))
                                   for k, kind in enumerate(KINDS)]))


def _loose_spans(text: Column, base: Column) -> Column:
    found = F.sort_array(F.concat(*[_gate(text, LOOSE[kind][1], _placed(text, LOOSE[kind][0], lambda v: F.lit(True), k))
                                    for k, kind in enumerate(KINDS)]))
    return F.filter(found, lambda x: ~F.exists(base, lambda b: (x["s"] < b["e"]) & (b["s"] < x["e"])))


def _voted(text: Column, spans: Column, strict: bool) -> Column:
    """Each span with its labelers' votes: 1 for, 0 against, -1 neither."""
    def votes(x: Column) -> Column:
        before = F.substring(text, F.greatest(x["s"] - CONTEXT_CHARS, F.lit(0)) + 1, F.least(x["s"], F.lit(CONTEXT_CHARS)))
        by_kind = lambda f: F.coalesce(*[F.when(x["k"] == k, f(kind)) for k, kind in enumerate(KINDS)])
        edge = F.concat(F.substring(text, x["s"], F.when(x["s"] > 0, 1).otherwise(0)), F.substring(text, x["e"] + 1, F.lit(1)))
        return F.struct(
            x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e"),
            (F.lit(1) if strict else F.when(by_kind(lambda kind: F.rlike(x["v"], F.lit(OWN[kind]))), -1).otherwise(0))
            .alias("pattern"),
            F.when(by_kind(lambda kind: F.rlike(x["v"], F.lit(GAZETTEER[kind]))), 1).otherwise(0).alias("gazetteer"),
            F.when(by_kind(lambda kind: F.rlike(before, F.lit(FOR[kind]))), 1)
            .when(F.rlike(before, F.lit(AGAINST)), 0).otherwise(-1).alias("context"),
            F.when(F.rlike(edge, F.lit(r"[\p{L}\p{N}_]")), 0).otherwise(1).alias("edges"))
    return F.transform(spans, votes)


def candidates(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with arrays ``__base`` and ``__loose`` of voted spans."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    both = let(text, lambda t: let(base_spans(t), lambda b: F.struct(
        _voted(t, b, True).alias("base"), _voted(t, _loose_spans(t, b), False).alias("loose"))))
    held, = free(docs, "__pii")
    return docs.withColumn(held, both).select(*_others(docs), F.col(f"{held}.base").alias("__base"),
                                              F.col(f"{held}.loose").alias("__loose"))


def _others(docs: DataFrame) -> list[str]:
    """The table's columns but those that have a result's name."""
    return [f"`{c}`" for c in docs.columns if c.lower() not in ("__base", "__loose", "__spans")]


# -- label model: plain arithmetic on the counts of vote patterns ------------------

def _posteriors(rows: list[tuple], steps: int = 50) -> list[float]:
    """P(personal data) of each vote pattern ``(votes, count)`` by EM for
    labelers that are right independently of each other."""
    n = len(LABELERS)
    post = []
    for votes, _ in rows:  # start: the share of labelers for it
        cast = [v for v in votes if v >= 0]
        post.append(min(0.9, max(0.1, sum(cast) / len(cast))) if cast else 0.5)
    for _ in range(steps):
        pos = sum(p * c for p, (_, c) in zip(post, rows))
        neg = sum((1 - p) * c for p, (_, c) in zip(post, rows))
        prior = (pos + 1) / (pos + neg + 2)
        rates = []  # per labeler and class: share of each vote (-1, 0, 1), smoothed
        for j in range(n):
            share = []
            for side in (0, 1):
                mass = {v: 1.0 + 2.0 * (v == side) for v in (-1, 0, 1)}  # better than chance to begin with
                for p, (votes, c) in zip(post, rows):
                    mass[votes[j]] += c * (p if side else 1 - p)
                total = sum(mass.values())
                share.append({v: m / total for v, m in mass.items()})
            rates.append(share)
        new = []
        for votes, _ in rows:
            z = math.log(prior / (1 - prior)) + sum(math.log(rates[j][1][votes[j]] / rates[j][0][votes[j]]) for j in range(n))
            new.append(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
        post = new
    return post


def _features(votes: tuple) -> list[float]:
    return [1.0, *(float(v) if v >= 0 and v == 1 else -1.0 if v == 0 else 0.0 for v in votes)]


def _logistic(rows: list[tuple], post: list[float], steps: int = 400) -> list[float]:
    """Weights of a ridge logistic regression on the posteriors."""
    w = [0.0] * (len(LABELERS) + 1)
    total = sum(c for _, c in rows) or 1
    for _ in range(steps):
        grad = [1e-3 * x for x in w]
        for (votes, c), p in zip(rows, post):
            f = _features(votes)
            q = 1 / (1 + math.exp(-sum(a * b for a, b in zip(w, f))))
            for j, x in enumerate(f):
                grad[j] += c / total * (q - p) * x
        w = [a - 1.0 * g for a, g in zip(w, grad)]
    return w


def train(found: DataFrame) -> dict[int, list[float]]:
    """Classifier weights per kind from all documents' candidates."""
    span = F.explode(F.concat("__base", "__loose")).alias("x")
    counts = found.select(span).groupBy("x.k", *[f"x.{v}" for v in LABELERS]).count().collect()
    out = {}
    for k in range(len(KINDS)):
        rows = sorted((tuple(r[1:5]), r["count"]) for r in counts if r[0] == k)
        if rows:
            out[k] = _logistic(rows, _posteriors(rows))
    return out


def _accepted(weights: dict[int, list[float]]) -> Callable[[Column], Column]:
    def ok(x: Column) -> Column:
        z = F.lit(-1.0)
        for k, w in weights.items():
            score = F.lit(w[0])
            for name, a in zip(LABELERS, w[1:]):
                score = score + F.when(x[name] == 1, a).when(x[name] == 0, -a).otherwise(0.0)
            z = F.when(x["k"] == k, score).otherwise(z)
        return (z >= 0) & ((x["pattern"] != 0) | (x["context"] == 1))
    return ok


def _plain(spans: Column) -> Column:
    return F.sort_array(F.transform(spans, lambda x: F.struct(x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e"))))


def find(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``__base`` and ``__spans``: sorted arrays of spans
    (s start, k kind number, e end), in place of columns named so (or
    ``__loose``)."""
    found = stage(candidates(docs, text_col), "pii")
    ok = _accepted(train(found))
    return found.select(*_others(docs), _plain(F.col("__base")).alias("__base"),
                        _plain(F.concat("__base", F.filter("__loose", ok))).alias("__spans"))


def written(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"].cast("string"),
                                                                 x["e"].cast("string"))), ",")


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with each span replaced by ``<KIND>``; spans that overlap an
    earlier one are part of its replacement.  ``length_col`` is set anew.
    Other columns may have any name: they travel in one struct."""
    others = [docs[c] for c in docs.columns if c != text_col]
    found = find(docs.select(F.struct(F.lit(0).alias("__"), *others).alias("row"), docs[text_col].alias("text")), "text")
    text = F.col("text")
    names = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])
    blank = F.array().cast("array<struct<s:int,k:int,e:int>>")

    def merge(acc: Column, x: Column) -> Column:
        last = F.element_at(acc, -1)
        joined = F.struct(last["s"].alias("s"), last["k"].alias("k"), F.greatest(last["e"], x["e"]).alias("e"))
        return F.when(F.size(acc) == 0, F.array(x)).when(
            x["s"] < last["e"], F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(joined))).otherwise(
            F.concat(acc, F.array(x)))

    def replaced(m: Column) -> Column:
        def piece(x: Column, j: Column) -> Column:
            at = F.when(j == 0, 0).otherwise(F.get(m, j - 1)["e"])
            return F.concat(F.substring(text, at + 1, x["s"] - at), F.get(names, x["k"]))
        tail = F.substring(text, F.element_at(m, -1)["e"] + 1, F.char_length(text))
        return F.concat(F.array_join(F.transform(m, piece), ""), tail)

    merged = F.aggregate("__spans", blank, merge)
    new = F.when(F.size("__spans") == 0, text).otherwise(let(merged, replaced))
    found = found.select("row", "__spans", new.alias("text"))

    def column(c: str) -> Column:
        if c == text_col:
            return F.col("text").alias(c)
        own = F.col("row").getField(c)
        if c == length_col:
            kind = docs.schema[c].dataType
            own = F.when(F.size("__spans") == 0, own).otherwise(F.char_length("text").cast(kind))
        return own.alias(c)

    return found.select(*map(column, docs.columns))
