"""License scans by sentence rules, in DataFrame functions only.

A text is cut into sentences (at line ends, and after ``. ! ? ;`` before white
space); a sentence is normalised to lower-case words and looked up in a fixed
table of licence sentences.  A sentence may be wrapped: up to ``WRAP`` lines
without a blank one between them, or parts ended by ``;``, are looked up as
one as well, and the longest known one counts from its first line to its
last.  A document's identifiers, in order and with the
number of unknown sentences between them, are matched against ordered rules:
sequences of identifiers with at most ``GAP`` unknown sentences between two.
The longest rule wins at each place; matches do not overlap.

The table is fixed (about 32,000 short rows), so it is broadcast; only
known sentences leave the scan, and a document's identifiers are gathered per
document, never per licence.

Defined cases: a null or empty text has no licence; rows equal in id and text
give one set of matches; a null id keeps its matches; other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from rivulet.llm.host_quality import let

#: Unknown sentences allowed between two of a rule.
GAP = 2
#: Lines of a wrapped sentence, at most (the longest known one has 89 words).
WRAP = 48

_CUT = r"[.!?;]+(?:[\x20\x09-\x0D]+|$)|\n+"
#: A cut that a wrapped sentence goes on over.
WRAPPED = r"^(?:;[\x20\x09\x0D]*\n?[\x20\x09]*|\n)\z"

# Names by which a sentence refers to a licence.
NAMES = {
    "MIT": ["mit license", "mit licence", "mit open source license", "expat license", "mit", "mit license see license"],
    "Apache-2.0": ["apache license version 2 0", "apache license 2 0", "apache 2 0 license", "apache 2 0", "apache software license 2 0"],
    "GPL-2.0-only": ["gnu general public license version 2", "gnu general public license v2", "gpl version 2", "gplv2", "gnu gpl v2"],
    "GPL-3.0-only": ["gnu general public license version 3", "gnu general public license v3", "gpl version 3", "gplv3", "gnu gpl v3"],
    "LGPL-2.1-only": ["gnu lesser general public license version 2 1", "lgpl version 2 1", "lgplv2 1"],
    "LGPL-3.0-only": ["gnu lesser general public license version 3", "lgpl version 3", "lgplv3"],
    "AGPL-3.0-only": ["gnu affero general public license version 3", "agpl version 3", "agplv3"],
    "MPL-2.0": ["mozilla public license version 2 0", "mozilla public license v 2 0", "mpl 2 0"],
    "BSD-2-Clause": ["bsd 2 clause license", "2 clause bsd license", "simplified bsd license", "freebsd license"],
    "BSD-3-Clause": ["bsd 3 clause license", "3 clause bsd license", "new bsd license", "modified bsd license", "bsd license"],
    "ISC": ["isc license", "isc licence"],
    "Zlib": ["zlib license", "zlib libpng license"],
    "Unlicense": ["unlicense", "unlicense license"],
    "CC0-1.0": ["cc0 1 0", "cc0 1 0 universal", "creative commons zero v1 0 universal"],
    "CC-BY-4.0": ["cc by 4 0", "creative commons attribution 4 0 international license", "creative commons attribution 4 0"],
    "CC-BY-SA-4.0": ["cc by sa 4 0", "creative commons attribution sharealike 4 0 international license"],
    "CC-BY-NC-4.0": ["cc by nc 4 0", "creative commons attribution noncommercial 4 0 international license"],
    "CC-BY-ND-4.0": ["cc by nd 4 0", "creative commons attribution noderivatives 4 0 international license"],
    "CC-BY-NC-SA-4.0": ["cc by nc sa 4 0", "creative commons attribution noncommercial sharealike 4 0 international license"],
    "GPL-2.0-or-later": ["gnu general public license version 2 or later", "gpl version 2 or later", "gplv2 or later",
                         "gnu general public license either version 2 of the license or at your option any later version"],
    "GPL-3.0-or-later": ["gnu general public license version 3 or later", "gpl version 3 or later", "gplv3 or later",
                         "gnu general public license either version 3 of the license or at your option any later version"],
    "LGPL-2.1-or-later": ["gnu lesser general public license version 2 1 or later",
                          "gnu lesser general public license either version 2 1 of the license or at your option any later version"],
    "LGPL-3.0-or-later": ["gnu lesser general public license version 3 or later",
                          "gnu lesser general public license either version 3 of the license or at your option any later version"],
    "AGPL-3.0-or-later": ["gnu affero general public license version 3 or later",
                          "gnu affero general public license either version 3 of the license or at your option any later version"],
}
# What comes before the name.
SUBJECTS = ["", "this work is ", "this file is ", "this software is ", "this program is ", "this project is ", "this code is ",
            "this library is ", "this document is ", "the content is ", "the source code is ", "it is "]
VERBS = ["licensed under ", "released under ", "distributed under ", "available under ", "provided under ", "published under ",
         "made available under ", "licensed under the terms of ", "distributed under the terms of ", "covered by ", "subject to "]
ARTICLES = ["", "the ", "a "]
# Notices of headers, which name the text "the License".
HEADERS = {"Apache-2.0": ["apache license version 2 0 the license"],
           "MPL-2.0": ["mozilla public license version 2 0 the license", "mozilla public license v 2 0 the license"]}
# Sentences of licence texts.
TEXTS = {
    "mit_grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit_permission": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit_notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit_as_is": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "bsd_redistribution": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd_source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd_binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd_endorse": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "apache_may_not": "you may not use this file except in compliance with the license",
    "apache_obtain": "you may obtain a copy of the license at",
    "gpl_free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl2_free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "lgpl_free": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",
    "agpl_free": "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "mpl_form": "this source code form is subject to the terms of the mozilla public license v",
    "unlicense_free": "this is free and unencumbered software released into the public domain",
    "zlib_as_is": "this software is provided as is without any express or implied warranty",
    "zlib_grant": "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",
    "cc0_waiver": "the person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide under copyright law including all related and neighboring rights to the extent allowed by law",
    "lgpl_hope": "this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "gpl_hope": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "isc_grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "or_later": "or at your option any later version",
    "all_rights": "all rights reserved",
}
# Ordered rules over identifiers; those of one notice are added.
RULES = {
    "mit-text": ("MIT", ["mit_permission", "mit_notice", "mit_as_is"]),
    "mit-grant": ("MIT", ["mit_grant", "mit_as_is"]),
    "mit-permission": ("MIT", ["mit_permission", "mit_notice"]),
    "bsd-3-text": ("BSD-3-Clause", ["bsd_redistribution", "bsd_source", "bsd_binary", "bsd_endorse"]),
    "bsd-2-text": ("BSD-2-Clause", ["bsd_redistribution", "bsd_source", "bsd_binary"]),
    "apache-header": ("Apache-2.0", ["n_apache_2_0", "apache_may_not", "apache_obtain"]),
    "apache-may-not": ("Apache-2.0", ["n_apache_2_0", "apache_may_not"]),
    "gpl-3-later-text": ("GPL-3.0-or-later", ["gpl_free", "gpl_hope"]),
    "gpl-3-later": ("GPL-3.0-or-later", ["gpl_free"]),
    "gpl-2-later-text": ("GPL-2.0-or-later", ["gpl2_free", "gpl_hope"]),
    "gpl-2-later": ("GPL-2.0-or-later", ["gpl2_free"]),
    "gpl-3-notice-later": ("GPL-3.0-or-later", ["n_gpl_3_0_only", "or_later"]),
    "gpl-2-notice-later": ("GPL-2.0-or-later", ["n_gpl_2_0_only", "or_later"]),
    "isc-text": ("ISC", ["isc_grant", "mit_as_is"]),
    "isc-grant": ("ISC", ["isc_grant"]),
    "lgpl-2.1-later-text": ("LGPL-2.1-or-later", ["lgpl_free", "lgpl_hope"]),
    "lgpl-2.1-later": ("LGPL-2.1-or-later", ["lgpl_free"]),
    "agpl-3-later-text": ("AGPL-3.0-or-later", ["agpl_free", "gpl_hope"]),
    "agpl-3-later": ("AGPL-3.0-or-later", ["agpl_free"]),
    "mpl-form": ("MPL-2.0", ["mpl_form"]),
    "unlicense-text": ("Unlicense", ["unlicense_free"]),
    "zlib-text": ("Zlib", ["zlib_as_is", "zlib_grant"]),
    "zlib-grant": ("Zlib", ["zlib_grant"]),
    "cc0-waiver": ("CC0-1.0", ["cc0_waiver"]),
}


def _notice(name: str) -> str:
    return "n_" + re.sub(r"[^a-z0-9]+", "_", name.lower())


def sentence_table() -> dict[str, str]:
    """Normalised sentence -> identifier."""
    table = {s + v + a + n: _notice(name) for names in (NAMES, HEADERS) for name, ns in names.items() for n in ns
             for s in SUBJECTS for v in VERBS for a in ARTICLES}
    table.update({f"spdx license identifier {re.sub('[^a-z0-9]+', ' ', name.lower())}": _notice(name) for name in NAMES})
    table.update({text: sid for sid, text in TEXTS.items()})
    return table


def rule_table() -> dict[str, tuple[str, str]]:
    """Identifiers of a rule, each in angle brackets -> (rule, licence)."""
    rules = {"".join(f"<{i}>" for i in ids): (rule, name) for rule, (name, ids) in RULES.items()}
    rules.update({f"<{_notice(name)}>": (f"notice-{name.lower()}", name) for name in NAMES})
    return rules


def rule_pattern() -> str:
    """All rules as one pattern, the longest first."""
    keys = sorted(rule_table(), key=lambda k: (-k.count("<"), k))
    return "|".join(k.replace("><", ">~{0,%d}<" % GAP) for k in keys)


def _normalised(s: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(s), "[^a-z0-9]+", " "))


def _openers() -> str:
    """Pattern of the beginnings of known sentences: two words, or the first
    alone on its line."""
    first: dict[str, set[str]] = {}
    for t in sentence_table():
        a, b = t.split()[:2]
        first.setdefault(a, set()).add(b)
    return "^(?:" + "|".join(f"{a}(?:$| (?:{'|'.join(sorted(b))})(?:$| ))" for a, b in sorted(first.items())) + ")"


def _lookups(text: Column) -> Column:
    """Array of (pos, last, sentence): each piece, and the runs of pieces that
    a wrapped sentence may be, from where one can begin."""
    none = F.array().cast("array<struct<pos:int,last:int,sentence:string>>")

    def pieces(both: Column) -> Column:
        norm, cut = both["norm"], both["cut"]

        def at(s: Column, i: Column) -> Column:
            own = F.struct(i.alias("pos"), i.alias("last"), s.alias("sentence"))

            def step(acc: Column, k: Column) -> Column:
                # a run goes on over one line end or ";", not over a blank line or the end of a sentence
                on = acc["on"] & F.rlike(F.get(cut, k - 1), F.lit(WRAPPED)) & (F.length(F.get(norm, k)) > 0)
                joined = F.concat_ws(" ", acc["s"], F.get(norm, k))
                one = F.struct(i.alias("pos"), k.alias("last"), joined.alias("sentence"))
                return F.when(on, F.struct(on.alias("on"), joined.alias("s"), F.concat(acc["all"], F.array(one)).alias("all"))) \
                    .otherwise(F.struct(F.lit(False).alias("on"), acc["s"].alias("s"), acc["all"].alias("all")))

            zero = F.struct(F.lit(True).alias("on"), s.alias("s"), none.alias("all"))
            last = F.least(F.size(norm) - 1, i + (WRAP - 1))
            runs = F.aggregate(F.sequence(i + 1, last), zero, step, lambda acc: acc["all"])
            more = F.when((last > i) & F.rlike(F.get(cut, i), F.lit(WRAPPED)) & F.rlike(s, F.lit(_openers())), runs).otherwise(none)
            return F.when(F.length(s) == 0, none).otherwise(F.concat(F.array(own), more))

        return F.flatten(F.transform(norm, at))

    norm = F.transform(F.split(text, _CUT, -1), _normalised)
    return let(F.struct(norm.alias("norm"), F.regexp_extract_all(text, F.lit(_CUT), F.lit(0)).alias("cut")), pieces)


def _apart(found: Column) -> Column:
    """Of (pos, last, sid) the longest at each place, from the first on,
    without overlaps."""
    blank = F.array().cast("array<struct<pos:int,last:int,sid:string>>")
    order = F.array_sort(found, lambda a, b: F.when(a["pos"] != b["pos"], a["pos"] - b["pos"]).otherwise(b["last"] - a["last"]))
    return F.aggregate(order, blank, lambda acc, x: F.when(
        (F.size(acc) > 0) & (x["pos"] <= F.get(acc, F.size(acc) - 1)["last"]), acc).otherwise(F.concat(acc, F.array(x))))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, match_no, rule, license, n_sentences)``: one row per match,
    numbered from 1 in the text's order."""
    table = docs.sparkSession.createDataFrame(sorted(sentence_table().items()), "sentence string, sid string")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    s = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("h"), F.inline(_lookups(text)))
    known = s.join(F.broadcast(table), "sentence").select("id", "h", "pos", "last", "sid")
    seq = known.groupBy("id", "h").agg(_apart(F.collect_set(F.struct("pos", "last", "sid"))).alias("seq"))

    def token(x: Column, j: Column) -> Column:
        gap = F.when(j == 0, 0).otherwise(x["pos"] - F.get("seq", j - 1)["last"] - 1)
        return F.concat(F.repeat(F.lit("~"), F.least(gap, F.lit(GAP + 1))), F.lit("<"), x["sid"], F.lit(">"))

    line = F.array_join(F.transform("seq", token), "")
    hit = seq.select("id", F.posexplode(F.regexp_extract_all(line, F.lit(rule_pattern()), F.lit(0))).alias("n", "hit"))
    rules = rule_table()
    key = F.replace(F.col("hit"), F.lit("~"), F.lit(""))
    pick = lambda k: F.element_at(F.create_map(*[F.lit(x) for a, r in rules.items() for x in (a, r[k])]), key)
    return hit.select(F.col("id").alias(id_col), (F.col("n") + 1).cast("bigint").alias("match_no"), pick(0).alias("rule"),
                      pick(1).alias("license"), F.regexp_count("hit", F.lit("<")).cast("bigint").alias("n_sentences"))


def oracle_sql() -> str:
    """The scan as DuckDB SQL over ``documents``."""
    q = lambda s: "'" + s.replace("'", "''") + "'"
    rows = lambda r: ", ".join("(" + ", ".join(q(x) for x in row) + ")" for row in r)
    lists = lambda xs: "[" + ", ".join(q(x) for x in xs) + "]"
    names = rows((n, _notice(name)) for name, ns in NAMES.items() for n in ns)
    other = rows((s, i) for s, i in sentence_table().items() if s in TEXTS.values() or s.startswith("spdx"))
    return rf"""
WITH names(name, sid) AS (VALUES {names}),
known AS (
  SELECT s || v || a || name AS sentence, sid
  FROM names, (SELECT unnest({lists(SUBJECTS)}) AS s), (SELECT unnest({lists(VERBS)}) AS v),
       (SELECT unnest({lists(ARTICLES)}) AS a)
  UNION ALL SELECT * FROM (VALUES {other})),
cuts AS (SELECT doc_id, string_split_regex(coalesce(text, ''), {q(_CUT.replace("$", "$"))}) AS s FROM documents),
sentences AS (
  SELECT doc_id, unnest(s) AS s, unnest(range(len(s))) AS pos FROM cuts),
found AS (
  SELECT doc_id, pos, sid
  FROM (SELECT doc_id, pos, trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g')) AS sentence FROM sentences)
  JOIN known USING (sentence)),
tokens AS (
  SELECT doc_id, pos, repeat('~', least(coalesce(pos - lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) - 1, 0),
                                        {GAP + 1})::BIGINT) || '<' || sid || '>' AS token FROM found),
lines AS (SELECT doc_id, string_agg(token, '' ORDER BY pos) AS line FROM tokens GROUP BY doc_id),
hits AS (SELECT doc_id, regexp_extract_all(line, {q(rule_pattern())}) AS hit FROM lines),
each AS (SELECT doc_id, unnest(hit) AS hit, unnest(range(1, len(hit) + 1)) AS match_no FROM hits),
rules(key, rule, license) AS (VALUES {rows((k, *r) for k, r in rule_table().items())})
SELECT doc_id, match_no, rule, license, CAST(length(hit) - length(replace(hit, '<', '')) AS BIGINT) AS n_sentences
FROM each JOIN rules ON key = replace(hit, '~', '')
"""
