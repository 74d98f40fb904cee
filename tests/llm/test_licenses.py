"""License scans: rules, order, gaps, odd inputs; SQL has the whole table."""

from rivulet.llm import licenses as L

MIT = """MIT License

Copyright (c) 2020 Somebody

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions.

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""


def scan(spark, rows):
    df = spark.createDataFrame([(i, t, "p", "s") for i, t in rows], "doc_id bigint, text string, pos string, sid string")
    return sorted(((r.doc_id, r.match_no, r.rule, r.license, r.n_sentences) for r in L.scan(df).collect()),
                  key=lambda r: (r[0] is not None, r))


def test_rules(spark):
    perm = "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    rows = [(1, MIT), (2, "x. Licensed under the Apache License, Version 2.0. You may not use this file except in compliance "
                           "with the License. y"),
            (3, "Released under the MIT License.\nfoo\nLicensed under CC BY-NC 4.0."),
            (4, perm),  # a sentence without its rule
            (5, MIT.replace("\n\nTHE", "\n\n" + "filler line\n" * 2 + "THE")),
            (6, MIT.replace("\n\nTHE", "\n\n" + "filler line\n" * 3 + "THE")),
            (7, "This work is licensed under the GNU General Public License, version 3; or (at your option) any later version."),
            (8, "SPDX-License-Identifier: BSD-3-Clause"), (9, None), (10, ""), (11, "plain words " * 20_000),
            (3, "Released under the MIT License.\nfoo\nLicensed under CC BY-NC 4.0."), (None, "Licensed under ISC License.")]
    assert scan(spark, rows) == [
        (None, 1, "notice-isc", "ISC", 1),
        (1, 1, "mit-text", "MIT", 3), (2, 1, "apache-may-not", "Apache-2.0", 2),
        (3, 1, "notice-mit", "MIT", 1), (3, 2, "notice-cc-by-nc-4.0", "CC-BY-NC-4.0", 1),
        (5, 1, "mit-text", "MIT", 3), (6, 1, "mit-permission", "MIT", 2),
        (7, 1, "gpl-3-notice-later", "GPL-3.0-or-later", 2), (8, 1, "notice-bsd-3-clause", "BSD-3-Clause", 1)]
    assert scan(spark, []) == []


def test_tables():
    table = L.sentence_table()
    assert len(table) < 40_000 and all(s == " ".join(s.split()) and s for s in table)
    ids = set(table.values())
    assert all(i in ids for _, seq in L.RULES.values() for i in seq)


APACHE = """ * Licensed under the Apache License, Version 2.0 (the "License");
 * you may not use this file except in compliance with the License.
 * You may obtain a copy of the License at
 *
 *     http://www.apache.org/licenses/LICENSE-2.0
"""
GPL = """# This program is free software{0} you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation{1} either version {2} of the License, or
# (at your option) any later version.
#
# This program is distributed in the hope that it will be useful,
# but WITHOUT ANY WARRANTY; without even the implied warranty of
# MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
# GNU General Public License for more details.
"""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""


def test_wrapped_texts(spark):
    import textwrap
    rows = [(k, "\n\n".join(textwrap.fill(x, width) for x in MIT.split("\n\n"))) for k, width in ((1, 78), (2, 40), (3, 20))]
    rows += [(4, APACHE), (5, GPL.format(":", ",", 3)), (6, GPL.format(";", ";", 2)), (7, BSD),
             (8, "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby "
                 "granted, provided that the above\ncopyright notice and this permission notice appear in all copies.\n"),
             (9, "This work is\nlicensed under the\nMIT License.\nReleased under the ISC License\nReleased under the Zlib License\n"),
             (10, "This work is licensed under the\n\nMIT License.")]  # two paragraphs
    assert scan(spark, rows) == [
        (1, 1, "mit-text", "MIT", 3), (2, 1, "mit-text", "MIT", 3), (3, 1, "mit-text", "MIT", 3),
        (4, 1, "apache-header", "Apache-2.0", 3), (5, 1, "gpl-3-later-text", "GPL-3.0-or-later", 2),
        (6, 1, "gpl-2-later-text", "GPL-2.0-or-later", 2), (7, 1, "bsd-2-text", "BSD-2-Clause", 3), (8, 1, "isc-grant", "ISC", 1),
        (9, 1, "notice-mit", "MIT", 1), (9, 2, "notice-isc", "ISC", 1), (9, 3, "notice-zlib", "Zlib", 1)]


def test_later_versions_and_texts(spark):
    rows = [(1, "SPDX-License-Identifier: GPL-2.0-or-later"),
            (2, "Licensed under the GNU General Public License, either version 3 of the License, or (at your option) any later version."),
            (3, "This is free and unencumbered software released into the public domain.\n"),
            (4, "Released under the MIT License (see LICENSE)."),
            (5, GPL.format(";", ",", 3).replace("General", "Affero General", 1)),
            (6, GPL.format(";", ",", "2.1").replace("General", "Lesser General", 1).replace("program", "library")),
            (7, "// This Source Code Form is subject to the terms of the Mozilla Public\n// License, v. 2.0. If a copy of the MPL"),
            (8, "This software is provided 'as-is', without any express or implied\nwarranty. In no event will the authors be held "
                "liable.\n\nPermission is granted to anyone to use this software for any purpose,\nincluding commercial applications, "
                "and to alter it and redistribute it\nfreely, subject to the following restrictions:\n")]
    assert scan(spark, rows) == [
        (1, 1, "notice-gpl-2.0-or-later", "GPL-2.0-or-later", 1), (2, 1, "notice-gpl-3.0-or-later", "GPL-3.0-or-later", 1),
        (3, 1, "unlicense-text", "Unlicense", 1), (4, 1, "notice-mit", "MIT", 1),
        (5, 1, "agpl-3-later-text", "AGPL-3.0-or-later", 2), (6, 1, "lgpl-2.1-later-text", "LGPL-2.1-or-later", 2),
        (7, 1, "mpl-form", "MPL-2.0", 1), (8, 1, "zlib-text", "Zlib", 2)]
    empty = spark.createDataFrame([], "doc_id bigint, text string, sentence string")
    assert L.scan(empty).collect() == []
