"""Cases that the operators once lost."""

import random

import brute


def test_short_near_duplicates_equal_all_pairs(spark):
    from astroloom.llm import jaccard_join

    r = random.Random(5)
    docs = []
    for _ in range(500):  # a text of 6 to 60 words and one with a few words more: similarities from 0.8 on
        words = [f"w{r.randrange(10**9)}" for _ in range(r.randint(6, 60))]
        more = max(1, (len(words) - 4) // 4)
        docs += [(len(docs), " ".join(words)), (len(docs) + 1, " ".join(words + [f"x{r.randrange(10**9)}" for _ in range(more)]))]
    got = {x.doc_id: (x.class_id, x.n_links) for x in jaccard_join.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    want = brute.near(docs)
    assert sum(n for _, n in want.values()) > 800
    assert got == want


NOTICES = {
    "MIT": """MIT License

Copyright (c) 2020 A Name. All rights reserved.

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

All rights reserved.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS BE LIABLE.""",
    "BSD": """Copyright (c) 2020, A Name

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice.""",
    "Apache-2.0": """ # Licensed under the Apache License, Version 2.0 (the "License");
 # you may not use this file except in compliance with the License.
 # You may obtain a copy of the License at
 #
 #     http://www.apache.org/licenses/LICENSE-2.0
 #
 # Unless required by applicable law or agreed to in writing, software
 # distributed under the License is distributed on an "AS IS" BASIS,
 # WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
 # See the License for the specific language governing permissions and
 # limitations under the License.""",
    "GPL-3.0-or-later": """a line without an end
This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.

You should have received a copy of the GNU General Public License
along with this program.  If not, see <https://www.gnu.org/licenses/>.""",
    "GPL-2.0-or-later": """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version 2 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.

You should have received a copy of the GNU General Public License along
with this program; if not, write to the Free Software Foundation, Inc.,
51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA.""",
    "MPL-2.0": """/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at https://mozilla.org/MPL/2.0/. */""",
}


def test_wrapped_licence_notices(spark):
    from astroloom.llm import license_scan

    got = {r.name: r for r in license_scan.scan(spark.createDataFrame(list(NOTICES.items()), "name string, text string")).collect()}
    assert {k: r.licenses for k, r in got.items()} == {k: [k] for k in NOTICES}
    assert got["Apache-2.0"].sentence_ids == ["apache-notice", "apache-comply", "apache-obtain", "apache-asis", "apache-see"]


def test_leaks_are_judged_by_occurrence(spark):
    from astroloom.llm import decontamination

    ask = "On Monday {} bought {} red apples and then gave {} of them to his old friend {} before the long way home"
    items = [(1, ask.format("Tom", 12, 5, "Ann")), (2, "What is 17 plus 25"), (3, "Oslo Bergen Turku Malmo Odense Aarhus"), (4, None)]
    one, two, three = ask.format("Tom", 12, 5, "Ann"), ask.format("Bob", 31, 8, "Eve"), ask.format("Kim", 44, 9, "Lea")
    filler = " so the words went on and on with nothing in them at all for quite a while "
    docs = [
        (1, one + filler + two), (2, two + filler + three), (3, one), (4, filler * 3), (5, two + " " + three + " " + one), (6, two.replace("red apples", "red and green apples") + filler + three),
        (7, "they ask what What is 17 plus 25 now"), (8, "they ask What is 30 plus 4 now"), (9, "by Oslo Bergen Turku Malmo Odense Aarhus then"), (10, "by Rome Paris Turin Milan Genoa Siena then"), (11, None),
    ]
    got = {r.doc_id: (r.contaminated, r["items"], r.n_reparameterised) for r in decontamination.by_document(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    clean = (False, "", 0)
    assert got == {1: (True, "1", 1), 2: (True, "1", 1), 3: (True, "1", 0), 4: clean, 5: (True, "1", 1), 6: (True, "1", 1), 7: (True, "2", 0), 8: (True, "2", 1), 9: (True, "3", 0), 10: clean, 11: clean}


def test_purity_is_that_of_labelled_pages(spark):
    from astroloom.llm import url_filter

    rules = [("block", f"a.com/x/{k}/") for k in range(70)] + [("block", f"b.com/p/q/r/t{'abcdefghij'[k]}z/") for k in range(10)] + [("allow", "c.com/x/1/")]
    urls = [f"http://a.com/x/{k}/" for k in range(100)] + [f"http://b.com/p/q/r/t{c}z/" for c in "abcdefghijklmnopqrstuvwxyz"] + [f"http://b.com/p/q/r/u{c}z/" for c in "abcdefghijklmnopqrstuvwxyz"] + [f"http://c.com/x/{k}/" for k in range(30)] + [f"http://d.com/x/{k}/" for k in range(30)]
    got = {r.page_id: r.verdict for r in url_filter.judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), rules).collect()}
    assert {u: got[k] for k, u in enumerate(urls)} == {u: "block" if u[7] in "ab" else "allow" for u in urls}


def test_misspelled_terms_at_each_place():
    import numpy as np

    from astroloom.llm import toxicity

    terms = ["stupid", "idiot", "moron", "scum"]
    a = toxicity.Automaton([(t, False, 1.0) for t in terms])

    def found(text):
        _, term, errors, _ = a.hits(np.array([ord(c) for c in text + "\n"], dtype=np.uint32))
        return [(terms[k], int(e)) for k, e in zip(term, errors, strict=True)]

    for t in terms[:3]:
        for k in range(len(t)):
            for w in (t[:k] + "q" + t[k + 1 :], t[:k] + "*" + t[k + 1 :], t[:k] + "q" + t[k:], t[:k] + t[k + 1 :]):
                assert found(f"a {w} b") == [(t, 1)], w
        assert found(f"{t} *{t}* {t}! -{t}") == [(t, 0)] * 4
    for w in ("$cum", "s*um", "sc*m", "scu*", "s-cum"):
        assert found(f"a {w} b") == [("scum", 1)], w
    assert found("scum! (scum) qcum scun 2scum") == [("scum", 0)] * 3
