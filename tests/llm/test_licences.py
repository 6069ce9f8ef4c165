"""Licence notices in their usual layout, ordered rules, and tables of any size."""

from __future__ import annotations

MIT = """MIT License

Copyright (c) 2020 Somebody

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS BE LIABLE.
"""
APACHE = """   Licensed under the Apache License, Version 2.0 (the "License");
   you may not use this file except in compliance with the License.
   You may obtain a copy of the License at

       http://www.apache.org/licenses/LICENSE-2.0

   Unless required by applicable law or agreed to in writing, software
   distributed under the License is distributed on an "AS IS" BASIS,
   WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
   See the License for the specific language governing permissions and
   limitations under the License.
"""
BSD2 = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD3 = BSD2 + """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
GPL3 = """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU General Public License for more details.

    You should have received a copy of the GNU General Public License
    along with this program.  If not, see <https://www.gnu.org/licenses/>.
"""
AGPL = GPL3.replace("GNU General", "GNU Affero General")
LGPL = """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.
"""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
"""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
"""
GPL2 = GPL3.replace("version 3", "version 2")
GPL2_ONLY = """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License version 2 as
published by the Free Software Foundation.
"""
GPL2_KERNEL = GPL3.split("either")[0] + "version 2 of the License.\n"
ZLIB = """  This software is provided 'as-is', without any express or implied
  warranty.  In no event will the authors be held liable for any damages
  arising from the use of this software.

  Permission is granted to anyone to use this software for any purpose,
  including commercial applications, and to alter it and redistribute it
  freely, subject to the following restrictions:
"""
UNLICENSE = "This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy it.\n"
BOOST = """Permission is hereby granted, free of charge, to any person or organization
obtaining a copy of the software and accompanying documentation covered by
this license (the "Software") to use, reproduce, display, distribute,
execute, and transmit the Software, and to prepare derivative works of the
Software, and to permit third-parties to whom the Software is furnished to
do so, all subject to the following:
"""
EPL = """This program and the accompanying materials are made available under the
terms of the Eclipse Public License 2.0 which is available at
https://www.eclipse.org/legal/epl-2.0/
"""
HOLDERS = ["the <organization>", "the University of California, Berkeley", "Google Inc.", "the copyright holders"]
WANT = [
    *((BSD3.replace("the copyright holder", x), ["BSD-3-Clause"]) for x in HOLDERS), (BSD2 + "\n3. The name of the author may not be used to endorse or promote products\n   derived from this software without specific prior written permission.\n", ["BSD-3-Clause"]),
    (GPL2, ["GPL-2.0-or-later"]), (GPL2_ONLY, ["GPL-2.0-only"]), (GPL2_KERNEL, ["GPL-2.0-only"]), (ZLIB, ["Zlib"]), (UNLICENSE, ["Unlicense"]), (BOOST, ["BSL-1.0"]), (EPL, ["EPL-2.0"]),
    ("# SPDX-License-Identifier: MIT OR Apache-2.0\n", ["Apache-2.0", "MIT"]), ("/* SPDX-License-Identifier: (GPL-2.0-or-later OR BSD-2-Clause) */", ["BSD-2-Clause", "GPL-2.0-or-later"]), ("SPDX-License-Identifier: Unknown-1.0", []),
    ("Neither the name of the game nor the names of its players matter.", []),
    (MIT, ["MIT"]), (APACHE, ["Apache-2.0"]), (BSD2, ["BSD-2-Clause"]), (BSD3, ["BSD-3-Clause"]), (GPL3, ["GPL-3.0-or-later"]), (AGPL, ["AGPL-3.0-or-later"]), (LGPL, ["LGPL-2.1-or-later"]), (ISC, ["ISC"]), (MPL, ["MPL-2.0"]),
    ("// SPDX-License-Identifier: GPL-2.0-or-later\nint main() {}", ["GPL-2.0-or-later"]), (MIT + "\n\n" + APACHE, ["Apache-2.0", "MIT"]), ("I like the MIT license.", []), (None, []), ("", []),
]


def test_usual_layouts(spark):
    from astroloom.llm import license_scan as L

    out = L.scan(spark.createDataFrame([(i, t) for i, (t, _) in enumerate(WANT)], "doc_id long, text string"))
    assert {r.doc_id: r.licenses for r in out.collect()} == {i: w for i, (_, w) in enumerate(WANT)}


def test_rules_are_ordered_and_use_sentences_up(spark):
    from astroloom.llm import license_scan as L

    docs = spark.createDataFrame([(1, "A one. B two. A one. B two. C three."), (2, "B two. X. C three."), (3, "B two. A one.")], "doc_id long, text string")
    known = {"a": "a one", "b": "b two", "c": "c three"}
    rules = [("AB", ["a", "b"]), ("BC", ["b", "c"]), ("B", ["b"]), ("A", ["a"])]
    got = lambda r: {x.doc_id: x.licenses for x in L.scan(docs, known, r, [], []).collect()}
    assert got(rules) == {1: ["AB"], 2: ["BC"], 3: ["A", "B"]}
    assert got(rules[::-1]) == {1: ["A", "B"], 2: ["B"], 3: ["A", "B"]}


def test_a_large_table(spark):
    from astroloom.llm import license_scan as L

    known = {f"s{k}": f"{'kept' if k % 2 else 'given'} under terms number {k}" for k in range(1500)}
    docs = spark.createDataFrame([(k, f"Kept under terms number {k}.\nGiven under\nterms number {k}") for k in range(0, 1500, 100)] + [(7, "Kept under terms\nnumber 1499.")], "doc_id long, text string")
    got = {r.doc_id: r.licenses for r in L.scan(docs, known, [(f"L{k}", [f"s{k}"]) for k in range(1500)], [], []).collect()}
    assert got == {k: [f"L{k}"] for k in range(0, 1500, 100)} | {7: ["L1499"]}
