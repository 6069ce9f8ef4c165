"""Licence recognition by sentences and ordered rules, in DataFrame operations only.

A text is cut into sentences, each is normalised and looked up among the known
licence sentences (a fixed table). Sentences end at line ends as well, so a
known one may also be wrapped: it is found where it equals sentences that follow
one another. A wording may have slots of a few words, as for the holder's name, and a tag
line may join licences by or, and, with. The identifiers found, in text order, are matched against the rules in
the order given: a rule is a sequence of identifiers that must stand one after the
other, sentences that are not known or in no rule being skipped, and the first rule
that fits uses its sentences up, so a longer notice goes before its parts. All of it
happens inside the row: no shuffle, no join, no bound on the text's length or on the
number of sentences and rules; known sentences are tried by their first word.

The SQL twin knows one-line notices only (SENTENCES and RULES).

Defined results: null and empty texts have no sentence and no licence; repeated
rows are scanned row by row; an empty table gives no rows; further columns are
kept, but for those named n_sentences, sentence_ids or licenses, which are replaced.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import read

#: Known licence sentences, normalised: lower case, runs of other characters than letters and digits as one blank.
SENTENCES = {
    "apache-notice": "licensed under the apache license version 2 0",
    "apache-comply": "you may not use this file except in compliance with the license",
    "apache-obtain": "you may obtain a copy of the license at http www apache org licenses license 2 0",
    "apache-asis": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apache-see": "see the license for the specific language governing permissions and limitations under the license",
    "mit-notice": "released under the mit license",
    "mit-title": "the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-keep": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit-asis": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "gpl3-notice": "this work is licensed under the gnu general public license version 3",
    "gpl2-notice": "this work is licensed under the gnu general public license version 2",
    "gpl-redistribute": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl-hope": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "gpl-copy": "you should have received a copy of the gnu general public license along with this program",
    "ccbync-notice": "licensed under cc by nc 4 0",
    "ccby-notice": "licensed under cc by 4 0",
    "ccbysa-notice": "licensed under cc by sa 4 0",
    "ccbysa-work": "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    "ccby-work": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc0-notice": "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work",
    "bsd-notice": "released under the bsd license",
    "bsd-redistribute": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "mpl-notice": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "reserved": "all rights reserved",
}

#: Licence and the sequence of sentences that names it. Fixed, under 200 entries.
RULES = [
    ("Apache-2.0", ["apache-notice"]),
    ("Apache-2.0", ["apache-comply", "apache-obtain", "apache-asis", "apache-see"]),
    ("MIT", ["mit-notice"]),
    ("MIT", ["mit-grant", "mit-keep", "mit-asis"]),
    ("GPL-3.0", ["gpl3-notice"]),
    ("GPL-3.0-or-later", ["gpl-redistribute", "gpl-hope", "gpl-copy"]),
    ("GPL-2.0", ["gpl2-notice"]),
    ("CC-BY-NC-4.0", ["ccbync-notice"]),
    ("CC-BY-4.0", ["ccby-notice"]),
    ("CC-BY-4.0", ["ccby-work"]),
    ("CC-BY-SA-4.0", ["ccbysa-notice"]),
    ("CC-BY-SA-4.0", ["ccbysa-work"]),
    ("CC0-1.0", ["cc0-notice"]),
    ("BSD", ["bsd-notice"]),
    ("BSD", ["bsd-redistribute"]),
    ("MPL-2.0", ["mpl-notice"]),
]

_GPL_COPY = "you should have received a copy of the gnu general public license along with this program if not "
_GPL_WRITE = _GPL_COPY + "write to the free software foundation inc "

#: Further wordings and the identifiers that each stands for, as the notices are usually written.
WORDINGS = [
    ("licensed under the apache license version 2 0 the license", "apache-notice"),
    ("licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", "apache-notice,apache-comply"),
    ("you may obtain a copy of the license at https www apache org licenses license 2 0", "apache-obtain"),
    ("the above copyright notice and this permission notice including the next paragraph shall be included in all copies or substantial portions of the software", "mit-keep"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version", "gpl2-redistribute"),
    (_GPL_COPY + "see http www gnu org licenses", "gpl-copy"),
    (_GPL_COPY + "see https www gnu org licenses", "gpl-copy"),
    (_GPL_WRITE + "51 franklin street fifth floor boston ma 02110 1301 usa", "gpl-copy"),
    (_GPL_WRITE + "51 franklin st fifth floor boston ma 02110 1301 usa", "gpl-copy"),
    (_GPL_WRITE + "59 temple place suite 330 boston ma 02111 1307 usa", "gpl-copy"),
    (_GPL_WRITE + "675 mass ave cambridge ma 02139 usa", "gpl-copy"),
]

_FREE = "is free software you can redistribute it and or modify it under the terms of the gnu "
_LATER = " of the license or at your option any later version"
_ENDORSE = "may be used to endorse or promote products derived from this software without specific prior written permission"
_EPL = "this program and the accompanying materials are made available under the terms of the eclipse public license "

WORDINGS += [
    ("this library " + _FREE + "lesser general public license as published by the free software foundation either version 2 1" + _LATER, "lgpl21-redistribute"),
    ("this program " + _FREE + "lesser general public license as published by the free software foundation either version 3" + _LATER, "lgpl3-redistribute"),
    ("this library " + _FREE + "lesser general public license as published by the free software foundation either version 3" + _LATER, "lgpl3-redistribute"),
    ("this program " + _FREE + "affero general public license as published by the free software foundation either version 3" + _LATER, "agpl3-redistribute"),
    ("redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer", "bsd-source"),
    ("redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution", "bsd-binary"),
    (f"neither the name of * nor the names of its contributors {_ENDORSE}", "bsd-endorse"),
    (f"neither the name of * nor the names of other contributors {_ENDORSE}", "bsd-endorse"),
    (f"neither the name of * nor the names of any contributors {_ENDORSE}", "bsd-endorse"),
    (f"neither the names of * nor the names of its contributors {_ENDORSE}", "bsd-endorse"),
    (f"neither the names of * nor the names of their contributors {_ENDORSE}", "bsd-endorse"),
    ("the name of * may not be used to endorse or promote products derived from this software without specific prior written permission", "bsd-endorse"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies", "isc-grant"),
    ("permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies", "isc-grant"),
    *((f"this program {_FREE}general public license {x}", f"gpl{v}-only") for v in (2, 3) for x in (f"version {v} as published by the free software foundation", f"as published by the free software foundation version {v} of the license")),
    ("permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions", "zlib-grant"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following", "boost-grant"),
    ("distributed under the boost software license version 1 0", "boost-notice"),
    *((_EPL + x, "epl2-notice") for x in ("2 0 which is available at https www eclipse org legal epl 2 0", "2 0 which is available at http www eclipse org legal epl 2 0", "v2 0 which accompanies this distribution", "v 2 0 which accompanies this distribution")),
    ("this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0", "mpl-notice"),
]

#: Identifiers of licences that a tag line may name.
TAGGED = ["MIT", "ISC", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "MPL-2.0", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "AGPL-3.0-only", "AGPL-3.0-or-later", "Unlicense", "Zlib", "BSL-1.0", "EPL-2.0", "0BSD"]
TAG_LINE = "spdx license identifier "

#: Rules on identifiers that only WORDINGS has, in order; they go before RULES.
WORDING_RULES = [
    ("GPL-2.0-or-later", ["gpl2-redistribute", "gpl-hope", "gpl-copy"]),
    ("GPL-2.0-only", ["gpl2-only"]),
    ("GPL-3.0-only", ["gpl3-only"]),
    ("LGPL-2.1-or-later", ["lgpl21-redistribute"]),
    ("LGPL-3.0-or-later", ["lgpl3-redistribute"]),
    ("AGPL-3.0-or-later", ["agpl3-redistribute"]),
    ("BSD-3-Clause", ["bsd-redistribute", "bsd-source", "bsd-binary", "bsd-endorse"]),
    ("BSD-2-Clause", ["bsd-redistribute", "bsd-source", "bsd-binary"]),
    ("BSD-3-Clause", ["bsd-redistribute", "bsd-endorse"]),
    ("ISC", ["isc-grant"]),
    ("Zlib", ["zlib-grant"]),
    ("Unlicense", ["unlicense"]),
    ("BSL-1.0", ["boost-grant"]),
    ("BSL-1.0", ["boost-notice"]),
    ("EPL-2.0", ["epl2-notice"]),
    *((x, [f"tag-{x}"]) for x in TAGGED),
]


def sentences_of(text: Column) -> Column:
    """Normalised sentences that hold a letter or digit: cut after . ! ? before white space, and at line ends."""
    cut = F.split(F.regexp_replace(F.coalesce(text, F.lit("")), r"([.!?])[\x20\x09-\x0D]+", "$1\n"), "\n")
    return F.filter(F.transform(cut, lambda x: F.trim(F.regexp_replace(F.lower(x), r"[^\p{L}\p{N}]+", " "))), lambda x: x != "")


#: A slot of a wording: from one word to twelve.
_SLOT = "[^ \n]+(?:[ \n][^ \n]+){0,11}?"


def _pattern(words: str) -> str:
    return words.replace(" ", "[ \n]").replace("*", _SLOT)


def _by_first_word(texts: list[str]) -> str:
    """A pattern of all the texts, each word after a blank or line feed; at one place the longest counts. A word * is a slot."""
    groups: dict[str, list[str]] = {}
    for t in sorted(texts, key=len, reverse=True):
        first, _, rest = t.partition(" ")
        groups.setdefault(first, []).append(_pattern(rest))
    return "|".join(f"{first}(?:" + "|".join(f"[ \n]{x}(?=\n)" if x else "(?=\n)" for x in rests) + ")" for first, rests in groups.items())


def _named(found: Column, table: dict[str, str], tags: dict[str, str]) -> Column:
    """Identifiers of a text that was found: its own in the table, those of the wording whose slots it fills, or one for each licence of a tag line."""
    plain = F.from_json(F.lit(json.dumps({t: n for t, n in table.items() if "*" not in t})), "map<string,string>")
    own = F.try_element_at(plain, found)
    for text, name in table.items():
        if "*" in text:
            own = F.when(found.rlike(f"^{_pattern(text)}$"), F.lit(name)).otherwise(own)
    listed = F.regexp_extract_all(found, F.lit(f" ({'|'.join(sorted(tags, key=len, reverse=True))})(?= or | and | with |$)"), F.lit(1))
    names = F.from_json(F.lit(json.dumps(tags)), "map<string,string>")
    return F.when(found.startswith(TAG_LINE), F.transform(listed, lambda t: F.concat(F.lit("tag-"), F.try_element_at(names, t)))).otherwise(F.split(own, ","))


def _licenses(ids: Column, rules: list[tuple[str, list[str]]]) -> Column:
    """Names of the rules that fit, in order of the rules; one that fits uses its identifiers up wherever it does."""
    text = json.dumps([{"name": n, "seq": "".join(f",{x}," for x in seq)} for n, seq in rules])
    table = F.from_json(F.lit(text), "array<struct<name:string,seq:string>>")
    ruled = F.from_json(F.lit(json.dumps(sorted({x for _, seq in rules for x in seq}))), "array<string>")
    start = F.array_join(F.transform(F.filter(ids, lambda x: F.array_contains(ruled, x)), lambda x: F.concat(F.lit(","), x, F.lit(","))), "")
    zero = F.struct(start.alias("left"), F.array().cast("array<string>").alias("names"))

    def tried(a: Column, r: Column) -> Column:
        hit = a.left.contains(r.seq)
        return F.struct(F.when(hit, F.replace(a.left, r.seq, F.lit(",#,"))).otherwise(a.left).alias("left"), F.when(hit, F.array_append(a.names, r["name"])).otherwise(a.names).alias("names"))

    return F.aggregate(table, zero, tried, lambda a: a.names)


def scan(docs: DataFrame, sentences: dict[str, str] = SENTENCES, rules: list[tuple[str, list[str]]] = RULES, wordings: list[tuple[str, str]] = WORDINGS, wording_rules: list[tuple[str, list[str]]] = WORDING_RULES) -> DataFrame:
    """docs plus n_sentences, sentence_ids (array, text order) and licenses (array, by name)."""
    table = {text: name for name, text in sentences.items()} | dict(wordings)
    tags = {x.lower().replace("-", " ").replace(".", " "): x for x in TAGGED} if wordings else {}
    one = "|".join(sorted(tags, key=len, reverse=True))
    tag_line = f"|{TAG_LINE}(?:{one})(?: (?:or|and|with) (?:{one}))*(?=\n)" if tags else ""
    anyone = f"(?<=\n)(?:{_by_first_word(list(table))}{tag_line})"
    own = f"_s_{uuid.uuid4().hex}"  # no column of docs has this name
    text = F.concat(F.lit("\n"), F.array_join(own, "\n"), F.lit("\n"))
    found_texts = F.regexp_extract_all(text, F.lit(anyone), F.lit(0))
    ids = F.flatten(F.transform(found_texts, lambda x: _named(F.translate(x, "\n", " "), table, tags or {"none": "none"})))
    found = docs.withColumn(own, sentences_of(F.col("text"))).withColumn("n_sentences", F.size(own).cast("long")).withColumn("sentence_ids", ids).drop(own)
    none = F.array().cast("array<string>")
    return found.withColumn("licenses", F.when(F.size("sentence_ids") == 0, none).otherwise(F.array_sort(F.array_distinct(_licenses(F.col("sentence_ids"), [*wording_rules, *rules])))))


def op10_license_scan(spark, sf_dir) -> DataFrame:
    """doc_id, n_sentences, the licence sentences found in text order, the licences, and how many."""
    out = scan(read(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select("doc_id", "n_sentences", F.array_join("sentence_ids", ",").alias("sentence_ids"), F.array_join("licenses", ",").alias("licenses"), F.size("licenses").cast("long").alias("n_licenses"))


def _sql() -> str:
    known = ", ".join(f"('{t}', '{n}')" for n, t in SENTENCES.items())
    rules = ", ".join(f"('{n}', ',{','.join(s)},')" for n, s in RULES)
    return rf"""
WITH known(sentence, id) AS (VALUES {known}), rules(license, seq) AS (VALUES {rules}),
s AS (
  SELECT doc_id, list_filter(list_transform(string_split(regexp_replace(coalesce(text, ''), '([.!?])[\x20\x09-\x0D]+', '\1' || chr(10), 'g'), chr(10)),
         lambda x: trim(regexp_replace(lower(x), '[^\p{{L}}\p{{N}}]+', ' ', 'g'))), lambda x: x <> '') AS l
  FROM documents),
hit AS (
  SELECT doc_id, string_agg(id, ',' ORDER BY i) AS ids
  FROM (SELECT doc_id, unnest(l) AS sentence, generate_subscripts(l, 1) AS i FROM s) JOIN known USING (sentence) GROUP BY doc_id),
lic AS (
  SELECT doc_id, string_agg(license, ',' ORDER BY license) AS licenses, count(*) AS n
  FROM (SELECT DISTINCT doc_id, license FROM hit JOIN rules ON contains(',' || ids || ',', seq)) GROUP BY doc_id)
SELECT s.doc_id, CAST(len(l) AS BIGINT) AS n_sentences, coalesce(ids, '') AS sentence_ids, coalesce(licenses, '') AS licenses,
       CAST(coalesce(n, 0) AS BIGINT) AS n_licenses
FROM s LEFT JOIN hit ON s.doc_id = hit.doc_id LEFT JOIN lic ON s.doc_id = lic.doc_id
"""


OP10_SQL = _sql()
