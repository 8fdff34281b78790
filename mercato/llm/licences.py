"""Licence scan by Dice coefficient over word bigrams (operator 8), DataFrame
only.

The whole text is normalised to words, so a notice is found in running text
and over line breaks.  A template of L words is compared with the windows of L
words that begin with one of its bigrams, by the Dice coefficient of the two
bigram sets.  Of hits that overlap the best one stays: by score, then length,
then place, then name.

Size bounds prune twice before any window is compared.  A template of s
bigrams reaches the threshold t only with s t / (2 - t) of them at least; so a
text without both words of one of any s - s t / (2 - t) + 1 of its bigrams
cannot match (a plain search in the text for those of the longest words), nor one that holds fewer of its
bigrams.  Everything is evaluated in place; nothing is shuffled.

Defined cases: null and empty texts have no words; a text of fewer than two
words has no bigrams; a window at the end of the text may be shorter; repeated
rows are reported once each; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm.common import read_table, text_of

THRESHOLD = 0.8

# Notices as projects write them (fixed values).
TEMPLATES = (
    ("AGPL-3.0", "This program is licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0-header", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
     "except in compliance with the License. You may obtain a copy of the License at "
     "http://www.apache.org/licenses/LICENSE-2.0"),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0-work", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or "
     "neighboring rights to this work."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
     "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT-grant", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
     "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
     "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies "
     "of the Software, and to permit persons to whom the Software is furnished to do so."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)

# Parts of full licence texts (fixed values).
_WARRANTY = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO "
    "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
    "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, "
    "TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE "
    "SOFTWARE.")
_NOTICE_KEPT = "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
_BSD_START = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution.")
_BSD_THIRD = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission.")
_BSD_END = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_ISC_END = (
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL "
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
    "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
    "THIS SOFTWARE.")
_BY_NAME = dict(TEMPLATES)
TEMPLATES += (
    ("BSD-2-Clause-text", f"{_BSD_START} {_BSD_END}"),
    ("BSD-3-Clause-text", f"{_BSD_START} {_BSD_THIRD} {_BSD_END}"),
    ("ISC-text", f"{_BY_NAME['ISC']} {_ISC_END}"),
    ("MIT-text", f"{_BY_NAME['MIT-grant'].removesuffix('.')}, subject to the following conditions: {_NOTICE_KEPT} {_WARRANTY}"),
)


def normalised(text: str) -> list[str]:
    """Words of a template: lower case, letters, digits and inner dots."""
    return re.sub(r"\.( |$)", " ", re.sub("[^a-z0-9.]+", " ", text.lower())).split()


class Template:
    """A template's words as a sorted set of bigrams, and its bounds."""

    def __init__(self, name: str, text: str, threshold: float):
        words = normalised(text)
        self.name, self.pairs, self.n_words = name, sorted({f"{a} {b}" for a, b in zip(words, words[1:])}), len(words)
        self.fewest = math.ceil(len(self.pairs) * threshold / (2 - threshold) - 1e-9)  # bigrams that a match shares
        # Of these bigrams a match has one at least: the text holds both its words, the longer one first here.
        missing = len(self.pairs) - self.fewest + 1
        both = sorted((sorted(p.split(), key=lambda w: (-len(w), w)) for p in self.pairs),
                      key=lambda w: (-len(w[0]), w[0], -len(w[1]), w[1]))
        self.keys: dict[str, set[str]] = {}
        for long, short in both[:missing]:
            self.keys.setdefault(long, set()).add(short)


def _has_key(keys: dict[str, set[str]]):
    """Whether a text holds a longer word and one of those beside it."""
    def any_of(conditions):
        return reduce(or_, conditions)

    return any_of(F.contains("text", F.lit(long)) & any_of(F.contains("text", F.lit(w)) for w in sorted(short))
                  for long, short in sorted(keys.items()))


def _found(template: Template, pairs, threshold: float):
    """Array of the hits (begin, end, dice, name) of one template; ``pairs``:
    the text's bigrams, by place."""
    own = F.array(*map(F.lit, template.pairs))
    places = F.filter(F.transform(pairs, lambda p, i: F.when(F.array_contains(own, p), i)), lambda i: i.isNotNull())

    def hit(i):
        window = F.slice(pairs, i + 1, template.n_words - 1)
        shared = 2.0 * F.size(F.array_intersect(window, own))
        return F.struct(i.alias("begin"), F.least(i + template.n_words, F.size(pairs) + 1).alias("end"),
                        (shared / (F.size(F.array_distinct(window)) + len(template.pairs))).alias("dice"),
                        F.lit(template.name).alias("name"))

    hits = F.filter(F.transform(places, hit), lambda h: h["dice"] >= threshold)
    return F.when(F.size(places) >= template.fewest, hits)


def scan(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """One row per hit: doc_id, word (the first word's number), n_words,
    licence, dice."""
    known = [Template(name, text, threshold) for name, text in templates]
    rows = docs.select(docs["doc_id"].alias("doc_id"), F.lower(text_of(docs)).alias("text"))

    every: dict[str, set[str]] = {}
    for t in known:
        for long, short in t.keys.items():
            every.setdefault(long, set()).update(short)
    rows = rows.where(_has_key(every))
    plain = F.regexp_replace(F.regexp_replace("text", "[^a-z0-9.]+", " "), r"\.( |$)", " ")
    rows = rows.select("doc_id", F.array(*(_has_key(t.keys) for t in known)).alias("asked"), F.split(F.btrim(plain), " +").alias("words"))
    # Nothing is filtered from here on: a filter would be pushed down and evaluate what it reads again.
    pairs = F.transform(F.slice("words", 2, F.greatest(F.lit(0), F.size("words") - 1)),
                        lambda w, i: F.concat(F.get("words", i), F.lit(" "), w))
    rows = rows.select("doc_id", "asked", pairs.alias("pairs"))
    nothing = F.array().cast("array<struct<begin:int,end:int,dice:double,name:string>>")
    hits = F.flatten(F.array(*(F.coalesce(F.when(F.get("asked", F.lit(k)), _found(t, F.col("pairs"), threshold)), nothing)
                               for k, t in enumerate(known))))
    rows = rows.select("doc_id", hits.alias("hits"))

    def better(a, b):
        length = (a["end"] - a["begin"]) - (b["end"] - b["begin"])
        later = (a["begin"] < b["begin"]) | (a["begin"] == b["begin"]) & (a["name"] < b["name"])
        longer = (length > 0) | (length == 0) & later
        return (a["dice"] > b["dice"]) | (a["dice"] == b["dice"]) & longer

    best = F.filter("hits", lambda h: ~F.exists("hits", lambda g: (g["begin"] < h["end"]) & (h["begin"] < g["end"]) & better(g, h)))
    return rows.select("doc_id", F.explode(best).alias("h")).select(
        "doc_id", F.col("h.begin").alias("word"), (F.col("h.end") - F.col("h.begin")).alias("n_words"),
        F.col("h.name").alias("licence"), F.col("h.dice").alias("dice"))


def op8_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read_table(spark, sf_dir, "documents"))


def oracle(templates=TEMPLATES, threshold: float = THRESHOLD) -> str:
    """Windows as joins of numbered bigrams, without the bounds."""
    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    notices = ", ".join(f"({quoted(name)}, {quoted(text)})" for name, text in templates)
    plain = ("string_split_regex(trim(regexp_replace(regexp_replace(lower({}), '[^a-z0-9.]+', ' ', 'g'), "
             "'\\.( |$)', ' ', 'g')), ' +')")
    return f"""
WITH notices(name, body) AS (VALUES {notices}),
shapes AS (SELECT name, {plain.format('body')} AS w FROM notices),
parts AS (SELECT name, len(w) AS size, unnest(list_distinct(list_transform(range(1, len(w)),
            lambda i: w[i] || ' ' || w[i + 1]))) AS pair FROM shapes),
sizes AS (SELECT name, any_value(size) AS size, count(*) AS s FROM parts GROUP BY name),
texts AS (SELECT row_number() OVER () AS r, doc_id, {plain.format('text')} AS w FROM documents WHERE text IS NOT NULL),
pairs AS (SELECT r, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS pair,
            unnest(range(0, len(w) - 1)) AS place FROM texts WHERE len(w) > 1),
held AS (SELECT r, place, name, size, p.pair FROM pairs p JOIN parts USING (pair)),
often AS (SELECT r, name FROM held GROUP BY r, name
          HAVING count(DISTINCT pair) >= {threshold} / 2 * any_value((SELECT s FROM sizes z WHERE z.name = held.name))),
starts AS (SELECT h.r, h.name, h.size, h.place FROM held h SEMI JOIN often USING (r, name)),
shared AS (SELECT a.r, a.name, a.place, count(DISTINCT b.pair) AS c FROM starts a
           JOIN held b ON a.r = b.r AND a.name = b.name AND b.place BETWEEN a.place AND a.place + a.size - 2
           GROUP BY ALL),
widths AS (SELECT a.r, a.name, a.place, count(DISTINCT b.pair) AS u, max(b.place) + 2 AS last FROM starts a
           JOIN pairs b ON a.r = b.r AND b.place BETWEEN a.place AND a.place + a.size - 2 GROUP BY ALL),
hits AS (SELECT r, name, place AS b, last AS e, 2.0::DOUBLE * c / (u + s) AS dice
         FROM shared JOIN widths USING (r, name, place) JOIN sizes USING (name)
         WHERE 2.0::DOUBLE * c / (u + s) >= {threshold})
SELECT doc_id, CAST(h.b AS INTEGER) AS word, CAST(h.e - h.b AS INTEGER) AS n_words, h.name AS licence, h.dice
FROM hits h JOIN texts USING (r)
WHERE NOT EXISTS (SELECT 1 FROM hits g WHERE g.r = h.r AND g.b < h.e AND h.b < g.e
  AND (-g.dice, g.b - g.e, g.b, g.name) < (-h.dice, h.b - h.e, h.b, h.name))
"""
