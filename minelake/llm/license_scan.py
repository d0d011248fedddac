"""License scan: Dice coefficient over word bigrams (built-ins only).

Every unit of a document (a line, a paragraph between blank lines, and the whole
text) is normalised (lower case, runs of anything but a-z and 0-9 become one space)
and compared with each licence template by the Dice coefficient of their sets of
word bigrams, 2 * common / (own + template's). A Dice of ``threshold`` needs set
sizes within threshold / (2 - threshold) of each other, so most units and templates
are pruned by size before any set is compared.

Passages inside longer units: every sentence, and every window of as many words as a
template, at any alignment, is compared with the templates and with the standard
paragraphs in ``PASSAGES`` (full licence texts hold these paragraphs). A passage of a
text needs at least threshold / (2 - threshold) of the template's bigrams somewhere in
the text, so almost all texts are settled by one intersection with all templates'
bigrams. A window starts at a bigram of its template. Of overlapping windows of two
licences the one with more common bigrams stays (BSD-3 holds BSD-2); a sentence counts
for its best licence only. A passage counts only for a licence that no line, paragraph
or whole text of the document matches.

Result: one row per distinct doc_id (null is one): n_units matched (and one for each
licence found in passages only), n_licenses matched, license with the best match (ties:
the one that sorts first), its dice, and the sorted licences joined by commas. Documents
without a match have 0, 0, null, null and "". Rows that repeat a doc_id are merged. Null
or empty texts match nothing. Units that are equal within a row count once. Extra columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8

# Short licence notices and standard licence texts, by SPDX id.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("BSD-2-Clause", 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.'),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MIT", "Released under the MIT License."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.'),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]


_GNU = ("This {} is free software{} you can redistribute it and/or modify it under the terms of the GNU {}General Public License as published by the "
        "Free Software Foundation{} either version {} of the License, or (at your option) any later version.")

# Standard paragraphs, matched as passages only.
PASSAGES = [
    ("AGPL-3.0", _GNU.format("program", ":", "Affero ", ",", "3")),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.'),
    ("GPL-2.0", _GNU.format("program", ";", "", ";", "2")),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-2.1", _GNU.format("library", ";", "Lesser ", ";", "2.1")),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-3.0", _GNU.format("library", ":", "Lesser ", ",", "3")),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-3.0", "This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3 of the GNU General Public License, supplemented by the additional permissions listed below."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
]


def bigrams(text: str) -> list[str]:
    words = re.sub("[^a-z0-9]+", " ", text.lower()).split()
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def _bounds(n: int, threshold: float) -> tuple[float, float]:
    return threshold / (2 - threshold) * n, (2 - threshold) / threshold * n


def units(text: Column) -> Column:
    return F.array_distinct(F.concat(F.split(text, "\n", -1), F.split(text, r"\n[ \t\r]*\n", -1), F.array(text)))


def _let(expr: Column, fn) -> Column:
    """``expr`` evaluated once for all its uses in ``fn``."""
    return F.element_at(F.transform(F.array(expr), fn), 1)


def _grams(text: Column) -> Column:
    """The word bigrams of a text in order, repeats kept."""
    words = F.split(F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " ")), " ")
    return _let(words, lambda w: F.transform(F.slice(w, 2, F.greatest(F.size(w), F.lit(1))), lambda x, i: F.concat_ws(" ", F.get(w, i), x)))


def _scored(own: Column, t: Column, start: Column, n: Column) -> Column:
    """A passage's bigram set against a template."""
    return _let(F.size(F.array_intersect(own, t["grams"])), lambda c: F.struct(
        c.alias("common"), (2 * c / (F.size(own) + F.size(t["grams"]))).alias("dice"), t["license"].alias("license"), start.alias("start"), n.alias("n")))


def _windows(g: Column, t: Column, threshold: float) -> Column:
    starts = F.filter(F.transform(g, lambda x, i: F.when(F.array_contains(t["grams"], x), i)), lambda i: i.isNotNull())
    return F.filter(F.transform(starts, lambda i: _let(F.array_distinct(F.slice(g, i + 1, t["n"])), lambda own: _scored(own, t, i, t["n"]))),
                    lambda h: h["dice"] >= threshold)


def _best(hits: Column) -> Column:
    """Windows that no overlapping window of another licence beats."""
    rank = lambda h: F.struct(h["common"], h["dice"])
    beats = lambda o, h: (rank(o) > rank(h)) | ((rank(o) == rank(h)) & (o["license"] < h["license"]))
    overlap = lambda o, h: (o["start"] < h["start"] + h["n"]) & (h["start"] < o["start"] + o["n"])
    return _let(hits, lambda hs: F.when(F.size(F.array_distinct(hs["license"])) < 2, hs).otherwise(
        F.filter(hs, lambda h: ~F.exists(hs, lambda o: (o["license"] != h["license"]) & overlap(o, h) & beats(o, h)))))


def passages(rows: DataFrame, known: list[tuple[str, str]], threshold: float) -> DataFrame:
    """(doc_id, dice, license) of the sentences and windows that match."""
    known = [(name, bigrams(t), len(re.sub("[^a-z0-9]+", " ", t.lower()).split()) - 1) for name, t in known if bigrams(t)]
    if not known:
        return rows.select("doc_id", F.lit(None).cast("double").alias("dice"), F.lit(None).cast("string").alias("license")).limit(0)
    # one below the bound's ceiling never passes, so rounding down loses nothing
    tpl = F.array(*[F.struct(F.lit(name).alias("license"), F.array(*map(F.lit, g)).alias("grams"), F.lit(n).alias("n"),
                             F.lit(int(_bounds(len(g), threshold)[0])).alias("need")) for name, g, n in known])
    every = F.array(*map(F.lit, sorted({x for _, g, _ in known for x in g})))
    near = _let(F.array_intersect(_grams(F.col("text")), every), lambda seen: F.filter(
        tpl, lambda t: F.when(F.size(seen) >= t["need"], F.size(F.array_intersect(t["grams"], seen)) >= t["need"]).otherwise(False)))
    # explode_outer and a null filter: no size filter is inferred that would work out the sets twice
    some = rows.select("doc_id", "text", F.explode_outer(F.filter(F.array(near), lambda c: F.size(c) > 0)).alias("near")).where(F.col("near").isNotNull())
    windows = _let(_grams(F.col("text")), lambda g: _best(F.flatten(F.transform("near", lambda t: _windows(g, t, threshold)))))
    sentences = F.flatten(F.transform(F.split("text", r"(?<=[.!?;:])\s+|\n"), lambda x: _let(F.array_distinct(_grams(x)), lambda own: F.slice(F.reverse(F.array_sort(
        F.filter(F.transform("near", lambda t: _scored(own, t, F.lit(0), F.lit(0))), lambda h: h["dice"] >= threshold))), 1, 1))))
    some = some.select("doc_id", F.explode_outer(F.concat(windows, sentences)).alias("h")).where(F.col("h").isNotNull())
    return some.select("doc_id", "h.dice", "h.license")


def license_scan(docs: DataFrame, templates: list[tuple[str, str]] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    given = TEMPLATES if templates is None else templates
    known = sorted((name, grams) for name, grams in ((n, bigrams(t)) for n, t in given) if grams)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    found = rows.select("doc_id", F.explode(units(F.col("text"))).alias("unit"))
    found = found.select("doc_id", F.xxhash64("unit").alias("unit"), F.split(F.trim(F.regexp_replace(F.lower("unit"), "[^a-z0-9]+", " ")), " ").alias("words"))
    w = F.col("words")
    grams = F.array_distinct(F.transform(F.slice(w, 2, F.size(w)), lambda x, i: F.concat_ws(" ", F.get(w, i), x)))
    found = found.select("doc_id", "unit", grams.alias("grams"))
    n = F.size("grams")
    dice = [F.when(n.between(*_bounds(len(g), threshold)), F.struct(
        (2 * F.size(F.array_intersect("grams", F.array(*map(F.lit, g)))) / (n + len(g))).alias("dice"), F.lit(name).alias("license"))) for name, g in known]
    kind = "array<struct<dice:double,license:string>>"
    hits = F.filter(F.array(*dice), lambda h: h["dice"] >= threshold) if dice else F.array().cast(kind)
    hits = found.select("doc_id", "unit", F.inline(hits))
    inner = passages(rows, given + (PASSAGES if templates is None else []), threshold).select("doc_id", F.struct("dice", "license").alias("inner"))
    both = hits.unionByName(inner, allowMissingColumns=True).unionByName(rows.select("doc_id"), allowMissingColumns=True)
    # sets of a document's matched units, passages and licences: a few
    out = both.groupBy("doc_id").agg(
        F.collect_set("unit").alias("units"), F.collect_set(F.struct("dice", "license")).alias("whole"), F.collect_set("inner").alias("inner"))
    out = out.withColumn("whole", F.filter("whole", lambda h: h["license"].isNotNull()))
    out = out.withColumn("inner", F.filter("inner", lambda h: ~F.array_contains(F.col("whole.license"), h["license"])))
    out = out.withColumn("all", F.concat("whole", "inner"))
    best = F.try_element_at(F.array_sort(F.transform("all", lambda h: F.struct((-h["dice"]).alias("d"), h["license"].alias("license")))), F.lit(1))
    names = F.array_sort(F.array_distinct("all.license"))
    return out.select("doc_id", (F.size("units") + F.size(F.array_distinct("inner.license"))).cast("long").alias("n_units"),
                      F.size(names).cast("long").alias("n_licenses"), best["license"].alias("license"), F.round(-best["d"], 6).alias("dice"),
                      F.array_join(names, ",").alias("licenses"))


def oracle_sql(table: str = "documents", threshold: float = THRESHOLD) -> str:
    """The same scan in DuckDB SQL, passages included."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    listed = lambda t: "[" + ", ".join(map(quoted, bigrams(t))) + "]"
    known = ", ".join(f"({quoted(n)}, {listed(t)})" for n, t in TEMPLATES)
    inner = ", ".join(f"({k}, {quoted(n)}, {listed(t)}, {len(re.sub('[^a-z0-9]+', ' ', t.lower()).split()) - 1}, {int(_bounds(len(bigrams(t)), threshold)[0])})"
                      for k, (n, t) in enumerate(TEMPLATES + PASSAGES) if bigrams(t))
    words = lambda c: f"string_split(trim(regexp_replace(lower({c}), '[^a-z0-9]+', ' ', 'g')), ' ')"
    return f"""
WITH tpl(license, tg) AS (VALUES {known}),
units AS (SELECT doc_id, unnest(list_distinct(list_concat(string_split(text, chr(10)), regexp_split_to_array(text, '\\n[ \\t\\r]*\\n'), [text]))) AS unit
          FROM {table} WHERE text IS NOT NULL),
words AS (SELECT doc_id, unit, {words('unit')} AS w FROM units),
grams AS (SELECT doc_id, unit, list_distinct([w[i] || ' ' || w[i + 1] for i in range(1, len(w))]) AS g FROM words WHERE len(w) > 1),
hits AS (SELECT doc_id, unit, license, 2.0 * len(list_intersect(g, tg)) / (len(g) + len(tg)) AS dice
         FROM grams JOIN tpl ON len(g) BETWEEN {threshold / (2 - threshold)} * len(tg) AND {(2 - threshold) / threshold} * len(tg)),
ok AS (SELECT * FROM hits WHERE dice >= {threshold}),
tp(pid, license, tg, n, need) AS (VALUES {inner}),
tm AS (SELECT pid, unnest(tg) AS gram FROM tp),
txt AS (SELECT row_number() OVER () AS rid, doc_id, text FROM {table} WHERE text IS NOT NULL),
tw AS MATERIALIZED (SELECT rid, [w[i] || ' ' || w[i + 1] for i in range(1, len(w))] AS g FROM (SELECT rid, {words('text')} AS w FROM txt)),
st AS MATERIALIZED (SELECT rid, unnest(g) AS gram, generate_subscripts(g, 1) AS i FROM tw),
near AS (SELECT rid, pid FROM st JOIN tm USING (gram) GROUP BY rid, pid HAVING count(DISTINCT gram) >= (SELECT need FROM tp WHERE tp.pid = tm.pid)),
win AS (SELECT st.rid, st.i, n, license, tg, list_distinct(g[st.i:st.i + n - 1]) AS own
        FROM near JOIN tp USING (pid) JOIN st USING (rid) JOIN tm ON tm.pid = near.pid AND tm.gram = st.gram JOIN tw ON tw.rid = st.rid),
hit AS MATERIALIZED (SELECT * FROM (SELECT rid, i, n, license, len(list_intersect(own, tg)) AS common, 2.0 * len(list_intersect(own, tg)) / (len(own) + len(tg)) AS dice FROM win) WHERE dice >= {threshold}),
kept AS (SELECT rid, dice, license FROM hit h WHERE NOT EXISTS (SELECT 1 FROM hit o WHERE o.rid = h.rid AND o.license <> h.license AND o.i < h.i + h.n AND h.i < o.i + o.n
  AND (o.common > h.common OR (o.common = h.common AND (o.dice > h.dice OR (o.dice = h.dice AND o.license < h.license)))))),
sen AS (SELECT DISTINCT rid, unnest(string_split(regexp_replace(text, '([.!?;:])[ \\t\\n\\x0B\\f\\r]+', '\\1' || chr(10), 'g'), chr(10))) AS s FROM txt WHERE rid IN (SELECT rid FROM near)),
sg AS (SELECT rid, s, list_distinct([w[i] || ' ' || w[i + 1] for i in range(1, len(w))]) AS own FROM (SELECT rid, s, {words('s')} AS w FROM sen) WHERE len(w) > 1),
sh AS (SELECT rid, dice, license FROM (SELECT rid, s, license, len(list_intersect(own, tg)) AS common, 2.0 * len(list_intersect(own, tg)) / (len(own) + len(tg)) AS dice
         FROM sg JOIN near USING (rid) JOIN tp USING (pid)) WHERE dice >= {threshold}
       QUALIFY row_number() OVER (PARTITION BY rid, s ORDER BY common DESC, dice DESC, license DESC) = 1),
passage AS (SELECT DISTINCT doc_id, x.dice, x.license FROM (SELECT * FROM kept UNION ALL SELECT * FROM sh) x JOIN txt USING (rid)
            WHERE NOT EXISTS (SELECT 1 FROM ok WHERE ok.doc_id IS NOT DISTINCT FROM txt.doc_id AND ok.license = x.license)),
every AS (SELECT doc_id, unit, dice, license FROM ok UNION ALL SELECT doc_id, NULL, dice, license FROM passage),
per AS (SELECT doc_id, count(DISTINCT unit) + count(DISTINCT license) FILTER (WHERE unit IS NULL) AS n_units, count(DISTINCT license) AS n_licenses, max(dice) AS dice,
               string_agg(DISTINCT license, ',' ORDER BY license) AS licenses FROM every GROUP BY doc_id),
best AS (SELECT o.doc_id, min(o.license) AS license FROM every o JOIN per p ON o.doc_id IS NOT DISTINCT FROM p.doc_id AND o.dice = p.dice GROUP BY o.doc_id)
SELECT d.doc_id, coalesce(p.n_units, 0) AS n_units, coalesce(p.n_licenses, 0) AS n_licenses, b.license, round(p.dice, 6) AS dice, coalesce(p.licenses, '') AS licenses
FROM (SELECT DISTINCT doc_id FROM {table}) d LEFT JOIN per p ON d.doc_id IS NOT DISTINCT FROM p.doc_id LEFT JOIN best b ON d.doc_id IS NOT DISTINCT FROM b.doc_id"""
