"""Licence scan (operator 9), in built-in column expressions alone.

A unit is each line of a text and, where there are several lines, the text as a
whole.  Units and templates are normalised alike: every run of signs other than
ASCII letters and digits becomes one space, letters become lower case.  A unit
matches a template if

- size bound: its number of word bigrams, repeats included, lies between
  n t / (2 - t) and n (2 - t) / t, where n is the template's and t the threshold
  (outside, equal bags could not reach t), and
- Dice: 2 |A n B| / (|A| + |B|) >= t over the sets of bigrams.

The size bound is tested on word counts before any bigram is formed, and again
for each template before its bigrams are compared.

A notice that is wrapped over lines, or stands in a longer line, and the full
licence texts of ``license_texts`` are looked for as passages: runs of at most
n (2 - t) / t bigrams that start where a run of the template's bigrams starts and
end where one ends (any others only add foreign bigrams).  Of a start the best
end counts, found in one pass with running counts of the different bigrams; of
passages that overlap the best one.  This is done for templates
that no line and not the text as a whole matches, and only where it can succeed:
the text has one of the template's anchors (words chosen so that the bigrams
without them are too few for t), and then at least |B| t / (2 - t) of the
template's |B| different bigrams.  Unit -i is a passage that starts at word i.

Everything happens inside a row: no shuffle, and a frequent line costs no more
than a rare one.

Edge cases: null and empty texts, and units of one word, match nothing; of
equal Dice values the name first in order is the best; repeated rows each give a
row; very long texts are scanned whole; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import lru_cache
from pathlib import Path

from pyspark.sql import Column, DataFrame, functions as F

THRESHOLD = 0.8

# Wordings of public licence notices.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable "
        "law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."),
    "BSD-2-Clause-header": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:"),
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies."),
    "MIT": "Released under the MIT License.",
    "MIT-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, "
        "copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom "
        "the Software is furnished to do so, subject to the following conditions:"),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}


def normal_words(text: str) -> list[str]:
    return re.sub(r"[^A-Za-z0-9]+", " ", text).lower().split()


def template_sizes(templates: dict[str, str]) -> list[tuple[str, list[str], int]]:
    """Name, different bigrams in order, number of bigrams with repeats."""
    out = []
    for name in sorted(templates):
        words = normal_words(templates[name])
        pairs = [f"{a} {b}" for a, b in zip(words, words[1:])]
        out.append((name, sorted(set(pairs)), len(pairs)))
    return out


@lru_cache
def full_texts() -> dict[str, str]:
    """The full licence texts; only the driver reads the files."""
    return {f"{f.stem}-text": f.read_text() for f in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))}


def anchors(templates: dict[str, str], threshold: float) -> dict[str, tuple[int, list[str]]]:
    """Of each template, how many different bigrams a match shares at least, and
    words of which a match has one: fewer bigrams than that are without them."""
    out, used = {}, set()
    for name, grams, _ in template_sizes(templates):
        need = max(1, math.ceil(len(grams) * threshold / (2 - threshold) - 1e-9))
        left, chosen = [set(g.split()) for g in grams], []
        while len(left) >= need:
            held = Counter(w for g in left for w in g)  # long words, and those of other templates, first
            best = max(sorted(held), key=lambda w: held[w] * min(len(w), 9) ** 2 * (3 if w in used else 1) * (1 if len(w) > 5 else 0.02))
            chosen.append(best)
            left = [g for g in left if best not in g]
        used |= set(chosen)
        out[name] = need, chosen
    return out


def _list(words: list[str]) -> Column:
    return F.split(F.lit("\n".join(words)), "\n")


def _let(value: Column, then) -> Column:
    """``then(value)``, for which ``value`` is computed once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def passages(clean: Column, names: Column, templates: dict[str, str], threshold: float) -> Column:
    """``(unit, name, dice)`` of the passages of a normalised text (with line ends)
    that match templates other than ``names``."""
    marks, sizes = anchors(templates, threshold), template_sizes(templates)
    if not sizes:
        return F.array().cast("array<struct<unit:int,name:string,dice:double>>")
    known = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(name).alias("name"), F.lit(2 * marks[name][0]).alias("length"),
                               _list(marks[name][1]).alias("anchors")) for i, (name, _, _) in enumerate(sizes)])
    whole = F.array(*[F.struct(F.lit(name).alias("name"), _list(grams).alias("grams"), F.lit(len(grams)).alias("size"),
                               F.lit(marks[name][0]).alias("need"), F.lit(math.floor(n * (2 - threshold) / threshold + 1e-9)).alias("most"))
                      for name, grams, n in sizes])
    words = F.split(F.trim(F.regexp_replace(clean, r"[ \n]+", " ")), " ")
    grams = _let(words, lambda w: F.slice(F.zip_with(w, F.slice(w, 2, 1 << 30), lambda a, b: F.concat(a, F.lit(" "), b)), 1, F.size(w) - 1))
    shared = lambda a, b: F.size(F.array_intersect(a, b))

    def last_seen(g: Column) -> Column:
        """Of each place of ``g``, the place before it that has the same bigram, or 0."""
        placed = F.array_sort(F.transform(g, lambda v, i: F.struct(v.alias("v"), (i + 1).alias("j"))))
        pairs = _let(placed, lambda p: F.zip_with(p, F.slice(F.concat(F.slice(p, 1, 1), p), 1, F.size(p)), lambda b, a: F.struct(
            b.j.alias("j"), F.when((a.v == b.v) & (a.j < b.j), a.j).otherwise(0).alias("seen"))))
        return F.transform(F.array_sort(pairs), lambda p: p.seen)

    def best_from(spots: Column, x: Column, at: Column) -> Column:
        """The best end of a start, in one pass: a bigram is new to the passage if it was last seen before the start."""
        stretch = F.slice(spots, at, x.most)
        last = F.least(at + x.most - 1, F.size(spots))

        def step(s: Column, o: Column) -> Column:
            new = o.seen < at
            every, both = s.every + new.cast("int"), s.both + (new & o.hit).cast("int")
            dice = F.lit(2.0) * both / (every + x["size"])
            better = (o.closes | (o.j == last)) & (dice > s.dice)
            return F.struct(every.alias("every"), both.alias("both"), F.when(better, dice).otherwise(s.dice).alias("dice"),
                            F.when(better, o.j).otherwise(s.end).alias("end"))

        start = F.struct(F.lit(0).alias("every"), F.lit(0).alias("both"), F.lit(-1.0).alias("dice"), F.lit(0).alias("end"))
        return F.aggregate(stretch, start, step, lambda s: F.struct((-s.dice).alias("d"), at.alias("at"), s.end.alias("end")))

    def search(g: Column, seen: Column, x: Column) -> Column:
        def of(spots: Column) -> Column:
            starts = F.transform(F.filter(spots, lambda o: o.opens), lambda o: o.j)
            starts = F.filter(starts, lambda i: shared(F.slice(g, i, x.most), x.grams) >= x.need)
            found = F.transform(starts, lambda at: best_from(spots, x, at))
            ranked = F.array_sort(F.filter(found, lambda m: -m.d >= F.lit(threshold)))
            apart = F.aggregate(ranked, F.filter(ranked, lambda m: F.lit(False)), lambda kept, m: F.when(
                F.exists(kept, lambda o: (o["at"] <= m.end) & (m["at"] <= o.end)), kept).otherwise(F.concat(kept, F.array(m))))
            return F.transform(apart, lambda m: F.struct((-m["at"]).alias("unit"), x["name"].alias("name"), (-m.d).alias("dice")))

        def marked(hits: Column) -> Column:
            flag = lambda i: F.coalesce(F.get(hits, i), F.lit(False))
            return F.transform(seen, lambda p, i: F.struct((i + 1).alias("j"), p.alias("seen"), flag(i).alias("hit"), (
                flag(i) & ~flag(i - 1)).alias("opens"), (flag(i) & ~flag(i + 1)).alias("closes")))
        return _let(_let(F.transform(g, lambda v: F.array_contains(x.grams, v)), marked), of)

    def within(near: Column) -> Column:
        def of(g: Column) -> Column:
            likely = F.filter(F.transform(near, lambda i: F.get(whole, i)), lambda x: shared(g, x.grams) >= x.need)
            return _let(likely, lambda some: F.when(F.size(some) > 0, _let(last_seen(g), lambda seen: F.flatten(
                F.transform(some, lambda x: search(g, seen, x))))))
        return F.when(F.size(near) > 0, _let(grams, of))

    every = sorted({w for _, chosen in marks.values() for w in chosen})
    here = F.array_intersect(F.split(F.translate(clean, "\n", " "), " "), _list(every))
    near = _let(here, lambda w: F.transform(F.filter(known, lambda x: (F.length(clean) >= x.length) & ~F.array_contains(names, x["name"])
                                                     & F.arrays_overlap(x.anchors, w)), lambda x: x.i))
    return F.coalesce(_let(near, within), F.array().cast("array<struct<unit:int,name:string,dice:double>>"))


def _templates(templates: dict[str, str]) -> Column:
    return F.array(*[F.struct(F.lit(name).alias("name"), F.array(*map(F.lit, grams)).alias("grams"), F.lit(n).alias("n"))
                     for name, grams, n in template_sizes(templates)])


def scan(docs: DataFrame, text: str = "text", into: str = "matches", templates: dict[str, str] | None = None,
         threshold: float = THRESHOLD, long_templates: dict[str, str] | None = None) -> DataFrame:
    """``docs`` with ``into``, an array of ``(unit, name, dice)``: unit 0 is the text
    as a whole, unit i its i-th line, unit -i a passage that starts at its i-th
    word.  ``long_templates`` are looked for as passages only."""
    long_templates = full_texts() if long_templates is None and templates is None else long_templates or {}
    templates = TEMPLATES if templates is None else templates
    sizes = [n for _, _, n in template_sizes(templates)]
    least, most = min(sizes) * threshold / (2 - threshold), max(sizes) * (2 - threshold) / threshold
    t = F.lit(threshold)

    docs = docs.withColumn("_clean", F.lower(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[^A-Za-z0-9\n]+", " ")))
    clean = F.col("_clean")
    lines = F.transform(F.split(clean, "\n"), lambda x, i: F.struct((i + 1).alias("unit"), F.trim(x).alias("body")))
    whole = F.array(F.struct(F.lit(0).alias("unit"), F.trim(F.regexp_replace(clean, r"[ \n]+", " ")).alias("body")))
    step = docs.withColumn("_units", F.when(clean.contains("\n"), F.concat(whole, lines)).otherwise(lines))
    # words are parted by single spaces, so their number is that of the spaces and one
    gaps = lambda body: F.length(body) - F.length(F.replace(body, F.lit(" "), F.lit("")))
    step = step.withColumn("_units", F.filter("_units", lambda u: (gaps(u.body) >= F.lit(least)) & (gaps(u.body) <= F.lit(most))))

    def grams(u: Column) -> Column:
        words = F.split(u.body, " ")
        pairs = F.zip_with(words, F.slice(words, 2, 1 << 30), lambda a, b: F.concat(a, F.lit(" "), b))
        return F.struct(u.unit.alias("unit"), gaps(u.body).alias("n"), F.array_distinct(F.slice(pairs, 1, gaps(u.body))).alias("grams"))

    step = step.withColumn("_units", F.transform("_units", grams))

    def against(u: Column) -> Column:
        near = F.filter(_templates(templates), lambda x: (u.n >= x.n * t / (2 - t)) & (u.n <= x.n * (2 - t) / t))
        scored = F.transform(near, lambda x: F.struct(u.unit.alias("unit"), x["name"].alias("name"),
                             (F.lit(2.0) * F.size(F.array_intersect(u.grams, x.grams)) / (F.size(u.grams) + F.size(x.grams))).alias("dice")))
        return F.filter(scored, lambda m: m.dice >= t)

    step = step.withColumn("_found", F.flatten(F.transform("_units", against)))
    more = passages(clean, F.transform("_found", lambda m: m["name"]), {**templates, **long_templates}, threshold)
    return step.withColumn(into, F.concat("_found", more)).drop("_units", "_clean", "_found")


def op9_licenses(docs: DataFrame) -> DataFrame:
    """Per document: the licences found (names in order), the number of units that
    match, and the best match."""
    found = scan(docs.select("doc_id", "text"))
    best = F.element_at(F.sort_array(F.transform("matches", lambda m: F.struct((-m.dice).alias("d"), m["name"].alias("name")))), 1)
    return found.select(
        "doc_id", F.array_join(F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["name"]))), ",").alias("licenses"),
        F.size(F.array_distinct(F.transform("matches", lambda m: m.unit))).alias("n_units"),
        F.when(F.size("matches") > 0, best["name"]).alias("best_license"),
        F.when(F.size("matches") > 0, F.round(-best["d"], 6)).alias("best_dice"))


def oracle_sql(threshold: float = THRESHOLD) -> str:
    rows = ", ".join("('%s', '%s')" % (n, b.replace("'", "''")) for n, b in TEMPLATES.items())
    words = "list_filter(string_split(regexp_replace(lower({}), '[^a-z0-9]+', ' ', 'g'), ' '), lambda w: w <> '')"
    grams = "list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])"
    return f"""
WITH template AS (
  SELECT name, {grams} AS bag FROM (SELECT name, {words.format('body')} AS w FROM (VALUES {rows}) AS v(name, body))),
line AS (
  SELECT doc_id, k, unnest(string_split(text, chr(10))) AS body, generate_subscripts(string_split(text, chr(10)), 1) AS unit
  FROM (SELECT doc_id, row_number() OVER () AS k, regexp_replace(coalesce(text, ''), '[^A-Za-z0-9\\n]+', ' ', 'g') AS text FROM documents)),
unit AS (
  SELECT doc_id, k, unit, body FROM line
  UNION ALL
  SELECT doc_id, k, 0, string_agg(body, ' ' ORDER BY unit) FROM line GROUP BY doc_id, k HAVING count(*) > 1),
bag AS (
  SELECT doc_id, k, unit, {grams} AS bag FROM (SELECT doc_id, k, unit, {words.format('body')} AS w FROM unit) WHERE len(w) > 1),
hit AS (
  SELECT k, unit, name, 2.0 * len(list_intersect(b.bag, t.bag)) / (len(list_distinct(b.bag)) + len(list_distinct(t.bag))) AS dice
  FROM bag b JOIN template t ON len(b.bag) >= len(t.bag) * {threshold} / (2 - {threshold}) AND len(b.bag) <= len(t.bag) * (2 - {threshold}) / {threshold}),
best AS (
  SELECT k, string_agg(DISTINCT name, ',' ORDER BY name) AS licenses, CAST(count(DISTINCT unit) AS INTEGER) AS n_units,
    first(name ORDER BY dice DESC, name) AS best_license, round(max(dice), 6) AS best_dice
  FROM hit WHERE dice >= {threshold} GROUP BY k)
SELECT d.doc_id, coalesce(licenses, '') AS licenses, coalesce(n_units, 0) AS n_units, best_license, best_dice
FROM (SELECT DISTINCT doc_id, k FROM line) d LEFT JOIN best USING (k)
"""
