"""License scans by diagonal voting, in DataFrame functions only.

Hashes of all word k-grams of all documents are joined to the positions of the same hashes in
license templates. Each match votes for the diagonal "document word minus template word"; votes
are summed by document, template and diagonal, neighbouring diagonals are merged, and the spans
they mark are verified word by word: a match counts only where the words themselves are equal, a span
only where enough of the template's words and of its own are matched, all words among them that tell
the license from its family, and of overlapping spans only the one that fits its template best is kept.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

GRAM = 5
#: Diagonals this far apart belong to one span: words were inserted or left out in between.
NEAR = 8
#: A span counts when its matched words are this share of the template's words and of its own.
COVER = 0.5

# Phrases that name a license, with their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


class Template(NamedTuple):
    """A passage of a license; ``needs`` are phrases of it, of at most GRAM words, without which it is another license."""

    label: str
    text: str
    needs: tuple[str, ...] = ()


# Opening and granting passages of public licenses, with their labels and what tells them from others.
_TERMS = "This {0} is free software: you can redistribute it and/or modify it under the terms of the GNU {1} License as published by the Free Software Foundation, "
_LATER = "either version {2} of the License, or (at your option) any later version. "
_HOPE = "This {0} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {1} License for more details."
_GNU = [
    ("agpl-3", "program", "Affero General Public", "3"), ("gpl-2", "program", "General Public", "2"), ("gpl-3", "program", "General Public", "3"), ("lgpl-2", "library", "Library General Public", "2"),
    ("lgpl-2.1", "library", "Lesser General Public", "2.1"), ("lgpl-3", "program", "Lesser General Public", "3"), ("lgpl-3", "library", "Lesser General Public", "3"),
]
_BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_CC = [
    ("cc-by", "Attribution"), ("cc-by-sa", "Attribution ShareAlike"), ("cc-by-nd", "Attribution NoDerivatives"), ("cc-by-nc", "Attribution NonCommercial"),
    ("cc-by-nc-sa", "Attribution NonCommercial ShareAlike"), ("cc-by-nc-nd", "Attribution NonCommercial NoDerivatives"),
]
_CC_VERSIONS = [("4.0", "International"), ("3.0", "Unported")]
TEMPLATES = [
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.", ("with or without fee", "appear in all copies")),
    Template("apache-2", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    Template("bsd-2", _BSD),
    Template("bsd-3", _BSD + " Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.", ("endorse or promote products",)),
    Template("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.", ("waived all copyright",)),
    # Without a version, or with the version elsewhere.
    Template("gpl", (_TERMS + _HOPE).format("program", "General Public"), ("gnu general public",)),
    *[Template(label, (_TERMS + _LATER + _HOPE).format(what, name, version), (f"gnu {name}", f"version {version} of")) for label, what, name, version in _GNU],
    *[Template(label, f"This work is licensed under the Creative Commons {name} {v} {where} License. To view a copy of this license, visit http://creativecommons.org/licenses/{label[3:]}/{v}/", (f"Commons {name} {v[0]}",)) for label, name in _CC for v, where in _CC_VERSIONS],
    *[Template(label, f"licensed under a Creative Commons {name} {v} {where} License", (f"Commons {name} {v[0]}",)) for label, name in _CC for v, where in _CC_VERSIONS],
]


def _template_words(text: str) -> list[str]:
    return re.findall("[0-9a-z]+", text.lower())


def _need_starts(t: Template, k: int) -> list[list[int]]:
    """Of each phrase that a template needs, the places of the k-grams that hold it."""
    words, out = _template_words(t.text), []
    for need in map(_template_words, t.needs):
        at = [i for i in range(len(words) - len(need) + 1) if words[i : i + len(need)] == need]
        out.append(sorted({j for i in at for j in range(max(0, i + len(need) - k), min(i, len(words) - k) + 1)}))
    return out


def word_array(text: Column) -> Column:
    """Words of a text: A-Z in lower case, runs of digits, letters and non-ASCII characters."""
    low = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    parts = F.split(low, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    return F.filter(parts, lambda w: w != "")


def _grams(words: str, k: int, only: list[tuple[str, ...]] | None = None) -> Column:
    """(at, hash, own): position, hash and words of each k-gram, or of those whose hash is that of one of ``only``; none in shorter texts."""
    gram = ", ".join(f"get({words}, i + {j})" for j in range(k))
    at = f"sequence(0, size({words}) - {k})"
    if only is not None:  # a set of literals, looked up in constant time
        known = ", ".join(f"xxhash64({', '.join(repr(w) for w in g)})" for g in only) or "null"
        at = f"filter({at}, i -> xxhash64({gram}) in ({known}))"
    none = "cast(array() as array<struct<at: int, hash: bigint, own: array<string>>>)"
    return F.expr(f"if(size({words}) >= {k}, transform({at}, i -> struct(i as at, xxhash64({gram}) as hash, array({gram}) as own)), {none})")


def _places(words: str, phrase: str) -> Column:
    """First words of the places where a phrase stands."""
    w, parts = F.col(words), phrase.split()

    def here(i: Column) -> Column:
        test = F.get(w, i) == parts[0]
        for j, p in enumerate(parts[1:], 1):
            test = test & (F.get(w, i + j) == p)
        return F.coalesce(test, F.lit(False))

    none = F.expr("cast(array() as array<int>)")
    long = F.size(w) >= len(parts)
    return F.when(long & F.array_contains(w, parts[-2] if len(parts) > 2 else parts[0]), F.filter(F.sequence(F.lit(0), F.size(w) - len(parts)), here)).otherwise(none)


def template_grams(spark: SparkSession, templates: list[Template], k: int) -> DataFrame:
    """(template, t_at, hash, t_own) of all template k-grams: as large as the templates, not as the input."""
    rows = F.array(*[F.struct(F.lit(i).alias("template"), F.lit(" ".join(_template_words(t.text))).alias("text")) for i, t in enumerate(templates)])
    t = spark.range(1).select(F.explode(rows).alias("t")).select("t.template", F.split("t.text", " ").alias("w"))
    return t.select("template", F.explode(_grams("w", k)).alias("g")).select("template", F.col("g.at").alias("t_at"), F.col("g.hash").alias("hash"), F.col("g.own").alias("t_own"))


def _fact(values: list[str]) -> Column:
    """The value, an SQL expression, that belongs to the number of a template."""
    return F.expr(f"element_at(array({', '.join(values)}), template + 1)")


def spans(docs: DataFrame, templates: list[Template] | None = None, k: int = GRAM, near: int = NEAR, cover: float = COVER) -> DataFrame:
    """Verified template spans: row_id, label, first_word, last_word, share of the template's words matched.

    ``docs`` has ``row_id`` (unique) and ``w`` (words). A span holds all phrases that its template needs. Spans of a document
    that overlap are rivals: the one with most matched words stays, words that are missing from it or inserted counted off, then the smallest
    label, then the first. Documents without a span have no row; an empty table gives no rows. Of very long texts, only k-grams
    whose hash is a template's leave the row of the text, and rivals meet among spans that overlap, however many a text has.
    """
    templates = TEMPLATES if templates is None else templates
    own = [_template_words(t.text) for t in templates]
    known = sorted({tuple(w[i : i + k]) for w in own for i in range(len(w) - k + 1)})
    grams = docs.select("row_id", F.explode(_grams("w", k, known)).alias("g")).select("row_id", F.col("g.at").alias("at"), F.col("g.hash").alias("hash"), F.col("g.own").alias("own"))
    hits = grams.join(F.broadcast(template_grams(docs.sparkSession, templates, k)), "hash").where(F.col("own") == F.col("t_own")).withColumn("diagonal", F.col("at") - F.col("t_at"))
    votes = hits.groupBy("row_id", "template", "diagonal").agg(F.min("at").alias("first"), F.max("at").alias("last"), F.collect_set("t_at").alias("covered"))
    along = Window.partitionBy("row_id", "template").orderBy("diagonal")
    t_words = _fact([str(len(w)) for w in own])
    apart = (F.col("diagonal") - F.lag("diagonal").over(along) > near) | (F.col("first") - F.lag("first").over(along) > 2 * t_words)
    runs = votes.withColumn("run", F.sum(F.when(F.coalesce(apart, F.lit(False)), 1).otherwise(0)).over(along))
    merged = runs.groupBy("row_id", "template", "run").agg(F.min("first").alias("first_word"), (F.max("last") + k - 1).alias("last_word"), F.array_distinct(F.flatten(F.collect_list("covered"))).alias("covered"))
    # Template words that some matched k-gram holds.
    every = F.array_distinct(F.flatten(F.transform("covered", lambda t: F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda j: t + j))))
    starts = [", ".join(f"cast(array({', '.join(map(str, at))}) as array<int>)" for at in _need_starts(t, k)) for t in templates]
    needs = _fact([f"cast(array({x}) as array<array<int>>)" for x in starts])
    long = F.col("last_word") - F.col("first_word") + 1
    facts = merged.select("*", t_words.alias("t_words"), _fact([f"'{t.label}'" for t in templates]).alias("label"), F.size(every).alias("matched"), needs.alias("needs"))
    fits = facts.where((F.col("matched") >= cover * F.col("t_words")) & (F.col("matched") >= cover * long) & F.forall("needs", lambda n: F.arrays_overlap(n, "covered")))
    before = Window.partitionBy("row_id").orderBy("first_word", "last_word", "template")
    fresh = F.col("first_word") > F.max("last_word").over(before.rowsBetween(Window.unboundedPreceding, -1))
    fits = fits.withColumn("fresh", F.coalesce(fresh, F.lit(True)).cast("int")).withColumn("island", F.sum("fresh").over(before))
    off = (F.col("t_words") - F.col("matched")) + (long - F.col("matched"))
    rival = F.struct((off - F.col("matched")).alias("rank"), "label", "first_word", "last_word", (F.col("matched") / F.col("t_words")).alias("share"))
    rivals = fits.groupBy("row_id", "island").agg(F.array_sort(F.collect_list(rival)).alias("rivals"))
    none = F.filter("rivals", lambda _: F.lit(False))
    free = lambda kept, x: ~F.exists(kept, lambda y: (y["first_word"] <= x["last_word"]) & (x["first_word"] <= y["last_word"]))
    best = F.aggregate("rivals", none, lambda kept, x: F.when(free(kept, x), F.concat(kept, F.array(x))).otherwise(kept))
    return rivals.select("row_id", F.explode(best).alias("s")).select("row_id", "s.label", "s.first_word", "s.last_word", "s.share")


def scan(docs: DataFrame, phrases: dict[str, str] | None = None, templates: list[Template] | None = None) -> DataFrame:
    """License phrases and template spans of each document.

    Takes ``doc_id`` and ``text`` of ``docs``; other columns are ignored. One row per input row: doc_id,
    n_words, n_base, first_word, last_word, base_labels, labels and score (the best share of a template's
    words in a verified span, 1 with a phrase, 0 with nothing). Null and empty texts have no words. Rows that repeat a
    doc_id and a text get one result each, the same; an empty table gives no rows.
    """
    phrases = PHRASES if phrases is None else phrases
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    base = base.withColumn("row_id", F.struct("doc_id", F.xxhash64("text").alias("h"), F.octet_length("text").alias("n")))
    found = base.select("doc_id", "row_id", word_array(F.col("text")).alias("w"))
    places = {f"p{i}": (_places("w", p), label) for i, (p, label) in enumerate(phrases.items())}
    facts = found.select("doc_id", "row_id", F.size("w").cast("long").alias("n_words"), *[c.alias(n) for n, (c, _) in places.items()])
    every = F.concat(*[F.col(n) for n in places])
    of = F.array(*[F.when(F.size(n) > 0, F.lit(label)) for n, (_, label) in places.items()])
    facts = facts.select("doc_id", "row_id", "n_words", F.size(every).cast("long").alias("n_base"), F.array_min(every).cast("long").alias("first_word"), F.array_max(every).cast("long").alias("last_word"), F.array_sort(F.array_distinct(F.array_compact(of))).alias("base"))
    more = spans(found.select("row_id", "w"), templates).groupBy("row_id").agg(F.collect_set("label").alias("more"), F.max("share").alias("share"))
    joined = facts.alias("f").join(more.alias("m"), F.col("f.row_id").eqNullSafe(F.col("m.row_id")), "left")
    labels = F.array_sort(F.array_union("base", F.coalesce("more", F.expr("cast(array() as array<string>)"))))
    score = F.greatest(F.when(F.col("n_base") > 0, 1.0).otherwise(0.0), F.least(F.coalesce("share", F.lit(0.0)), F.lit(1.0)))
    return joined.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"), score.alias("score"))
