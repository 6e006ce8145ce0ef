"""Licence scan: sparse TF-IDF cosine of notices, headers and whole texts to templates, then inheritance along the directory tree."""

from __future__ import annotations

import math
import re
from pathlib import Path
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import count_words, let, stored


class Template(NamedTuple):
    """A text of a licence; what is similar must also hold all terms of ``must`` (a name, a version) to count.

    Without such terms similarity alone decides, and every text that could be similar has to be compared.
    """

    licence: str
    text: str
    must: tuple[str, ...] = ()


# The usual one-line notices of public licences.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license. Redistribution and use in source and binary forms are permitted.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License, CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright to this work, CC0 1.0 Universal.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
# What a text like a notice must hold.
NOTICE_MUST = {
    "Apache-2.0": ("apache",), "BSD-3-Clause": ("redistribution",), "CC-BY-4.0": ("creative",), "CC-BY-NC-4.0": ("by-nc",), "CC0-1.0": ("waived",),
    "GPL-3.0": ("gnu",), "MIT": ("mit",), "MPL-2.0": ("mozilla",)}
_GPL = ("This program is free software{0} you can redistribute it and/or modify it under the terms of the GNU {1} Public License as published by "
        "the Free Software Foundation{2} either version {3} of the License, or (at your option) any later version.")
_GPL_REST = (" This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
             "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {1} Public License for more details. You should have received a copy of "
             "the GNU {1} Public License along with this program. If not, see <https://www.gnu.org/licenses/>.")
_APACHE = ('Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
           "You may obtain a copy of the License at")
_APACHE_REST = (' http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the '
                'License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License '
                "for the specific language governing permissions and limitations under the License.")
_MIT_GRANT = ('Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the '
              '"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, '
              "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to "
              "the following conditions:")


def _gnu(licence: str, kind: str, version: str, must: tuple[str, ...]) -> list[Template]:
    words = (":", kind, ",", version) if version == "3" else (";", kind, ";", version)
    return [Template(licence, text.format(*words), must) for text in (_GPL, _GPL + _GPL_REST)]


# Titles, references and standard headers, in whole and by their first paragraph.
HEADERS = [
    Template("MIT", "MIT License", ("mit", "license")),
    Template("MIT", "The MIT License (MIT)", ("mit", "license")),
    Template("MIT", "Licensed under the MIT license. See LICENSE file in the project root for full license information.", ("mit", "license")),
    Template("MIT", _MIT_GRANT, ("permission", "software")),
    Template("Apache-2.0", "Apache License", ("apache", "license")),
    Template("Apache-2.0", "Apache License Version 2.0, January 2004", ("apache", "license")),
    Template("Apache-2.0", _APACHE, ("apache",)),
    Template("Apache-2.0", _APACHE + _APACHE_REST, ("apache",)),
    Template("BSD-2-Clause", "BSD 2-Clause License", ("bsd", "2-clause")),
    Template("BSD-3-Clause", "BSD 3-Clause License", ("bsd", "3-clause")),
    Template("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.", ("bsd-style",)),
    Template("GPL-2.0", "This work is licensed under the GNU General Public License, version 2.", ("gnu", "2")),
    Template("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991", ("gnu", "general", "2")),
    Template("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007", ("gnu", "general", "3")),
    *_gnu("GPL-2.0", "General", "2", ("gnu", "2")),
    *_gnu("GPL-3.0", "General", "3", ("gnu", "3")),
    *_gnu("LGPL-3.0", "Lesser General", "3", ("gnu", "lesser", "3")),
    *_gnu("AGPL-3.0", "Affero General", "3", ("gnu", "affero", "3")),
    Template("MPL-2.0", "Mozilla Public License Version 2.0", ("mozilla", "public", "license")),
    Template("MPL-2.0", TEMPLATES["MPL-2.0"] + " If a copy of the MPL was not distributed with this file, You can obtain one at "
             "https://mozilla.org/MPL/2.0/.", ("mozilla",)),
    *[Template(re.sub("-only|-or-later", "", name), f"SPDX-License-Identifier: {name}", (name.lower(),))
      for name in (*TEMPLATES, "BSD-2-Clause", "GPL-2.0", *(f"{g}-{how}" for g in ("GPL-2.0", "GPL-3.0", "LGPL-3.0", "AGPL-3.0") for how in ("only", "or-later")))],
]
# Terms that a text like a whole licence must hold; the texts are in ``licence_texts``.
FULL_TEXTS = {
    "Apache-2.0": ("apache",), "BSD-2-Clause": ("redistributions", "disclaimer"), "BSD-3-Clause": ("redistributions", "disclaimer"), "CC0-1.0": ("cc0",),
    "GPL-2.0": ("gnu",), "GPL-3.0": ("gnu",), "MIT": ("permission", "merchantability"), "MPL-2.0": ("mozilla",)}


def all_templates(notices: dict[str, str] = TEMPLATES) -> list[Template]:
    """The notices, headers and full texts."""
    folder = Path(__file__).parent / "licence_texts"
    full = [Template(name, (folder / f"{name}.txt").read_text(), must) for name, must in FULL_TEXTS.items()]
    must = lambda name, text: NOTICE_MUST.get(name, ()) if TEMPLATES.get(name) == text else ()
    return [*(Template(name, text, must(name, text)) for name, text in notices.items()), *HEADERS, *full]


# Names of files that hold the licence of their directory.
FILE_NAMES = r"(?i)^(licen[cs]e|copying|notice)([.-].*)?$"
# Lines that belong to a leading comment.
COMMENT = r"^\s*($|#|//|/\*|\*|--|;|%|<!--)"
# Least cosine of a notice, and least share of a document's words in notices that makes it a licence file.
LEAST, FILE_SHARE = 0.6, 0.5


def split_terms(text: str) -> list[str]:
    """Terms of a template: lower-cased runs of ASCII letters, digits and inner points or hyphens."""
    return [t.strip(".-") for t in re.findall(r"[a-z0-9.-]+", text.lower()) if t.strip(".-")]


# Fixed value: a run as ``split_terms`` takes it, without the points and hyphens at its ends.
TERM = "[a-z0-9]++(?:[.-]++[a-z0-9]++)*+"


def _terms(line: Column) -> Column:
    return F.regexp_extract_all(F.lower(line), F.lit(TERM), F.lit(0))


def _of(terms) -> Column:
    return F.array(*map(F.lit, terms)).cast("array<string>")


def term_weights(found: DataFrame, vocabulary: list[str]) -> tuple[dict[str, float], float, dict[str, int]]:
    """Inverse document frequencies of the templates' terms over all documents, that of an unseen term, and the documents of each term.

    ``found`` holds for every document the terms of ``vocabulary`` in it (column ``found``). The templates bound the number of terms;
    only their counts come to the driver.
    """
    counts = found.select(F.explode(F.array_append("found", F.lit(""))).alias("term")).groupBy("term").count().collect()
    documents = {r["term"]: r["count"] for r in counts}
    n = documents.get("", 0)
    weight = {t: math.log((1 + n) / (1 + documents.get(t, 0))) + 1 for t in vocabulary}
    return weight, math.log(1 + n) + 1, {t: documents.get(t, 0) for t in vocabulary}


def template_vectors(templates: list[Template], weight: dict[str, float]) -> list[dict[str, float]]:
    """The TF-IDF vector of every template, of length 1."""
    vectors = []
    for template in templates:
        terms = split_terms(template.text)
        vector = {t: terms.count(t) * weight[t] for t in set(terms)}
        norm = math.sqrt(sum(v * v for v in vector.values()))
        vectors.append({t: v / norm for t, v in sorted(vector.items())})
    return vectors


def needed_terms(templates: list[Template], vectors: list[dict[str, float]], documents: dict[str, int], least: float) -> list[tuple[tuple[str, ...], tuple[str, ...]]]:
    """What a text must hold to count as similar to some template: pairs of terms of which it holds all, and terms of which it holds one.

    The first are the ``must`` terms of a template. The cosine is at most the length of the part of the template's vector whose
    terms the text holds, so the second are terms, rare ones first, without which the rest of the vector is shorter than ``least``;
    there are none where the ``must`` terms alone are as long.
    """
    needed = set()
    for template, vector in zip(templates, vectors):
        rest, some = 1.0, []
        for t in sorted(vector.keys() - set(template.must), key=lambda t: (documents[t], -vector[t], t)):
            if rest < least * least - 1e-6:
                break
            some.append(t)
            rest -= vector[t] ** 2
        # the must terms, which are held anyway, can be long enough by themselves
        enough = rest >= least * least - 1e-6
        needed.add((template.must, () if enough else tuple(sorted(some))))
    return sorted(needed)


def _possible(needed: list[tuple[tuple[str, ...], tuple[str, ...]]]):
    """Whether a text with the given terms can be similar to some template."""
    relevant = _of(sorted({t for every, some in needed for t in (*every, *some)}))

    def holds(own: Column) -> Column:
        each = F.lit(False)
        for every, some in needed:
            one = F.arrays_overlap(own, _of(some)) if some else F.lit(True)
            for t in every:
                one = F.array_contains(own, t) & one
            each = each | one
        return each

    return lambda terms: let(F.array_intersect(terms, relevant), holds)


def _units(text: Column, possible) -> Column:
    """What is compared: the whole text, its leading comment, its paragraphs and their lines; those that cannot be similar are left out.

    Structs of ``kind`` (0 whole, 1 leading comment, 2 paragraph, 3 line), number of the paragraph and ``text``. What a line lacks its
    paragraph may hold, but not the other way round: lines are looked at in possible paragraphs only. The whole text is possible.
    """
    unit = lambda kind, k, x: F.struct(F.lit(kind).alias("kind"), k.cast("int").alias("par"), x.alias("text"))
    lines_of = lambda x: F.split(x, "\n")
    some = lambda units: F.filter(units, lambda u: possible(_terms(u["text"])))

    def leading(lines: Column) -> Column:
        end = F.array_position(F.transform(lines, lambda x: ~F.rlike(x, F.lit(COMMENT))), True)
        return F.array_join(F.when(end > 0, F.slice(lines, F.lit(1), (end - 1).cast("int"))).otherwise(lines), "\n")

    def of_paragraphs(pars: Column) -> Column:
        lines = F.transform(pars, lambda p: F.transform(lines_of(p["text"]), lambda line: unit(3, p["par"], line)))
        return F.concat(pars, some(F.flatten(lines)))

    first = F.concat(F.array(unit(0, F.lit(-1), text)), some(F.array(unit(1, F.lit(-1), let(lines_of(text), leading)))))
    pars = F.transform(F.split(text, r"\n[ \t\r]*\n"), lambda x, k: unit(2, k, x))
    return F.concat(first, let(some(pars), of_paragraphs))


def _counted(terms: Column) -> Column:
    """Distinct terms with their numbers, from the places where a new term begins among the sorted ones."""

    def of_sorted(s: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(s) - 1)
        begins = F.filter(places, lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))
        pair = lambda b: F.transform(b, lambda i, j: F.struct(
            F.get(s, i).alias("term"), (F.coalesce(F.get(b, j + 1), F.size(s)) - i).alias("n")))
        return let(begins, pair)

    return let(F.array_sort(terms), of_sorted)


def _similar(units: DataFrame, templates: list[Template], vectors: list[dict[str, float]], weight: dict[str, float], unseen: float) -> DataFrame:
    """The most similar template (``best``: similarity, turn, licence; ties go to the first name) of every unit (uid, at, ..., text).

    The units' distinct terms meet the templates' weights in a broadcast table with a row per term of a template.
    """
    needed = sorted({t for x in templates for t in x.must})
    bit = {t: 1 << i for i, t in enumerate(needed)}
    table = [(t, w, [v.get(t, 0.0) for v in vectors], bit.get(t, 0)) for t, w in weight.items()]
    table = stored(units.sparkSession.createDataFrame(table, "term string, w double, v array<double>, bit bigint"), "licence-terms")
    terms = units.select("uid", "at", F.explode(_counted(_terms(F.col("text")))).alias("x")).select("uid", "at", "x.term", "x.n")
    held = terms.join(F.broadcast(table), "term", "left").withColumn("tw", F.col("n") * F.coalesce("w", F.lit(unseen)))
    sums = held.groupBy("uid", "at").agg(
        F.sum(F.col("tw") * F.col("tw")).alias("square"), F.bit_or(F.coalesce("bit", F.lit(0))).alias("bits"),
        *[F.coalesce(F.sum(F.col("tw") * F.get("v", F.lit(k))), F.lit(0.0)).alias(f"dot{k}") for k in range(len(templates))])
    turn = {name: -i for i, name in enumerate(sorted({x.licence for x in templates}))}
    scores = []
    for k, x in enumerate(templates):
        must = F.lit(sum(bit[t] for t in x.must)).cast("bigint")
        score = F.struct(F.round(F.col(f"dot{k}") / F.sqrt("square"), 9).alias("similarity"), F.lit(turn[x.licence]).alias("turn"), F.lit(x.licence).alias("licence"))
        scores.append(F.when(F.col("bits").bitwiseAND(must) == must, score))
    return sums.select("uid", "at", F.array_max(F.array(*scores)).alias("best"))


def scan(files: DataFrame, templates: dict[str, str] = TEMPLATES, id_col: str = "doc_id", path_col: str = "path", text_col: str = "text",
         least: float = LEAST) -> DataFrame:
    """Licence of every file: doc_id, path, dir, licence, similarity, origin, from_dir.

    The whole text, its leading comment, every paragraph (lines up to an empty one) and every line are possible notices;
    the TF-IDF vector of each that holds the terms without which none can reach ``least`` is compared
    with those of the templates: ``templates``, ``HEADERS`` and full texts (terms of no template weigh as unseen ones). The most similar with
    a cosine of ``least`` or more is the file's own: origin "notice". A file with a licence file's name, or
    with half its words or more in notices, also gives its licence to its directory. A file without a notice has that
    of the nearest directory above it, its own first: origin "directory", found in ``from_dir``; else null and
    origin "none". Of several licence files in a directory the most similar counts, then the first licence by name.

    Null and empty texts have no notice but inherit; a null path has neither directory nor ancestors. Rows are
    judged one by one, repeated or not; other columns are ignored. Only directories are joined along the tree, a
    row each, so a directory with very many files costs no more there; the files join a stored table of one
    row a directory, in which adaptive execution splits those of a large one.
    """
    known = all_templates(templates)
    vocabulary = sorted({t for x in known for t in (*split_terms(x.text), *x.must)})
    text, path = F.coalesce(F.col(text_col), F.lit("")), F.col(path_col)
    # every text is cut into terms once; the number of a row, as stored, holds its units together
    rows = stored(
        files.select(
            F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("doc_id"), path.alias("path"),
            F.regexp_replace(path, "/?[^/]*$", "").alias("dir"), text.alias("text"), F.array_intersect(_terms(text), _of(vocabulary)).alias("found")),
        "licence-texts")
    weight, unseen, documents = term_weights(rows, vocabulary)
    vectors = template_vectors(known, weight)
    possible = _possible(needed_terms(known, vectors, documents, least))
    units = rows.where(possible(F.col("found"))).select("uid", "text", F.posexplode(_units(F.col("text"), possible)).alias("at", "u")).select(
        "uid", "at", "u.kind", "u.par", count_words(F.col("u.text")).alias("words"), "u.text")
    units = stored(units, "licence-units")
    sure = _similar(units, known, vectors, weight, unseen).where(F.col("best.similarity") >= least)
    # words in notices: of paragraphs or else their lines, of the leading comment or of the whole text, whichever are most
    sure = sure.join(units.select("uid", "at", "kind", "par", "words"), ["uid", "at"])
    words = lambda kind, f: F.coalesce(f(F.when(F.col("kind") == kind, F.col("words"))), F.lit(0))
    parts = sure.groupBy("uid", "par").agg(
        F.max("best").alias("best"), F.greatest(words(0, F.max), words(1, F.max)).alias("wide"), F.greatest(words(2, F.max), words(3, F.sum)).alias("words"))
    own = parts.groupBy("uid").agg(F.max("best").alias("best"), F.greatest(F.max("wide"), F.sum("words")).alias("in_notices"))
    own = own.join(units.where("kind = 0").select("uid", F.col("words").alias("n_words")), "uid")
    best = F.col("best")
    named = F.rlike(F.regexp_extract("path", "[^/]*$", 0), F.lit(FILE_NAMES))
    rows = stored(
        rows.drop("text", "found").join(own, "uid", "left").select(
            "doc_id", "path", "dir", best["licence"].alias("own"), best["similarity"].alias("similarity"),
            (best.isNotNull() & (F.coalesce(named, F.lit(False)) | (F.col("in_notices") >= FILE_SHARE * F.col("n_words")))).alias("is_file")),
        "licence-notices")

    # the most similar notice, then the first name: the smallest pair of negative similarity and licence
    givers = rows.where("is_file and dir is not null")
    given = givers.groupBy("dir").agg(F.min(F.struct((-F.col("similarity")).alias("far"), "own"))["own"].alias("licence"))
    # each directory meets itself and those above it, "" being the top
    parts = F.split("dir", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda k: F.struct(k.alias("depth"), F.concat_ws("/", F.slice(parts, 1, k)).alias("up")))
    tree = rows.where("dir is not null").select("dir").distinct().select("dir", F.explode(above).alias("a")).select("dir", "a.depth", "a.up")
    tree = tree.distinct().join(given.withColumnRenamed("dir", "up"), "up")
    nearest = tree.groupBy("dir").agg(F.max(F.struct("depth", "licence", "up")).alias("near")).select("dir", "near.licence", "near.up")
    # stored, so that adaptive execution can split the files of a large directory
    joined = rows.join(stored(nearest, "licence-directories").hint("merge"), "dir", "left")
    origin = F.when(F.col("own").isNotNull(), "notice").when(F.col("licence").isNotNull(), "directory").otherwise("none")
    return joined.select(
        "doc_id", "path", "dir", F.coalesce("own", "licence").alias("licence"), "similarity", origin.alias("origin"),
        F.when(F.col("own").isNull(), F.col("up")).alias("from_dir"))
