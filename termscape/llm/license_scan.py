"""Licence scan: TF-IDF cosine of statements to templates, then inheritance from the nearest directory.

A file's lines, and its text as a whole, are units. A unit's vector has a token's count times its inverse
document frequency over all files; tokens outside the templates count with the frequency of none.
The best template with a cosine of at least ``MIN_COSINE`` is a line's licence.

Notices (header forms, SPDX tags, titles, passages and whole texts of licences) are compared with more units: the
lines, the sentences of a line, the text as a whole, and windows of the text's tokens. A window is as long as a
notice of up to ``MAX_WINDOW`` tokens and lies so that one of the notice's anchors stands where the notice has it; so
statements that wrap over lines, stand behind comment marks or inside a longer line are compared by themselves.
A unit must also have those tokens of the licence's name, and words like license, that the notice has: versions
differ in one digit, and a name like MIT is a word of other languages.
A file takes the best of its lines and notices: licence titles and texts come first, the conditions that licences share
and a mere reservation of rights last, whatever their cosine. A file whose name says so, which as a whole is as
close to a template, or which has a licence's title passage, is a licence file: it licenses its directory.
A file without a licence of its own inherits from the nearest directory above it that has a licence file.

Everything is DataFrame functions. Most lines share nothing with a template and are gone early: per template, the
fewest tokens are found without which the cosine cannot be reached (the squared weights of
the others add up to less than the cosine's square), and only files and lines that have one of those are
split. Of these, units with too many tokens outside the templates for the cosine go in the same pass. What
is left is a narrow table, and so are the files' names; the texts are read three times and never shuffled.
Equal units are scored once, so a statement in a third of all files is one row. Templates are a
parameter of the job; what the driver collects is one count for each of their tokens.

Defined cases: null and empty texts have no licence of their own; a null path inherits nothing and licenses
nothing; repeated rows are separate files; of several licence files in a directory the closest counts, then
the name that sorts first, then the first licence name; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import json
import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termscape.llm.common import ascii_lower, salted_join
from termscape.session import Scratch, frozen

TOKEN = "[a-z0-9]+"
MIN_COSINE = 0.8
LICENSE_NAMES = r"(?i)^(license|licence|copying|unlicense)([.-].*)?$"
#: Vocabulary of all templates together; more is refused, as it is broadcast.
MAX_VOCABULARY = 10_000

#: Customary statements of common licences.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("proprietary", "All rights reserved."),
)


_REDISTRIBUTION = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
_CLAUSE_1 = " Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
_CLAUSE_2 = " Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_NEITHER = "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_END = (
    " THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO,"
    " THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS"
    " BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE"
    " GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT"
    " LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal"
    " in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell"
    " copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice"
    " and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF"
    " ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO"
    " EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,"
    " ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
_UNLICENSE = "This is free and unencumbered software released into the public domain."
_GNU = "{name} Version {version}, {day} Copyright (C) {years} Free Software Foundation, Inc."
_TERMS = "under the terms of the {name} as published by the Free Software Foundation; either version {version} of the License, or (at your option) any later version."
_GNU_LICENSES = (
    ("GPL-2.0", "GNU General Public License", "2", "June 1991", "1989, 1991"),
    ("GPL-3.0", "GNU General Public License", "3", "29 June 2007", "2007"),
    ("LGPL-2.1", "GNU Lesser General Public License", "2.1", "February 1999", "1991, 1999"),
    ("LGPL-3.0", "GNU Lesser General Public License", "3", "29 June 2007", "2007"),
    ("AGPL-3.0", "GNU Affero General Public License", "3", "19 November 2007", "2007"),
)
_CREATIVE = (
    ("CC-BY-4.0", "Attribution"), ("CC-BY-NC-4.0", "Attribution-NonCommercial"), ("CC-BY-SA-4.0", "Attribution-ShareAlike"),
    ("CC-BY-ND-4.0", "Attribution-NoDerivatives"), ("CC-BY-NC-SA-4.0", "Attribution-NonCommercial-ShareAlike"),
    ("CC-BY-NC-ND-4.0", "Attribution-NonCommercial-NoDerivatives"),
)
_SPDX = (
    "AGPL-3.0", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC0-1.0", "GPL-2.0", "GPL-3.0", "ISC", "LGPL-2.1", "LGPL-3.0", "MIT", "MPL-2.0", "Unlicense",
    *(name for name, _ in _CREATIVE),
)
#: What a notice is: the licence's title or text, a statement, conditions that several licences have, a reservation of rights.
TEXT, STATEMENT, SHARED, RESERVATION = range(4)
#: Fixed values: (licence, kind, notice). Longer ones than ``MAX_WINDOW`` are compared with whole files.
NOTICES = (
    *((name, STATEMENT, f"SPDX-License-Identifier: {name}") for name in _SPDX),
    *((name, STATEMENT, text) for name, text in TEMPLATES if name != "proprietary"),
    ("proprietary", RESERVATION, "All rights reserved."),
    ("Apache-2.0", TEXT, "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION"),
    ("Apache-2.0", STATEMENT, "Apache License, Version 2.0"),
    ("Apache-2.0", STATEMENT, "Apache License 2.0"),
    ("Apache-2.0", STATEMENT, "Apache 2.0 License"),
    ("MIT", STATEMENT, "MIT License"),
    ("MIT", STATEMENT, "The MIT License (MIT)"),
    ("MIT", STATEMENT, "Licensed under the MIT License."),
    ("MIT", STATEMENT, "Distributed under the MIT License."),
    ("MIT", TEXT, _MIT),
    ("BSD-2-Clause", STATEMENT, "BSD 2-Clause License"),
    ("BSD-2-Clause", SHARED, _REDISTRIBUTION),
    ("BSD-2-Clause", TEXT, _REDISTRIBUTION + _CLAUSE_1 + _CLAUSE_2 + _BSD_END),
    ("BSD-3-Clause", STATEMENT, "BSD 3-Clause License"),
    ("BSD-3-Clause", STATEMENT, _NEITHER),
    ("BSD-3-Clause", TEXT, _REDISTRIBUTION + _CLAUSE_1 + _CLAUSE_2 + " " + _NEITHER + _BSD_END),
    ("ISC", STATEMENT, "ISC License"),
    ("ISC", STATEMENT, _ISC),
    ("Unlicense", STATEMENT, _UNLICENSE),
    ("MPL-2.0", STATEMENT, "Mozilla Public License, Version 2.0"),
    ("MPL-2.0", TEXT, "Mozilla Public License Version 2.0 1. Definitions 1.1. \"Contributor\" means each individual or legal entity that creates, contributes to the creation of, or owns Covered Software."),
    ("CC0-1.0", STATEMENT, "CC0 1.0 Universal"),
    *((name, STATEMENT, f"{long} version {version}") for name, long, version, _, _ in _GNU_LICENSES),
    *((name, STATEMENT, f"{long} v{version}") for name, long, version, _, _ in _GNU_LICENSES),
    *((name, STATEMENT, _TERMS.format(name=long, version=version)) for name, long, version, _, _ in _GNU_LICENSES),
    *((name, TEXT, _GNU.format(name=long, version=version, day=day, years=years)) for name, long, version, day, years in _GNU_LICENSES),
    *((name, STATEMENT, f"Creative Commons {long} 4.0 International") for name, long in _CREATIVE),
    *((name, STATEMENT, name.replace("-", " ")) for name, _ in _CREATIVE),
)
#: Words that a unit must have where the notice has them, like the tokens of the licence's name.
NEEDED = ("license", "spdx", "creative")
#: Tokens of a notice that windows are cut for; notices of fewer than three are compared with lines and sentences.
MAX_WINDOW, MIN_WINDOW = 64, 3


def tokens_of(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(text), F.lit(TOKEN), 0)


def _lower(text: str) -> str:
    return text.translate({c: c + 32 for c in range(65, 91)})


def template_weights(counts: dict[str, int], n_files: int, templates: tuple) -> tuple[list[tuple], dict[str, float], float, set[str]]:
    """Rows (token, number, license, weight / norm), idf of each token, idf of others, anchor tokens."""
    other = math.log(1 + n_files) + 1
    idf: dict[str, float] = {}
    rows, anchors = [], set()
    for number, (name, text) in enumerate(templates):
        found = re.findall(TOKEN, _lower(text))
        for token in found:
            idf[token] = math.log((1 + n_files) / (1 + counts.get(token, 0))) + 1
        weights = {t: found.count(t) * idf[t] for t in found}
        norm = math.sqrt(sum(w * w for w in weights.values()))
        rows += [(t, number, name, w / norm) for t, w in weights.items()]
        rest = 1.0
        for token in sorted(weights, key=lambda t: (-weights[t], t)):
            if rest < (MIN_COSINE - 1e-6) ** 2:
                break
            anchors.add(token)
            rest -= (weights[token] / norm) ** 2
    return rows, idf, other, anchors


def notice_tables(notices: tuple, rows: list[tuple], idf: dict[str, float]) -> tuple[list[tuple], dict[str, list[dict]], set[str]]:
    """Rows (token, number, license, share, kind, 1 for a token that a unit must have); by anchor, the windows it asks for; anchors.

    A window is (tokens, place of the anchor in it). ``rows`` and ``idf`` are those of ``template_weights``. The
    rarest of the tokens that a unit must have is anchor enough.
    """
    anchors: set[str] = set()
    index, windows = [], {}
    shares: dict[int, dict[str, float]] = {}
    for token, number, name, share in rows:
        shares.setdefault(number, {})[token] = share
        index.append((token, number, name, share, notices[number][1], int(token in [*re.findall(TOKEN, _lower(name)), *NEEDED])))
    for number, (_, _, text) in enumerate(notices):
        found, rest, own = re.findall(TOKEN, _lower(text)), 1.0, []
        needed = [row[0] for row in index if row[1] == number and row[5]]
        for token, share in sorted(shares[number].items(), key=lambda x: (-idf[x[0]], x[0])):
            if rest < (MIN_COSINE - 1e-6) ** 2:
                break
            own.append(token)
            rest -= share * share
        if needed:
            own = [max(needed, key=lambda t: (idf[t], t))]
        anchors.update(own)
        if MIN_WINDOW <= len(found) <= MAX_WINDOW:
            for token in own:
                windows.setdefault(token, set()).update((len(found), at) for at, t in enumerate(found) if t == token)
    return index, {token: [{"size": size, "at": at} for size, at in sorted(places)] for token, places in windows.items()}, anchors


def _windows(text: Column, windows: dict[str, list[dict]]) -> Column:
    """The windows of a text's tokens around the anchors, each as tokens with spaces between them."""
    asked = F.from_json(F.lit(json.dumps(windows)), "map<string,array<struct<size:int,at:int>>>")

    def cut(tokens: Column) -> Column:
        placed = F.filter(F.transform(tokens, lambda t, i: F.struct(F.element_at(asked, t).alias("asked"), i.alias("i"))), lambda x: x["asked"].isNotNull())

        def around(x: Column) -> Column:
            return F.transform(x["asked"], lambda w: F.array_join(F.slice(tokens, F.greatest(x["i"] - w["at"], F.lit(0)) + 1, w["size"]), " "))

        return F.array_distinct(F.flatten(F.transform(placed, around)))

    return F.get(F.transform(F.array(tokens_of(text)), cut), F.lit(0))


def _may_reach(unit: Column, idf: dict[str, float], other: float) -> Column:
    """Whether the unit's tokens inside the templates weigh enough against those outside.

    The cosine is at most the share of the length that lies inside; outside, a token weighs ``other`` or more.
    """
    values = F.from_json(F.lit(json.dumps(idf)), "map<string,double>")

    def reaches(tokens: Column) -> Column:
        start = F.struct(F.lit(0).alias("n"), F.lit(0.0).alias("square"))

        def add(state: Column, token: Column) -> Column:
            times = F.size(F.filter(tokens, lambda t: t == token))
            weight = times * F.element_at(values, token)
            return F.struct((state["n"] + times).alias("n"), (state["square"] + weight * weight).alias("square"))

        inside = F.aggregate(F.array_intersect(tokens, F.map_keys(values)), start, add)
        least = MIN_COSINE * MIN_COSINE - 1e-9
        return F.get(
            F.transform(F.array(inside), lambda s: s["square"] >= least * (s["square"] + (F.size(tokens) - s["n"]) * other * other)), F.lit(0)
        )

    return F.get(F.transform(F.array(tokens_of(unit)), reaches), F.lit(0))


def _scores(units: DataFrame, index: DataFrame, idf: DataFrame, other: float) -> DataFrame:
    """Distinct ``unit`` texts to their best licence and score, where it is at least the smallest cosine."""
    distinct = units.select("unit").distinct()
    held = distinct.withColumn("token", F.explode(tokens_of(F.col("unit")))).groupBy("unit", "token").agg(F.count(F.lit(1)).alias("times"))
    weighed = held.join(F.broadcast(idf), "token", "left")
    weighed = weighed.withColumn("weight", F.col("times") * F.coalesce("idf", F.lit(other)))
    norms = weighed.groupBy("unit").agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))
    dots = weighed.join(F.broadcast(index), "token").groupBy("unit", "number", "license").agg(F.sum(F.col("weight") * F.col("share")).alias("dot"))
    scored = dots.join(norms, "unit").withColumn("score", F.round(F.col("dot") / F.col("norm"), 6)).where(F.col("score") >= MIN_COSINE)
    best = scored.groupBy("unit").agg(F.max("score").alias("score"), F.min_by("license", F.struct(-F.col("score"), "license")).alias("license"))
    return best.select("unit", "license", "score")


def _notice_scores(units: DataFrame, index: DataFrame, idf: DataFrame, other: float) -> DataFrame:
    """Distinct ``unit`` texts to the best licence of each kind that they reach."""
    held = units.select("unit").distinct().withColumn("token", F.explode(tokens_of(F.col("unit"))))
    held = held.groupBy("unit", "token").agg(F.count(F.lit(1)).alias("times")).join(F.broadcast(idf), "token", "left")
    weighed = held.withColumn("weight", F.col("times") * F.coalesce("idf", F.lit(other)))
    norms = weighed.groupBy("unit").agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))
    needs = index.groupBy("number").agg(F.sum("named").alias("needs"))
    dots = weighed.join(F.broadcast(index), "token").groupBy("unit", "number", "license", "kind").agg(
        F.sum(F.col("weight") * F.col("share")).alias("dot"), F.sum("named").alias("named")
    )
    scored = dots.join(F.broadcast(needs), "number").where("named = needs").join(norms, "unit")
    scored = scored.withColumn("score", F.round(F.col("dot") / F.col("norm"), 6)).where(F.col("score") >= MIN_COSINE)
    best = scored.groupBy("unit", "kind").agg(F.max("score").alias("score"), F.min_by("license", F.struct(-F.col("score"), "license")).alias("license"))
    return best.groupBy("unit").agg(F.collect_list(F.struct("kind", "score", "license")).alias("found"))


def scan(
    files: DataFrame,
    id_column: str = "doc_id",
    path_column: str = "path",
    text_column: str = "text",
    templates: tuple = TEMPLATES,
    notices: tuple = NOTICES,
) -> DataFrame:
    """Per file: own licence and score, inherited licence and the directory it comes from, licence (own or inherited)."""
    with Scratch(files.sparkSession) as scratch:
        found = _scan(files, id_column, path_column, text_column, templates, notices, scratch)
        return frozen(found, "licences")


def _scan(files: DataFrame, id_column: str, path_column: str, text_column: str, templates: tuple, notices: tuple, scratch: Scratch) -> DataFrame:
    spark = files.sparkSession
    named_notices = tuple((name, text) for name, _, text in notices)
    vocabulary = sorted({t for _, text in templates + named_notices for t in re.findall(TOKEN, _lower(text))})
    if len(vocabulary) > MAX_VOCABULARY:
        raise ValueError(f"{len(vocabulary)} tokens in the templates; at most {MAX_VOCABULARY} are broadcast")
    plain = files.select(
        F.col(id_column).alias("doc_id"), F.col(path_column).alias("path"), F.coalesce(text_column, F.lit("")).alias("text")
    )
    plain = plain.withColumn("file", F.md5(F.concat_ws("\x1f", *[F.coalesce(F.concat(F.lit("v"), F.col(c).cast("string")), F.lit("n")) for c in ("doc_id", "path", "text")])))
    n_files = plain.count()
    wanted = F.array(*[F.lit(t) for t in vocabulary])
    held = plain.select(F.explode(F.array_intersect(wanted, tokens_of(F.col("text")))).alias("token"))
    counts = {r["token"]: r["count"] for r in held.groupBy("token").count().collect()}
    rows, idf_values, other, anchors = template_weights(counts, n_files, templates)
    index = spark.createDataFrame(rows, "token string, number int, license string, share double")
    idf = spark.createDataFrame(list(idf_values.items()), "token string, idf double")

    notice_rows, notice_idf_values, _, _ = template_weights(counts, n_files, named_notices)
    notice_rows, windows, notice_anchors = notice_tables(notices, notice_rows, notice_idf_values)
    notice_index = spark.createDataFrame(notice_rows, "token string, number int, license string, share double, kind int, named int")
    notice_idf = spark.createDataFrame(list(notice_idf_values.items()), "token string, idf double")

    def holds_any(tokens: set[str]) -> Column:
        if not tokens:
            return F.lit(False)
        # by first letter, so that most words are left at their first one
        tails = {first: "|".join(sorted(t[1:] for t in tokens if t[0] == first)) for first in sorted({t[0] for t in tokens})}
        any_of = "|".join(f"{first}(?:{rest})" for first, rest in tails.items())
        return F.col("text").rlike(rf"(?i)(?<![a-z0-9])(?:{any_of})(?![a-z0-9])")

    def unit_of(text: Column, is_whole: bool, of_notices: bool) -> Column:
        return F.struct(text.alias("text"), F.lit(is_whole).alias("is_whole"), F.lit(of_notices).alias("of_notices"))

    parts = F.concat(F.split("text", r"\n|(?<=[.!?;])\s+"), _windows(F.col("text"), windows), F.array("text"))
    unit = F.explode(F.concat(
        F.transform(F.split("text", "\n"), lambda line: unit_of(line, False, False)), F.array(unit_of(F.col("text"), True, False)),
        F.transform(F.array_distinct(parts), lambda part: unit_of(part, False, True)),
    ))
    units = plain.where(holds_any(anchors | notice_anchors)).select("file", unit.alias("u")).select("file", "u.*")
    of_templates = holds_any(anchors) & _may_reach(F.col("text"), idf_values, other)
    of_notices = holds_any(notice_anchors) & _may_reach(F.col("text"), notice_idf_values, other)
    units = units.where(F.when(F.col("of_notices"), of_notices).otherwise(of_templates)).withColumnRenamed("text", "unit").distinct()
    units = scratch.table(units, "licence-units")
    directory = F.when(F.instr("path", "/") > 0, F.regexp_extract("path", r"(?s)^(.*)/[^/]*$", 1)).otherwise(F.when(F.col("path").isNotNull(), F.lit("")))
    names = scratch.table(plain.select("doc_id", "path", "file", directory.alias("dir")), "licence-files")
    lines, whole, parts = (units.where(kind).select("file", "unit") for kind in ("not is_whole and not of_notices", "is_whole", "of_notices"))
    scores = scratch.table(_scores(units.where("not of_notices"), index, idf, other), "licence-scores")
    notice_scores = scratch.table(_notice_scores(parts, notice_index, notice_idf, other), "licence-notice-scores")
    unit_key = F.xxhash64("file")
    scored_lines = salted_join(lines, scores, "unit", unit_key).where("score is not null")
    scored_whole = salted_join(whole, scores, "unit", unit_key).select("file", F.col("score").alias("whole_score"), F.col("license").alias("whole_license"))
    kind = F.when(F.col("license").isin([name for name, kind, _ in notices if kind == RESERVATION]), RESERVATION).otherwise(STATEMENT)
    found = salted_join(parts, notice_scores, "unit", unit_key).select("file", F.explode("found").alias("n")).select("file", "n.license", "n.score", "n.kind")
    found = scored_lines.select("file", "license", "score", kind.alias("kind")).union(found)
    best_first = F.struct("kind", -F.col("score"), "license")
    own = found.groupBy("file").agg(
        F.min_by("license", best_first).alias("own_license"), F.min_by("score", best_first).alias("own_score"), F.min("kind").alias("kind")
    )
    own = own.join(scored_whole.where("whole_score is not null"), "file", "full")

    placed = scratch.table(names.join(own, "file", "left"), "licence-owners")
    named = F.regexp_extract(F.coalesce("path", F.lit("")), r"(?s)([^/]*)$", 1).rlike(LICENSE_NAMES)
    grants = F.when(F.col("kind") == TEXT, F.col("own_license"))
    grants = F.coalesce(grants, "whole_license", F.when(named, F.col("own_license")))
    granted = placed.where(F.col("dir").isNotNull()).withColumn("grants", grants).where("grants is not null")
    closest = F.struct(-F.coalesce("whole_score", "own_score"), "path", "grants")
    granted = granted.groupBy("dir").agg(F.min_by("grants", closest).alias("inherited_license"))

    # each directory's chain of directories above it, itself first
    parts = F.split("dir", "/")
    depth = F.when(F.col("dir") == "", 0).otherwise(F.size(parts))
    dirs = placed.select("dir").where("dir is not null").distinct()
    above = dirs.withColumn("depth", F.explode(F.sequence(F.lit(0), depth)))
    above = above.withColumn("above", F.array_join(F.slice(parts, F.lit(1), F.col("depth")), "/"))
    nearest = above.join(granted.withColumnRenamed("dir", "above"), "above").groupBy("dir").agg(
        F.max_by("inherited_license", "depth").alias("inherited_license"), F.max_by("above", "depth").alias("inherited_from")
    )
    joined = salted_join(placed, nearest, "dir", F.col("file"))
    own_license = F.coalesce("own_license", "whole_license")
    needs = own_license.isNull()
    return joined.select(
        F.col("doc_id").alias(id_column),
        F.col("path").alias(path_column),
        own_license.alias("own_license"),
        F.coalesce("own_score", "whole_score").alias("own_score"),
        F.when(needs, F.col("inherited_license")).alias("inherited_license"),
        F.when(needs, F.col("inherited_from")).alias("inherited_from"),
        F.coalesce(own_license, "inherited_license").alias("license"),
    )
