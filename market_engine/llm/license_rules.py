"""Licences by sentence rules: known sentences become identifiers, sequences of identifiers licences.

A text is cut at ends of sentences and of paragraphs, and reduced to lower-case letters and digits with single
spaces. Ends of lines may be inside a sentence, as licences are wrapped, or end it, as titles do: so a known
sentence is one that begins and ends at a cut or at an end of line and may have ends of lines between its words. Marks
of comments and numbers of clauses before a line are left out. Known sentences are replaced by their
identifiers, the longest from a place first, the rest dropped. Ordered rules then look for sequences of identifiers,
the longer ones first; what a rule has matched is no longer there for later rules. DataFrame functions only; no
row leaves its partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of

#: Replacements that bring a text in lower case to words and marks: `[ ... ]` around what cuts enclose, `{ ... }` around
#: what ends of lines enclose. Brackets of the text itself are taken out before.
MARKS = (
    (r"[\[\]{}]", " "),
    # Comment marks, then numbers and letters of clauses, at the start of a line.
    (r"(?m)^[\x20\x09]*(?:[#;%*]+|//+|/[*]+|--+|<!--)+", " "),
    (r"(?m)^[\x20\x09]*[(]?(?:[0-9]{1,2}|[a-z])[.)][\x20\x09]+", " "),
    # Points that end no sentence.
    (r"\b(v|inc|ltd|co|corp|e[.]g|i[.]e|vs)[.]([\x20\x09-\x0D])", r"\1 \2"),
    (r"[.!?]+[\"')]*[\x20\x09-\x0D]+", " ] [ "),
    (r"\r?\n[\x20\x09\x0B-\x0D]*\n[\x20\x09-\x0D]*", " ] [ "),
    (r"\n", " } { "),
    (r"[^a-z0-9\[\]{}]+", " "),
)

# The wording of licence texts, normalised.
SENTENCES = {
    "licensed under the apache license version 2 0": "apache2-short",
    "licensed under the apache license version 2 0 the license": "apache2-grant",
    "you may not use this file except in compliance with the license": "comply",
    "you may obtain a copy of the license at http www apache org licenses license 2 0": "apache2-copy",
    "you may obtain a copy of the license at": "copy-at",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an"
    " as is basis without warranties or conditions of any kind either express or implied": "no-warranty-law",
    "see the license for the specific language governing permissions and limitations under the license": "see-license",
    "released under the mit license": "mit-short",
    "licensed under the mit license": "mit-short",
    "this project is licensed under the mit license": "mit-short",
    "the mit license": "mit-title",
    "mit license": "mit-title",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation"
    " files the software to deal in the software without restriction including without limitation the rights to use copy modify"
    " merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is"
    " furnished to do so subject to the following conditions": "mit-grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the"
    " software": "mit-notice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties"
    " of merchantability fitness for a particular purpose and noninfringement": "mit-warranty",
    "this work is licensed under the gnu general public license version 3": "gpl3-short",
    "licensed under the gnu general public license version 3": "gpl3-short",
    "this work is licensed under the gnu general public license version 2": "gpl2-short",
    "licensed under the gnu general public license version 2": "gpl2-short",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as"
    " published by the free software foundation either version 3 of the license or at your option any later version": "gpl3-grant",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as"
    " published by the free software foundation either version 2 of the license or at your option any later version": "gpl2-grant",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of"
    " merchantability or fitness for a particular purpose": "gnu-warranty",
    "see the gnu general public license for more details": "gnu-details",
    "licensed under cc by 4 0": "cc-by-4",
    "licensed under cc by sa 4 0": "cc-by-sa-4",
    "licensed under cc by nc 4 0": "cc-by-nc-4",
    "licensed under cc by nd 4 0": "cc-by-nd-4",
    "licensed under cc by nc sa 4 0": "cc-by-nc-sa-4",
    "licensed under cc by nc nd 4 0": "cc-by-nc-nd-4",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by-4",
    "this work is licensed under a creative commons attribution sharealike 4 0 international license": "cc-by-sa-4",
    "this work is licensed under a creative commons attribution noncommercial 4 0 international license": "cc-by-nc-4",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following"
    " conditions are met": "bsd-grant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following"
    " disclaimer": "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer"
    " in the documentation and or other materials provided with the distribution": "bsd-binary",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl2-grant",
    "this source code form is subject to the terms of the mozilla public license version 2 0": "mpl2-grant",
    "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0": "mpl2-copy",
    "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0": "mpl2-copy",
    "all rights reserved": "reserved",
    "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the"
    " license": "apache2-header",
    "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of"
    " contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the"
    " software": "mit-liability",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived"
    " from this software without specific prior written permission": "bsd-names",
    "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but"
    " not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed": "bsd-warranty",
    "in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or"
    " consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or"
    " business interruption however caused and on any theory of liability whether in contract strict liability or tort including"
    " negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such"
    " damage": "bsd-liability",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided"
    " that the above copyright notice and this permission notice appear in all copies": "isc-grant",
    "to the extent possible under law the author s have dedicated all copyright and related and neighboring rights to this software"
    " to the public domain worldwide": "cc0-grant",
    "this is free and unencumbered software released into the public domain": "unlicense-grant",
}

#: Licences of the GNU family: identifier, name, and the versions their notices name. Fixed values.
GNU = (("gpl", "general", ("2", "3")), ("lgpl", "lesser general", ("2 1", "3")), ("agpl", "affero general", ("3",)))

# Licences that SPDX lines name.
SPDX = (
    "0BSD", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0",
    "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0", "CC0-1.0", "EPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later",
    "GPL-3.0-only", "GPL-3.0-or-later", "ISC", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only",
    "LGPL-3.0-or-later", "MIT", "MPL-2.0", "Unlicense", "Zlib",
)


def _family() -> dict[str, str]:
    """The notices of the GNU licences, for programs and libraries, and SPDX lines."""
    found = {}
    for short, name, versions in GNU:
        for kind in ("program", "library", "file"):
            for version in versions:
                grant = (
                    f"this {kind} is free software you can redistribute it and or modify it under the terms of the gnu {name} public"
                    f" license as published by the free software foundation either version {version} of the license or at your option any"
                    " later version"
                )
                found[grant] = f"{short}{version.replace(' ', '.')}-grant"
            found[
                f"this {kind} is distributed in the hope that it will be useful but without any warranty without even the implied"
                " warranty of merchantability or fitness for a particular purpose"
            ] = "gnu-warranty"
            found[f"you should have received a copy of the gnu {name} public license along with this {kind}"] = "gnu-copy"
        found[f"see the gnu {name} public license for more details"] = "gnu-details"
    for name in SPDX:
        found["spdx license identifier " + " ".join(name.lower().replace("-", " ").replace(".", " ").split())] = f"spdx:{name}"
    return found


SENTENCES |= {s: name for s, name in _family().items() if s not in SENTENCES}

#: (licence, identifiers in sequence), tried in this order. Fixed values.
RULES = (
    ("Apache-2.0", ("apache2-header", "apache2-copy", "no-warranty-law", "see-license")),
    ("Apache-2.0", ("apache2-header", "copy-at", "no-warranty-law", "see-license")),
    ("Apache-2.0", ("apache2-grant", "comply", "apache2-copy", "no-warranty-law", "see-license")),
    ("Apache-2.0", ("apache2-grant", "comply", "copy-at", "no-warranty-law", "see-license")),
    ("MIT", ("mit-title", "mit-grant", "mit-notice", "mit-warranty", "mit-liability")),
    ("MIT", ("mit-grant", "mit-notice", "mit-warranty", "mit-liability")),
    ("MIT", ("mit-title", "mit-grant", "mit-notice", "mit-warranty")),
    ("MIT", ("mit-grant", "mit-notice", "mit-warranty")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names", "bsd-warranty", "bsd-liability")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-warranty", "bsd-liability")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    *[
        (f"{short.upper()}-{version.replace(' ', '.')}{'.0' if ' ' not in version else ''}-or-later", (f"{short}{version.replace(' ', '.')}-grant", *rest))
        for short, _, versions in GNU
        for version in versions
        for rest in (("gnu-warranty", "gnu-details", "gnu-copy"), ("gnu-warranty", "gnu-details"), ())
    ],
    ("MPL-2.0", ("mpl2-grant", "mpl2-copy")),
    ("ISC", ("isc-grant",)),
    ("CC0-1.0", ("cc0-grant",)),
    ("Unlicense", ("unlicense-grant",)),
    *[(name, (f"spdx:{name}",)) for name in SPDX],
    ("Apache-2.0", ("apache2-short",)),
    ("Apache-2.0", ("apache2-header",)),
    ("Apache-2.0", ("apache2-grant",)),
    ("MIT", ("mit-short",)),
    ("MIT", ("mit-grant",)),
    ("MIT", ("mit-title",)),
    ("GPL-3.0-only", ("gpl3-short",)),
    ("GPL-2.0-only", ("gpl2-short",)),
    ("CC-BY-4.0", ("cc-by-4",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4",)),
    ("CC-BY-ND-4.0", ("cc-by-nd-4",)),
    ("CC-BY-NC-SA-4.0", ("cc-by-nc-sa-4",)),
    ("CC-BY-NC-ND-4.0", ("cc-by-nc-nd-4",)),
    ("MPL-2.0", ("mpl2-grant",)),
    ("All-rights-reserved", ("reserved",)),
)


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _pattern() -> str:
    """A known sentence between two marks, the longest first, with ends of lines between its words or not."""
    ordered = sorted(SENTENCES, key=lambda sentence: (-len(sentence), sentence))
    return r"[\[{] (?:" + "|".join(r" (?:} \{ )?".join(sentence.split()) for sentence in ordered) + r") [\]}]"


def sentence_ids(text: Column) -> Column:
    """The identifiers of the known sentences of a text, in order."""
    pairs = [F.lit(x) for sentence, name in SENTENCES.items() for x in (sentence, name)]
    known = F.create_map(*pairs)
    marked = F.lower(text)
    for pattern, replacement in MARKS:
        marked = F.regexp_replace(marked, pattern, replacement.replace("\\", "$"))
    marked = F.regexp_replace(F.concat(F.lit("[ "), marked, F.lit(" ]")), " +", " ")
    found = F.regexp_extract_all(marked, F.lit(_pattern()), F.lit(0))
    words = F.transform(found, lambda s: F.regexp_replace(F.regexp_replace(s, r" } \{ ", " "), r"[\[{] | [\]}]", ""))
    return F.transform(words, lambda s: F.element_at(known, s))


def match_rules(ids: Column) -> Column:
    """A struct of the licences found, in the order of the rules, and the identifiers that no rule took."""
    rules = F.array(
        *[F.struct(F.lit(name).alias("name"), F.lit("|" + "||".join(found) + "|").alias("ids")) for name, found in RULES]
    )
    # Identifiers stand between two bars of their own, so that neighbours can be taken out one by one.
    start = F.struct(
        F.concat(F.lit("|"), F.array_join(ids, "||"), F.lit("|")).alias("left"),
        F.array().cast("array<string>").alias("licenses"),
    )

    def step(state, rule):
        return F.when(
            F.contains(state["left"], rule["ids"]),
            F.struct(
                F.replace(state["left"], rule["ids"], F.lit("")).alias("left"),
                F.array_append(state["licenses"], rule["name"]).alias("licenses"),
            ),
        ).otherwise(state)

    return F.aggregate(rules, start, step)


def scan(docs: DataFrame) -> DataFrame:
    """The documents with sentence_ids, licenses and unmatched (arrays of strings).

    A NULL or empty text has no sentences. A licence that two rules find is listed once. Every row is judged on its own,
    so repeated rows and other columns do not matter; columns of these names are replaced.
    """
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("sentence_ids", "licenses", "unmatched")]
    named = docs.select(*kept, F.explode(F.array(sentence_ids(text_of()))).alias("sentence_ids"))
    none = F.array().cast("array<string>")
    found = F.when(F.size("sentence_ids") > 0, match_rules(F.col("sentence_ids")))
    matched = named.withColumn("_llm_found", found)
    left = F.filter(F.split(F.col("_llm_found.left"), r"\|"), lambda x: x != "")
    return matched.withColumn("licenses", F.coalesce(F.array_distinct("_llm_found.licenses"), none)).withColumn(
        "unmatched", F.coalesce(left, none)
    ).drop("_llm_found")


def result(docs: DataFrame) -> DataFrame:
    found = scan(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    return found.select(
        "doc_id",
        F.size("sentence_ids").cast("long").alias("n_sentences"),
        F.array_join("sentence_ids", ",").alias("sentence_ids"),
        F.array_join("licenses", ",").alias("licenses"),
        F.array_join("unmatched", ",").alias("unmatched"),
    )


def oracle() -> str:
    """The same in DuckDB: a step per rule."""
    pairs = ", ".join(f"{_quoted(s)}: {_quoted(n)}" for s, n in SENTENCES.items())
    steps, last = [], "s0"
    for i, (name, found) in enumerate(RULES, 1):
        ids = _quoted("|" + "||".join(found) + "|")
        steps.append(
            f"s{i} AS (SELECT doc_id, ids, CASE WHEN contains(rest, {ids}) THEN replace(rest, {ids}, '') ELSE rest END AS rest,"
            f" CASE WHEN contains(rest, {ids}) THEN list_append(found, {_quoted(name)}) ELSE found END AS found FROM {last})"
        )
        last = f"s{i}"
    marked = "lower(coalesce(text, ''))"
    for pattern, replacement in MARKS:
        marked = f"regexp_replace({marked}, {_quoted(pattern)}, {_quoted(replacement)}, 'g')"
    return f"""
WITH marked AS (SELECT doc_id, regexp_replace('[ ' || {marked} || ' ]', ' +', ' ', 'g') AS t FROM documents),
found AS (SELECT doc_id, regexp_extract_all(t, {_quoted(_pattern())}) AS l FROM marked),
sentences AS (
  SELECT doc_id, list_transform(l, lambda s: MAP {{{pairs}}}[regexp_replace(replace(s, ' }} {{ ', ' '), '[[{{] | []}}]', '', 'g')]) AS ids
  FROM found),
s0 AS (SELECT doc_id, ids, '|' || array_to_string(ids, '||') || '|' AS rest, CAST([] AS VARCHAR[]) AS found FROM sentences),
{", ".join(steps)}
SELECT doc_id, len(ids) AS n_sentences, array_to_string(ids, ',') AS sentence_ids,
       array_to_string(list_filter(found, lambda x, i: list_position(found, x) = i), ',') AS licenses,
       array_to_string(list_filter(string_split(rest, '|'), lambda x: x <> ''), ',') AS unmatched
FROM {last}
"""
