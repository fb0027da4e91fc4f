"""Licence scans by canonical digests. DataFrame operations only.

A text is made canonical (case, punctuation, white space, copyright lines and equivalent
spellings do not count) and its SHA-256 is joined with the digests of known licences, made
canonical the same way. The same is done with every line of the text, so that a document
that carries a licence notice among other text names that licence, too. The known texts are
a fixed list (its size is bounded by this file), so they are broadcast.

Defined cases: a null text, or one without words, has no digest and no licence; repeated
rows give repeated rows; a null doc_id is kept; an empty table gives an empty result; a
document of copyright lines alone has no words left.
"""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import start
from tidewater.session import materialize

# Spellings that licence texts use for the same word.
EQUIVALENT = [
    ("acknowledgement", "acknowledgment"),
    ("analogue", "analog"),
    ("analyse", "analyze"),
    ("artefact", "artifact"),
    ("authorisation", "authorization"),
    ("authorised", "authorized"),
    ("favour", "favor"),
    ("fulfil", "fulfill"),
    ("initialise", "initialize"),
    ("judgement", "judgment"),
    ("labour", "labor"),
    ("licence", "license"),
    ("licenced", "licensed"),
    ("non commercial", "noncommercial"),
    ("organisation", "organization"),
    ("per cent", "percent"),
    ("programme", "program"),
    ("recognised", "recognized"),
    ("sub license", "sublicense"),
    ("sublicence", "sublicense"),
    ("utilisation", "utilization"),
    ("whilst", "while"),
    ("wilful", "willful"),
]

# Names of licences in notices.
NAMES = {
    "0BSD": ["BSD Zero Clause License", "0BSD license"],
    "AGPL-3.0": ["GNU Affero General Public License, version 3", "GNU AGPL v3"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 license"],
    "BSD-2-Clause": ["BSD 2-Clause License", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "New BSD License", "Modified BSD License"],
    "BSL-1.0": ["Boost Software License, Version 1.0"],
    "CC-BY-4.0": ["CC BY 4.0", "Creative Commons Attribution 4.0 International License"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0",
                     "Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0",
                     "Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC0-1.0": ["CC0 1.0", "CC0 1.0 Universal"],
    "GPL-2.0": ["GNU General Public License, version 2", "GNU GPL v2", "GPLv2"],
    "GPL-3.0": ["GNU General Public License, version 3", "GNU GPL v3", "GPLv3"],
    "ISC": ["ISC License"],
    "LGPL-2.1": ["GNU Lesser General Public License, version 2.1"],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3"],
    "MIT": ["MIT License", "MIT licence", "Expat License"],
    "MPL-2.0": ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0"],
    "Unlicense": ["Unlicense"],
    "Zlib": ["zlib License"],
}

# How notices name a licence.
NOTICES = [
    "Available under {}.",
    "Distributed under {}.",
    "Licensed under {}.",
    "Provided under {}.",
    "Released under {}.",
    "This document is licensed under {}.",
    "This file is licensed under {}.",
    "This project is licensed under {}.",
    "This software is licensed under {}.",
    "This software is released under {}.",
    "This work is licensed under {}.",
    "This work is released under {}.",
]

_AS_IS = ('THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH '
          "REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND "
          "FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, "
          "OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, "
          "DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS "
          "ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS "
          "SOFTWARE.")
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met: 1. Redistributions of "
        "source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer. 2. Redistributions in binary form must reproduce the above "
        "copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution.{} THIS SOFTWARE "
        'IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR '
        "IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF "
        "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT "
        "SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, "
        "INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED "
        "TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR "
        "BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
        "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN "
        "ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH "
        "DAMAGE.")

_WARRANTY = ('THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR '
             "IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS "
             "FOR A PARTICULAR PURPOSE{} IN NO EVENT SHALL {} BE LIABLE FOR ANY {}DAMAGES OR "
             "OTHER LIABILITY, WHETHER IN {}CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF "
             "OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")

# Texts of short licences.
TEXTS = {
    "0BSD": ("Permission to use, copy, modify, and/or distribute this software for any "
             "purpose with or without fee is hereby granted. " + _AS_IS),
    "BSD-2-Clause": _BSD.format(""),
    "BSD-3-Clause": _BSD.format(
        " 3. Neither the name of the copyright holder nor the names of its contributors may be "
        "used to endorse or promote products derived from this software without specific "
        "prior written permission."),
    "ISC": ("Permission to use, copy, modify, and/or distribute this software for any purpose "
            "with or without fee is hereby granted, provided that the above copyright notice "
            "and this permission notice appear in all copies. " + _AS_IS),
    "MIT": ("Permission is hereby granted, free of charge, to any person obtaining a copy of "
            'this software and associated documentation files (the "Software"), to deal in the '
            "Software without restriction, including without limitation the rights to use, "
            "copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
            "Software, and to permit persons to whom the Software is furnished to do so, "
            "subject to the following conditions: The above copyright notice and this "
            "permission notice shall be included in all copies or substantial portions of the "
            'Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS '
            "OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, "
            "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
            "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, "
            "WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
            "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    "Zlib": ("This software is provided 'as-is', without any express or implied warranty. In no "
             "event will the authors be held liable for any damages arising from the use of "
             "this software. Permission is granted to anyone to use this software for any "
             "purpose, including commercial applications, and to alter it and redistribute it "
             "freely, subject to the following restrictions: 1. The origin of this software "
             "must not be misrepresented; you must not claim that you wrote the original "
             "software. If you use this software in a product, an acknowledgment in the "
             "product documentation would be appreciated but is not required. 2. Altered "
             "source versions must be plainly marked as such, and must not be misrepresented "
             "as being the original software. 3. This notice may not be removed or altered "
             "from any source distribution."),
}
TEXTS["BSL-1.0"] = (
    "Permission is hereby granted, free of charge, to any person or organization obtaining a "
    "copy of the software and accompanying documentation covered by this license (the "
    '"Software") to use, reproduce, display, distribute, execute, and transmit the Software, '
    "and to prepare derivative works of the Software, and to permit third-parties to whom the "
    "Software is furnished to do so, all subject to the following: The copyright notices in "
    "the Software and this entire statement, including the above license grant, this "
    "restriction and the following disclaimer, must be included in all copies of the Software, "
    "in whole or in part, and all derivative works of the Software, unless such copies or "
    "derivative works are solely in the form of machine-executable object code generated by a "
    "source language processor. " + _WARRANTY.format(
        ", TITLE AND NON-INFRINGEMENT.",
        "THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE", "", ""))
_PUBLIC = (
    "This is free and unencumbered software released into the public domain. Anyone is free to "
    "copy, modify, publish, use, compile, sell, or distribute this software, either in source "
    "code form or as a compiled binary, for any purpose, commercial or non-commercial, and by "
    "any means. In jurisdictions that recognize copyright laws, the author or authors of this "
    "software dedicate any and all copyright interest in the software to the public domain. We "
    "make this dedication for the benefit of the public at large and to the detriment of our "
    "heirs and successors. We intend this dedication to be an overt act of relinquishment in "
    "perpetuity of all present and future rights to this software under copyright law. "
    + _WARRANTY.format(" AND NONINFRINGEMENT.", "THE AUTHORS", "CLAIM, ", "AN ACTION OF "))
TEXTS["Unlicense"] = _PUBLIC + " For more information, please refer to <https://unlicense.org>"

# Titles that may stand above a licence's text, beside its NAMES.
TITLES = {"BSD-2-Clause": ["2-Clause BSD License"],
          "BSD-3-Clause": ["3-Clause BSD License"],
          "BSL-1.0": ["Boost Software License - Version 1.0 - August 17th, 2003",
                      "Boost Software License 1.0"]}

# Texts of long licences, as published, a file each.
LONG = Path(__file__).parent / "license_texts"
# Where the terms end; what follows says how to apply them.
_ENDS = ["END OF TERMS AND CONDITIONS", "How to Apply These Terms to Your New", "Exhibit A -"]
_STREETS = ["51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA",
            "51 Franklin St, Fifth Floor, Boston, MA  02110-1301  USA",
            "59 Temple Place, Suite 330, Boston, MA  02111-1307  USA"]


def _versions(text: str) -> list[str]:
    """A long licence as it is found: whole or up to the end of its terms, broken into lines or
    not (of which those that begin with "copyright" do not count), with either spelling of its
    links and any address of its publisher."""
    cut = [text] + [text[:text.index(e) + k] for e in _ENDS if e in text
                    for k in (0, len(_ENDS[0]) * (e == _ENDS[0]))]
    street = re.compile(r"51 Franklin St(?:reet)?,\s+Fifth\s+Floor,\s+Boston,\s+MA\s+02110-1301,?"
                        r"\s+USA")
    cut += [street.sub(x, t) for t in cut for x in _STREETS if street.search(t)]
    cut += [re.sub("https?://", f"{x}://", t) for t in cut for x in ("http", "https")]
    flat = [re.sub(r"(?<=\S)[ \t]*\n[ \t]*(?=\S)(?!Copyright \(|Everyone is|\d+ \w+ (?:Street|Place))",
                   " ", t) for t in cut]
    return list(dict.fromkeys(cut + flat))


def _headings(licence: str) -> list[str]:
    names = dict.fromkeys(NAMES[licence] + TITLES.get(licence, []))
    return [the + n + short for n in names for the in ("", "The ")
            for short in ("", f" ({licence})")]


def known() -> list[tuple[str, str]]:
    """(licence id, text) of every known text: notices by rule, and whole licences with and
    without a heading."""
    rows = [(i, n.format(the + name)) for i, names in NAMES.items() for name in names
            for n in NOTICES for the in ("", "the ")]
    short = [*TEXTS.items(), ("Unlicense", TEXTS["Unlicense"].replace("https", "http")),
             ("Unlicense", _PUBLIC)]
    rows += short + [(i, f"{h}\n{t}") for i, t in short for h in _headings(i)]
    return rows + [(f.stem, t) for f in sorted(LONG.glob("*.txt"))
                   for t in _versions(f.read_text())]


def canonical_lines(text: Column) -> Column:
    """Canonical lines of a text, without empty and copyright lines."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    t = F.replace(F.coalesce(text, F.lit("")), F.lit("©"), F.lit(" copyright "))
    t = F.regexp_replace(F.translate(t, upper, lower), r"[^\p{L}\p{N}\n]+", " ")
    t = F.concat(F.lit(" "), F.replace(t, F.lit("\n"), F.lit(" \n ")), F.lit(" "))
    for a, b in EQUIVALENT:
        t = F.replace(t, F.lit(f" {a} "), F.lit(f" {b} "))
    lines = F.transform(F.split(t, "\n"), lambda x: F.trim(x))
    return F.filter(lines, lambda x: (x != "") & ~x.rlike(
        r"^(copyright( |$)|c [0-9]{4}|all rights reserved$)"))


def scan(docs: DataFrame, texts: list[tuple[str, str]] | None = None) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_words (of the canonical text),
    text_digest, license_id (the whole text's licence), notices (licences of its lines, in
    order, by spaces; null without any) and n_notices (lines that are notices)."""
    spark = start(docs)
    listed = spark.createDataFrame(texts or known(), "license string, body string")
    listed = listed.select("license", canonical_lines(F.col("body")).alias("l")).select(
        F.array_join("l", " ").alias("body"), "license")
    listed = listed.groupBy("body").agg(F.min("license").alias("license"))
    digests = listed.select(F.sha2("body", 256).alias("digest"), "license")
    least, most = listed.agg(F.min(F.length("body")), F.max(F.length("body"))).first()

    lines = canonical_lines(F.col("text"))
    rows = docs.select("doc_id", lines.alias("l")).select(
        "doc_id", F.array_join("l", " ").alias("body"),
        F.filter("l", lambda x: F.length(x).between(least, most)).alias("l"))
    rows = materialize(rows.select(
        "doc_id",
        F.when(F.col("body") == "", 0).otherwise(
            F.length("body") - F.length(F.replace("body", F.lit(" "), F.lit(""))) + 1)
        .cast("long").alias("n_words"),
        F.when(F.col("body") != "", F.sha2("body", 256)).alias("text_digest"),
        F.transform("l", lambda x: F.sha2(x, 256)).alias("l")), "canonical")
    by_line = (rows.where("size(l) > 0").select("doc_id", "text_digest", "l").distinct()
               .select("doc_id", "text_digest", F.explode("l").alias("digest"))
               .join(F.broadcast(digests), "digest")
               .groupBy("doc_id", "text_digest")
               .agg(F.array_join(F.array_sort(F.collect_set("license")), " ").alias("notices"),
                    F.count(F.lit(1)).alias("n_notices")))
    whole = digests.select(F.col("digest").alias("text_digest"),
                           F.col("license").alias("license_id"))
    out = rows.drop("l").join(F.broadcast(whole), "text_digest", "left")
    by_line = by_line.withColumnRenamed("doc_id", "_id").withColumnRenamed("text_digest", "_d")
    return (out.join(by_line, out["doc_id"].eqNullSafe(by_line["_id"])
                     & (out["text_digest"] == by_line["_d"]), "left")
            .select("doc_id", "n_words", "text_digest", "license_id", "notices",
                    F.coalesce("n_notices", F.lit(0)).alias("n_notices")))


def oracle() -> str:
    """The scan of the documents table, as SQL."""
    def q(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    t = (f"regexp_replace(translate(replace(coalesce(text, ''), chr(169), ' copyright '), "
         f"'{upper}', '{lower}'), '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g')")
    t = f"' ' || replace({t}, chr(10), ' ' || chr(10) || ' ') || ' '"
    for a, b in EQUIVALENT:
        t = f"replace({t}, ' {a} ', ' {b} ')"
    drop = "'^(copyright( |$)|c [0-9]{4}|all rights reserved$)'"
    values = ", ".join(f"({q(i)}, {q(x)})" for i, x in known())
    return f"""
WITH given AS (SELECT * FROM (VALUES {values}) AS v(license, text)),
both AS (SELECT 0 AS k, license AS name, NULL::BIGINT AS doc_id, 0 AS rid, text FROM given
  UNION ALL SELECT 1, NULL, doc_id, row_number() OVER (), text FROM documents),
canon AS (SELECT k, name, doc_id, rid, [trim(x) FOR x IN string_split({t}, chr(10))
  IF trim(x) <> '' AND NOT regexp_matches(trim(x), {drop})] AS l FROM both),
listed AS (SELECT array_to_string(l, ' ') AS body, min(name) AS license FROM canon
  WHERE k = 0 GROUP BY 1),
rows_ AS (SELECT doc_id, rid, l, array_to_string(l, ' ') AS body FROM canon WHERE k = 1),
by_line AS (SELECT rid, string_agg(DISTINCT license, ' ' ORDER BY license) AS notices,
  count(*) AS n FROM (SELECT rid, unnest(l) AS body FROM rows_) JOIN listed USING (body)
  GROUP BY rid)
SELECT doc_id, CASE WHEN r.body = '' THEN 0
    ELSE length(r.body) - length(replace(r.body, ' ', '')) + 1 END AS n_words,
  CASE WHEN r.body <> '' THEN sha256(r.body) END AS text_digest, license AS license_id,
  notices, coalesce(n, 0) AS n_notices
FROM rows_ r LEFT JOIN listed ON listed.body = r.body LEFT JOIN by_line USING (rid)
""".replace("both AS", "given_or_read AS").replace("FROM both)", "FROM given_or_read)")
