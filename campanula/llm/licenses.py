"""License scan by canonical digest lookup.

A text is brought to a canonical form: lower case, copyright marks and lines
left out, equivalent spellings replaced, everything but letters and digits
turned into single spaces.  The digest of the *entire* canonical text is then
hash-joined with the digests of known licenses.  A license notice is the same
thing one level down: an entire line whose canonical digest is that of a known
notice.  There is no partial or fuzzy matching.

Whole texts are looked up a second time in a form that doesn't know lines, so
that wrapping makes no difference: list bullets go, and so does what stands
before the first words of a known license if it is nothing but titles and
copyright notices.  Nothing behind those first words is left out.

The catalogue is a small table of fixed size and is canonicalised by the same
expressions as the documents.  Built-in functions only.  Null texts count as
empty and match nothing; repeated rows are looked up each on their own, rows
that repeat an id with the same text too.
"""

from __future__ import annotations

from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from campanula.session import materialize

from .common import whole_text

# --- fixed values: spellings that count as equal (from, to), whole words ---
SPELLINGS = (("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("sublicence", "sublicense"),
             ("sub license", "sublicense"), ("organisation", "organization"), ("non commercial", "noncommercial"),
             ("whilst", "while"), ("https", "http"), ("copyright holders", "copyright owners"), ("copyright holder", "copyright owner"))

# --- fixed values: whole license texts (copyright lines are left out of any comparison) ---
_DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE
ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
"""
LICENSES = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "BSD-2-Clause": _BSD_HEAD + _DISCLAIMER,
    "BSD-3-Clause": _BSD_HEAD + """3. Neither the name of the copyright holder nor the names of its contributors may be used to
endorse or promote products derived from this software without specific prior written permission.
""" + _DISCLAIMER,
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE.""",
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it
and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If
you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not
required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.""",
}

# --- fixed values: notices that stand on a line of their own, by license ---
NOTICES = {
    "MIT": ("Released under the MIT License.", "Licensed under the MIT License.", "SPDX-License-Identifier: MIT"),
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0.", "Released under the Apache License, Version 2.0.",
                   'Licensed under the Apache License, Version 2.0 (the "License");', "SPDX-License-Identifier: Apache-2.0"),
    "GPL-3.0": ("This work is licensed under the GNU General Public License, version 3.",
                "Licensed under the GNU General Public License, version 3.", "SPDX-License-Identifier: GPL-3.0-only",
                "SPDX-License-Identifier: GPL-3.0-or-later"),
    "GPL-2.0": ("This work is licensed under the GNU General Public License, version 2.",
                "Licensed under the GNU General Public License, version 2.", "SPDX-License-Identifier: GPL-2.0-only"),
    "BSD-3-Clause": ("Released under the BSD 3-Clause License.", "Licensed under the BSD 3-Clause License.",
                     "SPDX-License-Identifier: BSD-3-Clause"),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.",
                     "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.",
                     "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC0-1.0": ("Licensed under CC0 1.0.", "Dedicated to the public domain under CC0 1.0.", "SPDX-License-Identifier: CC0-1.0"),
    "all-rights-reserved": ("All rights reserved.",),
}
# --- fixed values: the form without lines (canonical words) ---
#: more whole texts by license, beside LICENSES and the files of license_texts
VARIANTS = (
    ("MIT", LICENSES["MIT"].replace("this permission notice shall", "this permission notice (including the next paragraph) shall")),
    ("ISC", LICENSES["ISC"].replace("and/or distribute", "and distribute")),
)
#: what follows is an appendix that copies of a license may do without
APPENDIX = ("END OF TERMS AND CONDITIONS", "ADDENDUM: How to use this License")
#: first words of the license itself
OPENINGS = ("permission is hereby granted free of charge to any person", "redistribution and use in source and binary forms",
            "permission to use copy modify and", "this software is provided as is without any express or implied",
            "terms and conditions for use reproduction and distribution", "everyone is permitted to copy and distribute verbatim copies",
            "definitions contributor means each individual or legal entity", "definitions commercial use means distribution",
            "creative commons corporation is not a law firm", "statement of purpose the laws of most jurisdictions",
            "preamble the intent of this document is to state")
#: what may stand before them beside copyright notices
TITLES = (r"(?<= )(?:(?:the )?(?:(?:mit|x11|expat|isc|zlib|libpng|bsd|0bsd|zero|[0-4]|clause|new|or|modified|simplified|revised|style) )+license (?:(?:mit|isc|x11|expat|bsd) )?"
          r"|gnu (?:(?:library|lesser|affero|general|public|free|documentation) )+license (?:l?gpl )?version [0-9 ]+(?:[a-z]+ )?[0-9]{4} "
          r"|apache license version 2 0 (?:january 2004 )?(?:http www apache org licenses (?:license 2 0 )?)?|mozilla public license version [12] [01] "
          r"|creative commons legal code |cc0 1 0 universal |the artistic license |all rights reserved |license )")
#: a list bullet: number, letter or small roman number with a full stop or bracket
BULLET = r"(?<!\S)\(?(?:\d{1,2}(?:\.\d{1,2})*|[a-z]|[ivx]{1,4})[.)](?!\S)"
#: words of one copyright notice; a longer passage is text
NOTICE_WORDS = 40
#: licenses under which a text is not free to use
RESTRICTED = ("CC-BY-NC-4.0", "all-rights-reserved")
COPYLEFT = ("GPL-2.0", "GPL-3.0", "CC-BY-SA-4.0")
COPYLEFT_TEXTS = ("GPL-1.0", "LGPL-2.0", "LGPL-2.1", "LGPL-3.0", "GFDL-1.2", "GFDL-1.3", "MPL-1.1", "MPL-2.0")
# ---------------------------------------------------------------------------------


def canonical_lines(text: Column) -> Column:
    """The non-empty canonical lines of a text."""
    c = F.regexp_replace(F.lower(text), r"©|\(c\)", " copyright ")
    # one space on both sides of every line, so that whole words can be replaced
    c = F.regexp_replace(c, r"[^\p{L}\p{N}\n]+", " ")
    c = F.replace(F.concat(F.lit(" "), F.replace(c, F.lit("\n"), F.lit(" \n ")), F.lit(" ")), F.lit("  "), F.lit(" "))
    for old, new in SPELLINGS:
        c = F.replace(c, F.lit(f" {old} "), F.lit(f" {new} "))
    return F.filter(F.transform(F.split(c, "\n"), lambda x: F.trim(x)), lambda x: x != "")


def canonical_text(lines: Column) -> Column:
    """Canonical lines in one, without copyright lines."""
    return F.array_join(F.filter(lines, lambda x: ~x.startswith("copyright") & (x != "all rights reserved")), " ")


def _digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def flat_text(text: Column) -> Column:
    """Canonical words of a text in one line, a space at both ends, without list bullets."""
    c = F.regexp_replace(F.lower(text), r"©|\(c\)", " copyright ")
    c = F.regexp_replace(F.regexp_replace(c, BULLET, " "), r"[^\p{L}\p{N}]+", " ")
    c = F.concat(F.lit(" "), F.trim(c), F.lit(" "))
    for old, new in SPELLINGS:
        c = F.replace(c, F.lit(f" {old} "), F.lit(f" {new} "))
    return c


def opening(flat: Column) -> Column:
    """Where in a flat text the first words of a known license begin, null if nowhere."""
    return F.least(*[F.nullif(F.instr(flat, f" {o} "), F.lit(0)) for o in OPENINGS])


def license_body(flat: Column, at: Column) -> Column:
    """A flat text from its opening on, if only titles and copyright notices stand before it."""
    head = F.trim(F.regexp_replace(F.substring(flat, F.lit(1), at), TITLES, ""))
    notices = head.startswith("copyright ") & F.forall(
        F.split(head, r"\bcopyright\b"), lambda x: F.size(F.split(F.trim(x), " ")) <= NOTICE_WORDS)
    return F.when((head == "") | notices, F.substring(flat, at, F.length(flat))).otherwise(flat)


def whole_texts() -> list[tuple[str, str]]:
    """(license, text) of all known whole texts, with and without appendix."""
    files = sorted((f for f in resources.files(__package__).joinpath("license_texts").iterdir() if f.name.endswith(".txt")), key=lambda f: f.name)
    texts = [*LICENSES.items(), *VARIANTS, *((f.name.removesuffix(".txt"), f.read_text(encoding="utf-8")) for f in files)]
    texts += [(k, t[t.index("Statement of Purpose"):]) for k, t in texts if k == "CC0-1.0"]
    short = [(k, t[:t.index(a) + n]) for k, t in texts for a in APPENDIX if a in t for n in (0, len(a) if a == APPENDIX[0] else 0)]
    return list(dict.fromkeys(texts + short))


def flat_catalogue(spark: SparkSession) -> DataFrame:
    """Digests of the known whole texts in the form without lines."""
    known = spark.createDataFrame(whole_texts(), "flat_license string, raw string").select("flat_license", flat_text(F.col("raw")).alias("flat"))
    return known.select("flat_license", _digest(license_body(F.col("flat"), opening(F.col("flat")))).alias("flat_digest")).distinct()


def catalogue(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """Digests of the known whole texts and of the known notices."""
    def table(pairs):
        return spark.createDataFrame(pairs, "license string, raw string")
    whole = table(list(LICENSES.items())).select("license", _digest(canonical_text(canonical_lines(F.col("raw")))).alias("digest"))
    lines = table([(k, n) for k, ns in NOTICES.items() for n in ns])
    lines = lines.select("license", F.array_join(canonical_lines(F.col("raw")), " ").alias("line"))
    return whole, lines.select("license", _digest(F.col("line")).alias("digest"), F.length("line").alias("n"))


def scan_licenses(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: digest of the canonical text, the license that the entire
    text is (null if none), the notices on lines of their own and a verdict."""
    whole, notices = catalogue(documents.sparkSession)
    longest = max(len(n) for ns in NOTICES.values() for n in ns) + 40  # a canonical notice is shorter
    text = whole_text(text_col)
    rows = documents.select(F.col(id_col).alias("__id"), F.xxhash64(text).alias("__row"), canonical_lines(text).alias("__lines"), flat_text(text).alias("__flat"))
    rows = rows.withColumn("__at", opening(F.col("__flat")))
    # lines longer than any notice cannot be one; the short ones and the digest are written once and read twice
    short = F.array_distinct(F.filter("__lines", lambda x: F.length(x) <= longest))
    body = F.when(F.col("__at").isNotNull(), _digest(license_body(F.col("__flat"), F.col("__at"))))
    rows = materialize(rows.select("__id", "__row", _digest(canonical_text(F.col("__lines"))).alias("digest"), body.alias("flat_digest"), short.alias("__short")))
    found = (rows.select("__id", "__row", F.explode("__short").alias("line")).select("__id", "__row", _digest(F.col("line")).alias("digest"))
             .join(F.broadcast(notices), "digest").groupBy("__id", "__row").agg(F.array_sort(F.collect_set("license")).alias("__found")))
    out = rows.select("__id", "__row", "digest", "flat_digest").join(F.broadcast(whole), "digest", "left")
    out = out.join(F.broadcast(flat_catalogue(documents.sparkSession)), "flat_digest", "left").withColumn("license", F.coalesce("license", "flat_license"))
    found = found.withColumnRenamed("__id", "__id2").withColumnRenamed("__row", "__row2")
    out = out.join(found, F.col("__id").eqNullSafe(F.col("__id2")) & (F.col("__row") == F.col("__row2")), "left")
    held = F.coalesce("__found", F.array().cast("array<string>"))
    every = F.array_union(held, F.when(F.col("license").isNotNull(), F.array("license")).otherwise(F.array().cast("array<string>")))

    def any_of(names):
        return F.arrays_overlap(every, F.array(*map(F.lit, names)))
    verdict = (F.when(F.size(every) == 0, "none").when(any_of(RESTRICTED), "restricted").when(any_of(COPYLEFT + COPYLEFT_TEXTS), "copyleft").otherwise("permissive"))
    return out.select(F.col("__id").alias(id_col), F.col("digest").alias("text_digest"), F.col("license").alias("license_id"),
                      F.size(held).cast("long").alias("n_notices"), F.array_join(held, ",").alias("notices"), verdict.alias("verdict"))


def _sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def oracle_sql() -> str:
    """The same scan in DuckDB SQL."""
    def lines(column: str) -> str:
        c = f"regexp_replace(lower({column}), '©|\\(c\\)', ' copyright ', 'g')"
        c = f"regexp_replace({c}, '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g')"
        c = f"replace(' ' || replace({c}, chr(10), ' ' || chr(10) || ' ') || ' ', '  ', ' ')"
        for old, new in SPELLINGS:
            c = f"replace({c}, ' {old} ', ' {new} ')"
        return f"list_filter(list_transform(string_split({c}, chr(10)), lambda x: trim(x, ' ')), lambda x: x <> '')"

    def digest(column: str) -> str:
        return (f"sha256(array_to_string(list_filter({column}, lambda x: not starts_with(x, 'copyright') and x <> 'all rights reserved'), ' '))")
    whole = ", ".join(f"({_sql_text(k)}, {_sql_text(v)})" for k, v in LICENSES.items())
    notices = ", ".join(f"({_sql_text(k)}, {_sql_text(n)})" for k, ns in NOTICES.items() for n in ns)
    names = {k: ", ".join(map(_sql_text, v)) for k, v in (("restricted", RESTRICTED), ("copyleft", COPYLEFT))}
    return f"""
WITH whole_known AS (SELECT license, {digest(lines('raw'))} AS digest FROM (VALUES {whole}) AS v(license, raw)),
notice_known AS (SELECT license, array_to_string({lines('raw')}, ' ') AS line FROM (VALUES {notices}) AS v(license, raw)),
rows AS (SELECT doc_id, row_number() OVER () AS r, {lines("coalesce(text, '')")} AS lines FROM documents),
hits AS (SELECT r, list_sort(list_distinct(list(k.license))) AS found
         FROM (SELECT r, unnest(list_distinct(lines)) AS line FROM rows) l JOIN notice_known k USING (line) GROUP BY r),
joined AS (SELECT doc_id, {digest('lines')} AS text_digest, coalesce(h.found, []) AS found
           FROM rows LEFT JOIN hits h USING (r)),
named AS (SELECT j.*, w.license AS license_id,
                 CASE WHEN w.license IS NULL THEN found ELSE list_distinct(list_append(found, w.license)) END AS every
          FROM joined j LEFT JOIN whole_known w ON w.digest = j.text_digest)
SELECT doc_id, text_digest, license_id, CAST(len(found) AS BIGINT) AS n_notices, array_to_string(found, ',') AS notices,
       CASE WHEN len(every) = 0 THEN 'none' WHEN list_has_any(every, [{names['restricted']}]) THEN 'restricted'
            WHEN list_has_any(every, [{names['copyleft']}]) THEN 'copyleft' ELSE 'permissive' END AS verdict
FROM named"""
