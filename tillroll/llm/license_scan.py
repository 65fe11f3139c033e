"""Licence scan by canonical digests, in DataFrame functions only.

A text is canonical when it is in lower case, without copyright notices, "all
rights reserved" and list marks, with each run of characters that are neither
letters nor digits as one space, and with equivalent spellings made one. A notice
starts a line with a sign, a year, "by" or "the" after the word; it ends with the
line, or with a sentence where at least 80 characters follow it there. The digest
of the whole canonical text is hash-joined to the digests of known licences (a
fixed, small table); a line that is a licence text or statement by itself is looked
up by its digest too. Statements are made from the names and versions of licences.
No shuffle.

Null text counts as empty and has no licence. Null ids and repeated rows keep
their rows. An empty table gives no rows; extra columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Spellings that count as equal, as whole words.
SPELLINGS = (
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("licensor", "licenser"),
    ("sub license", "sublicense"), ("sub licence", "sublicense"), ("non commercial", "noncommercial"),
    ("copyright owner", "copyright holder"), ("copyright owners", "copyright holders"),
    ("per cent", "percent"), ("acknowledgement", "acknowledgment"), ("favour", "favor"),
    ("organisation", "organization"), ("authorised", "authorized"), ("programme", "program"),
    ("initialise", "initialize"), ("realise", "realize"), ("merchantibility", "merchantability"),
    ("wilful", "willful"), ("whilst", "while"), ("https", "http"),
)

_NOTICE = r"^[ \t#*/;%\-]*(?:copyright[ \t:]*(?:\(c\)|©|[0-9<\[]|by[ \t]|the[ \t])|\(c\)[ \t]*(?:copyright[ \t]*)?[0-9<\[]|©)"
NOTICE_LINE = _NOTICE
NOTICE_THEN_TEXT = _NOTICE + r"[^\n]{0,200}?[a-z]{2}[.][ \t]+([^\n]{80,})$"
LIST_MARK = r"^[ \t#*/;%\-]*\(?(?:[0-9]{1,2}|[a-z])[.)][ \t]+"
LEFT_OUT = " all rights reserved "
SHORT = 200   # characters; a shorter known text holds the word license

_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO '
    "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
    "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
    "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
    "IN THE SOFTWARE."
)
_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
    "to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n"
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
    "the Software.\n" + _WARRANTY
)
_ISC_GRANT = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
)
_ISC_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING '
    "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
    "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
    "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE "
    "USE OR PERFORMANCE OF THIS SOFTWARE."
)
_BSD_HEAD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:\n"
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer.\n"
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
    "following disclaimer in the documentation and/or other materials provided with the distribution.\n"
)
_BSD_THREE = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission.\n"
)
_BSD_WARRANTY = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE "
    "USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_ZLIB = (
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
    "liable for any damages arising from the use of this software.\n"
    "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to "
    "alter it and redistribute it freely, subject to the following restrictions:\n"
    "1. The origin of this software must not be misrepresented; you must not claim that you wrote the original "
    "software. If you use this software in a product, an acknowledgment in the product documentation would be "
    "appreciated but is not required.\n"
    "2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original "
    "software.\n"
    "3. This notice may not be removed or altered from any source distribution."
)

_UNLICENSE = (
    "This is free and unencumbered software released into the public domain.\n"
    "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form "
    "or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.\n"
    "In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright "
    "interest in the software to the public domain. We make this dedication for the benefit of the public at large and to "
    "the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in "
    "perpetuity of all present and future rights to this software under copyright law.\n"
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE "
    "LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
    "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_APACHE_NOTICE = (
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with '
    "the License. You may obtain a copy of the License at\nhttp://www.apache.org/licenses/LICENSE-2.0\n"
    "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on "
    'an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
    "specific language governing permissions and limitations under the License."
)
_MPL_NOTICE = (
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
    "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
)
_ISC = _ISC_GRANT + ", provided that the above copyright notice and this permission notice appear in all copies.\n" + _ISC_WARRANTY

# Identifiers, titles and texts of known licences and of notices that stand for them.
TEXTS = (
    ("MIT", ("MIT License", "The MIT License", "The MIT License (MIT)"), _MIT),
    ("MIT-0", ("MIT No Attribution",), _MIT.replace(", subject to the following conditions", "").replace(
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n", "")),
    ("ISC", ("ISC License", "The ISC License"), _ISC),
    ("0BSD", ("BSD Zero Clause License", "Zero-Clause BSD"), _ISC_GRANT + ".\n" + _ISC_WARRANTY),
    ("BSD-2-Clause", ("BSD 2-Clause License", "The 2-Clause BSD License"), _BSD_HEAD + _BSD_WARRANTY),
    ("BSD-3-Clause", ("BSD 3-Clause License", "The 3-Clause BSD License"), _BSD_HEAD + _BSD_THREE + _BSD_WARRANTY),
    ("Zlib", ("zlib License", "The zlib/libpng License"), _ZLIB),
    ("Unlicense", ("The Unlicense",), _UNLICENSE),
    ("Unlicense", ("The Unlicense",), _UNLICENSE + "\nFor more information, please refer to <https://unlicense.org>"),
    ("Apache-2.0", (), _APACHE_NOTICE),
    ("MPL-2.0", (), _MPL_NOTICE),
)
# Licences with names that statements use; of versioned ones, identifier and name of each version.
NAMES = (
    ("MIT", "MIT License"), ("MIT", "MIT"), ("ISC", "ISC License"), ("Zlib", "zlib License"), ("Unlicense", "Unlicense"),
    ("BSL-1.0", "Boost Software License"), ("0BSD", "Zero-Clause BSD License"), ("WTFPL", "WTFPL"),
    ("BSD-2-Clause", "BSD 2-Clause License"), ("BSD-3-Clause", "BSD 3-Clause License"),
)
VERSIONED = (
    ("Apache-{}", "Apache License", ("1.1", "2.0")), ("MPL-{}", "Mozilla Public License", ("1.1", "2.0")),
    ("GPL-{}-only", "GNU General Public License", ("1.0", "2.0", "3.0")),
    ("LGPL-{}-only", "GNU Lesser General Public License", ("2.1", "3.0")),
    ("AGPL-{}-only", "GNU Affero General Public License", ("3.0",)), ("EPL-{}", "Eclipse Public License", ("1.0", "2.0")),
)
COMMONS = tuple("CC-" + x for x in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND"))
COMMONS_NAMES = {"BY": "Attribution", "SA": "ShareAlike", "NC": "NonCommercial", "ND": "NoDerivatives"}
SAYINGS = ("Released under {}.", "Licensed under {}.", "This work is licensed under {}.", "This project is licensed under {}.",
           "This software is released under {}.", "Distributed under {}.", "License: {}")


def _statements() -> Iterator[tuple[str, str]]:
    """Identifier and statement, for each saying, article and way to write a version."""
    names = [*NAMES, ("CC0-1.0", "CC0 1.0"), ("CC0-1.0", "CC0 1.0 Universal")]
    for form, name, versions in VERSIONED:
        for version in versions:
            for written in {version, version.removesuffix(".0")}:
                names += [(form.format(version), name + between + written) for between in (" ", ", version ", ", v")]
    for code in COMMONS:
        spelled = "-".join(COMMONS_NAMES[x] for x in code.split("-")[1:])
        for version in ("3.0", "4.0"):
            names += [(f"{code}-{version}", f"{code.replace('-', ' ', 1)} {version}"),
                      (f"{code}-{version}", f"Creative Commons {spelled} {version} International License")]
    for code, name in names:
        for saying in SAYINGS:
            for article in ("", "a " if name.startswith("Creative") else "the "):
                if "licen" in (saying + name).lower():
                    yield code, saying.format(article + name)
    for code in sorted({c for c, _ in names} | {c.replace("-only", "-or-later") for c, _ in names}):
        yield code, f"SPDX-License-Identifier: {code}"


KNOWN = tuple(dict.fromkeys((
    *((code, head + text) for code, titles, text in TEXTS for head in ("", *(t + "\n" for t in titles))), *_statements())))


def _spelled(out: Column, spellings: tuple[tuple[str, str], ...]) -> Column:
    """Words between blanks, with one of two spellings; blanks are doubled for
    it, so that words side by side do not share one."""
    out = F.replace(out, F.lit(" "), F.lit("  "))
    for other, one in spellings:
        out = F.replace(out, F.lit(f" {other.replace(' ', '  ')} "), F.lit(f" {one.replace(' ', '  ')} "))
    return F.replace(out, F.lit("  "), F.lit(" "))


PAIRS = tuple(x for x in SPELLINGS if " " in x[0])   # a line may end within these


def canonical_line(line: Column) -> Column:
    """A line of lower case as words with a space before and after each."""
    line = F.regexp_replace(F.regexp_replace(line, NOTICE_THEN_TEXT, "$1"), LIST_MARK, "")
    out = F.concat(F.lit(" "), F.regexp_replace(line, r"[^\p{L}\p{N}]+", " "), F.lit(" "))
    out = F.replace(F.replace(out, F.lit("  "), F.lit(" ")), F.lit(LEFT_OUT), F.lit(" "))
    return _spelled(out, SPELLINGS)


def canonical_lines(text: Column) -> Column:
    """Canonical lines of a text, without copyright notices and empty lines."""
    lines = F.filter(F.split(F.lower(text), r"[\r\n]"),
                     lambda x: ~F.rlike(x, F.lit(NOTICE_LINE)) | F.rlike(x, F.lit(NOTICE_THEN_TEXT)))
    return F.filter(F.transform(lines, lambda x: F.trim(canonical_line(x))), lambda x: x != "")


def canonical_text(lines: Column) -> Column:
    """Canonical lines as one text."""
    return F.trim(_spelled(F.concat(F.lit(" "), F.array_join(lines, " "), F.lit(" ")), PAIRS))


def digest(canonical: Column) -> Column:
    return F.sha2(canonical, 256)


def known_digests(spark: SparkSession) -> list[tuple[str, str, int]]:
    """(digest, licence, length) of the known texts: at most as many as ``KNOWN`` has."""
    rows = spark.createDataFrame(KNOWN, "license string, text string").select(
        canonical_text(canonical_lines(F.col("text"))).alias("text"), "license").select(
        digest(F.col("text")).alias("digest"), "license", F.length("text").alias("n"), F.contains("text", F.lit("license")).alias("named")).distinct().collect()
    if not all(r["named"] or r["n"] >= SHORT for r in rows):
        raise ValueError("a short known text must name a license")
    return sorted((r["digest"], r["license"], r["n"]) for r in rows)


def scan(docs: DataFrame, known: list[tuple[str, str, int]]) -> DataFrame:
    """doc_id, digest of the whole text, license (of the whole text, or null),
    line_licenses (licences that lines state, sorted, by commas)."""
    spark = docs.sparkSession
    table = F.broadcast(spark.createDataFrame(known, "digest string, license string, n int").select("digest", "license"))
    names = F.map_from_arrays(F.array(*(F.lit(d) for d, _, _ in known)), F.array(*(F.lit(n) for _, n, _ in known)))
    longest = max((n for _, _, n in known), default=0)
    lines = F.col("lines")
    # Only lines that can be known ones are looked up.
    likely = F.filter(lines, lambda x: (F.length(x) <= longest) & ((F.length(x) >= SHORT) | F.contains(x, F.lit("license"))))
    hits = F.filter(F.transform(likely, lambda x: names[digest(x)]), lambda x: x.isNotNull())
    read = docs.select("doc_id", canonical_lines(F.coalesce("text", F.lit(""))).alias("lines"))
    found = read.select("doc_id", digest(canonical_text(lines)).alias("digest"),
                        F.array_join(F.array_sort(F.array_distinct(hits)), ",").alias("line_licenses"))
    return found.join(table, "digest", "left").select("doc_id", "digest", "license", "line_licenses")


def oracle_sql() -> str:
    """The same in DuckDB."""
    def quoted(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    def spelled(x: str, spellings: tuple[tuple[str, str], ...]) -> str:
        x = f"replace({x}, ' ', '  ')"
        for other, one in spellings:
            x = f"replace({x}, {quoted(' ' + other.replace(' ', '  ') + ' ')}, {quoted(' ' + one.replace(' ', '  ') + ' ')})"
        return f"replace({x}, '  ', ' ')"

    def text(lines: str) -> str:
        return f"trim({spelled(f"' ' || array_to_string({lines}, ' ') || ' '", PAIRS)}, ' ')"

    canon = f"regexp_replace(regexp_replace(x, {quoted(NOTICE_THEN_TEXT)}, '\\1'), {quoted(LIST_MARK)}, '')"
    canon = f"' ' || regexp_replace({canon}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g') || ' '"
    canon = spelled(f"replace(replace({canon}, '  ', ' '), {quoted(LEFT_OUT)}, ' ')", SPELLINGS)
    lines = (
        f"list_filter(list_transform(list_filter(string_split(replace(lower(text), chr(13), chr(10)), chr(10)), "
        f"lambda x: NOT regexp_matches(x, {quoted(NOTICE_LINE)}) OR regexp_matches(x, {quoted(NOTICE_THEN_TEXT)})), "
        f"lambda x: trim({canon}, ' ')), lambda x: x <> '')"
    )
    rows = ", ".join(f"({quoted(n)}, {quoted(t)})" for n, t in KNOWN)
    return f"""
    WITH known AS (
      SELECT DISTINCT sha256({text(lines)}) AS digest, license FROM (VALUES {rows}) AS t(license, text)
    ), read AS (
      SELECT row_number() OVER () AS n, doc_id, {lines} AS lines
      FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)
    ), hits AS (
      SELECT n, string_agg(DISTINCT license, ',' ORDER BY license) AS names
      FROM (SELECT n, sha256(unnest(lines)) AS digest FROM read) JOIN known USING (digest) GROUP BY n
    )
    SELECT doc_id, r.digest, license, coalesce(names, '') AS line_licenses
    FROM (SELECT n, doc_id, sha256({text('lines')}) AS digest FROM read) r LEFT JOIN hits USING (n) LEFT JOIN known USING (digest)
    """
