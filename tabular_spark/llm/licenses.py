"""License scans by canonical digest lookup, with DataFrame operations only.

A whole text, each block of it between blank lines and each line is brought into a canonical form
(lower case, copyright lines off, equivalent spellings made one, punctuation and white space to
single spaces) and its digest is hash-joined with those of known license texts, canonicalised by
the same expression. The known texts are a short fixed list, so they are broadcast.

Texts of several paragraphs (``license_texts/``) are found wherever they stand, however they are
broken into lines and paragraphs: the whole document is brought into one line, cut before every
occurrence of a known text's first ``FIRST`` words, and from each cut the digests of as many
characters as the known texts with these first words have are looked up. This is done with titles
and copyright lines off, with or without a year, and with them; holders' names are made one. One-
line notices (``KNOWN``) must be a unit or a block of their own, as a sentence may only speak of a
license.

Cases: a null text counts as empty; empty texts and units match nothing; repeated rows get the
same result each; an empty table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

import hashlib
import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabular_spark.llm.common import text_of

# Known license texts and notices, by SPDX identifier.
KNOWN = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
)
# Spellings that count as one, in canonical form (what is written, what it becomes).
SPELLINGS = (
    ("licence", "license"),
    ("sub license", "sublicense"),
    ("non commercial", "noncommercial"),
    ("non infringement", "noninfringement"),
    ("acknowledgement", "acknowledgment"),
    ("copyright owner", "copyright holder"),
    ("https", "http"),
    ("per cent", "percent"),
)
#: A line that names who holds the copyright, and since when.
COPYRIGHT_LINE = r"(?m)^[^a-z0-9\n]*(copyright|\(c\)|©)[^\n]*(19|20)[0-9][0-9][^\n]*$"
#: All but letters, digits and the ends of lines; what stands around the end of a line.
PUNCTUATION, LINE_END = r"[^\p{L}\p{N}\n]+", r" ?\n ?"
#: Every known text holds one of these in canonical form, so a text or unit without them can't be one.
MARKS = ("licen", "permission", "redistribution")
#: Ends of lines between two blocks; any number of them.
BETWEEN_BLOCKS, LINE_ENDS = r"\n\n+", r"\n+"
#: Texts of several paragraphs, in files named after their SPDX identifiers; how many of their first words they are looked for by.
TEXTS, FIRST = Path(__file__).with_name("license_texts"), 6
#: What ends the terms of a license, before advice on how to apply it.
END_OF_TERMS = "END OF TERMS AND CONDITIONS"
#: Lines that aren't of the license itself: who holds the copyright, with or without a year (unless the terms follow in the same line), and its title.
TERMS_FOLLOW = r"(?![^\n]*(?:permission is hereby|permission to use|redistribution and use|licen[cs]ed under))"
HOLDER_LINE = (
    r"(?m)^[^\p{L}\p{N}\n]*(copyright\b[ \t]*+(\(c\)|©)?+|©)" + TERMS_FOLLOW
    + r"[ \t:]*+(?!(and|in|interest|interests|law|laws|license|licenses|notice|notices|holder|holders|on|or|owner|owners|permission|statement|to|treaty)\b)[^\n]*$"
)
YEAR_LINE = r"(?m)^[^a-z0-9\n]*(copyright|\(c\)|©)" + TERMS_FOLLOW + r"[^\n]*(19|20)[0-9][0-9][^\n]*$"
TITLE_LINE = r"(?m)^ ?((the )?(mit|expat|isc|x11|zlib|boost software|bsd|([023]|two|three|new|modified|simplified|revised) (clause )?bsd)( [a-z0-9]+){0,3}? licen[cs]e( [a-z0-9]{1,7}){0,4}|all rights reserved) ?$"
#: Numbers of the conditions; names that stand for the holder (what comes before them, up to where they go, what all becomes).
CONDITION = r"(?<![^ ])(?:[0-9]|[a-z]|[ivx]{1,3}) (?=redistributions |neither the name)"
NAMES = (
    (r"neither the names? of ", r".+? (?:nor|or) the names of (?:its|any|other|the)(?: other)? contributors", "neither the name of the copyright holder nor the names of its contributors"),
    (r"software is provided by ", r".+? as is", "software is provided by the copyright holders and contributors as is"),
    (r"in no event shall ", r".+? be liable for any direct", "in no event shall the copyright holder or contributors be liable for any direct"),
)


def marked(text: Column) -> Column:
    found = F.contains(text, F.lit(MARKS[0]))
    for mark in MARKS[1:]:
        found |= F.contains(text, F.lit(mark))
    return found


def plain_lines(text: Column) -> Column:
    """Lower case, without copyright lines and punctuation; lines stay apart."""
    out = F.regexp_replace(F.lower(text), COPYRIGHT_LINE, "")
    return F.regexp_replace(F.regexp_replace(out, PUNCTUATION, " "), LINE_END, "\n")


def one_line(lines: Column) -> Column:
    """The canonical form of a text, block or line of ``plain_lines``."""
    out = F.trim(F.regexp_replace(lines, LINE_ENDS, " "))
    for written, becomes in SPELLINGS:
        out = F.replace(out, F.lit(written), F.lit(becomes))
    return out


def canonical(text: Column) -> Column:
    return one_line(plain_lines(text))


def known(spark: SparkSession) -> DataFrame:
    """(license, digest) of the fixed list."""
    return spark.createDataFrame(list(KNOWN), "license string, text string").select("license", F.sha2(canonical(F.col("text")), 256).alias("digest")).distinct()


def units(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, hash, unit, part): the whole text, its blocks and its lines, still as ``plain_lines``, where they hold one of ``MARKS``; ``unit`` numbers them."""
    text = text_of(text_col)
    lines = docs.where(marked(F.lower(text))).select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("hash"), plain_lines(text).alias("lines"))
    parts = F.concat(F.array("lines"), F.split("lines", BETWEEN_BLOCKS), F.split("lines", LINE_ENDS))
    return lines.select("doc_id", "hash", F.posexplode(parts).alias("unit", "part")).where(marked(F.col("part")))


def hits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, hash, unit, license) of the units that are a known license."""
    digest = F.sha2(one_line(F.col("part")), 256)
    found = units(docs, id_col, text_col).select("doc_id", "hash", "unit", digest.alias("digest"))
    return found.join(F.broadcast(known(docs.sparkSession)), "digest").drop("digest")


def bare_lines(text: Column) -> Column:
    """Like ``plain_lines``, but all lines of titles and holders are off."""
    lines = F.regexp_replace(F.regexp_replace(F.lower(text), HOLDER_LINE, ""), YEAR_LINE, "")
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(lines, PUNCTUATION, " "), LINE_END, "\n"), TITLE_LINE, "")


def forms(text: Column) -> Column:
    """The canonical forms of a text without lines of titles and holders, and with them, as they may stand inside other lines; both without numbers of conditions."""
    every = F.regexp_replace(F.regexp_replace(F.lower(text), PUNCTUATION, " "), LINE_END, "\n")
    return F.array_distinct(F.transform(F.array(bare_lines(text), every), lambda x: F.regexp_replace(one_line(x), CONDITION, "")))


def one_holder(form: Column) -> Column:
    """Holders' names of any length made one; each is read from one mention to the next only."""
    for before, name, becomes in NAMES:

        def renamed(part: Column, pattern: str = f"^{before}{name}", becomes: str = becomes) -> Column:
            return F.regexp_replace(part, pattern, becomes)

        form = F.array_join(F.transform(F.split(form, f"(?={before})"), lambda x: renamed(x)), "")
    return form


def known_texts(spark: SparkSession) -> list[tuple[str, str]]:
    """(license, form) of the fixed texts of several paragraphs, with and without what follows the end of their terms."""
    found = []
    for path in sorted(TEXTS.glob("*.txt")):
        name, text = path.name.removesuffix(".txt").removesuffix(".notice"), path.read_text(encoding="utf-8")
        terms, end, _ = text.partition(END_OF_TERMS)
        found += [(name, x) for x in sorted({text, terms, terms + end})]
    texts = spark.createDataFrame(found, "license string, text string")
    each = texts.select("license", F.explode(forms(F.col("text"))).alias("form")).select("license", one_holder(F.col("form")))
    return sorted({(r[0], r[1]) for r in each.collect()})


def marked_texts(docs: DataFrame, id_col: str, text_col: str, **columns) -> DataFrame:
    text = text_of(text_col)
    return docs.where(marked(F.lower(text))).select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("hash"), *[c(text).alias(name) for name, c in columns.items()])


def passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, hash, whole, license) of the known texts of several paragraphs, wherever they stand."""
    texts = known_texts(docs.sparkSession)
    first = {form: " ".join(form.split(" ")[:FIRST]) for _, form in texts}
    start = f"(?<![^ ])(?=(?:{'|'.join(sorted(set(first.values())))})(?: |$))"
    # a known text may hold first words itself, so it takes up to this many pieces
    most, longest = max(len(re.findall(start, form)) for form in first), max(map(len, first))
    rows = [(name, first[form], len(form), hashlib.sha256(form.encode()).hexdigest()) for name, form in texts]
    known_ = docs.sparkSession.createDataFrame(rows, "license string, first string, length int, digest string")
    cut = marked_texts(docs, id_col, text_col, form=lambda text: F.explode(forms(text))).select("doc_id", "hash", F.split("form", start).alias("pieces"))
    joined = F.transform("pieces", lambda x, i: F.array_join(F.slice("pieces", i + 1, F.lit(most)), ""))
    each = cut.select("doc_id", "hash", F.size("pieces").alias("all"), F.posexplode(joined).alias("at", "rest"))
    each = each.where(F.col("rest").rlike(f"^{start}")).withColumn("rest", one_holder(F.col("rest")))
    # one character more than any known text tells whether the last word ends there
    each = each.select("doc_id", "hash", ((F.col("at") == 0) & (F.col("all") <= most)).alias("alone"), F.char_length("rest").alias("reach"), F.substring("rest", 1, longest + 1).alias("rest"))
    found = each.withColumn("first", F.substring_index("rest", " ", FIRST)).join(F.broadcast(known_), "first")
    found = found.where((F.sha2(F.expr("left(rest, length)"), 256) == F.col("digest")) & F.expr("substring(rest, length + 1, 1)").isin("", " "))
    return found.select("doc_id", "hash", (F.col("alone") & (F.col("reach") == F.col("length"))).alias("whole"), "license")


def notices(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, hash, whole, license) of the blocks that are a known notice once lines of titles and holders are off."""

    def blocks(text: Column) -> Column:
        return F.filter(F.transform(F.split(bare_lines(text), BETWEEN_BLOCKS), one_line), lambda x: x != "")

    each = marked_texts(docs, id_col, text_col, blocks=blocks)
    each = each.select("doc_id", "hash", (F.size("blocks") == 1).alias("whole"), F.explode("blocks").alias("form")).where(marked(F.col("form")))
    return each.withColumn("digest", F.sha2("form", 256)).join(F.broadcast(known(docs.sparkSession)), "digest").select("doc_id", "hash", "whole", "license")


def licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, is_license, licenses) of every document: whether the whole text is one, and all that it holds, sorted, comma-joined."""
    both = hits(docs, id_col, text_col).select("doc_id", "hash", (F.col("unit") == 0).alias("whole"), "license")
    both = both.unionByName(passages(docs, id_col, text_col)).unionByName(notices(docs, id_col, text_col))
    found = both.groupBy("doc_id", "hash").agg(F.max("whole").alias("whole"), F.array_join(F.array_sort(F.collect_set("license")), ",").alias("licenses"))
    slim = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text_of(text_col)).alias("_hash"))
    both = slim.join(found, slim["_id"].eqNullSafe(found["doc_id"]) & (slim["_hash"] == found["hash"]), "left")
    return both.select(F.col("_id").alias("doc_id"), F.coalesce("whole", F.lit(False)).alias("is_license"), F.coalesce("licenses", F.lit("")).alias("licenses"))


def oracle() -> str:
    """The same in SQL, from the same fixed values."""

    def quoted(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    def lines(x: str) -> str:
        x = f"regexp_replace(lower({x}), {quoted(COPYRIGHT_LINE)}, '', 'g')"
        return f"regexp_replace(regexp_replace({x}, {quoted(PUNCTUATION)}, ' ', 'g'), {quoted(LINE_END)}, chr(10), 'g')"

    def line(x: str) -> str:
        x = f"trim(regexp_replace({x}, {quoted(LINE_ENDS)}, ' ', 'g'), ' ')"
        for written, becomes in SPELLINGS:
            x = f"replace({x}, {quoted(written)}, {quoted(becomes)})"
        return x

    values = ", ".join(f"({quoted(a)}, {quoted(b)})" for a, b in KNOWN)
    return f"""
        WITH d AS (SELECT doc_id, {lines("coalesce(text, '')")} AS lines FROM documents),
        k AS (SELECT DISTINCT license, {line(lines("t"))} AS form FROM (VALUES {values}) AS v(license, t)),
        u AS (SELECT doc_id, true AS whole, lines AS part FROM d
              UNION ALL SELECT doc_id, false, unnest(regexp_split_to_array(lines, {quoted(BETWEEN_BLOCKS)})) FROM d
              UNION ALL SELECT doc_id, false, unnest(regexp_split_to_array(lines, {quoted(LINE_ENDS)})) FROM d),
        h AS (SELECT doc_id, bool_or(whole) AS whole, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses
              FROM (SELECT doc_id, whole, {line("part")} AS form FROM u) JOIN k USING (form) GROUP BY doc_id)
        SELECT d.doc_id, coalesce(h.whole, false) AS is_license, coalesce(h.licenses, '') AS licenses FROM d LEFT JOIN h USING (doc_id)
    """
