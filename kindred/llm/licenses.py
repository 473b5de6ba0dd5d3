"""Licence scans by canonical digest, with Spark's own functions only.

A text is canonical when case, punctuation, copyright statements, a heading that only names the licence and
equivalent spellings no longer matter; its SHA-256 is looked up among those of known licence texts. Short
licences are known by their texts, long ones by the digests of their published files. Whole documents are
looked up, and each of their lines and paragraphs as a text of its own, so that a notice inside a document
is found as well, wrapped or not.

A copyright statement is a line that begins with a copyright sign, or with the word and a sign, a year or a
place for one; a line of running text that begins with the word stays. Phrases of warranty clauses that name
the party differ from file to file and count as equivalent.

Defined results: null and empty texts have no licence. A text that is nothing but copyright statements and
punctuation is empty when canonical and has none. Two known texts with one canonical form are reported
under the smaller name. Texts are read whole, whatever their length. Repeated rows are scanned each for
themselves; other columns are ignored, whatever their names.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch

#: Names and texts of common notices and short licences.
KNOWN_TEXTS = {
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "MIT-notice": "Released under the MIT License.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-notice": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0-notice": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0-notice": "Released under CC0 1.0.",
    "BSD-3-Clause-notice": "Released under the BSD 3-Clause License.",
    "MPL-2.0-notice": "Licensed under the Mozilla Public License, version 2.0.",
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.""",
    "Unlicense": """This is free and unencumbered software released into the public domain.
Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.
In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
For more information, please refer to <https://unlicense.org>""",
}
# two clauses: without the third; older files of the public-domain text name an address without its s
KNOWN_TEXTS["BSD-2-Clause"] = "\n".join(line for line in KNOWN_TEXTS["BSD-3-Clause"].split("\n") if not line.startswith("3."))
UNLICENSE_HTTP = KNOWN_TEXTS["Unlicense"].replace("https", "http")

#: Canonical SHA-256 of the published files of longer licences.
KNOWN_DIGESTS = {
    "836bac26f47a3c14a72b5e6f247732cc5e230182bc5f53ae94acc88705d6bc02": "Apache-2.0",
    "e963bc30f4d3c45f45030c34409ee37315564625649c1394e32bb5ddd99e01b2": "Artistic-1.0-Perl",
    "3745ea0ba8d65edd8f2469f4046b41a07c77e7df7c9269d86b01a0ac6f0f701b": "CC0-1.0",
    "54b490a3575d326211f808dbbcf8e240f9d7ba769c22d0a9e3dbefdf43687e4e": "GFDL-1.2",
    "e87fab80004d4bb955691df4d5643f76ffcc3e55d346624b8ea40d317850fcaf": "GFDL-1.3",
    "95f69ba9d635f183125d2f6d354a1cda31761a231012f139526aaee88a5e0b52": "GPL-1.0",
    "9bc2c94d184338d8ab2a289ffd6d841a82a6f3b7aa98cd2de69e0aeedbf3aa39": "GPL-2.0",
    "cf71b9cdde32013f3afea720706a267753b77b3c666ff219a21f1729db235081": "GPL-3.0",
    "43fa14d27fa80b02bf3ca23596da665db7b6c4be1926922d5edc6b4a67cdaadb": "LGPL-2.0",
    "ae4876bea285fb226943488c4bf7fe5ba878e1496b47f3a4c1f2689fb35cc1f0": "LGPL-2.1",
    "12e6ff7f27e0165356edac322baf4f4d2890ebe909b411365d88a8911b18aae2": "LGPL-3.0",
    "cd8c93e8cda40d570f597b805e8d0fc6d97670d975f8ca514d58027803b51a23": "MPL-1.1",
    "95f6a0d094cf3da6a140310541c7b576789031b600469b70877b34f97918e4c9": "MPL-2.0",
    "e25f5504db9482f6e8e71dae9ee49552ade1470028fff6af9be902b25a24dac2": "Apache-2.0",
}

#: Spellings that count as the second of each pair, after case and punctuation are gone.
SPELLINGS = [
    ("licence", "license"), ("licenced", "licensed"), ("sub license", "sublicense"), ("organisation", "organization"),
    ("organisations", "organizations"), ("authorisation", "authorization"), ("authorised", "authorized"), ("favour", "favor"),
    ("non commercial", "noncommercial"), ("non infringement", "noninfringement"), ("merchantibility", "merchantability"),
    ("per cent", "percent"), ("copyright owner", "copyright holder"), ("copyright owners", "copyright holders"), ("v2 0", "version 2 0"),
    ("acknowledgement", "acknowledgment"), ("and or", "and"),
]
#: Phrases that name the party or number the clause, and what each counts as; read where WARRANTY stands.
WARRANTY = " warranties "
PHRASES = [
    (" neither the names? of [a-z0-9 ]{1,120}? nor the names of (?:its|their|any|the|other) contributors ", " neither the name of the copyright holder nor the names of its contributors "),
    (" this software is provided by [a-z0-9 ]{1,80}? as is ", " this software is provided by the copyright holders and contributors as is "),
    (" in no event shall [a-z0-9 ]{1,80}? be liable ", " in no event shall the copyright holders be liable "),
    (" and [a-z0-9 ]{1,60}? disclaims all warranties ", " and the author disclaims all warranties "),
    (" [0-9a-d] redistributions ", " redistributions "),
    (" [0-9a-d] neither ", " neither "),
]
COPYRIGHT_LINE = r"(?m)^[^a-z0-9\n]*(?:(?:portions )?copyright *(?:\(c\)|©|\(©\)|[:,<\[{]|by |[0-9]{4}\b|[^\n]{1,60}\b(?:19|20)[0-9]{2}\b)|\(c\) |©|all rights reserved\W*$)[^\n]*$"
HEADING = r"^[ \n\f]*(?:the )?(?:mit|isc|zlib|0bsd|(?:new |simplified |modified |revised |[023] clause |zero clause )?bsd|boost software|expat|x11)(?: [a-z0-9]+){0,6}? license(?: [a-z0-9]+){0,8} ?[\n\f]"
MAP_ROWS = 200  # known texts up to which the table is one constant map; beyond, a shuffled join


def canonical_lines(text: Column) -> Column:
    """The canonical form with its line ends kept, and a form feed between paragraphs: lower case, a-z and 0-9 in words
    that one space parts."""
    low = F.lower(F.coalesce(text.cast("string"), F.lit("")))
    low = F.regexp_replace(low, COPYRIGHT_LINE, "")
    low = F.regexp_replace(low, r"[^a-z0-9\n]+", " ")
    low = F.regexp_replace(low, r" ?\n *\n[ \n]*", " \f ")
    low = F.concat(F.lit(" "), F.regexp_replace(low, r" ?\n ?", " \n "), F.lit(" "))
    for old, new in SPELLINGS:
        low = F.replace(low, F.lit(f" {old} "), F.lit(f" {new} "))
    return low


def whole_of(lines: Column) -> Column:
    """The canonical form of a whole text from its canonical lines."""
    line = F.concat(F.lit(" "), F.trim(F.regexp_replace(F.regexp_replace(lines, HEADING, ""), r"[ \n\f]+", " ")), F.lit(" "))
    told = line
    for pattern, phrase in PHRASES:
        told = F.regexp_replace(told, pattern, phrase)
    return F.trim(F.when(F.contains(line, F.lit(WARRANTY)), told).otherwise(line))


def canonical(text: Column) -> Column:
    return whole_of(canonical_lines(text))


def known_digests(spark: SparkSession, texts=None, digests=None) -> DataFrame:
    """digest and licence of each known text, {name: text}, and of each known digest, {digest: name}; both as built in
    unless given."""
    if texts is None and digests is None:
        texts, digests = KNOWN_TEXTS, KNOWN_DIGESTS
    rows = spark.createDataFrame([*sorted((texts or {}).items()), *([("Unlicense", UNLICENSE_HTTP)] if texts is KNOWN_TEXTS else [])], "licence string, text string")
    rows = rows.select(F.sha2(canonical(F.col("text")), 256).alias("digest"), "licence")
    rows = rows.unionByName(spark.createDataFrame(sorted((digests or {}).items()), "digest string, licence string"))
    return rows.groupBy("digest").agg(F.min("licence").alias("licence"))


def scan_licenses(docs: DataFrame, known: DataFrame | None = None, id_col="doc_id", text_col="text") -> DataFrame:
    """One row per document: id, canonical_sha256, licence of the whole text (or null), n_lines: lines and paragraphs of
    several lines that are a known text, and their licences, sorted and joined by commas."""
    spark = docs.sparkSession
    known = (known if known is not None else known_digests(spark)).select("digest", "licence")
    rows = docs.select(F.col(id_col).alias("doc_id"), canonical_lines(F.col(text_col)).alias("lines"))
    rows = rows.withColumn("plain", whole_of(F.col("lines")))
    digest = lambda x: F.sha2(x.cast("binary"), 256)
    lines = F.filter(F.transform(F.split("lines", "[\n\f]"), lambda x: F.trim(x)), lambda x: x != "")
    wrapped = F.filter(F.transform(F.split("lines", "\f"), lambda x: F.trim(F.regexp_replace(x, r"^[ \n]+|[ \n]+$", ""))), lambda x: F.contains(x, F.lit("\n")))
    paragraphs = F.transform(wrapped, lambda x: F.replace(x, F.lit(" \n "), F.lit(" ")))
    rows = rows.select("doc_id", F.when(F.col("plain") != "", F.sha2("plain", 256)).alias("whole"), F.transform(F.concat(lines, paragraphs), digest).alias("digests"))
    if known.limit(MAP_ROWS + 1).count() <= MAP_ROWS:
        # a digest table of checked size is one constant; each document's digests are looked up in place
        names = known.agg(F.map_from_entries(F.collect_list(F.struct("digest", "licence"))).alias("names"))
        whole = rows.join(F.broadcast(known), rows.whole == known.digest, "left").drop("digest").withColumn("names", names.scalar())
        listed = F.array_sort(F.filter(F.transform("digests", lambda d: F.try_element_at("names", d)), lambda x: x.isNotNull()))
        found = whole.select("doc_id", F.col("whole").alias("canonical_sha256"), "licence", listed.alias("listed"))
    else:
        # a larger table meets the digests in a shuffled join; row numbers are written before both sides use them
        rows = Scratch(spark, "licences").save(rows.withColumn("row", F.monotonically_increasing_id()), "rows")
        hits = rows.select("row", F.explode("digests").alias("digest")).join(known, "digest").groupBy("row").agg(F.array_sort(F.collect_list("licence")).alias("listed"))
        found = rows.join(known, rows.whole == known.digest, "left").join(hits, "row", "left")
        found = found.select("doc_id", F.col("whole").alias("canonical_sha256"), "licence", F.coalesce("listed", F.array().cast("array<string>")).alias("listed"))
    return found.select("doc_id", "canonical_sha256", "licence", F.size("listed").cast("long").alias("n_lines"), F.array_join(F.array_distinct("listed"), ",").alias("line_licences"))
