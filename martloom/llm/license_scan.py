"""License scans: canonical digests of whole texts, looked up among the digests of known licences.

A text is made canonical by row-local expressions: small letters, copyright lines out, equivalent spellings made one,
every run of other characters than letters and digits one blank. Its SHA-256 is ``digest``. Known texts are looked up by
another digest, for which a line is out only if it is a notice of copyright (the word with a sign, a year or a place for
one) and a leading title is out too, so that wrapping does not decide it. The same lookup is done for every line as a
text of its own, since notices are a line long.

Every text is made canonical once, with its line feeds kept: no spelling spans lines, and what is left out are whole
lines, so both forms of the text and those of its lines are put together from the canonical lines. A text of
ASCII only is made small by the plain function, and lines are searched for notices only in texts that hold such words.

Known are the constants below and the whole licences of ``licenses.parquet`` beside this module, each as published, with
every paragraph on one line, and all on one line (with notices of copyright inside it or without any; a text on one line
that begins with such a notice is left out whole); those with an appendix also without it. The driver reads that file, as
executors elsewhere do not have it. Only digests and ids move. The known table is stored, so Spark knows its size and takes it to the
lines if it is small; copies of a text share a digest, and a shuffled join splits such a group as it splits any hot key.

Null and empty texts have the digest of the empty text, which is no licence. Rows of one id share the notices of all their
lines.
Extra columns are not read; an empty table gives no rows; a line that matches several known texts names each.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce
from operator import or_
from pathlib import Path

import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm.frames import settled, stored
from martloom.llm.url_filter import LOWER, UPPER

#: Spellings that count as one, in the order in which they are replaced.
SPELLINGS = (
    ("licence", "license"),
    ("sub-license", "sublicense"),
    ("sub license", "sublicense"),
    ("non-infringement", "noninfringement"),
    ("merchantibility", "merchantability"),
    ("acknowledgement", "acknowledgment"),
    ("organisation", "organization"),
    ("favour", "favor"),
    ("https://", "http://"),
    ("&", " and "),
)
COPYRIGHT_LINE = r"(^|\n)[ \t>*#/;-]*(copyright|\(c\)|©|all rights reserved)[^\n]*"
#: Lines that the lookup leaves out: COPYRIGHT_LINE drops any that wrapping lets start with the word.
NOTICE_LINE = r"(^|\n)[ \t>*#/;-]*(copyright[ \t]*(\(c\)|©|[<\[{(]?(yyyy|year|[0-9]{4}))|\(c\)[ \t]*[0-9]{4}|©|all rights reserved)[^\n]*"
TITLE = r"^(the )?((mit|isc|zlib|bsd zero clause|bsd [23] clause( new or revised| simplified)?) license|unlicense)( mit| isc| zlib)?( |$)"
APPENDIX = "END OF TERMS AND CONDITIONS"
OTHERS = r"[^a-z0-9\x{80}-\x{10FFFF}]+"
OTHERS_IN_LINE = r"[^a-z0-9\n\x01\x{80}-\x{10FFFF}]+"
#: What every line that COPYRIGHT_LINE matches holds, and the place where it does.
COPYRIGHT_WORDS = ("copyright", "(c)", "©", "all rights reserved")
COPYRIGHT_PLACE = r"(^|\n)[ \t>*#/;-]*(copyright|\(c\)|©|all rights reserved)"
#: Put before lines that the digest leaves out and the lookup keeps; stray ones become another separator.
MARK, NO_MARK = "\x01", "\x02"
#: How a text that TITLE matches may begin.
TITLE_STARTS = ("the", "mit", "isc", "zli", "bsd", "unl")

#: Texts of licences and one-line notices as they are published.
KNOWN = {
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
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be
held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it
and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If
you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not
required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.""",
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
}


def canonical(text: Column, left_out: str = COPYRIGHT_LINE) -> Column:
    text = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    text = F.regexp_replace(text, left_out, "")
    for spelling, kept in SPELLINGS:
        text = F.replace(text, F.lit(spelling), F.lit(kept))
    return F.trim(F.regexp_replace(text, OTHERS, " "))


def digest(text: Column) -> Column:
    return F.sha2(canonical(text).cast("binary"), 256)


def lookup_digest(text: Column) -> Column:
    return F.sha2(F.regexp_replace(canonical(text, NOTICE_LINE), TITLE, "").cast("binary"), 256)


def published() -> list[tuple[str, str]]:
    """Name and text of every known licence and notice; a name may have several texts."""
    table = pq.read_table(Path(__file__).with_name("licenses.parquet")).to_pydict()
    return sorted([*KNOWN.items(), *zip(table["license"], table["text"], strict=True)])


def layouts(text: str) -> set[str]:
    """A text as it is, with each paragraph on a line, and on one line; also without what follows its terms."""
    found = set()
    for part in {text, text.split(APPENDIX)[0], text.split(APPENDIX)[0] + APPENDIX} if APPENDIX in text else {text}:
        paragraphs = [" ".join(p.split()) for p in re.split(r"\n\s*\n", part)]
        bare = re.sub(NOTICE_LINE, "", part, flags=re.IGNORECASE)
        found |= {part, "\n\n".join(paragraphs), " ".join(paragraphs), " ".join(bare.split())}
    return found


def known_digests(spark: SparkSession, known: Iterable[tuple[str, str]] | None = None) -> DataFrame:
    """digest (for the lookup) and license of each layout of the known names and texts."""
    texts = sorted({(name, t) for name, text in (published() if known is None else known) for t in layouts(text)})
    rows = spark.createDataFrame(texts, "license string, text string")
    found = rows.select(lookup_digest(F.col("text")).alias("digest"), "license").distinct()
    return found.filter(F.col("digest") != F.sha2(F.lit("").cast("binary"), 256))


def small(text: Column) -> Column:
    """Small letters for A-Z alone; texts of ASCII only take the plain function, which is far faster."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def canonical_lines(text: Column) -> Column:
    """The canonical form of small letters with line feeds kept, notices out, and MARK before other lines that
    COPYRIGHT_LINE matches."""
    suspect = reduce(or_, [F.contains(text, F.lit(word)) for word in COPYRIGHT_WORDS])
    marked = F.regexp_replace(F.regexp_replace(text, NOTICE_LINE, ""), COPYRIGHT_PLACE, f"$1{MARK}$2")
    text = F.when(suspect, marked).otherwise(text)
    for spelling, kept in SPELLINGS:
        text = F.replace(text, F.lit(spelling), F.lit(kept))
    return F.regexp_replace(text, OTHERS_IN_LINE, " ")


def untitled_digest(text: Column) -> Column:
    bare = F.when(F.substring(text, 1, 3).isin(*TITLE_STARTS), F.regexp_replace(text, TITLE, "")).otherwise(text)
    return F.sha2(bare.cast("binary"), 256)


def digests(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, digest and sought of every text, and key and sought of every line that is not empty (digest: null)."""
    text = F.replace(F.coalesce("text", F.lit("")), F.lit(MARK), F.lit(NO_MARK))
    texts = docs.select(F.col(key).alias("k"), settled(small(text).alias("text")))
    cleaned = texts.select("k", settled(canonical_lines(F.col("text")).alias("clean")))
    parted = cleaned.select("k", settled(F.transform(F.split("clean", "\n", -1), lambda line: F.trim(line)).alias("lines")))
    plain = F.transform("lines", lambda line: F.trim(F.replace(line, F.lit(MARK), F.lit(""))))
    shown = F.array_join(F.filter("lines", lambda line: (line != "") & ~F.startswith(line, F.lit(MARK))), " ")
    lines = parted.select("k", settled(shown.alias("shown"), F.filter(plain, lambda line: line != "").alias("lines")))
    whole = F.struct(F.sha2(F.col("shown").cast("binary"), 256).alias("digest"), untitled_digest(F.array_join("lines", " ")).alias("sought"))
    each = F.transform("lines", lambda line: F.struct(F.lit(None).cast("string").alias("digest"), untitled_digest(line).alias("sought")))
    return lines.select("k", F.inline_outer(F.concat(F.array(whole), each)))


def scanned(docs: DataFrame, known: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, digest, license (of the whole text, else null), n_notices and notices: the known texts among its lines,
    each once, in order and joined by blanks.

    Lines that are no known text end where they are read; texts and known lines, some hundred bytes each, are stored.
    """
    names = F.array_sort(F.collect_set("license")).alias("names")
    named = stored(known.groupBy(F.col("digest").alias("sought")).agg(names), "license-known")
    hits = digests(docs, key).join(named, "sought", "left").filter("digest IS NOT NULL OR names IS NOT NULL")
    hits = stored(hits.select("k", "digest", "names"), "license-hits")
    texts = hits.filter("digest IS NOT NULL").select(F.col("k").alias(key), "digest", F.array_join("names", " ").alias("license"))
    each = F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_set("names")))), " ")
    found = hits.filter("digest IS NULL").groupBy("k").agg(F.sum(F.size("names")).alias("n_notices"), each.alias("notices"))
    joined = texts.join(found, F.col(key).eqNullSafe(F.col("k")), "left")
    return joined.select(key, "digest", "license", F.coalesce("n_notices", F.lit(0)).alias("n_notices"), F.coalesce("notices", F.lit("")).alias("notices"))
