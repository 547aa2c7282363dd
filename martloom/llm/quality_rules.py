"""Quality rules, line first: lines that fail are taken out, documents that lose too much text are rejected.

Everything is a row-local expression: one scan, no shuffle, no Python. A document's words and windows are arrays of
its own row, so the size of a source or of a group of copies makes no difference.

A line (between ``\\n``) with at least one word fails when one of these holds:

* punctuation: fewer than ``few_words`` words and no closing punctuation at its end;
* navigation: at least three bars or arrows between entries;
* boilerplate: under ``short_line`` characters, with a phrase of web page furniture or a licence note;
* symbols: more than a tenth of its characters are symbols;
* capitals: at least ten characters, with letters, none of them small.

A document is kept when it passes the base rules and the lines that pass hold at least ``least_share`` percent of its
lines' characters. Windows of three words are compared by 64-bit hash within their document.

Null and empty texts have no words, so they fail the base rules. Repeated rows are judged alike, one by one; columns
besides ``text`` are never read, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.frames import ROW, SPACES, settled, unpacked, whole, words

SPACE_RUN = r"[\x20\x09-\x0D]+"
A_WORD = r"[^\x20\x09-\x0D]"
NO_SYMBOLS = r"[^#*$%&|<>]+"
#: What may close a sentence or a list entry.
CLOSING = (".", "!", "?", ":", ";", ",", "…", "»", "”", '"', "'", ")", "]")
BARS = ("|", ">", "»", "•")
PHRASES = (
    "all rights reserved",
    "licensed under",
    "license, version",
    "released under",
    "privacy policy",
    "terms of use",
    "terms of service",
    "cookie",
    "enable javascript",
    "click here",
    "sign up",
    "log in",
    "lorem ipsum",
)
BOILERPLATE = "(?i)" + "|".join(PHRASES)


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def left_of(text: Column, others: str) -> Column:
    """How many characters are left when ``others``, a pattern of runs, is taken out."""
    return F.length(F.regexp_replace(text, others, "")).cast("long")


def line_fails(line: Column, few_words: int, short_line: int) -> Column:
    trimmed = F.btrim(line, F.lit(SPACES))
    size = F.length(line)
    open_end = ~F.right(trimmed, F.lit(1)).isin(*CLOSING)
    bars = [size - F.length(F.replace(line, F.lit(bar))) >= 3 for bar in BARS]
    return (
        (open_end & (F.size(F.split(trimmed, SPACE_RUN)) < few_words))
        | reduce(Column.__or__, bars)
        | ((size < short_line) & line.rlike(BOILERPLATE))
        | (left_of(line, NO_SYMBOLS) * 10 > size)
        | ((size >= 10) & (line == F.upper(line)) & (line != F.lower(line)))
    )


def _repeated() -> Column:
    """Words covered by windows found twice or more.

    Most texts repeat no window, which the distinct hashes tell; else windows sorted by hash, then place, show it.
    """
    return F.expr(
        "CASE WHEN size(grams) = size(array_distinct(grams)) THEN 0L ELSE aggregate("
        " transform(array(sort_array(transform(grams, (gram, at) -> named_struct('gram', gram, 'at', at)))), s ->"
        "  sort_array(transform(filter(s, (x, j) -> get(s, j - 1).gram <=> x.gram OR get(s, j + 1).gram <=> x.gram), x -> x.at)))[0],"
        " named_struct('n', 0L, 'last', -3),"
        " (a, at) -> named_struct('n', a.n + least(3, at - a.last), 'last', at), a -> a.n) END"
    )


def judged(docs: DataFrame, few_words: int = 10, least_share: int = 50, short_line: int = 200) -> DataFrame:
    """Each document as struct ``_row``, beside it n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed and kept."""
    text = F.coalesce(F.col("text"), F.lit(""))
    parts = whole(docs, text.alias("t")).select(
        ROW,
        words(F.col("t")).alias("w"),
        F.filter(F.split("t", "\n", -1), lambda line: line.rlike(A_WORD)).alias("lines"),
        left_of(F.col("t"), NO_SYMBOLS).alias("n_symbols"),
    )
    grams = F.expr(
        "CASE WHEN size(w) < 3 THEN CAST(array() AS array<bigint>)"
        " ELSE transform(sequence(0, size(w) - 3), i -> xxhash64(w[i], w[i + 1], w[i + 2])) END"
    )
    passing = F.filter("lines", lambda line: ~line_fails(line, few_words, short_line))
    counted = parts.select(
        ROW,
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        grams.alias("grams"),
        F.length(F.array_join("lines", "")).cast("long").alias("all_chars"),
        F.length(F.array_join(passing, "")).cast("long").alias("line_chars"),
    ).withColumn("n_repeat_words", _repeated())
    failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    enough = F.col("line_chars") * 100 >= F.col("all_chars") * least_share
    results = [*map(F.col, MEASURES), failed.alias("base_failed"), (~failed & enough).alias("kept")]
    return counted.select(ROW, settled(*results))


def passing_documents(docs: DataFrame, **options: int) -> DataFrame:
    """The documents that are kept, with all their columns and whole text."""
    return unpacked(judged(docs, **options).filter("kept"), docs.columns)


def cleaned(docs: DataFrame, few_words: int = 10, short_line: int = 200, **options: int) -> DataFrame:
    """The documents that are kept, their failed lines taken out of ``text``."""
    lines = F.filter(
        F.split("text", "\n", -1), lambda line: ~line.rlike(A_WORD) | ~line_fails(line, few_words, short_line)
    )
    kept = passing_documents(docs, few_words=few_words, short_line=short_line, **options)
    return kept.select(*[F.array_join(lines, "\n").alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns])
