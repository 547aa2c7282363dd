"""Phrase collocations: SETM relational mining over occurrence relations.

A text is cut into pieces at punctuation and line ends, and pieces into words. An occurrence relation has a row for each
place of a language at which a phrase of some length begins. It is persisted in blocks: a block holds a bounded number of
words, or one text, sorted by place, where places of different pieces are never neighbours. A join by piece
and neighbouring position is therefore a merge of two sorted relations inside a block, and moves no rows. One round:

1. **Group and count.** A block names its distinct phrases with their counts. These, not the occurrences, are shuffled by
   phrase; a phrase has a row per block at most, so a frequent one is no hot key. Phrases of ``least`` occurrences or more stay, and get as their
   id the smallest place (block, number) that names them, which is exact and the same whenever it is computed.
2. **Semi-join.** The ids go back to the blocks that named the phrases, and occurrences of other phrases drop out.
3. **Extend.** What is left is merge-joined with the occurrences of frequent words that follow, which gives the relation of
   the next length.

A longer phrase is told by the ids of its beginning and of its last word, so counts are exact. The tables of frequent
phrases are then joined by id: what follows the first word of a phrase is the phrase of that id and the last word.

Null texts are empty; a null language is ``und``. Empty texts and repeated rows count as they are. Ids and other columns are not
read. A text longer than a block is a block of its own. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.frames import stored

LONGEST = 4
LEAST = 30
TOP = 2000
#: Percent of a phrase's occurrences that one longer phrase must hold to make it redundant.
COVERED = 80
#: A cut's score is this times the phrase's count, divided by the counts of both parts.
SCALE = 2_000_000
BLOCK_WORDS = 1 << 21
TOKENS_AT_ONCE = 1 << 17
#: A place of an id: block in the upper bits, number in the block in the lower ones.
NUMBER_BITS = 32
BLOCKS_A_TASK = 1 << 11

_UPPER, _LOWER, _BREAKS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b".,;:!?\n\x0b\x0c\r"
BREAK = b"."
TO_TOKENS = bytes.maketrans(_UPPER + b"\t" + _BREAKS, _LOWER + b" " + BREAK * len(_BREAKS))
RELATION = "block long, lang string, n_words long, at binary, number binary, word_at binary, word_id binary, phrases binary, words binary, counts binary"


def packed(array: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(array).tobytes())


def opened(content: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(content, max_output_size=1 << 33), kind)


def places(at: np.ndarray) -> bytes:
    """Sorted places, as distances."""
    return packed(np.diff(at, prepend=0).astype("<u4"))


def placed(content: bytes) -> np.ndarray:
    return np.cumsum(opened(content, "<u4").astype(np.int64))


def tokens(text: str | None) -> list[bytes]:
    """Lower-cased words, and a break wherever a piece ends. Of blanks only spaces are left, and no word holds a break."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(TO_TOKENS)
    return data.replace(BREAK, b" . ").split()


def _first_relation(block: int, lang: str, parts: list[pa.Array]) -> tuple | None:
    """The occurrences of words of a block. The phrases of the first relation are the words themselves."""
    coded = pa.chunked_array(parts).combine_chunks().dictionary_encode()
    codes, names = coded.indices.to_numpy(), coded.dictionary.to_pylist()
    word = np.array([n != BREAK for n in names], bool)
    # Breaks take a place, so that words on both sides of one are not neighbours.
    at = np.flatnonzero(word[codes])
    if not len(at):
        return None
    number = (np.cumsum(word) - 1)[codes[at]]
    counts = np.bincount(number)
    texts = b"\n".join(n for n in names if n != BREAK)
    return block, lang, len(at), places(at), packed(number.astype("<u4")), b"", b"", texts, b"", packed(counts.astype("<i8"))


def _occurrences(docs: DataFrame, block_words: int) -> DataFrame:
    """Blocks of the relation of single words."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, list[pa.Array]] = {}
        sizes: dict[str, int] = {}
        made = TaskContext.get().partitionId() * BLOCKS_A_TASK
        last = made + BLOCKS_A_TASK

        def keep(lang: str, found: list[bytes]) -> None:
            held.setdefault(lang, []).append(pa.array(found, pa.large_binary()))
            sizes[lang] = sizes.get(lang, 0) + len(found)

        def block(lang: str) -> pd.DataFrame:
            nonlocal made
            if made == last:
                raise ValueError(f"more than {BLOCKS_A_TASK} blocks in a task: raise block_words")
            row = _first_relation(made, lang, held.pop(lang))
            made, sizes[lang] = made + 1, 0
            return pd.DataFrame([row] if row else [], columns=[c.split()[0] for c in RELATION.split(", ")])

        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                found: list[bytes] = []
                for text in texts:
                    found += tokens(text)
                    found.append(BREAK)
                    if len(found) >= TOKENS_AT_ONCE:
                        keep(lang, found)
                        found = []
                        if sizes[lang] >= block_words:
                            yield block(lang)
                keep(lang, found)
        for lang in list(held):
            yield block(lang)

    named = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    return named.mapInPandas(run, RELATION)


def _named(relation: DataFrame, first: bool) -> DataFrame:
    """The distinct phrases of each block, with their place and count."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for block, lang, phrases, words, counts in batch.itertuples(index=False):
                count = opened(counts, "<i8")
                place = (block << NUMBER_BITS) + np.arange(len(count))
                if first:
                    yield pd.DataFrame({"place": place, "lang": lang, "word": phrases.decode("utf-8", "surrogatepass").split("\n"), "count": count})
                else:
                    yield pd.DataFrame({"place": place, "phrase": opened(phrases, "<i8"), "word": opened(words, "<i8"), "count": count})

    shape = "place long, lang string, word string, count long" if first else "place long, phrase long, word long, count long"
    return relation.select("block", "lang", "phrases", "words", "counts").mapInPandas(run, shape)


def _frequent(named: DataFrame, keys: list[str], least: int) -> DataFrame:
    """Places, ids and counts of the phrases that occur often enough."""
    same = Window.partitionBy(*keys)
    counted = named.select("place", *keys, F.sum("count").over(same).alias("f"), F.min("place").over(same).alias("id"))
    return counted.filter(F.col("f") >= least)


def _joined(at: np.ndarray, ids: np.ndarray, word_at: np.ndarray, word_ids: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merge join of phrases of a length with the words that stand right behind them: place, phrase and word."""
    where = np.searchsorted(word_at, at + length)
    there = np.minimum(where, max(0, len(word_at) - 1))
    follows = word_at[there] == at + length if len(word_at) else np.zeros(len(at), bool)
    return at[follows], ids[follows], word_ids[there[follows]]


def _extended(relation: DataFrame, frequent: DataFrame, length: int) -> DataFrame:
    """The relation of phrases one word longer, from the frequent ones of a length."""

    def extend(own: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        columns = [c.split()[0] for c in RELATION.split(", ")]
        if own.empty or known.empty:
            return pd.DataFrame(columns=columns)
        row = own.iloc[0]
        number = opened(row["number"], "<u4").astype(np.int64)
        ids = np.full(int(number.max()) + 1, -1, np.int64)
        ids[(known["place"].to_numpy() & (1 << NUMBER_BITS) - 1)] = known["id"].to_numpy()
        at, held = placed(row["at"]), ids[number]
        at, held = at[held >= 0], held[held >= 0]
        word_at, word_ids = (at, held) if length == 1 else (placed(row["word_at"]), opened(row["word_id"], "<i8"))
        at, phrase, word = _joined(at, held, word_at, word_ids, length)
        if not len(at):
            return pd.DataFrame(columns=columns)
        phrases, phrase_number = np.unique(phrase, return_inverse=True)
        words, word_number = np.unique(word, return_inverse=True)
        pairs, number, counts = np.unique(phrase_number * len(words) + word_number, return_inverse=True, return_counts=True)
        made = (row["block"], row["lang"], row["n_words"], places(at), packed(number.astype("<u4")), places(word_at), packed(word_ids))
        made += (packed(phrases[pairs // len(words)]), packed(words[pairs % len(words)]), packed(counts.astype("<i8")))
        return pd.DataFrame([made], columns=columns)

    known = frequent.select(F.shiftright("place", NUMBER_BITS).alias("block"), "place", "id")
    return relation.groupBy("block").cogroup(known.groupBy("block")).applyInPandas(extend, RELATION)


def mined(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, block_words: int = BLOCK_WORDS) -> tuple[DataFrame, list[DataFrame]]:
    """Words by language, and for each length from 1 the frequent phrases: id, f, and lang and word, or phrase and word."""
    relation = stored(_occurrences(docs, block_words), "setm-words")
    sizes = relation.groupBy("lang").agg(F.sum("n_words").alias("n"))
    levels = []
    for length in range(1, longest + 1):
        keys = ["lang", "word"] if length == 1 else ["phrase", "word"]
        frequent = stored(_frequent(_named(relation, length == 1), keys, least), f"setm-frequent-{length}")
        levels.append(frequent.filter("place = id").select("id", *keys, "f"))
        if length < longest:
            relation = stored(_extended(relation, frequent, length), f"setm-relation-{length + 1}")
    return sizes, levels


def _candidates(levels: list[DataFrame]) -> DataFrame:
    """All frequent phrases of two words or more: id, lang, phrase, f, the counts of their parts, and the phrases inside them.

    ``firsts`` and ``rests`` have the counts of what stands before and behind each cut, ``inside`` the lengths and ids
    of all shorter phrases of two words or more in it, ``tail`` the id of what follows the first word.
    """
    words = levels[0].select(F.col("id").alias("word"), "lang", F.col("word").alias("text"), F.col("f").alias("word_f"))
    none = F.array().cast("array<struct<length: int, id: bigint>>")
    known, found = levels[0].select("id", "lang", F.col("word").alias("phrase"), "f", F.array().cast("array<bigint>").alias("firsts"), none.alias("inside"), F.lit(None).cast("long").alias("tail")), None
    for length, level in enumerate(levels[1:], 2):
        head = known.select(F.col("id").alias("phrase"), "lang", F.col("phrase").alias("head"), F.col("f").alias("head_f"), "firsts", F.col("inside").alias("head_inside"), F.col("tail").alias("head_tail"))
        last = words.select("word", "text", "word_f")
        joined = level.join(head, "phrase").join(last, "word")
        firsts = F.concat("firsts", F.array("head_f"))
        phrase = F.concat_ws(" ", "head", "text").alias("phrase")
        if length == 2:
            # What follows the first of two words is the second.
            made = joined.select("id", "lang", phrase, "f", firsts.alias("firsts"), F.array("word_f").alias("rests"), none.alias("inside"), F.col("word").alias("tail"))
        else:
            # The rest is the phrase whose beginning is the rest of the beginning, with the same last word.
            rest = levels[length - 2].select(F.col("phrase").alias("head_tail"), "word", F.col("id").alias("rest"))
            rests = known.select(F.col("id").alias("rest"), F.col("f").alias("rest_f"), F.col("rests").alias("rest_rests"), F.col("inside").alias("rest_inside"))
            full = joined.join(rest, ["head_tail", "word"]).join(rests, "rest")
            shorter = [F.struct(F.lit(length - 1).alias("length"), F.col(part).alias("id")) for part in ("phrase", "rest")]
            inside = F.array_distinct(F.concat("head_inside", F.array(*shorter), "rest_inside"))
            made = full.select("id", "lang", phrase, "f", firsts.alias("firsts"), F.concat(F.array("rest_f"), "rest_rests").alias("rests"), inside.alias("inside"), F.col("rest").alias("tail"))
        known = stored(made, f"setm-candidates-{length}")
        numbered = known.withColumn("length", F.lit(length))
        found = numbered if found is None else found.union(numbered)
    return found


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, top: int = TOP, block_words: int = BLOCK_WORDS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of the best phrases of each language.

    A phrase of count a scores floor(SCALE * a / (l + r)) at its worst cut into parts of counts l and r; of equal scores, the
    first cut. Phrases that a longer one covers to ``COVERED`` percent are left out.
    """
    sizes, levels = mined(docs, longest, least, block_words)
    phrases = _candidates(levels)
    long = phrases.select(F.col("f").alias("longer_f"), F.inline("inside")).groupBy("length", "id").agg(F.max("longer_f").alias("longer_f"))
    kept = phrases.join(long, ["length", "id"], "left").filter(f"longer_f IS NULL OR 100 * longer_f < {COVERED} * f")
    scored = f"transform(arrays_zip(firsts, rests), (c, k) -> struct((f * CAST({SCALE} AS DECIMAL(20,0))) DIV (c.firsts + c.rests) AS score, k AS k, c.firsts AS l, c.rests AS r))"
    cut = kept.select("lang", "phrase", F.col("f").alias("a"), F.array_min(F.expr(scored)).alias("cut"))
    best = cut.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
