"""Packing: shortest-pack-first over the histogram of lengths.

Documents are encoded, closed by one more id, and cut into full sequences and a rest. Only lengths matter to packing:
the driver gets their histogram, at most ``size`` numbers however many documents there are, and places lengths longest
first, each into the pack that is shortest so far, whole patterns at a time with the count of sequences that follow
them. A pattern is a list of lengths; the lengths of all patterns with their counts become intervals of ranks. A
piece finds its sequence by its rank among the pieces of its length: interval, sequence and offset come from one
join with the interval table, whose size depends on the number of lengths, never on the documents.

Ranks are counted in two steps, in small parts of a length and over the sizes of the parts, so a length that a third of
all pieces share is spread over many tasks. Pieces are stored once, without their ids unless asked for, and read again;
every later step is narrow.

Null and empty texts are one closing id. Repeated rows are packed one by one, told apart by a row number. Extra columns
are not read. No documents give no pieces. Very long texts are encoded whole and cut, long runs of blanks
or of one word's letters included.
"""

from __future__ import annotations

import json
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.frames import stored

SIZE = 1024
END = 0
#: How byte-level vocabularies cut a text before merging.
CUTS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Runs of separators from which on the tokenizers library takes a text.
LONG_GAP = re.compile(r"\s{10000}")


class Encoder:
    """Ids of a byte-level BPE file of the tokenizers library.

    The file's vocabulary is run by tiktoken, which yields the same ids in less than half the time. Texts that hold one of the
    file's added tokens or a run of separators that its search for cuts may not get through, and the first text of every task
    as a check, go through the tokenizers library itself.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t["content"] for t in parts.get("added_tokens", [])]
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(shown)]
        byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        vocabulary = {k: v for k, v in parts["model"]["vocab"].items() if k not in self.added}
        ranks = {bytes(byte_of[c] for c in token): i for token, i in vocabulary.items()}
        self.fast = tiktoken.Encoding("file", pat_str=CUTS, mergeable_ranks=ranks, special_tokens={})
        self.verified = False

    def exact(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def ids(self, text: str) -> np.ndarray:
        if any(token in text for token in self.added) or LONG_GAP.search(text):
            return self.exact(text)
        try:
            ids = self.fast.encode_to_numpy(text, disallowed_special=())
        except ValueError:
            return self.exact(text)
        if text and not self.verified:
            if not np.array_equal(ids, self.exact(text)):
                raise ValueError("the two libraries disagree on a text")
            self.verified = True
        return ids


def pieces(docs: DataFrame, path: str, size: int = SIZE, key: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """key, start, length, ids_crc32, doc_tokens and, if asked for, ids of every piece: full ones and a rest."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(path)
        for batch in batches:
            rows: list[tuple] = []
            for name, text in zip(batch[key], batch["text"], strict=True):
                ids = np.append(encoder.ids(text), END).astype("<u4")
                for start in range(0, len(ids), size):
                    part = ids[start : start + size]
                    row = (name, start, len(part), zlib.crc32(part.tobytes()), len(ids))
                    rows.append((*row, part.astype(np.int64)) if with_ids else row)
            names = [key, "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids
            frame = pd.DataFrame(rows, columns=names)
            if batch[key].isna().any():
                frame[key] = frame[key].astype(object).where(frame[key].notna(), None)
            yield frame

    narrow = docs.select(F.col(key), F.coalesce("text", F.lit("")).alias("text"))
    kind = docs.schema[key].dataType.simpleString()
    shape = f"`{key}` {kind}, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<long>" * with_ids
    return narrow.mapInPandas(run, shape)


@dataclass
class Pattern:
    """Lengths of one sequence, and how many sequences have them."""

    lengths: list[int]
    count: int


def patterns(histogram: dict[int, int], size: int = SIZE) -> list[Pattern]:
    """Shortest-pack-first: lengths longest first, each into the shortest pack that is open."""
    open_packs: dict[int, list[Pattern]] = defaultdict(list)
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            used = next((u for u in range(1, size - length + 1) if open_packs[u]), 0)
            if not used:
                open_packs[length].append(Pattern([length], left))
                break
            pack = open_packs[used].pop()
            if pack.count > left:
                open_packs[used].append(Pattern(pack.lengths, pack.count - left))
            taken = min(pack.count, left)
            open_packs[used + length].append(Pattern([*pack.lengths, length], taken))
            left -= taken
    return [p for u in sorted(open_packs) for p in open_packs[u]]


def intervals(found: list[Pattern]) -> list[tuple[int, int, int, int, int]]:
    """length, first rank, end rank, first sequence and offset of every place in every pattern."""
    ranks: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for pattern in found:
        offset = 0
        for length in pattern.lengths:
            rows.append((length, ranks[length], ranks[length] + pattern.count, sequence, offset))
            ranks[length] += pattern.count
            offset += length
        sequence += pattern.count
    return rows


def packed(rows: DataFrame, size: int = SIZE, part_rows: int = 100_000) -> DataFrame:
    """Adds sequence_id and offset to stored pieces with a column ``length`` and a row number ``n``."""
    histogram = {r["length"]: r["c"] for r in rows.groupBy("length").agg(F.count("*").alias("c")).collect()}
    table = intervals(patterns(histogram, size))
    shape = "length long, low long, high long, first long, offset long"
    places = rows.sparkSession.createDataFrame(table, shape)
    parts = max(1, -(-sum(histogram.values()) // part_rows)) * 4
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("n"), F.lit(parts)))
    sizes = dealt.groupBy("length", "part").agg(F.count("*").alias("c"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("length", "part", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("base"))
    inner = dealt.withColumn("at", F.row_number().over(Window.partitionBy("length", "part").orderBy("n")) - 1)
    ranked = inner.join(bases, ["length", "part"]).withColumn("rank", F.col("base") + F.col("at"))
    placed = ranked.join(F.broadcast(places), "length").filter("rank >= low AND rank < high")
    return placed.withColumn("sequence_id", F.col("first") + F.col("rank") - F.col("low"))


def sequences(docs: DataFrame, path: str, size: int = SIZE, key: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """Every piece of every document with its place: key, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    rows = stored(pieces(docs, path, size, key, with_ids).withColumn("n", F.monotonically_increasing_id()), "packing-pieces")
    names = [key, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return packed(rows, size).select(*names, *["ids"] * with_ids)
