"""MinHash near-dedup: multi-index Hamming join of b-bit signatures.

A text is the set of its hashed shingles of five words. Its signature has 96 symbols, each the lowest 10 bits of one
minimum hash, in 16 chunks of six symbols. Two sets of similarity t differ in a symbol with probability 1 - t, so
``radius`` symbols bound the distance of all pairs that are to be found, but for a share of some 1e-6 of those that lie right
on the threshold. Below that bound nothing is lost: by the pigeonhole principle at least one chunk differs in no more
symbols than its share of the radius, and a text enters one group for every choice of that many symbols to leave out of
a chunk. Pairs of a group pass if the whole signatures lie within the radius, then if the parities of 512 bins of shingles
(an odd sketch, whose distance never exceeds the symmetric difference) allow it, and last if the sets themselves are as
similar as asked for. So every link is confirmed on full sets.

Equal sets are one node, told by a 128-bit digest, so copies cost a row. Groups are worked off without all their pairs:
first every node is compared with the hubs of its groups, the nodes that share most groups with others, a number of
comparisons in proportion to the memberships. What is linked becomes components. Then only groups in which several
components are left are joined with themselves, across components, and the join itself lets pass only pairs within
the radius, in the first chunk they agree in. Joins are shuffled joins that adaptive execution splits where a key is hot. What
has been done is written to the shared folder before the next step reads it.

Null and empty texts have no shingles and stand alone. Texts under five words are one shingle, the whole sequence. Rows with equal
ids or texts are linked or not by their texts, row by row. Other columns are not read. An empty table gives no rows.
Long texts are read whole, their minima taken a thousand shingles at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import sqrt

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.components import components
from martloom.llm.frames import ROW, stored, unpacked, whole
from martloom.llm.prefix_join import digest, shingles

WORDS = 5
PERCENT = 85
CHUNKS = 16
WIDTH = 6
BITS = 10
SYMBOLS = CHUNKS * WIDTH
BINS = 512
#: Standard deviations between the expected distance at the threshold and the radius.
MARGIN = 4.75
ROWS_AT_ONCE = 1024
#: Lowest nine bits of each symbol of a chunk, and the highest one.
LOW_BITS = sum(((1 << BITS - 1) - 1) << BITS * i for i in range(WIDTH))
HIGH_BIT = sum(1 << BITS * i + BITS - 1 for i in range(WIDTH))
U = np.uint64

_random = np.random.default_rng(2024)
FACTORS = _random.integers(0, 1 << 32, SYMBOLS, dtype=np.int64).astype(np.uint32) | np.uint32(1)
SHIFTS = _random.integers(0, 1 << 32, SYMBOLS, dtype=np.int64).astype(np.uint32)


def radius(percent: int) -> int:
    """How many symbols may differ in signatures of sets that are as similar as asked for."""
    apart = 1 - percent / 100
    return int(SYMBOLS * apart + MARGIN * sqrt(SYMBOLS * apart * (1 - apart)))


def allowed_errors(percent: int) -> list[int]:
    """Symbols that may differ in each chunk; -1 for a chunk that need not be looked at.

    If every chunk had more errors than allowed, there would be at least the sum of (allowed + 1), one more than the radius.
    """
    each, more = divmod(radius(percent) + 1, CHUNKS)
    return [each if c < more else each - 1 for c in range(CHUNKS)]


def sketch(tokens: np.ndarray) -> np.ndarray:
    """The chunks of the signature and the parities of a set, as 64-bit numbers."""
    folded = (tokens ^ (tokens >> U(32))).astype(np.uint32)
    least = np.full(SYMBOLS, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(folded), ROWS_AT_ONCE):
        hashes = folded[at : at + ROWS_AT_ONCE, None] * FACTORS + SHIFTS
        hashes ^= hashes >> np.uint32(15)
        hashes *= np.uint32(0x2C1B3C6D)
        np.minimum(least, hashes.min(axis=0), out=least)
    mixed = (least ^ (least >> np.uint32(13))) * np.uint32(0x297A2D39)
    symbols = (mixed >> np.uint32(32 - BITS)).astype(U).reshape(CHUNKS, WIDTH)
    chunks = (symbols << (U(BITS) * np.arange(WIDTH, dtype=U))).sum(axis=1, dtype=U)
    odd = np.bincount((tokens >> U(7) & U(BINS - 1)).astype(np.int64), minlength=BINS) & 1
    return np.concatenate([chunks, np.packbits(odd.astype(np.uint8)).view(U)]).view(np.int64)


def _sketched(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n, d1, d2 and sketch of every document."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                tokens = shingles(text, words)
                rows.append((doc_id, len(tokens), *digest(tokens), sketch(tokens)))
            yield pd.DataFrame(rows, columns=["doc_id", "n", "d1", "d2", "sketch"]).astype({"doc_id": batch["doc_id"].dtype})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInPandas(run, f"doc_id {kind}, n long, d1 long, d2 long, sketch array<long>")


def _group_keys(percent: int) -> Column:
    """The groups of a node: a chunk, and which of its symbols are left out."""
    keys = []
    for chunk, errors in enumerate(allowed_errors(percent)):
        for out in combinations(range(WIDTH), errors) if errors >= 0 else ():
            kept = sum(((1 << BITS) - 1) << BITS * i for i in range(WIDTH) if i not in out)
            keys.append(F.xxhash64(F.lit(chunk), F.lit(sum(1 << i for i in out)), F.col("sketch")[chunk].bitwiseAND(F.lit(kept))))
    return F.array(*keys)


def _errors(chunk: int) -> str:
    """SQL: symbols that differ in a chunk of the sketches sa and sb. Adding carries into the highest bit of a symbol."""
    apart = f"(sa[{chunk}] ^ sb[{chunk}])"
    return f"bit_count((({apart} & {LOW_BITS}L) + {LOW_BITS}L | {apart}) & {HIGH_BIT}L)"


def _near(percent: int) -> Column:
    """Whether sizes, signatures and parities of na, sa and nb, sb leave a link possible."""
    distance = " + ".join(_errors(c) for c in range(CHUNKS))
    parity = " + ".join(f"bit_count(sa[{i}] ^ sb[{i}])" for i in range(CHUNKS, CHUNKS + BINS // 64))
    sizes = f"least(na, nb) * 100 >= greatest(na, nb) * {percent}"
    return F.expr(f"{sizes} AND ({parity}) * {100 + percent} <= (na + nb) * {100 - percent} AND {distance} <= {radius(percent)}")


def _sides(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    one = nodes.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    return one, one.toDF("b", "nb", "sb")


def _hub_pairs(members: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Each node with the hubs of its groups that it may be linked to."""
    degrees = members.groupBy("node").agg(F.count("*").alias("degree"))
    ranked = members.join(degrees, "node")
    hubs = ranked.groupBy("key").agg(F.max(F.struct("degree", (-F.col("node")).alias("less"))).alias("hub"))
    pairs = members.join(hubs, "key").select(F.col("node").alias("a"), (-F.col("hub.less")).alias("b")).filter("a <> b").distinct()
    one, two = _sides(nodes)
    return pairs.join(one, "a").join(two, "b").filter(_near(percent)).select("a", "b")


def _crossing_pairs(members: DataFrame, nodes: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that share a group and may be linked."""
    placed = members.join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    apart = placed.groupBy("key").agg(F.min("root").alias("r1"), F.max("root").alias("r2")).filter("r1 < r2").select("key")
    mixed = placed.join(apart, "key", "left_semi").join(nodes.select("node", "n", "sketch"), "node")
    mixed = stored(mixed.select("key", "node", "root", "n", "sketch"), "minhash-mixed")
    one = mixed.toDF("key", "a", "ra", "na", "sa")
    two = mixed.toDF("key", "b", "rb", "nb", "sb")
    across = (F.col("a") < F.col("b")) & (F.col("ra") != F.col("rb"))
    return one.join(two, "key").filter(across & _near(percent)).select("a", "b").distinct()


def _full_sets(docs: DataFrame, pairs: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """node, n and tokens of all nodes in the pairs, from the text of a document that has the set."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for node, text, d1, d2 in zip(batch["node"], batch["text"], batch["d1"], batch["d2"], strict=True):
                tokens = shingles(text, words)
                if digest(tokens) == (d1, d2):
                    rows.append((node, len(tokens), tokens.view(np.int64)))
            yield pd.DataFrame(rows, columns=["node", "n", "tokens"])

    named = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    wanted = nodes.select("node", "rep", "d1", "d2").join(named, "node")
    texts = docs.select("doc_id", "text").join(wanted, F.col("doc_id").eqNullSafe(F.col("rep")))
    sets = texts.select("node", "text", "d1", "d2").mapInPandas(run, "node long, n long, tokens array<long>")
    return sets.dropDuplicates(["node"])


def _confirmed(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, percent: int, words: int) -> DataFrame:
    """The pairs whose full sets are as similar as asked for."""
    sets = stored(_full_sets(docs, pairs, nodes, words), "minhash-sets")
    one = sets.toDF("a", "na", "ta")
    two = sets.toDF("b", "nb", "tb")
    common = F.size(F.array_intersect("ta", "tb")).alias("c")
    counted = pairs.join(one, "a").join(two, "b").select("a", "b", "na", "nb", common)
    return counted.filter(f"c * 100 >= (na + nb - c) * {percent}").select("a", "b")


def linked(docs: DataFrame, percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable by links) and kept of each document."""
    rows = stored(_sketched(docs, words), "minhash-rows")
    equal = rows.filter("n > 0").groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    nodes = stored(equal.withColumn("node", F.monotonically_increasing_id()), "minhash-nodes")

    keyed = nodes.select("node", F.explode(_group_keys(percent)).alias("key"))
    groups = keyed.groupBy("key").agg(F.min("node").alias("least"), F.max("node").alias("most")).filter("least < most")
    members = stored(keyed.join(groups.select("key"), "key"), "minhash-members")

    stars = stored(_hub_pairs(members, nodes, percent), "minhash-stars")
    links = stored(_confirmed(stars, docs, nodes, percent, words), "minhash-links")
    crossing = _crossing_pairs(members, nodes, components(links), percent)
    crossing = stored(crossing, "minhash-crossing")
    more = _confirmed(crossing, docs, nodes, percent, words)
    roots = components(links.union(more))

    named = nodes.select("node", "rep", "d1", "d2").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    labels = named.join(least, "root").select("d1", "d2", "component_id")
    joined = rows.select("doc_id", "n", "d1", "d2").join(labels, ["d1", "d2"], "left")
    component = F.coalesce("component_id", "doc_id")
    return joined.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def one_of_each(docs: DataFrame, percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """One document of each component, the one with the smallest id, with all its columns.

    Rows that repeat both id and text are one row. Rows that repeat the chosen id with other texts stay with it.
    """
    kept = linked(docs, percent, words).filter("kept").select("doc_id").distinct()
    chosen = whole(docs, F.col("doc_id").alias("id"), F.col("text").alias("t"))
    chosen = chosen.join(kept.withColumnRenamed("doc_id", "k"), F.col("id").eqNullSafe(F.col("k")), "left_semi")
    return unpacked(chosen.groupBy("id", F.sha2("t", 256)).agg(F.first(ROW).alias(ROW)), docs.columns)
