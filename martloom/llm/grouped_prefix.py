"""N-gram Jaccard join: grouped prefix join.

Texts become sets of hashed shingles. All sets are ordered alike, rare shingles first. Two sets of n and m shingles
whose similarity is t or more share one in their prefixes, the first n - ceil(t n) + 1 and m - ceil(t m) + 1, and
from the first one they share, enough must be left in both.

How frequent a shingle is need not be known exactly, as any order gives all pairs: shingles are counted over all texts in a fixed
number of buckets, a table of one megabyte whatever the corpus. A passage, notice or line that a third of all texts
share stands out in it, and comes last.

Equal sets are one node, told by a 128-bit digest. Nodes with identical prefix and size are one group, so the index of
prefix shingles has a row per group and shingle. Group pairs are filtered by size and by the place of their common
shingle, then expanded to members, and members are verified on their full sets. An odd sketch, the parities of 512 bins of
shingles, tells most that differ too much before that, and no others: its distance never exceeds the symmetric difference.

Groups are paired without all their pairs: first each group with the hubs of its shingles, the groups that share most
shingles with others, and each member with the least of its group. What is linked becomes components. Only shingles that several components still share are joined with
themselves, across components, and that join lets only pairs pass that may be linked. Joins are
shuffled joins that adaptive execution splits where a key is hot. What has been done is written to the shared folder before the
next step reads it.

Null and empty texts have no shingles and stand alone. Texts of fewer words than a shingle are one shingle. Rows with equal ids or texts are
linked or not by their texts, row by row. Other columns are not read. An empty table gives no rows. The join is exact up to equal
64-bit hashes of different shingles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.components import components
from martloom.llm.frames import ROW, stored, unpacked, whole
from martloom.llm.minhash_hamming import _confirmed
from martloom.llm.prefix_join import digest, shingles

WORDS = 3
PERCENT = 90
BUCKETS = 1 << 18
#: The table of counts is summed in so many parts.
PARTS = 64
BINS = 512
U = np.uint64


def _buckets(tokens: np.ndarray) -> np.ndarray:
    return (tokens & U(BUCKETS - 1)).astype(np.int64)


def bucket_counts(docs: DataFrame, words: int) -> np.ndarray:
    """How many shingles of all texts fall into each bucket. The driver gets ``BUCKETS`` numbers."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text in batch["text"]:
                np.add.at(total, _buckets(shingles(text, words)), 1)
        yield pd.DataFrame({"part": range(PARTS), "counts": [p.tobytes() for p in np.split(total, PARTS)]})

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(c, np.int64) for c in frame["counts"]], axis=0)
        return pd.DataFrame({"part": frame["part"].iloc[:1], "counts": [total.tobytes()]})

    shape = "part int, counts binary"
    rows = docs.select("text").mapInPandas(count, shape).groupBy("part").applyInPandas(add, shape).collect()
    found = np.zeros(BUCKETS, np.int64)
    for row in rows:
        found[row["part"] * (BUCKETS // PARTS) :][: BUCKETS // PARTS] = np.frombuffer(row["counts"], np.int64)
    return found


def prefix(tokens: np.ndarray, counts: np.ndarray, percent: int) -> np.ndarray:
    """The first shingles of a set, rare buckets first, of which a linked set shares one."""
    size = len(tokens)
    order = np.lexsort((tokens, counts[_buckets(tokens)]))
    return tokens[order[: size - -(-percent * size // 100) + 1]]


def _prefixed(docs: DataFrame, counts: np.ndarray, percent: int, words: int) -> DataFrame:
    """doc_id, n, digests of set and of prefix and size, prefix and odd sketch of every document."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                tokens = shingles(text, words)
                first = prefix(tokens, counts, percent) if len(tokens) else tokens
                odd = np.bincount((tokens >> U(18) & U(BINS - 1)).astype(np.int64), minlength=BINS) & 1
                sketch = np.packbits(odd.astype(np.uint8)).view(np.int64)
                rows.append((doc_id, len(tokens), *digest(tokens), *digest(np.append(first, U(len(tokens)))), first.view(np.int64), sketch))
            yield pd.DataFrame(rows, columns=["doc_id", "n", "d1", "d2", "g1", "g2", "prefix", "odd"]).astype({"doc_id": batch["doc_id"].dtype})

    kind = docs.schema["doc_id"].dataType.simpleString()
    shape = f"doc_id {kind}, n long, d1 long, d2 long, g1 long, g2 long, prefix array<long>, odd array<long>"
    return docs.select("doc_id", "text").mapInPandas(run, shape)


def _sizes(percent: int) -> Column:
    """Whether sizes na and nb leave a link possible."""
    return F.expr(f"least(na, nb) * 100 >= greatest(na, nb) * {percent}")


def _places(percent: int) -> Column:
    """Whether enough is left from the places pa and pb of the first common shingle on."""
    return F.expr(f"least(na - pa, nb - pb) >= ((na + nb) * {percent} + {99 + percent}) DIV {100 + percent}")


def _parities(percent: int) -> Column:
    """Whether the odd sketches oa and ob differ in no more places than linked sets of these sizes."""
    apart = " + ".join(f"bit_count(oa[{i}] ^ ob[{i}])" for i in range(BINS // 64))
    return F.expr(f"({apart}) * {100 + percent} <= (na + nb) * {100 - percent}")


def _star_pairs(index: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Heads of groups with the heads of their hubs, and members with the head of their group, if they may be linked."""
    degrees = index.groupBy("head").agg(F.count("*").alias("degree"))
    ranked = index.join(degrees, "head")
    hubs = ranked.groupBy("token").agg(F.max(F.struct("degree", (-F.col("head")).alias("less"), "n", "at")).alias("hub"))
    fields = [F.col("head").alias("a"), (-F.col("hub.less")).alias("b"), F.col("n").alias("na"), F.col("hub.n").alias("nb")]
    pairs = index.join(hubs, "token").select(*fields, F.col("at").alias("pa"), F.col("hub.at").alias("pb"))
    groups = pairs.filter((F.col("a") != F.col("b")) & _sizes(percent) & _places(percent)).select("a", "b").distinct()
    own = nodes.filter("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b"))
    one = nodes.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("odd").alias("oa"))
    return groups.union(own).join(one, "a").join(one.toDF("b", "nb", "ob"), "b").filter(_parities(percent)).select("a", "b")


def _crossing_pairs(index: DataFrame, nodes: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """Members of groups that share a shingle, in different components, if they may be linked."""
    placed = nodes.select("node", "head").join(roots, "node", "left").select("node", "head", F.coalesce("root", "node").alias("root"))
    ends = placed.groupBy("head").agg(F.min("root").alias("r1"), F.max("root").alias("r2"))
    apart = index.join(ends, "head").groupBy("token").agg(F.min("r1").alias("r1"), F.max("r2").alias("r2")).filter("r1 < r2").select("token")
    alone = ends.filter("r1 < r2").select("head")
    shared = index.join(apart, "token").select("token", "head", "at")
    # Members of a group of several components share all their prefix: its first shingle tells them.
    inner = nodes.join(alone, "head").select(F.col("first").alias("token"), "head", F.lit(0).alias("at")).distinct()
    members = shared.union(inner).distinct().join(placed, "head").join(nodes.select("node", "n", "odd"), "node")
    mixed = stored(members.select("token", "node", "root", "n", "at", "odd"), "prefix-mixed")
    one = mixed.toDF("token", "a", "ra", "na", "pa", "oa")
    two = mixed.toDF("token", "b", "rb", "nb", "pb", "ob")
    across = (F.col("a") < F.col("b")) & (F.col("ra") != F.col("rb"))
    return one.join(two, "token").filter(across & _sizes(percent) & _places(percent) & _parities(percent)).select("a", "b").distinct()


def linked(docs: DataFrame, percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id reachable by links) of each document."""
    found = _prefixed(docs, bucket_counts(docs, words), percent, words)
    rows = stored(found.withColumn("row", F.monotonically_increasing_id()), "prefix-rows")
    # A set's node is its first row, where its prefix stays; only heads of groups have theirs read.
    rows = rows.withColumn("first", F.try_element_at("prefix", F.lit(1)))
    same = [F.first(c).alias(c) for c in ("n", "g1", "g2", "first")] + [F.first(F.col("odd")[i]).alias(f"odd{i}") for i in range(BINS // 64)]
    equal = rows.filter("n > 0").groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"), F.min("row").alias("node"), *same)
    odd = F.array(*[f"odd{i}" for i in range(BINS // 64)]).alias("odd")
    equal = stored(equal.select("node", "rep", "d1", "d2", "n", "g1", "g2", "first", odd), "prefix-sets")
    heads = equal.groupBy("g1", "g2").agg(F.min("node").alias("head"))
    nodes = stored(equal.join(heads, ["g1", "g2"]).select("node", "head", "rep", "d1", "d2", "n", "odd", "first"), "prefix-nodes")

    entries = rows.select(F.col("row").alias("head"), "n", "prefix").join(heads.select("head"), "head", "left_semi")
    entries = entries.select("head", "n", F.posexplode("prefix").alias("at", "token"))
    several = entries.groupBy("token").agg(F.min("head").alias("least"), F.max("head").alias("most")).filter("least < most")
    index = stored(entries.join(several.select("token"), "token").select("token", "head", "n", "at"), "prefix-index")

    stars = stored(_star_pairs(index, nodes, percent), "prefix-stars")
    links = stored(_confirmed(stars, docs, nodes, percent, words), "prefix-links")
    crossing = stored(_crossing_pairs(index, nodes, components(links), percent), "prefix-crossing")
    roots = components(links.union(_confirmed(crossing, docs, nodes, percent, words)))

    named = nodes.select("node", "rep", "d1", "d2").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    labels = named.join(least, "root").select("d1", "d2", "component_id")
    joined = rows.select("doc_id", "n", "d1", "d2").join(labels, ["d1", "d2"], "left")
    return joined.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """One document of each component, the one with the smallest id, with all its columns.

    Rows that repeat both id and text are one row. Rows that repeat the chosen id with other texts stay with it.
    """
    kept = linked(docs, percent, words).filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id").distinct()
    chosen = whole(docs, F.col("doc_id").alias("id"), F.col("text").alias("t"))
    chosen = chosen.join(kept.withColumnRenamed("doc_id", "k"), F.col("id").eqNullSafe(F.col("k")), "left_semi")
    return unpacked(chosen.groupBy("id", F.sha2("t", 256)).agg(F.first(ROW).alias(ROW)), docs.columns)
