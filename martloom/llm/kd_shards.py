"""Sharding by a k-d tree: nodes are split at distributed weighted medians along their widest dimension.

A row's weight is its size in bytes. Each dimension becomes a 62-bit integer: the value's place between the global
minimum and maximum in the upper 31 bits, a hash of the row in the lower 31, so that equal values can be split. A
node that stands for several leaves is cut where the share of its weight that its left leaves are due is reached.

The tree grows level by level, all nodes of a level together. A cut is found by counting weight in ``bins`` equal
bins of the node's range, then in the bin the cut falls in, until the bin holds under ``slack`` of a leaf or one key.
Each pass is one aggregation that combines in the map tasks; the driver receives at most leaves x bins rows of three
numbers, whatever the size of the table. Passes read a narrow stored table (no text), which survives lost executors.

Slots within a shard are numbered in two steps: rows are numbered in small parts of a shard, and parts are offset by
the sizes of the parts before. No task receives a whole shard.

Null texts weigh the 8 bytes of their row and have the checksum of nothing. Null or missing dimension values stand at
zero; repeated rows, even in a third of the table, are told apart by a row number. Extra columns are not read. An
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.frames import stored

HALF = 1 << 31


@dataclass
class Node:
    """A cell of the tree: where its leaves start, how many it stands for, and the cut once it is known."""

    first: int
    leaves: int
    dim: int = 0
    cut: int = 0
    left: Node | None = None
    right: Node | None = None

    def number(self) -> Column:
        """The leaf of a row, as nested comparisons."""
        if self.left is None or self.right is None:
            return F.lit(self.first)
        return F.when(F.col(f"d{self.dim}") < self.cut, self.left.number()).otherwise(self.right.number())


def _place(kind: str, name: str) -> Column:
    """A dimension as a number; text stands by its hash."""
    column = F.col(f"`{name}`")
    return F.crc32(column.cast("binary")).cast("double") if kind in ("string", "binary") else column.cast("double")


def prepared(docs: DataFrame, dims: Sequence[str], key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, size, text_crc32, n (a row number) and a 62-bit integer ``d0``, ``d1``, ... per dimension; stored."""
    content = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    kinds = dict(docs.dtypes)
    narrow = stored(
        docs.select(
            F.col(key),
            (F.octet_length(content) + 8).cast("long").alias("size"),
            F.crc32(content).alias("text_crc32"),
            F.monotonically_increasing_id().alias("n"),
            *[F.coalesce(F.nanvl(_place(kinds[d], d), F.lit(0.0)), F.lit(0.0)).alias(f"p{i}") for i, d in enumerate(dims)],
        ),
        "kd-narrow",
    )
    names = [f"p{i}" for i in range(len(dims))]
    ends = narrow.agg(*[f(c).alias(f"{f.__name__}_{c}") for c in names for f in (F.min, F.max)]).first()

    def scaled(i: int, name: str) -> Column:
        low, high = ends[f"min_{name}"] or 0.0, ends[f"max_{name}"] or 0.0
        share = (F.col(name) - low) / (high - low) if high > low else F.lit(0.0)
        upper = F.least((share * HALF).cast("long"), F.lit(HALF - 1))
        return upper * HALF + F.shiftrightunsigned(F.xxhash64(F.col(key), F.col("n"), F.lit(i)), 33)

    return narrow.select(key, "size", "text_crc32", "n", *[scaled(i, c).alias(f"d{i}") for i, c in enumerate(names)])


def _extents(rows: DataFrame, root: Node, dims: int) -> dict[int, dict]:
    """Rows, weight and the ends of every dimension, by leaf of the tree so far."""
    ends = [f(f"d{i}").alias(f"{n}{i}") for i in range(dims) for n, f in (("low", F.min), ("high", F.max))]
    found = rows.groupBy(root.number().alias("node")).agg(F.sum("size").alias("weight"), F.count("*").alias("rows"), *ends)
    return {r["node"]: r.asDict() for r in found.collect()}


def _cut(rows: DataFrame, root: Node, open_nodes: list[Node], extents: dict[int, dict], dims: int, bins: int, slack: float) -> None:
    """Sets the cut of each open node."""
    todo = {}
    for node in open_nodes:
        seen = extents.get(node.first)
        if seen is None:
            node.dim, node.cut = 0, 0
            continue
        widths = [(seen[f"high{i}"] // HALF - seen[f"low{i}"] // HALF, -i) for i in range(dims)]
        node.dim = -max(widths)[1]
        due = seen["weight"] * (node.leaves // 2) / node.leaves
        todo[node.first] = [node, seen[f"low{node.dim}"], seen[f"high{node.dim}"] + 1, due, seen["weight"] / node.leaves]
    while todo:
        shown = [todo.get(first) for first in range(root.leaves)]
        dim = F.array(*[F.lit(t[0].dim if t else None).cast("int") for t in shown])
        low = F.array(*[F.lit(t[1] if t else None).cast("long") for t in shown])
        step = F.array(*[F.lit(-(-(t[2] - t[1]) // bins) if t else None).cast("long") for t in shown])
        keys = F.array(*[F.col(f"d{i}") for i in range(dims)])
        at = F.col("node")
        ranges = rows.select("size", keys.alias("keys"), root.number().alias("node")).select(
            "node", "size", F.get("keys", F.get(dim, at)).alias("k"), F.get(low, at).alias("low"), F.get(step, at).alias("step")
        )
        binned = ranges.filter("k >= low").withColumn("bin", F.expr("(k - low) DIV step")).filter(F.col("bin") < bins)
        counts: dict[int, dict[int, int]] = {}
        for r in binned.groupBy("node", "bin").agg(F.sum("size").alias("weight")).collect():
            counts.setdefault(r["node"], {})[r["bin"]] = r["weight"]
        for first, (node, lo, hi, due, leaf_weight) in list(todo.items()):
            step_size, before = -(-(hi - lo) // bins), 0
            for chosen, weight in sorted(counts.get(first, {}).items()):
                if before + weight >= due:
                    break
                before += weight
            else:
                chosen, weight = bins - 1, 0
            start = lo + chosen * step_size
            if step_size == 1 or weight <= slack * leaf_weight:
                near_end = abs(before + weight - due) < abs(before - due)
                node.cut = min(start + step_size, hi) if near_end else start
                del todo[first]
            else:
                todo[first] = [node, start, min(start + step_size, hi), due - before, leaf_weight]


def tree(rows: DataFrame, leaves: int, dims: int, bins: int = 1024, slack: float = 0.001) -> Node:
    """The k-d tree of prepared rows."""
    root = Node(0, leaves)
    level = [root] if leaves > 1 else []
    while level:
        extents = _extents(rows, root, dims)
        _cut(rows, root, level, extents, dims, bins, slack)
        below = []
        for node in level:
            half = node.leaves // 2
            node.left, node.right = Node(node.first, half), Node(node.first + half, node.leaves - half)
            below += [n for n in (node.left, node.right) if n.leaves > 1]
        level = below
    return root


def leaves_for(rows: DataFrame, target_bytes: int) -> int:
    """How many leaves it takes for none to be over the target."""
    total = rows.agg(F.sum("size")).first()[0] or 0
    return max(1, -(-total // target_bytes))


def numbered(rows: DataFrame, shard: Column, part_rows: int = 100_000) -> DataFrame:
    """Adds shard and slot, the row's number in its shard, from 0 and without gaps."""
    total = rows.count()
    parts = max(1, -(-total // part_rows))
    placed = rows.withColumn("shard", shard.cast("int")).withColumn("part", F.pmod(F.xxhash64("n"), F.lit(parts)))
    sizes = placed.groupBy("shard", "part").agg(F.count("*").alias("c"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("shard", "part", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("shard", "part").orderBy("n")
    inner = placed.withColumn("inner", F.row_number().over(within) - 1)
    return inner.join(offsets, ["shard", "part"]).withColumn("slot", (F.col("offset") + F.col("inner")).cast("long"))


def sharded(
    docs: DataFrame, dims: Sequence[str], leaves: int | None = None, target_bytes: int | None = None, key: str = "doc_id"
) -> DataFrame:
    """key, size, text_crc32, shard and slot of each document: ``leaves`` shards, or as many as keep to the target."""
    rows = prepared(docs, dims, key)
    if leaves is None:
        leaves = leaves_for(rows, target_bytes or 1 << 30)
    root = tree(rows, leaves, len(dims))
    return numbered(rows, root.number()).select(key, "size", "text_crc32", "shard", "slot")
