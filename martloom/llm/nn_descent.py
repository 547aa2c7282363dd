"""Approximate nearest neighbours: NN-descent builds a neighbour graph, greedy search walks it.

Nearness is the largest inner product. For the graph, vectors get one more component that makes them all as long as the
longest, which turns that order into the order of distances; scores are inner products of the vectors as given, in
double precision.

Equal vectors are one node of the graph, which knows its smallest ``top + 1`` ids: no answer needs more of them. The
graph starts from blocks of rows that lie together under several orders by random hyperplanes; the rows are sorted by
range over all tasks and cut into blocks of fixed size, so no bucket can be overfull. Then rounds of Spark joins look at
neighbours of neighbours: each node meets the neighbours of its neighbours, either side keeps what is nearer than
its farthest neighbour. Behind an edge of an earlier round only fresh edges are followed, as all others were. The reverse of every
edge takes part, so no node's followers need to be gathered. Rounds end when few edges change.

Queries walk the graph from their own node and from the nearest nodes of their blocks under orders that the graph did
not start from: each step expands the nearest nodes not yet expanded and keeps the nearest ``beam`` found, until these
are all expanded. Both loops end by themselves; one that reaches its bound raises. A step is a join with the graph, of ids alone; what is new
to a query gets its vector then. A popular node is a hot join key, which adaptive execution splits. Every step is written to the shared folder. Nothing but counts reaches the driver.

Vectors that are null, zero, or hold null or non-finite components take no part. Nor do those of another length than most
have (the greater of two as common); a warning tells their number.
Repeated rows of one id and vector count once. Extra columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.frames import setting, stored

NEIGHBOURS = 24
TABLES = 4
BLOCK = 256
#: Rounds end when no more than this share of the edges is new.
SETTLED = 0.02
BEAM = 224
EXPANDED = 64
#: Nearest nodes of a query's block, in each order, from which its walk starts too.
ENTRIES = 4
#: Rows of a node beside a neighbour's neighbours that a task compares, and gets, at once.
PART = 512
#: Rounds and steps after which a loop that has not ended is an error.
ROUNDS = 100
STEPS = 1000


def takes_part(vector: Column) -> Column:
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & good & F.exists(vector, lambda x: x != 0)


def nearest_first(partition: str, *ties: str) -> Window:
    return Window.partitionBy(partition).orderBy(F.col("sim").desc(), *ties)


def graph_nodes(vectors: DataFrame, key: str, vector: str, top: int) -> DataFrame:
    """node, vec, long (the added component) and ids of every distinct vector."""
    rows = vectors.select(F.col(key).alias("id"), F.col(vector).cast("array<float>").alias("vec")).filter(takes_part(F.col("vec")))
    sizes = rows.groupBy(F.size("vec").alias("size")).agg(F.count("*").alias("n"))
    usual, total = sizes.agg(F.max(F.struct("n", "size")), F.sum("n")).first()
    if usual and usual["n"] < total:
        warnings.warn(f"{total - usual['n']} of {total} vectors take no part, as they do not have {usual['size']} components", stacklevel=2)
    rows = rows.filter(F.size("vec") == (usual["size"] if usual else 0)).distinct()
    place = F.row_number().over(Window.partitionBy("vec").orderBy("id"))
    few = rows.withColumn("place", place).filter(F.col("place") <= top + 1)
    grouped = few.groupBy("vec").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    square = F.aggregate("vec", F.lit(0.0).cast("double"), lambda s, x: s + x.cast("double") * x)
    nodes = stored(grouped.select(F.monotonically_increasing_id().alias("node"), "vec", "ids", square.alias("square")), "ann-nodes")
    most = nodes.agg(F.max("square")).first()[0] or 0.0
    return nodes.select("node", "vec", "ids", F.sqrt(F.greatest(F.lit(most) - F.col("square"), F.lit(0.0))).alias("long"))


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and counts of a list column."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return array.flatten().to_numpy(zero_copy_only=False), np.diff(array.offsets.to_numpy())


def _first_graph(nodes: DataFrame, k: int, tables: range, block: int) -> DataFrame:
    """u, v and sim of the nearest rows in blocks, under the orders numbered ``tables``."""

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.empty:
                continue
            full = np.column_stack([np.stack(batch["vec"]), batch["long"]]).astype(np.float32)
            for t in tables:
                planes = np.random.default_rng(t).standard_normal((full.shape[1], 31)).astype(np.float32)
                signs = (full @ planes > 0).astype(np.int64)
                codes = signs @ (1 << np.arange(30, -1, -1))
                yield pd.DataFrame({"t": t, "code": codes, "node": batch["node"], "vec": list(full)})

    def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: list[pd.DataFrame] = []
        held = 0
        for batch in batches:
            kept.append(batch)
            held += len(batch)
            if held < 2 * block:
                continue
            rows = pd.concat(kept)
            whole = (held // block - 1) * block
            for start in range(0, whole, block):
                yield best(rows.iloc[start : start + block])
            kept, held = [rows.iloc[whole:]], held - whole
        if held:
            yield best(pd.concat(kept))

    def best(rows: pd.DataFrame) -> pd.DataFrame:
        names, vectors = rows["node"].to_numpy(), np.stack(rows["vec"]).astype(np.float64)
        sims = vectors @ vectors.T
        sims[names[:, None] == names[None, :]] = -np.inf
        n = min(k, len(names) - 1)
        if n < 1:
            return pd.DataFrame({"u": [], "v": [], "sim": []})
        near = np.argpartition(-sims, n - 1, axis=1)[:, :n]
        found = np.take_along_axis(sims, near, axis=1)
        frame = pd.DataFrame({"u": np.repeat(names, n), "v": names[near].ravel(), "sim": found.ravel()})
        return frame[np.isfinite(frame["sim"])]

    coded = nodes.select("node", "vec", "long").mapInPandas(spread, "t int, code long, node long, vec array<float>")
    dealt = coded.repartitionByRange("t", "code", "node").sortWithinPartitions("t", "code", "node")
    return dealt.mapInPandas(compared, "u long, v long, sim double")


def _nearest(edges: DataFrame, k: int) -> DataFrame:
    once = edges.groupBy("u", "v").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh"))
    return once.withColumn("place", F.row_number().over(nearest_first("u", "v"))).filter(F.col("place") <= k).drop("place")


def _adjacency(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """v, its neighbours' ids, vectors and added components, and per neighbour its farthest similarity; the first ``n_new`` edges are fresh."""
    far = edges.groupBy("u").agg(F.min("sim").alias("far"))
    known = nodes.select(F.col("node").alias("v"), "vec", "long").join(far.withColumnRenamed("u", "v"), "v", "left")
    item = F.struct("v", "vec", "long", F.coalesce("far", F.lit(float("-inf"))).alias("far"))
    kinds = [F.collect_list(F.when(kind, item)).alias(name) for name, kind in (("new", F.col("fresh")), ("old", ~F.col("fresh")))]
    grouped = edges.join(known, "v").groupBy("u").agg(*kinds)
    grouped = grouped.select("u", F.size("new").alias("n_new"), F.concat("new", "old").alias("items"))
    return grouped.select(
        F.col("u").alias("v"),
        "n_new",
        F.col("items.v").alias("ws"),
        F.flatten("items.vec").alias("vecs"),
        F.col("items.long").alias("longs"),
        F.col("items.far").alias("fars"),
    )


def _beside(own: DataFrame, around: DataFrame) -> DataFrame:
    """Rows of a node u beside those of a neighbour's neighbours that it has not met: behind an old edge, the fresh ones alone."""

    def unmet(column: str, width: Column) -> Column:
        return F.when(F.col("fresh"), F.col(column)).otherwise(F.slice(column, F.lit(1), F.col("n_new") * width)).alias(column)

    lists = [unmet(c, F.size("vec") if c == "vecs" else F.lit(1)) for c in ("ws", "vecs", "longs", "fars")]
    return own.join(around, "v").filter("fresh OR n_new > 0").select("u", "vec", "long", "far", *lists)


def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches a few rows long: a row holds the vectors of all neighbours, which are compared in double precision."""
    for batch in batches:
        for start in range(0, batch.num_rows, PART):
            yield batch.slice(start, PART)


def _met(rows: DataFrame) -> DataFrame:
    """Candidate edges u, v, sim from rows of a node u beside a neighbour's neighbours: those near enough for a side."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            ws, counts = _lists(batch.column("ws"))
            owner = np.repeat(np.arange(batch.num_rows), counts)
            vec = _lists(batch.column("vec"))[0].reshape(batch.num_rows, -1)
            vecs = _lists(batch.column("vecs"))[0].reshape(len(ws), -1)
            number = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in ("u", "long", "far")}
            longs, fars = (_lists(batch.column(n))[0] for n in ("longs", "fars"))
            sims = np.einsum("ij,ij->i", vec[owner].astype(np.float64), vecs.astype(np.float64)) + number["long"][owner] * longs
            u = number["u"][owner]
            one, two = (u != ws) & (sims > number["far"][owner]), (u != ws) & (sims > fars)
            u, v = np.concatenate([u[one], ws[two]]), np.concatenate([ws[one], u[two]])
            sims = np.concatenate([sims[one], sims[two]])
            frame = pd.DataFrame({"u": u, "v": v, "sim": sims}).drop_duplicates(["u", "v"])
            yield pa.RecordBatch.from_pandas(frame, preserve_index=False)

    return rows.mapInArrow(run, "u long, v long, sim double")


def graph(nodes: DataFrame, k: int = NEIGHBOURS, tables: int = TABLES, block: int = BLOCK, rounds: int = ROUNDS) -> DataFrame:
    """u, v and sim: the nearest k nodes of every node, as far as they are found."""
    start = _first_graph(nodes, k, range(tables), block).withColumn("fresh", F.lit(True))
    edges = stored(_nearest(start.union(start.select(F.col("v").alias("u"), F.col("u").alias("v"), "sim", "fresh")), k), "ann-edges")
    total = edges.count()
    for _ in range(rounds):
        around = _adjacency(edges, nodes)
        far = edges.groupBy("u").agg(F.min("sim").alias("far"))
        own = edges.select("u", "v", "fresh").join(nodes.select(F.col("node").alias("u"), "vec", "long").join(far, "u"), "u")
        met = _met(_beside(own, around))
        seen = edges.withColumn("fresh", F.lit(False))
        edges = stored(_nearest(seen.union(met.withColumn("fresh", F.lit(True))), k), "ann-edges")
        if edges.filter("fresh").count() <= SETTLED * total:
            return edges
    raise RuntimeError(f"edges still change after {rounds} rounds")


def _scored(pairs: DataFrame, queries: DataFrame, vecs: DataFrame) -> DataFrame:
    """q, node and sim of pairs of a query and a node: the inner product of the vectors as given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            one, two = (_lists(batch.column(c))[0].reshape(batch.num_rows, -1).astype(np.float64) for c in ("vec", "other"))
            columns = [batch.column("q"), batch.column("node"), pa.array(np.einsum("ij,ij->i", one, two))]
            yield pa.RecordBatch.from_arrays(columns, ["q", "node", "sim"])

    rows = pairs.join(vecs, "node").join(queries, "q").select("q", "node", "vec", "other")
    return rows.mapInArrow(run, "q long, node long, sim double")


def entered(nodes: DataFrame, starts: DataFrame, k: int = ENTRIES, tables: int = TABLES, block: int = BLOCK) -> DataFrame:
    """q and node: the nearest of each of the nodes ``starts`` (q) in blocks by other orders than those of the graph."""
    near = _first_graph(nodes, k, range(tables, 2 * tables), block).select(F.col("u").alias("q"), F.col("v").alias("node"))
    return near.join(starts, "q", "left_semi").distinct()


def walked(edges: DataFrame, nodes: DataFrame, starts: DataFrame, entries: DataFrame, beam: int = BEAM, steps: int = STEPS) -> DataFrame:
    """q, node and sim: the nearest nodes that greedy search finds for the nodes ``starts`` (q), also from ``entries``."""
    around = stored(edges.groupBy(F.col("u").alias("v")).agg(F.collect_list("v").alias("ws")), "ann-around")
    queries = stored(starts.join(nodes.select(F.col("node").alias("q"), "vec"), "q"), "ann-queries")
    square = F.aggregate("vec", F.lit(0.0).cast("double"), lambda s, x: s + x.cast("double") * x)
    own = queries.select("q", F.col("q").alias("node"), square.alias("sim"))
    vecs = nodes.select("node", F.col("vec").alias("other"))
    others = _scored(entries.filter("q <> node").select("q", "node").distinct(), queries, vecs)
    state = stored(own.union(others).withColumn("done", F.lit(False)), "ann-state")
    for _ in range(steps):
        place = F.row_number().over(Window.partitionBy("q").orderBy("done", F.col("sim").desc(), "node"))
        marked = state.withColumn("next", ~F.col("done") & (place <= EXPANDED))
        frontier = marked.filter("next").select("q", F.col("node").alias("v"))
        # Ids alone tell what is new to a query; only those pairs get vectors.
        met = frontier.join(around, "v").select("q", F.explode("ws").alias("node")).distinct()
        found = _scored(met.join(state.select("q", "node"), ["q", "node"], "left_anti"), queries, vecs)
        known = marked.select("q", "node", "sim", (F.col("done") | F.col("next")).alias("done"))
        both = known.union(found.withColumn("done", F.lit(False)))
        nearest = both.withColumn("place", F.row_number().over(nearest_first("q", "node"))).filter(F.col("place") <= beam)
        state = stored(nearest.drop("place"), "ann-state")
        if state.filter("NOT done").isEmpty():
            return state.select("q", "node", "sim")
    raise RuntimeError(f"nodes are still not expanded after {steps} steps")


def searched(vectors: DataFrame, is_query: Column, top: int = 20, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), key and score of the nearest rows found for each row that is a query."""
    nodes = graph_nodes(vectors, key, vector, top)
    asked = vectors.filter(is_query).select(F.col(key).alias("query_id"), F.col(vector).cast("array<float>").alias("vec"))
    asked = stored(asked.join(nodes.select("vec", F.col("node").alias("q")), "vec").select("query_id", "q").distinct(), "ann-asked")
    starts = asked.select("q").distinct()
    with setting(vectors.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch", str(PART)):
        near = walked(graph(nodes), nodes, starts, entered(nodes, starts))
    members = near.join(nodes.select("node", "ids"), "node").select("q", "sim", F.explode("ids").alias("id"))
    ranked = members.withColumn("place", F.row_number().over(nearest_first("q", "id"))).filter(F.col("place") <= top + 1)
    answers = asked.join(ranked, "q").filter("id <> query_id")
    rank = F.row_number().over(nearest_first("query_id", "id"))
    answers = answers.withColumn("rank", rank.cast("int")).filter(F.col("rank") <= top)
    return answers.select("query_id", "rank", F.col("id").alias(key), F.col("sim").alias("score"))
