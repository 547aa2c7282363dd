from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from martloom.llm import nn_descent
from martloom.llm.queries import QUERIES

SHAPE = "vec_id long, embedding array<float>, label int, node string, sim string"


def answers(rows):
    found = {}
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return found


def test_recall_against_brute_force(spark):
    sf_dir = "/root/testdata/sf0.01"
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").toPandas()
    ids, vectors = table["vec_id"].to_numpy(), np.stack(table["embedding"]).astype(float)
    found = answers(QUERIES["op6_nn_descent"].build(spark, sf_dir).collect())
    hits = total = 0
    for at in np.flatnonzero(ids % 20 == 0):
        scores = vectors @ vectors[at]
        scores[at] = -np.inf
        best = ids[np.lexsort((ids, -scores))[:20]]
        got = found[ids[at]]
        hits += len(set(best) & {i for i, _ in got})
        total += 20
        for i, score in got:
            assert abs(score - float(vectors[ids == i][0] @ vectors[at])) < 1e-9
        assert [i for i, _ in got] == [i for i, s in sorted(got, key=lambda g: (-g[1], g[0]))]
    assert hits >= 0.9 * total


def test_copies_ties_and_unfit_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [1.0, 0.0, 0.0], 0, "x", "y") for i in range(60)]
    rows += [(100 + i, [float(x) for x in rng.standard_normal(3)], 0, "x", "y") for i in range(40)]
    rows += [(200, None, 0, "", ""), (220, [0.0, 0.0, 0.0], 0, "", ""), (240, [1.0, None, 1.0], 0, "", ""), (260, [float("nan"), 1.0, 1.0], 0, "", "")]
    rows += [(280, [float("inf"), 1.0, 1.0], 0, "", ""), (300, [], 0, "", ""), (320, [1.0], 0, "", ""), (0, [1.0, 0.0, 0.0], 0, "", "")]
    found = answers(nn_descent.searched(spark.createDataFrame(rows, SHAPE), F.col("vec_id") % 20 == 0).collect())
    assert set(found) == {0, 20, 40, 100, 120}
    good = {i: np.array(v, np.float32).astype(float) for i, v, *_ in rows if i < 200}
    for q, got in found.items():
        want = sorted(((-float(v @ good[q]), i) for i, v in good.items() if i != q))[:20]
        assert [i for i, _ in got] == [i for _, i in want]


def test_few_and_no_vectors(spark):
    three = spark.createDataFrame([(0, [1.0, 2.0], 0, "", ""), (1, [2.0, 1.0], 0, "", ""), (2, [-1.0, 0.0], 0, "", "")], SHAPE)
    assert [i for i, _ in answers(nn_descent.searched(three, F.col("vec_id") % 20 == 0).collect())[0]] == [1, 2]
    assert nn_descent.searched(three.limit(1), F.col("vec_id") % 20 == 0).collect() == []
    assert nn_descent.searched(three.limit(0), F.col("vec_id") % 20 == 0).collect() == []


def test_rounds_go_on_until_few_edges_change(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.standard_normal(8)], 0, "", "") for i in range(400)]
    nodes = nn_descent.graph_nodes(spark.createDataFrame(rows, SHAPE), "vec_id", "embedding", 20)
    with pytest.raises(RuntimeError):
        nn_descent.graph(nodes, k=8, tables=2, block=16, rounds=1)


def test_walk_goes_on_until_all_is_expanded(spark):
    last = 11
    nodes = spark.createDataFrame([(i, [1.0 + i, 0.0], [i], 0.0) for i in range(last + 4)], "node long, vec array<float>, ids array<long>, long double")
    chain = [(i, i + 1, float(i), False) for i in range(last)] + [(last + 2, last + 3, 0.0, False)]
    edges = spark.createDataFrame(chain, "u long, v long, sim double, fresh boolean")
    starts = spark.createDataFrame([(0,)], "q long")
    entries = spark.createDataFrame([(0, last + 2)], "q long, node long")
    found = nn_descent.walked(edges, nodes, starts, entries.limit(0)).collect()
    assert {r["node"]: r["sim"] for r in found} == {i: 1.0 + i for i in range(last + 1)}
    found = nn_descent.walked(edges, nodes, starts, entries).collect()
    assert {r["node"] for r in found} == {*range(last + 1), last + 2, last + 3}
    with pytest.raises(RuntimeError):
        nn_descent.walked(edges, nodes, starts, entries, steps=3)


def test_only_what_has_not_met_is_compared(spark):
    nodes = spark.createDataFrame([(i, [float(i), 1.0], 0.5) for i in range(5)], "node long, vec array<float>, long double")
    edges = spark.createDataFrame([(1, 2, 1.0, False), (1, 3, 2.0, True), (4, 2, 1.0, False)], "u long, v long, sim double, fresh boolean")
    own = spark.createDataFrame([(0, 1, False), (2, 1, True), (0, 4, False)], "u long, v long, fresh boolean")
    own = own.join(nodes.selectExpr("node AS u", "vec", "long"), "u").withColumn("far", F.lit(0.0))
    found = {r["u"]: r for r in nn_descent._beside(own, nn_descent._adjacency(edges, nodes)).collect()}
    assert found[0]["ws"] == [3] and found[0]["vecs"] == [3.0, 1.0] and len(found[0]["longs"]) == len(found[0]["fars"]) == 1
    assert found[2]["ws"] == [3, 2] and found[2]["vecs"] == [3.0, 1.0, 2.0, 1.0] and len(found) == 2


def test_a_walk_scores_a_pair_once(spark, monkeypatch):
    seen, scored = [], nn_descent._scored

    def watched(pairs, queries, vecs):
        seen.extend((r["q"], r["node"]) for r in pairs.select("q", "node").collect())
        return scored(pairs, queries, vecs)

    monkeypatch.setattr(nn_descent, "_scored", watched)
    nodes = spark.createDataFrame([(i, [1.0 + i, 0.0]) for i in range(6)], "node long, vec array<float>")
    ring = [(i, (i + d) % 6, 1.0, False) for i in range(6) for d in (1, 2)]
    edges = spark.createDataFrame(ring, "u long, v long, sim double, fresh boolean")
    starts = spark.createDataFrame([(0,), (3,)], "q long")
    found = nn_descent.walked(edges, nodes, starts, spark.createDataFrame([(0, 5)], "q long, node long")).collect()
    assert {(r["q"], r["node"]): r["sim"] for r in found} == {(q, i): (1.0 + q) * (1 + i) for q in (0, 3) for i in range(6)}
    assert sorted(seen) == sorted((q, i) for q in (0, 3) for i in range(6) if i != q)


def test_one_longer_vector_does_not_remove_the_others(spark):
    rows = [(i, [1.0 + i, 2.0], 0, "", "") for i in range(4)] + [(9, [1.0, 2.0, 3.0], 0, "", "")]
    with pytest.warns(UserWarning, match="1 of 5 vectors"):
        nodes = nn_descent.graph_nodes(spark.createDataFrame(rows, SHAPE), "vec_id", "embedding", 20)
    assert sorted(r["ids"] for r in nodes.collect()) == [[0], [1], [2], [3]]


def test_few_rows_are_compared_at_once():
    batch = pa.RecordBatch.from_pydict({"ws": [[i, i + 1] for i in range(1300)]})
    found = list(nn_descent.parts(iter([batch, batch.slice(0, 0)])))
    assert [b.num_rows for b in found] == [512, 512, 276]
    values, counts = nn_descent._lists(found[2].column("ws"))
    assert values[0] == 1024 and len(values) == counts.sum() == 552
