"""Quality classifier: Bradley-Terry ranking learned from preference pairs, cut at a score quantile.

A pair says that a document labelled 1 is preferred to one labelled 0. The strength of a document is linear in its
features, so the chance of a preference is the logistic function of the weighted difference of two documents'
features; the weights minimise the logistic loss over all pairs, with a small ridge term.

All labelled documents that are not held out take part. They are ordered by a hash of their id and numbered by kind; every one
of the more frequent kind is paired with ``per_row`` of the other, in turn, so that all of both take part evenly. The
differences are written once; a Newton step sums gradient and curvature over them in the tasks, and the driver gets
those sums alone, one row of numbers a task. Every document is then scored in a single scan by row-local expressions;
labels, lang, source and doc_id are not among the features.

The cut: training scores are ranked, and the quantile that leaves as large a share above it as carries label 1 is
put at ``threshold``. Scores are probabilities by the logistic function of the distance to it.

Null and empty texts have all features zero and are scored like any other. A document labelled more than once counts
once, with the highest label; labels that are null or belong to no document are left out. Without documents of both
labels every score is 0.5. Repeated rows get equal scores. Extra columns are not read. No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.frames import ROW, settled, stored, unpacked, whole, words
from martloom.operators.outliers import percentiles

PAIRS_PER_ROW = 4
FOLDS = 5


def held_out(key: Column) -> Column:
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def features(text: Column, tokens: Column, lines: Column) -> dict[str, Column]:
    """Eleven measures of a text; ``tokens`` are its words, ``lines`` its lines."""
    size = F.greatest(F.length(text), F.lit(1)).cast("double")
    n = F.greatest(F.size(tokens), F.lit(1)).cast("double")
    kept = F.greatest(F.size(lines), F.lit(1)).cast("double")

    def share(others: str) -> Column:
        return F.length(F.regexp_replace(text, others, "")) / size

    return {
        "symbols": share(r"[^#*$%&|<>]+"),
        "capitals": share(r"[^\p{Lu}]+"),
        "digits": share(r"[^0-9]+"),
        "shouts": share(r"[^!?]+"),
        "stops": share(r"[^.]+"),
        "letters": share(r"[^\p{L}]+"),
        "log_words": F.log1p(F.size(tokens).cast("double")),
        "word_length": F.length(text) / n / 10,
        "distinct_words": F.size(F.array_distinct(tokens)) / n,
        "distinct_lines": F.size(F.array_distinct(lines)) / kept,
        "line_length": F.log1p(F.length(text) / kept),
    }


@dataclass
class Ranking:
    """Weights on scaled features, and the raw score that stands at the threshold."""

    names: list[str]
    weights: np.ndarray
    means: np.ndarray
    scales: np.ndarray
    cut: float = 0.0
    threshold: float = 0.5
    shown: dict = field(default_factory=dict)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.means) / self.scales) @ self.weights

    def score(self, columns: dict[str, Column]) -> Column:
        """The score of a row, from its features."""
        raw = F.lit(-self.cut + float(np.log(self.threshold / (1 - self.threshold))))
        for name, w, m, s in zip(self.names, self.weights, self.means, self.scales, strict=True):
            raw = raw + (columns[name] - float(m)) * float(w / s)
        return 1 / (1 + F.exp(-raw))


def preference_pairs(labels: np.ndarray, per_row: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of preferred and of other rows: each of the more frequent kind with ``per_row`` of the other, in turn."""
    good, bad = np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)
    if not len(good) or not len(bad):
        return good[:0], bad[:0]
    turn = np.arange(per_row * max(len(good), len(bad)))
    one, two = (good, bad) if len(good) >= len(bad) else (bad, good)
    one, two = one[turn // per_row], two[turn % len(two)]
    return (one, two) if len(good) >= len(bad) else (two, one)


def newton_sums(diff: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Number of differences, gradient of their logistic loss and its curvature, in one row."""
    chance = 1 / (1 + np.exp(-np.clip(diff @ weights, -30, 30)))
    curvature = (diff * (chance * (1 - chance))[:, None]).T @ diff
    return np.concatenate([[len(diff)], diff.T @ (chance - 1), curvature.ravel()])


def newton(k: int, sums_at: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The weights that minimise the loss with its ridge term, given the sums over all differences at any weights."""
    weights = np.zeros(k)
    for _ in range(25):
        sums = sums_at(weights)
        ridge = 1e-3 * sums[0] * np.eye(k)
        step = np.linalg.solve(sums[1 + k :].reshape(k, k) + ridge, sums[1 : 1 + k] + ridge @ weights)
        weights = weights - step
        if np.abs(step).max() < 1e-6:
            break
    # The order in which tasks add up leaves no trace.
    return np.round(weights, 9)


def fit(x: np.ndarray, labels: np.ndarray, names: list[str], threshold: float, per_row: int = PAIRS_PER_ROW) -> Ranking:
    """The ranking of rows in memory, in the order given; ``learned`` is the same over a table."""
    good, bad = preference_pairs(labels, per_row)
    model = Ranking(names, np.zeros(len(names)), np.zeros(len(names)), np.ones(len(names)))
    if not len(good):
        return model
    model.means, model.scales = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
    diff = (x[good] - x[bad]) / model.scales
    model.weights = newton(len(names), lambda weights: newton_sums(diff, weights))
    model.cut = float(np.quantile(model.raw(x), 1 - float((labels == 1).mean())))
    model.threshold = threshold
    return model


def _measured(docs: DataFrame) -> tuple[DataFrame, dict[str, Column]]:
    text = F.coalesce(F.col("text"), F.lit(""))
    parts = whole(docs, text.alias("t"), words(text).alias("w"), F.split(text, "\n", -1).alias("lines"))
    return parts, features(F.col("t"), F.col("w"), F.col("lines"))


def _labelled(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, list[str]]:
    """label, features ``x`` and place in the order of hashes, of every labelled document that is not held out.

    Texts are measured where they are read; what is shuffled is a row of numbers.
    """
    known = labels.filter(~held_out(F.col("doc_id")) & F.col("quality").isNotNull())
    known = known.groupBy("doc_id").agg(F.max("quality").alias("label"))
    parts, columns = _measured(docs.select("doc_id", "text"))
    rows = parts.select(F.col(f"{ROW}.doc_id").alias("doc_id"), F.array(*columns.values()).alias("x"))
    rows = rows.join(known, "doc_id").groupBy("doc_id").agg(F.max("label").alias("label"), F.min("x").alias("x"))
    order = ["label", F.xxhash64("doc_id"), "doc_id"]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(dealt.select("label", "x", F.monotonically_increasing_id().alias("at")), "quality-rows"), list(columns)


def _differences(rows: DataFrame, counts: dict[int, int], per_row: int) -> DataFrame:
    """Features of preferred documents less those of others, pairs as in ``preference_pairs``."""
    task = F.shiftright("at", 33)
    starts = rows.groupBy("label", task.alias("task")).agg(F.min("at").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy("label").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    # One row per task and label.
    starts = starts.select("label", "task", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("less"))
    numbered = rows.withColumn("task", task).join(F.broadcast(starts), ["label", "task"])
    numbered = numbered.select("label", "x", (F.col("at") + F.col("less")).alias("place"))
    many = 1 if counts[1] >= counts[0] else 0
    turns = F.explode(F.sequence(F.col("place") * per_row, F.col("place") * per_row + (per_row - 1)))
    ones = numbered.filter(F.col("label") == many).select("x", turns.alias("turn"))
    ones = ones.select(F.col("x").alias("one"), (F.col("turn") % counts[1 - many]).alias("place"))
    twos = numbered.filter(F.col("label") == 1 - many).select(F.col("x").alias("two"), "place")
    sign = 1 if many == 1 else -1
    return ones.join(twos, "place").select(F.zip_with("one", "two", lambda a, b: (a - b) * sign).alias("diff"))


def learned(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, per_row: int = PAIRS_PER_ROW) -> Ranking:
    """The ranking fitted on all labelled documents that are not held out."""
    rows, names = _labelled(docs, labels)
    k = len(names)
    model = Ranking(names, np.zeros(k), np.zeros(k), np.ones(k))
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not counts.get(0) or not counts.get(1):
        return model
    spread = [f(F.col("x")[i]) for f in (F.avg, F.stddev_pop) for i in range(k)]
    found = np.array(rows.agg(*[c.alias(f"c{i}") for i, c in enumerate(spread)]).first(), float)
    # Ten digits, as the order in which tasks add up leaves no trace in these.
    found = np.array([float(f"{v:.9e}") for v in found])
    model.means, model.scales = found[:k], np.maximum(found[k:], 1e-6)
    pairs, scales = stored(_differences(rows, counts, per_row), "quality-pairs"), model.scales

    def sums_at(weights: np.ndarray) -> np.ndarray:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = 0.0
            for batch in batches:
                if len(batch):
                    total = total + newton_sums(np.stack(batch["diff"]) / scales, weights)
            yield pd.DataFrame({"sums": [total] if np.ndim(total) else []})

        rows = pairs.mapInPandas(run, "sums array<double>").collect()
        return np.sum([r["sums"] for r in rows], axis=0)

    model.weights = newton(k, sums_at)
    raw = sum(((F.col("x")[i] - float(model.means[i])) * float(model.weights[i] / scales[i]) for i in range(k)), F.lit(0.0))
    model.cut = percentiles(rows.select(raw.alias("raw")), "raw", [1 - counts[1] / sum(counts.values())])[0]
    model.threshold = threshold
    return model


def scored(docs: DataFrame, model: Ranking) -> DataFrame:
    """Each document as struct ``_row``, and its score."""
    parts, columns = _measured(docs)
    return parts.select(ROW, settled(model.score(columns).alias("score")))


def chosen_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The documents that score at least the threshold, with all their columns."""
    model = learned(docs, labels, threshold)
    return unpacked(scored(docs, model).filter(F.col("score") >= threshold), docs.columns)
