"""Periodic runs of words: Lyndon arrays by Baier's grouping, Lyndon roots extended to runs by common extensions.

A run is a stretch of words with smallest period q and a length of at least max(``shortest``, 3 q) that neither neighbour
extends. For every run, in one of the two orders of words (any order and its inverse), the longest Lyndon word that
starts at some place of it is q words long. So both Lyndon arrays name all candidates (place, length), and a candidate
is a run if its period, extended to the left and to the right, is long enough.

1. **Stretches.** A run of length L holds L - q >= 16 words that recur q words on. So it lies within the words covered by
   16-word windows that occur twice in the text. All windows of a batch are hashed and sorted at once; a stretch of
   covered words holds a run wholly or not at all, and what is not covered is in none. Equal hashes of different windows
   only add words to a stretch.
2. **Lyndon arrays.** Phase one of the grouping suffix sorter: suffixes are grouped by their longest Lyndon prefix found so
   far, at first their first word. Groups are taken from the largest down. When one is taken its prefixes are final. Each of its
   suffixes points at the nearest place before it that is in a smaller group, and each place pointed at has its prefix
   extended by as many copies as suffixes point at it, which moves it to a group just above its own.
3. **Extensions.** Blocks of 1, 2, 4, ... words of a batch are named by rank, exactly; two places are compared block by
   block from the longest down, for all candidates at once.

Texts are split between the rows of a batch: a step works on a bounded number of words, or one text. Memory follows
the longest text. Work is in proportion to the words, with a logarithm for windows and ranks. Null and empty texts have
no words and no runs, and give null for the greatest run. Rows with equal ids or texts are worked on row by row, other columns are not read,
and an empty table gives no rows. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.prefix_join import mixed

SHORTEST = 24
REPEATS = 3
#: A run of ``SHORTEST`` words or ``REPEATS`` periods has this many words that recur one period on.
WINDOW = SHORTEST * (REPEATS - 1) // REPEATS
WORDS_AT_ONCE = 1 << 19
RUNS = "array<struct<start: long, length: long, period: long>>"
U = np.uint64
#: Words of a text by its id.
Words = Callable[[object, list[bytes]], list[bytes]]


def lyndon_array(letters: list[int]) -> list[int]:
    """Length of the longest Lyndon word that starts at each place, by phase one of the grouping suffix sorter."""
    n = len(letters)
    ranked = sorted(set(letters))
    rank = {letter: g for g, letter in enumerate(ranked)}
    group = [rank[letter] for letter in letters]
    members: list[set[int]] = [set() for _ in ranked]
    for place, g in enumerate(group):
        members[g].add(place)
    prefix = [1] * len(ranked)
    below = list(range(-1, len(ranked) - 1))
    above = list(range(1, len(ranked) + 1))
    done = [False] * n
    smaller = [-1] * n
    lengths = [0] * n
    current = len(ranked) - 1
    while current >= 0:
        size = prefix[current]
        counts: dict[int, int] = {}
        for place in sorted(members[current]):
            done[place] = True
            lengths[place] = size
            p = place - 1
            while p >= 0 and done[p]:
                beyond = smaller[p]
                if beyond >= 0 and done[beyond]:
                    beyond = smaller[p] = smaller[beyond]
                p = beyond
            smaller[place] = p
            if p >= 0:
                counts[p] = counts.get(p, 0) + 1
        members[current].clear()
        # Those that take more copies belong to larger groups, and the last group made stands next to the old one.
        moved: dict[tuple[int, int], list[int]] = {}
        for p, copies in counts.items():
            moved.setdefault((copies, group[p]), []).append(p)
        for copies, old in sorted(moved, reverse=True):
            places = moved[copies, old]
            members[old].difference_update(places)
            new = len(members)
            members.append(set(places))
            prefix.append(prefix[old] + copies * size)
            higher = above[old]
            below.append(old)
            above.append(higher)
            below[higher], above[old] = new, new
            for p in places:
                group[p] = new
        current = below[current]
    return lengths


def stretches(letters: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Start and end of what windows that recur in a text cover, for texts that begin at ``starts`` and fill ``letters``."""
    none = np.empty((0, 2), np.int64)
    if len(letters) < WINDOW:
        return none
    hashes, width = letters, 1
    while width < WINDOW:
        step = min(width, WINDOW - width)
        hashes = mixed(hashes[:-step] * U(0x9E3779B97F4A7C15) + hashes[step:] + U(width))
        width += step
    owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    at = np.flatnonzero(owner[: len(hashes)] == owner[WINDOW - 1 :])
    keys = hashes[at] + owner[at].astype(U) * U(0xD6E8FEB86659FD93)
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    found = np.zeros(len(at), bool)
    found[order[1:][same]] = True
    found[order[:-1][same]] = True
    change = np.zeros(len(letters) + 1, np.int64)
    np.add.at(change, at[found], 1)
    np.add.at(change, at[found] + WINDOW, -1)
    covered = np.cumsum(change[:-1]) > 0
    begins = covered.copy()
    begins[1:] &= ~covered[:-1] | (owner[1:] != owner[:-1])
    ends = covered.copy()
    ends[:-1] &= ~covered[1:] | (owner[1:] != owner[:-1])
    return np.stack([np.flatnonzero(begins), np.flatnonzero(ends) + 1], axis=1)


class Extensions:
    """How far two places of a text agree, to the right and to the left, by ranks of blocks of doubling length."""

    def __init__(self, letters: np.ndarray, longest: int):
        self.ranks = [np.unique(letters, return_inverse=True)[1].astype(np.int64)]
        size = 1
        while size * 2 <= longest:
            now = self.ranks[-1]
            pairs = now[:-size] * (int(now.max()) + 1) + now[size:]
            self.ranks.append(np.unique(pairs, return_inverse=True)[1].astype(np.int64))
            size *= 2

    def right(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Length of the longest common beginning of what starts at ``one`` and at ``two``, which lies behind it."""
        total = np.zeros(len(one), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            ranks = self.ranks[k]
            a, b = one + total, two + total
            inside = b < len(ranks)
            total += ((ranks[np.where(inside, a, 0)] == ranks[np.where(inside, b, 0)]) & inside).astype(np.int64) << k
        return total

    def left(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Length of the longest common end of what lies before ``one`` and before ``two``."""
        total = np.zeros(len(one), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            ranks, size = self.ranks[k], 1 << k
            a, b = one - total - size, two - total - size
            inside = (a >= 0) & (b < len(ranks))
            total += ((ranks[np.where(inside, a, 0)] == ranks[np.where(inside, b, 0)]) & inside).astype(np.int64) << k
        return total


def runs_of(letters: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Start, length and period of all runs, ordered by start and period, for texts that begin at ``starts``."""
    spans = stretches(letters, starts)
    if not len(spans):
        return np.empty((0, 3), np.int64)
    sizes = spans[:, 1] - spans[:, 0]
    # Stretches stand behind each other, a separator of its own before each and one at the end.
    offsets = np.cumsum(np.concatenate([[1], sizes + 1]))
    total = int(offsets[-1])
    source = np.arange(total) - np.repeat(np.concatenate([[0], offsets[:-1] - spans[:, 0]]), np.diff(np.concatenate([[0], offsets])))
    values = np.unique(letters[np.clip(source, 0, len(letters) - 1)], return_inverse=True)[1].astype(np.int64)
    separators = np.concatenate([[0], offsets[1:] - 1])
    values[separators] = len(values) + np.arange(len(separators))

    places, periods = [], []
    for start, size in zip(offsets[:-1].tolist(), sizes.tolist(), strict=True):
        own = values[start : start + size].tolist()
        for order in (own, [-v for v in own]):
            places.append(np.arange(start, start + size))
            periods.append(np.array(lyndon_array(order), np.int64))
    place, period = np.concatenate(places), np.concatenate(periods)
    inside = place + period < separators[np.searchsorted(separators, place)]
    place, period = place[inside], period[inside]

    agree = Extensions(values, int(sizes.max()))
    right = agree.right(place, place + period)
    # The first root of a run of three periods agrees with what follows it for one period and more.
    enough = right >= period
    place, period, right = place[enough], period[enough], right[enough]
    left = agree.left(place, place + period)
    length = period + left + right
    long = length >= np.maximum(SHORTEST, REPEATS * period)
    first = place[long] - left[long]
    found = np.unique(np.stack([first, period[long], length[long]], axis=1), axis=0)
    return np.stack([source[found[:, 0]], found[:, 2], found[:, 1]], axis=1)


def plain_words(doc_id: object, words: list[bytes]) -> list[bytes]:
    return words


def _worked(texts: list[list[bytes]]) -> Iterator[tuple[list[tuple[int, int, int]], bytes]]:
    """Runs and collapsed text of each text."""
    starts = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    letters = np.fromiter((xxhash.xxh3_64_intdigest(w) for t in texts for w in t), U, int(starts[-1]))
    runs = runs_of(letters, starts)
    ends = np.searchsorted(runs[:, 0], starts)
    for i, words in enumerate(texts):
        own = runs[ends[i] : ends[i + 1]] - [starts[i], 0, 0]
        kept = words
        if len(own):
            dropped = np.zeros(len(words) + 1, np.int64)
            np.add.at(dropped, own[:, 0] + own[:, 2], 1)
            np.add.at(dropped, own[:, 0] + own[:, 1], -1)
            kept = [words[k] for k in np.flatnonzero(np.cumsum(dropped[:-1]) == 0).tolist()]
        yield [tuple(r) for r in own.tolist()], b" ".join(kept)


def periodic_runs(docs: DataFrame, words: Words = plain_words) -> DataFrame:
    """doc_id, runs (by start, then period) and collapsed of each document.

    ``collapsed`` is what is left, joined by single blanks, when of each run all words but those of its first period are dropped.
    ``words`` may put other words in place of those of a text.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            at, held, size = 0, [], 0
            ids = batch["doc_id"]
            for i, text in enumerate(batch["text"]):
                found = words(None if pd.isna(ids.iloc[i]) else ids.iloc[i], (text or "").encode("utf-8", "surrogatepass").split())
                held.append(found)
                size += len(found)
                if size >= WORDS_AT_ONCE or i == len(batch) - 1:
                    done = list(_worked(held))
                    yield pd.DataFrame({"doc_id": ids.iloc[at : i + 1], "runs": [[{"start": a, "length": b, "period": c} for a, b, c in r] for r, _ in done], "collapsed": [c.decode("utf-8", "surrogatepass") for _, c in done]})
                    at, held, size = i + 1, [], 0

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInPandas(run, f"doc_id {kind}, runs {RUNS}, collapsed string")


def summary(found: DataFrame) -> DataFrame:
    """Number of runs, the one with the greatest exponent, and digests, for rows of ``periodic_runs``."""
    greater = lambda best, run: run["length"] * best["period"] > best["length"] * run["period"]
    best = F.aggregate(F.slice("runs", 2, F.greatest(F.size("runs"), F.lit(1))), F.get("runs", F.lit(0)), lambda best, run: F.when(greater(best, run), run).otherwise(best))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.concat_ws("\n", lines), F.when(F.size("runs") > 0, "\n").otherwise(""))
    named = found.select("doc_id", "runs", "collapsed", best.alias("best"))
    return named.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length DIV best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
