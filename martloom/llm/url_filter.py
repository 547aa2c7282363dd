"""URL filters: all glob rules at once by a bit-parallel wildcard automaton (Shift-And over several 64-bit words).

A glob is matched against the whole canonical url, that is host (A-Z in small letters) and path. ``*`` stands for any
run of characters but ``/``, ``**`` for any run at all, ``?`` for one character but ``/``. Each literal of each rule owns
one bit. Reading a character moves every bit on by one where the character fits; a star keeps its bit alive. So one
pass over a url simulates every rule, whatever their number: the state is a row of 64-bit words.

Urls of a batch advance together, one character column at a time, ordered by length so that short ones drop out.
The scan reads the two url columns only and shuffles nothing, hence no key can be hot.

A null url, or one without ``://``, has an empty host and path; no rule fits it and the default verdict holds, which
is ``block`` for an empty host. Repeated rows are judged alike. Other columns are not read. No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """A host with all its subdomains, and the start of a path."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path

    @property
    def globs(self) -> tuple[str, str]:
        return f"{self.name}**", f"*.{self.name}**"


class Automaton:
    """Shift-And masks of a list of globs.

    Bits run through all globs one after the other, a start bit before each. ``step[b]`` has the bits that byte ``b``
    may enter, ``stay[b]`` those whose star lets byte ``b`` pass.
    """

    def __init__(self, globs: Sequence[str]):
        starts, ends, enter, loops = [], [], [], []
        for glob in globs:
            starts.append(len(enter))
            enter.append(None)
            loops.append(set())
            raw, i = glob.encode(), 0
            while i < len(raw):
                if raw[i] == ord("*"):
                    deep = raw[i : i + 2] == b"**"
                    loops[-1] |= set(range(256)) if deep else set(range(256)) - {ord("/")}
                    i += 1 + deep
                    continue
                enter.append(set(range(256)) - {ord("/")} if raw[i] == ord("?") else {raw[i]})
                loops.append(set())
                i += 1
            ends.append(len(enter) - 1)
        self.words = (len(enter) + 63) // 64
        self.step = np.zeros((256, self.words), np.uint64)
        self.stay = np.zeros((256, self.words), np.uint64)
        for bit, (into, loop) in enumerate(zip(enter, loops, strict=True)):
            for byte in into or ():
                self.step[byte, bit // 64] |= np.uint64(1 << bit % 64)
            for byte in loop:
                self.stay[byte, bit // 64] |= np.uint64(1 << bit % 64)
        self.start = np.zeros(self.words, np.uint64)
        for bit in starts:
            self.start[bit // 64] |= np.uint64(1 << bit % 64)
        self.ends = [(bit // 64, np.uint64(bit % 64)) for bit in ends]

    def matches(self, texts: Sequence[bytes], block: int = 4_000_000) -> np.ndarray:
        """A row of booleans for each text: which globs match it."""
        found = np.zeros((len(texts), len(self.ends)), bool)
        sizes = np.array([len(t) for t in texts], np.int64)
        order = np.argsort(-sizes, kind="stable")
        at = 0
        while at < len(order):
            longest = max(int(sizes[order[at]]), 1)
            rows = order[at : at + max(1, block // longest)]
            found[rows] = self._run([texts[i] for i in rows], sizes[rows])
            at += len(rows)
        return found

    def _run(self, texts: list[bytes], sizes: np.ndarray) -> np.ndarray:
        """Texts come longest first, so those still being read are always a leading slice."""
        width = int(sizes[0])
        chars = np.frombuffer(b"".join(t.ljust(width, b"\0") for t in texts), np.uint8).reshape(len(texts), width)
        state = np.tile(self.start, (len(texts), 1))
        alive = np.searchsorted(-sizes, -np.arange(width), side="left")
        one, top = np.uint64(1), np.uint64(63)
        for column, live in enumerate(alive):
            now, byte = state[:live], chars[:live, column]
            moved = now << one
            moved[:, 1:] |= now[:, :-1] >> top
            state[:live] = (moved & self.step[byte]) | (now & self.stay[byte])
        return np.stack([(state[:, word] >> bit) & one for word, bit in self.ends], axis=1).astype(bool)


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + F.lit(3), F.length(url)))
    host = F.regexp_extract(rest, r"\A([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def judged(pages: DataFrame, rules: Sequence[Rule], blocked: Sequence[str], key: str = "page_id") -> DataFrame:
    """key, host, path, rule and verdict of each page.

    The longest fitting rule decides; where none fits, a page is blocked when a glob of ``blocked`` matches it.
    """
    globs = [g for r in rules for g in r.globs] + list(blocked)
    order = sorted(range(len(rules)), key=lambda i: (-len(rules[i].name), rules[i].name))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = Automaton(globs)
        for batch in batches:
            if batch.empty:
                continue
            urls = [(h + p).encode("utf-8", "surrogatepass") for h, p in zip(batch["host"], batch["path"], strict=True)]
            found = automaton.matches(urls)
            rule = np.full(len(batch), None, object)
            verdict = np.where(found[:, 2 * len(rules) :].any(axis=1) | (batch["host"] == "").to_numpy(), BLOCK, ALLOW).astype(object)
            for i in reversed(order):
                fits = found[:, 2 * i] | found[:, 2 * i + 1]
                rule[fits], verdict[fits] = rules[i].name, rules[i].verdict
            yield batch.assign(rule=rule, verdict=verdict)

    host, path = host_and_path(F.col("url"))
    narrow = pages.select(F.col(key), host.alias("host"), path.alias("path"))
    kind = pages.schema[key].dataType.simpleString()
    return narrow.mapInPandas(run, f"`{key}` {kind}, host string, path string, rule string, verdict string")
