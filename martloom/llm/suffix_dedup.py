"""Suffix-array dedup of exact substrings, by external induced sorting of shards.

Removed is every byte covered by a string of ``length`` bytes that also starts in a document with a smaller id.

Two equal strings have the same anchor: the least hash of the ``GRAM``-byte grams in them. Documents are worked on in
blocks of a few megabytes, dealt by a hash of their id. Three passes over the text, each one Spark job:

1. Every block sends the hashes of its anchors, each once. Hashes that two documents share are sent back to the blocks
   that have them; most text drops out here.
2. Around each shared anchor lies the context that holds every string with this anchor. A block sends each distinct
   context once, with its smallest id. A shard has all contexts of its anchors; their suffixes are sorted by external
   induced sorting with common prefixes (see ``induced``), runs with a common prefix of ``length`` are the equal
   strings, and the smallest id of a run decides what is covered. The covered spans go back to the blocks.
3. Blocks take the covered bytes out.

A passage or line that a third of all documents share is one context in a block, so no shard grows with copies; a
shard's contexts may exceed memory, as the sorting goes to disk. The number of blocks and shards follows the bytes of the
table. What the passes send is written to the shared folder before the next begins.

Null texts are empty. Documents without an id come after all others. Rows with one id do not remove each other's
bytes. Texts under ``length`` bytes stay. Other columns are passed on as they are by ``deduplicated``. An empty table
gives no rows. A document longer than a block is a block of its own size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.frames import ROW, stored, whole
from martloom.llm.induced import common_of, rows_of, suffix_orders
from martloom.llm.prefix_join import mixed

LENGTH = 50
GRAM = 24
BLOCK_BYTES = 2_000_000
SHARD_BYTES = 6_000_000
NO_ID = np.iinfo(np.int64).max
U = np.uint64


def _grams(data: np.ndarray, k: int) -> np.ndarray:
    """A hash of the k bytes from every place, by joining hashes of halves."""
    parts, size = {1: mixed(data.astype(U) + U(1))}, 1
    while size * 2 <= k:
        half = parts[size]
        parts[size * 2] = half[:-size] * U(0x9E3779B97F4A7C15) + (half[size:] ^ (half[size:] >> U(29)))
        size *= 2
    n, total, at = len(data) - k + 1, np.zeros(len(data) - k + 1, U), 0
    for size in sorted(parts, reverse=True):
        if at + size <= k:
            total = total * U(0xD6E8FEB86659FD93) + (parts[size][at : at + n] ^ (parts[size][at : at + n] >> U(31)))
            at += size
    return mixed(total)


def _slid(values: np.ndarray, width: int, take) -> np.ndarray:
    """``take`` of every window of ``width`` values."""
    size, now = 1, values
    while size * 2 <= width:
        now = take(now[:-size], now[size:])
        size *= 2
    n = len(values) - width + 1
    return take(now[:n], now[width - size : width - size + n])


class Block:
    """The documents of a block, in the order of their ids, as one run of bytes."""

    def __init__(self, frame: pd.DataFrame):
        ids = np.array([NO_ID if pd.isna(i) else int(i) for i in frame["id"]], np.int64)
        texts = [bytes(t) for t in frame["content"]]
        self.order = np.argsort(ids, kind="stable")
        self.ids = ids[self.order]
        self.texts = [texts[i] for i in self.order]
        self.sizes = np.array([len(t) for t in self.texts], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)]).astype(np.int64)
        self.data = np.frombuffer(b"".join(self.texts), np.uint8)

    def anchors(self, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place, hash and document of every anchor."""
        none = np.empty(0, np.int64)
        if len(self.data) < length:
            return none, none.astype(U), none
        hashes, width = _grams(self.data, gram), length - gram + 1
        least = _slid(hashes, width, np.minimum)
        whole_window = np.zeros(len(self.data) + 1, bool)
        for start, size in zip(self.starts, self.sizes, strict=False):
            whole_window[start : start + max(0, size - length + 1)] = True
        least = np.where(whole_window[: len(least)], least, U(0))
        edge = np.zeros(width - 1, U)
        most = _slid(np.concatenate([edge, least, edge]), width, np.maximum)
        places = np.flatnonzero((hashes == most) & (hashes != 0))
        # Least hashes are small ones: scrambled again, they spread evenly over shards.
        return places, mixed(hashes[places] + U(1)), np.searchsorted(self.starts, places, side="right") - 1


def _packed(array: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(array).tobytes())


def _opened(content: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(content, max_output_size=1 << 31), kind)


def _shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    return ((hashes >> U(32)) * U(shards) >> U(32)).astype(np.int64)


def _sent_hashes(frame: pd.DataFrame, shards: int, length: int, gram: int) -> pd.DataFrame:
    """A block's distinct anchor hashes by shard, and those that several of its documents have."""
    block = Block(frame)
    _, hashes, owners = block.anchors(length, gram)
    order = np.lexsort((owners, hashes))
    hashes, ids = hashes[order], block.ids[owners[order]]
    firsts = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])) if len(hashes) else np.empty(0, np.int64)
    lasts = np.append(firsts[1:], len(hashes)) - 1
    several = ids[firsts] != ids[lasts]
    hashes = hashes[firsts]
    ends = np.searchsorted(_shard_of(hashes, shards), np.arange(shards + 1))
    name = frame["block"].iloc[0]
    rows = [
        (name, s, hashes[a:b].tobytes(), np.packbits(several[a:b]).tobytes())
        for s, a, b in zip(range(shards), ends[:-1], ends[1:], strict=True)
        if b > a
    ]
    return pd.DataFrame(rows, columns=["block", "shard", "hashes", "several"])


def _shared_hashes(frame: pd.DataFrame) -> pd.DataFrame:
    """For each block of a shard, the hashes that documents share."""
    arrays = [np.frombuffer(h, U) for h in frame["hashes"]]
    every = np.concatenate(arrays)
    several = np.concatenate([np.unpackbits(np.frombuffer(b, np.uint8), count=len(a)) for a, b in zip(arrays, frame["several"], strict=True)])
    order = np.argsort(every, kind="stable")
    ordered = every[order]
    firsts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    counts = np.diff(np.append(firsts, len(ordered)))
    shared = (counts > 1) | (np.add.reduceat(several[order].astype(np.int64), firsts) > 0)
    flags = np.empty(len(every), bool)
    flags[order] = np.repeat(shared, counts)
    ends = np.cumsum([0] + [len(a) for a in arrays])
    rows = [(name, a[flags[s:e]].tobytes()) for name, a, s, e in zip(frame["block"], arrays, ends[:-1], ends[1:], strict=True)]
    return pd.DataFrame([r for r in rows if r[1]], columns=["block", "shared"])


def _sent_contexts(frame: pd.DataFrame, shared: pd.DataFrame, shards: int, length: int, gram: int) -> pd.DataFrame:
    """A block's distinct contexts of shared anchors by shard.

    A context has its bytes, which of its windows lie in the document, the smallest id and the places with that id.
    Other places of the block are covered whatever the shard says, and travel as spans.
    """
    names = ["block", "shard", "count", "contexts", "windows", "ids", "copies", "places", "spans"]
    if frame.empty or shared.empty:
        return pd.DataFrame(columns=names)
    block = Block(frame)
    places, hashes, owners = block.anchors(length, gram)
    wanted = np.sort(np.concatenate([np.frombuffer(h, U) for h in shared["shared"]]))
    at = np.minimum(np.searchsorted(wanted, hashes), len(wanted) - 1)
    keep = wanted[at] == hashes
    places, hashes, owners = places[keep], hashes[keep], owners[keep]
    reach = length - gram
    spots = places[:, None] + np.arange(-reach, length)
    inside = (spots >= block.starts[owners][:, None]) & (spots < block.starts[owners + 1][:, None])
    contexts = np.where(inside, block.data[np.clip(spots, 0, len(block.data) - 1)], 0).astype(np.uint8)
    first = np.maximum(reach - (places - block.starts[owners]), 0)
    last = np.minimum(block.starts[owners + 1] - length - places + reach, reach)
    random = np.random.default_rng(11).integers(1, 1 << 62, contexts.shape[1], dtype=np.int64).astype(U) * U(2) + U(1)
    mark = mixed((contexts.astype(U) * random).sum(axis=1) + (first * 64 + last).astype(U))
    order = np.lexsort((places, mark, hashes))
    sorted_contexts, sorted_first, sorted_last = contexts[order], first[order], last[order]
    new = np.ones(len(order), bool)
    new[1:] = (sorted_contexts[1:] != sorted_contexts[:-1]).any(axis=1)
    new[1:] |= (sorted_first[1:] != sorted_first[:-1]) | (sorted_last[1:] != sorted_last[:-1])
    heads = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    ids = block.ids[owners[order]]
    mine = ids == ids[heads][group]
    spans = np.stack([places[order] - reach + sorted_first, places[order] - reach + sorted_last + length], axis=1).astype("<u4")
    shard = _shard_of(hashes[order], shards)
    rows, name = [], frame["block"].iloc[0]
    ends = np.searchsorted(shard, np.arange(shards + 1))
    for s in np.flatnonzero(np.diff(ends)):
        a, b = ends[s], ends[s + 1]
        here = heads[(heads >= a) & (heads < b)]
        own = mine[a:b]
        rows.append(
            (
                name,
                int(s),
                len(here),
                _packed(sorted_contexts[here]),
                _packed((sorted_first[here] | sorted_last[here] << 8).astype("<u2")),
                _packed(ids[here]),
                _packed(np.add.reduceat(own.astype(np.int64), here - a).astype("<u4")),
                _packed(places[order][a:b][own].astype("<u4")),
                _packed(spans[a:b][~own]),
            )
        )
    return pd.DataFrame(rows, columns=names)


def _covered(contexts: np.ndarray, first: np.ndarray, last: np.ndarray, ids: np.ndarray, length: int, reach: int) -> np.ndarray:
    """For each context, a bit per window: whether an equal window belongs to a smaller id."""
    bits = np.zeros(len(ids), np.uint64)
    columns = np.ascontiguousarray(contexts.T)
    for column, order in suffix_orders(columns, reach):
        valid = (first <= column) & (last >= column)
        weights = np.where(valid, ids, NO_ID)
        least: list[np.ndarray] = []
        open_min, runs = NO_ID, []
        for tuples in order:
            new = common_of(tuples) < length
            values = weights[rows_of(tuples)]
            starts = np.flatnonzero(new)
            if not len(starts) or starts[0] > 0:
                open_min = min(open_min, int(values[: starts[0] if len(starts) else len(values)].min()))
            if len(starts):
                if runs:
                    least.append(np.array([open_min], np.int64))
                runs.append(True)
                minima = np.minimum.reduceat(values, starts)
                least.append(minima[:-1])
                open_min = int(minima[-1])
        least.append(np.array([open_min], np.int64))
        minima, base = np.concatenate(least), -1
        for tuples in order:
            run = base + np.cumsum(common_of(tuples) < length)
            base = int(run[-1])
            rows = rows_of(tuples)
            hit = rows[valid[rows] & (minima[run] < ids[rows])]
            bits[hit] |= np.uint64(1 << column)
    return bits


def _spans(bits: np.ndarray, places: np.ndarray, owner: np.ndarray, length: int, reach: int) -> np.ndarray:
    """Start and end of what the set windows of each place cover, neighbouring windows joined."""
    one = np.uint64(1)
    marked = bits[owner]
    table = (marked[:, None] >> np.arange(reach + 1, dtype=U)) & one == 1
    before = np.pad(table[:, :-1], ((0, 0), (1, 0)))
    after = np.pad(table[:, 1:], ((0, 0), (0, 1)))
    row, start = np.nonzero(table & ~before)
    _, end = np.nonzero(table & ~after)
    at = places[row].astype(np.int64) - reach
    return np.stack([at + start, at + end + length], axis=1).astype("<u4")


def _sorted_shard(frame: pd.DataFrame, length: int, gram: int) -> pd.DataFrame:
    """Covered spans for each block of a shard."""
    reach = length - gram
    contexts = np.concatenate([_opened(c, "u1").reshape(n, -1) for c, n in zip(frame["contexts"], frame["count"], strict=True)])
    windows = np.concatenate([_opened(w, "<u2") for w in frame["windows"]]).astype(np.int64)
    ids = np.concatenate([_opened(i, "<i8") for i in frame["ids"]])
    bits = _covered(contexts, windows & 255, windows >> 8, ids, length, reach)
    rows, at = [], 0
    for name, n, copies, places, spans in zip(frame["block"], frame["count"], frame["copies"], frame["places"], frame["spans"], strict=True):
        owner = np.repeat(np.arange(n), _opened(copies, "<u4"))
        found = _spans(bits[at : at + n], _opened(places, "<u4"), owner, length, reach)
        every = np.concatenate([found, _opened(spans, "<u4").reshape(-1, 2)])
        at += n
        if len(every):
            rows.append((name, _packed(every)))
    return pd.DataFrame(rows, columns=["block", "spans"])


def _kept(frame: pd.DataFrame, marks: pd.DataFrame) -> Iterator[tuple[int, bytes, int, int]]:
    """Place in the frame, kept bytes, removed bytes and removed runs of each document."""
    block = Block(frame)
    change = np.zeros(len(block.data) + 1, np.int32)
    for content in marks["spans"]:
        spans = _opened(content, "<u4").reshape(-1, 2).astype(np.int64)
        np.add.at(change, spans[:, 0], 1)
        np.add.at(change, spans[:, 1], -1)
    gone = np.cumsum(change[:-1]) > 0
    for i, (start, end) in enumerate(zip(block.starts[:-1], block.starts[1:], strict=True)):
        here = gone[start:end]
        removed = int(here.sum())
        runs = int(here[:1].sum() + (here[1:] & ~here[:-1]).sum()) if removed else 0
        yield int(block.order[i]), block.data[start:end][~here].tobytes() if removed else block.texts[i], removed, runs


def _marks(rows: DataFrame, total: int, length: int, gram: int) -> DataFrame:
    """Covered spans by block, for rows of id, content and block."""
    shards = max(1, -(-total // SHARD_BYTES))
    blocks = rows.select("id", "content", "block")

    def send_hashes(frame: pd.DataFrame) -> pd.DataFrame:
        return _sent_hashes(frame, shards, length, gram)

    def send_contexts(frame: pd.DataFrame, shared: pd.DataFrame) -> pd.DataFrame:
        return _sent_contexts(frame, shared, shards, length, gram)

    def sort_shard(frame: pd.DataFrame) -> pd.DataFrame:
        return _sorted_shard(frame, length, gram)

    hashes = blocks.groupBy("block").applyInPandas(send_hashes, "block long, shard long, hashes binary, several binary")
    shared = stored(hashes.groupBy("shard").applyInPandas(_shared_hashes, "block long, shared binary"), "suffix-shared")
    shape = "block long, shard long, count long, contexts binary, windows binary, ids binary, copies binary, places binary, spans binary"
    contexts = blocks.groupBy("block").cogroup(shared.groupBy("block")).applyInPandas(send_contexts, shape)
    return stored(contexts.groupBy("shard").applyInPandas(sort_shard, "block long, spans binary"), "suffix-marks")


def _blocked(docs: DataFrame, *more: str) -> tuple[DataFrame, int]:
    """id, content and block of each row, and all bytes."""
    content = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    total = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    blocks = max(1, -(-total // BLOCK_BYTES))
    rows = whole(docs, F.col("doc_id").cast("long").alias("id"), content.alias("content"))
    block = F.pmod(F.xxhash64("id", F.crc32("content")), F.lit(blocks)).alias("block")
    return rows.select(*more, "id", "content", block), total


def measured(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of each document."""
    rows, total = _blocked(docs)

    def finish(frame: pd.DataFrame, marks: pd.DataFrame) -> pd.DataFrame:
        sizes, found = [len(t) for t in frame["content"]], []
        names = frame["id"].tolist()
        for at, kept, removed, runs in _kept(frame, marks):
            name = None if pd.isna(names[at]) else int(names[at])
            found.append((name, sizes[at], removed, runs, hashlib.sha256(kept).hexdigest()))
        return pd.DataFrame(found, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]).astype({"doc_id": "Int64"})

    shape = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    marks = _marks(rows, total, length, gram)
    return rows.groupBy("block").cogroup(marks.groupBy("block")).applyInPandas(finish, shape)


def deduplicated(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """The documents with the covered bytes taken out of their texts, all other columns as they were.

    A character that loses some of its bytes is left out whole.
    """
    rows, total = _blocked(docs, ROW)
    others = [c for c in docs.columns if c != "text"]

    def finish(frame: pd.DataFrame, marks: pd.DataFrame) -> pd.DataFrame:
        found = [(frame["rest"].iloc[at], kept.decode("utf-8", "ignore")) for at, kept, _, _ in _kept(frame, marks)]
        return pd.DataFrame(found, columns=["rest", "kept"])

    marks = _marks(rows, total, length, gram)
    rest = F.struct(*[F.col(f"{ROW}.`{c}`") for c in others]).alias("rest")
    packed = rows.select(rest, "id", "content", "block")
    shape = f"rest {packed.schema['rest'].dataType.simpleString()}, kept string"
    done = packed.groupBy("block").cogroup(marks.groupBy("block")).applyInPandas(finish, shape)
    return done.select(*[F.col("kept").alias(c) if c == "text" else F.col(f"rest.`{c}`") for c in docs.columns])
