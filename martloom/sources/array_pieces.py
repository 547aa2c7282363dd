"""Cutting files that are one JSON array into elements: what ``files.json_elements`` does inside a task.

Rows are pieces of a file in order, without the closing brace each ends in. All steps run over whole Arrow batches.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

QUOTE, OPEN, CLOSE, ESCAPE = 1, 2, 3, 4
KIND = np.zeros(256, np.uint8)
for _signs, _kind in ((b'"', QUOTE), (b"{[", OPEN), (b"]", CLOSE), (b"\\", ESCAPE)):
    KIND[list(_signs)] = _kind

RANGE = "file string, range long, odd long, total0 long, total1 long, least0 long, least1 long, n0 long, n1 long"
ELEMENT = "file string, range long, n long, text string"
SCHEMA = pa.schema([("file", pa.string()), ("range", pa.int64()), ("n", pa.int64()), ("text", pa.string())])
#: What may follow the last element, and what an array without elements is.
REST, NONE = re.compile(rb"\s*\]\s*"), re.compile(rb"(\xef\xbb\xbf)?\s*\[\s*\]\s*")


def _bytes(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column in one piece, and where each value ends."""
    values = values.cast(pa.string())
    offsets = np.frombuffer(values.buffers()[1], np.int32)[values.offset : values.offset + len(values) + 1].astype(np.int64)
    data = values.buffers()[2]
    held = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return held[offsets[0] : offsets[-1]], offsets[1:] - offsets[0]


class Run:
    """Quotes passed and depth reached in one range, for either way the range may begin: outside or inside a string."""

    def __init__(self, above: int = 0) -> None:
        self.passed, self.depth = 0, [above, above]

    def take(self, data: np.ndarray, ends: np.ndarray, sides: tuple[int, ...]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per side: whether the brace that ends a piece lies outside of strings, and the depth behind it."""
        kinds = KIND[data]
        pos = np.flatnonzero(kinds)
        kind = kinds[pos]
        slash = pos[kind == ESCAPE]
        if len(slash):
            # Every other backslash of a run takes away the meaning of what follows it in its piece.
            piece = np.searchsorted(ends, slash, "right")
            fresh = np.append(True, (np.diff(slash) != 1) | (np.diff(piece) != 0))
            first = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
            bare = (np.arange(len(slash)) - first) % 2 == 0
            escaped = slash[bare & (slash + 1 < ends[piece])] + 1
            kept = (kind != ESCAPE) & ~np.isin(pos, escaped)
            pos, kind = pos[kept], kind[kept]
        quotes = self.passed + np.cumsum(kind == QUOTE)
        before = np.searchsorted(pos, ends)
        at_end = np.append(self.passed, quotes)[before] % 2
        step = (kind == OPEN).astype(np.int64) - (kind == CLOSE)
        found = []
        for side in sides:
            levels = np.append(0, np.cumsum(step * (quotes % 2 == side)))[before]
            outside = at_end == side
            depth = self.depth[side] + levels - np.cumsum(outside)
            self.depth[side] = int(depth[-1])
            found.append((outside, depth))
        self.passed = int(np.append(self.passed, quotes)[-1]) % 2
        return found


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """File and start of a range with rows of it."""
    for batch in batches:
        if not batch.num_rows:
            continue
        codes = batch.column("file").dictionary_encode().indices.to_numpy()
        starts = batch.column("range").to_numpy()
        cuts = np.flatnonzero((np.diff(codes) != 0) | (np.diff(starts) != 0)) + 1
        for at, until in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            rows = batch.slice(int(at), int(until - at))
            yield (rows.column("file")[0].as_py(), int(starts[at])), rows


def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per range: quotes, levels passed, the least depth that an object ends at, and how often that is."""

    def row() -> pa.RecordBatch:
        values = [*key, run.passed, *run.depth, *least, *n]
        names = [field.split()[0] for field in RANGE.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([v], pa.string() if i == 0 else pa.int64()) for i, v in enumerate(values)], names)

    key = None
    for spot, rows in _ranges(batches):
        if spot != key:
            if key is not None:
                yield row()
            key, run, least, n = spot, Run(), [None, None], [0, 0]
        for side, (outside, depth) in enumerate(run.take(*_bytes(rows.column("value")), (0, 1))):
            if not outside.any():
                continue
            low = int(depth[outside].min())
            if least[side] is None or low < least[side]:
                least[side], n[side] = low, 0
            if low == least[side]:
                n[side] += int((depth[outside] == low).sum())
    if key is not None:
        yield row()


def cut(inner: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Elements that lie in one range, or (``inner`` false) the parts of those that may lie in several.

    Rows tell whether their range begins inside a string (``side``), how deep (``above``), which element (``base``) and the
    levels of the whole file (``all``; null if the range is the whole file).
    """

    def rows_of(key: tuple[str, int], first: int, offsets: np.ndarray, data: np.ndarray) -> pa.RecordBatch:
        size = len(offsets) - 1
        texts = pa.StringArray.from_buffers(size, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data))
        columns = [pa.repeat(pa.scalar(key[0], pa.string()), size), pa.repeat(pa.scalar(key[1], pa.int64()), size), pa.array(np.arange(first, first + size)), texts]
        return pa.RecordBatch.from_arrays(columns, schema=SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def broken() -> ValueError:
            return ValueError(f"{key[0]} is not one JSON array")

        def ended() -> Iterator[pa.RecordBatch]:
            if total is None and walk.depth[side] != -1:
                raise broken()
            if held and not inner:
                data = np.concatenate(held)
                yield rows_of(key, n, np.array([0, len(data)]), data)

        key = None
        for spot, rows in _ranges(batches):
            if spot != key:
                if key is not None:
                    yield from ended()
                side, above, n, total = (rows.column(c)[0].as_py() for c in ("side", "above", "base", "all"))
                key, walk, held, partial = spot, Run(above), [], spot[1] > 0
                if total is not None and total != -1:
                    raise broken()
            data, ends = _bytes(rows.column("value"))
            ((outside, depth),) = walk.take(data, ends, (side,))
            over = outside & (depth < 1)
            closing = outside & (depth == 1)
            for i in np.flatnonzero(over):
                piece = data[ends[i - 1] if i else 0 : ends[i]].tobytes()
                rest = REST if n + closing[:i].any() else NONE
                if depth[i] != -1 or not rest.fullmatch(piece):
                    raise broken()
            # The braces are put back; what follows the last element is left out.
            spots = ends + np.arange(len(ends))
            text = np.empty(len(data) + len(ends), np.uint8)
            plain = np.ones(len(text), bool)
            plain[spots] = False
            text[plain], text[spots] = data, ord("}")
            if over.any():
                keep = np.repeat(~over, np.diff(spots, prepend=-1))
                spots, text, closing = np.cumsum(np.diff(spots, prepend=-1)[~over]) - 1, text[keep], closing[~over]
            stops = spots[closing] + 1
            if not len(stops):
                if len(text):
                    held.append(text)
                continue
            before = sum(map(len, held))
            text = np.concatenate([*held, text])
            offsets = np.append(0, before + stops)
            held = [text[offsets[-1] :].copy()] if offsets[-1] < len(text) else []
            if partial and not inner:
                yield rows_of(key, n, offsets[:2], text)
            if inner:
                own = int(partial)
                if len(offsets) > 1 + own:
                    yield rows_of(key, n + own, offsets[own:], text)
            partial = False
            n += len(stops)
        if key is not None:
            yield from ended()

    return run
