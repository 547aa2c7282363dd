"""SentencePiece encoding and decoding on the tokenizers library.

The model file, a protobuf message, is read field by field: pieces with scores and kinds, the kind of model, byte
fallback, and the normaliser with its compiled character map. From these the same normaliser, blank marker, model (unigram
scores, or merges ordered by score for a BPE model) and byte fallback are built as a tokenizer of the tokenizers
library, which encodes whole batches on several threads.

Batches are cut by bytes, so memory is bounded by the longest text. The scan shuffles nothing. Parity with the
sentencepiece library is checked on the documents whose id has a hash divisible by ``parity_every``; a difference
stops the job. Decoding is the inverse, with byte pieces joined to characters.

Null and empty texts have no ids. Repeated rows are encoded one by one; extra columns are not read; no rows give no
rows.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BATCH_BYTES = 2_000_000


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind)
        size = varint() if size is None else size
        yield tag >> 3, message[at : at + size]
        at += size


@dataclass
class Model:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    unknown: int = 0
    charsmap: bytes = b""
    dummy_prefix: bool = True
    trim: bool = True

    @staticmethod
    def parse(content: bytes) -> Model:
        """The field numbers of the published message format."""
        model = Model()
        for number, value in _fields(content):
            if number == 1:
                piece = dict(_fields(value))
                score = struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
                model.pieces.append((piece.get(1, b"").decode(), score, piece.get(3, NORMAL)))
            elif number == 2:
                spec = dict(_fields(value))
                model.kind = spec.get(3, UNIGRAM)
                model.byte_fallback = bool(spec.get(35, 0))
                model.unknown = spec.get(40, 0)
            elif number == 3:
                spec = dict(_fields(value))
                model.charsmap = spec.get(2, b"")
                model.dummy_prefix, model.trim = bool(spec.get(3, 1)), bool(spec.get(4, 1))
        return model

    def merges(self) -> list[tuple[str, str]]:
        """All ways to join two pieces to a third, better scores first."""
        ids = {p: i for i, (p, _, _) in enumerate(self.pieces)}
        made = {p for p, _, kind in self.pieces if kind in (NORMAL, USER)}
        found = []
        for i, (piece, score, _) in enumerate(self.pieces):
            if piece in made:
                parts = [(piece[:k], piece[k:]) for k in range(1, len(piece))]
                found += [(-score, i, ids[a], ids[b], (a, b)) for a, b in parts if a in made and b in made]
        return [pair for *_, pair in sorted(found)]

    def tokenizer(self):
        from tokenizers import Regex, Tokenizer, decoders, models, normalizers

        names = [p for p, _, _ in self.pieces]
        if self.kind == UNIGRAM:
            core = models.Unigram([(p, s) for p, s, _ in self.pieces], unk_id=self.unknown, byte_fallback=self.byte_fallback)
        elif self.kind == BPE:
            vocabulary = {p: i for i, p in enumerate(names)}
            core = models.BPE(
                vocabulary, self.merges(), unk_token=names[self.unknown], fuse_unk=True, byte_fallback=self.byte_fallback
            )
        else:
            raise ValueError(f"models of kind {self.kind} are not supported")
        steps = [normalizers.Precompiled(self.charsmap)] if self.charsmap else []
        if self.trim:
            steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Strip(left=True, right=True)]
        steps.append(normalizers.Replace(" ", MARK))
        if self.dummy_prefix:
            steps.append(normalizers.Prepend(MARK))
        built = Tokenizer(core)
        built.normalizer = normalizers.Sequence(steps)
        ends = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
        built.decoder = decoders.Sequence(ends + ([decoders.Strip(" ", 1, 0)] if self.dummy_prefix else []))
        return built


class Codec:
    """Both directions for lists of texts."""

    def __init__(self, path: str, threads: int = 2):
        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        with open(path, "rb") as file:
            content = file.read()
        self.path = path
        self.model = Model.parse(content)
        self.tokenizer = self.model.tokenizer()
        self.contents = [
            bytes([int(p[3:5], 16)]) if kind == BYTE else p.replace(MARK, " ").encode() for p, _, kind in self.model.pieces
        ]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.tokenizer.decode_batch(ids, skip_special_tokens=False)

    def returns(self, text: str, ids: list[int]) -> bool:
        """Whether the contents of the pieces, put together, are the normalised text."""
        plain = not self.model.charsmap and not self.model.trim
        prefix = MARK if self.model.dummy_prefix and text else ""
        wanted = prefix + text if plain else self.tokenizer.normalizer.normalize_str(text)
        return b"".join(map(self.contents.__getitem__, ids)) == wanted.replace(MARK, " ").encode()

    def reference(self):
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_file=self.path)


def batches_of(texts: list[str], most: int = BATCH_BYTES) -> Iterator[slice]:
    """Slices of texts of about that many characters, at least one text each."""
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > most:
            yield slice(start, i)
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield slice(start, len(texts))


def _narrow(docs: DataFrame, key: str, parity_every: int) -> DataFrame:
    every = F.pmod(F.xxhash64(F.col(key)), F.lit(max(1, parity_every))) == 0
    checked = (every & F.lit(parity_every > 0)).alias("checked")
    return docs.select(F.col(key), F.coalesce("text", F.lit("")).alias("text"), checked)


def _encoded(batches: Iterator[pd.DataFrame], codec: Codec) -> Iterator[tuple[pd.DataFrame, list[list[int]]]]:
    """Rows and their ids, parity verified where it is asked for."""
    reference = None
    for batch in batches:
        texts = batch["text"].tolist()
        for part in batches_of(texts):
            rows, ids = batch.iloc[part], codec.encode(texts[part])
            for text, got, wanted in zip(texts[part], ids, rows["checked"], strict=True):
                if wanted:
                    reference = reference or codec.reference()
                    if got != reference.encode(text, num_threads=1):
                        raise ValueError("the two libraries disagree on a text")
            yield rows, ids


def encoded(docs: DataFrame, path: str, key: str = "doc_id", parity_every: int = 100) -> DataFrame:
    """key, ids (array of int) and checked (whether parity was verified) of each document."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows, ids in _encoded(batches, Codec(path)):
            yield pd.DataFrame({key: rows[key], "ids": [np.array(x, np.int32) for x in ids], "checked": rows["checked"]})

    kind = docs.schema[key].dataType.simpleString()
    return _narrow(docs, key, parity_every).mapInPandas(run, f"`{key}` {kind}, ids array<int>, checked boolean")


def decoded(rows: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """key and text of rows of ids."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = Codec(path)
        for batch in batches:
            ids = [[] if x is None else [int(i) for i in x] for x in batch["ids"]]
            yield pd.DataFrame({key: batch[key], "text": codec.decode(ids)})

    return rows.select(key, "ids").mapInPandas(run, f"`{key}` {rows.schema[key].dataType.simpleString()}, text string")


def summary(docs: DataFrame, path: str, key: str = "doc_id", parity_every: int = 100) -> DataFrame:
    """key, n_ids, ids_crc32, round_trip (whether the ids stand for the whole normalised text) and checked."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = Codec(path)
        for rows, ids in _encoded(batches, codec):
            yield pd.DataFrame(
                {
                    key: rows[key],
                    "n_ids": [len(x) for x in ids],
                    "ids_crc32": [zlib.crc32(np.array(x, "<u4").tobytes()) for x in ids],
                    "round_trip": [codec.returns(t, x) for t, x in zip(rows["text"], ids, strict=True)],
                    "checked": rows["checked"],
                }
            )

    kind = docs.schema[key].dataType.simpleString()
    columns = f"`{key}` {kind}, n_ids long, ids_crc32 long, round_trip boolean, checked boolean"
    return _narrow(docs, key, parity_every).mapInPandas(run, columns)
