"""Byte-level BPE through a sentencepiece model that is written straight from a rank file.

Every byte is one character of the model (``chr(256 + byte)``), every token of the rank file one piece with the score
``-rank``, and normalisation is the identity. Merging the best-scored pair first is then the same as merging the pair of the
lowest rank first, so each pre-token gets the ids of the rank file. Decoding maps the ids back to their bytes.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame

from .common import batchwise

#: pre-tokens whose ids a task remembers
CACHE = 200_000
#: added to a byte to make its character
SHIFT = 256


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their rank, one base64 text and a number a line."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, file))}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: bytes | int | float) -> bytes:
    """One field of a protocol buffer: a length-delimited, a fixed 32-bit or a varint one."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def mapped(token: bytes) -> str:
    return "".join([chr(SHIFT + b) for b in token])


def serialise(ranks: dict[bytes, int]) -> bytes:
    """A sentencepiece model whose piece ids are the ranks; the unknown piece comes last and is never met."""
    by_rank = sorted(ranks, key=ranks.__getitem__)
    if [ranks[t] for t in by_rank] != list(range(len(by_rank))):
        raise ValueError("ranks must run from 0 without gaps")
    missing = [b for b in range(256) if bytes([b]) not in ranks]
    if missing:
        raise ValueError(f"{len(missing)} single bytes have no rank")
    # fields and enums of sentencepiece_model.proto: pieces 1 (piece 1, score 2, type 3), trainer 2, normaliser 3
    normal, unknown, bpe = 1, 2, 2
    pieces = [_field(1, _field(1, mapped(t).encode()) + _field(2, float(-ranks[t])) + _field(3, normal)) for t in by_rank]
    pieces.append(_field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, unknown)))
    nowhere = (1 << 64) - 1  # -1: no begin, end or padding piece
    trainer = _field(3, bpe) + _field(4, len(pieces)) + _field(40, len(by_rank)) + b"".join(_field(n, nowhere) for n in (41, 42, 43))
    normaliser = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(pieces) + _field(2, trainer) + _field(3, normaliser)


class Codec:
    """Encodes and decodes texts by a rank file; ids come packed as little-endian unsigned 32-bit integers."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise(ranks))
        self.split = regex.compile(pattern).findall
        self.ranks = ranks
        self.bytes_of = sorted(ranks, key=ranks.__getitem__)
        self.known: dict[str, bytes] = {}

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        words = [self.split(t) for t in texts]
        new = list({w for ws in words for w in ws if w not in self.known})
        if len(self.known) + len(new) > CACHE:
            self.known = {}
            new = list({w for ws in words for w in ws})
        raw = [w.encode() for w in new]
        merged = [i for i, b in enumerate(raw) if b not in self.ranks]
        found = {w: struct.pack("<I", self.ranks[b]) for w, b in zip(new, raw, strict=True) if b in self.ranks}
        encoded = self.model.encode([mapped(raw[i]) for i in merged], num_threads=1) if merged else []
        found |= {new[i]: np.array(ids, "<u4").tobytes() for i, ids in zip(merged, encoded, strict=True)}
        self.known |= found
        return [b"".join([self.known[w] for w in ws]) for ws in words]

    def decode(self, packed: bytes) -> bytes:
        table = self.bytes_of
        return b"".join([table[i] for i in np.frombuffer(packed, "<u4").tolist()])


def encode_texts(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    text: str = "text",
    keep: Sequence[str] | None = None,
    ids: bool = True,
    digests: bool = False,
) -> DataFrame:
    """Ids of every text: ``ids array<int>`` (unless switched off) and ``n_tokens long``.

    ``digests`` adds the SHA-256 of the packed ids and of the bytes they decode to. Rows keep the columns ``keep`` (all by default);
    columns named like the new ones are replaced. A null text is the empty one: no ids. Repeated rows stay; an empty table gives none.
    Texts of any length are encoded whole. ``ranks_path`` must be readable on every executor.
    """
    wanted = ["n_tokens bigint", *["ids array<int>"] * ids, *["ids_sha256 string", "decoded_sha256 string"] * digests]

    def make():
        codec = Codec(read_ranks(ranks_path), pattern)

        def encode(texts):
            packed = codec.encode([t or "" for t in texts])
            out = [[len(p) // 4 for p in packed]]
            if ids:
                out.append([np.frombuffer(p, "<u4").astype("<i4") for p in packed])
            if digests:
                out.append([hashlib.sha256(p).hexdigest() for p in packed])
                out.append([hashlib.sha256(codec.decode(p)).hexdigest() for p in packed])
            return out

        return encode

    return batchwise(docs, [text], ", ".join(wanted), make, keep)


def decode_ids(
    df: DataFrame, ranks_path: str, pattern: str, ids: str = "ids", to: str = "decoded", keep: Sequence[str] | None = None
) -> DataFrame:
    """``to binary``: the bytes of each id list in ``ids`` (null for a null list or one with an id that has no token)."""

    def make():
        table = sorted((ranks := read_ranks(ranks_path)), key=ranks.__getitem__)

        def decode(lists):
            fit = [x is not None and all(i is not None and 0 <= i < len(table) for i in x) for x in lists]
            return [[b"".join([table[i] for i in x]) if ok else None for x, ok in zip(lists, fit, strict=True)]]

        return decode

    return batchwise(df, [ids], f"`{to}` binary", make, keep)
