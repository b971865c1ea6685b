"""Byte-level BPE encoding and decoding with forced boundaries.

A pair of bytes that occurs inside no token of the vocabulary is a certain cut:
no merge can ever cross it.  Each piece of the pre-tokenizer is split at such
pairs, the fragments are encoded on their own (equal fragments once per task)
and the ids are joined in order.  Cuts are made inside pre-tokenizer pieces
only: across pieces the pattern looks at its neighbours.

Added tokens of the file are cut out of the text first, as the library does.
A null text counts as empty and has no ids.  Texts of any length are encoded
whole; the caches are bounded and end with their task, which changes no result.
"""

from __future__ import annotations

import json
import sys
from array import array

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import free_name, give_back, numbered, schema_of

#: The pre-tokenizer's pattern of this vocabulary.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CACHE = 1 << 18  # remembered pieces; fragments of cut pieces: a quarter
CACHE_BYTES = 1 << 24  # of remembered pieces and their ids; fragments: a quarter
ROWS = 1024      # texts at a time


def byte_alphabet() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary:
    printable Latin-1 characters for themselves, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    chars = {b: chr(b) for b in plain}
    for b in range(256):
        if b not in chars:
            chars[b] = chr(0x100 + len(chars) - len(plain))
    return [chars[b] for b in range(256)]


class Codec:
    """Encoder and decoder of one tokenizer file (made once per Python worker)."""

    _made: dict = {}

    @classmethod
    def of(cls, path: str) -> Codec:
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()
        byte_of = {c: b for b, c in enumerate(alphabet)}
        self.model = Tokenizer.from_file(path).model
        size = 1 + max([*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"])])
        self.bytes_of = [b""] * size
        inside = set()
        for token, i in spec["model"]["vocab"].items():
            self.bytes_of[i] = raw = bytes(byte_of[c] for c in token)
            inside.update(zip(raw, raw[1:]))  # noqa: B905
        self.certain = {(a, b) for a in range(256) for b in range(256)} - inside
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for content, i in self.added.items():
            self.bytes_of[i] = content.encode()
        self.added_split = regex.compile("(" + "|".join(
            regex.escape(c) for c in sorted(self.added, key=len, reverse=True)) + ")") if self.added else None
        self.latin = str.maketrans({chr(b): c for b, c in enumerate(alphabet)})
        self.findall = regex.compile(PIECES).findall
        self.pieces, self.fragments = _Memo(self._piece, CACHE, CACHE_BYTES), _Memo(self._fragment, CACHE // 4, CACHE_BYTES // 4)

    def _fragment(self, raw: bytes) -> bytes:
        return _packed(t.id for t in self.model.tokenize(raw.decode("latin-1").translate(self.latin)))

    def _piece(self, piece: str) -> bytes:
        raw = piece.encode()
        cuts = [i for i, pair in enumerate(zip(raw, raw[1:]), 1) if pair in self.certain]  # noqa: B905
        if not cuts:
            return self._fragment(raw)
        edges = [0, *cuts, len(raw)]
        return b"".join(self.fragments[raw[a:b]] for a, b in zip(edges, edges[1:], strict=False))

    def encode(self, text: str | None) -> bytes:
        """The token ids of the whole text, as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        parts = self.added_split.split(text) if any(c in text for c in self.added) else [text]
        return b"".join(
            _packed([self.added[part]]) if i % 2 else b"".join(map(self.pieces.__getitem__, self.findall(part)))
            for i, part in enumerate(parts))

    def decode(self, ids) -> str:
        """The text of the ids; special tokens stay."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")

    def forget(self) -> None:
        """Drops what is remembered: the worker goes on to other tasks."""
        self.pieces.clear()
        self.fragments.clear()

    def text_of(self, packed: bytes | None) -> str:
        """``decode`` of packed ids."""
        return self.decode(np.frombuffer(packed or b"", "<u4").tolist())


def _packed(ids) -> bytes:
    return array("I", ids).tobytes() if sys.byteorder == "little" else np.array(list(ids), "<u4").tobytes()


class _Memo(dict):
    """Made values by key: ``most`` of them, ``most_bytes`` with their keys, at
    most.  A value too large for that is not kept."""

    def __init__(self, make, most: int, most_bytes: int):
        super().__init__()
        self.make, self.most, self.most_bytes, self.held = make, most, most_bytes, 0

    def clear(self):
        super().clear()
        self.held = 0

    def __missing__(self, key):
        value = self.make(key)
        size = len(key) + len(value)
        if size <= self.most_bytes:
            if len(self) >= self.most or self.held + size > self.most_bytes:
                self.clear()
            self[key] = value
            self.held += size
        return value


def _slices(batches):
    for batch in batches:
        for i in range(0, batch.num_rows, ROWS):
            yield batch.slice(i, ROWS)


def encode(docs: DataFrame, vocabulary: str, text_col: str = "text", out: str = "token_ids",
           decoded: str | None = None) -> DataFrame:
    """``docs`` with the token ids as little-endian unsigned 32-bit integers in
    one binary column, and, if ``decoded`` names a column, the text that
    ``decode`` makes of them, in the same pass."""
    names = [*docs.columns, free_name(docs, out), *([free_name(docs, decoded)] if decoded else [])]
    plain, text_at = numbered(docs), docs.columns.index(text_col)

    def run(batches):
        codec = Codec.of(vocabulary)
        for batch in _slices(batches):
            ids = [codec.encode(t) for t in batch.column(text_at).to_pylist()]
            batch = batch.append_column("ids", pa.array(ids, pa.binary()))
            yield batch.append_column("back", pa.array(map(codec.text_of, ids), pa.string())) if decoded else batch
        codec.forget()
        give_back()

    return plain.mapInArrow(run, schema_of(plain, "ids binary", *(["back string"] if decoded else []))).toDF(*names)


def decode(df: DataFrame, vocabulary: str, ids_col: str = "token_ids", out: str = "decoded") -> DataFrame:
    """``df`` with the text of the ids that ``encode`` gave (null: empty)."""
    plain, ids_at = numbered(df), df.columns.index(ids_col)

    def run(batches):
        codec = Codec.of(vocabulary)
        for batch in _slices(batches):
            yield batch.append_column("back", pa.array(map(codec.text_of, batch.column(ids_at).to_pylist()), pa.string()))

    return plain.mapInArrow(run, schema_of(plain, "back string")).toDF(*df.columns, free_name(df, out))
