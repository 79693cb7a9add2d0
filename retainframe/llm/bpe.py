"""Byte-level BPE encoding and decoding over whole columns.

Method: a piece's adjacent pairs are the leaves of a segment tree that holds, for every range, the smallest
(rank, position). The root is the leftmost pair of lowest rank; after each merge three leaves change and are
updated along their paths, until no mergeable pair is left.

Edge cases: null and empty texts give an empty id list, which decodes to the empty text; any length is encoded
whole (a run without a break costs n log n); repeated rows give repeated results; the result columns get
the names asked for, and an input column with such a name is replaced.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks

#: The published break-up pattern of byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same pattern spelled out for texts of ASCII and Latin-1 letters only, which the faster matcher can run.
LATIN = "A-Za-zÀ-ÖØ-öø-ÿ"
LATIN_PATTERN = rf"'(?:[stmd]|re|ve|ll)| ?[{LATIN}]+| ?[0-9]+| ?[^\s0-9{LATIN}]+|\s+(?!\S)|\s+"
NOT_LATIN = rf"[^\t\n\r\x20-\x7e{LATIN}]"
#: No merge: above every rank. A pair is packed as left << WIDE | right, a key as rank << PLACE | position.
NONE, WIDE, PLACE = 1 << 62, 20, 32


def byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary: printable bytes for themselves, the rest from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, spare = [], 256
    for b in range(256):
        if b in shown:
            out.append(chr(b))
        else:
            out.append(chr(spare))
            spare += 1
    return out


class ByteBpe:
    """A byte-level BPE tokenizer from a public tokenizer file; whole texts, no truncation or padding."""

    def __init__(self, path: str, remember: int = 200_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        letters = byte_letters()
        byte_of = {c: b for b, c in enumerate(letters)}
        self.of_byte = [vocab[c] for c in letters]
        self.rank: dict[int, int] = {}
        self.made: list[int] = []
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.rank.setdefault(vocab[left] << WIDE | vocab[right], rank << PLACE)
            self.made.append(vocab[left + right])
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes_of: dict[int, bytes] = {
            i: bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
            for token, i in [*vocab.items(), *self.special.items()]
        }
        self.any_pieces = regex.compile(PATTERN).findall
        self.latin_pieces, self.not_latin = re.compile(LATIN_PATTERN).findall, re.compile(NOT_LATIN).search
        self.cut = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")").split if self.special else None
        self.remember, self.known = remember, _Known(self, {})
        top = max(self.bytes_of, default=-1) + 1
        self.tokens = pa.array([self.bytes_of.get(i, b"") for i in range(top)], pa.large_binary())

    def merge(self, data: bytes) -> list[int]:
        """Ids of one piece. nodes is the segment tree: the children of i are 2i and 2i + 1, leaf i is the pair at position i."""
        ids, n = [self.of_byte[b] for b in data], len(data)
        if n < 2:
            return ids
        rank, made = self.rank.get, self.made
        leaves = 1 << (n - 2).bit_length()
        nodes = [NONE] * leaves + [rank(ids[i] << WIDE | ids[i + 1], NONE) | i for i in range(n - 1)] + [NONE] * (leaves - n + 1)
        for i in range(leaves - 1, 0, -1):
            left, right = nodes[2 * i], nodes[2 * i + 1]
            nodes[i] = left if left < right else right
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while (best := nodes[1]) < NONE:
            at = best & (1 << PLACE) - 1
            gone = after[at]
            ids[at], ids[gone] = made[best >> PLACE], -1
            nxt, prev = after[gone], before[at]
            after[at] = nxt
            changed = [(at, NONE)]
            if nxt < n:
                before[nxt] = at
                changed = [(gone, NONE), (at, rank(ids[at] << WIDE | ids[nxt], NONE) | at)]
            if prev >= 0:
                changed.append((prev, rank(ids[prev] << WIDE | ids[at], NONE) | prev))
            for i, key in changed:
                i += leaves
                nodes[i] = key
                while i > 1:
                    other = nodes[i ^ 1]
                    if other < key:
                        key = other
                    i >>= 1
                    if nodes[i] == key:
                        break
                    nodes[i] = key
        return [i for i in ids if i >= 0]

    def pieces(self, text: str) -> list[str]:
        return self.any_pieces(text) if self.not_latin(text) else self.latin_pieces(text)

    def encoded(self, text: str | None) -> bytes:
        """Ids as little-endian 32-bit numbers."""
        if not text:
            return b""
        known = self.known.__getitem__
        parts = self.cut(text) if self.cut else [text]
        if len(parts) == 1:
            return b"".join(map(known, self.pieces(text)))
        return b"".join(self.special[p].to_bytes(4, "little") if k % 2 else b"".join(map(known, self.pieces(p))) for k, p in enumerate(parts))

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.encoded(text), "<i4").tolist()

    def decode(self, ids: list[int] | None) -> str:
        return b"".join([self.bytes_of.get(i, b"") for i in ids or ()]).decode("utf-8", errors="replace")

    def encode_column(self, texts: pa.Array) -> pa.Array:
        found = [self.encoded(t.as_py()) for t in texts]
        ends = np.cumsum([0, *(len(f) // 4 for f in found)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(found), "<i4")))

    def decode_column(self, ids: pa.Array) -> pa.Array:
        """Texts of many rows: the tokens' bytes are gathered at once and cut at the rows' ends."""
        flat = ids.flatten()  # rows that are null count as empty
        known = pc.and_(pc.greater_equal(flat, 0), pc.less(flat, len(self.tokens)))
        taken = self.tokens.take(pc.if_else(known, flat, pa.scalar(None, flat.type)))
        ends = np.concatenate([[0], np.cumsum(np.asarray(pc.fill_null(pc.list_value_length(ids), 0), dtype=np.int64))])
        at = np.frombuffer(taken.buffers()[1], np.int64)[taken.offset :][ends] if len(taken) else np.zeros(len(ends), np.int64)
        data = taken.buffers()[2]
        body = data.to_pybytes() if data is not None else b""
        return pa.array([body[i:j].decode("utf-8", errors="replace") for i, j in zip(at, at[1:])], pa.string())


class _Known(dict):
    """Ids of pieces. A full generation becomes the old one of the next, so memory is bounded and frequent pieces stay."""

    def __init__(self, owner: ByteBpe, old: dict):
        super().__init__()
        self.owner, self.old = owner, old

    def __missing__(self, piece: str) -> bytes:
        found = self.old.get(piece)
        if found is None:
            ids = self.owner.merge(piece.encode())
            found = struct.pack(f"<{len(ids)}i", *ids)
        if len(piece) <= 64:
            if len(self) < self.owner.remember:
                self[piece] = found
            elif self.owner.known is self:
                self.old = {}
                self.owner.known = _Known(self.owner, self)
        return found


_LOADED: dict[str, ByteBpe] = {}


def tokenizer(path: str) -> ByteBpe:
    """One tokenizer per worker process and file."""
    if path not in _LOADED:
        _LOADED[path] = ByteBpe(path)
    return _LOADED[path]


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with the token ids of ``text``; special tokens written in a text are taken as such."""
    schema = T.StructType([f for f in df.schema if f.name.lower() != ids.lower()] + [T.StructField(ids, T.ArrayType(T.IntegerType(), False), False)])
    others = schema.names[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = tokenizer(path).encode_column
        for batch in batches:
            for i, j in chunks(batch, text):
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in others], work(part.column(text))], names=schema.names)

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with the text of its token ids, special tokens included; broken byte sequences become U+FFFD."""
    schema = T.StructType([f for f in df.schema if f.name.lower() != text.lower()] + [T.StructField(text, T.StringType(), False)])
    others = schema.names[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = tokenizer(path).decode_column
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in others], work(batch.column(ids))], names=schema.names)

    return df.mapInArrow(run, schema)


def ids_digest(ids: str = "ids") -> Column:
    """Lower-case hexadecimal SHA-256 of the decimal ids joined by commas."""
    return F.sha2(F.array_join(F.transform(F.col(ids), lambda i: i.cast("string")), ","), 256)


def token_table(df: DataFrame, path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: its key, number of tokens, digest of the ids, and digest of the decoded text."""
    coded = decode(encode(df.select(key, text), path, text, "ids").select(key, "ids"), path, "ids", "decoded")
    return coded.select(key, F.size("ids").cast("long").alias("n_tokens"), ids_digest().alias("ids_sha256"), F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))
