"""Byte-level BPE by a sentencepiece model that is serialised directly from the rank file.

Every byte is mapped to one printable character; the model's pieces are the
mapped vocabulary in rank order with score ``-rank``, normalisation is the
identity, and ``<unk>`` comes last, so that a piece's id is its rank. Each
pre-token is encoded by itself: the highest score merges first and ties merge
leftmost, as byte-pair merging by ranks does; a pre-token that is itself in
the vocabulary is that id. Decoding maps each id's piece back to its bytes.

Defined results: null text is empty; empty text has no ids (digests of no
bytes). Repeated rows give repeated results, an empty table an empty one.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame, SparkSession

from cartwise.llm.common import id_text, lean, ship, table

ship(__name__)

RANK_FILE = "byte_bpe_multi_50k.tiktoken"

#: Bytes that print as themselves; the rest take the code points from 256 on, in order.
_PRINTED = (*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100))

#: Pre-tokens whose ids a task remembers at once; beyond it the memory starts anew.
CACHE_SIZE = 1 << 18
#: Texts whose ids a task holds at once before it hands them on.
ROWS_AT_ONCE = 256


def byte_map() -> list[str]:
    out, extra = [], 256
    for b in range(256):
        if b in _PRINTED:
            out.append(chr(b))
        else:
            out.append(chr(extra))
            extra += 1
    return out


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n >= 0x80:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: int | float | bytes) -> bytes:
    """One protobuf field: a varint, a 32-bit float or length-delimited bytes."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def model_bytes(ranks: dict[bytes, int]) -> bytes:
    """A sentencepiece ModelProto: pieces (1), trainer settings (2), normaliser settings (3)."""
    shown = byte_map()
    by_rank = sorted(ranks, key=ranks.__getitem__)
    if [ranks[t] for t in by_rank] != list(range(len(by_rank))):
        raise ValueError("ranks must be 0 .. n - 1")
    pieces = [_field(1, _field(1, "".join(shown[b] for b in token).encode()) + _field(2, -float(r)) + _field(3, 1))
              for r, token in enumerate(by_rank)]
    unknown = _field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2))
    # model type 2 is BPE; -1 (as a 64-bit varint) switches the other special pieces off
    off = (1 << 64) - 1
    trainer = _field(3, 2) + _field(4, len(by_rank) + 1) + _field(40, len(by_rank)) + _field(41, off) + _field(42, off) + _field(43, off)
    normaliser = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(pieces) + unknown + _field(2, trainer) + _field(3, normaliser)


class Codec:
    """Encoder and decoder of one task."""

    def __init__(self, ranks: dict[bytes, int], model: bytes, pattern: str) -> None:
        self.find = regex.compile(pattern).findall
        self.ranks = ranks
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        shown = byte_map()
        self.to_shown = dict(enumerate(shown))
        back = {c: b for b, c in enumerate(shown)}
        self.pieces = [bytes(back[c] for c in self.model.id_to_piece(i)) for i in range(len(ranks))]
        self.cache: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        tokens = self.find(text)
        cache = self.cache
        try:
            return b"".join(map(cache.__getitem__, tokens))
        except KeyError:
            pass
        missing = [t for t in set(tokens) if t not in cache]
        if len(cache) + len(missing) > CACHE_SIZE:
            cache.clear()
            missing = list(set(tokens))
        merged = []
        for t in missing:
            rank = self.ranks.get(t.encode())
            if rank is None:
                merged.append(t)
            else:
                cache[t] = struct.pack("<I", rank)
        shown = [t.encode().decode("latin-1").translate(self.to_shown) for t in merged]
        for t, ids in zip(merged, self.model.encode(shown, out_type=int, num_threads=1), strict=True):
            cache[t] = struct.pack(f"<{len(ids)}I", *ids)
        return b"".join(map(cache.__getitem__, tokens))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.pieces.__getitem__, memoryview(ids).cast("I")))


def encoded(batches: Iterator[pa.RecordBatch], codec: Codec, keep_ids: bool) -> Iterator[pa.RecordBatch]:
    """doc_id, count and digests (and, on request, the ids) of batches of doc_id and text, ``ROWS_AT_ONCE`` rows at a time."""
    for batch in (whole.slice(at, ROWS_AT_ONCE) for whole in batches for at in range(0, whole.num_rows, ROWS_AT_ONCE)):
        n, ids_hash, text_hash, kept = [], [], [], []
        for text in batch.column("text"):
            ids = codec.encode(text.as_py() or "")
            n.append(len(ids) // 4)
            ids_hash.append(hashlib.sha256(ids).hexdigest())
            text_hash.append(hashlib.sha256(codec.decode(ids)).hexdigest())
            if keep_ids:
                kept.append(ids)
        columns = [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string())]
        names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        if keep_ids:
            borders = np.concatenate([[0], np.cumsum(n, dtype=np.int64)])
            columns.append(pa.LargeListArray.from_arrays(borders, pa.array(np.frombuffer(b"".join(kept), np.int32))).cast(pa.list_(pa.int32())))
            names.append("ids")
        yield pa.RecordBatch.from_arrays(columns, names=names)


def encode_documents(docs: DataFrame, rank_path: str, pattern: str, keep_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 (and, on request, the ids) of every whole text."""
    spark = docs.sparkSession
    ranks = read_ranks(rank_path)
    shared = spark.sparkContext.broadcast((ranks, model_bytes(ranks)))  # size: the vocabulary file's
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return encoded(batches, Codec(*shared.value, pattern), keep_ids)

    return id_text(docs).mapInArrow(lean(run), schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN)
