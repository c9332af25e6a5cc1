"""Byte-level BPE of whole texts: ids, byte and character offsets, and the way back."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.base import map_batches, slices
from riskloom.llm.chunks import ChunkEncoder

_encoders: dict[tuple[str, str], ChunkEncoder] = {}


def encoder(path: str, pattern: str) -> ChunkEncoder:
    """One per Python worker and vocabulary."""
    if (path, pattern) not in _encoders:
        _encoders[path, pattern] = ChunkEncoder.from_ranks(path, pattern)
    return _encoders[path, pattern]


def character_offsets(raw: bytes, widths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First character of each token and the one behind its last; a character split between tokens belongs to all of them."""
    lead = (np.frombuffer(raw, np.uint8) & 0xC0) != 0x80
    upto = np.concatenate(([0], np.cumsum(lead)))  # characters that begin before a byte
    ends = np.cumsum(widths)
    return upto[ends - widths + 1] - 1, upto[ends]


def encode(docs: DataFrame, vocabulary: str, pattern: str, id: str = "doc_id", text: str = "text", offsets: bool = True) -> DataFrame:
    """Columns `id`, ids (array of int) and, with `offsets`, first and behind (character places of each token) of every row.

    Each match of `pattern` is merged by itself by the ranks of the file, as the rank file's own library does it. There are no
    special tokens. Null texts are empty and give no ids. Repeated rows each give a row.
    """
    narrow = docs.select(id, F.coalesce(F.col(text), F.lit("")).cast("binary").alias("_text"))
    schema = narrow.drop("_text").schema.add("ids", T.ArrayType(T.IntegerType()))
    if offsets:
        schema = schema.add("first", T.ArrayType(T.IntegerType())).add("behind", T.ArrayType(T.IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary, pattern)
        for batch in batches:
            for part in slices(batch, "_text", 2 << 20):
                raws = part.column("_text").to_pylist()
                ids = enc.encode([b.decode("utf-8", "replace") for b in raws])
                columns = [part.column(0), lists([np.frombuffer(x, "<u4") for x in ids])]
                if offsets:
                    spans = [character_offsets(raw, enc.widths[np.frombuffer(x, "<u4")]) for raw, x in zip(raws, ids, strict=True)]
                    columns += [lists([a for a, _ in spans]), lists([b for _, b in spans])]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return map_batches(narrow, run, schema)


def lists(arrays: list[np.ndarray]) -> pa.Array:
    bounds = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(arrays).astype(np.int32)))


def decode(encoded: DataFrame, vocabulary: str, pattern: str, id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Columns `id` and raw (binary) of every row: the bytes of all tokens in turn, through the byte table.

    Bytes are joined before anyone reads characters in them, so a character split between tokens is whole again. Null ids give
    no bytes; an id that the vocabulary lacks is an error.
    """
    narrow = encoded.select(id, F.coalesce(F.col(ids), F.array().cast("array<int>")).alias("_ids"))
    schema = narrow.drop("_ids").schema.add("raw", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = encoder(vocabulary, pattern).pieces
        for batch in batches:
            column = batch.column("_ids")
            bounds = column.offsets.to_numpy()
            flat = column.values.to_numpy()
            for start in range(0, batch.num_rows, 256):
                stop = min(start + 256, batch.num_rows)
                raws = [b"".join(map(pieces.__getitem__, flat[bounds[k] : bounds[k + 1]].tolist())) for k in range(start, stop)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, stop - start), pa.array(raws, pa.binary())], names=schema.names)

    return map_batches(narrow, run, schema)


def digests(docs: DataFrame, vocabulary: str, pattern: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """`id`, n_tokens, ids_sha256 (decimal ids joined by commas) and decoded_sha256 of every row: a round trip of `encode` and `decode`."""
    narrow = docs.select(id, F.coalesce(F.col(text), F.lit("")).cast("binary").alias("_text"))
    schema = narrow.drop("_text").schema.add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary, pattern)
        decimal = [str(i) for i in range(len(enc.pieces))]
        for batch in batches:
            for part in slices(batch, "_text", 2 << 20):
                found = enc.encode([b.decode("utf-8", "replace") for b in part.column("_text").to_pylist()])
                ids = [np.frombuffer(x, "<u4").tolist() for x in found]
                written = [hashlib.sha256(",".join(map(decimal.__getitem__, x)).encode()).hexdigest() for x in ids]
                back = [hashlib.sha256(b"".join(map(enc.pieces.__getitem__, x))).hexdigest() for x in ids]
                columns = [part.column(0), pa.array(list(map(len, ids)), pa.int64()), pa.array(written), pa.array(back)]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return map_batches(narrow, run, schema)
