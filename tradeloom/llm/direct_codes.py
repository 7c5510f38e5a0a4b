"""Token files with random access: directly addressable codes.

Ids are cut into 8-bit chunks, lowest first. Level 0 holds the lowest chunk of
every id; a bitmap says which ids go on, and level 1 holds the next chunk of
those only, and so on. The position of an id on the next level is the number
of set bits before it, which a directory with one count per 512 bits answers
with one short popcount. Any token is read from as many bytes as it has
chunks; no block is decoded.

Layout of a file (little-endian)::

    "TLDAC001"  documents:u64  tokens:u64  levels:u64
    ids:i64[documents]  has_id:u8[documents]  ends:u64[documents]
    per level:  count:u64  chunks:u8[count]  bitmap:u8[ceil(count/8)]
                directory:u64[ceil(count/512)]

``ends`` are token positions inside the file. The last level's bitmap is zero.
Files hold a bounded number of tokens, except that a document is not split.
"""

from __future__ import annotations

import io
import os
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.llm.common import (
    id_and_text,
    new_folder,
    one_task_each,
    open_for_reading,
    open_for_writing,
    release_memory,
    stage,
    text_key,
    text_slices,
)
from tradeloom.llm.vocabulary import encoder

MAGIC = b"TLDAC001"
END_ID = 0
BLOCK = 512
FILE_TOKENS = 2_000_000
ENCODED_BYTES = 1 << 20  # of texts that are encoded together


def encode_levels(ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Chunks, continuation bitmap and directory of each level."""
    levels, rest = [], ids.astype(np.uint32)
    while True:
        goes_on = rest > 0xFF
        bitmap = np.packbits(goes_on, bitorder="little")
        padded = np.zeros(-(-len(rest) // BLOCK) * BLOCK, dtype=bool)
        padded[: len(rest)] = goes_on
        per_block = padded.reshape(-1, BLOCK).sum(axis=1)
        directory = (np.cumsum(per_block) - per_block).astype("<u8")
        levels.append(((rest & 0xFF).astype(np.uint8), bitmap, directory))
        rest = rest[goes_on] >> 8
        if not len(rest):
            return levels


def write_codes(out, ids: list[int | None], tokens: list[np.ndarray]) -> int:
    """Write one file and return its number of tokens."""
    ends = np.cumsum([len(t) for t in tokens]).astype("<u8")
    joined = np.concatenate(tokens) if tokens else np.zeros(0, np.uint32)
    levels = encode_levels(joined)
    out.write(MAGIC + struct.pack("<QQQ", len(ids), len(joined), len(levels)))
    out.write(np.array([i or 0 for i in ids], dtype="<i8").tobytes())
    out.write(np.array([i is not None for i in ids], dtype=np.uint8).tobytes())
    out.write(ends.tobytes())
    for chunks, bitmap, directory in levels:
        out.write(struct.pack("<Q", len(chunks)))
        for part in (chunks, bitmap, directory):
            out.write(part.tobytes())
    return len(joined)


class CodeFile:
    """Reads a token file: one token, a range, or whole documents."""

    def __init__(self, data: bytes):
        view = io.BytesIO(data)
        if view.read(8) != MAGIC:
            raise ValueError("not a token file")
        documents, self.tokens, count = struct.unpack("<QQQ", view.read(24))
        ids = np.frombuffer(view.read(8 * documents), "<i8")
        known = np.frombuffer(view.read(documents), np.uint8)
        self.ids = [int(i) if k else None for i, k in zip(ids, known, strict=True)]
        self.ends = np.frombuffer(view.read(8 * documents), "<u8").astype(np.int64)
        self.levels = []
        for _ in range(count):
            (n,) = struct.unpack("<Q", view.read(8))
            chunks = np.frombuffer(view.read(n), np.uint8)
            bitmap = np.frombuffer(view.read(-(-n // 8)), np.uint8)
            directory = np.frombuffer(view.read(8 * -(-n // BLOCK)), "<u8")
            self.levels.append((chunks, bitmap, directory))

    def token(self, at: int) -> int:
        """The id at one position."""
        if not 0 <= at < self.tokens:
            raise IndexError(at)
        value = shift = 0
        for chunks, bitmap, directory in self.levels:
            value |= int(chunks[at]) << shift
            shift += 8
            if not bitmap[at >> 3] >> (at & 7) & 1:
                return value
            start = at // BLOCK * BLOCK
            bits = int.from_bytes(bitmap[start >> 3 : (at >> 3) + 1].tobytes(), "little")
            at = int(directory[at // BLOCK]) + (bits & ((1 << (at - start)) - 1)).bit_count()
        raise ValueError("the last level goes on")

    def all_tokens(self) -> np.ndarray:
        """All ids, level by level."""
        values = self.levels[0][0].astype(np.uint32)
        where = None  # positions that have a chunk on this level; None for all
        for level, (chunks, bitmap, _) in enumerate(self.levels):
            if level:
                values[where] |= chunks.astype(np.uint32) << np.uint32(8 * level)
            goes_on = np.flatnonzero(np.unpackbits(bitmap, count=len(chunks), bitorder="little"))
            where = goes_on if where is None else where[goes_on]
        return values

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """``(id, start, ids)`` of each document, start within the file."""
        values, start = self.all_tokens(), 0
        for key, end in zip(self.ids, self.ends.tolist(), strict=True):
            yield key, start, values[start:end]
            start = end


_MANIFEST = "part int, seq int, path string, documents long, tokens long"


def write_token_files(
    docs: DataFrame,
    tokenizer: str,
    folder: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    file_tokens: int = FILE_TOKENS,
) -> DataFrame:
    """Write ``docs`` to token files in id order; returns the staged manifest.

    Rows are ``(part, seq, path, documents, tokens, start)``; ``part`` and
    ``seq`` are the order of the files and ``start`` the tokens before each. A
    NULL text is empty and has only the end id. NULL ids come first; rows with
    equal ids are ordered by a key of their text. No rows give no files. A file
    gets its own name in every attempt and counts only through the manifest,
    so lost or repeated tasks leave nothing wrong behind.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, size = TaskContext.get().partitionId(), 0, 0
        codes = encoder(tokenizer)
        end = np.array([END_ID], dtype=np.uint32)
        ids: list[int | None] = []
        tokens: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            nonlocal seq, size
            path = os.path.join(folder, f"tokens-{part:05d}-{seq:05d}-{uuid.uuid4().hex}.dac")
            with open_for_writing(path) as out:
                size = write_codes(out, ids, tokens)
            row = {"part": [part], "seq": [seq], "path": [path], "documents": [len(ids)], "tokens": [size]}
            ids.clear()
            tokens.clear()
            seq, size = seq + 1, 0
            return pa.RecordBatch.from_pydict(row, schema=_manifest_schema())

        for batch in text_slices(batches, "text", ENCODED_BYTES):
            keys, texts = batch.column("id").to_pylist(), batch.column("text").to_pylist()
            for key, found in zip(keys, codes.encode(texts), strict=True):
                ids.append(key)
                tokens.append(np.concatenate([found, end]))
                size += len(found) + 1
                if size >= file_tokens:
                    yield flush()
        if ids:
            yield flush()
        release_memory()

    rows = id_and_text(docs, id_col, text_col).withColumn("key", text_key(F.col("text")))
    placed = rows.repartitionByRange("id", "key").sortWithinPartitions("id", "key").select("id", "text")
    files = stage(placed.mapInArrow(run, _MANIFEST), "token-files")
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    # one row per file: bounded by the data over the file size
    return files.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def _manifest_schema() -> pa.Schema:
    return pa.schema(
        [("part", pa.int32()), ("seq", pa.int32()), ("path", pa.string()), ("documents", pa.int64()), ("tokens", pa.int64())]
    )


def read_token_files(manifest: DataFrame) -> DataFrame:
    """``(id, start, n_tokens, ids_crc32)`` per document, read from the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist(), strict=True):
                with open_for_reading(path) as f:
                    rows = [
                        (key, start + at, len(ids), zlib.crc32(ids.astype("<u4", copy=False)))
                        for key, at, ids in CodeFile(f.read()).documents()
                    ]
                columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["id", "start", "n_tokens", "ids_crc32"])

    return one_task_each(manifest.select("path", "start")).mapInArrow(
        run, "id long, start long, n_tokens long, ids_crc32 long"
    )


def tokens_on_disk(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", file_tokens: int = FILE_TOKENS
) -> DataFrame:
    """Write ``docs`` to fresh token files and read them back."""
    folder = new_folder(docs.sparkSession, "tokens")
    return read_token_files(write_token_files(docs, tokenizer, folder, id_col, text_col, file_tokens))
