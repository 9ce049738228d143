"""Token ids in directly addressable files.

An id is split into chunks of eight bits.  Level 0 holds the lowest chunk of every token;
one bit per token says whether a higher chunk follows on the next level, which therefore
holds only the tokens that need it.  A directory of ranks (ones before each block of 512
bits) finds a token's place on the next level, so any token can be read from its position
without decoding others.

File layout, little-endian: ``TOKD``, levels u32, tokens u64, documents u64; per level:
items u64, the chunks, the bits (padded to whole blocks), one rank u64 per block; then
per document its id i64, a flag u8 (0: the id is NULL) and its first token in the file u64.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratafold.llm.rows import slices
from stratafold.llm.tokens import WordEncoder
from stratafold.workspace import fresh_path, materialise

MAGIC = b"TOKD"
CHUNK_BITS = 8
BLOCK_BITS = 512
END_ID = 1
# A file is closed once it holds this many tokens; a longer document makes a longer file.
TOKENS_PER_FILE = 4_000_000
# Tasks that read files back, at most; each opens its files one after the other.
READ_TASKS = 20_000

MANIFEST = "part int, number int, name string, n_docs long, n_tokens long"
DECODED = "name string, position long, doc_id long, start long, n_tokens long, ids_crc32 long"


def _pack_level(values: np.ndarray) -> tuple[bytes, np.ndarray]:
    """A level's bytes, and what of the values is left for the next one."""
    higher = values >> CHUNK_BITS
    follows = higher > 0
    bits = np.zeros(-(-len(values) // BLOCK_BITS) * BLOCK_BITS, np.uint8)
    bits[: len(values)] = follows
    ones = bits.reshape(-1, BLOCK_BITS).sum(1, dtype=np.uint64)
    ranks = np.concatenate([np.zeros(1, np.uint64), np.cumsum(ones, dtype=np.uint64)])[: len(ones)]
    chunks = (values & ((1 << CHUNK_BITS) - 1)).astype(np.uint8)
    level = struct.pack("<Q", len(values)) + chunks.tobytes() + np.packbits(bits, bitorder="little").tobytes() + ranks.astype("<u8").tobytes()
    return level, higher[follows]


def pack(doc_ids: list[int | None], ids: list[np.ndarray]) -> bytes:
    """A file's content for documents in order; ids are unsigned 32-bit."""
    values = np.concatenate(ids).astype(np.uint32) if ids else np.empty(0, np.uint32)
    levels, rest = [], values
    while len(rest) or not levels:
        level, rest = _pack_level(rest)
        levels.append(level)
    starts = np.cumsum([0] + [len(x) for x in ids])[:-1].astype("<u8")
    names = np.array([d or 0 for d in doc_ids], "<i8")
    known = np.array([d is not None for d in doc_ids], np.uint8)
    head = MAGIC + struct.pack("<IQQ", len(levels), len(values), len(doc_ids))
    return head + b"".join(levels) + names.tobytes() + known.tobytes() + starts.tobytes()


class TokenFile:
    """Reads a file's content: any token by position, a document, or all."""

    def __init__(self, content: bytes | memoryview):
        if bytes(content[:4]) != MAGIC:
            raise ValueError("not a token file")
        levels, self.n_tokens, n_docs = struct.unpack_from("<IQQ", content, 4)
        at, self._levels = 24, []
        for _ in range(levels):
            (items,) = struct.unpack_from("<Q", content, at)
            blocks = -(-items // BLOCK_BITS)
            chunks = np.frombuffer(content, np.uint8, items, at + 8)
            bits = np.frombuffer(content, np.uint8, blocks * BLOCK_BITS // 8, at + 8 + items)
            at += 8 + items + len(bits)
            self._levels.append((chunks, bits, np.frombuffer(content, "<u8", blocks, at)))
            at += 8 * blocks
        names = np.frombuffer(content, "<i8", n_docs, at)
        known = np.frombuffer(content, np.uint8, n_docs, at + 8 * n_docs)
        self.doc_ids = [int(d) if k else None for d, k in zip(names, known)]
        self.starts = np.frombuffer(content, "<u8", n_docs, at + 9 * n_docs)

    def __len__(self) -> int:
        return self.n_tokens

    def __getitem__(self, position: int) -> int:
        """The id at a position: one chunk and at most one block's bits per level."""
        if not 0 <= position < self.n_tokens:
            raise IndexError(position)
        value = 0
        for number, (chunks, bits, ranks) in enumerate(self._levels):
            value |= int(chunks[position]) << (CHUNK_BITS * number)
            if not bits[position >> 3] >> (position & 7) & 1:
                break
            block = position // BLOCK_BITS
            inside = np.unpackbits(bits[block * BLOCK_BITS // 8 : (position >> 3) + 1], bitorder="little")
            position = int(ranks[block]) + int(inside[: position - block * BLOCK_BITS].sum())
        return value

    def all(self) -> np.ndarray:
        """Every id in order, as unsigned 32-bit integers."""
        value = np.empty(0, np.uint32)
        for chunks, bits, _ in reversed(self._levels):
            follows = np.unpackbits(bits, bitorder="little", count=len(chunks)).astype(bool)
            here = chunks.astype(np.uint32)
            here[follows] |= value << CHUNK_BITS
            value = here
        return value

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """Each document's id, first position and ids."""
        values, ends = self.all(), [*map(int, self.starts[1:]), self.n_tokens]
        for doc_id, start, end in zip(self.doc_ids, map(int, self.starts), ends):
            yield doc_id, start, values[start:end]


def _store(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def _write(folder: str, name: str, content: bytes) -> None:
    store, root = _store(folder)
    store.create_dir(root, recursive=True)
    with store.open_output_stream(f"{root}/{name}") as out:
        out.write(content)


def _read(folder: str, name: str) -> pa.Buffer:
    store, root = _store(folder)
    with store.open_input_file(f"{root}/{name}") as file:
        return file.read_buffer()


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int = END_ID,
    tokens_per_file: int = TOKENS_PER_FILE,
) -> DataFrame:
    """Encode the texts, write files in ascending doc_id order, return their manifest.

    Needs columns ``doc_id`` and ``text``.  NULL text is empty: such a document has the end
    id alone.  NULL doc_ids come first, equal ones in any order.  The order of files is
    (part, number); only files that the manifest names count, so a task that runs again
    after a lost executor leaves at most a file nobody reads.  No documents, no files.
    """

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder.of(tokenizer)
        task = TaskContext.get()
        part, attempt, number = task.partitionId(), task.taskAttemptId(), 0
        names: list[int | None] = []
        ids: list[np.ndarray] = []
        held = 0

        def close() -> pa.RecordBatch:
            name = f"part-{part:06d}-{number:06d}-{attempt}-{uuid.uuid4().hex[:8]}.tok"
            _write(folder, name, pack(names, ids))
            row = [[part], [number], [name], [len(names)], [held]]
            return pa.record_batch([pa.array(c, t) for c, t in zip(row, (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()))], ["part", "number", "name", "n_docs", "n_tokens"])

        for batch in slices(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                names.append(doc_id)
                ids.append(np.append(np.frombuffer(encoder.encode(text), "<u4"), np.uint32(end_id)))
                held += len(ids[-1])
                if held >= tokens_per_file:
                    yield close()
                    names, ids, held, number = [], [], 0, number + 1
        if names:
            yield close()

    # Equal doc_ids, NULL among them, are spread by their text, so none fills a range.
    spread = F.xxhash64("text")
    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id", spread).sortWithinPartitions("doc_id", spread)
    return materialise(ordered.mapInArrow(encode, MANIFEST), "token-manifest")


def file_starts(manifest: DataFrame) -> DataFrame:
    """The manifest with ``start``, the tokens in all files before.

    Sums per part are accumulated over one row per part; files only within their part.
    """
    parts = manifest.groupBy("part").agg(F.sum("n_tokens").alias("part_tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("part_start", F.coalesce(F.sum("part_tokens").over(before), F.lit(0)))
    within = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.join(parts, "part").withColumn("start", F.col("part_start") + F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))


def read_token_files(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """One row per document, read from the files: doc_id, start, n_tokens, ids_crc32, and the file's name."""

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, rows=1):
            name, before = batch.column(0)[0].as_py(), batch.column(1)[0].as_py()
            found = [(p, d, before + s, len(v), zlib.crc32(v.astype("<u4").tobytes())) for p, (d, s, v) in enumerate(TokenFile(_read(folder, name)).documents())]
            columns = list(zip(*found)) or [[]] * 5
            yield pa.record_batch([pa.array([name] * len(found), pa.string())] + [pa.array(c, pa.int64()) for c in columns], ["name", "position", "doc_id", "start", "n_tokens", "ids_crc32"])

    # Only names and starts travel: a task opens the files of its rows itself, and nothing is joined to what it reads.
    tasks = min(max(manifest.count(), 1), READ_TASKS)
    documents = file_starts(manifest).select("name", "start").repartition(tasks, "name").mapInArrow(decode, DECODED)
    return documents.select("doc_id", "start", "n_tokens", "ids_crc32", F.col("name").alias("file"))


def token_files(spark: SparkSession, docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write the documents' tokens to a new shared folder and read them back."""
    folder = fresh_path(spark, "token-files")
    return read_token_files(spark, folder, write_token_files(docs, folder, tokenizer))
