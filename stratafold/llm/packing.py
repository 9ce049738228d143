"""Best-fit packing of documents into sequences of several permitted lengths.

Documents are cut into pieces no longer than the longest permitted length.  Shards of
pieces, dealt out evenly whatever their keys, are packed by best fit in descending order.
In a shard every choice of permitted lengths (each subset that holds the longest) is
tried: a new bin takes the length of that subset with the least cost per token it can still be
expected to hold, and at the end each bin shrinks to the cheapest length that holds
its contents.  The cheapest choice wins.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratafold.llm.rows import slices
from stratafold.llm.tokens import WordEncoder
from stratafold.workspace import materialise

# Permitted lengths and what a sequence of each costs: its tokens, attention that grows with the
# square, and a fixed part per sequence.
COSTS = {size: size + size * size / 32768 + 32 for size in (512, 1024, 2048, 4096)}
# Pieces packed together; a shard wastes at most a few bins, so larger ones hardly pack better.
SHARD_PIECES = 100_000
# With more lengths the subsets to try would be too many.
MAX_LENGTHS = 8

PACKED = "bin_id long, bin_size int, bin_used int, doc_id long, piece int, start long, length int, bin_offset int"


def _fill(lengths: list[int], sizes: list[int], costs: Mapping[int, float]) -> list[list[int]]:
    """Bins (lists of positions) for lengths in descending order, opened in the given sizes."""
    open_bins: dict[int, list[int]] = {}
    free = 0  # bit r: a bin with r tokens of room is open
    bins: list[list[int]] = []
    rest = sum(lengths)
    for position, length in enumerate(lengths):
        fitting = free >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            number = open_bins[room].pop()
            if not open_bins[room]:
                free ^= 1 << room
            bins[number].append(position)
        else:
            room = min((s for s in sizes if s >= length), key=lambda s: (costs[s] / min(s, rest), s))
            number = len(bins)
            bins.append([position])
        rest -= length
        room -= length
        if room:
            held = open_bins.setdefault(room, [])
            if not held:
                free |= 1 << room
            held.append(number)
    return bins


def pack_lengths(lengths: list[int], costs: Mapping[int, float]) -> list[tuple[int, list[int]]]:
    """(size, positions) of each bin; every length is positive and at most the longest size."""
    order = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
    falling = [lengths[i] for i in order]
    sizes = sorted(costs)
    best: list[tuple[int, list[int]]] = []
    least = float("inf")
    for count in range(len(sizes)):
        for some in combinations(sizes[:-1], count):
            packed, cost = [], 0.0
            for held in _fill(falling, [*some, sizes[-1]], costs):
                used = sum(falling[i] for i in held)
                size = min((s for s in sizes if s >= used), key=lambda s: (costs[s], s))
                cost += costs[size]
                packed.append((size, [order[i] for i in held]))
            if cost < least:
                best, least = packed, cost
    return best


def token_lengths(docs: DataFrame, tokenizer: str, end_tokens: int = 1) -> DataFrame:
    """doc_id and n_tokens (with the end token) of every whole text; NULL text is empty."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder.of(tokenizer)
        for batch in slices(batches):
            lengths = [len(encoder.encode(t)) // 4 + end_tokens for t in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0).cast(pa.int64()), pa.array(lengths, pa.int64())], ["doc_id", "n_tokens"])

    return docs.select("doc_id", "text").mapInArrow(count, "doc_id long, n_tokens long")


def best_fit(lengths: DataFrame, costs: Mapping[int, float] = COSTS, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """Pack rows of (doc_id, n_tokens); one row per piece, with its bin and place in it.

    Other columns are not read.  A document longer than the longest permitted length gives
    full pieces and a remainder, ``start`` being a piece's first token in its document.  A
    length of zero, less, or NULL takes no room: one row with a NULL bin.  Repeated rows are
    packed each; a NULL doc_id is packed like any other.  Bin ids are unique, not dense.
    Within one shard the result depends only on its rows; how rows are dealt to shards
    follows the partitions they come in.
    """
    if not 1 <= len(costs) <= MAX_LENGTHS or min(costs) < 1:
        raise ValueError(f"from 1 to {MAX_LENGTHS} permitted lengths, all positive")
    longest = max(costs)
    lengths = materialise(lengths.select("doc_id", "n_tokens"), "pack-lengths")
    size = F.coalesce(F.col("n_tokens"), F.lit(0))
    last = F.greatest(F.ceil(size / longest).cast("long") - 1, F.lit(0))
    pieces = lengths.select("doc_id", size.alias("n"), F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("piece")).select(
        "doc_id",
        F.col("piece").cast("int").alias("piece"),
        (F.col("piece") * longest).alias("start"),
        F.greatest(F.least(F.col("n") - F.col("piece") * longest, F.lit(longest)), F.lit(0)).cast("int").alias("length"),
    )
    total = lengths.agg(F.coalesce(F.sum(F.greatest(F.ceil(size / longest), F.lit(1))), F.lit(0))).first()[0]

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [b for b in batches if b.num_rows]
        if not rows:
            return
        # Rows may arrive in another order when a task runs again, so they are put in order first.
        data = pa.Table.from_batches(rows).sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending")])
        length = data.column("length").to_pylist()
        filled = data.slice(0, sum(1 for n in length if n > 0)).num_rows
        bin_id, bin_size, bin_used, offset = [None] * len(length), [None] * len(length), [None] * len(length), [None] * len(length)
        shard = TaskContext.get().partitionId() << 32
        for number, (room, held) in enumerate(pack_lengths(length[:filled], costs)):
            used = sum(length[i] for i in held)
            at = 0
            for i in held:
                bin_id[i], bin_size[i], bin_used[i], offset[i] = shard + number, room, used, at
                at += length[i]
        out = pa.table(
            {
                "bin_id": pa.array(bin_id, pa.int64()),
                "bin_size": pa.array(bin_size, pa.int32()),
                "bin_used": pa.array(bin_used, pa.int32()),
                "doc_id": data.column("doc_id"),
                "piece": data.column("piece"),
                "start": data.column("start"),
                "length": data.column("length"),
                "bin_offset": pa.array(offset, pa.int32()),
            }
        )
        yield from out.to_batches(max_chunksize=10_000)

    # Dealt out in turn, not by key: a hot document id cannot fill a shard.
    return pieces.repartition(max(1, -(-int(total) // shard_pieces))).mapInArrow(pack, PACKED)
