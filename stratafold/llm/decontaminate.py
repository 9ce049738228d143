"""Benchmark items in documents, found although some characters differ.

An item that occurs with at most e edits has, of e + 1 pieces, at least one unchanged.  So
each item is cut into that many pieces, an automaton finds exact hits of all pieces in one
pass over a text, and around each hit Myers' bit-parallel distance tells whether the item is
there.  Benchmark items are the stated query set: they go to the tasks in blocks of bounded
size, and every block meets all documents.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratafold.llm.rows import slices

# Edits allowed, as a share of an item's characters.
ERROR_RATE = 0.05
# UTF-8 bytes of item texts that go to the tasks at once; an automaton takes about 40 times that.
BLOCK_BYTES = 1_000_000

HITS = "doc_id long, item_id long, distance int, start int, stop int"


def plain(text: str | None) -> str:
    """Lower case, white space as single blanks; NULL is empty.  Places refer to this form."""
    return " ".join((text or "").lower().split())


def pieces(item: str, edits: int) -> list[tuple[int, str]]:
    """(offset, piece): ``edits`` + 1 pieces of nearly equal length that make up the item."""
    cuts = [len(item) * k // (edits + 1) for k in range(edits + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def _masks(item: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, character in enumerate(item):
        masks[character] = masks.get(character, 0) | 1 << i
    return masks


def myers(masks: dict[str, int], length: int, text: Iterable[str]) -> tuple[int, int]:
    """(distance, stop) of the best match of a pattern anywhere in ``text``, the first such stop."""
    full, top = (1 << length) - 1, 1 << (length - 1)
    plus, minus, score = full, 0, length
    best, stop = length, 0
    for place, character in enumerate(text, 1):
        equal = masks.get(character, 0)
        across = equal | minus
        down = (((equal & plus) + plus) ^ plus) | equal
        up = minus | (full & ~(down | plus))
        low = plus & down
        if up & top:
            score += 1
        elif low & top:
            score -= 1
        up <<= 1
        low <<= 1
        plus = (low | ~(across | up)) & full
        minus = up & across & full
        if score < best:
            best, stop = score, place
    return best, stop


class Items:
    """A block of items, ready to be found in plain texts."""

    def __init__(self, items: list[tuple[int | None, str]], error_rate: float):
        import ahocorasick

        self._items = []
        self._automaton = ahocorasick.Automaton()
        for item_id, item in items:
            edits = int(len(item) * error_rate)
            number = len(self._items)
            self._items.append((item_id, edits, len(item), _masks(item), _masks(item[::-1])))
            for offset, piece in pieces(item, edits):
                ends_at = offset + len(piece)
                if piece not in self._automaton:
                    self._automaton.add_word(piece, [])
                self._automaton.get(piece).append((number, ends_at))
        if self._items:
            self._automaton.make_automaton()

    def find(self, text: str) -> list[tuple[int | None, int, int, int]]:
        """(item_id, distance, start, stop) of each item's best match within its budget."""
        if not self._items or not text:
            return []
        windows: dict[int, list[list[int]]] = {}
        for at, holders in self._automaton.iter(text):
            for number, ends_at in holders:
                _, edits, length, _, _ = self._items[number]
                start = at + 1 - ends_at - edits
                spans = windows.setdefault(number, [])
                if spans and start <= spans[-1][1]:
                    spans[-1][0] = min(spans[-1][0], start)
                    spans[-1][1] = max(spans[-1][1], start + length + 2 * edits)
                else:
                    spans.append([start, start + length + 2 * edits])
        found = []
        for number, spans in windows.items():
            item_id, edits, length, masks, backward = self._items[number]
            matches = []
            for low, high in spans:
                low = max(0, low)
                distance, stop = myers(masks, length, text[low:high])
                if distance <= edits:
                    stop += low
                    _, size = myers(backward, length, text[max(0, stop - length - edits) : stop][::-1])
                    matches.append((distance, stop - size, stop))
            if matches:
                found.append((item_id, *min(matches)))
        return found


def item_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[int | None, str]]]:
    """The items in blocks of about ``block_bytes``; one block is on the driver at a time.  Empty items are left out."""
    items = benchmark.select("item_id", "text").filter(F.length(F.trim("text")) > 0)
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_bytes))
    for number in range(blocks):
        chosen = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == number).collect()
        yield [(r["item_id"], plain(r["text"])) for r in chosen if plain(r["text"])]


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document and item found in it: doc_id, item_id, distance, start, stop.

    Needs ``doc_id`` and ``text``, and ``item_id`` and ``text`` of the benchmark; both are
    compared in ``plain`` form.  NULL or empty texts hold nothing, NULL or empty items are
    nowhere; ids may be NULL and are passed on.  Repeated rows give repeated rows.  Of an
    item's matches in a document the one with the least distance, then the first, is given.
    """
    found = None
    for block in item_blocks(benchmark, block_bytes):

        def find(batches: Iterable[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            items = Items(block, error_rate)
            for batch in slices(batches):
                rows = [(d, *hit) for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for hit in items.find(plain(t))]
                columns = list(zip(*rows)) or [[]] * 5
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
                yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "item_id", "distance", "start", "stop"])

        hits = docs.select("doc_id", "text").mapInArrow(find, HITS)
        found = hits if found is None else found.unionByName(hits)
    return found


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs``, all columns, in which no benchmark item is found."""
    text = docs.columns.index("text")
    for block in item_blocks(benchmark, block_bytes):

        def clean(batches: Iterable[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            items = Items(block, error_rate)
            for batch in slices(batches):
                yield batch.filter(pa.array([not items.find(plain(t)) for t in batch.column(text).to_pylist()], pa.bool_()))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
