"""The best documents for each query by summed term impacts, with norm buckets that prune.

A document is a vector of impacts over the terms that occur in the queries, a query one of
weights times repeats; a score is their product.  Documents are met in order of falling length
(norm) in buckets: a query passes over a bucket whose longest vector cannot reach its tenth
best score so far (Cauchy-Schwarz), and within a bucket over documents whose product on the
query's heaviest coordinates, plus the most the remaining length allows, cannot.  What is left
is scored exactly, in integers.  Queries are the stated set: they go to the tasks in blocks of
bounded size, and every block meets all documents.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from stratafold.llm.rows import slices
from stratafold.workspace import materialise

TOP = 10
# UTF-8 bytes of queries that go to the tasks at once.
BLOCK_BYTES = 200_000
# Documents of a bucket; about as many of the longest vectors of all give every query its first bound.
BUCKET = 1_024
# Share of a query's squared length that its focus coordinates hold.
FOCUS = 0.5
# Room for rounding of bounds, which are floating point numbers; scores are integers.
ROOM = 1 + 1e-9

# Bytes that end a term, and the case fold of A-Z.
_BREAKS = [b for b in range(128) if not chr(b).isalnum()]
_FOLD = bytes.maketrans(bytes(_BREAKS) + b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b" " * len(_BREAKS) + b"abcdefghijklmnopqrstuvwxyz")

POSTED = "doc_id long, n long, terms array<int>, counts array<long>"
VECTORS = "doc_id long, norm double, terms array<int>, impacts array<long>"
HITS = "number int, item_id long, doc_id long, score long"


def terms_of(text: str | bytes | None) -> list[bytes]:
    """Maximal stretches of ASCII letters and digits and of all other characters beyond ASCII; A-Z in lower case."""
    raw = text if isinstance(text, bytes) else (text or "").encode("utf-8", "replace")
    return raw.translate(_FOLD).split()


@dataclass
class Block:
    """Some queries: their number and item_id, and their terms as (positions in ``terms``, repeats)."""

    names: list[tuple[int, int | None]]
    queries: list[tuple[np.ndarray, np.ndarray]]
    terms: list[bytes]


def query_blocks(items: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    """The queries in blocks of about ``block_bytes``; one block is on the driver at a time.  Without a term there is nothing to find."""
    texts = items.select("item_id", "text").filter("text IS NOT NULL")
    total = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks, number = max(1, -(-total // block_bytes)), 0
    for part in range(blocks):
        chosen = texts.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == part).collect()
        place: dict[bytes, int] = {}
        block = Block([], [], [])
        for row in sorted(chosen, key=lambda r: (r["item_id"] is None, r["item_id"], r["text"])):
            counted = Counter(place.setdefault(t, len(place)) for t in terms_of(row["text"]))
            if counted:
                block.names.append((number, row["item_id"]))
                block.queries.append((np.array(list(counted), np.int64), np.array(list(counted.values()), np.int64)))
                number += 1
        block.terms = list(place)
        if block.names:
            yield block


def _posted(docs: DataFrame, terms: list[bytes]) -> DataFrame:
    """Per document with terms its number of terms and, of those asked for, positions and occurrences."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {t: i for i, t in enumerate(terms)}
        for batch in slices(batches):
            rows = []
            for doc_id, text in zip(batch.column(0).cast(pa.int64()).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                found = terms_of(text)
                if found:
                    held = Counter(filter(None.__ne__, map(place.get, found)))
                    rows.append((doc_id, len(found), list(held), list(held.values())))
            columns = list(zip(*rows)) or [[]] * 4
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()))
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "n", "terms", "counts"])

    return docs.select("doc_id", "text").mapInArrow(count, POSTED)


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def _vectors(posted: DataFrame, documents: int, total: int) -> DataFrame:
    """Impacts of each document's terms, and the norm; documents with none of the terms have no vector."""

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, terms, counts = (batch.column(i) for i in (1, 2, 3))
            sizes = np.diff(terms.offsets.to_numpy())
            tf = counts.flatten().to_numpy()
            m = np.array([25 + 75 * x * documents // total for x in n.to_pylist()], np.int64)
            impacts = 1_000_000_000 * tf // (1000 * tf + 8 * np.repeat(m, sizes))
            ends = np.cumsum(np.concatenate([[0], sizes])).astype(np.int32)
            squares = np.concatenate([[0.0], np.cumsum(impacts.astype(np.float64) ** 2)])
            norms = np.sqrt(np.maximum(squares[ends[1:]] - squares[ends[:-1]], 0)) * ROOM
            listed = pa.ListArray.from_arrays(pa.array(ends), pa.array(impacts, pa.int64()))
            yield pa.record_batch([batch.column(0), pa.array(norms), terms, listed], ["doc_id", "norm", "terms", "impacts"])

    return posted.filter(F.size("terms") > 0).mapInArrow(measure, VECTORS)


class _Query:
    """A query's weights, its focus coordinates, and its best documents so far."""

    def __init__(self, name: tuple[int, int | None], terms: np.ndarray, weights: np.ndarray, least: int, top: int):
        self.name, self.terms, self.weights, self.least, self.top = name, terms, weights, least, top
        order = np.argsort(-weights, kind="stable")
        squares = np.cumsum(weights[order].astype(np.float64) ** 2)
        self.length = math.sqrt(squares[-1])
        many = int(np.searchsorted(squares, FOCUS * squares[-1])) + 1
        self.focus = order[:many]
        self.rest = math.sqrt(max(0.0, squares[-1] - squares[min(many, len(squares)) - 1])) * ROOM
        self.best: list[tuple[int, tuple[bool, int], int | None]] = []

    def meet(self, longest: float, norms: np.ndarray, impacts: np.ndarray, doc_ids: list[int | None]) -> None:
        """Take in a bucket: ``impacts`` has a row per document and a column per term of the block."""
        if longest * self.length * ROOM < self.least:
            return
        seen = impacts[:, self.terms[self.focus]]
        known = seen @ self.weights[self.focus]
        beyond = np.sqrt(np.maximum(norms**2 - (seen.astype(np.float64) ** 2).sum(1), 0) + 1)
        near = np.flatnonzero(known + beyond * self.rest * ROOM >= self.least)
        if not len(near):
            return
        scores = impacts[np.ix_(near, self.terms)] @ self.weights
        good = np.flatnonzero(scores >= self.least)
        for i in good[np.argsort(-scores[good], kind="stable")].tolist():
            score, doc_id = int(scores[i]), doc_ids[near[i]]
            if score < self.least:
                break
            # Of equal scores the smallest doc_id is best, NULL the last.
            entry = (score, (doc_id is not None, -(doc_id or 0)), doc_id)
            if len(self.best) < self.top:
                heapq.heappush(self.best, entry)
            elif entry[:2] > self.best[0][:2]:
                heapq.heapreplace(self.best, entry)
            if len(self.best) == self.top:
                self.least = max(self.least, self.best[0][0])


def _search(vectors: DataFrame, block: Block, weights: list[np.ndarray], least: list[int], top: int, bucket: int) -> DataFrame:
    """Each task's best documents for each query, none below ``least``; vectors come in order of falling norm."""
    width = len(block.terms)

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = [_Query(name, terms, w, bound, top) for name, (terms, _), w, bound in zip(block.names, block.queries, weights, least)]
        for batch in slices(batches, bucket):
            norms = batch.column(1).to_numpy()
            terms, values = batch.column(2), batch.column(3)
            sizes = np.diff(terms.offsets.to_numpy())
            impacts = np.zeros((len(norms), width), np.int64)
            impacts[np.repeat(np.arange(len(norms)), sizes), terms.flatten().to_numpy()] = values.flatten().to_numpy()
            ids, longest = batch.column(0).to_pylist(), float(norms[0])
            for query in queries:
                query.meet(longest, norms, impacts, ids)
        rows = [(*q.name, doc_id, score) for q in queries for score, _, doc_id in q.best]
        columns = list(zip(*rows)) or [[]] * 4
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
        yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], ["number", "item_id", "doc_id", "score"])

    return vectors.mapInArrow(search, HITS)


def _longest(vectors: DataFrame, wanted: int) -> DataFrame:
    """About ``wanted`` of the longest vectors: all above a limit from a histogram of the norms, thinned by hash where too many.

    Any rows would do, as their scores only give lower bounds; long ones give better ones.
    """
    step = F.floor(F.log2("norm") * 8)
    counts = vectors.filter("norm > 0").groupBy(step.alias("step")).agg(F.count("*").alias("rows")).orderBy(F.desc("step")).collect()
    rows, limit = 0, 0.0
    for row in counts:
        rows, limit = rows + row["rows"], 2 ** (row["step"] / 8) / ROOM
        if rows >= wanted:
            break
    return vectors.filter(F.col("norm") >= limit).filter(F.pmod(F.xxhash64("doc_id", "impacts"), F.lit(max(1, rows // wanted))) == 0)


def ranked_search(docs: DataFrame, items: DataFrame, top: int = TOP, block_bytes: int = BLOCK_BYTES, bucket: int = BUCKET) -> DataFrame:
    """The ``top`` best documents of each item: item_id, rank (from 1), doc_id, score.

    Needs ``doc_id`` and ``text``, and ``item_id`` and ``text`` of the items.  With N documents
    that have a term, L all their terms, n a document's terms, df the documents that hold a
    term and tf its occurrences in one: a term's weight w is floor(1000 ln((2N + 2) / (2df + 1))),
    m is 25 + (75 n N) div L, and a score sums w * ((10^9 tf) div (1000 tf + 8 m)) over the
    item's terms, repeats included.  Scores are above 0; equal ones are ranked by doc_id, NULL
    last.  NULL and empty texts have no terms: such a document counts nowhere, such an item
    finds nothing.  Every row is a document or an item of its own, also where ids repeat.
    """
    ranked, spark = None, docs.sparkSession
    for block in query_blocks(items, block_bytes):
        seen = Observation()
        sums = [F.count("*").alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("total")]
        posted = materialise(_posted(docs, block.terms), "lexical-posted", seen, sums)
        documents, total = seen.get["documents"], seen.get["total"]
        if not documents:
            break
        # As many rows as the block has terms.
        held = posted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect()
        df = {r["term"]: r["df"] for r in held}
        by_term = np.array([weight(documents, df.get(t, 0)) for t in range(len(block.terms))], np.int64)
        weights = [by_term[terms] * repeats for terms, repeats in block.queries]
        vectors = materialise(_vectors(posted, documents, total), "lexical-vectors")

        first = _search(_longest(vectors, bucket).sortWithinPartitions(F.desc("norm")), block, weights, [1] * len(weights), top, bucket)
        place = F.row_number().over(Window.partitionBy("number").orderBy(F.desc("score")))
        bounds = {r["number"]: r["score"] for r in first.withColumn("place", place).filter(F.col("place") == top).collect()}
        least = [bounds.get(number, 1) for number, _ in block.names]
        # A vector too short for every query is not read again.
        shortest = min(bound / (math.sqrt(float((w.astype(np.float64) ** 2).sum())) * ROOM) if w.any() else math.inf for bound, w in zip(least, weights))
        reaching = vectors.filter(F.col("norm") >= shortest).sortWithinPartitions(F.desc("norm"))
        found = materialise(_search(reaching, block, weights, least, top, bucket), "lexical-found")
        ranked = found if ranked is None else ranked.unionByName(found)
    if ranked is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    # Spark keeps the first rows of each window before the shuffle as well.
    placed = ranked.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return placed.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


_TERMS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

SQL = f"""
WITH docs AS (
    SELECT doc_id, {_TERMS} AS terms FROM documents
), sized AS (
    SELECT doc_id, terms, CAST(len(terms) AS BIGINT) AS n FROM docs WHERE len(terms) > 0
), sums AS (
    SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(n) AS BIGINT) AS n_all FROM sized
), asked AS (
    SELECT item_id, term, count(*) AS repeats FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL
), held AS (
    SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, n, unnest(terms) AS term FROM sized)
    WHERE term IN (SELECT term FROM asked) GROUP BY ALL
), weights AS (
    SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM held, sums GROUP BY term, n_docs
), scored AS (
    SELECT item_id, doc_id,
           CAST(sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_all)))) AS BIGINT) AS score
    FROM asked JOIN held USING (term) JOIN weights USING (term), sums GROUP BY item_id, doc_id
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0
) WHERE rank <= {TOP}
"""
