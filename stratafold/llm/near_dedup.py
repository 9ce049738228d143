"""Near-duplicate documents by bottom-k sketches, confirmed on full shingle sets.

One hash function orders all shingles; a document's sketch is the smallest ``SKETCH``
values of its set.  Two documents similar enough share at least ``least_shared`` retained
values (see there), so by the prefix principle they meet in the inverted list of one of
their rarest retained values, and only those lists are built: a passage that very many documents
share fills a list only for documents that consist of such passages.

A list is not expanded into pairs.  First its members meet the list's smallest document;
what is linked then forms components.  Only lists that still span several components are
looked at again, in tasks of bounded size, and only for links between components.
Candidates pass an estimate on the union's sketch; every link is confirmed on full sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratafold.llm.graph import components
from stratafold.llm.rows import release_memory, slices, unused_name
from stratafold.operators.joins import broadcast_if_small
from stratafold.workspace import materialise

WORDS = 5
PERCENT = 85
# Values a sketch retains.
SKETCH = 32
# Chance that two linked documents share fewer retained values than they are searched by.
MISS = 3e-8
# Shingles a task compares at once; larger lists are cut into blocks that meet two by two.
BLOCK_SHINGLES = 2_000_000
# Members of short lists that are looked at in one go; a list with a tenth as many is long.
LANE_ROWS = 2_000
# A task with more candidates than this per member compares full sets itself.
DENSE = 4

_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def shingle_set(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles; empty without words.

    A-Z are lower-cased, words end at ASCII white space; with fewer words than a shingle
    has, all of them are one shingle.
    """
    found = (text or "").encode("utf-8", "replace").lower().split()
    if not found:
        return np.empty(0, np.int64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    width = min(words, len(found))
    last = len(found) - width + 1
    mixed = np.full(last, width, np.uint64)
    for i in range(width):
        mixed = (mixed ^ hashes[i : i + last]) * _STEP
        mixed ^= mixed >> np.uint64(29)
    mixed = mixed * _MIX
    mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed.view(np.int64))


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0] + [len(a) for a in arrays]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(arrays) if arrays else np.empty(0, np.int64)))


def sketches(docs: DataFrame, words: int, keep: int | None) -> DataFrame:
    """doc_id, n_shingles, set_key (128 bits that name the set) and the ``keep`` smallest hashes (None: all)."""

    def sketch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [shingle_set(t, words) for t in batch.column(1).to_pylist()]
            yield pa.record_batch(
                [
                    batch.column(0).cast(pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                    _lists([s[:keep] for s in sets]),
                ],
                ["doc_id", "n_shingles", "set_key", "hashes"],
            )

    return docs.select("doc_id", "text").mapInArrow(sketch, "doc_id long, n_shingles long, set_key binary, hashes array<long>")


def least_shared(percent: int, miss: float = MISS) -> int:
    """Retained values two linked documents share, but for the chance ``miss``: 14 at 85 percent, 12 at 80.

    Of the ``SKETCH`` smallest values of the union of two linked sets, each is common to both with a chance
    of at least ``percent``; they are drawn without replacement, so a binomial tail bounds the chance of fewer.
    """
    share = percent / 100
    below, least = (1 - share) ** SKETCH, 0
    while below <= miss and least < SKETCH:
        least += 1
        below += math.comb(SKETCH, least) * share**least * (1 - share) ** (SKETCH - least)
    if not least:
        raise ValueError(f"sketches of {SKETCH} values miss links at {percent} percent with a chance above {miss}")
    return least


def _least_overlap(n: Column, percent: int) -> Column:
    """Retained values a document of n shingles shares with any it is linked to.

    Up to the first bound its partners' sketches are whole sets, where the share is exact.
    """
    return F.when(n <= SKETCH * percent // 100, F.ceil(n * percent / 100)).otherwise(F.lit(least_shared(percent))).cast("int")


def inverted_lists(classes: DataFrame, percent: int) -> DataFrame:
    """(value, class_id, n_shingles): each document under the rarest of its retained values."""
    postings = classes.select("class_id", "n_shingles", F.explode("hashes").alias("value"))
    shared = postings.groupBy("value").agg(F.count("*").alias("held_by")).filter("held_by > 1")
    kept = F.size("values") - _least_overlap(F.col("n_shingles"), percent) + 1
    return (
        postings.join(shared, "value")
        .groupBy("class_id", "n_shingles")
        .agg(F.sort_array(F.collect_list(F.struct("held_by", "value"))).alias("values"))
        .filter(kept > 0)
        .select("class_id", "n_shingles", F.explode(F.slice("values", F.lit(1), kept)).alias("v"))
        .select(F.col("v.value").alias("value"), "class_id", "n_shingles")
    )


def _full_sets(docs: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """Full sets of the documents named in ``ids`` (class_id), one row per different set."""
    wanted = docs.join(broadcast_if_small(ids.withColumnRenamed("class_id", "doc_id")), "doc_id", "left_semi")
    full = sketches(wanted, words, None).filter("n_shingles > 0")
    return materialise(
        full.groupBy(F.col("doc_id").alias("class_id"), "set_key").agg(F.first("hashes").alias("hashes")), "near-sets"
    )


def _estimated(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose estimate on the union's sketch does not rule a link out; some may repeat.

    Nothing here needs the rows of a key together but the joins, so a hot one's can be split.
    """
    left = classes.select(F.col("class_id").alias("a"), F.col("hashes").alias("left"))
    right = classes.select(F.col("class_id").alias("b"), F.col("hashes").alias("right"))
    union = F.slice(F.array_sort(F.array_union("left", "right")), 1, SKETCH)
    common = F.size(F.array_intersect(F.array_intersect("left", "right"), union))
    enough = F.least(F.lit(least_shared(percent)), F.ceil(F.size(union) * percent / 100))
    return pairs.join(left, "a").join(right, "b").filter(common >= enough).select("a", "b")


def _confirmed(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Those of the pairs (a, b) that are links by their full sets."""
    ids = pairs.select(F.col("a").alias("class_id")).unionByName(pairs.select(F.col("b").alias("class_id"))).distinct()
    sets = _full_sets(docs, ids, words)
    left = sets.select(F.col("class_id").alias("a"), F.col("hashes").alias("left"))
    right = sets.select(F.col("class_id").alias("b"), F.col("hashes").alias("right"))
    both = F.size(F.array_intersect("left", "right"))
    linked = both * 100 >= (F.size("left") + F.size("right") - both) * percent
    return materialise(pairs.join(left, "a").join(right, "b").filter(linked).select("a", "b"), "near-links")


def _overlaps(sets: list[np.ndarray], wanted: Iterable[int]) -> Iterator[tuple[int, np.ndarray]]:
    """For each wanted position, how many values it shares with every other set."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, place, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = owner[np.argsort(place, kind="stable")]
    starts = np.cumsum(counts) - counts
    first = np.cumsum([0] + [len(s) for s in sets])
    for i in wanted:
        mine = place[first[i] : first[i + 1]]
        mine = mine[counts[mine] > 1]
        sizes = counts[mine]
        take = np.repeat(starts[mine] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        yield i, np.bincount(owner[take], minlength=len(sets))


def _estimate_group(percent: int):
    """Candidates between components in each part of a list, or a mark that there are too many."""
    fewest = least_shared(percent)

    def one(value: int, low: int, high: int, ids, comps, blocks, sizes, sets) -> list[tuple]:
        least = np.where(sizes <= SKETCH * percent // 100, np.ceil(sizes * percent / 100), fewest)
        found: list[tuple[int, int]] = []
        for i, shared in _overlaps(sets, range(len(sets))):
            right = (shared >= np.minimum(least[i], least)) & (comps != comps[i]) & (ids > ids[i])
            if low != high:
                right &= blocks != blocks[i]
            found.extend((i, int(j)) for j in np.flatnonzero(right))
            if len(found) > DENSE * len(sets):
                return [(value, low, high, None, None)]
        kept = []
        for i, j in found:
            union = np.union1d(sets[i], sets[j])[:SKETCH]
            common = np.intersect1d(np.intersect1d(sets[i], sets[j], assume_unique=True), union, assume_unique=True)
            if len(common) >= min(fewest, math.ceil(len(union) * percent / 100)):
                kept.append((value, low, high, int(ids[i]), int(ids[j])))
        return kept

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["value", "low", "high"], kind="stable")
        keys = [rows[k].to_numpy() for k in ("value", "low", "high")]
        held = [rows[k].to_numpy() for k in ("class_id", "component", "block", "n_shingles")]
        sets = [np.asarray(h, np.int64) for h in rows["hashes"]]
        edges = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
        found: list[tuple] = []
        for start, end in zip([0, *edges], [*edges, len(rows)]):
            found += one(*(int(k[start]) for k in keys), *(h[start:end] for h in held), sets[start:end])
        del rows, held, sets
        release_memory()
        return pd.DataFrame(found, columns=["value", "low", "high", "a", "b"])

    return run


def _link_group(percent: int):
    """Links that join components in one task's part of a list, by full sets; no more than it has members."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        ids, blocks = rows["class_id"].to_numpy(), rows["block"].to_numpy()
        names, comps = np.unique(rows["component"].to_numpy(), return_inverse=True)
        parent = list(range(len(names)))

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        sets = [np.asarray(h, np.int64) for h in rows["hashes"]]
        sizes = np.array([len(s) for s in sets])
        largest = np.bincount(comps).argmax()
        across = rows["low"].iloc[0] != rows["high"].iloc[0]
        links = []
        for i, shared in _overlaps(sets, np.flatnonzero(comps != largest)):
            linked = (shared * 100 >= (sizes + sizes[i] - shared) * percent) & (comps != comps[i])
            if across:
                linked &= blocks != blocks[i]
            for j in np.flatnonzero(linked):
                mine, other = root(comps[i]), root(comps[j])
                if mine != other:
                    parent[other] = mine
                    links.append((int(ids[i]), int(ids[j])))
        del rows, sets
        release_memory()
        return pd.DataFrame(links, columns=["a", "b"])

    return run


def _links_between(lists: DataFrame, classes: DataFrame, docs: DataFrame, linked: DataFrame, words: int, percent: int) -> DataFrame:
    """Further links (a, b) in lists whose members are not yet one component."""
    named = lists.join(linked.withColumnRenamed("node", "class_id"), "class_id", "left").withColumn(
        "component", F.coalesce("component", "class_id")
    )
    # With two members the first round has compared all there is.
    named = materialise(named, "near-named")
    open_lists = materialise(
        named.groupBy("value")
        .agg(
            F.count("*").alias("members"),
            F.min("component").alias("lowest"),
            F.max("component").alias("highest"),
            F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES).cast("int").alias("blocks"),
        )
        .filter((F.col("members") > 2) & (F.col("lowest") != F.col("highest")))
        .select("value", "blocks", (F.col("members") > LANE_ROWS // 10).alias("long")),
        "near-open",
    )
    block = F.pmod(F.xxhash64("class_id"), F.col("blocks")).cast("int")
    parts = materialise(
        named.join(open_lists, "value")
        .withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("value", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "class_id", "component", "n_shingles", "long"),
        "near-open-lists",
    )
    keys = ["value", "low", "high"]
    # Short lists share a task, for a task of its own costs more than they do.
    lanes = max(1, parts.filter("NOT long").count() // LANE_ROWS)
    lane = F.when(F.col("long"), F.struct(*keys)).otherwise(
        F.struct(F.pmod(F.xxhash64("value"), F.lit(lanes)).alias("value"), F.lit(-1).alias("low"), F.lit(-1).alias("high"))
    )
    estimates = materialise(
        parts.join(classes.select("class_id", "hashes"), "class_id")
        .groupBy(lane.alias("lane"))
        .applyInPandas(_estimate_group(percent), "value long, low int, high int, a long, b long"),
        "near-estimates",
    )
    pairs = estimates.filter("a IS NOT NULL").select("a", "b").distinct()
    confirmed = _confirmed(pairs, docs, words, percent)

    crowded = estimates.filter("a IS NULL").select(keys)
    crowd = parts.join(crowded, keys)
    sets = _full_sets(docs, crowd.select("class_id").distinct(), words)
    found = crowd.join(sets, "class_id").groupBy(keys).applyInPandas(_link_group(percent), "a long, b long")
    return confirmed.unionByName(materialise(found, "near-links"))


def near_dedup(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Documents are linked if 100 * shared shingles >= percent * shingles of both; component_id
    is the smallest doc_id reachable over links, and the document that bears it is kept.
    Needs columns ``doc_id`` and ``text``, reads no others.  NULL or empty text has no
    shingles: linked with nothing, its own component.  doc_id names a document: rows that
    repeat one are the same node and share its component.  A row with a NULL doc_id cannot
    be named; it takes the component of texts with the same shingles, or NULL, and is kept
    only in the latter case.  A link is missed with a chance of ``MISS``; below 42 percent the
    sketches cannot give that, which is an error.
    """
    described = materialise(sketches(docs, words, SKETCH), "near-sketches")
    every = described.filter("n_shingles > 0").groupBy("set_key").agg(
        F.min("doc_id").alias("class_id"), F.first("n_shingles").alias("n_shingles"), F.first("hashes").alias("hashes")
    )
    classes = materialise(every.filter("class_id IS NOT NULL"), "near-classes")
    lists = materialise(inverted_lists(classes, percent), "near-lists")

    # Written, so that the join meets plain tables and can split a long list's partition.
    heads = lists.groupBy("value").agg(F.min("class_id").alias("b"), F.count("*").alias("members")).filter("members > 1")
    heads = materialise(heads, "near-heads")
    stars = lists.join(heads, "value").select(F.col("class_id").alias("a"), "b").filter("a <> b").distinct()
    pairs = materialise(_estimated(materialise(stars, "near-stars"), classes, percent), "near-pairs")
    first = _confirmed(materialise(pairs.distinct(), "near-pairs"), docs, words, percent)
    # Rows of one doc_id with different sets are one node, whichever set a class is named by.
    same = described.filter("n_shingles > 0 AND doc_id IS NOT NULL").join(
        classes.select("set_key", "class_id"), "set_key"
    ).filter("doc_id <> class_id").select(F.col("doc_id").alias("a"), F.col("class_id").alias("b"))
    named_twice = same.join(classes.select(F.col("class_id").alias("a")), "a", "left_semi").distinct()
    first = materialise(first.unionByName(named_twice), "near-links")
    more = _links_between(lists, classes, docs, components(first), words, percent)
    linked = components(first.unionByName(more))

    by_set = classes.join(linked, F.col("class_id") == F.col("node"), "left").select(
        "set_key", F.coalesce("component", "class_id").alias("component")
    )
    named = described.select("doc_id", "n_shingles", "set_key").join(by_set, "set_key", "left")
    return named.select(
        "doc_id",
        "n_shingles",
        F.coalesce("component", "doc_id").alias("component_id"),
        F.col("doc_id").eqNullSafe(F.coalesce("component", "doc_id")).alias("kept"),
    )


def keep_one_of_near(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each group of near duplicates, that with the smallest doc_id.

    Every row is a document of its own here, also one without a doc_id (kept only if its whole
    group has none) or with a doc_id that other rows hold.  Rows without shingles are no one's
    copies and stay.  Needs columns ``doc_id`` and ``text``; all columns are kept.  The rows are
    numbered and written once, so that no two of them can be taken for one.
    """
    number = unused_name(docs, "row_number")
    numbered = materialise(docs.withColumn(number, F.monotonically_increasing_id()), "near-numbered")
    found = near_dedup(numbered.select(F.col(number).alias("doc_id"), "text"), words, percent)
    groups = found.filter("n_shingles > 0").select(F.col("doc_id").alias(number), F.col("component_id").alias("near_group"))
    groups = materialise(groups.join(numbered.select(number, F.col("doc_id").alias("near_name")), number), "near-groups")
    order = F.struct(F.col("near_name").isNull(), "near_name", number)
    best = groups.groupBy("near_group").agg(F.min(order)[number].alias("stays"), F.count("*").alias("members"))
    best = materialise(best.filter("members > 1").select("near_group", "stays"), "near-best")
    gone = materialise(groups.join(best, "near_group").filter(F.col(number) != F.col("stays")).select(number), "near-gone")
    return numbered.join(broadcast_if_small(gone), number, "left_anti").select(docs.columns)
