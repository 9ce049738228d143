"""Runs of words: stretches that repeat with a period, and texts with the repeats taken out.

A run of period q that is at least four periods long covers four neighbouring places of the
grid 0, q, 2q, ..., which then hold the same word.  The grids of all periods have about
n log n places (a harmonic sum), and on each such candidate longest common extensions of two
places one period apart give the run's exact ends.  They come from a grammar made by
recompression (``recompression``).  Documents are taken together up to a bounded number of
characters, so the work is done on whole arrays.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratafold.llm.recompression import Grammar

# A run has so many words and so many periods at least.
MIN_LENGTH = 6
MIN_PERIODS = 4
# Characters of texts looked at together; a longer text is alone.
GROUP_CHARS = 1_000_000

RUNS = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, strongest int, collapsed string"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _candidates(symbols: np.ndarray, low: int, high: int, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) of grid places, periods from ``low`` to ``high``, that begin so many equal ones.

    ``limits`` says for each period how much of the sequence, from its beginning, can hold a run.
    """
    places, periods = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for period in range(low, high + 1):
        grid = symbols[: limits[period] : period]
        if len(grid) < MIN_PERIODS:
            continue
        same = grid[1:] == grid[:-1]
        found = np.flatnonzero(same[:-2] & same[1:-1] & same[2:])
        if len(found):
            places.append(found * period)
            periods.append(np.full(len(found), period, np.int64))
    return np.concatenate(places), np.concatenate(periods)


def runs_of(texts: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of every run of each sequence of symbols from 0 on, by start, then period."""
    order = sorted(range(len(texts)), key=lambda k: -len(texts[k]))
    sizes = np.array([len(texts[k]) for k in order], np.int64)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not len(sizes) or sizes[0] < MIN_LENGTH:
        return out
    # Each text ends with a symbol of its own, so nothing goes on into the next one.
    joined = np.concatenate([part for n, k in enumerate(order) for part in (texts[k], [-1 - n])]).astype(np.int64)
    begins = np.cumsum(np.concatenate([[0], sizes + 1]))
    last = int(sizes[0]) // MIN_PERIODS
    # The longer texts come first: those with four periods end where the others begin.
    able = np.searchsorted(-sizes, -MIN_PERIODS * np.arange(last + 1), side="right")
    limits = begins[able]
    grammar: Grammar | None = None
    found: set[tuple[int, int, int]] = set()
    reach = np.zeros(len(joined), np.int64)
    by = np.ones(len(joined), np.int64)
    low = 1
    while low <= last:
        place, period = _candidates(joined, low, min(2 * low - 1, last), limits)
        # Inside a run whose period divides theirs they would find that run again.
        known = (reach[place] > place + (MIN_PERIODS - 1) * period) & (period % by[place] == 0)
        place, period = place[~known], period[~known]
        if len(place):
            grammar = grammar or Grammar(joined)
            start = place - grammar.common_behind(place, place + period)
            end = place + period + grammar.common_ahead(place, place + period)
            fit = end - start >= np.maximum(MIN_LENGTH, MIN_PERIODS * period)
            for run in sorted(set(zip(start[fit].tolist(), end[fit].tolist(), period[fit].tolist()))):
                found.add(run)
                here = slice(run[0], run[1])
                wider = reach[here] < run[1]
                reach[here][wider], by[here][wider] = run[1], run[2]
        low *= 2
    # Of one stretch the smallest period is its period.
    smallest: dict[tuple[int, int], int] = {}
    for start, end, period in found:
        smallest[start, end] = min(period, smallest.get((start, end), period))
    for (start, end), period in smallest.items():
        n = int(np.searchsorted(begins, start, side="right")) - 1
        out[order[n]].append((start - int(begins[n]), end - start, period))
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in out]


def strongest(runs: list[tuple[int, int, int]]) -> int | None:
    """Position of the run with the greatest exact length / period; the first of equal ones."""
    if not runs:
        return None
    return min(range(len(runs)), key=lambda k: (-Fraction(runs[k][1], runs[k][2]), runs[k][0], runs[k][2]))


def _described(texts: list[str | None]) -> tuple[list, list, list, list]:
    """Word counts, runs, strongest runs and collapsed texts."""
    words = [(t or "").encode("utf-8", "replace").split() for t in texts]
    known: dict[bytes, int] = {}
    found = runs_of([np.array([known.setdefault(w, len(known)) for w in ws], np.int64) for ws in words])
    collapsed = []
    for ws, runs in zip(words, found):
        if runs:
            kept = np.ones(len(ws), bool)
            for start, length, period in runs:
                kept[start + period : start + length] = False
            ws = [ws[i] for i in np.flatnonzero(kept)]
        collapsed.append(b" ".join(ws).decode("utf-8"))
    return [len(ws) for ws in words], found, [strongest(r) for r in found], collapsed


def periodic_runs(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, runs, strongest, collapsed; other columns are not read.

    Words end at ASCII white space and are numbered from 0.  A run is a stretch of words with
    smallest period q (words q apart are identical), ``MIN_LENGTH`` words and ``MIN_PERIODS``
    periods long at least, that neither neighbouring word extends.  ``runs`` has all of them by
    start, then period; ``strongest`` is the position of the one with the greatest length /
    period, NULL without runs.  ``collapsed`` has the words that no run repeats, joined by one
    space: of each run its first q words stay.  NULL and empty texts have no words and an empty
    collapsed text.  Rows are looked at one by one: repeated rows give repeated rows, NULL ids stay.
    """

    def describe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ids, at = batch.column(1), batch.column(0).cast(pa.int64()), 0
            while at < batch.num_rows:
                group, chars = [], 0
                while at + len(group) < batch.num_rows and (not group or chars < GROUP_CHARS):
                    group.append(texts[at + len(group)].as_py())
                    chars += len(group[-1] or "")
                count, runs, best, collapsed = _described(group)
                rows = [[{"start": s, "length": n, "period": p} for s, n, p in r] for r in runs]
                yield pa.record_batch(
                    [ids.slice(at, len(group)), pa.array(count, pa.int64()), pa.array(rows, pa.list_(_RUN)), pa.array(best, pa.int32()), pa.array(collapsed, pa.string())],
                    ["doc_id", "n_words", "runs", "strongest", "collapsed"],
                )
                at += len(group)

    return docs.select("doc_id", "text").mapInArrow(describe, RUNS)


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """doc_id and text of ``docs``; the words of a tenth of the texts repeat from some word on.

    With h the checksum of the doc_id, those with h % 10 = 0: n words, g = h div 10, a = g % n and
    p = 1 + (n - a) div (3 + g % 8); from word a on the words a to a + p - 1 come again and again.
    """
    check = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(check / 10)

    def repeated(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        word = F.transform(
            F.array(F.struct(a.alias("a"), p.alias("p"))),
            lambda v: F.transform(words, lambda w, i: F.when(i < v["a"], w).otherwise(F.get(words, (v["a"] + (i - v["a"]) % v["p"]).cast("int")))),
        )[0]
        return F.when(n > 0, F.array_join(word, " ")).otherwise("")

    split = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    text = F.when(F.col("text").isNotNull() & (check % 10 == 0), F.transform(F.array(split), repeated)[0])
    return docs.select("doc_id", F.coalesce(text, F.col("text")).alias("text"))


def runs_digest(found: DataFrame) -> DataFrame:
    """Numbers of the strongest run, and digests of all runs and of the collapsed text."""
    best = F.get("runs", F.col("strongest"))
    lines = F.transform("runs", lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]))
    text = F.array_join(F.transform(lines, lambda line: F.concat(line, F.lit("\n"))), "")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.expr("1000 * get(runs, strongest).length div get(runs, strongest).period").alias("exponent_milli"),
        F.sha2(text.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
