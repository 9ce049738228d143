"""Runs of words against a plain search, extensions against a plain comparison."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from stratafold.llm import periodic
from stratafold.llm.queries import QUERIES
from stratafold.llm.recompression import Grammar
from stratafold.llm.rows import read_table
from tests.llm.conftest import ROWS

SF_DIR = "/root/testdata/sf0.001"


def plain_runs(words):
    """Every stretch of words q apart that agree, for each q, taken as far as it goes."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q), q)
            i = j
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


sequences = st.lists(st.integers(0, 2), max_size=70) | st.builds(
    lambda head, part, times, tail: head + part * times + tail, *[st.lists(st.integers(0, 2), max_size=9)] * 2, st.integers(3, 12), st.lists(st.integers(0, 2), max_size=9)
)


@settings(max_examples=300, deadline=None)
@given(st.lists(sequences, max_size=5))
def test_runs_equal_a_plain_search(texts):
    assert periodic.runs_of([np.array(t, np.int64) for t in texts]) == [plain_runs(t) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(sequences, min_size=1, max_size=4), st.randoms(use_true_random=False))
def test_extensions_equal_a_plain_comparison(texts, chance):
    joined = [x for n, t in enumerate(texts) for x in [*t, -1 - n]]
    grammar = Grammar(np.array(joined))
    pairs = [(chance.randrange(len(joined)), chance.randrange(len(joined))) for _ in range(12)]
    x, y = map(np.array, zip(*[p for p in pairs if p[0] != p[1]] or [(0, len(joined) - 1)]))
    if x[0] == y[0]:
        return

    def plain(i, j, turn):
        n = 0
        while min(i, j) >= 0 and max(i, j) < len(joined) and joined[i] == joined[j]:
            i, j, n = i + turn, j + turn, n + 1
        return n

    assert grammar.common_ahead(x, y).tolist() == [plain(i, j, 1) for i, j in zip(x, y)]
    assert grammar.common_behind(x, y).tolist() == [plain(i - 1, j - 1, -1) for i, j in zip(x, y)]


def test_long_texts_take_few_levels():
    random.seed(4)
    same = np.zeros(100_000, np.int64)
    mixed = np.array([random.randrange(3) for _ in range(100_000)], np.int64)
    fibonacci = [[0], [0, 1]]
    while len(fibonacci[-1]) < 100_000:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    for text in (same, mixed, np.array(fibonacci[-1])):
        assert len(Grammar(text)._levels) < 120
    assert periodic.runs_of([same]) == [[(0, 100_000, 1)]]
    period = np.arange(20_000)
    assert periodic.runs_of([np.concatenate([[20_000], *[period] * 4, period[:7], [7, 8, 9]])]) == [[(1, 80_010, 20_000)]]


def plain_digest(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    told = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    left = " ".join(w for i, w in enumerate(words) if i not in gone)
    numbers = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *numbers, hashlib.sha256(told.encode()).hexdigest(), hashlib.sha256(left.encode()).hexdigest())


def test_the_query_equals_a_plain_version(spark):
    docs = read_table(spark, SF_DIR, "documents").collect()
    got = QUERIES["op11_periodic_runs"](spark, SF_DIR)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(plain_digest(r.doc_id, r.text) for r in docs)


def test_odd_rows(spark, odd):
    rows = [(r[0], r[1]) for r in ROWS] + [(30, "a " * 90_000), (None, "x y x y\nx y x\ty z"), (31, "é é é é é é"), (10, "short  text")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, runs string")
    got = periodic.runs_digest(periodic.periodic_runs(periodic.with_periodic_tails(docs))).collect()
    quick = [plain_digest(i, t if len(t or "") < 100_000 else None) for i, t in rows]
    assert sorted((r for r in map(tuple, got) if r[0] not in (7, 8, 30)), key=str) == sorted((w for w in quick if w[0] not in (7, 8, 30)), key=str)
    by_id = {r.doc_id: r for r in got}
    assert tuple(by_id[30])[:6] == (30, 1, 0, 90_000, 1, 90_000_000) and len(got) == len(rows)
    assert by_id[30].collapsed_sha256 == hashlib.sha256(b"a").hexdigest()
    assert periodic.periodic_runs(odd("strongest").limit(0)).collect() == []
