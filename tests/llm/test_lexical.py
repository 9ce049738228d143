"""Ranked search against a plain scoring of all documents."""

import math
import random
import re
from collections import Counter

import pytest

from stratafold.llm import lexical
from tests.llm.conftest import ROWS

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_search(docs, items, top=10):
    held = [(i, Counter(plain_terms(t))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    n_docs, n_all = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item_id, text in items:
        scores = []
        for doc_id, counts, n in held:
            m = 100 - 75 + (75 * n * n_docs) // n_all
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * counts[t] // (1000 * counts[t] + 8 * m))
                for t in plain_terms(text) if t in counts
            )
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=str)


def test_terms_follow_their_rule():
    assert lexical.terms_of("Ab-c_9 ÉX\x00z\n{q}\x85w") == [t.encode() for t in plain_terms("Ab-c_9 ÉX\x00z\n{q}\x85w")]
    assert lexical.terms_of(None) == lexical.terms_of("") == lexical.terms_of(" -!") == []


@pytest.mark.parametrize("bucket, block", [(1024, 200_000), (7, 60)])
def test_search_equals_a_plain_one(spark, bucket, block):
    random.seed(5)
    words = [f"w{i}" for i in range(80)]
    odds = [1 / (i + 1) for i in range(80)]
    docs = [(i, " ".join(random.choices(words, odds, k=random.choice((2, 9, 40, 400))))) for i in range(300)]
    docs += [(1000 + i, docs[3][1]) for i in range(90)] + [(None, docs[3][1]), (3, docs[3][1]), (600, None), (601, ""), (602, "-")]
    items = [(i, " ".join(random.choices(words, k=random.randrange(1, 12)))) for i in range(14)]
    items += [(50, docs[3][1]), (50, "w1 W1 w7"), (None, "w5"), (51, None), (52, "!"), (53, "unheard"), (54, "w0 w0 w0")]
    frame = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, score string").repartition(5)
    asked = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, rank long")
    got = lexical.ranked_search(frame, asked, block_bytes=block, bucket=bucket)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == plain_search(docs, items)
    if bucket == 7:
        fewer = lexical.ranked_search(frame, asked, top=3, bucket=bucket)
        assert sorted(map(tuple, fewer.collect()), key=str) == plain_search(docs, items, 3)
    assert lexical.ranked_search(frame, asked.limit(0)).collect() == []
    assert lexical.ranked_search(frame.limit(0), asked).collect() == []


def test_odd_rows(spark, odd):
    items = [(1, "Seven WIZARDS brew"), (2, "word7 and39999"), (3, "short text")]
    got = lexical.ranked_search(odd("norm"), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(map(tuple, got.collect()), key=str) == plain_search([r[:2] for r in ROWS], items)
