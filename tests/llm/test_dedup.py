"""Exact, near and line dedup against plain versions."""

import hashlib
import math
import random
import re

import pytest

import corpus_pipeline
from stratafold.llm.exact_dedup import exact_dedup
from stratafold.llm.graph import _contracted, components
from stratafold.llm.line_dedup import drop_boilerplate, drop_spread_lines, line_table, spread_lines
from stratafold.llm import near_dedup as near
from tests.conftest import plan_of
from tests.llm.conftest import ROWS

DOCS = "doc_id long, text string, source string"


def plain_exact(rows):
    groups = {}
    for doc_id, text in rows:
        norm = re.sub("[\x20\x09-\x0d]+", " ", text or "")
        groups.setdefault(norm, []).append(doc_id)
    out = []
    for norm, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        digest = hashlib.sha256(norm.encode()).hexdigest()
        first = True
        for i in sorted(ids, key=lambda i: (i is None, i)):
            out.append((i, keep, len(ids), first, digest))
            first = False
    return sorted(out, key=str)


@pytest.mark.parametrize("counters", [1, 4, 1024])
def test_exact_dedup_of_odd_rows(spark, odd, counters):
    got = exact_dedup(odd("group_size"), counters)
    assert sorted(map(tuple, got.collect()), key=str) == plain_exact([(r[0], r[1]) for r in ROWS])


def test_exact_dedup_with_a_hot_group(spark):
    rows = [(i, "same  text" if i % 3 == 0 else f"text {i % 500}") for i in range(3000)] + [(0, "same text")] * 5
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = exact_dedup(docs, counters=64)
    assert sorted(map(tuple, got.collect()), key=str) == plain_exact(rows)
    # The hot group is settled by a broadcast join, before the shuffle of the others.
    assert "BroadcastHashJoin" in plan_of(got) and "Python" not in plan_of(got)


def test_exact_dedup_of_nothing(spark):
    assert exact_dedup(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def plain_lines(rows, sites):
    seen = {}
    for doc_id, text, source in rows:
        for line in (text or "").split("\n") if text is not None else []:
            if line.strip(" "):
                seen.setdefault(line.strip(" "), set()).add(source)
    spread = {line for line, found in seen.items() if len(found - {None}) >= sites}
    used, out = {}, []
    for doc_id, text, source in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        left, gone = [], 0
        for line in text.split("\n") if text is not None else []:
            plain = line.strip(" ")
            if plain in spread and used.setdefault(plain, (doc_id, text, len(left) + gone)) != (doc_id, text, len(left) + gone):
                gone += 1
            else:
                left.append(line)
        out.append((doc_id, None if text is None else "\n".join(left), gone))
    return sorted(out, key=str)


def lines_of(df, name):
    return sorted(((r["doc_id"], r["text"], r[name]) for r in df.collect()), key=str)


def test_lines_by_distinct_sites(spark):
    random.seed(3)
    common = [f"common line {k}" for k in range(12)]
    rows = []
    for i in range(300):
        lines = [f"own {i} {j}" for j in range(3)] + random.sample(common, 3) + ["", "  "]
        if i % 50 == 7:
            lines.append("rare line on few sites")
        random.shuffle(lines)
        rows.append((i, "\n".join(lines), f"site{i % 9}" if i % 11 else None))
    docs = spark.createDataFrame(rows, DOCS)
    for sites in (3, 9, 10):
        assert lines_of(drop_spread_lines(docs, sites), "n_removed") == plain_lines(rows, sites)


def test_near_the_threshold_sites_are_counted_exactly(spark):
    rows = [(k, "twenty" if k < 20 else "nineteen" if k < 39 else f"own {k}", f"s{k if k < 20 else k - 20}") for k in range(60)]
    lines = line_table(spark.createDataFrame(rows * 3, DOCS))
    found = {r.line_hash for r in spread_lines(lines, 20).collect()}
    assert found == {r[0] for r in spark.sql("SELECT xxhash64('twenty')").collect()}


def test_the_stage_drops_a_passage_of_a_table_with_a_hot_source(spark):
    passage = " ".join(f"long{i}" for i in range(60))
    # Of 400 rows one source holds half; the passage is in 20 documents on 7 sources, other lines on 3 and 4.
    rows = [(k, f"own {k}", "hot" if k % 2 else f"s{k % 38}") for k in range(400)]
    for k in [*range(1, 29, 2), 2, 4, 6, 8, 10, 12]:
        rows[k] = (k, f"own {k}\n{passage}", rows[k][2])
    for line, ids in (("on three", (101, 103, 102, 104)), ("on four", (201, 203, 202, 204, 206))):
        for k in ids:
            rows[k] = (k, f"{line}\n{rows[k][1]}", rows[k][2])
    assert len({r[2] for r in rows if passage in r[1]}) == 7
    docs = spark.createDataFrame(rows, DOCS)
    want = plain_lines(rows, 4)
    assert lines_of(drop_spread_lines(docs), "n_removed") == want
    left = [r.text for r in corpus_pipeline.drop_boilerplate(spark, docs, "").collect()]
    assert sorted(left) == sorted(text for _, text, _ in want)
    assert [sum(line in t for t in left) for line in (passage, "on three", "on four")] == [1, 4, 1]


@pytest.mark.parametrize("name", ["n_removed", "gone_at", "position"])
def test_lines_of_odd_rows(spark, odd, name):
    cleaned = drop_spread_lines(odd(name), 2)
    assert cleaned.columns[:4] == ["doc_id", "text", "source", name]
    rows = [(r[0], r[1], r[2]) for r in ROWS]
    assert lines_of(cleaned, cleaned.columns[-1]) == plain_lines(rows, 2)


def test_lines_of_nothing(spark):
    assert drop_spread_lines(spark.createDataFrame([], DOCS)).collect() == []


def plain_near(rows, percent=85):
    sets = {}
    for doc_id, text in rows:
        if doc_id is not None:
            sets.setdefault(doc_id, set()).update(near.shingle_set(text).tolist())
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and both * 100 >= percent * len(sets[a] | sets[b]):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {i: root(i) for i in ids}


def near_result(df):
    return {r.doc_id: r.component_id for r in df.collect() if r.doc_id is not None}


def changed(words, random, rate):
    return [w if random.random() > rate else f"new{random.randrange(10**6)}" for w in words]


@pytest.mark.parametrize("dense, shingles", [(near.DENSE, near.BLOCK_SHINGLES), (0, 3000)])
def test_near_dedup_equals_all_pairs(spark, monkeypatch, dense, shingles):
    monkeypatch.setattr(near, "DENSE", dense)
    monkeypatch.setattr(near, "BLOCK_SHINGLES", shingles)
    random.seed(5)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = random.choices(vocabulary, k=40)
    rows = []
    base = random.choices(vocabulary, k=120)
    for i in range(60):  # near copies, many of them just above or below the threshold
        rows.append((len(rows), " ".join(changed(base, random, random.choice((0.005, 0.01, 0.02))))))
    for i in range(60):  # a common passage, all else different
        rows.append((len(rows), " ".join(random.choices(vocabulary, k=80) + passage + random.choices(vocabulary, k=30))))
    for i in range(40):  # chains of small steps, and short texts
        step = rows[-1][1].split() if i % 8 else random.choices(vocabulary, k=60)
        rows.append((len(rows), " ".join([*step, f"tail{i}"])))
    for i in range(30):
        rows.append((len(rows), " ".join(vocabulary[i % 6 : i % 6 + i % 9])))
    random.shuffle(rows)
    got = near_result(near.near_dedup(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == plain_near(rows)


def test_the_stage_keeps_one_of_all_pairs_at_80_percent(spark):
    random.seed(8)
    vocabulary = [f"w{i}" for i in range(900)]
    rows = []
    for base in range(40):  # of 200 shingles, one new word in the middle takes 5, so 3 or 4 of them lead to 0.81 to 0.86
        words = random.choices(vocabulary, k=204)
        rows.append((len(rows), " ".join(words)))
        for new in (3, 4, 5):
            copy = list(words)
            for at in range(20, 20 + 30 * new, 30):
                copy[at] = f"new{base}and{new}"
            rows.append((len(rows), " ".join(copy)))
    random.shuffle(rows)
    kept = corpus_pipeline.keep_one_of_near(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    want = plain_near(rows, 80)
    assert {r.doc_id for r in kept.collect()} == set(want.values()) < set(plain_near(rows, 85).values())


def test_the_stage_keeps_one_row_of_repeated_and_nameless_ones(spark):
    random.seed(4)
    one, two, three, four = (" ".join(random.choices([f"w{i}" for i in range(500)], k=80)) for _ in range(4))
    rows = [
        (1, one), (1, one), (1, one), (7, one + " end"), (None, one), (None, one + " tail"),
        # The id of a near copy also names a text of its own, and one doc_id names near versions.
        (7, two), (8, three), (8, three + " more"),
        (None, four), (None, four), (None, four + " on"),
        (9, None), (9, None), (None, ""),
    ]
    docs = spark.createDataFrame([(i, t, f"row {k}") for k, (i, t) in enumerate(rows)], "doc_id long, text string, row_key string").repartition(4)
    kept = corpus_pipeline.keep_one_of_near(spark, docs, "")
    assert kept.columns == docs.columns
    left = [(r.doc_id, next((k for k, t in enumerate((one, two, three, four)) if (r.text or "").startswith(t)), None)) for r in kept.collect()]
    assert sorted(left, key=str) == sorted([(1, 0), (7, 1), (8, 2), (None, 3), (9, None), (9, None), (None, None)], key=str)


@pytest.mark.parametrize("percent, least", [(50, 2), (80, 12), (85, 14), (100, 32)])
def test_shared_values_follow_from_the_chance_of_a_miss(percent, least):
    def missed(k):
        return sum(math.comb(near.SKETCH, i) * (percent / 100) ** i * (1 - percent / 100) ** (near.SKETCH - i) for i in range(k))

    assert near.least_shared(percent) == least and missed(least) <= near.MISS
    assert least == near.SKETCH or missed(least + 1) > near.MISS


def test_links_too_weak_for_the_sketches_are_refused():
    with pytest.raises(ValueError):
        near.least_shared(40)


def test_near_dedup_of_odd_rows(spark, odd):
    rows = near.near_dedup(odd("component_id")).collect()
    assert len(rows) == len(ROWS)
    assert {r.doc_id: r.component_id for r in rows if r.doc_id} == {
        1: 1, 2: 1, 3: 1, 4: 4, 5: 5, 6: 6, 7: 7, 8: 7, 9: 9, 10: 9,
    }
    nameless = {(r.n_shingles > 0, r.component_id, r.kept) for r in rows if r.doc_id is None}
    assert nameless == {(True, 1, False), (False, None, True)}
    assert near.near_dedup(odd().limit(0)).collect() == []


def test_shingles_follow_their_rule():
    assert len(near.shingle_set(None)) == len(near.shingle_set(" \n")) == 0
    assert len(near.shingle_set("one two")) == 1 and len(near.shingle_set("a b c d e f")) == 2
    assert near.shingle_set("A\tb  c").tolist() == near.shingle_set("a b c").tolist()
    assert near.shingle_set("É b").tolist() != near.shingle_set("é b").tolist()
    assert near.shingle_set("a b").tolist() != near.shingle_set("b a").tolist()


def test_components_of_chains_and_repeats(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (102, 102), (None, 5), (5, None)]
    random.seed(1)
    random.shuffle(chain)
    got = {r.node: r.component for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 102}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_components_take_few_rounds_on_shuffled_paths(spark):
    nodes = list(range(10_000))
    random.seed(2)
    random.shuffle(nodes)
    links = spark.createDataFrame(list(zip(nodes, nodes[1:])), "node long, near long")
    both = links.unionByName(links.select(links.near.alias("node"), links.node.alias("near")))
    assert len(_contracted(both)) < 30
    got = components(links.toDF("a", "b")).collect()
    assert len(got) == len(nodes) and {r.component for r in got} == {0}


def test_components_equal_a_plain_search(spark):
    random.seed(3)
    links = [(random.randrange(400), random.randrange(400)) for _ in range(260)] + [(0, i) for i in range(300, 360)]
    root = {n: n for link in links for n in link}
    for _ in root:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == root


def test_a_document_of_boilerplate_alone_goes(spark):
    rows = [(i, "boiler one\n\nboiler two\n", f"site {i}") for i in range(6)]
    rows += [(6, "boiler one\nmine", "site 1"), (7, None, "site 1"), (8, " \n", "site 2"), (9, "\tboiler one\n\r", "site 3")]
    docs = spark.createDataFrame(rows, DOCS)
    got = {r.doc_id: r.text for r in drop_boilerplate(docs).collect()}
    assert got == {0: "boiler one\n\nboiler two\n", 6: "mine", 7: None, 8: " \n", 9: "\tboiler one\n\r"}


def test_very_many_lines_of_one_text(spark):
    lines = [f"line {i}" for i in range(150_000)]
    docs = spark.createDataFrame([(i, "\n".join(lines + [f"own {i}"]), f"site {i}") for i in range(5)], DOCS)
    left = {r.doc_id: r.text for r in drop_spread_lines(docs).collect()}
    assert left[0].count("\n") == 150_000 and all(left[i] == f"own {i}" for i in range(1, 5))


def test_one_row_of_each_group_stays(spark, odd):
    rows = near.keep_one_of_near(odd("row_number"), percent=80)
    assert rows.columns == ["doc_id", "text", "source", "row_number"]
    assert sorted((r.doc_id for r in rows.collect()), key=str) == sorted([1, 4, 5, 6, 7, 9, None], key=str)
    assert near.keep_one_of_near(odd().limit(0)).collect() == []
