"""Packing, token files, chat, leaks, licenses, revisits, quality: against plain versions and round trips."""

import datetime as dt
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratafold.llm import chat, decontaminate, licenses, quality, warc
from stratafold.llm.packing import COSTS, best_fit, pack_lengths, token_lengths
from stratafold.llm.queries import TOKENIZER
from stratafold.llm.token_files import TokenFile, pack, read_token_files, token_files, write_token_files
from stratafold.llm.tokens import WordEncoder
from stratafold.workspace import fresh_path
from tests.conftest import plan_of
from tests.llm.conftest import ROWS

# --- tokens and their files ----------------------------------------------------


def whole_text_ids(text):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    return tokenizer.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text("aA's.,-É ß́İ\x1c\x85<|endoftext|>1", max_size=40)))
def test_words_give_the_ids_of_the_whole_text(text):
    text = text.encode("utf-8", "replace").decode()
    assert np.frombuffer(WordEncoder.of(TOKENIZER).encode(text), "<u4").tolist() == whole_text_ids(text)


def test_special_strings_give_special_ids():
    assert whole_text_ids("a <|endoftext|> b") == [320, 49407, 321]
    for text in ("a <|endoftext|> b", "x<|startoftext|>y <|endoftext|>", "<|endoftext|><|endoftext|>\n."):
        assert np.frombuffer(WordEncoder.of(TOKENIZER).encode(text), "<u4").tolist() == whole_text_ids(text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.one_of(st.integers(0, 255), st.integers(0, 2**32 - 1)), max_size=40), max_size=8))
def test_a_file_gives_any_token_and_all(docs):
    names = [None if i == 1 else i * 7 - 3 for i in range(len(docs))]
    arrays = [np.array(d, np.uint32) for d in docs]
    read = TokenFile(pack(names, arrays))
    flat = [x for d in docs for x in d]
    assert len(read) == len(flat) and read.all().tolist() == flat
    assert [read[i] for i in range(len(flat))] == flat
    assert [(d, v.tolist()) for d, _, v in read.documents()] == list(zip(names, docs))
    with pytest.raises(IndexError):
        read[len(flat)]


def test_random_access_over_many_blocks():
    values = np.random.default_rng(1).choice(np.array([3, 300, 70_000, 20_000_000], np.uint32), 5000)
    read = TokenFile(pack([1], [values]))
    assert [read[i] for i in range(5000)] == values.tolist()


def test_token_files_of_odd_rows(spark, odd):
    got = token_files(spark, odd("start"), TOKENIZER).collect()
    rows = sorted(((r[0], r[1]) for r in ROWS), key=lambda r: (r[0] is not None, r[0] or 0))
    assert len(got) == len(rows)
    at, by_place = 0, sorted(got, key=lambda r: r.start)
    ids = {}
    for r in by_place:
        assert r.start == at
        at += r.n_tokens
    for doc_id, text in rows:
        values = np.array([*whole_text_ids(text), 1], "<u4")
        ids.setdefault(doc_id, set()).add((len(values), zlib.crc32(values.tobytes())))
    assert [r.doc_id for r in by_place] == [d for d, _ in rows]
    assert all((r.n_tokens, r.ids_crc32) in ids[r.doc_id] for r in by_place)
    assert token_files(spark, odd().limit(0), TOKENIZER).collect() == []


def test_many_files_keep_the_order(spark):
    docs = spark.createDataFrame([(i * 3 % 101, f"text number {i}") for i in range(101)], "doc_id long, text string").repartition(5)
    folder = fresh_path(spark, "tokens")
    manifest = write_token_files(docs, folder, TOKENIZER, tokens_per_file=40)
    assert manifest.count() > 10
    got = sorted(read_token_files(spark, folder, manifest).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == list(range(101)) and len({r.file for r in got}) == manifest.count()


# --- packing -------------------------------------------------------------------


def plain_best_fit(lengths, sizes, costs):
    bins = []
    rest = sum(lengths)
    for n in sorted(lengths, reverse=True):
        fitting = [b for b in bins if b[0] >= n]
        if fitting:
            bin_ = min(fitting, key=lambda b: b[0])
        else:
            size = min((s for s in sizes if s >= n), key=lambda s: (costs[s] / min(s, rest), s))
            bins.append(bin_ := [size, 0])
        bin_[0] -= n
        bin_[1] += n
        rest -= n
    return sum(min(costs[s] for s in sorted(costs) if s >= used) for _, used in bins)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=60))
def test_packing_is_the_cheapest_best_fit(lengths):
    costs = {8: 9.0, 20: 21.0, 64: 60.0}
    packed = pack_lengths(lengths, costs)
    assert sorted(i for _, held in packed for i in held) == list(range(len(lengths)))
    for size, held in packed:
        used = sum(lengths[i] for i in held)
        assert size == min(s for s in costs if s >= used)
    cost = sum(costs[size] for size, _ in packed)
    subsets = [[64], [8, 64], [20, 64], [8, 20, 64]]
    assert cost == pytest.approx(min(plain_best_fit(lengths, s, costs) for s in subsets))


def check_packed(rows, lengths, costs):
    places, pieces = {}, {}
    for r in rows:
        if r.bin_id is not None:
            assert r.bin_size in costs and r.bin_used <= r.bin_size
            places.setdefault(r.bin_id, []).append((r.bin_offset, r.length, r.bin_used))
        pieces.setdefault(r.doc_id, []).append((r.start, r.length))
    for held in places.values():
        at = 0
        for offset, length, used in sorted(held):
            assert offset == at and length > 0
            at += length
        assert at == used
    for doc_id, total in lengths.items():
        assert sum(n for _, n in pieces[doc_id]) == total


def test_pieces_lie_end_to_end(spark):
    random.seed(2)
    data = [(i, random.choice((3, 70, 500, 5000, 12_288))) for i in range(400)]
    rows = best_fit(spark.createDataFrame(data, "doc_id long, n_tokens long").repartition(3), shard_pieces=100).collect()
    check_packed(rows, dict(data), COSTS)
    used = {r.bin_id: (r.bin_used, r.bin_size) for r in rows}
    assert sum(u for u, _ in used.values()) / sum(s for _, s in used.values()) > 0.9


def test_packing_of_odd_rows(spark, odd):
    lengths = token_lengths(odd("bin_id"), TOKENIZER)
    assert best_fit(lengths.limit(0)).collect() == []
    rows = best_fit(lengths).collect()
    assert {r.doc_id for r in rows} == {r[0] for r in ROWS}
    assert all(r.bin_id is not None for r in rows)
    given_ = spark.createDataFrame([(1, 0), (2, None), (3, -4), (None, 9)], "doc_id long, n_tokens long")
    assert sorted((str(r.doc_id), r.length, r.bin_id is None) for r in best_fit(given_).collect()) == [
        ("1", 0, True), ("2", 0, True), ("3", 0, True), ("None", 9, False),
    ]
    with pytest.raises(ValueError):
        best_fit(lengths, {})


# --- chat ----------------------------------------------------------------------

MARKS = st.lists(st.sampled_from([*chat.CHAT.controls(), "~", "<", "[", "s>", "/s>", " ", "ok", "\n", "$1\\"]), max_size=8).map("".join)


def test_escaping_is_reversible_and_complete(spark):
    texts: list[str] = []

    @settings(max_examples=300, deadline=None)
    @given(MARKS)
    def gather(text):
        texts.append(text)

    gather()
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("e", chat.escape(F.col("t")))
    for r in df.withColumn("u", chat.unescape(F.col("e"))).collect():
        assert r.u == r.t and not any(c in r.e for c in chat.CHAT.controls())


def machine(roles):
    state = "start"
    for i, role in enumerate(roles):
        if role not in chat.CHAT.moves.get(state, ()):
            return False, i
        state = role
    return state in chat.CHAT.accepted, None


@pytest.mark.parametrize("block", [1, 3, 256])
def test_conversations_read_back(spark, block):
    random.seed(block)
    rows, want = [], {}
    for conv in range(40):
        roles = ["system"] * (conv % 3 == 0) + ["user", "assistant"] * random.randrange(1, 5)
        if conv % 4 == 1:
            roles.insert(random.randrange(len(roles)), random.choice(["user", "tool", "", "assistant"]))
        if conv % 7 == 2:
            roles.pop()
        texts = ["".join(random.choices([*chat.CHAT.controls(), "~", "x", " ", "é", "\n"], k=6)) for _ in roles]
        rows += [(conv, i, r, t, "other") for i, (r, t) in enumerate(zip(roles, texts))]
        want[conv] = (list(zip(roles, texts)), *machine(roles))
    random.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, segments string")
    formatted = chat.format_conversations(df, block_turns=block)
    assert "Python" not in plan_of(formatted)
    got = {r.conv_id: r for r in formatted.withColumn("turns", chat.read_turns(F.col("text"))).collect()}
    for conv, (turns, valid, wrong) in want.items():
        r = got[conv]
        assert [(t.role, t.text) for t in r.turns] == turns
        assert (r.valid, r.first_wrong_turn) == (valid, wrong)
        assert "".join(s.text for s in r.segments) == r.text
        assert sum(s.loss for s in r.segments) == sum(role == "assistant" for role, _ in turns)


def test_odd_conversations(spark):
    rows = [(None, None, None, None), (1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (2, None, "assistant", None), (2, 0, "user", "q")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    formatted = chat.format_conversations(df)
    got = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in formatted.withColumn("turns", chat.read_turns(F.col("text"))).collect()}
    assert got == {None: [("", "")], 1: [("user", "a"), ("user", "a"), ("user", "b")], 2: [("assistant", ""), ("user", "q")]}
    assert chat.format_conversations(df.limit(0)).collect() == []


# --- benchmark leaks -----------------------------------------------------------


def edit_distance_anywhere(item, text):
    """Least distance of an item to any part of a text."""
    row = list(range(len(item) + 1))
    best = row[-1]
    for c in text:
        diagonal, row[0] = row[0], 0
        for i, x in enumerate(item, 1):
            diagonal, row[i] = row[i], min(diagonal + (x != c), row[i] + 1, row[i - 1] + 1)
        best = min(best, row[-1])
    return best


@settings(max_examples=150, deadline=None)
@given(st.text("ab ", min_size=1, max_size=90), st.text("ab ", max_size=120))
def test_bit_parallel_distance(item, text):
    distance, stop = decontaminate.myers(decontaminate._masks(item), len(item), text)
    assert distance == edit_distance_anywhere(item, text)
    assert distance == edit_distance_anywhere(item, text[:stop])


def test_leaks_equal_brute_force(spark):
    random.seed(8)
    words = ["".join(random.choices("abcde", k=random.randrange(2, 6))) for _ in range(60)]
    items = [(i, " ".join(random.choices(words, k=random.randrange(4, 14)))) for i in range(12)] + [(90, None), (91, " "), (92, items_text := "ab cd")]
    docs = []
    for d in range(60):
        text = " ".join(random.choices(words, k=40))
        if d % 2:
            leak = list(random.choice(items[:12])[1])
            for _ in range(random.randrange(0, 6)):
                place = random.randrange(len(leak))
                random.choice((lambda: leak.pop(place), lambda: leak.insert(place, "z"), lambda: leak.__setitem__(place, "y")))()
            text = text[:80] + " " + "".join(leak).upper().replace(" ", "\n ") + " " + text[80:]
        docs.append((d, text, "x"))
    docs += [(None, None, "x"), (61, "", "x"), (62, items_text, "x"), (62, items_text, "x")]
    want = set()
    for doc_id, text, _ in docs:
        for item_id, item in items:
            item, plain = decontaminate.plain(item), decontaminate.plain(text)
            if item and plain and edit_distance_anywhere(item, plain) <= int(len(item) * 0.1):
                want.add((doc_id, item_id, edit_distance_anywhere(item, plain)))
    frame = spark.createDataFrame(docs, "doc_id long, text string, distance string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    for block in (10**6, 200):
        hits = decontaminate.benchmark_hits(frame, benchmark, 0.1, block).collect()
        assert {(r.doc_id, r.item_id, r.distance) for r in hits} == want
        for r in hits:
            part = decontaminate.plain(dict((d, t) for d, t, _ in docs)[r.doc_id])[r.start : r.stop]
            assert edit_distance_anywhere(decontaminate.plain(dict(items)[r.item_id]), part) == r.distance
        clean = decontaminate.drop_contaminated(frame, benchmark, 0.1, block)
        assert sorted(map(str, (r.doc_id for r in clean.collect()))) == sorted(str(d) for d, _, _ in docs if d not in {w[0] for w in want})
        assert clean.columns == frame.columns
    assert decontaminate.benchmark_hits(frame, benchmark.limit(0)).collect() == []
    assert decontaminate.benchmark_hits(frame.limit(0), benchmark).collect() == []


# --- licenses ------------------------------------------------------------------


def test_licenses_are_found_whole_and_nearly_whole(spark, odd):
    apache, mit = licenses.TEMPLATES["apache-2.0-notice"], licenses.TEMPLATES["mit-notice"]
    filler = " ".join(f"word{i}" for i in range(333))
    rows = [
        (1, f"{filler} {apache} {filler}", "x"),
        (2, filler + mit.upper().replace(" ", "\n\n"), "x"),
        (3, f"{filler} " + " ".join(apache.split()[: len(apache.split()) // 2]), "x"),
        (4, apache.replace("compliance", "keeping"), "x"),
        (5, "Released under the MIT License. Licensed under CC BY-NC 4.0.", "x"),
        (6, None, "x"), (7, "", "x"), (None, "Released under the MIT License.", "x"), (8, "the License", None),
        (5, "Released under the MIT License. Licensed under CC BY-NC 4.0.", "x"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, hash string")
    table = licenses.template_table(spark)
    found = licenses.scan_licenses(docs, table)
    assert "Python" not in plan_of(found)
    got = {(r.doc_id, r.template): r for r in found.collect()}
    assert {(1, "apache-2.0-notice"), (2, "mit-notice"), (4, "apache-2.0-notice"), (5, "mit"), (5, "cc-by-nc-4.0"), (None, "mit")} <= set(got)
    # Half of the long notice is the short one and no more.
    assert [k for k in got if k[0] in (3, 6, 7, 8)] == [(3, "apache-2.0")]
    assert got[1, "apache-2.0-notice"].containment == 1 and got[4, "apache-2.0-notice"].containment < 1
    assert got[1, "apache-2.0-notice"].word <= 333
    assert licenses.scan_licenses(docs.limit(0), table).collect() == []
    assert licenses.scan_licenses(docs, table.limit(0)).collect() == []
    assert licenses.scan_licenses(odd("hash"), table).collect() == []


# --- revisits ------------------------------------------------------------------


@pytest.mark.parametrize("url, same", [
    ("HTTP://WWW.Example.com:80/a/?b=2&utm_source=x&a=1#top", "example.com/a?a=1&b=2"),
    ("https://example.com/a?ref=1", "example.com/a"), ("example.com", "example.com"), ("", ""),
])
def test_canonical_urls(spark, url, same):
    assert spark.range(1).select(warc.canonical_url(F.lit(url))).first()[0] == same


def records(spark, rows):
    data = [(i, kind, uri, None if at is None else dt.datetime(2026, 1, 1) + dt.timedelta(minutes=at), block, "x") for i, kind, uri, at, block in rows]
    return spark.createDataFrame(data, "record_id string, record_type string, uri string, date timestamp, block string, url string")


def response(etag, body, status=200):
    return f"HTTP/1.1 {status} OK\r\nETag: {etag}\r\nContent-Type: text/html\r\nExpires: never\r\n\r\n{body}"


def revisit(*headers):
    return "HTTP/1.1 304 Not Modified\r\n" + "".join(h + "\r\n" for h in headers) + "\r\n"


def test_revisits_take_the_latest_earlier_full_response(spark):
    rows = [
        ("r1", "response", "http://a/", 1, response('"1"', "one")), ("r2", "response", "http://www.a", 5, response('"2"', "two\r\n\r\nmore")),
        ("r3", "response", "http://a/", 7, response('"3"', "part", 206)), ("r2", "response", "http://www.a", 5, response('"2"', "two\r\n\r\nmore")),
        ("v1", "revisit", "http://a/#x", 3, revisit('ETag: W/"1"', "Expires: now", "Content-Type: none")),
        ("v2", "revisit", "https://A/", 9, revisit('etag: "2"')), ("v3", "revisit", "http://a/", 1, revisit('ETag: "1"')),
        ("v4", "revisit", "http://a/", 6, revisit('ETag: "1"')), ("v5", "revisit", "http://a/", 6, revisit()),
        ("v6", "revisit", None, 6, revisit()), ("v7", "revisit", "http://a/", None, None), ("v8", "revisit", "http://b/", 9, "junk"),
        ("x", "request", "http://a/", 2, "GET"),
    ]
    got = {r.record_id: r for r in warc.resolve_revisits(records(spark, rows)).collect()}
    assert {k: (r.outcome, r.response_id) for k, r in got.items()} == {
        "v1": ("resolved", "r1"), "v2": ("resolved", "r2"), "v3": ("missing", None), "v4": ("changed", "r2"),
        "v5": ("unverified", "r2"), "v6": ("missing", None), "v7": ("missing", None), "v8": ("missing", None),
    }
    assert [(h.name, h.value) for h in got["v1"].headers] == [("content-type", "text/html"), ("etag", 'W/"1"'), ("expires", "now")]
    assert got["v2"].body == "two\r\n\r\nmore" and got["v4"].body is None
    assert warc.resolve_revisits(records(spark, [])).collect() == []


def test_a_hot_url_equals_a_plain_search(spark):
    random.seed(4)
    rows = [(f"{'r' if random.random() < 0.3 else 'v'}{i:04d}", i) for i in random.sample(range(3000), 600)]
    made = [
        (name, "response" if name[0] == "r" else "revisit", "http://hot/" if i % 3 else f"http://h{i % 50}/", i // 2,
         response('"1"', name) if name[0] == "r" else revisit('ETag: "1"'))
        for name, i in rows
    ]
    want = {}
    for name, kind, uri, at, _ in made:
        if kind == "revisit":
            earlier = [(a, n) for n, k, u, a, _ in made if k == "response" and u == uri and a < at]
            want[name] = max(earlier)[1] if earlier else None
    got = {r.record_id: (r.response_id, r.body) for r in warc.resolve_revisits(records(spark, made).repartition(7)).collect()}
    assert got == {k: (v, v) for k, v in want.items()}


# --- quality -------------------------------------------------------------------


def test_quality_on_held_out_documents(spark):
    random.seed(6)
    words = ["river", "stone", "bridge", "walks", "quiet", "evening", "under"]

    def text(good):
        prose = " ".join(random.choices(words, k=random.randrange(30, 200)))
        return prose + "." if good else "".join(f"{w.upper()}!! " for w in prose.split())

    docs = [(i, text(i % 5 > 0), i % 5 > 0) for i in range(400)]
    frame = spark.createDataFrame([(i, t, "x") for i, t, _ in docs] + [(None, None, "x"), (1000, "", "x"), (1000, "", "x")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, int(g)) for i, _, g in docs] + [(None, 1), (5, None), (9999, 1)], "doc_id long, quality int")
    model = quality.fit(frame, labels)
    rows = quality.score_quality(frame, model).collect()
    assert len(rows) == 403 and all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id < 400]
    assert held and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows if r.doc_id is not None)
    assert all(r.predicted == (r.score >= 0.3) == docs[r.doc_id][2] for r in held)
    kept = quality.keep_good(frame, model)
    assert kept.columns == frame.columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in rows if r.predicted}
    assert quality.score_quality(frame.limit(0), model).collect() == []


def graded(n, seed=9):
    """Texts from all prose (good) to all shouting (bad), and how good each is."""
    random.seed(seed)
    words = ["river", "stone", "bridge", "walks", "quiet", "evening", "under"]
    goods = [random.random() for _ in range(n)]
    return [(" ".join(w if random.random() < g else w.upper() + "!!" for w in random.choices(words, k=120)), g) for g in goods]


@pytest.mark.parametrize("limit", [40, 20_000])
def test_the_cut_is_a_quantile_of_all_rows(spark, limit):
    # The labelled documents are better than the others, and with the small limit most labels are not in the sample.
    texts = graded(1500)
    labelled = [i for i, (_, g) in enumerate(texts) if g > 0.35]
    free = [i for i in range(len(texts)) if zlib.crc32(str(i).encode()) % 5]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(texts[i][1] > 0.5)) for i in labelled], "doc_id long, quality int")
    share = np.mean([texts[i][1] <= 0.5 for i in labelled if i in set(free)])
    model = quality.fit(docs, labels, max_labelled=limit)
    strengths = np.array([model.strength(quality.features(texts[i][0])) for i in free])
    assert model.quantile_at == pytest.approx(np.quantile(strengths, share, method="midpoint"))
    scored = {r.doc_id: r.predicted for r in quality.score_quality(docs, model).collect()}
    assert sum(1 - scored[i] for i in free) == pytest.approx(share * len(free), abs=1)


def test_a_hot_doc_id_leaves_the_other_labels_in_the_fit(spark):
    texts = graded(60, seed=10)
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5]
    labels = spark.createDataFrame([(i, int(texts[i][1] > 0.5)) for i in ids] + [(ids[0], 1)] * 300, "doc_id long, quality int")
    plain = [(i, texts[i][0]) for i in ids]
    # The smallest labelled doc_id is held by far more rows than the fit takes: copies, or different texts.
    for others in ([plain[0]] * 400, [(ids[0], f"{plain[0][1]} {'x' * k}") for k in range(400)]):
        docs = spark.createDataFrame(plain + others, "doc_id long, text string").repartition(3)
        model = quality.fit(docs, labels, max_labelled=80)
        scores = {r.doc_id: r.score for r in quality.score_quality(docs, model).collect()}
        good, bad = ([scores[i] for i in ids[1:] if (texts[i][1] > 0.5) == g] for g in (True, False))
        assert model.weights.any() and np.mean(good) > np.mean(bad) + 0.05


def test_quality_without_both_labels(spark):
    docs = spark.createDataFrame([(1, "a text"), (2, None)], "doc_id long, text string")
    for given_ in ([], [(1, 1), (2, 1)]):
        model = quality.fit(docs, spark.createDataFrame(given_, "doc_id long, quality int"))
        assert {round(r.score, 6) for r in quality.score_quality(docs, model).collect()} == {quality.CUT}
        assert quality.keep_good(docs, model).count() == 2


def test_preferences_move_weights_the_right_way():
    data = np.array([[0.0, 1.0], [0.1, 5.0], [1.0, 2.0], [0.9, 4.0]])
    mean, spread, weights = quality.learn(data, np.array([0, 0, 1, 1]))
    assert weights[0] > abs(weights[1])
