import collections
import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riverbend.llm import phrases, repeats, suffix_array
from riverbend.llm.repeats import Bytes, Plan, Words

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, row string, th string"


def slow_bytes(rows, window):
    """Brute force of the byte operator: rows of (id, text)."""
    data = [(t or "").encode() for _, t in rows]
    times = collections.Counter(d[i:i + window] for d in data for i in range(len(d) - window + 1))
    out = []
    for (doc, _), d in zip(rows, data):
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - window + 1):
            if times[d[i:i + window]] > 1:
                gone[i:i + window] = True
        spans = sum(bool(g) and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc, len(d), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(d, np.uint8)[~gone].tobytes()).hexdigest()))
    return sorted(out, key=str)


def slow_words(rows, window):
    data = [(t or "").encode().split() for _, t in rows]
    least = {}
    for (doc, _), w in zip(rows, data):
        if doc is not None:
            for i in range(len(w) - window + 1):
                k = tuple(w[i:i + window])
                least[k] = min(least.get(k, doc), doc)
    out = []
    for (doc, _), w in zip(rows, data):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if doc is not None and least[tuple(w[i:i + window])] < doc:
                gone[i:i + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((doc, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 3), max_size=60), st.integers(1, 70))
def test_suffix_ranks(letters, depth):
    ranks = suffix_array.suffix_ranks(np.array(letters, np.int64), depth)
    suffixes = [tuple(letters[i:]) for i in range(len(letters))]
    order = sorted(range(len(letters)), key=lambda i: suffixes[i])
    for a, b in zip(order, order[1:]):
        assert ranks[a] <= ranks[b]
        assert suffixes[a][:depth] == suffixes[b][:depth] or ranks[a] < ranks[b]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from([1, 2, 255, 256, 1 << 20]), max_size=60), st.integers(1, 70))
def test_ranks_count_smaller_prefixes(letters, depth):
    ranks = suffix_array.suffix_ranks(np.array(letters, np.int64), depth).tolist()
    prefixes = [tuple(letters[i:i + depth]) for i in range(len(letters))]
    assert ranks == [sum(q < p for q in prefixes) for p in prefixes]


def test_ranks_of_ties_and_of_keys_too_large_to_pack():
    assert suffix_array.suffix_ranks(np.ones(7, np.int64), 1).tolist() == [0] * 7
    assert suffix_array.suffix_ranks(np.ones(7, np.int64), 3).tolist() == [2, 2, 2, 2, 2, 1, 0]
    keys = np.array([1 << 61, 5, 1 << 60, 5])
    got, order = suffix_array.in_order(keys, 1 << 62)
    assert got.tolist() == sorted(keys.tolist()) == keys[order].tolist()


@pytest.mark.parametrize("units, size", [(Bytes, (20, 6)), (Words, (9, 3))])
def test_texts_hashed_side_by_side_have_their_own_anchors(monkeypatch, units, size):
    plan, rng = Plan(units, *size), np.random.default_rng(4)
    texts = [units.split(b" ".join(rng.choice([b"a", b"b", b"cc"], n))) for n in (0, 40, 3, 9, 200, 1, 25, 60, 8, 30, 500)]
    for most in (1, 90, 1 << 15):
        monkeypatch.setattr(repeats, "SIDE_BY_SIDE", most)
        found = [row for number, own in repeats.anchors_of(texts, plan) for row in zip(number.tolist(), *(x.tolist() for x in own), strict=True)]
        assert found == [(k, *row) for k, t in enumerate(texts) for row in zip(*(x.tolist() for x in repeats.anchors(t, plan)), strict=True)]


@settings(max_examples=80, deadline=None)
@given(st.binary(max_size=120), st.sampled_from([(9, 3), (20, 6), (8, 8), (12, 1)]), st.booleans())
def test_each_window_has_one_anchor_that_depends_on_it_alone(data, size, few):
    if few:
        data = bytes(b % 3 for b in data)
    plan = Plan(Bytes, *size)
    units = Bytes.split(data)
    found = repeats.anchors(units, plan)
    covered = [s for f, n in zip(found.first, found.windows) for s in range(f, f + n)]
    assert covered == list(range(max(0, len(data) - plan.window + 1)))
    chosen = {}
    for h, at, f, n in zip(*found):
        for s in range(f, f + n):
            assert s <= at <= s + plan.window - plan.gram
            assert chosen.setdefault(data[s:s + plan.window], (h, at - s)) == (h, at - s)


def test_long_texts_are_hashed_in_chunks(monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK", 16)
    rng = np.random.default_rng(0)
    words = Words.split(b" ".join(rng.choice([b"a", b"b", b"cc"], 300)))
    small = repeats.anchors(words, Plan(Words, 10, 3))
    monkeypatch.setattr(repeats, "CHUNK", 1 << 18)
    whole = repeats.anchors(words, Plan(Words, 10, 3))
    spread = lambda f: [(h, a) for h, a, n in zip(f.hash, f.at, f.windows) for _ in range(n)]
    assert spread(small) == spread(whole)


def corpus():
    rng = np.random.default_rng(1)
    vocabulary = [f"w{i}é" for i in range(300)]
    text = lambda n: " ".join(rng.choice(vocabulary, n))
    passage, line = text(30), text(14)
    rows = [(i, f"{text(int(rng.integers(5, 30)))} {passage if i % 3 == 0 else ''} {text(8)}\n{line if i % 2 else ''} {text(5)}") for i in range(40)]
    copies = [(100 + i, rows[4][1]) for i in range(30)]
    near = [(200 + i, rows[6][1].replace(" ", "  ", 1) + f" end{i}") for i in range(20)]
    runs = [(300, "a " * 60), (301, "a " * 45), (302, "abc " * 30 + text(5))]
    odd = [(None, None), (400, ""), (401, " \n"), (402, None), (None, rows[0][1]), (403, rows[0][1]), (403, rows[0][1]), (403, "other " + passage), (404, "short")]
    return rows + copies + near + runs + odd


@pytest.mark.parametrize("hot", [8192, 3])
def test_words_against_brute_force(spark, hot):
    rows = corpus()
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    out = phrases.remove_passages(df, window=12, phrase=4, hot=hot)
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in out.collect()), key=str) == slow_words(rows, 12)


@pytest.mark.parametrize("hot", [8192, 3])
def test_bytes_against_brute_force(spark, hot):
    rows = corpus()
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    out = suffix_array.remove_repeated_bytes(df, window=40, gram=10, hot=hot)
    assert sorted((tuple(r) for r in out.collect()), key=str) == slow_bytes(rows, 40)


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert phrases.remove_passages(df).count() == 0 and suffix_array.remove_repeated_bytes(df).count() == 0


def test_queries_against_brute_force(spark):
    from riverbend.llm.queries import op5_phrases, op7_suffix_array
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted((tuple(r) for r in op5_phrases(spark, SF).collect()), key=str) == slow_words(rows, 50)
    assert sorted((tuple(r) for r in op7_suffix_array(spark, SF).collect()), key=str) == slow_bytes(rows, 200)
