import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riverbend.llm import decontaminate as d
from riverbend.llm.common import plain_words

SF = "/root/testdata/sf0.001"
ITEM = "the quick brown fox jumps over the lazy dog while seven bright owls watch from a tall green tree near the river"


def slow_score(item, words):
    """Smith-Waterman cell by cell."""
    h = np.zeros((len(item) + 1, len(words) + 1))
    for i in range(1, len(item) + 1):
        for j in range(1, len(words) + 1):
            same = d.MATCH if item[i - 1] == words[j - 1] else d.MISMATCH
            h[i, j] = max(0, h[i - 1, j - 1] + same, h[i - 1, j] + d.GAP, h[i, j - 1] + d.GAP)
    return h.max()


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 4), min_size=1, max_size=12), st.lists(st.integers(-1, 4), max_size=20))
def test_alignment(item, words):
    words = [-1 if w == -1 else w for w in words]
    score, end = d.best_local(np.array(item), np.array(words, np.int64))
    assert score == pytest.approx(slow_score(item, words))
    if score:
        assert slow_score(item, words[:end]) == pytest.approx(score)


def edited(text, every):
    return " ".join("changed" if i % every == every - 1 else w for i, w in enumerate(text.split()))


def test_copies_edits_and_strangers():
    items = d.Items([(7, ITEM), (8, "a b"), (9, "something else entirely about numbers and long tables")])
    whole = items.leaks(f"some words before {ITEM.upper()}!! and after", 0.5)
    assert [(x.item, x.score, x.start, x.end) for x in whole] == [(7, 1.0, 3, 3 + len(ITEM.split()))]
    assert [x.item for x in items.leaks(f"x {edited(ITEM, 6)} y", 0.5)] == [7]
    words = ITEM.split()
    assert [x.item for x in items.leaks(" ".join(words[:8] + ["new", "words"] + words[8:11] + words[13:]), 0.5)] == [7]
    assert items.leaks("the the over the of the a the quick test of a river", 0.5) == []
    assert [x.item for x in items.leaks("x a b", 0.5)] == [8]
    assert items.leaks("", 0.5) == []


def test_rare_seeds_stay_for_an_item_that_leaks_everywhere():
    items = d.Items([(1, ITEM)])
    n = len(items.places)
    items.keep_rare(dict.fromkeys(items.places, 30_000), 90_000)
    assert len(items.places) == n
    common = next(iter(items.places))
    items.keep_rare({common: 80_000}, 90_000)
    assert len(items.places) == n - 1


@pytest.mark.parametrize("share", [0.1, 0.2, 0.3])
def test_edited_item_in_a_third_of_all_documents(spark, share):
    rng = np.random.default_rng(int(share * 10))
    item = [f"w{i}" for i in range(40)]
    gone = set(np.linspace(2, 38, round(share * 40)).astype(int).tolist())
    leak = [f"x{i}" if i in gone else w for i, w in enumerate(item)]
    texts = [[f"c{i}" for i in rng.integers(0, 400, 60)] for _ in range(90)]
    for i in range(0, 90, 3):
        texts[i][20:20] = leak
    for i in range(1, 90, 9):  # shares a frequent gram, but is clean
        texts[i][5:5] = leak[-5:]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    ids = {w: i for i, w in enumerate(item)}
    scores = [slow_score(list(ids.values()), [ids.get(w, -1) for w in words]) / 40 for words in texts]
    want = {i: s for i, s in enumerate(scores) if s >= 0.5}
    got = {r.doc_id: r.score for r in d.leaks(docs, bench).collect()}
    assert sorted(got) == sorted(want) == list(range(0, 90, 3))
    assert all(got[i] == pytest.approx(s) for i, s in want.items())
    assert d.decontaminate(docs, bench).count() == 60


def test_short_items_take_no_clean_documents(spark):
    texts = [f"a trip to Paris in the year {i}" for i in range(30)] + ["nothing here", "only this one says zanzibar", "the zebra yodels"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame([(1, "Paris"), (2, "the"), (3, "in the"), (4, "Zanzibar!"), (5, "zebra yodels")], "item_id long, text string")
    assert sorted((r.doc_id, r.item_id, r.score) for r in d.leaks(docs, bench).collect()) == [(31, 4, 1.0), (32, 5, 1.0)]
    assert sorted(r.doc_id for r in d.decontaminate(docs, bench).collect()) == list(range(31))


def test_query_against_brute_force(spark):
    from riverbend.llm.queries import op2_decontamination
    docs = {r.doc_id: plain_words(r.text or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = {r.item_id: plain_words(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    got = {(r.doc_id, r.item_id): r for r in op2_decontamination(spark, SF).collect()}
    want = {}
    for k, item in items.items():
        ids = {w: i for i, w in enumerate(dict.fromkeys(item))}
        own = np.array([ids[w] for w in item])
        for i, words in docs.items():
            if sum(w in ids for w in words) >= 0.5 * len(item):
                score, _ = d.best_local(own, np.array([ids.get(w, -1) for w in words], np.int64))
                if score >= 0.5 * len(item):
                    want[i, k] = score / len(item)
    assert set(got) == set(want) and want
    assert all(got[x].score == pytest.approx(want[x]) for x in want)
    assert all(got[x].word_end - got[x].word_start >= 0.5 * len(items[x[1]]) for x in want)


def test_small_tables_and_blocks(spark):
    rows = [(1, f"intro {ITEM}", "x", 1.0), (1, f"intro {ITEM}", "x", 1.0), (2, None, "x", 1.0), (3, "", "x", 1.0), (None, f"{edited(ITEM, 7)} end", "x", 1.0),
            (5, "clean words only", "x", 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id string, score double")
    bench = spark.createDataFrame([(10, ITEM), (11, None), (12, "..."), (13, "one two three four five")], "item_id long, text string")
    for block in (d.BLOCK_WORDS, 5):
        out = d.leaks(docs, bench, block_words=block).collect()
        assert sorted((r.doc_id or 0, r.item_id) for r in out) == [(0, 10), (1, 10), (1, 10)]
    kept = d.decontaminate(docs, bench)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3, 5]
    assert d.leaks(docs, bench.limit(0)).count() == 0 and d.decontaminate(docs.limit(0), bench).count() == 0
