import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riverbend.llm import queries, runs

DOCS = "doc_id long, text string"


def brute(words, min_length=6, min_exponent=4):
    """All runs, each distance by itself."""
    found = []
    for q in range(1, len(words) // min_exponent + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            own = words[i:j + q]
            if len(own) >= max(min_length, min_exponent * q) and not any(own[r:] == own[:-r] for r in range(1, q)):
                found.append((i, len(own), q))
            i = max(j, i) + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapse(words, found):
    gone = {k for s, n, q in found for k in range(s + q, s + n)}
    return b" ".join(w for k, w in enumerate(words) if k not in gone)


def check(texts):
    for text, (n, found, kept) in zip(texts, runs.runs_of_texts(texts), strict=True):
        words = text.split()
        want = brute(words)
        assert (n, found, kept) == (len(words), want, collapse(words, want))


def repeating(rnd):
    words = []
    for _ in range(rnd.randint(0, 6)):
        letters = rnd.choice([1, 2, 2, 3, 5])
        unit = [rnd.randrange(letters) for _ in range(rnd.randint(1, rnd.choice([3, 9, 20])))]
        if rnd.random() < 0.3:
            unit = unit * rnd.randint(1, 5) + [rnd.randrange(letters)]
        words += (unit * rnd.randint(1, 7))[:rnd.randint(1, 120)]
    return " ".join(f"w{w}" for w in words).encode()


def test_repeating_texts_against_brute_force():
    rnd = random.Random(5)
    for _ in range(300):
        check([repeating(rnd) for _ in range(rnd.randint(1, 5))])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "b"]), max_size=60).map(lambda w: " ".join(w).encode()), min_size=1, max_size=3))
def test_two_words_against_brute_force(texts):
    check(texts)


def test_small_chunks_give_the_same(monkeypatch):
    rnd = random.Random(6)
    texts = [repeating(rnd) for _ in range(20)]
    whole = list(runs.runs_of_texts(texts))
    monkeypatch.setattr(runs, "CELLS", 1)
    assert list(runs.runs_of_texts(texts)) == whole


@pytest.mark.parametrize("n", [1, 2, 8, 64])
def test_transform_convolves_exactly(n):
    rnd = np.random.default_rng(n)
    x, y = rnd.integers(0, runs.PRIME, (2, 3, n)).astype(np.uint64)
    got = runs.transform(runs._times(runs.transform(x), runs.transform(y)), inverse=True)
    for row, a, b in zip(got.tolist(), x.tolist(), y.tolist(), strict=True):
        want = [sum(a[i] * b[(k - i) % n] for i in range(n)) * n % runs.PRIME for k in range(n)]
        assert row == want


def test_sums_of_squared_differences():
    words = np.array([*np.random.default_rng(1).integers(0, 90000, 200), *[7] * 60])
    squares = np.append(0, np.cumsum(words.astype(np.int64) ** 2 % runs.PRIME))
    for b in (1, 2, 8, 16):
        at = np.arange(0, 150, b)
        want = [[int(((words[j:j + b] - words[j + d:j + d + b]) ** 2).sum()) % runs.PRIME for d in range(b, 2 * b)] for j in at.tolist()]
        assert runs.mismatches(words, squares, at, b).tolist() == want


@pytest.mark.parametrize("words, want", [
    (["a"] * 200_000, [(0, 200_000, 1)]),
    (([*"ab"] * 30_000)[:-1], [(0, 59_999, 2)]),
    ((["a"] * 20_000 + ["c"]) * 4, None),
    ([str(i % 7919) for i in range(40_000)], [(0, 40_000, 7919)])])
def test_long_texts_in_bounded_time(words, want):
    (n, found, kept), = runs.runs_of_texts([" ".join(words).encode()])
    if want is None:
        want = [(k * 20_001, 20_000, 1) for k in range(4)] + [(0, 80_004, 20_001)]
        want.sort(key=lambda r: (r[0], r[2]))
    assert n == len(words) and found == want


def test_very_long_word_and_no_words():
    texts = [b"x" * 20_000_000, b"", b" \t\r\n\x0b\x0c", "\u00a0 \u00a0 \u00a0 \u00a0 \u00a0 \u00a0".encode()]
    found = list(runs.runs_of_texts(texts))
    assert [r[:2] for r in found] == [(1, []), (0, []), (0, []), (6, [(0, 6, 1)])]
    assert list(runs.runs_of_texts([])) == []


def test_operator_edges(spark):
    rows = [(1, None), (2, ""), (3, "a b " * 4), (3, "a b " * 4), (None, "q " * 6), (5, "q " * 5)]
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 AS runs", "2 AS collapsed", "3 AS n_words")
    found = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in runs.periodic_runs(docs).collect()), key=str)
    assert found == sorted([(1, 0, [], ""), (2, 0, [], ""), (3, 8, [(0, 8, 2)], "a b"), (3, 8, [(0, 8, 2)], "a b"), (None, 6, [(0, 6, 1)], "q"),
                            (5, 5, [], "q q q q q")], key=str)
    assert runs.periodic_runs(docs.limit(0)).count() == 0


def test_fewer_than_four_periods_are_refused():
    with pytest.raises(ValueError):
        list(runs.runs_of_texts([b"a a"], min_exponent=3))


def test_query_against_brute_force(spark, tmp_path):
    rnd = random.Random(9)
    rows = [(i, " ".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(0, 90)))) for i in range(400)] + [(None, "z " * 9), (401, None)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: tuple(r)[1:] for r in queries.op12_periodic_runs(spark, str(tmp_path)).collect()}
    planted = 0
    for doc, text in rows:
        words = (text or "").split()
        h = zlib.crc32(str(doc).encode()) if doc is not None else 1
        if h % 10 == 0 and words:
            planted += 1
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        found = brute(words)
        best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        listing = "".join(f"{s},{n},{q}\n" for s, n, q in found)
        digests = [hashlib.sha256(t).hexdigest() for t in (listing.encode(), collapse([w.encode() for w in words], found))]
        assert got[doc] == (len(found), *(best or [None] * 3), 1000 * best[1] // best[2] if best else None, *digests)
    assert planted > 20 and len(got) == len(rows)
