import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riverbend.llm import toxicity

SF = "/root/testdata/sf0.01"


def unit(rng, n_terms):
    terms = np.sort(rng.choice(n_terms, int(rng.integers(1, 6)), replace=False))
    w = rng.random(len(terms)) + 0.1
    return terms, w / np.linalg.norm(w)


@settings(max_examples=25, deadline=None)
@given(st.integers(0, 10_000))
def test_search_is_exact(seed):
    rng = np.random.default_rng(seed)
    vectors = [unit(rng, 20) for _ in range(int(rng.integers(0, 400)))]
    index = toxicity.BlockMaxIndex(vectors, 20)
    for _ in range(5):
        t, w = unit(rng, 20)
        dense = np.zeros(20)
        dense[t] = w
        cosines = np.array([dense[a] @ b for a, b in vectors])
        k = int(rng.integers(1, 20))
        want = [i for i in np.lexsort((np.arange(len(vectors)), -np.round(cosines, 9))).tolist() if cosines[i] > 0][:k] if vectors else []
        got = index.search(t, w, k)
        assert got.entry.tolist() == want
        assert np.allclose(got.cosine, cosines[want] if want else [])


def test_isotonic():
    x, y = toxicity.isotonic(np.array([1.0, 2, 3, 3, 4]), np.array([0.0, 1, 0, 0, 1]), np.array([1.0, 1, 1, 1, 2]))
    assert x.tolist() == [1, 2, 3, 4] and np.allclose(y, [0, 1 / 3, 1 / 3, 1])


def test_examples_vote_and_ties_count_once_each():
    terms = [b"bad", b"good"]
    examples = [(i, 1, ((0, 1),), 0) for i in range(30)] + [(100 + i, 0, ((1, 1),), 0) for i in range(30)] + [(200 + i, 0, (), 0) for i in range(40)]
    model = toxicity.ToxicityModel(terms, np.ones(2), examples)
    assert model.score("so bad, BAD!")[0] > 0.9 > 0.1 > model.score("good")[0]
    assert model.score("")[0] == model.score("neither")[0] < 0.05
    found = model.score("bad")[1]
    assert found == [(0, 1.0, 1.0)]
    assert toxicity.ToxicityModel([], np.empty(0), []).score("x")[0] == 0.5


def test_words_and_beginnings():
    assert toxicity.features({b"abcdef"}) == {b"abcdef", b"abcd*", b"abcde*"}
    assert "réeux*".encode() in toxicity.features({"réeuxment".encode()})


@pytest.fixture(scope="module")
def scored(spark):
    from riverbend.llm.queries import op1_toxicity
    return op1_toxicity(spark, SF).collect()


def test_query_on_held_out_labels(spark, scored):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in scored) == sorted(texts)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in scored)
    held = [(labels[r.doc_id], r.score) for r in scored if r.held_out and r.doc_id in labels]
    pos, neg = [s for y, s in held if y], [s for y, s in held if not y]
    auc = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    assert auc > 0.8 and np.mean([(s >= 0.5) == y for y, s in held]) > 0.9


def test_small_tables(spark):
    docs = spark.createDataFrame([(i, f"{'awful scum' if i % 3 == 0 else 'a fine text'} number w{i}", "a", 0.5) for i in range(90)]
                                 + [(None, None, "a", 0.5), (3, "awful scum number w3", "a", 0.5), (500, "", "b", 0.1)],
                                 "doc_id long, text string, label string, score double")
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(90)] + [(None, 1, 1), (7, 1, None), (8, 1, 5)],
                                   "doc_id long, quality int, toxic int")
    out = toxicity.toxicity_table(docs, labels).collect()
    assert len(out) == 93
    assert {r.predicted for r in out if r.doc_id is not None and r.doc_id < 90 and r.doc_id % 3 == 0} == {1}
    assert {r.predicted for r in out if r.doc_id is None or r.doc_id >= 90 or r.doc_id % 3} == {0}
    kept = toxicity.remove_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.count() == 62
    assert toxicity.toxicity_table(docs.limit(0), labels).count() == 0
    assert {r.score for r in toxicity.toxicity_table(docs, labels.limit(0)).collect()} == {0.5}
    model = toxicity.fit(docs, labels)
    first = docs.where("doc_id = 3").select(toxicity.evidence(docs["text"], model).alias("e")).first().e[0]
    assert first.cosine == pytest.approx(1) and first.positive == 1


def test_twenty_labelled_rows_separate_their_two_words(spark):
    rows = [(i, "what awful stuff" if i % 2 else "what lovely stuff") for i in range(20)] + [(100, "lovely"), (101, "so awful"), (102, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, toxic int")
    score = {r.doc_id: r.score for r in toxicity.toxicity_table(docs, labels).collect()}
    assert all((score[i] >= 0.5) == bool(i % 2) for i in range(20)) and score[100] < 0.5 <= score[101]
    assert toxicity.remove_toxic(docs, labels.where("toxic = 0 or doc_id < 12")).count() > 10


def test_a_copy_of_a_lone_example_has_it_as_evidence(spark):
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(f"w{k}" for k in rng.integers(0, 400, 12)) + (" awful" if i % 4 == 0 else "")) for i in range(800)]
    lone = "a kind of its own that no other text has"
    rows += [(2000, lone), (2001, lone.upper() + "!"), (2002, lone), (2003, "a kind of its own"), (2004, "that calm text of one more kind"), (2005, "that calm text of one more kind")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(800)] + [(2000, 1), (2004, 0)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, modulus=10 ** 9, remainder=1)
    for copy in (lone, lone.upper() + "!"):
        score, found = model.score(copy)
        assert score > 0.5 and found[0] == (2000, 1.0, 1.0)
    score, found = model.score("that calm text of one more kind")
    assert score < 0.5 and found[0] == (2004, 1.0, 0.0)


def test_the_whole_query_against_brute_force(spark):
    """Every score again from dense vectors: all cosines, all votes, the calibration."""
    from riverbend.llm.common import table
    docs, labels = table(spark, "/root/testdata/sf0.001", "documents"), table(spark, "/root/testdata/sf0.001", "labels")
    model = toxicity.fit(docs, labels)
    known = {r.doc_id: r.toxic for r in labels.collect() if r.toxic in (0, 1) and zlib.crc32(str(r.doc_id).encode()) % 5}
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    examples = [(i, known[i], model.counts(texts[i])) for i in sorted(known) if i in texts]

    def dense(counts):
        v = np.zeros(len(model.idf))
        for t, n in counts:
            v[t] = (1 + np.log(n)) * model.idf[t]
        return v / (np.linalg.norm(v) or 1)

    groups = {}
    for i, label, counts in examples:
        if counts:
            groups.setdefault(counts, []).append(label)
    prior = (sum(y for own in groups.values() for y in own) + sum(y for _, y, c in examples if not c) + 1) / (len(examples) + 2)
    own = [(dense(c), len(y), sum(y)) for c, y in groups.items()]
    for i, text in texts.items():
        counts = model.counts(text)
        copies = [y for j, y, _ in examples if toxicity.whole(text) and toxicity.whole(texts[j]) == toxicity.whole(text)]
        if not counts and not copies:
            assert model.score(text) == (model.none, [])
            continue
        v = dense(counts)
        cosines = np.array([v @ u for u, _, _ in own])
        best = np.sort(cosines[cosines > 1e-12])[::-1][:toxicity.NEIGHBOURS]
        least = best[-1] - 1e-9 if len(best) else 2
        near = [(c, n, p) for c, (_, n, p) in zip(cosines, own, strict=True) if c >= least]
        if len(near) > toxicity.NEIGHBOURS:
            continue  # equal cosines at the edge: which of them vote is the index's order
        w = [1 / (min(max(1 - c, 0), 1) + toxicity.EPS) for c, _, _ in near]
        votes = sum(x * n for x, (_, n, _) in zip(w, near, strict=True)) + len(copies) / toxicity.EPS + 1
        raw = (sum(x * p for x, (_, _, p) in zip(w, near, strict=True)) + sum(copies) / toxicity.EPS + prior) / votes
        assert model.score(text)[0] == pytest.approx(0.98 * np.interp(raw, *model.steps) + 0.02 * raw, abs=1e-9)
