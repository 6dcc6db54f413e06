import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from riverbend.llm import quality as q

SF = "/root/testdata/sf0.01"


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abA \n\t!é|", max_size=600))
def test_every_word_lies_in_a_passage(text):
    x = q.encode(text.encode())
    n = len(text.encode().split())
    assert x.shape == (max(1, -(-n // q.PASSAGE)), q.N_FEATURES) and np.isfinite(x).all()
    assert round(float(x[:, q._N_CLASSES + 4].sum() * q.PASSAGE)) == n


def test_gradients_by_finite_differences():
    rng = np.random.default_rng(0)
    bags = [rng.normal(size=(n, q.N_FEATURES)) for n in (1, 3, 2)]
    labels = np.array([1.0, 0, 1])
    m = q.AttentionModel(bags, labels, steps=3)
    sizes = np.array([1, 3, 2])
    starts, x = np.array([0, 1, 4]), np.concatenate(bags)

    def loss():
        p = m._forward(x, starts, sizes)["p"]
        return -np.mean(labels * np.log(p) + (1 - labels) * np.log(1 - p))

    for k, g in m._gradients(x, starts, sizes, labels).items():
        for _ in range(4):
            i = tuple(int(rng.integers(n)) for n in m.weights[k].shape)
            old, step = m.weights[k], np.zeros(m.weights[k].shape)
            step[i] = 1e-5
            m.weights[k] = old + step
            up = loss()
            m.weights[k] = old - step
            down = loss()
            m.weights[k] = old
            assert abs((up - down) / 2e-5 - np.asarray(g)[i]) < 1e-5


def test_attention_finds_the_telling_passage():
    good, bad = " ".join(f"word{i} is, here." for i in range(100)), "SHOUT!! " * 64
    bags = [q.encode((good + " " + (bad if i % 2 else good[:300]) + " " + good[i:]).encode()) for i in range(60)]
    m = q.AttentionModel(bags, np.array([1 - i % 2 for i in range(60)]))
    scores, weights = m.score(bags)
    assert scores[::2].min() > 0.8 > 0.2 > scores[1::2].max()
    assert abs(weights.sum() - 60) < 1e-6


def test_query_on_held_out_labels(spark):
    from riverbend.llm.queries import op3_quality
    out = op3_quality(spark, SF).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(out) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in out)
    held = [(labels[r.doc_id], r.score) for r in out if r.held_out and r.doc_id in labels]
    pos, neg = [s for y, s in held if y], [s for y, s in held if not y]
    assert np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg]) > 0.9
    assert np.mean([(s >= 0.7) == y for y, s in held]) > 0.9


def test_small_tables(spark):
    rows = [(i, "BAD!! " * 40 if i % 3 == 0 else "a fine text, as ever. " * 10, "x", 1.0) for i in range(60)]
    docs = spark.createDataFrame(rows + [(None, None, "x", 1.0), (3, "BAD!! " * 40, "x", 1.0), (700, "", "x", 1.0), (701, "long " * 60_000, "x", 1.0)],
                                 "doc_id long, text string, held_out string, score double")
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(60)] + [(None, 1, 0), (5, None, 0), (701, 1, 0)], "doc_id long, quality int, toxic int")
    out = q.quality_table(docs, labels).collect()
    assert len(out) == 64
    assert all(r.predicted == (r.doc_id % 3 > 0) for r in out if r.doc_id is not None and r.doc_id < 60)
    assert q.quality_table(docs.limit(0), labels).count() == 0
    assert {r.score for r in q.quality_table(docs, labels.limit(0)).collect()} == {0.5}
