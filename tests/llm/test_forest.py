import numpy as np
import pytest
from pyspark.sql import functions as F

from riverbend.llm import forest


def exact(ids, x, queries, k):
    """Brute force: {query id: [(vec_id, score)]}."""
    out = {}
    for i in queries:
        q = x[ids.index(i)]
        own = sorted(((-float(q @ v), j) for j, v in zip(ids, x) if j != i))[:k]
        out[i] = [(j, -s) for s, j in own]
    return out


def recall(got, want):
    return np.mean([len({j for j, _ in got.get(i, [])} & {j for j, _ in w}) / len(w) for i, w in want.items() if w])


def result(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        own = out.setdefault(r.query_id, [])
        own.append((r.vec_id, r.score))
        assert r.rank == len(own)
    return out


def test_ranges_hold_the_longest_prefixes():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((500, 8))
    f = forest.PrefixForest(x, np.linalg.norm(x, axis=1).max(), trees=3, bits=10)
    q = rng.standard_normal((20, 8))
    codes = f.hash(np.column_stack([q, np.zeros(20)]))
    lo, hi = f.ranges(q, 30)
    for i in range(20):
        for depth in range(10, -1, -1):
            own = [(f.codes[t] >> (10 - depth) == codes[i, t] >> (10 - depth)) for t in range(3)]
            if sum(o.sum() for o in own) >= 30 or not depth:
                break
        assert all((np.flatnonzero(o) == np.arange(a, b)).all() for o, a, b in zip(own, lo[i], hi[i]))


def test_a_part_holds_one_shard_and_one_block_of_queries(spark):
    n, shards, blocks = 3000, 3, 10
    entries = spark.range(n).select(F.encode(F.col("id").cast("string"), "utf-8").alias("vec"), F.array("id").alias("ids"))
    dealt = forest._dealt(entries, entries.select("vec", F.col("ids")[0].alias("query")), shards, blocks)
    parts = dealt.groupBy("part").agg(F.expr("count_if(query >= 0)").alias("asked"), F.expr("count_if(query < 0)").alias("held")).collect()
    assert len(parts) == shards * blocks
    assert max(p.asked for p in parts) < 1.3 * n / blocks and max(p.held for p in parts) < 1.2 * n / shards
    pairs = dealt.where("query < 0").select("part", F.col("ids")[0].alias("id")).join(dealt.where("query >= 0").select("part", "query"), "part")
    assert pairs.count() == pairs.distinct().count() == n * n


def test_blocks_of_queries_change_no_result(spark):
    x = np.random.default_rng(5).standard_normal((600, 6))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    whole, cut = (result(forest.nearest(df, F.col("vec_id") % 2 == 0, k=5, shard_size=200, asked_size=a)) for a in (1000, 40))
    assert whole == cut and len(whole) == 300


def test_query_recall(spark):
    from riverbend.llm.queries import op8_prefix_forest
    sf = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").collect()
    ids, x = [r.vec_id for r in rows], np.array([r.embedding for r in rows])
    want = exact(ids, x, [i for i in ids if i % 20 == 0], 20)
    got = result(op8_prefix_forest(spark, sf))
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    assert recall(got, want) >= 0.9
    for i, own in got.items():
        for j, s in own:
            assert s == pytest.approx(float(x[ids.index(i)] @ x[ids.index(j)]), abs=1e-12)


def test_shards_norms_copies_and_odd_rows(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((300, 6)) * rng.uniform(0.5, 3, (300, 1))
    x[50:180] = x[50]
    rows = [(i, v.tolist(), "s") for i, v in enumerate(x)]
    odd = [(None, [1.0] * 6, "s"), (1000, None, "s"), (1020, [], "s"), (1040, [0.0] * 6, "s"), (1060, [float("nan")] + [1.0] * 5, "s"), (1080, [None] + [1.0] * 5, "s"),
           (1100, [1.0] * 5, "s"), (1120, [float("inf")] * 6, "s"), (60, x[60].tolist(), "s")]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, score string")
    want = exact(list(range(300)), x, range(0, 300, 20), 5)
    got = result(forest.nearest(df, F.col("vec_id") % 20 == 0, 5, share=50, shard_size=40))  # so large a share reads everything
    assert {i: [j for j, _ in v] for i, v in got.items()} == {i: [j for j, _ in v] for i, v in want.items()}
    few = result(forest.nearest(df.where("vec_id < 3"), F.col("vec_id") == 0, 20))
    assert [j for j, _ in few[0]] == [j for j, _ in exact([0, 1, 2], x[:3], [0], 20)[0]]
    assert forest.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert forest.nearest(df.where("vec_id in (0, 1040)"), F.col("vec_id") % 20 == 0).count() == 0
