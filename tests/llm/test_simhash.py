import itertools

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from riverbend.llm import simhash
from riverbend.llm.components import connected_components

SCHEMA = "doc_id long, text string, fp string, size string, component_id string"


def slow_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(fps, radius=3):
    """fps: list of (id, fp) -> smallest reachable id for each, brute force."""
    label = list(range(len(fps)))
    for a, b in itertools.combinations(range(len(fps)), 2):
        if bin(fps[a][1] ^ fps[b][1]).count("1") <= radius and label[a] != label[b]:
            old, new = label[b], label[a]
            label = [new if x == old else x for x in label]
    out = []
    for x in label:
        ids = [i for (i, _), y in zip(fps, label) if y == x and i is not None]
        out.append(min(ids) if ids else None)
    return out


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aAbB éÉ\x85\x1c\t\n", max_size=60))
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) == slow_fingerprint(text)


def test_forest_finds_all_within_the_radius():
    rng = np.random.default_rng(1)
    centre = rng.integers(0, 2**63, 6).astype(np.uint64)
    fps = np.unique(np.concatenate([c ^ (np.uint64(1) << rng.integers(0, 64, 40).astype(np.uint64))
                                    ^ (np.uint64(1) << rng.integers(0, 64, 40).astype(np.uint64)) for c in centre]))
    forest = simhash.BKForest(fps, np.zeros(len(fps), np.int64))
    found = {(int(a), int(b)) for q, n in forest.search(fps, np.zeros(len(fps), np.int64), 3) for a, b in zip(q, n)}
    slow = {(a, b) for a in range(len(fps)) for b in range(len(fps)) if bin(int(fps[a]) ^ int(fps[b])).count("1") <= 3}
    assert found == slow and len(slow) > len(fps)


def near_copies(seed=0, n=150):
    """Fingerprints round a few centres and far from all."""
    rng = np.random.default_rng(seed)
    out = []
    for c in rng.integers(0, 2**63, 5).tolist():
        for _ in range(n // 6):
            x = c
            for b in rng.integers(0, 64, int(rng.integers(0, 5))).tolist():
                x ^= 1 << b
            out.append(x)
    return out + rng.integers(0, 2**63, n // 6).tolist()


def test_links_span_all_components_at_any_tree_size(spark):
    fps = sorted({x - (1 << 64) if x >> 63 else x for x in near_copies()})
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    want = slow_components([(x, x & (2**64 - 1)) for x in fps])
    for tree_size in (4096, 7, 2):
        roots = {r.node: r.root for r in connected_components(simhash.links(df, 3, tree_size)).collect()}
        assert [roots.get(x, x) for x in fps] == want


def test_components_of_a_long_chain_and_a_hub(spark):
    chain = [(i, i + 1) for i in range(40)]
    hub = [(1000, 1001 + i) for i in range(200)] + [(5000, 5000), (None, 3)]
    df = spark.createDataFrame(chain + hub, "a long, b long")
    got = {r.node: r.root for r in connected_components(df).collect()}
    assert got == {i: 0 for i in range(41)} | {1000 + i: 1000 for i in range(201)}
    assert connected_components(df.limit(0)).count() == 0


def test_near_duplicates_against_brute_force(spark):
    base = " ".join(f"word{i}" for i in range(400))
    rows = [(5, base), (3, base.replace("word7 ", "WORD7 ")), (9, base.replace("word200", "other")), (7, base),
            (1, None), (2, ""), (4, " \n"), (None, base), (None, None), (11, "one two"), (11, "one two"), (12, "a lone text of words " * 30)]
    df = spark.createDataFrame([(i, t, "x", "y", "z") for i, t in rows], SCHEMA)
    got = simhash.near_duplicates(df).collect()
    fps = [(i, slow_fingerprint(t or "")) for i, t in rows]
    want = sorted(((i, f, c) for (i, f), c in zip(fps, slow_components(fps))), key=str)
    assert sorted(((r.doc_id, r.fp & (2**64 - 1), r.component_id) for r in got), key=str) == want
    kept = simhash.dedup(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, _, c in want})
    assert simhash.dedup(df.limit(0)).count() == 0 and simhash.simhash_table(df.limit(0)).count() == 0


def test_query_against_brute_force(spark):
    from riverbend.llm.queries import op10_simhash
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    fps = [(d.doc_id, slow_fingerprint(d.text or "")) for d in docs]
    want = {(i, f"{f:016x}", c) for (i, f), c in zip(fps, slow_components(fps))}
    assert {tuple(r) for r in op10_simhash(spark, sf).collect()} == want


@pytest.mark.parametrize("name", ["_key", "_text_hash", "_nth", "_kept_id", "_kept_hash", "key", "h", "id", "row", "nth", "kept", "fp", "group_fp", "text_hash", "component_id", "_id", "_text", "a.b"])
def test_dedup_keeps_columns_of_any_name(spark, name):
    docs = spark.createDataFrame([(1, "one two three four", 7), (2, "one two three four", 8), (3, "quite another text here", 9)], ["doc_id", "text", name])
    out = simhash.dedup(docs)
    assert out.columns == docs.columns
    assert sorted(map(tuple, out.collect())) == [(1, "one two three four", 7), (3, "quite another text here", 9)]
