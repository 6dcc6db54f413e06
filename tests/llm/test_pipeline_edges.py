"""The pipeline as a chain on rows that are odd in any way."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from riverbend.session import materialize

CLASHING = ["_key", "_text_hash", "_nth", "_kept_id", "_kept_hash", "row", "h", "key", "id", "fp", "group_fp", "component_id", "label", "score", "hits", "terms", "deal",
            "start", "length", "shard", "seed", "found", "n_found"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables in the drivers' schemas: nulls in every column, empty, long and repeated texts, copies, toxic and leaked ones, and columns of any name."""
    path = str(tmp_path_factory.mktemp("edges"))
    calm = [(i, f"calm text number {i} tells of {'sea hill wood lake'.split()[i % 4]} and {i * 7} other things, at length") for i in range(1, 60)]
    vile = [(100 + i, f"vile awful scum {i} says vile awful scum things to scum {i * 3}") for i in range(12)]
    leak = "which river runs past the old stone mill on the way down to the harbour of the northern town"
    odd = [(200, None), (201, ""), (202, " \t\n"), (None, "a text that has no id but words enough to be one"), (None, None), (203, "x" * 200_000),
           (204, "word " * 30_000), (205, f"So they ask: {leak}? And so on it goes."), (206, calm[4][1]), (207, calm[4][1]), (3, calm[2][1]), (3, calm[2][1]),
           (208, "mail me at some.one@example.org or +1 212 555 0100 please, today")]
    docs = spark.createDataFrame(calm + vile + odd, "doc_id long, text string").select(
        "doc_id", "text", F.when(F.col("doc_id") % 2 == 0, "en").alias("lang"), F.lit(None).cast("string").alias("source"),
        F.length("text").cast("long").alias("n_chars"), *[F.lit(i).alias(c) for i, c in enumerate(CLASHING)])
    docs.repartition(3).write.parquet(f"{path}/documents.parquet")
    labels = [(i, 1, 0) for i, _ in calm] + [(i, 0, 1) for i, _ in vile] + [(None, 1, 1), (5, None, None), (999, 1, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, leak), (2, None), (3, ""), (None, "an item that nobody has ever quoted")], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


@pytest.fixture(scope="module")
def stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(materialize(stage(spark, out[-1], folder), "edge-stage"))
    return out


def ids(df):
    return sorted((r.doc_id for r in df.select("doc_id").collect()), key=str)


def test_all_columns_stay_with_their_values(stages):
    whole = {r.doc_id: r for r in stages[0].collect()}
    for df in stages[1:4]:
        assert df.columns == stages[0].columns
        for r in df.where("doc_id is not null").collect():
            assert tuple(r)[2:] == tuple(whole[r.doc_id])[2:] and r.text == whole[r.doc_id].text
    assert [r[5:] for r in map(tuple, stages[4].collect())] == [tuple(range(len(CLASHING)))] * stages[4].count()


def test_toxic_rows_go_and_others_stay(stages):
    left = ids(stages[1])
    assert not set(range(100, 112)) & set(left)
    assert {200, 201, 202, 203, 204, 205, 206, 207, 208} <= set(left) and left.count(3) == 3 and left.count(None) == 2 and left.count("None") == 0


def test_one_of_each_group_stays(stages):
    left = ids(stages[2])
    assert len(left) == len(set(left)) and 3 in left and 5 in left and not {206, 207} & set(left)
    assert 200 in left and not {201, 202} & set(left)  # null, empty and blank texts are one group
    assert {203, 204, 205, 208} <= set(left)


def test_leaks_go(stages):
    assert set(ids(stages[2])) - set(ids(stages[3])) == {205}


def test_personal_data_goes_and_lengths_stay_known(stages):
    texts = {r.doc_id: r.text for r in stages[4].collect()}
    assert "some.one@example.org" not in texts[208] and texts[208].startswith("mail me at ")
    assert texts[200] is None or texts[200] == ""


def test_every_row_is_packed(stages):
    packed = stages[5].collect()
    assert {r.doc_id for r in packed} == set(ids(stages[4]))
    assert sum(r.length for r in packed if r.doc_id == 204) == next(r.doc_tokens for r in packed if r.doc_id == 204) > 30_000


def test_run_gives_the_same(spark, folder, stages):
    got = sorted((r.doc_id or -1, r.start, r.length, r.ids_crc32) for r in corpus_pipeline.run(spark, folder).collect())
    assert got == sorted((r.doc_id or -1, r.start, r.length, r.ids_crc32) for r in stages[5].collect())


@pytest.mark.parametrize("empty", ["documents", "labels", "benchmark"])
def test_empty_tables(spark, folder, tmp_path, empty):
    for name in ("documents", "labels", "benchmark"):
        rows = spark.read.parquet(f"{folder}/{name}.parquet")
        (rows.limit(0) if name == empty else rows).write.parquet(f"{tmp_path}/{name}.parquet")
    n = corpus_pipeline.run(spark, str(tmp_path)).count()
    assert n == 0 if empty == "documents" else n > 50
