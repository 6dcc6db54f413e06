"""Every stage of the pipeline against a plain Python version of it."""

import numpy as np
import pytest

import corpus_pipeline
from riverbend.llm import decontaminate, pii, toxicity
from riverbend.llm.common import plain_words
from riverbend.llm.queries import PII_KEY, TOKENIZER
from riverbend.session import materialize
from test_packing import verify
from test_simhash import slow_components, slow_fingerprint

SF = "/root/testdata/sf0.001"
NAMES = [name for name, _ in corpus_pipeline.STAGES]


@pytest.fixture(scope="module")
def stages(spark):
    """Rows before the first stage and after every stage."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs.collect()]
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF), "test-stage")
        out.append(docs.collect())
    return out


def ids(rows):
    return sorted(r.doc_id for r in rows)


def test_names_and_columns(spark, stages):
    assert NAMES == ["toxicity", "simhash near-dedup", "decontamination", "pii", "packing"]
    assert all(list(s[0].asDict()) == list(stages[0][0].asDict()) for s in stages[1:5])
    assert all(0 < len(b) <= len(a) for a, b in zip(stages[:4], stages[1:5]))


def test_toxicity(spark, stages):
    model = toxicity.fit(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    assert ids(stages[1]) == ids(r for r in stages[0] if model.score(r.text or "")[0] < 0.5)


def test_near_duplicates(stages):
    fps = [(r.doc_id, slow_fingerprint(r.text or "")) for r in stages[1]]
    assert ids(stages[2]) == sorted(set(slow_components(fps)))


def test_decontamination(spark, stages):
    items = [plain_words(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]

    def holds(text):
        words = plain_words(text or "")
        for item in items:
            code = {w: i for i, w in enumerate(dict.fromkeys(item))}
            own = np.array([code.get(w, -1) for w in words], np.int64)
            if (own >= 0).sum() >= 0.5 * len(item) and decontaminate.best_local(np.array([code[w] for w in item]), own)[0] >= 0.5 * len(item):
                return True
        return False

    assert ids(stages[3]) == ids(r for r in stages[2] if not holds(r.text))


def test_pii_and_packing(spark, stages):
    own = pii.Pseudonymizer(PII_KEY)
    assert {(r.doc_id, r.text) for r in stages[4]} == {(r.doc_id, own.replace(r.text)[0]) for r in stages[3]}
    from tokenizers import Tokenizer
    texts = {r.doc_id: r.text for r in stages[4]}
    verify(stages[5], texts, Tokenizer.from_file(TOKENIZER), 4096)


def test_run_is_all_stages(spark, stages):
    key = lambda r: (r.doc_id, r.start, r.length, r.ids_crc32)
    assert sorted(map(key, corpus_pipeline.run(spark, SF).collect())) == sorted(map(key, stages[5]))
