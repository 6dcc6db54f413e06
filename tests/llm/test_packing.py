import collections
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riverbend.llm import packing
from riverbend.llm.queries import TOKENIZER


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(TOKENIZER)


def verify(pieces, texts, tokenizer, capacity):
    """Every id of every document lies in one piece; sequences are gapless and within capacity."""
    by_doc = collections.defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
    assert set(by_doc) == set(texts)
    for doc, text in texts.items():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        at = 0
        for p in sorted(by_doc[doc], key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids) and p.ids_crc32 == zlib.crc32(ids[at:at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    sequences = collections.defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append((p.offset, p.length))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(max_size=30), max_size=5))
def test_word_ids_are_the_tokenizers(texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(TOKENIZER)
    got = [x.tolist() for x in packing.WordIds(TOKENIZER).encode([x.encode() for x in texts])]
    assert got == [t.encode(x, add_special_tokens=False).ids for x in texts]


def test_word_ids_after_forgetting(monkeypatch, tokenizer):
    monkeypatch.setattr(packing, "KEPT_WORDS", 8)
    words = packing.WordIds(TOKENIZER)
    for k in range(6):
        texts = [f"alpha{k} Beta, gämma{j}!! it's <|endoftext|> x y" for j in range(4)]
        assert [x.tolist() for x in words.encode([x.encode() for x in texts])] == [tokenizer.encode(x, add_special_tokens=False).ids for x in texts]


def test_assignment_takes_the_cheapest_sequence_with_room():
    lengths = np.array([90, 60, 50, 30, 20, 10, 10])
    sequence, offset = packing.assign(lengths, 100, 1, 0.01)
    cost, used = collections.Counter(), collections.Counter()
    for k, length in zip(sequence.tolist(), lengths.tolist()):
        fits = [j for j in range(int(sequence.max()) + 1) if used[j] + length <= 100]
        assert cost[k] == min(cost[j] for j in fits)
        cost[k] += length + 0.01 * length**2
        used[k] += length
    assert max(used.values()) <= 100 and offset.min() == 0


def test_small_tables(spark, tokenizer):
    long = " ".join(f"word{i}" for i in range(900))
    rows = [(1, "a few words", 1, 2), (2, None, 1, 2), (3, "", 1, 2), (4, long, 1, 2), (5, "a few words", 1, 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, start int, sequence_id int")
    out = packing.pack_documents(df, TOKENIZER, capacity=64).collect()
    verify(out, {r[0]: r[1] for r in rows}, tokenizer, 64)
    again = spark.createDataFrame([(None, "x y", 1, 2)] * 3, df.schema)
    out = packing.pack_documents(again, TOKENIZER).collect()
    assert [p.doc_id for p in out] == [None] * 3 and sorted(p.offset for p in out) == [0, 3, 6]
    assert packing.pack_documents(df.limit(0), TOKENIZER).count() == 0


def test_query_round_trip(spark, tokenizer):
    from riverbend.llm.queries import op4_packing
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    out = op4_packing(spark, sf).collect()
    sequences = verify(out, texts, tokenizer, 4096)
    tokens = sum(p.length for p in out)
    assert sequences <= -(-tokens // 4096) * 1.02 + 1
