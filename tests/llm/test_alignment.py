import collections
import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riverbend.llm import alignment, queries

DOCS = "doc_id long, text string"
TEXTS = ["", " ", "a", "  a  b", "<|endoftext|> x </s><s>", "▁a ▁", "ﬁ é\x00 <0x41>", "\n\n\t x　y", "漢字 test 👩‍👩‍👧 it's", " " * 700 + "x", "a\r\nb", "\x00", "x" * 3000,
         "The quick brown fox, the lazy dog. The quick brown fox."]


@pytest.fixture(scope="module")
def aligner():
    return alignment.Aligner(queries.ALIGNED)


def plain(aligner, text):
    """A's and B's ids, the groups and the linked pairs, offset by offset; A by the slower library."""
    t = aligner.tokenizers
    a = t.slow.encode(" " + text, add_special_tokens=False).ids
    b = t.pieces.encode(text)
    whole = (" " + text).encode()
    if not text or b"".join(t.a_bytes[i] for i in a) != whole or b"".join(t.b_bytes[i] for i in b) != whole:
        return 0, 0, "", []
    a_at = {int(e): i for i, e in enumerate(np.cumsum([len(t.a_bytes[i]) for i in a]))}
    groups, links, p, r = [], [], 0, 0
    for j, end in enumerate(np.cumsum([len(t.b_bytes[i]) for i in b]).tolist()):
        if end in a_at:
            i = a_at[end]
            groups.append(f"{','.join(map(str, a[p:i + 1]))}|{','.join(map(str, b[r:j + 1]))}")
            links.append((a[i], b[j]))
            p, r = i + 1, j + 1
    return len(a), len(b), ";".join(groups), links


def check(aligner, texts):
    for text, (n_a, n_b, groups, links) in zip(texts, aligner.align(texts), strict=True):
        pairs = [(int(p) >> 32, int(p) & 0xFFFFFFFF) for p in aligner.pairs[links]]
        assert (n_a, n_b, groups, pairs) == plain(aligner, text)


def test_odd_texts(aligner):
    check(aligner, TEXTS)
    check(aligner, [])
    assert list(aligner.align(["▁a"])) and plain(aligner, "▁a")[0] == 0 < plain(aligner, "<s> a")[0]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=40), max_size=4))
def test_any_text(aligner, texts):
    check(aligner, texts)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.sampled_from([" ", "  ", "\n", "the", "The", "ing", "1999", ".", "'s", "é", "漢", "▁", "ab"]), max_size=30).map("".join), max_size=4))
def test_blanks_and_marks(aligner, texts):
    check(aligner, texts)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.text(st.characters(min_codepoint=33, max_codepoint=126) | st.sampled_from("\n\nésßÉŉſ×'1a"), min_size=1, max_size=9)
                         | st.sampled_from(["don't", "the", "x\n\ny", "<s>", "</s>", "<0x41>", "1999.", "'s", "_", "--"]), min_size=1, max_size=25).map(" ".join), max_size=4))
def test_words_with_single_spaces(aligner, texts):
    check(aligner, texts)


def test_plain_words_are_tokenised_once(aligner, monkeypatch):
    own = alignment.Aligner(queries.ALIGNED)
    seen, b = [], own.tokenizers.b
    monkeypatch.setattr(own.tokenizers, "b", lambda texts: seen.extend(texts) or b(texts))
    texts = ["The café is open.\nThe door is café", "a  b the", " the", "the ", "the\n door", "the \ndoor", "the\tdoor", "漢 the", "is open.\nThe the"]
    check(own, texts)
    assert " ".join(seen) == "The café is open.\nThe door the a  b the  the the  the\n door the \ndoor the\tdoor 漢 the"
    seen.clear()
    check(own, ["door door is The", "the the café"])
    assert not seen


def test_words_that_are_no_windows_leave_their_texts_whole(aligner, monkeypatch):
    own = alignment.Aligner(queries.ALIGNED)
    monkeypatch.setattr(alignment, "WORDS_AT_ONCE", 3)
    monkeypatch.setattr(alignment, "ODD", re.compile("[^ -~▁]"))  # B takes a ▁ for a space
    texts = ["▁a the dog", "the fox dog", "x ▁ y"]
    check(own, texts)
    check(own, texts)
    assert (own.window_of < 0).any() and (own.window_of >= 0).any() and len(own.window_of) == len(own.words)


def test_documents(aligner, spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    check(aligner, texts)


def test_quick_ids_are_the_tokenizers_for_every_character(aligner):
    t = aligner.tokenizers
    assert t.same
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"x{c}1{c} {c}{c}." for c in every[k:k + 64]) for k in range(0, len(every), 64)]
    texts = texts[:600] + texts[600::40]
    assert t.a(texts) == [e.ids for e in t.slow.encode_batch([" " + x for x in texts], add_special_tokens=False)]


def test_forgotten_windows(aligner, monkeypatch):
    for name, value in (("KEPT_WINDOWS", 8), ("KEPT_IDS", 40)):
        monkeypatch.setattr(alignment, name, value)
        for k in range(6):
            check(aligner, [f"alpha{k} beta, gämma{j}!! it's x y" for j in range(4)])
            assert len(aligner.groups) == len(aligner.numbers) == len(aligner.bytes) == len(aligner.bounds) - 1
        monkeypatch.undo()


def test_linked_pairs_are_bounded_by_the_vocabularies(aligner):
    t = aligner.tokenizers
    assert len(aligner.pairs) <= sum(map(len, t.a_bytes)) + sum(map(len, t.b_bytes)) + 512 * 512
    some = {(i, j) for i, a in enumerate(t.a_bytes[:300]) for j, b in enumerate(t.b_bytes[:1500]) if a and b and (a.endswith(b) or b.endswith(a))}
    own = {(int(p) >> 32, int(p) & 0xFFFFFFFF) for p in aligner.pairs}
    assert some == {(i, j) for i, j in own if i < 300 and j < 1500}


def test_query_against_plain_counts(aligner, spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(99, None), (None, "the dog"), (7, "the dog"), (7, "the dog")]
    rows += [(100 + i, f"The number {i} follows {i * i}") for i in range(40)]
    spark.createDataFrame(rows, DOCS).selectExpr("*", "1 AS pairs", "2 AS times", "3 AS groups", "4 AS _scored").write.parquet(f"{tmp_path}/documents.parquet")
    own = [(doc, plain(aligner, text or "")) for doc, text in rows]
    counts = collections.Counter(link for _, (_, _, _, links) in own for link in links)
    best = collections.defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    want = [(doc, n_a, n_b, len(links), len(links), hashlib.sha256(groups.encode()).hexdigest() if groups else "",
             sum(counts[link] == best[link[1]] for link in links), sum(counts[link] for link in links)) for doc, (n_a, n_b, groups, links) in own]
    found = queries.op13_alignment(spark, str(tmp_path))
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(want, key=str)


def test_groups_and_empty_table(aligner, spark):
    docs = spark.createDataFrame([(1, "The quick fox")], DOCS)
    assert alignment.alignments(docs, queries.ALIGNED).first().groups == plain(aligner, "The quick fox")[2]
    assert alignment.alignment_table(docs.limit(0), queries.ALIGNED).count() == 0
