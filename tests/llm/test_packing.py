import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from repotide.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END]


def padding(lengths):
    return sum(packing.LENGTH - n for n in lengths if n & (n - 1))


def check(rows, texts, tokenizer):
    """Every id in exactly one piece, sequences without gaps, next to no padding."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert by_doc.keys() == texts.keys()
    for key, text in texts.items():
        ids, at = np.array(ids_of(tokenizer, text), "<u4"), 0
        for r in sorted(by_doc[key], key=lambda r: r.start):
            part = ids[r.start : r.start + r.length].tobytes()
            assert (r.start, r.doc_tokens) == (at, len(ids)) and r.length > 0
            assert r.ids_crc32 == zlib.crc32(part)
            at += r.length
        assert at == len(ids)
    lengths = []
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        lengths.append(at)
    assert max(lengths) <= packing.LENGTH and padding(lengths) == 0
    return lengths


def texts_of(docs):
    return {r.doc_id: r.text for r in docs.collect()}


def words(n, seed):
    rng = np.random.default_rng(seed)
    return " ".join(f"word{k}" for k in rng.integers(0, 500, n))


def test_every_id_in_one_piece(documents, odd, tokenizer):
    texts = [*odd, *odd, *[words(n, n) for n in range(1, 1500, 9)], words(9000, 1), "İstanbul Σς ﬁ <|endoftext|>x <|startoftext|>"]
    docs = documents(texts)
    check(packing.pieces(docs, PATH).collect(), texts_of(docs), tokenizer)


@pytest.mark.parametrize("size", [1, 300, 682, 1024, 1400, 2046, 2047, 2048, 5000])
def test_copies_of_one_length(documents, tokenizer, size):
    docs = documents(["a " * size] * 150, partitions=1)
    lengths = check(packing.pieces(docs, PATH).collect(), texts_of(docs), tokenizer)
    total = 150 * (size + 1)
    assert sum(n == packing.LENGTH for n in lengths) >= total // packing.LENGTH


def test_words_cut_at_white_space_give_the_ids_of_the_text(tokenizer):
    texts = ["é e ́x", "a b c\x85d\x1ce", "it's  IT'S 12 3½ ²", "x\r\ny\x0bz\x0c", "日本 語。 ﷺ", "'s 'S's", "ᄀ ᅡ 가", "a" * 300]
    own = packing.Vocabulary(open(PATH, encoding="utf-8").read())
    for _ in range(2):
        for text, data in zip(texts, own.ids([t.encode() for t in texts]), strict=True):
            assert np.frombuffer(data, "<u4").tolist() == ids_of(tokenizer, text)
    assert all(len(w) <= packing.WORD_BYTES for w in own.known)


@pytest.fixture(scope="module")
def own():
    return packing.Vocabulary(open(PATH, encoding="utf-8").read())


@settings(max_examples=300, deadline=None)
@given(text=st.text(st.one_of(st.characters(max_codepoint=0x2FF, exclude_categories=("Cs",)), st.sampled_from("aeE .,!?'é́ß")), max_size=30))
def test_words_of_any_kind(text, own, tokenizer):
    assert np.frombuffer(own.ids([text.encode()])[0], "<u4").tolist() == ids_of(tokenizer, text)


def test_white_space_of_every_kind_is_none_to_the_vocabulary(tokenizer):
    """The claim the cutting rests on: an id never spans one of the six characters."""
    for c in "\x20\x09\x0a\x0b\x0c\x0d":
        assert ids_of(tokenizer, f"foo{c}bar")[:-1] == ids_of(tokenizer, "foo")[:-1] + ids_of(tokenizer, "bar")[:-1]


def test_ids_of_the_sequences(documents, tokenizer):
    docs = documents([words(n, n) for n in (5, 3000, 70, 800)], partitions=1)
    rows = packing.pieces(docs, PATH, with_ids=True)
    made = {r.sequence_id: np.frombuffer(r.ids, "<u4").tolist() for r in packing.sequences(rows).collect()}
    for r in rows.collect():
        assert made[r.sequence_id][r.offset : r.offset + r.length] == np.frombuffer(r.ids, "<u4").tolist()
    every = sorted(i for t in texts_of(docs).values() for i in ids_of(tokenizer, t))
    assert sorted(i for ids in made.values() for i in ids) == every


def test_null_and_repeated_ids_clashing_names_and_no_rows(documents, clashing):
    docs = documents([words(40, 1), words(40, 1), None, "x"])
    same = clashing(docs.drop("n_chars")).withColumns({"start": F.lit(1), "length": F.lit("z"), "offset": F.lit(0)})
    columns = ("doc_id", "start", "length", "ids_crc32", "doc_tokens")
    assert sorted(packing.pieces(same, PATH).select(*columns).collect()) == sorted(packing.pieces(docs, PATH).select(*columns).collect())
    nameless = docs.withColumn("doc_id", F.when(F.col("doc_id") > 1, 7))
    rows = packing.pieces(nameless, PATH)
    assert rows.agg(F.sum("length")).first()[0] == packing.pieces(docs, PATH).agg(F.sum("length")).first()[0]
    assert rows.where("doc_id is null").count() >= 2
    empty = packing.pieces(docs.limit(0), PATH)
    assert empty.count() == 0 and empty.columns == rows.columns


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 2047), min_size=1, max_size=60), st.integers(1, 12))
def test_differencing_keeps_every_item(sizes, k):
    windows = packing.differenced(sizes, k)
    assert len(windows) <= k
    assert sorted(n for _, members in windows for n in members) == list(range(len(sizes)))
    assert all(total == sum(sizes[n] for n in members) for total, members in windows)


def test_differencing_balances_opposing_imbalances():
    """The textbook example, and far better than dealing in turn on random sizes."""
    assert sorted(total for total, _ in packing.differenced([8, 7, 6, 5, 4], 2)) == [14, 16]
    rng = np.random.default_rng(0)
    sizes = rng.integers(1, 700, 400).tolist()
    totals = [total for total, _ in packing.differenced(sizes, 20)]
    dealt = [sum(sizes[n::20]) for n in range(20)]
    assert max(totals) - min(totals) < 0.05 * (max(dealt) - min(dealt))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 2047), min_size=1, max_size=80))
def test_the_number_of_windows_rises_with_what_they_hold(sizes):
    windows = packing.packed([[(n, 0, size)] for n, size in enumerate(sizes)])
    assert len(windows) == -(-sum(sizes) // packing.LENGTH)
    covered = defaultdict(list)
    for pieces in windows:
        assert sum(p[2] for p in pieces) <= packing.LENGTH
        for n, start, length in pieces:
            covered[n].append((start, length))
    for n, size in enumerate(sizes):
        at = 0
        for start, length in sorted(covered[n]):
            assert start == at and length > 0
            at += length
        assert at == size
