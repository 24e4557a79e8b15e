import random

import numpy as np
import pytest

from repotide.llm import decontamination as D
from repotide.llm.common import words_of


def brute(texts, items, window):
    sets = {}
    for item, text in items:
        words = words_of(text)
        size = min(window, len(words))
        for k in range(len(words) - size + 1 if words else 0):
            sets.setdefault(tuple(words[k : k + size]), set()).add(str(item))
    out = {}
    for doc, text in enumerate(texts):
        words, hit, found = words_of(text), set(), set()
        for size in {len(w) for w in sets}:
            for k in range(len(words) - size + 1):
                if ids := sets.get(tuple(words[k : k + size])):
                    hit.update(range(k, k + size))
                    found |= ids
        out[doc] = (len(words), len(hit), len(found), D.digest(found), bool(hit) and 20 * len(hit) >= len(words))
    return out


def result(df):
    return {r[0]: tuple(r[1:]) for r in df.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()}


def test_suffix_array_and_index():
    rng = random.Random(1)
    for _ in range(40):
        n = rng.randint(1, 300)
        symbols = np.array([rng.randint(0, rng.choice([0, 2, 40])) for _ in range(n)] + [41])
        order = D.suffix_array(symbols)
        assert order.tolist() == sorted(range(n + 1), key=lambda i: symbols[i:].tolist())
        index = D.FMIndex(symbols, 42)
        patterns = np.array([[rng.randint(0, 2) for _ in range(3)] for _ in range(8)])
        begin, end = index.search(patterns, np.full(8, 3))
        for p, b, e in zip(patterns.tolist(), begin, end, strict=True):
            places = sorted(index.locate(np.arange(b, e)).tolist())
            assert places == [i for i in range(n) if symbols[i : i + 3].tolist() == p]


@pytest.mark.parametrize("shard", [5, 60, 400_000])
def test_against_brute_force(spark, documents, odd, monkeypatch, shard):
    monkeypatch.setattr(D, "SHARD_WORDS", shard)
    rng = random.Random(shard)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 60))) for _ in range(40)] + odd
    items = [(k, " ".join(rng.choice("ABc") for _ in range(n))) for k, n in enumerate([3, 5, 7, 9, 9, 20, 2, 0])] + [(99, None)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = result(D.judged(D.removal_spans(documents(texts), benchmark, 6)))
    assert got == brute(texts, items, 6)


def test_blocks_of_the_benchmark(spark, documents, monkeypatch):
    texts = ["a b c d e f g", "x y z", None, "a b c"]
    items = [(1, "b c d"), (2, "c d e"), (3, "y z"), (4, "q")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(D, "BLOCK_BYTES", 4)
    monkeypatch.setattr(D, "benchmark_blocks", lambda b, f=D.benchmark_blocks: f(b, 4))
    assert result(D.judged(D.removal_spans(documents(texts), benchmark))) == brute(texts, items, 13)


def test_empty_tables_and_clashing_columns(spark, documents, clashing, odd):
    benchmark = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert result(D.judged(D.removal_spans(documents(["b"]).limit(0), benchmark))) == {}
    full = result(D.judged(D.removal_spans(clashing(documents(odd)), clashing(benchmark))))
    assert full == brute(odd, [(1, "a")], 13)
    none = result(D.judged(D.removal_spans(documents(odd), benchmark.limit(0))))
    assert all(x[1] == 0 and not x[4] for x in none.values()) and len(none) == len(odd)


def test_cut(spark, documents):
    benchmark = spark.createDataFrame([(1, "b C")], "item_id long, text string")
    out = D.with_spans_cut(documents(["A, b -- c! d", "x", None]), benchmark)
    assert sorted(out.collect()) == [(0, "A, ! d"), (1, "x"), (2, None)]


@pytest.mark.parametrize("block", [4, 1 << 20])
def test_rows_with_shared_and_null_ids(spark, block, monkeypatch):
    monkeypatch.setattr(D, "benchmark_blocks", lambda b, f=D.benchmark_blocks: f(b, block))
    rows = [(1, "a b c d e f g"), (1, "clean words"), (None, "x b c d y z"), (None, None), (None, "a b c"), (1, "clean words")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    benchmark = spark.createDataFrame([(1, "b c d"), (2, "c d e"), (3, "y z"), (4, "q")], "item_id long, text string")
    found = D.judged(D.removal_spans(docs, benchmark)).collect()
    got = sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items) for r in found)
    assert got == [("1", 2, 0, 0), ("1", 2, 0, 0), ("1", 7, 4, 2), ("None", 0, 0, 0), ("None", 3, 0, 0), ("None", 6, 5, 2)]
    out = sorted((str(r.doc_id), str(r["text"]).split()) for r in D.with_spans_cut(docs, benchmark).collect())
    assert out == [("1", ["a", "f", "g"]), ("1", ["clean", "words"]), ("1", ["clean", "words"]), ("None", ["None"]), ("None", ["a", "b", "c"]), ("None", ["x"])]
