import random

from repotide.llm import licenses as L
from repotide.llm.common import words_of


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute_base(text):
    words = words_of(text)
    found = []
    for phrase, label in L.PHRASES:
        p = phrase.split()
        found += [(k, label) for k in range(len(words)) if words[k : k + len(p)] == p]
    at = [k for k, _ in found]
    return len(words), len(found), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in found}))


TEXTS = [
    "Released Under THE MIT-license. under the mit license under the mit license!",
    "Licensed under the Apache License, Version 2.0.\nLicensed under CC BY-NC 4.0.",
    "This work is licensed under the GNU Genera1 Public Licence, version 3.",
    "cc by nc by nc cc by ncx", "under the mit licenses", "xunder the mit license", "the mit license under the",
]


def test_base_columns(spark, documents, clashing, odd):
    texts = TEXTS + odd
    out = L.license_labels(clashing(documents(texts))).collect()
    got = {r["doc_id"]: (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in out}
    assert got == {k: brute_base(t) for k, t in enumerate(texts)}
    labels = {r["doc_id"]: r["labels"] for r in out}
    assert labels[2] == "gpl-3" and labels[0] == "mit" and labels[1] == "apache-2,cc-by-nc" and labels[len(TEXTS)] == ""


def test_notices_with_errors_are_found():
    rng, scan = random.Random(5), L.scanner()
    for notice, label in L.NOTICES:
        for _ in range(20):
            chars = list(notice)
            for _ in range(L.edits_of(notice)):
                at = rng.randrange(1, len(chars) - 1)
                chars[at : at + 1] = rng.choice([[], ["q"], [chars[at], "q"]])
            text = "zz yy " + "".join(chars) + " ww " + "xx " * rng.randint(0, 5)
            spans = [s for s in scan(text) if s[0] == label]
            assert spans, (notice, text)
            for _, a, b, e in spans:
                assert any(distance(n, text[a:b]) <= e for n, x in L.NOTICES if x == label)


def test_unlike_texts_have_no_labels(spark, documents):
    assert {r["labels"] for r in L.license_labels(documents(["under the sun " * 200, "license version of the mit " * 50])).collect()} == {""}
    assert L.license_labels(documents(["a"]).limit(0)).count() == 0


def test_long_texts_of_near_notices_take_linear_time():
    scan = L.scanner()
    assert len(scan("all rights reserve " * 20_000)) == 20_000
    assert scan("released under the " * 20_000) == []
