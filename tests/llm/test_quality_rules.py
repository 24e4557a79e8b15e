import random
import re
from collections import Counter

import numpy as np
import pytest

from repotide.llm import quality_rules as Q


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
    inside = {k + i for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for i in range(3)}
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        sum(x in lines[:k] for k, x in enumerate(lines)),
        len(inside),
        len(words) < 50 or 100 * len(inside) > 50 * len(words),
    )


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    prose = lambda n: " ".join(
        "".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(1, 9))) + "\n" * (rng.random() < 0.08) for _ in range(n)
    )
    clean = [(prose(rng.randint(60, 400)), rng.choice(["en", "de"]), "hot" if rng.random() < 0.5 else f"s{rng.randint(0, 9)}") for _ in range(600)]
    junk = [(" ".join(w + rng.choice("#$%&") * 3 for w in prose(150).split()), "en", "hot") for _ in range(30)]
    return clean, junk


def test_base_columns(spark, documents, clashing, odd, corpus):
    texts = [*odd, *(x[0] for x in corpus[0][:40]), "a b c\na b c\n \na b c", "a a a a", "a a a"]
    out = Q.judged(clashing(documents(texts))).collect()
    assert {r["doc_id"]: tuple(r[c] for c in BASE) for r in out} == {k: brute(t) for k, t in enumerate(texts)}
    assert not any(r["kept"] and r["base_failed"] for r in out)


def test_outliers_are_rejected_and_clean_rows_kept(spark, documents, corpus):
    clean, junk = corpus
    rows = Q.judged(documents(clean + junk), min_rows=40).collect()
    kept = {r["doc_id"]: r["kept"] for r in rows}
    assert all(kept[k] for k in range(len(clean)))
    assert not any(kept[len(clean) + k] for k in range(len(junk)))


def test_null_groups_and_empty_table(spark, documents, corpus):
    nulls = [(text, None, None) for text, _, _ in corpus[0][:80]]
    rows = Q.judged(documents(nulls), min_rows=40).collect()
    assert len(rows) == 80 and all(r["kept"] for r in rows)
    assert Q.judged(documents(nulls).limit(0)).count() == 0


def test_estimate_withstands_a_third_of_outliers(spark):
    rng = np.random.default_rng(0)
    good, bad = rng.normal(0, 1, (600, Q.DIMENSIONS)), rng.normal(12, 0.5, (300, Q.DIMENSIONS))
    rows = [(0, "x", None, v) for v in np.vstack([good, bad]).tolist()]
    df = spark.createDataFrame(rows, "level int, lang string, source string, features array<double>")
    fit = Q.covariance_determinant(df).first()
    assert np.abs(fit["mean"]).max() < 0.5
    white = np.array(fit["white"]).reshape(Q.DIMENSIONS, -1)
    distance = np.square((bad - fit["mean"]) @ white.T).sum(1)
    assert distance.min() > 100 > np.square((good - fit["mean"]) @ white.T).sum(1).max()
