import hashlib
import random

import numpy as np
import pytest

import corpus_pipeline as P
from repotide.llm import quality_rules
from repotide.llm.common import words_of
from llm.test_line_dedup import brute_runs as line_brute
from llm.test_ngram_join import brute as join_brute

DDL = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n):
    words = ["".join(rng.choice("etaoinshrdlucmf") for _ in range(rng.randint(2, 9))) for _ in range(n)]
    return "\n".join(" ".join(words[k : k + 9]) for k in range(0, n, 9))


def corpus():
    rng = random.Random(11)
    items = [prose(rng, 30) for _ in range(4)]
    texts = [prose(rng, rng.randint(60, 200)) for _ in range(60)]
    texts += [texts[3], texts[3], texts[7].replace("a", "a", 1) + "\nextra words at the end"]
    near = texts[5].split(" ")
    near[len(near) // 2] = "changed"
    texts.append(" ".join(near))
    texts += [prose(rng, 50) + "\n" + items[0], prose(rng, 70) + " " + items[1].replace("\n", " ")]
    texts += ["too short", None, "", " ".join(w + "###" for w in prose(rng, 90).split()), "same words again " * 40]
    return texts, items


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sf"))
    texts, items = corpus()
    rows = [(k, t, "en" if k % 3 else None, f"s{k % 2}", len(t or "")) for k, t in enumerate(texts)]
    spark.createDataFrame(rows, DDL).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def contaminated(text, items):
    windows = {tuple(words_of(t)[k : k + 13]) for t in items for k in range(len(words_of(t)) - 12)}
    words, hit = words_of(text), set()
    for k in range(len(words) - 12):
        if tuple(words[k : k + 13]) in windows:
            hit.update(range(k, k + 13))
    return bool(hit) and 20 * len(hit) >= len(words)


def test_whole_pipeline_against_brute_force(spark, folder, monkeypatch):
    texts, items = corpus()
    judged = {r["doc_id"]: r for r in quality_rules.judged(spark.read.parquet(f"{folder}/documents.parquet")).collect()}
    left = [k for k in range(len(texts)) if judged[k]["kept"]]
    assert len(texts) - len(left) >= 5 and set(range(60)) <= set(left)
    cut = line_brute([texts[k] for k in left])
    left = [(k, cut[n][0]) for n, k in enumerate(left) if cut[n][1] == 0 or cut[n][0].strip()]
    classes = join_brute([t for _, t in left])
    left = [x for n, x in enumerate(left) if classes[n][0] == n]
    left = {k: t for k, t in left if not contaminated(t, items)}
    out = {r["doc_id"]: r for r in P.run(spark, folder).collect()}
    assert set(out) == set(left)
    for k, text in left.items():
        assert out[k]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_stages_keep_the_columns_and_take_odd_rows(spark, folder, odd, clashing):
    rows = [(k, t, None, None, None) for k, t in enumerate(odd)] + [(None, "a b", "x", "y", 1), (0, None, None, None, None)]
    docs = spark.createDataFrame(rows, DDL)
    for start in (clashing(docs), docs.limit(0)):
        now = start
        for name, stage in P.STAGES:
            now = stage(spark, now, folder)
            if name != P.STAGES[-1][0]:
                assert now.columns == list(P.COLUMNS)
            now = spark.createDataFrame(now.collect(), now.schema)
        assert now.count() >= 0


def test_digest_of_ids(spark, folder):
    row = P.run(spark, folder).first()
    assert np.int64(row["n_tokens"]) > 0 and len(row["ids_sha256"]) == 64


def test_rows_that_share_an_id_are_judged_one_by_one(spark, folder):
    """A rejected, copied or contaminated row goes, whatever happens to others with its id."""
    rng = random.Random(3)
    _, items = corpus()
    good = [prose(rng, 120) for _ in range(60)]
    for shared in (7, None):
        rows = [(100 + k, t, "en", "s0", 1) for k, t in enumerate(good)]
        rows += [(shared, prose(rng, 120), "en", "s0", 1), (shared, "one", "en", "s0", 1), (shared, good[4], "en", "s0", 1)]
        rows += [(shared, prose(rng, 60) + " " + items[2].replace("\n", " "), "en", "s0", 1)]
        docs = spark.createDataFrame(rows, DDL)
        texts = lambda df: sorted(r["text"] for r in df.where("doc_id <=> " + ("null" if shared is None else "7")).collect())  # noqa: B023, E731
        mine = [r[1] for r in rows[60:]]
        assert "one" not in texts(P.quality(spark, docs, folder))
        assert texts(P.benchmark(spark, docs, folder)) == sorted(mine[:3])
        left = P.near_duplicates(spark, docs, folder)
        assert left.count() == len(rows) - 1
        # The smallest id stays: 7 is smaller than the copy's, null is not.
        assert texts(left) == sorted(mine if shared == 7 else [mine[0], mine[1], mine[3]])
