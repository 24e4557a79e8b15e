import random
import zlib

import numpy as np

from repotide.llm import quality_classifier as C


def corpus(n=300):
    rng = random.Random(4)
    texts, labels = [], []
    for k in range(n):
        words = ["".join(rng.choice("etaoinshr") for _ in range(rng.randint(1, 8))) for _ in range(rng.randint(20, 200))]
        good = rng.random() < 0.75
        if not good:
            words = [w.upper() + "!!" for w in words] if k % 2 else [w + "###" for w in words]
        texts.append(" ".join(words))
        labels.append(int(good))
    return texts, labels


def test_density_difference_equals_the_definition():
    rng = np.random.default_rng(1)
    moments = {}
    for label in (0, 1):
        x = rng.normal(label, 1 + label, (400, 4)) @ rng.normal(0, 1, (4, 4))
        moments[label] = (300 * (label + 1), x.mean(0), np.cov(x.T, bias=True))
    model, probe = C.Discriminant(moments), rng.normal(0, 2, (20, 4))
    pooled = (300 * moments[0][2] + 600 * moments[1][2]) / 900
    expected = np.full(20, np.log(2.0))
    for label, sign in ((1, 1), (0, -1)):
        s = (1 - C.POOLED) * moments[label][2] + C.POOLED * pooled
        s = (1 - C.DIAGONAL) * s + C.DIAGONAL * np.diag(np.diag(s)) + C.FLOOR**2 * np.eye(4)
        d = probe - moments[label][1]
        expected -= sign * 0.5 * (np.einsum("ij,jk,ik->i", d, np.linalg.inv(s), d) + np.linalg.slogdet(s)[1])
    assert np.allclose(model.log_ratio(probe), expected)


def test_held_out_rows_are_told_apart(spark, documents, clashing, odd):
    texts, labels = corpus()
    rows = [(k, q, 0) for k, q in enumerate(labels)] + [(10_000, 1, 0), (0, None, 1)]
    table = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    out = {r["doc_id"]: r for r in C.scores(clashing(documents(texts + odd)), clashing(table)).collect()}
    assert len(out) == len(texts) + len(odd)
    held = [k for k in range(len(texts)) if zlib.crc32(str(k).encode()) % 3 == 1]
    assert all(out[k]["held_out"] == (zlib.crc32(str(k).encode()) % 3 == 1) for k in out)
    assert np.mean([out[k]["predicted"] == labels[k] for k in held]) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in out.values())


def test_labels_of_held_out_rows_are_not_used(spark, documents):
    texts, labels = corpus(60)
    flipped = [1 - q if zlib.crc32(str(k).encode()) % 3 == 1 else q for k, q in enumerate(labels)]
    found = []
    for own in (labels, flipped):
        table = spark.createDataFrame(list(enumerate(own)), "doc_id long, quality int")
        found.append({r["doc_id"]: r["score"] for r in C.scores(documents(texts, 1), table).collect()})
    assert all(abs(found[0][k] - found[1][k]) < 1e-9 for k in found[0])


def test_nothing_to_learn_from(spark, documents):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["score"] for r in C.scores(documents(["a", None]), none).collect()} == {0.5}
    assert C.scores(documents(["a"]).limit(0), none).count() == 0
