import re
from collections import Counter, defaultdict
from itertools import permutations

import pytest

from repotide.llm import filter_audit

LABELS = "doc_id long, quality int, toxic int"


def fails(text, doc_id, by_text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    smaller = doc_id is not None and any(x is not None and x < doc_id for x in by_text[text])
    return {
        "A": len(words) < 200,
        "B": 100 * len(set(words)) < 50 * len(words),
        "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
        "D": bool(re.search(r"[#$%&*|]", text)),
        "E": smaller,
    }


def brute(docs, labels):
    """The contract, document by document and order by order."""
    good = {r.doc_id for r in labels if r.quality == 1 and r.doc_id is not None}
    toxic = {r.doc_id for r in labels if r.toxic == 1 and r.doc_id is not None}
    by_text = defaultdict(list)
    for r in docs:
        by_text[r.text or ""].append(r.doc_id)
    out, removed = defaultdict(Counter), Counter()
    for r in docs:
        failed, part = fails(r.text or "", r.doc_id, by_text), r.source or ""
        for order in permutations("ABCDE"):
            gone = False
            for step, letter in enumerate(order, 1):
                row = out[part, "".join(order), step]
                here = failed[letter] and not gone
                row["removed"] += here
                row["redundant"] += failed[letter] and gone
                row["unique_fails"] += failed[letter] and sum(failed.values()) == 1
                row["good_lost"] += here and r.doc_id in good
                row["toxic_lost"] += here and r.doc_id in toxic
                gone = gone or failed[letter]
                row["kept"] += not gone
                removed[part, letter] += here
    return {
        (*key, *(int(row[c]) for c in filter_audit.COUNTS), removed[key[0], key[1][key[2] - 1]])
        for key, row in out.items()
    }


def table(df):
    columns = ("part", "filter_order", "step", *filter_audit.COUNTS, "shapley")
    rows = [tuple(r) for r in df.select(*columns).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


LONG = " ".join(f"w{k}" for k in range(250))
TEXTS = [
    (LONG, "en", "a"), (LONG, "en", "a"), (LONG, "en", "b"), (LONG + " #", "en", "a"), ("w " * 300, "en", "a"),
    (LONG.upper(), "en", "b"), (LONG.upper(), "en", None), ("é" * 40 + " A\x0bB\x1cC", "en", ""), ("A\xa0B", "en", "b"),
    ("C" * 2 + "x" * 98, "en", "b"), ("C" * 3 + "x" * 98, "en", "b"), (" ".join(f"w{k % 125}" for k in range(250)), "en", "c"),
    (" ".join(f"w{k % 124}" for k in range(250)), "en", "c"), ("𝒳" * 50 + "Z", "en", "c"), (LONG[:-4], "fr", "c"),
]


@pytest.fixture
def labels(spark):
    return spark.createDataFrame(
        [(0, 1, 0), (0, 1, 0), (1, 0, 1), (2, 1, 1), (4, 1, None), (5, None, 1), (6, 1, 0), (None, 1, 1), (99, 1, 1)], LABELS
    )


def test_equals_walking_every_order(documents, labels, odd):
    docs = documents([*TEXTS, *odd, *odd])
    assert table(filter_audit.audit(docs, labels)) == brute(docs.collect(), labels.collect())


def test_null_and_repeated_ids(spark, documents, labels):
    docs = documents([*TEXTS, *TEXTS])
    from pyspark.sql import functions as F

    renamed = F.when(F.col("doc_id") % 4 == 3, None).when(F.col("doc_id") > 20, 0).otherwise(F.col("doc_id"))
    docs = docs.withColumn("doc_id", renamed)
    found = table(filter_audit.audit(docs, labels))
    assert found == brute(docs.collect(), labels.collect())
    assert sum(r[3] + r[4] for r in found if r[1] == "ABCDE" and r[2] == 1) == docs.count()


def test_extra_columns_and_no_labels(spark, documents, labels, clashing):
    docs = documents(TEXTS)
    found = table(filter_audit.audit(clashing(docs).withColumnsRenamed({"key": "mask", "node": "good"}), clashing(labels)))
    assert found == table(filter_audit.audit(docs, labels))
    bare = table(filter_audit.audit(docs, labels.limit(0)))
    assert {r[7:9] for r in bare} == {(0, 0)} and {r[:7] for r in bare} == {r[:7] for r in found}


def test_no_documents_give_no_rows(documents, labels):
    assert filter_audit.audit(documents(TEXTS).limit(0), labels).count() == 0


def test_a_third_of_all_rows_may_be_copies(documents, labels):
    docs = documents([(LONG if k % 3 else f"{k}", "en", f"s{k % 7}") for k in range(300)])
    assert table(filter_audit.audit(docs, labels)) == brute(docs.collect(), labels.collect())
