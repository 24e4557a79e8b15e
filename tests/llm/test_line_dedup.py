import hashlib
import random

from repotide.llm import line_dedup as D


def chunks(text):
    lines = text.split("\n")
    h = [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) for x in lines]
    long = [x.count(" ") + 1 >= D.LONG_WORDS for x in lines]
    r = [(x + D.FACTOR * (h[i - 1] if i else 0)) % 2**32 for i, x in enumerate(h)]
    out, now = [], []
    for i, line in enumerate(lines):
        now.append(line)
        cut = 0 < i < len(lines) - 2 and r[i] > r[i - 1] and r[i] >= r[i + 1]
        if cut or long[i] or (i + 1 < len(lines) and long[i + 1]) or i == len(lines) - 1:
            out.append(tuple(now))
            now = []
    return out


def brute(texts):
    seen, out = set(), {}
    for k, text in enumerate(texts):
        if text is None:
            out[k] = (None, 0, 0, 0, 0)
            continue
        all_, kept = chunks(text), []
        for c in all_:
            counts = len(c) > 1 or c[0].count(" ") + 1 >= D.LONG_WORDS
            if not (counts and c in seen):
                kept.append(c)
            if counts:
                seen.add(c)
        lines = [x for c in kept for x in c]
        total = sum(map(len, all_))
        out[k] = ("\n".join(lines), total, len(all_), len(all_) - len(kept), total - len(lines))
    return out


COLUMNS = ("text", "n_lines", "n_chunks", "n_removed_chunks", "n_removed_lines")


def result(df):
    return {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in df.collect()}


def corpus():
    rng = random.Random(2)
    passages = [[f"line {rng.random()}" for _ in range(rng.randint(1, 12))] for _ in range(6)] + [["w " * 80]]
    texts = []
    for _ in range(60):
        lines = [f"own {rng.random()}" for _ in range(rng.randint(0, 9))]
        for p in rng.sample(passages, rng.randint(0, 3)):
            at = rng.randint(0, len(lines))
            lines[at:at] = p
        texts.append("\n".join(lines))
    return texts + texts[:5]


def test_against_brute_force(spark, documents, clashing, odd):
    texts = corpus() + odd
    out = D.deduplicated(clashing(documents(texts, 5)), runs=False)
    assert result(out) == brute(texts)
    assert {"lang", "source", "n_chars", "words"} <= set(out.columns)


def test_inserted_lines_do_not_hide_a_passage(spark, documents):
    passage = [f"shared {k}" for k in range(40)]
    texts = ["\n".join(["a", *passage]), "\n".join(["b", "c", "d", *passage, "e"])]
    rows = result(D.deduplicated(documents(texts), runs=False))
    assert rows[0][4] == 0 and rows[1][4] >= 30


def test_ids_that_are_null_or_shared(spark):
    text = "\n".join(f"line {k}" for k in range(30))
    rows = [(None, text), (3, text), (3, text), (3, "x"), (None, None), (-5, text)]
    out = D.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(out) == 6
    removed = {(r["doc_id"], r["n_lines"]): r["n_removed_lines"] for r in out}
    assert removed[(None, 30)] == 0 and removed[(3, 30)] > 20 and removed[(-5, 30)] > 20


def test_columns_named_like_its_own(spark, documents):
    from pyspark.sql import functions as F

    docs = documents(["a\nb", "a\nb"]).withColumns({c: F.lit("z") for c in ("n_lines", "_lines", "_codes", "_gone", "_text")})
    assert result(D.deduplicated(docs)) == brute(["a\nb", "a\nb"])


def test_empty_table_and_plan(spark, documents):
    df = D.deduplicated(documents(["a"]).limit(0))
    assert df.count() == 0
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def brute_runs(texts):
    """Text and number of removed lines if each later run of LONG_WORDS words goes, besides repeated chunks."""
    first, seen, out = {}, set(), {}
    for k, text in enumerate(texts):
        if text is None:
            out[k] = (None, 0)
            continue
        lines, gone, at = text.split("\n"), set(), 0
        for c in chunks(text):
            if len(c) > 1 or c[0].count(" ") + 1 >= D.LONG_WORDS:
                gone.update(range(at, at + len(c)) if c in seen else ())
                seen.add(c)
            at += len(c)
        for i in range(len(lines)):
            for j in range(i + 1, len(lines) + 1):
                if sum(x.count(" ") + 1 for x in lines[i:j]) < D.LONG_WORDS:
                    continue
                doc, start = first.setdefault(tuple(lines[i:j]), (k, i))
                if (doc, start) != (k, i):
                    gone.update(x for x in range(i, j) if doc != k or x >= start + j - i)
        out[k] = ("\n".join(x for i, x in enumerate(lines) if i not in gone), len(gone))
    return out


def runs_corpus():
    rng = random.Random(5)
    line = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    passages = [[line(rng.randint(3, 40)) for _ in range(rng.randint(2, 8))] for _ in range(8)] + [[line(30), line(30), line(5)], [line(5), line(70)]]
    texts = []
    for _ in range(40):
        lines = [line(rng.randint(1, 12)) for _ in range(rng.randint(0, 6))]
        for p in rng.sample(passages, rng.randint(0, 3)):
            at = rng.randint(0, len(lines))
            lines[at:at] = p[rng.randint(0, 1) :]
        texts.append("\n".join(lines))
    return [*texts, "x\n" * 160, texts[1], None, "", "\n".join(passages[8] * 3)]


def test_every_repeated_run_against_brute_force(spark, documents, odd):
    texts = runs_corpus()
    rows = {r["doc_id"]: (r["text"], r["n_removed_lines"]) for r in D.deduplicated(documents(texts, 5)).collect()}
    assert rows == brute_runs(texts)
    odd_rows = {r["doc_id"]: (r["text"], r["n_removed_lines"]) for r in D.deduplicated(documents(corpus() + odd)).collect()}
    assert odd_rows == brute_runs(corpus() + odd)
    by_chunks = result(D.deduplicated(documents(texts, 5), runs=False))
    assert sum(r[1] for r in rows.values()) > sum(r[4] for r in by_chunks.values())


def test_a_passage_of_few_short_lines(spark, documents):
    passage = [" ".join(f"{a}{k}" for k in range(20)) for a in "abc"]
    texts = ["\n".join(["one", *passage, "two"]), "\n".join(["three", *passage, "four"])]
    assert D.deduplicated(documents(texts)).where("doc_id = 1").first()["text"] == "three\nfour"


def test_runs_of_texts_that_share_an_id(spark):
    passage = "\n".join(" ".join(f"{a}{k}" for k in range(20)) for a in "abc")
    rows = [(3, "one\n" + passage), (3, "two\n" + passage), (None, "x\n" + passage)]
    out = D.deduplicated(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r["text"] for r in out.collect()) == ["one", "two", "x\n" + passage]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
