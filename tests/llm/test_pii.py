import hashlib
import random
import re

import pytest

from repotide.llm import pii as P


def brute(text):
    """The base rules, as plainly as they are stated."""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m.group() if c.isdigit()]
        check = sum(sum(divmod(d * 2, 10)) if k % 2 else d for k, d in enumerate(reversed(digits)))
        if 13 <= len(digits) <= 19 and check % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append(("phone", *m.span()))
    return out


def test_base_spans_of_random_texts():
    rng = random.Random(2)
    parts = ["a", "Z", "_", "@", "@", ".", ".", "-", "+", "+1", " ", "1", "23", "255", "256", "0007", "4111111111111111", "(", "é", "a@b.c", "4111-1111 1111-1111", "1.2.3.4"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))
        assert P.base_spans(text) == brute(text), text


def people(n=300):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghilmnorstu") for _ in range(rng.randint(2, 8)))
    number = lambda k: "".join(str(rng.randint(0, 9)) for _ in range(k))
    out = []
    for _ in range(n):
        own = rng.choice([f"{word()}.{number(2)}@mail{number(1)}.example.com", f"{rng.randint(1, 255)}.{number(2)}.7.{number(1)}", f"+1 ({number(3)}) 555-{number(4)}", f"password={number(12)}x", word()])
        out.append(" ".join([*(word() for _ in range(rng.randint(0, 30))), own, *(word() for _ in range(rng.randint(0, 30)))]))
    return out


@pytest.fixture(scope="module")
def tagger(spark):
    rows = list(enumerate(people(1500)))
    return P.train(spark.createDataFrame(rows, "doc_id long, text string"), epochs=14)


def test_tagger_finds_spans_without_the_patterns(tagger):
    held = people(1800)[1500:]
    found = [P.tagged_spans([t], tagger)[0] for t in held]
    expected = [P.base_spans(t) for t in held]
    hits = sum(len(set(a) & set(b)) for a, b in zip(found, expected, strict=True))
    assert hits >= 0.8 * sum(map(len, expected))
    assert sum(map(len, found)) <= 1.05 * sum(map(len, expected))


def test_windows_agree_wherever_a_text_is_cut(tagger):
    span = "ab.12@mail3.example.com"
    for shift in range(0, 100, 7):
        text = "word " * 20 + "x" * shift + " " + span + " word" * 20
        assert [text[a:b] for _, a, b in P.tagged_spans([text], tagger)[0]] in ([span], [])


def test_all_spans_keep_the_base():
    base = [("email", 5, 9), ("card", 20, 36)]
    assert P.all_spans(base, [("phone", 30, 40), ("phone", 40, 50), ("ip", 0, 5)]) == [
        ("email", 5, 9), ("ip", 0, 5), ("card", 20, 36), ("phone", 40, 50)
    ]


def test_free_spans_equal_the_plain_rule():
    rng = random.Random(1)
    span = lambda: (rng.choice(P.KINDS), a := rng.randint(0, 60), a + rng.randint(1, 9))
    for _ in range(300):
        base, tagged = [span() for _ in range(rng.randint(0, 6))], [span() for _ in range(rng.randint(0, 6))]
        free = [s for s in tagged if not any(s[1] < b and a < s[2] for _, a, b in base)]
        assert set(P.all_spans(base, tagged)) == {*base, *free}


def test_documents(spark, documents, clashing, odd, tagger):
    texts = people(40) + odd
    rows = {r["doc_id"]: r for r in P.detected(clashing(documents(texts)), tagger).collect()}
    assert len(rows) == len(texts)
    for k, text in enumerate(texts):
        base = brute(text or "")
        r = rows[k]
        assert [r[f"n_{x}"] for x in P.KINDS] == [sum(s[0] == x for s in base) for x in P.KINDS]
        assert r["base_sha256"] == hashlib.sha256(P.joined(base).encode()).hexdigest()
        assert set(P.joined(base).split(",")) - {""} <= set(r["spans"].split(","))


def test_nothing_to_train_on(spark, documents):
    out = P.detected(documents(["no data here", None, ""])).collect()
    assert [r["spans"] for r in out] == ["", "", ""]
    assert P.detected(documents(["a"]).limit(0)).count() == 0
