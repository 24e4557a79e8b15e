import hashlib
import random

import pytest

from repotide.llm import warc as W

PAGES = "page_id long, url string, html string"


def made(n, seed=0):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        body = bytes(rng.randrange(256) for _ in range(rng.randint(0, 300)))
        out.append((k, W.record(k, f"http://x/{k}", body, len(body), hashlib.sha1(body).hexdigest(), None)))
    return out


@pytest.mark.parametrize("pack", [W.packed, bytes])
def test_later_records_are_recovered(pack):
    rng = random.Random(4)
    for seed in range(30):
        parts = [pack(x) for _, x in made(12, seed)]
        bad = sorted(rng.sample(range(12), 3))
        for k in bad:
            damage = rng.choice(["flip", "cut", "junk"])
            part = bytearray(parts[k])
            at = rng.randrange(12, len(part))
            if damage == "flip":
                part[at] ^= 0x55
            elif damage == "cut":
                del part[at:]
            else:
                part[0:0] = b"junk\x1f\x8b\x08junk\r\nWARC/1.0\r\n"
            parts[k] = bytes(part)
        found = list(W.salvage(b"".join(parts)))
        assert sum(x[1] for x in found) == len(b"".join(parts))
        assert [x[0] for x in found] == [sum(y[1] for y in found[:k]) for k in range(len(found))]
        got = {x[3][0] for x in found if x[3]}
        assert got >= set(range(12)) - set(bad)
        assert pack is bytes or any(x[2] for x in found)  # a flipped letter of a plain address shows nowhere


def test_large_member_and_empty_archive(monkeypatch):
    assert list(W.salvage(b"")) == []
    body = b"a" * (17 << 20)
    data = W.packed(W.record(1, None, body, len(body), hashlib.sha1(body).hexdigest(), None))
    assert data[-1] == 0
    both = data + W.packed(made(1)[0][1])
    assert [x[2] for x in W.salvage(both)] == [None, None]


def brute(rows):
    out = []
    for page_id, _, html in rows:
        body = (html or "").encode()
        head = max((r[0] for r in rows if (r[2] or "").encode() == body and r[0] is not None), default=None)
        revisit = len(body) >= 1000 and head is not None and page_id != head
        out.append((page_id, len(body), hashlib.sha1(body).hexdigest(), "revisit" if revisit else "response", head if revisit else None))
    return sorted(out, key=repr)


def test_round_trip(spark, clashing, monkeypatch):
    monkeypatch.setattr(W, "RECORDS_PER_FILE", 3)
    long = "é\r\n\r\nWARC/1.0\r\n" * 300
    rows = [(k, f"http://a/{k}\r\nx", long) for k in range(7)] + [(6, None, long), (None, "u", long), (None, None, None)]
    rows += [(50, "u", None), (51, "u", ""), (52, "u", "short"), (53, "u", "short"), (54, None, "\0 x" * 999)]
    found = W.round_trip(clashing(spark.createDataFrame(rows, PAGES)))
    assert W.gaps(found).count() == 0
    assert sorted((tuple(r) for r in W.records(found).collect()), key=repr) == brute(rows)
    payloads = {r["page_id"]: bytes(r["payload"]) for r in found.where("record_type = 'response' and page_id >= 50").collect()}
    assert payloads[54] == ("\0 x" * 999).encode() and payloads[50] == b""


def test_empty_table(spark):
    empty = spark.createDataFrame([], PAGES)
    assert W.records(W.round_trip(empty)).collect() == []


def test_damaged_files_on_disk(spark, tmp_path):
    from pathlib import Path

    path = f"{tmp_path}/a"
    rows = [(k, "u", f"page {k} " * 50) for k in range(20)]
    W.write_archives(spark.createDataFrame(rows, PAGES).coalesce(1), path)
    file = next(Path(path).glob("part-*"))
    data = bytearray(file.read_bytes())
    data[len(data) // 2] ^= 0xFF
    file.write_bytes(bytes(data))
    for crc in Path(path).glob(".*.crc"):
        crc.unlink()
    found = W.read_archives(spark, path)
    assert W.records(found).count() == 19
    assert W.gaps(found).count() == 1
