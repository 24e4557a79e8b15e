"""Benchmark decontamination by an FM-index for each training shard.

A shard is a run of documents inside one task, of about SHARD_WORDS words. Its words are
numbered, its suffixes sorted (doubling; only suffixes that are still tied are sorted again),
and the Burrows-Wheeler transform is kept as a wavelet matrix with rank directories. All
benchmark windows are searched backward at once, occurrences are located through sampled
suffix positions, and overlapping ones are merged into removal spans.

Nothing is shuffled: a document's hits are known in the task that reads it. A document longer
than a shard is indexed in pieces that overlap by the longest window less one word. The
benchmark is read in blocks of at most BLOCK_BYTES of text; its total size decides how many.

Rows that share a doc_id, or have none, are judged one by one, with one block and with several.
Null and empty texts have no words, no hits and are not contaminated. Equal items all count.
Items without a word are ignored. Other columns of `docs` are not read.
"""

import hashlib
from functools import reduce
from itertools import pairwise

import numpy as np
from pyspark.sql import functions as F

from repotide.llm.common import map_rows, words_of

WINDOW = 13
SHARD_WORDS = 400_000
SAMPLE = 8
BLOCK_BYTES = 2 << 20
SPANS_DDL = "doc_id long, n_words long, spans array<struct<start:long,stop:long>>, items array<string>"


class WaveletMatrix:
    """Ranks of numbers below 2**bits; each level stores its bits and their running count."""

    def __init__(self, values, bits):
        self.bits, self.zeros, self.ones = bits, [], []
        for level in reversed(range(bits)):
            bit = (values >> level) & 1
            running = np.zeros(len(values) + 1, np.int32)
            np.cumsum(bit, out=running[1:])
            self.ones.append(running)
            self.zeros.append(len(values) - int(running[-1]))
            one = bit.astype(bool)
            values = np.concatenate([values[~one], values[one]])

    def rank(self, symbols, at):
        """How often symbols[k] occurs before position at[k]."""
        begin, end = np.zeros_like(at), at.copy()
        for k, level in enumerate(reversed(range(self.bits))):
            ones, one = self.ones[k], ((symbols >> level) & 1).astype(bool)
            b, e = ones[begin], ones[end]
            begin = np.where(one, b + self.zeros[k], begin - b)
            end = np.where(one, e + self.zeros[k], end - e)
        return end - begin

    def access(self, at):
        """The numbers at positions `at`, and how often each occurred before."""
        begin, end, value = np.zeros_like(at), at.copy(), np.zeros_like(at)
        for k in range(self.bits):
            ones = self.ones[k]
            one = ones[end + 1] > ones[end]
            value = (value << 1) | one
            b, e = ones[begin], ones[end]
            begin = np.where(one, b + self.zeros[k], begin - b)
            end = np.where(one, e + self.zeros[k], end - e)
        return value, end - begin


def suffix_array(symbols):
    """Positions of all suffixes in order. The last symbol must occur nowhere else."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    new = np.ones(n, bool)
    new[1:] = symbols[order[1:]] != symbols[order[:-1]]
    first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = first
    tied = ~(new & np.append(new[1:], True))
    h = 1
    while tied.any():
        at = np.flatnonzero(tied)
        suffixes = order[at]
        key = rank[suffixes] * n + rank[np.minimum(suffixes + h, n - 1)]
        by = np.argsort(key)
        key, suffixes = key[by], suffixes[by]
        order[at] = suffixes
        fresh = np.ones(len(at), bool)
        fresh[1:] = key[1:] != key[:-1]
        rank[suffixes] = at[np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))]
        still = ~(fresh & np.append(fresh[1:], True))
        tied[at] = still
        h *= 2
    return order


class FMIndex:
    """Backward search and location over a sequence of numbers that ends with a unique one."""

    def __init__(self, symbols, alphabet):
        n = len(symbols)
        order = suffix_array(symbols)
        self.below = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=alphabet))])
        self.matrix = WaveletMatrix(symbols[order - 1], max(1, int(alphabet - 1).bit_length()))
        sampled = order % SAMPLE == 0
        self.sampled = sampled
        self.sample_rank = np.concatenate([[0], np.cumsum(sampled)])
        self.sample = order[sampled]
        self.n = n

    def search(self, patterns, lengths):
        """Row ranges [begin, end) of the patterns, which stand right-aligned in the matrix."""
        begin = np.zeros(len(patterns), np.int64)
        end = np.full(len(patterns), self.n, np.int64)
        for step in range(1, patterns.shape[1] + 1):
            live = np.flatnonzero((lengths >= step) & (begin < end))
            if not len(live):
                break
            symbol = patterns[live, -step]
            ranks = self.matrix.rank(np.tile(symbol, 2), np.concatenate([begin[live], end[live]]))
            begin[live] = self.below[symbol] + ranks[: len(live)]
            end[live] = self.below[symbol] + ranks[len(live) :]
        return begin, np.maximum(end, begin)

    def locate(self, rows):
        """Positions in the sequence, by walking back to the next sampled suffix."""
        rows, steps = rows.copy(), np.zeros(len(rows), np.int64)
        open_ = np.flatnonzero(~self.sampled[rows])
        while len(open_):
            symbol, before = self.matrix.access(rows[open_])
            rows[open_] = self.below[symbol] + before
            steps[open_] += 1
            open_ = open_[~self.sampled[rows[open_]]]
        return self.sample[self.sample_rank[rows]] + steps


def windows_of(items, window):
    """(distinct windows as word tuples, for each the ids of its items)."""
    found = {}
    for item_id, text in items:
        words = words_of(text)
        size = min(window, len(words))
        for k in range(len(words) - size + 1 if words else 0):
            found.setdefault(tuple(words[k : k + size]), set()).add(item_id)
    return list(found), [tuple(sorted(x)) for x in found.values()]


def shard_hits(documents, windows, lengths):
    """(document number, first word, end, window number) of all occurrences in a shard."""
    number = {}
    parts = []
    for k, words in enumerate(documents):
        parts.append([-1 - k if w is None else number.setdefault(w, len(number)) for w in (*words, None)])
    known = [k for k, w in enumerate(windows) if all(x in number for x in w)]
    if not known:
        return []
    ends = len(documents)  # each document ends with a number of its own, the last one largest
    symbols = np.concatenate([np.array(p, np.int64) for p in parts])
    own = symbols < 0
    symbols = np.where(own, len(number) - 1 - symbols, symbols)
    patterns = np.zeros((len(known), max(lengths[k] for k in known)), np.int64)
    for row, k in enumerate(known):
        patterns[row, -lengths[k] :] = [number[w] for w in windows[k]]
    index = FMIndex(symbols, len(number) + ends)
    begin, end = index.search(patterns, np.array([lengths[k] for k in known]))
    times = end - begin
    which = np.repeat(np.arange(len(known)), times)
    rows = np.repeat(begin, times) + np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times)
    places = index.locate(rows)
    starts = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    document = np.searchsorted(starts, places, side="right") - 1
    return [
        (d, int(p - starts[d]), int(p - starts[d]) + lengths[known[w]], known[w])
        for d, p, w in zip(document.tolist(), places, which.tolist(), strict=True)
    ]


def merged(spans):
    """Disjoint spans in order; overlapping or touching ones become one."""
    out = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return out


def _finder(windows, ids):
    """The mapInArrow function over (doc_id, text): SPANS_DDL rows, shard by shard."""
    lengths = [len(w) for w in windows]
    overlap = max(lengths, default=1) - 1

    def rows_of(batch):
        """Rows of (doc_id, number of words) and pieces (row, first word, words), cut to shards."""
        shard, rows, size = [], [], 0
        for doc_id, text in batch:
            words = words_of(text)
            rows.append((doc_id, len(words)))
            for at in range(0, max(1, len(words) - overlap), SHARD_WORDS):
                piece = words[at : at + SHARD_WORDS + overlap]
                shard.append((len(rows) - 1, at, piece))
                size += len(piece)
                if size >= SHARD_WORDS and at + SHARD_WORDS < len(words) - overlap:
                    yield rows, shard, False
                    shard, size = [], 0
            if size >= SHARD_WORDS:
                yield rows, shard, True
                shard, rows, size = [], [], 0
        yield rows, shard, True

    def run(pairs):
        spans, items = {}, {}
        for rows, shard, whole in rows_of(pairs):
            for piece, start, stop, window in shard_hits([p[2] for p in shard], windows, lengths):
                row, at, _ = shard[piece]
                spans.setdefault(row, set()).add((at + start, at + stop))
                items.setdefault(row, set()).update(ids[window])
            if whole:
                for k, (doc_id, n_words) in enumerate(rows):
                    yield doc_id, n_words, merged(spans.get(k, ())), sorted(items.get(k, ()))
                spans, items = {}, {}

    return run


def _batched(run):
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(SPANS_DDL))

    def batches_of(batches):
        def pairs():
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    part = batch.slice(at, 256)
                    yield from zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True)

        def packed(rows):
            ids, counts, spans, items = zip(*rows, strict=True)
            spans = [[{"start": a, "stop": b} for a, b in x] for x in spans]
            return pa.RecordBatch.from_arrays(
                [pa.array(x, f.type) for x, f in zip((ids, counts, spans, items), arrow, strict=True)], schema=arrow
            )

        rows = []
        for row in run(pairs()):
            rows.append(row)
            if len(rows) == 4096:
                yield packed(rows)
                rows = []
        if rows:
            yield packed(rows)

    return batches_of


def benchmark_blocks(benchmark, block_bytes=BLOCK_BYTES):
    """Lists of (item_id, text) that together are the whole benchmark, each of bounded size."""
    size = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = -(-size // block_bytes) or 1
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
    chosen = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text", part.alias("part"))
    for k in range(count):
        yield [tuple(r) for r in chosen.where(F.col("part") == k).select("item_id", "text").collect()]


def _number():
    """A 64-bit number of a row's id and text; rows that share it are equal."""
    return F.xxhash64("doc_id", "text")


def _joined(spans):
    """Column of `merged` spans, from a sorted array of them."""

    def more(out, x):
        last = F.get(out, F.size(out) - 1)
        longer = F.struct(last["start"].alias("start"), F.greatest(last["stop"], x["stop"]).alias("stop"))
        touching = F.coalesce(x["start"] <= last["stop"], F.lit(False))
        return F.when(touching, F.concat(F.slice(out, 1, F.size(out) - 1), F.array(longer))).otherwise(F.concat(out, F.array(x)))

    return F.aggregate(spans, F.array().cast("array<struct<start:bigint,stop:bigint>>"), more)


def _found(texts, items, window):
    return texts.select("doc_id", "text").mapInArrow(_batched(_finder(*windows_of(items, window))), SPANS_DDL)


def removal_spans(docs, benchmark, window=WINDOW):
    """doc_id, n_words, spans (word numbers, merged), items with an occurring window.

    One row for each row of `docs`, whatever their ids. What several blocks of the benchmark find
    is merged by a number of the row's content, so that rows which share an id, or have none, keep
    to themselves.
    """
    blocks = list(benchmark_blocks(benchmark))
    if len(blocks) == 1:
        return _found(docs, blocks[0], window)
    rows = docs.select("doc_id", "text", _number().alias("_number"))
    texts = rows.select(F.col("_number").alias("doc_id"), "text")
    found = reduce(lambda a, b: a.unionAll(b), [_found(texts, items, window) for items in blocks])
    # Equal rows say the same, so sets hold what one of them says: a list for each block at most.
    spans = found.groupBy(F.col("doc_id").alias("_own")).agg(
        F.max("n_words").alias("n_words"),
        _joined(F.array_sort(F.flatten(F.collect_set("spans")))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    named = rows.select("doc_id", "_number")
    return named.join(spans, F.col("_number") == F.col("_own")).select("doc_id", "n_words", "spans", "items")


def judged(spans):
    """The contamination columns of removal spans."""
    length = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["stop"] - s["start"])
    return spans.select(
        "doc_id",
        "n_words",
        length.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        ((length > 0) & (20 * length >= F.col("n_words"))).alias("contaminated"),
        "spans",
    )


def cut(text, spans):
    """`text` without the words in `spans`; the characters between removed words go too."""
    from repotide.llm.common import WORD, lower_ascii

    places = [m.span() for m in WORD.finditer(lower_ascii(text))]
    keep = [0, *(x for a, b in spans for x in (places[a][0], places[b - 1][1])), len(text)]
    return "".join(text[a:b] for a, b in list(pairwise(keep))[::2])


def digest(items):
    """What items_sha256 holds, for checks."""
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


def with_spans_cut(docs, benchmark, window=WINDOW):
    """doc_id and text of all documents, with removal spans cut out."""

    def make():
        def each(doc_id, text, spans):
            yield doc_id, cut(text, [(s["start"], s["stop"]) for s in spans]) if spans else text

        return each

    rows = docs.select("doc_id", "text", _number().alias("_number"))
    spans = removal_spans(rows.select(F.col("_number").alias("doc_id"), "text"), benchmark, window)
    # Equal rows bring equal spans; one of them is enough for all.
    spans = spans.groupBy(F.col("doc_id").alias("_own")).agg(F.first("spans").alias("spans"))
    joined = rows.join(spans, F.col("_number") == F.col("_own")).select("doc_id", "text", "spans")
    return map_rows(joined, make, "doc_id long, text string")
