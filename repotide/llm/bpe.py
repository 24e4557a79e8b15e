"""Byte-level BPE: encoding by a rank file, and exact decoding.

Texts are cut into pieces without a regular expression. Each code point of a slice of texts
becomes a small symbol (its class, and for white space and apostrophes what follows); each
symbol is a function from scanner state to scanner state. Composition of such functions is
associative, so blocks of the text are composed side by side, the states at block borders are
chained, and all states inside the blocks follow at once. A piece starts wherever the table of
(state, symbol) says so. Pieces found in a cache are done; all new pieces of a slice are merged
together, one round of lowest-rank merges at a time, in arrays.

Null and empty texts have no ids. The rank file is read on the driver and sent to the tasks;
its size is a property of the vocabulary. Every row gives one row.
"""

import base64
import hashlib

import numpy as np

from repotide.llm.common import SLICE

#: Pieces kept per task; when full, the cache starts again (results do not depend on it).
CACHED = 300_000
#: Characters scanned at once, and characters in a block of the scan.
SCAN_CHARS, BLOCK = 1 << 20, 1024

L, N, O, S, W, S_LAST, W_LAST, A1, A2, START = range(10)  # noqa: E741
IN_L, IN_N, IN_O, IN_W, SPACE, LEFT1, LEFT2, FRESH = range(8)
# The contractions of the pattern, without the apostrophe.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


def transitions():
    """(next state, whether a piece starts) for each state and symbol.

    S and W are white space inside a run, S_LAST and W_LAST the last one before something
    else; A1 and A2 apostrophes that begin a contraction of one or two letters if a piece
    starts there; START a text's first character is preceded by it.
    """
    to = np.zeros((8, 10), np.uint8)
    starts = np.zeros((8, 10), bool)
    for state in range(8):
        for symbol, inside in ((L, IN_L), (N, IN_N), (O, IN_O)):
            to[state, symbol] = inside
            starts[state, symbol] = state not in (inside, SPACE)
        for symbol in (S, W):
            to[state, symbol] = IN_W
            starts[state, symbol] = state != IN_W
        # The last character of a run stands alone; a plain space goes to the next piece.
        to[state, S_LAST], starts[state, S_LAST] = SPACE, True
        to[state, W_LAST], starts[state, W_LAST] = FRESH, True
        for symbol, left in ((A1, LEFT1), (A2, LEFT2)):
            run_on = state in (IN_O, SPACE)
            to[state, symbol] = IN_O if run_on else left
            starts[state, symbol] = not run_on
        to[state, START], starts[state, START] = FRESH, True
    # Letters of a contraction belong to it, whatever comes next starts anew.
    to[LEFT1, L], starts[LEFT1, L] = FRESH, False
    to[LEFT2, L], starts[LEFT2, L] = LEFT1, False
    return to, starts


def class_table():
    """Class of each code point, from the Unicode properties the pattern names."""
    import regex

    table = np.full(0x110000, O, np.uint8)
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    whole = "".join(every)
    for name, kind in ((r"\p{L}", L), (r"\p{N}", N), (r"\s", W)):
        table[[ord(c) for c in regex.findall(name, whole)]] = kind
    table[32] = S
    return table


def symbols_of(points, first, classes):
    """Symbol of each code point; `first` are the places where texts begin."""
    kind = classes[points]
    follows = np.append(kind[1:], W)
    ends = np.zeros(len(kind), bool)
    ends[first[1:] - 1] = True
    ends[-1:] = True
    white = (kind == S) | (kind == W)
    next_white = (follows == S) | (follows == W) | ends
    symbols = np.where(white & ~next_white, np.where(kind == S, S_LAST, W_LAST), kind)
    at = np.flatnonzero(points == 39)
    if len(at):
        stop = np.searchsorted(first, at, side="right")
        limit = np.append(first[1:], len(points))[stop - 1]
        padded = np.append(points, [0, 0])
        one, two = padded[at + 1], padded[at + 2]
        short = np.isin(one, [ord(c) for c in CONTRACTIONS if len(c) == 1]) & (at + 1 < limit)
        long = np.zeros(len(at), bool)
        for c in CONTRACTIONS:
            if len(c) == 2:
                long |= (one == ord(c[0])) & (two == ord(c[1])) & (at + 2 < limit)
        symbols[at] = np.where(short, A1, np.where(long, A2, O))
    return symbols


def scan(symbols, first, to, starts):
    """Whether a piece starts at each place, by composing transition functions block by block."""
    n = len(symbols)
    rows = -(-n // BLOCK)
    grid = np.full(rows * BLOCK, W, np.uint8)
    grid[:n] = symbols
    grid = grid.reshape(rows, BLOCK)
    begins = np.zeros(rows * BLOCK, bool)
    begins[first] = True
    begins = begins.reshape(rows, BLOCK)
    across = np.tile(np.arange(8, dtype=np.uint8), (rows, 1))
    for k in range(BLOCK):  # composition of the functions of each block, all blocks at once
        across[begins[:, k]] = FRESH
        across = to[across, grid[:, k, None]]
    state, entry = FRESH, np.empty(rows, np.uint8)
    for row in range(rows):
        entry[row] = state
        state = across[row, state]
    out = np.empty((rows, BLOCK), bool)
    state = entry
    for k in range(BLOCK):
        state = np.where(begins[:, k], FRESH, state)
        out[:, k] = starts[state, grid[:, k]]
        state = to[state, grid[:, k]]
    out = out.ravel()[:n]
    out[first] = True
    return out


def pieces_of(texts, classes, to, starts):
    """For each text the character places where its pieces start."""
    found = [np.zeros(0, np.int64)] * len(texts)
    group, size = [], 0

    def flush():
        whole = "".join(texts[k] for k in group)
        points = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
        lengths = np.array([len(texts[k]) for k in group])
        first = np.cumsum(lengths) - lengths
        at = np.flatnonzero(scan(symbols_of(points, first, classes), first, to, starts))
        cuts = np.searchsorted(at, np.append(first, len(points)))
        for k, a, b, base in zip(group, cuts, cuts[1:], first, strict=False):
            found[k] = at[a:b] - base

    for k, text in enumerate(texts):
        if not text:
            continue
        group.append(k)
        size += len(text)
        if size >= SCAN_CHARS:
            flush()
            group, size = [], 0
    if group:
        flush()
    return found


class Merges:
    """Ranks of pairs of ids in sorted arrays, and rounds of merges over many pieces at once."""

    def __init__(self, ranks):
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                a, b = ranks.get(token[:k]), ranks.get(token[k:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = rank
        self.keys = np.array(sorted(pairs), np.int64)
        self.rank = np.array([pairs[k] for k in self.keys.tolist()], np.int64)

    def ranks_of(self, ids, piece):
        """Rank of each neighbouring pair inside a piece; a large number if there is none."""
        key = ids[:-1] << 32 | ids[1:]
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (piece[1:] == piece[:-1]), self.rank[at], 1 << 40)

    def __call__(self, pieces):
        """Lists of ids of byte strings."""
        data = np.frombuffer(b"".join(pieces), np.uint8)
        piece = np.repeat(np.arange(len(pieces)), [len(p) for p in pieces])
        ids = self.single[data]
        out = [None] * len(pieces)

        def finish(ids, piece):
            if len(ids):
                cuts = np.flatnonzero(np.diff(piece)) + 1
                for p, x in zip(piece[np.append(0, cuts)].tolist(), np.split(ids, cuts), strict=True):
                    out[p] = tuple(x.tolist())

        while len(ids):
            if len(ids) == 1:
                finish(ids, piece)
                break
            rank = np.append(self.ranks_of(ids, piece), 1 << 40)
            border = np.flatnonzero(np.append(True, piece[1:] != piece[:-1]))
            least = np.minimum.reduceat(rank, border)
            sizes = np.diff(np.append(border, len(ids)))
            low = np.repeat(least, sizes)
            done = low == 1 << 40
            finish(ids[done], piece[done])
            # Merge every lowest-ranked pair, from the left; of overlapping ones each second.
            pick = (rank == low) & ~done
            touching = np.flatnonzero(pick[1:] & pick[:-1]) + 1
            if len(touching):
                run = np.cumsum(np.append(True, np.diff(touching) > 1))
                head = touching[np.flatnonzero(np.append(True, np.diff(touching) > 1))]
                odd = (touching - head[run - 1]) % 2 == 0
                pick[touching[odd]] = False
            at = np.flatnonzero(pick)
            ids = ids.copy()
            ids[at] = rank[at]
            keep = ~done
            keep[at + 1] = False
            ids, piece = ids[keep], piece[keep]
        return out


class Encoder:
    """Ids and character offsets of texts, with a cache of pieces."""

    def __init__(self, ranks, classes):
        self.merges, self.classes, self.cache = Merges(ranks), classes, {}
        self.to, self.starts = transitions()
        self.ranks, self.token = ranks, {rank: token for token, rank in ranks.items()}

    def __call__(self, texts):
        """For each text (ids, first character of each piece, number of ids of each piece)."""
        texts = [t or "" for t in texts]
        places = pieces_of(texts, self.classes, self.to, self.starts)
        cut = []
        for text, at in zip(texts, places, strict=True):
            at = at.tolist()
            cut.append([text[a:b] for a, b in zip(at, [*at[1:], len(text)], strict=False)])
        if len(self.cache) > CACHED:
            self.cache = {}
        new = {p: p.encode() for p in {p for pieces in cut for p in pieces} - self.cache.keys()}
        whole = {p: (self.ranks[b],) for p, b in new.items() if b in self.ranks}
        self.cache.update(whole)
        new = [p for p in new if p not in whole]
        if new:
            self.cache.update(zip(new, self.merges([p.encode() for p in new]), strict=True))
        out = []
        for pieces, at in zip(cut, places, strict=True):
            ids, counts = [], []
            for x in map(self.cache.__getitem__, pieces):
                ids += x
                counts.append(len(x))
            out.append((ids, at, counts))
        return out

    def decode(self, ids):
        return b"".join(map(self.token.__getitem__, ids))


def ranks_of(spark, path):
    """{token bytes: rank} of a rank file; a path with a scheme is read by Spark."""
    if "://" in path:
        lines = [r[0].encode() for r in spark.read.text(path).collect()]
    else:
        with open(path, "rb") as file:
            lines = file.read().splitlines()
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(None, lines))}


def _over_texts(docs, path, make_columns, ddl, keep):
    """mapInArrow over (kept columns, text), a slice of texts at a time."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL(ddl)
    arrow = to_arrow_schema(schema)
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((ranks_of(spark, path), class_table()))

    def run(batches):
        encoder = Encoder(*shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                columns = make_columns(encoder, part.column("text").to_pylist())
                kept = [part.column(k) for k in keep]
                made = [pa.array(c, f.type) for c, f in zip(columns, list(arrow)[len(keep) :], strict=True)]
                arrays = [c.cast(f.type) for c, f in zip(kept, arrow, strict=False)] + made
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, schema)


def encoded(docs, path, keep=("doc_id",)):
    """The kept columns, then n_tokens, ids, piece_starts (characters) and piece_sizes (ids)."""
    kept = ", ".join(f"{c} {dict(docs.dtypes)[c]}" for c in keep)

    def columns(encoder, texts):
        rows = encoder(texts)
        return [len(r[0]) for r in rows], *([r[k] for r in rows] for k in range(3))

    ddl = f"{kept}, n_tokens long, ids array<int>, piece_starts array<int>, piece_sizes array<int>"
    return _over_texts(docs, path, columns, ddl, list(keep))


def decoded(rows, path, keep=("doc_id",)):
    """The kept columns and the bytes of `ids`, from rows of `encoded`."""
    from pyspark.sql import functions as F

    ranks = ranks_of(rows.sparkSession, path)
    shared = rows.sparkSession.sparkContext.broadcast({rank: token for token, rank in ranks.items()})

    @F.udf("binary")
    def join(ids):
        return bytearray(b"".join(map(shared.value.__getitem__, ids or [])))

    return rows.select(*keep, join("ids").alias("bytes"))


def digests(docs, path, keep=("doc_id",)):
    """Number of ids, and hashes of the ids and of the bytes they decode to."""

    def columns(encoder, texts):
        ids = [r[0] for r in encoder(texts)]
        return (
            [len(x) for x in ids],
            [hashlib.sha256(np.array(x, "<u4").tobytes()).hexdigest() for x in ids],
            [hashlib.sha256(encoder.decode(x)).hexdigest() for x in ids],
        )

    kept = ", ".join(f"{c} {dict(docs.dtypes)[c]}" for c in keep)
    ddl = f"{kept}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _over_texts(docs, path, columns, ddl, list(keep))
