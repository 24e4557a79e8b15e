"""Packing of documents into windows of a fixed length by Karmarkar-Karp multiway differencing.

A document is the ids of its text (null: empty) and one end id. What fills whole windows is cut
off in front; the rest, shorter than a window, waits in a group. As soon as a group holds enough
for WINDOWS windows it is packed, and what exceeds whole windows goes on to the next group.

In a group each item is a partial partition of the windows: its length in one, nothing in the
others. The two partial partitions of largest imbalance are merged again and again, the fullest
window of one with the emptiest of the other, until one partition of near-equal windows is left.
The number of windows starts at the whole windows that the group fills and rises by one as long as
its ids exceed their capacity. Windows that came out above their length are then levelled in the
same manner: the excess is cut off, and the largest excess meets the emptiest window. So windows
are full and few documents are cut. The last group of a task leaves less than one window; it is
laid out as sequences whose lengths are powers of two, so that no sequence needs padding.

Everything happens in the task that reads a document, without a shuffle; a group's size is fixed,
whatever the documents. Sequences are numbered by partition and place in it, so they are the same
when a lost task is repeated over the same rows. Read the documents from a table: rows straight
from a shuffle may come in another order when a task is repeated, and pack otherwise.

Ids come from the tokenizers library, a word between ASCII white space at a time. No id of this
vocabulary spans white space, so this gives the ids of the whole text; words seen before are
looked up.

Null and empty texts are one end id. Very long texts give many windows. Repeated rows and null or
repeated doc_ids are packed row by row, each id once per row. Columns other than the key and the
text are not read. An empty table gives no rows.
"""

import heapq
import os
import zlib
from array import array

from repotide.llm.common import SLICE

#: Length of a window, and the id that ends each document.
LENGTH, END = 2048, 1
#: Windows packed together; more balance better and cost more, and bound a task's memory.
WINDOWS = 64
#: Items shorter than this are strung together before they are packed.
LEAST = 64
#: Marks that are cut off a word's end.
MARKS = b".,;:!?"
#: The characters that stand for bytes in the vocabulary: bytes of Latin-1 that show stand for
#: themselves, the others for the characters from 256 on, in order.
SHOWING = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
SHOWN = {b: 256 + n for n, b in enumerate(b for b in range(256) if b not in SHOWING)}
#: Words kept with their ids per worker, and the longest ones kept.
CACHED, WORD_BYTES = 1_000_000, 64


def _letters(word):
    """A word of letters up to U+00FF in lower case, or None for any other word."""
    letters = word.decode()
    return letters.lower().encode() if letters.isalpha() and max(letters) < "\u0100" else None


def _lowered(text):
    """A-Z in lower case, as the vocabulary has it, unless that could make a special token."""
    return text if b"<|" in text else text.lower()


class Vocabulary:
    """A tokenizer file and the ids of words seen so far. A worker builds the tokenizer once, as
    it keeps what is broadcast."""

    def __init__(self, definition):
        self.definition, self.tokenizer, self.known = definition, None, {}

    def __getstate__(self):
        return {"definition": self.definition, "tokenizer": None, "known": {}}

    def _learn(self, words):
        """Ids of new words. The vocabulary's rule cuts a word of letters with marks behind it
        between the two, and such words need none of the rule's other steps but lower case, so
        the merges of the model are enough for them; all others go through the whole rule."""
        if self.tokenizer is None:
            # Spark runs one task a core already; threads of the library would only be in the way.
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            self.tokenizer = Tokenizer.from_str(self.definition)
        known, model, other = self.known, self.tokenizer.model, []
        for word in words:
            base = word.rstrip(MARKS)
            lowered = base.lower() if base.isalpha() else _letters(base)
            if lowered is None or len(word) > WORD_BYTES:
                other.append(word)
                continue
            ids = known.get(lowered)
            if ids is None:
                shown = lowered.decode() if lowered.isascii() else lowered.decode("latin-1").translate(SHOWN)
                ids = known[lowered] = array("I", [t.id for t in model.tokenize(shown)]).tobytes()
            if len(base) < len(word):
                marks = word[len(base) :]
                if marks not in known:
                    known[marks] = self._whole([marks])[0]
                ids += known[marks]
            known[word] = ids
        known.update(zip(other, self._whole(other), strict=True))

    def _whole(self, words):
        found = self.tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)
        return [array("I", x.ids).tobytes() for x in found]

    def ids(self, texts):
        """The ids of each text in UTF-8 as little-endian 32-bit numbers, with the end id."""
        if len(self.known) > CACHED:
            self.known.clear()
        known, cut = self.known, [_lowered(t or b"").split() for t in texts]
        found = [list(map(known.get, words)) for words in cut]
        holes = [[n for n, x in enumerate(data) if x is None] if None in data else [] for data in found]
        new = {words[n] for words, places in zip(cut, holes, strict=True) for n in places}
        if new:
            self._learn(new)
        for words, data, places in zip(cut, found, holes, strict=True):
            for n in places:
                data[n] = known[words[n]]
        for word in new:
            if len(word) > WORD_BYTES:
                del known[word]
        end = END.to_bytes(4, "little")
        return [b"".join(data) + end for data in found]


def vocabulary_of(spark, path):
    """The definition in a tokenizer file; a path with a scheme is read by Spark."""
    if "://" in path:
        return Vocabulary(spark.read.text(path, wholetext=True).first()[0])
    with open(path, encoding="utf-8") as file:
        return Vocabulary(file.read())


def merged(a, b, k):
    """Two partial partitions, each a falling list of at most k (sum, members) with the empty
    windows left out, as one: the fullest window of `a` meets the emptiest of `b`."""
    meet = zip(a[k - len(b) :], reversed(b[k - len(a) :]), strict=True)
    out = a[: k - len(b)] + [(x[0] + y[0], x[1] + y[1]) for x, y in meet] + b[: k - len(a)]
    out.sort(key=lambda w: -w[0])
    return out


def differenced(sizes, k):
    """The windows, falling, as (sum, numbers of the items)."""
    heap = [(-size, n, [(size, [n])]) for n, size in enumerate(sizes)]
    heapq.heapify(heap)
    number = len(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        both = merged(a, b, k)
        least = both[-1][0] if len(both) == k else 0
        heapq.heappush(heap, (least - both[0][0], number, both))
        number += 1
    return heap[0][2] if heap else []


def cut(pieces, n):
    """Take the last n ids off a list of (document, start, length): what stays, what goes."""
    stay, gone = list(pieces), []
    while n:
        document, start, length = stay.pop()
        part = min(n, length)
        if part < length:
            stay.append((document, start, length - part))
        gone.append((document, start + length - part, part))
        n -= part
    return stay, gone[::-1]


def levelled(windows, k, length):
    """k windows of at most `length` ids, which must be room enough: excess is cut off the
    largest pieces of a window, and the largest excess goes to the emptiest window."""
    windows = [(total, pieces) for total, pieces in windows] + [(0, [])] * (k - len(windows))
    loose = []
    for n, (total, pieces) in enumerate(windows):
        if total > length:
            stay, gone = cut(sorted(pieces, key=lambda p: p[2]), total - length)
            windows[n] = (length, stay)
            loose.append((total - length, gone))
    while loose:
        loose.sort(key=lambda w: -w[0])
        open_windows = sorted((n for n in range(k) if windows[n][0] < length), key=lambda n: windows[n][0])
        rest = loose[len(open_windows) :]
        for (size, gone), n in zip(loose, open_windows, strict=False):
            total, pieces = windows[n]
            over = max(0, size - (length - total))
            stay, left = cut(gone, over)
            windows[n] = (total + size - over, pieces + stay)
            if over:
                rest.append((over, left))
        loose = rest
    return [pieces for _, pieces in windows]


def packed(items, length=LENGTH):
    """Windows, as lists of pieces, of a group of items (lists of pieces)."""
    total = sum(p[2] for item in items for p in item)
    k = max(1, total // length)
    while total > k * length:
        k += 1
    found = differenced([sum(p[2] for p in item) for item in items], k)
    return levelled([(size, [p for n in members for p in items[n]]) for size, members in found], k, length)


class Group:
    """The items of a task that wait for being packed."""

    def __init__(self, length=LENGTH, windows=WINDOWS):
        self.length, self.windows = length, windows
        self.items, self.small, self.size, self.small_size = [], [], 0, 0

    def add(self, document, start, n):
        """Add a piece of less than a window; gives the windows that are full now."""
        self.size += n
        if n < LEAST:
            self.small.append((document, start, n))
            self.small_size += n
            if self.small_size >= LEAST:
                self._string()
        else:
            self.items.append([(document, start, n)])
        return self._pack() if self.size >= self.windows * self.length else []

    def _string(self):
        if self.small:
            self.items.append(self.small)
            self.small, self.small_size = [], 0

    def _pack(self):
        """Whole windows; what is left over waits on."""
        self._string()
        rest, kept = self.size % self.length, []
        over = rest
        while over:
            last = self.items.pop()
            size = sum(p[2] for p in last)
            stay, gone = cut(last, min(over, size))
            if stay:
                self.items.append(stay)
            kept.append(gone)
            over -= min(over, size)
        windows = packed(self.items, self.length)
        self.items, self.size = kept, rest
        return windows

    def finish(self):
        """All that is left: whole windows, then sequences whose lengths are powers of two."""
        windows = self._pack() if self.size >= self.length else []
        self._string()
        pieces = [p for item in self.items for p in item]
        self.items, rest = [], self.size
        self.size = 0
        while rest:
            part = 1 << (rest.bit_length() - 1)
            pieces, gone = cut(pieces, part)
            windows.append(gone)
            rest -= part
        return windows


def _make(with_ids):
    """Function from an iterator of (key, ids) to rows of `pieces`."""
    from pyspark import TaskContext

    def rows(documents):
        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 33
        group, known, count = Group(), {}, 0

        def sequence(window):
            nonlocal number
            offset = 0
            for document, start, length in window:
                key, total, data, base = known[document]
                part = data[4 * (start - base) : 4 * (start + length - base)]
                yield key, start, length, zlib.crc32(part), total, number, offset, *([part] if with_ids else [])
                offset += length
            number += 1

        def waiting():
            """Forget the ids of documents that no longer wait."""
            alive = {p[0] for item in [*group.items, group.small] for p in item}
            for document in known.keys() - alive:
                del known[document]

        for key, data in documents:
            total = len(data) // 4
            whole = total - total % LENGTH
            known[count] = (key, total, data, 0)
            for start in range(0, whole, LENGTH):
                yield from sequence([(count, start, LENGTH)])
            known[count] = (key, total, data[4 * whole :], whole)
            full = group.add(count, whole, total - whole) if total > whole else []
            for window in full:
                yield from sequence(window)
            if full:
                waiting()
            elif total == whole:
                del known[count]
            count += 1
        for window in group.finish():
            yield from sequence(window)

    return rows


def pieces(docs, path, key="doc_id", with_ids=False):
    """One row per piece: the key, its first id's place in the document and its length, the CRC
    of its ids, the document's length, and its sequence and place there; with `with_ids` also the
    ids as little-endian 32-bit numbers."""
    import pyarrow as pa
    from pyspark.sql import functions as F
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    ddl = f"`{key}` {dict(docs.dtypes)[key]}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    schema = StructType.fromDDL(ddl + (", ids binary" if with_ids else ""))
    arrow = to_arrow_schema(schema)
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(vocabulary_of(spark, path))
    rows_of = _make(with_ids)

    def run(batches):
        def documents():
            for batch in batches:
                for at in range(0, batch.num_rows, SLICE):
                    part = batch.slice(at, SLICE)
                    yield from zip(part.column(0).to_pylist(), shared.value.ids(part.column(1).to_pylist()), strict=True)

        out = []
        for row in rows_of(documents()):
            out.append(row)
            if len(out) >= 8192:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), arrow, strict=True)], schema=arrow)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), arrow, strict=True)], schema=arrow)

    return docs.select(F.col(key), F.col("text").cast("binary")).mapInArrow(run, schema)


def sequences(rows):
    """(sequence_id, ids) of rows of `pieces` with their ids, in the order of their offsets."""
    from pyspark.sql import functions as F

    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # at most a window of ids
    parts = rows.groupBy("sequence_id").agg(ordered.alias("parts"))
    joined = F.aggregate("parts", F.lit(b""), lambda all_, p: F.concat(all_, p["ids"]))
    return parts.select("sequence_id", joined.alias("ids"))
