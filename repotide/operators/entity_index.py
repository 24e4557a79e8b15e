"""Entities of a dictionary of any size, found through an index of q-grams.

`entities.entity_mentions` tests each pattern of a literal in each row, which suits some dozens of
patterns. Here the dictionary is a table. A text can only mention a pattern if it holds each run
of q characters (q-gram) of it. Those of its longest word count, and the pattern is filed under
the one that the fewest texts hold. A word shorter than q is filed under itself; a pattern with a
q-gram that no text holds is left out. The rows are those of `entity_mentions` over the same patterns.

Texts look up the q-grams of their words. A word without white space holds a pattern or not
wherever it stands, so a task looks up each distinct word once and keeps the answer; a pattern of
several words is tested on the whole text where its longest word is found.
"""

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repotide.functions.expressions import bind
from repotide.operators.arrow_terms import numbered
from repotide.scratch import write_table

GRAM_CHARS = 4
# Bytes of index that may be broadcast; a larger one is joined by shuffle.
BROADCAST_BYTES = 32 << 20
# Copies of the index in that join, so that a frequent q-gram is not one task's work.
SALTS = 16
# Words that a task keeps answers for, and their length; others are looked up again.
KEPT_WORDS = 200_000
KEPT_CHARS = 64
# Cells (text, number) that a task marks at a time.
CELLS = 1 << 20
SPACE = r"[ \t\n\x0B\f\r]+"

MENTION = ("language", "id", "seq", "entity_type", "name", "entry")


def grams(text, lengths):
    """The distinct q-grams of a text, for each of a few lengths, as one array.

    The text is cut into characters once: `substring` would walk a long text from its start for
    every place.
    """
    nothing = F.array().cast("array<string>")

    def runs(chars, length):
        if length == 0:
            return F.array(F.lit(""))
        at = lambda i: F.concat(*[F.get(chars, i + k) for k in range(length)])
        places = F.sequence(F.lit(0), F.size(chars) - length)
        return F.when(F.size(chars) >= length, F.array_distinct(F.transform(places, at))).otherwise(nothing)

    return bind(
        F.filter(F.split(text, ""), lambda c: c != ""),
        lambda chars: reduce(F.concat, [runs(chars, length) for length in lengths], nothing),
    )


def _longest_word(text):
    """The longest run without white space, the last in order of equal ones; empty without any."""
    sized = lambda word: F.struct(F.char_length(word).alias("chars"), word.alias("word"))
    return F.array_max(F.transform(F.split(text, SPACE), sized))["word"]


def pattern_grams(dictionary, q=GRAM_CHARS):
    """(entity_type, name, entry, gram): the q-grams of each pattern's longest word; null patterns
    have none."""
    lengths = list(range(q + 1))
    known = dictionary.where(F.col("name").isNotNull()).withColumn("word", _longest_word(F.col("name")))
    size = F.least(F.char_length("word"), F.lit(q))
    of_length = F.filter(grams(F.col("word"), lengths), lambda g: F.char_length(g) == size)
    return known.select("entity_type", "name", "entry", F.explode(of_length).alias("gram"))


def _lengths(filed):
    """Which lengths of q-grams the patterns need: at most q + 1 numbers."""
    return sorted(r.n for r in filed.select(F.char_length("gram").alias("n")).distinct().collect())


def _fits(table, columns, limit):
    """Whether a written table may be broadcast, by the bytes of its strings."""
    size = sum((F.octet_length(c) for c in columns), F.lit(64))
    return (table.agg(F.sum(size)).first()[0] or 0) <= limit


def _text_grams(docs, lengths, *columns):
    lowered = docs.withColumn("text", F.lower("description")).where(F.col("text").isNotNull())
    return lowered.select(*columns, F.explode(grams(F.col("text"), lengths)).alias("gram"))


def _remembered(look_up):
    """`look_up` of a word, with the answers for short words kept, up to KEPT_WORDS of them."""
    kept = {}

    def found(word):
        if len(word) > KEPT_CHARS:
            return look_up(word)
        if word not in kept:
            if len(kept) >= KEPT_WORDS:
                kept.clear()
            kept[word] = look_up(word)
        return kept[word]

    return found


def _held(word, wanted, lengths):
    """Those of the wanted q-grams that a word holds, some of them repeated."""
    held = []
    for n in lengths:
        for i in range(len(word) - n + 1):
            gram = word[i : i + n]
            if gram in wanted:
                held.append(gram)
    return held


def _marked(words, look_up, width):
    """The texts of a column of word lists, some at a time: their first row, and for each of them and
    each of `width` numbers whether `look_up` of one of its words has the number."""
    rows, codes, distinct = numbered(words)
    answers = [look_up(word) for word in distinct.to_pylist()]
    sizes = np.fromiter(map(len, answers), np.int64, len(answers))
    ends = np.cumsum(sizes)
    numbers = np.fromiter((n for answer in answers for n in answer), np.int64, sizes.sum())
    step = max(CELLS // max(width, 1), 1)
    for first in range(0, len(words), step):
        low, high = np.searchsorted(rows, [first, first + step])
        marks = np.zeros((min(step, len(words) - first), width), bool)
        own = codes[low:high]
        many = sizes[own]
        # Places in `numbers` of the answers of one word after the other.
        places = np.repeat(ends[own] - np.cumsum(many), many) + np.arange(many.sum())
        marks[np.repeat(rows[low:high] - first, many), numbers[places]] = True
        yield first, marks


def _worded(docs, *columns):
    """Lower-cased texts as words, at least one for each text; null texts are left out."""
    lowered = docs.withColumn("text", F.lower("description")).where(F.col("text").isNotNull())
    return lowered.select(*columns, F.split("text", SPACE).alias("words"))


def _held_counts(docs, wanted, lengths):
    """(gram, texts): how many texts of a task hold each wanted q-gram; several rows for a q-gram."""
    shared = docs.sparkSession.sparkContext.broadcast([r.gram for r in wanted.collect()])

    def count(batches):
        place = {gram: n for n, gram in enumerate(shared.value)}
        look_up = _remembered(lambda word: [place[gram] for gram in _held(word, place, lengths)])
        texts = np.zeros(len(place), np.int64)
        for batch in batches:
            for _, marks in _marked(batch.column("words"), look_up, len(place)):
                texts += np.count_nonzero(marks, axis=0)
        held = np.flatnonzero(texts)
        grams_held = pa.array([shared.value[n] for n in held], pa.string())
        yield pa.RecordBatch.from_arrays([grams_held, pa.array(texts[held])], ["gram", "texts"])

    return _worded(docs).mapInArrow(count, "gram string, texts long")


def _numbered_mentions(docs, filed, lengths):
    """(language, id, seq, numbers): places in `filed`, rows with a name and a gram, of the patterns
    that each text mentions."""
    # Patterns that are not one word; only they are tested on whole texts.
    spaced = [n for n, row in enumerate(filed) if len(row.name.split()) != 1 or row.name != row.name.strip()]
    shared = docs.sparkSession.sparkContext.broadcast(([(r.name, r.gram) for r in filed], spaced))

    def find(batches):
        (names, grams_of), asked = zip(*shared.value[0]), shared.value[1]
        spaced, patterns = set(asked), {}
        for number, gram in enumerate(grams_of):
            patterns.setdefault(gram, []).append(number)

        def near(word):
            held = [n for gram in _held(word, patterns, lengths) for n in patterns[gram]]
            return [n for n in held if n in spaced or names[n] in word]

        look_up = _remembered(near)
        for batch in batches:
            sizes, numbers = [], []
            for first, marks in _marked(batch.column("words"), look_up, len(names)):
                for row, place in np.argwhere(marks[:, asked]):
                    text = batch.column("text")[first + int(row)].as_py()
                    marks[row, asked[place]] = names[asked[place]] in text
                sizes.append(np.count_nonzero(marks, axis=1))
                numbers.append(np.nonzero(marks)[1].astype(np.int32))
            if sizes:
                ends = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int32)
                listed = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(numbers)))
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], listed], ["language", "id", "seq", "numbers"])

    text = F.col("text") if spaced else F.lit(None).cast("string").alias("text")
    rows = _worded(docs, "language", "id", "seq", text)
    return rows.mapInArrow(find, T.StructType([*rows.schema.fields[:3], T.StructField("numbers", T.ArrayType(T.IntegerType()))]))


def _salted(rows, keys, by):
    """Both sides of a join on `gram`, dealt by gram and salt."""
    salt = F.pmod(F.xxhash64(*by), F.lit(SALTS))
    copies = keys.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return rows.withColumn("_salt", salt).join(copies, ["gram", "_salt"]).drop("_salt")


def gram_index(docs, dictionary, q=GRAM_CHARS, limit=BROADCAST_BYTES, other_texts=False):
    """(entity_type, name, entry, gram): each pattern with that of its q-grams which the fewest
    texts hold; equal ones by the order of their letters. Written as a table.

    Patterns with a q-gram that no text holds are left out, unless the index is also meant for
    `other_texts`, such as later micro-batches; the counts then only make it fast.
    """
    filed = write_table(pattern_grams(dictionary, q), "pattern-grams")
    wanted = write_table(filed.select("gram").distinct(), "grams")
    lengths = _lengths(wanted)
    if not lengths:
        return filed
    if _fits(wanted, ["gram"], limit):
        held = _held_counts(docs, wanted, lengths)
    else:
        held = _text_grams(docs, lengths).join(wanted, "gram", "left_semi").withColumn("texts", F.lit(1))
    counts = held.groupBy("gram").agg(F.sum("texts").alias("texts"))
    known = filed.join(counts, "gram", "left")
    place = F.struct(F.coalesce("texts", F.lit(0)), "gram")
    rarest = known.groupBy("entity_type", "name", "entry").agg(
        F.min_by("gram", place).alias("gram"), F.count_if(F.col("texts").isNull()).alias("missing")
    )
    if not other_texts:
        rarest = rarest.where("missing = 0")
    return write_table(rarest.drop("missing"), "gram-index")


def entity_mentions(docs, dictionary=None, q=GRAM_CHARS, limit=BROADCAST_BYTES, index=None):
    """(language, id, seq, entity_type, name, entry) for a table of patterns (entity_type, name,
    entry): a pattern is mentioned if it is a substring of the lower-cased description.

    `docs` are unique by id. An index of up to `limit` bytes goes to all tasks through the driver and
    the texts stay where they are read; beyond it, (id, q-gram) pairs are shuffled and the candidates join their texts.
    An `index` made for other texts may be given in place of the dictionary.
    """
    if index is None:
        index = gram_index(docs, dictionary, q, limit)
    lengths = _lengths(index)
    if not lengths:
        return docs.select("language", "id", "seq").join(index.drop("gram"), F.lit(False)).select(*MENTION)
    text = F.lower("description")
    if _fits(index, ["entity_type", "name", "gram"], limit):
        filed = index.collect()
        kinds = docs.sparkSession.createDataFrame(
            [(n, *(row[c] for c in MENTION[3:])) for n, row in enumerate(filed)],
            T.StructType([T.StructField("number", T.IntegerType()), *(index.schema[c] for c in MENTION[3:])]),
        )
        rows = _numbered_mentions(docs, filed, lengths).select("language", "id", "seq", F.explode("numbers").alias("number"))
        return rows.join(F.broadcast(kinds), "number").select(*MENTION)
    pairs = _salted(_text_grams(docs, lengths, "id"), index, ["id"]).drop("gram")
    texts = docs.select("language", "id", "seq", text.alias("text"))
    return pairs.join(texts, "id").where(F.contains("text", F.col("name"))).select(*MENTION)


def entity_mention_counts(mentions):
    """(entity_type, name, documents)."""
    return mentions.groupBy("entity_type", "name").agg(F.count("*").alias("documents"))
