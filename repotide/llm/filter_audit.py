"""Audit of how five filters interact, over every order in which they can be applied.

The filters, on a whole text (null: empty) whose words are maximal runs without white space:

A  under 200 words;  B  100 * distinct words < 50 * words;  C  100 * capitals > 2 * code points;
D  holds any of #$%&*|;  E  identical to the text of any smaller doc_id of the whole table.

What a document adds to the result depends on five bits and its labels alone. So documents are
first counted by (part, mask of failures, good, toxic): at most 128 cells a part, whatever the
size of a part. Then the cells of a part are folded, in one row, with higher-order functions:
each cell walks each of the 120 orders with `aggregate`, which gives 600 structs weighted with
the cell's number of documents, and the cells' arrays are merged by elementwise sums.

Filter E needs no window over all copies of a text. Rows are counted by (digest of the text, cell
without E, doc_id), then by (digest, cell) together with the count at the smallest id; what is
left is a row for each cell that a text occurs in, and the smallest id over those decides.

Null and empty texts are equal to each other and to no other text. A row without a doc_id has no
smaller one and is smaller than none, so it passes E and makes no other row fail. Rows with the
same doc_id and text are not smaller than each other. A document is good (toxic) if any row of
`labels` with its doc_id says so; labels without a doc_id belong to no document. Further columns
of either table are not read. An empty table has no parts and gives no rows.
"""

import hashlib
from itertools import permutations

from pyspark.sql import Window
from pyspark.sql import functions as F

from repotide.llm.common import map_rows

#: The filters in the order of their letters, and their limits.
LETTERS = "ABCDE"
MIN_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 200, 50, 2
SYMBOLS = b"#$%&*|"
CAPITALS = bytes(range(65, 91))
#: Bytes of UTF-8 that do not begin a code point.
INNER = bytes(range(0x80, 0xC0))
#: The counts of a struct, in the order of the result.
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def orders(letters=LETTERS):
    """Every order of the filters, sorted."""
    return ["".join(p) for p in permutations(letters)]


def text_mask(text):
    """Bits of the filters A to D that a text in UTF-8 fails. bytes.split cuts at exactly the
    six white-space characters of the rule."""
    words = text.split()
    chars = len(text.translate(None, INNER))
    failed = (
        len(words) < MIN_WORDS,
        100 * len(set(words)) < DISTINCT_PERCENT * len(words),
        100 * (len(text) - len(text.translate(None, CAPITALS))) > CAPITAL_PERCENT * chars,
        len(text.translate(None, SYMBOLS)) < len(text),
    )
    return sum(1 << n for n, x in enumerate(failed) if x)


def masked(docs):
    """(doc_id, part, mask, digest) of each row, made where the text is read."""

    def make():
        def row(doc_id, source, text):
            text = text or b""
            yield doc_id, source or "", text_mask(text), hashlib.sha256(text).digest()

        return row

    read = docs.select("doc_id", F.col("source").cast("string"), F.col("text").cast("binary"))
    kind = dict(docs.dtypes)["doc_id"]
    return map_rows(read, make, f"doc_id {kind}, part string, mask int, digest binary")


def _labels(labels):
    """One row per labelled doc_id."""
    said = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False))).alias(c)
    named = labels.where(F.col("doc_id").isNotNull())
    return named.groupBy("doc_id").agg(said("quality"), said("toxic")).withColumnsRenamed({"quality": "good"})


def cells(docs, labels):
    """(part, mask, good, toxic, n): all documents, counted by what they fail and their labels."""
    no = F.lit(False)
    rows = masked(docs).join(_labels(labels), "doc_id", "left").withColumns(
        {"good": F.coalesce("good", no), "toxic": F.coalesce("toxic", no)}
    )
    cell = ["part", "mask", "good", "toxic"]
    per_id = rows.groupBy("digest", "doc_id", *cell).agg(F.count("*").alias("n"))
    per_cell = per_id.groupBy("digest", *cell).agg(
        F.sum("n").alias("n"),
        F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))), F.lit(0)).alias("unnamed"),
        F.min("doc_id").alias("first"),
        F.min_by("n", "doc_id").alias("at_first"),
    )
    # A text has at most one row here for each of its cells.
    smallest = F.min("first").over(Window.partitionBy("digest"))
    passing = F.col("unnamed") + F.when(F.col("first") == F.col("smallest"), F.col("at_first")).otherwise(0)
    split = per_cell.withColumn("smallest", smallest).withColumn("passing", passing)
    entry = lambda mask, n: F.struct(mask.alias("mask"), n.alias("n"))
    both = F.array(entry(F.col("mask"), F.col("passing")), entry(F.col("mask") + 16, F.col("n") - F.col("passing")))
    return (
        split.select("part", "good", "toxic", F.inline(both))
        .where("n > 0")
        .groupBy(*cell)
        .agg(F.sum("n").alias("n"))
    )


def _order_array(letters):
    """The orders as one constant, an array of arrays of filter numbers that every task gets."""
    numbers = [[letters.index(x) for x in order] for order in orders(letters)]
    return F.array(*[F.array(*[F.lit(n) for n in order]) for order in numbers])


def _walk(cell, order):
    """What one cell adds at each step of one order: a struct of counts for each filter."""
    n = cell["n"]
    none = F.lit(0).cast("long")

    def step(state, number):
        fails = F.getbit(cell["mask"], number) == 1
        here = fails & ~state["gone"]
        gone = state["gone"] | fails
        count = lambda condition: F.when(condition, n).otherwise(none)
        counted = {
            "kept": count(~gone),
            "removed": count(here),
            "redundant": count(fails & state["gone"]),
            "unique_fails": count(fails & (F.bit_count(cell["mask"]) == 1)),
            "good_lost": count(here & cell["good"]),
            "toxic_lost": count(here & cell["toxic"]),
        }
        made = F.struct(*[counted[c].alias(c) for c in COUNTS])
        return F.struct(gone.alias("gone"), F.concat(state["steps"], F.array(made)).alias("steps"))

    shape = "array<struct<" + ",".join(f"{c}:bigint" for c in COUNTS) + ">>"
    start = F.struct(F.lit(False).alias("gone"), F.array().cast(shape).alias("steps"))
    return F.aggregate(order, start, step, lambda state: state["steps"])


def folded(counted, letters=LETTERS):
    """One row per part, order and step from the cells of `cells`."""
    table, names = _order_array(letters), orders(letters)
    zero = F.struct(*[F.lit(0).cast("long").alias(c) for c in COUNTS])
    zeros = F.array_repeat(zero, len(names) * len(letters))
    add = lambda a, b: F.struct(*[(a[c] + b[c]).alias(c) for c in COUNTS])
    walked = F.transform("cells", lambda cell: F.flatten(F.transform(table, lambda order: _walk(cell, order))))
    merged = F.aggregate(walked, zeros, lambda total, one: F.zip_with(total, one, add))
    # At most 128 cells a part: 32 masks, good or not, toxic or not.
    listed = counted.groupBy("part").agg(F.collect_list(F.struct("mask", "good", "toxic", "n")).alias("cells"))
    steps = listed.select("part", F.posexplode(merged).alias("k", "s"))
    order = F.get(F.array(*[F.lit(n) for n in names]), F.floor(F.col("k") / len(letters)).cast("int"))
    named = steps.select("part", order.alias("filter_order"), (F.col("k") % len(letters) + 1).alias("step"), "s.*")
    letter = named.withColumn("letter", F.substring("filter_order", F.col("step"), F.lit(1)))
    # 120 rows of a part have the same letter.
    shapley = F.sum("removed").over(Window.partitionBy("part", "letter"))
    return letter.withColumn("shapley", shapley).drop("letter")


def audit(docs, labels):
    """Counts of every filter at every step of every order, per part; zeros included."""
    return folded(cells(docs, labels))


_BITS = " + ".join(f"CASE WHEN {x} THEN {1 << n} ELSE 0 END" for n, x in enumerate("abcde"))
ORACLE = r"""
WITH t AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
),
f AS (
  SELECT doc_id, part, len(w) < 200 AS a, 100 * len(list_distinct(w)) < 50 * len(w) AS b,
         100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 2 * length(text) AS c,
         regexp_matches(text, '[#$%&*|]') AS d,
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS e
  FROM t
),
l AS (
  SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic
  FROM labels GROUP BY doc_id
),
cell AS (
  SELECT part, BITS AS mask, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, count(*) AS n
  FROM f LEFT JOIN l USING (doc_id) GROUP BY ALL
),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter, unnest([0, 1, 2, 3, 4]) AS bit),
o AS (
  SELECT p.letter || q.letter || r.letter || s.letter || t.letter AS filter_order,
         [p.bit, q.bit, r.bit, s.bit, t.bit] AS bits
  FROM x p, x q, x r, x s, x t
  WHERE len(list_distinct([p.bit, q.bit, r.bit, s.bit, t.bit])) = 5
),
st AS (
  SELECT filter_order, k AS step, 1 << bits[k] AS own,
         list_sum(list_transform(bits[1:k - 1], lambda z: 1 << z)) AS gone
  FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS k)
),
r AS (
  SELECT part, filter_order, CAST(step AS INTEGER) AS step, own,
    CAST(sum(CASE WHEN mask & (coalesce(gone, 0)::BIGINT | own) = 0 THEN n ELSE 0 END) AS BIGINT) AS kept,
    CAST(sum(CASE WHEN mask & own > 0 AND mask & coalesce(gone, 0)::BIGINT = 0 THEN n ELSE 0 END) AS BIGINT) AS removed,
    CAST(sum(CASE WHEN mask & own > 0 AND mask & coalesce(gone, 0)::BIGINT > 0 THEN n ELSE 0 END) AS BIGINT) AS redundant,
    CAST(sum(CASE WHEN mask = own THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
    CAST(sum(CASE WHEN good AND mask & own > 0 AND mask & coalesce(gone, 0)::BIGINT = 0 THEN n ELSE 0 END) AS BIGINT) AS good_lost,
    CAST(sum(CASE WHEN toxic AND mask & own > 0 AND mask & coalesce(gone, 0)::BIGINT = 0 THEN n ELSE 0 END) AS BIGINT) AS toxic_lost
  FROM cell, st GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM r""".replace("BITS", _BITS)
