"""Line dedup by content-defined chunks of lines, in DataFrame functions only.

A rolling hash runs over the hashes of each line and the one before; a chunk ends with a line
whose rolling hash is larger than those beside it. So boundaries follow the content and not
the position (inserted lines move later chunks without changing them), and a chunk has two
lines at least and three on average. A line of LONG_WORDS words or more is a chunk of its own.
Chunks of several lines (or one long line) that occur again anywhere are removed; the
occurrence in the smallest doc_id, and there the first one, stays.

Equal chunks are found by grouping on their digest and their bytes together, reduced in each
task first, so a chunk in a third of all documents moves one row a task. Only chunks whose
digest stands for one string of bytes are removed. Texts are shuffled twice: as chunks to
that grouping and whole to the join with the places to remove.

Chunks miss a repeated passage whose boundaries fall outside it. So each repeated run of lines
with LONG_WORDS words or more goes besides. Each line of such a run stands in two places, so all
others are left out first, by a grouping of line hashes. Windows of the rest (the shortest run of
that many words from each line on, and up to each line) are grouped by two hashes and the SHA-256
of their lines' 128-bit hashes, and the lines of a later occurrence go, without those that the
first occurrence has itself. A window has LONG_WORDS lines at most, as a line counts as a word or
more. `runs=False` leaves this out.

A null text stays null and has no lines; an empty text has one empty line. Rows that share a
doc_id are told apart by their text; equal rows get equal results. A null doc_id counts as
smaller than any other. Extra columns are carried along by `deduplicated`.
Digests have 128 bits; should two different chunks share one, both are kept.
"""

from pyspark.sql import functions as F

LONG_WORDS = 50
#: The hash of the line before is multiplied by this in the rolling hash.
FACTOR = 31
_STOP = 1 << 31
_HASHES = 1 << 32
DIGEST = ("_digest", "_digest2")
COUNTS = ("n_lines", "n_chunks", "n_removed_chunks", "n_removed_lines")
_NO_ID = "-9223372036854775809"


def _number(line):
    return F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("long")


def _is_long(line):
    # So many words need that many bytes; most lines are told by their size alone.
    return (F.octet_length(line) >= 2 * LONG_WORDS - 1) & _has_words(line)


def _has_words(line):
    return _n_words(line) >= LONG_WORDS


def _n_words(line):
    return F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) + 1


def with_chunks(docs):
    """Adds `_lines` and `_codes`: start * 2^31 + stop of each chunk of lines."""
    rows = docs.withColumn("_lines", F.split("text", "\n", -1))
    rows = rows.withColumn("_hashes", F.transform("_lines", _number))
    rows = rows.withColumn("_long", F.transform("_lines", _is_long))
    n = F.size("_lines")
    zero = F.array(F.lit(0).cast("long"))
    before = F.concat(zero, F.slice("_hashes", 1, F.greatest(n - 1, F.lit(0))))
    rows = rows.withColumn("_rolled", F.zip_with("_hashes", before, lambda h, b: (h + FACTOR * b) % _HASHES))

    def end(rolled, i):
        peak = (i > 0) & (i < n - 2) & (rolled > F.get("_rolled", i - 1)) & (rolled >= F.get("_rolled", i + 1))
        return F.when((i == n - 1) | peak | F.get("_long", i) | F.get("_long", i + 1), i.cast("long") + 1)

    ends = F.transform("_rolled", end)
    rows = rows.withColumn("_ends", F.filter(ends, lambda e: e.isNotNull()))
    starts = F.concat(zero, F.slice("_ends", 1, F.greatest(F.size("_ends") - 1, F.lit(0))))
    codes = F.zip_with(starts, "_ends", lambda a, b: a * _STOP + b)
    return rows.withColumn("_codes", codes).drop("_hashes", "_rolled", "_ends")


def _start(code):
    return F.shiftright(code, 31)


def _lines_of(code, of="_lines"):
    start = _start(code)
    return F.slice(of, start.cast("int") + 1, (code.bitwiseAND(F.lit(_STOP - 1)) - start).cast("int"))


def _order():
    """The place of a chunk or window among all: by doc_id, then by code."""
    place = F.coalesce(F.col("doc_id").cast("decimal(38,0)"), F.lit(_NO_ID).cast("decimal(38,0)"))
    return (place * F.lit(1 << 62).cast("decimal(19,0)") + F.col("_code")).cast("decimal(38,0)").alias("_order")


def occurrences(docs):
    """Each chunk that counts: document, its order among all, its code, digest and bytes.

    The digest is made of the hashes of its lines, so that a reader who does not want the bytes
    does not build them.
    """

    def chunk(code):
        marks = _lines_of(code, "_marks")
        counts = (F.size(marks) > 1) | F.get("_long", _start(code).cast("int"))
        return F.when(
            counts,
            F.struct(
                code.alias("_code"),
                F.xxhash64(marks).alias("_digest"),
                F.xxhash64(F.lit(7), marks).alias("_digest2"),
                F.array_join(_lines_of(code), "\n").alias("_chunk"),
            ),
        )

    # The chunks are cut out inside the row: after the explode no row holds the whole text.
    rows = with_chunks(docs.select("doc_id", "text")).withColumn("_marks", F.transform("_lines", lambda x: F.xxhash64(x)))
    rows = rows.select("doc_id", F.xxhash64("text").alias("_text"), F.inline(F.array_compact(F.transform("_codes", chunk))))
    return rows.select("doc_id", "_text", "_code", _order(), *DIGEST, "_chunk")


def repeated_lines(docs):
    """doc_id, _text and in `_lines` the lines that stand in two places at least, in order: their
    number, two hashes and words."""
    rows = docs.where(F.col("text").isNotNull()).select("doc_id", F.xxhash64("text").alias("_text"), F.split("text", "\n", -1).alias("_all"))
    rows = rows.select("doc_id", "_text", F.posexplode("_all").alias("_i", "_line"))
    hashes = (F.xxhash64("_line").alias("_h1"), F.xxhash64(F.lit(7), "_line").alias("_h2"))
    rows = rows.select("doc_id", "_text", "_i", *hashes, F.least(_n_words(F.col("_line")), F.lit(LONG_WORDS)).alias("_words"))
    again = rows.groupBy("_h1", "_h2").agg(F.count("*").alias("_n")).where("_n > 1")
    rows = rows.join(again.drop("_n"), ["_h1", "_h2"])
    # Equal rows bring the same lines twice; a set has them once.
    found = F.array_sort(F.collect_set(F.struct("_i", "_h1", "_h2", "_words")))
    return rows.groupBy("doc_id", "_text").agg(found.alias("_lines"))


def windows(docs):
    """Each window of several lines (or one that is no chunk of its own), like `occurrences`.

    The order holds the text's hash too, so that texts that share a doc_id have an order.
    """
    rows = repeated_lines(docs)

    def taken(lines, first, way):
        """How many of `lines`, which must follow each other from `first`, reach LONG_WORDS."""
        start = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("n"))

        def more(s, x):
            fits = (s["sum"] < LONG_WORDS) & (x["_i"] == first + way * s["n"])
            return F.when(fits, F.struct((s["sum"] + x["_words"]).alias("sum"), (s["n"] + 1).alias("n"))).otherwise(s)

        return F.aggregate(lines, start, more, lambda s: F.when(s["sum"] >= LONG_WORDS, s["n"]))

    def spot(place, n):
        return F.when(n.isNotNull(), F.struct(place.alias("at"), n.alias("n")))

    def forward(x, k):
        n = taken(F.slice("_lines", k + 1, LONG_WORDS), x["_i"], 1)
        return F.when(x["_words"] < LONG_WORDS, spot(k, n))

    def backward(x, k):
        first = F.greatest(k + 1 - LONG_WORDS, F.lit(0))
        n = taken(F.reverse(F.slice("_lines", first + 1, k + 1 - first)), x["_i"], -1)
        return F.when(x["_words"] < LONG_WORDS, spot(k + 1 - n, n))

    spots = F.array_distinct(F.array_compact(F.concat(F.transform("_lines", forward), F.transform("_lines", backward))))

    def window(spot):
        lines = F.slice("_lines", spot["at"] + 1, spot["n"])
        marks = F.transform(lines, lambda x: F.struct(x["_h1"], x["_h2"]))
        text = F.array_join(F.transform(lines, lambda x: F.concat_ws(",", x["_h1"].cast("string"), x["_h2"].cast("string"))), ";")
        start = F.get("_lines", spot["at"])["_i"].cast("long")
        return F.struct(
            (start * _STOP + start + spot["n"]).alias("_code"),
            F.xxhash64(marks).alias("_digest"),
            F.xxhash64(F.lit(7), marks).alias("_digest2"),
            F.unhex(F.sha2(text, 256)).alias("_chunk"),
        )

    rows = rows.withColumn("_windows", spots).where(F.size("_windows") > 0)
    rows = rows.select("doc_id", "_text", F.inline(F.transform("_windows", window)))
    return rows.select("doc_id", "_text", "_code", F.struct(_order(), "_text").alias("_order"), *DIGEST, "_chunk")


def covered_lines(docs):
    """doc_id, _text and the code of lines that repeat an earlier run of LONG_WORDS words."""
    found = windows(docs)
    rows = found.drop("_chunk").join(repeated_chunks(found), list(DIGEST)).where("_order > _first")
    first, base = F.col("_first._order"), F.col("_order._order") - F.col("_code")
    # Where both occurrences are in one text and overlap, the lines of the first one stay.
    same = (first >= base) & (F.col("_first._text") == F.col("_text"))
    kept = F.when(same, (first - base).cast("long").bitwiseAND(F.lit(_STOP - 1)))
    stop = F.col("_code").bitwiseAND(F.lit(_STOP - 1))
    start = F.greatest(_start(F.col("_code")), F.coalesce(kept, F.lit(0)))
    return rows.where(start < stop).select("doc_id", "_text", (start * _STOP + stop).alias("_cover"))


def repeated_chunks(found):
    """Digest and first occurrence of chunks that occur again, compared byte by byte."""
    groups = found.groupBy(*DIGEST, "_chunk").agg(F.count("*").alias("_n"), F.min("_order").alias("_first"))
    return (
        groups.groupBy(*DIGEST)
        .agg(F.count("*").alias("_strings"), F.max("_n").alias("_n"), F.min("_first").alias("_first"))
        .where("_strings = 1 and _n > 1")
        .select(*DIGEST, "_first")
    )


def deduplicated(docs, runs=True):
    """`docs` with repeated chunks and runs removed from `text`, and counts of what was removed.

    n_removed_chunks counts chunks, n_removed_lines all lines that went.

    Columns of `docs` that are named like a count or begin with an underscore are left out.
    """
    docs = docs.select(*(c for c in docs.columns if c[:1] != "_" and c not in COUNTS))
    found = occurrences(docs)
    again = repeated_chunks(found)
    places = (
        found.drop("_chunk")
        .join(again, list(DIGEST))
        .where("_order > _first")
        .select("doc_id", "_text", "_code", F.lit(None).cast("long").alias("_cover"))
    )
    if runs:
        places = places.unionByName(covered_lines(docs).withColumn("_code", F.lit(None).cast("long")))
    places = places.groupBy(F.col("doc_id").alias("_doc"), F.col("_text").alias("_same")).agg(
        F.collect_set("_code").alias("_gone"), *([F.collect_set("_cover").alias("_covers")] if runs else [])
    )
    rows = docs.withColumn("_text", F.xxhash64("text"))
    rows = rows.join(places, rows["doc_id"].eqNullSafe(F.col("_doc")) & (F.col("_text") == F.col("_same")), "left")
    rows = with_chunks(rows.drop("_doc", "_same", "_text")).drop("_long")
    gone = F.coalesce("_gone", F.array().cast("array<bigint>"))
    kept = F.array_except("_codes", gone)
    lines = F.flatten(F.transform(kept, lambda code: _lines_of(code)))
    changed = F.size(gone) > 0
    if runs:
        numbers = lambda codes: F.flatten(F.transform(codes, lambda c: F.sequence(_start(c), c.bitwiseAND(F.lit(_STOP - 1)) - 1)))
        covers = F.coalesce("_covers", F.array().cast("array<bigint>"))
        left = F.array_except(numbers(kept), numbers(covers))
        rows = rows.withColumn("_left", F.transform(left, lambda i: F.get("_lines", i.cast("int"))))
        lines = F.col("_left")
        changed = changed | (F.size(covers) > 0)
    size = lambda x: F.coalesce(F.when(x.isNotNull(), F.size(x)), F.lit(0)).cast("long")
    return rows.select(
        *(c for c in docs.columns if c != "text"),
        F.when(changed, F.array_join(lines, "\n")).otherwise(F.col("text")).alias("text"),
        size(F.col("_lines")).alias("n_lines"),
        size(F.col("_codes")).alias("n_chunks"),
        F.size(gone).cast("long").alias("n_removed_chunks"),
        (size(F.col("_lines")) - size(lines)).alias("n_removed_lines"),
    )


ORACLE = f"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM documents
), h AS (
  SELECT *, ('0x' || left(md5(line), 8))::BIGINT AS h, length(line) - length(replace(line, ' ', '')) + 1 >= {LONG_WORDS} AS long FROM l
), b AS (
  SELECT *, coalesce(r > lag(r) OVER w AND r >= lead(r) OVER w AND lead(r, 2) OVER w IS NOT NULL, false)
            OR long OR coalesce(lead(long) OVER w, false) AS cut
  FROM (SELECT *, (h + {FACTOR} * coalesce(lag(h) OVER w, 0)) % {1 << 32} AS r FROM h WINDOW w AS (PARTITION BY doc_id ORDER BY i))
  WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), c AS (
  SELECT *, coalesce(sum(cut::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS k FROM b
), g AS (
  SELECT doc_id, k, count(*) AS n, min(i) AS first_line, string_agg(line, chr(10) ORDER BY i) AS chunk FROM c GROUP BY doc_id, k
), r AS (
  SELECT *, (n > 1 OR length(chunk) - length(replace(chunk, ' ', '')) + 1 >= {LONG_WORDS})
            AND row_number() OVER (PARTITION BY chunk ORDER BY doc_id, first_line) > 1 AS gone FROM g
), s AS (
  SELECT doc_id, i, line, length(line) - length(replace(line, ' ', '')) + 1 AS words FROM l
), u AS (SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY i) AS upto FROM s),
w AS (
  SELECT DISTINCT a.doc_id, a.i, b.i AS j FROM u a JOIN u b ON a.doc_id = b.doc_id AND b.i BETWEEN a.i AND a.i + {LONG_WORDS - 1}
  WHERE b.upto - a.upto + a.words >= {LONG_WORDS}
    AND ((a.words < {LONG_WORDS} AND b.upto - b.words - a.upto + a.words < {LONG_WORDS}) OR (b.words < {LONG_WORDS} AND b.upto - a.upto < {LONG_WORDS}))
), x AS (
  SELECT w.doc_id, w.i, w.j, string_agg(u.line, chr(10) ORDER BY u.i) AS txt
  FROM w JOIN u ON u.doc_id = w.doc_id AND u.i BETWEEN w.i AND w.j GROUP BY ALL
), y AS (
  SELECT *, first_value(doc_id) OVER p AS first_doc, first_value(j) OVER p AS first_end, row_number() OVER p AS place
  FROM x WINDOW p AS (PARTITION BY txt ORDER BY doc_id, i)
), v AS (
  SELECT DISTINCT doc_id, unnest(range(CASE WHEN first_doc = doc_id THEN greatest(i, first_end + 1) ELSE i END, j + 1)) AS i
  FROM y WHERE place > 1
), z AS (
  SELECT c.doc_id, c.i, c.line, r.gone OR v.i IS NOT NULL AS gone
  FROM c JOIN r USING (doc_id, k) LEFT JOIN v ON v.doc_id = c.doc_id AND v.i = c.i
), t AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone) AS rest, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed_lines
  FROM z GROUP BY doc_id
), q AS (SELECT doc_id, count(*) AS n_chunks, count(*) FILTER (gone) AS n_removed_chunks FROM r GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(rest, '') END AS text, coalesce(n_lines, 0) AS n_lines,
       coalesce(n_chunks, 0) AS n_chunks, coalesce(n_removed_chunks, 0) AS n_removed_chunks, coalesce(n_removed_lines, 0) AS n_removed_lines
FROM documents d LEFT JOIN t USING (doc_id) LEFT JOIN q USING (doc_id)
"""
