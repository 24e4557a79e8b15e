"""Language identification by interpolated Kneser-Ney character models.

Texts become letters in lower case, with single spaces between runs of letters. Spark counts
the four-letter grams of each language over all training texts (summed in each task first),
and derives continuation counts, discounts and back-off weights of every order. The model is
kept as sorted arrays: for each order its grams and contexts, and beside them one column per
language. The letters of the training texts are numbered, so that a gram is a 64-bit number of
its own and shares its row with no other; a letter that was not trained on has the number 0,
which is in no gram of the model. The arrays grow with the distinct grams of the corpus; they
are gathered by the driver and sent to the tasks. More than LETTERS letters are an error. A text gets the language of
lowest cross-entropy per character; the sharpness of the scores and, for each language, the
cross-entropy beyond which an answer is rejected are calibrated on all training texts.

Null texts and texts without a letter are `und`, score 0, as are all texts if there is nothing
to learn from. Ties go to the language that is first by name. A null doc_id counts as the empty
string in the split. Rows are judged one by one; repeated rows get equal results.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from repotide.scratch import write_table

ORDER = 4
#: Letters of the training texts (the space is one) that 16 bits can number.
LETTERS = 65_535
#: Characters handled at once by a task; longer texts are cut, sums are not affected.
CHUNK = 400_000
#: Distinct grams that a task holds before it hands them on.
HELD = 1_000_000
SHARPNESS = (1.0, 2.0, 4.0, 8.0, 16.0, 32.0, 64.0)
#: Standard deviations above the mean of its training texts at which an answer is rejected.
REJECT = 5.0
COUNTS_DDL = "lang string, gram long, c long"
SCORES_DDL = "doc_id long, held_out boolean, lang string, letters long, entropy array<double>"


def fold_table():
    """Lower-case letter of each code point, or a space."""
    table = np.full(0x110000, 32, np.uint32)
    for c in range(0x110000):
        s = chr(c)
        if s.isalpha():
            low = s.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def folded(text, table):
    """Three spaces, the letters with single spaces between their runs, and a space."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    out = table[points]
    keep = out != 32
    keep[1:] |= keep[:-1] & (out[1:] == 32)
    out = out[keep]
    if not len(out):
        return out
    tail = [] if out[-1] == 32 else [32]
    return np.concatenate([[32] * (ORDER - 1), out, tail]).astype(np.uint64)


def grams(letters):
    """The grams of four numbered letters as 64-bit numbers, earlier letters in higher bits."""
    n = len(letters) - ORDER + 1
    out = np.zeros(n, np.uint64)
    for k in range(ORDER):
        out = (out << np.uint64(16)) | letters[k : n + k]
    return out


def pieces(letters):
    """Cuts a long sequence so that each gram is in one piece."""
    for at in range(0, len(letters) - ORDER + 1, CHUNK):
        yield letters[at : at + CHUNK + ORDER - 1]


def held_out():
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(4)) == 2


def training(docs):
    return docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")


def alphabet(docs, table):
    """Number of each letter: from 1 on in the training texts, 0 elsewhere."""
    rows = training(docs).select("text")
    shared = rows.sparkSession.sparkContext.broadcast(table)

    def run(batches):
        seen = np.zeros(0x110000, bool)
        for batch in batches:
            for k in range(batch.num_rows):
                seen[folded(batch.column(0)[k].as_py(), shared.value)] = True
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(seen).astype(np.int32))], ["letter"])

    # One row a letter, of which Unicode has fewer than 140,000.
    letters = sorted(r[0] for r in rows.mapInArrow(run, "letter int").distinct().collect())
    if len(letters) > LETTERS:
        raise ValueError(f"{len(letters)} letters in the training texts; at most {LETTERS} can be numbered")
    numbers = np.zeros(0x110000, np.uint64)
    numbers[letters] = np.arange(1, len(letters) + 1)
    return numbers


def gram_counts(docs, table, numbers):
    """(lang, gram, c) of the training texts."""
    rows = training(docs)
    shared = rows.sparkSession.sparkContext.broadcast((table, numbers))

    def run(batches):
        table, numbers = shared.value
        found = {}

        def summed(lang, more=()):
            g = np.concatenate([x[0] for x in found[lang]] + [x[0] for x in more])
            c = np.concatenate([x[1] for x in found[lang]] + [x[1] for x in more])
            g, inverse = np.unique(g, return_inverse=True)
            return g, np.bincount(inverse, weights=c).astype(np.int64)

        def out(lang):
            g, c = summed(lang)
            return pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(g), pa.string()), pa.array(g.view(np.int64)), pa.array(c)], ["lang", "gram", "c"]
            )

        for batch in batches:
            for k in range(batch.num_rows):
                lang, text = batch.column(0)[k].as_py(), batch.column(1)[k].as_py()
                for piece in pieces(folded(text, table)):
                    g, c = np.unique(grams(numbers[piece]), return_counts=True)
                    found.setdefault(lang, []).append((g, c))
                    if sum(len(x[0]) for x in found[lang][1:]) > CHUNK:
                        found[lang] = [summed(lang)]
                        if len(found[lang][0][0]) > HELD:
                            yield out(lang)
                            del found[lang]
        for lang in list(found):
            yield out(lang)

    return rows.mapInArrow(run, COUNTS_DDL).groupBy("lang", "gram").agg(F.sum("c").alias("c"))


def kneser_ney(counts):
    """For each order from ORDER to 1: (grams with `share`, contexts with `backoff`)."""
    out = []
    for order in range(ORDER, 0, -1):
        counts = write_table(counts, f"grams{order}")
        ones = counts.groupBy("lang").agg(
            F.count_if(F.col("c") == 1).alias("n1"), F.count_if(F.col("c") == 2).alias("n2")
        )
        discount = F.least(F.lit(0.95), F.greatest(F.lit(0.1), F.col("n1") / F.greatest(F.col("n1") + 2 * F.col("n2"), F.lit(1))))
        ones = ones.select("lang", discount.alias("discount"))
        context = F.shiftrightunsigned("gram", 16) if order > 1 else F.lit(0).cast("long")
        rows = counts.withColumn("context", context)
        totals = rows.groupBy("lang", "context").agg(F.sum("c").alias("total"), F.count("*").alias("kinds"))
        totals = totals.join(ones, "lang")
        share = rows.join(totals, ["lang", "context"]).select(
            "lang", "gram", ((F.col("c") - F.col("discount")) / F.col("total")).alias("share")
        )
        backoff = totals.select(
            "lang", F.col("context").alias("gram"), (F.col("discount") * F.col("kinds") / F.col("total")).alias("share")
        )
        out.append((share, backoff))
        mask = (1 << 16 * (order - 1)) - 1
        lower = F.col("gram").bitwiseAND(F.lit(mask))
        counts = counts.groupBy("lang", lower.alias("gram")).agg(F.count("*").alias("c"))
    return out


def gram_array(rows, langs, missing):
    """(sorted grams, matrix grams x languages) of rows (lang, gram, share)."""
    number = F.array_position(F.array(*(F.lit(x) for x in langs)), F.col("lang")) - 1
    got = rows.select("gram", number.cast("int").alias("number"), F.col("share").cast("float").alias("share")).toPandas()
    keys, row = np.unique(got["gram"].to_numpy(np.int64).view(np.uint64), return_inverse=True)
    matrix = np.full((len(keys) + 1, len(langs)), missing, np.float32)
    matrix[row, got["number"].to_numpy()] = got["share"].to_numpy(np.float32)
    return keys, matrix


def lookup(array, grams):
    """Rows of a gram array for grams; the last row for those that are not in it."""
    keys, matrix = array
    at = np.minimum(np.searchsorted(keys, grams), max(len(keys) - 1, 0))
    return matrix[np.where(keys[at] == grams, at, len(keys))] if len(keys) else matrix[np.zeros(len(grams), int)]


class Model:
    """Numbers of the letters, and sorted arrays of shares and back-off weights, highest order first."""

    def __init__(self, langs, orders, numbers):
        self.langs, self.orders, self.numbers = langs, orders, numbers

    def log_probability(self, grams):
        """Natural logarithm, grams x languages, of the last letter after those before it."""
        total = np.full((len(grams), len(self.langs)), 1.0 / 65536, np.float32)
        for order in range(1, ORDER + 1):
            share, backoff = self.orders[ORDER - order]
            gram = grams & np.uint64((1 << 16 * order) - 1)
            context = gram >> np.uint64(16) if order > 1 else np.zeros_like(gram)
            total = lookup(share, gram) + lookup(backoff, context) * total
        return np.log(np.maximum(total, 1e-12))

    def cross_entropies(self, texts, table):
        """(number of grams, cross-entropy of each language) of each text."""
        out = [[0, np.zeros(len(self.langs))] for _ in texts]
        held, owners, size = [], [], 0

        def flush():
            every = np.concatenate(held)
            kinds, inverse = np.unique(every, return_inverse=True)
            logs = self.log_probability(kinds)[inverse]
            cuts = np.cumsum([0, *(len(g) for g in held)])
            sums = np.add.reduceat(logs, cuts[:-1], axis=0, dtype=np.float64)
            for k, n, s in zip(owners, np.diff(cuts), sums, strict=True):
                out[k][0] += int(n)
                out[k][1] = out[k][1] - s

        for k, text in enumerate(texts):
            for piece in pieces(folded(text or "", table)):
                held.append(grams(self.numbers[piece]))
                owners.append(k)
                size += len(held[-1])
                if size >= CHUNK:
                    flush()
                    held, owners, size = [], [], 0
        if held:
            flush()
        return [(n, s / max(n, 1)) for n, s in out]


def train(docs, table):
    """The model of the training texts, or None if there are none."""
    numbers = alphabet(docs, table)
    counts = write_table(gram_counts(docs, table, numbers), "gram-counts")
    langs = sorted(r[0] for r in counts.select("lang").distinct().collect())
    if not langs:
        return None
    orders = [(gram_array(share, langs, 0.0), gram_array(backoff, langs, 1.0)) for share, backoff in kneser_ney(counts)]
    return Model(langs, orders, numbers)


def scored(docs, model, table):
    """SCORES_DDL rows: cross-entropies of each text."""
    shared = docs.sparkSession.sparkContext.broadcast((model, table))
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(StructType.fromDDL(SCORES_DDL))

    def run(batches):
        model, table = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = model.cross_entropies(part.column(3).to_pylist(), table)
                made = [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1].tolist() for r in rows], arrow.field(4).type)]
                yield pa.RecordBatch.from_arrays([*part.columns[:3], *made], schema=arrow)

    return docs.select("doc_id", held_out().alias("held_out"), "lang", "text").mapInArrow(run, SCORES_DDL)


def calibrated(scores, langs):
    """Adds lang_pred, score and rejected, calibrated on the training rows of `scores`."""
    best = F.array_min("entropy")
    at = F.array_position("entropy", best).cast("int")
    names = F.array(*(F.lit(x) for x in langs))
    rows = scores.withColumn("best", best).withColumn("at", at).withColumn("guess", F.element_at(names, at))
    known = rows.where(~F.col("held_out") & F.col("lang").isNotNull() & (F.col("letters") > 0))
    own = F.element_at("entropy", F.array_position(names, F.col("lang")).cast("int"))

    def log_share(entropy, sharp):
        spread = F.aggregate("entropy", F.lit(0.0), lambda s, e: s + F.exp(sharp * (F.col("best") - e)))
        return sharp * (F.col("best") - entropy) - F.log(spread)

    fits = known.agg(*(F.avg(log_share(own, s)).alias(f"s{k}") for k, s in enumerate(SHARPNESS))).first()
    sharp = max(zip([f if f is not None else 0.0 for f in fits], SHARPNESS, strict=True))[1]
    right = known.where(F.col("guess") == F.col("lang"))
    limits = dict.fromkeys(langs, float("inf"))
    for lang, mean, deviation in right.groupBy("lang").agg(F.avg("best"), F.stddev_pop("best")).collect():
        limits[lang] = mean + REJECT * max(deviation, 0.02)
    limit = F.element_at(F.array(*(F.lit(limits[x]) for x in langs)), F.col("at"))
    empty = F.col("letters") == 0
    return rows.select(
        "doc_id",
        "held_out",
        F.when(empty, "und").otherwise(F.col("guess")).alias("lang_pred"),
        F.when(empty, 0.0).otherwise(F.exp(log_share(F.col("best"), sharp))).alias("score"),
        (empty | (F.col("best") > limit)).alias("rejected"),
        F.when(~empty, F.col("best")).alias("cross_entropy"),
    )


def predicted(docs):
    """doc_id, held_out, lang_pred, score, rejected, cross_entropy of each row of `docs`."""
    table = fold_table()
    model = train(docs, table)
    if model is None:
        return docs.select(
            "doc_id",
            held_out().alias("held_out"),
            F.lit("und").alias("lang_pred"),
            F.lit(0.0).alias("score"),
            F.lit(True).alias("rejected"),
            F.lit(None).cast("double").alias("cross_entropy"),
        )
    scores = write_table(scored(docs, model, table), "entropies")
    return calibrated(scores, model.langs)
