"""Personal data: exact base patterns, and spans tagged by a character BiLSTM with CRF.

The tagger is trained in numpy on windows of at most TRAIN_DOCS sampled documents. Their
labelled spans are those of the base patterns; some windows are also used in other spellings
(VARIANTS), so that the tagger learns forms which the patterns miss. Then every text is cut
into overlapping windows; each character takes the tag of the window in which it lies most
centrally, and equal neighbouring tags make a span. A tagged span is reported if it has what
its kind demands (`plausible`) and does not touch a base span; base spans always stay.

A plausible span has a digit or an @, so windows without either are not decoded: they could
not change the result. Null and empty texts have no spans. Without a labelled span in the
sample nothing is trained and only base spans are reported. Every row gives one row.
"""

import bisect
import hashlib
import random
import re
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from repotide.llm.bilstm_crf import Tagger
from repotide.llm.common import SLICE, map_rows

KINDS = ("email", "ip", "card", "phone")
#: Documents whose windows train the tagger, and windows of each sort that are used.
TRAIN_DOCS, TRAIN_WINDOWS = 4000, 500
WINDOW, STRIDE, EPOCHS = 64, 32, 35
DDL = (
    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"
)

# The base patterns. Possessive and look-behind forms only avoid rescanning.
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
SIGNAL = re.compile(r"[0-9@]")


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def digits_of(text):
    return re.sub(r"[^0-9]", "", text)


def emails(text):
    last = 0
    if "@" not in text:
        return
    for m in LOCAL.finditer(text):
        if text[m.end() : m.end() + 1] == "@" and max(m.start(), last) < m.end():
            domain = DOMAIN.match(text, m.end() + 1)
            if domain:
                yield max(m.start(), last), domain.end()
                last = domain.end()


def base_spans(text):
    """(kind, start, end), by kind and place."""
    out = [("email", a, b) for a, b in emails(text)]
    if not SIGNAL.search(text):
        return out
    for m in IP.finditer(text):
        if all(int(x) <= 255 for x in m.group().split(".") if len(x) < 10) and all(
            len(x.lstrip("0")) <= 3 for x in m.group().split(".")
        ):
            out.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        digits = digits_of(m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(digits_of(m.group())) <= 15:
                out.append(("phone", *m.span()))
    return out


def plausible(kind, text):
    """Whether a tagged span has what its kind demands."""
    digits = digits_of(text)
    if kind == "email":
        return bool(re.fullmatch(r"[A-Za-z0-9._%+-]+\s?@\s?[A-Za-z0-9-]+(\s?\.\s?[A-Za-z0-9-]+)+", text))
    if kind == "ip":
        parts = re.split(r"\s*\.\s*", text.strip())
        return len(parts) == 4 and all(re.fullmatch(r"[0-9]{1,3}", x) and int(x) <= 255 for x in parts)
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15 and not re.search(r"[A-Za-z]", text) and len(text) < 30


def numbers_of(text):
    """Code points below 128; other letters and other characters have one number each."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    other = np.array([128 + (not chr(c).isalpha()) for c in points[points > 127].tolist()], np.int64)
    points[points > 127] = other
    return points


def tags_of(length, spans):
    """Tag 0 outside, then a beginning and an inside tag of each kind."""
    out = np.zeros(length, np.int64)
    for kind, a, b in spans:
        k = 1 + 2 * KINDS.index(kind)
        out[a:b], out[a] = k + 1, k
    return out


#: Other spellings of a base span, by kind.
VARIANTS = {
    "email": (lambda s, r: s.replace("@", " @ "), lambda s, r: s.replace(".", " . ")),
    "ip": (lambda s, r: s.replace(".", " . "), lambda s, r: s.replace(".", ". ")),
    "card": (lambda s, r: ".".join(re.findall("....?", digits_of(s))), lambda s, r: "  ".join(re.findall("....?", digits_of(s)))),
    "phone": (
        lambda s, r: s[1:].strip(),
        lambda s, r: "00" + s[1:],
        lambda s, r: digits_of(s)[:1] + "".join(f"{r.choice('.- /')}{x}" for x in re.findall("...?.?", digits_of(s)[1:])),
    ),
}


def labelled_windows(text, seed):
    """(sort, window, tags) of one text: around spans as they stand and in another spelling,
    around other digits and @ signs, and seldom from anywhere."""
    rng, spans = random.Random(seed), base_spans(text)

    def window(sort, text, spans, at):
        at = max(0, at)
        inside = [(k, max(a - at, 0), min(b - at, WINDOW)) for k, a, b in spans if a < at + WINDOW and b > at]
        return sort, text[at : at + WINDOW].ljust(WINDOW), tags_of(WINDOW, inside).tolist()

    for kind, a, b in spans:
        yield window(kind, text, spans, a - rng.randint(4, WINDOW - 30))
        own = rng.choice(VARIANTS[kind])(text[a:b], rng)
        before, after = text[max(0, a - WINDOW) : a], text[b : b + WINDOW]
        if not SIGNAL.search(before):
            end = len(before) + len(own)
            changed = [(kind, len(before), end), *((k, x + end, y + end) for k, x, y in base_spans(after))]
            yield window(f"{kind}*", before + own + after, changed, len(before) - rng.randint(4, WINDOW - 30))
    taken = {i for _, a, b in spans for i in range(a, b)}
    free = [m.start() for m in SIGNAL.finditer(text) if m.start() not in taken]
    for at in rng.sample(free, min(2, len(free))):
        yield window("none", text, spans, at - rng.randint(4, WINDOW - 10))
    if rng.random() < 0.1 and text:
        yield window("plain", text, spans, rng.randrange(len(text)))


def training_windows(docs, size=TRAIN_DOCS, per_sort=TRAIN_WINDOWS):
    """(numbers, tags) of windows from the `size` documents whose hashed ids are smallest, or None
    if none has a span. At most `per_sort` windows of each sort come to the driver."""
    ids = docs.where("text is not null").select("doc_id").distinct()
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(size)

    def make():
        def each(doc_id, text):
            for n, (sort, cut, tags) in enumerate(labelled_windows(text, doc_id)):
                yield sort, hashlib.md5(f"{doc_id} {n} {cut}".encode("utf-8", "replace")).hexdigest(), cut, tags

        return each

    texts = docs.where("text is not null").join(F.broadcast(ids), "doc_id", "left_semi").select("doc_id", "text")
    rows = map_rows(texts, make, "sort string, place string, cut string, tags array<int>")
    order = Window.partitionBy("sort").orderBy("place")
    chosen = rows.withColumn("n", F.row_number().over(order)).where(F.col("n") <= per_sort).collect()
    chosen.sort(key=lambda r: r["place"])
    if not any(any(r["tags"]) for r in chosen):
        return None
    return np.array([numbers_of(r["cut"]) for r in chosen]), np.array([r["tags"] for r in chosen])


def train(docs, epochs=EPOCHS):
    """A tagger, or None if the sample has no labelled span."""
    windows = training_windows(docs)
    if windows is None:
        return None
    return Tagger(130, 1 + 2 * len(KINDS)).fit(*windows, epochs)


def windows_of(text):
    """Starts of the windows that have a digit or an @."""
    starts = sorted({max(0, (m.start() // STRIDE - k) * STRIDE) for m in SIGNAL.finditer(text) for k in (0, 1)})
    return [a for a in starts if SIGNAL.search(text, a, a + WINDOW)]


def spans_of(tags):
    """(kind, start, end) of equal neighbouring kinds; a beginning tag starts a new span."""
    kind = (tags + 1) // 2
    edge = np.flatnonzero(np.diff(kind, prepend=0, append=0) | np.append((tags % 2 == 1) & (tags > 0), False))
    return [(KINDS[kind[a] - 1], int(a), int(b)) for a, b in zip(edge, edge[1:], strict=False) if kind[a]]


def reconciled(length, starts, decoded):
    """One tag for each character: that of the window whose centre is nearest, the earlier on ties."""
    tags, best = np.zeros(length, np.int64), np.full(length, WINDOW, np.int64)
    distance = np.abs(2 * np.arange(WINDOW) - WINDOW + 1)
    for a, row in zip(starts, decoded, strict=True):
        n = min(WINDOW, length - a)
        nearer = distance[:n] < best[a : a + n]
        tags[a : a + n][nearer] = row[:n][nearer]
        best[a : a + n][nearer] = distance[:n][nearer]
    return tags


def tagged_spans(texts, tagger):
    """Plausible spans that the tagger finds in each text."""
    starts = [windows_of(t) for t in texts]
    cuts = [t[a : a + WINDOW].ljust(WINDOW) for t, own in zip(texts, starts, strict=True) for a in own]
    if not cuts:
        return [[] for _ in texts]
    decoded = []
    for at in range(0, len(cuts), 2048):
        whole = numbers_of("".join(cuts[at : at + 2048])).reshape(-1, WINDOW)
        decoded.append(tagger.decode(whole).astype(np.int8))
    decoded, out, used = np.concatenate(decoded), [], 0
    for text, own in zip(texts, starts, strict=True):
        found = []
        if own:
            rows = decoded[used : used + len(own)]
            used += len(own)
            if rows.any():
                for kind, a, b in spans_of(reconciled(len(text), own, rows)):
                    piece = text[a:b]
                    a, b = a + len(piece) - len(piece.lstrip()), b - len(piece) + len(piece.rstrip())
                    if a < b and plausible(kind, text[a:b]):
                        found.append((kind, a, b))
        out.append(found)
    return out


def all_spans(base, tagged):
    """Base spans and the tagged ones that touch none of them, by kind and place."""
    order = sorted((a, b) for _, a, b in base)
    starts, ends = [a for a, _ in order], list(accumulate((b for _, b in order), max))
    free = []
    for s in tagged:
        before = bisect.bisect_left(starts, s[2])  # base spans that start before it ends
        if not before or ends[before - 1] <= s[1]:
            free.append(s)
    return sorted({*base, *free}, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def detected(docs, tagger=None, epochs=EPOCHS):
    """DDL rows: base counts and digest, and all spans, for each row of `docs`."""
    docs = docs.select("doc_id", "text")
    tagger = train(docs, epochs) if tagger is None else tagger
    shared = docs.sparkSession.sparkContext.broadcast(tagger)

    arrow = to_arrow_schema(StructType.fromDDL(DDL))

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                texts = [t or "" for t in part.column(1).to_pylist()]
                base = [base_spans(t) for t in texts]
                # The windows of a slice of texts are decoded together.
                tagged = tagged_spans(texts, shared.value) if shared.value is not None else [[]] * len(texts)
                spans = [all_spans(b, t) for b, t in zip(base, tagged, strict=True)]
                made = [
                    *([sum(s[0] == k for s in b) for b in base] for k in KINDS),
                    [hashlib.sha256(joined(b).encode()).hexdigest() for b in base],
                    [joined(x) for x in spans],
                    [len(x) - len(b) for x, b in zip(spans, base, strict=True)],
                ]
                columns = [pa.array(c, f.type) for c, f in zip(made, list(arrow)[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], schema=arrow)

    return docs.mapInArrow(run, DDL)
