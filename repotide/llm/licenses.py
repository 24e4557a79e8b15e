"""License scan: fuzzy search for short notices.

A text is reduced to its words joined by single spaces. A notice that may differ in k edits is
split into k + 1 pieces, of which one must occur unchanged (pigeonhole); one Aho-Corasick pass
finds all pieces, and around each the regex library's bounded-error matching verifies the
notice and reports its span. Overlapping candidate windows of a notice are joined first, so a
frequent piece does not verify the same text again and again. Phrases that must stand exactly
(the base) are counted at all their places, overlapping ones included.

Null and empty texts have no words, no places and no labels. Every row gives one row.
"""

import bisect

from repotide.llm.common import map_rows, words_of

# The base phrases and their labels.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)
#: Notices that are searched with errors; labels and wording as in the public license texts.
NOTICES = (
    ("released under the mit license", "mit"),
    ("licensed under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit"),
    ("licensed under the apache license version 2 0", "apache-2"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("creative commons attribution noncommercial", "cc-by-nc"),
    ("gnu general public license version 3", "gpl-3"),
    ("gnu general public license version 2", "gpl-2"),
    ("gnu lesser general public license", "lgpl"),
    ("redistribution and use in source and binary forms", "bsd"),
    ("mozilla public license version 2 0", "mpl-2"),
    ("creative commons attribution sharealike", "cc-by-sa"),
    ("this work is dedicated to the public domain", "public-domain"),
    ("all rights reserved", "all-rights-reserved"),
)
#: One edit is allowed for each so many characters, and one at least.
CHARS_PER_EDIT = 14
DDL = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
    "labels string, score double, spans array<struct<label:string,start:long,stop:long,edits:int>>"
)


def edits_of(notice):
    return max(1, len(notice) // CHARS_PER_EDIT)


def pieces_of(notice):
    """(offset, piece) of the k + 1 pieces of a notice."""
    n = edits_of(notice) + 1
    cuts = [len(notice) * k // n for k in range(n + 1)]
    return [(cuts[k], notice[cuts[k] : cuts[k + 1]]) for k in range(n)]


def windows_of(places, notice, length):
    """Joined stretches of the text in which `notice` may stand, from (place, offset) of pieces."""
    k, out = edits_of(notice), []
    for start in sorted(place - offset for place, offset in places):
        a, b = max(0, start - k), min(length, start + len(notice) + k)
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def scanner(notices=NOTICES):
    """f(text of joined words) -> (label, start, stop, edits) of all fuzzy matches."""
    import ahocorasick
    import regex

    automaton, owners = ahocorasick.Automaton(), {}
    for number, (notice, _) in enumerate(notices):
        for offset, piece in pieces_of(notice):
            owners.setdefault(piece, []).append((number, offset))
    for piece, where in owners.items():
        automaton.add_word(piece, (len(piece), where))
    automaton.make_automaton()
    patterns = [
        regex.compile(f"(?e)(?:{regex.escape(notice)}){{e<={edits_of(notice)}}}") for notice, _ in notices
    ]

    def scan(text):
        places, found = {}, []
        for last, (size, where) in automaton.iter(text):
            for number, offset in where:
                places.setdefault(number, []).append((last + 1 - size, offset))
        for number, at in places.items():
            notice, label = notices[number]
            for a, b in windows_of(at, notice, len(text)):
                for m in patterns[number].finditer(text, a, b):
                    found.append((label, m.start(), m.end(), sum(m.fuzzy_counts)))
        return found

    return scan


def places_of(phrase, joined):
    """Character places where the words of `phrase` stand consecutively in ' w w w '."""
    out, at = [], joined.find(f" {phrase} ")
    while at >= 0:
        out.append(at)
        at = joined.find(f" {phrase} ", at + 1)
    return out


def license_labels(docs, phrases=PHRASES, notices=NOTICES):
    """One row of DDL for each row of `docs`; spans are in words, best match first per label."""

    def make():
        scan = scanner(notices)

        def each(doc_id, text):
            words = words_of(text)
            text = " ".join(words)
            joined = f" {text} "
            starts = None

            def word_at(place):
                """The number of the word that character `place` of the joined text is in."""
                nonlocal starts
                if starts is None:
                    starts, at = [], 0
                    for w in words:
                        starts.append(at)
                        at += len(w) + 1
                return bisect.bisect_right(starts, place) - 1

            base = [(word_at(p), label) for phrase, label in phrases for p in places_of(phrase, joined)]
            matches = scan(text)
            spans = [(label, word_at(a), word_at(b - 1) + 1, e) for label, a, b, e in matches]
            base_labels = {label for _, label in base}
            score = 1.0 if base else max((1 - e / max(b - a, 1) for _, a, b, e in matches), default=0.0)
            yield (
                doc_id,
                len(words),
                len(base),
                min((at for at, _ in base), default=None),
                max((at for at, _ in base), default=None),
                ",".join(sorted(base_labels)),
                ",".join(sorted(base_labels | {s[0] for s in spans})),
                max(0.0, min(1.0, score)),
                [{"label": x, "start": a, "stop": b, "edits": e} for x, a, b, e in sorted(set(spans))],
            )

        return each

    return map_rows(docs.select("doc_id", "text"), make, DDL)
