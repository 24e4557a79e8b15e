"""Tokens of Arrow batches as numbers, so that tasks count them without a Python object for each."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from repotide.functions.text import WHITESPACE

# Which bytes are white space; no byte of a longer UTF-8 character is.
SPACE = np.isin(np.arange(256), [ord(c) for c in WHITESPACE])


def split_texts(texts):
    """A column of texts as lists of tokens: split at each white space like `ml_tokens`, which also
    makes the lower case and cuts off the white space at the end. Null and empty texts have no token."""
    texts = texts.fill_null("").cast(pa.string())
    buffer = texts.buffers()[2]
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(b"" if buffer is None else buffer, np.uint8)[offsets[0] : offsets[-1]]
    begins, ends = offsets[:-1] - offsets[0], offsets[1:] - offsets[0]
    breaks = SPACE[data]
    at = np.flatnonzero(breaks)
    # Each break ends a token, and so does the end of each text that is not empty.
    until = np.searchsorted(at, ends)
    within = until - np.searchsorted(at, begins)
    filled = ends > begins
    earlier = np.cumsum(filled) - filled
    stops = np.zeros(len(at) + int(filled.sum()) + 1, np.int32)
    stops[1 + np.arange(len(at)) + np.repeat(earlier, within)] = at - np.arange(len(at))
    stops[1 + (until + earlier)[filled]] = (ends - until)[filled]
    tokens = pa.StringArray.from_buffers(len(stops) - 1, pa.py_buffer(stops), pa.py_buffer(data[~breaks]))
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(within + filled)).astype(np.int32)), tokens)


def numbered(tokens):
    """Of a column of lists: the row of each token, its place among the distinct ones, and those."""
    found = tokens.flatten().dictionary_encode()
    return pc.list_parent_indices(tokens).to_numpy(), found.indices.to_numpy(), found.dictionary


def counted(tokens):
    """Of a column of lists: row, distinct token and count of each token in its row, by row, and the
    distinct tokens."""
    rows, codes, terms = numbered(tokens)
    width = max(len(terms), 1)
    pairs, counts = np.unique(rows.astype(np.int64) * width + codes, return_counts=True)
    return pairs // width, pairs % width, counts, terms
