"""N-gram Jaccard join by chosen paths.

Texts are sets of five-word shingles; equal sets are one vertex. In each run a set goes down
the paths of tokens that it samples (each with probability 1 / (0.8 * its size), decided by a
hash of path and token, so that similar sets sample the same ones). A path held by few sets is
brute-forced on sketches; one held by many is split again by another sampled token, and at the
last level in blocks. Two sets of similarity 0.8 or more stay together in a run at level k with
probability at least q(k), q(0) = 1, q(k) = 1 - exp(-q(k - 1)); `runs_for` repeats runs until
the wanted recall is reached at the last level.

The pairs so found only make candidate classes (connected components). Each candidate class is
then compared exactly on its whole sets, in blocks of bounded size, which gives the number of
links of each document and the final classes. No pair is written: blocks give a count per set
and a spanning forest.

Texts of fewer than five words are one shingle of all their words; null texts and texts without
a word are classes of their own, without links. Rows that share a doc_id are told apart by
their text, equal rows count as copies. Null doc_ids are allowed; the class id is the smallest
doc_id of the class, null only if it has none.
"""

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from repotide.llm.common import map_rows
from repotide.llm.components import components
from repotide.llm.shingles import Hasher, mixed
from repotide.scratch import write_table

SIMILARITY = 0.8
RECALL = 0.999
#: Levels of recursion; sets that share a path of so many tokens are compared in blocks.
LEVELS = 3
#: A path that more sets share is split again; the last level is compared in blocks of this many.
BUCKET, BLOCK_SKETCHES = 512, 4096
#: Shingles in a block of the exact comparison, besides at most BUCKET sets.
BLOCK_SHINGLES = 400_000
#: Bits of the filter that picks the texts of some documents: 16 MB, whatever their number.
HEAD_BITS = 1 << 27
#: Bins of a sketch, one byte each.
BINS = 256
#: Standard deviations that a sketch may fall short of the threshold.
SLACK = 4.0
SETS_DDL = "doc_id long, key string, size int, sketch binary, paths array<long>"


def runs_for(recall=RECALL, levels=LEVELS):
    q = 1.0
    for _ in range(levels):
        q = 1 - math.exp(-q)
    return math.ceil(math.log(1 - recall) / math.log(1 - q))


def chosen(path, tokens, similarity=SIMILARITY):
    """The children of `path` that a set goes down to: one number for each sampled token."""
    at = np.array([path], np.int64).view(np.uint64)
    odd = mixed(at) | np.uint64(1)
    draws = mixed(tokens * odd + at)
    share = 1.0 / (similarity * len(tokens))
    if share < 1:
        draws = draws[draws < np.uint64(int(share * 2.0**64))]
    return mixed(draws + odd).view(np.int64).tolist()


def sketch_of(tokens):
    """Smallest token of each bin (by leading byte) as one byte; 0 is an empty bin."""
    bins, first = np.unique((tokens >> np.uint64(56)).astype(np.int64), return_index=True)
    out = np.zeros(BINS, np.uint8)
    out[bins] = 1 + (mixed(tokens[first]) % np.uint64(255)).astype(np.uint8)
    return out.tobytes()


def key_of(tokens):
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).hexdigest()


def sets_of(docs, similarity, runs):
    def make():
        hasher = Hasher()

        def each(doc_id, text):
            tokens = hasher.shingles(text)
            if not len(tokens):
                yield doc_id, None, 0, None, None
            else:
                paths = sorted({p for r in range(runs) for p in chosen(r + 1, tokens, similarity)})
                yield doc_id, key_of(tokens), len(tokens), sketch_of(tokens), paths

        return each

    return map_rows(docs.select("doc_id", "text"), make, SETS_DDL)


def likely(a, b, size_a, size_b, similarity):
    """Whether pairs of sketches (rows) may belong to sets of the wanted similarity."""
    same = ((a == b) & (a > 0)).sum(1)
    used = ((a > 0) | (b > 0)).sum(1)
    union = (size_a + size_b) / (1 + similarity)
    spread = similarity * (1 - similarity) * np.maximum(0, 1 - used / union) / used
    fits = np.minimum(size_a, size_b) >= similarity * np.maximum(size_a, size_b)
    return fits & (same >= (similarity - SLACK * np.sqrt(spread)) * used - 1.0)


def forest(n, near):
    """Breadth-first forest over rows 0..n-1: root of each. near(row, others) -> mask."""
    root = np.full(n, -1)
    for start in range(n):
        if root[start] >= 0:
            continue
        root[start] = start
        queue = [start]
        while queue:
            left = np.flatnonzero(root < 0)
            if not len(left):
                return root
            row = queue.pop()
            met = left[near(row, left)]
            root[met] = start
            queue += met.tolist()
    return root


def groups_of(batches, names):
    """Lists of rows with equal first columns from sorted batches, group by group."""
    group, held = None, []
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for row in zip(*columns, strict=True):
            if row[:names] != group:
                if held:
                    yield group, held
                group, held = row[:names], []
            held.append(row[names:])
    if held:
        yield group, held


def _edges(similarity):
    """mapInArrow over sorted (group, key, block, size, sketch): edges of a forest of likely pairs.

    A group of two blocks only reports what joins components of one block to those of the other.
    """

    def run(batches):
        out_u, out_v = [], []
        for _, rows in groups_of(batches, 1):
            rows = list({r[0]: r for r in rows}.values())
            if len(rows) < 2:
                continue
            blocks = np.array([r[1] for r in rows])
            sizes = np.array([r[2] for r in rows])
            sketches = np.frombuffer(b"".join(bytes(r[3]) for r in rows), np.uint8).reshape(-1, BINS)

            def roots(at):
                own, own_sizes = sketches[at], sizes[at]  # noqa: B023
                near = lambda row, others: likely(own[others], own[row][None], own_sizes[others], own_sizes[row], similarity)
                return at[forest(len(at), near)]

            ends = np.arange(len(rows))
            if blocks.min() != blocks.max():
                inside = [np.flatnonzero(blocks == b) for b in (blocks.min(), blocks.max())]
                ends = np.unique(np.concatenate([roots(at) for at in inside]))
            whole = roots(np.arange(len(rows)))
            for k in ends[whole[ends] != ends].tolist():
                out_u.append(rows[k][0])
                out_v.append(rows[whole[k]][0])
            if len(out_u) > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(out_u), pa.array(out_v)], ["u", "v"])
                out_u, out_v = [], []
        if out_u:
            yield pa.RecordBatch.from_arrays([pa.array(out_u), pa.array(out_v)], ["u", "v"])

    return run


def _place(column):
    """Number of a doc_id's bit among HEAD_BITS, counted from 1 as Spark's bitmaps do."""
    return F.pmod(F.xxhash64(column), F.lit(HEAD_BITS)) + 1


def _maybe_among(texts, heads):
    """Rows of `texts` whose _doc may be one of `heads`: a bitmap of HEAD_BITS hashed bits, in
    pieces of 4 KB, is broadcast. A row that is none of them stays only if it shares a bit."""
    place = _place(heads.columns[0])
    bits = heads.groupBy(F.bitmap_bucket_number(place).alias("_piece")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("_bits")
    )
    at = F.bitmap_bit_position(_place("_doc")).cast("int")
    byte = F.conv(F.hex(F.expr("substring(_bits, _at div 8 + 1, 1)")), 16, 10).cast("int")
    marked = texts.withColumns({"_piece": F.bitmap_bucket_number(_place("_doc")), "_at": at})
    # At most HEAD_BITS / 8 bytes.
    found = marked.join(F.broadcast(bits), "_piece")
    return found.where(F.getbit(byte, F.col("_at") % 8) == 1).drop("_piece", "_at", "_bits")


def texts_of(docs, members):
    """`members` (key, head, ...) with the text of a document that has the set `key`. Texts of
    documents that are no heads are left out before anything is shuffled."""
    members = write_table(members, "members")
    texts = _maybe_among(docs.select(F.col("doc_id").alias("_doc"), "text"), members.select("head"))
    return members.join(texts, F.col("head").eqNullSafe(F.col("_doc"))).drop("_doc")


def _children(docs, crowded, similarity):
    """The next level of crowded nodes: (node, key), from (node, key, head)."""
    paths = crowded.groupBy("key", "head").agg(F.collect_list("node").alias("nodes"))

    def make():
        hasher = Hasher()

        def each(key, nodes, text):
            tokens = hasher.shingles(text)
            if len(tokens) and key_of(tokens) == key:
                for node in nodes:
                    for child in chosen(node, tokens, similarity):
                        yield child, key

        return each

    rows = texts_of(docs, paths).select("key", "nodes", "text")
    return map_rows(rows, make, "node long, key string").distinct()


def blocks_of(number, weight):
    """Explodes rows into pairs of blocks: one group per pair (i <= j) that the row's block is in."""
    block = F.pmod(F.xxhash64("key", F.lit(weight)), number).cast("int")
    others = F.sequence(F.lit(0), (number - 1).cast("int"))
    return block, F.explode(
        F.transform(others, lambda o: F.struct(F.least(block, o).alias("i"), F.greatest(block, o).alias("j")))
    )


def candidate_edges(docs, sets, similarity, levels):
    """Edges (u, v) whose components hold all sets that met on a path and have like sketches."""
    nodes = sets.select(F.explode("paths").alias("node"), "key")
    edges = None
    for level in range(1, levels + 1):
        counts = nodes.groupBy("node").agg(F.count("*").alias("n")).where("n > 1")
        nodes = write_table(nodes.join(counts, "node"), "nodes")
        crowded = nodes.where(F.col("n") > BUCKET)
        last = level == levels or crowded.isEmpty()
        bucket = nodes if last else nodes.where(F.col("n") <= BUCKET)
        full = bucket.join(sets.select("key", "size", "sketch"), "key")
        block, pair = blocks_of(F.ceil(F.col("n") / BLOCK_SKETCHES), level)
        full = full.select("node", "key", block.alias("block"), "size", "sketch", pair.alias("pair"))
        group = F.xxhash64("node", "pair.i", "pair.j").alias("group")
        rows = full.select(group, "key", "block", "size", "sketch").repartition("group").sortWithinPartitions("group")
        found = write_table(rows.mapInArrow(_edges(similarity), "u string, v string").distinct(), "candidates")
        edges = found if edges is None else edges.unionAll(found)
        if last:
            return edges
        heads = sets.select("key", "head")
        nodes = write_table(_children(docs, crowded.select("node", "key").join(heads, "key"), similarity), "nodes")
    return edges


def intersections(rows):
    """Matrix of the numbers of common tokens of all pairs of sorted arrays."""
    n = len(rows)
    owner = np.repeat(np.arange(n), [len(r) for r in rows])
    _, number, times = np.unique(np.concatenate(rows), return_inverse=True, return_counts=True)
    shared = times[number] > 1
    owner, number = owner[shared], number[shared]
    order = np.argsort(number, kind="stable")
    owner, number = owner[order], number[order]
    _, number = np.unique(number, return_inverse=True)
    out = np.zeros((n, n), np.float32)
    width = max(64, (8 << 20) // (4 * n))
    top = int(number[-1]) + 1 if len(number) else 0
    for at in range(0, top, width):
        a, b = np.searchsorted(number, [at, at + width])
        part = np.zeros((n, min(width, top - at)), np.float32)
        part[owner[a:b], number[a:b] - at] = 1
        out += part @ part.T
    return out


def _compared(similarity):
    """mapInArrow over sorted (root, i, j, key, block, copies, tokens): links and forest."""

    def run(batches):
        for (_, i, j), rows in groups_of(batches, 3):
            rows = list({r[0]: r for r in rows}.values())
            tokens = [np.frombuffer(bytes(r[3]), np.uint64) for r in rows]
            sizes = np.array([len(t) for t in tokens], np.float64)
            copies = np.array([r[2] for r in rows], np.int64)
            blocks = np.array([r[1] for r in rows])
            common = intersections(tokens)
            linked = common * (1 + similarity) >= similarity * (sizes[:, None] + sizes) - 1e-6
            np.fill_diagonal(linked, False)
            if i != j:  # pairs inside a block belong to the group of that block
                linked &= blocks[:, None] != blocks
            links = linked @ copies
            root = forest(len(rows), lambda row, others: linked[row, others])  # noqa: B023
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows]), pa.array(links, pa.int64()), pa.array([rows[r][0] for r in root])],
                ["key", "links", "root"],
            )

    return run


def exact_links(docs, sets, classes, similarity):
    """(key, links, root) of candidate classes (vertex, root), compared on their whole sets."""
    roots = classes.select(F.col("root").alias("vertex"), "root").distinct()
    members = classes.unionAll(roots).join(sets.select("key", "head", "size", "copies"), F.col("vertex") == F.col("key"))
    sizes = members.groupBy("root").agg(
        F.greatest(F.ceil(F.count("*") / BUCKET), F.ceil(F.sum("size") / BLOCK_SHINGLES)).alias("number")
    )
    members = texts_of(docs, members.join(sizes, "root").select("root", "key", "head", "copies", "number"))

    def make():
        hasher = Hasher()

        def each(root, key, copies, number, text):
            tokens = hasher.shingles(text)
            if len(tokens) and key_of(tokens) == key:
                yield root, key, copies, number, tokens.tobytes()

        return each

    ddl = "root string, key string, copies long, number long, tokens binary"
    rows = map_rows(members.select("root", "key", "copies", "number", "text"), make, ddl)
    block, pair = blocks_of(F.col("number"), "exact")
    rows = rows.select("root", block.alias("block"), "key", "copies", "tokens", pair.alias("pair"))
    rows = rows.select("root", F.col("pair.i"), F.col("pair.j"), "key", "block", "copies", "tokens")
    rows = rows.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j")
    return rows.mapInArrow(_compared(similarity), "key string, links long, root string")


def similar_classes(docs, similarity=SIMILARITY, recall=RECALL, levels=LEVELS):
    """doc_id, class_id, n_links (documents of similarity 0.8 or more), n_copies of each row."""
    documents = write_table(sets_of(docs, similarity, runs_for(recall, levels)), "sets")
    with_words = documents.where("key is not null")
    sets = with_words.groupBy("key").agg(
        F.min("doc_id").alias("head"),
        F.count("*").alias("copies"),
        F.first("size").alias("size"),
        F.first("sketch").alias("sketch"),
        F.first("paths").alias("paths"),
    )
    sets = write_table(sets, "distinct-sets")
    classes = components(candidate_edges(docs, sets, similarity, levels))
    compared = write_table(exact_links(docs, sets, classes, similarity), "links")
    links = compared.groupBy("key").agg(F.sum("links").alias("links"))
    final = components(compared.select(F.col("key").alias("u"), F.col("root").alias("v")))
    rows = (
        sets.select("key", "head", "copies")
        .join(links, "key", "left")
        .join(final.select(F.col("vertex").alias("key"), "root"), "key", "left")
        .withColumn("root", F.coalesce("root", "key"))
    )
    heads = rows.groupBy("root").agg(F.min("head").alias("class_id"))
    rows = rows.join(heads, "root").select("key", "class_id", "copies", F.coalesce("links", F.lit(0)).alias("links"))
    return documents.select("doc_id", "key").join(rows, "key", "left").select(
        "doc_id",
        F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce(F.col("links") + F.col("copies") - 1, F.lit(0)).alias("n_links"),
        F.coalesce("copies", F.lit(1)).alias("n_copies"),
    )
