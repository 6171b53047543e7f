"""N-gram Jaccard join by chosen paths.

Texts become sets of five-word shingles; documents with equal sets are one node. A set's min-hash
tokens (coordinate, value) stand for it: two sets share a token with a probability equal to their
Jaccard similarity. One run is a tree over the nodes: every tree node samples, from its own path,
one or two of the coordinates (1 / similarity on average) and splits its sets by their tokens
there; a part with one set is dropped, a small one is compared by brute force, a large one is
split again. Parts that are still large after ``DEPTH`` levels are compared block by block, whole.
Runs repeat until a pair at the threshold, on a path of full depth, is met with the target recall.

What brute force lets through (an estimate from the tokens, well below the threshold) joins nodes
into candidate classes. Inside those, all pairs are verified on the shingles themselves, in blocks,
so that classes and numbers of links are exact for what the trees have brought together.

Words are runs of letters and digits (and all beyond ASCII) of the lower-cased text. Cases: a text
of one to four words has one shingle, of all of them; texts without words (null, empty) have equal,
empty sets and are one class; repeated rows are documents of their own with equal sets; null ids
are documents like others; an empty table gives an empty result; only named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabular_spark.llm.common import as_record, removed, stored, text_of

WORDS, SIMILARITY = 5, 0.8
#: Min-hash tokens of a set.
TOKENS = 64
#: Levels of a tree; sets in a part that is compared at once.
DEPTH, LEAF = 3, 100
RECALL = 0.999
#: Pairs whose share of equal tokens is this much below the threshold are still verified (over 4 standard deviations).
MARGIN = 0.2
#: Nodes of a candidate class that are verified against each other in one task are two blocks of this size.
BLOCK = 128
#: Nodes in a block of a part that is still large at full depth; only tokens are compared there, so two such blocks are about a megabyte.
PART_BLOCK = 2048
CHUNK = 4 << 20


def mixed_bits(x):
    """A bijection of 64-bit numbers that spreads their bits."""
    import numpy as np

    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)


def shingles(texts: list[str], words: int = WORDS) -> tuple[Any, Any]:
    """Hashes of all shingles of the texts, one after the other, and how many each text has."""
    import numpy as np

    encoded = [x.lower().encode() for x in texts]
    raw = np.frombuffer(b" ".join(encoded) + b" ", np.uint8)
    ends = np.cumsum([len(x) + 1 for x in encoded])
    inside = (raw >= 128) | ((raw >= 97) & (raw <= 122)) | ((raw >= 48) & (raw <= 57))
    change = np.flatnonzero(np.diff(np.concatenate(([False], inside)).astype(np.int8)))
    first, last = change[::2], change[1::2]
    number = np.bincount(np.searchsorted(ends, first, "right"), minlength=len(texts))
    if not len(first):
        return np.zeros(0, np.uint64), number
    code = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64)
    start = np.zeros(len(raw), np.int64)
    start[first] = first
    place = (np.arange(len(raw)) - np.maximum.accumulate(start)).astype(np.uint64)
    weighted = np.where(inside, code[raw] * (place * np.uint64(2) + np.uint64(1)), np.uint64(0))
    word = mixed_bits(np.add.reduceat(weighted, first))
    factor = np.random.default_rng(13).integers(1, 1 << 62, words, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    padded = np.concatenate((word, np.zeros(words, np.uint64)))
    begin = np.cumsum(number) - number
    count = np.where(number >= words, number - words + 1, (number > 0).astype(number.dtype))
    of = np.repeat(np.arange(len(texts)), count)
    at = begin[of] + np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
    out = np.zeros(len(of), np.uint64)
    for k in range(words):
        out += np.where(k < number[of], padded[at + k] * factor[k], np.uint64(0))
    return mixed_bits(out), count


def sketch(texts: list[str], words: int, tokens: int) -> tuple[list[bytes], list[int], Any]:
    """Per text: a digest of its set, the set's size, and its min-hash tokens."""
    import hashlib

    import numpy as np

    all_, count = shingles(texts, words)
    ends = np.cumsum(count)
    digests, sizes = [], []
    for a, b in zip(ends - count, ends):
        own = np.unique(all_[a:b])
        sizes.append(len(own))
        digests.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
    out = np.zeros((len(texts), tokens), np.int32)
    full = np.flatnonzero(count)
    if len(full):
        draw = np.random.default_rng(17)
        starts = (ends - count)[full]
        for t in range(tokens):
            xor, factor = draw.integers(0, 1 << 63, 2, dtype=np.uint64)
            hashed = ((all_ ^ xor) * (factor | np.uint64(1)) >> np.uint64(32)).astype(np.uint32)
            out[full, t] = np.minimum.reduceat(hashed, starts).view(np.int32)
    return digests, sizes, out


def chunks(column, most: int = CHUNK) -> Iterator[list[str]]:
    run, size = [], 0
    for value in column:
        run.append(text := value.as_py() or "")
        size += len(text)
        if size >= most:
            yield run
            run, size = [], 0
    if run:
        yield run


def sketches(docs: DataFrame, id_col: str, text_col: str, words: int, tokens: int) -> DataFrame:
    """(doc_id, hash, digest, size, tokens) of every document; ``hash`` is the text's."""
    text = text_of(text_col)
    slim = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("hash"), text.alias("text"))

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            done = 0
            for texts in chunks(batch.column(2)):
                digests, sizes, found = sketch(texts, words, tokens)
                ends = pa.array(np.arange(len(texts) + 1, dtype=np.int32) * tokens)
                columns = [batch.column(0).slice(done, len(texts)), batch.column(1).slice(done, len(texts)), pa.array(digests, pa.binary()), pa.array(sizes, pa.int32()), pa.ListArray.from_arrays(ends, pa.array(found.reshape(-1)))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "hash", "digest", "size", "tokens"])
                done += len(texts)

    return slim.mapInArrow(run, f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, hash long, digest binary, size int, tokens array<int>")


def complete_groups(batches: Iterator, key: int = 0) -> Iterator:
    """Arrow tables that hold whole groups, from batches sorted by a long key column."""
    import numpy as np
    import pyarrow as pa

    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        keys = table.column(key).to_numpy()
        cut = int(np.flatnonzero(keys != keys[-1])[-1]) + 1 if keys[0] != keys[-1] else 0
        if cut:
            yield table.slice(0, cut).combine_chunks()
        rest = table.slice(cut)
    if rest is not None:
        yield rest.combine_chunks()


def least_joined(n: int, a, b):
    """For each of n things the least one that it is joined with, over any number of the pairs (a, b)."""
    import numpy as np

    least = np.arange(n)
    while True:
        new = least.copy()
        np.minimum.at(new, a, least[b])
        np.minimum.at(new, b, least[a])
        new = new[new]
        if (new == least).all():
            return least
        least = new


def brute_force(least_share: float, size_ratio: float, tokens: int):
    """Edges (node, least node it is joined with) from parts: rows (part, node, size, tokens, side, whole), sorted by part.

    All pairs of a part are compared. Where a part is two blocks of a larger one (not ``whole``),
    each block is a whole part as well, so only what joins the two blocks is told: one edge for
    two groups, not one for each node. Edges of all parts in a batch become one forest.
    """

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for table in complete_groups(batches):
            part, node, size = (table.column(i).to_numpy() for i in range(3))
            marks = table.column(3).combine_chunks().flatten().to_numpy().reshape(-1, tokens)
            side, whole = table.column(4).to_numpy(), table.column(5).to_numpy(zero_copy_only=False)
            order = np.lexsort((node, part))
            part, node, size, marks, side, whole = (x[order] for x in (part, node, size, marks, side, whole))
            found_a, found_b, k = [], [], 1
            at = np.arange(len(part))
            while True:
                at = at[: np.searchsorted(at, len(part) - k)]
                at = at[part[at] == part[at + k]]
                if not len(at):
                    break
                low, high = np.minimum(size[at], size[at + k]), np.maximum(size[at], size[at + k])
                near = at[low >= size_ratio * high]
                near = near[(marks[near] == marks[near + k]).sum(1) >= least_share * tokens]
                found_a.append(near)
                found_b.append(near + k)
                k += 1
            if not found_a:
                continue
            a, b = np.concatenate(found_a), np.concatenate(found_b)
            least, every = least_joined(len(part), a, b), np.arange(len(part))
            known = ~whole[a] & (side[a] == side[b])
            inner = least_joined(len(part), a[known], b[known])
            joined = np.flatnonzero((least != every) & (inner == every))
            if len(joined):
                names, places = np.unique(np.concatenate((node[joined], node[least[joined]])), return_inverse=True)
                forest = least_joined(len(names), places[: len(joined)], places[len(joined) :])
                rest = np.flatnonzero(forest != np.arange(len(names)))
                yield pa.RecordBatch.from_arrays([pa.array(names[rest]), pa.array(names[forest[rest]])], ["a", "b"])

    return run


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for all nodes of the edges (a, b): the least node that they reach.

    Large-star and small-star steps in turn, each a few shuffles of the edges, until nothing
    changes. An edge always points to the smaller node.
    """

    def down(a: str, b: str) -> list:
        return [F.greatest(a, b).alias("a"), F.least(a, b).alias("b")]

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())

    now = stored(edges.select(*down("a", "b")).where("a != b").distinct(), "edges")
    last, state = None, mark(now)
    while state != last:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("root"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("root").alias("b")).distinct()
        root = large.groupBy("a").agg(F.min("b").alias("root"))
        each = large.join(root, "a")
        small = each.where("b != root").select(F.col("b").alias("a"), F.col("root").alias("b")).unionByName(each.select("a", F.col("root").alias("b")))
        after = stored(small.select(*down("a", "b")).where("a != b").distinct(), "edges")
        last, state = state, mark(after)
        removed(now)
        now = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def runs_needed(recall: float = RECALL, similarity: float = SIMILARITY, depth: int = DEPTH) -> int:
    """Runs after which a pair at the threshold, parted by no level of full depth, is met with the recall."""
    one, two = similarity, 1 - (1 - similarity) ** 2
    split = 1 / similarity - 1  # how often a tree node samples a second coordinate
    level = one * (1 - split) + two * split
    return math.ceil(math.log(1 - recall) / math.log(1 - level**depth))


def candidate_edges(nodes: DataFrame, similarity: float, recall: float, tokens: int) -> DataFrame:
    """Edges (a, b) between nodes (node, size, tokens) that the trees bring together."""
    runs = runs_needed(recall, similarity)
    second = int((1 / similarity - 1) * 1000)
    slim = nodes.select("node", "size", "tokens")
    paths = F.explode(F.transform(F.sequence(F.lit(1), F.lit(runs)), lambda r: F.xxhash64(r)))
    now = slim.select("node", "size", "tokens", paths.alias("path"))
    compare = brute_force(similarity - MARGIN, similarity * 0.9, tokens)
    edges = None
    for level in range(1, DEPTH + 1):
        coordinate = [F.pmod(F.xxhash64("path", F.lit(i)), F.lit(tokens)).cast("int") for i in range(2)]
        other = (F.pmod(F.xxhash64("path", F.lit("second")), F.lit(1000)) < second) & (coordinate[0] != coordinate[1])
        parts = F.filter(F.array(coordinate[0], F.when(other, coordinate[1])), lambda c: c.isNotNull())
        split = now.withColumn("c", F.explode(parts)).select("node", F.xxhash64("path", "c", F.element_at("tokens", F.col("c") + 1)).alias("part"))
        sizes = split.groupBy("part").agg(F.count("*").alias("members")).where("members > 1")
        kept = stored(split.join(sizes, "part").join(slim, "node"), f"paths-{level}")
        small = kept.where(F.col("members") <= LEAF).withColumn("side", F.lit(0)).withColumn("whole", F.lit(True))
        large = kept.where(F.col("members") > LEAF)
        if level == DEPTH:
            blocks = F.ceil(F.col("members") / PART_BLOCK).cast("int")
            pairs = large.withColumn("side", F.pmod(F.xxhash64("node"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
            pairs = pairs.withColumn("part", F.xxhash64("part", F.least("side", "other"), F.greatest("side", "other"))).withColumn("whole", F.col("side") == F.col("other"))
            small = small.unionByName(pairs.select(*small.columns))
        found = small.select("part", "node", "size", "tokens", "side", "whole").repartition("part").sortWithinPartitions("part").mapInArrow(compare, "a long, b long")
        edges = found if edges is None else edges.unionByName(found)
        now = large.select("node", "size", "tokens", F.col("part").alias("path"))
    return edges.distinct()


def verified(members: DataFrame, words: int, similarity: float) -> DataFrame:
    """(node, least, links) for rows (part, node, weight, text, side, whole), per part.

    Pairs of the two sides of a part are compared, or all its pairs if it is ``whole``.
    """

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for table in complete_groups(batches):
            parts = table.column(0).to_numpy()
            starts = np.flatnonzero(np.concatenate(([True], parts[1:] != parts[:-1])))
            out: list[list] = [[], [], []]
            for a, b in zip(starts, [*starts[1:], len(parts)]):
                group = table.slice(a, b - a)
                node, weight, side = (group.column(i).to_numpy() for i in (1, 2, 4))
                all_, count = shingles(group.column(3).to_pylist(), words)
                of = np.repeat(np.arange(b - a), count)
                vocabulary, token = np.unique(all_, return_inverse=True)
                keys = np.unique(token.astype(np.int64) * (b - a) + of)
                token, of = np.divmod(keys, b - a)
                size = np.bincount(of, minlength=b - a)
                common = np.zeros((b - a, b - a), np.float32)
                for low in range(0, len(vocabulary), 4096):
                    i, j = np.searchsorted(token, (low, low + 4096))
                    holds = np.zeros((b - a, min(4096, len(vocabulary) - low)), np.float32)
                    holds[of[i:j], token[i:j] - low] = 1
                    common += holds @ holds.T
                # in whole numbers, so that a similarity of just the threshold counts
                linked = common * 1000 >= round(similarity * 1000) * (size[:, None] + size[None, :] - common)
                np.fill_diagonal(linked, False)
                if not group.column(5)[0].as_py():
                    linked &= side[:, None] != side[None, :]
                least = least_joined(b - a, *np.nonzero(linked))
                # the least by number of node
                low = np.full(b - a, np.iinfo(np.int64).max)
                np.minimum.at(low, least, node)
                out[0].append(node)
                out[1].append(low[least])
                out[2].append(linked @ weight)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in out], ["node", "least", "links"])

    columns = members.select("part", "node", "weight", "text", "side", "whole")
    return columns.repartition("part").sortWithinPartitions("part").mapInArrow(run, "node long, least long, links long")


def jaccard_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, similarity: float = SIMILARITY, recall: float = RECALL, tokens: int = TOKENS
) -> DataFrame:
    """(doc_id, hash, class, class_id, links) of every document.

    ``class`` is the least (doc_id, hash) of the class, ``class_id`` its doc_id, ``links`` the
    number of other documents at ``similarity`` or more, copies included.
    """
    drawn = stored(sketches(docs, id_col, text_col, words, tokens), "sketches")
    first = F.min(F.struct("doc_id", "hash")).alias("first")
    nodes = drawn.groupBy("digest").agg(first, F.count("*").alias("weight"), F.first("size").alias("size"), F.first("tokens").alias("tokens"))
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    edges = candidate_edges(nodes.where("size > 0"), similarity, recall, tokens)
    classes = stored(components(edges), "candidates")

    def block(of: str, members: str):
        return F.pmod(F.xxhash64(of), F.ceil(F.col(members) / BLOCK))

    sizes = classes.groupBy("root").agg(F.count("*").alias("members"))
    found = classes.join(sizes, "root").join(nodes.select("node", "first", "weight"), "node")
    text = text_of(text_col)
    texts = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text).alias("_hash"), text.alias("text"))
    found = found.join(texts, F.col("first.doc_id").eqNullSafe(F.col("_id")) & (F.col("first.hash") == F.col("_hash"))).dropDuplicates(["node"])
    side = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    found = found.withColumn("blocks", F.ceil(F.col("members") / BLOCK)).withColumn("side", side)
    found = found.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1)))
    part = F.xxhash64("root", F.least("side", "other"), F.greatest("side", "other"))
    # a block meets each other one, and itself
    found = found.select(part.alias("part"), "node", "weight", "text", "side", (F.col("side") == F.col("other")).alias("whole"))
    checked = stored(verified(found, words, similarity), "verified")
    links = checked.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(checked.where("node != least").select(F.col("node").alias("a"), F.col("least").alias("b")))
    firsts = nodes.select("node", "digest", "first", "weight")
    each = firsts.join(links, "node", "left").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    each = stored(each, "node-classes")
    heads = each.where("links > 0").groupBy("root").agg(F.min("first").alias("class"))
    each = each.join(heads, "root", "left").select("digest", F.coalesce("class", "first").alias("class"), (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("links"))
    return drawn.select("doc_id", "hash", "digest").join(each, "digest").select("doc_id", "hash", "class", F.col("class.doc_id").alias("class_id"), "links")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with the first document, by id, of each class; all columns kept."""
    found = stored(jaccard_classes(docs, id_col, text_col, **options), "classes")
    kept = F.col("doc_id").eqNullSafe(F.col("class.doc_id")) & (F.col("hash") == F.col("class.hash"))
    keys = [F.col("doc_id").alias("_id"), F.col("hash").alias("_hash")]
    drop = found.where(~kept).select(*keys).distinct()
    again = found.where(kept).groupBy(*keys).count().where("count > 1").drop("count")

    def match(df: DataFrame, other: DataFrame, how: str) -> DataFrame:
        return df.join(other, df["id"].eqNullSafe(other["_id"]) & (df["text_hash"] == other["_hash"]), how)

    left = match(as_record(docs, id=F.col(id_col), text_hash=F.xxhash64(text_of(text_col))), drop, "left_anti")
    if not again.isEmpty():  # rows that repeat a kept one in id and text
        again = stored(again, "classes-repeats")
        left = match(left, again, "left_anti").unionByName(match(left, again, "left_semi").dropDuplicates(["id", "text_hash"]))
    return left.select("record.*")


def op1(docs: DataFrame) -> DataFrame:
    return jaccard_classes(docs).select("doc_id", "class_id", "links")
