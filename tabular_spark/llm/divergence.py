"""Divergence of sources: how far the term shares of one group are from those of another.

Term counts are added up inside of each task before anything is shuffled. The terms that a
language keeps are numbered in order, and each (language, source) group gets one sorted array of
(term id, share) per block of term ids, so that no array exceeds a block. Groups are dealt in
tiles; for each unordered pair of tiles and each block, one task co-groups the arrays of both,
intersects them two by two by a galloping search, and prices overlaps and one-sided terms both
ways. Terms absent on both sides all cost the same, so they need only be counted, once per pair.

Shares are integers, p = 1 + floor(10^9 (count + 1) / (N + V)), N the group's occurrences of kept
terms and V their number; a term's price is floor((p - q)^2 / q). All arithmetic is exact.

Cases: null texts, languages and sources count as empty texts; every row is a document, also
repeated ones; texts of any length are read piece by piece; groups without kept terms have N = 0;
a language without kept terms has pairs of value 0 and no terms; equal values are ranked by item;
an empty table gives an empty result; other columns are never read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabular_spark.llm.common import ranked, stored

#: Scale of the shares.
SHARE = 1_000_000_000
#: Term ids in a block, and groups in a tile: a pair task holds two tiles' arrays of one block.
BLOCK, TILE = 1 << 16, 16
#: Distinct terms that a task holds before it gives them out, and text bytes that it takes apart at once.
HELD, PIECE = 400_000, 1 << 20
#: Up to so many groups (some hundred bytes each) are broadcast; more are joined by a shuffle.
BROADCAST_GROUPS = 100_000


def term_table() -> bytes:
    """For each byte: itself where it is part of a term, A-Z as a-z, and a space where it separates."""
    letter = [97 <= b <= 122 or b >= 128 for b in range(256)]
    return bytes(b if letter[b] else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def pieces(text: bytes, most: int = PIECE) -> Iterator[list[bytes]]:
    """The terms of a text of spaces and terms, some at a time; no term is cut."""
    at = 0
    while at < len(text):
        end = text.find(b" ", at + most) if at + most < len(text) else -1
        yield text[at : end if end >= 0 else len(text)].split()
        at = end if end >= 0 else len(text)


def term_counts(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents; each group has a row of the empty term, with zeros."""
    slim = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).cast("binary").alias(a) for c, a in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    names = ["lang", "source", "term"]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        table = term_table()
        held: dict[tuple, tuple[Counter, Counter]] = {}

        def out() -> Iterator:
            for (lang, source), (occurrences, documents) in held.items():
                terms = [b"", *occurrences]
                columns = [[lang] * len(terms), [source] * len(terms), terms, [0, *occurrences.values()], [0, *(documents[t] for t in occurrences)]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.binary()] * 3 + [pa.int64()] * 2)], [*names, "n", "docs"])
            held.clear()

        for batch in batches:
            langs, sources, texts = (batch.column(i) for i in range(3))
            for i in range(batch.num_rows):
                occurrences, documents = held.setdefault((langs[i].as_py(), sources[i].as_py()), (Counter(), Counter()))
                here: set[bytes] = set()
                for terms in pieces(texts[i].as_py().translate(table)):
                    occurrences.update(terms)
                    here.update(terms)
                documents.update(here)
                if i % 64 == 0 and sum(len(x[0]) for x in held.values()) > HELD:
                    yield from out()
        yield from out()

    found = slim.mapInArrow(run, "lang binary, source binary, term binary, n long, docs long")
    return found.groupBy(*names).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")).select(*[F.col(c).cast("string").alias(c) for c in names], "n", "docs")


def share(count: Column, total: Column, kept: Column) -> Column:
    """p of ``count``, null where no term is kept; the product may exceed 64 bits."""
    up = F.lit(SHARE).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)")
    return F.when(kept > 0, quotient(up, (total + kept).cast("decimal(20,0)")) + 1)


def price(p: Column, q: Column) -> Column:
    return quotient((p - q) * (p - q), q)


def quotient(up: Column, down: Column) -> Column:
    """The whole part of a quotient of whole numbers, exact (SQL's ``div``)."""
    return F.call_function("div", up, down)


def gallop(small, large, run: int = 256):
    """For each of ``small`` its place in ``large``, or -1; both ascending. The search doubles its step from the last place found."""
    import numpy as np

    at, out = 0, np.full(len(small), -1, np.int64)
    for start in range(0, len(small), run):
        part = small[start : start + run]
        step, end = run, at
        while end < len(large) and large[end] <= part[-1]:
            end = min(len(large), end + step)
            step *= 2
        if at == end:
            if at == len(large):
                break
            continue
        place = at + np.searchsorted(large[at:end], part)
        inside = place < end
        hit = np.zeros(len(part), bool)
        hit[inside] = large[place[inside]] == part[inside]
        out[start : start + len(part)][hit] = place[hit]
        at = int(place[-1])
    return out


def priced(p, q):
    return (p - q) * (p - q) // q


def merged(a, b) -> tuple[int, int, int]:
    """(value of a by b, value of b by a, terms in either) of two (ids, shares, share of an absent term)."""
    import numpy as np

    if len(a[0]) > len(b[0]):
        ba, ab, either = merged(b, a)
        return ab, ba, either
    at = gallop(a[0], b[0])
    in_a, in_b = at >= 0, np.zeros(len(b[0]), bool)
    in_b[at[in_a]] = True
    pa, pb, a0, b0 = a[1], b[1], a[2], b[2]
    ab = priced(pa[in_a], pb[in_b]).sum() + priced(pa[~in_a], b0).sum() + priced(a0, pb[~in_b]).sum()
    ba = priced(pb[in_b], pa[in_a]).sum() + priced(b0, pa[~in_a]).sum() + priced(pb[~in_b], a0).sum()
    return int(ab), int(ba), len(pa) + int((~in_b).sum())


def pair_sums(arrays: DataFrame, tiles: DataFrame) -> DataFrame:
    """(a, b, ab, ba, either) of each unordered pair of a language's groups in each block that either has terms of.

    ``arrays`` are (part, block, tile, last_tile, g, absent, ids, shares), ``tiles`` (part, tile, members): the
    (g, absent) of each tile, also of groups without terms in a block.
    """
    key, columns = ["part", "block", "lo", "hi"], ["g", "absent", "ids", "shares", "others"]
    others = tiles.select(F.col("part").alias("_part"), F.col("tile").alias("_tile"), F.col("members").alias("others"))

    def dealt(rows: DataFrame, mine: str, theirs: str, to: Column) -> DataFrame:
        each = rows.withColumn(mine, F.col("tile")).withColumn(theirs, F.explode(to))
        return each.join(others, (each["part"] == others["_part"]) & (each[theirs] == others["_tile"])).select(*key, *columns).toDF(*key, *columns)

    left = dealt(arrays, "lo", "hi", F.sequence(F.col("tile"), F.col("last_tile")))
    right = dealt(arrays.where("tile > 0"), "hi", "lo", F.sequence(F.lit(0).cast("long"), F.col("tile") - 1))

    def run(keys, ours, theirs):
        import numpy as np
        import pyarrow as pa

        nothing = np.zeros(0, np.int64)

        def side(table, beside) -> dict:
            # what has terms here, and the rest of the tile, which the rows of the other side name
            found = {m["g"]: (nothing, nothing, m["absent"]) for m in (beside["others"][0].as_py() if beside.num_rows else ())}
            for i in range(table.num_rows):
                ids, shares = (table[c][i].values.to_numpy(zero_copy_only=False) for c in ("ids", "shares"))
                found[table["g"][i].as_py()] = (ids, shares, table["absent"][i].as_py())
            return found

        same = keys[2].as_py() == keys[3].as_py()
        first = side(ours, ours if same else theirs)
        second = first if same else side(theirs, ours)
        rows = [(a, b, *merged(x, y)) for a, x in sorted(first.items()) for b, y in sorted(second.items()) if (a < b or not same) and (len(x[0]) or len(y[0]))]
        columns = list(zip(*rows)) or [[]] * 5
        return pa.table([pa.array(list(c), pa.int64()) for c in columns], names=["a", "b", "ab", "ba", "either"])

    parts = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(run, "a long, b long, ab long, ba long, either long")
    return parts.groupBy("a", "b").agg(F.sum("ab").alias("ab"), F.sum("ba").alias("ba"), F.sum("either").alias("either"))


def audited(docs: DataFrame, least_docs: int = 3, top: int = 200, block: int = BLOCK, tile: int = TILE, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(lang, source, part, item, value, rank), as the module says."""
    counts = stored(term_counts(docs, lang_col, source_col, text_col), "term-counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n")).where(F.col("docs") >= least_docs)
    kept = stored(ranked(kept.select("lang", "term", "lang_n"), F.col("lang"), F.col("term"), rank="id"), "kept-terms")
    seen = stored(counts.join(kept, ["lang", "term"]), "kept-counts")
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total"))
    totals = seen.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    named = ranked(counts.select("lang", "source").distinct(), F.col("lang"), F.col("source"), rank="g")
    spans = named.groupBy("lang").agg(F.min("g").alias("part"), F.max("g").alias("last"))
    groups = named.join(spans, "lang").join(langs, "lang", "left").join(totals, ["lang", "source"], "left").na.fill(0, ["v", "lang_total", "total"])
    zero = F.lit(0).cast("long")
    groups = groups.withColumns({"absent": share(zero, F.col("total"), F.col("v")), "tile": F.floor((F.col("g") - F.col("part")) / tile), "last_tile": F.floor((F.col("last") - F.col("part")) / tile)})
    groups = stored(groups, "groups")
    few = groups.count() <= BROADCAST_GROUPS
    rows = seen.join(F.broadcast(groups) if few else groups, ["lang", "source"])
    rows = rows.withColumns({"p": share(F.col("n"), F.col("total"), F.col("v")), "q": share(F.col("lang_n"), F.col("lang_total"), F.col("v")), "block": F.floor(F.col("id") / block)})
    rows = stored(rows.select("lang", "source", "g", "part", "tile", "last_tile", "absent", "block", "id", "term", "p", "q"), "shares")

    arrays = rows.groupBy("part", "block", "tile", "last_tile", "g", "absent").agg(F.sort_array(F.collect_list(F.struct("id", "p"))).alias("t"))
    arrays = arrays.select("part", "block", "tile", "last_tile", "g", "absent", F.col("t.id").alias("ids"), F.col("t.p").alias("shares"))
    tiles = groups.groupBy("part", "tile").agg(F.collect_list(F.struct("g", "absent")).alias("members"))
    sums = stored(pair_sums(stored(arrays, "term-arrays"), tiles), "pair-sums")
    both = sums.select("a", "b", F.col("ab").alias("value"), "either").unionByName(sums.select(F.col("b").alias("a"), F.col("a").alias("b"), F.col("ba").alias("value"), "either"))
    mine = groups.select("lang", "source", "v", F.col("absent").alias("_p"), F.col("g").alias("a"), F.explode(F.sequence("part", "last")).alias("b")).where("a <> b")
    theirs = groups.select(F.col("g").alias("b"), F.col("source").alias("item"), F.col("absent").alias("_q"))
    absent = F.when(F.col("v") > 0, (F.col("v") - F.coalesce("either", zero)) * price(F.col("_p"), F.col("_q"))).otherwise(zero)
    pairs = mine.join(theirs, "b").join(both, ["a", "b"], "left").select("lang", "source", "item", (F.coalesce("value", zero) + absent).alias("value"))

    def ranks(df: DataFrame, *by: str) -> Column:
        return F.row_number().over(Window.partitionBy("lang", "source", *by).orderBy(F.desc("value"), "item"))

    terms = rows.where("p > q").select("lang", "source", "block", F.col("term").alias("item"), price(F.col("p"), F.col("q")).alias("value"))
    # first inside of blocks, so that no task ranks all terms of a group
    best = terms.withColumn("rank", ranks(terms, "block")).where(F.col("rank") <= top).drop("rank", "block")
    out = [df.withColumn("rank", ranks(df)).select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank") for df, part in ((pairs, "pair"), (best, "term"))]
    return out[0].unionByName(out[1].where(F.col("rank") <= top))


def op13(docs: DataFrame) -> DataFrame:
    return audited(docs)


#: DuckDB SQL for ``op13``: every group with every kept term, and every two groups of a language.
ORACLE = f"""
    WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
        w AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
        c AS (SELECT lang, source, term, count(*) AS n FROM w GROUP BY ALL),
        k AS (SELECT lang, term, count(*) AS n FROM w GROUP BY ALL HAVING count(DISTINCT r) >= 3),
        l AS (SELECT lang, count(*) AS v, sum(n) AS n FROM k GROUP BY lang),
        t AS (SELECT c.lang, source, sum(c.n) AS n FROM c JOIN k USING (lang, term) GROUP BY ALL),
        g AS (SELECT x.lang, x.source, coalesce(l.v, 0) AS v, coalesce(t.n, 0) AS n FROM (SELECT DISTINCT lang, source FROM d) x LEFT JOIN l USING (lang) LEFT JOIN t USING (lang, source)),
        p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + ({SHARE}::HUGEINT * (coalesce(c.n, 0) + 1)) // (g.n + g.v) AS p, 1 + ({SHARE}::HUGEINT * (k.n + 1)) // (l.n + l.v) AS q
            FROM g JOIN k USING (lang) JOIN l USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
        pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sum(((x.p - y.p) * (x.p - y.p)) // y.p), 0)::BIGINT AS value
            FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source
            LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term GROUP BY ALL),
        terms AS (SELECT lang, source, 'term' AS part, term AS item, (((p - q) * (p - q)) // q)::BIGINT AS value FROM p WHERE n > 0 AND p > q)
    SELECT lang, source, part, item, value, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank
    FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms) QUALIFY part = 'pair' OR rank <= 200
"""
