"""Document fingerprints by consistent weighted sampling, with DataFrame operations only.

The terms of a document are its words, lower-cased, weighted by how often they stand in it. For
each of ``SAMPLES`` samples a term draws, from hashes of itself alone, r and c from Gamma(2, 1)
and b from the uniform distribution. With t = floor(ln(weight) / r + b), it bids
c * exp(-r * (t - b + 1)); the lowest bid's (term, t) is the document's sample. Two documents get
the same sample with a probability equal to their generalised Jaccard similarity, the sum of
smaller weights over the sum of larger ones. A fingerprint is the array of 32-bit sample hashes.

Cases: a null text counts as empty; texts without words share one fingerprint, of a term of their
own; equal texts have equal fingerprints; repeated rows are computed once and returned as often
as they came; the next document is that of the next smaller id (null ids last), of several rows
with that id the one whose text comes first; a single document is its own next one; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabular_spark.llm.common import ranked, stored, text_of

#: Samples in a fingerprint, and how many of them are computed from one row (few enough for compiled code).
SAMPLES, BLOCK = 32, 4
#: What separates terms: everything but letters, marks and digits.
BETWEEN = r"[^\p{L}\p{M}\p{N}]+"
LOW = 0xFFFFFFFF


def draws(term: Column, number: Column) -> dict[str, Column]:
    """r and c from Gamma(2, 1) and b from the uniform distribution, for a term (64-bit hash) and a sample."""

    def unit(bits: Column) -> Column:  # in (0, 1)
        return (bits.bitwiseAND(F.lit(LOW)) + F.lit(0.5)) * F.lit(1.0 / (1 << 32))

    one, two = F.xxhash64(term, number), F.xxhash64(number, term)
    return {
        "r": -F.ln(unit(one) * unit(F.shiftright(one, 32))),
        "c": -F.ln(unit(two) * unit(F.shiftright(two, 32))),
        "b": unit(one.bitwiseXOR(F.shiftright(two, 17))),
    }


def packed_bid(term: Column, log_weight: Column, r: Column, c: Column, b: Column) -> Column:
    """The bid in the upper bits and the hash of (term, t) in the lower ones of a long, so that a plain minimum finds the sample.

    The fourth root keeps the order of bids and brings small and large ones into 31 bits.
    """
    t = F.floor(log_weight / r + b)
    root = F.sqrt(F.sqrt(c * F.exp(r * (b - t - 1.0))))
    rank = (F.least(root, F.lit(31.0)) * F.lit(float(1 << 26))).cast("long")
    return F.shiftleft(rank, 32).bitwiseOR(F.hash(term, t).cast("long").bitwiseAND(F.lit(LOW)))


def signatures(terms: DataFrame, keys: list[str], samples: int = SAMPLES) -> DataFrame:
    """``keys``, ``signature`` (array of int) and ``least_term``, from one row per key and term: ``keys``, term (64-bit hash), weight."""
    rows = terms.withColumn("lw", F.ln("weight")).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(samples // BLOCK - 1))))
    drawn = [draws(F.col("term"), F.col("block") * BLOCK + j) for j in range(BLOCK)]
    rows = rows.select(*keys, "block", "term", "lw", *[x.alias(f"{name}{j}") for j, d in enumerate(drawn) for name, x in d.items()])
    mins = [F.min(packed_bid(F.col("term"), F.col("lw"), F.col(f"r{j}"), F.col(f"c{j}"), F.col(f"b{j}"))).alias(f"m{j}") for j in range(BLOCK)]
    best = rows.groupBy(*keys, "block").agg(*mins, F.min("term").alias("least_term"))
    # the lower half as a signed int
    part = F.array(*[F.shiftright(F.shiftleft(f"m{j}", 32), 32).cast("int") for j in range(BLOCK)])
    joined = best.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("block", part.alias("part")))).alias("parts"), F.min("least_term").alias("least_term"))
    return joined.select(*keys, F.flatten("parts.part").alias("signature"), "least_term")


def word_terms(texts: DataFrame, keys: list[str]) -> DataFrame:
    """``keys``, term, weight: the words of ``text``, counted."""
    each = texts.select(*keys, F.explode(F.split(F.lower("text"), BETWEEN)).alias("word")).where("word != ''")
    return each.select(*keys, F.xxhash64("word").alias("term")).groupBy(*keys, "term").agg(F.count("*").alias("weight"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", samples: int = SAMPLES) -> DataFrame:
    """(doc_id, signature) of every distinct document."""
    slim = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text")).dropDuplicates()
    keyed = slim.withColumn("hash", F.xxhash64("text"))
    found = signatures(word_terms(keyed, ["doc_id", "hash"]), ["doc_id", "hash"], samples)
    found = found.select(F.col("doc_id").alias("_id"), F.col("hash").alias("_hash"), "signature")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("hash") == F.col("_hash"))
    return keyed.select("doc_id", "hash").join(found, same, "left").select("doc_id", or_wordless(F.col("signature"), samples).alias("signature"))


def or_wordless(signature: Column, samples: int = SAMPLES) -> Column:
    return F.coalesce(signature, F.array_repeat(F.lit(0), samples))


def likeness(a: Column, b: Column) -> Column:
    """The share of equal samples, an estimate of the generalised Jaccard similarity."""
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same)) / F.size(a)


def text_hex(signature: Column) -> Column:
    return F.array_join(F.transform(signature, lambda x: F.lower(F.lpad(F.hex(x.cast("long").bitwiseAND(F.lit(LOW))), 8, "0"))), "")


def with_next(docs: DataFrame) -> DataFrame:
    """Slim rows (doc_id, key, hash, n_chars, copies, next_key, next_hash, next_copies), one per distinct id and text.

    ``key`` is the id's 64-bit hash, never null.
    """
    text = text_of()
    slim = docs.select("doc_id", F.xxhash64("doc_id").alias("key"), F.xxhash64(text).alias("hash"), F.char_length(text).cast("long").alias("n_chars"))
    slim = stored(slim.groupBy("doc_id", "key", "hash", "n_chars").agg(F.count("*").alias("copies")), "documents-slim")
    first = slim.groupBy("doc_id", "key").agg(F.min(F.struct("hash", "copies")).alias("first"))
    order = ranked(first.select("doc_id", "key", "first.hash", "first.copies"), F.col("doc_id").desc_nulls_last())
    number = order.count()
    after = order.select(F.pmod(F.col("rank") - 1, F.lit(max(1, number))).alias("rank"), F.col("key").alias("next_key"), F.col("hash").alias("next_hash"), F.col("copies").alias("next_copies"))
    return stored(slim.join(order.select("rank", "key").join(after, "rank").drop("rank"), "key"), "documents-next")


def op6(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness.

    Texts are dealt once by (key, hash); the part that the document before needs is sent on to
    it. Four rows for each document carry the digest of the edited text through the same job:
    their version is 2 to 5 and their term a quarter of the digest.
    """
    links = with_next(docs)
    text = text_of()
    own = docs.select(F.xxhash64("doc_id").alias("key"), F.xxhash64(text).alias("hash"), text.alias("text"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    before = links.select(F.col("key").alias("to_key"), F.col("hash").alias("to_hash"), "n_chars", half.alias("half"), (F.col("copies") * F.col("next_copies")).alias("times"), F.col("next_key").alias("key"), F.col("next_hash").alias("hash"))
    heads = own.join(before, ["key", "hash"]).select(F.col("to_key").alias("key"), F.col("to_hash").alias("hash"), "n_chars", "half", "times", F.expr("left(text, half)").alias("head"))
    both = own.join(heads, ["key", "hash"]).select("key", "hash", "times", "text", F.expr("concat(left(text, cast(n_chars as int) - half), head)").alias("edited"))
    both = both.withColumn("digest", F.sha2("edited", 256))
    digest = [F.struct(F.lit(2 + i).alias("version"), F.array(F.conv(F.substring("digest", 1 + 16 * i, 16), 16, -10)).alias("words")) for i in range(4)]
    versions = [F.struct(F.lit(i).alias("version"), F.split(F.lower(c), BETWEEN).alias("words")) for i, c in enumerate(("text", "edited"))]
    each = both.select("key", "hash", "times", F.explode(F.array(*versions, *digest)).alias("v")).select("key", "hash", "times", "v.version", F.explode("v.words").alias("word")).where("word != ''")
    term = F.when(F.col("version") >= 2, F.col("word").try_cast("long")).otherwise(F.xxhash64("word")).alias("term")
    keys = ["key", "hash", "version"]
    terms = each.select(*keys, "times", term).groupBy(*keys, "term").agg((F.count("*") / F.max("times")).alias("weight"))
    found = stored(signatures(terms, keys, samples), "signatures")

    def version(i: int, *names: str) -> DataFrame:
        return found.where(F.col("version") == i).select(F.col("key").alias(names[0]), F.col("hash").alias(names[1]), F.col("least_term" if i > 1 else "signature").alias(names[2]))

    out = links.join(version(0, "key", "hash", "own"), ["key", "hash"], "left").join(version(1, "key", "hash", "edited"), ["key", "hash"], "left")
    parts = found.where("version >= 2").groupBy("key", "hash").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("version", "least_term"))), lambda x: F.lower(F.lpad(F.hex(x["least_term"]), 16, "0"))), "").alias("edited_sha256"))
    out = out.join(parts, ["key", "hash"]).join(version(0, "next_key", "next_hash", "after"), ["next_key", "next_hash"], "left")
    own_, edited, after = (or_wordless(F.col(c), samples) for c in ("own", "edited", "after"))
    out = out.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))))
    return out.select(
        "doc_id", "n_chars", "edited_sha256", text_hex(own_).alias("fingerprint"), text_hex(edited).alias("edited_fingerprint"),
        likeness(own_, edited).alias("near_edited"), likeness(own_, after).alias("near_next"),
    )
