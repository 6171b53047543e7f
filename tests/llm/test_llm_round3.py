"""Token files, integer centroid clustering and the source divergence audit against brute force and on odd input."""

import hashlib
import random
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tabular_spark.llm import centroids, divergence, token_files

DOCS = "doc_id long, text string, lang string, source string"


def random_texts(n, seed=1):
    draw = random.Random(seed)
    words = ["the", " and", "ß", "naïve", "  ", "\n", "don't", "<|endoftext|>", "日本語", "x" * 70, "42", ",", " a", "\t", "🙂"]
    return ["".join(draw.choice(words) for _ in range(draw.randrange(0, 40))) for _ in range(n)]


@pytest.fixture(scope="module")
def tokenizer():
    found = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found.no_truncation()
    found.no_padding()
    return found


def tokens(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [2]


# token files


@pytest.mark.parametrize("most", [1, 7, 64, 1 << 20])
def test_stretches_of_any_length_give_the_same_ids(tokenizer, most):
    texts = ["", *random_texts(40), "", "", "y" * 300, ""]
    raw = [t.encode() for t in texts]
    offsets, data = np.cumsum([0, *map(len, raw)]), np.frombuffer(b"".join(raw), np.uint8)
    ids, lengths = zip(*token_files.StretchEncoder().documents(data, offsets, 2, most))
    ids, lengths = np.concatenate(ids).tolist(), np.concatenate(lengths).tolist()
    want = [tokens(tokenizer, t) for t in texts]
    assert lengths == [len(x) for x in want]
    assert ids == [i for x in want for i in x]


def test_a_full_memory_gives_the_same_ids(tokenizer, monkeypatch):
    monkeypatch.setattr(token_files, "REMEMBERED", 5)
    texts = random_texts(30, 2)
    raw = [t.encode() for t in texts]
    offsets, data = np.cumsum([0, *map(len, raw)]), np.frombuffer(b"".join(raw), np.uint8)
    parts = list(token_files.StretchEncoder().documents(data, offsets, 2, 200))
    assert np.concatenate([p[0] for p in parts]).tolist() == [i for t in texts for i in tokens(tokenizer, t)]


@pytest.mark.parametrize("planes", [4, 32])
@pytest.mark.parametrize("n", [1, 7, 8, 1000])
def test_planes_come_back(planes, n):
    import zstandard

    ids = np.array([random.Random(n).randrange(1 << 32) for _ in range(n)], np.uint32)
    packed = token_files.to_planes(ids, planes, zstandard.ZstdCompressor())
    assert (token_files.from_planes(packed, n, planes, zstandard.ZstdDecompressor()) == ids).all()


@pytest.mark.parametrize("planes,block", [(4, 1 << 16), (32, 10)])
def test_token_files_hold_every_document(spark, tokenizer, tmp_path, planes, block):
    rows = [(i * 3, t) for i, t in enumerate(random_texts(60))] + [(None, "null id"), (5, None), (5, ""), (9, "twice"), (9, "twice"), (10**12, "the end " * 5000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    path = str(tmp_path / "tokens")
    token_files.write_tokens(docs, path, planes=planes, block=block)
    got = token_files.read_tokens(spark, path).orderBy("file", "position").collect()
    want = sorted(((i, tokens(tokenizer, t)) for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert [(r.doc_id is not None, r.doc_id or 0) for r in got] == [(i is not None, i or 0) for i, _ in want]
    assert sorted(((r.doc_id is not None, r.doc_id or 0), list(r.ids)) for r in got) == sorted(((i is not None, i or 0), ids) for i, ids in want)
    index = token_files.block_index(spark, path).collect()
    assert sum(r.ids for r in index) == sum(len(ids) for _, ids in want) and max(r.ids for r in index) <= block
    found = token_files.token_digests(spark, path).orderBy("start").collect()
    assert [r.start for r in found] == np.cumsum([0, *(r.n_tokens for r in found)])[:-1].tolist()
    assert sorted(r.ids_crc32 for r in found) == sorted(zlib.crc32(np.array(ids, "<u4").tobytes()) for _, ids in want)


def test_a_cut_file_is_refused(spark, tmp_path):
    token_files.write_tokens(spark.createDataFrame([(1, "text")], "doc_id long, text string"), str(tmp_path / "t"))
    content = next(bytes(r.content) for r in token_files.contents(spark, str(tmp_path / "t")).collect())
    with pytest.raises(ValueError):
        token_files.TokenFile(content[:-20])


def test_op11_equals_the_library(spark, sf, tokenizer):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want, at = [], 0
    for row in sorted(docs.select("doc_id", "text").collect()):
        ids = tokens(tokenizer, row.text)
        want.append((row.doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(map(tuple, token_files.op11(docs).select("doc_id", "start", "n_tokens", "ids_crc32").collect())) == want


def test_op11_of_nothing_and_of_clashing_names(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert token_files.op11(empty).collect() == []
    odd = spark.createDataFrame([(1, "a", "b", 3)], "doc_id long, text string, _hash string, part int")
    assert [(r.doc_id, r.start, r.n_tokens) for r in token_files.op11(odd).collect()] == [(1, 0, 2)]


def test_many_equal_rows_go_to_several_files(spark, tmp_path):
    docs = spark.range(4000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("same text").alias("text")).repartition(4)
    token_files.write_tokens(docs, str(tmp_path / "t"))
    sizes = [r["count"] for r in token_files.read_tokens(spark, str(tmp_path / "t")).groupBy("file").count().collect()]
    assert sum(sizes) == 4000 and max(sizes) < 2500


# centroids


def brute_clusters(rows, k, rounds, dims):
    kept = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    kept_ordered = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    centers = [list(v) for _, v in kept_ordered[:k]]

    def best(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centers))

    for _ in range(rounds):
        found = [best(v)[1] for _, v in kept]
        for j in range(len(centers)):
            mine = [v for (_, v), f in zip(kept, found) if f == j]
            if mine:
                centers[j] = [sum(c) // len(mine) for c in zip(*mine)]
    return sorted((str(i), best(v)[1], best(v)[0]) for i, v in kept)


@pytest.mark.parametrize("spread", [0.1, 3.0, 1e5])
def test_clusters_equal_brute_force(spark, spread):
    draw = random.Random(3)
    rows = [(i, [float(np.float32(draw.gauss(0, spread))) for _ in range(6)]) for i in range(60)]
    rows += [(60, rows[0][1]), (60, rows[0][1]), (None, rows[1][1]), (61, None), (62, [1.0] * 5), (63, [None] * 6), (64, [float("nan")] * 6), (65, [float("inf")] + [0.0] * 5), (66, [0.0] * 6)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    found, _ = centroids.clustered(table, 7, 3, dims=6)
    assert sorted((str(r.vec_id), r.cluster, r.distance) for r in found.collect()) == brute_clusters(rows, 7, 3, 6)


def test_large_components_count_as_the_bound(spark):
    table = spark.createDataFrame([(1, [3e38] * 64), (2, [-3e38] * 64), (3, [0.0] * 64)], "vec_id long, embedding array<float>")
    got = centroids.op12(table, k=2, rounds=1).collect()
    assert len(got) == 3 and all(r.distance >= 0 for r in got)


def test_packed_products_are_exact(spark):
    draw = random.Random(5)
    vectors = [[draw.randrange(-90, 90) for _ in range(8)] for _ in range(9)]
    bits, arrays = centroids.packed(vectors, max(sum(x * x for x in v) for v in vectors))
    assert len(arrays) < len(vectors) and bits * (len(vectors) // len(arrays)) <= centroids.ROOM
    table = spark.createDataFrame([(v, sum(x * x for x in v)) for v in vectors], "x array<long>, norm long")
    got = centroids.nearest(table, vectors, max(sum(x * x for x in v) for v in vectors)).collect()
    assert all(r.best.distance == 0 and vectors[r.best.cluster] == list(r.x) for r in got)


def test_few_or_no_vectors(spark):
    one = spark.createDataFrame([(5, [1.0] * 64)], "vec_id long, embedding array<float>")
    assert [(r.vec_id, r.cluster, r.distance, r.inertia) for r in centroids.op12(one).collect()] == [(5, 0, 0, 0)]
    assert centroids.op12(one.where("vec_id < 0")).collect() == []


def test_clustering_runs_no_python(spark, sf):
    plan = centroids.nearest(centroids.integer_vectors(spark.read.parquet(f"{sf}/embeddings.parquet"), 64, 256), [[1] * 64], 10)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# divergence


def by_sql(docs):
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    cursor = con.execute(divergence.ORACLE)
    names = [c[0] for c in cursor.description]
    return sorted(tuple(r[names.index(c)] for c in ("lang", "source", "part", "rank", "item", "value")) for r in cursor.fetchall())


def rows_of(found):
    return sorted(map(tuple, found.select("lang", "source", "part", "rank", "item", "value").collect()))


@pytest.mark.parametrize("block,tile", [(1 << 16, 16), (3, 2), (1, 1)])
def test_divergence_of_odd_documents(spark, block, tile):
    draw = random.Random(8)
    words = ["Alpha", "beta", "GAMMA", "ß", "Été", "été", "x1y", "don't", "日本", "_", "delta-delta", " "]
    rows = [(i, " ".join(draw.choice(words) for _ in range(draw.randrange(0, 12))), draw.choice(["en", "fr"]), draw.choice(["a", "b", "c", "é", "B"])) for i in range(80)]
    rows += [(80, None, None, None), (81, "alpha alpha", None, "z"), (82, "1 2 3", "none", "s"), (83, "", "none", "t"), (84, "beta", "en", None), (None, "gamma gamma", "en", "a"), (0, rows[0][1], "en", "a"), (0, rows[0][1], "en", "a")]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    assert rows_of(divergence.audited(docs, block=block, tile=tile)) == by_sql(docs)


def test_divergence_of_nothing_and_of_clashing_names(spark):
    empty = spark.createDataFrame([], DOCS)
    assert divergence.op13(empty).collect() == []
    docs = spark.createDataFrame([(1, "a a", "en", "s", 1, "x"), (2, "a b", "en", "t", 2, "y"), (3, "a", "en", "t", 3, "z")], DOCS + ", g int, term string")
    assert rows_of(divergence.op13(docs)) == by_sql(docs.select("doc_id", "text", "lang", "source"))


def test_terms_of_long_texts_are_not_cut():
    text = b" ".join(b"w%d" % i for i in range(5000)) + b"  " + b"v" * 3000
    assert [t for p in divergence.pieces(text, 100) for t in p] == text.split()


def test_op13_equals_sql(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", "source")
    assert rows_of(divergence.op13(docs)) == by_sql(docs)


@pytest.mark.parametrize("seed", range(5))
def test_gallop(seed):
    draw = np.random.default_rng(seed)
    large = np.unique(draw.integers(0, 5000, 2000))
    small = np.unique(draw.integers(0, 6000, [1, 10, 300, 1500, 5][seed]))
    for a, b, run in ((small, large, 4), (large, small, 64), (small, small, 256), (small, large[:0], 4)):
        place = {int(v): i for i, v in enumerate(b)}
        assert divergence.gallop(a, b, run).tolist() == [place.get(int(v), -1) for v in a]


def test_prices_of_two_groups():
    draw = np.random.default_rng(2)
    for _ in range(20):
        a, b = (np.sort(draw.choice(30, draw.integers(0, 30), replace=False)) for _ in range(2))
        pa, pb, a0, b0 = draw.integers(1, 10**9, len(a)), draw.integers(1, 10**9, len(b)), 5, 3
        full_a, full_b = dict(zip(a.tolist(), pa.tolist())), dict(zip(b.tolist(), pb.tolist()))
        terms = sorted(set(full_a) | set(full_b))
        p, q = [full_a.get(t, a0) for t in terms], [full_b.get(t, b0) for t in terms]
        want = (sum((x - y) ** 2 // y for x, y in zip(p, q)), sum((y - x) ** 2 // x for x, y in zip(p, q)), len(terms))
        assert divergence.merged((a, pa, a0), (b, pb, b0)) == want
