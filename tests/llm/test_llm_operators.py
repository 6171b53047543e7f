"""Operators for training data against brute force, and what they do with odd input."""

import base64
import bz2
import gzip
import hashlib
import itertools
import lzma
import math
import random
import re
import textwrap
import time
import zlib
from collections import Counter, defaultdict
from urllib.parse import quote

import pandas as pd
import pytest

from tabular_spark.llm import bpe, exact_dedup, fingerprints, html_wrappers, licenses, mixing, quality, secrets, sharding, similarity_join

CLASHING = "hash string, digest string, record string, shard string, slot string, row string, rank string, words string, copies string, _id string, _source string, id string, text_hash string"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}"
LABELS = "doc_id long, quality int, toxic int"


def table(spark, texts, sources=None, ids=None):
    rows = []
    for i, text in enumerate(texts):
        rows.append((ids[i] if ids else i, text, None if i % 3 else "en", sources[i] if sources else "a", None if text is None else len(text), *["clash"] * 13))
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows and ids, ties."""
    long_text = " ".join(f"word{i % 977} and so on {i}" for i in range(40_000))
    texts = [None, None, "", "   \n\t ", "one", "one", "one two three four", long_text, long_text, "é ü 漢字 \U0001f600 text", "one", "a b c d e f g h i j"]
    sources = [None, "b", None, "a", "a", "a", "b", "c", "d", None, "a", "\U0001f600"]
    ids = [0, 1, 2, 3, 4, 4, 6, 7, 8, None, None, 9_007_199_254_740_993]
    return table(spark, texts, sources, ids).cache()


@pytest.fixture(scope="module")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="module")
def local(docs):
    return docs.toPandas()


@pytest.fixture(scope="module")
def labels(spark, sf):
    return spark.read.parquet(f"{sf}/labels.parquet")


def rows(df):
    return [r.asDict() for r in df.collect()]


# similarity join


def word_sets(texts, words=5):
    out = []
    for text in texts:
        found = re.findall(rb"(?:[a-z0-9]|[\x80-\xff])+", (text or "").lower().encode())
        out.append({tuple(found[i : i + words]) for i in range(max(1, len(found) - words + 1))} if found else set())
    return out


def brute_classes(ids, texts):
    sets, least, links = word_sets(texts), list(range(len(ids))), Counter()

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    for i, j in itertools.combinations(range(len(ids)), 2):
        a, b = sets[i], sets[j]
        if a == b or (a and b and len(a & b) * 5 >= 4 * len(a | b)):
            links[i] += 1
            links[j] += 1
            least[root(i)] = root(j)
    first = defaultdict(list)
    for i in range(len(ids)):
        first[root(i)].append(ids[i])
    return {ids[i]: (min(first[root(i)]), links[i]) for i in range(len(ids))}


def test_join_equals_brute_force(docs, local):
    got = {r["doc_id"]: (r["class_id"], r["links"]) for r in rows(similarity_join.op1(docs))}
    assert got == brute_classes(local["doc_id"].tolist(), local["text"].tolist())


def test_join_of_many_near_copies(spark, monkeypatch):
    monkeypatch.setattr(similarity_join, "PART_BLOCK", 100)
    draw = random.Random(5)
    base = [f"w{draw.randrange(10**6)}" for _ in range(120)]
    texts = []
    for i in range(420):  # several blocks and parts of a tree
        words = list(base)
        for _ in range(i % 3):
            words[draw.randrange(120)] = f"x{i}"
        texts.append(" ".join(words))
    texts += [" ".join(f"w{draw.randrange(10**6)}" for _ in range(60)) for _ in range(80)]
    got = {r["doc_id"]: (r["class_id"], r["links"]) for r in rows(similarity_join.op1(table(spark, texts)))}
    assert got == brute_classes(list(range(len(texts))), texts)


def test_join_counts_the_threshold_itself(spark):
    a = [f"w{i}" for i in range(40)]
    near, far = [*a[:36], *"nopq"], [*a[:35], *"rstuv"]  # 32 of 40 in common; 31 of 41
    got = {r["doc_id"]: r["links"] for r in rows(similarity_join.op1(table(spark, [" ".join(x) for x in (a, near, far)])))}
    sets = word_sets([" ".join(x) for x in (a, near, far)])
    want = [sum(len(x & y) * 5 >= 4 * len(x | y) for y in sets if y is not x) for x in sets]
    assert [got[i] for i in range(3)] == want


def test_join_odd(odd):
    got = rows(similarity_join.jaccard_classes(odd))
    assert len(got) == 12
    wordless = [r for r in got if r["doc_id"] in (0, 1, 2, 3)]
    assert {r["links"] for r in wordless} == {3} and len({str(r["class"]) for r in wordless}) == 1
    kept = similarity_join.one_of_each(odd)
    assert kept.columns == odd.columns
    assert len(word_sets(t["text"] for t in kept.collect())) == len({frozenset(x) for x in word_sets(t["text"] for t in odd.collect())})


def test_runs_needed_meet_the_recall():
    assert similarity_join.runs_needed(0.5) < similarity_join.runs_needed(0.999)


# sharding


def test_sharding_is_whole_and_even(docs, local):
    got = sharding.op2(docs).toPandas()
    assert sorted(got["doc_id"]) == sorted(local["doc_id"]) and set(got["law"]) == {"rows"}
    counts = got.groupby("shard").size()
    assert set(counts.index) == set(range(16)) and counts.max() - counts.min() <= 1
    assert all(sorted(x) == list(range(len(x))) for _, x in got.groupby("shard")["slot"])
    text = dict(zip(local["doc_id"], local["text"].fillna("")))
    assert all(c == zlib.crc32(text[d].encode()) and s == len(text[d].encode()) + 1 for d, c, s in zip(got["doc_id"], got["text_crc32"], got["size"]))


def test_sharding_over_many_buckets_mixes_and_agrees(docs):
    small = sharding.shuffled(docs, 3, bucket_bytes=20_000).select("record.doc_id", "shard", "slot")
    one, other = (x.orderBy("shard", "slot").toPandas() for x in (small, sharding.shuffled(docs.repartition(5), 3, bucket_bytes=20_000).select("record.doc_id", "shard", "slot")))
    assert sorted(one["doc_id"]) == sorted(other["doc_id"]) and one["doc_id"].tolist() != sorted(one["doc_id"])
    assert one[["shard", "slot"]].equals(other[["shard", "slot"]])
    assert all(sorted(x) == list(range(len(x))) for _, x in one.groupby("shard")["slot"])


def test_sharding_odd(spark, odd, tmp_path):
    got = sharding.op2(odd).toPandas()
    assert len(got) == 12 and sorted(got["shard"]) == sorted(set(got["shard"])) and set(got["slot"]) == {0}
    assert (got["size"] == 1).sum() == 3
    sharding.write_shards(odd, str(tmp_path / "shards"), 4)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.groupBy("shard").count().select("count").distinct().collect()[0][0] == 3 and back.select("record.*").columns == odd.columns


# secrets


def brute_base(text):
    text, out = text or "", []
    for order, (kind, pattern, group, least) in enumerate((
        ("assign", r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6), ("access", r"AKIA[A-Z0-9]+", 0, 20), ("hex", r"[0-9a-f]+", 0, 24),
    )):
        out += [(m.start(), order, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(pattern, text, re.ASCII) if len(m[group]) >= least]
    return [x[2] for x in sorted(out)]


def test_secrets_base_equals_brute_force(docs, local):
    text = dict(zip(local["doc_id"], local["text"]))
    for r in rows(secrets.op3(docs)):
        want = brute_base(text[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in secrets.KINDS] == [sum(x.startswith(k) for x in want) for k in secrets.KINDS]
        assert set(want) <= set(r["spans"].split(","))


SECRET = "api_key = Zx81kQpw92LmN4"
LAYERS = {
    "url": quote(SECRET, safe="").replace("a", "%61"),
    "unicode": "".join(f"\\u{ord(c):04x}" for c in SECRET),
    "references": "".join(f"&#{ord(c)};" for c in SECRET),
    "base64": base64.b64encode(SECRET.encode()).decode(),
    "packed": base64.b64encode(gzip.compress(SECRET.encode())).decode(),
    "nested": base64.b64encode(quote(base64.b64encode(SECRET.encode()).decode(), safe="").replace("Y", "%59").encode()).decode(),
    "deep": "".join(f"%{b:02X}" for b in base64.b64encode(zlib.compress("".join(f"\\u{ord(c):04x}" for c in SECRET).encode())).decode().encode()),
}


@pytest.mark.parametrize("name", LAYERS)
def test_secrets_in_layers(name):
    before = "Ünïcödé \U0001f600 before: "
    spans, unopened = secrets.find(f"{before}{LAYERS[name]} and after")
    hits = [s for s in spans if s[0] == "assign" and not s[3]]
    assert unopened == 0 and hits
    assert all(len(before) <= s[1] < s[2] <= len(before) + len(LAYERS[name]) for s in hits)


NOISE = bytes(random.Random(1).randrange(256) for _ in range(300))
LINES = ("some words of a letter\n" * 9 + SECRET + "\n").encode()
BYTE_LAYERS = {
    "twice packed": base64.b64encode(gzip.compress(zlib.compress(SECRET.encode()))).decode(),
    "second gzip": base64.b64encode(gzip.compress(b"first ") + gzip.compress(SECRET.encode())).decode(),
    "second bz2": base64.b64encode(bz2.compress(b"first ") + bz2.compress(SECRET.encode())).decode(),
    "second xz": base64.b64encode(lzma.compress(b"first ") + lzma.compress(SECRET.encode())).decode(),
    "after the member": base64.b64encode(gzip.compress(b"first ") + SECRET.encode()).decode(),
    "percent packed": quote(gzip.compress(SECRET.encode()), safe=""),
    "escapes packed": "".join(f"\\x{b:02x}" for b in zlib.compress(SECRET.encode())),
    "base64 64": "\n".join(textwrap.wrap(base64.b64encode(b"x" * 35 + b" " + SECRET.encode() + b" " * 40).decode(), 64)),
    "base64 76": "\r\n".join(textwrap.wrap(base64.b64encode(gzip.compress(NOISE + LINES)).decode(), 76)),
    "percent with a byte": "%FF" + "".join(f"%{b:02x}" for b in SECRET.encode()) + "%FE",
    "base64 with bytes": base64.b64encode(NOISE[:30] + SECRET.encode() + NOISE[30:60]).decode(),
}


@pytest.mark.parametrize("name", BYTE_LAYERS)
def test_secrets_in_byte_layers(name):
    before = "Ünïcödé \U0001f600 before: "
    spans, unopened = secrets.find(f"{before}\n{BYTE_LAYERS[name]}\n\nand after")
    hits = [s for s in spans if s[0] == "assign" and not s[3]]
    assert unopened == 0 and hits
    assert all(len(before) < s[1] < s[2] <= len(before) + 1 + len(BYTE_LAYERS[name]) for s in hits)


def test_secrets_end_on_cycles_and_bombs(monkeypatch):
    layer = "%2525252525252541 token%3Dabcdef12345"
    assert any(s[0] == "assign" for s in secrets.find(layer)[0])
    monkeypatch.setattr(secrets, "WINDOW", 1 << 20)
    monkeypatch.setattr(secrets, "OVERLAP", 1 << 14)
    monkeypatch.setattr(secrets, "PIECE", 1 << 16)
    # over several windows, with what a border cuts
    filler = b"a " * (secrets.WINDOW // 2 - 7)
    for data in (filler + b" password=abcdef12 " + filler, filler * 3 + b" token=abcdef12"):
        large = base64.b64encode(zlib.compress(data, 9)).decode()
        spans, unopened = secrets.find(f"before {large}")
        assert unopened == 0 and [x[:3] for x in spans] == [("assign", 7, 7 + len(large))]
    bomb = base64.b64encode(lzma.compress(lzma.compress(bytes(1 << 28)))).decode()
    assert len(bomb) < 10_000 and secrets.find(bomb)[1] == 1


@pytest.mark.parametrize("prefix", ["https://example.com/cb/", "https://example.com/a/", "data", "x+", "a/b/c/d/", "word_"])
def test_secrets_in_base64_after_other_characters(prefix):
    secret = "password=abcdef12"
    for data in (f"some {secret} here".encode(), f"some {secret} here".encode("utf-16-le"), f"ä {secret}".encode("utf-16"), gzip.compress(secret.encode() * 3, mtime=0)):
        run = base64.b64encode(data).decode()
        spans, _ = secrets.find(f"see {prefix}{run} there")
        assert any(k == "assign" and a < 4 + len(prefix) + len(run) and b > 4 + len(prefix) for k, a, b, _, _ in spans), data


def test_secrets_in_named_references():
    text = "a &amp; password&equals;abcdef12, token&amp;amp;equals;abcdef12 &amp;none; &none;"
    assert [text[a:b] for _, a, b, _, _ in secrets.find(text)[0]] == ["password&equals;abcdef12", "token&amp;amp;equals;abcdef12"]
    assert secrets.unicode_pieces("&amp;none;") == [("&", 5), ("none;", 5)] and secrets.unicode_pieces("&none;") is None


def test_secrets_odd(odd):
    got = rows(secrets.op3(odd))
    assert len(got) == 12 and all(r["n_assign"] == 0 for r in got)


# extraction


def page(i, paragraphs, comments=2):
    menu = "".join(f"<li><a href='/{k}'>Menu {k}</a></li>" for k in range(i % 4 + 2))
    said = "".join(f"<div class='comment'><p>Reader {k} says hello {i}</p></div>" for k in range(comments))
    body = "".join(f"<p>{p}</p>" for p in paragraphs)
    return (
        f"<!DOCTYPE html><html><head><title>T{i}</title><style>p{{}}</style><script>var x = '<p>no</p>';</script></head><body><header><h1>Site</h1></header><nav><ul>{menu}</ul></nav>"
        f"<article><h1>Title {i}</h1>{body}</article><aside><p>Side {i}</p></aside><section class='comments'>{said}</section><form><input><button>Go {i}</button></form><footer>Foot {i}</footer></body></html>"
    )


def test_extraction_finds_articles(spark):
    made, want = [], {}
    for i in range(60):
        paragraphs = [f"Paragraph {k} of {i} &amp; <b>bold</b>\n   text &#233;" for k in range(i % 5 + 1)]
        made.append((i, f"https://host{i % 3}.example/{i}", page(i, paragraphs, i % 4)))
        want[i] = "\n\n".join([f"Title {i}"] + [f"Paragraph {k} of {i} & bold text é" for k in range(i % 5 + 1)])
    pages = spark.createDataFrame(made, "page_id long, url string, html string").repartition(4)
    got = {r["page_id"]: r for r in rows(html_wrappers.op4(pages))}
    assert {k: r["text"] for k, r in got.items()} == want
    assert all(r["n_chars"] == len(want[k]) for k, r in got.items())


def test_wrapper_folds_and_aligns():
    wrapper = html_wrappers.Wrapper()
    for i in range(30):
        labels, texts, _ = html_wrappers.stream(page(i, ["x"] * (i % 4 + 1)))
        wrapper.page(labels, texts)
    again = html_wrappers.Wrapper.load(wrapper.dump())
    assert again.pages == 30 and again.groups and any(x[1] == 30 for x in again.items)
    other = html_wrappers.Wrapper()
    labels, texts, _ = html_wrappers.stream(page(99, ["y"]))
    other.page(labels, texts)
    again.merge(other)
    assert again.pages == 31


def test_extraction_odd(spark):
    made = [(1, None, None), (2, "https://a.b/c", ""), (3, "no url", "just text"), (4, "https://a.b/d", "<p>cut <b>off"), (4, "https://a.b/d", "<p>cut <b>off"), (None, "https://a.b/e", "<article><p>x" + " y" * 200_000 + "</p></article>"), (5, "https://a.b/f", "<script>only()</script>")]
    pages = spark.createDataFrame([(*r, "clash", "clash") for r in made], "page_id long, url string, html string, host string, wrapper string")
    got = Counter((r["page_id"], r["text"] if r["n_chars"] < 100 else r["n_chars"]) for r in rows(html_wrappers.op4(pages)))
    assert got == Counter({(1, ""): 1, (2, ""): 1, (3, "just text"): 1, (4, "cut off"): 2, (None, 400_001): 1, (5, ""): 1})
    assert rows(html_wrappers.op4(pages.limit(0))) == []



ARTICLE = "<article><h1>Head</h1><p>Body</p></article>"


@pytest.mark.parametrize(
    "html",
    [
        f"<head><script>for(i=0;i<n;i++){{x()}}</script></head><body>{ARTICLE}</body>",
        f"<style>a<b{{}}</style>{ARTICLE}<script>'<p>'</script>",
        f"<html><head><meta charset=utf-8><title>T</title><body>{ARTICLE}",
        f"<html><head><title>T</title>{ARTICLE}",
        f"<body class='single has-sidebar'>{ARTICLE}<div class='sidebar-left'><p>Side</p></div>",
        f"<body class='no sidebar'>{ARTICLE.replace('<article', '<article class=article-share-enabled')}<div class='share-buttons'>Share</div>",
    ],
)
def test_extraction_keeps_articles_of_untidy_pages(html):
    assert html_wrappers.Wrapper().text(html) == "Head\n\nBody"


def host_wrapper(pages):
    wrapper = html_wrappers.Wrapper()
    for x in pages:
        other = html_wrappers.Wrapper()
        other.page(*html_wrappers.stream(x)[:2])
        wrapper.merge(other)
    return html_wrappers.Wrapper.load(wrapper.dump())


@pytest.mark.parametrize("times", [1, 2, 25])
@pytest.mark.parametrize("differing", [False, True])
def test_extraction_keeps_articles_of_copies(times, differing):
    pages = [f"<body><p>Printed at {k if differing else 0}</p>{ARTICLE}</body>" for k in range(times)]
    assert {host_wrapper(pages).text(x) for x in pages} == {"Head\n\nBody"}
    pages = [x.replace(ARTICLE, "<div><p>All there is</p></div>").replace("<p>Printed at 0</p>", "") for x in pages]
    assert all("All there is" in host_wrapper(pages).text(x) for x in pages if not differing)


@pytest.mark.parametrize("number", [2, 3, 25])
def test_wrappers_decide_what_is_article(number):
    menu = "<div><a>Home</a><a>News</a><a>About</a></div>"

    def pages(body):
        return ["<body><div>Site</div>" + menu + body.format(k=k, more="".join(f"<p>More {j} of {k}</p>" for j in range(k % 3))) + "<div>All rights</div></body>" for k in range(number)]

    def want(text):
        return [text.format(k=k, more="".join(f"\n\nMore {j} of {k}" for j in range(k % 3))) for k in range(number)]

    for body, text in (
        ("<div><h2>Title {k}</h2><p>Text {k}</p>{more}</div>", "Title {k}\n\nText {k}{more}"),
        ("<div><h2>Title {k}</h2><h3>Summary</h3><p>Text {k}</p>{more}</div>", "Title {k}\n\nSummary\n\nText {k}{more}"),
        ("<div class=entry>Day {k}</div><div><p>A long text of the page number {k}</p>{more}</div>", "Day {k}\n\nA long text of the page number {k}{more}"),
        ("<div class=related-story><h2>Title {k}</h2>{more}</div>", "Title {k}{more}"),
    ):
        made = pages(body)
        wrapper = host_wrapper(made)
        got = [wrapper.text(x) for x in made]
        # words alone leave nothing of the fourth but the template
        assert got == want(text) and [html_wrappers.Wrapper().text(x) for x in made] != want(text)


# tokens


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found.no_truncation()
    found.no_padding()
    return found


def test_tokens_equal_the_library(docs, local, tokenizer):
    text = dict(zip(local["doc_id"], local["text"].fillna("")))
    for r in rows(bpe.op5(docs)):
        ids = tokenizer.encode(text[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_tokens_of_random_strings(tokenizer):
    draw, codec = random.Random(3), bpe.ForcedBoundaryCodec()
    parts = ["a", "Z", "'s", "'ll", " ", "  ", "\n", "\r\n", "\t", "0", "99", "é", "漢", "\U0001f600", " ", " ", "　", "\x85", "́", ".", "!!", "<|endoftext|>", "<|", "\x00", "\x7f", "Привет", "हिन्दी", "_", "http://", "‍", "ﬁ"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randrange(30))) for _ in range(4000)]
    for text, (packed, decoded) in zip(texts, codec.encode_decode([x.encode() for x in texts])):
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert [int.from_bytes(packed[i : i + 4], "little") for i in range(0, len(packed), 4)] == ids, repr(text)
        assert decoded.decode("utf-8", "replace") == tokenizer.decode(ids, skip_special_tokens=False), repr(text)


def test_tokens_odd(odd, tokenizer):
    got = sorted(r["n_tokens"] for r in rows(bpe.op5(odd)))
    assert got == sorted(len(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids) for r in odd.collect())


# fingerprints


def edited(local):
    order = local.sort_values("doc_id", ascending=False)
    ids, texts = order["doc_id"].tolist(), order["text"].fillna("").tolist()
    return {i: (t, t[: len(t) - len(t) // 2] + n[: len(t) // 2], n) for i, t, n in zip(ids, texts, texts[1:] + texts[:1])}


def true_likeness(a, b):
    x, y = (Counter(re.findall(r"[^\W_]+", t.lower())) for t in (a, b))
    return sum((x & y).values()) / max(1, sum((x | y).values()))


def test_fingerprints(docs, local):
    want, got = edited(local), rows(fingerprints.op6(docs))
    assert sorted(r["doc_id"] for r in got) == sorted(want)
    errors, prints = [], defaultdict(set)
    for r in got:
        own, changed, after = want[r["doc_id"]]
        assert r["n_chars"] == len(own) and r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        prints[own].add(r["fingerprint"])
        prints[changed].add(r["edited_fingerprint"])
        errors += [r["near_edited"] - true_likeness(own, changed), r["near_next"] - true_likeness(own, after)]
    assert all(len(x) == 1 for x in prints.values())
    assert abs(sum(errors) / len(errors)) < 0.03 and math.sqrt(sum(e * e for e in errors) / len(errors)) < 0.12


def test_fingerprints_odd(spark, odd):
    got = rows(fingerprints.op6(odd))
    assert len(got) == 12 and all(0 <= r["near_next"] <= 1 for r in got)
    assert len({r["fingerprint"] for r in got if r["doc_id"] in (0, 1, 2, 3)}) == 1
    one = rows(fingerprints.op6(table(spark, ["alone here"])))
    assert one[0]["near_next"] == one[0]["near_edited"] or one[0]["near_next"] == 1.0
    assert len(rows(fingerprints.fingerprints(odd))) == 11


# licenses


def test_licenses_in_other_spellings(spark):
    mit = dict(licenses.KNOWN)["MIT"]
    texts = [f"Copyright (c) 2019 Somebody\n\n{mit.upper()}", "some text\n\nlicensed under the mit LICENCE\n\nmore", "no license", None, "", "  \n\n "]
    got = {r["doc_id"]: (r["is_license"], r["licenses"]) for r in rows(licenses.licenses(table(spark, texts)))}
    assert got == {0: (True, "MIT"), 1: (False, "MIT"), 2: (False, ""), 3: (False, ""), 4: (False, ""), 5: (False, "")}


def test_licenses_of_several_paragraphs(spark):
    own = {x.name.removesuffix(".txt"): x.read_text(encoding="utf-8") for x in licenses.TEXTS.glob("*.txt")}
    mit, bsd, isc = own["MIT"], own["BSD-3-Clause"], own["ISC"]
    wrapped = "\n\n".join(textwrap.fill(x, 60) for x in bsd.split("\n\n")).replace("the copyright holder nor", "ACME, Inc. nor")
    noted = "/*\n" + "\n".join(f" * {x}".rstrip() for x in f"Copyright (c) Jo Doe\n\n{isc}".split("\n")) + "\n */\nint main;"
    want = {
        f"MIT License\n\nCopyright (c) 2020 Jo Doe\n\n{mit}": (True, "MIT"),
        f"The MIT License (MIT)\nCopyright (c) Jo Doe\n{mit}": (True, "MIT"),
        f"# Readme\n\nAbout this.\n\n{mit}\n\nThe end, {isc}\n\n{isc}": (False, "ISC,MIT"),
        f"Copyright Jo Doe. All rights reserved.\n\n{wrapped}": (True, "BSD-3-Clause"),
        own["BSD-2-Clause"].replace("\n\n", "\n"): (True, "BSD-2-Clause"),
        noted: (False, "ISC"),
        mit.replace("\n\nTHE SOFTWARE", "\n\nNot so.\n\nTHE SOFTWARE"): (False, ""),
        own["Apache-2.0.notice"]: (True, "Apache-2.0"),
        **{own[k]: (True, k) for k in ("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "Apache-2.0", "CC0-1.0", "Unlicense")},
        f"Before\n\n{own['GPL-3.0'].partition(licenses.END_OF_TERMS)[0]}\n\nafter": (False, "GPL-3.0"),
    }
    got = {r["doc_id"]: (r["is_license"], r["licenses"]) for r in rows(licenses.licenses(table(spark, list(want))))}
    for i, (text, (whole, names)) in enumerate(want.items()):
        assert got[i][0] == whole and got[i][1] == names, (text[:200], got[i])


def test_licenses_in_any_paragraphing(spark):
    own = {x.name.removesuffix(".txt"): x.read_text(encoding="utf-8") for x in licenses.TEXTS.glob("*.txt")}
    mit, flat = own["MIT"], {k: " ".join(x.split()) for k, x in own.items()}
    holder = "a very long list of names " * 30
    want = {
        f"Foo Library\n{mit}": (False, "MIT"),
        f"This file is free. {flat['MIT']} And more follows.": (False, "MIT"),
        f"Copyright (c) 2020 Jo Doe. {flat['ISC']}": (False, "ISC"),
        f"{flat['MIT']} {flat['MIT']} {flat['BSD-2-Clause']}": (False, "BSD-2-Clause,MIT"),
        " ".join(flat["MIT"].split()[:-1]): (False, ""),
        flat["MIT"].rstrip(".") + "s": (False, ""),
        f"x {flat['MIT'].replace('without limitation', 'with limitation')}": (False, ""),
        f"Intro {flat['BSD-3-Clause'].replace('the copyright holder nor', holder + 'nor')}": (False, "BSD-3-Clause"),
        f"Permission is hereby granted, free of charge, to all. The software is provided by us. {flat['MIT']}": (False, "MIT"),
        **{re.sub(r"\s+", lambda m, n=[0]: (n.__setitem__(0, n[0] + 1), "\n\n" if n[0] % 50 == 0 else " ")[1], own[k]): (True, k) for k in ("GPL-3.0", "MPL-2.0", "LGPL-2.1", "CC0-1.0")},
        "It isn't Licensed under the MIT License. Or is it?": (False, ""),
    }
    got = {r["doc_id"]: (r["is_license"], r["licenses"]) for r in rows(licenses.licenses(table(spark, list(want))))}
    for i, (text, found) in enumerate(want.items()):
        assert got[i] == found, (text[:200], got[i])


def test_licenses_cost_grows_with_the_text(spark):
    def seconds(n):
        docs = table(spark, ["Permission is hereby granted, free of charge, to the software is provided by " * n])
        began = time.perf_counter()
        assert rows(licenses.licenses(docs))[0]["licenses"] == ""
        return time.perf_counter() - began

    seconds(10)
    small, large = seconds(5_000), seconds(20_000)
    assert large < 10 * max(small, 1)


def test_licenses_odd(odd):
    assert len(rows(licenses.licenses(odd))) == 12


# exact copies


def test_exact_copies_with_a_hot_text(spark):
    texts = ["hot"] * 400 + [None, "", ""] + [f"cold {i % 150}" for i in range(300)] + ["Hot", "hot "]
    for counters in (2, 20, 1000):
        got = rows(exact_dedup.exact_dedup(table(spark, texts), counters=counters))
        groups = defaultdict(list)
        for i, t in enumerate(texts):
            groups[t or ""].append(i)
        assert len(got) == len(texts)
        for r in got:
            text = texts[r["doc_id"]] or ""
            assert (r["keep_id"], r["group_size"], r["kept"]) == (max(groups[text]), len(groups[text]), r["doc_id"] == max(groups[text]))
            assert r["text_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_misra_gries_finds_the_heavy(spark):
    texts = ["a"] * 300 + ["b"] * 200 + [str(i) for i in range(500)]
    keys = exact_dedup.digests(table(spark, texts)).select("digest")
    found = {bytes(r[0]) for r in exact_dedup.misra_gries(keys, 20).collect()}
    assert {hashlib.sha256(x).digest() for x in (b"a", b"b")} <= found and len(found) <= 20


def test_exact_copies_odd(odd):
    got = rows(exact_dedup.exact_dedup(odd))
    assert len(got) == 12 and sum(r["kept"] for r in got) == 7
    kept = exact_dedup.without_copies(odd)
    assert kept.columns == odd.columns and kept.count() == 7 and kept.select("text").distinct().count() == 7


# quality


def test_quality_on_held_out_rows(docs, labels):
    got = quality.op9(docs, labels).toPandas().merge(labels.toPandas(), on="doc_id")
    assert all(h == (zlib.crc32(str(i).encode()) % 5 == 0) for i, h in zip(got["doc_id"], got["held_out"]))
    assert got["score"].between(0, 1).all() and (got["predicted"] == (got["score"] >= 0.3)).all()


def test_quality_learns_pairs_and_bins():
    import numpy as np

    draw = np.random.default_rng(1)
    x = draw.random((4000, len(quality.FEATURES)))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit(x[:3000], y[:3000])
    assert ((model.score(x[3000:]) > 0.5) == (y[3000:] > 0.5)).mean() > 0.85
    y = (x[:, 2] > 0.3).astype(float)
    assert ((quality.fit(x[:3000], y[:3000]).score(x[3000:]) > 0.5) == (y[3000:] > 0.5)).mean() > 0.97


def test_quality_features_do_not_depend_on_neighbours():
    texts = [b"", b"  lead and trail  ", b"one one two", b"", "é Ü | 12 !! *&".encode(), b"\n\n", b"a"]
    together = quality.features(texts)
    assert all((together[i] == quality.features([t])[0]).all() for i, t in enumerate(texts))


def test_quality_never_reads_held_out_labels(spark, docs, labels):
    from pyspark.sql import functions as F

    other = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    key = ["doc_id"]
    one, two = (quality.op9(docs, x).toPandas().sort_values(key, ignore_index=True) for x in (labels, other))
    assert one.equals(two)


def test_quality_odd(spark, odd, labels):
    none = spark.createDataFrame([], LABELS)
    assert {r["score"] for r in rows(quality.op9(odd, none))} == {0.5}
    some = spark.createDataFrame([(i, i % 2 if i != 3 else None, None) for i in (0, 1, 2, 3, 4, 6, 7, 8)], LABELS)
    assert len(rows(quality.op9(odd, some))) == 12
    assert quality.accepted(odd, none).count() == 12 and quality.accepted(odd, none).columns == odd.columns


# mixing


def water_filling(sizes, weights=(5, 2, 1), cap=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    target, free, left = {}, list(names), float(sum(sizes.values()))
    while free:
        level = left / sum(weight[s] for s in free)
        full = [s for s in free if cap * sizes[s] <= level * weight[s]]
        if not full:
            return target | {s: level * weight[s] for s in free}
        for s in full:
            target[s] = float(cap * sizes[s])
            left -= target[s]
        free = [s for s in free if s not in full]
    return target


def check_mix(given, got):
    sizes = Counter()
    for _, source, text in given:
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    want, taken, most = water_filling(dict(sizes)), Counter(), Counter()
    source_of = {i: s for i, s, _ in given}
    for r in got:
        s = source_of[r["doc_id"]]
        assert r["source_size"] == sizes[s] and math.isclose(r["target"], want[s], rel_tol=1e-9, abs_tol=1e-6)
        assert r["taken"] in [k * r["size"] for k in range(4)]
        taken[s] += r["taken"]
        most[s] = max(most[s], r["size"])
    assert all(abs(taken[s] - want[s]) <= most[s] / 2 + 1e-6 for s in sizes)


def test_mix_meets_targets(docs, local):
    got = rows(mixing.op10(docs))
    check_mix(list(zip(local["doc_id"], local["source"], local["text"])), got)
    key = sorted((r["doc_id"], r["taken"]) for r in got)
    assert key == sorted((r["doc_id"], r["taken"]) for r in rows(mixing.op10(docs.repartition(7))))


def test_mix_by_a_tree_of_buckets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET", 8)
    monkeypatch.setattr(mixing, "FAN_IN", 3)
    draw = random.Random(2)
    texts = ["w " * draw.randrange(1, 60) for _ in range(600)]
    sources = ["hot" if i % 3 else draw.choice([None, "a", "b", "z"]) for i in range(600)]
    given = table(spark, texts, sources)
    check_mix(list(zip(range(600), sources, texts)), rows(mixing.op10(given)))
    made = Counter(r["doc_id"] for r in mixing.mixed(given).collect())
    assert all(made[r["doc_id"]] * r["size"] == r["taken"] for r in rows(mixing.op10(given)))


def test_pivot_keeps_words_and_leaves_one():
    draw = random.Random(1)
    sizes, shares = [draw.randrange(1, 90) for _ in range(300)], [draw.random() for _ in range(300)]
    out, at = mixing.pivot(sizes, shares, draw.random)
    assert math.isclose(sum(a * b for a, b in zip(sizes, out)), sum(a * b for a, b in zip(sizes, shares)), rel_tol=1e-9)
    assert all(x in (0.0, 1.0) for i, x in enumerate(out) if i != at)


def test_mix_odd(odd):
    got = rows(mixing.op10(odd))
    assert len(got) == 12 and 9_007_199_254_740_993 in {r["doc_id"] for r in got}
    assert mixing.mixed(odd).columns == odd.columns


def test_empty_tables(spark, odd):
    none, no_labels = odd.limit(0), spark.createDataFrame([], LABELS)
    for found in (
        similarity_join.op1(none), sharding.op2(none), secrets.op3(none), bpe.op5(none), fingerprints.op6(none), licenses.licenses(none), exact_dedup.exact_dedup(none),
        quality.op9(none, no_labels), mixing.op10(none), similarity_join.one_of_each(none), exact_dedup.without_copies(none), quality.accepted(none, no_labels), mixing.mixed(none),
    ):
        assert isinstance(found.toPandas(), pd.DataFrame) and found.count() == 0
