"""What inferred wrappers overrule, and alignments in linear space."""

import random
import tracemalloc

import pytest

from tabular_spark.llm import html_wrappers

SHAPES = {
    "form": "<form>{menu}<h1>Head {k}</h1><div>{body}</div></form>",
    "menu-left": "<div class='wrap menu-left'>{menu}<h1>Head {k}</h1><div>{body}</div></div>",
    "cookies-accepted": "<div class='page cookies-accepted'>{menu}<h1>Head {k}</h1><div>{body}</div></div>",
    "comments-open": "{menu}<div class='post comments-open'><h1>Head {k}</h1>{body}</div>",
    "unclosed nav": "<nav>{menu}<div><h1>Head {k}</h1>{body}</div>",
    "nav-collapsed": "<h2>The site</h2>{menu}<div id='content' class='main nav-collapsed'><h1>Head {k}</h1>{body}</div>",
}
MENU = "<ul class='menu'><li>Home</li><li>About</li></ul>"


def host(pages):
    wrapper = html_wrappers.Wrapper()
    for x in pages:
        other = html_wrappers.Wrapper()
        other.page(*html_wrappers.stream(x)[:2])
        wrapper.merge(other)
    return html_wrappers.Wrapper.load(wrapper.dump())


def paragraphs(k):
    return [f"Paragraph {j} of page {k} says more of it than any title." for j in range(k % 3 + 1)]


@pytest.mark.parametrize("number", [1, 2, 3, 30])
@pytest.mark.parametrize("shape", SHAPES)
def test_what_varies_overrules_words(shape, number):
    pages = ["<body>" + SHAPES[shape].format(menu=MENU, k=k, body="".join(f"<p>{x}</p>" for x in paragraphs(k))) + "</body>" for k in range(number)]
    wrapper = host(pages)
    assert [wrapper.text(x) for x in pages] == ["\n\n".join([f"Head {k}", *paragraphs(k)]) for k in range(number)]


@pytest.mark.parametrize("number", [1, 2, 30])
def test_long_comments_and_other_parts_stay_out(number):
    said = "".join(f"<p>Reader {j} has a lot to say here</p>" for j in range(40))
    side = "<aside><p>Read also {k}</p></aside>"
    pages = [("<body>" + MENU + "<div><h1>Head {k}</h1><p>The text of page {k}</p></div>" + side + "<div id='comments'>" + said + "<p>{k}</p></div></body>").format(k=k) for k in range(number)]
    assert [host(pages).text(x) for x in pages] == [f"Head {k}\n\nThe text of page {k}" for k in range(number)]


def brute(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


@pytest.mark.parametrize("cells", [1, 50, 1 << 27])
def test_alignment_is_a_longest_one(monkeypatch, cells):
    monkeypatch.setattr(html_wrappers, "MOST_CELLS", cells)
    draw = random.Random(7)
    for _ in range(300):
        letters = "abcdefgh"[: draw.randint(1, 8)]
        a, b = ("".join(draw.choices(letters, k=draw.randint(0, 40))) for _ in range(2))
        pairs = html_wrappers.aligned(a, b)
        assert all(a[i] == b[j] for i, j in pairs) and len(pairs) == brute(a, b)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))


def test_alignment_of_very_long_pages_in_little_memory():
    draw = random.Random(8)
    a, b = ("".join(chr(0xF0000 + draw.randrange(400)) for _ in range(100_000)) for _ in range(2))
    tracemalloc.start()
    pairs = html_wrappers.aligned(a, b)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200 << 20 and len(pairs) > 5_000
