"""HTML extraction by wrappers: union-free regular expressions inferred per host.

A page is a stream of tags and text slots, each named by its path. Adjacent repetitions are folded
into repeated groups, also of groups, until none is left. The wrapper of a host starts as the
stream of its first page; every further page is aligned with it, and what only one of the two has
becomes an optional group. Tasks infer wrappers of the hosts in their pages, and a tree of merges,
by the same alignment, brings those of a host together, so that each page of the table counts.

To extract, a page of a host with at least two different pages is aligned with its host's wrapper.
What varies, is optional or is repeated with other texts is the pages' own; what is constant on all
pages, also as a repeated group, is template. Elements and words in class, id and role choose among
what is the pages' own: menus, headers, footers, sidebars, notices, adverts, forms and reader
comments are left out, and an article that they tell of is taken alone and whole, unless the pages' own text outside of it
outweighs it. Else all text of the pages' own is taken, and what is constant in between. What varies
overrules them: a part that they leave out is taken back in where it holds so much of what varies on
the host's pages that it outweighs the rest, as a form, a menu left open or an element with words
such as "cookies-accepted" around the whole article. If the words leave nothing, what varies is taken
against the weaker ones. On hosts with one page, or copies of one, all text counts as varying.

Cases: a null html counts as empty and gives the empty text; a null url belongs to the host "";
unclosed and cut-off tags are closed by what follows; repeated rows stay; texts of any length are
kept whole; an empty table gives an empty result; only page_id, url and html are read.
"""

from __future__ import annotations

import hashlib
import html as entities
import json
import re
import zlib
from collections.abc import Iterator
from functools import cached_property, lru_cache
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabular_spark.llm.common import removed, stored

# Fixed values of HTML: elements without content, those whose content isn't text, those that start a block, those that a new one closes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe svg textarea title object canvas".split())
BLOCKS = frozenset("address article aside blockquote body caption dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
CLOSED_BY_SAME = frozenset("li dt dd tr td th option".split())
# Elements and words in class, id and role that stand for other parts of a page than its article.
OTHER_ELEMENTS = frozenset("aside button dialog footer form head menu nav select".split())
OTHER_WORDS = frozenset("ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer login menu modal nav navbar navigation newsletter notice popup promo related respond search share sharing sidebar signup social sponsor sponsored subscribe widget".split())
#: Those of them that may as well be part of an article's name; not heeded where the words leave nothing that differs between pages.
WEAK_WORDS = frozenset("banner modal newsletter notice popup promo related search share sharing sidebar signup social sponsor sponsored subscribe widget".split())
#: Only outside of an article.
OUTSIDE_WORDS = frozenset(["header", "masthead"])
ARTICLE_ELEMENTS = frozenset(["article", "main"])
ARTICLE_WORDS = frozenset("article articlebody main content entry post story".split())
#: Elements whose words say nothing of the part they hold, and parts of a hyphenated word that make it a state of its element.
WHOLE_PAGE = frozenset(["html", "body"])
MODIFIERS = frozenset("disabled enabled has is no not with without".split())
#: Words that even an article element outside of any other article is left out for.
COMMENT = frozenset(["comment", "comments"])
COMMENT_WORDS = COMMENT | {"disqus", "respond"}
#: What may stand in <head>; anything else ends it.
IN_HEAD = frozenset("base head link meta noscript script style template title".split())

TOKEN = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|<(/?)([A-Za-z][^\s/>]*)([^>]*)(>|$)|([^<]+|<)", re.DOTALL)
ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
SPACE = re.compile(r"\s+")
#: Checksums of texts are polynomials, so that those of neighbours can be put together.
MODULUS, BASE = (1 << 61) - 1, 1_000_003
#: What is told of as an article is none if the pages' own text elsewhere is so many times as long.
OUTWEIGHED = 4
#: Longest group, in tokens or groups, that is tried as a repetition.
LONGEST_GROUP = 24
REPEATED = re.compile("(.{1,%d}?)\\1+" % LONGEST_GROUP, re.DOTALL)
#: The same for a part that has an article's element, words or heading.
OUTWEIGHED_ARTICLE = 2
#: Pairs of places, one bit each, that an alignment holds at once.
MOST_CELLS = 1 << 27
#: Wrappers merged in a node of the tree; parts that the pages of a host are dealt to for extraction.
FAN_IN, SALTS = 64, 64


@lru_cache(20_000)
def telling(name: str, attributes: str) -> str:
    """The words in class, id and role that say what an element is for.

    Those of <html> and <body>, and states such as has-sidebar, don't; on an article element only
    whole words do, as article-share is still the article.
    """
    if name in WHOLE_PAGE:
        return ""
    words = set()
    for a in ATTRIBUTE.finditer(attributes):
        for word in (a[2] or a[3] or a[4] or "").lower().split():
            parts = re.split(r"[^a-z]+", word)
            if not MODIFIERS & set(parts) and (len(parts) == 1 or name not in ARTICLE_ELEMENTS):
                words |= set(parts)
    return ".".join(sorted(words & (OTHER_WORDS | OUTSIDE_WORDS | ARTICLE_WORDS)))


@lru_cache(100)
def end_of(name: str) -> re.Pattern:
    return re.compile(f"</{re.escape(name)}(?=[\\s/>])[^>]*(?:>|$)", re.IGNORECASE)


def stream(page: str) -> tuple[list[str], list[str], list[bool]]:
    """Labels of a page's tokens, the text of each (empty for tags), and whether a block starts before it.

    A label is the path of open elements, with their telling words; that of a slot ends in ``#``.
    """
    labels, texts, breaks = [], [], []
    open_: list[tuple[str, str]] = []  # element and its path
    fresh, at_char = True, 0
    while at_char < len(page):
        m = TOKEN.match(page, at_char)
        at_char = m.end()
        closing, name, rest, _, text = m.groups()
        if text is not None:
            text = entities.unescape(text)
            if open_ and open_[-1][0] == "head" and text.strip():
                open_.pop()
            if text.strip() or (text and labels and labels[-1].endswith("#")) or (text and not fresh):
                labels.append((open_[-1][1] if open_ else "") + "#")
                texts.append(text)
                breaks.append(fresh)
                fresh = False
            continue
        if not name:
            continue
        name = name.lower()
        if name == "br":
            labels.append((open_[-1][1] if open_ else "") + "br#")
            texts.append(" ")
            breaks.append(fresh)
            continue
        if name in BLOCKS:
            fresh = True
        if closing:
            if name in [x[0] for x in open_]:
                while open_.pop()[0] != name:
                    pass
                labels.append((open_[-1][1] if open_ else "") + "/" + name)
                texts.append("")
                breaks.append(False)
            continue
        if name not in IN_HEAD:
            at = next((i for i in range(len(open_)) if open_[i][0] == "head"), -1)
            if at >= 0:
                del open_[at:]
        if name in BLOCKS:  # a paragraph can't hold a block
            at = next((i for i in range(len(open_) - 1, -1, -1) if open_[i][0] == "p"), -1)
            if at >= 0:
                del open_[at:]
        if name in CLOSED_BY_SAME:
            at = next((i for i in range(len(open_) - 1, -1, -1) if open_[i][0] in (name, "ul", "ol", "dl", "table", "select")), -1)
            if at >= 0 and open_[at][0] == name:
                del open_[at:]
        if name in RAW:
            if not rest.rstrip().endswith("/"):  # its content isn't markup
                end = end_of(name).search(page, at_char)
                at_char = end.end() if end else len(page)
            continue
        words = telling(name, rest) if rest else ""
        path = (open_[-1][1] if open_ else "") + name + ("." + words if words else "") + ">"
        labels.append(path)
        texts.append("")
        breaks.append(False)
        if name not in VOID and not rest.rstrip().endswith("/"):
            open_.append((name, path))
    return labels, texts, breaks


@lru_cache(200_000)
def placed(label: str, overruled: frozenset[str] = frozenset(), weak: bool = True) -> tuple[int, str]:
    """2 for a slot in an article, 1 for one elsewhere, 0 for one in another part of the page, told by elements and words, and the path of the part.

    Without ``weak``, ``WEAK_WORDS`` aren't heeded; what the paths in ``overruled`` say of other parts isn't either.
    """
    article, path = False, ""
    for step in label.split(">")[:-1]:
        path += step + ">"
        name, *own = step.split(".")
        own = set(own) if weak else set(own) - WEAK_WORDS
        if path not in overruled:
            other = OTHER_WORDS & own
            if name in ARTICLE_ELEMENTS and not article:
                other &= COMMENT
            if name in OTHER_ELEMENTS or other:
                return 0, path
            if not article and name not in ARTICLE_ELEMENTS and (name == "header" or OUTSIDE_WORDS & own):
                return 0, path
        article = article or name in ARTICLE_ELEMENTS or bool(ARTICLE_WORDS & own)
    return (2 if article else 1), ""


def place(label: str, overruled: frozenset[str] = frozenset(), weak: bool = True) -> int:
    return placed(label, overruled, weak)[0]


def like_article(steps: str) -> bool:
    """Whether an element on a path is an article's, or its heading."""
    own = [set(step.split(".")) for step in steps.split(">")[:-1]]
    return not any(COMMENT_WORDS & x and not ARTICLE_WORDS & x for x in own) and any(x & (ARTICLE_ELEMENTS | ARTICLE_WORDS | {"h1"}) for x in own)


def checksum(text: str) -> int:
    """Of one slot; the lower 32 bits count the slots, the others are the polynomial."""
    text = text.strip()
    return zlib.crc32(text.encode("utf-8", "surrogatepass")) + 1 << 32 | 1 if text else 0


def joined(sums: list[int | None]) -> int | None:
    """The checksum of slots one after the other; None if one varies."""
    value = number = 0
    for x in sums:
        if x is None:
            return None
        slots = x & 0xFFFFFFFF
        value, number = (value * pow(BASE, slots, MODULUS) + (x >> 32)) % MODULUS, number + slots
    return value << 32 | number


def rows_of(x: str, y: str) -> Iterator[int]:
    """For each prefix of ``y``, the bit row of its longest common subsequences with the prefixes of ``x``: bit i is 0 where one more character of ``x`` makes it longer."""
    places: dict[str, int] = {}
    for i, v in enumerate(x):
        places[v] = places.get(v, 0) | 1 << i
    full = (1 << len(x)) - 1
    row = full
    for v in y:
        matches = row & places.get(v, 0)
        row = (row + matches | row - matches) & full
        yield row


def lengths(x: str, y: str) -> Any:
    """Lengths of the longest common subsequences of ``y`` with each prefix of ``x``, the empty one first."""
    import numpy as np

    for row in rows_of(x, y):
        pass
    bits = np.unpackbits(np.frombuffer(row.to_bytes(-(-len(x) // 8), "little"), np.uint8), bitorder="little")[: len(x)]
    return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])


def aligned(a: str, b: str) -> list[tuple[int, int]]:
    """Pairs of places of a longest common subsequence.

    Parts of up to ``MOST_CELLS`` pairs of places are traced back through their bit rows; larger
    ones are halved where the lengths for both halves add up to the most, so that memory stays
    linear in the longer page.
    """
    low = 0
    while low < min(len(a), len(b)) and a[low] == b[low]:
        low += 1
    high = 0
    while high < min(len(a), len(b)) - low and a[-1 - high] == b[-1 - high]:
        high += 1
    pairs = [(i, i) for i in range(low)]
    todo = [(low, len(a) - high, low, len(b) - high)]
    while todo:
        left, right, top, bottom = todo.pop()
        x, y = a[left:right], b[top:bottom]
        if not x or not y:
            continue
        if len(y) > 1 and len(x) * len(y) > MOST_CELLS:
            middle = len(y) // 2
            cut = int((lengths(x, y[:middle]) + lengths(x[::-1], y[middle:][::-1])[::-1]).argmax())
            todo += [(left + cut, right, top + middle, bottom), (left, left + cut, top, top + middle)]
            continue
        rows = list(rows_of(x, y))
        i, j, back = len(x), len(y), []
        while i and j:
            if rows[j - 1] >> (i - 1) & 1:
                i -= 1
                continue
            j -= 1
            if not j or rows[j - 1] >> (i - 1) & 1:
                i -= 1
                back.append((left + i, top + j))
        pairs += reversed(back)
    return pairs + [(len(a) - k, len(b) - k) for k in range(high, 0, -1)]


def added(x: dict[str, int], y: dict[str, int]) -> dict[str, int]:
    return {**x, **{k: x.get(k, 0) + n for k, n in y.items()}} if y else x


class Wrapper:
    """The regular expression of a host's pages.

    Inside, each label and each repeated group is one character, so that a stream is a string.
    ``names`` are the labels, ``groups`` what a group's character repeats, in the order of their
    finding. An item is [character, pages that have it, checksum of its text or None if it varies,
    characters of its text over all pages by the label of their slots]; one that fewer than all
    pages have is optional. Copies of a page say nothing of what is constant,
    so ``first`` is the digest of the first page's tokens and texts and ``many`` whether another differs.
    """

    FIRST = 0xF0000

    def __init__(self) -> None:
        self.pages = 0
        self.first, self.many = "", False
        self.items: list[list[Any]] = []
        self.names: list[str] = []
        self.index: dict[str, str] = {}
        self.groups: dict[str, str] = {}
        self.patterns: list[tuple[str, re.Pattern]] = []
        self.known: dict[str, list[tuple[int, int]]] = {}

    def char(self, name: str) -> str:
        if name not in self.index:
            self.index[name] = chr(self.FIRST + len(self.names))
            self.names.append(name)
        return self.index[name]

    def group(self, block: str) -> str:
        """The character of the group that repeats ``block``; a new one changes what streams fold to."""
        char = self.char("(" + block + ")+")
        if char not in self.groups:
            self.groups[char] = block
            self.patterns.append((char, re.compile("(?:" + block + "|" + char + ")+")))
        return char

    def fold(self, labels: str, learn: bool = True) -> tuple[str, list[int]]:
        """The stream with its repetitions folded, those known also where they stand once, and the first token of each item."""
        starts = list(range(len(labels)))
        while True:
            before = labels
            for char, pattern in self.patterns:
                if self.groups[char][0] not in labels:
                    continue
                out, kept, last = [], [], 0
                for m in pattern.finditer(labels):
                    out.append(labels[last : m.start()] + char)
                    kept += starts[last : m.start() + 1]
                    last = m.end()
                if last:
                    labels, starts = "".join(out) + labels[last:], kept + starts[last:]
            if labels != before:
                continue
            m = REPEATED.search(labels) if learn else None
            if m is None:
                return labels, starts
            self.group(m[1])

    def align(self, labels: str) -> list[tuple[int, int]]:
        if labels not in self.known:
            if len(self.known) > 1000:
                self.known = {}
            self.known[labels] = aligned("".join(x[0] for x in self.items), labels)
        return self.known[labels]

    def folded(self, items: list[list[Any]], labels: str, pages: int) -> list[list[Any]]:
        """Items put together where the stream of their characters, ``labels``, folds."""
        folded, starts = self.fold(labels)
        out = []
        for c, i, j in zip(folded, starts, [*starts[1:], len(items)]):
            run = items[i:j]
            constant = joined([x[2] for x in run]) if j == i + 1 or all(x[1] == pages for x in run) else None
            sizes = run[0][3]
            for x in run[1:]:
                sizes = added(sizes, x[3])
            out.append([c, max(x[1] for x in run), constant, sizes])
        return out

    def take(self, pages: int, items: list[list[Any]]) -> None:
        """Aligns folded items, of one page or of another wrapper, and takes them in."""
        own = "".join(x[0] for x in self.items)
        if self.fold(own)[0] != own:  # a repetition was found that the items hold unfolded
            self.items = self.folded(self.items, own, self.pages)
            self.known = {}
        self.pages += pages
        if not self.items:
            self.items = items
            return
        pairs = self.align("".join(x[0] for x in items))
        for i, j in pairs:
            x, y = self.items[i], items[j]
            self.items[i] = [x[0], x[1] + y[1], x[2] if x[2] == y[2] else None, added(x[3], y[3])]
        if len(pairs) < len(items):
            out, i, j = [], 0, 0
            for a, b in [*pairs, (len(self.items), len(items))]:
                out += self.items[i:a] + items[j:b] + self.items[a : a + 1]
                i, j = a + 1, b + 1
            self.items, self.known = out, {}

    def differs(self, first: str, many: bool = False) -> None:
        self.many = self.many or many or bool(self.first and first and self.first != first)
        self.first = self.first or first

    def page(self, labels: list[str], texts: list[str]) -> None:
        self.differs(hashlib.sha256("\0".join([*labels, *texts]).encode("utf-8", "surrogatepass")).hexdigest())
        items = []
        for x, text in zip(labels, texts):
            size = len(text.strip())
            items.append([self.char(x), 1, checksum(text), {x: size} if size else {}])
        self.take(1, self.folded(items, "".join(x[0] for x in items), 1))

    def merge(self, other: Wrapper) -> None:
        self.differs(other.first, other.many)
        own: dict[str, str] = {}
        for i, name in enumerate(other.names):
            c = chr(self.FIRST + i)
            own[c] = self.group("".join(own[x] for x in other.groups[c])) if c in other.groups else self.char(name)
        items = [[own[x[0]], *x[1:]] for x in other.items]
        self.take(other.pages, self.folded(items, "".join(x[0] for x in items), other.pages))

    def dump(self) -> bytes:
        return zlib.compress(json.dumps([self.pages, self.first, self.many, self.items, self.names, self.groups]).encode())

    @classmethod
    def load(cls, data: bytes) -> Wrapper:
        out = cls()
        out.pages, out.first, out.many, out.items, names, groups = json.loads(zlib.decompress(data))
        for i, name in enumerate(names):
            c = chr(cls.FIRST + i)
            assert (out.group(groups[c]) if c in groups else out.char(name)) == c
        return out

    def template(self, labels: list[str]) -> set[int]:
        """The tokens of a page whose text is the same on all pages of the host, groups as a whole."""
        if not self.many:
            return set()
        folded, starts = self.fold("".join(map(self.char, labels)), learn=False)
        ends, out = [*starts[1:], len(labels)], set()
        for a, b in self.align(folded):
            if self.items[a][2] is not None and self.items[a][1] == self.pages:
                out.update(range(starts[b], ends[b]))
        return out

    @cached_property
    def weights(self) -> dict[str, int]:
        """Characters by label that differ between the host's pages; on a host with one page, or copies of one, all of them."""
        out: dict[str, int] = {}
        for x in self.items:
            if not self.many or x[2] is None or x[1] < self.pages:
                for label, n in x[3].items():
                    out[label] = out.get(label, 0) + n
        return out

    @cached_property
    def overruled(self) -> frozenset[str]:
        """Paths of parts that elements and words put outside of the article, but that hold what differs between pages.

        One by one, the heaviest such part is taken back in, those with an article's element, words
        or heading first, while it outweighs what is left by ``OUTWEIGHED`` (``OUTWEIGHED_ARTICLE``
        with such). A labelled article that isn't outweighed itself ends this, and parts of reader
        comments are taken back in only if nothing else differs.
        """
        out: frozenset[str] = frozenset()
        while True:
            left, held, articles = [0, 0, 0], {}, set()
            for label, n in self.weights.items():
                at, path = placed(label, out)
                left[at] += n
                if not at:
                    held[path] = held.get(path, 0) + n
                    if like_article(path[path[:-1].rfind(">") + 1 :] + label[len(path) :]):
                        articles.add(path)
            if not held or left[2] and left[2] * OUTWEIGHED >= left[1]:
                return out
            for path in sorted(held, key=lambda p: (p not in articles, -held[p], p)):
                words = set(path[path[:-1].rfind(">") + 1 : -1].split("."))
                if held[path] > left[1] * (OUTWEIGHED_ARTICLE if path in articles else OUTWEIGHED) and (path in articles or not left[1] or not words & COMMENT_WORDS):
                    out |= {path}
                    break
            else:
                return out

    @cached_property
    def confirmed(self) -> bool:
        """Whether what differs between the host's pages doesn't outweigh what words tell of as their article."""
        inside = sum(n for label, n in self.sizes.items() if place(label, self.overruled) == 2)
        return not self.many or inside * OUTWEIGHED >= sum(n for label, n in self.weights.items() if place(label, self.overruled) == 1)

    @cached_property
    def sizes(self) -> dict[str, int]:
        """Characters by label of all the host's pages."""
        out: dict[str, int] = {}
        for x in self.items:
            for label, n in x[3].items():
                out[label] = out.get(label, 0) + n
        return out

    def kept(self, labels: list[str], texts: list[str]) -> set[int]:
        """The tokens whose text is that of the article."""
        fixed = self.template(labels)
        slots = [i for i, x in enumerate(labels) if x[-1] == "#"]
        places = {i: place(labels[i], self.overruled) for i in slots}
        shown = [i for i in slots if texts[i].strip()]
        inside = any(places[i] == 2 for i in shown)
        if inside and self.confirmed:
            return {i for i in slots if places[i] == 2}
        out = {i for i in slots if places[i] == 2 or places[i] == 1 and i not in fixed}
        if self.many and not any(i in out for i in shown):  # the words leave nothing: what differs is the article
            out = {i for i in slots if i not in fixed and place(labels[i], self.overruled, weak=False)}
        if not any(i in out for i in shown):
            out = {i for i in slots if places[i]}
        own = [i for i in shown if i in out]
        for a, b in zip(own, own[1:]):  # constant text in between, in the element that holds both
            between = [i for i in range(a + 1, b) if i not in out and places.get(i) == 1]
            for i in between:
                parent = labels[i][: labels[i].rstrip("#").rstrip(">").rfind(">") + 1]
                if all(x.startswith(parent) for x in labels[a : b + 1]):
                    out.add(i)
        return out

    def text(self, page: str) -> str:
        """The main text of a page."""
        labels, texts, breaks = stream(page)
        kept = self.kept(labels, texts)
        blocks: list[str] = []
        for i, (t, new) in enumerate(zip(texts, breaks)):
            if new or not blocks:
                blocks.append("")
            if i in kept:
                blocks[-1] += t
        return "\n\n".join(x for b in blocks if (x := SPACE.sub(" ", b).strip()))


def host_of(url_col: str = "url"):
    return F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)", 1))


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper) of all hosts of (host, html)."""

    def infer(batches: Iterator) -> Iterator:
        import pyarrow as pa

        found: dict[str, Wrapper] = {}
        for batch in batches:
            for host, page in zip(batch.column(0), batch.column(1)):
                labels, texts, _ = stream(page.as_py())
                found.setdefault(host.as_py(), Wrapper()).page(labels, texts)
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array([w.dump() for w in found.values()], pa.binary())], ["host", "wrapper"])

    def merge(group):
        out = Wrapper()
        for data in group.sort_values("part")["wrapper"]:
            out.merge(Wrapper.load(data))
        group = group.iloc[:1].copy()
        group["wrapper"] = [out.dump()]
        return group

    now = stored(pages.mapInArrow(infer, "host string, wrapper binary").withColumn("part", F.spark_partition_id().cast("long")), "wrappers")
    parts = (now.agg(F.max("part")).first()[0] or 0) + 1
    while parts > 1:
        up = now.withColumn("above", F.floor(F.col("part") / FAN_IN)).groupBy("host", "above").applyInPandas(lambda g: merge(g).assign(part=g["above"].iloc[0])[["host", "wrapper", "part"]], "host string, wrapper binary, part long")
        after = stored(up, "wrappers")
        removed(now)
        now, parts = after, -(-parts // FAN_IN)
    return now.select("host", "wrapper")


def main_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text) of every page.

    Pages and wrappers are dealt by host and a salt and sorted so that the wrapper comes before
    the pages it is for; a host with many pages is spread over ``SALTS`` tasks.
    """
    slim = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), host_of(url_col).alias("host"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    found = wrappers(slim.select("host", "html"))
    salted = slim.withColumn("salt", F.pmod(F.xxhash64("page_id", "html"), F.lit(SALTS)).cast("int")).withColumn("wrapper", F.lit(None).cast("binary"))
    spread = found.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    both = salted.unionByName(spread, allowMissingColumns=True).select("host", "salt", "wrapper", "page_id", "url", "html")
    dealt = both.repartition("host", "salt").sortWithinPartitions("host", "salt", F.col("wrapper").isNull())

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        wrapper = Wrapper()
        for batch in batches:
            kept, texts = [], []
            for i, (data, page) in enumerate(zip(batch.column(2), batch.column(5))):
                if data.is_valid:
                    wrapper = Wrapper.load(data.as_py())
                else:
                    kept.append(i)
                    texts.append(wrapper.text(page.as_py()))
            rows = batch.take(pa.array(kept, pa.int64()))
            yield pa.RecordBatch.from_arrays([rows.column(3), rows.column(4), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    return dealt.mapInArrow(run, f"page_id {slim.schema['page_id'].dataType.simpleString()}, url string, text string")


def op4(pages: DataFrame) -> DataFrame:
    return main_texts(pages).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
