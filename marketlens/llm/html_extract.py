"""HTML extraction by a maximum-scoring subsequence.

A page is a sequence of tags and words, and both get their weights from labelled
pages (`labelled_pages`), in which the wanted region and the furniture that it
encloses are marked:

* a word scores 2p - 1, where p is the learned probability that a word in such
  surroundings (elements, and the parts of their names, that are open around it)
  is wanted, and not under `LEAST`;
* a tag scores minus the share of its kind that stands outside wanted regions, so
  it costs something between nothing and one word; its kind is its name and
  whether p is at least `SURE` around it.

One linear scan finds the contiguous region of the largest sum.  Elements that
the region encloses and that look, by their own tag and names, like the marked
furniture inside the labelled regions are cut out of it, and a tag in them costs
the scan at most `ENCLOSED`; surroundings opened before the region never cut
anything.  Names are only evidence: they are
features of the labelled pages and nothing else decides by them.

Text rules: character references are decoded, white space inside a block
becomes one space, blocks are joined by one space; inline tags add nothing.

Cases: a null or empty page gives an empty text; very long pages are read whole,
in time linear in their length and one page at a time; markup cut off at the end
of the page is dropped, and an attribute whose quote is never closed ends with
its tag; a page whose best region has no positive sum gives an empty text; of
regions of equal sum the one that ends first is taken; repeated rows and null
ids are each returned; an empty table gives no rows; further columns pass
through, and the result column replaces one of its name.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# A quoted value ends where a quote is followed by space, slash or the tag's end.
MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|textarea|select|svg|iframe|object|math)\b.*?(?:</\1\s*>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"(?=[\s/>])|'[^']*'(?=[\s/>]))*(?:>|\Z)|[^>]*(?:>|\Z))",
    re.S | re.I)
ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop|aria-label|hidden|style)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

# Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q "
                   "rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
PAGE = frozenset(["html", "body"])
CLOSE_ONLY_THEMSELVES = frozenset(["article", "main", "body"])
ABOUT_OTHERS = frozenset(["has", "with", "no", "without"])  # `has-sidebar` is not a sidebar
STEM = 5
LEAST, SURE, ENCLOSED = -0.25, 0.9, 0.1

# Marks of the labelled pages: the wanted region, and furniture inside it.
BEGIN, END, CUT, UNCUT = "<!--begin-->", "<!--end-->", "<!--cut-->", "<!--uncut-->"
MARKS = frozenset([BEGIN, END, CUT, UNCUT])
_WORDS = "the council met on monday to talk about the new bridge and its cost for the town".split()


def _sentence(n: int) -> str:
    return " ".join(_WORDS[i % len(_WORDS)] for i in range(n)) + "."


def _named(tag: str, names: str, inner: str) -> list[str]:
    """The part under each of the names, as class, id or role in turn."""
    keys = ("class", "id", "class", "role")
    return [f'<{tag} {keys[i % 4]}="{name}">{inner}</{tag}>' for i, name in enumerate(names.split())]


def labelled_parts() -> dict[str, list[str]]:
    """The parts that labelled pages are put together from, by what they are."""
    links = "".join(f'<li><a href="/{w}">{w}</a></li>' for w in _WORDS[:6])
    items = "".join(f"<li>{w} us</li>" for w in _WORDS[:4])
    more = f"<h3>More</h3><ul><li>{_sentence(6)}</li><li>{_sentence(5)}</li></ul>"
    note = f"<h3>Comments</h3><div><p>{_sentence(14)}</p></div><div><p>{_sentence(9)}</p></div>"
    asked = f"<label>{_sentence(4)}</label><input name=q><button>Go</button>"
    return {
        "menu": [f"<nav><ul>{links}</ul></nav>", f"<div><ul>{links}</ul></div>", f"<div><ul>{items}</ul></div>",
                 f"<ul>{links}</ul>", "<div>" + "".join(f'<a href="/{w}">{w}</a> | ' for w in _WORDS[:5]) + "</div>",
                 f"<menu>{links}</menu>",
                 *_named("div", "nav navbar navigation main-menu menu menubar top-navigation breadcrumb breadcrumbs "
                         "pagination pager tabs toc", f"<ul>{links}</ul>")],
        "header": [f"<header><h1>Daily page</h1><p>{_sentence(5)}</p></header>",
                   *_named("div", "header masthead banner topbar site-header page-header", f"<p>{_sentence(6)}</p>")],
        "footer": [f"<footer>&copy; example &middot; {_sentence(9)}</footer>", f"<footer><p>{_sentence(12)}</p></footer>",
                   *_named("div", "footer copyright colophon contentinfo site-footer footer-content", f"<p>{_sentence(8)}</p>")],
        "aside": [f"<aside>{more}</aside>", f"<aside><p>{_sentence(18)}</p></aside>",
                  *_named("div", "sidebar side-bar sidebar-widget complementary related related-posts recommended "
                          "recommendations trending popular most-read", more)],
        "notice": [f"<dialog><p>{_sentence(7)}</p></dialog>",
                   *_named("div", "cookie cookies cookie-notice cookie-banner consent gdpr notice alert popup modal overlay "
                           "toast newsletter newsletter-box subscribe subscription paywall", f"<p>{_sentence(10)}</p>")],
        "advert": [*_named("div", "ad ads ad-slot advert advertisement adverts advertising sponsor sponsored "
                           "sponsored-content promo promotion banner-ad", _sentence(12)),
                   '<div style="display: none">' + _sentence(9) + "</div>", f"<div hidden>{_sentence(8)}</div>"],
        "form": [f'<form action="/s">{asked}</form>', f"<form><p>{_sentence(8)}</p>{asked}</form>",
                 *_named("div", "search search-box login signup login-form", asked),
                 *_named("div", "share sharing social social-links", f"<ul>{links}</ul>")],
        "comments": [*_named("section", "comments comment-list commentlist discussion replies respond disqus reply "
                             "reader-comments", note), *_named("div", "comments comment replies", note)],
    }


def labelled_pages() -> list[str]:
    """Small pages of many layouts, put together by rule from labelled parts."""
    parts = labelled_parts()
    opened = [("<article>", "</article>"), ("<main>", "</main>"), ("<div>", "</div>"), ("<section>", "</section>"),
              ('<div class="layout has-sidebar"><article>', "</article></div>"), ("<table><tr><td>", "</td></tr></table>"),
              ('<article class="post">', "</article>"), ("<div><div>", "</div></div>"), ("<main><article>", "</article></main>"),
              *((f'<div class="{n}">', "</div>") for n in (
                  "post-content", "entry", "story-body", "article-text", "page-content", "main-column", "content", "articleBody",
                  "post", "story", "text-widget", "widget-content", "body-copy")),
              *((f'<div class="{n}"><article>', "</article></div>") for n in (
                  "sidebar-layout", "ad-free", "comments-open", "menu-open page", "header-fixed wrapper")),
              ('<div id="footer-sticky" class="container"><main>', "</main></div>")]
    bodies = [f"<p>{_sentence(40)}</p><p>{_sentence(25)} <b>{_sentence(6)}</b></p>",
              f"<p>{_sentence(30)}<br>{_sentence(20)}<p>{_sentence(4)}</p><ul><li>{_sentence(8)}</li><li>{_sentence(11)}</li></ul>",
              f'<p>{_sentence(12)} <a href="/b">{_sentence(3)}</a> {_sentence(15)}</p><p>{_sentence(35)}</p>',
              f"{_sentence(45)}<h2>The cost</h2>{_sentence(20)}",
              f"<h2>The bridge</h2><p>{_sentence(28)}</p><blockquote><p>{_sentence(12)}</p></blockquote>",
              f"<ol><li>{_sentence(14)}</li><li><a href=/c>{_sentence(4)}</a> {_sentence(9)}</li></ol><p>{_sentence(30)}</p>",
              f"<p>{_sentence(16)}</p><ul>" + "".join(f"<li>{_sentence(7 + n)}</li>" for n in range(5)) + "</ul>",
              f"<h2>Who came</h2><ul>" + "".join(f"<li><p>{_sentence(9 + n)}</p></li>" for n in range(3)) + f"</ul><p>{_sentence(21)}</p>",
              f"<p>{_sentence(22)}</p><table><tr><td>{_sentence(5)}</td><td>{_sentence(4)}</td></tr></table><p>{_sentence(18)}</p>"]
    head = "<!DOCTYPE html><html><head><meta charset=utf-8><title>A bridge for the town</title><style>p{}</style></head><body>"
    before, after = ("menu", "header", "notice", "advert", "form"), ("aside", "comments", "form", "menu", "advert", "notice")
    inside = ("advert", "aside", "form", "comments", "notice", "menu", "header", "footer")
    used = Counter()

    def part(kind: str) -> str:
        # A bare list may be an article's own, so it is never furniture inside one.
        made = [p for p in parts[kind] if not p.startswith(("<div><", "<ul>"))] if kind.endswith("!") else parts[kind]
        used[kind] += 1
        return made[used[kind] % len(made)]

    for kind in inside:
        parts[f"{kind}!"] = [p for p in parts[kind] if not p.startswith(("<div><", "<ul>"))]
    pages = []
    for n in range(12 * len(opened)):
        opening, closing = opened[n % len(opened)]
        title = ("<h1>A bridge for the town</h1>", "", "<h2>A bridge</h2>")[n % 3]
        cut = "" if n % 3 == 0 else CUT + part(inside[n // 2 % len(inside)] + "!") + UNCUT
        body = title + bodies[n % len(bodies)] + cut + bodies[(n // 2 + 3) % len(bodies)] + f"<p>{_sentence(3 + n % 9)}</p>"
        pages.append(head + part("menu") + part(before[n % len(before)]) + part(before[n // 3 % len(before)])
                     + BEGIN + opening + body + closing + END
                     + part(after[n % len(after)]) + part(after[n // 4 % len(after)]) + part("footer") + "</body></html>")
    return pages


def features(name: str, attributes: str) -> frozenset[str]:
    """What an element itself tells: its tag, the parts of its names and their stems."""
    out = set() if name in PAGE or name in INLINE and name != "a" else {f"<{name}>"}
    if attributes and name not in PAGE:
        for key, value in ATTRIBUTE.findall(attributes):
            key, value = key.lower(), value.strip("\"'")
            if key == "hidden" or key == "style" and "display:none" in value.replace(" ", "").lower():
                out.add("unseen")
            elif key != "style":
                about = ""
                for part in NAME_PARTS.findall(value):
                    part = about + part.lower()
                    about = f"{part} " if part in ABOUT_OTHERS else ""
                    if not about:
                        out.add(part)
                        if len(part) > STEM and " " not in part:
                            out.add(part[:STEM] + "*")
    return frozenset(out)


class Token(NamedTuple):
    kind: str                  # "word", "mark", or a tag such as "li" and "/li"
    text: str                  # the words' text; " " for what ends a block
    words: int
    around: frozenset[str]     # features of all elements that are open around it
    own: frozenset[str]        # features of an opening tag itself
    opened: tuple[int, ...]    # where the elements open around it begin


def tokens(page: str) -> Iterator[Token]:
    """A page's tags and texts in order."""
    stack: list[tuple[str, frozenset[str]]] = []  # name, features of it and all around it
    begun: tuple[int, ...] = ()
    at = count = 0
    nothing: frozenset[str] = frozenset()

    def around() -> frozenset[str]:
        return stack[-1][1] if stack else nothing

    def text(raw: str) -> Token:
        shown = entities.unescape(raw) if "&" in raw else raw
        return Token("word", shown, len(shown.split()), around(), nothing, begun)

    for m in MARKUP.finditer(page):
        if m.start() > at:
            yield text(page[at:m.start()])
            count += 1
        at = m.end()
        if not m[3]:
            yield Token("mark" if m[0] in MARKS else "raw", m[0] if m[0] in MARKS else " " if m[1] else "", 0, nothing, nothing, ())
            count += 1
            continue
        name, own, outer = m[3].lower(), nothing, around()
        if not m[2]:
            own = features(name, m[4].rstrip(">"))
            if name not in VOID and not m[4].rstrip("> ").endswith("/"):
                if name == "p" and stack and stack[-1][0] == "p":
                    stack.pop()
                    begun, outer = begun[:-1], around()
                stack.append((name, outer | own))
                begun += (count,)
        else:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    del stack[i:]
                    begun = begun[:i]
                    break
                if stack[i][0] in CLOSE_ONLY_THEMSELVES and name not in PAGE:
                    break  # a stray closing tag does not close its surroundings
            outer = around()
        yield Token(m[2] + name, "" if name in INLINE else " ", 0, outer, own, begun)
        count += 1
    if at < len(page):
        tail = page[at:]
        cut = tail.rfind("<")
        if cut >= 0 and re.fullmatch(r"</?[a-zA-Z!]?[^>]*", tail[cut:], re.S):
            tail = tail[:cut]  # a tag that the page's end cuts off
        yield text(tail)


class Evidence(NamedTuple):
    """A logistic model over sets of features; features never seen weigh nothing."""
    bias: float
    weight: dict[str, float]

    def probability(self, around: Iterable[str]) -> float:
        return float(1 / (1 + np.exp(-self.bias - sum(self.weight.get(f, 0.0) for f in around))))


def fit(counts: dict[frozenset[str], list[int]], ridge: float = 0.05, rounds: int = 40) -> Evidence:
    """From how often each set of features was [unwanted, wanted], by Newton steps."""
    names = {f: i for i, f in enumerate(sorted(set().union(*counts)))}
    x = np.zeros((len(counts), len(names) + 1))
    x[:, -1] = 1
    for row, around in enumerate(counts):
        x[row, [names[f] for f in around]] = 1
    no, yes = np.array(list(counts.values()), dtype=float).T
    keep = ridge * np.eye(x.shape[1])
    keep[-1, -1] = 1e-6  # the bias is free
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (yes - p * (no + yes)) - keep @ w
        step = np.linalg.solve((x.T * (p * (1 - p) * (no + yes))) @ x + keep, slope)
        w = w + step * min(1.0, 4.0 / max(np.abs(step).max(), 1e-9))
    return Evidence(float(w[-1]), {f: float(w[i]) for f, i in names.items()})


class Weights(NamedTuple):
    wanted: Evidence           # of words, by their surroundings
    tag: dict[tuple[str, bool], float]  # of tags, by their kind
    unknown_tag: dict[bool, float]
    cut: Evidence              # of elements inside a region, by their own features


def weights(pages: list[str] | None = None) -> Weights:
    """Learned from labelled pages, by default those of `labelled_pages`."""
    words, tags, elements = (defaultdict(lambda: [0, 0]) for _ in range(3))
    for page in labelled_pages() if pages is None else pages:
        wanted = cutting = first = False
        for t in tokens(page):
            if t.kind == "mark":
                wanted, cutting = (t.text == BEGIN, False) if t.text in (BEGIN, END) else (wanted, t.text == CUT)
                first = cutting
            elif t.kind == "word":
                words[t.around][wanted and not cutting] += t.words
            else:
                tags[t.kind, t.around][wanted and not cutting] += 1
                if wanted and t.own and (first or not cutting):
                    elements[t.own][cutting] += 1
                    first = False
    wanted_words = fit(words)
    kinds = defaultdict(lambda: [0, 0])
    for (kind, around), (outside, inside) in tags.items():
        for k in (kind, ""):
            counted = kinds[k, wanted_words.probability(around) >= SURE]
            counted[0] += outside
            counted[1] += inside
    share = {k: -(outside + 1) / (inside + outside + 2) for k, (outside, inside) in kinds.items()}
    return Weights(wanted_words, share, {sure: share["", sure] for sure in (False, True)}, fit(elements))


def best_region(scores: Iterable[float]) -> tuple[int, int]:
    """[begin, end) of the contiguous run of the largest positive sum."""
    best = total = 0.0
    begin, region = 0, (0, 0)
    for i, score in enumerate(scores):
        total += score
        if total <= 0:
            total, begin = 0.0, i + 1
        elif total > best:
            best, region = total, (begin, i + 1)
    return region


class Extractor:
    """Extracts with given weights; probabilities are kept per set of features."""

    KEPT = 100_000

    def __init__(self, learned: Weights):
        self.learned = learned
        self.word: dict[frozenset[str], float] = {}
        self.furniture: dict[frozenset[str], bool] = {}

    def value(self, around: frozenset[str]) -> float:
        if around not in self.word:
            if len(self.word) >= self.KEPT:
                self.word.clear()
            self.word[around] = 2 * self.learned.wanted.probability(around) - 1
        return self.word[around]

    def score(self, t: Token) -> float:
        if t.kind == "word":
            return max(LEAST, self.value(t.around)) * t.words
        if t.kind in ("mark", "raw"):
            return 0.0
        sure = self.value(t.around) >= 2 * SURE - 1
        return self.learned.tag.get((t.kind, sure), self.learned.unknown_tag[sure])

    def is_furniture(self, t: Token) -> bool:
        if t.own not in self.furniture:
            if len(self.furniture) >= self.KEPT:
                self.furniture.clear()
            self.furniture[t.own] = self.learned.cut.probability(t.own) > 0.5
        return self.furniture[t.own]

    def __call__(self, page: str | None) -> str:
        if not page:
            return ""
        parts = list(tokens(page))
        furniture = {i for i, t in enumerate(parts) if t.own and self.is_furniture(t)}
        begin, end = best_region(
            self.score(t) if furniture.isdisjoint(t.opened) else max(self.score(t), LEAST * t.words - ENCLOSED) for t in parts)
        furniture = {i for i in furniture if i >= begin}
        out = []
        for t in parts[begin:end]:
            if t.kind != "word":
                out.append(t.text if t.kind != "mark" else "")
            elif furniture.isdisjoint(t.opened):
                out.append(t.text)
        return " ".join("".join(out).split())


def extract(page: str | None, learned: Weights | None = None) -> str:
    """Main text of a page, by the given weights or those of the labelled pages."""
    return Extractor(weights() if learned is None else learned)(page)


def extract_pages(df: DataFrame, html: str, out: str = "text", learned: Weights | None = None) -> DataFrame:
    """Replace `html` by the main text, in column `out`."""
    gone = {html.lower(), out.lower()}
    schema = T.StructType([f for f in df.schema.fields if f.name.lower() not in gone]
                          + [T.StructField(out, T.StringType(), False)])
    learned = weights() if learned is None else learned

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        main_text = Extractor(learned)
        for batch in batches:
            found = pa.array([main_text(p.as_py()) for p in batch.column(html)], pa.string())
            keep = [(n, c) for n, c in zip(batch.schema.names, batch.columns) if n.lower() not in gone]
            yield pa.RecordBatch.from_arrays([c for _, c in keep] + [found], names=[n for n, _ in keep] + [out])

    return df.mapInArrow(run, schema)
