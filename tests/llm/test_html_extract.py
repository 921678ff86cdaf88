import html
import random
import re

from conftest import SF_ORACLE
from marketlens.llm import html_extract as H
from marketlens.llm.queries import op4_html_text

BODY = "<p>The harbour was <b>quiet</b> all&nbsp;day &amp; night.</p>\n<p>Nobody   came\nby; the boats lay still.</p>"
WANT = "The harbour was quiet all day & night. Nobody came by; the boats lay still."
MENU = "<nav><ul><li><a href=/a>Home</a></li><li><a href=/b>About us</a></li></ul></nav>"
FOOT = "<footer><p>Copyright 2024 by the harbour news</p></footer>"


def page(inner, before=MENU, after=FOOT):
    return ("<!DOCTYPE html><html><head><title>Harbour</title><style>p{color:red}</style>"
            f"<script>if (a < b) document.write('<p>no</p>')</script></head><body>{before}{inner}{after}</body></html>")


def test_furniture_goes_and_text_rules_hold():
    cases = {
        "article": page(f"<article>{BODY}</article>"),
        "main": page(f"<main>{BODY}</main>"),
        "named": page(f'<div class="post-content">{BODY}</div>'),
        "bare": page(f"<div>{BODY}</div>"),
        "header": page(f"<article>{BODY}</article>", "<header><h1>Harbour News</h1><p>Since 1901</p></header>" + MENU),
        "sidebar": page(f"<article>{BODY}</article>", MENU + '<div id="sidebar"><p>More to read here today</p></div>'),
        "advert": page(f'<article><p>The harbour was <b>quiet</b> all&nbsp;day &amp; night.</p><div class="ad">Buy boats now'
                       "</div><p>Nobody   came\nby; the boats lay still.</p></article>"),
        "notice": page(f"<article>{BODY}</article>", '<div class="cookie-banner">We use cookies <button>OK</button></div>'),
        "form": page(f"<article>{BODY}<form><label>Your name</label><input><select><option>One</option></select></form></article>"),
        "comments": page(f"<article>{BODY}</article>", after='<section id="comments"><h2>Comments</h2><p>I liked this '
                         "text about the harbour very much indeed</p><p>So did I and my boat too</p></section>" + FOOT),
        "inner comments": page(f'<article>{BODY}<div class="commentlist"><p>First of all readers here</p></div></article>'),
        "script": page(f"<article>{BODY}<script>var x = '</p> words';</script><!-- hidden words --></article>"),
        "hidden": page(f'<article>{BODY}<div style="display: none">unseen words</div></article>'),
        "unclosed": page(f"<article>{BODY.replace('</p>', '').replace('</b>', '</b>')}</article>"),
    }
    for name, p in cases.items():
        assert H.extract(p) == WANT, name


def test_cut_off_pages_and_odd_input():
    full = page(f"<article>{BODY}</article>")
    for cut in range(0, len(full), 7):
        H.extract(full[:cut])
    assert H.extract(full[:full.index("</article")]) == WANT
    assert H.extract(full[:full.index("</article") + 4]) == WANT
    assert H.extract(None) == "" and H.extract("") == "" and H.extract("<p") == ""
    assert H.extract("<<<>>><p>&#x41;&#66;&bogus;") != None  # noqa: E711
    long = " ".join(f"word{i}" for i in range(200_000))
    assert H.extract(page(f"<article><p>{long}</p></article>")) == long


def wanted_text(labelled):
    """The text between the marks of a labelled page, without what is marked as cut."""
    inner = labelled[labelled.index(H.BEGIN):labelled.index(H.END)]
    inner = re.sub(f"{H.CUT}.*?{H.UNCUT}", " ", inner, flags=re.S)
    return " ".join(html.unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?[ab]\b[^>]*>", "", inner))).split())


def without_scan(p, learned):
    """All words that are more likely wanted than not, wherever they stand."""
    ex = H.Extractor(learned)
    out, furniture = [], set()
    for i, t in enumerate(H.tokens(p)):
        if t.own and ex.is_furniture(t):
            furniture.add(i)
        if t.kind != "word" or ex.value(t.around) > 0 and furniture.isdisjoint(t.opened):
            out.append(t.text)
    return " ".join("".join(out).split())


def test_words_outweigh_tags():
    w = H.weights()
    value = H.Extractor(w).value
    assert value(frozenset(["<article>", "<p>"])) > 0.9 and value(frozenset(["<div>", "<p>"])) > 0.5
    assert all(v < 0 for v in [*w.tag.values(), *w.unknown_tag.values()])
    for unwanted in ({"<nav>", "<ul>", "<li>", "<a>"}, {"<footer>"}, {"<div>", "ad"}, {"<head>", "<title>"}):
        assert value(frozenset(unwanted)) < 0, unwanted


def test_region_equals_brute_force():
    rng = random.Random(5)
    for _ in range(400):
        scores = [rng.choice([-2.0, -1.0, -0.5, 0.0, 0.5, 1.0, 3.0]) for _ in range(rng.randrange(0, 14))]
        begin, end = H.best_region(scores)
        best = max((sum(scores[a:b]) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)), default=0)
        assert sum(scores[begin:end]) == max(best, 0)
        assert (begin, end) == (0, 0) or best > 0


def test_scan_decides_where_names_do_not():
    w = H.weights()
    story = "".join(f"<p>{s}</p>" for s in (
        "The harbour was quiet all day and nobody came by.", "The boats lay still, and the men mended their nets until dark."))
    want = " ".join(re.sub(r"<[^>]*>", " ", story).split())
    listed = "<div><ul><li>Home</li><li>Contact us</li><li>Our prices</li></ul></div>"
    short = "<div><div>Weather</div><div>Sports</div><div>Travel</div></div>"
    for before, after in ((listed, ""), ("", listed), (listed, listed), (short, listed), (short, short)):
        p = f"<html><head><title>Quiet</title></head><body>{before}<div>{story}</div>{after}</body></html>"
        assert H.extract(p, w) == want, (before, after)
        assert without_scan(p, w) != want, (before, after)


def test_misleading_names_and_unclosed_quotes():
    inner = {
        "widget": f'<div class="widget-article">{BODY}</div>',
        "layout": f'<div class="ad-free sidebar-layout"><article>{BODY}</article></div>',
        "quote": f'<div class="menu><a href=/x>Home</a></div><article>{BODY}</article>',
        "quote inside": f'<article><p><a href="/x>{BODY[3:]}</article>',
        "list": f"<div><ul><li>Home</li><li>Contact us</li></ul></div><div>{BODY}</div>",
    }
    for name, p in inner.items():
        assert H.extract(page(p)) == WANT, name


def test_pages_that_were_not_learned_from():
    pages = H.labelled_pages()
    right = sum(H.extract(p, w) == wanted_text(p)
                for k in range(5) for w in [H.weights([p for n, p in enumerate(pages) if n % 5 != k])]
                for n, p in enumerate(pages) if n % 5 == k)
    assert right >= 0.9 * len(pages)  # the others have furniture of a name that no other page has


def test_operator_keeps_rows_and_columns(spark):
    rows = [(1, None, "a", 1), (1, None, "a", 1), (None, page(f"<article>{BODY}</article>"), "b", 2)]
    df = spark.createDataFrame(rows, "page_id long, html string, text string, N_CHARS int")
    out = H.extract_pages(df, "html")
    assert out.columns == ["page_id", "N_CHARS", "text"]
    assert sorted(r.text for r in out.collect()) == ["", "", WANT]
    assert H.extract_pages(df.limit(0), "html").count() == 0


def test_query(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF_ORACLE}/pages.parquet").collect()}
    rows = op4_html_text(spark, SF_ORACLE).collect()
    assert len(rows) == len(pages)
    for r in rows:
        inner = re.search(r"<article>(.*?)(</article>|<footer|\Z)", pages[r.page_id].html, re.S)[1]
        inner = re.sub(r"</?b>", "", inner)
        inner = re.sub(r"<[^>]*(>|\Z)", " ", inner)
        want = " ".join(html.unescape(inner).split())
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, want, len(want))
