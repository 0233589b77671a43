"""Operator 4: hand-made pages of many layouts, and every given page against its article element."""

import html
import math
import random
import re

import pytest

from conftest import SF_MID
from ledgerline.llm.htmltext import CONTAINERS, HEADINGS, INLINE, Page, extract, main_text

LONG = "This is a sentence of the article, with some words; and more of them. "


def page(body, head="<title>Title</title><style>p{}</style><script>var a='<p>x</p>';</script>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


CASES = {
    "article among all kinds of other parts": (
        "<header><h1>Site</h1><nav><ul><li><a href=/>Home</a></li></ul></nav></header><div class='cookie-notice'>" + LONG * 3 + "</div>"
        "<main><article><h1>Head &amp; line</h1><p>One  two\n three.</p><p>To.</p><ul><li>First</li><li>Second</li></ul></article>"
        "<aside>" + LONG * 4 + "</aside><section id=comments><p>" + LONG * 5 + "</p></section></main><form><p>Sign up</p></form>"
        "<footer>&copy; 2020</footer><script>if (a < b) {}</script>", "Head & line\nOne two three.\nTo.\nFirst\nSecond"),
    "no article element": (
        "<div id=header>Top</div><div class=wrap><div class='post-content'><h2>T</h2><p>" + LONG + "</p><p>Ok.</p></div>"
        "<div class='sidebar'><p>" + LONG * 3 + "</p></div></div><div class=footer>End</div>", "T\n" + LONG.strip() + "\nOk."),
    "unclosed paragraphs and inline markup": (
        "<article><p>A <b>bold<br>word<p>B<i>c</i>d<p>E &lt;x&gt; &#233;&eacute;&nbsp;f", "A bold word\nBcd\nE <x> éé f"),
    "links stay in sentences, lists of links go": (
        "<article><p>See <a href=x>this page</a>, please.</p><p><a href=y>Only a link</a></p><ul><li><a href=z>Other story</a></li></ul>"
        "<p>" + LONG + "</p></article>", "See this page, please.\nOnly a link\n" + LONG.strip()),
    "header of the article": (
        "<article><header><h1>Head</h1><div class=byline>By someone</div></header><p>" + LONG + "</p><footer>Tags</footer></article>",
        "Head\n" + LONG.strip()),
    "two articles and an advert between": (
        "<article><p>" + LONG + "</p></article><div class='ad'>" + LONG + "</div><article><p>Second. " + LONG + "</p></article>",
        LONG.strip() + "\nSecond. " + LONG.strip()),
    "hidden parts and comments in the markup": (
        "<article><p>Seen, yes.</p><p hidden>Not</p><p style='display: none'>Nor</p><!-- <p>no</p> --><p>End.</p></article>", "Seen, yes.\nEnd."),
    "table": ("<table><tr><td>a, b<td>c. d</tr></table>", "a, b\nc. d"),
}


@pytest.mark.parametrize("name", CASES)
def test_layouts(name):
    body, want = CASES[name]
    assert main_text(page(body)) == want


BESIDE = {
    "title, intro and end beside a long section": (
        "<div id=content><h1>T</h1><p>Intro</p><div class=section>" + LONG * 9 + "</div><p>End</p></div>",
        "T\nIntro\n" + (LONG * 9).strip() + "\nEnd"),
    "losses on several levels": (
        "<div><p>" + LONG + "</p><section><p>" + LONG * 2 + "</p><table><tr><td>" + LONG * 9 + "</table></section></div>",
        LONG.strip() + "\n" + (LONG * 2).strip() + "\n" + (LONG * 9).strip()),
    "quotation that dominates": ("<h1>T</h1><blockquote>" + LONG * 9 + "</blockquote>Fin.", "T\n" + (LONG * 9).strip() + "\nFin."),
    "a long and a short article": (
        "<article><p>" + LONG * 9 + "</p></article><article><p>Short one.</p></article>", (LONG * 9).strip() + "\nShort one."),
    "title and text beside the article element": (
        "<div><h1>T</h1><p>" + LONG + "</p><article><p>" + LONG * 9 + "</p></article></div>",
        "T\n" + LONG.strip() + "\n" + (LONG * 9).strip()),
    "other lines beside the article element": (
        "<div>Call us</div><div><a href=x>menu</a></div><article><h1>T</h1><p>" + LONG * 2 + "</p></article><div>Made by x</div>",
        "T\n" + (LONG * 2).strip()),
}


@pytest.mark.parametrize("name", BESIDE)
def test_text_beside_a_dominant_part(name):
    body, want = BESIDE[name]
    assert main_text(page(body)) == want


NAMED = {
    "wrapper that has a sidebar": ("<div class='content has-sidebar'><p>One, two.</p><p>Three.</p></div>", "One, two.\nThree."),
    "layout and missing comments": (
        "<div id=layout-sidebar-right><section class=no-comments><p>One, two.</p></section></div><footer>End</footer>", "One, two."),
    "page builder": (
        "<div class='elementor-widget elementor-widget-heading'><h2>T</h2></div>"
        "<div class='elementor-widget elementor-widget-text-editor'><p>" + LONG + "</p></div>", "T\n" + LONG.strip()),
    "boxes of an article": (
        "<article><h1>T</h1><div class=toc><p>Parts: one.</p></div><p>" + LONG + "</p><div class=notice>Note.</div><p class='alert'>Beware.</p>"
        "<p class=copyright>By x.</p><div class=ad>" + LONG + "</div></article>", "T\nParts: one.\n" + LONG.strip() + "\nNote.\nBeware.\nBy x."),
    "box with long text and no article element": (
        "<div><p>" + LONG + "</p><div class=notice><p>" + LONG * 2 + "</p></div><div class=copyright><a href=x>x</a></div></div>",
        LONG.strip() + "\n" + (LONG * 2).strip()),
    "named wrapper of the article element": (
        "<div class=promo>Buy</div><div class='page sidebar'><article><p>Short.</p></article></div>", "Short."),
    "named wrapper of the title": ("<div class=banner><h1>T</h1></div><article><p>" + LONG + "</p></article>", "T\n" + LONG.strip()),
    "named wrapper of most of the text": ("<div class='post sidebar'><p>" + LONG * 5 + "</p></div><p>End.</p>", (LONG * 5).strip() + "\nEnd."),
    "teasers after the article stay out": (
        "<article><h1>T</h1><p>Short.</p></article><div class=related><article><h1>Other</h1><p>" + LONG * 9 + "</p></article></div>", "T\nShort."),
}


@pytest.mark.parametrize("name", NAMED)
def test_ratios_overrule_names(name):
    body, want = NAMED[name]
    assert main_text(page(body)) == want


INSIDE = {
    "self-closed drawings": ("<article><p>A <svg class=x/>b.</p><p>C <math/>d.</p></article><div class=ad><svg><title/><text>x</text></svg></div>",
                             "A b.\nC d."),
    "formulas": ("<article><p>Where <math><mi>x</mi><mo>=</mo><mn>1</mn><mspace/><annotation>x=1</annotation></math>, so.</p></article>",
                 "Where x=1, so."),
    "embedded with end tags": (
        "<article><p>A <svg><path d=x><text>no</text></svg>b<video src=x><p>no</p></video>.</p><select><option>no</select><p>C.</p></article>",
        "A b.\nC."),
    **{f"{tag} without an end tag": (f"<article><p>A.</p><div><{tag} data=x><p>B.</p></div><p>C.</p></article>"
                                     f"<div class=ad><{tag}>x</{tag}></div>", "A.\nB.\nC.")
       for tag in ("object", "canvas", "audio", "video", "select", "svg")},
    "lists with some links": (
        "<article><ul><li><a href=x>A</a></li><li>plain</li></ul><ol><li>B<ul><li><a href=y>C</a></li></ul></li></ol>"
        "<ul><li><a href=x>Other</a></li><li><a href=x>story</a></li></ul></article>", "A\nplain\nB\nC"),
}


@pytest.mark.parametrize("name", INSIDE)
def test_parts_inside_an_article(name):
    body, want = INSIDE[name]
    assert main_text(page(body)) == want


def test_many_embedded_elements():
    assert main_text("<video>" * 50_000 + "x" + "</div></video>" * 50_000) == ""
    assert main_text("<div><object>" * 50_000 + "x") == "x"


@pytest.mark.parametrize(("text", "want"), [
    (None, ""), ("", ""), ("plain  text\n here", "plain text here"), ("<p>a<p>b", "a\nb"), ("a < b & c &amp d &am", "a < b & c & d &am"),
    ("<a \"", ""), ("<script>x", ""), ("<!-- open", ""), ("</p></div>x", "x"), ("<nav>only a menu</nav>", "")])
def test_odd_html(text, want):
    assert main_text(text) == want


def test_long_and_deep_pages():
    assert main_text("<div>" * 50_000 + "x") == "x"
    assert main_text("<p class=x>a " * 50_000).count("\n") == 49_999
    assert main_text("<" * 200_000 + "<a '" * 300).startswith("<")


def test_path_scores():
    p = Page(page("<article><p>" + LONG * 3 + "</p><p>" + LONG + "</p></article><div><a href=x>menu</a></div>"))
    scores = p.scores()
    best = max(range(len(scores)), key=scores.__getitem__)
    assert {p.tag[e] for e, _ in p.texts if e >= 0 and p.path[e] == best} == {"p"}
    assert all(scores[p.path[e]] < scores[best] / 4 for e, _ in p.texts if e >= 0 and p.tag[e] == "a")


def test_given_pages(spark):
    pages = spark.read.parquet(f"{SF_MID}/pages.parquet")
    got = {r["page_id"]: r["text"] for r in extract(pages).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)</article>", r["html"] or "", re.S)
        blocks = [" ".join(html.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", x))).split())
                  for x in re.split(r"</?(?:p|h1)>", article[1])] if article else []
        assert got[r["page_id"]] == "\n".join(b for b in blocks if b)


def test_columns(spark):
    df = spark.createDataFrame([(1, "<p>a", "u", "old"), (None, None, None, None), (1, "<p>a", "u", "old")],
                               "page_id long, html string, url string, TEXT string")
    got = extract(df)
    assert got.columns == ["page_id", "url", "text"]
    assert sorted(map(str, got.collect())) == sorted(map(str, [r for r in got.collect()]))
    assert sorted(r["text"] for r in got.collect()) == ["", "a", "a"]
    assert extract(df.where("false")).count() == 0


FOLLOW = "<div class=c2><p>Follow us on all channels</p></div>"


@pytest.mark.parametrize(("body", "want"), [
    ("<div class=c1><p>" + LONG * 4 + "</p></div>" + FOLLOW, (LONG * 4).strip()),
    (FOLLOW + "<div class=c1><p>" + LONG * 4 + "</p><div><p>" + LONG * 3 + "</p></div></div><div class=x1><p>More like this</p></div>",
     (LONG * 4).strip() + "\n" + (LONG * 3).strip()),
    ("<article><header><h1>T</h1><p>Lead paragraph.</p></header><p>" + LONG + "</p></article>", "T\nLead paragraph.\n" + LONG.strip()),
    ("<article><p class=comment>C.</p><p class='ad-hoc'>A.</p><div class=related-work>R.</div><p class=share-price>S.</p><p class=ad>Buy</p>"
     "<div class=post-comments><p>No</p></div><div class='ad-slot top'>No</div></article>", "C.\nA.\nR.\nS."),
])
def test_the_threshold_cuts_boxes_and_names_drop_no_text(body, want):
    assert main_text(page(body)) == want


def slow_chosen(p):
    """The path decision once more, from its definition: every sum is taken over all texts again."""
    n = len(p.parent)
    up = lambda e: [e, *up(p.parent[e])] if e > 0 else [0]
    chain = [set(up(e)) for e in range(n)]
    trail = lambda q: [*trail(p.up_of[q]), q] if q >= 0 else []
    link = ["a" in {p.tag[x] for x in chain[e]} for e in range(n)]
    texts = [(e, t) for e, t in p.texts if e >= 0 and t.strip()]
    live = [(e, t) for e, t in texts if not p.out[e]]
    order = list(dict.fromkeys(p.path[e] for e, _ in live))

    def ratio(q, of):
        mine = [(e, t) for e, t in live if p.path[e] == q]
        return sum(of(t) for e, t in mine if not link[e]) / len(mine)

    def shared(a, b):
        a, b = trail(a), trail(b)
        same = sum(x == y for x, y in zip(a, b, strict=False))
        return same / max(len(a), len(b), 2)
    raw = {q: (ratio(q, lambda t: len(" ".join(t.split()))), ratio(q, lambda t: len(re.findall("[.,;:!?…。、，！？；：]", t)))) for q in order}
    score = {}
    for k, q in enumerate(order):
        near = [(math.exp(-(j - k) ** 2 / 2) * shared(q, order[j]), raw[order[j]]) for j in range(len(order)) if abs(j - k) <= 2]
        w = sum(x for x, _ in near)
        score[q] = sum(x * r[0] for x, r in near) / w * (1 + sum(x * r[1] for x, r in near) / w)
    positive = [x for x in score.values() if x > 0]
    mean = sum(positive) / max(1, len(positive))
    least = .75 * math.sqrt(sum((x - mean) ** 2 for x in positive) / max(1, len(positive)))
    s = [0 if p.out[e] else score.get(p.path[e], 0) for e in range(n)]

    def in_item(e):
        return next((p.tag[x] for x in up(e) if p.tag[x] not in INLINE), "") == "li"

    def links_only(e):
        return p.list_of[e] >= 0 and in_item(e) and all(link[x] for x, _ in live if s[x] > 0 and p.list_of[x] == p.list_of[e])
    counted = [(e, len(t.strip())) for e, t in live if s[e] > 0 and not links_only(e)]
    alive = lambda e: p.tag[e] in ("article", "main") and not p.out[e]
    titled = any(p.tag[e] == "h1" and p.article[e] and s[e] > 0 for e in range(n))
    counts_for = lambda e: p.article[e] or not titled and any(p.tag[x] == "h1" for x in chain[e]) or not link[e] and s[e] >= least
    every = lambda c: sum(size for e, size in counted if c in chain[e])
    own = lambda c: sum(size for e, size in counted if c in chain[e] and counts_for(e))
    top = 0
    while not top or p.tag[top] not in ("article", "main"):
        for e in range(n - 1, 0, -1):
            if p.parent[e] == top and p.tag[e] in CONTAINERS and every(e):
                holds = any(e in chain[x] and alive(x) and s[x] > 0 for x in range(n))
                if every(e) == every(top) or holds and 0 < own(e) == own(top):
                    top = e
                    break
        else:
            break
    good = {e for e, _ in live if not link[e] and s[e] >= least and s[e] > 0} | {
        e for e in range(n) if s[e] > 0 and p.tag[e] in ("article", "main", "h1")}
    holds = [any(e in chain[x] for x in good) for e in range(n)]
    title = [any(p.tag[x] in HEADINGS for x in chain[e]) for e in range(n)]
    cut = {e for e in range(1, n) if p.tag[e] in ("div", "section", "center") and not p.article[e] and not holds[e]
           and holds[p.parent[e]] and any(e in chain[x] and not title[x] and s[x] > 0 for x, _ in live)}
    return [e for e, _ in live if top in chain[e] and s[e] > 0
            and not any(x in cut and top in chain[p.parent[x]] for x in chain[e])]


def test_decision_as_the_slow_version(spark):
    given = [r["html"] for r in spark.read.parquet(f"{SF_MID}/pages.parquet").limit(25).collect()]
    made = [page(body) for group in (CASES, BESIDE, NAMED, INSIDE) for body, _ in group.values()]
    rng = random.Random(4)
    for _ in range(60):
        parts = [f"<div class=k{rng.randrange(4)}>" + "".join(
            rng.choice(["<p>" + LONG * rng.randrange(1, 4) + "</p>", "<p>Short</p>", "<ul><li><a href=x>link</a></li></ul>", "<h2>H</h2>",
                        "<div class=w><p>Box</p></div>"]) for _ in range(rng.randrange(1, 4))) + "</div>" for _ in range(rng.randrange(1, 6))]
        made.append(page("".join(parts)))
    for text in filter(None, given + made):
        p = Page(text)
        chosen = p.chosen(p.scores())
        assert [e for e, t in p.texts if e >= 0 and t.strip() and chosen[e]] == slow_chosen(p)


def test_the_result_comes_through_the_scores(spark):
    """With all scores 0 there is no text, with all 1 menus and adverts come in."""
    rows = spark.read.parquet(f"{SF_MID}/pages.parquet").where("html IS NOT NULL").collect()
    for r in rows:
        p = Page(r["html"])
        n, own = len(p.depth_of), p.text()
        assert p.text([0.0] * n) == "" != own and p.text([1.0] * n) != own
