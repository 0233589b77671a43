"""Main text of web pages by tag-path ratios (operator 4).

Method.  Every text node has a path of tags (with their classes) from the
root.  Per path the text length and the punctuation of its nodes are
summed, link text not counting, and divided by the number of nodes.  Both
ratios are smoothed over neighbouring paths (in page order, weighted by how
much of the path they share), fused into one score and thresholded; the
paths above are the content paths.  Paths through elements that are no part
of an article whatever their ratios -- navigation, page header and footer,
asides, forms, scripts, styles, hidden parts -- score zero, and so do elements
whose class, id or role names an advert, notice, menu, sidebar or comments.
Such a name is overruled if the element holds most of the page's text, or the
only article, main or h1 element; words after has-, no-, with- or layout- are
no names.  Words that are as often boxes of an article (notice, toc, ...)
exclude only outside an article element, and where there is none only
elements without a content path.  Inside an article a name excludes only if
no other word in it names a subject (ad-slot, not ad-hoc), and a paragraph or
heading only if it is an advert.  Exclusion acts through the scores: what is
excluded shares one path that has none, and only text with a score is taken.

The article is the lowest common container of its text: from the root the
walk goes down into a container only if no text that would be returned stays
outside.  An article or main element is where the walk ends; on the way to it
plain text beside it does not count, but content paths, other articles and a
first heading that the articles lack do.  Text blocks of that container are
returned, short or long, but for lists made of links only and for the boxes
that the threshold cuts: a div or section, outside an article element, that
holds no content path while its neighbours do.  So a one-word paragraph of the
article stays, and neither a long advert nor a "follow us" box comes in.

Rows are independent: one narrow scan, no shuffle.  Per page the work and
memory are linear in its length.

Cases: null or empty html, or html without text outside excluded elements,
gives an empty text; text without any tag is one block; unclosed and
misnested tags are closed as browsers do (a new paragraph ends the last,
a list item its sibling); formulas are text; an embedded element (svg, object,
canvas, video, ...) without an end tag in its parent excludes nothing; character references are decoded, with or without
semicolon; repeated rows are extracted one by one; other columns are kept.
"""

from __future__ import annotations

import html as references
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.util import row_groups

NEIGHBOURS = 2       # paths on each side that take part in smoothing
MOST = 0.8           # of the page's text that makes an element the article whatever its name
THRESHOLD = 0.75      # of the standard deviation of the fused scores

TAG = re.compile(r"""<!--.*?(?:-->|$)|<[!?][^>]*+(?:>|$)
  |<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>
  |<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*+)(?P<attrs2>[^>]*+)(?:>|$)""", re.S | re.X)
ATTRIBUTE = re.compile(r"""(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
PUNCTUATION = re.compile(r"[.,;:!?…。、，！？；：]")

# Element names of the HTML standard by what they mean here
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
EMBEDDED = frozenset("template svg canvas object audio video select".split())
MATH = frozenset("math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom mfenced menclose msub "
                 "msup msubsup munder mover munderover mmultiscripts mprescripts none mtable mtr mtd maction semantics "
                 "annotation annotation-xml".split())
EXCLUDED = frozenset("nav footer aside form button menu dialog head fieldset label datalist output "
                     "annotation annotation-xml".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr br img".split()) | MATH
CONTAINERS = frozenset("html body main article div section center table tbody tr td blockquote".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
CLOSES = {"li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
          "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
#: Words in a class, id or role that name something other than the article.
OTHER_PARTS = frozenset("""ad ads advert adverts advertisement advertising adsense sponsor sponsored sponsors promo
  promoted promotion banner banners sidebar sidebars nav navbar navigation menu menus menubar breadcrumb breadcrumbs
  footer masthead complementary contentinfo cookie cookies consent gdpr notice notices alert alerts newsletter
  subscribe subscription signup popup modal overlay dialog social share sharing related recommended recommendations
  comment comments commentlist disqus respond reply replies widget widgets toolbar pagination pager login search
  skip toc copyright disclaimer""".split())
#: Those of them that name boxes of an article as well.
BOXES = frozenset("notice notices alert alerts widget widgets toc copyright disclaimer".split())
#: Words that say what an element has, lacks or how it is laid out: what follows them does not name it.
MODIFIERS = frozenset("has no with without layout".split())
#: Words beside such a word in a compound that name no subject: an article's "ad-slot" is an advert, its "ad-hoc" is not.
GENERIC = frozenset("""a article area articles bar block body bottom box button buttons col container content count footer
  form group header heading holder icon icons inline inner item items js label left link links list main media more page
  panel post posts reader right row section site slot text title top unit user wrap wrapper zone""".split())
#: Words that make a text block of an article (a paragraph, a heading) an advert; no other word does.
ADVERTS = frozenset("ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promoted promotion".split())
TEXT_BLOCKS = frozenset("p pre blockquote li dt dd td th tr figure figcaption".split()) | HEADINGS
#: Elements that a low score cuts as a whole.
BOX_TAGS = frozenset("div section center".split())
#: The same for elements that are usually the article itself.
OTHER_ARTICLES = frozenset("comment reply ad advert advertisement promo related sponsored".split())


def _attributes(text: str) -> dict[str, str]:
    return {k.lower(): v.strip("\"'") for k, v in ATTRIBUTE.findall(text)} if text.strip(" /") else {}


def _names(attrs: dict[str, str], strict: bool = False) -> set[str]:
    """The words of an element's class, id and role; if ``strict`` only of names made of such words and generic ones."""
    out = set()
    for k in ("class", "id", "role"):
        for word in attrs.get(k, "").split():
            parts = []
            for p in NAME_PART.findall(word.removeprefix("elementor-widget")):
                if p.lower() in MODIFIERS:
                    break
                parts.append(p.lower())
            if not strict or all(p in OTHER_PARTS or p in GENERIC for p in parts):
                out.update(parts)
    return out


def _tags(html: str) -> list[tuple[int, int, str, bool, str]]:
    """Start, end, name, whether it is an end tag, attributes; comments and script-like elements have no name."""
    out, at, drawn = [], 0, 0
    while m := TAG.search(html, at):
        at = m.end()
        tag, end, attrs = (m["tag"] or m["tag2"] or "").lower(), bool(m["end"] or m["end2"]), m["attrs"] or m["attrs2"] or ""
        if tag in ("svg", "math") and not attrs.endswith("/"):
            drawn = max(0, drawn + (-1 if end else 1))
        if tag in RAW and not end:
            if not (drawn and attrs.endswith("/")):
                last = re.compile(rf"</{re.escape(tag)}\b", re.I).search(html, at)
                at = (html.find(">", last.start()) + 1 or len(html)) if last else len(html)
            tag = ""
        out.append((m.start(), at, tag, end, attrs))
    return out


def _ends(tags: list[tuple[int, int, str, bool, str]]) -> dict[int, int]:
    """The numbers of the embedded elements' start tags -> the tag at which they end, if that is in the same parent."""
    out, stack, opened = {}, [], Counter()
    for k, (_, _, tag, end, attrs) in enumerate(tags):
        if not tag or tag in VOID or tag in INLINE:
            continue
        if not end:
            if tag == "svg" and attrs.endswith("/"):
                out[k] = k
            else:
                stack.append((tag, k))
                opened[tag] += 1
        elif opened[tag]:
            last = None
            while last != tag:
                last, start = stack.pop()
                opened[last] -= 1
            if tag in EMBEDDED:
                out[start] = k
    return out


class Page:
    """Elements and text nodes of a page; an element's parent has a smaller number."""

    def __init__(self, html: str):
        self.parent, self.tag, self.path, self.out, self.article = [-1], [""], [0], [False], [False]
        self.list_of = [-1]                 # the outermost list around an element
        self.named = [""]                   # "box" or "part" for elements excluded by name only
        self.paths = {(): 0}                # (path of the parent, label) -> path
        self.depth_of = [0]
        self.up_of = [-1]
        self.texts: list[tuple[int, str]] = []   # (element, text); an element of -1 ends a block
        self.stack = [0]
        self._read(html)
        if any(self.named):
            self._exclude_named()
        # what is excluded shares one path without a score
        self.depth_of.append(0)
        self.up_of.append(-1)
        self.path = [len(self.up_of) - 1 if out else p for p, out in zip(self.path, self.out, strict=True)]

    def _path(self, parent: int, label: str) -> int:
        key = (parent, label)
        if key not in self.paths:
            self.paths[key] = len(self.depth_of)
            self.depth_of.append(self.depth_of[parent] + 1)
            self.up_of.append(parent)
        return self.paths[key]

    def _text(self, text: str) -> None:
        if text:
            self.texts.append((self.stack[-1], references.unescape(text) if "&" in text else text))

    def _block(self) -> None:
        if self.texts and self.texts[-1][0] >= 0:
            self.texts.append((-1, ""))

    def _close(self, tags: set[str], within: set[str]) -> None:
        """Close the nearest open element of ``tags``, not looking beyond one of ``within``."""
        for k in range(len(self.stack) - 1, 0, -1):
            tag = self.tag[self.stack[k]]
            if tag in tags:
                del self.stack[k:]
                if tag not in INLINE:
                    self._block()
                return
            if tag in within:
                return

    def _open(self, tag: str, attrs: dict[str, str]) -> None:
        up = self.stack[-1]
        inside = self.article[up]
        names = _names(attrs, strict=inside)
        own = tag in EXCLUDED or "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true" \
            or "display:none" in attrs.get("style", "").replace(" ", "").lower()
        parts = set()
        if tag in ("article", "main"):
            parts = names & OTHER_ARTICLES
        elif tag not in ("html", "body"):
            parts = names & (ADVERTS if inside and tag in TEXT_BLOCKS else OTHER_PARTS)
            if not inside:
                parts |= names & {"header"}
                own = own or tag == "header"
        out = self.out[up] or own
        if self.tag[up] == "header" and inside and tag not in TEXT_BLOCKS and tag not in INLINE:
            out = True  # of an article's own header headings and paragraphs belong to its text
        self.parent.append(up)
        self.tag.append(tag)
        self.path.append(self._path(self.path[up], f"{tag}.{attrs['class']}" if attrs.get("class") else tag))
        self.out.append(out)
        self.list_of.append(len(self.parent) - 1 if self.list_of[up] < 0 and tag in ("ul", "ol") else self.list_of[up])
        self.named.append("" if not parts else "box" if parts <= BOXES else "part")
        self.article.append(inside or tag in ("article", "main"))
        self.stack.append(len(self.parent) - 1)

    def _read(self, html: str) -> None:
        tags = _tags(html)
        ends = _ends(tags) if any(t[2] in EMBEDDED for t in tags) else {}
        at, k = 0, 0
        while k < len(tags):
            start, _, tag, end, attrs = tags[k]
            self._text(html[at:start])
            k = ends.get(k, k)
            at = tags[k][1]
            k += 1
            if not tag or tag in EMBEDDED or tag in MATH and not end and attrs.endswith("/"):
                continue
            if end:
                if tag not in INLINE:
                    self._block()
                self._close({tag}, {"table"} if tag in INLINE or tag in ("p", "li") else set())
                continue
            if tag == "br":
                self._text(" ")
            if tag in VOID:
                if tag == "hr":
                    self._block()
                continue
            if tag not in INLINE:
                self._block()
                self._close({"p"}, CONTAINERS | {"li", "dd", "button"})
                if tag in CLOSES:
                    self._close(*CLOSES[tag])
            self._open(tag, _attributes(attrs))
        self._text(html[at:])

    def _exclude_named(self) -> None:
        """Exclude the elements that are named as other parts, but for those that hold the article."""
        n = len(self.parent)
        size, articles, titles = [0] * n, [0] * n, [0] * n          # in the whole element
        within, link, covered = [0] * n, [False] * n, [False] * n   # within: article elements around it
        free_articles = free_titles = 0
        for e in range(1, n):
            up = self.parent[e]
            link[e] = link[up] or self.tag[e] == "a"
            covered[e] = covered[up] or self.out[e] or bool(self.named[e])
            articles[e] = not self.out[e] and self.tag[e] in ("article", "main") and not self.named[e]
            titles[e] = not self.out[e] and self.tag[e] == "h1"
            within[e] = within[up] + (articles[e] and not covered[e])
            free_articles += articles[e] and not covered[e]
            free_titles += titles[e] and not covered[e]
        for e, text in self.texts:
            if e >= 0 and not self.out[e] and not link[e]:
                size[e] += len(text.strip())
        for e in range(n - 1, 0, -1):
            for held in (size, articles, titles):
                held[self.parent[e]] += held[e]
        content = self._in_content(link) if not free_articles and "box" in self.named else [False] * n
        for e in range(1, n):
            if self.named[e] and not self.out[e]:
                self.out[e] = not (
                    articles[e] and not free_articles or titles[e] and not free_titles
                    or within[e] == free_articles and size[e] > 0 and size[e] >= MOST * size[0]
                    or self.named[e] == "box" and (self.article[e] or content[e]))
            self.out[e] = self.out[e] or self.out[self.parent[e]]

    def _in_content(self, link: list[bool]) -> list[bool]:
        """Whether an element holds text of a content path outside links."""
        scores = self.scores()
        least, out = self._least(scores), [False] * len(self.parent)
        for e, _ in self.texts:
            if e >= 0 and not self.out[e] and not link[e] and 0 < scores[self.path[e]] >= least:
                out[e] = True
        for e in range(len(out) - 1, 0, -1):
            out[self.parent[e]] = out[self.parent[e]] or out[e]
        return out

    def scores(self) -> list[float]:
        """The fused, smoothed score of each path."""
        n, link = len(self.depth_of), self._links()
        length, points, nodes = [0.0] * n, [0.0] * n, [0] * n
        order = []
        for e, text in self.texts:
            if e < 0 or self.out[e] or not text.strip():
                continue
            p = self.path[e]
            if not nodes[p]:
                order.append(p)
            nodes[p] += 1
            if not link[e]:
                length[p] += len(" ".join(text.split()))
                points[p] += len(PUNCTUATION.findall(text))
        out = [0.0] * n
        for k, p in enumerate(order):
            total = [0.0, 0.0, 0.0]
            for j in range(max(0, k - NEIGHBOURS), min(len(order), k + NEIGHBOURS + 1)):
                q = order[j]
                w = math.exp(-(j - k) ** 2 / 2) * self._shared(p, q)
                for i, x in enumerate((1.0, length[q] / nodes[q], points[q] / nodes[q])):
                    total[i] += w * x
            out[p] = total[1] / total[0] * (1 + total[2] / total[0])
        return out

    def _shared(self, p: int, q: int) -> float:
        """The part of the longer path that two paths share."""
        longest = max(self.depth_of[p], self.depth_of[q], 1)
        while p != q:
            if self.depth_of[p] >= self.depth_of[q]:
                p = self.up_of[p]
            else:
                q = self.up_of[q]
        return (1 + self.depth_of[p]) / (1 + longest)

    def _least(self, scores: list[float]) -> float:
        """The score from which a path is a content path."""
        positive = [x for x in scores if x > 0]
        mean = sum(positive) / len(positive) if positive else 0.0
        return THRESHOLD * math.sqrt(sum((x - mean) ** 2 for x in positive) / len(positive)) if positive else 0.0

    def _links(self) -> list[bool]:
        link = [False]
        for e in range(1, len(self.parent)):
            link.append(link[self.parent[e]] or self.tag[e] == "a")
        return link

    def container(self, scores: list[float], least: float, link: list[bool]) -> int:
        """The element that holds the article."""
        n = len(self.parent)
        heading, marked = [False] * n, [False] * n
        for e in range(1, n):
            heading[e] = heading[self.parent[e]] or self.tag[e] == "h1"
            marked[e] = scores[self.path[e]] > 0 and self.tag[e] in ("article", "main")
        lists = self.link_lists(scores, link)
        titled = any(self.tag[e] == "h1" and self.article[e] and scores[self.path[e]] > 0 for e in range(n))
        every, of_article = [0] * n, [0] * n
        for e, text in self.texts:
            if e < 0 or scores[self.path[e]] <= 0 or not (size := len(text.strip())) \
                    or lists.get(self.list_of[e]) and self._in_item(e):
                continue
            every[e] += size
            if self.article[e] or heading[e] and not titled or not link[e] and scores[self.path[e]] >= least:
                of_article[e] += size
        children: dict[int, list[int]] = {}
        for e in range(n - 1, 0, -1):
            up = self.parent[e]
            every[up] += every[e]
            of_article[up] += of_article[e]
            marked[up] = marked[up] or marked[e]
            if every[e] and self.tag[e] in CONTAINERS:
                children.setdefault(up, []).append(e)
        at, down = 0, 0
        while down is not None:
            at = down
            down = None if at and self.tag[at] in ("article", "main") else next(
                (e for e in children.get(at, ()) if every[e] == every[at] or marked[e] and 0 < of_article[e] == of_article[at]), None)
        return at

    def chosen(self, scores: list[float]) -> list[bool]:
        """Which elements' own text belongs to the article.

        That is text with a score, in the container, and outside the boxes
        that the threshold cuts: those beside content that hold more than
        headings, but neither a content path nor an article or first heading, if the container is no article itself.
        """
        n, link, least = len(self.parent), self._links(), self._least(scores)
        top = self.container(scores, least, link)
        held, plain, title = [False] * n, [False] * n, [False] * n  # plain: text that is no heading
        for e in range(1, n):
            title[e] = title[self.parent[e]] or self.tag[e] in HEADINGS
        for e, text in self.texts:
            if e >= 0 and text.strip() and scores[self.path[e]] > 0:
                held[e] = held[e] or not link[e] and scores[self.path[e]] >= least
                plain[e] = plain[e] or not title[e]
        for e in range(n - 1, 0, -1):
            up = self.parent[e]
            held[e] = held[e] or scores[self.path[e]] > 0 and self.tag[e] in ("article", "main", "h1")
            held[up] = held[up] or held[e]
            plain[up] = plain[up] or plain[e]
        inside = [False] * n
        inside[top] = True
        for e in range(1, n):
            up = self.parent[e]
            low = not held[e] and plain[e] and held[up] and self.tag[e] in BOX_TAGS and not self.article[e]
            inside[e] = inside[e] or inside[up] and not low
        return [inside[e] and scores[self.path[e]] > 0 for e in range(n)]

    def text(self, scores: list[float] | None = None) -> str:
        """The article by these path scores (the page's own if none are given)."""
        scores = self.scores() if scores is None else scores
        chosen, link = self.chosen(scores), self._links()
        lists = self.link_lists(scores, link)
        blocks, parts, item, linked = [], [], False, True
        for e, text in [*self.texts, (-1, "")]:
            if e >= 0:
                if chosen[e]:
                    parts.append(text)
                    if text.strip():
                        linked = linked and link[e] and lists.get(self.list_of[e], True)
                        item = item or self._in_item(e)
                continue
            block = " ".join("".join(parts).split())
            if block and not (item and linked):
                blocks.append(block)
            parts, item, linked = [], False, True
        return "\n".join(blocks)

    def link_lists(self, scores: list[float], link: list[bool]) -> dict[int, bool]:
        """Of each outermost list, whether all of its text is links."""
        out: dict[int, bool] = {}
        for e, text in self.texts:
            if e >= 0 and scores[self.path[e]] > 0 and self.list_of[e] >= 0 and text.strip():
                out[self.list_of[e]] = out.get(self.list_of[e], True) and link[e]
        return out

    def _in_item(self, e: int) -> bool:
        while e > 0 and (self.tag[e] in INLINE):
            e = self.parent[e]
        return self.tag[e] == "li"


def main_text(html: str | None) -> str:
    return Page(html).text() if html else ""


def extract(pages: DataFrame, html_col: str = "html", out_col: str = "text") -> DataFrame:
    """``pages`` with the main text of each page in ``out_col`` (in place of a column of that name)."""
    kept = [c for c in pages.columns if c.lower() not in (html_col.lower(), out_col.lower())]

    def run(batches):
        for batch in row_groups(batches):
            texts = [main_text(x) for x in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(texts, pa.string())], names=[*kept, out_col])

    schema = T.StructType([*[pages.schema[c] for c in kept], T.StructField(out_col, T.StringType())])
    return pages.select(F.col(html_col), *kept).mapInArrow(run, schema)
