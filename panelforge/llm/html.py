"""The main text of web pages by tree scoring.

Every paragraph of the page earns points for its length and its commas, less for the share of its
text that is links. It passes them to the elements around it, whole to the nearest and halved at each
further container. The element with most points holds the article; siblings with enough points belong
to it. What is left of the page is not read.

Names (class, id, role) say what is no article, and a form is none, but the points decide whether that is
believed: a word is, if all that it names on the page holds a minor share of the page's points, apart from
single elements that hold the major share, which are spared; or if elements that are named as the
article hold enough points outside of all that it names.

Scale. Pages are mapped one by one where they are read; work is linear in the page and no
recursion depends on its depth.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.llm.words import small

_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td "
    "tfoot th thead title tr ul".split()
)
# Elements that hold several paragraphs, and so may be the article.
_CONTAINER = set("#page article body center div fieldset figure html main section table tbody td tr blockquote".split())
_NEVER = set(
    "head script style noscript template nav header footer aside button select option textarea input label "
    "iframe object embed svg canvas math audio video map menu dialog datalist".split()
)
_KEPT_ROOTS = {"#page", "html", "body", "main"}
# Words of class, id or role that name what is not the article: a whole token, or its first or last part.
_NOT_TEXT = set(
    "ad ads adbox adslot advert adverts advertisement advertising banner sponsor sponsored promo promotion promoted "
    "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription "
    "sidebar aside widget widgets rail menu menubar nav navbar navigation breadcrumb breadcrumbs pagination pager "
    "footer header masthead topbar toolbar comment comments commentlist disqus reply replies respond "
    "share sharing social related recommended recommendations login signup search complementary contentinfo hidden".split()
)
_TEXT = set("article content entry main post story text body".split())
# Parts that make a token a statement about the layout: has-sidebar, with-comments, share-enabled.
_LAYOUT = set("has no with without enabled disabled layout is not".split())
_COMMENTS = set("comment comments commentlist disqus reply replies respond".split())
# A word is believed up to so much of the points of a page; reader comments may well outgrow the article.
_BELIEVED, _BELIEVED_COMMENTS = 0.5, 0.9
# So much of the points in named articles outside of what a word names is enough, too.
_ARTICLE_SHARE = 0.1
# Points of a container that is named, but not believed to be what its name says.
_NAMED = 0.5
_CLOSED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"},
}
_FENCE = set("html body div article section main aside nav header footer ul ol dl table td th blockquote form figure".split())
_PARTS = re.compile(r"[a-z]+")

_LINK_SHARE, _LINKS = 0.7, 3
_SIBLING_SHARE = 0.2


_NOTHING: frozenset[str] = frozenset()


def _names(value: str) -> tuple[set[str], bool]:
    """Words that say what is not the article, and whether a token names the article."""
    found, article = set(), False
    for token in value.lower().split():
        parts = _PARTS.findall(token)
        if not parts or not _LAYOUT.isdisjoint(parts):
            continue
        if parts[-1] not in _NOT_TEXT and not _TEXT.isdisjoint(parts):
            article = True
        else:
            found.update(_NOT_TEXT.intersection((parts[0], parts[-1])))
    return found, article


class _Page(HTMLParser):
    """The element tree as parallel lists, parents before children, and the text in page order."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tag, self.parent, self.words = ["#page"], [-1], [_NOTHING]
        self.article, self.hidden = [False], [False]
        self.pieces: list[tuple[int, str | None]] = []
        self.open = [0]

    def _close(self, tags: set[str], fence: set[str]) -> None:
        for depth in range(len(self.open) - 1, 0, -1):
            tag = self.tag[self.open[depth]]
            if tag in tags:
                del self.open[depth:]
                return
            if tag in fence:
                return

    def handle_starttag(self, tag, attrs):
        if tag in _BLOCK:
            self._close({"p"}, _FENCE)
        if tag in _CLOSED_BY:
            self._close(_CLOSED_BY[tag], _FENCE - {"td", "th"} if tag in ("tr", "td", "th", "tbody") else _FENCE)
        words, article, hidden = {"form"} if tag == "form" else set(), tag in ("article", "main"), False
        for name, value in attrs:
            if name in ("class", "id", "role") and value:
                found, named = _names(value)
                words |= found
                article |= named
            elif name in ("hidden", "aria-modal"):
                hidden = True
        self.tag.append(tag)
        self.parent.append(self.open[-1])
        self.words.append(frozenset(words) if words and tag not in _KEPT_ROOTS else _NOTHING)
        self.article.append(article)
        self.hidden.append(hidden and tag not in _KEPT_ROOTS)
        node = len(self.tag) - 1
        if tag in _BLOCK or tag == "br":
            self.pieces.append((node, None))
        if tag not in _VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if tag in _BLOCK:
            self.pieces.append((self.open[-1], None))
        for depth in range(len(self.open) - 1, 0, -1):
            if self.tag[self.open[depth]] == tag:
                del self.open[depth:]
                return

    def handle_data(self, data):
        self.pieces.append((self.open[-1], data))


def main_text(html: str) -> str:
    """The article of one page; blocks in page order, joined by one space."""
    page = _Page()
    page.feed(html)
    page.close()
    tag, parent, words = page.tag, page.parent, page.words
    n = len(tag)
    gone, link = [False] * n, [False] * n
    block = [0] * n  # nearest block element, itself included
    for i in range(1, n):
        p = parent[i]
        gone[i] = gone[p] or tag[i] in _NEVER or page.hidden[i]
        link[i] = link[p] or tag[i] == "a"
        block[i] = i if tag[i] in _BLOCK else block[p]

    own, own_link, commas = [0] * n, [0] * n, [0] * n
    for i, text in page.pieces:
        if text is not None and not gone[i] and (size := len("".join(text.split()))):
            own[block[i]] += size
            own_link[block[i]] += size * link[i]
            commas[block[i]] += text.count(",") + text.count("、") + text.count("，")
    points = [
        (min(own[i] / 25, 1) + commas[i] + min(own[i] / 100, 3)) * (1 - own_link[i] / own[i]) if own[i] else 0.0
        for i in range(n)
    ]

    # What a word names on the page, nested elements counted once.
    within = points[:]
    for i in range(n - 1, 0, -1):
        within[parent[i]] += within[i]
    most_of = {word: (_BELIEVED_COMMENTS if word in _COMMENTS else _BELIEVED) * within[0] for names in words for word in names}
    held = dict.fromkeys(most_of, 0.0)
    around, counted = [_NOTHING] * n, [_NOTHING] * n  # words on the way here; those whose points were added up
    in_article, told = page.article[:], {}  # points in named articles by the words around them
    for i in range(1, n):
        p = parent[i]
        around[i], counted[i] = around[p] | words[i] if words[i] else around[p], counted[p]
        if words[i]:
            small_ones = {w for w in words[i] - counted[p] if within[i] <= most_of[w]}
            for word in small_ones:
                held[word] += within[i]
            counted[i] = counted[p] | small_ones
        in_article[i] = in_article[i] or in_article[p]
        if in_article[i] and points[i]:
            told[around[i]] = told.get(around[i], 0.0) + points[i]
    stated = {w for w in held if sum(p for names, p in told.items() if w not in names) >= _ARTICLE_SHARE * within[0]}
    believed = {w for w, share in held.items() if share <= most_of[w]}
    for i in range(1, n):
        gone[i] = gone[i] or gone[parent[i]] or any(
            w in stated or w in believed and within[i] <= most_of[w] for w in words[i]
        )
        if gone[i]:
            own[i] = own_link[i] = 0
            points[i] = 0.0

    size, size_link, links = own[:], own_link[:], [0] * n
    for i in range(n - 1, 0, -1):
        links[i] += tag[i] == "a" and not gone[i]
        size[parent[i]] += size[i]
        size_link[parent[i]] += size_link[i]
        links[parent[i]] += links[i]

    # Lists of links inside the page are menus, whatever they are called.
    for i in range(1, n):
        menu = (
            tag[i] in _BLOCK and tag[i] not in _KEPT_ROOTS and links[i] >= _LINKS
            and size_link[i] > _LINK_SHARE * size[i]
        )
        gone[i] = gone[i] or gone[parent[i]] or menu

    # A container with text of its own keeps its points; a paragraph gives them away.
    score, passed = [0.0] * n, [0.0 if gone[i] else points[i] for i in range(n)]
    for i in range(n - 1, -1, -1):
        if tag[i] in _CONTAINER:
            score[i] = passed[i]
        if i:
            passed[parent[i]] += passed[i] / 2 if tag[i] in _CONTAINER else passed[i]
    best, most = -1, 0.0
    for i in range(n):
        if score[i] > 0 and not gone[i]:
            value = score[i] * (1 - size_link[i] / size[i] if size[i] else 0)
            value *= 2 if page.article[i] and (tag[i] not in _KEPT_ROOTS or tag[i] == "main") else 1
            value *= _NAMED if words[i] else 1
            score[i] = value
            if value > most:
                best, most = i, value
    if best < 0:
        return ""

    kept = [best == 0] * n
    for i in range(1, n):
        near = parent[i] == parent[best] and tag[best] not in _KEPT_ROOTS
        kept[i] = not gone[i] and (
            i == best or kept[parent[i]]
            or near and (tag[i] in _CONTAINER and score[i] >= _SIBLING_SHARE * most
                         or tag[i] == "p" and size[i] >= 80 and size_link[i] <= 0.25 * size[i])
        )
    out = ["" if not kept[i] and text is None else " " if text is None else text for i, text in page.pieces if text is None or kept[i]]
    return " ".join("".join(out).split())


def extract(pages: DataFrame) -> DataFrame:
    """The main text of every row of ``pages`` (page_id, url, html).

    Returns page_id, url, text (empty if the page has none) and n_chars, its code points.

    Null and empty html give the empty text. Broken markup is read as far as it goes: unclosed
    elements end with what they are in. Repeated rows are extracted each; null page_ids and urls stay. An
    empty table gives an empty result. Other columns are not looked at.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            texts = [main_text(h) if h else "" for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), "html").mapInArrow(
        work, "page_id long, url string, text string, n_chars long"
    )
