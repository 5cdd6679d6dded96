"""Main text of web pages by tag-path ratios.

Every block of text has a root-to-leaf path of tags (with the first class name or the id,
without digits).  Per path the page's text length without links and its punctuation are added
up and divided by the number of blocks; both ratios are smoothed down the tree of
paths, so that a heading takes part in the weight of the paragraphs beside it, fused by
the smaller of the two, and compared with the best path.  Paths above the threshold mark
their containers as content.  Elements that declare themselves something else (menus,
forms, notices, reader comments ...) never become blocks.

A page is parsed in one pass whose time grows with its length only, whatever its markup.
"""

from __future__ import annotations

import html as references
import re

import pandas as pd
from pyspark.sql import functions as F

from sheafline.llm.common import bounded_batches, without

# Share of the best fused ratio a path needs, weight of a path's surroundings in its
# smoothed ratios, and share of linked text above which a block is no prose.
THRESHOLD = 0.4
SMOOTHING = 0.5
MOST_LINKED = 0.5

# Elements by what they do to text.
INLINE = frozenset(
    "a abbr acronym area b base bdi bdo big cite code data del dfn em font i img input ins kbd label link map mark meta"
    " nobr output param picture q rp rt ruby s samp small source span strike strong sub sup time track tt u var wbr".split()
)
NO_END = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NEVER_TEXT = frozenset(
    "applet aside audio button canvas datalist dialog embed fieldset footer form frameset head iframe menu nav noframes"
    " noscript object script select style svg template textarea title video xmp".split()
)
CONTAINERS = frozenset("html body main article section div center".split())
CLOSES_ITSELF = {name: (name,) for name in ("li", "tr", "option", "p")} | {
    "td": ("td", "th"), "th": ("td", "th"), "dt": ("dt", "dd"), "dd": ("dt", "dd")
}
PUNCTUATION = re.compile("[.,;:!?…、。！，：；？]")
ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split()
)
# Words by which class names and ids declare something other than the article.
DECLARED = frozenset(
    "ad ads advert advertisement advertising adverts adsense alert alerts banner breadcrumb breadcrumbs comment comments"
    " consent cookie cookies disclaimer discussion disqus footer gdpr login menu menus modal nav navbar navigation newsletter notice"
    " notices notification pager pagination paywall popup promo promotion recommended related replies reply respond"
    " share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar widget widgets".split()
)
# Words so plain that a name which merely contains one declares it, as in ``rightsidebar``.
STEMS = re.compile("advert|breadcrumb|commentlist|cookie|disqus|mainmenu|navbar|navmenu|newsletter|paywall|sidebar|sidenav|topnav")
SITE_HEADERS = frozenset("header masthead page-header site-header topbar top-bar".split())
# A name that starts so tells how the element is laid out beside such a part.
ABOUT_OTHERS = frozenset("has is no with without hide show".split())

_REST = r"""(?:[^>=]++|=\s*+(?:"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z))?+)*+(?:>|\Z)"""
TOKEN = re.compile(
    rf"""<!--(?:-?>|.*?(?:--!?>|\Z))
    |<(?P<raw>script|style|textarea|title|iframe|xmp|noembed|noframes)(?=[\s/>]){_REST}.*?(?:</(?P=raw)(?=[\s/>])[^>]*+(?:>|\Z)|\Z)
    |<(?P<open>[a-z][^\s/>]*+)(?P<rest>{_REST})
    |</(?P<close>[a-z][^\s/>]*+)[^>]*+(?:>|\Z)
    |<[!?/][^>]*+(?:>|\Z)""",
    re.I | re.S | re.X,
)
ATTRIBUTE = re.compile(r"""(?:^|[\s"'/])(class|id|role)\s*+=\s*+("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)


def declared_other(name, found, in_article):
    """Whether an element says by tag, role, class or id that it is no article text."""
    if name in NEVER_TEXT or (name == "header" and not in_article):
        return True
    if found.get("role", "").lower() in ROLES:
        return True
    for value in (*found.get("class", "").lower().split(), found.get("id", "").lower()):
        if value in DECLARED:
            return True
        if name in ("html", "body", "main", "article"):
            continue
        if value in SITE_HEADERS and not in_article:
            return True
        words = re.findall("[a-z]+", value)
        if not words or words[0] in ABOUT_OTHERS or "with" in words:
            continue
        if STEMS.search(value) or not DECLARED.isdisjoint((words[0], words[-1])):
            return True
    return False


class Paths:
    """The tree of tag paths of a page, with blocks, characters and punctuation of each."""

    def __init__(self):
        self.parent, self.container, self.article, self.titles = [-1], [0], [-1], set()
        self.known, self.blocks = {}, []

    def child(self, at, name, label):
        key = (at, label)
        if key not in self.known:
            self.known[key] = new = len(self.parent)
            self.parent.append(at)
            self.container.append(new if name in CONTAINERS else self.container[at])
            self.article.append(new if name == "article" else self.article[at])
            if name == "h1":
                self.titles.add(new)
        return self.known[key]

    def add(self, at, text, linked):
        self.blocks.append((at, text, len(PUNCTUATION.findall(text)), linked / len(text)))

    def smoothed(self, measure):
        """``measure`` of blocks as a mean per path, mixed with the means of the subtrees above it."""
        size = len(self.parent)
        own, under = [[0, 0.0] for _ in range(size)], [[0, 0.0] for _ in range(size)]
        for block in self.blocks:
            for sums in (own, under):
                sums[block[0]][0] += 1
                sums[block[0]][1] += measure(block)
        for at in range(size - 1, 0, -1):
            for k in (0, 1):
                under[self.parent[at]][k] += under[at][k]
        around = [0.0] * size
        for at in range(size):
            mean = under[at][1] / max(1, under[at][0])
            around[at] = mean if at == 0 else (1 - SMOOTHING) * mean + SMOOTHING * around[self.parent[at]]
        return {
            at: (1 - SMOOTHING) * own[at][1] / own[at][0] + SMOOTHING * around[max(0, self.parent[at])]
            for at in range(size)
            if own[at][0]
        }

    def content(self):
        """Texts of the blocks that belong to content paths, in page order."""
        lengths = self.smoothed(lambda b: len(b[1]) * (1 - b[3]))
        marks = self.smoothed(lambda b: b[2] * (1 - b[3]))
        longest, most = max(lengths.values(), default=0), max(marks.values(), default=0)
        if not longest:
            return []
        # Prose is long and punctuated; a path weighs what the weaker of the two says.
        fused = {at: min(n / longest, marks[at] / most if most else 1) for at, n in lengths.items()}
        best = max(fused.values())
        chosen = {at for at, ratio in fused.items() if ratio >= THRESHOLD * best}
        # A path of links only is chosen for its surroundings; it marks no container.
        prose = {at for at, _, _, linked in self.blocks if linked <= MOST_LINKED}
        articles = {self.article[at] for at in chosen & prose} - {-1}
        containers = {self.container[at] for at in chosen & prose}
        chosen |= {at for at in lengths if self.article[at] in articles or self.container[at] in containers}
        # The title may stand in a container around that of the text.
        around = set()
        for at in containers:
            while at > 0 and at not in around:
                around.add(at)
                at = self.parent[at]
        chosen |= {at for at in self.titles if self.container[at] in around}
        return [
            text
            for at, text, _, linked in self.blocks
            if at in chosen and (linked <= MOST_LINKED or self.article[at] in articles)
        ]


def page_paths(page):
    """:class:`Paths` of one page's blocks; inline elements do not end a block."""
    paths, stack = Paths(), [("", 0, False)]
    open_names, parts, state = {}, [], {"links": 0, "linked": 0}

    def flush():
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                paths.add(stack[-1][1], text, min(state["linked"], len(text)))
            parts.clear()
        state["linked"] = 0

    def take(raw):
        if raw and not stack[-1][2]:
            text = references.unescape(raw)
            parts.append(text)
            if state["links"]:
                state["linked"] += len("".join(text.split()))

    def drop_top():
        flush()
        name = stack.pop()[0]
        open_names[name] -= 1

    end = 0
    for token in TOKEN.finditer(page):
        take(page[end : token.start()])
        end = token.end()
        name = (token["open"] or token["close"] or "").lower()
        if name == "a":
            state["links"] = int(token["close"] is None)
        elif name == "br":
            parts.append(" ")
        elif not name or name in INLINE:
            continue
        elif token["close"]:
            if open_names.get(name):
                while stack[-1][0] != name:
                    drop_top()
                drop_top()
                # Links do not reach beyond the block they stand in.
                state["links"] = 0
            elif name == "p":
                flush()
        else:
            flush()
            state["links"] = 0 if name in CONTAINERS else state["links"]
            if stack[-1][0] == "p" or stack[-1][0] in CLOSES_ITSELF.get(name, ()):
                drop_top()
            if name in NO_END:
                continue
            found = {k.lower(): v.strip("\"'") for k, v in ATTRIBUTE.findall(token["rest"])}
            top = stack[-1]
            other = top[2] or declared_other(name, found, paths.article[top[1]] >= 0)
            first = re.sub(r"\d+", "", [*found.get("class", "").split(), found.get("id", "").strip()][0])
            at = top[1] if other else paths.child(top[1], name, f"{name}.{first}" if first else name)
            stack.append((name, at, other))
            open_names[name] = open_names.get(name, 0) + 1
    take(page[end:])
    flush()
    return paths


def main_text(page):
    """Blocks of the main text of one page, joined by blank lines; empty if there are none."""
    return "\n\n".join(page_paths(page).content())


def extract_main_text(pages, html="html"):
    """``pages`` without ``html``, with ``text`` and ``n_chars`` (long), the code points of ``text``.

    Character references are decoded and white space inside a block becomes one space.
    Null and empty pages, and pages without any prose, give an empty text.  Bytes that
    are not UTF-8 count as replacement characters.  Long pages are read whole; repeated
    rows and ties have results of their own; an empty table stays empty; columns named
    ``text`` or ``n_chars`` are replaced.  A raw element, comment or quoted attribute that
    never ends reaches to the end of the page, as in a browser.
    """

    @F.pandas_udf("string")
    def extracted(page: pd.Series) -> pd.Series:
        return page.map(main_text)

    text = extracted(F.coalesce(F.make_valid_utf8(F.col(html)), F.lit("")))
    kept = without(bounded_batches(pages).withColumn("__text", text), html, "text", "n_chars")
    named = kept.withColumnRenamed("__text", "text")
    return named.withColumn("n_chars", F.char_length("text").cast("long"))
