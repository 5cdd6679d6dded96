"""Markup to text: HTML through the standard parser, Markdown natively."""

import html
from collections import Counter
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

HTML_RESULT = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("text", "title", "error")]
)

# Elements whose text is left out, and elements without an end tag.
HIDDEN_ELEMENTS = frozenset({"script", "style", "template", "rt", "rp"})
VOID_ELEMENTS = frozenset(
    "area base basefont bgsound br col command embed frame hr image img input isindex "
    "keygen link menuitem meta nextid param source spacer track wbr".split()
)


class _TextNodes(HTMLParser):
    """Collects stripped text nodes; every tag, comment or declaration ends a node."""

    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.lines, self.title = [], None
        self._open, self._node = [], []
        # How often each name, and any hidden element, is open now.
        self._depth, self._hidden = Counter(), 0
        self._title_children = None

    def end_node(self):
        node, self._node = "".join(self._node), []
        if not node:
            return
        if self._title_children is not None:
            self._title_children.append(node)
        if not self._hidden and node.strip():
            self.lines.append(node.strip())

    def _close_title(self):
        children, self._title_children = self._title_children, None
        self.title = children[0] if len(children) == 1 else None

    def handle_starttag(self, tag, attrs):
        self.end_node()
        if tag in VOID_ELEMENTS:
            return
        if tag == "title" and self._title_children is None and not self.seen_title:
            self._title_children, self.seen_title = [], True
        self._open.append(tag)
        self._depth[tag] += 1
        self._hidden += tag in HIDDEN_ELEMENTS

    seen_title = False

    def handle_startendtag(self, tag, attrs):
        self.end_node()

    def handle_endtag(self, tag):
        self.end_node()
        if self._depth[tag]:
            closed = None
            while closed != tag:
                closed = self._open.pop()
                self._depth[closed] -= 1
                self._hidden -= closed in HIDDEN_ELEMENTS
                if closed == "title" and self._title_children is not None:
                    self._close_title()

    def handle_data(self, data):
        self._node.append(data)

    def handle_entityref(self, name):
        char = html.entities.html5.get(f"{name};")
        self._node.append(f"&{name}" if char is None else char)

    def handle_charref(self, name):
        self._node.append(html.unescape(f"&#{name};"))

    def handle_comment(self, data):
        self.end_node()

    handle_decl = handle_pi = unknown_decl = handle_comment

    def close(self):
        super().close()
        self.end_node()
        if self._title_children is not None:
            self._close_title()


def html_nodes(markup):
    """(text, title) of one HTML document."""
    parser = _TextNodes()
    parser.feed(markup)
    parser.close()
    return "\n".join(parser.lines), parser.title


def _page(raw):
    if raw is None:
        return None, None, None
    try:
        return (*html_nodes(bytes(raw).decode("utf-8", "replace")), None)
    except Exception as error:  # the parser refuses some malformed declarations
        return None, None, f"{type(error).__name__}: {error}"


@F.pandas_udf(HTML_RESULT)
def _html_to_text(content: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([_page(raw) for raw in content], columns=HTML_RESULT.names)


def html_to_text(content):
    """Struct (text, title, error) of HTML bytes, decoded as UTF-8 with replacement.

    A page the parser refuses has an error and no text.

    Declared non-deterministic so that a later filter on the result is not
    pushed below it, which would parse every page twice.
    """
    return _html_to_text.asNondeterministic()(content)


# Content of a heading: words, and blanks or marks that do not merely end the line.
_LINE_END = r"\n\r\u0085\u2028\u2029"
_HEADING = rf"(?:[^ \t#{_LINE_END}]++|[ \t]++(?!#*+[ \t]*+$)|#++(?![ \t]*+$))*+"
# A link's label and target; neither reaches over another one that begins inside it.
_LABEL = r"\[[^\[\]]{}\]"
_TARGET = r"(?:\((?:[^()]++|\([^()]*+\))*+\)|\[[^\[\]]*+\])"

# Markdown constructs as (text that must occur, pattern, what it renders
# to).  Order matters:
# code before marks, images before links, addresses before tags, setext underlines
# before rules and bullets, escapes and entities last.  A repeated group is possessive:
# one that can backtrack recurses once per repetition and ends the JVM on a long line.
# What a pattern passes over never holds its own beginning, so that each part of a text
# is read a bounded number of times.
MARKDOWN_RULES = (
    ("```", r"(?s)```[ \t]*+\n?((?:[^\s`]++|\s++(?!```)|`(?!``))*+)\s*+```", "`$1`"),
    ("-->", r"(?s)<!--.*?-->", ""),
    ("![", "!" + _LABEL.format("*+") + _TARGET, ""),
    ("[", _LABEL.format("++").replace("[^", "([^", 1).replace("++", "++)") + _TARGET, "$1"),
    ("]:", r"(?m)^ {0,3}" + _LABEL.format("++") + r":[ \t]++\S.*$", ""),
    ("<", r"<((?:https?|ftp|mailto):[^<>\s]++|[^\s<>@/]++@[^\s<>@]++)>", "$1"),
    ("<", r"</?(?:b|strong)>", "**"),
    ("<", r"</?(?:i|em|u)>", "_"),
    ("<", r"</?[A-Za-z][^<>]*+>", ""),
    ("\n=", r"(?m)^([^\n#>*+-][^\n]*+)\n=++[ \t]*+$", "# $1"),
    ("\n-", r"(?m)^([^\n#>*+-][^\n]*+)\n-++[ \t]*+$", "## $1"),
    ("#", rf"(?m)^(#{{1,6}})(?!#)[ \t]*+({_HEADING})[ \t]*+#*+[ \t]*+$", "$1 $2"),
    ("", r"(?m)^ {0,3}(?:(?:\*[ \t]*+){3,}+|(?:-[ \t]*+){3,}+|(?:_[ \t]*+){3,}+)$", "* * *"),
    ("", r"(?m)^([ \t]*+)[*+-][ \t]++", "$1* "),
    ("***", r"\*\*\*([^*\s](?:[^*\n]*[^*\s])?)\*\*\*", "**_$1_**"),
    ("__", r"__([^_\n]++)__", "**$1**"),
    ("*", r"(^|[^*\w\\])\*([^*\s](?:[^*\n]*[^*\s])?)\*([^*\w]|$)", "$1_$2_$3"),
    ("\\", r"\\([`*_{}\[\]()#+.!-])", "$1"),
    ("&nbsp;", r"&nbsp;", " "),
    ("&quot;", r"&quot;", '"'),
    ("&lt;", r"&lt;", "<"),
    ("&gt;", r"&gt;", ">"),
    ("&amp;", r"&amp;", "&"),
)
# Constructs that may stay open: their pattern sees a text only up to its last such end.
CLOSED_BY = "-->"


def markdown_to_text(markdown):
    """Readable text of Markdown: links become labels, images disappear.

    The target is the sequence of whitespace-separated tokens, which is all the
    chunker sees; line wrapping of a renderer is not reproduced.
    """
    texts = F.array(markdown)  # one element, so that every rule sees its input once
    for occurs, pattern, replacement in MARKDOWN_RULES:
        texts = F.transform(texts, _rule(occurs, pattern, replacement))
    return F.get(texts, F.lit(0))


def _rule(occurs, pattern, replacement):
    """Apply a pattern only to texts that hold its mark: most texts skip most rules."""

    def apply(t):
        if occurs != CLOSED_BY:
            return F.regexp_replace(t, pattern, replacement)
        tail = F.substring_index(t, CLOSED_BY, -1)
        head = F.substring(t, F.lit(1), F.char_length(t) - F.char_length(tail))
        return F.concat(F.regexp_replace(head, pattern, replacement), tail)

    return lambda t: F.when(t.contains(occurs), apply(t)).otherwise(t)
