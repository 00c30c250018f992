"""Flat text blocks of an HTML page, in page order."""

from __future__ import annotations

import html
import re
from typing import NamedTuple

# Elements that a reader never sees as running text, with all they contain.
_UNSEEN = (
    "script", "style", "noscript", "template", "svg", "math", "iframe", "object", "canvas", "select", "textarea",
    "button", "title", "audio", "video", "map", "datalist",
)
# Elements that begin and end a block; all others are part of the line they stand in.
_BLOCK = frozenset(
    (
        "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir",
        "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "frameset", "h1", "h2", "h3", "h4",
        "h5", "h6", "head", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "optgroup",
        "p", "pre", "search", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
    )
)
_VOID = frozenset(
    ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")
)
# Blocks that a new one of their kind, or any block, ends without a closing tag.
_LINES = frozenset(("p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "td", "th", "tr", "option"))
_HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
_ASIDE = frozenset(("nav", "footer", "aside", "form", "menu", "dialog", "search", "fieldset"))
_MAIN = frozenset(("article", "main"))
# Words of class, id and role that name what is not the article, and what is.
_ASIDE_WORDS = frozenset(
    (
        "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs",
        "byline", "comment", "comments", "commentlist", "complementary", "consent", "contentinfo", "cookie", "cookies",
        "copyright", "discussion", "disqus", "footer", "gdpr", "header", "login", "masthead", "menu", "menubar", "modal",
        "nav", "navbar", "navigation", "newsletter", "notice", "notices", "notification", "pager", "pagination", "popup",
        "promo", "promoted", "promotion", "recommended", "related", "replies", "reply", "respond", "search", "share",
        "sharing", "sidebar", "signup", "skip", "social", "sponsor", "sponsored", "subscribe", "tags", "teaser",
        "toolbar", "topbar", "widget", "widgets",
    )
)
_MAIN_WORDS = frozenset(("article", "body", "content", "entry", "main", "maincontent", "post", "story", "text"))
_TITLE_WORDS = frozenset(("header", "byline", "notice"))  # inside an article these may be part of it: only headings stay

# A name that begins or ends so tells a state of the page, not what the element is: has-sidebar, menu-open.
_STATE_FIRST = frozenset(("has", "is", "no", "with", "without"))
_STATE_LAST = frozenset(("active", "closed", "collapsed", "disabled", "enabled", "open", "opened", "visible"))

# Unseen elements whose content is no markup: without an end tag they run to the end of the page.
_RAW = {name: re.compile(rf"</{name}\s*>", re.IGNORECASE) for name in ("script", "style", "textarea", "title")}
# Elements, and what stands in them, that a slash before the bracket ends.
_FOREIGN = ("svg", "math")

_NO_TAG = r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
# A name, and behind an equals sign a value: in quotes, or up to a space or the bracket, whatever quotes stand in it.
# A quote that never ends, or stands where a name begins, is a character like others.
_ATTRIBUTE = r"""[\s/]+|[^\s/>][^\s/>=]*(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s>"'][^\s>]*)?)?"""
_ATTRIBUTES = rf"((?:{_ATTRIBUTE})*+)(?:>|\Z)"
_TOKEN = re.compile(_NO_TAG + r"|<(/?)([a-zA-Z][^\s/>]*+)" + _ATTRIBUTES, re.DOTALL)
_UNSEEN_TAG = re.compile(
    _NO_TAG + r"|<(/?)(" + "|".join(_UNSEEN) + r")(?=[\s/>])" + _ATTRIBUTES, re.DOTALL | re.IGNORECASE
)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_HIDDEN = re.compile(
    r"""\shidden(?=[\s=/]|$)|display\s*:\s*none|visibility\s*:\s*hidden|\saria-hidden\s*=\s*["']?true""", re.IGNORECASE
)
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_WORD_SPLIT = re.compile(r"[^a-z0-9]+")
_SPACE = re.compile(r"\s+")


class Block(NamedTuple):
    text: str
    words: int
    link_density: float
    aside: bool
    main: bool
    heading: bool


class _Open(NamedTuple):
    tag: str
    aside: bool
    main: bool
    hidden: bool


def _words_of(attributes: str) -> set[str]:
    found = set()
    for names in _NAMES.findall(attributes):
        for name in "".join(names).split():
            parts = _WORD_SPLIT.split(_CAMEL.sub(" ", name).lower())
            if len(parts) == 1 or not (parts[0] in _STATE_FIRST or parts[-1] in _STATE_LAST):
                found.update(parts)
    return found


def _entered(tag: str, attributes: str, outer: _Open) -> _Open:
    """What an element adds to what it stands in: once beside the article, all inside is."""
    aside, main, hidden = outer.aside, outer.main, outer.hidden
    names = _words_of(attributes) if "=" in attributes else set()
    if tag in _MAIN:
        main = main or not aside
        names &= {"comment", "comments", "teaser", "related", "sidebar", "ad", "ads", "promo", "sponsored", "reply"}
    elif tag in _ASIDE or (tag == "header" and not main):
        aside = True
    if tag not in ("html", "body", "main"):
        own = names & _ASIDE_WORDS
        if main or names & _MAIN_WORDS:
            own -= _TITLE_WORDS if main else {"header"}
        if own:
            aside = True
        elif names & _MAIN_WORDS and not aside:
            main = True
    if attributes and _HIDDEN.search(attributes):
        hidden = True
    return _Open(tag, aside, main, hidden)


def _unseen(page: str) -> dict[int, int]:
    """Where each unseen element begins and ends. Without an end tag it is not there: only its tag is skipped."""
    ends: dict[int, int] = {}
    begun: dict[str, list[int]] = {name: [] for name in _UNSEEN}
    at = 0
    while token := _UNSEEN_TAG.search(page, at):
        at = token.end()
        if not token[2]:
            continue
        tag = token[2].lower()
        foreign = tag in _FOREIGN or any(begun[name] for name in _FOREIGN)
        if token[1]:
            if begun[tag]:
                ends[begun[tag].pop()] = at
        elif foreign and token[3].endswith("/"):
            ends[token.start()] = at
        elif tag in _RAW and not foreign:
            end = _RAW[tag].search(page, at)
            at = ends[token.start()] = end.end() if end else len(page)
        else:
            begun[tag].append(token.start())
    return ends


def blocks(page: str) -> list[Block]:
    """The text between block elements, references decoded, white space single; empty ones left out."""
    found: list[Block] = []
    stack = [_Open("", False, False, False)]
    pieces: list[str] = []
    links: list[str] = []
    link_depth = 0
    heading = False

    def end_block() -> None:
        if pieces:
            text = _SPACE.sub(" ", html.unescape("".join(pieces))).strip()
            if text and not stack[-1].hidden:
                words = text.count(" ") + 1
                linked = len(html.unescape("".join(links)).split())
                found.append(Block(text, words, min(1.0, linked / words), stack[-1].aside, stack[-1].main, heading))
            pieces.clear()
            links.clear()

    def take(text: str) -> None:
        if text:
            pieces.append(text)
            if link_depth:
                links.append(text)

    unseen = _unseen(page)
    at = 0
    while token := _TOKEN.search(page, at):
        take(page[at : token.start()])
        at = token.end()
        if not token[2]:
            continue
        tag, closing = token[2].lower(), token[1]
        if tag in _UNSEEN and not closing:
            at = unseen.get(token.start(), at)
            if tag in ("title", "button", "select", "textarea"):
                end_block()
            continue
        if tag == "a":
            link_depth = 0 if closing else 1
        elif tag == "br" or tag == "wbr":
            take(" " if tag == "br" else "")
        elif tag in _BLOCK:
            end_block()
            heading = not closing and tag in _HEADINGS
            if tag in _VOID:
                continue
            if closing:
                link_depth = 0
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth].tag == tag:
                        del stack[depth:]
                        break
            else:
                while stack[-1].tag in _LINES and (tag == stack[-1].tag or stack[-1].tag in ("p", *_HEADINGS)):
                    stack.pop()
                stack.append(_entered(tag, token[3], stack[-1]))
        elif not closing and tag not in _VOID and ("=" in token[3] or "hidden" in token[3].lower()):
            # An inline element only matters if it is named or hidden; it is a block then.
            inner = _entered(tag, token[3], stack[-1])
            if inner[1:] != stack[-1][1:]:
                end_block()
                stack.append(inner)
        elif closing and any(o.tag == tag for o in stack):
            end_block()
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    del stack[depth:]
                    break
    take(page[at:])
    end_block()
    return found
