"""Leaf blocks of HTML pages: the runs of text between block-level tags, each
with the tags and class words above it, and the nearest such words by themselves.

Reads whatever is there: unclosed and misnested tags, unquoted attributes,
comments and raw-text elements that never end. White space inside a block is
single, character references are decoded, and no text is cut.

A head without an end tag ends where something stands that cannot be in a head.
Another hidden element without an end tag of its own hides what follows up to
the next block-level tag or the end of the element around it.

What stands above a block is kept as sets that elements share with their parents
unless they add to them; with ``known`` (the model's own words and tags) those sets
stay small, so a page nested to any depth costs time and memory in proportion.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+(?=>)|[^>]*+)(?:>|\Z)", re.S)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
_WORD = re.compile(r"[a-z]+")
#: Elements whose text is never shown as part of the page's body.
HIDDEN = frozenset("script style template noscript head title svg iframe object".split())
#: Elements that may stand in a head.
_IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
RAW = frozenset("script style title textarea".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that do not end a block.
INLINE = frozenset("a abbr b bdi bdo cite code data del dfn em font i ins kbd label mark q s samp small span "
                   "strong sub sup time tt u var wbr img".split())
_ENDS_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 "
                    "header hr main menu nav ol p pre section table ul".split())
#: Elements that tell which part of the page a block is in.
REGIONS = frozenset("article main nav aside footer header form section".split())
_SELF = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
         "th": ("td", "th"), "option": ("option",)}


@dataclass
class Block:
    """``tags`` and ``names``: those of all elements above the text; ``leaf``: the
    innermost element; ``near``: the innermost of ``REGIONS``; ``own``: the class
    words of the innermost element that has any; ``linked``: characters in links."""

    text: str
    tags: frozenset[str]
    leaf: str
    near: str
    names: frozenset[str]
    own: frozenset[str]
    linked: int


@dataclass(slots=True)
class _Open:
    """An open element: its tag and what a block in it has above."""

    tag: str
    tags: frozenset[str]
    near: str
    names: frozenset[str]
    own: frozenset[str]


_PAGE = _Open("", frozenset(), "", frozenset(), frozenset())


def blocks(page: str | None, known: tuple[frozenset[str], frozenset[str]] | None = None) -> list[Block]:
    """The page's blocks in order; none for a null or empty page. ``known``: the
    only tags and class words of interest above a block."""
    out: list[Block] = []
    stack: list[_Open] = []
    opened: Counter[str] = Counter()
    text: list[str] = []
    links = linked = 0
    # of the open hidden elements: [blocks before it, blocks before the first block-level tag in it]
    hidden: list[list[int]] = []
    unbound: list[list[int]] = []
    page = page or ""
    at = 0

    def flush() -> None:
        nonlocal linked
        if text:
            words = html.unescape("".join(text)).split()
            text.clear()
            if words:
                e = stack[-1] if stack else _PAGE
                out.append(Block(" ".join(words), e.tags, e.tag, e.near, e.names, e.own, linked))
            linked = 0

    def pop_to(k: int, own: bool = False) -> None:
        """Close the elements from ``k`` on; ``own``: that one by its own end tag."""
        nonlocal links
        for i in range(len(stack) - 1, k - 1, -1):
            t = stack[i].tag
            opened[t] -= 1
            links -= t == "a"
            if t in HIDDEN and t not in RAW:
                mark = hidden.pop()
                if unbound and unbound[-1] is mark:
                    unbound.pop()
                first, bound = mark
                del out[first:bound if bound >= 0 and not (own and i == k) else len(out)]
        del stack[k:]

    def end_head() -> None:
        flush()
        pop_to(next(k for k, x in enumerate(stack) if x.tag == "head"))

    while at < len(page):
        m = _TOKEN.search(page, at)
        end = m.start() if m else len(page)
        if end > at:
            if stack and stack[-1].tag == "head" and not page[at:end].isspace():
                end_head()
            text.append(page[at:end])
            if links:
                linked += end - at
        if not m:
            break
        at = m.end()
        close, tag = m[1], m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if tag not in INLINE and tag not in RAW:
            flush()
        if close:
            for k in range(len(stack) - 1, -1, -1) if opened[tag] else ():
                if stack[k].tag == tag:
                    pop_to(k, own=True)
                    break
            continue
        if (stack and stack[-1].tag == "head" and tag not in _IN_HEAD
                or tag == "body" and opened["head"]):
            end_head()
        if unbound and (tag in _ENDS_P or tag in _SELF or tag == "body"):
            for mark in unbound:
                mark[1] = len(out)
            unbound.clear()
        if tag in _ENDS_P and any(e.tag == "p" for e in stack[-3:]):
            for k in range(len(stack) - 1, max(len(stack) - 4, -1), -1):
                if stack[k].tag == "p":
                    pop_to(k)
                    break
        elif tag in _SELF and stack and stack[-1].tag in _SELF[tag]:
            pop_to(len(stack) - 1)
        if tag in VOID or m[3].endswith("/") and tag not in INLINE and tag not in _ENDS_P:
            continue
        up = stack[-1] if stack else _PAGE
        own = frozenset(w for v in _NAMES.findall(m[3]) for w in _WORD.findall(v.lower())) if m[3] else up.own
        if known:
            told, tag_told = own & known[1], tag in known[0]
        else:
            told, tag_told = own, True
        stack.append(_Open(tag, up.tags if tag in up.tags or not tag_told else up.tags | {tag},
                           tag if tag in REGIONS else up.near, up.names if told <= up.names else up.names | told,
                           told if own else up.own))
        opened[tag] += 1
        links += tag == "a"
        if tag in HIDDEN and tag not in RAW:  # raw text that is hidden is skipped below
            hidden.append([len(out), -1])
            unbound.append(hidden[-1])
        if tag in RAW:
            stop = re.compile(rf"</{tag}\b", re.I).search(page, at)
            stop = stop.start() if stop else len(page)
            if tag not in HIDDEN:
                text.append(page[at:stop])
            at = stop
    flush()
    pop_to(0)
    return out
