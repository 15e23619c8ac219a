"""Leaf blocks of an HTML page, in page order, with their tag paths.

A block is the text between two block-level tags; inline tags do not split it,
and a line break inside it is white space.  Scripts, styles, comments, text areas,
titles and templates have no blocks; all other elements do, also drawings,
formulas, frames and what stands for them, and a labeller may decide on them.
Missing and stray end tags are taken as browsers take them: a paragraph ends where
the next block-level element starts, which also ends a drawing or formula, an end
tag closes what is open inside its element, and one without a start is ignored.
An element that closes itself has no content, whatever it is.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape

#: Elements whose content is no markup: it is skipped up to their end tag.
SKIPPED = "script|style|title|textarea"
#: Elements whose content is markup but never shown.
UNSEEN = "template"
#: Drawings and formulas, and the elements that stand inside a line of them.
FOREIGN = frozenset(["svg", "math"])
FOREIGN_INLINE = frozenset(
    "svg g defs symbol use path circle ellipse line polygon polyline rect text tspan textpath image lineargradient radialgradient stop clippath mask desc metadata"
    " math mi mo mn ms mtext mspace mrow mfrac msqrt mroot msup msub msubsup munder mover munderover mmultiscripts mprescripts mstyle merror mpadded mphantom menclose semantics annotation".split()
)
#: Elements that stand inside a line of text.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: A start tag of the key closes an open element of the values, up to the nearest list or table.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset(["ul", "ol", "dl", "table", "select"])

TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({SKIPPED})\b[^>]*+(?<!/)>.*?(?:</\1\b[^>]*+>|\Z)|<[!?][^>]*+>"
    r"|<(/?)([a-z][a-z0-9:-]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>",
    re.S | re.I,
)
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
NAME_PARTS = re.compile(r"[a-z]+|[0-9]+")


@dataclass(frozen=True, slots=True)
class Block:
    text: str
    #: Per open element, outermost first: its tag, then "." and each word of its class, id and role.
    path: tuple[str, ...]
    #: Characters inside links.
    link_chars: int


def _names(tag: str, attributes: str) -> tuple[str, ...]:
    if "=" not in attributes:
        return (tag,)
    words = []
    for m in NAMES.finditer(attributes):
        words += NAME_PARTS.findall((m[1] or m[2] or m[3] or "").lower())
    return (tag, *[f".{w}" for w in words])


def blocks(html: str) -> list[Block]:
    """The non-empty blocks; white space inside is one space, references are decoded."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    path: tuple[str, ...] | None = None
    links = link_chars = unseen = foreign = 0

    def text(raw: str) -> None:
        nonlocal path, link_chars
        if raw and not unseen:
            parts.append(raw)
            if path is None and not raw.isspace():
                path = tuple(name for _, names in stack for name in names)
            if links:
                link_chars += len(raw.strip())

    def end_block() -> None:
        nonlocal path, link_chars
        if path is not None:
            joined = "".join(parts)
            joined = " ".join((unescape(joined) if "&" in joined else joined).split())
            if joined:
                out.append(Block(joined, path, min(link_chars, len(joined))))
        parts.clear()
        path, link_chars = None, 0

    def close(at: int) -> None:
        nonlocal links, unseen, foreign
        links -= sum(tag == "a" for tag, _ in stack[at:])
        unseen -= sum(tag == UNSEEN for tag, _ in stack[at:])
        foreign -= sum(tag in FOREIGN for tag, _ in stack[at:])
        del stack[at:]

    done = 0
    for m in TOKEN.finditer(html):
        text(html[done : m.start()])
        done = m.end()
        tag = m[3]
        if tag is None:  # a comment, declaration or skipped element
            continue
        tag = tag.lower()
        if tag == "br":
            parts.append(" ")
            continue
        inline = tag in INLINE or tag in FOREIGN_INLINE
        if not inline:
            end_block()
        if m[2]:
            for at in range(len(stack) - 1, -1, -1):
                if stack[at][0] == tag:
                    close(at)
                    break
            continue
        if tag in VOID or m[4].endswith("/"):
            continue
        if not inline:
            if foreign:
                close(next(at for at in range(len(stack)) if stack[at][0] in FOREIGN))
            for at in range(len(stack) - 1, -1, -1):
                if stack[at][0] == "p" or stack[at][0] in CLOSES.get(tag, ()):
                    close(at)
                    break
                if stack[at][0] in SCOPES or stack[at][0] not in INLINE and stack[at][0] not in ("td", "th"):
                    break
        links += tag == "a"
        unseen += tag == UNSEEN
        foreign += tag in FOREIGN
        stack.append((tag, _names(tag, m[4])))
    text(html[done:])
    end_block()
    return out
