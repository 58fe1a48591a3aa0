"""Leaf blocks of an HTML page: the runs of text between block elements, with the elements around them."""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape

# Elements of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe noembed noframes xmp noscript template".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr nobr".split()
)
CLOSES = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]),
    "th": frozenset(["td", "th"]),
    "option": frozenset(["option"]),
    "thead": frozenset(["tr", "td", "th", "thead", "tbody", "tfoot"]),
    "tbody": frozenset(["tr", "td", "th", "thead", "tbody", "tfoot"]),
    "tfoot": frozenset(["tr", "td", "th", "thead", "tbody", "tfoot"]),
}
SCOPES = frozenset("ul ol dl table select article section nav header footer aside main form div body html".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<close2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)(?P<rest2>[^>]*+)>",
    re.S,
)
NAMED = re.compile(r"(?:^|[\s\"'])(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)


@dataclass
class Block:
    text: str
    around: tuple[tuple[str, str], ...]  # element name and its class, id and role, outermost first
    linked: int  # characters inside links
    last: str  # the element that the text stands in


def blocks_of(html: str) -> list[Block]:
    """The blocks of a page in order: character references decoded, white space made one space, empty ones left out."""
    blocks: list[Block] = []
    stack: list[tuple[str, str]] = []
    parts: list[str] = []
    state = {"links": 0, "linked": 0}

    def flush() -> None:
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                blocks.append(Block(text, tuple(stack), min(state["linked"], len(text)), stack[-1][0] if stack else ""))
            parts.clear()
        state["linked"] = 0

    def add(text: str) -> None:
        if text:
            parts.append(text)
            if state["links"]:
                state["linked"] += len(text)

    def close(names: frozenset[str]) -> None:
        """Close what an opening tag ends without saying so: everything down to the outermost of `names` in this scope."""
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in names:
                del stack[k:]
                close(names)
                return
            if stack[k][0] in SCOPES:
                return

    at, size = 0, len(html)
    while at < size:
        token = TOKEN.search(html, at)
        if token is None:
            break
        add(html[at : token.start()])
        at = token.end()
        name = token["name"] or token["name2"]
        if name is None:
            continue
        name = name.lower()
        closing, rest = (token["close"] or token["close2"]), (token["rest"] or token["rest2"] or "")
        if name == "br":
            add(" ")
        elif name in INLINE:
            if name == "a":
                state["links"] = 0 if closing else 1
        elif closing:
            if name == "p" or any(one == name for one, _ in stack):
                flush()
                state["links"] = 0
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == name:
                        del stack[k:]
                        break
                    if name == "p" and stack[k][0] in SCOPES:
                        break
        elif name in RAW:
            if not rest.endswith("/") or name in ("script", "style", "title"):
                end = re.compile(f"</{name}(?=[\\s/>])[^>]*>", re.I).search(html, at)
                at = end.end() if end else size
        elif name in VOID:
            if name == "hr":
                flush()
        else:
            flush()
            state["links"] = 0
            close(CLOSES.get(name, frozenset()) | {"p"})
            if not rest.endswith("/") or name in ("p", "div", "li", "td"):
                named = " ".join(a or b or c for a, b, c in NAMED.findall(rest)).lower() if rest else ""
                stack.append((name, named))
    add(html[at:])
    flush()
    return blocks
