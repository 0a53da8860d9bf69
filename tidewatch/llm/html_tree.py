"""HTML as a tree of block elements with their text, for pages as they are found."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

from tidewatch.shipping import ship_by_value

ship_by_value(__name__)

# Elements by what HTML says of them.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr br".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TEXT = frozenset("script style textarea title noscript iframe noembed noframes xmp template".split())
HIDDEN = frozenset("script style textarea title noscript iframe noembed noframes template head select option button object svg math canvas audio video map datalist".split())
# Elements that can be in a head; any other one, or text, ends it.
IN_HEAD = frozenset("title meta link base basefont bgsound script style noscript noframes template html head".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hgroup hr main menu nav ol p pre search section table ul li dd dt body td th tr tbody thead tfoot".split()
)
# An element that begins closes an open one of these kinds, up to the given container.
CLOSES = {
    "li": (frozenset({"li"}), frozenset({"ul", "ol", "menu"})),
    "dt": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "dd": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "tr": (frozenset({"tr", "td", "th"}), frozenset({"table"})),
    "td": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "th": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "option": (frozenset({"option"}), frozenset({"select"})),
    "body": (frozenset({"head"}), frozenset()),
}

# A tag is looked for where one can begin; nothing that a pattern has passed is tried again.
_BEGIN = re.compile(r"<(?:(!--)|(/?)([a-zA-Z][^\s/>]*+)()|[!?/])")
_TAG = re.compile(r"<(?:(!--)|(/?)([a-zA-Z][^\s/>]*+)(?:((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>)?|[!?/])")
_ATTRIBUTE = re.compile(r"(?<![^\s=/\"'>])([^\s=/\"'>]++)\s*+=\s*+(\"[^\"]*+\"|'[^']*+'|[^\s>]*+)")
_SPACE = re.compile(r"\s+")


@dataclass
class Node:
    tag: str
    parent: int
    attributes: str = ""
    # Runs of text inside the element itself: (order in the page, text, characters inside links).
    runs: list[tuple[int, str, int]] = field(default_factory=list)
    hidden: bool = False


def attribute(raw: str, name: str) -> str:
    for key, value in _ATTRIBUTE.findall(raw):
        if key.lower() == name:
            return html.unescape(value.strip("\"'"))
    return ""


def parse(page: str | None) -> list[Node]:
    """Nodes in page order, parents before children; node 0 is the page itself.

    Inline elements belong to the text around them.  End tags that fit nothing are ignored, missing ones implied.  What
    no ``>`` follows is text.  From the first tag on whose quote never ends, quotes are not heeded and a tag ends at the
    next ``>``.  The time is in proportion to the page, whatever is in it.
    """
    page = page or ""
    nodes = [Node("#page", -1)]
    stack = [0]  # open block elements
    places: dict[str, list[int]] = {}  # where in the stack those of each kind are
    endless: set[str] = set()  # raw elements that no end tag follows
    quotes = True
    links = 0
    text: list[str] = []
    linked = 0
    order = 0

    def flush() -> None:
        nonlocal linked, order
        if text:
            joined = _SPACE.sub(" ", html.unescape("".join(text))).strip()
            if joined:
                nodes[stack[-1]].runs.append((order, joined, min(linked, len(joined))))
                order += 1
            text.clear()
        linked = 0

    def cut(k: int) -> None:
        for i in stack[k:]:
            places[nodes[i].tag].pop()
        del stack[k:]

    def innermost(kinds) -> int:
        return max((places[tag][-1] for tag in kinds if places.get(tag)), default=0)

    def close(kinds, until) -> None:
        k = innermost(kinds)
        if k and (k == len(stack) - 1 or k >= innermost(until)):
            flush()
            cut(k)

    def next_tag(at: int) -> tuple[int, int, str, str, str]:
        """Where the next tag begins and ends, its slash, its name ("" for comments and such) and what follows that."""
        nonlocal quotes
        begin = (_TAG if quotes else _BEGIN).search(page, at)
        if not begin:
            return end, end, "", "", ""
        start, after = begin.span()
        comment, closing, tag, rest = begin.groups()
        if tag and rest is not None and quotes:
            return start, after, closing, tag.lower(), rest
        quotes = quotes and (not tag or start > last)
        stop = page.find("-->" if comment else ">", after)
        if stop < 0:
            return (start if comment else end), end, "", "", ""
        return start, stop + (3 if comment else 1), closing or "", (tag or "").lower(), page[after:stop]

    at, end, last = 0, len(page), page.rfind(">")
    while at < end:
        start, after, closing, tag, rest = next_tag(at)
        chunk = page[at:start]
        if nodes[stack[-1]].tag == "head" and chunk and not chunk.isspace():
            cut(len(stack) - 1)
        if chunk and not nodes[stack[-1]].hidden:
            text.append(chunk)
            if links:
                linked += len(chunk)
        at = after
        if not tag:
            continue
        if nodes[stack[-1]].tag == "head" and not closing and tag not in IN_HEAD:
            cut(len(stack) - 1)
        if tag in INLINE:
            if tag == "a":
                links = max(0, links + (-1 if closing else 1))
            elif tag == "br" and not nodes[stack[-1]].hidden:
                text.append(" ")
            continue
        if closing:
            close({tag}, {"table"} if tag not in ("table", "body", "html") and tag in ("td", "th", "tr") else frozenset())
            links = 0 if tag in CLOSES_P else links
            continue
        flush()
        if tag in CLOSES_P:
            close({"p"}, {"td", "th", "table", "button", "article", "section", "div"})
            links = 0
        if tag in CLOSES:
            close(*CLOSES[tag])
        if tag in VOID or rest.endswith("/") and tag not in RAW_TEXT and tag in ("svg", "path"):
            continue
        if tag in RAW_TEXT:
            # Everything up to the end tag is text of this element, which is never shown.
            stop = None if tag in endless else re.compile(rf"</{tag}\s*+>", re.I).search(page, at)
            if stop:
                at = stop.end()
                continue
            endless.add(tag)
            if tag in ("script", "style", "textarea", "title", "iframe"):
                break
            continue
        if tag in ("html",):
            continue
        nodes.append(Node(tag, stack[-1], rest, hidden=nodes[stack[-1]].hidden or tag in HIDDEN))
        places.setdefault(tag, []).append(len(stack))
        stack.append(len(nodes) - 1)
    flush()
    return nodes
