"""Labelled pages: layouts with known parts, and what pages say about themselves."""

from __future__ import annotations

import random

from tidewatch.llm.html_tree import Node, attribute
from tidewatch.shipping import ship_by_value

ship_by_value(__name__)

CONTENT_TAGS = frozenset({"article", "main"})
OTHER_TAGS = frozenset("nav aside footer form header menu dialog".split())
# Class names as sites use them, by the part of the page that they mark.
CONTENT_NAMES = "content main article post entry body story text post-content entry-content article-body main-content post-body page-content".split()
OTHER_NAMES = {
    "menu": "nav menu navbar navigation breadcrumb breadcrumbs topnav main-menu site-nav tabs pagination pager".split(),
    "header": "header site-header masthead banner top-bar page-header logo".split(),
    "footer": "footer site-footer bottom copyright colophon page-footer legal".split(),
    "sidebar": "sidebar side aside widget widgets related recommended rail right-column popular trending".split(),
    "notice": "notice cookie cookies cookie-banner consent alert gdpr message disclaimer cookie-notice popup modal newsletter".split(),
    "advert": "ad ads advert advertisement ad-banner sponsored promo promotion adsbox banner-ad sponsor".split(),
    "form": "form search search-form login signup subscribe newsletter-form contact-form".split(),
    "comments": "comments comment comment-list reader-comments responses replies reply discussion disqus user-comments comment-body".split(),
    "share": "share social social-links sharing buttons tags meta byline".split(),
}


def _words(r: random.Random, n: int) -> str:
    words = ["".join(r.choice(["ta", "re", "lon", "mi", "sed", "ur", "ka", "ve", "no", "is"]) for _ in range(r.randint(1, 4))) for _ in range(n)]
    return " ".join(w + ("," if r.random() < 0.08 else "." if r.random() < 0.08 else "") for w in words).capitalize() + "."


def _part(r: random.Random, kind: str, wrap: str) -> str:
    """One part of a page that is no content, with semantic or plain markup."""
    name = r.choice(OTHER_NAMES[kind])
    attr = f'{r.choice(["class", "class", "id"])}="{name}"' if r.random() < 0.85 or wrap == "div" else ""
    prose = lambda lo, hi: _words(r, r.randint(lo, hi))
    links = lambda lo, hi: "".join(f'<li><a href="/x">{prose(1, 4)}</a></li>' for _ in range(r.randint(lo, hi)))
    if kind == "menu":
        return f"<{wrap} {attr} data-label=0><ul>{links(3, 8)}</ul></{wrap}>"
    if kind == "sidebar":
        inner = f"<h3>{prose(1, 3)}</h3><ul>{links(2, 6)}</ul>" if r.random() < 0.6 else f"<h4>{prose(1, 3)}</h4><p>{prose(5, 40)}</p>"
        return f"<{wrap} {attr} data-label=0>{inner}</{wrap}>"
    if kind == "comments":
        item = lambda: f'<{r.choice(["div", "li"])} class="{r.choice(["comment", "reply", "comment-item"])}"><p>{prose(5, 60)}</p>'
        inner = "".join(x + ("</div>" if x.startswith("<div") else "</li>") for x in (item() for _ in range(r.randint(1, 5))))
        return f"<{wrap} {attr} data-label=0><h3>{prose(1, 2)}</h3>{inner}</{wrap}>"
    if kind == "form":
        return f'<{wrap} {attr} data-label=0><label>{prose(1, 4)}</label><input name="q"><p>{prose(3, 12)}</p><button>{prose(1, 2)}</button></{wrap}>'
    if kind in ("header", "footer", "share"):
        inner = r.choice([f"<p>{prose(2, 12)}</p>", f"&copy; {prose(2, 10)}", f"<h2>{prose(1, 4)}</h2>", f'<a href="/">{prose(1, 3)}</a> {prose(1, 5)}'])
        return f"<{wrap} {attr} data-label=0>{inner}</{wrap}>"
    return f"<{wrap} {attr} data-label=0>{r.choice([prose(4, 30), f'<p>{prose(4, 40)}</p>'])}</{wrap}>"


_WRAPS = {"menu": ["nav", "div", "ul"], "header": ["header", "div"], "footer": ["footer", "div"], "sidebar": ["aside", "div", "section"], "form": ["form", "form", "div"], "comments": ["section", "div", "ul"]}


def layouts(count: int = 400, seed: int = 11) -> list[str]:
    """Pages of random parts in random markup; data-label tells what is content and is never a feature."""
    r = random.Random(seed)
    pages = []
    for _ in range(count):
        blocks = []
        # Some articles are no prose: words repeated, in capitals, or without punctuation.
        odd = r.choice([None, None, None, "repeated", "plain", "signs"])
        for _ in range(r.randint(1, 14)):
            kind = r.random()
            text = _words(r, r.choice([2, 6, 15, 40, 90]))
            if odd == "repeated":
                text = " ".join([text.split()[0].strip(".,")] * len(text.split()))
            elif odd == "plain":
                text = text.replace(".", "").replace(",", "").upper()
            elif odd == "signs":
                text = text.replace(" ", "!! ").replace(".", r.choice(["", "###", "!!"]))
            if kind < 0.72:
                blocks.append(f"<p>{text}</p>")
            elif kind < 0.82:
                blocks.append(f"<h{r.randint(2, 4)}>{_words(r, r.randint(1, 6))}</h{r.randint(2, 4)}>")
            elif kind < 0.9:
                blocks.append("<ul>" + "".join(f"<li>{_words(r, r.randint(2, 15))}</li>" for _ in range(r.randint(2, 5))) + "</ul>")
            elif kind < 0.95:
                blocks.append(f"<blockquote><p>{text}</p></blockquote>")
            else:
                blocks.append(f"<div>{text}</div>")
        if r.random() < 0.45:
            for _ in range(r.randint(1, 2)):
                kind = r.choice(["advert", "share", "sidebar", "notice", "comments"])
                blocks.insert(r.randint(0, len(blocks)), _part(r, kind, r.choice(_WRAPS.get(kind, ["div"]))))
        wrap = r.choice(["article", "article", "main", "div", "div", "section"])
        attr = f'class="{r.choice(CONTENT_NAMES)}"' if wrap in ("div", "section") or r.random() < 0.3 else ""
        title = f"<h1>{_words(r, r.randint(2, 10))}</h1>" if r.random() < 0.8 else ""
        article = f"<{wrap} {attr} data-label=1>{title}{''.join(blocks)}</{wrap}>"
        before = [_part(r, k, r.choice(_WRAPS.get(k, ["div"]))) for k in ("header", "menu", "notice", "advert", "form") if r.random() < 0.45]
        after = [_part(r, k, r.choice(_WRAPS.get(k, ["div"]))) for k in ("sidebar", "comments", "share", "advert", "footer", "notice", "form") if r.random() < 0.4]
        body = "".join(before) + article + "".join(after)
        if r.random() < 0.4:
            body = f'<div class="{r.choice(["wrapper", "container", "page", "site", "layout", "row"])}">{body}</div>'
        pages.append(f"<html><head><title>x</title></head><body>{body}</body></html>")
    return pages


def known_label(nodes: list[Node]) -> list[int] | None:
    """A label for every node where the page tells: by data-label, else by its semantic elements."""
    own = any("data-label" in x.attributes for x in nodes)
    if not own and not any(x.tag in CONTENT_TAGS for x in nodes):
        return None
    labels = [0] * len(nodes)
    for i in range(1, len(nodes)):
        x = nodes[i]
        said = attribute(x.attributes, "data-label") if own else "1" if x.tag in CONTENT_TAGS else "0" if x.tag in OTHER_TAGS else ""
        labels[i] = int(said) if said else labels[x.parent]
    return labels
