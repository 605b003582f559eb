"""HTML as a sequence of text blocks with interned tag paths.

A tolerant reader: it never fails, closes what the language closes by itself
(paragraphs, list items, table cells), ignores end tags without a start, and
reads every character once.  A block is the text between two boundaries of
block-level elements; inline elements stay inside their block.  What a browser
doesn't show as text (scripts, styles, comments, the head's title, the
contents of form controls, templates, drawings and frames) is no block.
"""

from __future__ import annotations

import re
import zlib
from html import unescape

INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose contents aren't text of the page; of the first four the language ends only by their own end tag.
_UNREAD = frozenset("script style title textarea noscript template iframe svg object select noembed noframes audio video canvas".split())
_TO_THE_END = frozenset("script style title textarea".split())
#: Starting one of these ends an open one of the given kind, up to the element that bounds the search.
_ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
         "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr"}, {"table"}),
         "thead": ({"thead", "tbody", "tfoot"}, {"table"}), "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
         "tfoot": ({"thead", "tbody", "tfoot"}, {"table"})}
_CELLS = frozenset("table caption thead tbody tfoot tr td th".split())
_WALLS = frozenset("table td th caption".split())
_KEEPS_P = frozenset("button label output progress meter".split())
#: Elements nested deeper than this keep the path of the one above them, as browsers flatten them.
DEPTH = 512

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>""", re.S)
_ATTRIBUTE = re.compile(r"""(?<![\w-])(class|id|role|itemprop|hidden|style)\s*+(?:=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++))?""", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*+>", re.I) for tag in _UNREAD}


def _names(attributes: str) -> tuple[str, ...]:
    """The words of an element's class, id, role and kind of item, and whether it is hidden."""
    found = []
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "style":
            if "display:none" in value.replace(" ", "").lower():
                found.append("hidden")
        elif name == "hidden":
            found.append("hidden")
        else:
            found.extend(w.lower() for w in _NAME.findall(value) if len(w) > 1)
    return tuple(dict.fromkeys(found))


class Paths:
    """Tag paths, each met once: a number for it, and the hashed tokens that describe it.

    Tokens are the tags and names of all ancestors, the pairs of an element and its parent, and once
    more, marked, those of the last three elements.
    """

    def __init__(self, buckets: int) -> None:
        self.buckets = buckets
        self.known: dict[tuple, int] = {}
        self.names: dict[str, tuple[str, ...]] = {}
        self.above: list[frozenset] = [frozenset()]
        self.last: list[tuple[tuple[str, ...], ...]] = [()]
        self.tokens: list[tuple[int, ...]] = [()]

    def _bucket(self, token: str) -> int:
        return zlib.crc32(token.encode("utf-8", "replace")) % self.buckets

    def names_of(self, attributes: str) -> tuple[str, ...]:
        if not attributes or attributes == "/":
            return ()
        if attributes not in self.names:
            if len(self.names) > 50_000:
                self.names.clear()
            self.names[attributes] = _names(attributes)
        return self.names[attributes]

    def child(self, parent: int, tag: str, names: tuple[str, ...]) -> int:
        key = (parent, tag, names)
        if key not in self.known:
            own = (tag, *names, *(f"{w[:4]}~" for w in names if len(w) > 4))
            before = self.last[parent]
            pairs = (f"{p}>{w}" for p in (before[-1] if before else ("",)) for w in own)
            above = self.above[parent] | {self._bucket(t) for t in (*own, *pairs)}
            last = (*before[-2:], own)
            near = {self._bucket(f"{len(last) - i}:{t}") for i, e in enumerate(last) for t in e}
            self.known[key] = len(self.tokens)
            self.above.append(above)
            self.last.append(last)
            self.tokens.append(tuple(sorted(above | near)))
        return self.known[key]


def blocks(html: str, paths: Paths) -> list[tuple[int, str, float]]:
    """The blocks of a page in order: (path, text with white space as one space, share of its characters in links)."""
    out: list[tuple[int, str, float]] = []
    tags, places, open_tags = ["#"], [0], {}
    buffer: list[str] = []
    inline: set[str] = set()
    linked, link, pos, unclosed = 0, None, 0, set()

    def flush() -> None:
        nonlocal linked
        if buffer:
            text = " ".join("".join(buffer).split())
            if text:
                path = paths.child(places[-1], "~", tuple(sorted(inline))) if inline else places[-1]
                out.append((path, text, min(1.0, linked / len(text))))
            buffer.clear()
        linked = 0
        inline.clear()

    def cut(to: int) -> None:
        nonlocal link
        for tag in tags[to:]:
            open_tags[tag] -= 1
        del tags[to:], places[to:]
        if link is not None and link > to:
            link = None

    def add(text: str) -> None:
        nonlocal linked
        if text:
            buffer.append(unescape(text) if "&" in text else text)
            if link is not None:
                linked += len(text)

    while (m := _TAG.search(html, pos)) is not None:
        add(html[pos:m.start()])
        pos = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        attributes = (m[3] if m[2] else m[6]) or ""
        if m[1] or m[4]:  # an end
            if tag == "a":
                link = None
            elif tag not in INLINE and tag not in ("body", "html"):
                flush()
                if open_tags.get(tag):
                    at = len(tags) - 1
                    while tags[at] != tag and (tag in _CELLS or tags[at] not in _WALLS):
                        at -= 1
                    if tags[at] == tag:
                        cut(at)
            continue
        if tag in _UNREAD:
            end = None if tag in unclosed else _END[tag].search(html, pos)
            if end is not None:
                pos = end.end()
            elif tag in _TO_THE_END:
                pos = len(html)
            else:
                unclosed.add(tag)
            if tag not in ("script", "style", "noscript", "template"):
                flush()
            continue
        if tag in INLINE:
            if tag == "br":
                buffer.append(" ")
            elif tag not in VOID:
                inline.add(tag)
                inline.update(paths.names_of(attributes.strip()))
                if tag == "a":
                    link = len(tags)
            continue
        flush()
        if tag in VOID:
            continue
        if tags[-1] == "p" and tag not in _KEEPS_P or tag[0] == "h" and tag[1:].isdigit() and tags[-1][0] == "h" and tags[-1][1:].isdigit():
            cut(len(tags) - 1)
        if tag in _ENDS:
            kinds, bounds = _ENDS[tag]
            if any(open_tags.get(k) for k in kinds):
                at = len(tags) - 1
                while at > 0 and tags[at] not in kinds and tags[at] not in bounds:
                    at -= 1
                if tags[at] in kinds:
                    cut(at)
        tags.append(tag)
        open_tags[tag] = open_tags.get(tag, 0) + 1
        places.append(paths.child(places[-1], tag, paths.names_of(attributes.strip())) if len(tags) <= DEPTH else places[-1])
    add(html[pos:])
    flush()
    return out
