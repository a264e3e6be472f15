"""Leaf blocks of web pages: runs of text with no block-level element inside, and where they lie."""

from __future__ import annotations

import html
import re
import zlib
from collections import Counter
from typing import NamedTuple

#: Elements that begin and end a block of text.
BLOCK_TAGS = frozenset(
    "address article aside blockquote button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hgroup label legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul".split()
)
#: Elements whose content is not markup, elements that are never shown, elements without content.
RAW_TAGS = frozenset("script style title textarea iframe noembed noframes xmp".split())
HIDDEN_TAGS = frozenset("template noscript svg math object canvas audio video datalist".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: What a start tag ends without an end tag, and where the search for it stops.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr"}, {"table"}),
    "tbody": ({"tbody", "thead", "tfoot"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}),
}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
SECTIONS = frozenset("article aside dialog div fieldset figure footer form header main nav section table ul ol dl td".split())

_TAG = re.compile(r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*>|</[^a-zA-Z][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)>", re.S)
_OPEN = re.compile(r"<[a-zA-Z/!?]")
_NAMES = re.compile(r"(?:^|[\s\"'])(?:class|id|role|itemprop)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
FEATURE_BITS = 16


def code(feature: str) -> int:
    """The weight that a feature shares with whatever hashes alike."""
    return zlib.crc32(feature.encode("utf-8", "replace")) & ((1 << FEATURE_BITS) - 1)


def named(attributes: str) -> frozenset[str]:
    """The words in an element's class, id, role and itemprop, in lower case."""
    return frozenset(t.lower() for value in _NAMES.findall(attributes) for t in _TOKEN.findall(value))


class Place:
    """A chain of open elements. Chains are shared: the same element opened again at the same place is the
    same object, and names that an ancestor has already add nothing, so deep nesting stays cheap."""

    __slots__ = ("tag", "parent", "names", "hidden", "tags", "features", "section", "below", "_codes")

    def __init__(self, tag: str = "", parent: Place | None = None, names: frozenset[str] = frozenset()) -> None:
        self.tag, self.parent, self.names, self.below, self._codes = tag, parent, names, {}, None
        if parent is None:
            self.hidden, self.tags, self.features, self.section = False, frozenset(), frozenset(), ""
            return
        self.hidden = parent.hidden or tag in HIDDEN_TAGS
        self.tags = parent.tags if tag in parent.tags else parent.tags | {tag}
        own = {f"in {tag}", *(f"named {n}" for n in names)}
        self.features = parent.features if own <= parent.features else parent.features | own
        self.section = tag if tag in SECTIONS else parent.section

    def open(self, tag: str, attributes: str) -> Place:
        key = (tag, attributes)
        if key not in self.below:
            self.below[key] = Place(tag, self, named(attributes) if attributes else frozenset())
        return self.below[key]

    @property
    def codes(self) -> list[int]:
        """Features of the place: all ancestors' tags and names, the nearest elements, the nearest section."""
        if self._codes is None:
            up = self.parent.tag if self.parent else ""
            outer = self.parent.section if self.parent else ""
            near = [f"own {self.tag}", f"up {up}", f"own {self.tag} section {self.section}", f"section {self.section} outer {outer}", f"own {self.tag} up {up} named {bool(self.names)}"]
            near += [f"own named {n}" for n in sorted(self.names)] + [f"up named {n}" for n in sorted(self.parent.names if self.parent else ())]
            self._codes = [code(f) for f in sorted(self.features) + near]
        return self._codes


class Block(NamedTuple):
    text: str
    linked: int  # characters inside links
    place: Place


def blocks(page: str) -> list[Block]:
    """The shown leaf blocks of a page in order; references decoded, white space as single spaces.

    Malformed markup ends where a browser would end it: missing end tags are implied by what follows, end tags
    without a start are borders only, an unclosed comment or script goes to the end.
    """
    out: list[Block] = []
    top = Place()
    stack, open_tags = [top], Counter()
    parts: list[str] = []
    linked, link_at = 0, 0  # link_at: depth of the stack where the open link began, 0 for none
    at, last = 0, page.rfind(">")

    def say(raw: str) -> None:
        nonlocal linked
        if raw and not stack[-1].hidden:
            shown = html.unescape(raw) if "&" in raw else raw
            parts.append(shown)
            if link_at:
                linked += len(shown.strip())

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append(Block(text, min(linked, len(text)), stack[-1]))
            parts.clear()
        linked = 0

    def close(upto: int) -> None:
        nonlocal link_at
        open_tags.subtract(p.tag for p in stack[upto:])
        del stack[upto:]
        if link_at > len(stack):
            link_at = 0

    def end(names: set[str] | frozenset[str], until: set[str] | frozenset[str]) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in names:
                close(i)
                return
            if stack[i].tag in until:
                return

    while 0 <= at <= last:
        found = _TAG.search(page, at, last + 1)
        if found is None:
            break
        say(page[at : found.start()])
        at = found.end()
        if found[2] is None:
            if page.startswith("<!--", found.start()) and not found[0].endswith(("-->", "--!>")):
                at = len(page)
            continue
        tag = found[2].lower()
        if found[1]:
            if tag == "a":
                link_at = 0
            elif tag in BLOCK_TAGS or tag in HIDDEN_TAGS:
                flush()
                if tag in HEADINGS:
                    end(HEADINGS, BLOCK_TAGS - HEADINGS)
                elif open_tags[tag] > 0:
                    close(next(i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag))
        elif tag in RAW_TAGS:
            stop = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(page, at)
            at = stop.end() if stop else len(page)
        elif tag == "a":
            link_at = len(stack)
        elif tag == "br":
            say(" ")
        elif tag == "hr":
            flush()
        elif tag in BLOCK_TAGS or (tag in HIDDEN_TAGS and not found[3].endswith("/")):
            flush()
            if tag in BLOCK_TAGS and open_tags["p"] > 0:
                end({"p"}, BLOCK_TAGS - {"p"})
            if tag in ENDS:
                end(*ENDS[tag])
            stack.append(stack[-1].open(tag, found[3].strip()))
            open_tags[tag] += 1
    rest = page[at:]
    cut = _OPEN.search(rest)
    say(rest[: cut.start()] if cut else rest)
    flush()
    return out


def text_codes(block: Block, at: int, n: int) -> list[int]:
    """Features of a block's text and of its position among the page's blocks."""
    words = block.text.split(" ")
    few = len(words)
    own = block.place.tag
    facts = [
        "bias",
        f"words {few.bit_length()}",
        f"own {own} words {few.bit_length()}",
        f"links {4 * block.linked // len(block.text)}",
        f"ends {block.text[-1] if block.text[-1] in '.!?:;,' else ''}",
        f"capital {block.text[0].isupper()}",
        f"tenth {10 * at // n}",
        "first" if at == 0 else "last" if at == n - 1 else "inside",
    ]
    if "\N{COPYRIGHT SIGN}" in block.text:
        facts.append("copyright")
    if few <= 6:
        facts.extend(f"word {w.lower().strip('.,:;!?')}" for w in words)
    return [code(f) for f in facts]
