"""A small forgiving HTML parser: elements, text in order, nothing else."""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field

#: Element names of HTML, in natural order.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes noscript script style template title xmp".split())
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "section select summary table tbody td textarea tfoot th thead tr ul".split()
)
CLOSES_P = BLOCKS - frozenset("body button caption dd dt head html legend optgroup option select tbody td textarea tfoot th thead tr".split())
SCOPE = frozenset("applet button caption html marquee object table td template th".split())
#: What a start tag ends: tag -> (ended tags, how far to look).
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "body": ({"head"}, set()),
}
MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|</?[a-zA-Z][^>]*>", re.S
)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")


#: Elements nested deeper stand beside each other, as in browsers.
DEPTH = 200


@dataclass
class Element:
    tag: str
    attributes: dict[str, str] = field(default_factory=dict)
    items: list = field(default_factory=list)  # text and elements in order

    def elements(self) -> list[Element]:
        return [x for x in self.items if isinstance(x, Element)]


def attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, a, b, c in ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), html.unescape(a or b or c))
    return found


def parse(source: str) -> Element:
    root = Element("#root")
    stack, at, flat = [root], 0, Counter()

    def end(tags: set[str], limits: frozenset | set) -> None:
        """End the outermost of ``tags`` that no element of ``limits`` holds."""
        cut = None
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].tag in tags:
                cut = depth
            elif stack[depth].tag in limits:
                break
        if cut is not None:
            del stack[cut:]

    while found := MARKUP.search(source, at):
        if found.start() > at:
            stack[-1].items.append(html.unescape(source[at : found.start()]))
        at = found.end()
        tag = found[2]
        if not tag:
            continue
        tag = tag.lower()
        if found[1]:
            if flat[tag]:
                flat[tag] -= 1
                continue
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    del stack[depth:]
                    break
                if stack[depth].tag in ("td", "th", "table") and tag not in BLOCKS:
                    break
            continue
        if tag in CLOSES_P:
            end({"p"}, SCOPE)
        if tag in ENDS:
            end(*ENDS[tag])
        element = Element(tag, attributes(found[3]) if found[3] else {})
        stack[-1].items.append(element)
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(source, at)
            at = close.end() if close else len(source)
        elif tag not in VOID:
            if len(stack) < DEPTH:
                stack.append(element)
            else:
                flat[tag] += 1
    if at < len(source):
        stack[-1].items.append(html.unescape(source[at:]))
    return root
