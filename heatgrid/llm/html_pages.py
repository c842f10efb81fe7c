"""Pages as trees of blocks: tags, implied ends, character references.

A block is an element that begins a line of its own. Inline elements are no nodes: their text belongs to
the block around them, and counts as link text inside a link. The contents of scripts, styles and other
elements that are never text are left out, as are comments. Elements deeper than ``DEEPEST`` blocks are
taken as part of the block at that depth; their text is kept.
"""

import html
import re
from dataclasses import dataclass, field
from functools import lru_cache

DEEPEST = 50

# Elements by their role in the HTML standard.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "section select summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TEXT = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset(
    "audio button canvas datalist head iframe math noembed noframes noscript object script select style svg template "
    "textarea title video xmp".split()
)
ENDS_PARAGRAPH = BLOCKS - frozenset("body caption head html legend optgroup option tbody td tfoot th thead title tr".split())
# What a start tag ends, and the elements that keep it from doing so.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
    "option": ({"option"}, {"select"}),
    "body": ({"head"}, set()),
}
SCOPES = frozenset("html table td th caption".split())
TABLE = frozenset("table tbody thead tfoot tr td th caption".split())

NAME = re.compile(r"[a-zA-Z][^\s/>]*")
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
LETTERS = re.compile(r"[a-z]+")


@dataclass(slots=True)
class Text:
    parts: list[str] = field(default_factory=list)
    linked: int = 0

    def clean(self) -> str:
        """White space of any kind turned into one space, and trimmed."""
        return " ".join("".join(self.parts).split())


@dataclass(slots=True)
class Block:
    name: str
    sign: str  # name, and the words of class, id and role
    children: list = field(default_factory=list)


@lru_cache(100_000)
def sign_of(name: str, attributes: str) -> str:
    """The name with the words of class, id and role in order, leaving out parts that hold digits."""
    words: list[str] = []
    for key, value in ATTRIBUTE.findall(attributes):
        if key.lower() in ("class", "id", "role"):
            parts = re.split(r"[^a-z0-9]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", value).lower())
            words += [part for part in parts if LETTERS.fullmatch(part)]
    return ".".join([name, *dict.fromkeys(words)])


def tags(page: str):
    """(text, None, None) between tags, (None, name, attributes) for a start and (None, "/name", "") for an end.

    A tag without its ">" and a comment without its end reach to the end of the page.
    """
    find, at, size = page.find, 0, len(page)
    unquoted = {'"': size + 1, "'": size + 1}  # from where on a quote has no partner
    while at < size:
        start = find("<", at)
        if start < 0:
            yield page[at:], None, None
            return
        if start > at:
            yield page[at:start], None, None
        following = page[start + 1 : start + 2]
        if page.startswith("<!--", start):
            short = page.startswith((">", "->"), start + 4)
            end = find(">", start + 4) if short else find("-->", start + 4)
            at = size if end < 0 else end + (1 if short else 3)
        elif following in ("!", "?") or (following == "/" and not page[start + 2 : start + 3].isalpha()):
            end = find(">", start)
            at = size if end < 0 else end + 1
        elif following == "/" or (following.isascii() and following.isalpha()):
            closing = following == "/"
            name = NAME.match(page, start + 1 + closing)
            if name is None:
                yield "<", None, None
                at = start + 1
                continue
            end = look = name.end()
            while True:
                end = find(">", look)
                if end < 0:
                    return
                # A ">" within quotes does not end the tag.
                quotes = [(place, q) for q in "\"'" if 0 <= (place := find(q, look, end)) < unquoted[q]]
                if not quotes:
                    break
                place, quote = min(quotes)
                partner = find(quote, place + 1)
                if partner < 0:
                    unquoted[quote] = min(unquoted[quote], place)
                    look = place + 1
                else:
                    look = partner + 1
            label = name.group().lower()
            at = end + 1
            if closing:
                yield None, "/" + label, ""
                continue
            yield None, label, page[name.end() : end]
            if label in RAW_TEXT:
                stop = re.compile(f"</{re.escape(label)}(?=[\\s/>])", re.I).search(page, at)
                at = stop.start() if stop else size
        else:
            yield "<", None, None
            at = start + 1


def parse(page: str) -> Block:
    """The tree of blocks of a page, below one root without a name."""
    root = Block("", "")
    stack = [root]
    deep = 0  # blocks open below the deepest one kept
    unseen: list[str] = []  # elements without text that are open
    links = 0

    def pop_to(place: int) -> None:
        del stack[place:]

    def nearest(names, bounds) -> int:
        for place in range(len(stack) - 1, 0, -1):
            if stack[place].name in names:
                return place
            if stack[place].name in bounds:
                return 0
        return 0

    for text, name, attributes in tags(page):
        if name is None:
            if unseen:
                continue
            place = stack[-1].children
            if not place or not isinstance(place[-1], Text):
                if text.isspace():
                    continue
                place.append(Text())
            shown = html.unescape(text)
            place[-1].parts.append(shown)
            if links:
                place[-1].linked += len("".join(shown.split()))
            continue
        if unseen:
            # Raw text ends at its own end tag; others may nest.
            if name == "/" + unseen[-1]:
                unseen.pop()
            elif unseen[-1] == "head" and name in BLOCKS - UNSEEN:
                unseen.pop()  # the body has begun
            elif name == unseen[-1] and not attributes.endswith("/"):
                unseen.append(name)
                continue
            else:
                if name in RAW_TEXT:
                    unseen.append(name)
                continue
            if name[0] == "/":
                continue
        if name[0] == "/":
            label = name[1:]
            if label == "a":
                links = max(0, links - 1)
            elif label in BLOCKS and label not in ("body", "html"):
                if deep and label not in ("article", "main"):
                    deep -= 1
                    continue
                if place := nearest({label}, {"table"} - {label} if label in TABLE else SCOPES - {label}):
                    pop_to(place)
                    deep = 0
                    links = 0
            elif stack[-1].children and isinstance(stack[-1].children[-1], Text) and label == "br":
                stack[-1].children[-1].parts.append(" ")
            continue
        if name in UNSEEN:
            if name in VOID or (attributes.endswith("/") and name in ("svg", "math")):
                continue
            unseen.append(name)
            continue
        if name == "a":
            links = 1
            continue
        if name not in BLOCKS:
            if name in VOID and stack[-1].children and isinstance(stack[-1].children[-1], Text):
                stack[-1].children[-1].parts.append(" " if name == "br" else "")
            continue
        if name in ENDS_PARAGRAPH and (place := nearest({"p"}, SCOPES | {"li", "dd", "dt", "button"})):
            pop_to(place)
            deep = 0
        if name in ENDS:
            ended, bounds = ENDS[name]
            while place := nearest(ended, bounds):
                pop_to(place)
                deep = 0
        links = 0
        if len(stack) > DEEPEST:
            deep += name not in VOID
            stack[-1].children.append(Text())  # a new line begins
            continue
        block = Block(name, sign_of(name, attributes))
        stack[-1].children.append(block)
        if name not in VOID:
            stack.append(block)
    return root
