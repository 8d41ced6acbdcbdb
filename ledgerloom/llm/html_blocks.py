"""Leaf blocks of a web page: texts between block-level tags, with what surrounds them."""

import html
import re
from dataclasses import dataclass, field

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)"
    r"(?P<rest>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*+>|[^>]*(?:>|\Z))",
    re.S,
)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")
NAMES = re.compile(r"[a-z]+")
# Fixed lists of HTML's own element kinds.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small "
    "span strike strong sub sup time tt u var wbr br img".split()
)
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
UNREAD = frozenset("script style title textarea template noscript iframe select svg".split())
# A start tag that ends the nearest open element of its group.
ENDS = {
    "p": {"p"},
    "li": {"li", "p"},
    "dt": {"dt", "dd", "p"},
    "dd": {"dt", "dd", "p"},
    "tr": {"tr", "td", "th", "p"},
    "td": {"td", "th", "p"},
    "th": {"td", "th", "p"},
    "option": {"option"},
}
BLOCKS_ENDING_P = frozenset(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr "
    "main nav ol pre section table ul".split()
)
SCOPES = frozenset("table ul ol dl div section article main body td".split())


@dataclass
class Block:
    text: str
    path: tuple  # of (tag, names in class, id and role) from the outside in
    link_chars: int
    chars: int
    inner: set = field(default_factory=set)


def names_of(rest: str) -> str:
    """Words in an element's class, id and role, and whether it is hidden."""
    if "=" not in rest and "hidden" not in rest:
        return ""
    found = []
    for name, a, b, c in ATTRIBUTE.findall(rest):
        name, value = name.lower(), a or b or c
        if name in ("class", "id", "role"):
            found += NAMES.findall(value.lower())
        elif name == "hidden" or (name == "style" and "none" in value and "display" in value):
            found.append("hidden")
    return " ".join(dict.fromkeys(found))


def blocks(page: str) -> list[Block]:
    """The leaf blocks with any text, in page order."""
    out, stack, parts, inner = [], [], [], set()
    links = link_chars = 0

    def flush():
        nonlocal parts, link_chars, inner
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append(Block(text, tuple(stack), link_chars, len(text), inner))
            parts, link_chars, inner = [], 0, set()

    def pop_to(tags, stops=frozenset()):
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in tags:
                del stack[i:]
                return
            if stack[i][0] in stops:
                return

    at, size = 0, len(page)
    while at < size:
        m = TOKEN.search(page, at)
        text = page[at : m.start() if m else size]
        if text:
            parts.append(text)
            if links:
                link_chars += len(text)
        if not m:
            break
        at = m.end()
        tag = m.group("tag")
        if tag is None:
            if m.group().startswith("<![CDATA["):
                parts.append(html.escape(m.group()[9:].removesuffix("]]>")))
            continue
        tag = tag.lower()
        if m.group("end"):
            if tag == "a":
                links = max(0, links - 1)
            if tag not in INLINE:
                flush()
                pop_to({tag})
            continue
        if tag in UNREAD:
            if not m.group().endswith("/>"):
                close = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                at = close.end() if close else size
            continue
        if tag == "br":
            parts.append(" ")
        elif tag in INLINE:
            inner.add(tag)
            links += tag == "a"
            continue
        else:
            flush()
            links = 0
            if tag in ENDS:
                pop_to(ENDS[tag], SCOPES - ENDS[tag])
            elif tag in BLOCKS_ENDING_P:
                pop_to({"p"}, SCOPES)
            if tag not in VOID and not m.group().endswith("/>"):
                stack.append((tag, names_of(m.group("rest"))))
    flush()
    return out


def path_features(path) -> list[str]:
    """Features of a block's ancestors."""
    found = [f"parent={path[-1][0]}" if path else "parent="]
    found += [f"in={tag}" for tag, _ in path]
    for _, names in path:
        found += [f"name={n}" for n in names.split()]
    return list(dict.fromkeys(found))


def text_features(block: Block, first: bool, last: bool) -> list[str]:
    text = block.text
    words = text.count(" ") + 1
    stops = sum(text.count(c) for c in ".!?") + text.count(",")
    share = block.link_chars / max(block.chars, 1)
    found = [
        f"words={next((n for n in (2, 5, 10, 20, 40, 80) if words <= n), 'more')}",
        f"links={'none' if share == 0 else 'some' if share < 0.3 else 'many' if share < 0.8 else 'all'}",
        f"stops={min(stops, 4)}",
        "ends=stop" if text[-1] in ".!?:\"'" else "ends=other",
    ]
    if first:
        found.append("first")
    if last:
        found.append("last")
    if "©" in text or "·" in text or "|" in text:
        found.append("mark")
    return found
