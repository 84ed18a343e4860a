"""Main text of web pages by tag-path ratios.

A page is read once into blocks of text, each with the path of block elements from the root
to it. Parts that their markup declares to be something else (menus, site headers, footers,
sidebars, notices, adverts, forms, reader comments, scripts, styles) are left out. For each
path, the text length and the punctuation outside links are summed over all its blocks and
divided by their number; the two ratios are fused, smoothed over the blocks in page order, and
the paths whose mean reaches the threshold are content. The result is the text of the element
that holds the content blocks, short headings and paragraphs included.

Character references are decoded, white space inside a block becomes one space, blocks are
joined in page order by a line feed. A page is one row and is read whole; pages never meet.

Cases: null, empty or textless html gives an empty text; unclosed and misnested tags are read
as browsers do in the common cases (paragraphs, list items, cells); repeated rows get a row
each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names by role, and words that name such parts in class, id or role.
RAW = "script style noscript template iframe textarea title xmp svg annotation annotation-xml object canvas audio video".split()
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong "
    "sub sup time tt u var wbr img br input meta link area base col embed hr param source track nobr center "
    "math mi mo mn ms mtext mspace mrow mfrac msup msub msubsup msqrt mroot mover munder munderover mstyle mpadded mphantom mfenced "
    "mtable mtr mtd semantics".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("nav footer aside button select menu head datalist".split())
AROUND = frozenset("form fieldset dialog".split())  # some pages have all of their text inside one
UNCLOSED = ("nav", "header", "aside", "menu", "footer")  # an article or main ends them if nothing else does
PARAGRAPH_SCOPE = ("td", "th", "button", "caption", "object")
CLOSES_PARAGRAPH = frozenset(
    "address article aside blockquote details dialog dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup "
    "li main menu nav ol p pre section table ul".split()
)
ITEM_SCOPES = {
    "li": ("li", {"ul", "ol", "menu"}), "dt": ("dt dd", {"dl"}), "dd": ("dt dd", {"dl"}), "tr": ("tr td th", {"table"}),
    "td": ("td th", {"tr", "table"}), "th": ("td th", {"tr", "table"}), "option": ("option", {"select"}),
}
NAMED = frozenset(
    "nav navbar navigation menu menubar masthead footer sidebar aside widget widgets notice notices cookie cookies consent gdpr banner "
    "alert ad ads adbox adslot advert adverts advertisement advertising sponsor sponsored promo promotion comment comments reply replies "
    "respond disqus share sharing social subscribe newsletter breadcrumb breadcrumbs pagination pager popup modal related recommended "
    "contentinfo complementary search searchbox login signup disclaimer".split()
)
HEADER_NAMES = frozenset("header topbar branding".split())
ABOUT_ANOTHER = frozenset("with has no not without is".split())  # "with-sidebar" tells what is beside the element
PLACES = frozenset("left right top bottom main primary secondary wrapper wrap container area box bar block section inner outer list slot".split())
TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^<>]*+>"
    r"|<(?P<raw>" + "|".join(RAW) + r")(?=[\s/>])(?P<rawattrs>(?:\"[^\"]*\"|'[^']*'|[^'\"<>]++)*+)>(?:.*?)(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][\w:-]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^'\"<>]++)*+)>",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?(?=\s|/|$)""", re.I)
WORDS = re.compile(r"[a-z]+")
MARKS = re.compile(r"[.,;:!?…。，；：！？¡¿]")


@dataclass
class Element:
    name: str
    parent: Element | None
    drop: bool
    path: int  # number of the names from the root to it
    depth: int
    named: bool = False  # class, id or role say that it is no main text
    place: int = 0  # in page order; those below an element follow it,
    last: int = 0  # up to this one


@dataclass
class Block:
    owner: Element
    parts: list[str] = field(default_factory=list)
    linked: int = 0  # characters inside links


def head_word(token: str) -> str:
    """What a class, id or role calls its element: the last word, places aside; nothing where it tells of another element."""
    words = WORDS.findall(token)
    if not words or words[0] in ABOUT_ANOTHER:
        return ""
    while len(words) > 1 and words[-1] in PLACES:
        words.pop()
    return words[-1]


def declared_away(name: str, attributes: str, article: bool) -> tuple[bool, bool]:
    """Whether the markup hides a part or its element is no main text, and whether a class, id or role says so."""
    if name in DROPPED or name == "header" and not article:
        return True, False
    named = name in AROUND
    for key, value in ATTRIBUTE.findall(attributes or ""):
        key, value = key.lower(), value.strip("\"'").lower()
        if key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and "display:none" in value.replace(" ", "")):
            return True, False
        if key in ("class", "id", "role"):
            words = [head_word(token) for token in value.split()]
            named = named or any(w in NAMED or (not article and w in HEADER_NAMES) for w in words)
    return False, named and name not in ("body", "html", "article", "main")


def read_blocks(page: str) -> tuple[list[Block], list[Element]]:
    """Blocks with text in page order, and all elements in page order, the root first."""
    root = Element("", None, False, 0, 0)
    stack, elements, hidden, links, blocks = [root], [root], [], 0, []
    block = Block(root)
    paths: dict[tuple[int, str], int] = {}
    opened: dict[str, list[int]] = {}  # places in the stack of the open elements of a name
    last_close: dict[str, int] = {}

    def flush() -> None:
        nonlocal block, links
        if block.parts:
            blocks.append(block)
        block, links = Block(stack[-1]), 0
        hidden.clear()

    def add(text: str) -> None:
        if text and not stack[-1].drop and not hidden:
            block.parts.append(text)
            if links:
                block.linked += len(text)

    def pop_to(position: int) -> None:
        flush()
        for element in stack[position:]:
            opened[element.name].pop()
        del stack[position:]
        block.owner = stack[-1]

    def nearest(names) -> int:
        return max((opened[n][-1] for n in names if opened.get(n)), default=0)

    def close_nearest(own, scope) -> None:
        """End the nearest of ``own``, unless one of ``scope`` lies between."""
        position = nearest(own)
        if position > nearest(scope):
            pop_to(position)

    def unclosed(name: str, at: int) -> bool:
        if name not in last_close:
            found = list(re.finditer(f"</{name}\\b", page, re.I))
            last_close[name] = found[-1].start() if found else -1
        return last_close[name] < at

    at = 0
    for tag in TAG.finditer(page):
        if tag.start() > at:
            add(references.unescape(page[at : tag.start()]))
        at = tag.end()
        if tag["cdata"]:
            add(tag["cdata"])
        name = tag["name"]
        if name is None:
            continue
        name, closing = name.lower(), bool(tag["close"])
        if name in INLINE:
            if name == "a":
                links = 0 if closing else 1
            elif name in ("br", "hr"):
                add(" ")
            if name not in VOID:
                if closing:
                    if hidden and hidden[-1] == name:
                        hidden.pop()
                elif hidden and hidden[-1] == name or tag["attrs"] and any(declared_away(name, tag["attrs"], True)):
                    hidden.append(name)
            continue
        if closing:
            if opened.get(name):
                pop_to(opened[name][-1])
            continue
        if name in CLOSES_PARAGRAPH:
            close_nearest(("p",), PARAGRAPH_SCOPE)
        if name in ITEM_SCOPES:
            own, scope = ITEM_SCOPES[name]
            close_nearest(own.split(), scope)
        if name in ("article", "main"):
            for outer in UNCLOSED:
                if opened.get(outer) and not nearest(("article", "main")) and unclosed(outer, at):
                    pop_to(opened[outer][0])
        flush()
        top = stack[-1]
        article = bool(opened.get("article") or opened.get("main"))
        away, named = declared_away(name, tag["attrs"], article)
        path = paths.setdefault((top.path, name), len(paths) + 1)
        element = Element(name, top, top.drop or away, path, top.depth + 1, named, len(elements))
        elements.append(element)
        if not tag["attrs"].endswith("/"):
            opened.setdefault(name, []).append(len(stack))
            stack.append(element)
        block.owner = stack[-1]
    if at < len(page):
        add(references.unescape(page[at:]))
    flush()
    for element in reversed(elements):
        element.last = max(element.last, element.place)
        if element.parent is not None:
            element.parent.last = max(element.parent.last, element.last)
    return blocks, elements


def sums_below(elements: list[Element], amounts) -> list[int]:
    """For every element the sum of (owner, amount) over the elements below it, itself included."""
    total = [0] * len(elements)
    for owner, amount in amounts:
        total[owner.place] += amount
    for element in reversed(elements[1:]):
        total[element.parent.place] += total[element.place]
    return total


def below_any(elements: list[Element], marked) -> list[bool]:
    """For every element whether it or one above it is marked."""
    found = [False] * len(elements)
    for element in elements:
        found[element.place] = marked(element) or element.parent is not None and found[element.parent.place]
    return found


def without_named(found: list[tuple[Block, str]], elements: list[Element]) -> tuple[list[tuple[Block, str]], list[Element]]:
    """Blocks outside named elements, and the articles and mains there.

    A named element with most of the text outside links is kept, unless an article or main lies elsewhere.
    """
    bodies = [e for e in elements if e.name in ("article", "main") and not e.drop]
    if any(e.named for e in elements):
        own = sums_below(elements, [(b.owner, max(0, len(t) - b.linked)) for b, t in found])
        held = sums_below(elements, [(b.owner, 1) for b, _ in found])
        away = below_any(elements, lambda e: e.named)
        apart = [e for e in bodies if not away[e.place] and held[e.place]]
        for element in elements:
            if element.named and 2 * own[element.place] > own[0] and all(inside(e, element) or inside(element, e) for e in apart):
                element.named = False
        out = below_any(elements, lambda e: e.named and held[e.place] > 0)
        found = [(b, t) for b, t in found if not out[b.owner.place]]
        bodies = [e for e in bodies if not out[e.place]]
    return found, bodies


def chosen_paths(blocks: list[Block], texts: list[str]) -> set[int]:
    """Paths whose smoothed, fused ratio of text and punctuation reaches the threshold."""
    paths: dict[int, list[float]] = {}
    for block, text in zip(blocks, texts):
        total = paths.setdefault(block.owner.path, [0.0, 0.0, 0.0])
        own = max(0, len(text) - block.linked)
        total[0] += own
        total[1] += len(MARKS.findall(text)) * own / max(1, len(text))
        total[2] += 1
    fused = {p: (length / n) * (1.0 + marks / n) for p, (length, marks, n) in paths.items()}
    values = np.array([fused[b.owner.path] for b in blocks])
    padded = np.concatenate((values[:1], values, values[-1:]))
    smooth = (padded[:-2] + 2 * padded[1:-1] + padded[2:]) / 4
    mean: dict[int, list[float]] = {}
    for block, value in zip(blocks, smooth):
        mean.setdefault(block.owner.path, []).append(value)
    limit = min(float(smooth.std()), float(smooth.max()))
    return {p for p, v in mean.items() if sum(v) / len(v) >= limit}


def inside(element: Element, holder: Element) -> bool:
    return holder.place <= element.place <= holder.last


def main_text(page: str | None) -> str:
    if not page:
        return ""
    blocks, elements = read_blocks(page)
    texts = [" ".join("".join(b.parts).split()) for b in blocks]
    found, bodies = without_named([(b, t) for b, t in zip(blocks, texts) if t], elements)
    if not found:
        return ""
    paths = chosen_paths([b for b, _ in found], [t for _, t in found])
    content = [(b, t) for b, t in found if b.owner.path in paths]
    weights = sums_below(elements, [(b.owner, len(t)) for b, t in content])
    outer: list[Element] = []
    for e in bodies:  # in page order, so an outer one comes first
        if not outer or not inside(e, outer[-1]):
            outer.append(e)
    holders = [e for e in outer if weights[e.place]]
    if holders and 2 * sum(weights[e.place] for e in holders) >= weights[0]:
        held = below_any(elements, lambda e, ids=frozenset(map(id, holders)): id(e) in ids)
        return "\n".join(t for b, t in found if held[b.owner.place])
    # No article says where the text is: the deepest element around blocks that holds nine tenths of the content.
    around = {id(b.owner.parent or b.owner) for b, _ in content}
    reached = [False] * len(elements)
    for element in reversed(elements):
        reached[element.place] |= id(element) in around
        if element.parent is not None:
            reached[element.parent.place] |= reached[element.place]
    inner = sums_below(elements, [(b.owner.parent or b.owner, len(t)) for b, t in content])
    holder = max((e for e in elements if reached[e.place] and 10 * inner[e.place] >= 9 * weights[0]), key=lambda e: e.depth)
    return "\n".join(t for b, t in found if b.owner.path in paths or 2 * b.linked < len(t) and inside(b.owner, holder))


def extract(df: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns ``keep``, text and n_chars (code points) of every row."""
    source = df.select(*keep, F.col(html).alias("__html"))
    n = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py()) for page in batch.column(n)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:n], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*keep, "text", "n_chars"]
            )

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:n])
    return source.mapInArrow(run, f"{kept}, text string, n_chars bigint")
