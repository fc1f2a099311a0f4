"""Small document trees of pages, their alignment, and the template of a host."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Set
from dataclasses import dataclass, field
from hashlib import blake2b
from zlib import crc32

# Names of the markup language.
_RAW = "script|style|iframe|textarea|title"
# Without text of the page if they end; one that never ends is left out alone.
_MEDIA = frozenset("template svg noscript object canvas select audio video".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCKS = frozenset(
    "html head body main article section div nav aside header footer form fieldset ul ol li dl dt dd table thead"
    " tbody tfoot tr td th caption p h1 h2 h3 h4 h5 h6 blockquote pre figure figcaption address details summary"
    " dialog menu center hgroup button label".split()
)
# A start of the first ends an open one of the second, as far up as the third.
_ENDS_P = _BLOCKS - frozenset("html head body button label caption thead tbody tfoot tr td th".split())
_SCOPES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "body": ({"head"}, set()),
}
# What is never part of an article, by name, by role, or by a word of class or id.
_OTHER_TAGS = frozenset("head nav aside footer form button menu dialog fieldset label".split())
_OTHER_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar form".split())
_OTHER_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner"
    " nav navbar navigation menu breadcrumb breadcrumbs sidebar aside widget footer masthead topbar toolbar"
    " cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup"
    " login share sharing social related recommended recommendations comment comments commentlist reply replies"
    " respond disqus discussion feedback pager pagination skip search copyright disclaimer".split()
)
# First words of names that tell of a layout or a topic, such as ``with-sidebar``.
_ABOUT = frozenset("has with no without tag category".split())
# Tags that no name rules out, and words that rule out whatever they name.
_NEVER_OTHER = frozenset("html body main".split())
_REMARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored comment comments commentlist"
    " reply replies respond disqus feedback cookie cookies consent gdpr notice notices".split()
)
# Words that may as well be what a section of an article is about, and what such a section is made of.
_TOPICS = frozenset("related discussion social search".split())
_PROSE = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure".split())
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{_RAW})\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|</?[a-zA-Z][^>]*+>"
    r"|<[!?][^>]*+>",
    re.S | re.I,
)
_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in _MEDIA}
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


@dataclass(eq=False)
class Node:
    """A block of a page: its label, its texts and children in order."""

    label: str
    other: bool = False
    parts: list = field(default_factory=list)  # Node or (text, characters of links)
    below: int = 0

    @property
    def children(self) -> list[Node]:
        return [p for p in self.parts if isinstance(p, Node)]


def _names(rest: str, whole: bool) -> tuple[str, bool, set[str]]:
    """The words of class and id that name a node, whether its role rules it out, and the words that may.

    Only names that are such a word as a ``whole`` may, or any name that has one.
    """
    words, ruled_out, doubts = [], False, set()
    for name, a, b, c in _ATTRIBUTE.findall(rest):
        value = a or b or c
        if name.lower() == "role":
            ruled_out |= value.strip().lower() in _OTHER_ROLES
        elif name.lower() == "hidden":
            ruled_out |= not value or value.lower() == "hidden"
        else:
            for token in value.split():
                parts = _WORD.findall(_CAMEL.sub(" ", token).lower())
                words += parts
                if parts and parts[0] not in _ABOUT and (len(parts) == 1 or not whole):
                    doubts |= _OTHER_WORDS.intersection(parts)
    return ".".join(words), ruled_out, doubts


def parse(page: str) -> Node:
    """The tree of a page, however deep. Tags that do not end are ended as browsers do; comments and scripts are left out."""
    root = Node("#")
    stack, tags = [root], ["#"]
    open_tags: Counter[str] = Counter()
    text: list[str] = []
    linked, in_link = 0, 0
    skipped, depth_skipped = "", 0  # formatting that is ruled out, without ending its block
    doubtful: list[tuple[Node, set[str], bool]] = []  # ruled out by name, and whether within an article
    endless: set[str] = set()
    at = 0

    def flush() -> None:
        nonlocal linked
        if text:
            joined = " ".join(html.unescape("".join(text)).split())
            if joined:
                stack[-1].parts.append((joined, min(linked, len(joined))))
            text.clear()
        linked = 0

    def close(depth: int) -> None:
        flush()
        open_tags.subtract(tags[depth:])
        del stack[depth:], tags[depth:]

    def innermost(tag: str) -> int:
        depth = len(tags) - 1
        while tags[depth] != tag:
            depth -= 1
        return depth

    while m := _TOKEN.search(page, at):
        if m.start() > at:
            if not skipped:
                piece = page[at : m.start()]
                text.append(piece)
                if in_link:
                    linked += len(piece.strip())
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in _BLOCKS:
            skipped = ""
        elif skipped:
            if tag == skipped:
                depth_skipped += -1 if m["end"] else 1
                if not depth_skipped:
                    skipped = ""
            continue
        if m["end"]:
            if tag == "a":
                in_link = 0
            elif open_tags[tag]:
                close(innermost(tag))
            elif tag in ("p", "br"):
                text.append(" ")
            continue
        if tag == "a":
            in_link = 1
        rest = m["rest"]
        if tag in _MEDIA:
            if tag not in endless and not rest.endswith("/"):
                end = _END[tag].search(page, at)
                if end:
                    at = end.end()
                else:
                    endless.add(tag)
            continue
        names, ruled_out, doubts = _names(rest, tag == "article") if rest and not rest.isspace() else ("", False, set())
        if tag in _VOID:
            text.append("\n" if tag in ("br", "hr") else "")
            if tag == "hr":
                flush()
            continue
        if tag not in _BLOCKS:
            if ruled_out or doubts:
                skipped, depth_skipped = tag, 1
            continue
        flush()
        if tag in _ENDS_P and open_tags["p"]:
            close(innermost("p"))
        ends, scope = _SCOPES.get(tag, (set(), set()))
        if any(open_tags[t] for t in ends):
            for depth in range(len(tags) - 1, 0, -1):
                if tags[depth] in ends:
                    close(depth)
                    break
                if tags[depth] in scope:
                    break
        in_link = 0
        node = Node(f"{tag}:{names}" if names else tag, ruled_out or tag in _OTHER_TAGS)
        if doubts and not node.other and tag not in _NEVER_OTHER:
            node.other = True
            doubtful.append((node, doubts, bool(open_tags["article"] or open_tags["main"])))
        stack[-1].parts.append(node)
        stack.append(node)
        tags.append(tag)
        open_tags[tag] += 1
    if at < len(page) and not skipped:
        text.append(page[at:])
    flush()
    if doubtful:
        _spare(root, doubtful)
    return root


def _spare(root: Node, doubtful: list[tuple[Node, set[str], bool]]) -> None:
    """Take back what a name rules out where the content tells otherwise.

    A box around the article is no sidebar, whatever its name: it has a heading of the
    first level, an article or a main element, and most of the page's text that is not
    linked. A section within an article that is headed, made of plain prose and hardly
    linked may be about what its name says. Adverts, comments and notices stay out.
    """
    size: dict[int, int] = {}
    linked: dict[int, int] = {}
    article: set[int] = set()
    for n in reversed(_preorder(root)):
        own = [p for p in n.parts if not isinstance(p, Node)]
        size[id(n)] = sum(len(t) for t, _ in own) + sum(size[id(c)] for c in n.children)
        linked[id(n)] = sum(links for _, links in own) + sum(linked[id(c)] for c in n.children)
        if any(id(c) in article or _tag(c.label) in ("h1", "article", "main") for c in n.children):
            article.add(id(n))
    total = size[id(root)] - linked[id(root)]
    for node, doubts, within in doubtful:
        if doubts <= _TOPICS and within and 3 * linked[id(node)] <= size[id(node)]:
            tags = {_tag(c.label) for c in node.children}
            node.other = not (tags <= _PROSE and any(re.fullmatch("h[1-6]", t) for t in tags))
        elif doubts.isdisjoint(_REMARKS) and id(node) in article:
            node.other = 2 * (size[id(node)] - linked[id(node)]) <= total


@dataclass(eq=False)
class Slot:
    """A node of a template, or of one page on its way into one.

    ``pages`` have it; ``values`` are checksums of its own texts, up to ``MANY``;
    ``size`` and ``linked`` count the characters of these texts.
    """

    label: str
    other: bool
    pages: int = 1
    values: set = field(default_factory=set)
    size: int = 0
    linked: int = 0
    children: list = field(default_factory=list)
    repeats: bool = False


MANY = 8


def _preorder(top):
    """A node or slot and all below it, each before its children; pages may be nested deeper than calls may."""
    out, todo = [], [top]
    while todo:
        out.append(todo.pop())
        todo += reversed(out[-1].children)
    return out


def slots(node: Node) -> Slot:
    """A page's tree with neighbours of one shape put together, as runs of paragraphs or rows are."""
    built: dict[int, Slot] = {}
    for n in reversed(_preorder(node)):
        out = built[id(n)] = Slot(n.label, n.other)
        own = []
        for part in n.parts:
            if not isinstance(part, Node):
                own.append(part[0])
                out.size += len(part[0])
                out.linked += part[1]
                continue
            child = built.pop(id(part))
            last = out.children[-1] if out.children else None
            if last is not None and last.label == child.label:
                merge(last, child)
                last.pages, last.repeats = 1, True
            else:
                out.children.append(child)
        if own:
            out.values.add(crc32("\n".join(own).encode()))
    return built[id(node)]


def _weight(a: Slot, b: Slot, memo: dict) -> int:
    """Simple tree matching: the size of the largest matching that keeps labels, parents and order."""
    if a.label != b.label:
        return 0
    todo = [(a, b)]
    while todo:
        top, other = todo[-1]
        pairs = [(x, y) for x in top.children for y in other.children if x.label == y.label]
        missing = [(x, y) for x, y in pairs if (id(x), id(y)) not in memo]
        if missing:
            todo += missing
            continue
        todo.pop()
        row = [0] * (len(other.children) + 1)
        for x in top.children:
            before, row = row, [0]
            for j, y in enumerate(other.children):
                best = before[j + 1] if before[j + 1] > row[j] else row[j]
                if x.label == y.label:
                    best = max(best, before[j] + memo[id(x), id(y)])
                row.append(best)
        memo[id(top), id(other)] = row[-1] + 1
    return memo[id(a), id(b)]


def align(a: Slot, b: Slot, memo: dict | None = None) -> list[tuple[Slot | None, Slot | None]]:
    """Children of ``a`` and ``b`` in common order, matched where the largest matching matches them."""
    memo = {} if memo is None else memo
    m, n = len(a.children), len(b.children)
    if [x.label for x in a.children] == [y.label for y in b.children]:
        return list(zip(a.children, b.children, strict=True))
    best = [[0] * (n + 1) for _ in range(m + 1)]
    for i in range(m - 1, -1, -1):
        for j in range(n - 1, -1, -1):
            w = _weight(a.children[i], b.children[j], memo)
            best[i][j] = max(best[i + 1][j], best[i][j + 1], best[i + 1][j + 1] + w if w else 0)
    out, i, j = [], 0, 0
    while i < m and j < n:
        w = _weight(a.children[i], b.children[j], memo)
        if w and best[i][j] == best[i + 1][j + 1] + w:
            out.append((a.children[i], b.children[j]))
            i, j = i + 1, j + 1
        elif best[i][j] == best[i + 1][j]:
            out.append((a.children[i], None))
            i += 1
        else:
            out.append((None, b.children[j]))
            j += 1
    return out + [(x, None) for x in a.children[i:]] + [(None, y) for y in b.children[j:]]


def merge(into: Slot, other: Slot) -> None:
    """Add a page or a template to a template with the same root label."""
    memo: dict = {}
    todo = [(into, other)]
    while todo:
        a, b = todo.pop()
        a.pages += b.pages
        a.size += b.size
        a.linked += b.linked
        a.repeats |= b.repeats
        if len(a.values) < MANY:
            a.values = set(sorted(a.values | b.values)[:MANY])
        pairs = align(a, b, memo)
        todo += [(mine, theirs) for mine, theirs in pairs if mine is not None and theirs is not None]
        a.children = [mine if mine is not None else theirs for mine, theirs in pairs]


def dump(slot: Slot) -> list:
    """The slots in preorder, each with the number of its children."""
    return [
        [s.label, int(s.other), s.pages, sorted(s.values), s.size, s.linked, int(s.repeats), len(s.children)]
        for s in _preorder(slot)
    ]


def load(data: list) -> Slot:
    done: list[Slot] = []
    for label, other, pages, values, size, linked, repeats, n in reversed(data):
        children = [done.pop() for _ in range(n)]
        done.append(Slot(label, bool(other), pages, set(values), size, linked, children, bool(repeats)))
    return done[0]


RARE = ":*"


def _tag(label: str) -> str:
    return label.partition(":")[0]


def _is_rare(slot: Slot, least: float) -> bool:
    return slot.pages < least or slot.label.endswith((RARE, RARE + "other"))


def fold(slot: Slot, least: float) -> None:
    """Put siblings of one tag that few pages have into one, with their pages, texts and children.

    So a template stays small however many pages it is of, and nothing leaves its sums:
    blocks named anew by every page count together. What is ruled out by its name is
    folded apart.
    """
    todo = [slot]
    while todo:
        top = todo.pop()
        kept: list[Slot] = []
        rare: dict[str, Slot] = {}
        for c in top.children:
            if not _is_rare(c, least):
                kept.append(c)
                continue
            c.label = _tag(c.label) + RARE + ("other" if c.other else "")
            if c.label in rare:
                merge(rare[c.label], c)
            else:
                rare[c.label] = c
                kept.append(c)
        top.children = kept
        todo += kept


# A template of so many pages tells what is constant; a text that so few values stand
# for is part of it.
ENOUGH = 5


def _is_template(slot: Slot, pages: int) -> bool:
    """Ruled out by its name, mostly links, or the same on the pages of the host."""
    if slot.other:
        return True
    if slot.size and slot.linked > 0.6 * slot.size and not slot.children:
        return True
    return pages >= ENOUGH and slot.pages >= 0.5 * pages and slot.size > 0 and len(slot.values) == 1 and not slot.repeats


def _contents(template: Slot) -> dict[int, int]:
    """Per slot, by its id, the characters in slots that vary, below and in it."""
    out: dict[int, int] = {}
    for s in reversed(_preorder(template)):
        below = sum(out[id(c)] for c in s.children)
        out[id(s)] = 0 if _is_template(s, template.pages) else s.size - s.linked + below
    return out


def main_path(template: Slot) -> list[str | list[str]]:
    """Labels from the root to the node that holds the article.

    That is an article or main element with a good part of the varying text, else
    the deepest node that still has most of it. Siblings of one tag that less than half
    of the pages have count as one node; a list in the path stands for it: its tag, then
    the labels of the siblings of this tag that are not of it.
    """
    fold(template, template.pages / 2)
    content = _contents(template)
    path, node, total = [], template, content[id(template)]
    named = _named(template, content)
    if named:
        size, labels = max(named, key=lambda n: n[0])
        if size > 0.3 * total:
            return labels
    while True:
        best = max(node.children, key=lambda c: content[id(c)], default=None)
        inner = best is not None and not re.match(r"(p|h[1-6]|li|td|tr|blockquote|pre)\b", best.label)
        if not inner or content[id(best)] < 0.7 * total or best.repeats:
            return path
        path.append(_step(best, node))
        node = best


def _step(slot: Slot, parent: Slot) -> str | list[str]:
    if not slot.label.endswith(RARE):
        return slot.label
    tag = _tag(slot.label)
    return [tag, *[c.label for c in parent.children if c is not slot and _tag(c.label) == tag]]


def _named(template: Slot, content: dict[int, int]) -> list[tuple[int, list[str | list[str]]]]:
    out, todo, path = [], [(1, c, template) for c in reversed(template.children)], []
    while todo:
        depth, slot, parent = todo.pop()
        if slot.other:
            continue
        path[depth - 1 :] = [_step(slot, parent)]
        if re.match(r"(article|main)\b", slot.label):
            out.append((content[id(slot)], path.copy()))
        if not slot.label.startswith("article"):
            todo += [(depth + 1, c, slot) for c in reversed(slot.children)]
    return out


# What lays out a page, and what holds items that belong together.
_BOXES = frozenset("div section article main center table tbody tr td".split())
_LISTS = frozenset("ul ol dl table".split())


def _inside(place: int, label: str) -> int:
    """Where a child is: a checksum of the tags from the root to it, as names may be a page's own."""
    return crc32(f"/{_tag(label)}".encode(), place)


def _key(place: int, text: str) -> int:
    """Equal for aligned nodes of one text."""
    body = text.encode("utf-8", "surrogatepass")
    return int.from_bytes(blake2b(body, digest_size=8, key=place.to_bytes(4)).digest(), signed=True)


def _kept(node: Node, place: int) -> list[tuple[Node, int]]:
    """A node and what is below it in page order, without what is ruled out by its name."""
    out, todo = [], [(node, place, False)]
    while todo:
        top, at, within = todo.pop()
        tag = _tag(top.label)
        # The head of an article holds its title or its first paragraph; other headers hold none.
        if top is node or not top.other and (tag != "header" or _has_title(top) or within and _has_lead(top)):
            out.append((top, at))
            within |= tag == "article"
            todo += [(c, _inside(at, c.label), within) for c in reversed(top.children)]
    return out


def marks(page: Node) -> list[tuple[int, int]]:
    """``(place, text)`` of the blocks of a page, each once, and ``(place, 0)`` of their places."""
    found = set()
    for node, place in _kept(page, 0):
        for part in node.parts:
            if not isinstance(part, Node):
                found.add((place, _key(place, part[0])))
    return sorted(found | {(place, 0) for place, _ in found})


def blocks(node: Node, place: int = 0, constant: Set[int] = frozenset()) -> list[str]:
    """Texts of the blocks of a node in page order, without what is ruled out by its name or constant.

    Items of a list or table stay if it stands among varying text, as rows of an
    article do; between boxes that lay out a page it does not.
    """
    kept = _kept(node, place)
    if not constant:
        kept_ids = {id(n) for n, _ in kept}
        return _in_order(node, kept_ids, kept_ids, {})
    texts: dict[int, list[bool]] = {}  # by node, whether its texts vary
    varies: dict[int, bool] = {}
    mixed: dict[int, bool] = {}  # varying text outside of boxes
    for n, at in reversed(kept):
        own = [_key(at, p[0]) not in constant for p in n.parts if not isinstance(p, Node)]
        below = [c for c in n.children if varies.get(id(c))]
        texts[id(n)] = own
        varies[id(n)] = any(own) or bool(below)
        mixed[id(n)] = any(own) or any(_tag(c.label) not in _BOXES for c in below)
    items: set[int] = set()
    for n, _ in kept:
        for c in n.children:
            if id(n) in items or mixed[id(n)] and _tag(c.label) in _LISTS:
                items.add(id(c))
    return _in_order(node, varies.keys(), items, texts)


def _in_order(node: Node, kept: Set[int], whole: Set[int], texts: dict[int, list[bool]]) -> list[str]:
    """Texts of the nodes ``kept``: all of those that are ``whole``, of others those marked in ``texts``."""
    out, todo = [], [node]
    while todo:
        part = todo.pop()
        if not isinstance(part, Node):
            out.append(part)
        elif id(part) in kept:
            marked = iter(texts.get(id(part), ()))
            shown = [
                p if isinstance(p, Node) else p[0]
                for p in part.parts
                if isinstance(p, Node) or next(marked, False) or id(part) in whole
            ]
            todo += reversed(shown)
    return out


def _has_title(node: Node) -> bool:
    return any(re.match(r"h[1-6]\b", n.label) for n in _preorder(node)[1:])


def _has_lead(node: Node) -> bool:
    return any(_tag(n.label) == "p" and any(not isinstance(p, Node) and p[1] < len(p[0]) for p in n.parts) for n in node.children)


def _follow(node: Node, path: list[str | list[str]]) -> list[tuple[Node, int]]:
    here = [(node, 0)]
    for step in path:
        inside = [(c, _inside(at, c.label)) for n, at in here for c in n.children]
        if isinstance(step, str):
            here = [(c, at) for c, at in inside if c.label == step]
        else:
            here = [
                (c, at) for c, at in inside if _tag(c.label) == step[0] and c.label not in step[1:] and not c.other
            ]
    return here


def extract(page: Node, path: list[str | list[str]] | None, constant: Set[int] = frozenset()) -> str:
    """The article of a page, given the path and the constant texts of its host's template.

    A page that lacks the path is judged alone; one without any text of its own is whole.
    """
    found = _follow(page, path) if path else []
    if not found:
        found = _follow(page, main_path(slots(page)))
    own = [b for n, at in found for b in blocks(n, at, constant)]
    return "\n".join(own or [b for n, at in found for b in blocks(n, at)])
