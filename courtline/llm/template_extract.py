"""Main text of web pages by content elements, layouts and marks, with equivalence classes of the host's template.

Pages of one host (in chunks of bounded size) are read together. A page becomes a sequence of tokens, tags with
their path of ancestors and text runs; tokens that share an occurrence vector, the counts in each page, form a
class. A class is valid if it spans enough pages and its tokens come in the same order in each of them. Valid
classes nest: a class whose tokens all lie between two tokens of another is its child. Classes and nesting describe
the host's template, and what lies between two neighbouring tokens of a class is a slot of it.

The main text is that of the content region, an article or main element of the page or, without one, the container that
holds the varying text of the page's layout, or else the whole page. Of its slots those with child classes or running
text are content; a slot that is one line of the template's own words around short values, as a user box or a line with
the date and the weather, is a field and left out, whatever its names. Names only say what can't be a field: headings
and unmarked paragraphs, list items and cells. Regions whose element, role or class marks them as navigation, header,
footer, sidebar, notice, advert, form or comments are left out too, and so is constant text of the template, within a
content element only at its two ends.
"""

from __future__ import annotations

import html
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import ship, staged

CHUNK_BYTES = 8_000_000    # html of a host that is read together
HEAVY = 100_000            # hosts with this fraction of the bytes or more are cut into chunks; there can't be more of them
CONSTANT_PAGES = 4         # different pages that have to hold a text run for it to be template
CONSTANT_SHARE = 0.8       # of the chunk's different pages
NEAR_PERCENT = 85          # different words that near copies of a page share, of those of both; copies tell nothing about constant text
REGION_SHARE = 0.9         # of a layout's text that its content region holds
FIELD_WORDS = 2            # the template's own words that a line has to have at least to be a field
FIELD_SHARE = 0.5          # of the line's words

# Element names of HTML by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math".split())
DROPPED = frozenset("head script style textarea title noscript template iframe svg math object canvas nav header footer aside form button select "
                    "dialog menu".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike "
                   "strong sub sup time tt u var wbr".split())
CLOSES = {  # an opening tag that ends an open element of the given names
    "p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "thead": {"tbody", "tr", "td", "th"}, "tbody": {"thead", "tbody", "tr", "td", "th"},
}
ENDS_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav "
                   "ol p pre section table ul".split())
SCOPES = frozenset("html body table td th article section main aside nav header footer div ul ol dl form".split())
# A class or id marks boilerplate if it is made of role words and words of place and form only: "main-nav", "share-bar",
# not "has-sidebar" or "entry-header".
MARKS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo banner cookie cookies consent gdpr notice popup modal sidebar "
                  "sidenav nav navbar navigation menu breadcrumb breadcrumbs header masthead footer comment comments disqus share sharing social related "
                  "recommended newsletter subscribe signup login search widget skip pagination pager".split())
PLACES = frozenset("bar box block area section wrap wrapper container inner outer list links link item items top bottom left right site main primary "
                   "secondary global sticky fixed mobile desktop row col column unit slot zone group button buttons icon icons form field input toggle "
                   "overlay layer message panel thread media google".split())
OF_POSTS = frozenset("post posts article articles entry entries story stories page pages".split())     # not with header: it holds their title
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alertdialog alert".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
TEXTUAL = frozenset("p li dt dd td th pre blockquote caption figcaption summary".split())    # running text, unless the element has a class or id
CONTAINERS = frozenset("html body div section main article center td".split())    # and elements with a hyphen in their name

_TAG = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.DOTALL)
_ATTR = re.compile(r"""([^\s"'>/=]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none", re.IGNORECASE)
_SPACE = re.compile(r"\s+")


class Node:
    """An element; ``key`` is its path of names, with the class or id of each, ``own`` why it is dropped by itself,
    ``content`` whether it is an article or main element."""
    __slots__ = ("name", "key", "own", "dropped", "content", "parent")

    def __init__(self, name: str, key: str, own: str, content: str, parent: "Node | None"):
        self.name, self.key, self.own, self.content, self.parent = name, key, own, content, parent
        self.dropped = bool(own) or (parent is not None and parent.dropped)


@lru_cache(100_000)
def _marked(mark: str, in_article: bool) -> str:
    """What the classes and the id of an element mark it as: "comment", another "mark" or nothing."""
    for token in mark.replace("side-bar", "sidebar").split():
        parts = [p for p in re.split(r"[-_]+", token) if p]
        roles = MARKS.intersection(parts)
        if in_article or OF_POSTS.intersection(parts):
            roles -= {"header", "masthead"}
        if roles and all(p in roles or p in PLACES or p in OF_POSTS or re.fullmatch(r"\d+(?:x\d+)?", p) for p in parts):
            return "comment" if roles & {"comment", "comments", "disqus"} else "mark"
    return ""


def _node(name: str, attributes: str, parent: Node | None) -> Node:
    found = {k.lower(): a or b or c for k, a, b, c in _ATTR.findall(attributes)} if "=" in attributes else {}
    mark = f"{found.get('class', '')} {found.get('id', '')}".strip().lower()
    role = found.get("role", "").lower()
    content = next((c for c in ("main", "article") if c in (name, role)), "")
    in_article, own = (mark or name == "header") and _inside(parent, "article"), ""
    title = name == "header" and in_article             # a header inside an article holds its title, whatever its class
    if name in DROPPED and not title:
        own = "name"
    elif role in ROLES or bool(attributes and _HIDDEN.search(attributes)) or found.get("aria-hidden") == "true":
        own = "attribute"
    elif mark and not title and name not in ("html", "body", "article", "main"):
        own = _marked(mark, in_article)
    if content and parent is not None and parent.key.rsplit("/", 1)[-1].startswith("comment"):
        own = "comment"
    key = f"{parent.key if parent else ''}/{name}{'.' + mark if mark else ''}"
    return Node(name, key, own, content, parent)


def _inside(node: Node | None, name: str) -> bool:
    while node is not None:
        if name in (node.name, node.content):
            return True
        node = node.parent
    return False


def _settle(tokens: list[tuple[str, str, Node]]) -> list[tuple[str, str, Node]]:
    """Nothing that contains the page's content element is dropped: a main element or, without one, the article with
    more text than all that isn't dropped."""
    contents = [node for kind, _, node in tokens if kind == "open" and node.content and not node.own]
    if not any(node.dropped for node in contents):
        return tokens
    chosen = [node for node in contents if node.content == "main"]
    if any(not node.dropped for node in chosen):
        return tokens
    if not chosen:
        size, rest = Counter(), 0
        for kind, value, node in tokens:
            if kind == "text" and (n := len(value.strip())):
                rest += 0 if node.dropped else n
                while node is not None and not node.own:
                    if node.content:
                        size[id(node)] += n
                    node = node.parent
        articles = [node for node in contents if node.dropped and size[id(node)] > rest and not _of_comments(node)]
        chosen = [max(articles, key=lambda node: size[id(node)])] if articles else []
    for node in chosen:
        while node is not None:
            node.own, node = "", node.parent
    for kind, _, node in tokens:                        # parents come first
        if kind == "open":
            node.dropped = bool(node.own) or node.parent.dropped
    return tokens


def _of_comments(node: Node | None) -> bool:
    while node is not None and node.own != "comment":
        node = node.parent
    return node is not None


def parse(page: str) -> list[tuple[str, str, Node]]:
    """Tokens of a page in order: (kind, value, element); kinds: open, close, text and break (a block's border)."""
    root = Node("", "", "", "", None)
    out, stack, at = [], [root], 0

    def close(depth: int) -> None:
        while len(stack) > depth:
            out.append(("close", stack[-1].name, stack.pop()))

    end = len(page)
    while at < end:
        m = _TAG.search(page, at)
        stop = m.start() if m else end
        if stop > at:
            out.append(("text", page[at:stop], stack[-1]))
        if not m:
            break
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA["):
                out.append(("text", html.escape(m[0][9:-3]), stack[-1]))
            continue
        name = m[2].lower()
        if m[1]:
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].name == name), 0)
            if depth:
                close(depth)
            elif name not in INLINE:
                out.append(("break", name, stack[-1]))
            continue
        if name in VOID:
            out.append(("open", name, _node(name, "", stack[-1])))
            continue
        ends = CLOSES.get(name, set()) | ({"p"} if name in ENDS_P else set())
        if ends:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name in ends:
                    close(i)
                    break
                if stack[i].name in SCOPES and not (name in ("tr", "td", "th", "tbody", "thead") and stack[i].name in ("td", "th")):
                    break
        node = _node(name, m[3], stack[-1])
        out.append(("open", name, node))
        if m[3].endswith("/") and name not in INLINE:
            out.append(("close", name, node))
        elif name in RAW:                               # raw text up to its end tag
            tail = re.compile(rf"</{re.escape(name)}\s*>", re.IGNORECASE).search(page, at)
            at = tail.end() if tail else end
            out.append(("close", name, node))
        else:
            stack.append(node)
    close(1)
    return _settle(out)


def clean(text: str) -> str:
    return _SPACE.sub(" ", html.unescape(text)).strip()


def near_copies(pages: list[set[str]]) -> list[int]:
    """For each page the first one that it is a near copy of, by its different words; itself if there is none."""
    held = Counter(w for words in pages for w in words)
    index: dict[str, list[int]] = defaultdict(list)
    first = []
    for i, words in enumerate(pages):
        # near copies have one of their rarest words in common, as many as may differ and one more
        rare = sorted(words, key=lambda w: (held[w], w))[:len(words) - -(-NEAR_PERCENT * len(words) // 100) + 1]
        match = i
        for j in sorted({j for w in rare for j in index[w]}):
            both = len(words & pages[j])
            if 100 * both >= NEAR_PERCENT * (len(words) + len(pages[j]) - both):
                match = j
                break
        first.append(match)
        if match == i:
            for w in rare:
                index[w].append(i)
    return first


class Template:
    """Equivalence classes of the tokens of same-host pages."""

    def __init__(self, pages: list[list[tuple[str, str, Node]]]):
        different = {}
        for tokens in pages:                            # copies of a page tell nothing about the template
            different.setdefault(tuple((k, v) for k, v, _ in tokens if k != "text" or v.strip()), tokens)
        self.pages = list(different.values())
        vectors: dict[tuple[str, str], dict[int, int]] = defaultdict(dict)
        for i, tokens in enumerate(self.pages):
            for token, n in Counter(map(self.token, tokens)).items():
                if token[1]:
                    vectors[token][i] = n
        groups: dict[tuple, list[tuple[str, str]]] = defaultdict(list)
        least = max(2, len(self.pages) / 2)
        for token, vector in vectors.items():
            if len(vector) >= least:
                groups[tuple(vector.items())].append(token)
        self.classes = [tokens for vector, tokens in groups.items() if len(tokens) > 1 and self.ordered(set(tokens), dict(vector))]
        self.tokens = {t for c in self.classes for t in c}
        self.filled: set[tuple[int, tuple[str, str]]] = set()      # a class and the token of it after which children lie
        self.parents = self.nest()
        # constant text of the template; one class with the tags around it or not, it is the same in all pages
        live = {self.token(item)[1] for tokens in self.pages for item in tokens if item[0] == "text" and not item[2].dropped}
        often = {t[1]: v for t, v in vectors.items() if t[0] == "text" and len(v) >= CONSTANT_PAGES and t[1] in live}
        lines = self.lines()
        first = near_copies([set(" ".join(v for k, v, node in tokens if k == "text" and not node.dropped).split())
                             for tokens in self.pages]) if often or lines else []
        enough = max(CONSTANT_PAGES, CONSTANT_SHARE * len(set(first)))
        self.constant = {t for t, v in often.items() if len({first[i] for i in v}) >= enough}
        self.fields = {key: frame for key, held in lines.items() if (frame := self.frame([words for i, words in held.items() if first[i] == i]))}

    @staticmethod
    def token(item: tuple[str, str, Node]) -> tuple[str, str]:
        kind, value, node = item
        return (kind, f"{node.key}\n{value.strip()}" if value.strip() else "") if kind == "text" else (kind, node.key)

    def ordered(self, tokens: set, vector: dict[int, int]) -> bool:
        """The class's tokens come in one order in each page that holds them once."""
        first = None
        for i, n in vector.items():
            if n > 1:
                continue
            order = [t for t in map(self.token, self.pages[i]) if t in tokens]
            if first is not None and order != first:
                return False
            first = order
        return True

    def nest(self) -> list[int | None]:
        """Parent of each class: the smallest class with two neighbouring tokens that enclose it in the first page with both.
        The slot of the parent in which a class with a block of its own lies is ``filled``."""
        spans = []
        for tokens in self.classes:
            held, span = set(tokens), None
            for i, page in enumerate(self.pages):
                at = [k for k, item in enumerate(page) if self.token(item) in held]
                if at:
                    span = (i, at)
                    break
            spans.append(span)
        out: list[int | None] = []
        for c, (page, at) in enumerate(spans):
            best = None
            for d, (other, places) in enumerate(spans):
                if d != c and other == page and any(a < at[0] and at[-1] < b for a, b in zip(places, places[1:])):
                    width = places[-1] - places[0]
                    if best is None or width < best[0]:
                        best = (width, d)
            out.append(best[1] if best else None)
            if best and any(kind == "open" and key.rsplit("/", 1)[-1].split(".")[0] not in INLINE for kind, key in self.classes[c]):
                before = [k for k in spans[best[1]][1] if k < at[0]]
                self.filled.add((best[1], self.token(self.pages[page][before[-1]])))
        return out

    def lines(self) -> dict[str, dict[int, list[str]]]:
        """Slots that may be fields: those between the opening and the closing token of a block, neighbours in their class
        but for inline tags and text, of which no page holds a child class or another block. By the block's path, the
        words of the slot in each page that has it once."""
        of = {token: c for c, tokens in enumerate(self.classes) for token in tokens}
        able = set()
        for (kind, key), c in of.items():
            name, _, mark = key.rsplit("/", 1)[-1].partition(".")
            if kind == "open" and of.get(("close", key)) == c and (c, (kind, key)) not in self.filled and name not in HEADINGS | INLINE \
                    and (mark or name not in TEXTUAL) and name not in ("html", "body", "article", "main"):
                able.add(key)
        out: dict[str, dict[int, list[str]]] = defaultdict(dict)
        for i, tokens in enumerate(self.pages):
            found = self.slot_words(tokens, able)
            able -= {key for key, words in found.items() if words is None}
            for key, words in found.items():
                if words:
                    out[key][i] = words
        return {key: held for key, held in out.items() if key in able}

    @staticmethod
    def slot_words(tokens: list[tuple[str, str, Node]], keys) -> dict[str, list[str] | None]:
        """Words of a page in the blocks of the given paths; None for a path that holds another block or is a content
        element, no words for one that the page has more than once or drops."""
        out: dict[str, list[str] | None] = {}
        if not keys:
            return out
        key, part, seen = None, [], Counter()
        for kind, value, node in tokens:
            if kind == "open" and node.key in keys and not node.dropped and key is None:
                key, part = node.key, []
                seen[key] += 1
                if node.content:
                    out[key] = None
            elif key is not None:
                if kind == "close" and node.key == key:
                    if out.get(key, []) is not None:
                        out[key] = clean("".join(part)).split() if seen[key] == 1 else []
                    key = None
                elif kind == "text":
                    part.append("" if node.dropped else value)
                elif value == "br":
                    part.append("\n")
                elif value not in INLINE:
                    out[key] = None
        return out

    @staticmethod
    def frame(held: list[list[str]]) -> list[str]:
        """The template's own words of a slot, those that each of its different pages has once, if they make it a field:
        enough of its words, in one order, around values that differ."""
        if len(held) < CONSTANT_PAGES:
            return []
        own = set.intersection(*[{w for w, n in Counter(words).items() if n == 1} for words in held])
        orders = {tuple(w for w in words if w in own) for words in held}
        total = sum(map(len, held))
        if len(own) < FIELD_WORDS or len(orders) > 1 or len(own) * len(held) < FIELD_SHARE * total or all(len(words) == len(own) for words in held):
            return []
        return list(orders.pop())

    def fields_of(self, tokens: list[tuple[str, str, Node]]) -> set[str]:
        """Paths of the blocks of a page that are fields: they hold the template's words of the slot, in order."""
        found = self.slot_words(tokens, self.fields.keys())
        return {key for key, words in found.items() if words and [w for w in words if w in self.fields[key]] == self.fields[key]}


def _container(node: Node) -> bool:
    return node.name in CONTAINERS or "-" in node.name


class Layouts:
    """Content regions of pages that mark no content element.

    A layout is told by a container that at least two different pages have and that holds nearly all text of those
    pages; what most of them hold beside it are side slots of the layout. Other layouts of the host don't count.
    """

    def __init__(self, pages: list[list[tuple[str, str, Node]]], constant: set[str]):
        self.constant = constant
        held = [self.text_of(tokens) for tokens in pages]
        having: dict[str, list[int]] = defaultdict(list)
        for i, (_, under, _) in enumerate(held):
            for key in under:
                having[key].append(i)
        self.sides: dict[str, set[str]] = {}
        for key, at in having.items():
            if len(at) < 2 or key.count("/") < 3:           # html and body hold every layout
                continue
            total = sum(held[i][0] for i in at)
            if total and sum(held[i][1][key] for i in at) >= REGION_SHARE * total:
                outside = Counter(k for i in at for k in held[i][2] if not self.within(k, key))
                self.sides[key] = {k for k, n in outside.items() if n >= max(2, len(at) / 2)}

    @staticmethod
    def within(key: str, path: str) -> bool:
        return key == path or key.startswith(path + "/")

    def text_of(self, tokens) -> tuple[int, dict[str, int], dict[str, int]]:
        """Length of a page's text; that under each container; that under it without a nearer one."""
        total, under, nearest = 0, {}, Counter()
        for kind, value, node in tokens:
            if node.dropped:
                continue
            if kind == "open" and _container(node):
                under.setdefault(node.key, 0)
            elif kind == "text" and value.strip() and Template.token((kind, value, node))[1] not in self.constant:
                n, first, up = len(value.strip()), True, node
                total += n
                while up is not None and up.name:
                    if _container(up):
                        under[up.key] = under.get(up.key, 0) + n
                        if first:
                            nearest[up.key] += n
                        first = False
                    up = up.parent
                if first:
                    nearest[""] += n
        return total, under, nearest

    def region(self, tokens: list[tuple[str, str, Node]]) -> str:
        """Path of a page's content region: the innermost of its layout's that leaves out side slots only; without one,
        the whole page."""
        total, under, nearest = self.text_of(tokens)
        for key in sorted((k for k, n in under.items() if n and k in self.sides), key=len, reverse=True):
            left = sum(n for k, n in nearest.items() if not self.within(k, key) and k not in self.sides[key])
            if left <= (1 - REGION_SHARE) * total:
                return key
        return ""


def _block_of(node: Node) -> Node:
    while node.name in INLINE:
        node = node.parent
    return node


def _heads(node: Node | None) -> bool:
    while node is not None:
        if node.name in HEADINGS:
            return True
        node = node.parent
    return False


def _blocks(tokens: list[tuple[str, str, Node]], element, constant: set[str], fields: set[str] = frozenset()) -> list[str]:
    """Text blocks, in page order, of what isn't dropped. The blocks of ``fields`` are left out, unless there are no others.

    ``element`` gives the content element that a node lies in, None for what isn't content. In a content element
    constant text counts as template only before its first and after its last block of its own; headings are its own.
    Where the whole page is content (its root element) each constant run is template.
    """
    if fields:
        kept = _blocks([item for item in tokens if item[0] != "text" or _block_of(item[2]).key not in fields], element, constant)
        return kept or _blocks(tokens, element, constant)
    out, part = [], []

    def flush() -> None:
        if part and (text := clean("".join(v for v, _, _ in part))):
            out.append((text, next(of for _, of, _ in reversed(part) if of is not None), all(fixed for v, _, fixed in part if v.strip())))
        part.clear()

    for kind, value, node in tokens:
        if kind == "text":
            if not node.dropped and (of := element(node)) is not None:
                fixed = bool(constant) and Template.token((kind, value, node))[1] in constant
                if not fixed or of.name:
                    part.append((value, of, fixed and not _heads(node)))
        elif kind == "break" or value not in INLINE:
            flush()
        elif value == "br":
            part.append(("\n", None, False))
    flush()
    if all(fixed for _, _, fixed in out):
        return [text for text, _, _ in out]
    kept = []
    for _, group in groupby(out, key=lambda block: id(block[1])):
        group = list(group)
        own = [i for i, block in enumerate(group) if not block[2]]
        kept += [text for text, _, _ in group[own[0]:own[-1] + 1]] if own else []
    return kept


def _outermost(wanted):
    """The outermost element around a node, or the node itself, that is ``wanted``."""
    known: dict[int, Node | None] = {}

    def element(node: Node) -> Node | None:
        path, above = [], node
        while above is not None and id(above) not in known:
            path.append(above)
            above = above.parent
        above = known[id(above)] if above is not None else None
        for inner in reversed(path):
            above = known[id(inner)] = above if above is not None else inner if wanted(inner) else None
        return above
    return element


def extract(pages: list[str]) -> list[str]:
    """Main text of each of the pages of one host, the slots of their template that aren't fields; pages that mark their
    content and those that don't are read apart."""
    parsed = [parse(p) for p in pages]
    out = [""] * len(pages)
    with_content = [any(node.content and not node.dropped for kind, _, node in tokens if kind == "open") for tokens in parsed]
    marking = [i for i, own in enumerate(with_content) if own]
    others = [i for i, own in enumerate(with_content) if not own]
    if marking:
        template = Template([parsed[i] for i in marking])
        for i in marking:
            out[i] = "\n".join(_blocks(parsed[i], _outermost(lambda n: n.content), template.constant, template.fields_of(parsed[i])))
    if others:
        template = Template([parsed[i] for i in others])
        layouts = Layouts(template.pages, template.constant)
        of_path: dict[str, list[int]] = defaultdict(list)
        for i in others:
            of_path[layouts.region(parsed[i])].append(i)
        for path, members in of_path.items():
            constant, templates = template.constant, [template]
            if len(of_path) > 1 and path:                   # a layout has constant text and fields of its own
                templates.append(Template([parsed[i] for i in members]))
                constant = constant | templates[1].constant
            for i in members:
                fields = set().union(*[t.fields_of(parsed[i]) for t in templates])
                out[i] = "\n".join(_blocks(parsed[i], _outermost(lambda n: n.key == path), constant, fields))
    return out


def _page_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by host and chunk; a chunk's pages are read together."""
    def done(key, rows) -> pa.RecordBatch:
        texts = extract([r[2] for r in rows]) if key[0] is not None else [extract([r[2]])[0] for r in rows]
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string()),
                                           pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                          ["page_id", "url", "text", "n_chars"])
    key, rows = None, []
    for batch in batches:
        for host, chunk, *row in zip(*(batch.column(c).to_pylist() for c in ("host", "chunk", "page_id", "url", "html"))):
            if key != (host, chunk):
                if rows:
                    yield done(key, rows)
                key, rows = (host, chunk), []
            rows.append(row)
    if rows:
        yield done(key, rows)


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row: page_id, url, text (blocks joined by a line feed), n_chars (code points).

    A null or empty html, or one without main text, gives an empty text. A page whose url is null or names no host
    is read alone, as is the only page of a host: only its own elements then tell what is content. Rows that repeat
    are read like others. An empty table gives no row; other columns are ignored.
    """
    ship(pages.sparkSession)
    host = F.lower(F.regexp_extract(F.col(url_col), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"),
                        F.when(F.length(host) > 0, host).alias("host"))
    sizes = staged(rows.groupBy("host").agg(F.sum(F.octet_length("html")).cast("double").alias("bytes")), "hosts")
    total = sizes.agg(F.sum("bytes")).first()[0] or 0.0
    heavy = sizes.where(F.col("bytes") > max(CHUNK_BYTES, total / HEAVY)).select(
        F.col("host"), F.ceil(F.col("bytes") / CHUNK_BYTES).cast("long").alias("chunks")).where("host is not null")
    chunk = F.when(F.col("host").isNull(), F.pmod(F.xxhash64("page_id", "html"), F.lit(1 << 20))) \
        .otherwise(F.pmod(F.xxhash64("page_id", "url"), F.coalesce("chunks", F.lit(1).cast("long"))))
    dealt = rows.join(F.broadcast(heavy), "host", "left").withColumn("chunk", chunk).drop("chunks")
    return dealt.repartition("host", "chunk").sortWithinPartitions("host", "chunk", "page_id", "url") \
        .mapInArrow(_page_rows, "page_id long, url string, text string, n_chars long") \
        .withColumnsRenamed({"page_id": id_col, "url": url_col})
