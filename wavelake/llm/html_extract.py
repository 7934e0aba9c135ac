"""Main text of web pages by consensus host paths (operator 10).

1. Every page is parsed once into containers (block elements) and blocks of
   text.  A container's score is the length of its own blocks outside links,
   plus half of each child's score.  Each container's share of the page's
   best score is its vote for its generalised path: tags with sorted classes,
   digits replaced.
2. Votes are summed per host and path by Spark (partial sums first, so a host
   with a third of all pages is one row per task and path), and the path with
   most votes wins its host.  A vote also names the ancestor that adds the
   article's heading and text beside the container (outside ``article`` and
   ``main``, which hold theirs); the one with most votes widens the host's path.
3. Pages are joined with their host's winning path and extracted again from
   the elements on that path.  The join is salted: the rows of a hot host are
   dealt over ``SALT`` keys.  A page without such an element uses its own best
   container.

Inside the chosen element menus, headers, footers, sidebars, notices, adverts,
forms, scripts, styles and reader comments are left out, by tag, role or a
word of the class or id.  Words and ``form`` are weak signs: they don't count
where what they name holds most of the page's text (a form around the page, a
theme that calls everything a widget), nor around ``main``, the page's
``article`` or an element on the host's winning path.

Scripts, buttons, pictures and other elements that stand inside a line, and
inline adverts, are left out without ending the block around them.  A path of
over ``LONG_PATH`` characters is named by a digest of the path above and its
last step, so that a page's paths grow with its tags and not with their depth.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Collection, Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, stored

SALT = 32
#: longer paths are named by a digest
LONG_PATH = 400
TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)
    |<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>"']|"[^"]*"|'[^']*')*)(?:>|\Z)
    |(?P<text>[^<]+|<)""", re.S | re.X)
ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark nobr q rp rt "
                   "ruby s samp small span strike strong sub sup time tt u var wbr br img picture source".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
#: elements whose blocks belong to the container around them
LEAF = frozenset("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd pre blockquote figcaption figure address".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
#: start tags that end an open paragraph
ENDS_P = frozenset("address article aside blockquote details dialog dd div dl dt fieldset figcaption figure footer "
                   "form h1 h2 h3 h4 h5 h6 header hr li main menu nav ol p pre section table ul".split())
#: start tags that end an open element of these names, unless one of the second is nearer
ENDS_SAME = {"li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
             "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")),
             "th": (("td", "th"), ("tr", "table")), "option": (("option",), ("select",)),
             "tbody": (("thead", "tbody", "tfoot", "tr", "td", "th"), ("table",)),
             "body": (("head",), ())}
SKIP_TAGS = frozenset("head nav footer aside form menu dialog noscript template svg math button select input "
                      "object embed applet audio video canvas map label".split()) | RAW
#: left out inside a line: the block around them goes on
MUTED = frozenset("noscript template svg math button select object audio video canvas map label".split())
#: inline elements with such a class or id are left out in the same way
ADVERT_WORDS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion".split())
HARD_TAGS, FORM, NONE = SKIP_TAGS - {"form"}, frozenset(["form"]), frozenset()
SKIP_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar "
                       "toolbar form".split())
HARD_ROLES = SKIP_ROLES - {"banner"}
SKIP_WORDS = frozenset("nav navbar navigation menu breadcrumb breadcrumbs footer sidebar aside widget widgets related "
                       "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe "
                       "signup ad ads advert adverts advertisement advertising sponsor sponsored promo promotion "
                       "share sharing social comment comments commentlist discussion disqus replies respond form "
                       "login search pagination pager toolbar".split())
#: of these even an element with most of the text may be no wrapper: comments outgrow their post
COMMENT_WORDS = frozenset("comment comments commentlist discussion disqus replies respond".split())
#: what stands in these is never shown as it is
UNSEEN = frozenset("head noscript template svg math".split())
BESIDE = re.compile(r"(?:has|with|without|no|layout|is|js)[^a-z]")
HEADER_WORDS = frozenset("header masthead banner topbar".split())
MAIN = frozenset(("article", "main"))
#: an element around one of these is a frame of the page, not an article
FRAME_TAGS, FRAME_WORDS = frozenset(("nav", "footer")), frozenset("nav navbar sidebar".split())


@dataclass
class Node:
    tag: str
    parent: int
    path: str
    skip: bool
    header: bool  # of a header only headings count, and only inside the main element
    hard: bool = False  # left out by its own tag or role
    words: frozenset = frozenset()  # weak signs of its own: skip words of class and id, "form" for the tag
    named: bool = False  # a weak sign is in its id, which the path does not show
    main: bool = False  # is or stands inside an article or main element


@dataclass
class Page:
    nodes: list[Node] = field(default_factory=list)
    #: (container node, innermost node, text, characters inside links)
    blocks: list[tuple[int, int, str, int]] = field(default_factory=list)
    links: list[tuple[str, str]] = field(default_factory=list)
    #: weak signs (node, word) that don't count, nodes that nothing above leaves out
    void: set[tuple[int, str]] = field(default_factory=set)
    reset: set[int] = field(default_factory=set)


def _step(tag: str, attrs: str) -> tuple[str, bool, frozenset, bool, bool]:
    """Generalised path step, whether tag or role leave it out, skip words,
    whether the id has one, whether it is a header."""
    hard, header, step, named = tag in HARD_TAGS, tag == "header", tag, False
    found = FORM if tag == "form" else NONE
    if attrs and "=" in attrs:
        for name, value in ATTRIBUTE.findall(attrs):
            value = value.strip("\"'").lower()
            if name.lower() == "role":
                hard, header = hard or value in HARD_ROLES, header or value == "banner"
                continue
            # "has-sidebar" and the like tell what stands beside, not what this is
            words = {w for c in value.split() if not BESIDE.match(c) for w in re.split(r"[^a-z]+", c)}
            found = found | (words & SKIP_WORDS)
            header = header or bool(words & HEADER_WORDS)
            if name.lower() == "class":
                step = ".".join([tag, *sorted({re.sub(r"\d+", "0", c) for c in value.split()})])
            else:
                named = named or bool(words & SKIP_WORDS)
    return step, hard and tag not in MAIN, found, named, header and tag not in MAIN


def _weights(page: Page, out: list[bool]) -> list[int]:
    """Characters outside links per node with all below it, without nodes that
    are ``out``."""
    weight = [0] * len(page.nodes)
    for _, inner, text, linked in page.blocks:
        if not out[inner]:
            weight[inner] += max(0, len(text) - linked)
    for k in range(len(page.nodes) - 1, 0, -1):
        weight[page.nodes[k].parent] += weight[k]
    return weight


def _set_skips(page: Page, reset: Collection[int], void: set[tuple[int, str]]) -> None:
    """Skip of every node from its own signs and its parent's; ``reset`` nodes
    are not skipped whatever is above, ``void`` pairs (node, word) are no sign."""
    nodes = page.nodes
    for k, node in enumerate(nodes):
        node.skip = k not in reset and (node.hard or k > 0 and nodes[node.parent].skip or bool(
            node.words) and node.tag not in MAIN and any((k, w) not in void for w in node.words))


def _left(page: Page) -> int:
    return sum(max(0, len(text) - linked) for _, inner, text, linked in page.blocks
               if not page.nodes[inner].skip and not page.nodes[inner].header)


def _within(page: Page, tags: Collection[str]) -> list[bool]:
    """Whether a node is or stands inside an element of one of the tags."""
    found = [False] * len(page.nodes)
    for k, node in enumerate(page.nodes):
        found[k] = node.tag in tags or node.parent >= 0 and found[node.parent]
    return found


def _ends(page: Page) -> list[int]:
    """Place behind each node's subtree; the nodes of a subtree stand together."""
    end = list(range(1, len(page.nodes) + 1))
    for k in range(len(page.nodes) - 1, 0, -1):
        up = page.nodes[k].parent
        end[up] = max(end[up], end[k])
    return end


def _judge_skips(page: Page) -> None:
    """Decide which weak signs count on this page.

    A sign is void where its element holds most of the page's text (or all
    elements with it together do), if an article's signs are inside or none
    is outside."""
    nodes, void = page.nodes, page.void
    _set_skips(page, (), void)
    if not any(node.skip and node.tag in MAIN for node in nodes):
        hard = [False] * len(nodes)
        for k, node in enumerate(nodes):
            hard[k] = node.hard or node.parent >= 0 and hard[node.parent]
        total = left = 0
        for _, inner, text, linked in page.blocks:
            if not hard[inner]:
                total += max(0, len(text) - linked)
                left += 0 if nodes[inner].skip else max(0, len(text) - linked)
        if 2 * left >= total and _left(page):  # then no sign holds most of the text
            return
    end = _ends(page)

    def below(out) -> list[bool]:
        """Whether a node or one above it is left out by a tag, a role or ``out``."""
        found = [False] * len(nodes)
        for k, node in enumerate(nodes[1:], 1):
            found[k] = node.hard or found[node.parent] or out(k, node)
        return found

    def comment(k: int, node: Node) -> bool:
        return any((k, w) not in void for w in node.words & COMMENT_WORDS)
    weight = _weights(page, below(lambda k, node: False))
    listed, unseen = _within(page, frozenset(["li"])), _within(page, UNSEEN)
    signed = [k for k, node in enumerate(nodes) if node.words and node.tag not in MAIN]
    # an article's signs: main, h1, and articles that are no reader's comment
    titles = [k for k, node in enumerate(nodes) if weight[k] and node.tag in ("main", "h1")]
    articles = [k for k, node in enumerate(nodes) if weight[k] and node.tag == "article" and not comment(k, node)
                and not listed[k]]
    signs = sorted(titles + articles) if len(articles) == 1 else titles

    places: set[int] = set()

    def within(k: int, some: list[int]) -> bool:
        return bisect_left(some, end[k]) > bisect_left(some, k)

    def judge(words: frozenset, weight: list[int], alike: bool) -> None:
        """``alike``: elements without an article's signs may be wrappers too,
        if none of these places is beside them."""
        def wraps(some: list[int]) -> bool:
            return 2 * sum(weight[k] for k in some) > weight[0] and (any(within(k, signs) for k in some) or (
                alike and not any(all(not k <= m < end[k] and not m <= k < end[m] for k in some) for m in places)))
        for word in sorted({w for k in signed for w in nodes[k].words & words}):
            own = [k for k in signed if word in nodes[k].words]
            alone = {k for k in own if wraps([k])}
            outer, last = [], 0
            for k in own:
                if k not in alone and k >= last:
                    outer.append(k)
                    last = end[k]
            void.update((k, word) for k in (own if len(outer) > 1 and wraps(outer) else alone))
        _set_skips(page, (), void)
    judge(COMMENT_WORDS, weight, False)
    comments = below(comment)
    signs = [k for k in sorted(titles + articles) if nodes[k].tag == "main" or not comments[k] and not comment(k, nodes[k])]
    # where one stands with text that is not skipped
    body = [0] * (len(nodes) + 1)
    for _, inner, text, linked in page.blocks:
        if not nodes[inner].skip and not nodes[inner].header and nodes[inner].tag not in HEADING:
            body[inner + 1] += max(0, len(text) - linked)
    body = list(accumulate(body))
    for k in signs:
        while nodes[k].tag in LEAF or nodes[k].header:
            k = nodes[k].parent
        if k > 0 and not nodes[k].skip and body[end[k]] > body[k]:
            places.add(k)
    judge(SKIP_WORDS - COMMENT_WORDS, weight, True)
    if not _left(page):
        judge(SKIP_WORDS - COMMENT_WORDS, _weights(page, comments), True)
    if not _left(page):
        judge(COMMENT_WORDS, weight, True)
    # main, and the page's article if no other is free, stand for themselves
    for k, node in enumerate(nodes):
        if node.tag == "main" and node.skip and not unseen[k]:
            page.reset.add(k)
    if not page.reset and not any(n.tag in MAIN and not n.skip and weight[k] for k, n in enumerate(nodes)):
        left, last, found = _left(page), 0, []
        for k in signs:
            if nodes[k].tag == "article" and k >= last:  # not inside another
                found.append(k)
                last = end[k]
        titled = [k for k in found if within(k, titles)]
        page.reset.update(k for k in found if found == [k] or titled == [k] or weight[k] > left)
    _set_skips(page, page.reset, void)


def _path(above: str, step: str) -> str:
    path = f"{above}>{step}"
    if len(path) <= LONG_PATH:
        return path
    return f"#{hashlib.blake2b(above.encode('utf-8', 'surrogatepass'), digest_size=16).hexdigest()}>{step}"


def _advert(attrs: str) -> bool:
    return any(not BESIDE.match(c) and ADVERT_WORDS.intersection(re.split(r"[^a-z]+", c))
               for name, value in ATTRIBUTE.findall(attrs) if name.lower() != "role"
               for c in value.strip("\"'").lower().split())


def parse(html: str | None) -> Page:
    """Containers and blocks of a page.  Unclosed, stray and cut-off tags are
    taken as browsers do in the usual cases.  Memory grows with the page's
    length, however deep its elements stand."""
    page = Page([Node("body", -1, "body", False, False)])  # html and body tags may be missing
    nodes, stack, text, linked, depth = page.nodes, [0], [], 0, 0
    href, anchor = None, []
    html, at = html or "", 0
    paths: dict[tuple[str, str], str] = {}  # equal paths share their text
    #: open muted elements: place in the stack, open elements of its name, block text around it
    held: list[tuple[int, list[int], list[str], int]] = []
    opened: Counter[str] = Counter()  # names in the stack

    def flush() -> None:
        nonlocal linked
        if text:
            block = " ".join(entities.unescape("".join(text)).split())
            if block:
                inner = k = stack[-1]
                while nodes[k].tag in LEAF:
                    k = nodes[k].parent
                page.blocks.append((k, inner, block, linked))
            text.clear()
        linked = 0

    def drop(size: int) -> None:
        opened.subtract(nodes[k].tag for k in stack[size:])
        del stack[size:]

    def leave(size: int) -> None:
        """End the open elements from ``size`` on; the block around a muted one goes on."""
        nonlocal linked
        flush()
        while held and held[-1][0] >= size:
            place, _, around, linked = held.pop()
            drop(place)
            text[:] = around
            if place > size:
                flush()
        drop(size)

    def enter(tag: str, attrs: str, hard: bool) -> None:
        step, own, words, named, header = _step(tag, attrs)
        up = nodes[stack[-1]]
        key = up.path, step
        path = paths.get(key) or paths.setdefault(key, _path(*key))
        nodes.append(Node(tag, stack[-1], path, False, (header or up.header) and tag not in MAIN,
                          own or hard, words, named, up.main or tag in MAIN))
        if not attrs.rstrip().endswith("/"):
            stack.append(len(nodes) - 1)
            opened[tag] += 1

    def mute(tag: str, attrs: str) -> None:
        """A node that is left out; the text before it waits for its end."""
        nonlocal linked
        if not attrs.rstrip().endswith("/"):
            held.append((len(stack), [1], text.copy(), linked))
            text.clear()
            linked = 0
            enter(tag, attrs, True)

    while at < len(html):
        m = TOKEN.match(html, at)
        at = m.end()
        tag = m.group("tag")
        if m.group("text") is not None:
            t = m.group("text")
            text.append(t)
            if depth:
                linked += len(t.strip())
                anchor.append(t)
            continue
        if tag is None:
            continue
        tag, attrs = tag.lower(), m.group("attrs")
        if m.group("close"):
            if tag in INLINE:
                if held and nodes[stack[held[-1][0]]].tag == tag:
                    held[-1][1][0] -= 1
                    if not held[-1][1][0]:
                        leave(held[-1][0])
                if tag == "a" and depth:
                    page.links.append((href, " ".join(entities.unescape("".join(anchor)).split())))
                    depth = 0
                continue
            if not opened[tag]:
                if tag not in MUTED and tag not in RAW:
                    flush()
                continue
            for k in range(len(stack) - 1, 0, -1):
                if nodes[stack[k]].tag == tag:
                    leave(k)
                    break
            continue
        if tag in INLINE:
            if tag == "a":
                found = re.search(r"""(?:^|\s)href\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", attrs, re.I)
                depth, href, anchor = 1, entities.unescape(found[1].strip("\"'")) if found else "", []
            elif tag == "br":
                text.append(" ")
            if held and nodes[stack[held[-1][0]]].tag == tag:
                held[-1][1][0] += 1
            elif tag not in VOID and "=" in attrs and _advert(attrs):
                mute(tag, attrs)
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, at)
            at = end.end() if end else len(html)
            continue
        if tag in VOID and tag != "hr":
            continue
        if tag in MUTED:
            mute(tag, attrs)
            continue
        flush()
        depth = 0
        if tag in ENDS_P and opened["p"]:
            k = len(stack) - 1
            while nodes[stack[k]].tag in INLINE or nodes[stack[k]].tag == "label":
                k -= 1
            if nodes[stack[k]].tag == "p":
                leave(k)
        if tag in ENDS_SAME:
            ends, stop = ENDS_SAME[tag]
            k = len(stack) - 1
            while k > 0 and nodes[stack[k]].tag not in stop and any(opened[t] for t in ends):
                if nodes[stack[k]].tag in ends:
                    leave(k)
                k -= 1
        if tag in ("html", "body", "hr"):
            continue
        enter(tag, attrs, False)
    leave(1)
    flush()
    _judge_skips(page)
    return page


def container_scores(page: Page) -> dict[int, float]:
    """Score per container: own block characters outside links, and half of
    what its children have."""
    score: dict[int, float] = {}
    for container, inner, text, linked in page.blocks:
        if not page.nodes[inner].skip and not page.nodes[inner].header:
            score[container] = score.get(container, 0.0) + max(0, len(text) - linked)
    for k in range(len(page.nodes) - 1, 0, -1):  # children come after their parent
        if k in score:
            up = page.nodes[k].parent
            score[up] = score.get(up, 0.0) + score[k] / 2
    return score


def wide_votes(page: Page) -> dict[tuple[str, str | None], float]:
    """Vote per generalised path, and the path it is widened to: its
    containers' score over the page's best.  Containers with nothing to add or
    less than half of the best score name no widened path; those with less
    than a millionth of it have no vote."""
    score = container_scores(page)
    best, out = max(score.values(), default=0.0), {}
    around = Around(page) if best > 0 else None
    for k, s in score.items():
        if best > 0 and s >= best * 5e-7:
            top = around.widened(k) if 2 * s >= best else k
            key = page.nodes[k].path, page.nodes[top].path if top != k else None
            out[key] = out.get(key, 0.0) + s / best
    return out


def votes(page: Page) -> dict[str, float]:
    """Vote per generalised path."""
    out: dict[str, float] = {}
    for (path, _), v in wide_votes(page).items():
        out[path] = out.get(path, 0.0) + v
    return out


class Around:
    """What is shown of a page, to widen a container to its article."""

    def __init__(self, page: Page):
        self.page, self.ready = page, False

    def _read(self) -> None:
        nodes = self.page.nodes
        n, self.ready = len(nodes), True
        self.end = _ends(self.page)
        self.frame = [False] * n
        #: text outside and inside links, without headings, per node with all below it
        self.plain, self.linked = [0] * n, [0] * n
        #: text in a node itself, of blocks that aren't mostly links
        self.own = [0] * n
        #: first block of a subtree; place and node of the headings; h1 before each node
        self.first, self.headings, self.h1 = [len(self.page.blocks)] * n, {}, [0] * (n + 1)
        for at, (_, inner, text, linked) in enumerate(self.page.blocks):
            node = nodes[inner]
            if node.skip or node.header and node.tag not in HEADING:
                continue
            self.first[inner] = min(self.first[inner], at)
            if node.tag in HEADING:
                self.headings[at] = inner
                self.h1[inner + 1] += node.tag == "h1"
                continue
            self.plain[inner] += max(0, len(text) - linked)
            self.linked[inner] += linked
            self.own[inner] += len(text) - linked if 2 * linked <= len(text) else 0
        for k in range(n - 1, 0, -1):
            up, node = nodes[k].parent, nodes[k]
            self.plain[up] += self.plain[k]
            self.linked[up] += self.linked[k]
            self.first[up] = min(self.first[up], self.first[k])
            if node.skip and (node.tag in FRAME_TAGS or node.words & FRAME_WORDS):
                self.frame[up] = True
        self.h1, self.places = list(accumulate(self.h1)), list(self.headings)
        #: the last heading so far that is in no header, per place of a heading
        self.last = list(accumulate((-1 if nodes[m].header else m for m in self.headings.values()),
                                    lambda a, m: a if m < 0 else m))
        # jumps over many ancestors; the nearest frame at or above a node
        self.jump, depth, self.framed = [0] * n, [0] * n, [0] * n
        for k in range(1, n):
            up = nodes[k].parent
            far = self.jump[up]
            depth[k] = depth[up] + 1
            self.jump[k] = self.jump[far] if depth[up] - depth[far] == depth[far] - depth[self.jump[far]] else up
            self.framed[k] = k if self.frame[k] else self.framed[up]
        #: how many elements above a node add text to what is inside; without and with a title
        self.adds = []
        for titled in (False, True):
            good = [bool(self.plain[c]) and not self.links(c) and not (titled and self.first[c] in self.headings)
                    for c in range(n)]
            count, adds = [0] * n, [0] * n
            for c in range(1, n):
                count[nodes[c].parent] += good[c]
            for c in range(1, n):
                up = nodes[c].parent
                adds[c] = adds[up] + (self.own[up] > 0 or count[up] > good[c])
            self.adds.append(adds)

    def children(self, k: int) -> Iterator[int]:
        c = k + 1
        while c < self.end[k]:
            yield c
            c = self.end[c]

    def links(self, k: int) -> bool:
        return self.linked[k] > self.plain[k]

    def _climb(self, k: int, test: Callable[[int], bool]) -> int:
        """The first node at or above k that passes; all above it pass too."""
        while not test(k):
            k = self.page.nodes[k].parent if test(self.jump[k]) else self.jump[k]
        return k

    def _beside(self, k: int, tags: Collection[str]) -> bool:
        """Whether a heading stands before k in its parent; one of a header
        only if the parent is no frame of the page."""
        nodes, up = self.page.nodes, self.page.nodes[k].parent
        for i in range(bisect_left(self.places, self.first[k]) - 1, -1, -1):
            m = self.headings[self.places[i]]
            if not up < m < self.end[up]:  # the blocks of a subtree stand together
                return False
            if nodes[m].tag in tags and (not nodes[m].header or up > 0 and not self.frame[up]):
                return True
        return False

    def titled(self, k: int) -> int:
        """The parent of an article without a title, if the parent's text begins
        with an h1 of its own and it holds no other article and is no frame of
        the page; else the article."""
        if not self.ready:
            self._read()
        nodes, up = self.page.nodes, self.page.nodes[k].parent
        if up < 0 or self.frame[up] or self.h1[self.end[k]] > self.h1[k] or self.first[k] in self.headings:
            return k
        title = self.headings.get(self.first[up], 0)
        alone = not any(nodes[c].tag == "article" for c in self.children(up) if c != k)
        return up if alone and nodes[title].tag == "h1" and not nodes[title].header and nodes[title].parent == up else k

    def widened(self, k: int) -> int:
        """The smallest ancestor of k that adds the article's heading, and from
        there the largest that adds text and is no frame of the page.  Ancestors
        in which k has less than half of the text are not looked at, nor is
        the whole page, except for a heading beside k."""
        nodes = self.page.nodes
        if nodes[k].main:
            return k
        if not self.ready:
            self._read()
        most, top, up = 2 * self.plain[k], k, nodes[k].parent
        inside = self.h1[self.end[k]] > self.h1[k]
        titled = inside or self.first[k] in self.headings
        if not inside and up >= 0 and self.plain[up] <= most:
            before = bisect_left(self.places, self.first[k])
            if self._beside(k, ("h1",) if titled else HEADING):
                top, titled = up, True
            elif not titled and up > 0 and before and self.last[before - 1] >= 0:
                up = self._climb(up, lambda x: x < self.last[before - 1] or x == 0)
                if up > 0 and self.plain[up] <= most:
                    top, titled = up, True
        up = nodes[top].parent
        if up <= 0:
            return top
        limit = max(self._climb(up, lambda x: x == 0 or self.plain[x] > most), self.framed[up])
        if up == limit:
            return top
        last = self._climb(up, lambda x: nodes[x].parent <= limit)
        return self._climb(top, lambda x: self.adds[titled][x] <= self.adds[titled][last])


def _ancestors(page: Page, k: int) -> list[int]:
    out = [k]
    while page.nodes[k].parent >= 0:
        k = page.nodes[k].parent
        out.append(k)
    return out


def main_element(page: Page, path: str | None) -> int:
    """Node to extract: the elements on ``path`` or what encloses them all,
    widened to an enclosing article or main element.  If all elements on
    ``path`` are skipped, by weak signs that the path shows or that stand above
    them, these signs don't count."""
    on = [k for k, node in enumerate(page.nodes) if node.path == path]
    found = [k for k in on if not page.nodes[k].skip]
    if on and not found:
        out = [False] * len(page.nodes)
        for k, node in enumerate(page.nodes):
            out[k] = bool(node.hard or node.words & COMMENT_WORDS) or node.parent >= 0 and out[node.parent]
        found = [k for k in on if not page.nodes[k].named and not out[k]]
        if found:
            clear: set[int] = set()
            for k in found:
                while k >= 0 and k not in clear:
                    clear.add(k)
                    k = page.nodes[k].parent
            page.void |= {(a, w) for a in clear for w in page.nodes[a].words}
            _set_skips(page, page.reset, page.void)
    if not found:
        score = container_scores(page)
        if not score:
            return 0
        found = [max(score, key=lambda k: (score[k], -k))]
    end = _ends(page)
    common = [a for a in _ancestors(page, found[0]) if end[a] > found[-1]]
    wide = [k for k in common if page.nodes[k].tag in MAIN]
    articles = [k for k in wide if page.nodes[k].tag == "article"]
    return (articles or wide or [common[0]])[-1]


def extract(page: Page, path: str | None, wide: str | None = None) -> list[str]:
    """Blocks of the main text in page order: all of the main element, and of
    what it is widened to (by ``wide`` where it stands on ``path``) what is not
    mostly links."""
    nodes = page.nodes
    core = top = main_element(page, path)
    around = Around(page)
    if core > 0:
        last = _ends(page)[core] if wide is not None else 0
        if nodes[core].tag in MAIN:
            top = around.titled(core)
        elif wide is not None and (f"{path}>".startswith(f"{nodes[core].path}>") or any(
                nodes[k].path == path for k in range(core, last))):
            top = next((a for a in _ancestors(page, core) if nodes[a].path == wide), core)
        else:
            top = around.widened(core)
    inside, out, chain = {top}, [], set()
    if top != core:
        if not around.ready:
            around._read()
        up = _ancestors(page, core)
        chain = set(up[1:up.index(top) + 1])
    for k in range(top + 1, len(nodes)):
        if nodes[k].parent in inside and not (nodes[k].parent in chain and k not in chain and k != core
                                              and around.links(k)):
            inside.add(k)
    for _, inner, text, linked in page.blocks:
        node = nodes[inner]
        if inner in inside and not node.skip and not (inner in chain and 2 * linked > len(text)):
            if node.header and not (node.tag in HEADING and top > 0):
                continue
            out.append(text)
    return out


def host_of(url):
    """Host of a URL column, in lower case without port; empty if there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1),
                              F.lit("")))


def host_paths(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """host, path, votes and widened path (or null) of the winning path per
    host; of equal votes the first path in order wins."""
    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        total: dict[tuple[str, str, str | None], float] = {}
        for host, html in zip(batch.column(0), batch.column(1), strict=True):
            for (path, wide), v in wide_votes(parse(html.as_py())).items():
                key = host.as_py(), path, wide
                total[key] = total.get(key, 0.0) + round(v, 6)
        return pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in total], pa.string()), pa.array([k[1] for k in total], pa.string()),
             pa.array([k[2] for k in total], pa.string()),
             pa.array([round(v * 1e6) for v in total.values()], pa.int64())], ["host", "path", "wide", "votes"])
    cast = map_batches(pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html")), fn,
                       "host string, path string, wide string, votes bigint")
    total = cast.groupBy("host", "path", "wide").agg(F.sum("votes").alias("votes"))
    # pages with nothing to add don't vote on the widened path
    total = total.groupBy("host", "path").agg(F.sum("votes").alias("votes"), F.min(F.when(
        F.col("wide").isNotNull(), F.struct((-F.col("votes")).alias("v"), F.col("wide")))).alias("w"))
    # one row per host by a combined aggregate: most votes, then the first path
    best = total.groupBy("host").agg(F.min(F.struct((-F.col("votes")).alias("v"), F.col("path"), F.col("w.wide").alias(
        "wide"))).alias("b"))
    return best.select("host", F.col("b.path").alias("path"), (-F.col("b.v")).alias("votes"),
                       F.col("b.wide").alias("wide"))


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                  html_col: str = "html") -> DataFrame:
    """One row per input row: page_id, url, text, n_chars (code points).

    A null or empty page, or one without main text, has an empty text.  Pages
    with a null url or one without a host vote together.  Repeated rows stay
    repeated; other columns are not read."""
    # written first: with its size known, a small table of paths goes to the
    # pages, and the pages are shuffled only if it is large
    paths = stored(host_paths(pages, url_col, html_col), "paths")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                        F.coalesce(F.col(html_col), F.lit("")).alias("html"), host_of(F.col(url_col)).alias("host"))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALT)).cast("int"))
    paths = paths.select("host", "path", "wide", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt"))
    joined = rows.join(paths, ["host", "salt"], "left").select("page_id", "url", "html", "path", "wide")

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        text = ["\n\n".join(extract(parse(h.as_py()), p.as_py(), w.as_py()))
                for h, p, w in zip(batch.column(2), batch.column(3), batch.column(4), strict=True)]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(text, pa.string()), pa.array(map(len, text), pa.int64())],
            ["page_id", "url", "text", "n_chars"])
    kind = rows.schema["page_id"].dataType.simpleString()
    return map_batches(joined, fn, f"page_id {kind}, url string, text string, n_chars bigint")
