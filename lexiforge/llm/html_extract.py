"""Main text of web pages by wrapper induction.

1. Every page is parsed once, into blocks of text and a skeleton: siblings of
   its main part with the same tag and classes are merged; a skeleton node with
   text of its own is a slot.
2. For each host the distinct skeletons (few, however many pages a host has)
   are aligned by simple tree matching and folded into wrappers; aligned nodes
   share a slot of the wrapper. A host's skeletons are dealt by their hashes to
   tasks of about KINDS; the wrappers of all deals are folded the same way.
3. As a slot holds the texts of merged siblings, each text counts by itself: one
   that every page of the wrapper with this slot has there is template, if at
   least DISTINCT such pages differ in their main part; the others vary and are
   content. A wrapper whose pages are too few, or are copies of one page, shows
   nothing, and all its slots count as content.
4. An element of the main part whose class or id is a mark of furniture (adverts,
   notices, comments, teasers and the like) is only suspected. The wrapper's
   pages decide: where it holds half of their text or more, varies and is not
   mostly links, it is content after all. Where a wrapper has too few pages, the
   page alone decides by the same shares. Comments are content only if they are
   the whole text.
5. A page's text is what stands in content slots of its main part.

The main part: the outermost articles, if they hold half of what the main
elements and articles together hold; else all of these; else, if they hold less
than a third of the page's unmarked text outside links, the body. Elements that
are never main text by their tag (nav, aside, footer, controls, scripts and the
like) and hidden ones stay out at any depth. A header inside the main part is
kept if it holds a heading, as it is the article's own.

Only hashes and skeletons are shuffled; blocks are joined to the template of
their host and skeleton, which Spark broadcasts only when it has measured it
small.

Defined results for odd input: null, empty or textless html gives the empty
text; a page without article or main part is read from its body; null or odd
urls make one host; repeated rows get equal rows; empty tables give none; other
columns don't take part; nodes deeper than DEPTH in the main part share the slot
of their ancestor there.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import Staging, tidy

#: Pages with different main parts from which a wrapper's constant slots are believed.
DISTINCT = 5
#: Share of nodes that must match for a skeleton to follow a wrapper.
ALIKE = 0.5
#: Skeletons of a host that one task folds, about.
KINDS = 512
#: Levels of the main part that the skeleton tells apart.
DEPTH = 40

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that end an open <p>.
ENDS_P = BLOCK - frozenset("td th tr tbody thead tfoot caption body html".split())
#: A start tag closes an open element of these kinds, up to the given borders.
SIBLINGS = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
}
#: Elements whose text is never main text.
NEVER = frozenset(
    "head nav header footer aside script style noscript template iframe svg canvas button select textarea input dialog object "
    "audio video map datalist title".split()
)
#: Roles that say the same.
NEVER_ROLES = frozenset("navigation banner contentinfo complementary search menu menubar toolbar dialog alertdialog".split())
#: Whole names in class and id, or parts of names that are otherwise NEUTRAL, that make an element suspect.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising advertorial adbox adslot adunit banner banners breadcrumb "
    "breadcrumbs consent cookie cookies dropdown footer gdpr login masthead menu menus modal nav navbar navigation navlinks newsletter "
    "notice notices pagination pager popup promo promos promoted promotion recommended recommendations related share sharing sidebar "
    "signup skip social sponsor sponsored subscribe subscription teaser teasers toolbar topbar topnav widget widgets".split()
)
COMMENTS = frozenset("comment comments commentlist disqus replies respond".split())
#: Parts of a name that say nothing about what an element holds.
NEUTRAL = frozenset(
    "area aside bar block body bottom box btn button buttons center column container content desktop element fixed floating footer "
    "form global group header holder inline inner item items large layer left link links list main message mobile module outer panel "
    "page post posts primary right secondary section site slot small space sticky story stories stuff text to top unit web wrap wrapper".split()
)

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|([^<]+|<)", re.S)
_ATTR = re.compile(r"(?<![\w-])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_PART = re.compile(r"[^a-zA-Z]+|(?<=[a-z])(?=[A-Z])")
_SPACE = re.compile(r"\s+")
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

#: Standing of an element: content, suspected comments, suspected furniture, never main text.
FREE, TALK, SUSPECT, OUT = range(4)


@lru_cache(maxsize=20_000)
def marked(names: str) -> int:
    """What the names in class and id make of an element: FREE, TALK or SUSPECT."""
    best = FREE
    for name in names.split():
        parts = [p.lower() for p in _PART.split(name) if p]
        told = [p for p in parts if p not in NEUTRAL]
        if told and all(p in COMMENTS for p in told):
            return TALK
        if parts and (name.lower() in MARKS or (all(p in MARKS or p in NEUTRAL for p in parts) and any(p in MARKS for p in parts))):
            best = SUSPECT
    return best


class Page:
    """Elements in document order, each with its parent, and the texts between their borders."""

    def __init__(self):
        self.tag, self.sign, self.parent, self.standing = ["#"], ["#"], [0], [FREE]
        #: (element, border count, text): texts with equal counts have no border of a block between them
        self.texts: list[tuple[int, int, str]] = []


def _standing(tag: str, found: dict[str, str]) -> int:
    if tag in NEVER or "hidden" in found or found.get("aria-hidden", "").lower() == "true" or _UNSEEN.search(found.get("style", "")):
        return OUT
    if found.get("role", "").lower() in NEVER_ROLES:
        return OUT
    if tag in ("html", "body", "main"):
        return FREE
    if tag in ("form", "menu"):
        return SUSPECT
    return marked(f"{found.get('class', '')} {found.get('id', '')}")


@lru_cache(maxsize=20_000)
def _element(tag: str, attributes: str) -> tuple[str, str, int]:
    """Tag by role, signature and standing."""
    found = {m[1].lower(): (m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(attributes)}
    sign = re.sub(r"[\s()]", "_", ".".join([tag, *sorted(found.get("class", "").split())]))
    if found.get("role", "").lower() == "main":
        return "main", sign, FREE
    return tag, sign, _standing(tag, found)


def parse(source: str) -> Page:
    page = Page()
    open_at, names = [0], ["#"]  # open elements and their tags as written
    count: Counter = Counter()  # open elements by tag
    border = at = 0

    def close(i: int) -> None:
        nonlocal border
        for name in names[i:]:
            count[name] -= 1
            border += name in BLOCK
        del open_at[i:], names[i:]

    for m in _TOKEN.finditer(source):
        if m.start() < at:
            continue
        if m[4] is not None:
            page.texts.append((open_at[-1], border, m[4]))
            continue
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:  # end tag
            if count[tag] > 0:
                for i in range(len(names) - 1, 0, -1):
                    if names[i] == tag:
                        close(i)
                        break
                    if tag not in BLOCK and names[i] in BLOCK:
                        break  # a stray inline end tag closes no block
            continue
        if tag in ENDS_P and count["p"] > 0:
            for i in range(len(names) - 1, 0, -1):
                if names[i] == "p":
                    close(i)
                    break
                if names[i] in BLOCK:
                    break
        if tag in SIBLINGS:
            same, edge = SIBLINGS[tag]
            if any(count[x] > 0 for x in same):
                for i in range(len(names) - 1, 0, -1):
                    if names[i] in edge:
                        break
                    if names[i] in same:
                        close(i)
                        break
        if tag == "br":
            page.texts.append((open_at[-1], border, " "))
            continue
        kind, sign, standing = _element(tag, m[3])
        border += tag in BLOCK
        page.tag.append(kind)
        page.sign.append(sign)
        page.parent.append(open_at[-1])
        page.standing.append(standing)
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(source, m.end())
            at = end.end() if end else len(source)
        elif tag not in VOID and (tag in BLOCK or not m[3].endswith("/")):  # "/>" means nothing on a block
            open_at.append(len(page.tag) - 1)
            names.append(tag)
            count[tag] += 1
    return page


def _sums(page: Page, own: list[int]) -> list[int]:
    """Own values plus those of all elements below; children come after their parents."""
    out = list(own)
    for i in range(len(out) - 1, 0, -1):
        out[page.parent[i]] += out[i]
    return out


def _settle(page: Page) -> None:
    """Hands standings down to the elements inside, wrappers around the main part and headings of articles excepted."""
    n = len(page.tag)
    mains = _sums(page, [int(t == "main") for t in page.tag])
    articles = _sums(page, [int(t == "article" and s == FREE) for t, s in zip(page.tag, page.standing, strict=True)])
    headings = _sums(page, [int(len(t) == 2 and t[0] == "h" and t[1] in "123456") for t in page.tag])
    inside = [False] * n
    for i in range(1, n):
        up, tag = page.parent[i], page.tag[i]
        inside[i] = inside[up] or page.tag[up] in ("article", "main")
        own = page.standing[i]
        if own in (TALK, SUSPECT) and tag != "article" and (mains[i] or (articles[i] and articles[i] == articles[0])):
            own = FREE  # class="with-sidebar" around everything, or a page-wide form
        elif own == OUT and tag == "header" and inside[i] and headings[i]:
            own = FREE
        page.standing[i] = max(own, page.standing[up])


def _main(page: Page, weight: list[int]) -> list[int]:
    """The roots of the main part; ``weight`` is the free text of each element outside links."""
    n = len(page.tag)
    inside = [0] * n  # 1 in an article, 2 in a main element
    articles, all_parts, bodies = [], [], []
    for i in range(1, n):
        tag, up = page.tag[i], page.parent[i]
        inside[i] = inside[up]
        if page.standing[i] != FREE:
            continue
        if tag == "body" and not bodies:
            bodies.append(i)
        if tag in ("article", "main"):
            if not inside[up]:
                all_parts.append(i)
            if tag == "article" and not inside[up] & 1:
                articles.append(i)
            inside[i] |= 1 if tag == "article" else 2
    held = _sums(page, weight)
    body = bodies or [0]
    total, whole = (sum(held[i] for i in x) for x in (all_parts, body))
    if all_parts and (3 * total >= whole or not whole):
        # a main element may hold no more than its articles, or much more
        return articles if articles and 2 * sum(held[i] for i in articles) >= total else all_parts
    return body


class Skeleton:
    """Siblings with equal signatures merged, in order of first appearance."""

    def __init__(self):
        self.sign: list[str] = ["#"]
        self.kids: list[dict[str, int]] = [{}]
        self.depth: list[int] = [0]

    def child(self, at: int, sign: str) -> int:
        if self.depth[at] >= DEPTH:
            return at
        got = self.kids[at].get(sign)
        if got is None:
            got = self.kids[at][sign] = len(self.sign)
            self.sign.append(sign)
            self.kids.append({})
            self.depth.append(self.depth[at] + 1)
        return got

    def text(self, at: int = 0) -> str:
        inner = " ".join(self.text(k) for k in self.kids[at].values())
        return f"{self.sign[at]}({inner})" if inner else self.sign[at]

    def order(self, at: int = 0) -> list[int]:
        return [at, *(i for k in self.kids[at].values() for i in self.order(k))]


#: A block: its skeleton node in preorder, its text, the node of the suspect it stands in (-1: none), whether that
#: is a comment, and its characters inside links.
Block = tuple


def shape(source: str | None) -> tuple[str, list[Block]]:
    """The text of a page's skeleton, and the blocks of its main part in page order."""
    skeleton, found = Skeleton(), []
    if not source:
        return skeleton.text(), []
    page = parse(source)
    _settle(page)
    n = len(page.tag)
    linked = [False] * n
    for i in range(1, n):
        linked[i] = linked[page.parent[i]] or page.tag[i] == "a"
    weight = [0] * n
    for i, _, text in page.texts:
        if page.standing[i] == FREE and not linked[i]:
            weight[i] += len(text.strip())
    roots = frozenset(_main(page, weight))
    spot, doubt = [-1] * n, [-1] * n  # skeleton nodes of the main part's elements, and of the suspects they stand in
    for i in range(n):
        up = page.parent[i]
        if i in roots:
            spot[i] = skeleton.child(0, page.sign[i]) if i else 0
        elif i and spot[up] >= 0 and page.standing[i] != OUT:
            suspect = page.standing[i] != FREE
            spot[i] = skeleton.child(spot[up], page.sign[i]) if page.tag[i] in BLOCK or (suspect and doubt[up] < 0) else spot[up]
            doubt[i] = doubt[up] if doubt[up] >= 0 else spot[i] if suspect else -1
    number = {k: i for i, k in enumerate(skeleton.order())}

    def add(own: list[tuple[int, str]]) -> None:
        text = _SPACE.sub(" ", entities.unescape("".join(t for _, t in own))).strip()
        if text:
            i = own[0][0]
            links = sum(len(t.strip()) for e, t in own if linked[e])
            found.append((number[spot[i]], text, number[doubt[i]] if doubt[i] >= 0 else -1, page.standing[i] == TALK, links))

    held: list[tuple[int, str]] = []
    key = None
    for i, border, text in page.texts:
        if spot[i] < 0:
            continue
        if key != (border, doubt[i]):
            add(held)
            held, key = [], (border, doubt[i])
        held.append((i, text))
    add(held)
    return skeleton.text(), found


def doubts(found: list[Block]) -> dict[int, tuple[int, int, bool]]:
    """Characters, those in links, and whether it is a comment, by suspect."""
    out: dict[int, tuple[int, int, bool]] = {}
    for _, text, suspect, talk, links in found:
        if suspect >= 0:
            chars, linked, _ = out.get(suspect, (0, 0, False))
            out[suspect] = (chars + len(text), linked + links, talk)
    return out


def cleared(chars: int, links: int, talk: bool, total: int) -> bool:
    """Whether a suspect is content after all."""
    return chars >= total if talk else 2 * chars >= total and 2 * links < chars


def page_text(source: str | None) -> str:
    """The text of a page that no wrapper tells anything about."""
    _, found = shape(source)
    total = sum(len(b[1]) for b in found)
    keep = {k for k, (chars, links, talk) in doubts(found).items() if cleared(chars, links, talk, total)}
    return "\n".join(b[1] for b in found if b[2] < 0 or b[2] in keep)


# -- simple tree matching ---------------------------------------------------------

Tree = tuple  # (sign, [Tree, ...])


def read_tree(text: str) -> Tree:
    """A tree from a skeleton's text."""
    stack: list[tuple[str, list]] = [("", [])]
    for m in re.finditer(r"[^\s()]+|[()]", text):
        if m[0] == "(":
            stack.append(stack[-1][1][-1])
        elif m[0] == ")":
            stack.pop()
        else:
            stack[-1][1].append((m[0], []))
    return stack[0][1][0] if stack[0][1] else ("#", [])


def size(tree: Tree) -> int:
    return 1 + sum(size(k) for k in tree[1])


def match(a: Tree, b: Tree) -> tuple[int, list]:
    """Nodes in the largest top-down, order-preserving matching of two trees, and the matched pairs of children."""
    if a[0] != b[0]:
        return 0, []
    ka, kb = a[1], b[1]
    best = [[0] * (len(kb) + 1) for _ in range(len(ka) + 1)]
    inner = [[match(x, y) for y in kb] for x in ka]
    for i in range(1, len(ka) + 1):
        for j in range(1, len(kb) + 1):
            best[i][j] = max(best[i - 1][j], best[i][j - 1], best[i - 1][j - 1] + inner[i - 1][j - 1][0])
    pairs, i, j = [], len(ka), len(kb)
    while i and j:
        score, below = inner[i - 1][j - 1]
        if score and best[i][j] == best[i - 1][j - 1] + score:
            pairs.append((i - 1, j - 1, below))
            i, j = i - 1, j - 1
        elif best[i][j] == best[i - 1][j]:
            i -= 1
        else:
            j -= 1
    return best[-1][-1] + 1, pairs[::-1]


class Wrapper:
    """A growing tree whose nodes are slots."""

    def __init__(self, name: int):
        self.name, self.slots = name, 0
        self.tree: Tree | None = None

    def _grow(self, tree: Tree) -> tuple[Tree, list[int]]:
        """A copy of ``tree`` with slot numbers, and the slots in preorder."""
        own = self.slots
        self.slots += 1
        kids, order = [], [own]
        for k in tree[1]:
            kid, below = self._grow(k)
            kids.append(kid)
            order += below
        return (tree[0], kids, own), order

    def fold(self, tree: Tree) -> list[int]:
        """Slots of the nodes of ``tree`` in preorder; nodes that match nothing become new slots."""
        if self.tree is None:
            self.tree, order = self._grow(tree)
            return order

        def merge(mine, other, pairs) -> list[int]:
            matched = {j: (i, below) for i, j, below in pairs}
            kids, order, put = mine[1], [mine[2]], 0
            taken = {j: kids[i] for j, (i, _) in matched.items()}
            for j, k in enumerate(other[1]):
                if j in taken:
                    node = taken[j]
                    order += merge(node, k, matched[j][1])
                    put = next(n for n, x in enumerate(kids) if x is node) + 1
                else:
                    node, below = self._grow(k)
                    kids.insert(put, node)
                    put += 1
                    order += below
            return order

        return merge(self.tree, tree, match(self.tree, tree)[1])


def _write(tree: Tree) -> tuple[str, list[int]]:
    """A wrapper's tree as text, and its slots in preorder."""
    parts, order = zip(*map(_write, tree[1]), strict=True) if tree[1] else ((), ())
    return f"{tree[0]}({' '.join(parts)})" if parts else tree[0], [tree[2], *(i for o in order for i in o)]


def induce(skeletons: list[str]) -> tuple[list[tuple[int, list[int]]], list[Wrapper]]:
    """For each skeleton its wrapper and the wrapper's slots of its nodes in preorder; and the wrappers."""
    wrappers: list[Wrapper] = []
    out = []
    for text in skeletons:
        tree = read_tree(text)
        n = size(tree)
        best, share = None, 0.0
        for w in wrappers:
            score = match(w.tree, tree)[0] / min(n, w.slots)
            if score > share:
                best, share = w, score
        if best is None or share < ALIKE:
            best = Wrapper(len(wrappers))
            wrappers.append(best)
        out.append((best.name, best.fold(tree)))
    return out, wrappers


# -- the job ------------------------------------------------------------------------


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "replace")) - 2**63


SHAPES = (
    "page_id long, url string, host string, kind long, skeleton string, main long, "
    "blocks array<struct<node:int,text:string,hash:long,doubt:int>>, doubts array<struct<node:int,chars:long,links:long,talk:boolean>>, total long"
)
_BLOCKS = pa.list_(pa.struct([("node", pa.int32()), ("text", pa.string()), ("hash", pa.int64()), ("doubt", pa.int32())]))
_DOUBTS = pa.list_(pa.struct([("node", pa.int32()), ("chars", pa.int64()), ("links", pa.int64()), ("talk", pa.bool_())]))


def _shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["page_id", "url", "host", "kind", "skeleton", "main", "blocks", "doubts", "total"]
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            part = batch.slice(lo, 256)
            shapes = [shape(source) for source in part.column(3).to_pylist()]
            kinds = [_hash(s) for s, _ in shapes]
            blocks = [[{"node": b[0], "text": b[1], "hash": _hash(b[1]), "doubt": b[2]} for b in found] for _, found in shapes]
            doubt = [[{"node": k, "chars": c, "links": n, "talk": t} for k, (c, n, t) in doubts(found).items()] for _, found in shapes]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).cast(pa.int64()),
                    part.column(1),
                    part.column(2),
                    pa.array(kinds, pa.int64()),
                    pa.array([s for s, _ in shapes], pa.string()),
                    pa.array([_hash("\n".join(b[1] for b in found)) for _, found in shapes], pa.int64()),
                    pa.array(blocks, _BLOCKS),
                    pa.array(doubt, _DOUBTS),
                    pa.array([sum(len(b[1]) for b in found) for _, found in shapes], pa.int64()),
                ],
                names=names,
            )


def _induce(group: pa.Table) -> pa.Table:
    """Skeletons of one deal -> the slot of each node; the first row of a wrapper carries its tree."""
    rows = sorted(group.to_pylist(), key=lambda r: (-r["n"], r["skeleton"]))
    slots, wrappers = induce([r["skeleton"] for r in rows])
    trees = {w.name: _write(w.tree) for w in wrappers}
    flat = [(r, i, w, x, trees.pop(w, (None, None))) for r, (w, own) in zip(rows, slots, strict=True) for i, x in enumerate(own)]
    return pa.table(
        {
            "host": pa.array([f[0]["host"] for f in flat], pa.string()),
            "kind": pa.array([f[0]["kind"] for f in flat], pa.int64()),
            "node": pa.array([f[1] for f in flat], pa.int32()),
            "deal": pa.array([f[0]["deal"] for f in flat], pa.int32()),
            "part": pa.array([f[2] for f in flat], pa.int32()),
            "own": pa.array([f[3] for f in flat], pa.int32()),
            "tree": pa.array([f[4][0] for f in flat], pa.string()),
            "order": pa.array([f[4][1] for f in flat], pa.list_(pa.int32())),
        }
    )


def _merge(group: pa.Table) -> pa.Table:
    """The wrappers of a host's deals, folded into each other -> the slot that each of their slots becomes."""
    rows = sorted(group.to_pylist(), key=lambda r: (r["deal"], r["part"]))
    slots, _ = induce([r["tree"] for r in rows])
    flat = [(r, own, w, x) for r, (w, new) in zip(rows, slots, strict=True) for own, x in zip(r["order"], new, strict=True)]
    return pa.table(
        {
            "host": pa.array([f[0]["host"] for f in flat], pa.string()),
            "deal": pa.array([f[0]["deal"] for f in flat], pa.int32()),
            "part": pa.array([f[0]["part"] for f in flat], pa.int32()),
            "own": pa.array([f[1] for f in flat], pa.int32()),
            "wrapper": pa.array([f[2] for f in flat], pa.int32()),
            "slot": pa.array([f"{f[2]}.{f[3]}" for f in flat], pa.string()),
        }
    )


def align(shapes: DataFrame, staging: Staging) -> DataFrame:
    """``host, kind, node, wrapper, slot``: the wrapper slot of each node of each distinct skeleton of a host."""
    kinds = staging.put(shapes.groupBy("host", "kind").agg(F.count(F.lit(1)).alias("n"), F.min("skeleton").alias("skeleton")), "kinds")
    deals = kinds.groupBy("host").agg(F.ceil(F.count(F.lit(1)) / KINDS).cast("int").alias("deals"))
    dealt = kinds.join(deals, "host").withColumn("deal", F.pmod("kind", F.col("deals")).cast("int")).drop("deals")
    columns = "host string, kind long, node int, deal int, part int, own int, tree string, order array<int>"
    folded = staging.put(dealt.groupBy("host", "deal").applyInArrow(_induce, columns), "folded")
    trees = folded.where("tree is not null").select("host", "deal", "part", "tree", "order")
    merged = trees.groupBy("host").applyInArrow(_merge, "host string, deal int, part int, own int, wrapper int, slot string")
    return staging.put(folded.drop("tree", "order").join(merged, ["host", "deal", "part", "own"]).select("host", "kind", "node", "wrapper", "slot"), "aligned")


def induce_templates(shapes: DataFrame, staging: Staging) -> DataFrame:
    """``host, kind, template, verdicts``: by skeleton, the (node, text hash) that are template, and the suspects judged."""
    some = shapes.where("total > 0")
    aligned = align(some, staging)
    # pages of a wrapper that differ; copies of a page show nothing about what is constant
    wrapper = aligned.where("node = 0").select("host", "kind", "wrapper")
    aligned = aligned.drop("wrapper")
    lean = some.select(
        "host", "kind", "main", "total", "doubts", F.array_distinct(F.transform("blocks", lambda b: F.struct(b["node"].alias("node"), b["hash"].alias("text")))).alias("slots")
    )
    differ = lean.join(wrapper, ["host", "kind"]).groupBy("host", "wrapper", "main").agg(F.min(F.struct("kind", "total", "slots", "doubts")).alias("page"))
    differ = staging.put(differ.select("host", "wrapper", "main", "page.*"), "differ")
    texts = differ.select("host", "wrapper", "main", "kind", F.explode("slots").alias("s")).select("host", "wrapper", "main", "kind", "s.node", "s.text")
    texts = staging.put(texts.join(aligned, ["host", "kind", "node"]).select("host", "slot", "text", "main").distinct(), "texts")
    # pages of a slot, counted without collecting them: one row a page and slot, then one a slot
    had = texts.select("host", "slot", "main").distinct().groupBy("host", "slot").agg(F.count(F.lit(1)).alias("pages")).where(F.col("pages") >= DISTINCT)
    constant = (
        texts.groupBy("host", "slot", "text")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= DISTINCT)
        .join(had, ["host", "slot"])
        .where("n = pages")
        .select("host", "slot", "text")
    )
    template = aligned.join(constant, ["host", "slot"]).groupBy("host", "kind").agg(F.collect_list(F.struct("node", F.col("text").alias("hash"))).alias("template"))
    judged = (
        differ.select("host", "kind", "total", F.explode("doubts").alias("d"))
        .select("host", "kind", "total", "d.*")
        .join(aligned, ["host", "kind", "node"])
        .groupBy("host", "slot")
        .agg(F.count(F.lit(1)).alias("pages"), F.sum("chars").alias("chars"), F.sum("links").alias("links"), F.sum("total").alias("total"), F.max("talk").alias("talk"))
        .where(F.col("pages") >= DISTINCT)
        .select("host", "slot", _cleared(*map(F.col, ("chars", "links", "talk", "total"))).alias("keep"))
    )
    verdicts = aligned.join(judged, ["host", "slot"]).groupBy("host", "kind").agg(F.map_from_entries(F.collect_list(F.struct("node", "keep"))).alias("verdicts"))
    both = staging.put(template.join(verdicts, ["host", "kind"], "full"), "template")
    staging.drop("kinds", "folded", "aligned", "differ", "texts")
    return both


def _cleared(chars, links, talk, total):
    """``cleared`` as an expression."""
    return F.when(talk, chars >= total).otherwise((2 * chars >= total) & (2 * links < chars))


@tidy
def extract_main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for each row of ``pages`` (page_id, url, html)."""
    staging = Staging(pages.sparkSession, "html-extract")
    host = F.lower(F.coalesce(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))
    named = pages.select("page_id", "url", host.alias("host"), "html")
    shapes = staging.put(named.mapInArrow(_shapes, SHAPES), "shapes")
    joined = shapes.join(induce_templates(shapes, staging), ["host", "kind"], "left")

    def keep(d):  # the wrapper's verdict on a suspect, or the page's own
        return F.coalesce(F.try_element_at("verdicts", d["node"]), _cleared(d["chars"], d["links"], d["talk"], F.col("total")))

    kept = F.transform(F.filter("doubts", keep), lambda d: d["node"])
    template = F.coalesce("template", F.expr("array()").cast("array<struct<node:int,hash:bigint>>"))
    joined = joined.withColumns({"kept": kept, "template": template})
    text = F.filter(
        "blocks",
        lambda b: ((b["doubt"] < 0) | F.array_contains(F.col("kept"), b["doubt"]))
        & ~F.array_contains(F.col("template"), F.struct(b["node"].alias("node"), b["hash"].alias("hash"))),
    )
    out = joined.select("page_id", "url", F.concat_ws("\n", F.transform(text, lambda b: b["text"])).alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("long"))
