"""Pages as small trees of text blocks, aligned by simple tree matching."""

from __future__ import annotations

import html as entities
import re
from collections import Counter

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<[!?][^>]*>?""", re.S)
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_SPACE = re.compile(r"\s+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset("html body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form "
                  "h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol p pre section summary table tbody td tfoot th thead "
                  "tr ul caption option select".split())
# Elements that hold no main text wherever they stand.
DROPPED = frozenset("script style noscript template head title nav footer aside form button select option textarea input iframe object "
                    "embed svg math canvas audio video dialog menu map noembed noframes".split())
REGION = frozenset(("article", "main"))
# An open element of the first kind ends where one of the second begins.
ENDS = {"p": BLOCK - {"html", "body"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"},
        "th": {"td", "th", "tr"}, "option": {"option"}}
_KEEPS = frozenset(("", "table", "ul", "ol", "dl", "div", "article", "section", "main", "body", "blockquote"))
# Parts of class and id names by which authors mark what is not the article, and what is.
ASIDE = frozenset("ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies "
                  "consent disqus footer header masthead menu modal nav navbar navigation newsletter notice notices notification "
                  "pagination pager popup promo promoted related replies reply respond share sharing sidebar signup social sponsor sponsored "
                  "subscribe toolbar widget widgets disclaimer alert".split())
INSIDE = frozenset("article story entry post".split())
_NAME = re.compile(r"[^a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")


def _names(attrs: dict[str, str]) -> list[list[str]]:
    """The parts of each class name and of the id."""
    return [[p for p in _NAME.split(_CAMEL.sub("-", name).lower()) if p] for name in f"{attrs.get('class', '')} {attrs.get('id', '')}".split()]


def _is_aside(tag: str, attrs: dict[str, str], in_region: bool) -> bool:
    if tag in DROPPED or (tag == "header" and not in_region):
        return True
    if not attrs or tag in ("html", "body"):
        return False
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in attrs.get("style", "").replace(" ", "").lower():
        return True
    if attrs.get("role") in ("navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "form", "menu"):
        return True
    if tag in REGION:
        return False
    return any(n and n[0] not in ("no", "has", "with", "without") and (n[0] in ASIDE or n[-1] in ASIDE) for n in _names(attrs))


def _is_region(tag: str, attrs: dict[str, str]) -> bool:
    return (tag in REGION or attrs.get("role") in ("main", "article") or attrs.get("itemprop") == "articleBody"
            or any(n in (["article"], ["story"], ["content"]) or n[:1] and n[0] in INSIDE and n[-1] in ("body", "content", "text") for n in _names(attrs)))


def _clean(parts: list[str]) -> str:
    return _SPACE.sub(" ", "".join(parts)).strip()


def parse(page: str) -> tuple[str, list]:
    """(title, tree) of a page. A node is [label, whether it is an article's own element, children], a block of text is
    [None, text, characters of it inside links]. Elements that cannot hold main text are left out with all they hold.

    Tags are read leniently, as browsers do: ends may be missing, an end without a start is skipped, references are decoded,
    comments, scripts and styles are no text. White space in a block is one space; a line break is white space.
    """
    root: list = ["root", False, []]
    # open elements: tag, node (None for inline ones), what is left out, inside a region, inside a link
    stack: list[tuple] = [("", root, False, False, False)]
    open_now: Counter = Counter()
    title: list[str] = []
    text: list[str] = []
    links = 0

    def flush():
        nonlocal links
        if text:
            block = _clean(text)
            if block:
                holder = next(e[1] for e in reversed(stack) if e[1] is not None)
                holder[2].append([None, block, min(links, len(block))])
            text.clear()
        links = 0

    def add(raw: str):
        nonlocal links
        if raw and not stack[-1][2]:
            raw = entities.unescape(raw) if "&" in raw else raw
            text.append(raw)
            if stack[-1][4]:
                links += len(raw)

    def close():
        if stack[-1][1] is not None:
            flush()
        open_now[stack.pop()[0]] -= 1

    at, end = 0, len(page)
    while at < end:
        m = _TAG.search(page, at)
        add(page[at:m.start() if m else end])
        if not m:
            break
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if open_now[tag] > 0:
                while stack[-1][0] != tag:
                    close()
                close()
            elif tag in BLOCK:
                flush()
            continue
        attrs = {}
        if m[3].strip(" /\n"):
            attrs = {k.lower(): entities.unescape(v.strip("\"'")) for k, v in _ATTR.findall(m[3])}
        if tag in RAW:
            closing = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(page, at)
            if tag == "title" and not title:
                title.append(_clean([entities.unescape(page[at:closing.start() if closing else end])]))
            at = closing.end() if closing else end
            continue
        if tag in BLOCK:
            while any(open_now[t] > 0 and tag in ends for t, ends in ENDS.items()) and _ends_here(stack, tag):
                close()
            flush()
        if tag in VOID:
            if tag in ("br", "hr", "wbr"):
                add(" " if tag == "br" else "")
            continue
        _, _, gone, region, link = stack[-1]
        gone = gone or _is_aside(tag, attrs, region)
        node = None
        own = not gone and _is_region(tag, attrs)
        if tag in BLOCK or gone != stack[-1][2]:
            flush()
            node = [f"{tag}.{attrs['class']}" if "class" in attrs else tag, own, []]
            if not gone:
                next(e[1] for e in reversed(stack) if e[1] is not None)[2].append(node)
        open_now[tag] += 1
        stack.append((tag, node, gone, region or own, link or tag == "a"))
    while len(stack) > 1:
        close()
    flush()
    return "".join(title), root


def _ends_here(stack: list[tuple], tag: str) -> bool:
    """Whether an open element ends where ``tag`` begins, looking down to the nearest that keeps such ends inside it."""
    for e in reversed(stack):
        if e[0] in ENDS and tag in ENDS[e[0]]:
            return True
        if e[0] in _KEEPS:
            return False
    return False


def dump(tree: list) -> list:
    """A tree as a flat list: depth, then what a node or block has. Trees may be deeper than Python recurses."""
    out, todo = [], [(0, tree)]
    while todo:
        depth, node = todo.pop()
        out.append([depth, *node] if node[0] is None else [depth, node[0], node[1]])
        if node[0] is not None:
            todo += [(depth + 1, c) for c in reversed(node[2])]
    return out


def load(rows: list) -> list:
    """The tree that ``dump`` has written."""
    path: list[list] = []
    for depth, *node in rows:
        if node[0] is not None:
            node.append([])
        del path[depth:]
        if path:
            path[-1][2].append(node)
        path.append(node)
    return path[0]


def blocks(tree: list) -> list[tuple[list, bool]]:
    """Text blocks in page order, and whether each lies in an element that is an article's own."""
    out, todo = [], [(tree, False)]
    while todo:
        node, inside = todo.pop()
        if node[0] is None:
            out.append((node, inside))
        else:
            todo += [(c, inside or node[1]) for c in reversed(node[2])]
    return out


def _known_size(node: list) -> int:
    """How many nodes match in two nodes of one label and this kind: a text block, or a node around one and nothing else.
    0 for any other node."""
    return 1 if node[0] is None else 2 if len(node[2]) == 1 and node[2][0][0] is None else 0


def match(a: list, b: list) -> list[tuple[list, list]]:
    """Pairs of text blocks of two trees that simple tree matching aligns.

    Two nodes match only with equal labels, and their children only in order: the greatest number of matched nodes comes
    from dynamic programming over both lists of children, with the numbers of the pairs below found first. Deep trees are
    walked without recursion of the language.
    """
    if a[0] != b[0]:
        return []
    weight: dict[tuple[int, int], int] = {}
    grids: dict[tuple[int, int], list[list[int]]] = {}
    todo: list[tuple[list, list, bool]] = [(a, b, False)]
    while todo:
        x, y, ready = todo.pop()
        key = (id(x), id(y))
        if key in weight:
            continue
        if x[0] is None:
            weight[key] = 1
            continue
        xs, ys = x[2], y[2]
        if not ready:
            todo.append((x, y, True))
            sizes = [_known_size(d) for d in ys]
            for c in xs:
                label, size = c[0], _known_size(c)
                todo += [(c, d, False) for d, n in zip(ys, sizes, strict=True)
                         if d[0] == label and not (size and size == n) and (id(c), id(d)) not in weight]
            continue
        before = [0] * (len(ys) + 1)
        grid = [before]
        inner = [(id(d), d[0], _known_size(d)) for d in ys]
        for c in xs:
            row, left, label, mine, size = [0], 0, c[0], id(c), _known_size(c)
            for j, (other, name, n) in enumerate(inner):
                best = before[j + 1] if before[j + 1] > left else left
                if name == label and (w := before[j] + (size if size and size == n else weight[mine, other])) > best:
                    best = w
                row.append(best)
                left = best
            grid.append(row)
            before = row
        grids[key] = grid
        weight[key] = 1 + before[-1]
    pairs, open_pairs = [], [(a, b)]
    while open_pairs:
        x, y = open_pairs.pop()
        if x[0] is None:
            pairs.append((x, y))
            continue
        if (id(x), id(y)) not in grids:
            # each has one text block and nothing else
            pairs.append((x[2][0], y[2][0]))
            continue
        grid, i, j = grids[id(x), id(y)], len(x[2]), len(y[2])
        while i and j:
            if grid[i][j] == grid[i - 1][j]:
                i -= 1
            elif grid[i][j] == grid[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                open_pairs.append((x[2][i], y[2][j]))
    return pairs
