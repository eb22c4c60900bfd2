"""HTML as a tree that forgives errors, and simple tree matching."""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter

import numpy as np

#: A comment, a declaration, or a tag: its slash, its name and its attributes. A quote opens a value only right after the equals
#: sign; elsewhere, and within a value without quotes, it is a character like others. Nothing is tried twice.
TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+)?+)*+)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=/][^\s=/]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s]*+)))?+")
#: Fixed values of HTML: elements without content, with raw text, that end a paragraph, and what each closes when it starts.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template".split())
BLOCK = frozenset("address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead title tr ul".split())
INLINE_SCOPE = frozenset("table td th caption button article section div main body html".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "body": ("head",)}
ENDS_P = BLOCK - frozenset("br option select caption td th tr tbody thead tfoot head html body title legend summary".split())
#: Fixed values of HTML and ARIA: elements and roles that are no part of an article by their meaning.
CHROME_TAGS = frozenset("nav aside footer form script style head title noscript iframe template select textarea menu dialog input".split())
CHROME_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
#: Class and id names of what is no article. A name counts as a whole, or if its other parts say only where or how large
#: something is. They mark containers; of the names of text elements only those of adverts do.
CHROME_NAMES = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs header masthead topbar footer sidebar aside ad ads adv advert adverts advertisement advertising banner promo promotion promotions sponsor sponsored sponsors "
    "cookie cookies consent gdpr notice notices notification notifications popup modal overlay newsletter subscribe subscription signup login search comment comments reply replies respond disqus "
    "share sharing social related recommended recommendations teaser teasers widget widgets pager pagination copyright toolbar".split()
)
ADVERT_NAMES = frozenset("ad ads advert adverts advertisement advertising sponsored".split())
NEUTRAL_NAMES = frozenset("list box boxes wrapper wrap container block blocks section area bar left right top bottom site page global inner outer slot unit item items link links button buttons post posts form panel row col column main primary secondary large small mobile desktop group".split())
CONTAINER_TAGS = frozenset("div section article ul ol dl table details header center fieldset blockquote".split())
_NAME_PARTS = re.compile(r"[a-z]+|[A-Z]+[a-z]*")
#: Child lists whose sizes multiply to more than this, once equal ends are paired, are aligned before their subtrees are matched.
MATCH_CELLS = 4096


def named_chrome(tag: str, names: list[str]) -> bool:
    """Whether class or id names say that an element isn't of the article."""
    wanted = CHROME_NAMES if tag in CONTAINER_TAGS else ADVERT_NAMES
    for name in names:
        parts = [p.lower() for p in _NAME_PARTS.findall(name)]
        if any(p in wanted for p in parts) and all(p in CHROME_NAMES or p in NEUTRAL_NAMES for p in parts):
            return tag not in ("body", "html", "main")
    return False


class Node:
    """An element: tag, a signature that same-host pages share, children (nodes and texts), whether it is chrome by its meaning, and whether its names say so.

    paragraph: the open <p> that a block element in this one would end.
    """

    __slots__ = ("tag", "sign", "kids", "chrome", "named", "up", "paragraph")

    def __init__(self, tag: str, sign: str, chrome: bool, up: Node | None, named: bool = False):
        self.tag, self.sign, self.chrome, self.up, self.named, self.kids = tag, sign, chrome, up, named, []
        self.paragraph = self if tag == "p" else None if up is None or tag in INLINE_SCOPE else up.paragraph

    def nodes(self) -> list[Node]:
        """The children that are elements and no chrome."""
        return [k for k in self.kids if isinstance(k, Node) and not k.chrome]

    def elements(self):
        """This node and all below it that isn't chrome, in page order."""
        todo = [self]
        while todo:
            node = todo.pop()
            yield node
            todo += [k for k in reversed(node.kids) if isinstance(k, Node) and not k.chrome]


def digest(text: str) -> int:
    """64 bits of a hash of a text, as a signed number."""
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _marks(attributes: str, tag: str) -> tuple[list[str], bool, bool]:
    """Of a tag's attributes: the first class names, whether its role is chrome, and whether its class or id names are."""
    marks, chrome, named, seen = [], False, False, set()
    for a in ATTRIBUTE.finditer(attributes):
        kind = a[1].lower()
        if kind not in ("class", "id", "role") or kind in seen:
            continue
        seen.add(kind)
        value = next((x for x in a.groups()[1:] if x is not None), "")
        if kind == "class":
            marks = value.split()[:2]
        if kind == "role":
            chrome = value.strip().lower() in CHROME_ROLES and tag not in ("body", "html")
        else:
            named = named or named_chrome(tag, value.split())
    return marks, chrome, named


def parse(source: str) -> Node:
    """The tree of a page. Unclosed and misplaced tags are mended roughly as browsers do; nothing is an error.

    Tags that are open are counted, so the tree is climbed only to what is there, and each step up is a step that was made down.
    """
    root = Node("#", "#", False, None)
    here, at, size = root, 0, len(source)
    open_: Counter[str] = Counter()

    def leave(node: Node) -> Node:
        """Closes all that is open up to a node, and says what is around it."""
        x = here
        while x is not node.up:
            open_[x.tag] -= 1
            x = x.up
        return x

    while at < size:
        m = TAG.search(source, at)
        if m is None:
            here.kids.append(source[at:])
            break
        if m.start() > at:
            here.kids.append(source[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            if open_[tag]:
                node = here
                while node.tag != tag:
                    node = node.up
                here = leave(node)
            elif tag in BLOCK:
                here.kids.append(Node("br", "br", False, here))
            continue
        if tag in ENDS_P and here.paragraph is not None:
            here = leave(here.paragraph)
        for other in CLOSES.get(tag, ()):
            node = here if open_[other] else root
            while node.up and node.tag != other and node.tag not in ("ul", "ol", "dl", "table", "select", "body"):
                node = node.up
            if node.tag == other:
                here = leave(node)
        marks, role, named = _marks(m[3], tag) if "=" in m[3] else ([], False, False)
        chrome = role or tag in CHROME_TAGS or tag == "header" and not open_["article"]
        node = Node(tag, ".".join([tag, *marks]), chrome, here, named)
        here.kids.append(node)
        if tag in RAW and not m[3].endswith("/"):
            end = re.compile(f"</{re.escape(tag)}[^>]*(?:>|\\Z)", re.I).search(source, at)
            node.kids.append(source[at : end.start() if end else size])
            at = end.end() if end else size
        elif tag not in VOID and not m[3].endswith("/"):
            here = node
            open_[tag] += 1
    return root


def text_of(node: Node, skip=None) -> str:
    """The text below a node without chrome: references decoded, white space as single spaces, blocks apart. skip(node): leave the node out."""
    out: list[str] = []

    todo: list = [node]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            out.append(html.unescape(x) if "&" in x else x)
        else:
            if x.tag in BLOCK:
                out.append(" ")
            if x.chrome and x is not node or skip is not None and skip(x):
                continue
            if x.tag in BLOCK:
                todo.append(" ")
            todo += reversed(x.kids)
    return " ".join("".join(out).split())


def containers(root: Node) -> set[int]:
    """The ids of the elements with a block element below them."""
    out: set[int] = set()
    for node in root.elements():
        if node.tag in BLOCK and node.tag != "br":
            up = node.up
            while up is not None and id(up) not in out:
                out.add(id(up))
                up = up.up
    return out


def block_text(node: Node) -> str:
    """The text of a block without blocks in it, its inline elements included; empty for other nodes."""
    if node.tag not in BLOCK or any(n.tag in BLOCK and n.tag != "br" for n in node.elements() if n is not node):
        return ""
    return text_of(node)


class Shape:
    """A tree for matching. Neighbours of one signature, with containers of the same signatures in them, are one shape, as lists of any length are.

    ident tells the shapes of a wrapper apart; a page's have none. `among`: only elements with these ids are taken.
    """

    __slots__ = ("sign", "ident", "kids", "nodes", "size", "key")

    def __init__(self, nodes: list[Node], ident: str = "", among: set[int] | None = None):
        self.nodes, self.sign, self.ident = nodes, nodes[0].sign, ident
        inner = containers(nodes[0]) if among is None else among
        todo = [self]
        for shape in todo:
            shape.kids, run, within = [], [], None
            for k in (k for n in shape.nodes for k in n.nodes() if among is None or id(k) in among):
                parts = {x.sign for x in k.nodes() if id(x) in inner}
                if run and (run[-1].sign != k.sign or parts != within):
                    shape.kids.append(Shape._of(run))
                    run = []
                run.append(k)
                within = parts
            if run:
                shape.kids.append(Shape._of(run))
            todo += shape.kids
        self.measure()

    @classmethod
    def _of(cls, nodes: list[Node]) -> Shape:
        return cls.made(nodes[0].sign, "", nodes)

    @classmethod
    def made(cls, sign: str, ident: str, nodes: list[Node] | None = None) -> Shape:
        out = cls.__new__(cls)
        out.sign, out.ident, out.nodes, out.kids, out.size, out.key = sign, ident, nodes or [], [], 1, 0
        return out

    def all(self) -> list[Shape]:
        """This shape and all below it, each before its children."""
        out = [self]
        for shape in out:
            out += shape.kids
        return out

    def measure(self) -> None:
        """Counts the shapes, and makes keys that are equal for equal trees."""
        for shape in reversed(self.all()):
            shape.size = 1 + sum(k.size for k in shape.kids)
            shape.key = hash((shape.sign, tuple(k.key for k in shape.kids)))


def _ends(a: list[Shape], b: list[Shape]) -> tuple[int, int]:
    """How many equal trees two lists start and end with."""
    most = min(len(a), len(b))
    head = next((i for i in range(most) if a[i].key != b[i].key), most)
    tail = next((i for i in range(most - head) if a[-1 - i].key != b[-1 - i].key), most - head)
    return head, tail


def match(a: Shape, b: Shape) -> tuple[int, list[tuple[Shape, Shape]]]:
    """Simple tree matching: the most nodes that pair up with order and ancestors kept, and the pairs.

    Equal trees at the ends of two child lists are paired as they are. What is left is matched by dynamic programming over
    the scores of all pairs of subtrees; where that would take over MATCH_CELLS pairs, over scores that are known before these
    are matched: an equal tree its size, another of the same signature 1. So long lists are aligned as a whole too.
    """
    if a.sign != b.sign:
        return 0, []
    known: dict[tuple[int, int], tuple[int, list[tuple[Shape, Shape]]]] = {}
    aligned: dict[tuple[int, int], list[tuple[Shape, Shape]]] = {}

    def middle(x: Shape, y: Shape) -> tuple[list[Shape], list[Shape], list[tuple[Shape, Shape]]]:
        head, tail = _ends(x.kids, y.kids)
        m, n = len(x.kids), len(y.kids)
        same = [*zip(x.kids[:head], y.kids[:head], strict=True), *zip(x.kids[m - tail :], y.kids[n - tail :], strict=True)]
        return x.kids[head : m - tail], y.kids[head : n - tail], same

    todo = [(a, b)]
    while todo:
        x, y = todo[-1]
        if (id(x), id(y)) in known:
            todo.pop()
            continue
        left, right, same = middle(x, y)
        if len(left) * len(right) > MATCH_CELLS:
            pairs = aligned.get((id(x), id(y)))
            if pairs is None:
                pairs = aligned[id(x), id(y)] = _aligned(left, right)
        else:
            pairs = [(p, q) for p in left for q in right if p.sign == q.sign]
        open_ = [(p, q) for p, q in pairs if (id(p), id(q)) not in known and p.kids and q.kids]
        if open_:
            todo += open_
            continue
        score = lambda p, q: known[id(p), id(q)][0] if p.kids and q.kids else 1
        if len(left) * len(right) <= MATCH_CELLS:
            pairs = _best(left, right, {(id(p), id(q)): score(p, q) for p, q in pairs})
        known[id(x), id(y)] = 1 + sum(p.size for p, _ in same) + sum(score(p, q) for p, q in pairs), same + pairs
        todo.pop()
    out, rest = [], [(a, b)]
    while rest:
        x, y = rest.pop()
        out.append((x, y))
        if (id(x), id(y)) in known:
            rest += reversed(known[id(x), id(y)][1])
        elif x.key == y.key:
            rest += zip(reversed(x.kids), reversed(y.kids), strict=True)
    return known[id(a), id(b)][0], out


def _aligned(left: list[Shape], right: list[Shape]) -> list[tuple[Shape, Shape]]:
    """The pairs of two long lists, in order, with the highest sum of scores, in memory of their length: the left list is halved, and where the right one is cut follows from the best sums from both ends."""
    signs: dict[str, int] = {}
    table = [np.array([(signs.setdefault(x.sign, len(signs)), x.key, x.size) for x in side], np.int64).reshape(-1, 3) for side in (left, right)]

    def sums(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        row = np.zeros(len(b) + 1, np.int64)
        for sign, key, size in a:
            own = np.where(b[:, 0] == sign, np.where(b[:, 1] == key, size, 1), 0)
            row[1:] = np.maximum.accumulate(np.maximum(row[1:], row[:-1] + own))
        return row

    out, todo = [], [(0, len(left), 0, len(right))]
    while todo:
        a, b, c, d = todo.pop()
        if a == b or c == d:
            continue
        if b - a == 1:
            own = np.where(table[1][c:d, 0] == table[0][a, 0], np.where(table[1][c:d, 1] == table[0][a, 1], table[0][a, 2], 1), 0)
            if own.any():
                out.append((left[a], right[c + int(own.argmax())]))
            continue
        half = (a + b) // 2
        cut = c + int((sums(table[0][a:half], table[1][c:d]) + sums(table[0][half:b][::-1], table[1][c:d][::-1])[::-1]).argmax())
        todo += [(half, b, cut, d), (a, half, c, cut)]
    return out


def _best(left: list[Shape], right: list[Shape], scores: dict[tuple[int, int], int]) -> list[tuple[Shape, Shape]]:
    """The pairs of two lists, in order, with the highest sum of scores."""
    m, n = len(left), len(right)
    best = [[0] * (n + 1) for _ in range(m + 1)]
    for i in range(m):
        for j in range(n):
            own = scores.get((id(left[i]), id(right[j])), 0)
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + own if own else 0)
    out, i, j = [], m, n
    while i and j:
        if best[i][j] == best[i - 1][j]:
            i -= 1
        elif best[i][j] == best[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            out.append((left[i], right[j]))
    return out[::-1]


def grow(wrapper: Shape | None, page: Shape) -> Shape:
    """A host's wrapper with what a further page has that it lacks: pages are matched, and shapes without a partner are put beside those that have one."""
    if wrapper is None:
        wrapper = Shape.made(page.sign, str(digest(page.sign)))
    partner = {id(q): p for p, q in match(wrapper, page)[1]}
    for q in page.all():
        p = partner[id(q)]
        at = 0
        for k in q.kids:
            if id(k) in partner:
                at = next(i for i, x in enumerate(p.kids) if x is partner[id(k)]) + 1
                continue
            same = sum(x.sign == k.sign for x in p.kids)
            new = Shape.made(k.sign, str(digest(f"{p.ident}/{k.sign}#{same}")))
            partner[id(k)] = new
            p.kids.insert(at, new)
            at += 1
    wrapper.measure()
    return wrapper


def dump(wrapper: Shape) -> list[list]:
    """A wrapper as rows of depth, signature and ident."""
    out, todo = [], [(wrapper, 0)]
    while todo:
        shape, depth = todo.pop()
        out.append([depth, shape.sign, shape.ident])
        todo += [(k, depth + 1) for k in reversed(shape.kids)]
    return out


def load(rows: list[list]) -> Shape:
    """The wrapper that `dump` wrote."""
    line: list[Shape] = []
    for depth, sign, ident in rows:
        shape = Shape.made(sign, ident)
        del line[depth:]
        if line:
            line[-1].kids.append(shape)
        line.append(shape)
    line[0].measure()
    return line[0]


def slots(root: Node, wrapper: Shape | None) -> dict[int, int]:
    """The slot of each element by its id: where it stands in the wrapper.

    Containers are aligned with the wrapper by tree matching. Text elements, and containers without a partner, share a slot
    with those of their signature under one parent slot.
    """
    inside = containers(root)
    partner: dict[int, str] = {}
    if wrapper is not None:
        for page, own in match(Shape([root], "", inside), wrapper)[1]:
            partner.update((id(n), own.ident) for n in page.nodes)
    out: dict[int, int] = {}
    known: dict[tuple[int, str], int] = {}
    for node in root.elements():
        if id(node) in partner:
            out[id(node)] = int(partner[id(node)])
            continue
        key = (out[id(node.up)] if node.up else 0, node.sign)
        if key not in known:
            known[key] = digest(f"{key[0]}/{key[1]}")
        out[id(node)] = known[key]
    return out
