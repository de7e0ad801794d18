"""HTML extraction with wrappers: union-free expressions inferred for each host.

A page becomes a stream of tags and texts. Streams of a host's pages are aligned
with the wrapper so far: equal tags and texts stay, different texts become slots,
stretches that one side lacks become optional groups, and stretches that repeat
at once become repeated groups. All distinct pages of a host take part: pages are
aligned to partial wrappers of about ``FAN`` pages, these to partial wrappers of
``FAN`` of them, and so on, so a host with a third of all pages spreads over many
tasks at each step.

What a wrapper says of a host is the container that holds the text of its slots,
the containers that the changing text of single pages votes for (a host may have
several templates), and the texts that most pages show, by counts over all pages.
These choose the text of every page of the host; article and main elements are
evidence for and after that choice, and the only rule for hosts without a wrapper.
A text that most pages show is left out where it stands before or after all of the
page's own text; between texts of the page's own in the main container, or as a
heading before them, it is part of the article. The page's own headline before
the main container goes with it.

Streams leave the first pass as skeletons: tags, and a hash and a length for each
text.
"""

from __future__ import annotations

import html as references
import json
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import lru_cache
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.store import removed, stored, text_or_empty

#: Wrappers that one step aligns, on average; the steps are as many as the largest host needs.
FAN = 32
#: Share of the changing text that the main container holds.
MAIN_SHARE = 0.8
#: Share of a page's own text that a container of the host must hold to be the page's; of one in an article.
PAGE_SHARE, MARKED_SHARE = 0.5, 0.25
#: Pages that tell a constant text from a coincidence, besides being most of those with its container.
SHOWN = 3
#: Bytes of wrappers that are broadcast; more are joined by shuffle.
BROADCAST_BYTES = 16 << 20

#: Fixed values of the language: elements by what they mean for the text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "search section summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes".split())
HIDDEN = frozenset(
    "script style head title nav aside footer form noscript template iframe svg math select button textarea object "
    "canvas audio video menu dialog search datalist".split()
)
CONTAINERS = frozenset("html body main article section div td table center".split())
_ASIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion menu nav navbar "
    "navigation sidebar footer header masthead cookie cookies consent notice notices gdpr popup modal overlay "
    "newsletter subscribe signup login share sharing social comment comments respond disqus related recommended "
    "breadcrumb breadcrumbs pagination toolbar widget alert".split()
)
#: Pieces that may stand beside them in a name; a name with any other piece (has-sidebar, entry-header) says nothing.
_BESIDE = frozenset("site top bottom left right global area slot box bar list links buttons posts".split())
#: Names that set nothing apart inside an article, where they hold its title.
_HEADS = frozenset("header masthead banner".split())
#: Names that set apart even an article, as a reader's comment is one.
_NEVER = frozenset(
    "comment comments respond disqus ad ads advert adverts advertisement advertising cookie cookies consent notice "
    "notices related recommended".split()
)
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[A-Za-z][^\s/>]*+)(?P<attrs>(?:=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|[^>])*?)(?:>|\Z)",
    re.S,
)
_ATTR = re.compile(r"(?<![\w-])(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)


def _named(value: str) -> set[str]:
    """The words of a class or id that set its element apart: only whole names count,
    each piece of which is such a word or may stand beside one."""
    out: set[str] = set()
    for name in value.lower().replace("side-bar", "sidebar").split():
        pieces = [x for x in re.split(r"[_-]", name) if x and not x.isdigit()]
        words = [x for x in pieces if x in _ASIDE_WORDS]
        if words and all(x in _ASIDE_WORDS or x in _BESIDE for x in pieces):
            out.update(words)
    return out


def _aside(name: str, attrs: str, inside: bool) -> tuple[bool, bool, bool, str]:
    """Whether an element is set apart by what it is, whether by a class or id, and
    whether even if it holds an article; and its class in the path."""
    if not attrs or attrs.isspace():
        return name in HIDDEN, False, False, ""
    hard, words, first = name in HIDDEN, set(), ""
    for key, *values in _ATTR.findall(attrs):
        key, value = key.lower(), next((v for v in values if v), "")
        if key == "hidden" and name not in ("article", "main", "body", "html"):
            hard = True
        elif key == "aria-hidden" and value.lower() == "true":
            hard = True
        elif key == "role" and value.lower() in _ROLES:
            hard = True
        elif key in ("class", "id"):
            if key == "class" and value.strip():
                first = re.sub(r"[\d/!]+", "#", value.split()[0])
            if name not in ("body", "html", "main"):
                words |= _named(value)
    if name == "article":
        words &= _NEVER
    elif inside:
        words -= _HEADS
    return hard, bool(words), bool(words & _NEVER), first


def blocks(page: str) -> list[tuple[str, str, bool, str]]:
    """(path of containers, block element, aside, text) for each block of text of
    ``page``, and ('', tag, ...) entries with empty text where a block element opens
    ('<name') or closes ('</name'). Elements that a class or id sets apart are in the
    path with a '!', unless they hold the only articles of the page, with more text
    than is outside."""
    out, plain, within = _parsed(page, frozenset())
    if plain or not within:
        return out
    other = _parsed(page, frozenset(within))[0]
    whole, more = (sum(len(x[3]) for x in y if not x[2] and "!" not in x[0]) for y in (out, other))
    return other if more > 2 * whole else out


def _parsed(page: str, cleared: frozenset[int]) -> tuple[list[tuple[str, str, bool, str]], bool, set[int]]:
    """The blocks; whether an article is not set apart; and the places of the
    elements that classes set apart and that hold an article. Those in ``cleared``
    are not set apart."""
    out: list[tuple[str, str, bool, str]] = []
    stack: list[tuple[str, bool, bool, str, tuple[int, ...] | None]] = []  # name, aside, article, piece of path, soft
    names: Counter = Counter()  # of the stack
    text: list[str] = []
    at = 0
    plain, within = False, set()

    def push(*item):
        stack.append(item)
        names[item[0]] += 1

    def pop():
        names[stack.pop()[0]] -= 1

    def flush():
        if text:
            joined = "".join(text)
            text.clear()
            if "&" in joined:
                joined = references.unescape(joined)
            clean = " ".join(joined.split())
            if clean:
                path = "/".join(x[3] for x in stack if x[3])
                out.append((path, stack[-1][0], stack[-1][1], clean) if stack else (path, "", False, clean))

    while True:
        m = _TOKEN.search(page, at)
        if m is None:
            text.append(page[at:])
            flush()
            return out, plain, within
        if m.start() > at:
            text.append(page[at : m.start()])
        begin, at = m.start(), m.end()
        name = m["name"]
        if name is None:
            if m["cdata"]:
                text.append(m["cdata"])
            continue
        name = name.lower()
        if m["close"]:
            if name in BLOCKS or names[name]:
                flush()
                out.append(("", f"</{name}", False, ""))
                # A closing tag without its opening one closes nothing.
                if names[name]:
                    while stack[-1][0] != name:
                        pop()
                    pop()
            continue
        attrs = m["attrs"]
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if name == "br":
            text.append(" ")
            continue
        if name in BLOCKS:
            flush()
            # A paragraph ends where a block begins, a list item where the next does.
            while stack and (stack[-1][0] == "p" or stack[-1][0] == name and name in ("li", "dt", "dd", "tr", "td", "th", "option")):
                pop()
        off, inside, held = (stack[-1][1], stack[-1][2], stack[-1][4]) if stack else (False, False, ())
        if name in VOID or attrs.endswith("/") and name not in BLOCKS:
            continue
        hard, soft, never, first = _aside(name, attrs, inside)
        hard = hard or name == "header" and not inside
        soft = soft and begin not in cleared
        # None: set apart by a class that holds for an article too.
        holds = None if soft and never or held is None else (*held, begin) if soft else held
        if name in BLOCKS:
            out.append(("", f"<{name}", off or hard, ""))
            article = name in ("article", "main") and not hard and not off
            if article:
                plain = plain or holds == ()
                within.update(holds or ())
            piece = name + ("." + first if first else "") if name in CONTAINERS or soft else ""
            push(name, off or hard, inside or article and holds == (), piece + "!" if soft else piece, holds)
        elif (hard or soft) and not off:
            # An inline element that is set apart: its text is a block of its own.
            flush()
            push(name, hard, inside, name + "!" if soft else "", holds)


def skeleton(page: str) -> list[list]:
    """The stream of ``page``: [tag] and [path, hash, length] for a text that is
    not set apart by its element."""
    out: list[list] = []
    for path, name, off, text in blocks(page):
        if not text:
            out.append([name])
        elif not off:
            out.append([path, _hash(text), len(text)])
    return out


def _hash(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


@lru_cache(10_000)
def _marked(path: str) -> bool:
    """Whether a text of ``path`` is in an article or main element."""
    return "!" not in path and any(x.split(".")[0] in ("article", "main") for x in path.split("/"))


def _under(path: str, main: str) -> bool:
    """Whether ``path`` is in the container ``main`` and not set apart inside it."""
    if main and path != main and not path.startswith(main + "/"):
        return False
    return "!" not in path[len(main) :]


def _form(item) -> str:
    """What an item must have in common with another to be aligned with it."""
    kind = item[0]
    if kind == "text":
        return f"#{item[1]}"
    if kind == "tag":
        return item[1]
    return f"{kind}({' '.join(_form(x) for x in item[1])})"


class _Siblings:
    """Subtrees and texts that lie side by side, with stretches that repeat at once
    made repeated groups, of any length: subtrees of equal form have equal numbers."""

    def __init__(self, forms: dict):
        self.forms, self.units = forms, []  # unit: its number, its items, whether it has text
        self.at: dict[int, list[int]] = {}  # places of units by number
        self.texts: list[int] = []  # places of units with text
        self.plus: list[tuple[int, list[int]]] = []  # place of each group, and its units' numbers

    def _cut(self, n: int) -> None:
        for unit in self.units[n:]:
            self.at[unit[0]].pop()
        del self.units[n:]
        while self.texts and self.texts[-1] >= n:
            self.texts.pop()
        while self.plus and self.plus[-1][0] >= n:
            self.plus.pop()

    def _put(self, unit: tuple[int, list, bool]) -> None:
        self.at.setdefault(unit[0], []).append(len(self.units))
        if unit[2]:
            self.texts.append(len(self.units))
        self.units.append(unit)

    def _group(self, at: int, items: list, inner: list[int]) -> None:
        number = self.forms.setdefault(("plus", *inner), len(self.forms))
        self._cut(at)
        self._put((number, [("plus", items)], True))
        self.plus.append((at, inner))

    def add(self, unit: tuple[int, list, bool]) -> None:
        self._put(unit)
        n = len(self.units)
        for at, inner in reversed(self.plus):
            tail = self.units[at + 1 :] if n - at - 1 == len(inner) else []
            if tail and [x[0] for x in tail] == inner:
                self._group(at, _merge(self.units[at][1][0][1], _items_of(tail)), inner)
                return
        # A group has text: it begins at the last unit with text or before.
        last = self.texts[-1] if self.texts else -1
        if 2 * (n - last) > n:
            return
        places = self.at[unit[0]]
        for k in range(min(bisect_left(places, last), len(places) - 1) - 1, -1, -1):
            size = n - 1 - places[k]
            if 2 * size > n:
                break
            if all(self.units[n - j][0] == self.units[n - size - j][0] for j in range(1, size + 1)):
                tail, before = self.units[n - size :], self.units[n - 2 * size : n - size]
                self._group(n - 2 * size, _merge(_items_of(before), _items_of(tail)), [x[0] for x in tail])
                return


def _items_of(units: list) -> list:
    return [item for unit in units for item in unit[1]]


def _fold(items: list) -> list:
    """``items`` with stretches that repeat at once made repeated groups, the inner
    ones first. An opening tag that nothing closes is a sibling of what follows."""
    forms: dict = {}
    stack: list[tuple[tuple | None, _Siblings]] = [(None, _Siblings(forms))]
    opened: Counter = Counter()

    def unit(item):
        return forms.setdefault(_form(item), len(forms)), [item], item[0] == "text"

    def leave(n):
        """Hand what is open above place ``n`` of the stack to its siblings."""
        for item, above in stack[n + 1 :]:
            opened[item[1]] -= 1
            stack[n][1].add(unit(item))
            for x in above.units:
                stack[n][1].add(x)
        del stack[n + 1 :]

    for item in items:
        if item[0] == "tag" and item[1].startswith("</"):
            name = "<" + item[1][2:]
            if not opened[name]:
                stack[-1][1].add(unit(item))
                continue
            leave(max(k for k in range(1, len(stack)) if stack[k][0][1] == name))
            opened[name] -= 1
            first, inner = stack.pop()
            parts = [unit(first), *inner.units, unit(item)]
            number = forms.setdefault(("tree", *(x[0] for x in parts)), len(forms))
            stack[-1][1].add((number, _items_of(parts), any(x[2] for x in parts)))
        elif item[0] == "tag":
            opened[item[1]] += 1
            stack.append((item, _Siblings(forms)))
        else:
            stack[-1][1].add(unit(item))
    leave(0)
    return _items_of(stack[0][1].units)


def _merge(a: list, b: list) -> list:
    """Items of equal forms as one: texts that differ become slots."""
    out = []
    for x, y in zip(a, b, strict=True):
        if x[0] == "text":
            constant = x[2] if x[2] == y[2] else None
            out.append(("text", x[1], constant, x[3] + y[3]))
        elif x[0] == "tag":
            out.append(x)
        else:
            out.append((x[0], _merge(x[1], y[1])))
    return out


def _flat(items: list) -> tuple[list, list]:
    """``items`` without optional groups, and the number of the group of each (0: none)."""
    out, groups = [], []
    for k, item in enumerate(items, 1):
        inner = item[1] if item[0] == "opt" else [item]
        out += inner
        groups += [k if item[0] == "opt" else 0] * len(inner)
    return out, groups


def align(a: list, b: list) -> list:
    """The wrapper of two wrappers: mismatches become slots or optional groups. What
    is optional on either side stays so, and is aligned like the rest."""
    (a, ga), (b, gb) = _flat(a), _flat(b)
    left, right = [_form(x) for x in a], [_form(x) for x in b]
    out: list = []
    last = None

    def add(items, keys):
        nonlocal last
        for item, key in zip(items, keys, strict=True):
            if key is None:
                out.append(item)
            elif key == last:
                out[-1][1].append(item)
            else:
                out.append(("opt", [item]))
            last = key

    for n, (op, i, j, k, m) in enumerate(SequenceMatcher(None, left, right, autojunk=False).get_opcodes()):
        if op == "equal":
            add(_merge(a[i:j], b[k:m]), [(x, y) if x or y else None for x, y in zip(ga[i:j], gb[k:m], strict=True)])
        else:
            add(a[i:j], [("a", n, x) for x in ga[i:j]])
            add(b[k:m], [("b", n, x) for x in gb[k:m]])
    return _alternatives(out)


def _subtrees(items: list) -> Iterator[list]:
    """``items`` cut into elements with all they hold, and single items beside them."""
    closed = {"<" + x[1][2:] for x in items if x[0] == "tag" and x[1].startswith("</")}
    opened: list[str] = []
    now: list = []
    for item in items:
        now.append(item)
        name = item[1] if item[0] == "tag" else ""
        if name.startswith("</"):
            if opened and opened[-1] == name[2:]:
                opened.pop()
        elif name in closed:
            opened.append(name[1:])
        if not opened:
            yield now
            now = []
    if now:
        yield now


def _alternatives(items: list) -> list:
    """``items`` with optional groups that stand at one place folded: each form of an
    element is there once, so a place grows with the forms that pages have there
    and not with the pages."""
    out: list = []
    known: dict | None = None
    for item in items:
        if item[0] != "opt":
            known = None
            out.append(item)
            continue
        known = {} if known is None else known
        for part in _subtrees(item[1]):
            form = tuple(_form(x) for x in part)
            if form in known:
                at = known[form]
                out[at] = ("opt", _merge(out[at][1], part))
            else:
                known[form] = len(out)
                out.append(("opt", part))
    return out


def _items(stream: list[list]) -> list:
    return _fold([("tag", x[0]) if len(x) == 1 else ("text", x[0], x[1], x[2]) for x in stream])


def _deepest(sizes: dict[str, int]) -> str | None:
    """The deepest container that holds ``MAIN_SHARE`` of the text of ``sizes`` by path."""
    whole = sum(sizes.values())
    if not whole:
        return None
    main, depth = "", 0
    at = [(p.split("/") if p else [], n) for p, n in sizes.items()]
    while True:
        below: dict[str, int] = {}
        for parts, n in at:
            if len(parts) > depth:
                below[parts[depth]] = below.get(parts[depth], 0) + n
        piece = max(below, key=below.get, default=None)
        if piece is None or below[piece] < MAIN_SHARE * whole:
            return main
        at = [(parts, n) for parts, n in at if len(parts) > depth and parts[depth] == piece]
        main = f"{main}/{piece}" if depth else piece
        depth += 1


def vote(texts: list[tuple], shown) -> str | None:
    """The container of most of the text of a page (path, hash, length) that is its own."""
    sizes: dict[str, int] = {}
    for path, key, n in texts:
        if key not in shown:
            sizes[path] = sizes.get(path, 0) + n
    return _deepest(sizes)


def partial(stream: list[list], shown) -> dict:
    """The wrapper of one page: ``items``, ``votes`` and ``pages``."""
    own = vote([x for x in stream if len(x) > 1], shown)
    return {"items": _items(stream), "votes": {} if own is None else {own: 1}, "pages": 1}


def joined(a: dict | None, b: dict) -> dict:
    """The wrapper of the pages of two wrappers."""
    if a is None:
        return b
    votes = Counter(a["votes"])
    votes.update(b["votes"])
    return {"items": align(a["items"], b["items"]), "votes": dict(votes), "pages": a["pages"] + b["pages"]}


def told(wrapper: dict, shown) -> dict:
    """What a host's wrapper says: ``main``, the container that holds the text of its
    slots; ``mains``, the containers of its pages, the likeliest first; ``shown``,
    hashes of the texts that most pages show."""
    sizes: dict[str, int] = {}

    def walk(group):
        for item in group:
            if item[0] == "text":
                if item[2] is None or item[2] not in shown:
                    sizes[item[1]] = sizes.get(item[1], 0) + item[3]
            elif item[0] != "tag":
                walk(item[1])

    walk(wrapper["items"])
    main = _deepest(sizes) or ""
    votes = sorted(wrapper["votes"], key=lambda p: (-wrapper["votes"][p], p))
    # A container of several templates' articles is not one template's.
    first = [main] if any(p == main or main.startswith(p + "/") or not p for p in votes[:1]) else []
    mains = [p for k, p in enumerate(dict.fromkeys(first + votes)) if not k or "!" not in p]
    return {"main": main, "mains": mains, "shown": sorted(shown)}


def constant(pages: int, there: int) -> bool:
    """Whether a text that ``pages`` of the ``there`` pages with its container show is constant."""
    return 2 * pages > there and pages >= SHOWN


def infer(skeletons: list[list[list]]) -> dict:
    """``told`` of the wrapper of a few pages."""
    texts = [{(x[0], x[1]) for x in s if len(x) > 1} for s in skeletons]
    by_text = Counter(x for t in texts for x in t)
    by_path = Counter(p for t in texts for p in {p for p, _ in t})
    shown = {key for (path, key), n in by_text.items() if constant(n, by_path[path])}
    wrapper: dict | None = None
    for stream in skeletons:
        wrapper = joined(wrapper, partial(stream, shown))
    return told(wrapper or {"items": [], "votes": {}}, shown)


def main_text(page: str, wrapper: dict | None) -> str:
    """The text of the article. With a wrapper: in the first of the host's main
    containers that holds enough of the page's own text, the blocks that the host
    does not show on most pages, or those in article or main elements if they are
    most of these; with them what the article's flow holds (``_flow``). Without:
    blocks inside article or main elements, or all. What a class sets apart counts
    only where the main container lies there, or where the page has no other text
    and no article."""
    all_blocks = blocks(page)
    found = [(x[0], x[3], x[1]) for x in all_blocks if x[3] and not x[2]]
    plain = [x for x in found if "!" not in x[0]]

    def size(some):
        return sum(len(x[1]) for x in some)

    if wrapper:
        shown = wrapper["shown"] if isinstance(wrapper["shown"], frozenset) else frozenset(wrapper["shown"])
        at = [i for i, x in enumerate(found) if not shown or _hash(x[1]) not in shown]
        own = [found[i] for i in at]
        seen = [x for x in own if "!" not in x[0]]
        for main in wrapper["mains"]:
            there = [i for i in at if _under(found[i][0], main)]
            held = size(found[i] for i in there)
            whole = size(seen) + (held if "!" in main else 0)
            if there and held >= (MARKED_SHARE if _marked(main) else PAGE_SHARE) * whole:
                inside = [i for i in there if _marked(found[i][0])]
                most = 2 * size(found[i] for i in inside) >= held
                plain = _flow(found, inside if inside and most else there, at, main, bool(inside) and most)
                break
        else:
            inside = [x for x in seen if _marked(x[0])]
            plain = (inside if inside and 2 * size(inside) >= size(seen) else seen) or plain
    else:
        plain = [x for x in plain if _marked(x[0])] or plain
    if not plain and not any(x[1] in ("<article", "<main") for x in all_blocks):
        plain = found
    return "\n".join(x[1] for x in plain)


_HEADING = re.compile("h[1-6]")


def _flow(found: list[tuple], chosen: list[int], own: list[int], main: str, marked: bool) -> list[tuple]:
    """The blocks of an article: the ``chosen`` places of ``found``; what the host
    shows on most pages if it stands between them in the main container, or is a
    heading right before them; and the page's own h1 before the container, if
    none is among them."""
    taken, mine = set(chosen), set(own)

    def inside(i):
        return _under(found[i][0], main) and (not marked or _marked(found[i][0]))

    for i in range(chosen[0] + 1, chosen[-1]):
        if i not in mine and inside(i):
            taken.add(i)
    before = chosen[0] - 1
    while before >= 0 and before not in mine and inside(before) and _HEADING.fullmatch(found[before][2]):
        taken.add(before)
        before -= 1
    if not any(found[i][2] == "h1" for i in taken):
        titles = [i for i in own if i < chosen[0] and found[i][2] == "h1" and "!" not in found[i][0]]
        taken.update(titles[-1:])
    return [found[i] for i in sorted(taken)]


_TEXTS = pa.list_(pa.struct([("path", pa.string()), ("text", pa.int64())]))


def learn(pages: DataFrame) -> DataFrame:
    """(host, wrapper) from ``pages`` (host, url, html); hosts with one distinct page,
    and pages without a host, get none."""

    def skeletons(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            made, texts = [], []
            for page in batch.column(1).to_pylist():
                stream = skeleton(page)
                made.append(json.dumps(stream, separators=(",", ":")))
                # Each distinct text with its container, and each container.
                pairs = {(x[0], x[1]) for x in stream if len(x) > 1}
                pairs |= {(p, None) for p, _ in pairs}
                texts.append([{"path": p, "text": t} for p, t in pairs])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(made, pa.string()), pa.array(texts, _TEXTS)],
                ["host", "key", "skeleton", "texts"],
            )

    def partials(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            made = []
            for text, shown in zip(batch.column(2).to_pylist(), batch.column(3), strict=True):
                shown = frozenset(shown.as_py() or ())
                made.append(json.dumps(partial(json.loads(text), shown), separators=(",", ":")))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(made, pa.string())], ["host", "key", "wrapper"])

    def aligned(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, key, wrapper = None, None, None

        def done():
            cols = [pa.array([group[0]], pa.string()), pa.array([key], pa.int64()), pa.array([json.dumps(wrapper, separators=(",", ":"))])]
            return pa.RecordBatch.from_arrays(cols, ["host", "key", "wrapper"])

        for batch in rows:
            for h, salt, k, w in zip(*(batch.column(n).to_pylist() for n in range(4)), strict=True):
                if (h, salt) != group:
                    if group is not None:
                        yield done()
                    group, key, wrapper = (h, salt), k, None
                wrapper = joined(wrapper, json.loads(w))
        if group is not None:
            yield done()

    def ended(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            hosts, out = [], []
            for h, w, shown in zip(*(batch.column(n).to_pylist() for n in range(3)), strict=True):
                wrapper = json.loads(w)
                if wrapper["pages"] > 1:
                    hosts.append(h)
                    out.append(json.dumps(told(wrapper, set(shown or ())), separators=(",", ":")))
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(out, pa.string())], ["host", "wrapper"])

    given = pages.filter("host <> ''").select("host", "html", F.xxhash64("html").alias("key"))
    made = given.mapInArrow(skeletons, "host string, key long, skeleton string, texts array<struct<path:string,text:long>>")
    made = stored(made.dropDuplicates(["host", "key"]), "skeletons")
    largest = made.groupBy("host").count().agg(F.max("count")).first()[0] or 0
    counts = made.select("host", F.explode("texts").alias("x")).groupBy("host", "x.path", "x.text").count().filter(F.col("count") >= SHOWN)
    there = counts.filter("text IS NULL").select("host", "path", F.col("count").alias("there"))
    shown = counts.filter("text IS NOT NULL").join(there, ["host", "path"]).filter(2 * F.col("count") > F.col("there"))
    shown = shown.groupBy("host").agg(F.collect_set("text").alias("shown"))
    shown = stored(shown, "shown")
    dealt = made.join(shown, "host", "left").select("host", "key", "skeleton", "shown")
    step = dealt.mapInArrow(partials, "host string, key long, wrapper string")
    salts = 1
    while salts * FAN < largest:
        salts *= FAN
    while salts:
        salted = step.select("host", F.pmod("key", F.lit(salts)).alias("salt"), "key", "wrapper")
        salted = salted.repartition("host", "salt").sortWithinPartitions("host", "salt", "key")
        step = salted.mapInArrow(aligned, "host string, key long, wrapper string")
        salts //= FAN
    wrappers = step.join(shown, "host", "left").select("host", "wrapper", "shown").mapInArrow(ended, "host string, wrapper string")
    out = stored(wrappers, "wrappers")
    removed(made, shown)
    return out


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: ``page_id``, ``url``, ``text``, ``n_chars`` (code
    points). A null html is an empty page and has an empty text; a null or odd url
    has no host and so no wrapper; repeated rows are extracted each; other columns
    are not read."""
    url = F.col(url_col).cast("string")
    rows = pages.select(
        F.col(id_col).alias("page_id"),
        url.alias("url"),
        text_or_empty(html_col).alias("html"),
        F.lower(F.coalesce(F.try_parse_url(url, F.lit("HOST")), F.lit(""))).alias("host"),
    )
    wrappers = learn(rows)
    size = wrappers.agg(F.sum(F.length("wrapper") + F.length("host"))).first()[0] or 0
    if size <= BROADCAST_BYTES:
        known = {r.host: r.wrapper for r in wrappers.collect()}  # its size is checked
        removed(wrappers)
        shared = pages.sparkSession.sparkContext.broadcast(known)
        joined, find = rows.withColumn("wrapper", F.lit(None).cast("string")), lambda host, _: shared.value.get(host)
    else:
        joined, find = rows.join(wrappers, "host", "left"), lambda _, wrapper: wrapper

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parsed: dict[str, dict] = {}
        for batch in rows:
            texts = []
            for host, page, own in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4)), strict=True):
                told = find(host, own)
                if told and told not in parsed:
                    if len(parsed) > 10_000:
                        parsed.clear()
                    parsed[told] = json.loads(told)
                    parsed[told]["shown"] = frozenset(parsed[told]["shown"])
                texts.append(main_text(page, parsed.get(told) if told else None))
            counts = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), counts], ["page_id", "url", "text", "n_chars"]
            )

    kind = rows.schema["page_id"].dataType.simpleString()
    given = joined.select("page_id", "url", "host", "html", "wrapper")
    return given.mapInArrow(batches, f"page_id {kind}, url string, text string, n_chars long")
