"""HTML extraction by union-free regular-expression inference.

A page is a tree of its block elements, by name and class, with its texts as leaves; neighbours of one shape, and runs of
neighbours that repeat, are folded into repeated groups. All pages of a host are aligned one after another into one
wrapper: elements that only some pages have become optional or, next to their like, repeated; texts that differ become
slots. Nothing is ever a choice between two shapes, so a wrapper stays a regular expression without unions.

A wrapper's leaf knows whether pages differ there, which makes it a slot. Beside its tree a wrapper has, for each path of
elements, the texts that every page with that path holds, wherever they stand among its repeats, and up to ``DISTINCT``
hashes of what pages hold there in all: once so many differ, what they share is template. The article is what stands in article or main elements, else the
deepest element with all slots, menus and the like aside. Every page is then matched against its host's wrapper, and its
text is what its leaves in the article hold beyond the template.

Wrappers are folded per task and host, merged in two rounds (a host with very many pages meets as one small wrapper per
task, never as pages), and joined to the pages: broadcast while their counted bytes are few, a skew join beyond. Element
names, roles and unmistakable class words decide only what is a menu, notice, advert or comment.
"""

from __future__ import annotations

import html as entities
import json
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher

import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adjudica.llm import _common as C

#: a text all pages share is template once so many different pages are known, and if it is less than SHARE of a page
DISTINCT, SHARE = 8, 0.3
BROADCAST_BYTES = 16 << 20
#: hosts whose wrappers a task holds before it hands them on
HELD_HOSTS = 2000
SALTS = 16

# fixed values: element names of HTML by role
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
RAW = {n: re.compile(f"</{n}(?=[\\s/>])", re.I | re.A) for n in "script style textarea title noscript template iframe xmp".split()}
DROPPED = frozenset("head script style noscript template iframe nav footer aside button select textarea menu dialog svg canvas object audio video".split())
MAIN = frozenset("article main".split())
#: elements that hold words: only a class of theirs that is such a word itself says that they are no article
WORDED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote figcaption figure pre caption td th dt dd address summary".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
#: elements that an open one of the other names ends, as far as the list, table or select they stand in
ENDED_BY = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
OUTSIDE_ROLE = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
#: words that mark a class or id as no article, as the whole token or its first or last part
OUTSIDE = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promoted promotion banner cookie cookies consent notice notices alert popup modal sidebar nav navbar navigation menu breadcrumb breadcrumbs header footer masthead share sharing social related recommended recommendations comment comments replies reply respond disqus newsletter subscribe subscription signup login search toolbar widget widgets pagination pager skip hidden copyright".split())
#: first parts that say what an element has, or what its text is about, not what it is
ABOUT = frozenset("has with without no is not category cat tag topic type format status post page single theme layout".split())
#: outside only if they hold less than half of a host's varying words: names of layout, not of a kind of text
LAYOUT = frozenset("banner header masthead nav navigation notice related search share sharing sidebar social toolbar widget widgets".split())

TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*>?|<(/?)([A-Za-z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>|[^<]+|<", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
MARKS = frozenset("class id role hidden aria-hidden".split())
#: elements whose class or id says nothing about their text
WHOLE = MAIN | {"html", "body"}
SPACE = re.compile(r"\s+")
INSIDE, MAYBE, OUT = 0, 1, 2


def tokens(page: str) -> Iterator[tuple[str, str, dict | str]]:
    """(kind, name, value): open tags with their marks, close tags and texts; comments and raw contents are left out."""
    at = 0
    while m := TOKEN.match(page, at):
        at = m.end()
        if m[2]:
            name = m[2].lower()
            if m[1]:
                yield "close", name, ""
                continue
            yield "open", name, {k.lower(): (v or "").strip("\"'") for k, v in ATTRIBUTE.findall(m[3]) if k.lower() in MARKS} if m[3] else {}
            if name in RAW:
                end = RAW[name].search(page, at)
                at = end.start() if end else len(page)
        elif m[0][0] != "<" or m[0] == "<":
            yield "text", "", m[0]


def _says_outside(value: str, whole: bool = False) -> int:
    """What the tokens of a class or id say; whole: none of their parts."""
    worst = INSIDE
    for token in value.lower().split():
        if whole:
            worst = max(worst, OUT if token in OUTSIDE and token not in LAYOUT else INSIDE)
            continue
        parts = re.split(r"[-_]+", token)
        for word in {token, parts[0], parts[-1]} & OUTSIDE if parts[0] not in ABOUT else {token} & OUTSIDE:
            worst = max(worst, MAYBE if word in LAYOUT else OUT)
    return worst


def _outside(name: str, marks: dict, in_main: bool) -> int:
    if name in DROPPED or (name == "header" and not in_main):
        return OUT
    least = MAYBE if name == "form" else INSIDE
    if not marks:
        return least
    if "hidden" in marks or marks.get("aria-hidden") == "true" or marks.get("role", "").lower() in OUTSIDE_ROLE:
        return OUT
    # a header that is an article's own holds its headline; what holds words has its id from them, and inside a block
    # a class says how words look
    if name in WHOLE or name == "header" or name in INLINE:
        return INSIDE
    if name in WORDED:
        return _says_outside(marks.get("class", ""), whole=True)
    return max((_says_outside(marks[k]) for k in ("class", "id") if k in marks), default=least)


# A wrapper is {"root": node, "shared": {path: [hashes of what pages hold there, hashes of the texts all of them hold]}}.
# A node is [label, outside, flags, kids]; a leaf is ["#", 0, flags, words, up to two hashes of what pages hold] in a
# wrapper and ["#", 0, flags, block numbers] in a page. Flags: 1 optional, 2 repeated, 4 a group
# whose elements come in any order, 8 a node for all classes of its name. A group of neighbours has the label "()".
LEAF, GROUP, OPTIONAL, REPEAT, WIDE, ANY = "#", "()", 1, 2, 4, 8
#: more labels of one element's name in a group than this are one node of that name, so that names made for each page
#: do not make a wrapper grow with the pages; and so many paths keep the texts of a single page
LABELS, PATHS = 16, 1000
#: elements nested deeper share the node they stand in, so that pages of unclosed elements stay shallow trees
DEEPEST = 100
#: more neighbours than this, folded, are one repeated group of optional elements
WIDEST = 64


def tree(page: str) -> tuple[list, list[str]]:
    """A page as (root node, texts of its blocks in page order); a leaf holds the numbers of its blocks."""
    root: list = ["", INSIDE, 0, []]
    stack: list[tuple[str, list, bool]] = [("", root, False)]
    open_names: Counter = Counter()
    held: list[str] = []
    texts: list[str] = []

    def cut(at: int) -> None:
        open_names.subtract(s[0] for s in stack[at:])
        del stack[at:]

    def flush() -> None:
        if held:
            text = SPACE.sub(" ", entities.unescape("".join(held))).strip()
            held.clear()
            if text:
                kids = stack[-1][1][3]
                if kids and kids[-1][0] == LEAF:
                    kids[-1][3].append(len(texts))
                else:
                    kids.append([LEAF, 0, 0, [len(texts)]])
                texts.append(text)

    def push(name: str, marks: dict, outside: int) -> None:
        label = name
        if marks and name not in WHOLE:
            said = marks.get("id") or (marks.get("class", "").split() or [""])[0]
            label = f"{name}.{said}" if (said := re.sub(r"\d+", "", said)) else name
        node = stack[-1][1]
        if len(stack) <= DEEPEST or outside > node[1]:
            node = [label, outside, 0, []]
            stack[-1][1][3].append(node)
        stack.append((name, node, stack[-1][2] or name in MAIN))
        open_names[name] += 1

    for kind, name, value in tokens(page):
        if kind == "text":
            held.append(value)
        elif name == "br":
            held.append("\n")
        elif kind == "open":
            outside = _outside(name, value, stack[-1][2])
            if name in INLINE:
                if outside and name not in VOID:
                    flush()
                    push(name, value, outside)
                continue
            flush()
            if name in CLOSES_P:
                open_p = next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] not in INLINE)
                if stack[open_p][0] == "p":
                    cut(open_p)
            if name in ENDED_BY and any(open_names[e] > 0 for e in ENDED_BY[name][0]):
                ended, until = ENDED_BY[name]
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] in until:
                        break
                    if stack[i][0] in ended:
                        cut(i)
                        break
            if name not in VOID:
                push(name, value, outside)
        else:
            if open_names[name] > 0:
                flush()
                cut(next(i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == name))
            elif name not in INLINE:
                flush()
    flush()
    return root, texts


def _sig(node: list) -> str:
    if node[0] == LEAF:
        return LEAF
    # repeated as often as it likes, an element is of one shape
    return f"{node[0]}[{' '.join(sorted({k[0] for k in node[3]}))}]" if node[0] != GROUP else "(" + " ".join(_sig(k) for k in node[3]) + ")"


def _merge(a: list, b: list, one_page: bool) -> list:
    """The node that both are instances of."""
    flags = a[2] | b[2] | (REPEAT if one_page else 0)
    if a[0] != LEAF:
        return [a[0], max(a[1], b[1]), flags, _align(a[3], b[3], one_page)]
    if one_page:
        return [LEAF, 0, a[2] | b[2], a[3] + b[3]]
    return [LEAF, 0, flags, a[3] + b[3], sorted({*a[4], *b[4]})[:2]]


def _optional(nodes: list[list]) -> list[list]:
    return [[*n[:2], n[2] | OPTIONAL, *n[3:]] for n in nodes]


def _is_wide(kids: list[list]) -> bool:
    return len(kids) == 1 and bool(kids[0][2] & WIDE)


def _widened(kids: list[list], one_page: bool) -> list[list]:
    """Many children as one repeated group that has each element once, optional: it matches them in any order."""
    if _is_wide(kids):
        return kids
    by_label: dict[str, list] = {}
    todo = list(reversed(kids))
    while todo:
        n = todo.pop()
        if n[0] == GROUP:
            todo += reversed(n[3])
        else:
            by_label[n[0]] = _merge(by_label[n[0]], n, one_page) if n[0] in by_label else n
    by_name: dict[tuple[str, int], list[str]] = {}
    for label, n in by_label.items():
        if label != LEAF and n[1] != MAYBE:
            by_name.setdefault((label.split(".")[0], n[1]), []).append(label)
    for (name, outside), labels in by_name.items():
        if len(labels) > LABELS:
            # what is outside and what is not stay apart
            label = name if outside == INSIDE else f"{name}.(outside)"
            one = None
            for k in labels:
                n = [label, *by_label.pop(k)[1:]]
                one = n if one is None else _merge(one, n, one_page)
            by_label[label] = [*one[:2], one[2] | ANY | REPEAT, *one[3:]]
    return [[GROUP, INSIDE, REPEAT | WIDE, _optional(list(by_label.values()))]]


def _align(a: list[list], b: list[list], one_page: bool, by=_sig) -> list[list]:
    """Children that both lists are instances of: like ones merged in order, the others optional."""
    if len(a) == len(b) == 1 and a[0][0] == b[0][0] and not a[0][2] & WIDE and not b[0][2] & WIDE:
        return [_merge(a[0], b[0], one_page)]
    x, y = [by(n) for n in a], [by(n) for n in b]
    if x == y:
        return [_merge(p, q, one_page) for p, q in zip(a, b, strict=True)]
    if by is _sig and (_is_wide(a) or _is_wide(b) or max(len(a), len(b)) > WIDEST):
        return _widened(_widened(a, one_page)[0][3] + _widened(b, one_page)[0][3], one_page)
    out: list = []
    for kind, i1, i2, j1, j2 in SequenceMatcher(None, x, y, autojunk=False).get_opcodes():
        if kind == "equal":
            out += [_merge(p, q, one_page) for p, q in zip(a[i1:i2], b[j1:j2], strict=True)]
        elif kind == "replace" and by is _sig:
            out += _align(a[i1:i2], b[j1:j2], one_page, lambda n: n[0])
        else:
            out += _optional(a[i1:i2]) + _optional(b[j1:j2])
    return _folded(out, one_page) if by is _sig else out


def _folded(kids: list[list], one_page: bool) -> list[list]:
    """Neighbours of one shape as one repeated node, and runs of two to four that follow themselves as a repeated group."""
    out: list = []
    for n in kids:
        if out and n[0] != LEAF and _sig(out[-1]) == _sig(n):
            m = _merge(out[-1], n, one_page)
            m[2] |= REPEAT
            out[-1] = m
        else:
            out.append(n)
    for k in (2, 3, 4):
        if len(out) < 2 * k:
            break
        sigs = [_sig(n) for n in out]
        folded, i = [], 0
        while i < len(out):
            group = None
            while i + 2 * k <= len(out) and sigs[i : i + k] == sigs[i + k : i + 2 * k]:
                parts = out[i : i + k] if group is None else group
                group = [_merge(p, q, one_page) for p, q in zip(parts, out[i + k : i + 2 * k], strict=True)]
                i += k
            if group is None:
                folded.append(out[i])
                i += 1
            else:
                folded.append([GROUP, INSIDE, REPEAT, group])
                i += k
        out = folded
    return _widened(out, one_page) if len(out) > WIDEST else out


def fold(node: list) -> list:
    """A page's node with repeats folded, inner ones first."""
    if node[0] == LEAF:
        return node
    return [*node[:3], _folded([fold(k) for k in node[3]], True)]


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text)


def _held(hashes: set[int]) -> int:
    return _hash(json.dumps(sorted(hashes)))


def of_page(node: list, texts: list[str]) -> dict:
    """A folded page as a wrapper of its own."""
    shared: dict[str, set[int]] = {}

    def leaf(n: list, path: str) -> list:
        if n[0] != LEAF:
            path = path if n[0] in ("", GROUP) else f"{path}/{n[0]}"
            return [*n[:3], [leaf(k, path) for k in n[3]]]
        hashes = {_hash(texts[i]) for i in n[3]}
        shared.setdefault(path, set()).update(hashes)
        return [LEAF, 0, n[2], sum(texts[i].count(" ") + 1 for i in n[3]), [_held(hashes)]]

    root = leaf(node, "")
    return {"root": root, "shared": {p: [[_held(h)], sorted(h)] for p, h in shared.items()}}


def both(a: dict, b: dict) -> dict:
    """The wrapper of all pages of two wrappers of a host."""
    shared = dict(a["shared"])
    for path, (held, texts) in b["shared"].items():
        if path in shared:
            own, known = shared[path]
            held, texts = sorted({*own, *held})[:DISTINCT], sorted(set(known) & set(texts))
        shared[path] = [held, texts]
    if len(shared) > PATHS:
        several = {p: x for p, x in shared.items() if len(x[0]) > 1}
        shared = several | dict(sorted((p, x) for p, x in shared.items() if p not in several)[: max(0, PATHS - len(several))])
    return {"root": _merge(a["root"], b["root"], False), "shared": shared}


def _leaves(node: list, path: tuple = ()) -> Iterator[tuple[tuple, list]]:
    """(nodes from the root, leaf) of all leaves."""
    if node[0] == LEAF:
        yield path, node
    else:
        for k in node[3]:
            yield from _leaves(k, (*path, node))


def decided(wrapper: dict) -> list:
    """The wrapper for reading: a leaf is ["#", whether it is of the article, hashes of its template texts], an element
    [label, outside, flags, kids, whether it is wholly in the article's container]."""
    leaves = list(_leaves(wrapper["root"]))
    varies = lambda leaf: len(leaf[4]) > 1
    several = any(varies(leaf) for _, leaf in leaves)
    mass: dict[int, float] = {}
    total = 0
    for path, leaf in leaves:
        if not any(n[1] == OUT for n in path) and (varies(leaf) or not several):
            total += leaf[3]
            for n in path:
                mass[id(n)] = mass.get(id(n), 0) + leaf[3]
    out = lambda n: n[1] == OUT or (n[1] == MAYBE and 2 * mass.get(id(n), 0) < total)
    inside = [(path, leaf) for path, leaf in leaves if not any(out(n) for n in path)]
    marked = [next(n for n in path if n[0] in MAIN) for path, leaf in inside if any(n[0] in MAIN for n in path)]
    if marked:
        container = {id(n) for n in marked}
    else:
        slots = [path for path, leaf in inside if varies(leaf) or not several]
        depth = 0
        while slots and all(len(p) > depth for p in slots) and len({id(p[depth]) for p in slots}) == 1:
            depth += 1
        # a paragraph or heading that alone varies is no container of its own
        while depth > 1 and slots[0][depth - 1][0].split(".")[0] in ("p", "li", "h1", "h2", "h3", GROUP):
            depth -= 1
        container = {id(slots[0][depth - 1])} if depth else set()

    def told(node: list, within: bool, gone: bool, path: str) -> list:
        within, gone = within or id(node) in container, gone or (node[0] != LEAF and out(node))
        if node[0] != LEAF:
            path = path if node[0] in ("", GROUP) else f"{path}/{node[0]}"
            return [*node[:3], [told(k, within, gone, path) for k in node[3]], within and not gone]
        held, texts = wrapper["shared"].get(path, ((), ()))
        return [LEAF, within and not gone, texts if len(held) >= DISTINCT else []]

    return told(wrapper["root"], False, False, "")


def expression(node: list) -> str:
    """The wrapper as a union-free regular expression over tags; # is a slot, = a text all pages share."""
    if node[0] == LEAF:
        inner = "=" if len(node[4]) == 1 else "#"
    else:
        inner = "".join(expression(k) for k in node[3])
        if node[0] not in ("", GROUP):
            inner = f"<{node[0]}>{inner}</>"
    mark = "*" if node[2] & OPTIONAL and node[2] & REPEAT else "+" if node[2] & REPEAT else "?" if node[2] & OPTIONAL else ""
    return f"({inner}){mark}" if mark else inner


def infer(pages: list[str]) -> dict:
    """The wrapper of pages of one host."""
    made = None
    for page in pages:
        root, texts = tree(page)
        one = of_page(fold(root), texts)
        made = one if made is None else both(made, one)
    return {"root": ["", INSIDE, 0, []], "shared": {}} if made is None else made


def _named(kids: list[list], label: str) -> list | None:
    for w in kids:
        if w[0] == label:
            return w
        if w[0] == GROUP and (found := _named(w[3], label)):
            return found
    return None


def _like(kids: list[list], label: str) -> list | None:
    """The node of a label, else the one that stands for all classes of its name."""
    found = _named(kids, label)
    if found is None and (found := _named(kids, label.split(".")[0])) and not found[2] & ANY:
        return None
    return found


def _match(node: list, wrapper: list | None, kept: set[int], template: dict[int, list], within: bool = False) -> None:
    """Which blocks of a page the wrapper's article leaves take, and what template they may hold.

    Children are matched in order by shape, what is left by name to what stands between, or anywhere. A part of a page
    that the wrapper lacks is of the article if what holds it is (within).
    """
    kids = wrapper[3] if wrapper else []
    pairs: list = [None] * len(node[3])
    x, y = [_sig(k) for k in node[3]], [LEAF if k[0] == LEAF else _sig(k) for k in kids]
    if x == y:
        pairs = list(kids)
    elif len(x) <= WIDEST >= len(y):
        for a, b, n in SequenceMatcher(None, x, y, autojunk=False).get_matching_blocks():
            pairs[a : a + n] = kids[b : b + n]
    at = {id(w): j for j, w in enumerate(kids)}
    lo = 0
    for i, (k, w) in enumerate(zip(node[3], pairs, strict=True)):
        if w is None and k[0] == GROUP:
            _match(k, wrapper, kept, template, within)
            continue
        if w is None:
            hi = next((at[id(p)] for p in pairs[i + 1 :] if p is not None), len(kids))
            w = _like(kids[lo:hi], k[0]) or _like(kids, k[0])
        else:
            lo = at[id(w)]
        if k[0] != LEAF:
            if k[1] != OUT and not (w is None and k[1]):
                _match(k, w, kept, template, w[4] if w is not None else within)
        elif w[1] if w is not None else within:
            kept.update(k[3])
            if w is not None and w[2]:
                template |= dict.fromkeys(k[3], w[2])


def read(page: str, wrapper: list) -> str:
    """The article of a page by its host's decided wrapper; where none of it matches, all that is no menu or the like."""
    root, texts = tree(page)
    folded = fold(root)
    kept: set[int] = set()
    template: dict[int, list] = {}
    _match(folded, wrapper, kept, template)
    if not kept:
        own = decided(of_page(folded, texts))
        _match(folded, own, kept, template)
    fixed = {i for i, t in template.items() if _hash(texts[i]) in t}
    words = lambda blocks: sum(texts[i].count(" ") + 1 for i in blocks)
    # texts that all pages share are template only beside an article; where they are most of it, pages are near copies
    if fixed and words(fixed) < SHARE * words(kept):
        kept -= fixed
    return "\n".join(texts[i] for i in sorted(kept))


PARTIAL = "host string, wrapper string"
#: every page carries its host's wrapper, so it is packed
PACKED = "host string, wrapper binary"
PARTIAL_ARROW = pa.schema([("host", pa.string()), ("wrapper", pa.string())])


def _partials(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One wrapper per host and task (more where a task has very many hosts)."""
    held: dict[str, dict] = {}

    def batch() -> pa.RecordBatch:
        return pa.record_batch([pa.array(list(held)), pa.array([json.dumps(w, separators=(",", ":")) for w in held.values()])], schema=PARTIAL_ARROW)

    for part in batches:
        for host, page in zip(part.column("host").to_pylist(), part.column("html").to_pylist(), strict=True):
            one = infer([page or ""])
            held[host] = both(held[host], one) if host in held else one
            if len(held) >= HELD_HOSTS:
                yield batch()
                held.clear()
    if held:
        yield batch()


def _joined(last: bool):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        host, made = None, None

        def row() -> pa.RecordBatch:
            text = json.dumps(decided(made) if last else made, separators=(",", ":"))
            packed = pa.array([zlib.compress(text.encode())], pa.binary()) if last else pa.array([text])
            return pa.record_batch([pa.array([host]), packed], names=["host", "wrapper"])

        for part in batches:
            for h, w in zip(part.column("host").to_pylist(), part.column("wrapper").to_pylist(), strict=True):
                one = json.loads(w)
                if h != host and made is not None:
                    yield row()
                    made = None
                host, made = h, one if made is None else both(made, one)
        if made is not None:
            yield row()

    return task


def wrappers(pages: DataFrame, work: C.Scratch) -> DataFrame:
    """host, wrapper (decided, as packed JSON) of each host, from all its pages."""
    own = pages.select(_host(F.col("url")).alias("host"), F.col("html").cast("string").alias("html"))
    partial = work.write(own.mapInArrow(_partials, PARTIAL), "partial")
    n = C.buckets_of(pages.sparkSession)
    salted = partial.withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(SALTS))).repartition(n, "host", "salt").sortWithinPartitions("host", "salt", "wrapper")
    once = salted.select("host", "wrapper").mapInArrow(_joined(False), PARTIAL)
    return once.repartition(n, "host").sortWithinPartitions("host", "wrapper").mapInArrow(_joined(True), PACKED)


def _host(url: Column) -> Column:
    return F.lower(F.coalesce(F.nullif(F.regexp_extract(url.cast("string"), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit("")), F.lit("")))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[str, list] = {}
    for batch in batches:
        out = []
        for page, w in zip(batch.column("html").to_pylist(), batch.column("wrapper").to_pylist(), strict=True):
            if w not in known:
                if len(known) >= HELD_HOSTS:
                    known.clear()
                known[w] = json.loads(zlib.decompress(w)) if w else ["", INSIDE, 0, [], False]
            out.append(read(page or "", known[w]))
        texts = pa.array(out, pa.string())
        yield pa.record_batch([batch.column("page_id"), batch.column("url"), texts, pc.utf8_length(texts).cast(pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page: its article's blocks, white space folded, joined by line ends.

    Null or empty html: empty text. Pages without a host (null or odd url) form one host. Rows are independent but for
    the wrapper; repeated pages count once in what pages share; repeated ids and extra columns change nothing. Elements
    left open end with what holds them. An empty table gives an empty one.
    """
    work = C.Scratch(pages.sparkSession, "html")
    made = work.write(wrappers(pages, work).withColumnRenamed("host", "of"), "wrappers")
    size = made.agg(F.coalesce(F.sum(F.octet_length("of") + F.octet_length("wrapper") + 32), F.lit(0))).first()[0]
    own = pages.select(F.col("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")).withColumn("host", _host(F.col("url")))
    joined = own.join(F.broadcast(made) if size <= BROADCAST_BYTES else made, F.col("host") == F.col("of"), "left")
    kind = dict(pages.dtypes)["page_id"]
    return joined.select("page_id", "url", "html", "wrapper").mapInArrow(_read, f"page_id {kind}, url string, text string, n_chars bigint")
