"""Main text of pages by wrappers: union-free regular expressions inferred from the pages of a host.

A page becomes a stream of tags and text slots. Adjacent equal groups of the stream fold to one repeated
group. Streams of one host are aligned pairwise, iteratively: what both have stays, what only one has
becomes optional, a single group meets the repeated one, and texts become slots with statistics
over all pages. Tasks align the pages they read, then partial wrappers are aligned in rounds of a
bounded number each, and a wrapper forgets optional parts that hardly any page has: no group and no wrapper grows with
the number of pages of a host.

The wrapper tells where the main text is: from its root it leads down to the element that holds most of the
host's plain text, links and unchanging texts left out. Names and class words of elements only shift those odds. Inside
that element, texts that stand on half of their slot's distinct pages go, and so do lists of links and
elements that are named as boilerplate. A page that its host's wrapper doesn't match, or that is alone, is its own wrapper.
"""

from __future__ import annotations

import hashlib
import html as entities
import json
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field
from difflib import SequenceMatcher
from functools import lru_cache
from operator import eq

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, bounded_batches, saved, slices, table, whole_text

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>", re.DOTALL)
ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.IGNORECASE)
WORD = re.compile(r"[a-z]+")
#: A slash at the end of an attribute without quotation marks belongs to it.
UNQUOTED = re.compile(r"=[^\s\"'>]+/$")
#: Elements whose content is no text of the page; those of ``OPEN`` end at their tag if they are never closed.
RAW = {"script", "style", "textarea", "iframe", "noscript", "template", "svg", "select", "title", "object"}
OPEN = {"noscript", "template", "svg", "select", "object"}
VOID = {"br", "img", "hr", "input", "meta", "link", "wbr", "area", "base", "col", "embed", "source", "track", "param"}
INLINE = {"a", "b", "i", "em", "strong", "span", "u", "s", "small", "sub", "sup", "code", "mark", "abbr", "cite", "q", "font", "tt", "kbd", "var", "del", "ins", "time", "wbr", "img", "big", "label", "bdi", "bdo"}
MAIN = {"article", "main"}
BOILER = {"nav", "header", "footer", "aside", "form", "head", "menu", "button", "dialog"}
MAIN_WORDS = {"article", "content", "post", "entry", "story", "main", "articlebody"}
BOILER_WORDS = {
    "ad", "ads", "adv", "advert", "advertisement", "banner", "promo", "sponsor", "sponsored", "cookie", "cookies", "consent", "gdpr", "notice", "alert", "popup", "modal", "overlay",
    "newsletter", "subscribe", "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "sidebar", "aside", "footer", "header", "masthead", "topbar", "comment", "comments",
    "respond", "reply", "replies", "share", "social", "related", "widget", "login", "signup", "search", "pagination", "pager", "toolbar", "complementary", "contentinfo", "copyright", "disclaimer",
}
#: Elements in which main text may be looked for; all others are parts of a text.
CONTAINERS = {"html", "body", "div", "section", "article", "main", "center", "table", "tbody", "tr", "td"}
#: How much the characters of a slot count: under a name of boilerplate, under one of main text, elsewhere; and those of links.
ODDS, LINKED = {"b": 0.25, "m": 4.0, "": 1.0}, 0.1
#: An element is entered if it has so much of what its parent holds.
MOST = 0.6
#: Wrappers that are aligned together in one round.
ROUND = 16
#: A wrapper forgets optional parts that fewer than one page in so many has; a part counts for one page at least, so nothing that a page has is rare among so few.
RARE = 50
#: Wrappers are broadcast if they have at most so many bytes in all; else pages and wrappers are shuffled by host.
BROADCAST_BYTES = 32 << 20
#: A slot counts so many texts; of more, those on the fewest pages are left out and all counts reduced (Misra and Gries).
KNOWN = 256
#: A text is fixed if so many distinct pages have it in one slot.
FIXED_PAGES = 3


@dataclass(slots=True)
class Part:
    """A tag, a text slot or a repeated group of a wrapper; of a page, ``texts`` are the places of its texts.

    ``pages`` is the number of distinct pages that have it, ``seen`` on how many of them each text stands, by hash, at least.
    """

    key: str
    optional: bool = False
    unit: list["Part"] | None = None
    pages: float = 1
    chars: int = 0
    seen: dict[int, float] = field(default_factory=dict)
    texts: list[int] = field(default_factory=list)


def cue(name: str, attributes: str) -> str:
    """What an element says about its content: m(ain), b(oilerplate) or nothing."""
    if name in BOILER:
        return "b"
    if not attributes or attributes.isspace():
        return "m" if name in MAIN else ""
    words: set[str] = set()
    for m in ATTRIBUTE.finditer(attributes):
        value = (m[2] or m[3] or m[4] or "").lower()
        kind = m[1].lower()
        if kind == "hidden" or kind == "aria-hidden" and value == "true" or kind == "style" and "display:none" in value.replace(" ", ""):
            return "b"
        if kind in ("class", "id", "role"):
            words.update(WORD.findall(value))
    if words & BOILER_WORDS:
        return "b"
    return "m" if name in MAIN or words & MAIN_WORDS else ""


_short_cue = lru_cache(4096)(cue)


@lru_cache(4096)
def _named(key: str) -> tuple[str, str]:
    """The name of an opened element's key, and its cue."""
    name, said = key[1:-1].split(" ")
    return name, said


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.strip().encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big")


def parse(page: str) -> tuple[list[Part], list[tuple[bool, str, int]]]:
    """The stream of a page and its texts: whether a block began with it, the text, character references decoded, and its hash."""
    stream: list[Part] = []
    texts: list[tuple[bool, str, int]] = []
    stack: list[str] = []
    at, block, links = 0, True, 0

    def text(piece: str) -> None:
        nonlocal block
        if not piece:
            return
        if piece.isspace():
            block = True
            return
        said = entities.unescape(piece) if "&" in piece else piece
        known = _hash(said)
        stream.append(Part("#a" if links else "#t", chars=len(said), seen={known: 1}, texts=[len(texts)]))
        texts.append((block, said, known))
        block = False

    while True:
        m = TOKEN.search(page, at)
        text(page[at : m.start()] if m else page[at:])
        if not m:
            return stream, texts
        at = m.end()
        slash, name, attributes = m.groups()
        if not name:
            continue
        name = name.lower()
        block = block or name not in INLINE
        if slash:
            place = next((i for i in range(len(stack) - 1, -1, -1) if stack[i] == name), None)
            if place is None:
                continue
            links -= stack[place:].count("a")
            del stack[place:]
            stream.append(Part(f"</{name}>"))
            continue
        stream.append(Part(f"<{name}>"))
        closed = attributes.endswith("/") and not UNQUOTED.search(attributes)
        if name in RAW:
            end = None if closed and name in OPEN else re.compile(rf"</{name}\s*>", re.IGNORECASE).search(page, at)
            if closed and end and re.compile(rf"<{name}\b", re.IGNORECASE).search(page, at, end.start()):
                end = None  # the end tag of a later element
            at = end.end() if end else at if closed or name in OPEN else len(page)
        elif name not in VOID and not closed:
            stack.append(name)
            links += name == "a"
            said = (_short_cue if len(attributes) < 200 else cue)(name, attributes)  # only short ones are remembered
            stream[-1].key = f"<{name} {said}>"


def _join(a: Part, b: Part, same: bool = False) -> Part:
    """One part for two that agree, of different pages or of the ``same``; of the same, a page counts once.

    Two of different pages are used up: their counts of texts pass to the new part, so that a page costs no copy of them.
    """
    unit = [_join(x, y, same) for x, y in zip(a.unit, b.unit, strict=True)] if a.unit else None
    pages = max(a.pages, b.pages) if same and not (a.optional or b.optional) else a.pages + b.pages
    if not a.seen and not b.seen:
        return Part(a.key, a.optional or b.optional, unit, pages, a.chars + b.chars, {}, a.texts + b.texts)
    more, less = (a.seen, b.seen) if len(a.seen) >= len(b.seen) else (b.seen, a.seen)
    seen = dict(more) if same else more
    for h, n in less.items():
        seen[h] = max(seen.get(h, 0), n) if same else seen.get(h, 0) + n
    if len(seen) > 2 * KNOWN:
        least = sorted(seen.values(), reverse=True)[KNOWN]
        seen = {h: n - least for h, n in seen.items() if n > least}
    return Part(a.key, a.optional or b.optional, unit, pages, a.chars + b.chars, seen, a.texts + b.texts)


def _group(unit: list[Part]) -> Part:
    return Part("(" + " ".join(p.key for p in unit) + ")+", unit=unit, pages=max(p.pages for p in unit))


def _sizes(keys: list[str], above: int) -> list[int]:
    """Sizes over ``above`` that an adjacent repeated group may have: distances between successive equal keys."""
    last: dict[str, int] = {}
    found: set[int] = set()
    for i, k in enumerate(keys):
        if k in last and i - last[k] > above:
            found.add(i - last[k])
        last[k] = i
    return sorted(found)


def fold(parts: list[Part]) -> list[Part]:
    """Adjacent equal groups as one repeated group, shorter groups first."""
    keys = [p.key for p in parts]
    todo = _sizes(keys, 0)
    while todo:
        size = todo.pop(0)
        if b"\1" * size not in bytes(map(eq, keys, keys[size:])):  # so many successive keys equal the ones ``size`` places on
            continue
        out: list[Part] = []
        i = 0
        while i < len(parts):
            n = 1
            while i + (n + 1) * size <= len(parts) and keys[i : i + size] == keys[i + n * size : i + (n + 1) * size]:
                n += 1
            if n > 1:
                unit = parts[i : i + size]
                for k in range(1, n):
                    unit = [_join(a, b, True) for a, b in zip(unit, parts[i + k * size : i + (k + 1) * size], strict=True)]
                same = size == 1 and unit[0].unit is not None
                out.append(unit[0] if same else _group(unit))
                i += n * size
            else:
                out.append(parts[i])
                i += 1
        parts, keys = out, [p.key for p in out]
        todo = _sizes(keys, size)
    return parts


def absorb(parts: list[Part], groups: dict[str, list[list[str]]]) -> list[Part]:
    """Groups that stand once in ``parts`` and are repeated in another wrapper become groups here too."""
    if not groups:
        return parts
    keys = [p.key for p in parts]
    out: list[Part] = []
    i = 0
    while i < len(parts):
        part, n = parts[i], 1
        unit = next((u for u in groups[keys[i]] if keys[i : i + len(u)] == u), None) if keys[i] in groups else None
        if unit:
            n = len(unit)
            part = _group(parts[i : i + n])
        if part.unit and out and out[-1].key == part.key:
            out[-1] = _join(out[-1], part, True)
        else:
            out.append(part)
        i += n
    return out


def groups_of(parts: list[Part]) -> dict[str, list[list[str]]]:
    """The keys of each repeated group by the first of them, longer groups first."""
    found: dict[str, list[list[str]]] = {}
    for p in {p.key: p for p in parts if p.unit}.values():
        found.setdefault(p.unit[0].key, []).append([q.key for q in p.unit])
    for units in found.values():
        units.sort(key=len, reverse=True)
    return found


def align(a: list[Part], b: list[Part]) -> list[Part]:
    """The wrapper of all that two wrappers match; both are used up."""
    if not a or not b:
        return a or b
    a, b = absorb(a, groups_of(b)), absorb(b, groups_of(a))
    out: list[Part] = []
    for op, i, j, k, m in SequenceMatcher(None, [p.key for p in a], [p.key for p in b], autojunk=False).get_opcodes():
        if op == "equal":
            out += [_join(x, y) for x, y in zip(a[i:j], b[k:m], strict=True)]
        else:
            for p in a[i:j] + b[k:m]:
                p.optional = True
                out.append(p)
    whole = max(p.pages for p in out)
    return [p for p in out if not p.optional or max(p.pages, 1) * RARE >= whole]


def _weight(p: Part) -> float:
    """Characters of a slot that may be main text."""
    fixed = sum(n for h, n in p.seen.items() if _fixed(h, p)) / p.pages if p.pages else 0
    return p.chars * max(0.0, 1 - fixed) * (LINKED if p.key == "#a" else 1)


@dataclass
class Element:
    start: int
    name: str
    cues: str
    end: int = 0
    weight: float = 0
    holds: bool = False
    inner: list["Element"] = field(default_factory=list)


def _is_open(key: str) -> bool:
    return key[0] == "<" and " " in key


def _under(cues: str) -> float:
    return ODDS["b" if "b" in cues else "m" if "m" in cues else ""]


def _group_weight(unit: list[Part], cues: str) -> float:
    total, stack = 0.0, []
    for p in unit:
        if p.unit:
            total += _group_weight(p.unit, cues + "".join(c for _, c in stack))
        elif p.key[0] == "#":
            total += _weight(p) * _under(cues + "".join(c for _, c in stack))
        elif _is_open(p.key):
            name, said = _named(p.key)
            stack.append((name, said))
        elif p.key[:2] == "</":
            _close(stack, p.key[2:-1], lambda e: e[0])
    return total


def _close(stack: list, name: str, of) -> list:
    """Take the innermost element of a name, and those inside it, from the stack."""
    place = next((i for i in range(len(stack) - 1, -1, -1) if of(stack[i]) == name), len(stack))
    gone = stack[place:]
    del stack[place:]
    return gone


def content(parts: list[Part]) -> tuple[int, int]:
    """The first and last part of the element with the main text; -1 and the number of parts if no element stands out."""
    root = Element(-1, "", "", len(parts))
    stack = [root]

    def leave(gone: list[Element], at: int) -> None:
        for e in reversed(gone):
            e.end = at
        for e, outer in zip(reversed(gone), [*reversed(gone[:-1]), stack[-1]], strict=True):
            outer.weight += e.weight
            outer.holds = outer.holds or e.name not in INLINE
            outer.inner.append(e)

    for i, p in enumerate(parts):
        if p.unit:
            stack[-1].weight += _group_weight(p.unit, stack[-1].cues)
            stack[-1].holds = True
        elif p.key[0] == "#":
            stack[-1].weight += _weight(p) * _under(stack[-1].cues)
        elif _is_open(p.key):
            name, said = _named(p.key)
            stack.append(Element(i, name, stack[-1].cues + said))
        elif p.key[:2] == "</" and len(stack) > 1:
            inner = stack[1:]
            gone = _close(inner, p.key[2:-1], lambda e: e.name)
            del stack[len(inner) + 1 :]
            if gone:
                leave(gone, i)
    gone = stack[1:]
    del stack[1:]
    if gone:
        leave(gone, len(parts))
    at = root
    while at.weight > 0:
        best = max((e for e in at.inner if e.name in CONTAINERS), key=lambda e: e.weight, default=None)
        if best is None or best.weight < MOST * at.weight or not (best.holds or "m" in best.cues):
            break
        at = best
    return at.start, at.end


class Wrapper:
    """A wrapper as pages are matched with it: where its main text is, its groups, the places of each key, and how many parts before a place are needed."""

    def __init__(self, parts: list[Part]):
        self.parts, self.bounds, self.groups = parts, content(parts), groups_of(parts)
        self.where: dict[str, list[int]] = {}
        self.needed = [0]
        for i, w in enumerate(parts):
            self.where.setdefault(w.key, []).append(i)
            self.needed.append(self.needed[-1] + (not w.optional))


def places(page: list[Part], wrapper: Wrapper) -> Iterator[tuple[Part, Part | None, int]]:
    """Each part of a page in order with the part that the wrapper has for it, if any, and that part's place."""
    at, needed = 0, wrapper.needed
    for p in absorb(page, wrapper.groups):
        of_key = wrapper.where.get(p.key, ())
        k = bisect_left(of_key, at)
        if k < len(of_key) and needed[of_key[k]] == needed[at]:
            found = of_key[k]
            at = found + 1
            yield p, wrapper.parts[found], found
        else:
            yield p, None, -1


def _leaves(p: Part, w: Part | None, boiler: bool, listed: bool = False) -> Iterator[tuple[Part, Part | None, bool, bool]]:
    """The slots of a part with those of the wrapper, whether boilerplate by a name, and whether in a list of links."""
    if p.unit:
        listed = listed or w is not None and w.pages + 1e-6 >= FIXED_PAGES and {q.key for q in _flat(p.unit)} == {"#a"}
        stack: list[tuple[str, bool]] = []
        for i, q in enumerate(p.unit):
            yield from _leaves(q, w.unit[i] if w else None, boiler or any(b for _, b in stack), listed)
            if _is_open(q.key):
                name, said = _named(q.key)
                stack.append((name, said == "b"))
            elif q.key[:2] == "</":
                _close(stack, q.key[2:-1], lambda e: e[0])
    elif p.key[0] == "#":
        yield p, w, boiler, listed


def _inside(page: list[Part], wrapper: Wrapper) -> list[tuple[Part, Part | None, bool, bool]]:
    """The slots of a page that are in the wrapper's element of main text; none if the page hasn't that element."""
    bounds = wrapper.bounds
    out: list[tuple[Part, Part | None, bool, bool]] = []
    stack: list[tuple[str, bool]] = []
    depth = 0 if bounds[0] < 0 else None  # open elements when the element begins
    for p, w, i in places(page, wrapper):
        if _is_open(p.key):
            name, said = _named(p.key)
            if depth is None and i == bounds[0]:
                stack.append((name, False))
                depth = len(stack)
            else:
                stack.append((name, depth is not None and said == "b"))
        elif p.key[:2] == "</":
            _close(stack, p.key[2:-1], lambda e: e[0])
            if depth is not None and len(stack) < depth:
                break
        elif depth is not None:
            out += _leaves(p, w, any(b for _, b in stack))
    return out


def _fixed(text: int, w: Part) -> bool:
    """Whether a text stands on half of the distinct pages of its slot, three at least."""
    n = w.seen.get(text, 0) + 1e-6
    return n >= FIXED_PAGES and 2 * n >= w.pages


def extract(page: str, wrapper: Wrapper) -> str:
    """The main text of a page, blanks inside it as one, trimmed."""
    stream, texts = parse(page)
    stream = fold(stream)
    found = _inside(stream, wrapper) if wrapper.parts else []
    if not any(p.key == "#t" and not boiler for p, _, boiler, _ in found):
        found = [(p, None, boiler, listed) for p, _, boiler, listed in _inside(stream, Wrapper(stream))]
    plain = any(p.key == "#t" and not boiler for p, _, boiler, _ in found)  # a text of links only is its links
    said: dict[int, bool] = {}  # places of texts that may be main text, and whether the wrapper tells that they are not
    for p, w, boiler, listed in found:
        if not boiler:
            said |= {k: plain and listed or w is not None and _fixed(texts[k][2], w) for k in p.texts}
    keep: list[int] = []
    block: list[int] = []
    for i in [*sorted(said), None]:
        if block and (i is None or texts[i][0]):
            keep += [] if all(said[k] for k in block) else block
            block = []
        block.append(i)
    return " ".join("".join(" " * texts[i][0] + texts[i][1] for i in keep).split())


def _flat(parts: list[Part]) -> Iterator[Part]:
    for p in parts:
        if p.unit:
            yield from _flat(p.unit)
        elif p.key[0] == "#":
            yield p


def dumps(parts: list[Part]) -> str:
    pack = lambda p: [p.key, int(p.optional), round(p.pages, 6), p.chars, [[h, round(n, 6)] for h, n in p.seen.items()], [pack(q) for q in p.unit] if p.unit else None]
    return json.dumps([pack(p) for p in parts], ensure_ascii=False)


def loads(text: str | None) -> list[Part]:
    unpack = lambda r: Part(r[0], bool(r[1]), [unpack(q) for q in r[5]] if r[5] else None, r[2], r[3], dict(r[4]))
    return [unpack(r) for r in json.loads(text)] if text else []


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One wrapper for each host of a task's pages."""
    found: dict[str, list[Part]] = {}
    for batch, pages in slices(batches, text="html"):
        for host, copies, page in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), pages, strict=True):
            stream = parse(page)[0]
            for p in stream:
                p.texts, p.pages, p.seen = [], 1 / copies, {h: 1 / copies for h in p.seen}
            stream = fold(stream)
            found[host] = align(found[host], stream) if host in found else stream
    if found:
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array([dumps(w) for w in found.values()])], names=["host", "wrapper"])


def _all(group: pd.DataFrame) -> list[Part]:
    wrapper: list[Part] = []
    for text in sorted(group["wrapper"]):
        wrapper = align(wrapper, loads(text))
    return wrapper


def _aligned(group: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"host": [group["host"].iloc[0]], "wrapper": [dumps(_all(group))]})


def _whole(group: pd.DataFrame) -> pd.DataFrame:
    """The wrapper of a host; of the texts it has counted only the fixed ones stay."""
    wrapper = _all(group)
    for slot in _flat(wrapper):
        slot.seen = {h: n for h, n in slot.seen.items() if _fixed(h, slot)}
    return pd.DataFrame({"host": [group["host"].iloc[0]], "wrapper": [dumps(wrapper)]})


def _host(column: str = "url"):
    return F.coalesce(F.lower(F.regexp_extract(F.col(column), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper) inferred from all pages; a page without a readable URL belongs to the host ''.

    Of n exact copies of a page on a host each counts as 1/n page.
    """
    bounded_batches(pages.sparkSession)
    rows = pages.select(_host().alias("host"), whole_text("html").alias("html")).withColumn("digest", F.xxhash64("host", "html"))
    copied = saved(rows.groupBy("digest").agg(F.count("*").alias("copies")).where("copies > 1"), "copied-pages")
    rows = rows.join(F.broadcast(copied) if copied.count() * 16 <= BROADCAST_BYTES else copied, "digest", "left")
    rows = rows.select("host", "html", F.coalesce("copies", F.lit(1)).alias("copies"))
    at = Scratch(pages.sparkSession, "wrappers")
    found = at.save(rows.mapInArrow(_partial, "host string, wrapper string"), "partial")
    while True:
        most = found.groupBy("host").agg(F.count("*").alias("n")).agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
        last = found
        if most <= ROUND:
            found = at.save(found.groupBy("host").applyInPandas(_whole, "host string, wrapper string"), "whole")
            at.drop(last)
            return found
        dealt = found.withColumn("cell", F.pmod(F.xxhash64("wrapper"), F.lit(-(-most // ROUND))))
        found = at.save(dealt.groupBy("host", "cell").applyInPandas(_aligned, "host string, wrapper string"), "some")
        at.drop(last)


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[str | None, Wrapper] = {}
    for batch, pages in slices(batches, text="html"):
        out = []
        for page, wrapper in zip(pages, batch.column(3).to_pylist(), strict=True):
            if wrapper not in known:
                if len(known) > 200:
                    known.clear()
                known[wrapper] = Wrapper(loads(wrapper))
            out.append(extract(page, known[wrapper]))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out), pa.array([len(t) for t in out], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def main_text(pages: DataFrame) -> DataFrame:
    """One row per input row: page_id, url, text (empty if none) and n_chars (its code points).

    ``pages`` needs page_id, url and html; other columns are ignored. A null or empty html gives an empty text;
    html that is cut off or badly nested is read as far as it goes. Rows may repeat. An empty table gives an
    empty result. A wrapper depends on the order in which pages are aligned, so on how the table is split.
    """
    found = wrappers(pages)
    size = found.agg(F.coalesce(F.sum(F.length("host") + F.length("wrapper")), F.lit(0))).first()[0]
    bounded_batches(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", whole_text("html").alias("html"), _host().alias("host"))
    rows = rows.join(F.broadcast(found) if size <= BROADCAST_BYTES else found, "host", "left").select("page_id", "url", "html", "wrapper")
    return rows.mapInArrow(_extracted, "page_id long, url string, text string, n_chars long")


def op10_html_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))
