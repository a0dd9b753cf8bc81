"""Main text of HTML pages through wrappers inferred for each host.

Pages of a host are turned into token streams of block tags and text. The first
stream is the wrapper; the others are aligned with it one by one. Where labels
agree, the parts are aligned inside; equal neighbours, alone or in short
sequences, become a repeated group; what only some pages have becomes optional;
differing text becomes a text slot. The result is a regular expression without
unions, as a nested pattern, in which each slot knows the text that most of its pages
may share (a majority vote that merges) and how much of its texts is link text.

A part of the pattern is boilerplate if its tag or the words of its class, id
or role say so (menus, headers, footers, sidebars, notices, adverts, forms,
comments), or if it lies outside the article and is mostly links. A text outside
the article goes where it equals a text that stands in at least ``CONSTANT_SHARE`` (and
``CONSTANT_PAGES``) of all different pages of the host that have a text at its place. Pages are then read along
their host's pattern: parts that match a boilerplate part go, the rest inside
the article or main element (all of the body if there is none) is the text. A
part that the pattern doesn't have is judged by its own tag and words.

Wrappers are fitted on all different pages of a host. Those of a host with more than ``PART`` rows are dealt by
their hash over parts of about as many pages; each part is fitted by itself, and the patterns are merged, ``PART`` at a
time, in rounds. Every page is extracted whole. Null html gives empty text, null urls share a wrapper. Elements nested deeper than ``DEPTH`` count as children of the one at that depth (texts stay whole and
in order); a tag that isn't closed before the next ``<`` is text. Repeated rows are extracted alike; only the id, url and
html columns are read; an empty table gives no rows.
"""

from __future__ import annotations

import difflib
import html as entities
import itertools
import json
import pickle
import re
from collections import Counter

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clinicflow.llm.common import ship, written

PART = 32
DEPTH = 100
CONSTANT_PAGES = 4
CONSTANT_SHARE = 0.9
LINK_SHARE = 0.6
PERIOD = 3
BROADCAST_CHARS = 16_000_000

# A tag ends at the next < outside of quotes at the latest, so no page is read over and over for one that isn't closed.
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^<>]*>|</?[a-zA-Z](?:[^<>\"']|\"[^\"]*\"|'[^']*')*+>|[^<]+|<", re.S)
TAG_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'=<>`]+)))?")
CAMEL = re.compile(r"([a-z])([A-Z])")
HIDDEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

# HTML element groups.
RAW = {"script", "style", "noscript", "template", "iframe", "svg", "math", "object", "canvas", "textarea", "select", "audio", "video"}
VOID = {"br", "img", "hr", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd",
    "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
ENDS_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
LIMITS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table", "tbody", "thead", "tfoot"}, "td": {"tr", "table"}, "th": {"tr", "table"}}
BOILERPLATE_TAGS = {"nav", "footer", "aside", "form", "button", "dialog", "menu", "head", "title", "label", "fieldset"}
MAIN_TAGS = {"main", "article"}
BOILERPLATE_WORDS = {
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "adsense", "sponsor", "sponsored", "promo", "promotion", "banner",
    "sidebar", "menu", "nav", "navbar", "navigation", "topbar", "breadcrumb", "breadcrumbs", "masthead", "footer",
    "cookie", "cookies", "consent", "gdpr", "notice", "popup", "modal", "overlay", "alert", "comment", "comments", "disqus",
    "reply", "replies", "related", "recommended", "recommendations", "share", "sharing", "social", "subscribe", "newsletter",
    "signup", "login", "search", "toolbar", "pagination", "pager", "widget", "copyright", "contentinfo", "complementary",
}
HEADER_WORDS = {"header"}


class Element:
    """A block element: its label, its words, and its children (elements and texts)."""

    __slots__ = ("tag", "label", "words", "hidden", "children")

    def __init__(self, tag: str, attributes: dict[str, str]):
        self.tag = tag
        named = " ".join(attributes.get(k, "") for k in ("class", "id", "role"))
        self.words = set(re.split(r"[^a-z0-9]+", CAMEL.sub(r"\1 \2", named).lower())) - {""}
        own = "." .join(sorted(re.sub(r"\d+", "0", w) for w in self.words))
        self.label = f"{tag}.{own}" if own else tag
        self.hidden = (
            "hidden" in attributes or attributes.get("aria-hidden") == "true" or bool(HIDDEN_STYLE.search(attributes.get("style", "")))
        )
        self.children: list = []

    def again(self) -> "Element":
        """The same element without its children."""
        out = Element.__new__(Element)
        out.tag, out.label, out.words, out.hidden, out.children = self.tag, self.label, self.words, self.hidden, []
        return out


class Text:
    """A run of text inside a block, and how many of its characters are link text."""

    __slots__ = ("parts", "linked")
    label = "#"

    def __init__(self):
        self.parts: list[str] = []
        self.linked = 0

    @property
    def value(self) -> str:
        return " ".join("".join(self.parts).split())


class _Open:
    """The open elements of a page. Elements below DEPTH become children of the last one above it: the tree stays
    shallow, the texts keep their order, and parts of a boilerplate element stay hidden with it."""

    def __init__(self, root: Element):
        self.stack: list[tuple[str, Element]] = [(root.tag, root)]
        self.count: Counter[str] = Counter()

    @property
    def tag(self) -> str:
        return self.stack[-1][0]

    def push(self, element: Element, stays: bool) -> None:
        top = self.stack[-1][1]
        if len(self.stack) <= DEPTH:
            top.children.append(element)
        else:
            element.hidden = element.hidden or element_is_boilerplate(top)
            self.stack[DEPTH - 1][1].children.append(element)
        if stays:
            self.stack.append((element.tag, element))
            self.count[element.tag] += 1

    def add_text(self, text: "Text") -> None:
        tag, top = self.stack[-1]
        if len(self.stack) > DEPTH:
            siblings = self.stack[DEPTH - 1][1].children
            if siblings[-1] is not top:  # the element goes on after one that was inside it
                top = top.again()
                siblings.append(top)
                self.stack[-1] = (tag, top)
        top.children.append(text)

    def cut(self, k: int) -> None:
        for tag, _ in self.stack[k:]:
            self.count[tag] -= 1
        del self.stack[k:]

    def close(self, tag: str) -> None:
        if self.count[tag] > 0:
            k = len(self.stack) - 1
            while self.stack[k][0] != tag:
                k -= 1
            self.cut(k)

    def close_implied(self, tag: str) -> None:
        """Ends that a tag implies, looked for in the DEPTH innermost elements."""
        if self.tag == "head" and tag not in ("title", "meta", "link", "base"):
            self.cut(len(self.stack) - 1)
        if self.tag == "p" and len(self.stack) > 1:
            self.cut(len(self.stack) - 1)
        ends = ENDS_BY.get(tag)
        if ends and any(self.count[e] for e in ends):
            for k in range(len(self.stack) - 1, max(0, len(self.stack) - 1 - DEPTH), -1):
                if self.stack[k][0] in LIMITS.get(tag, ()):
                    break
                if self.stack[k][0] in ends:
                    self.cut(k)
                    break


def parse(source: str | None) -> Element:
    """The block tree of a page. Comments, raw elements and hidden inline parts hold no text."""
    root = Element("html", {})
    opened = _Open(root)
    text: Text | None = None
    links = 0
    raw = None
    raw_depth = 0
    for token in TOKEN.findall(source or ""):
        if raw is not None:
            if token[0] == "<" and (name := TAG_NAME.match(token)) and name[1].lower() == raw:
                if token[1] == "/":
                    raw_depth -= 1
                elif raw not in ("script", "style", "textarea", "iframe", "noscript") and not token.endswith("/>"):
                    raw_depth += 1
                if raw_depth == 0:
                    raw = None
            continue
        if token[0] != "<" or len(token) == 1:
            if text is None:
                text = Text()
                opened.add_text(text)
            value = entities.unescape(token)
            text.parts.append(value)
            if links > 0:
                text.linked += len(value.strip())
            continue
        name = TAG_NAME.match(token)
        if name is None:
            continue
        tag, closing = name[1].lower(), token[1] == "/"
        if tag == "br":
            if text is not None:
                text.parts.append(" ")
            continue
        if tag in INLINE:
            if tag == "a":
                links = max(0, links + (-1 if closing else 1))
            continue
        if tag in VOID:
            if tag == "hr":
                text = None
            continue
        if tag in RAW:
            if not closing and not token.endswith("/>"):
                raw, raw_depth = tag, 1
            continue
        text = None
        links = 0
        if closing:
            opened.close(tag)
            continue
        if tag in ("html", "body"):
            continue
        opened.close_implied(tag)
        attributes = {m[1].lower(): entities.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(token, name.end())}
        opened.push(Element(tag, attributes), not token.endswith("/>"))
    return root


# ---- patterns


class Pattern:
    """A part of a wrapper: a tag, a text slot ("#") or a repeated sequence ("(a b)"), optional or repeated."""

    def __init__(self, label: str):
        self.label = label
        self.items: list[Pattern] = []
        self.optional = self.repeated = False
        self.boilerplate = False
        self.main = False
        # A slot's text that can be its most frequent one. It was seen ``votes + lost`` times at most, any other one ``lost`` times.
        self.constant: str | None = None
        self.votes = self.lost = 0
        self.seen = 0
        self.chars = self.linked = 0

    def expression(self) -> str:
        """The wrapper as a regular expression over labels, for reading and tests."""
        if self.label == "#":
            inner = "#"
        else:
            body = " ".join(i.expression() for i in self.items)
            inner = f"({body})" if self.label.startswith("(") else f"<{self.label}>{body}</>"
        return inner + ("+" if self.repeated else "") + ("?" if self.optional else "")


def pattern_of(node) -> Pattern:
    out = Pattern(node.label)
    out.seen = 1
    if isinstance(node, Text):
        out.constant, out.votes = node.value, 1
        out.chars, out.linked = len(out.constant), node.linked
        return out
    out.boilerplate = element_is_boilerplate(node)
    out.main = node.tag in MAIN_TAGS or "main" in node.words
    out.items = squashed([pattern_of(c) for c in node.children if not (isinstance(c, Text) and not c.value)])
    return out


def squashed(items: list[Pattern]) -> list[Pattern]:
    """Equal neighbours and equal short sequences become repeated groups."""
    if not _repeats(items):
        return items
    for period in range(1, PERIOD + 1):
        out: list[Pattern] = []
        for item in items:
            out.append(item)
            while len(out) >= 2 * period and _labels(out[-period:]) == _labels(out[-2 * period : -period]):
                again = out[-period:]
                del out[-period:]
                for k, pattern in enumerate(again):
                    out[-period + k] = merged(out[-period + k], pattern)
                if period == 1:
                    out[-1].repeated = True
                else:
                    group = Pattern("(" + " ".join(_labels(out[-period:])) + ")")
                    group.items = out[-period:]
                    group.repeated, group.seen = True, 1
                    out[-period:] = [group]
            if period > 1 and len(out) > period and out[-period - 1].label == "(" + " ".join(_labels(out[-period:])) + ")":
                group = out[-period - 1]
                group.items = [merged(a, b) for a, b in zip(group.items, out[-period:])]
                del out[-period:]
        items = out
    return items


def _repeats(items: list[Pattern]) -> bool:
    """Whether a sequence stands twice in a row, or after its own group."""
    labels = _labels(items)
    for period in range(1, PERIOD + 1):
        for k in range(len(labels) - period):
            if labels[k : k + period] == labels[k + period : k + 2 * period]:
                return True
            if period > 1 and labels[k] == "(" + " ".join(labels[k + 1 : k + 1 + period]) + ")":
                return True
    return False


def _labels(items: list[Pattern]) -> list[str]:
    return [i.label for i in items]


def merged(a: Pattern, b: Pattern) -> Pattern:
    """One pattern for both; labels are equal."""
    out = Pattern(a.label)
    out.optional, out.repeated = a.optional or b.optional, a.repeated or b.repeated
    out.boilerplate, out.main = a.boilerplate or b.boilerplate, a.main or b.main
    out.seen = a.seen + b.seen
    out.chars, out.linked = a.chars + b.chars, a.linked + b.linked
    if a.label == "#":
        _vote(out, a, b)
    else:
        out.items = squashed(aligned(a.items, b.items))
    return out


def _vote(out: Pattern, a: Pattern, b: Pattern) -> None:
    """The candidate of two slots: equal ones add their votes, the votes of different ones cancel each other.

    A text on CONSTANT_SHARE of the pages stays the candidate. One with a quarter of the votes or fewer is
    dropped: it was seen on five eighths of the pages at most.
    """
    out.lost = a.lost + b.lost
    if a.constant == b.constant:
        out.constant, out.votes = a.constant, a.votes + b.votes
    else:
        more, less = (a, b) if a.votes >= b.votes else (b, a)
        out.constant, out.votes = more.constant, more.votes - less.votes
        out.lost += less.votes
    if 4 * out.votes <= out.seen:
        out.lost += out.votes
        out.constant, out.votes = None, 0


def aligned(left: list[Pattern], right: list[Pattern]) -> list[Pattern]:
    """Matching labels are merged, the rest becomes optional; known groups are recognised on the other side first."""
    if _labels(left) == _labels(right):
        return [merged(x, y) for x, y in zip(left, right)]
    left, right = _grouped(left, right), _grouped(right, left)
    out: list[Pattern] = []
    for kind, a0, a1, b0, b1 in difflib.SequenceMatcher(None, _labels(left), _labels(right), autojunk=False).get_opcodes():
        if kind == "equal":
            out += [merged(x, y) for x, y in zip(left[a0:a1], right[b0:b1])]
            continue
        for item in left[a0:a1] + right[b0:b1]:
            item.optional = True
            out.append(item)
    return out


def _grouped(items: list[Pattern], other: list[Pattern]) -> list[Pattern]:
    groups = {g.label: len(g.items) for g in other if g.label.startswith("(")}
    if not groups:
        return items
    out: list[Pattern] = []
    for item in items:
        out.append(item)
        for label, n in groups.items():
            if len(out) >= n and "(" + " ".join(_labels(out[-n:])) + ")" == label:
                group = Pattern(label)
                group.items, group.seen = out[-n:], 1
                out[-n:] = [group]
    return out


def element_is_boilerplate(element: Element) -> bool:
    return element.hidden or element.tag in BOILERPLATE_TAGS or bool(element.words & BOILERPLATE_WORDS)


def combined(patterns) -> Pattern | None:
    wrapper = None
    for pattern in patterns:
        wrapper = pattern if wrapper is None else merged(wrapper, pattern)
    return wrapper


def infer(pages: list[str]) -> Pattern | None:
    """The wrapper of the different pages among ``pages``."""
    wrapper = combined(pattern_of(parse(source)) for source in dict.fromkeys(pages))
    if wrapper is not None:
        judge(wrapper, wrapper.seen, inside=False, repeated=False)
    return wrapper


def judge(pattern: Pattern, around: int, inside: bool, repeated: bool) -> tuple[int, int]:
    """Marks boilerplate parts; returns the characters and link characters below. ``around``: how often the part around it was seen."""
    repeated = repeated or pattern.repeated
    if pattern.label == "#":
        # Necessary for a text on CONSTANT_SHARE of the pages; the pages are counted exactly by place afterwards.
        same = pattern.constant is not None and pattern.votes + pattern.lost >= CONSTANT_SHARE * pattern.seen
        mostly = pattern.seen >= CONSTANT_PAGES and pattern.seen >= CONSTANT_SHARE * around
        pattern.boilerplate = same and mostly and not repeated and not inside
        return pattern.chars, pattern.linked
    inside = inside or pattern.main
    sums = [judge(item, pattern.seen, inside, repeated) for item in pattern.items]
    chars, linked = sum(s[0] for s in sums), sum(s[1] for s in sums)
    holds_main = _has_main(pattern)
    if not inside and not holds_main and chars and linked > LINK_SHARE * chars and pattern.label != "html":
        pattern.boilerplate = True
    return chars, linked


def _has_main(pattern: Pattern) -> bool:
    return pattern.main or any(_has_main(i) for i in pattern.items)


# ---- packing patterns for the join with their pages


def dumped(pattern: Pattern) -> str:
    def pack(p: Pattern):
        return [p.label, p.constant if p.label == "#" and p.boilerplate else int(p.boilerplate), [pack(i) for i in p.items]]

    return json.dumps(pack(pattern), ensure_ascii=False, separators=(",", ":"))


def loaded(text: str | None) -> dict:
    """Nested lookups: label -> (boilerplate, children); a slot has its constant texts. Equal labels at one place are one part unless all are boilerplate."""

    def unpack(items) -> dict:
        out: dict = {}
        for label, boilerplate, children in items:
            if label.startswith("("):
                for name, entry in unpack(children).items():
                    out[name] = _joined(out.get(name), entry)
            elif label == "#":
                out[label] = _joined(out.get(label), (frozenset([boilerplate] if boilerplate else []), {}))
            else:
                out[label] = _joined(out.get(label), (bool(boilerplate), unpack(children)))
        return out

    return unpack([json.loads(text)])["html"][1] if text else {}


def _joined(a, b):
    if a is None:
        return b
    both = a[0] and b[0]
    return (both | a[0] if isinstance(both, frozenset) and both else both, {**a[1], **b[1]})


def constants(source: str | None, wrapper: dict) -> dict[str, bool]:
    """For each place at which the wrapper has constant texts and the page has texts: whether these are all among them."""
    found: dict[str, bool] = {}

    def walk(element: Element, known: dict, path: list[str]) -> None:
        for child in element.children:
            if isinstance(child, Element):
                if child.label in known:
                    walk(child, known[child.label][1], [*path, child.label])
            elif child.value and known.get("#", (None,))[0]:
                place = json.dumps(path)
                found[place] = found.get(place, True) and child.value in known["#"][0]

    walk(parse(source), wrapper, [])
    return found


def settled(text: str, rejected: set[str]) -> str:
    """A dumped wrapper without the constant texts of some places."""

    def walk(items, path: list[str]) -> None:
        for item in items:
            if item[0] == "#":
                item[1] = 0 if json.dumps(path) in rejected else item[1]
            else:
                walk(item[2], path if item[0].startswith("(") else [*path, item[0]])

    root = json.loads(text)
    walk(root[2], [])
    return json.dumps(root, ensure_ascii=False, separators=(",", ":"))


def has_constants(pattern: Pattern) -> bool:
    return pattern.label == "#" and pattern.boilerplate or any(has_constants(i) for i in pattern.items)


# ---- extraction


def extract(source: str | None, wrapper: dict) -> str:
    root = parse(source)
    found: list[str] = []
    mains = _mains(root, wrapper)
    for element, known in mains or [(root, wrapper)]:
        _collect(element, known, bool(mains), found)
    return " ".join(found)


def _skipped(element: Element, known: dict, inside: bool) -> bool:
    if element_is_boilerplate(element):
        return True
    if not inside and (element.tag == "header" or element.words & HEADER_WORDS) and not _holds_main(element):
        return True
    entry = known.get(element.label)
    return entry is not None and entry[0]


def _holds_main(element: Element) -> bool:
    return any(isinstance(c, Element) and (_is_main(c) or _holds_main(c)) for c in element.children)


def _is_main(element: Element) -> bool:
    return element.tag in MAIN_TAGS or "main" in element.words


def _mains(element: Element, known: dict) -> list[tuple[Element, dict]]:
    """The outermost article or main elements outside boilerplate, in page order."""
    found = []
    for child in element.children:
        if isinstance(child, Element) and not _skipped(child, known, False):
            below = known.get(child.label, (False, {}))[1]
            found += [(child, below)] if _is_main(child) else _mains(child, below)
    return found


def _collect(element: Element, known: dict, inside: bool, found: list[str]) -> None:
    for child in element.children:
        if isinstance(child, Text):
            value = child.value
            if value and value not in known.get("#", (frozenset(),))[0]:
                found.append(value)
        elif not _skipped(child, known, inside):
            _collect(child, known.get(child.label, (False, {}))[1], inside, found)


# ---- tables


def host_of(url):
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    return F.regexp_replace(host, r"^[^@]*@|:\d+$", "")


def wrappers(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", part: int = PART) -> DataFrame:
    """(host, wrapper): one inferred wrapper per host, from all of its different pages, fitted in parts of about ``part`` pages."""
    ship(pages.sparkSession)
    own = pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html"))
    # Hosts of several parts: one in ``part`` rows at most, so their list is broadcast.
    large = written(own.groupBy("host").agg(F.count("*").alias("n")).filter(F.col("n") > part).select("host", F.ceil(F.col("n") / part).alias("parts")), "large-hosts")
    most = large.agg(F.max("parts")).first()[0] or 1
    own = own.filter(F.col("html").isNotNull())
    number = F.coalesce(F.pmod(F.xxhash64("html"), F.col("parts")), F.lit(0))
    # Copies have one number: a part holds each page once, combined in every task before the shuffle.
    parts = own.join(F.broadcast(large), "host", "left").groupBy("host", number.alias("part")).agg(F.collect_set("html").alias("pages"))
    parts = parts.select("host", "part", F.explode(F.array_sort("pages")).alias("html"))

    def fit(batches):
        # The pages of a part come one after the other.
        rows = (row for batch in batches for row in zip(*batch.columns))
        for (host, number), same in itertools.groupby(rows, lambda r: (r[0].as_py(), r[1].as_py())):
            pattern = combined(pattern_of(parse(source.as_py())) for _, _, source in same)
            yield pa.RecordBatch.from_arrays([pa.array([host]), pa.array([number], pa.int64()), pa.array([pickle.dumps(pattern)], pa.binary())], names=["host", "part", "pattern"])

    def join(key, pdf):
        pdf = pdf.sort_values("part")
        return pd.DataFrame({"host": [key[0]], "part": [key[1]], "pattern": [pickle.dumps(combined(map(pickle.loads, pdf["pattern"])))]})

    def finish(batches):
        for pdf in batches:
            found = []
            for wrapper in map(pickle.loads, pdf["pattern"]):
                judge(wrapper, wrapper.seen, inside=False, repeated=False)
                found.append((dumped(wrapper), has_constants(wrapper)))
            yield pd.DataFrame({"host": pdf["host"], "wrapper": [w for w, _ in found], "fixed": [f for _, f in found]})

    patterns = written(parts.mapInArrow(fit, "host string, part long, pattern binary"), "parts")
    while most > 1:
        above = F.floor(F.col("part") / part).alias("above")
        patterns = written(patterns.groupBy("host", above).applyInPandas(join, "host string, part long, pattern binary"), "parts")
        most = -(-most // part)
    fitted = written(patterns.select("host", "pattern").mapInPandas(finish, "host string, wrapper string, fixed boolean"), "fitted")
    fixed = fitted.filter("fixed").select("host", "wrapper")
    if fixed.isEmpty():
        return fitted.select("host", "wrapper")
    rejected = _changing(own, fixed).groupBy("host").agg(F.collect_set("place").alias("rejected"))

    def settle(batches):
        for pdf in batches:
            texts = [t if gone is None else settled(t, set(gone)) for t, gone in zip(pdf["wrapper"], pdf["rejected"])]
            yield pd.DataFrame({"host": pdf["host"], "wrapper": texts})

    return fitted.join(rejected, "host", "left").select("host", "wrapper", "rejected").mapInPandas(settle, "host string, wrapper string")


def _sized(known: DataFrame) -> DataFrame:
    """Wrappers to join pages with: broadcast if they are small."""
    size = known.agg(F.sum(F.length("wrapper") + F.length("host") + 100)).first()[0] or 0
    return F.broadcast(known) if size <= BROADCAST_CHARS else known


def _changing(pages: DataFrame, fixed: DataFrame) -> DataFrame:
    """(host, place): places whose constant texts stand in less than CONSTANT_SHARE of the host's different pages."""
    joined = pages.select("host", F.sha2("html", 256).alias("page"), "html").join(_sized(fixed), "host")

    def run(batches):
        known: dict = {}
        for batch in batches:
            rows = []
            for host, page, source, wrapper in zip(*[c.to_pylist() for c in batch.columns]):
                if wrapper not in known:
                    if len(known) > 1000:
                        known.clear()
                    known[wrapper] = loaded(wrapper)
                rows += [(host, page, place, same) for place, same in constants(source, known[wrapper]).items()]
            hosts, shas, places, same = zip(*rows) if rows else ((), (), (), ())
            columns = [pa.array(c, pa.string()) for c in (hosts, shas, places)] + [pa.array(same, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names=["host", "page", "place", "same"])

    told = joined.mapInArrow(run, "host string, page string, place string, same boolean").distinct()
    share = told.groupBy("host", "place").agg(F.avg(F.col("same").cast("int")).alias("share"))
    return share.filter(F.col("share") < CONSTANT_SHARE).select("host", "place")


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: id, url, ``text`` and ``n_chars``."""
    spark = pages.sparkSession
    ship(spark)
    id_type, url_type = dict(pages.dtypes)[id_col], dict(pages.dtypes)[url_col]
    own = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html"))
    known = written(wrappers(pages, id_col, url_col, html_col), "wrappers")
    joined = own.join(_sized(known), "host", "left").select("page_id", "url", "html", "wrapper")

    def run(batches):
        known: dict = {}
        for batch in batches:
            texts = []
            for source, wrapper in zip(batch.column(2), batch.column(3).to_pylist()):
                if wrapper not in known:
                    if len(known) > 1000:
                        known.clear()
                    known[wrapper] = loaded(wrapper)
                texts.append(extract(source.as_py(), known[wrapper]))
            lengths = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), lengths], names=[id_col, url_col, "text", "n_chars"])

    return joined.mapInArrow(run, f"`{id_col}` {id_type}, `{url_col}` {url_type}, text string, n_chars long")
