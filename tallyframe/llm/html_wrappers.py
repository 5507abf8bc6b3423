"""HTML extraction by union-free wrappers learned per host.

A page becomes a stream of block tokens: opened and closed containers, leaf
blocks and text slots.  Repeated neighbours fold into groups ``(X)+``.  Streams
of one host are aligned one after the other; what differs becomes an optional
``(X)?`` or a repeated group, text is a slot, and the result is a regular
expression without unions.  The streams are reduced to distinct ones per host
first, and a host with many is aligned in bounded groups, then across them, so
a host with a third of all pages is no large group.  Each page is then parsed
with its host's expression, whose captured content slots are its text.

A slot inside an ``article`` or ``main`` element is content.  On pages without
one the aligned slots decide: a slot whose texts stand on most of the host's
distinct pages is template, the others are content, and slots in menus,
headers, footers, sidebars, notices, adverts, forms and comments are taken only
where nothing else varies.  Where no slot of a page varies, and on a page that
its wrapper can't parse, all slots outside such furniture are its text.  A
``header`` inside an article or ``main`` is the article's own and content; a
paragraph, list item or the like whose class marks it is furniture.  Inside an
article what a marked region holds counts too: one with the article's title is
content, and so is a related section of prose that isn't mostly links.  A
region there that is marked only in part of a token (``page-notice-large``) is
decided by what was learned: its slots are left out where they are template.

Defined results: null or empty html gives empty text; ids and urls may be null
or repeat; pages without a host share one wrapper; every row gives one row.
"""

from __future__ import annotations

import hashlib
import html as entities
import json
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import cached_property, lru_cache
from typing import NamedTuple

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, materialise

#: Streams of one host that one step aligns.
GROUP = 64
#: Longest run of tokens that is tried as a repeated group.
LONGEST = 8
#: Distinct pages that must show a slot before it can count as template.
LEAST_PAGES = 3

#: Elements of the HTML standard by how they are read.
SKIPPED = "script|style|noscript|template|textarea|title|svg|iframe|object|select|button|math|canvas|audio|video"
CONTAINERS = frozenset("html body div section article main nav header footer aside form ul ol dl table tbody thead tfoot tr figure blockquote details dialog menu fieldset search".split())
LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th pre address figcaption caption summary hr legend label option center".split())
FURNITURE = frozenset("nav header footer aside form menu dialog search".split())
#: Words in a class, id or role that mark page furniture.
FURNITURE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment comments complementary consent contentinfo"
    " cookie cookies disqus footer form header hidden menu modal nav navbar navigation newsletter notice pager pagination popup promo"
    " related reply replies respond search share sharing sidebar social sponsor sponsored sponsors subscribe toolbar widget".split()
)
#: Words that may stand beside those in one hyphenated token (``site-header``, ``comment-list``).
PLACE_WORDS = frozenset("area bar block body bottom box container global inner items left link links list main outer page posts primary right secondary section site thread top wrap wrapper".split())
#: Elements that hold the page or its content and never open furniture.
PAGE_ELEMENTS = frozenset("html body main article".split())
#: Leaf blocks whose class, id or role can mark them as furniture; headings and cells can't.
MARKED_LEAVES = frozenset("p li dt dd address figcaption center label legend".split())
#: Furniture in which articles are no content of the page.
SHUT_ELEMENTS = frozenset("nav footer aside menu dialog".split())
SHUT_WORDS = frozenset("comment comments disqus related replies reply respond".split())
#: Words of lists of other posts; a section of prose under such a name can be the article's own.
RELATED_WORDS = frozenset(["related"])
#: Pieces that mark readers' comments, adverts and consent in any token, but for tokens that tell a state.
COMMENT_PIECE = regex.compile(r"comments?|comments?(?:list|area|box|form|wrap|thread|body|text|section)|disqus")
ADVERT_PIECE = regex.compile(r"ads?|adverts?|advertisements?|advertising|sponsor(?:s|ed)?|promo|cookies?|newsletter")
STATE_PIECES = frozenset("no not has have with without is are open opened closed enabled disabled allowed free off count ready policy".split())

TOKEN = regex.compile(
    rf"""<!--.*?(?:-->|\Z)
    |<(?P<skip>{SKIPPED})\b(?:"[^"]*"|'[^']*'|[^>"'])*(?:/>|>.*?(?:</(?P=skip)\s*>|\Z))
    |<(?P<end>/?)(?P<name>[a-z][a-z0-9:-]*)(?P<rest>(?:"[^"]*"|'[^']*'|[^>"'])*+>|[^>]*>)
    |<[!?/][^>]*>
    |<[a-z/!?][^>]*\Z""",
    regex.S | regex.I | regex.X,
)
ATTRIBUTE = regex.compile(r"""\b(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", regex.I)
WORD = regex.compile(r"[a-z]+")


class Mark(NamedTuple):
    """What a tag's name, class, id and role say of its region."""

    key: str
    #: furniture by the element, or by whole tokens of its words
    element: bool
    marked: bool
    content: bool
    #: furniture without content; comments among its words; only words of related posts
    shut: bool
    comment: bool
    related: bool
    #: some piece of a token is a furniture word
    partly: bool


@lru_cache(maxsize=4096)
def _mark(name: str, rest: str) -> Mark:
    """A tag's mark.

    A class, id or role marks furniture as a whole token, or as one in which
    all pieces are furniture or place words: ``site-header`` is, ``no-sidebar``
    and ``search-results`` are not.  Comments, adverts and consent mark by any
    piece of a token (``user-comment-box``), unless another piece tells a state
    (``comments-open``).
    """
    found = [(m[1].lower(), (m[2] or m[3] or m[4] or "").lower()) for m in ATTRIBUTE.finditer(rest)] if "=" in rest else []
    words = [w for _, value in found for w in WORD.findall(value)]
    pieces = [[w for w in WORD.findall(token) if len(w) > 1] for _, value in found for token in value.split()]
    marked = [p for p in pieces if FURNITURE_WORDS.intersection(p) and FURNITURE_WORDS.union(PLACE_WORDS).issuperset(p)]
    lasting = [p for p in pieces if not STATE_PIECES.intersection(p)]
    said = [] if name in PAGE_ELEMENTS else [p for p in lasting if any(map(COMMENT_PIECE.fullmatch, p))]
    paid = [] if name in PAGE_ELEMENTS else [p for p in lasting if any(map(ADVERT_PIECE.fullmatch, p))]
    comment = bool(said) or any(SHUT_WORDS.intersection(p) for p in marked)
    content = name in ("article", "main") or any(a == "role" and "main" in v.split() or a == "itemprop" and "articlebody" in v.split() for a, v in found)
    return Mark(
        ".".join([name, *words]),
        name in FURNITURE,
        bool(marked or said or paid) and name not in PAGE_ELEMENTS,
        content,
        name in SHUT_ELEMENTS or comment and name not in ("html", "body", "main"),
        comment,
        bool(marked) and not paid and all(RELATED_WORDS.intersection(p) for p in marked + said),
        name not in PAGE_ELEMENTS and any(FURNITURE_WORDS.intersection(p) for p in lasting),
    )


class Region:
    """An open or closed container: its mark, and what stands in it."""

    __slots__ = ("name", "mark", "parent", "content", "title", "articles", "prose", "chars", "linked", "furniture", "shut", "weak")

    def __init__(self, name: str, mark: Mark, parent: Region | None) -> None:
        self.name, self.mark, self.parent = name, mark, parent
        self.content = mark.content or parent is not None and parent.content
        self.title = self.articles = self.prose = self.furniture = self.shut = self.weak = False
        self.chars = self.linked = 0

    def note(self, what: str) -> None:
        """Set a flag here and in all regions around."""
        region: Region | None = self
        while region is not None and not getattr(region, what):
            setattr(region, what, True)
            region = region.parent

    def settle(self) -> None:
        """Furniture or content, once the page is read and the region around is settled."""
        mark, around = self.mark, self.parent
        in_content, in_furniture, in_shut, in_weak = (around.content, around.furniture, around.shut, around.weak) if around else (False, False, False, False)
        by_words, shut = mark.marked, mark.shut
        if in_content and not in_shut and self.name not in SHUT_ELEMENTS:
            if mark.related and self.prose and not self.articles and 2 * self.linked < self.chars:
                by_words = shut = False
            elif self.title and not mark.comment:
                by_words = False
        furniture = (mark.element or by_words) and not (self.name == "header" and in_content)
        self.shut = shut or in_shut
        self.furniture = self.shut or not mark.content and (furniture or in_furniture)
        self.weak = not mark.content and (in_weak or in_content and mark.partly and not by_words and not mark.related and not self.title)


def stream(html: str) -> tuple[list[str], list[str]]:
    """Block tokens of a page and the text of each slot, in order.

    Slots are ``#a`` in content elements, ``#w`` there in regions marked in
    part, ``#t`` elsewhere, ``#f`` in furniture.  Of furniture and content the
    innermost counts, but comments, related posts and elements like ``aside``
    hold no content.
    """
    tokens, texts, parts = [], [], []
    stack: list[Region] = []
    regions: list[Region] = []
    slots: list[tuple[int, Region | None, bool]] = []
    at, leaf, link, titled = 0, False, False, False

    def read(piece: str) -> None:
        parts.append(piece)
        if stack:
            stack[-1].chars += len(piece.strip())
            stack[-1].linked += len(piece.strip()) * link

    def flush() -> None:
        text = " ".join(entities.unescape("".join(parts)).split())
        parts.clear()
        if text:
            slots.append((len(tokens), stack[-1] if stack else None, leaf))
            tokens.append("#")
            texts.append(text)

    for m in TOKEN.finditer(html):
        if m.start() > at:
            read(html[at : m.start()])
        at = m.end()
        name = m["name"]
        if not name:
            continue
        name = name.lower()
        if name == "br":
            parts.append(" ")
        elif name == "a":
            link = not m["end"]
        elif name in LEAVES:
            flush()
            mark = _mark(name, m["rest"]) if not m["end"] and name in MARKED_LEAVES and "=" in m["rest"] else None
            leaf = mark is not None and mark.marked and not (name == "p" and mark.comment)
            if not m["end"]:
                tokens.append(name)
                if name == "p" and stack:
                    stack[-1].note("prose")
                elif name == "h1" and not titled and stack and stack[-1].content:
                    titled = True
                    stack[-1].note("title")
        elif name in CONTAINERS:
            flush()
            leaf = False
            if not m["end"]:
                if name == "article" and stack:
                    stack[-1].note("articles")
                stack.append(Region(name, _mark(name, m["rest"]), stack[-1] if stack else None))
                regions.append(stack[-1])
                tokens.append("<" + stack[-1].mark.key)
            elif any(s.name == name for s in stack):
                while stack.pop().name != name:
                    pass
                tokens.append(">" + name)
    read(html[at:])
    flush()
    for region in reversed(regions):
        if region.parent:
            region.parent.chars += region.chars
            region.parent.linked += region.linked
    for region in regions:
        region.settle()
    for k, region, in_leaf in slots:
        if in_leaf or region and region.furniture:
            tokens[k] = "#f"
        elif region and region.content:
            tokens[k] = "#w" if region.weak else "#a"
        else:
            tokens[k] = "#t"
    return tokens, texts


# An expression is a list of tokens, ["+", expression] and ["?", expression].


def _body(node):
    """What a node repeats or leaves out; equal bodies are the same place of a wrapper."""
    while isinstance(node, list):
        node = node[1][0] if len(node[1]) == 1 else [_body(n) for n in node[1]]
        if not (isinstance(node, list) and node and node[0] in ("+", "?")):
            break
    return node


def _name(node) -> str:
    return json.dumps(_body(node))


def fold(tokens: list) -> list:
    """Neighbouring equal runs as one repeated group, shortest runs first."""
    for size in range(1, LONGEST + 1):
        out, i = [], 0
        while i < len(tokens):
            run, times = tokens[i : i + size], 1
            while tokens[i + times * size : i + (times + 1) * size] == run and len(run) == size:
                times += 1
            if times > 1 and not (size == 1 and isinstance(run[0], list)):
                out.append(["+", run])
                i += times * size
            elif times > 1:
                out.append(run[0])
                i += times
            else:
                out.append(tokens[i])
                i += 1
        tokens = out
    return tokens


def _repeats(expression: list) -> list[list]:
    return [n[1] for n in expression if isinstance(n, list) and n[0] == "+" and len(n[1]) > 1]


def _grouped(expression: list, bodies: list[list]) -> list:
    """Single occurrences of runs that the other stream repeats, as groups too."""
    for body in bodies:
        out, i, size = [], 0, len(body)
        while i < len(expression):
            if expression[i : i + size] == body:
                out.append(["+", body])
                i += size
                while i < len(expression) and expression[i] == ["+", body]:
                    i += 1
            else:
                out.append(expression[i])
                i += 1
        expression = out
    return expression


def align(a: list, b: list) -> list:
    """The union-free expression of both: matches kept, repeats widened, differences optional."""
    if a == b:
        return a
    a, b = _grouped(a, _repeats(b)), _grouped(b, _repeats(a))
    out: list = []

    def optional(part: list) -> None:
        for node in part:
            out.append(node if isinstance(node, list) and node[0] == "?" else ["?", [node]])

    for kind, i, k, j, n in SequenceMatcher(None, [_name(x) for x in a], [_name(x) for x in b], autojunk=False).get_opcodes():
        if kind == "equal":
            for x, y in zip(a[i:k], b[j:n]):
                out.append(x if x == y else _wider(x, y))
        else:
            optional(a[i:k])
            optional(b[j:n])
    return out


def _wider(x, y):
    """The more general of two nodes with one body."""
    marks = {m for node in (x, y) for m in _marks(node)}
    body = x
    while isinstance(body, list):
        body = body[1] if len(body[1]) > 1 else body[1][0]
        if isinstance(body, list) and not (body and body[0] in ("+", "?")):
            break
    node = body if isinstance(body, list) else [body]
    if "+" in marks:
        node = [["+", node]]
    if "?" in marks:
        node = [["?", node]]
    return node[0]


def _marks(node) -> Iterator[str]:
    while isinstance(node, list):
        yield node[0]
        node = node[1][0] if len(node[1]) == 1 else None


class Wrapper:
    """A host's expression, compiled over one character per token, with its text slots captured by number."""

    def __init__(self, expression: list) -> None:
        self.expression = expression
        self.codes: dict[str, str] = {}
        self.kinds: list[str] = []
        self.pattern = regex.compile("".join(map(self._compile, expression)))

    def _compile(self, node) -> str:
        if isinstance(node, str):
            code = self.codes.setdefault(node, chr(0xE000 + len(self.codes)))
            if node[0] != "#":
                return code
            self.kinds.append(node)
            return f"({code})"
        # possessive: read once, without trying other divisions; what that can't read is aligned
        return f"(?:{''.join(map(self._compile, node[1]))}){'+' if node[0] == '+' else '?'}+"

    def places(self, tokens: list[str]) -> list[tuple[int, int]] | None:
        """Number of the slot and place of every text token; None if the wrapper can't parse the stream."""
        if any(t not in self.codes for t in tokens):
            return None
        match = self.pattern.fullmatch("".join(self.codes[t] for t in tokens))
        if match is None:
            return self._aligned(tokens)
        return [(slot, at) for slot in range(len(self.kinds)) for at, _ in match.spans(slot + 1)]

    @cached_property
    def _program(self) -> tuple[list[tuple[str, int]], list[list[int]], list[int]]:
        """Tokens of the expression with their slots (-1: none), what may follow each, and what may come first; len(tokens) is the end."""
        tokens: list[tuple[str, int]] = []
        follow: list[list[int]] = []

        def read(nodes: list) -> tuple[list[int], list[int], bool]:
            """First and last tokens of a sequence, and whether it may be empty."""
            first: list[int] = []
            last: list[int] = []
            empty = True
            for node in nodes:
                if isinstance(node, str):
                    tokens.append((node, sum(s >= 0 for _, s in tokens) if node[0] == "#" else -1))
                    follow.append([])
                    a, b, void = [len(tokens) - 1], [len(tokens) - 1], False
                else:
                    a, b, void = read(node[1])
                    if node[0] == "+":
                        for x in b:
                            follow[x] += [y for y in a if y not in follow[x]]
                    void |= node[0] == "?"
                for x in last:
                    follow[x] += [y for y in a if y not in follow[x]]
                first += a if empty else []
                last = last + b if void else b
                empty &= void
            return first, last, empty

        first, last, empty = read(self.expression)
        for x in last:
            follow[x].append(len(tokens))
        return tokens, follow, first + [len(tokens)] * empty

    def _aligned(self, tokens: list[str]) -> list[tuple[int, int]] | None:
        """:meth:`places` by aligning the stream with the expression: for each token the places of the expression that it can be, by what comes before."""
        known, follow, first = self._program
        came: list[dict[int, int]] = []
        reach = dict.fromkeys(first, -1)
        for token in tokens:
            here = {x: before for x, before in reach.items() if x < len(known) and known[x][0] == token}
            came.append(here)
            reach = {}
            for x in here:
                for y in follow[x]:
                    reach.setdefault(y, x)
        if len(known) not in reach:
            return None
        out, at = [], reach[len(known)]
        for k in range(len(tokens) - 1, -1, -1):
            if known[at][1] >= 0:
                out.append((known[at][1], k))
            at = came[k][at]
        return sorted(out)

    def slots(self, tokens: list[str], template: frozenset[int] = frozenset()) -> list[int] | None:
        """Places of the tokens in content slots; None if the wrapper can't parse the stream."""
        places = self.places(tokens)
        if places is None:
            return None
        of = lambda kind, left_out=frozenset(): sorted(at for slot, at in places if self.kinds[slot] == kind and slot not in left_out)
        varying = of("#t", template) or (template and of("#f", template))
        return sorted(of("#a") + of("#w", template)) or of("#w") or varying or of("#t")


@lru_cache(maxsize=512)
def _wrapper(expression: str | None) -> Wrapper | None:
    return Wrapper(json.loads(expression)) if expression is not None else None


def extract(html: str | None, wrapper: Wrapper | None, template: frozenset[int] = frozenset()) -> tuple[str, bool]:
    """Main text of a page, and whether the wrapper parsed it; ``template`` are the host's constant slots."""
    tokens, texts = stream(html or "")
    found = wrapper.slots(tokens, template) if wrapper else None
    parsed = found is not None
    if found is None:
        found = [k for k, t in enumerate(tokens) if t in ("#a", "#w")] or [k for k, t in enumerate(tokens) if t == "#t"]
    number = {k: n for n, k in enumerate(k for k, t in enumerate(tokens) if t[0] == "#")}
    return " ".join(texts[number[k]] for k in found), parsed


def _host(url: str):
    return F.coalesce(F.lower(F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))


def learn_wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(host, expression)``: the wrapper of every host, learned from all its pages."""

    def fold_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "html"):
            found = {(h, json.dumps(fold(stream(t or "")[0]))) for h, t in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist())}
            yield pa.RecordBatch.from_arrays([pa.array(c, type=pa.string()) for c in zip(*sorted(found))] if found else [pa.array([], type=pa.string())] * 2, ["host", "expression"])

    def align_group(table: pa.Table) -> pa.Table:
        streams = [json.loads(e) for e in sorted(table.column("expression").to_pylist(), key=lambda e: (len(e), e))]
        whole = streams[0]
        for other in streams[1:]:
            whole = align(whole, other)
        return pa.table({"host": table.column("host")[:1], "expression": pa.array([json.dumps(whole)])})

    rows = pages.select(_host(url_col).alias("host"), F.col(html_col).alias("html"))
    found = materialise(rows.mapInArrow(fold_pages, "host string, expression string").distinct(), "page-streams")
    while True:
        sizes = found.groupBy("host").agg(F.count(F.lit(1)).alias("streams"))
        most = sizes.agg(F.max("streams")).first()[0] or 0
        if most <= 1:
            return found
        groups = F.pmod(F.xxhash64("expression"), F.ceil(F.col("streams") / GROUP)).alias("part")
        dealt = found.join(sizes, "host").select("host", "expression", groups)
        aligned = dealt.groupBy("host", "part").applyInArrow(align_group, "host string, expression string")
        found = materialise(aligned if most <= GROUP else aligned.distinct(), "wrappers")


def _hash(*texts: str) -> int:
    return int.from_bytes(hashlib.blake2b("\0".join(texts).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def template_slots(joined: DataFrame) -> DataFrame:
    """``(host, template)``: numbers of the slots whose texts stand, on average, on most distinct pages that show the slot.

    Slots in ``article`` and ``main`` are content anyway and not counted.
    """

    def slot_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "html"):
            out = set()
            for host, html, expression in zip(*(batch.column(c).to_pylist() for c in ("host", "html", "expression"))):
                tokens, texts = stream(html or "")
                wrapper = _wrapper(expression)
                places = wrapper and wrapper.places(tokens)
                if not places:
                    continue
                number = {k: n for n, k in enumerate(k for k, t in enumerate(tokens) if t[0] == "#")}
                page, seen = _hash(*texts), set()
                for slot, at in places:
                    if wrapper.kinds[slot] != "#a":
                        row = (host, slot, _hash(texts[number[at]]), page)
                        out.add((*row, slot not in seen))
                        seen.add(slot)
            columns = list(zip(*sorted(out))) or [()] * 5
            types = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, types)], ["host", "slot", "text", "page", "lead"])

    rows = joined.select("host", "html", "expression").mapInArrow(slot_texts, "host string, slot int, text long, page long, lead boolean")
    once = rows.groupBy("host", "slot", "text", "page").agg(F.max("lead").alias("lead"))
    texts = once.groupBy("host", "slot", "text").agg(F.count(F.lit(1)).alias("stands"), F.sum(F.col("lead").cast("long")).alias("pages"))
    slots = texts.groupBy("host", "slot").agg(F.count(F.lit(1)).alias("texts"), F.sum("stands").alias("stands"), F.sum("pages").alias("pages"))
    constant = slots.where((F.col("pages") >= LEAST_PAGES) & (2 * F.col("stands") > F.col("texts") * F.col("pages")))
    return constant.groupBy("host").agg(F.sort_array(F.collect_set("slot")).alias("template"))


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(id_col, url_col, text, parsed)``: the main text of every whole page, read with its host's wrapper."""
    wrappers = learn_wrappers(pages, url_col, html_col)
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), _host(url_col).alias("host"))
    template = materialise(template_slots(rows.join(wrappers, "host")), "template-slots")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "html"):
            out = [extract(t, _wrapper(e), frozenset(s or ())) for t, e, s in zip(*(batch.column(c).to_pylist() for c in ("html", "expression", "template")))]
            columns = [batch.column("id"), batch.column("url"), pa.array([t for t, _ in out], type=pa.string()), pa.array([p for _, p in out], type=pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "url", "text", "parsed"])

    kind = pages.schema[id_col].dataType.simpleString()
    joined = rows.join(wrappers, "host", "left").join(template, "host", "left").select("id", "url", "html", "expression", "template")
    return joined.mapInArrow(read, f"id {kind}, url string, text string, parsed boolean").withColumnsRenamed({"id": id_col, "url": url_col})
