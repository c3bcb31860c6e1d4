"""HTML main-text extraction by equivalence-class template deduction.

A page is a row of tokens: tags and text nodes, each told apart by the chain
of containers above it. Over the pages of a host every token has an occurrence
vector (how often it occurs on each page). Tokens with equal vectors form an
equivalence class; a class is large and frequent enough to be template when it
has ``CLASS_SIZE`` tokens, one a page, on more than ``MOST`` of the host's distinct
bodies, and on ``MIN_PAGES`` at least. On a page a class is valid when its tokens come in the class's order, and classes
are nested: one lies within one gap of the other. What valid classes leave
open are the slots. The main slot of a host is the innermost container of its
template that holds more than ``MAIN_SHARE`` of what the slots hold, added up over its
distinct bodies. The main text is the slots' text inside the article: of the page's
``article`` and ``main`` elements those that the main slot lies in or meets (all of them
where the host has no template or the page not its main slot, or where they lie elsewhere),
or the body of a page without such elements; less the elements that stand for menus,
headers, footers, sidebars, notices, adverts, forms and comments by their tag, role
or class.

Vectors are compared by two 30-bit sums of page hashes times counts, which
add up before any shuffle: a host with a third of all pages is no large group.
A copy counts once: pages with the same tokens are one body, and so are pages
with the same longest text of whose text ``NEAR`` or more is on other bodies too.
Where unmarked menus hold so much of the text of nearly all pages, or a host has
fewer than ``MIN_PAGES`` bodies, menus cannot be told from copies and stay.
Template text goes only outside articles: an article that the main slot names
stays whole, however many pages of the host repeat it.

Cases: null or empty html gives an empty text. A null url is a host of its
own. Repeated pages are extracted each. Unclosed and cut-off markup ends with
the page. An empty table gives no rows; extra columns are ignored. Whole pages
are read, whatever their length.
"""

from __future__ import annotations

import html as _html
import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import Scratch, map_arrow

CLASS_SIZE = 3
MOST = 0.5
MIN_PAGES = 3
NEAR = 0.8
MAIN_SHARE = 0.5
ALL = -1  # in place of a token: the whole page

# Names of elements and the words of class, id and role that mark them.
RAW = ("script", "style", "textarea", "title", "iframe")  # without an end tag they last to the end of the page
WHOLE = ("noscript", "template", "svg", "math", "object", "select")  # without one they are tags like others
BOILERPLATE = {"head", "nav", "footer", "aside", "form", "dialog", "button", "menu", "fieldset"}
OUTER_BOILERPLATE = {"header"}
MAIN = {"article", "main"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font",
          "i", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike",
          "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
CONTAINERS = {"html", "head", "body", "div", "section", "article", "main", "nav", "header", "footer", "aside",
              "form", "ul", "ol", "table"}
MARKED = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|nav|navbar|navigation|menus?|sidebar|side|footer|"
    r"cookies?|consent|gdpr|notices?|newsletter|subscribe|popup|modal|overlay|comments?|commentlist|respond|disqus|"
    r"replies|share|sharing|social|related|recommended|breadcrumbs?|login|signup|search|toolbar|complementary|"
    r"contentinfo|alert|alertdialog|dialog)(?:$|[\s_\d-])", re.I)
OUTER_MARKED = re.compile(r"(?:^|[\s_-])(?:header|masthead|banner|topbar)(?:$|[\s_\d-])", re.I)

_LEX = re.compile(
    r"<!--.*?(?:-->|$)"
    r"|<(" + "|".join(RAW) + r")(?=[\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1(?=[\s/>])[^>]*>|$)"
    r"|(</?[a-zA-Z](?:[^>\"']|\"[^\"]*\"|'[^']*')*>)"
    r"|<[/!?a-zA-Z][^>]*(?:>|$)"
    r"|([^<]+|<)", re.S | re.I)
_WHOLE_TAG = re.compile(r"<(/?)(" + "|".join(WHOLE) + r")(?=[\s/>])", re.I)
_ATTRIBUTE = re.compile(r"\s(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HOST = re.compile(r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", re.I)
_WHOLE, _INNER = 1, 2  # boilerplate everywhere; boilerplate only outside the article


def host_of(url: str | None) -> str:
    m = _HOST.match(url or "")
    return m[1].lower() if m else ""


@lru_cache(maxsize=50_000)
def _tag(tag: str) -> tuple[str, bool, int, str]:
    """Name, whether it closes, kind of boilerplate (0: none), what marks it."""
    closing = tag[1] == "/"
    name = re.match(r"</?([a-zA-Z][^\s/>]*)", tag)[1].lower()
    if closing:
        return name, True, 0, name
    marks = " ".join(a or b or c for _, a, b, c in _ATTRIBUTE.findall(tag))
    kind = 0
    if name in BOILERPLATE or name not in MAIN | {"html", "body"} and MARKED.search(marks):
        kind = _WHOLE
    elif name in OUTER_BOILERPLATE or name not in MAIN | {"html", "body"} and OUTER_MARKED.search(marks):
        kind = _INNER
    return name, False, kind, f"{name} {marks}"


def _lexed(source: str) -> list[re.Match]:
    """Tags, text and comments; of a WHOLE element that has its end tag only the start tag."""
    found = list(_LEX.finditer(source))
    ends: dict[int, int] = {}
    opened: dict[str, list[int]] = {}
    for k, m in enumerate(found):
        if m[2] and (tag := _WHOLE_TAG.match(m[2])):
            name = tag[2].lower()
            if not tag[1]:
                if m[2].endswith("/>") and name in ("svg", "math"):
                    ends[k] = k
                else:
                    opened.setdefault(name, []).append(k)
            elif opened.get(name):
                ends[opened[name].pop()] = k
    if not ends:
        return found
    out, k = [], 0
    while k < len(found):
        out.append(found[k])
        k = ends.get(k, k) + 1
    return out


class Page:
    """Tokens of a page in order, and its text pieces."""

    def __init__(self, source: str | None):
        self.tokens: list[int] = []
        self.texts: list[tuple[int, str, bool, bool]] = []  # token place, text, in main, in boilerplate
        self.breaks: set[int] = set()                       # token places where a block ends
        self.long: dict[int, int] = {}                      # place of a text: its code points
        self.has_main = False
        self.ends: dict[int, int] = {}                      # place of a container's tag: place where it ends
        self.spans: dict[int, tuple[int, int]] = {}         # the same as numbers of text pieces
        self.mains: list[int] = []                          # places of outermost main elements
        stack: list[tuple[str, int, bool, bool, int, int]] = []  # name, path, in main, in boilerplate, place, piece
        open_names: dict[str, int] = {}
        path, main, boiler = 0, False, False
        for m in _lexed(source or ""):
            tag, text = m[2], m[3]
            if text is not None:
                said = _html.unescape(text)
                if words := " ".join(said.split()):
                    self.texts.append((len(self.tokens), said, main, boiler))
                    self.long[len(self.tokens)] = len(words)
                    self.tokens.append(xxh64_intdigest(words, path) >> 1)
                elif self.texts:
                    self.texts.append((-1, " ", main, boiler))
                continue
            if tag is None:
                if m[1]:
                    self.breaks.add(len(self.texts))
                continue
            name, closing, kind, marked = _tag(tag)
            if name in WHOLE:
                self.breaks.add(len(self.texts))
                continue
            if name not in INLINE:
                self.breaks.add(len(self.texts))
            self.tokens.append(xxh64_intdigest(("/" if closing else "") + marked, path) >> 1)
            if closing:
                if open_names.get(name):
                    while stack:
                        top, path, main, boiler, at, piece = stack.pop()
                        open_names[top] -= 1
                        self._ended(top, at, piece, len(self.tokens) - 1)
                        if top == name:
                            break
            elif name not in VOID and not tag.endswith("/>"):
                at = len(self.tokens) - 1
                stack.append((name, path, main, boiler, at, len(self.texts)))
                open_names[name] = open_names.get(name, 0) + 1
                if name in CONTAINERS:
                    path = xxh64_intdigest(marked, path)
                boiler = boiler or kind == _WHOLE or kind == _INNER and not main
                if name in MAIN and not boiler:
                    if not main:
                        self.mains.append(at)
                    main = self.has_main = True
        for name, _, _, _, at, piece in stack:
            self._ended(name, at, piece, len(self.tokens))

    def _ended(self, name: str, at: int, piece: int, end: int) -> None:
        if name in CONTAINERS:
            self.ends[at], self.spans[at] = end, (piece, len(self.texts))

    def lengths(self) -> list[int]:
        """Per token the code points of its text, wherever it stands."""
        return [self.long.get(at, 0) for at in range(len(self.tokens))]

    def sizes(self) -> list[int]:
        """Per token the code points that it may give to the main text."""
        out = [0] * len(self.tokens)
        for at, _, main, boiler in self.texts:
            if at >= 0 and not boiler and (main or not self.has_main):
                out[at] = self.long[at]
        return out

    def articles(self, slot: int | None) -> bytearray:
        """Which text pieces belong to an article. ``slot``: place of the main slot."""
        spans = [self.spans[at] for at in self.mains]
        if slot in self.spans:
            first, end = self.spans[slot]
            spans = [(a, b) for a, b in spans if a < end and first < b] or spans
        out = bytearray(len(self.texts))
        for a, b in spans:
            out[a:b] = b"\1" * (b - a)
        return out

    def text(self, template: set[int], slot: int | None = None) -> str:
        """Main text. ``template``: places of template tokens, ``slot``: of the main
        slot. A block goes only as a whole, and none of an article."""
        articles = self.articles(slot)
        blocks: list[list[tuple[int, str]]] = [[]]
        last = None
        for k, (at, said, _, boiler) in enumerate(self.texts):
            if boiler or self.has_main and not articles[k]:
                continue
            if last is not None and any(b in self.breaks for b in range(last + 1, k + 1)):
                blocks.append([])
            blocks[-1].append((at, said))
            last = k

        def fixed(block):
            places = [at for at, _ in block if at >= 0]
            return places and all(at in template for at in places)
        slots = blocks if self.has_main else [x for x in blocks if not fixed(x)]
        if not any(at >= 0 for block in slots for at, _ in block):
            slots = blocks
        return " ".join(" ".join("".join(said for _, said in block) for block in slots).split())


def main_slot(page: Page, template: set[int], token: int | None) -> int | None:
    """Place of the main slot's tag on the page."""
    return next((at for at in sorted(template) if page.tokens[at] == token), None)


def valid_places(page: Page, classes: list) -> set[int]:
    """Places of tokens of the classes that are ordered and nested on the page."""
    return _valid(page.tokens, classes)


def _valid(on_page: list[int], classes: list) -> set[int]:
    where: dict[int, list[int]] = {}
    for at, token in enumerate(on_page):
        where.setdefault(token, []).append(at)
    accepted: list[np.ndarray] = []
    out: set[int] = set()
    for tokens in classes:
        if any(len(where.get(t, ())) != 1 for t in tokens):
            continue
        places = np.array([where[t][0] for t in tokens])
        if (np.diff(places) <= 0).any():
            continue

        def within(a, b):
            gap = np.searchsorted(b, a)
            return (gap == gap[0]).all()
        if all(within(places, other) or within(other, places) for other in accepted):
            accepted.append(places)
            out.update(places.tolist())
    return out


# --- Spark -------------------------------------------------------------------

def _prepared(pages: DataFrame) -> DataFrame:
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return pages.select("page_id", "url", "html", host.alias("host"))


def bodies(prepared: DataFrame) -> DataFrame:
    """(host, body, tokens, sizes, lengths, ends): each page's tokens, equal ones of a
    host once. ``lengths``: of all text, ``ends``: of containers (0: none)."""
    def run(batches):
        for batch in batches:
            found: dict[tuple[str, int], tuple] = {}
            for source, host in zip(*(batch.column(i).to_pylist() for i in range(2))):
                page = Page(source)
                tokens = np.array(page.tokens, dtype=np.int64)
                body = xxh64_intdigest(tokens.tobytes()) >> 1
                if (host, body) not in found:
                    ends = np.zeros(len(tokens), dtype=np.int32)
                    ends[list(page.ends)] = list(page.ends.values())
                    found[host, body] = (tokens, np.array(page.sizes(), dtype=np.int32),
                                         np.array(page.lengths(), dtype=np.int32), ends)
            if found:
                hosts, keys = zip(*found)
                tokens, *numbers = zip(*found.values())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hosts, pa.string()), pa.array(keys, pa.int64()),
                     pa.array(tokens, pa.list_(pa.int64())), *(pa.array(n, pa.list_(pa.int32())) for n in numbers)],
                    names=["host", "body", "tokens", "sizes", "lengths", "ends"])
    pages = map_arrow(prepared.select("html", "host"), run, "host string, body long, tokens array<long>, "
                                                            "sizes array<int>, lengths array<int>, ends array<int>")
    least = F.min(F.struct("sizes", "lengths", "ends")).alias("least")
    return (pages.groupBy("host", "body").agg(F.first("tokens").alias("tokens"), least)
            .select("host", "body", "tokens", "least.sizes", "least.lengths", "least.ends"))


def distinct_bodies(found: DataFrame) -> DataFrame:
    """(host, body, tokens, lengths, ends): one body of each group of near copies, and
    all others."""
    place = F.explode(F.arrays_zip("tokens", "sizes")).alias("at")
    texts = (found.select("host", "body", place).select("host", "body", "at.tokens", "at.sizes")
             .where(F.col("sizes") > 0))
    alone = (texts.groupBy("host", "tokens")
             .agg(F.min("body").alias("least"), F.max("body").alias("most"), F.sum("sizes").alias("size"))
             .where(F.col("least") == F.col("most")))
    own = alone.groupBy(F.col("host").alias("of"), F.col("least").alias("is")).agg(F.sum("size").alias("own"))
    size = F.aggregate("sizes", F.lit(0).cast("long"), lambda total, x: total + x)
    longest = F.element_at("tokens", F.array_position("sizes", F.array_max("sizes")).cast("int"))
    near = F.coalesce("own", F.lit(0)) <= F.lit(1 - NEAR) * F.col("size")
    group = F.when(near & (F.col("size") > 0), longest).otherwise(F.col("body"))
    return (found.withColumn("size", size)
            .join(own, (F.col("host") == F.col("of")) & (F.col("body") == F.col("is")), "left")
            .groupBy("host", group.alias("group"))
            .agg(F.min(F.struct("body", "tokens", "lengths", "ends")).alias("one")).select("host", "one.*"))


def occurrence_sums(found: DataFrame) -> DataFrame:
    """(host, token, pages, total, v1, v2, place): partial sums per slice of rows."""
    def run(batches):
        for batch in batches:
            sums: dict[tuple[str, int], list] = {}
            for host, body, tokens in zip(*(batch.column(i).to_pylist() for i in range(3))):
                h = xxh64_intdigest(str(body))
                h1, h2 = h & 0x3FFFFFFF, h >> 34
                size = max(1, len(tokens))
                counts: dict[int, list] = {}
                for at, token in enumerate(tokens):
                    got = counts.setdefault(token, [0, 0.0])
                    got[0] += 1
                    got[1] += at / size
                for token, (n, place) in counts.items():
                    total = sums.setdefault((host, token), [0, 0, 0, 0, 0.0])
                    total[0] += 1
                    total[1] += n
                    total[2] += h1 * n
                    total[3] += h2 * n
                    total[4] += place
            if sums:
                hosts, tokens = zip(*sums)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hosts, pa.string()), pa.array(tokens, pa.int64()),
                     *(pa.array(c) for c in zip(*sums.values()))],
                    names=["host", "token", "pages", "total", "v1", "v2", "place"])
    return map_arrow(found.select("host", "body", "tokens"), run,
                     "host string, token long, pages long, total long, v1 long, v2 long, place double")


def templates(found: DataFrame) -> DataFrame:
    """(host, template): per host its equivalence classes as JSON, the most
    frequent and largest first, tokens in template order."""
    sums = (occurrence_sums(found).groupBy("host", "token")
            .agg(*(F.sum(c).alias(c) for c in ("pages", "total", "v1", "v2", "place"))))
    hosts = found.groupBy(F.col("host").alias("of")).agg(F.count(F.lit(1)).alias("n"))
    once = sums.where((F.col("pages") == F.col("total")) & (F.col("pages") >= MIN_PAGES))
    frequent = (once.join(hosts, F.col("host") == F.col("of"))
                .where(F.col("pages") > MOST * F.col("n")))
    member = F.struct((F.col("place") / F.col("pages")).alias("place"), "token")
    # the tokens of a class are on the same pages, so a class is no larger than a page
    classes = (frequent.groupBy("host", "pages", "v1", "v2")
               .agg(F.sort_array(F.collect_list(member)).alias("members"))
               .where(F.size("members") >= CLASS_SIZE))
    one = F.struct(F.col("pages").alias("p"), F.size("members").alias("s"), F.col("members.token").alias("t"))
    return classes.groupBy("host").agg(F.to_json(F.sort_array(F.collect_list(one), asc=False)).alias("template"))


def main_slots(found: DataFrame, templates: DataFrame) -> DataFrame:
    """(host, slot): the token that opens a host's main slot."""
    def run(batches):
        for batch in batches:
            sums: dict[tuple[str, int], list] = {}
            numbers = [batch.column(i).flatten().to_numpy() for i in (2, 3)]
            starts = batch.column(2).offsets.to_numpy() - batch.column(2).offsets[0].as_py()
            hosts, pages, templated = (batch.column(i).to_pylist() for i in (0, 1, 4))
            for host, tokens, template, start in zip(hosts, pages, templated, starts):
                lengths, ends = (n[start:start + len(tokens)] for n in numbers)
                template = _valid(tokens, _classes(template))
                upto = np.zeros(len(tokens) + 1, np.int64)
                upto[1:] = lengths
                upto[[at + 1 for at in template]] = 0
                upto = upto.cumsum()
                held = [(tokens[at], at, int(upto[ends[at]] - upto[at])) for at in template if ends[at]]
                for token, at, size in [(ALL, 0, int(upto[-1])), *held]:
                    total = sums.setdefault((host, token), [0, 0, 0])
                    total[0] += size
                    total[1] += at
                    total[2] += 1
            if sums:
                hosts, tokens = zip(*sums)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hosts, pa.string()), pa.array(tokens, pa.int64()), *(pa.array(c) for c in zip(*sums.values()))],
                    names=["host", "token", "size", "at", "pages"])
    of = templates.select(F.col("host").alias("of"), "template")
    joined = found.join(of, F.col("host") == F.col("of"))
    sums = (map_arrow(joined.select("host", "tokens", "lengths", "ends", "template"), run,
                      "host string, token long, size long, at long, pages long")
            .groupBy("host", "token").agg(*(F.sum(c).alias(c) for c in ("size", "at", "pages"))))
    share = F.max(F.when(F.col("token") == ALL, F.col("size"))).alias("all")
    # containers of a template are fewer than the tokens of a page; equal sizes: the inner one
    element = F.struct("size", (-F.col("at") / F.col("pages")).alias("before"), "token")
    held = F.collect_list(F.when(F.col("token") != ALL, element)).alias("held")
    return (sums.groupBy("host").agg(share, held)
            .select("host", F.array_min(F.filter("held", lambda e: e["size"] > F.col("all") * MAIN_SHARE))["token"].alias("slot")))


@lru_cache(maxsize=2_000)
def _classes(template: str | None) -> list:
    return [c["t"] for c in json.loads(template)] if template else []


def extract(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text (main text), n_chars (its code points)."""
    prepared = _prepared(pages)
    scratch = Scratch(pages.sparkSession, "templates")
    read = scratch.write(bodies(prepared), "bodies")
    distinct = scratch.write(distinct_bodies(read), "distinct")
    found = scratch.write(templates(distinct), "templates")
    scratch.drop("bodies")
    slots = main_slots(distinct, found).withColumnRenamed("host", "of")
    found = scratch.write(found.join(slots, F.col("host") == F.col("of"), "left").drop("of"), "slots")
    scratch.drop("distinct")
    scratch.drop("templates")
    # one template row per host: small tables are broadcast by their size, else
    # the shuffled join is split where a host is hot
    joined = prepared.join(found.withColumnRenamed("host", "of"), F.col("host") == F.col("of"), "left")

    def run(batches):
        for batch in batches:
            texts = []
            for source, template, slot in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4))):
                page = Page(source)
                places = valid_places(page, _classes(template))
                texts.append(page.text(places, main_slot(page, places, slot)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return map_arrow(joined.select("page_id", "url", "html", "template", "slot"), run,
                     f"page_id {kind}, url string, text string, n_chars long")
