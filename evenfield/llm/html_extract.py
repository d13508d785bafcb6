"""Main text of web pages by consensus of each host's pages on where it is.

Every page's containers are scored by the text of their blocks outside links and boilerplate (all of it for the
container that holds a block, half for the one around that). The best container's generalised path, its tags and
classes from the root without digits, is the page's vote, by the logarithm of its score. Votes are summed per host in
Spark, and each page is read again: the elements at its host's winning path give its text, or the page's own best
container where it has none at that path.

Text is made of blocks. Character references are decoded, white space inside a block becomes one space, blocks are
trimmed, empty ones go, and the rest are joined by one line feed in page order. Scripts, styles, markup, comments,
navigation, page headers and footers, asides, forms, adverts, notices and reader comments are left out. Buttons go, but for
those within a sentence. Fallback text of objects, which browsers don't show, goes.

Three things tell of boilerplate within the winning container. A plain name (``ads``, ``cookie-notice``) tells of it at once, on
elements that hold blocks. A doubtful one (``share``, ``comment-on-the-law``) only where at least half of the element's text is
links, sentences around a link aside, or where at least half of it repeats over the host. And a block of ``repeat_words`` or more
goes, whatever it is called, if it repeats over the host: it stands on at least ``repeat_share`` of the host's different pages
and on ``repeat_pages`` of them. Pages of one longest block are no different pages, so copies of an article
under several urls don't make it boilerplate, and a page's longest block never goes for being on its own copies. Blocks of doubtful
elements are counted whatever their length. Counts are over all pages, summed in Spark.

What is told of hosts is broadcast only while there are at most ``broadcast_hosts`` and as many repeated blocks; beyond that it is joined
by host and salt, so that no host's pages meet in one task. Null html is empty and gives empty text; a null url is a host
of its own; repeated rows are read each on their own; an empty table gives no rows; extra columns don't matter.
"""

from __future__ import annotations

import html as html_lib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, map_batches, read_table

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^'">]|"[^"]*"|'[^']*')*)>|<[/!?][^>]*(?:>|\Z)|<[a-zA-Z][^>]*(?:>|\Z)|([^<]+|<)""", re.S)
CLASS = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
CLASS_ONLY = re.compile(r"""(?:^|\s)class\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s>"']+))?|["']""")
#: Elements whose content is text up to their end tag, whatever it looks like.
RAW = frozenset("script style title textarea xmp iframe noframes".split())
#: Elements that stand for something else than text; one that is never closed is passed over as if it weren't there.
FALLBACK = frozenset("noscript template svg object canvas audio video".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTAINERS = frozenset("html body article main section div td th center table tbody tr".split())
BLOCKS = CONTAINERS | frozenset("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd pre blockquote figure figcaption address details summary hr header footer nav aside form fieldset thead tfoot caption menu dialog hgroup".split())
DROPPED = RAW | FALLBACK | frozenset("head nav aside footer select option datalist dialog".split())
#: Elements that a name of boilerplate tells of; words, paragraphs, headings and items of an article may have any name.
NAMED = frozenset("div section ul ol dl details center".split())
_P = frozenset({"p"})
SAME_CLOSES = {"li": _P | {"li"}, "dt": _P | {"dt", "dd"}, "dd": _P | {"dt", "dd"}, "tr": _P | {"tr", "td", "th"}, "td": _P | {"td", "th"}, "th": _P | {"td", "th"}}
BOILERPLATE = frozenset(
    "ad ads advert advertisement advertisements adverts adbox banner sponsor sponsored sidebar menu nav navbar navigation breadcrumb breadcrumbs "
    "footer header masthead cookie cookies consent notice notices popup modal overlay newsletter subscribe "
    "comments comment comment-list disqus respond replies pagination pager".split()
)
#: Names that an article's own parts have too.
DOUBTFUL = frozenset("promo promotion social share sharing related recommended widget toolbar skip signup login".split())

_ENDS = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I) for tag in RAW | FALLBACK}


@dataclass(frozen=True)
class HtmlParams:
    broadcast_hosts: int = 100_000
    salts: int = 16
    repeat_words: int = 8
    repeat_pages: int = 5
    repeat_share: float = 0.5


#: First parts of class names that tell of a page's layout, not of what the element is.
LAYOUT = frozenset("has no with without is show hide content main page site".split())
#: Parts of names that tell where an element is or what holds it, so that the other part tells what it is.
STRUCTURE = frozenset(
    "box slot list bar wrap wrapper container block unit area section inner outer panel form thread top bottom left right side above below "
    "post entry article page site main primary secondary global mobile desktop sticky fixed floating inline native in text links link item items "
    "holder zone space label title heading body content row col column group field author meta reply reader readers user users count policy info "
    "law manager dialog bottombar topbar copyright legal terms privacy leaderboard rectangle skyscraper placeholder google dfp toggle button icon js".split()
)
#: Names that an article's own head and parts have as well, so that they count outside of articles only, and alone.
ALONE = frozenset("header masthead notice notices skip widget toolbar signup login".split())


def _known(part: str) -> bool:
    return len(part) < 2 or part in STRUCTURE or part in BOILERPLATE or part in DOUBTFUL or any(c.isdigit() for c in part)


@lru_cache(maxsize=4096)
def is_boilerplate(name: str) -> bool:
    """Whether a class, id or role is a word for boilerplate, or one with parts that tell nothing else."""
    if name in BOILERPLATE:
        return True
    parts = name.split("-")
    return _edge(parts, BOILERPLATE) and all(map(_known, parts))


@lru_cache(maxsize=4096)
def is_doubtful(name: str) -> bool:
    """Whether a name that isn't boilerplate's begins or ends with a word that may stand for it."""
    return name in DOUBTFUL or (not is_boilerplate(name) and _edge(name.split("-"), BOILERPLATE | DOUBTFUL))


def _edge(parts: list[str], words: frozenset[str]) -> bool:
    return len(parts) > 1 and parts[0] not in LAYOUT and any(p in words and p not in ALONE for p in (parts[0], parts[-1]))


def block_hash(text: str) -> int:
    """A block's text as a signed 64-bit hash."""
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def _attribute(pattern: re.Pattern, attrs: str) -> str:
    return " ".join(a or b or c for a, b, c in pattern.findall(attrs)).lower()


class Place:
    """A generalised path: an element's tag and classes below those of the ones around it."""

    __slots__ = ("parent", "name", "depth", "agrees")

    def __init__(self, parent: Place | None, name: str, sought: list[str]):
        self.parent, self.name = parent, name
        self.depth = parent.depth + 1 if parent else 0
        #: Whether the path so far is the beginning of the sought one.
        self.agrees = parent is None or (parent.agrees and self.depth <= len(sought) and sought[self.depth - 1] == name)

    def __str__(self) -> str:
        names, at = [], self
        while at.parent:
            names.append(at.name)
            at = at.parent
        return "".join(f">{n}" for n in reversed(names))


class Holder:
    """An open container: the one around it, and whether it or one around it is at the sought path."""

    __slots__ = ("parent", "place", "number", "inside")

    def __init__(self, parent: Holder | None, place: Place, number: int, sought: list[str]):
        self.parent, self.place, self.number = parent, place, number
        self.inside = (parent is not None and parent.inside) or (place.agrees and place.depth == len(sought) > 0)


class Doubt:
    """An open form or element with a doubtful name; its characters, those in links and those in repeated blocks, with what is in it."""

    __slots__ = ("parent", "form", "chars", "in_links", "repeated", "gone")

    def __init__(self, parent: Doubt | None, form: bool):
        self.parent, self.form, self.gone = parent, form, False
        self.chars = self.in_links = self.repeated = 0

    def add(self, chars: int, in_links: int, repeated: int) -> None:
        self.chars, self.in_links, self.repeated = self.chars + chars, self.in_links + in_links, self.repeated + repeated

    def alone(self, total: int) -> bool:
        """Whether what was counted tells that it goes, on a page of ``total`` characters."""
        if not self.chars:
            return False
        if self.form:
            return 2 * self.chars <= total
        return 2 * max(self.in_links, self.repeated) >= self.chars


@dataclass(frozen=True, slots=True)
class Block:
    text: str
    links: int  # characters in links
    n_links: int  # links that begin in it
    holder: Holder  # the innermost open container
    doubt: Doubt | None  # the innermost open one


@dataclass(frozen=True, slots=True)
class Open:
    tag: str
    place: Place
    dropped: bool
    holder: Holder
    doubt: Doubt | None
    block: int  # where in the stack the nearest block is, itself included; 0 for none
    in_article: bool


def walk(page: str, sought: list[str], doubts: list[Doubt]) -> Iterator[Block]:
    """Raw blocks outside dropped elements; ``doubts`` gets each doubted element, those around it first.

    An open element costs a few small objects, whatever is around it, and an end tag that nothing is open for costs nothing.
    """
    at, size = 0, len(page)
    match = TOKEN.match
    root = Place(None, "", sought)
    stack = [Open("", root, False, Holder(None, root, 0, sought), None, 0, False)]
    count, links, link_chars, n_links, buttons = 0, 0, 0, 0, 0
    plain = False  # whether the block has text outside buttons
    pieces: list[str] = []
    is_open: dict[str, int] = {}  # how many elements of a tag are open
    ends: dict[str, int] = {}  # where the next end tag of a fallback element begins

    def block() -> Block:
        nonlocal pieces, link_chars, n_links, plain
        out = Block("".join(pieces) if plain else "", link_chars, n_links, stack[-1].holder, stack[-1].doubt)
        pieces, link_chars, n_links, plain = [], 0, 0, False
        return out

    def close(k: int) -> None:
        nonlocal links, buttons
        for x in stack[k:]:
            is_open[x.tag] -= 1
            links -= x.tag == "a"
            buttons -= x.tag == "button"
        del stack[k:]

    while at < size:
        m = match(page, at)
        at = m.end()
        text = m[4]
        if text is not None:
            if not stack[-1].dropped:
                pieces.append(text)
                plain = plain or not (buttons or text.replace("&nbsp;", " ").isspace())
                if links:
                    link_chars += len(text)
            continue
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in VOID:
            if tag == "br":
                pieces.append(" ")
            elif tag == "hr" and pieces:
                yield block()
            continue
        if tag in BLOCKS and pieces:
            yield block()
        if m[1]:
            if is_open.get(tag):
                k = len(stack) - 1
                while stack[k].tag != tag:  # all that is passed is closed
                    k -= 1
                close(k)
            continue
        if tag in RAW:
            end = _ENDS[tag].search(page, at)
            stop = page.find(">", end.end()) if end else -1
            at = stop + 1 if stop >= 0 else size
            continue
        if tag in FALLBACK:
            if ends.get(tag, 0) <= at:
                end = _ENDS[tag].search(page, at)
                ends[tag] = end.start() + 1 if end else size + 1
            if ends[tag] > size:
                continue
        if tag in BLOCKS:
            ended = SAME_CLOSES.get(tag, _P)
            while True:  # a block ends an open paragraph, and an item the item before it, with what is open in them
                k = stack[-1].block
                if not k or stack[k].tag not in ended:
                    break
                close(k)
        attrs = m[3]
        marked = tag
        top = stack[-1]
        dropped = top.dropped or tag in DROPPED
        doubt = top.doubt
        count += 1
        doubted = tag == "form"
        if attrs and attrs != "/":
            classes = _attribute(CLASS_ONLY, attrs)
            if classes:
                marked = tag + "." + ".".join(sorted({re.sub(r"[\d>]+", "", c) for c in classes.split()}))
            if not dropped and (tag in NAMED or tag == "table"):
                names = _attribute(CLASS, attrs).replace("_", "-").split()
                if tag == "table":  # of data, whatever it is called, unless its text says otherwise
                    doubted = any(is_boilerplate(n) or is_doubtful(n) for n in names)
                else:
                    dropped = any(is_boilerplate(n) and not (top.in_article and n in ALONE) for n in names)
                    doubted = any(map(is_doubtful, names))
            if not dropped and "hidden" in attrs.lower():
                dropped = any(x[1] and x[1].lower() == "hidden" for x in ATTRIBUTE.finditer(attrs))
        if doubted:
            doubt = Doubt(doubt, tag == "form")
            doubts.append(doubt)
        if tag == "header" and not top.in_article:
            dropped = True
        place = Place(top.place, marked, sought)
        holder = Holder(top.holder, place, count, sought) if tag in CONTAINERS else top.holder
        stack.append(Open(tag, place, dropped, holder, doubt, len(stack) if tag in BLOCKS else top.block, top.in_article or tag in ("article", "main")))
        is_open[tag] = is_open.get(tag, 0) + 1
        links += tag == "a"
        n_links += tag == "a" and not dropped
        buttons += tag == "button"
    if pieces:
        yield block()


@dataclass(frozen=True, slots=True)
class Found:
    text: str
    links: int
    holder: Holder
    counted: bool  # whether it may be boilerplate if the host's pages repeat it


def blocks(page: str, path: str | None = None, repeats: frozenset[int] = frozenset(), repeat_words: int = HtmlParams.repeat_words) -> list[Found]:
    """The blocks that have text and stay; ``repeats`` are the hashes of those that the host's pages repeat.

    A form goes unless most of the page's text is in it: pages made by servers often are one form.
    """
    found, doubts, total = [], [], 0
    for b in walk(page, path.split(">")[1:] if path else [], doubts):
        text = " ".join((html_lib.unescape(b.text) if "&" in b.text else b.text).split())
        if text:
            again = bool(repeats) and block_hash(text) in repeats
            long = text.count(" ") + 1 >= repeat_words
            total += len(text)
            if b.doubt:
                sentence = b.n_links == 1 and b.links < len(text) and text[-1] in ".!?"  # around its link
                b.doubt.add(len(text), 0 if sentence else min(b.links, len(text)), len(text) if again else 0)
            if not (again and long):
                found.append((b, Found(text, b.links, b.holder, long or (b.doubt is not None and not b.doubt.form))))
    for d in reversed(doubts):  # what is in an element counts for those around it
        if d.parent:
            d.parent.add(d.chars, d.in_links, d.repeated)
    for d in doubts:
        d.gone = (d.parent is not None and d.parent.gone) or d.alone(total)
    return [f for b, f in found if not (b.doubt and b.doubt.gone)]


#: What a container's tag is worth.
PRIOR = {"article": 3.0, "main": 2.0, "body": 0.5, "html": 0.1, "": 0.1}


def best_container(found: list[Found]) -> tuple[Holder, float] | None:
    """The container with most text of its own, and its score."""
    scores: dict[int, float] = {}
    holders: dict[int, Holder] = {}
    for f in found:
        worth = max(0, len(f.text) - 2 * f.links)
        for part, at in ((1.0, f.holder), (0.5, f.holder.parent)):
            if worth and at:
                scores[at.number] = scores.get(at.number, 0.0) + part * worth
                holders[at.number] = at
    if not scores:
        return None
    value = lambda n: scores[n] * PRIOR.get(holders[n].place.name.partition(".")[0], 1.0)
    number = max(scores, key=lambda n: (value(n), -n))
    return holders[number], scores[number]


def main_text(page: str, path: str | None, repeats: frozenset[int] = frozenset(), repeat_words: int = HtmlParams.repeat_words) -> str:
    """The text at ``path``, or in the page's own best container, without the blocks that the host's pages repeat."""
    found = blocks(page, path, repeats, repeat_words)
    own = [f.text for f in found if f.holder.inside]
    if not own and (best := best_container(found)):
        within = {None: False}
        for f in found:  # whether the best container is around it; each container is looked at once
            chain, holder = [], f.holder
            while holder not in within:
                chain.append(holder)
                holder = holder.parent
            for h in reversed(chain):
                within[h] = h is best[0] or within[h.parent]
        own = [f.text for f in found if within[f.holder]]
    return "\n".join(own)


def host_of(url: Column) -> Column:
    """The host in lower case without www or m; empty for null."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.regexp_replace(F.lower(host), r"^(www|m)\.", "")


def votes(pages: DataFrame, params: HtmlParams = HtmlParams()) -> DataFrame:
    """(host, path, weight, content, blocks) of each page that has text: its vote, the hash of its longest block, and those of the
    blocks that are boilerplate if other pages repeat them."""

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths, weights, contents, own = [], [], [], [], []
            for host, page in zip(batch.column("host").to_pylist(), batch.column("html")):
                found = blocks(page.as_py() or "", repeat_words=params.repeat_words)
                best = best_container(found)
                if best:
                    longest = max((f.text for f in found), key=lambda t: (len(t), t))
                    hosts.append(host)
                    paths.append(str(best[0].place))
                    weights.append(math.log1p(best[1]))
                    contents.append(block_hash(longest))
                    own.append(sorted({block_hash(f.text) for f in found if f.counted and f.text != longest}))
            columns = [pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(weights, pa.float64()), pa.array(contents, pa.int64()), pa.array(own, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["host", "path", "weight", "content", "blocks"])

    return map_batches(pages.select(host_of(F.col("url")).alias("host"), "html"), vote, "host string, path string, weight double, content long, blocks array<long>")


def winners(voted: DataFrame) -> DataFrame:
    """(host, path): the path with most votes, of equal ones the first by name. Votes are summed before any host's meet."""
    sums = voted.groupBy("host", "path").agg(F.round(F.sum("weight"), 6).alias("weight"))
    return sums.groupBy("host").agg(F.min_by("path", F.struct(-F.col("weight"), F.col("path"))).alias("path"))


def repeated(voted: DataFrame, params: HtmlParams = HtmlParams()) -> DataFrame:
    """(host, repeats): the hashes of the blocks that a host's different pages repeat.

    A page and block is a row of two hashes, told apart and counted before any host's meet. What is listed of a host stands on
    at least ``repeat_share`` of its pages each, so a list is at most 1 / repeat_share times as long as its pages' mean.
    """
    rows = voted.select("host", F.xxhash64("host").alias("h"), "content", "blocks")
    pages = rows.select("h", "host", "content").distinct().groupBy("h", "host").agg(F.count(F.lit(1)).alias("pages")).filter(F.col("pages") >= params.repeat_pages)
    seen = rows.select("h", "content", F.explode("blocks").alias("block")).distinct().groupBy("h", "block").agg(F.count(F.lit(1)).alias("on")).filter(F.col("on") >= params.repeat_pages)
    often = seen.join(pages, "h").filter(F.col("on") >= params.repeat_share * F.col("pages"))
    return often.groupBy("host").agg(F.collect_list("block").alias("repeats"))


def extract(pages: DataFrame, params: HtmlParams = HtmlParams()) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    voted = cut(votes(pages, params))
    hosts = cut(winners(voted).join(repeated(voted, params), "host", "left"))
    own = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    n_hosts, n_repeats = hosts.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size(F.coalesce("repeats", F.array().cast("array<long>")))), F.lit(0))).first()
    if max(n_hosts, n_repeats) <= params.broadcast_hosts:
        rows = own.join(F.broadcast(hosts), "host", "left")
    else:
        salted = hosts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(params.salts - 1))))
        rows = own.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(params.salts)).cast("int")).join(salted, ["host", "salt"], "left")
    types = dict(pages.dtypes)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py() or "", path.as_py(), frozenset(again.as_py() or ()), params.repeat_words) for page, path, again in zip(batch.column("html"), batch.column("path"), batch.column("repeats"))]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return map_batches(rows.select("page_id", "url", "html", "path", "repeats"), read, f"page_id {types['page_id']}, url string, text string, n_chars long")


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read_table(spark, sf_dir, "pages"))
