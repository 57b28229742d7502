"""Main text of web pages by equivalence-class template deduction.

Pages of one host come from a common template. A token is a tag, or a whole
text node, at its path of open tags; its occurrence vector is its count on
each page of the host. Tokens that share an occurrence vector and occur on
every page are an equivalence class; classes are nested by their paths, and
together they are the host's template. What the template doesn't hold are
slots. The text of a page is that of its remaining slots, but for those that
tag, class or id mark as menu, header, footer, sidebar, notice, advert, form
or comments (by whole names; of marks around or on an outermost article or main
element, only one of comments drops it); where the page has an article (or main) element only the slots
inside count. There the template drops whole wrappers only: an element like a div or a list goes if its
tag is in the template and all its text is, too. A heading or paragraph of the article itself stays
although every page has it, and so does an article that has nothing else.

Occurrence vectors are never built: a vector is represented by the sum of a
hash of (page, count) over the pages, so tokens are aggregated per host with
map-side partial sums, and a host of any size is no group of its own.
"""

from __future__ import annotations

import re
from collections import Counter
from decimal import Decimal
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import ensure_checkpoint_dir

PIECE = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z](?:[^>"']|"[^"]*"|'[^']*')*>|</?[a-zA-Z][^>]*(?:>|\Z)|</[^a-zA-Z][^>]*(?:>|\Z)|[^<]+|<""", re.S)
NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
MARKS = re.compile(r"""\s(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
WORD = re.compile("[a-z0-9]+")
RAW = {t: re.compile(rf"</{t}\b[^>]*(?:>|\Z)", re.I) for t in ("script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes")}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em embed font i img ins kbd label map mark meter nobr output picture "
                   "progress q rp rt ruby s samp small source span strike strong sub sup time track tt u var wbr".split())
DROPPED = frozenset("head script style noscript template nav header footer aside form button select textarea iframe object svg canvas "
                    "dialog menu title xmp noembed noframes audio video".split())
MARKED = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu menubar "
                   "breadcrumb breadcrumbs header masthead footer sidebar aside cookie cookies consent gdpr notice notices alert popup modal overlay "
                   "newsletter subscribe signup login search share sharing social related recommended comment comments commentlist disqus reply replies "
                   "respond pagination pager toolbar widget copyright complementary contentinfo".split())
COMMENTS = frozenset("comment comments commentlist disqus reply replies respond".split())
MAIN = {"main": 1, "article": 2}
# an open element of the first kind ends before a start tag of the second
CLOSED_BY = {"p": None, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}
# elements inside an article that go as a whole if the template holds them
WRAPPERS = frozenset("div section ul ol dl table fieldset details center figure".split())
#: Paths and labels longer than this many steps or characters are kept as a running hash.
DEEP, LONG = 64, 200
MIN_PAGES = 3
SPREAD = 1024


def _step(path: str, label: str, depth: int) -> str:
    """The path one tag further down; from DEEP steps on a hash, so that unclosed tags cost no more than others."""
    return f"{path}/{label}" if depth < DEEP else "#" + xxhash.xxh64_hexdigest(f"{path}/{label}")


class Page:
    """A scanned page.

    blocks    (text, in main, dropped by marks, hashes of its text nodes, innermost wrapper or -1)
    tokens    hash -> [count, path, text or None]
    wrappers  (hash of the tag, enclosing wrapper or -1) of the wrappers inside articles, in order
    """

    def __init__(self, page: str):
        self.blocks: list[tuple] = []
        self.tokens: dict[int, list] = {}
        self.wrappers: list[tuple[int, int]] = []
        self._scan(page)

    def _count(self, kind: str, path: str, value: str) -> int:
        key = xxhash.xxh64_intdigest(f"{kind}\0{path}\0{value}") - (1 << 63)
        self.tokens.setdefault(key, [0, path, value if kind == "text" else None])[0] += 1
        return key

    def _scan(self, page: str) -> None:
        top = ("", 0, 0, -1)  # path, dropped, main, wrapper
        stack: list[tuple] = []  # name and the same
        opened: Counter = Counter()
        text: list[str] = []
        hashes: list[int] = []
        path, dropped, main, wrapper = top

        def flush():
            nonlocal text, hashes
            if text:
                joined = " ".join("".join(text).split())
                if joined:
                    self.blocks.append((joined, main, dropped, hashes, wrapper))
                text, hashes = [], []

        def close(k: int):
            for entry in stack[k:]:
                opened[entry[0]] -= 1
            del stack[k:]

        at, end = 0, len(page)
        while at < end:
            m = PIECE.match(page, at)
            at, piece = m.end(), m[0]
            if piece[0] != "<" or piece == "<":
                if not dropped:
                    node = unescape(piece)
                    text.append(node)
                    if not node.isspace():
                        hashes.append(self._count("text", path, " ".join(node.split())))
                elif not piece.isspace():
                    self._count("text", path, " ".join(unescape(piece).split()))
                continue
            named = NAME.match(piece)
            if named is None:  # comment, doctype, processing instruction
                continue
            name = named[1].lower()
            if name not in INLINE:
                flush()
            elif name == "br":
                text.append(" ")
            if piece[1] == "/":
                if opened[name]:
                    close(next(k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name))
            elif piece[-1:] == ">":  # a tag that the end of the page cuts off opens nothing
                if name not in INLINE:
                    while stack and stack[-1][0] in INLINE and opened["p"]:
                        close(len(stack) - 1)
                    if stack and stack[-1][0] in CLOSED_BY and (CLOSED_BY[stack[-1][0]] is None or name in CLOSED_BY[stack[-1][0]]):
                        close(len(stack) - 1)
                path, dropped, main, wrapper = stack[-1][1:] if stack else top
                values = [(x[2] or x[3] or x[4] or "").lower() for x in MARKS.finditer(piece)]
                marks, names = [w for x in values for w in WORD.findall(x)], {n for x in values for n in x.split()}
                label = f"{name}.{'.'.join(sorted(set(marks)))}" if marks else name
                label = label if len(label) <= LONG else label[:20] + "#" + xxhash.xxh64_hexdigest(label)
                tag = self._count("tag", path, label)
                if name in RAW:
                    closing = RAW[name].search(page, at)
                    at = closing.end() if closing else end
                elif name not in VOID and not piece.endswith("/>"):
                    # 1: by a mark that an outermost article (or main) inside overrules
                    gone = 2 if name in DROPPED else 0
                    if name not in ("html", "body") and not MARKED.isdisjoint(names):
                        gone = max(gone, 2 if main == 2 or not COMMENTS.isdisjoint(names) else 1)
                    gone = max(gone, dropped)
                    if main and name in WRAPPERS:
                        self.wrappers.append((tag, wrapper))
                        wrapper = len(self.wrappers) - 1
                    stack.append((name, _step(path, label, len(stack)), 0 if gone == 1 and name in MAIN else gone, max(main, MAIN.get(name, 0)), wrapper))
                    opened[name] += 1
            path, dropped, main, wrapper = stack[-1][1:] if stack else top
        flush()

    def boilerplate(self, template: frozenset) -> list[bool]:
        """Per wrapper: it or one around it is in the template with all its text."""
        whole = [tag in template for tag, _ in self.wrappers]
        for block in self.blocks:
            if not block[3] or not template.issuperset(block[3]):
                at = block[4]
                while at >= 0 and whole[at] is not None:  # an outer wrapper that holds a slot: None, with all around it
                    whole[at] = None
                    at = self.wrappers[at][1]
        out: list[bool] = []
        for k, (_, above) in enumerate(self.wrappers):
            out.append(bool(whole[k]) or (above >= 0 and out[above]))
        return out


def extract(page: str | None, template: frozenset) -> str:
    """The text of a page's slots, given the template's tokens."""
    scanned = Page(page or "")
    blocks = [b for b in scanned.blocks if not b[2]]
    inside = [b for b in blocks if b[1]]
    if inside:
        gone = scanned.boilerplate(template) if template else []
        slots = [b for b in inside if not (gone and b[4] >= 0 and gone[b[4]])] or inside
    else:
        slots = [b for b in blocks if not (b[3] and template.issuperset(b[3]))]
    return "\n".join(b[0] for b in slots)


def scan(page: str):
    """(blocks, tokens) of a page."""
    scanned = Page(page)
    return scanned.blocks, scanned.tokens


def _tokens(batches):
    for batch in batches:
        rows: dict = {}
        for host, url, page_id, page in zip(*(batch.column(c).to_pylist() for c in ("host", "url", "page_id", "html"))):
            tokens = scan(page or "")[1]
            tokens[0] = [1, "", None]  # counts the host's pages
            for key, (count, path, value) in tokens.items():
                vector = xxhash.xxh64_intdigest(f"{page_id}\0{url}\0{count}") >> 24
                entry = rows.setdefault((host, key), [path, value is not None, 0, 0])
                entry[2] += 1
                entry[3] += vector
        columns = [[k[0] for k in rows], [k[1] for k in rows], *([v[i] for v in rows.values()] for i in range(4))]
        kinds = [pa.string(), pa.int64(), pa.string(), pa.bool_(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["host", "token", "path", "is_text", "pages", "vector"])


def with_host(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", "url", "html", F.coalesce(F.lower(F.regexp_extract("url", r"^.*?://([^/?#]*)", 1)), F.lit("")).alias("host"))


def templates(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """host, class, parent, token, path, is_text: the valid equivalence classes
    of each host with at least ``min_pages`` different pages. A class is named by its
    vector; its parent is the class of the nearest enclosing tag outside it."""
    rows = with_host(pages).mapInArrow(_tokens, "host string, token long, path string, is_text boolean, pages long, vector long")
    # a host of any size: the sum is a decimal, cut to a long
    vector = (F.sum(F.col("vector").cast("decimal(38,0)")) % F.lit(Decimal(1 << 62))).cast("long")
    rows = rows.groupBy("host", "token").agg(F.min("path").alias("path"), F.min("is_text").alias("is_text"),
                                             F.sum("pages").alias("pages"), vector.alias("vector")).checkpoint()
    # copies of a page weigh all tokens alike, but don't make a host
    several = with_host(pages).select("host", F.xxhash64("html").alias("page")).distinct().groupBy("host").count().where(F.col("count") >= min_pages)
    hosts = rows.where("token = 0").join(several, "host").select("host", F.col("pages").alias("all"))
    full = rows.where("token <> 0").join(hosts, "host").where(F.col("pages") == F.col("all"))
    sizes = full.groupBy("host", "vector").agg(F.count("*").alias("size"), F.min_by("path", F.length("path")).alias("top")).where("size > 1").checkpoint()
    classes = full.join(sizes.drop("top"), ["host", "vector"]).select("host", F.col("vector").alias("class"), "token", "path", "is_text")
    # nested: the class that has the longest other path above its top
    above = sizes.select("host", F.col("vector").alias("class"), F.explode(F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(F.split("top", "/")) - 1, F.lit(1))),
        lambda n: F.struct(F.array_join(F.slice(F.split("top", "/"), 1, n), "/").alias("prefix"), n.alias("depth")))).alias("p")) \
        .select("host", "class", "p.*")
    tops = sizes.groupBy("host", "top").agg(F.min("vector").alias("parent")).withColumnRenamed("top", "prefix")
    parents = above.join(tops, ["host", "prefix"]).where("parent <> class").groupBy("host", "class").agg(F.max_by("parent", "depth").alias("parent"))
    return classes.join(parents, ["host", "class"], "left").select("host", "class", "parent", "token", "path", "is_text")


def _extract(batches):
    for batch in batches:
        texts = [extract(page, frozenset(t or ())) for page, t in zip(batch.column("html").to_pylist(), batch.column("template").to_pylist())]
        out = pa.array(texts, pa.string())
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), out, pa.array([len(t) for t in texts], pa.int64())],
                                         names=["page_id", "url", "text", "n_chars"])


def main_text(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """page_id, url, text, n_chars per row of pages (page_id, url, html).

    Character references are decoded, white space inside a block becomes one
    space, blocks are joined in page order by a line feed. A null or empty
    page, or one without main text, gives an empty text. Pages whose url is
    null or has no host share the empty host. Unclosed and deeply nested tags cost
    no more memory than others. Hosts with fewer than
    ``min_pages`` different pages have no template. Repeated rows give repeated rows;
    other columns are ignored; an empty table gives no rows.
    """
    ensure_checkpoint_dir(pages.sparkSession)
    # tokens of a template: at most those of the host's smallest page
    known = templates(pages, min_pages).groupBy("host").agg(F.collect_list("token").alias("template")).checkpoint()
    # hosts with at least 1 in SPREAD of the pages (so at most SPREAD of them) are
    # dealt over parts of about that size, each with a copy of the template
    counts = with_host(pages.withColumn("html", F.lit(""))).groupBy("host").count().checkpoint()
    total = counts.agg(F.sum("count")).first()[0] or 0
    hot = F.broadcast(counts.where(F.col("count") * SPREAD >= total).select("host", F.ceil(F.col("count") * SPREAD / F.lit(max(total, 1))).cast("int").alias("parts")))
    dealt = with_host(pages).join(hot, "host", "left").withColumn(
        "part", F.coalesce(F.pmod(F.xxhash64("page_id", "url"), "parts").cast("int"), F.lit(0)))
    copies = known.join(hot, "host", "left").select("host", "template", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("part"))
    return dealt.join(copies, ["host", "part"], "left").select("page_id", "url", "html", "template").mapInArrow(
        _extract, f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long")
