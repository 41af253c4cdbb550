"""Main text of web pages: subtrees that recur across pages of a host are its templates and go, then what tags and classes call no main text."""

from __future__ import annotations

import html as entities
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lower_batches, materialize

NAME = re.compile(r"[A-Za-z][^\s/>]*+")
#: One attribute after a tag's name: its name, and its value in double quotes, in single ones or bare.
ATTRIBUTE = re.compile(r"""[\s/]*+(?:([^\s/>=][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]*+)))?+)?+""")
TOLD = {"class", "id", "role", "hidden", "aria-hidden", "style"}
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "template", "svg", "math"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
DROPPED = RAW | {"head", "nav", "header", "footer", "aside", "form", "button", "select", "noscript", "object", "canvas", "audio", "video", "dialog", "menu", "fieldset"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q", "rb", "rp", "rt", "rtc", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
PARAGRAPH_ENDS = {"address", "article", "aside", "blockquote", "details", "div", "dl", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "main", "menu", "nav", "ol", "p", "pre", "section", "table", "ul"}
#: Elements that a start tag closes, and those that keep it from doing so.
CLOSES = {"li": (("li",), ("ul", "ol")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "tr": (("tr",), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")), "option": (("option",), ("select",))}
CLOSES |= {name: (("p",), ("table", "td", "button", "object")) for name in PARAGRAPH_ENDS}
MAIN = {"article", "main"}
#: Elements that may be deleted as a site's template wherever they are; text elements of an article (paragraphs, headings) may rightly recur.
BOXES = {"div", "section", "ul", "ol", "dl", "table", "span", "a", "figure", "details", "center", "blockquote"} | DROPPED
TEXTS = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "pre", "td", "th", "tr", "dt", "dd"}
NAMED = re.compile(r"(?:^|[\s_-])(?:ad|ads|advert\w*|adsense|adbox|banner|sponsor\w*|promo\w*|sidebar\w*|nav\w*|menu\w*|breadcrumb\w*|masthead|site-?header|site-?footer|footer|cookie\w*|consent|gdpr|popup|modal|newsletter|subscri\w*|signup|login|comments?|commentlist|disqus|share|sharing|social\w*|related|recommend\w*|pagination|pager|skip-link)(?:$|[\s_-])", re.I)
#: Names that content can have as well: they count where nothing of a page is known to recur, and outside of articles.
VAGUE = re.compile(r"(?:^|[\s_-])(?:side|header|foot|topbar|toolbar|notice\w*|alert|overlay|reply|replies|legal|copyright|widget\w*|tags|toc|share\w*|related\w*)(?:$|[\s_-])", re.I)
#: Classes that say what an element has or lacks, not what it is.
STATES = re.compile(r"(?:has|with|without|no|is)[_-][\w-]+", re.I)
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
IN_HEAD = {"meta", "link", "title", "style", "script", "base", "noscript", "template", "html", "head"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu", "menubar", "toolbar"}
#: A subtree is a template if it recurs with PAGES different pages of its host, and with this share of them; boxes also with MANY pages.
PAGES, SHARE, MANY = 4, 0.2, 100
#: Templates of at most this number are broadcast (8 bytes each); more are joined by a shuffle.
FEW = 2_000_000
#: What is known of an element.
DROP, MAYBE, IS_MAIN, BOX, TEXT = 1, 2, 4, 8, 16


def told(name: str, attributes: dict[str, str]) -> int:
    """DROP if tag, role, class or style say that an element is no main text, MAYBE if a class may say so."""
    if name in DROPPED:
        return DROP
    if not attributes or name in ("html", "body") or name in MAIN:
        return 0
    out = 0
    for key, value in attributes.items():
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "role" and value.lower() in ROLES or key == "style" and HIDDEN.search(value):
            return DROP
        if key in ("class", "id"):
            value = STATES.sub("", value)
            if NAMED.search(value):
                return DROP
            out |= MAYBE * bool(VAGUE.search(value))
    return out


class Page:
    """Blocks of a page's text, each with the element that holds it, and the elements around texts with digests of their subtrees.

    A digest is that of the element's name, its own texts and the digests of the elements inside.  Each character of the page is looked at
    a bounded number of times, and each element is opened and closed once: time is linear in the page's length.
    """

    def __init__(self, html: str | None):
        self.blocks: list[str] = []
        self.owner: list[int] = []
        self.parent, self.flags, self.digest = [-1], [0], [0]
        self._names, self._stack = [""], [0]
        self._inside: list[list[bytes]] = [[]]
        self._open: dict[str, list[int]] = {}
        self._held: list[str] = []
        if html:
            self._read(html)
        self._flush()
        self._close(1)
        self._trim()

    def _flush(self) -> None:
        if self._held:
            text = " ".join(entities.unescape("".join(self._held)).split())
            self._held.clear()
            if text:
                self.blocks.append(text)
                self.owner.append(self._stack[-1])
                self._inside[self._stack[-1]].append(xxhash.xxh3_64_digest(text.encode("utf-8", "replace")))

    def _close(self, n: int) -> None:
        """Closes the elements from place n of the stack on."""
        while len(self._stack) > n:
            e = self._stack.pop()
            self._open[self._names[e]].pop()
            if self._inside[e]:
                digest = xxhash.xxh3_64_digest(self._names[e].encode("utf-8", "replace") + b"\0" + b"".join(self._inside[e]))
                self._inside[self.parent[e]].append(digest)
                # 0 stands for none.
                self.digest[e] = int.from_bytes(digest, "little", signed=True) or 1
            self._inside[e] = []

    def _start(self, name: str, attributes: dict[str, str]) -> None:
        if name not in INLINE:
            self._flush()
        if name in CLOSES:
            same, stop = (max((self._open[x][-1] for x in names if self._open.get(x)), default=0) for names in CLOSES[name])
            if same > stop:
                self._close(same)
        if name not in IN_HEAD and self._open.get("head"):
            self._flush()
            self._close(self._open["head"][0])
        if name in VOID:
            return
        flags = told(name, attributes) | IS_MAIN * (name in MAIN) | BOX * (name in BOXES) | TEXT * (name in TEXTS)
        if flags & DROP:
            self._flush()
        self._open.setdefault(name, []).append(len(self._stack))
        self.parent.append(self._stack[-1])
        self._stack.append(len(self._names))
        self._names.append(name)
        self.flags.append(flags)
        self.digest.append(0)
        self._inside.append([])

    def _end(self, name: str) -> None:
        places = self._open.get(name)
        if not places:
            if name in ("br", "p"):
                self._flush()
            return
        n = places[-1]
        if name not in INLINE or any(self._names[e] not in INLINE for e in self._stack[n:]):
            self._flush()
        self._close(n)

    def _read(self, html: str) -> None:
        at, size = 0, len(html)
        while at < size:
            here = html.find("<", at)
            if here < 0:
                self._held.append(html[at:])
                return
            if here > at:
                self._held.append(html[at:here])
            next_ = html[here + 1 : here + 2]
            if next_ in ("!", "?"):
                if html.startswith("<!--", here):
                    end, more = html.find("-->", here + 4), 3
                elif html.startswith("<![CDATA[", here):
                    end, more = html.find("]]>", here), 3
                    self._held.append(entities.escape(html[here + 9 : end if end >= 0 else size]))
                else:
                    end, more = html.find(">", here), 1
                at = size if end < 0 else end + more
                continue
            m = NAME.match(html, here + 1 + (next_ == "/"))
            if m is None:
                self._held.append("<")
                at = here + 1
                continue
            name, at, attributes = m[0].lower(), m.end(), {}
            while at < size and html[at] != ">":
                found = ATTRIBUTE.match(html, at)
                at = found.end()
                if found[1] is None:
                    # What is left are signs that no attribute begins with.
                    at += at < size and html[at] != ">"
                elif (key := found[1].lower()) in TOLD:
                    attributes.setdefault(key, found[2] or found[3] or found[4] or "")
            if at >= size:
                return
            closed = html[at - 1] == "/"
            at += 1
            if next_ == "/":
                self._end(name)
            elif name in RAW:
                self._start(name, {})
                stop = re.compile(rf"</{re.escape(name)}\s*+>", re.I).search(html, at)
                at = stop.end() if stop else size
                self._close(len(self._stack) - 1)
            else:
                self._start(name, attributes)
                if closed and name not in VOID and name not in INLINE and name not in PARAGRAPH_ENDS:
                    self._close(len(self._stack) - 1)

    def _trim(self) -> None:
        """Leaves only elements with text below them."""
        keep = [0] + [e for e in range(1, len(self._names)) if self.digest[e]]
        new = {e: i for i, e in enumerate(keep)}
        self.parent = [-1] + [new[self.parent[e]] for e in keep[1:]]
        self.flags, self.digest = [self.flags[e] for e in keep], [self.digest[e] for e in keep]
        self.owner = [new[e] for e in self.owner]
        del self._names, self._stack, self._inside, self._open, self._held


def main_text(blocks: list[str], owner: list[int], parent: list[int], flags: list[int], gone: list[int]) -> str:
    """The blocks that are left.  gone, by element: 0 no template, 1 boxes of its digest go, 2 all of its digest go.

    Only what is inside of article and main elements counts, if there are any.  What holds an article is no template, whatever recurs.
    """
    known = any(gone)
    n = len(parent)
    lost, inside = [False] * n, [False] * n
    cut, maybe = [False] * n, [False] * n
    any_main = False
    for e in range(1, n):
        up, f = parent[e], flags[e]
        main = bool(f & IS_MAIN)
        lost[e] = lost[up] or bool(f & DROP)
        inside[e] = inside[up] or main
        any_main |= main and not lost[e]
        cut[e] = not main and (cut[up] or gone[e] > 0 and bool(f & BOX) or gone[e] > 1 and bool(f & TEXT) and not inside[e])
        maybe[e] = not main and (maybe[up] or bool(f & MAYBE) and (not known or not inside[e]))
    return " ".join(b for b, e in zip(blocks, owner) if not (lost[e] or cut[e] or maybe[e]) and (inside[e] or not any_main))


def extract(pages: DataFrame, few: int = FEW) -> DataFrame:
    """page_id, url, text, n_chars of every row of pages (page_id, url, html).

    The subtrees of all elements are hashed and counted by host over its different pages (copies of a page count once).  A box goes if its
    subtree is on PAGES pages and on SHARE of the host's pages or on MANY; a paragraph, heading or cell outside of articles if it is on
    PAGES pages and on SHARE of them.  What tags, roles and telling classes call no main text goes as well, as reader comments and forms differ from page to
    page; vague class names count only outside of articles and on pages of which nothing recurs.

    A null html is an empty one and gives an empty text; pages without a host (a null url, say) have no templates; rows that repeat,
    repeat; an empty table gives an empty result; other columns are ignored.
    """
    spark = pages.sparkSession
    lower_batches(spark)
    kinds = {c: pages.schema[c].dataType.simpleString() for c in ("page_id", "url")}
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)", 1))
    host = F.when(host != "", F.xxhash64(host))
    lists = lambda values, kind: pa.array(values, pa.list_(kind))

    def parse(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 100):
                part = batch.slice(at, 100)
                found = [Page(h) for h in part.column(3).to_pylist()]
                page = [xxhash.xxh3_64_intdigest("\n".join(p.blocks).encode("utf-8", "replace")) >> 1 for p in found]
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(page, pa.int64()), lists([p.blocks for p in found], pa.string()), lists([p.owner for p in found], pa.int32()), lists([p.parent for p in found], pa.int32()), lists([p.flags for p in found], pa.int32()), lists([p.digest for p in found], pa.int64())], ["page_id", "url", "host", "page", "blocks", "owner", "parent", "flags", "digest"])

    form = f"page_id {kinds['page_id']}, url {kinds['url']}, host long, page long, blocks array<string>, owner array<int>, parent array<int>, flags array<int>, digest array<long>"
    parsed = materialize(pages.select("page_id", "url", host.alias("host"), "html").mapInArrow(parse, form).withColumn("row", F.monotonically_increasing_id()), "parsed")
    template = materialize(templates(parsed), "templates")
    n = template.count()
    width = {c: form.split(f"{c} ")[1].split(",")[0] for c in ("page_id", "url")}
    result = f"page_id {width['page_id']}, url {width['url']}, text string"

    def cleaned(batch: pa.RecordBatch, levels: list[list[int]]) -> pa.RecordBatch:
        cols = [batch.column(c).to_pylist() for c in ("blocks", "owner", "parent", "flags")]
        return pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array([main_text(*row) for row in zip(*cols, levels)], pa.string())], ["page_id", "url", "text"])

    if n <= few:
        # Sorted 64-bit keys and their levels: 9 bytes for each of `few` at most.
        got = template.orderBy("subtree").toArrow()
        shared = spark.sparkContext.broadcast((got["subtree"].to_numpy(), got["level"].to_numpy().astype(np.int8)))

        def run(batches):
            key, level = shared.value
            for batch in batches:
                for at in range(0, batch.num_rows, 100):
                    part = batch.slice(at, 100)
                    digest = part.column("digest").combine_chunks() if isinstance(part.column("digest"), pa.ChunkedArray) else part.column("digest")
                    own, size = digest.flatten().to_numpy(), np.array([len(x) for x in digest])
                    own = keyed(own, np.repeat(part.column("host").fill_null(0).to_numpy(), size))
                    place = np.minimum(np.searchsorted(key, own), max(0, len(key) - 1))
                    found = np.where(key[place] == own, level[place], 0) if len(key) else np.zeros(len(own), np.int8)
                    yield cleaned(part, [x.tolist() for x in np.split(found, np.cumsum(size)[:-1])] if len(size) else [])

        out = parsed.select("page_id", "url", "host", "blocks", "owner", "parent", "flags", "digest").mapInArrow(run, result)
    else:
        # Subtrees of a page that are templates come to its row; both sides are dealt to SALT parts, as one menu may be on a third of all pages.
        salted = template.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
        own = subtrees(parsed.select("host", "row", "digest"), "row").withColumn("salt", F.pmod("row", F.lit(SALT)).cast("int"))
        gone = own.join(salted, ["subtree", "salt"]).groupBy("row").agg(F.map_from_entries(F.collect_set(F.struct("subtree", "level"))).alias("gone"))

        def run(batches):
            for batch in batches:
                for at in range(0, batch.num_rows, 100):
                    part = batch.slice(at, 100)
                    levels = []
                    for h, digest, pairs in zip(*(part.column(c).to_pylist() for c in ("host", "digest", "gone"))):
                        have = dict(pairs or ())
                        levels.append([have.get(x, 0) for x in keyed(np.array(digest, np.int64), np.full(len(digest), h or 0)).tolist()])
                    yield cleaned(part, levels)

        out = parsed.join(gone, "row", "left").select("page_id", "url", "host", "blocks", "owner", "parent", "flags", "digest", "gone").mapInArrow(run, result)
    return out.withColumn("n_chars", F.length("text").cast("long"))


#: Parts that the pages of one template are dealt to.
SALT = 16


def keyed(digest: np.ndarray, host: np.ndarray) -> np.ndarray:
    """One 64-bit key of a subtree on a host, as the SQL of subtrees() makes it."""
    with np.errstate(over="ignore"):
        return digest.astype(np.int64) ^ (host.astype(np.int64) << np.int64(1) | (host.astype(np.int64) >> np.int64(63) & np.int64(1)))


def subtrees(rows: DataFrame, *more: str) -> DataFrame:
    """host, subtree (its key on this host) and more for each different subtree of each row with a host."""
    digest = F.explode(F.array_distinct(F.filter("digest", lambda d: d != 0)))
    key = F.col("d").bitwiseXOR(F.shiftleft("host", 1).bitwiseOR(F.shiftrightunsigned("host", 63)))
    return rows.where("host is not null").select("host", *more, digest.alias("d")).select("host", *more, key.alias("subtree"))


def templates(parsed: DataFrame) -> DataFrame:
    """subtree (its key on its host), level: 1 if boxes of it are templates, 2 if text elements are, too."""
    # Of equal pages of a host one counts.
    unique = parsed.where("host is not null").select("host", "page", "digest").dropDuplicates(["host", "page"])
    total = unique.groupBy("host").agg(F.count("*").alias("pages"))
    often = subtrees(unique).groupBy("host", "subtree").agg(F.count("*").alias("n")).where(F.col("n") >= PAGES)
    wide = F.col("n") >= SHARE * F.col("pages")
    return often.join(total, "host").where(wide | (F.col("n") >= MANY)).groupBy("subtree").agg(F.max(F.when(wide, 2).otherwise(1)).alias("level"))
