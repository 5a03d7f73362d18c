"""Main text of web pages by differencing with the nearest page of the host.

Pages are ordered by host and URL path; each is paired with that of its two neighbours on the host whose path
is nearer by edit distance. The text lines of both (one per block, in page order) are aligned by a longest common
subsequence, and lines that both have are deleted: what a site repeats is not the article.

Differencing alone errs in two ways, so it works together with the page's own marks. Lines inside menus, headers,
footers, sidebars, notices, adverts, forms, scripts, styles and comment sections go even where no neighbour has the same
ones. Lines inside an ``article`` or ``main`` element stay even where a neighbour has the same ones (copies of
articles and passages that several articles share). Inside an article a name that an article's own section may
have as well (``WEAK``, or any name given by an id alone) decides only together with the alignment: such lines go if the
neighbour has them and is not itself a copy of the article. The alignment decides about all other lines; in a page that
has an article, of those lines only a first-level heading can stay. Where deletion would leave nothing of a
page without an article, the neighbour is taken for a copy and nothing is deleted.

Defined results: a null or empty html gives an empty text; a page without a neighbour on its host loses no lines by
alignment; a null or bad URL puts the page on a host of its own name (empty). Equal rows give equal rows. An empty
table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import html as references
import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskengine.llm.store import materialise

MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""", re.S
)
ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
#: Their content is no text.
RAW = {"script", "style", "template", "noscript", "iframe", "svg", "math", "object", "canvas", "audio", "video", "head", "title"}
RAW_ENDS = {tag: re.compile(rf"</{tag}\b[^>]*>" + (r"|(?=<body\b)" if tag == "head" else ""), re.I) for tag in RAW}
#: Elements that hold what surrounds an article.
AROUND = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "select", "textarea", "fieldset", "label"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small",
    "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Words of class or id, and roles, that name what surrounds an article.
NAMES = set(
    """ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe
    subscription signup sidebar menu nav navbar navigation breadcrumb breadcrumbs footer masthead share sharing social related recommended widget toolbar login pagination pager skip""".split()
)
READERS = {"comment", "comments", "commentlist", "disqus", "respond", "replies", "discussion"}
#: Names that sections of an article have too.
WEAK = set(
    "alert banner consent discussion login menu navigation notice notices overlay pagination popup promotion recommended related replies respond sharing skip social subscription toolbar widget".split()
)
#: Elements that may be such sections; all others end too freely to be followed.
SECTIONS = {"div", "section", "ul", "ol", "dl", "table", "details"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "alertdialog", "dialog", "menu", "menubar", "toolbar"}
SPLIT = re.compile(r"[^a-zA-Z]+|(?<=[a-z])(?=[A-Z])")
OPEN, ARTICLE, AROUND_IT, HEADING, DOUBTFUL = 0, 1, 2, 3, 4


def _marks(tag: str, text: str, inside: bool = False) -> str | None:
    """``around`` or ``readers`` if the element's attributes name such a part; ``doubtful`` if it stands
    ``inside`` an article and its name may be that of a section."""
    if not text or tag in ("html", "body", "main"):
        return None
    found = {}
    for m in ATTRIBUTE.finditer(text):
        found.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    classes, words = ({w.lower() for w in SPLIT.split(x) if w} for x in (found.get("class", ""), f"{found.get('class', '')} {found.get('id', '')}"))
    if words & (READERS - WEAK if inside else READERS):
        return "readers"
    if tag == "article":
        return None
    role = found.get("role", "").lower()
    if role in ROLES or "hidden" in found or found.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none", found.get("style", ""), re.I):
        return "around"
    if inside and not classes & (NAMES - WEAK):
        return "doubtful" if words & (NAMES | WEAK) else None
    return "around" if words & NAMES else None


def page_lines(page: str) -> list[tuple[int, str]]:
    """(part, line) of each block with text, in page order."""
    out: list[tuple[int, str]] = []
    text: list[str] = []
    skip: list | None = None  # tag, depth, kind of the surrounding part that is being read
    doubt: list | None = None  # tag, depth of the doubtful section that is being read
    article = heading = 0
    at = 0

    def close() -> None:
        if text:
            line = " ".join(references.unescape("".join(text)).split())
            text.clear()
            if line:
                out.append((AROUND_IT if skip else DOUBTFUL if doubt else ARTICLE if article else HEADING if heading else OPEN, line))

    while m := MARKUP.search(page, at):
        if m.start() > at:
            text.append(page[at : m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        ending = bool(m[1] or m[4])
        attributes = m[3] or m[6] or ""
        if tag in RAW:
            if not ending and not attributes.endswith("/"):
                close()
                end = RAW_ENDS[tag].search(page, at)
                at = end.end() if end else len(page)
            continue
        if tag not in INLINE:
            close()
        if skip and tag in ("article", "main") and not ending and skip[2] != "readers" and _marks(tag, attributes) != "readers":
            skip = None  # a part that was never closed, or that wraps the page
        if skip:
            if tag == skip[0] and tag not in VOID:
                skip[1] += -1 if ending else 1
                if skip[1] == 0:
                    close()
                    skip = None
            continue
        if ending:
            if doubt and tag == doubt[0]:
                doubt[1] -= 1
                doubt = doubt if doubt[1] else None
            if tag in ("article", "main") and article:
                article -= 1
                doubt = doubt if article else None
            elif tag == "h1":
                heading = 0
            continue
        if tag in VOID or attributes.endswith("/"):
            continue
        kind = _marks(tag, attributes, article > 0)
        if kind in (None, "doubtful") and tag in AROUND and not (tag == "header" and article):
            kind = "around"
        if kind == "doubtful":
            if doubt is None and tag in SECTIONS:
                doubt = [tag, 1]
                continue
            kind = None
        if kind:
            close()
            skip = [tag, 1, kind]
            continue
        if doubt and tag == doubt[0]:
            doubt[1] += 1
        if tag in ("article", "main"):
            article += 1
        elif tag == "h1":
            heading = 1
    text.append(page[at:])
    close()
    return out


def shared_lines(own: list[int], other: list[int]) -> set[int]:
    """Positions of ``own`` in a longest common subsequence with ``other``: the longest rising chain of
    matching positions (each line's matches taken from the back, so that a line is matched once)."""
    where = defaultdict(list)
    for j, h in enumerate(other):
        where[h].append(j)
    tops: list[int] = []
    ends: list[tuple] = []
    for i, h in enumerate(own):
        for j in reversed(where.get(h, ())):
            k = bisect_left(tops, j)
            link = (i, ends[k - 1] if k else None)
            if k == len(tops):
                tops.append(j)
                ends.append(link)
            else:
                tops[k] = j
                ends[k] = link
    out, link = set(), ends[-1] if ends else None
    while link:
        out.add(link[0])
        link = link[1]
    return out


def chosen(parts: list[int], lines: list[str], shared: set[int]) -> str:
    """The main text, from the parts and lines of a page and the positions that its pair has too."""
    stays = [k for k, p in enumerate(parts) if p == ARTICLE]
    if stays:
        # a heading above the article belongs to it, unless the neighbour has it as well
        copy = shared.issuperset(stays)
        stays = [k for k, p in enumerate(parts) if p == ARTICLE or p == HEADING and k not in shared and k < stays[0] or p == DOUBTFUL and (copy or k not in shared)]
    else:
        free = [k for k, p in enumerate(parts) if p in (OPEN, HEADING, DOUBTFUL)]
        stays = [k for k in free if k not in shared] or free
    return " ".join(lines[k] for k in stays)


def _to_lines(hashes_only: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, lines, hashes = [], [], []
            for page in batch.column("html"):
                found = page_lines(page.as_py() or "")
                hashes.append([xxhash.xxh3_64_intdigest(x) - (1 << 63) for _p, x in found])
                if not hashes_only:
                    parts.append([p for p, _x in found])
                    lines.append([x for _p, x in found])
            rest = [pa.array(hashes, pa.list_(pa.int64()))]
            if not hashes_only:
                rest += [pa.array(parts, pa.list_(pa.int32())), pa.array(lines, pa.list_(pa.string()))]
            kept = [n for n in batch.schema.names if n != "html"]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in kept], *rest], names=[*kept, "hashes", *([] if hashes_only else ["parts", "lines"])])

    return run


def _difference(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, sizes = [], []
        for own, other, parts, lines in zip(*(batch.column(c).to_pylist() for c in ("hashes", "other", "parts", "lines")), strict=True):
            text = chosen(parts, lines, shared_lines(own, other or []))
            texts.append(text)
            sizes.append(len(text))
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(sizes, pa.int64())], names=["page_id", "url", "text", "n_chars"])


def nearest_pages(pages: DataFrame) -> DataFrame:
    """(rid, near): for each page, named by the hash of its row, the page of its host with the nearest path.
    Only names, hosts and paths are sorted; neighbours across two sorted partitions meet by a table with one
    row per partition."""
    named = materialise(
        pages.select("rid", F.lower(F.coalesce(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1), F.lit(""))).alias("host"), F.coalesce(F.regexp_replace("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*", ""), F.lit("")).alias("path"))
        .distinct()
        .repartitionByRange("host", "path", "rid")
        .sortWithinPartitions("host", "path", "rid")
        .withColumn("seat", F.monotonically_increasing_id()),
        "pages-order",
    )
    named = named.select("seat", F.shiftright("seat", 33).alias("part"), F.struct("rid", "host", "path").alias("own"))
    in_order = Window.orderBy("part")  # one row per partition
    edges = named.groupBy("part").agg(F.min(F.struct("seat", "own")).alias("a"), F.max(F.struct("seat", "own")).alias("z")).select("part", F.lag("z.own").over(in_order).alias("prior"), F.lead("a.own").over(in_order).alias("later"))
    beside = Window.partitionBy("part").orderBy("seat")
    both = named.withColumn("one", F.lag("own").over(beside)).withColumn("two", F.lead("own").over(beside)).join(F.broadcast(edges), "part")
    one, two = F.coalesce("one", "prior"), F.coalesce("two", "later")
    both = both.select("own", F.when(one["host"] == F.col("own.host"), one).alias("one"), F.when(two["host"] == F.col("own.host"), two).alias("two"))
    far = lambda c: F.levenshtein(F.col("own.path"), F.col(f"{c}.path"))
    near = F.when(F.col("two").isNull() | (far("one") <= far("two")), F.col("one.rid")).otherwise(F.col("two.rid"))
    return both.select(F.col("own.rid").alias("rid"), near.alias("near"))


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars)."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("rid", F.xxhash64("page_id", "url", "html"))
    pairs = materialise(nearest_pages(rows.select("rid", "url")), "pages-pairs").where("near is not null")
    own = rows.select("page_id", "url", "rid", "html").mapInArrow(_to_lines(False), "page_id long, url string, rid long, hashes array<long>, parts array<int>, lines array<string>")
    seen = rows.select("rid", "html").mapInArrow(_to_lines(True), "rid long, hashes array<long>").dropDuplicates(["rid"])
    other = pairs.join(seen.select(F.col("rid").alias("near"), F.col("hashes").alias("other")), "near").select("rid", "other")
    return own.join(other, "rid", "left").select("page_id", "url", "hashes", "other", "parts", "lines").mapInArrow(_difference, "page_id long, url string, text string, n_chars long")
