"""Main text of web pages by a site style tree.

Each page is parsed into the path of every element and its text blocks. The pages of a host are merged
into one tree of paths. A path's presentation importance is the entropy of its child-tag sequences
over the host's pages; the importance of a block's content is one minus the entropy of its spread over
the pages that have its path: what stands on every page tells nothing. A branch combines both over all
content below it. Branches and blocks of low importance are removed from each page. Elements that
HTML or their names declare as boilerplate are removed on every host, as a host with few pages says
nothing about its branches. A name declares nothing where the elements that bear it hold most of the page's text
outside links, or a main element with more text than is found beside named elements. Pages of a host with the same main text are copies and count as one page of the
tree, else an article that a host repeats would look like boilerplate. Branches are removed from every page; inside
the main container that a page declares, their importance counts double.

Defined cases: NULL or empty html gives empty text; a page without host is of the host ''; broken markup
is repaired as browsers do for paragraphs, list items and stray end tags; elements nested beyond ``PATH_DEPTH`` keep
their text and share a path; a page costs time and memory linear in its length; repeated rows each give a
row and count as one page of the tree; an empty table gives an empty result; further columns of the input do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship_code, written

# HTML element classes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("html body address article aside blockquote center dd details dialog div dl dt fieldset figcaption figure footer form "
                  "h1 h2 h3 h4 h5 h6 header hgroup li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCK - {"html", "body", "td", "th", "tr", "tbody", "thead", "tfoot"} | {"hr"}
#: Start tag -> (open elements it ends, elements beyond which it does not look).
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
        "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
NOISE_TAGS = frozenset("head script style noscript template iframe object svg canvas form button select textarea nav aside footer menu dialog search".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
NOISE_NAMES = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo banner nav navbar navigation menu menus breadcrumb breadcrumbs "
                        "sidebar footer cookie cookies consent notice notices popup modal overlay newsletter subscribe signup login share sharing social "
                        "related recommended comment comments disqus reply replies respond toolbar pagination pager widget widgets copyright".split())
TALK_NAMES = frozenset("comment comments reply replies related recommended".split())
MAIN_NAMES = frozenset("content article post entry story main articlebody".split())

#: An element nested deeper than this is part of the path of its ancestor at this depth, so that the ancestors of all
#: blocks stay linear in the page. Texts of any depth are kept.
PATH_DEPTH = 128
#: A host's tree judges a path only when at least this many different pages have it.
MIN_PAGES = 10
#: Branches below this importance go; weight of content against presentation.
LOW_BRANCH = 0.3
CONTENT_WEIGHT = 0.9
#: The importance of a branch inside a declared main container counts this much more.
MAIN_WEIGHT = 2
#: Blocks below this content importance go: the same text on nearly all pages that have its path.
LOW_BLOCK = 0.05


def _key(s: str) -> int:
    return xxhash.xxh3_64_intdigest(s.encode("utf-8", "surrogatepass")) - (1 << 63)


class _Element:
    """An open element; ``path`` is a hash of its tags and names from the root, ``up`` the chain of elements with a path of
    their own, ``block`` the place of the nearest block element on the stack."""
    __slots__ = ("tag", "path", "up", "depth", "block", "noise", "names", "children", "container", "contained", "in_main", "in_link")

    def __init__(self, tag, path, up, depth, block, noise, names, container, contained, in_main, in_link):
        self.tag, self.path, self.up, self.depth, self.block = tag, path, up, depth, block
        self.noise, self.names, self.container = noise, names, container
        self.contained, self.in_main, self.in_link = contained, in_main, in_link
        self.children: list[str] = []


class PageParser(HTMLParser):
    """Blocks and element styles of one page. The work is linear in the page: open elements are found by their tag."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack = [_Element("", 0, None, 0, 0, False, frozenset(), -1, False, False, False)]
        self.places: dict[str, list[int]] = {}  # tag -> places of its open elements on the stack
        self.branches: dict[int, list[int]] = {0: []}  # path -> paths down to it
        # Text, paths down to its element, noise, names of boilerplate around it, container, characters outside links.
        self.blocks: list[tuple[str, list[int], bool, frozenset, int, int]] = []
        self.styles: dict[int, list[str]] = {}
        self.containers: list[tuple[int, int, frozenset]] = []  # rank, number of the enclosing container, names around it
        self.buffer: list[str] = []
        self.linked = 0

    def last(self, *tags: str) -> int:
        """The place of the innermost open element of ``tags``; 0 where there is none."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def branch(self, e: _Element) -> list[int]:
        if e.path not in self.branches:
            found, at = [], e
            while at.up is not None:
                found.append(at.path)
                at = at.up
            self.branches[e.path] = found[::-1]
        return self.branches[e.path]

    def flush(self) -> None:
        if self.buffer:
            text = " ".join("".join(self.buffer).split())
            linked, self.linked = self.linked, 0
            self.buffer = []
            if text:
                top = self.stack[-1]
                e = self.stack[top.block]
                self.blocks.append((text, self.branch(e), top.noise, top.names, e.container, max(len(text) - linked, 0)))

    def pop_to(self, at: int) -> None:
        """Close the elements from place ``at`` on."""
        if self.stack[-1].block >= max(at, 1):
            self.flush()
        for e in self.stack[at:]:
            self.styles.setdefault(e.path, []).append(" ".join(e.children))
            self.places[e.tag].pop()
        del self.stack[at:]

    def handle_starttag(self, tag, attrs):
        top = self.stack
        if tag in CLOSES_P:
            at = self.last("p")
            if at and self.last("td", "th", "table", "button") < at:
                self.pop_to(at)
        if tag in ENDS:
            ends, limit = ENDS[tag]
            at = self.last(*ends)
            if at and self.last(*limit) < at:
                self.pop_to(at)
        parent = top[-1]
        parent.children.append(tag)
        if tag in VOID:
            if tag == "br":
                self.buffer.append(" ")
            elif tag == "hr":
                self.flush()
            return
        if tag in BLOCK:
            self.flush()
        names, role, hidden, item = "", "", False, ""
        for name, value in attrs:
            if name in ("class", "id"):
                names += " " + (value or "").lower()
            elif name == "role":
                role = (value or "").lower()
            elif name == "hidden" or name == "aria-hidden" and value == "true":
                hidden = True
            elif name == "itemprop":
                item = (value or "").lower()
        words = set("".join(c if c.isalnum() else " " for c in names).split()) if names else frozenset()
        own = tag not in ("html", "body", "article", "main")
        declared = tag in ("article", "main") or role == "main" or item == "articlebody"
        noise = parent.noise or hidden or tag in NOISE_TAGS or role in NOISE_ROLES
        around = parent.names
        bad = words & (NOISE_NAMES if own else TALK_NAMES) if tag not in ("html", "body") else frozenset()
        if own and "header" in words and not parent.in_main:
            bad = bad | {"header"}
        if bad:  # a name that is the word tells more than one that has it as a part
            whole = bad & set(names.split())
            around = around | {(frozenset(whole), frozenset(bad - whole))}
        if declared and not bad and (parent.noise or parent.names) and not parent.contained and not words & NOISE_NAMES & set(names.split()):
            noise, around = hidden, frozenset()  # an unclosed box of boilerplate does not swallow the article
        if not parent.in_main and tag == "header":
            noise = True
        if parent.depth < PATH_DEPTH:
            path, up, depth = _key(f"{parent.path}>{tag}.{'.'.join(sorted(words))}"), parent, parent.depth + 1
        else:
            path, up, depth = parent.path, parent.up, parent.depth
        container, contained, in_main = parent.container, parent.contained, parent.in_main
        rank = 0
        if not noise:
            rank = 3 if tag == "article" else 2 if tag == "main" or role == "main" or item == "articlebody" else 1 if tag in BLOCK and words & MAIN_NAMES else 0
        if rank:
            self.containers.append((rank, container, around))
            container = len(self.containers) - 1
            contained = contained or not around
            in_main = in_main or rank > 1
        self.places.setdefault(tag, []).append(len(top))
        top.append(_Element(tag, path, up, depth, len(top) if tag in BLOCK else parent.block, noise, around, container, contained, in_main, parent.in_link or tag == "a"))

    def handle_endtag(self, tag):
        if tag == "br":
            self.buffer.append(" ")
            return
        at = self.last(tag)
        if at and (tag in BLOCK or at > self.stack[-1].block):
            self.pop_to(at)

    def handle_data(self, data):
        if self.stack[-1].tag not in ("script", "style"):
            self.buffer.append(data)
            if self.stack[-1].in_link:
                self.linked += len(" ".join(data.split()))

    def boilerplate(self) -> set:
        """The names on this page that declare boilerplate."""
        total = clean = 0
        held: dict[tuple, int] = {}
        in_main: dict[tuple, int] = {}
        mains: list[frozenset | None] = []  # names around the outermost main element, not inside it
        for rank, outer, names in self.containers:
            known = mains[outer] if outer >= 0 else None
            mains.append(known if known is not None else names if rank > 1 else None)
        for _, _, noise, around, c, n in self.blocks:
            if noise:
                continue
            total += n
            clean += 0 if around else n
            main = (mains[c] if c >= 0 else None) or frozenset()
            for name in around:
                held[name] = held.get(name, 0) + n
                if name in main:
                    in_main[name] = in_main.get(name, 0) + n
        return {name for name, n in held.items() if 2 * n <= total and (name[0] or name[1] & TALK_NAMES or in_main.get(name, 0) <= clean)}

    def finish(self) -> tuple[list[tuple[str, list[int], bool]], dict[int, str], bool]:
        """Blocks (text, paths, noise or outside the main container), styles by path, whether there is a main container."""
        self.close()
        self.flush()
        self.pop_to(1)
        declared = self.boilerplate()
        found = [(text, paths, noise or not declared.isdisjoint(around), c) for text, paths, noise, around, c, _ in self.blocks]
        sizes = [0] * len(self.containers)
        for text, _, noise, c in found:
            if c >= 0 and not noise:
                sizes[c] += len(text)
        for k in range(len(sizes) - 1, -1, -1):  # an enclosing container comes before its contents
            if self.containers[k][1] >= 0:
                sizes[self.containers[k][1]] += sizes[k]
        main = max((k for k in range(len(sizes)) if sizes[k]), key=lambda k: (self.containers[k][0], sizes[k], -k), default=-1)
        inside: list[bool] = []
        for k, (_, outer, _) in enumerate(self.containers):
            inside.append(k == main or outer >= 0 and inside[outer])

        def outside(c: int) -> bool:
            return main >= 0 and not (c >= 0 and inside[c])

        blocks = [(text, paths, noise or outside(c)) for text, paths, noise, c in found]
        return blocks, {p: "|".join(sorted(s)) for p, s in self.styles.items()}, main >= 0


def parse(html: str):
    p = PageParser()
    p.feed(html.replace("<![", "<! [") if "<![" in html else html)  # marked sections as the comments they are in HTML
    return p.finish()


_SCHEMA = ("page_id {id}, url string, host string, "
           "blocks array<struct<text:string,leaf:bigint,content:bigint,branch:array<bigint>>>, "  # text NULL: outside the main text
           "styles array<struct<path:bigint,style:bigint>>, has_main boolean, body bigint")  # body: hash of the main text


def _parse_pages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        for at in range(0, len(b), 200):
            part, rows = b.iloc[at:at + 200], []
            for page_id, url, host, html in zip(part["page_id"], part["url"], part["host"], part["html"]):
                blocks, styles, has_main = parse(html)
                found = []
                for text, branch, noise in blocks:
                    found.append((None if noise else text, branch[-1] if branch else 0, _key(text), branch))
                body = _key("\n".join(text for text, _, noise in blocks if not noise))
                rows.append((page_id, url, host, found, [(p, _key(s)) for p, s in styles.items()], has_main, body))
            yield pd.DataFrame(rows, columns=["page_id", "url", "host", "blocks", "styles", "has_main", "body"])


def without_copies(parsed: DataFrame) -> DataFrame:
    """One page of each main text of a host."""
    texts = parsed.groupBy("host", "body").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n"))
    copied = written(texts.where("n > 1").select("host", "body", "first"), "html-copied")
    copies = written(parsed.select("host", "body", "row").join(copied, ["host", "body"]).where("row != first").select("row"), "html-copies")
    return parsed.join(copies, "row", "left_anti")


def style_tree(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(host, path, pages, importance) of branches and (host, leaf, content, pages, importance) of blocks."""
    def share(n: Column, m: Column) -> Column:  # log_m n
        return F.when(m > 1, F.ln(n) / F.ln(m)).otherwise(F.lit(0.0))

    styles = (parsed.select("host", F.explode("styles").alias("s")).groupBy("host", "s.path", "s.style").agg(F.count(F.lit(1)).alias("n"))
              .groupBy("host", "path").agg(F.sum("n").alias("m"), F.sum(F.col("n") * F.ln("n")).alias("nlogn")))
    # Entropy of the styles to the base of the number of pages; one page says nothing: importance 1.
    styles = written(styles.select("host", "path", "m", F.when(F.col("m") > 1, 1 - F.col("nlogn") / (F.col("m") * F.ln("m"))).otherwise(1.0).alias("presentation")), "html-styles")
    on_page = F.array_distinct(F.transform("blocks", lambda b: F.struct(b["leaf"].alias("leaf"), b["content"].alias("content"), b["branch"].alias("branch"))))
    features = (parsed.select("host", F.explode(on_page).alias("f")).groupBy("host", "f.leaf", "f.content")
                .agg(F.count(F.lit(1)).alias("k"), F.any_value("f.branch").alias("branch")))
    content = written(features.join(styles.select("host", F.col("path").alias("leaf"), "m"), ["host", "leaf"], "left")
                      .withColumn("m", F.coalesce("m", "k")).withColumn("importance", 1 - share(F.col("k"), F.col("m"))), "html-content")
    below = (content.select("host", F.explode("branch").alias("path"), "k", "importance").groupBy("host", "path")
             .agg((F.sum(F.col("k") * F.col("importance")) / F.sum("k")).alias("content")))
    branches = styles.join(below, ["host", "path"]).select(
        "host", "path", F.col("m").alias("pages"), (CONTENT_WEIGHT * F.col("content") + (1 - CONTENT_WEIGHT) * F.col("presentation")).alias("importance"))
    return branches, content.select("host", "leaf", "content", F.col("m").alias("pages"), "importance")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    ship_code(pages.sparkSession)
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))
    src = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), host.alias("host"), F.coalesce(html_col, F.lit("")).alias("html"))
    parsed = src.mapInPandas(_parse_pages, _SCHEMA.format(id=src.schema["page_id"].dataType.simpleString()))
    parsed = written(parsed.withColumn("row", F.monotonically_increasing_id()), "html-pages")
    branches, content = style_tree(without_copies(parsed))
    # What a host drops stands on most of its pages, so these lists are bounded by the blocks of a page.
    low = (branches.where((F.col("pages") >= MIN_PAGES) & (F.col("importance") < LOW_BRANCH)).select("host", "path", "importance", F.lit(None).cast("bigint").alias("content"))
           .unionByName(content.where((F.col("pages") >= MIN_PAGES) & (F.col("importance") < LOW_BLOCK)).select("host", F.col("leaf").alias("path"), "importance", "content")))
    # Written first: the planner then knows its size and need not shuffle the pages to a short list.
    low = written(low.groupBy("host").agg(
        F.collect_set(F.when(F.col("content").isNull(), F.col("path"))).alias("low_paths"),
        F.collect_set(F.when(F.col("content").isNull() & (MAIN_WEIGHT * F.col("importance") < LOW_BRANCH), F.col("path"))).alias("low_main_paths"),
        F.collect_set(F.when(F.col("content").isNotNull(), F.struct("path", "content"))).alias("low_blocks")), "html-low")

    # What lies outside the main container of a page that has one has no text here.
    none = F.array().cast("array<bigint>")
    paths = F.coalesce(F.when(F.col("has_main"), F.col("low_main_paths")).otherwise(F.col("low_paths")), none)
    low_blocks = F.coalesce("low_blocks", F.array().cast("array<struct<path:bigint,content:bigint>>"))
    kept = F.filter("blocks", lambda b: b["text"].isNotNull() & ~F.arrays_overlap(b["branch"], paths)
                    & ~F.array_contains(low_blocks, F.struct(b["leaf"].alias("path"), b["content"].alias("content"))))
    text = F.array_join(F.transform(kept, lambda b: b["text"]), "\n")
    out = parsed.select("page_id", "url", "host", "blocks", "has_main").join(low, "host", "left").select("page_id", "url", text.alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("bigint"))
