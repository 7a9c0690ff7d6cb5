"""Main text of web pages by consensus host paths.

A page is read into blocks of text and the containers they lie in. Containers are scored by the running text of their
blocks. Each page votes on the generalised path (tags and classes, digits as #) of its containers; Spark sums the votes of
each host. Pages are then read again: the text is what lies below the containers on the host's winning path (a page
on which these hold little of what its own best container does uses that one), with what is running text beside them - a
lead, a headline - as long as they are not an article or main element yet. Directly below body, containers of about the
same size as the largest belong to it.

Menus, forms, adverts, comments and the like are set aside by their tags and by whole words of their classes, ids and
roles (sidebar, site-footer, comments-area; not with-sidebar, has-comments or search-result). What holds nearly all of a
page's running text is taken back, whatever it is called.

Edge cases: a null or empty html gives an empty text. A null url, or one without a host, belongs to the host "". Unclosed
and stray tags are repaired as browsers commonly do; text outside any tag is a block. Repeated rows vote and are returned
each; extra columns are not read. Nothing is cut off, however long a page is, and time is linear in length and depth.
"""

from __future__ import annotations

import re
from hashlib import blake2b
from html import unescape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import tuned, written

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^<>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>"']|"[^"]*"|'[^']*')*+)>""", re.DOTALL)
ATTRIBUTE = re.compile(r"""(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
ANCHOR = re.compile(r"\b(?:name|id)\s*=", re.IGNORECASE)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?=[\s=/]|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.IGNORECASE)

#: Tag names of the HTML standard by what they mean here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rb rp rt s samp small span strike strong sub sup time tt u var".split())
LEFT_OUT = frozenset("nav header footer aside form button select option menu dialog head svg math object audio video canvas map fieldset".split())
CONTAINERS = frozenset("html body div section article main td th blockquote figure center details".split())
ENDS_P = frozenset("address article aside blockquote center details div dl fieldset figure figcaption footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul li dt dd tr td th tbody thead tfoot body html".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
STOPS = frozenset("ul ol dl table html body div section article main".split())
#: Words in classes, ids and roles of what is not the article.
OTHER = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner banners breadcrumb breadcrumbs comment comments commentlist consent cookie cookies disqus "
    "footer header menu menubar nav navbar navigation newsletter notice notices popup promo promotion related search share sharing sidebar signup social sponsor "
    "sponsored subscribe toolbar widget widgets modal overlay paywall complementary contentinfo dialog alert reply replies respond masthead topbar skip gdpr login".split()
)
#: Such a word ends the name of what it is (site-footer), or begins it and only a place or a shape follows (sidebar-left).
SHAPES = frozenset("left right top bottom middle center area section wrapper wrap container holder content box bar block panel list item items inner outer main primary secondary slot unit zone group row column col popup form links text body widget".split())
#: Words before which it is only spoken of.
SPOKEN_OF = frozenset("with without no not has have is are hide hidden show".split())
ARTICLE_HEADERS = frozenset("entry post article story title content".split())
COMMENTS = frozenset("comment comments reply replies respond".split())

#: A page of which less than this part of a set-aside element's running text would be left takes that element back.
LEAST_LEFT = 0.1
#: The same for elements whose names say little of what they hold.
WEAK, MOST_LEFT = frozenset("widget widgets search".split()), 0.5
#: The host's path is left for the page's own best container where it holds less than this part of what that one holds. As
#: much of the largest, and at most twice it, must another container beside it hold, directly below body, to belong to it.
LEAST_OF_BEST = 0.3


def names_of(attributes: str) -> tuple[list[str], set[str]]:
    """Generalised classes, and the words that name what the element is not the article for."""
    classes, said = [], set()
    if "=" in attributes:
        for name, *values in ATTRIBUTE.findall(attributes):
            value = next((v for v in values if v), "")
            if name.lower() == "class":
                classes += [re.sub(r"\d+", "#", c) for c in value.split()]
            for token in value.split():
                parts = [x for x in re.split(r"[-_\d]+", token.lower()) if x and x != "x"]
                if not parts or not SPOKEN_OF.isdisjoint(parts):
                    continue
                if parts[-1] in OTHER and not (parts[-1] == "header" and parts[0] in ARTICLE_HEADERS):
                    said.add(parts[-1])
                elif parts[0] in OTHER and SHAPES.issuperset(parts[1:]):
                    said.add(parts[0])
    return classes, said


def below(above: str, label: str) -> str:
    """The path of a container: its own tag and classes, after a hash of all above it, so that deep paths stay short."""
    return f"{blake2b(above.encode(), digest_size=8).hexdigest()}>{label}"


class Page:
    """Blocks in page order as (container, text, length of links, what they are set aside by); -1 for none of either.

    Containers and set-aside elements are numbered as they open and know the one around them.
    """

    def __init__(self, html: str | None):
        self.blocks: list[tuple[int, str, int, int]] = []
        self.above: list[int] = []
        self.path: list[str] = []
        self.kind: list[str] = []
        self.aside_above: list[int] = []
        self.aside_weak: list[bool] = []
        self._read(html or "")
        self._take_back()

    def _read(self, html: str) -> None:
        stack: list[tuple[str, bool, bool]] = []  # open tags other than inline ones; is it a container; is it set aside
        last: dict[str, list[int]] = {}  # where in the stack each tag is open
        stops: list[int] = []
        articles = 0  # open article and main elements
        inside, aside = -1, -1
        in_link = links = link_depth = 0
        parts: list[str] = []

        def close_block():
            nonlocal parts, links
            text = " ".join(unescape("".join(parts)).split()) if parts else ""
            if text:
                self.blocks.append((inside, text, links, aside))
            parts, links = [], 0

        def pop_to(depth):
            nonlocal inside, aside, articles, in_link
            if depth < link_depth:  # a link goes no further than the element it began in
                in_link = 0
            while len(stack) > depth:
                tag, container, away = stack.pop()
                last[tag].pop()
                if stops and stops[-1] == len(stack):
                    stops.pop()
                articles -= tag in ("article", "main")
                if container:
                    inside = self.above[inside]
                if away:
                    aside = self.aside_above[aside]

        def close(tags, within=True):
            """Closes the innermost open element with one of these tags, if it lies within the innermost table, list or section."""
            depth = max((last[t][-1] for t in tags if last.get(t)), default=-1)
            if depth >= 0 and (not within or not stops or depth > stops[-1]):
                pop_to(depth)
                return True
            return False

        at, end, low = 0, len(html), None
        while at < end:
            m = TAG.search(html, at)
            text = html[at : m.start()] if m else html[at:]
            if text:
                parts.append(text)
                links += len(text) if in_link else 0
            if not m:
                break
            at = m.end()
            tag = m[2]
            if tag is None:
                continue
            tag = tag.lower()
            closing = bool(m[1])
            if tag in INLINE:
                if tag == "a":
                    in_link, link_depth = 0 if closing else int("href" in (m[3] or "").lower() or not ANCHOR.search(m[3] or "")), len(stack)
                continue
            if tag == "br":
                parts.append(" ")
                continue
            if tag in RAW:
                if not closing:
                    low = low or html.lower()
                    low = low if len(low) == end else html  # lower() may change lengths
                    stop = low.find(f"</{tag}", at)
                    shut = html.find(">", stop) if stop >= 0 else -1
                    at = shut + 1 if shut >= 0 else end
                continue
            if tag in VOID and tag != "hr":
                continue
            close_block()
            if tag == "hr":
                continue
            if closing:
                close((tag,), tag not in STOPS)
                continue
            if tag in ENDS_P:
                close(("p",))
            if tag in CLOSES:
                while close(CLOSES[tag]) and tag == "tr":
                    pass
            attributes = m[3] or ""
            classes, said = names_of(attributes)
            container = tag in CONTAINERS
            if container:
                label = ".".join([tag, *sorted(set(classes))])
                self.path.append(below(self.path[inside] if inside >= 0 else "", label))
                self.above.append(inside)
                self.kind.append(tag)
                inside = len(self.above) - 1
            if articles:
                said.discard("header")
            away = not said.isdisjoint(COMMENTS) if tag == "article" else bool(said) or tag in LEFT_OUT and not (tag == "header" and articles) or bool(attributes and HIDDEN.search(attributes))
            away = away and tag not in ("html", "body", "main")
            if away:
                self.aside_above.append(aside)
                self.aside_weak.append(tag not in LEFT_OUT and bool(said) and WEAK.issuperset(said))
                aside = len(self.aside_above) - 1
            last.setdefault(tag, []).append(len(stack))
            if tag in STOPS:
                stops.append(len(stack))
            stack.append((tag, container, away))
            articles += tag in ("article", "main")
            if attributes.endswith("/") and tag not in CONTAINERS and tag != "p":
                pop_to(len(stack) - 1)
        close_block()

    def _take_back(self) -> None:
        """Drops the blocks that are set aside, but for those in elements without which next to nothing would be left."""
        n = len(self.aside_above)
        own, left = [0.0] * n, 0.0
        for _, text, links, aside in self.blocks:
            if aside >= 0:
                own[aside] += running(len(text), links)
            else:
                left += running(len(text), links)
        whole = own[:]
        for k in range(n - 1, -1, -1):
            if self.aside_above[k] >= 0:
                whole[self.aside_above[k]] += whole[k]
        # An element is taken back only if the one around it is; elements are numbered from the outside in.
        back = [False] * n
        for k in sorted(range(n), key=lambda k: -whole[k]):
            above = self.aside_above[k]
            if whole[k] > 0 and (above < 0 or back[above]) and left < (MOST_LEFT if self.aside_weak[k] else LEAST_LEFT) * whole[k]:
                back[k] = True
                left += own[k]
        self.blocks = [b for b in self.blocks if b[3] < 0 or back[b[3]]]

    def votes(self) -> dict[str, float]:
        """The running text of each container, most of that for the one above, and so on, by path; the largest is 1."""
        carried = [0.0] * len(self.above)
        for inside, text, links, _ in self.blocks:
            if inside >= 0:
                carried[inside] += running(len(text), links)
        votes: dict[str, float] = {}
        for k in range(len(carried) - 1, -1, -1):
            if carried[k] > 0:
                votes[self.path[k]] = votes.get(self.path[k], 0.0) + carried[k] * (1.5 if self.kind[k] in ("article", "main") else 1.0)
                if self.above[k] >= 0:
                    carried[self.above[k]] += 0.7 * carried[k]
        top = max(votes.values(), default=0.0)
        return {k: v / top for k, v in votes.items()} if top > 0 else {}

    def _held(self, path: str | None, length: list[int], links: list[int]) -> float:
        """Running text below the outermost containers with a path."""
        inside, total = [False] * len(self.path), 0.0
        for k, p in enumerate(self.path):
            above = self.above[k] >= 0 and inside[self.above[k]]
            inside[k] = above or p == path
            if p == path and not above:
                total += running(length[k], links[k])
        return total

    def text(self, wanted: str | None) -> str:
        """What lies below the containers with the wanted path; without such, below the page's own best container."""
        n = len(self.above)
        length, links = [0] * n, [0] * n
        for inside, text, in_links, _ in self.blocks:
            if inside >= 0:
                length[inside] += len(text)
                links[inside] += min(in_links, len(text))
        for k in range(n - 1, -1, -1):
            if self.above[k] >= 0:
                length[self.above[k]] += length[k]
                links[self.above[k]] += links[k]
        votes = self.votes()
        best = min(votes, key=lambda k: (-votes[k], k)) if votes else None
        there = wanted is not None and any(p == wanted and length[k] for k, p in enumerate(self.path))
        if not there or best is not None and self._held(wanted, length, links) <= LEAST_OF_BEST * self._held(best, length, links):
            wanted = best
        if wanted is None:
            return "\n".join(b[1] for b in self.blocks)
        chosen = [False] * n
        for k, path in enumerate(self.path):
            chosen[k] = path == wanted or self.above[k] >= 0 and chosen[self.above[k]]
        at = {k for k in range(n) if chosen[k] and length[k] and not (self.above[k] >= 0 and chosen[self.above[k]])}
        # Up, while what lies beside the chosen ones is running text too.
        moved = True
        while moved:
            moved = False
            by: dict[int, list[int]] = {}
            for k in at:
                if self.kind[k] not in ("article", "main"):
                    by.setdefault(self.above[k], []).append(k)
            for up, below_ in by.items():
                if up < 0 or self.kind[up] in ("body", "html"):
                    most = max(running(length[k], links[k]) for k in below_)
                    more = [k for k in range(n) if self.above[k] == up and k not in at and max(1.0, LEAST_OF_BEST * most) <= running(length[k], links[k]) <= 2 * most]
                    at.update(more)
                    continue
                beside, in_links = length[up] - sum(length[k] for k in below_), links[up] - sum(links[k] for k in below_)
                if 2 * (beside - in_links) >= beside:
                    at.difference_update(below_)
                    at.add(up)
                    moved = True
        chosen = [False] * n
        for k in range(n):
            chosen[k] = k in at or self.above[k] >= 0 and chosen[self.above[k]]
        return "\n".join(text for inside, text, _, _ in self.blocks if inside >= 0 and chosen[inside])


def running(length: int, links: int) -> float:
    """How much of a block is running text: links count against it, so lists of labels do not win."""
    return max(0.0, length - 2.0 * links)


def host(url: F.Column) -> F.Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, path): the path with the most votes of each host (ties: the first by code points)."""
    tuned(pages.sparkSession)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            votes: dict[tuple[str, str], float] = {}
            for name, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
                for path, v in Page(html).votes().items():
                    votes[name, path] = votes.get((name, path), 0.0) + v
            # Whole numbers, so that sums do not depend on their order.
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in votes], type=pa.string()), pa.array([k[1] for k in votes], type=pa.string()), pa.array([round(v * 1000) for v in votes.values()], type=pa.int64())], names=["host", "path", "votes"])

    votes = pages.select(host(F.col("url")).alias("host"), "html").mapInArrow(run, "host string, path string, votes long")
    sums = votes.groupBy("host", "path").agg(F.sum("votes").alias("votes"))
    best = sums.groupBy("host").agg(F.min(F.struct((-F.col("votes")).alias("order"), F.col("path").alias("path"))).alias("best"))
    return best.select("host", F.col("best.path").alias("path"))


def extracted(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    # Written, so its size is known: broadcast below Spark's own limit, else a join whose hot hosts Spark splits.
    paths = written(host_paths(pages), "host-paths").withColumnRenamed("host", "__host").withColumnRenamed("path", "__path")
    rows = pages.select("page_id", "url", "html", host(F.col("url")).alias("__host")).join(paths, "__host", "left").select("page_id", "url", "html", "__path")

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = [Page(html).text(path) for html, path in zip(batch.column("html").to_pylist(), batch.column("__path").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, type=pa.string()), pa.array(list(map(len, texts)), type=pa.int64())], names=["page_id", "url", "text", "n_chars"])

    kind = {f.name: f.dataType.simpleString() for f in pages.schema.fields}
    return rows.mapInArrow(run, f"page_id {kind['page_id']}, url {kind['url']}, text string, n_chars long")
