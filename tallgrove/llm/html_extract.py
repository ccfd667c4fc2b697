"""Main text of web pages by paths on which the pages of a host agree.

1. Each page's containers are scored by the text that stands in them outside of links and page furniture;
   nearer containers get more of it. From the best one the vote rises to the outermost article or main around it, or to what
   holds its headings and leads; its path (tags and classes, digits generalised) is the page's vote. A class or id
   word alone never makes furniture of a container around the page's article, main or most of its text.
2. Votes are summed per (host, path) with map-side sums, and each host's winner is taken.
3. Pages are read again with the winner of their host: the blocks in the containers with that path are the
   text. A page without such a container, and one whose host is unknown or of two minds, uses its own best path.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallgrove.llm.frames import ready, schema_with, stored, without

OUTPUT = ("text", "n_chars")
#: Part of a host's votes that its winner needs.
AGREED = 0.5

#: Tags whose quotes never close that are read with their quotes; after so many, quotes of the page hide no '>'.
MOST_UNCLOSED = 16
#: Containers, from the nearest, that the text of a block counts for.
NEAREST = 64

NAMED_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
ATTRIBUTE = re.compile(r"""([^\s=/"'<>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")

# Names of the HTML standard and of common page furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe svg canvas object textarea select title math".split())
SKIPPED = RAW | frozenset("head nav footer aside form button dialog".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3"
    " h4 h5 h6 head header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul option".split()
)
CONTAINERS = frozenset("body article main section div td center blockquote".split())
#: Elements that a class or id word makes furniture only if they are not the page's wrapper.
WRAPPERS = CONTAINERS | frozenset("table tbody tr".split())
BARRIERS = CONTAINERS | frozenset("ul ol table dl".split())
#: Elements whose end tag also ends the containers in them.
LEAVES_ROOMS = CONTAINERS | frozenset("html form nav footer aside header".split())
CLOSED_BY_OWN = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
                 "th": {"td", "th"}, "option": {"option"}}
FURNITURE = frozenset(
    "ad ads advert advertisement adverts advertising sponsor sponsored sidebar menu nav navbar navigation footer cookie"
    " cookies consent gdpr notice banner comments comment disqus breadcrumb breadcrumbs share sharing social related promo popup"
    " modal newsletter subscribe login search widget toolbar".split()
)
#: Running text, whose compound class names ("ad-hoc", "related-work") tell of its content.
#: What a title's own header is named after ("entry-header").
CONTENT = frozenset("entry post article story content".split())
RUNNING = frozenset("p h1 h2 h3 h4 h5 h6 pre code em strong b i q".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert".split())


def attributes(source: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(source)}


def is_furniture(tag: str, found: dict[str, str], in_article: bool) -> bool:
    """By tag, role or style."""
    if tag in SKIPPED or (tag == "header" and not in_article):
        return True
    if tag in ("html", "body", "article", "main"):
        return False
    if "hidden" in found or found.get("aria-hidden") == "true" or found.get("role") in ROLES:
        return True
    return "display:none" in found.get("style", "").replace(" ", "")


def named_furniture(tag: str, found: dict[str, str], in_article: bool) -> bool:
    """By a word of its class or id; running text only by a whole name."""
    if tag in ("html", "body", "article", "main"):
        return False
    names = f"{found.get('class', '')} {found.get('id', '')}".lower()
    words = set(names.split() if tag in RUNNING else re.split(r"[^a-z]+", names))
    return bool(words & FURNITURE) or ("header" in words and not words & CONTENT and not in_article)


def tags_of(source: str) -> Iterator[tuple[int, int, str, str, str]]:
    """(start, end, slash, name, attributes) of comments, declarations and tags, from the left and never back.

    Only whole tags have a name. A tag whose quotes never close ends at the next '>'; a '<' that nothing
    ends is text, unless it begins a tag that the page's end cuts off.
    """
    at, unclosed = 0, 0
    last_end = source.rfind(">")
    while (start := source.find("<", at)) >= 0:
        mark = source[start + 1 : start + 2]
        opens = source[start + 2 : start + 3] if mark == "/" else mark
        found = None
        if source.startswith("<!--", start):
            end = source.find("-->", start + 4)
            end = end + 3 if end >= 0 else len(source)
        elif mark in ("!", "?") or (opens.isascii() and opens.isalpha()):
            if start < last_end:
                if mark not in ("!", "?") and unclosed < MOST_UNCLOSED:
                    found = NAMED_TAG.match(source, start)
                    unclosed += found is None
                elif mark not in ("!", "?"):
                    found = PLAIN_TAG.match(source, start)
                end = found.end() if found else source.index(">", start) + 1
            elif mark not in ("!", "?") and source.find("<", start + 1) < 0:
                end = len(source)
            else:
                at = start + 1
                continue
        else:
            at = start + 1
            continue
        # A search for elements of raw text may skip ahead.
        ahead = yield (start, end, found[1], found[2].lower(), found[3]) if found else (start, end, "", "", "")
        at = max(end, ahead or 0)


class Page:
    """Blocks of a page's text, and the containers they stand in; parents are links, so memory follows the page."""

    def __init__(self, source: str) -> None:
        self.above: list[int] = []  # of each container the one around it, or -1
        self.path: list[int] = []  # of each container its path
        self.steps: list[tuple[int, str]] = []  # of each path the path around it, or -1, and its last step
        self.blocks: list[tuple[str, int, int]] = []  # text, container or -1, characters outside links
        self.titles: set[int] = set()  # blocks that are an h1
        self._path_of: dict[tuple[int, str], int] = {}
        # Articles, mains and elements that a class or id word may make furniture: (tag, the one around it, named).
        self._marks: list[tuple[str, int, bool]] = []
        self._mark_of: list[int] = []  # of each block
        self._stack: list[tuple[str, bool, bool]] = []  # tag, whether it is a container, whether it is a mark
        self._at: dict[str, list[int]] = {}  # depths of the open elements by tag
        self._barriers: list[int] = []  # depths at which the search for elements to close ends
        self._rooms: list[int] = []  # depths of elements of CONTAINERS
        self._inside: list[int] = [-1]  # open containers
        self._within: list[int] = [-1]  # open marks
        self._text: list[str] = []
        self._linked = 0
        self._links = 0
        self._skip = -1  # depth at which furniture began
        self._read(source)

    def _flush(self) -> None:
        if not self._text:
            return
        text = " ".join("".join(self._text).split())
        if text:
            if self._at.get("h1"):
                self.titles.add(len(self.blocks))
            self._mark_of.append(self._within[-1])
            self.blocks.append((text, self._inside[-1], max(0, len(text) - self._linked)))
        self._text, self._linked = [], 0

    def _add(self, text: str) -> None:
        if self._skip >= 0 or not text:
            return
        if "&" in text:
            text = entities.unescape(text)
        self._text.append(text)
        if self._links:
            self._linked += len(text.strip())

    def _close(self, depth: int) -> None:
        """Close all elements from this depth on."""
        for tag, container, mark in self._stack[depth:]:
            self._links -= tag == "a"
            self._at[tag].pop()
            if container:
                self._inside.pop()
            if mark:
                self._within.pop()
        del self._stack[depth:]
        for depths in (self._barriers, self._rooms):
            while depths and depths[-1] >= depth:
                depths.pop()
        if self._skip >= depth:
            self._skip = -1

    def _close_before(self, tag: str) -> None:
        """Close what a block of this tag ends, as far as the next barrier."""
        ends = CLOSED_BY_OWN.get(tag, frozenset()) | {"p"}
        barrier = len(self._barriers) - 1
        while barrier >= 0 and self._stack[self._barriers[barrier]][0] in ends:
            barrier -= 1
        least = self._barriers[barrier] if barrier >= 0 else -1
        first = len(self._stack)
        for end in ends:
            for depth in reversed(self._at.get(end, ())):
                if depth <= least:
                    break
                first = min(first, depth)
        if first < len(self._stack):
            self._close(first)

    def _open(self, tag: str, source: str) -> None:
        if tag in BLOCKS:
            self._flush()
            self._close_before(tag)
        if tag in VOID:
            if tag == "br":
                self._add(" ")
            return
        depth = len(self._stack)
        container = mark = False
        if self._skip < 0:
            found = attributes(source) if source.strip(" /") else {}
            in_article = bool(self._at.get("article") or self._at.get("main"))
            named = named_furniture(tag, found, in_article)
            mark = (named and tag in WRAPPERS) or tag in ("article", "main")
            if is_furniture(tag, found, in_article) or (named and not mark):
                self._skip, mark = depth, False
            if mark:
                self._marks.append((tag, self._within[-1], named))
                self._within.append(len(self._marks) - 1)
            if self._skip < 0 and tag in CONTAINERS:
                names = sorted({re.sub(r"\d+", "0", n.replace(">", "")) for n in found.get("class", "").lower().split()})
                around = self._inside[-1]
                step = (self.path[around] if around >= 0 else -1, ".".join([tag, *names]))
                if step not in self._path_of:
                    self._path_of[step] = len(self.steps)
                    self.steps.append(step)
                container = True
                self._inside.append(len(self.above))
                self.above.append(around)
                self.path.append(self._path_of[step])
        if tag == "a":
            self._links += 1
        self._stack.append((tag, container, mark))
        self._at.setdefault(tag, []).append(depth)
        if tag in CONTAINERS:
            self._rooms.append(depth)
        if tag in BARRIERS:
            self._barriers.append(depth)

    def _shut(self, tag: str) -> None:
        if tag in BLOCKS:
            self._flush()
        depths = self._at.get(tag)
        if depths and (tag in LEAVES_ROOMS or not self._rooms or self._rooms[-1] <= depths[-1]):
            self._close(depths[-1])

    def _read(self, source: str) -> None:
        at = 0
        tags = tags_of(source)
        found = next(tags, None)
        while found:
            start, end, slash, tag, rest = found
            if start > at:
                self._add(source[at:start])
            at = end
            if tag and slash:
                self._shut(tag)
            elif tag:
                closed = rest.endswith("/")
                if tag in RAW and not closed:
                    raw = re.compile(rf"</{re.escape(tag)}\s*>", re.IGNORECASE).search(source, at)
                    at = raw.end() if raw else len(source)
                else:
                    self._open(tag, rest)
                    if closed and tag not in BLOCKS and tag not in VOID:
                        self._shut(tag)
            try:
                found = tags.send(at)
            except StopIteration:
                found = None
        self._add(source[at:])
        self._flush()
        if any(named for _, _, named in self._marks):
            wrappers = self._wrappers()
            gone: list[bool] = []  # of each mark: it or one around it is furniture
            for n, (_, around, named) in enumerate(self._marks):
                gone.append((named and n not in wrappers) or (around >= 0 and gone[around]))
            left = [i for i, mark in enumerate(self._mark_of) if mark < 0 or not gone[mark]]
            self.titles = {k for k, i in enumerate(left) if i in self.titles}
            self.blocks = [self.blocks[i] for i in left]

    def _wrappers(self) -> set[int]:
        """Elements around the page's article or main or most of its text, so that their names do not count."""
        marks = self._marks
        kinds = ("article", "main")
        own = [0] * len(marks)  # characters outside links in each
        full = [False] * len(marks)  # whether a block is in it
        inside: list[frozenset[str]] = []  # article and main around it or itself
        nearest: list[int] = []  # the nearest named element around it or itself, or -1
        for n, (tag, around, named) in enumerate(marks):
            inside.append((inside[around] if around >= 0 else frozenset()) | ({tag} if not named else frozenset()))
            nearest.append(n if named else nearest[around] if around >= 0 else -1)
        text_in: dict[str, set[int]] = {kind: set() for kind in kinds}  # the nearest named elements around the text of such
        whole = 0
        for mark, (_, _, size) in zip(self._mark_of, self.blocks, strict=True):
            whole += size
            if mark >= 0:
                own[mark] += size
                full[mark] = True
                for kind in inside[mark]:
                    text_in[kind].add(nearest[mark])
        held: list[set[str]] = [set() for _ in marks]  # article and main in it
        for n in range(len(marks) - 1, -1, -1):
            tag, around, named = marks[n]
            if around >= 0 and full[n]:
                own[around] += own[n]
                full[around] = True
                held[around] |= held[n] | ({tag} if not named else set())
        out = set()
        meets: list[dict[str, bool]] = []  # whether text of such is next to it or to a named element around it
        for n, (_, around, named) in enumerate(marks):
            before = meets[around] if around >= 0 else {kind: -1 in text_in[kind] for kind in kinds}
            meets.append({kind: before[kind] or (named and n in text_in[kind]) for kind in kinds})
            if not named or not full[n]:
                continue
            if "main" in held[n]:
                out.add(n)
            elif not before["article"]:
                if "article" in held[n] and not (around >= 0 and inside[around]):
                    out.add(n)
                elif ("article" in held[n] or not before["main"]) and 2 * own[n] > whole:
                    out.add(n)
        return out

    def _tag(self, container: int) -> str:
        return self.steps[self.path[container]][1].partition(".")[0]

    def path_text(self, container: int) -> str:
        steps, path = [], self.path[container]
        while path >= 0:
            path, step = self.steps[path]
            steps.append(step)
        return ">".join(reversed(steps))

    def best(self) -> str:
        """Path of the container that ``_rise`` finds from the one with the highest score; '' if no text stands in one.

        Text counts for the ``NEAREST`` containers around it, divided by their distance.
        """
        scores = [0.0] * len(self.above)
        for _, container, own in self.blocks:
            distance = 1
            while container >= 0 and distance <= NEAREST:
                scores[container] += own / distance
                container = self.above[container]
                distance += 1
        scores = [score * 1.5 if score and self._tag(i) in ("article", "main") else score for i, score in enumerate(scores)]
        top = max(scores, default=0.0)
        return self.path_text(self._rise(scores.index(top))) if top > 0 else ""

    def _rise(self, container: int) -> int:
        """The outermost article or main around a container; without one, the ancestor that holds its headings and leads.

        Such an ancestor adds an h1 or text that stands in no other container, and other text only if it is
        less than what is there already (body: none).
        """
        line = [container]
        while self.above[line[-1]] >= 0:
            line.append(self.above[line[-1]])
        whole = [c for c in line if self._tag(c) in ("article", "main")]
        if whole:
            return whole[-1]
        on_line = set(line)
        leads, others = [0] * len(self.above), [0] * len(self.above)  # characters in each container
        for i, (_, inner, own) in enumerate(self.blocks):
            if inner >= 0:
                (leads if i in self.titles or inner in on_line else others)[inner] += own
        for c in range(len(self.above) - 1, -1, -1):
            if self.above[c] >= 0:
                leads[self.above[c]] += leads[c]
                others[self.above[c]] += others[c]
        for ancestor in line[1:]:
            kept = leads[container] + others[container]
            adds, other = leads[ancestor] - leads[container], others[ancestor] - others[container]
            if adds and (other < kept if self._tag(ancestor) != "body" else not other):
                container = ancestor
        return container

    def text_at(self, path: str) -> list[str]:
        """Blocks in the containers with the path, in page order; '' is the whole page."""
        if not path:
            return [text for text, _, _ in self.blocks]
        wanted: int | None = -1
        for step in path.split(">"):
            wanted = self._path_of.get((wanted, step))
            if wanted is None:
                return []
        chosen: list[bool] = []
        for c, around in enumerate(self.above):
            chosen.append(self.path[c] == wanted or (around >= 0 and chosen[around]))
        return [text for text, container, _ in self.blocks if container >= 0 and chosen[container]]


def host_of(url: str | None) -> str | None:
    found = re.match(r"\s*(?:[a-zA-Z][\w+.-]*:)?//([^/?#]*)", url or "")
    return found[1].rpartition("@")[2].lower() or None if found else None


def votes(pages: DataFrame) -> DataFrame:
    """(host, path): the vote of each page that has one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts = [host_of(u) for u in batch.column("url").to_pylist()]
            paths = [Page(h or "").best() if host else "" for host, h in zip(hosts, batch.column("html").to_pylist())]
            kept = [(h, p) for h, p in zip(hosts, paths) if p]
            yield pa.RecordBatch.from_arrays(
                [pa.array([h for h, _ in kept], pa.string()), pa.array([p for _, p in kept], pa.string())], names=["host", "path"]
            )

    return pages.select("url", "html").mapInArrow(run, "host string, path string")


def host_paths(pages: DataFrame, agreed: float = AGREED) -> DataFrame:
    """(host, path) of the hosts whose pages agree on a path; ties go to the later path in code point order."""
    counts = votes(pages).groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("host").agg(
        F.max(F.struct("n", "path")).alias("best"), F.sum("n").alias("all")
    )
    return best.filter(F.col("best.n") >= agreed * F.col("all")).select("host", F.col("best.path").alias("path"))


def extract(pages: DataFrame, agreed: float = AGREED) -> DataFrame:
    """``pages`` with text and n_chars (its code points).

    A null or empty page, or one of furniture alone, has an empty text; text that stands in no container is
    the page's text if it has no other. Cut-off pages are read as far as they go. Pages without a host use their own best path.
    An empty table gives no rows. Input columns named like the output are replaced.
    """
    ready(pages.sparkSession)
    base = without(pages, *OUTPUT)
    names = base.columns
    schema = schema_with(base, text="string", n_chars="long")
    out = schema.names
    winners = stored(host_paths(base, agreed), "host-paths").select(F.col("host").alias("_host"), F.col("path").alias("_path"))
    # The same host as host_of: between '//' and the next '/', '?' or '#', without a user name.
    host = F.lower(F.regexp_extract("url", r"^\s*(?:[a-zA-Z][\w+.-]*:)?//(?:[^/?#]*@)?([^/?#]*)", 1))
    joined = base.withColumn("_of", host).join(winners, F.col("_of") == F.col("_host"), "left").drop("_of", "_host")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for source, agreed_path in zip(batch.column("html").to_pylist(), batch.column("_path").to_pylist()):
                page = Page(source or "")
                blocks = page.text_at(agreed_path) if agreed_path else []
                texts.append("\n".join(blocks or page.text_at(page.best())))
            columns = [batch.column(n) for n in names]
            columns += [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=out)

    return joined.mapInArrow(run, schema)
