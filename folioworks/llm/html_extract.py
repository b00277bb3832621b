"""Main text of web pages by consensus host paths.

Each page is read into blocks of text below tag-class paths. A path names every
block element from the root by tag and classes, generalised: digits become
``#``, sibling positions do not count. Boilerplate (menus, headers, footers,
sidebars, notices, adverts, forms, scripts, styles, reader comments) takes no
part, wherever it stands; tags go before names inside an article.

1. Every page scores its containers (body, article, main, section, div, center)
   by the unlinked text anywhere below them, and walks down from the body: into
   ``main`` if it holds half of the text, into an article that holds most of it,
   into a division beside which there is next to nothing. It stops at an
   article, at a container with headings or text of its own, and at one with
   several parts. Lists, tables and quotes are never entered, they belong to what
   they stand in. An article without a heading is left for the parent that has it.
2. Each page votes for that container's path; Spark sums votes and scores by
   host and path, and the path with most votes (then score, then path) wins.
3. Each page is extracted again: all that stands below its host's winning path,
   or below the page's own container if that holds the winning one and is not
   the body. A page without the winning path, or with no text there, falls back
   to its own container.

Votes are combined before the shuffle, one row a host and path. Winners are
broadcast only if their number and their length are within bounds; otherwise
pages and winners are joined by host, which adaptive execution can split.

Text: character references are decoded, white space inside a block becomes one
space, blocks are trimmed and joined in page order by two line feeds. Line
breaks (``br``) are white space. Null html is an empty page; pages of a null or
odd url share the host ``""``. Repeated page_ids are separate rows, an empty
table gives none, other columns are ignored. Pages of any length are read whole
in one pass, in time that grows with their length whatever they hold: where
quotes never end, or swallow the rest of the page, tags end at the next ``>``.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, per_row, stored

MOST_BROADCAST_HOSTS = 100_000
MOST_BROADCAST_CHARS = 20_000_000
#: Of a container's unlinked text: what ``main`` must hold, what an article must, what may stand beside a division.
MAIN_SHARE, ARTICLE_SHARE, BESIDE_SHARE = 0.5, 0.8, 0.05

# HTML elements by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split())
CONTAINER = frozenset("article center div main section".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
RAW = frozenset("iframe noembed noframes script style textarea title xmp".split())
IN_HEAD = frozenset("base basefont bgsound link meta noscript script style template title".split())
SKIPPED = frozenset("aside button canvas datalist dialog footer menu nav noscript object option search select svg template video audio".split())
TABLE_PARTS = {"caption": "caption td th tr tbody thead tfoot", "tbody": "caption td th tr tbody thead tfoot", "thead": "caption td th tr tbody thead tfoot", "tfoot": "caption td th tr tbody thead tfoot", "tr": "caption td th tr", "td": "caption td th", "th": "caption td th"}
TABLE_PARTS = {tag: frozenset(closes.split()) for tag, closes in TABLE_PARTS.items()}
SCOPES = frozenset("table td th caption".split())
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog".split())

# Words in the names of boilerplate. Own words, in two kinds: with those of the first a whole part of a page is
# none of the article's; those of the second may be said of a frame around it, or of a part of the article.
ALIEN = frozenset("ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion comment comments commentlist disqus reply replies respond related recommended recommendations share sharing newsletter subscribe subscription breadcrumb breadcrumbs pager pagination cookie cookies consent gdpr copyright paywall signup login".split())
FRAME = frozenset("banner notice notices alert sidebar sidepanel aside menu nav navbar navigation social footer popup modal overlay announcement".split())
LOOSE = frozenset("header foot masthead topbar toolbar widget skip search disclaimer discussion".split())
#: With these alone a word of the first kinds names a part of an article too: ``related-posts`` does, ``related-work`` does not.
PARTS = frozenset("more most top bottom left right inline inner outer main post posts article articles page pages story stories item items link links list lists listing box boxes block blocks bar button buttons icon icons section area container content contents wrap wrapper widget widgets group panel pane slot unit zone form field fields input signup count counter title heading header label body text meta author avatar thread threads feed card cards media social via tools toggle strip row col column embed holder div ul li float fixed sticky js".split())
WHOLE = frozenset("side left-side right-side side-bar side-panel side-column side-nav".split())
#: A name that begins so tells what an element has beside it or is about, not what it is.
BESIDE = ("has-", "with-", "no-", "without-", "not-", "category-", "tag-", "type-", "format-", "status-")
#: A name that ends so tells a state, often that of the whole page.
STATES = ("-open", "-closed", "-off", "-on", "-enabled", "-disabled")
#: An element of such a name is no frame, whatever else it is named.
CONTENT = frozenset("content main main-content page-content site-content post post-content post-body entry entry-content article article-body article-content story story-body".split())
WRAPPER = frozenset("wrap wrapper page container layout site outer inner row col column grid root app document shell frame center body".split())

NAME = re.compile(r"[a-zA-Z][^\s/>]*+")
REST = re.compile(r"((?:[^>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')|[=\"'])*+)>")
ATTRIBUTE = re.compile(r"([^\s=/>\"'][^\s=/>]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++)))?+")
CLOSING = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in RAW}
DIGITS = re.compile(r"\d+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


def _attributes(source: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(source)} if source.strip(" /\n") else {}


def _named(name: str, strictly: bool = False) -> int:
    """How much a class or id says of boilerplate: 3 for alien, 2 for a frame, 1 for loose words, 0 for none.

    ``strictly`` it says so only if it is made of such words and of ``PARTS``, as
    an article's sections are named by their headings.
    """
    name = CAMEL.sub("-", name).lower().replace("_", "-")
    if name.startswith(BESIDE) or name.endswith(STATES):
        return 0
    words = set(name.split("-"))
    if strictly and not all(w in ALIEN or w in FRAME or w in LOOSE or w in PARTS or not w.isalpha() for w in words):
        return 0
    return 3 if words & ALIEN else 2 if words & FRAME or name in WHOLE else 1 if words & LOOSE else 0


@lru_cache(1 << 16)
def _look(tag: str, source: str) -> tuple[int, int, int, str, bool]:
    """What a tag's attributes say: boilerplate for certain (2), by name (as ``_named``), strictly so, its step, whether it wraps."""
    attributes = _attributes(source)
    classes = attributes.get("class", "")
    step = ".".join([tag, *sorted(DIGITS.sub("#", classes).split())])
    names = f"{classes} {attributes.get('id', '')}".split()
    style = attributes.get("style", "").replace(" ", "").lower()
    role = attributes.get("role", "").lower()
    gone = "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true" or "display:none" in style or "visibility:hidden" in style
    named = max(map(_named, names), default=0)
    strictly = max((_named(n, True) for n in names), default=0)
    if any(CAMEL.sub("-", n).lower().replace("_", "-") in CONTENT for n in names):
        named, strictly = named * (named == 3), strictly * (strictly == 3)
    wraps = not names or any(WRAPPER & set(CAMEL.sub("-", n).lower().replace("_", "-").split("-")) for n in names)
    return (2 if gone else 1 if role in ROLES else 0), named, strictly, "main" + step[len(tag) :] if role == "main" and tag in CONTAINER else step, wraps


class _Open:
    """An open block element."""

    __slots__ = ("tag", "parent", "step", "noise", "link", "article", "number", "up", "part", "matched", "inline", "count", "open_here")

    def __init__(self, tag: str, parent: _Open | None, step: str, noise: int, link: bool, article: bool, number: int):
        self.tag, self.parent, self.step, self.noise, self.link, self.article, self.number = tag, parent, step, noise, link, article, number
        self.inline: list[tuple[str, int, bool]] = []
        self.count: Counter = Counter()
        self.matched = 0


class _Page:
    """The text blocks of one page and its containers.

    ``path`` is a winning path; ``chosen`` are then the containers at it.
    """

    def __init__(self, source: str, path: str | None = None):
        #: Container, text, length of the unlinked text, whether it is a heading.
        self.blocks: list[tuple[int, str, int, bool]] = []
        root = _Open("body", None, "html>body", 0, False, False, 0)
        root.up = root.part = 0
        root.open_here = Counter()
        self.frames = [root]
        self.parents = [-1]
        self.wraps = [True]
        self.steps = path.split(">")[2:] if path else None
        self.chosen = [0] if self.steps == [] else []
        self._read(source, root)

    def _read(self, source: str, root: _Open) -> None:
        stack, everywhere = [root], Counter()
        pieces: list[str] = []
        linked = 0
        in_head, quotes = False, True
        at, end = 0, len(source)

        def flush() -> None:
            nonlocal linked
            if pieces:
                text = " ".join("".join(pieces).split())
                if text:
                    self.blocks.append((stack[-1].number, text, max(0, len(text) - linked), stack[-1].tag in HEADING))
                pieces.clear()
            linked = 0

        def close(to: int) -> None:
            flush()
            for frame in stack[to:]:
                everywhere[frame.tag] -= 1
                frame.parent.open_here[frame.tag] -= 1
            del stack[to:]

        def noise_here() -> int:
            top = stack[-1]
            return top.inline[-1][1] if top.inline else top.noise

        def say(text: str) -> None:
            nonlocal linked, in_head
            if in_head:
                if text.isspace():
                    return
                in_head = False
            if noise_here():
                return
            # A reference ends where its run of text does.
            text = entities.unescape(text) if "&" in text else text
            pieces.append(text)
            top = stack[-1]
            if top.inline[-1][2] if top.inline else top.link:
                linked += len(text.strip())

        while at < end:
            start = source.find("<", at)
            if start < 0:
                start = end
            if start > at:
                say(source[at:start])
            at = start + 1
            if at >= end:
                if start < end:
                    say("<")
                break
            letter = source[at]
            if letter in "!?":
                stop = source.find("-->", start + 2) if source.startswith("!--", at) else source.find(">", at)
                at = end if stop < 0 else stop + (3 if source.startswith("!--", at) else 1)
                continue
            closing = letter == "/"
            found = NAME.match(source, at + closing)
            if not found:
                if closing and at + 1 < end:
                    stop = source.find(">", at)
                    at = end if stop < 0 else stop + 1
                else:
                    say("<")
                continue
            tag, at = found[0].lower(), found.end()
            rest = REST.match(source, at) if quotes else None
            if rest:
                attributes, at = rest[1], rest.end()
            else:
                quotes = False
                stop = source.find(">", at)
                if stop < 0:
                    break
                attributes, at = source[at:stop], stop + 1
            if closing:
                self._end(tag, stack, everywhere, close, pieces)
                in_head = in_head and tag != "head"
                continue
            if in_head and tag not in IN_HEAD:
                in_head = False
            if tag in RAW:
                shut = CLOSING[tag].search(source, at)
                stop = source.find(">", shut.end()) if shut else -1
                at = end if stop < 0 else stop + 1
                continue
            if tag in ("html", "body"):
                continue
            if tag == "head":
                in_head = len(stack) == 1 and not pieces and not self.blocks
                continue
            if tag in VOID:
                if tag == "hr":
                    flush()
                elif tag == "br" and not noise_here():
                    pieces.append(" ")
                continue
            self._begin(tag, attributes, stack, everywhere, close, flush, noise_here)
        flush()

    def _end(self, tag, stack, everywhere, close, pieces) -> None:
        if tag not in BLOCK:
            if tag == "br":
                pieces.append(" ")
                return
            top = stack[-1]
            if top.count[tag]:
                while True:
                    name = top.inline.pop()[0]
                    top.count[name] -= 1
                    if name == tag:
                        return
            return
        counts = everywhere if tag in TABLE_PARTS or tag == "table" else stack[-1].open_here
        if counts[tag] > 0:
            i = len(stack) - 1
            while stack[i].tag != tag:
                i -= 1
            close(i)

    def _begin(self, tag, source, stack, everywhere, close, flush, noise_here) -> None:
        sure, named, strictly, step, wraps = _look(tag, source)
        top = stack[-1]
        if tag not in BLOCK:
            if source.endswith("/"):
                return
            # In code, names are those of syntax.
            code = top.tag == "pre" or top.count["code"] > 0
            noise = max(noise_here(), 2 if sure or tag in SKIPPED or named >= (2 if top.article else 1) and not code else 0)
            link = tag == "a" or (top.inline[-1][2] if top.inline else top.link)
            top.inline.append((tag, noise, link))
            top.count[tag] += 1
            return
        if tag in TABLE_PARTS:
            while stack[stack[-1].part].tag in TABLE_PARTS[tag]:
                close(stack[-1].part)
        else:
            if stack[-1].tag == "p" or stack[-1].tag in HEADING and tag in HEADING:
                close(len(stack) - 1)
            if tag in ("li", "dt", "dd") and stack[stack[-1].up].tag in (("li",) if tag == "li" else ("dt", "dd")):
                close(stack[-1].up)
        flush()
        top = stack[-1]
        kind = step.split(".", 1)[0]
        article = top.article or kind in ("article", "main")
        if top.article or tag == "section":
            named = strictly
        if kind in ("article", "main"):
            # A frame with a misleading name, or a form around the page, does not hide an article.
            noise = 2 if noise_here() >= 2 or sure == 2 else 0
        else:
            own = 2 if sure == 2 or tag in SKIPPED else 1 if sure or tag == "form" or tag == "header" and not top.article else 0
            if not own and not (top.article and (tag == "header" or tag in HEADING or tag == "hgroup")):
                own = 2 if named == 3 else 1 if named >= (2 if top.article else 1) else 0
            noise = max(noise_here(), own)
        link = top.inline[-1][2] if top.inline else top.link
        frame = _Open(tag, top, step, noise, link, article, top.number)
        if tag in CONTAINER and not noise:
            frame.number = len(self.frames)
            self.frames.append(frame)
            self.parents.append(top.number)
            self.wraps.append(wraps)
        place = len(stack)
        frame.up = top.up if tag in ("div", "address", "p") else place
        frame.part = place if tag in TABLE_PARTS or tag == "table" else top.part
        frame.open_here = Counter() if tag in SCOPES else top.open_here
        # The scope's owner counts the elements in it; a new scope starts below its own element.
        top.open_here[tag] += 1
        everywhere[tag] += 1
        stack.append(frame)
        if self.steps is not None and top.matched == place - 1 < len(self.steps) and self.steps[place - 1] == step:
            frame.matched = place
            if place == len(self.steps) and frame.number != top.number:
                self.chosen.append(frame.number)

    def scores(self) -> list[int]:
        """Of each container, the unlinked text anywhere below it."""
        found = [0] * len(self.frames)
        for number, _, size, _ in self.blocks:
            found[number] += size
        for number in range(len(found) - 1, 0, -1):
            found[self.parents[number]] += found[number]
        return found

    def _below(self, chosen: list[int]) -> list[bool]:
        inside = [False] * len(self.frames)
        for number in chosen:
            inside[number] = True
        for number in range(1, len(inside)):
            inside[number] = inside[number] or inside[self.parents[number]]
        return inside

    def _kind(self, number: int) -> str:
        return self.frames[number].step.split(".", 1)[0] if number else "body"

    def best(self, scores: list[int] | None = None) -> int:
        """The container that a page's text stands in."""
        scores = scores or self.scores()
        children: dict[int, list[int]] = {}
        for number in range(1, len(self.frames)):
            children.setdefault(self.parents[number], []).append(number)
        headings, direct = Counter(), Counter()
        for number, _, size, heading in self.blocks:
            direct[number] += size
            headings[number] += heading and size > 0
        for number in range(len(self.frames) - 1, 0, -1):
            headings[self.parents[number]] += headings[number]
        here = 0
        mains = [n for n in range(1, len(self.frames)) if self._kind(n) == "main"]
        if len(mains) == 1 and scores[mains[0]] >= MAIN_SHARE * scores[0] > 0:
            here = mains[0]
        inside = self._below([here])
        in_article = [False] * len(self.frames)
        articles = []
        for number in range(1, len(self.frames)):
            parent = self.parents[number]
            in_article[number] = self._kind(number) == "article" or in_article[parent]
            if in_article[number] and not in_article[parent] and inside[number]:
                articles.append(number)
        first = max(articles, key=lambda n: (scores[n], -n), default=None)
        share = ARTICLE_SHARE * sum(scores[n] for n in articles)
        if first is not None and scores[first] >= max(share, MAIN_SHARE * scores[here], 1):
            parent = self.parents[first]
            return parent if not headings[first] and headings[parent] and (parent or not here) else first
        while self._kind(here) in ("body", "div", "section", "center") and self.wraps[here] and here in children and scores[here]:
            child = max(children[here], key=lambda n: (scores[n], -n))
            beside = scores[here] - scores[child]
            if direct[here] or headings[here] > headings[child] or beside > BESIDE_SHARE * scores[here]:
                break
            here = child
        return here

    def path(self, number: int) -> str:
        steps, frame = [], self.frames[number]
        while frame is not None:
            steps.append(frame.step)
            frame = frame.parent
        return ">".join(reversed(steps))

    def text(self, chosen: list[int]) -> str:
        """The blocks below the chosen containers."""
        inside = self._below(chosen)
        return "\n\n".join(text for number, text, _, _ in self.blocks if inside[number])


def vote(source: str | None) -> tuple[str | None, float]:
    """The path of the page's container and its score; none for a page without text."""
    page = _Page(source or "")
    if not page.blocks:
        return None, 0.0
    scores = page.scores()
    best = page.best(scores)
    return page.path(best), float(scores[best])


def extract(source: str | None, path: str | None) -> str:
    """The text below ``path``, or below the page's own container."""
    page = _Page(source or "", path)
    best = page.best()
    wider = best and best not in page.chosen
    if page.chosen and not (wider and page._below([best])[page.chosen[0]]):
        text = page.text(page.chosen)
        if text:
            return text
    return page.text([best])


def host_of(url: str = "url"):
    """The host of a url in lower case without its port; ``""`` where there is none."""
    return F.coalesce(F.lower(F.regexp_extract(F.col(url), r"^[a-zA-Z][\w+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1)), F.lit(""))


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Votes of the pages, summed by host and path as far as one task sees them."""
    schema = pa.schema([("host", pa.string()), ("path", pa.string()), ("votes", pa.int64()), ("score", pa.float64())])
    sums: dict[tuple[str, str], list] = {}

    def emit():
        if sums:
            columns = [[k[0] for k in sums], [k[1] for k in sums], [v[0] for v in sums.values()], [v[1] for v in sums.values()]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
            sums.clear()

    for batch in batches:
        for host, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
            path, score = vote(source)
            if path:
                held = sums.setdefault((host, path), [0, 0.0])
                held[0] += 1
                held[1] += score
        if len(sums) > 50_000:
            yield from emit()
    yield from emit()


def winning_paths(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``host`` and ``path``: each host's path with most votes."""
    rows = pages.select(host_of(url_col).alias("host"), F.col(html_col).cast("string").alias("html"))
    votes = map_rows(rows, _votes, "host string, path string, votes long, score double")
    summed = votes.groupBy("host", "path").agg(F.sum("votes").alias("votes"), F.sum(F.round("score", 3)).alias("score"))
    return summed.groupBy("host").agg(F.max_by("path", F.struct("votes", "score", "path")).alias("path"))


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", most_hosts: int = MOST_BROADCAST_HOSTS) -> DataFrame:
    """One row a page: ``page_id, url, text, n_chars, path`` (the winning path of its host)."""
    winners = stored(winning_paths(pages, url_col, html_col))
    hosts, chars = winners.agg(F.count("*"), F.coalesce(F.sum(F.char_length("host") + F.char_length("path")), F.lit(0))).first()
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"), host_of(url_col).alias("host"))
    few = hosts <= most_hosts and chars <= MOST_BROADCAST_CHARS
    joined = rows.join(F.broadcast(winners) if few else winners, "host", "left").select("page_id", "url", "html", "path")
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64()), ("path", pa.string())])

    def row(page_id, url, source, path):
        text = extract(source, path)
        return page_id, url, text, len(text), path

    return map_rows(joined, per_row(schema, row, "page_id", "url", "html", "path"), "page_id long, url string, text string, n_chars long, path string")
