"""Operator 5, HTML extraction: consensus host paths.

Every page scores its containers by the text that stands in them outside links and boilerplate; its best
one votes for its generalised path of tags and classes. Spark sums the votes by host, and
every page of a host is extracted again along the host's winning path. A page on which that path doesn't cover most
of the score of its own best container uses the latter. From there the page climbs to the whole article: to the
article or main around it, else to the outermost container whose further blocks are mostly unlinked text (for body,
mostly headings, paragraphs and text that stands in body itself).

A class or id word, a role or a form only makes an element suspect. Its text is kept until the page is read, then the
element is judged: html, body and main are never boilerplate by a word, an article only beside a larger one (or a larger text under a title) or within another, and any
other element not where it holds main or most of the page's unlinked text (unless the article plainly stands outside of it).

Defined results: a null or empty page, and one without any text, gives the empty string; a null or odd url
has the empty host; repeated rows are extracted alike; markup that breaks off counts as markup;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm.storage import written

#: Fixed values of HTML: what never holds text, what has no end tag, what starts a new block, what can hold an article.
HIDDEN = {"script", "style", "template", "noscript", "svg", "head", "title", "iframe", "object", "canvas", "math"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = set("address article aside blockquote body dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav "
            "ol p pre section summary table tbody td tfoot th thead tr ul".split())
HOLDER = {"article", "main", "section", "div", "td", "body"}
BOILER_TAGS = {"nav", "header", "footer", "aside", "button", "select", "textarea", "menu", "dialog", "label"}
NEVER_BY_WORD = {"html", "body", "main"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
PROSE = HEADINGS | {"p", "li", "blockquote", "pre", "dd", "dt", "figcaption", "table"}
MARKS = {"h1", "article", "main"}  # where an article plainly stands
BOILER_WORDS = set("ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies footer header menu modal nav navbar "
                   "navigation newsletter notice popup promo promoted related share sharing sidebar social sponsor sponsored subscribe toolbar widget".split())
BOILER_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog", "menu"}
CLOSES_ITSELF = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|template|noscript|svg|iframe|canvas|math|title|textarea)\b.*?(?:</\1\s*>|\Z)"
                   r"|<(/?)([a-zA-Z][\w:-]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>|<[!?/a-zA-Z][^>]*(?:>|\Z)", re.S | re.I)
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
DIGITS = re.compile(r"\d+")


ROOT = -1  # the whole of a page without body


class Part(NamedTuple):
    """A stretch of text."""

    text: str
    linked: bool
    under: tuple[int, ...]  # suspects around it
    article: int  # outermost article around it, or -1


class Block(NamedTuple):
    containers: tuple[int, ...]  # from the outside in
    text: str
    linked: int  # characters in links
    tag: str  # innermost of PROSE around it, or empty


class Suspect(NamedTuple):
    """An element that may be boilerplate by its names."""

    article: int  # its number if it is an outermost article, or -1
    begins: bool  # a name begins with the boilerplate word
    open_marks: frozenset[int]  # marks around it


class Mark(NamedTuple):
    tag: str
    under: tuple[int, ...]  # suspects around it, itself included
    doubted: bool
    article: int  # outermost article around it, or -1


class Page:
    """Blocks of a page in order, each with the containers it stands in."""

    def __init__(self, markup: str):
        self.paths: list[str] = []  # of each container
        self.tags: list[str] = []  # of each container
        self.chains: list[tuple[int, ...]] = []  # of each container: those around it and itself, from the outside in
        self.blocks: list[Block] = []
        drafts: list[tuple[tuple[int, ...], list[Part], str]] = []
        stack: list[tuple[str, bool, int, bool]] = []  # tag, boilerplate, container or -1, suspect
        text: list[Part] = []
        suspects: list[Suspect] = []
        marks: list[Mark] = []
        under: tuple[int, ...] = ()  # suspects around this place
        open_marks: list[int] = []
        article, articles = -1, 0  # the outermost one around this place, and those opened
        boiler, links = 0, 0

        def flush() -> None:
            if text:
                drafts.append((next((self.chains[e[2]] for e in reversed(stack) if e[2] >= 0), ()), text.copy(), next((e[0] for e in reversed(stack) if e[0] in PROSE), "")))
                text.clear()

        def pop() -> None:
            nonlocal boiler, links, under, article
            tag, bad, _, doubted = stack.pop()
            boiler -= bad
            links -= tag == "a"
            if doubted:
                under = under[:-1]
            if tag in MARKS:
                open_marks.pop()
                if tag == "article" and not any(marks[k].tag == "article" for k in open_marks):
                    article = -1

        def put(part: str) -> None:
            if part and not boiler:
                text.append(Part(part, links > 0, under, article))

        place = 0
        for m in TOKEN.finditer(markup):
            put(markup[place:m.start()])
            place = m.end()
            tag = m.group(3)
            if tag is None:
                continue
            tag = tag.lower()
            if m.group(2):
                if any(e[0] == tag for e in stack):
                    if tag in BLOCK:
                        flush()
                    while stack[-1][0] != tag:
                        pop()
                    pop()
                elif tag in BLOCK:
                    flush()
                continue
            if tag == "br":
                put(" ")
                continue
            if tag in BLOCK:
                flush()
                if stack and stack[-1][0] != "p" and any(e[0] == "p" for e in stack) or stack and stack[-1][0] == "p":
                    while any(e[0] == "p" for e in stack):
                        pop()
            for other in CLOSES_ITSELF.get(tag, ()):
                if stack and stack[-1][0] == other:
                    pop()
            if tag in VOID or m.group(4).endswith("/"):
                continue
            named = self._named(m.group(4)) if m.group(4) else {}
            bad = tag in HIDDEN or tag in BOILER_TAGS or "hidden" in named or named.get("aria-hidden") == "true"
            container = -1
            if tag in HOLDER and not bad and not boiler:
                around = next((e[2] for e in reversed(stack) if e[2] >= 0), -1)
                above, chain = (self.paths[around], self.chains[around]) if around >= 0 else ("", ())
                container = len(self.paths)
                self.tags.append(tag)
                self.chains.append((*chain, container))
                own = ".".join([tag, *sorted(DIGITS.sub("#", w.lower()) for w in named.get("class", "").split())])
                self.paths.append(f"{above}/{own}")
            begins, within = self._words(named)
            doubted = not bad and not boiler and tag not in NEVER_BY_WORD and (begins or within or tag == "form")
            if tag == "article" and article < 0:
                article, articles = articles, articles + 1
            if doubted:
                nested = tag == "article" and any(marks[k].tag == "article" for k in open_marks)
                suspects.append(Suspect(article if tag == "article" and not nested else -1, begins, frozenset(open_marks)))
                under = (*under, len(suspects) - 1)
            if tag in MARKS:
                open_marks.append(len(marks))
                marks.append(Mark(tag if not boiler and not bad else "", under, doubted, article))
            stack.append((tag, bad, container, doubted))
            boiler += bad
            links += tag == "a"
        put(markup[place:])
        flush()
        condemned = self._condemned(suspects, marks, [p for _, parts, _ in drafts for p in parts]) if suspects else set()
        for containers, parts, tag in drafts:
            parts = [p for p in parts if condemned.isdisjoint(p.under)]
            words = " ".join(entities.unescape("".join(p.text for p in parts)).split())
            if words:
                self.blocks.append(Block(containers, words, sum(len(p.text) for p in parts if p.linked), tag))

    @staticmethod
    def _named(attributes: str) -> dict[str, str]:
        return {m.group(1).lower(): next((g for g in m.groups()[1:] if g is not None), "") for m in ATTRIBUTE.finditer(attributes)}

    @staticmethod
    def _words(named: dict[str, str]) -> tuple[bool, bool]:
        """Whether a class or id begins with a boilerplate word (or the role is one), and whether it holds one."""
        if not named:
            return False, False
        names = [[w for w in re.split(r"[^a-z]+", n) if w] for n in f"{named.get('class', '')} {named.get('id', '')}".lower().split()]
        return (named.get("role", "").lower() in BOILER_ROLES or any(n and n[0] in BOILER_WORDS for n in names),
                any(w in BOILER_WORDS for n in names for w in n))

    @staticmethod
    def _condemned(suspects: list[Suspect], marks: list[Mark], parts: list[Part]) -> set[int]:
        """The suspects that are boilerplate, judged from the outside in by their share of the unlinked text."""
        weights = [(0 if p.linked else len(p.text.strip()), p.under, p.article) for p in parts]
        total = sum(w for w, _, _ in weights)
        inside = [0] * len(suspects)
        for w, under, _ in weights:
            for k in under:
                inside[k] += w
        holds_main = {k for m in marks if m.tag == "main" for k in m.under}
        headed = {k for m in marks if m.tag in ("h1", "article") and not m.doubted for k in m.under}
        spared = set(holds_main)
        top = {k for k, s in enumerate(suspects) if s.article >= 0}  # articles are judged last
        for k, s in enumerate(suspects):
            if k in top or k in spared or 2 * inside[k] <= total:
                continue
            apart = {m.tag for j, m in enumerate(marks) if j not in s.open_marks and k not in m.under and all(d in top or d in spared for d in m.under)}
            if inside[k] == total and not apart or k in headed:
                spared.add(k)
            elif not apart & {"article", "main"}:
                rival = sum(w for w, under, _ in weights if k not in under and all(d in top or d in spared for d in under))
                if not (s.begins or "h1" in apart) or 10 * rival <= inside[k]:
                    spared.add(k)
        sizes: dict[int, int] = {}
        for w, under, article in weights:
            if article >= 0 and all(d in top or d in spared for d in under):
                sizes[article] = sizes.get(article, 0) + w
        largest = max(sizes.values(), default=0)
        # text under a title outside of all articles stands against an article without one
        heads = [m for m in marks if m.tag == "h1" and all(d in top or d in spared for d in m.under)]
        titled = {m.article for m in heads}
        rest = sum(w for w, under, article in weights if article < 0 and all(d in spared for d in under)) if -1 in titled else 0
        spared |= {k for k in top if 2 * sizes.get(suspects[k].article, 0) >= (largest if suspects[k].article in titled else max(largest, rest))}
        return set(range(len(suspects))) - spared

    def votes(self) -> dict[str, float]:
        """Score of each path: the text outside links in its blocks, shared with the containers further out by halves."""
        scores: dict[str, float] = {}
        for containers, text, linked, _ in self.blocks:
            weight = max(0.0, len(text) - 2.0 * linked)
            for c in reversed(containers):
                scores[self.paths[c]] = scores.get(self.paths[c], 0.0) + weight
                weight /= 2
        return scores

    def best(self) -> str | None:
        scores = self.votes()
        return min(scores, key=lambda p: (-scores[p], p)) if scores else None

    def text(self, path: str | None) -> str:
        """The article around ``path``, or around the page's own best path if ``path`` doesn't cover most of its score."""
        scores = self.votes()
        if not scores:
            return "\n".join(b.text for b in self.blocks)
        best = min(scores, key=lambda p: (-scores[p], p))
        wanted = path if path in scores and 2 * scores[path] >= scores[best] else best
        size: dict[int, int] = {}  # characters of all blocks in a container; of those in links, and of unlinked prose
        linked, prose = dict(size), dict(size)
        headed: set[int] = set()
        for block in self.blocks:
            own = max(0, len(block.text) - block.linked)
            for c in (ROOT, *block.containers):
                size[c] = size.get(c, 0) + len(block.text)
                linked[c] = linked.get(c, 0) + block.linked
                # what stands in body itself is prose there
                prose[c] = prose.get(c, 0) + (own if block.tag or c == (block.containers or (ROOT,))[-1] else 0)
            if block.tag in HEADINGS:
                headed.update(block.containers)

        def climbed(c: int) -> tuple[int, bool]:
            """The container of the whole article around ``c``, and whether what it adds is mostly links."""
            chain = self.chains[c] if any(self.tags[k] == "body" for k in self.chains[c]) else (ROOT, *self.chains[c])
            tags = ["body" if k == ROOT else self.tags[k] for k in chain]

            def adds_text(k: int, tag: str) -> bool:
                more = size[k] - size[c]
                return 2 * (prose[k] - prose[c]) >= more if tag == "body" else 2 * (linked[k] - linked[c]) <= more

            if "article" in tags:
                c = chain[tags.index("article")]
                if c in headed or "main" not in tags:
                    return c, False
            elif "main" in tags:
                top = chain[tags.index("main")]
                return top, not adds_text(top, "main")
            start = tags.index("main") if "main" in tags else 0
            for k, tag in zip(chain[start:], tags[start:], strict=True):
                if k == c or adds_text(k, tag):
                    return k, False
            return c, False

        whole: set[int] = set()
        cores: set[int] = set()  # where pure links are left out beyond
        for c in range(len(self.paths)):
            if self.paths[c] == wanted and c in size:
                top, links = climbed(c)
                whole.add(top)
                cores.add(c if links else top)
        return "\n".join(b.text for b in self.blocks if ROOT in cores or not cores.isdisjoint(b.containers) or (
            not whole.isdisjoint(b.containers) and (b.tag in HEADINGS or b.linked < len(b.text))))


def host_of(url: str = "url"):
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))


def consensus_extraction(spark: SparkSession, pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars, host, path (the host's winning one)."""
    kind = dict(pages.dtypes)
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), host_of(url_col).alias("host"))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths, scores = [], [], []
            for host, markup in zip(batch.column("host"), batch.column("html"), strict=True):
                for path, score in Page(markup.as_py() or "").votes().items():
                    hosts.append(host.as_py())
                    paths.append(path)
                    scores.append(score)
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(scores, pa.float64())], names=["host", "path", "score"])

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [Page(h.as_py() or "").text(p.as_py()) for h, p in zip(batch.column("html"), batch.column("path"), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("page_id", "url")] + [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
                                             + [batch.column(c) for c in ("host", "path")], names=["page_id", "url", "text", "n_chars", "host", "path"])

    # scores are summed in whole characters, so that the order of summing doesn't matter
    votes = rows.select("host", "html").mapInArrow(vote, "host string, path string, score double").groupBy("host", "path").agg(F.sum(F.floor("score")).alias("score"))
    paths = written(spark, votes.groupBy("host").agg(F.min(F.struct((-F.col("score")).alias("score"), "path")).alias("w")).select("host", F.col("w.path").alias("path")), "op5-paths")
    out = f"page_id {kind[id_col]}, url {kind[url_col]}, text string, n_chars long, host string, path string"
    return rows.join(paths, "host", "left").mapInArrow(extract, out)
