"""Main text of web pages by consensus of the pages of a host.

Each page scores its containers by the text of the blocks in them. The best ones vote for their
tag-class paths (numbers in class names left out), Spark adds the votes up per host, and the pages of a host are
extracted again with the paths that won there. A page that has none of them uses its own best one. What stands
beside the winning container in the nearest one around it (heading, lead, further parts) comes along.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoregrid.llm.common import ready, written

WINNING_SHARE = 0.1
"""A path wins at a host if it has this share of the votes, so a host has ten winners at most."""
VOTES_PER_PAGE = 3
DEEPEST = 64
"""Containers nested deeper than this share the path of the one at this depth."""

# Kinds of elements.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style title textarea noscript template iframe svg select".split())
_DROPPED = _RAW | frozenset("head nav header footer aside form button object audio video canvas dialog menu".split())
_CONTAINERS = frozenset("html body main article section div td center".split())
_BLOCKS = _CONTAINERS | frozenset(
    "p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr th caption blockquote pre figure figcaption"
    " address hr fieldset details summary hgroup".split()
)
_CLOSED_BY_BLOCK = frozenset(["p"])
_CLOSED_BY_SAME = {"li": "ul ol", "dt": "dl", "dd": "dl", "tr": "table", "td": "tr table", "th": "tr table"}
_HINTS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent"
    " gdpr notice notices alert popup modal overlay newsletter subscribe subscription sidebar widget related"
    " recommended recommendations share sharing social comment comments disqus reply replies respond menu nav navbar"
    " navigation breadcrumb breadcrumbs pagination pager footer header masthead login signup toolbar skip".split()
)
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form".split())
_NOT_HINTS = frozenset(["no", "has", "with", "without"])
_OF_ARTICLE = frozenset(["entry", "post", "article", "story", "content"])
"""A header named after one of these holds the heading of the text, not that of the site."""
_WHOLE = frozenset(["html", "body", "main"])
_PAGE = ("", "html", "body")

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*))>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>?",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(text)} if text.strip(" /") else {}


def _unwanted(tag: str, attributes: dict[str, str]) -> bool:
    """Is the element a menu, notice, advert or the like, by its kind, role or names?"""
    named = f"{attributes.get('class', '')} {attributes.get('id', '')}".split()
    names = [[w.lower() for w in _WORDS.findall(name)] for name in named]
    own = any(len(parts) > 1 and parts[0] in _OF_ARTICLE and parts[-1] == "header" for parts in names)
    dropped = tag in _DROPPED and not (tag == "header" and own)
    if dropped or "hidden" in attributes or attributes.get("role", "").lower() in _ROLES:
        return tag not in _WHOLE
    if tag in _WHOLE:
        return False
    for parts in names:
        if own and parts[-1:] == ["header"]:
            continue
        if parts and parts[0] not in _NOT_HINTS and (parts[0] in _HINTS or parts[-1] in _HINTS):
            return True
    return False


def _last(path: str) -> str:
    """Tag of the innermost container of a path."""
    return path.rpartition("/")[2].partition(".")[0]


def lifted(path: str) -> str:
    """The path of the article (or else main) element around a container, which holds headings beside it too."""
    parts = path.split("/")
    for tag in ("article", "main"):
        for k in range(len(parts) - 1, 0, -1):
            if parts[k].split(".")[0] == tag:
                return "/".join(parts[: k + 1])
    return path


class Page:
    """Blocks of text of a page, each with its nearest container, and the containers' paths and scores."""

    def __init__(self, source: str) -> None:
        self.paths, self.parents = [""], [-1]
        self.blocks: list[tuple[str, int]] = []
        self.links: list[int] = []  # per block, how much of it is in links
        self.scores: dict[str, float] = {}
        self.stack: list[tuple[str, int, bool]] = []  # tag, container, inside something unwanted
        self.pending: list[str] = []
        self.linked = 0
        at, end = 0, len(source)
        while at < end:
            m = _TAG.search(source, at)
            self._text(source[at : m.start() if m else end])
            if not m:
                break
            at = m.end()
            tag = (m[2] or m[5] or "").lower()
            if not tag:
                continue
            if m[1] or m[4]:
                self._close(tag)
            else:
                self._open(tag, m[3] or m[6] or "")
                if tag in _RAW:
                    close = re.compile(rf"</{re.escape(tag)}[\s/>]", re.IGNORECASE).search(source, at)
                    at = close.start() if close else end
        self._flush()

    def _top(self) -> tuple[str, int, bool]:
        return self.stack[-1] if self.stack else ("", 0, False)

    def _text(self, raw: str) -> None:
        if raw and not self._top()[2]:
            text = html.unescape(raw) if "&" in raw else raw
            self.pending.append(text)
            if any(s[0] == "a" for s in self.stack):
                self.linked += len(text)

    def _flush(self) -> None:
        text = " ".join("".join(self.pending).split())
        if text:
            node = self._top()[1]
            self.blocks.append((text, node))
            self.links.append(min(self.linked, len(text)))
            worth = max(0.0, len(text) - 2.0 * self.linked)
            for share in (1.0, 0.5):
                if node >= 0:
                    path = lifted(self.paths[node])
                    self.scores[path] = self.scores.get(path, 0.0) + share * worth
                    node = self.parents[node]
        self.pending, self.linked = [], 0

    def _open(self, tag: str, rest: str) -> None:
        if tag == "br":
            self._text(" ")
        if tag in _BLOCKS:
            self._flush()
            self._imply(tag)
        if tag in _VOID or rest.endswith("/") and tag not in _BLOCKS | _RAW:
            return
        _, node, off = self._top()
        attributes = _attributes(rest)
        off = off or _unwanted(tag, attributes)
        if tag in _CONTAINERS and not off:
            depth = self.paths[node].count("/")
            kind = ".".join([tag, *sorted({re.sub(r"\d+", "", c) for c in attributes.get("class", "").split()} - {""})])
            self.paths.append(f"{self.paths[node]}/{kind}" if depth < DEEPEST else self.paths[node])
            self.parents.append(node)
            node = len(self.paths) - 1
        if off and not self._top()[2]:
            self._flush()
        self.stack.append((tag, node, off))

    def _imply(self, tag: str) -> None:
        """Close what the start of a block ends without a tag of its own."""
        for k in range(len(self.stack) - 1, -1, -1):
            held = self.stack[k][0]
            if held in _CLOSED_BY_BLOCK:
                del self.stack[k:]
                break
            if held in _BLOCKS or held in _DROPPED:
                break
        if tag in _CLOSED_BY_SAME:
            scope = _CLOSED_BY_SAME[tag].split()
            same = ("dt", "dd") if tag in ("dt", "dd") else ("td", "th") if tag in ("td", "th") else (tag,)
            for k in range(len(self.stack) - 1, -1, -1):
                if self.stack[k][0] in scope:
                    break
                if self.stack[k][0] in same:
                    del self.stack[k:]
                    break

    def _close(self, tag: str) -> None:
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] == tag:
                if any(s[0] in _BLOCKS or s[2] for s in self.stack[k:]):
                    self._flush()
                del self.stack[k:]
                return

    def votes(self) -> list[tuple[str, float]]:
        """The best paths and their shares of the page's score."""
        total = sum(self.scores.values())
        best = sorted(self.scores.items(), key=lambda x: (-x[1], x[0]))[:VOTES_PER_PAGE]
        return [(p, s / total) for p, s in best if s > 0]

    def text(self, winners: list[str]) -> str:
        """The blocks in the first of the winning paths that is here, or else in the page's own best path.

        The whole page wins only where nothing in it does better. What `extended` adds belongs to the text too.
        """
        if not self.scores:
            return ""
        own = min(self.scores, key=lambda p: (-self.scores[p], p))
        chosen = next((p for p in winners if p in self.scores and _last(p) not in _PAGE), own)
        inside = self._below({k for k, path in enumerate(self.paths) if path == chosen})
        if _last(chosen) not in (*_PAGE, "article", "main"):
            inside = self._below(self.extended(inside))
        return "\n".join(text for text, node in self.blocks if inside[node])

    def _below(self, tops: set[int]) -> list[bool]:
        inside = [False] * len(self.paths)
        for k, parent in enumerate(self.parents):  # parents come before their children
            inside[k] = k in tops or (parent >= 0 and inside[parent])
        return inside

    def extended(self, inside: list[bool]) -> set[int]:
        """For each outermost container inside, the nearest one around it that adds blocks, mostly not links, or else itself.

        Heading, lead and sibling parts often stand beside the container that holds most of the text.
        The whole page is never one of these.
        """
        added, linked = [0] * len(self.paths), [0] * len(self.paths)
        for (text, node), links in zip(self.blocks, self.links):
            if not inside[node]:
                added[node] += len(text)
                linked[node] += links
        for k in range(len(self.paths) - 1, 0, -1):
            added[self.parents[k]] += added[k]
            linked[self.parents[k]] += linked[k]
        around: dict[int, int] = {}  # the extension by the container above, as many share it
        tops = set()
        for k, parent in enumerate(self.parents):
            if not inside[k] or (parent >= 0 and inside[parent]):
                continue
            if parent not in around:
                at = parent
                while at > 0 and _last(self.paths[at]) not in _PAGE and not added[at]:
                    at = self.parents[at]
                good = at > 0 and _last(self.paths[at]) not in _PAGE and 2 * linked[at] <= added[at]
                around[parent] = at if good else -1
            tops.add(around[parent] if around[parent] >= 0 else k)
        return tops


def winners(pages: DataFrame) -> DataFrame:
    """(host, paths): the paths that won at each host, most votes first; counted with partial sums, so a large host is no hot spot."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [
                (host, path, share)
                for host, source in zip(frame["host"], frame["html"])
                for path, share in Page(source or "").votes()
            ]
            yield pd.DataFrame(rows, columns=["host", "path", "share"]).astype({"share": np.float64})

    votes = pages.select(_host(), "html").mapInPandas(run, "host string, path string, share double")
    votes = written(votes.groupBy("host", "path").agg(F.sum("share").alias("votes")), "votes")
    totals = votes.groupBy("host").agg(F.sum("votes").alias("total"))
    won = votes.join(totals, "host").where(F.col("votes") >= WINNING_SHARE * F.col("total"))
    ranked = F.sort_array(F.collect_list(F.struct((-F.col("votes")).alias("v"), "path")))
    return written(won.groupBy("host").agg(F.transform(ranked, lambda x: x["path"]).alias("paths")), "winners")


def _host() -> Column:
    address = F.lower(F.coalesce("url", F.lit("")))
    return F.regexp_extract(address, r"^[a-z][a-z0-9+.-]*://([^/?#]*)", 1).alias("host")


def extracted(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text (blocks joined by line feeds), n_chars.

    A page without text, and null html, give an empty text; very long pages are read whole. Null and strange addresses form one host of
    their own. Repeated rows and null ids stay. Other columns are not read.
    """
    ready(pages.sparkSession)
    won = winners(pages).withColumnRenamed("host", "_host")

    def run(sources: pd.Series, paths: pd.Series) -> pd.Series:
        return pd.Series([Page(s or "").text(list(p) if p is not None else []) for s, p in zip(sources, paths)])

    run.__annotations__ = {"sources": pd.Series, "paths": pd.Series, "return": pd.Series}
    rows = pages.select("page_id", "url", "html", _host().alias("_at")).join(won, F.col("_at") == F.col("_host"), "left")
    found = rows.select("page_id", "url", F.pandas_udf(run, "string")("html", "paths").alias("text"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))
