"""The main text of web pages by the distribution of text over line blocks."""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from careerpanel.llm.common import map_slices, strings

#: Lines of a sliding window, and characters in one that begin the text.
WINDOW, SURGE = 3, 86
#: Elements whose content is not shown as text, and those that hold no article text.
RAW = {"script", "style", "noscript", "template", "iframe", "object", "textarea", "svg", "math", "canvas", "audio", "video", "title"}
ASIDE = {"nav", "aside", "footer", "form", "button", "select", "dialog", "menu", "menuitem", "label", "input"}
#: Elements that hold all of the text.
WHOLE = {"html", "body", "main", "article"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "mark",
    "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
#: Words of class, id and role that mark an element as no part of an article.
MARKS = set(
    "ad ads adv advert adverts advertisement advertising adsense banner promo promoted promotion sponsor sponsored cookie cookies consent gdpr "
    "notice notices alert popup modal overlay menu menus nav navbar navigation breadcrumb breadcrumbs sidebar side aside footer header masthead "
    "comment comments commentlist reply replies disqus discussion respond share sharing social related recommended recommendations newsletter "
    "subscribe subscription signup login search toolbar pagination pager widget widgets skip toc contentinfo complementary dialog".split()
)
_TAG = re.compile(r"""<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*)(?:>|$)""", re.S)
_MARK = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:[\s=/]|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


def marked(name: str, attributes: str, inside: bool) -> bool:
    """Whether an element's names or attributes say that it is no part of an article. Names of the page as a
    whole and of articles say nothing."""
    if not attributes:
        return False
    if _HIDDEN.search(attributes):
        return True
    if name in WHOLE:
        return False
    words = {w for m in _MARK.finditer(attributes) for w in _WORD.findall(_CAMEL.sub(" ", m[1] or m[2] or m[3] or "").lower())}
    found = words & MARKS
    return bool(found - {"header", "banner"} if inside else found)


def lines(page: str) -> list[tuple[str, int, bool]]:
    """The page's lines in order: text, characters of it in links, whether in an article.

    A line ends where a block-level element begins or ends, and is not empty. Left out: markup, comments,
    elements of RAW and ASIDE, page headers, and elements marked as asides by name; each but those of RAW leaves
    one empty line outside of articles.
    """
    out: list[tuple[str, int, bool]] = []
    open_: list[str] = []
    parts: list[str] = []
    linked = depth = 0  # depth: open articles
    skip = -1  # the place in open_ of the element that is left out

    def end() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            out.append((text, linked, depth > 0))
        parts.clear()
        linked = 0

    at = 0
    while True:
        m = _TAG.search(page, at)
        if skip < 0 and (text := page[at : m.start() if m else len(page)]):
            parts.append(text)
            if "a" in open_:
                linked += len(text.strip())
        if m is None:
            break
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if m[1]:
            if name not in open_:
                if name == "p" and skip < 0:
                    end()
                continue
            place = len(open_) - 1 - open_[::-1].index(name)
            if name in INLINE and any(x not in INLINE for x in open_[place + 1 :]):
                continue  # closes nothing beyond its block
            for x in open_[place:]:
                if skip < 0 and x in ("article", "main"):
                    end()
                    depth -= 1
            if skip >= place:
                skip = -1
            del open_[place:]
            if skip < 0 and name not in INLINE:
                end()
            continue
        if name in RAW and not m[3].rstrip().endswith("/"):
            close = re.compile(rf"</{re.escape(name)}\s*(?:>|$)|$", re.I).search(page, at)
            at = close.end()
            continue
        if name in VOID:
            if name in ("br", "hr") and skip < 0:
                end()
            continue
        if name not in INLINE:
            if skip < 0:
                end()
            while open_ and (open_[-1] in INLINE or open_[-1] == "p" or open_[-1] == name == "li") and skip != len(open_) - 1:
                open_.pop()
        open_.append(name)
        if skip < 0:
            if name in ASIDE or (name == "header" and not depth) or marked(name, m[3], depth > 0):
                skip = len(open_) - 1
                if not depth:
                    out.append(("", 0, False))
            elif name in ("article", "main"):
                depth += 1
    if skip < 0:
        end()
    return out


def main_text(page: str) -> str:
    """The article's text, one line for each block.

    The weight of a line is its characters, of which links outside of articles, and where the page has an
    article all lines outside of it, count nothing. Weights are summed over windows of WINDOW lines. The text
    begins at the surge: the first window with SURGE characters (or a quarter of the fullest window, if that is
    less; with any, if the page marks its article), and ends at the last dive: where windows stay empty after the last such window. All lines with
    weight in between are kept.
    """
    found = lines(page)
    article = any(inside for text, _, inside in found if text)
    weight = np.array([len(t) if inside else 0 if article or 2 * linked > len(t) else len(t) for t, linked, inside in found], np.int64)
    if not weight.any():
        return ""
    window = np.convolve(weight, np.ones(WINDOW, np.int64))[WINDOW - 1 :]
    surge = 1 if article else min(SURGE, -(-int(window.max()) // 4))
    full = np.flatnonzero(window >= surge)
    dive = np.flatnonzero(window[full[-1] :] == 0)
    begin, stop = int(full[0]), int(full[-1] + dive[0]) if len(dive) else len(weight)
    return "\n".join(found[i][0] for i in range(begin, stop) if weight[i])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars) of every row: the main text of the whole page and its code points.

    Null counts as an empty page; a page without text gives an empty text. Repeated rows give repeated
    results; a page of any length is one row; further columns are not read; there is no shuffle.
    """

    def start():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [main_text(x) for x in strings(batch, 2)]
            return pa.record_batch([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["id", "url", "text", "n_chars"])

        return step

    kinds = [pages.schema[c].dataType.simpleString() for c in (id_col, url_col)]
    out = map_slices(pages.select(id_col, url_col, html_col), start, f"id {kinds[0]}, url {kinds[1]}, text string, n_chars bigint", rows=100)
    return out.withColumnsRenamed({"id": id_col, "url": url_col})
