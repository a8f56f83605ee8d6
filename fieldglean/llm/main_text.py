"""Main text of web pages by tree scoring.

Paragraphs pass points for length and commas to their ancestors, discounted by link density. The best container and the siblings
that read like it are kept; menus, headers, footers, sidebars, notices, adverts, forms and reader comments inside them are not.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldglean.llm.common import pick, prepare

# Elements of HTML by what they mean for a text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style iframe noembed noframes noscript xmp textarea title".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BLOCK = HEADINGS | frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form header hgroup hr html legend li main menu nav ol optgroup option p pre search section select
    summary table tbody td tfoot th thead tr ul""".split())
#: Elements that never hold text of an article.
NEVER = frozenset("""applet aside audio button canvas datalist dialog embed footer head iframe input menu meter nav noembed noframes
    noscript object optgroup option output progress script search select style svg template textarea title video xmp""".split())
#: Elements that hold points of their own; the others pass on all they get.
CONTAINERS = frozenset("article body center div html main section td".split())
#: What a start tag closes if it is open, and the elements that end the search for it.
CLOSES = {"li": (("li",), ("ul", "ol", "menu", "dir")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
          "tr": (("tr",), ("table",)), "td": (("td", "th"), ("table",)), "th": (("td", "th"), ("table",)),
          "thead": (("thead", "tbody", "tfoot"), ("table",)), "tbody": (("thead", "tbody", "tfoot"), ("table",)),
          "tfoot": (("thead", "tbody", "tfoot"), ("table",)), "option": (("option",), ("select", "datalist")),
          "optgroup": (("optgroup",), ("select",)), "a": (("a",), ("table", "td", "th"))}
SCOPES = frozenset("applet button caption html marquee object table td template th".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data dfn em font i kbd label mark nobr q s samp small span strike strong sub sup time tt u var".split())
#: Words of class, id and role that mark what is around an article.
AROUND = frozenset("""ad ads adsense advert advertisement advertisements advertising adverts alert alerts alertdialog aside banner
    breadcrumb breadcrumbs comment commentlist comments complementary consent contentinfo cookie cookies dialog disclaimer discussion
    disqus footer gdpr login masthead menu menubar modal nav navbar navigation newsletter notice notices notification notifications
    pager pagination paywall popup promo promoted promotion recommendations recommended related remark replies reply respond search
    share sharing sidebar signin signup skip social sponsor sponsored subscribe subscription toc toolbar tooltip trending
    widget widgets""".split())
HEADER = frozenset("header topbar head".split())
OWN_HEADER = frozenset("article content entry post story title".split())
#: Words that say a page has or lacks a part, before the name of the part.
ABOUT = frozenset("has have with without no hide hidden hides show disable".split())

_TAG = re.compile(r"<(?:!--|[!?]|/(?![A-Za-z])|(/?)([A-Za-z][^\s/>]*))")
_STOP = re.compile(r">|=\s*([\"'])")
_ATTRIBUTE = re.compile(r"([A-Za-z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAMES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_NUMBER = re.compile(r"&#(?:0*[1-9]\d{7,}|[xX]0*[1-9A-Fa-f][0-9A-Fa-f]{7,});?|&#([xX]?)0{9,}")
_COMMAS = re.compile("[,，、،]")
_raw_ends = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in RAW}


def _decoded(text: str) -> str:
    """Character references decoded. Numbers beyond Unicode, however long, are the replacement character."""
    if "&" not in text:
        return text
    if "&#" in text:
        text = _NUMBER.sub(lambda m: "�" if m[1] is None else f"&#{m[1]}0", text)
    return references.unescape(text)


class _Page:
    """A page as elements in page order (parent, tag, flags) and texts (element, block, text, in a link).

    Two texts are of one block if no block element begins or ends between them."""

    def __init__(self, html: str):
        self.parent, self.tags, self.dropped, self.inside, self.linked, self.own_header = [-1], ["html"], [False], [False], [False], [False]
        self.texts: list[tuple[int, int, str, bool]] = []
        self._open, self._block = [0], 0
        # Places of open elements by tag, and of open block elements: no search walks up the tree.
        self._places: dict[str, list[int]] = {}
        self._blocks: list[int] = []
        self._parse(html)

    def _parse(self, html: str) -> None:
        at, n, dead = 0, len(html), set()
        while at < n:
            found = _TAG.search(html, at)
            if not found:
                self._text(html[at:])
                return
            if found.start() > at:
                self._text(html[at:found.start()])
            at, name = found.end(), found[2]
            if name is None:
                if found[0] == "<!--":
                    end = html.find("-->", at - 2)  # <!--> and <!---> are whole
                    at = n if end < 0 else max(end + 3, at)
                else:
                    end = html.find(">", at)
                    at = n if end < 0 else end + 1
                continue
            start = at
            while True:
                stop = _STOP.search(html, at)
                if not stop:
                    return  # the page ends inside a tag
                at = stop.end()
                if stop[1] is None:
                    break
                if stop[1] not in dead:
                    end = html.find(stop[1], at)
                    if end < 0:
                        dead.add(stop[1])  # a quote that never ends is not one
                    else:
                        at = end + 1
            name = name.lower()
            if found[1]:
                self._end(name)
                continue
            self._start(name, html[start:at - 1])
            if name in RAW:
                end = _raw_ends[name].search(html, at)
                at = end.start() if end else n

    def _text(self, text: str) -> None:
        i = self._open[-1]
        if not self.dropped[i]:
            self.texts.append((i, self._block, _decoded(text), self.linked[i]))

    def _push(self, tag: str) -> None:
        place = len(self._open)
        self._open.append(len(self.tags) - 1)
        self._places.setdefault(tag, []).append(place)
        if tag in BLOCK:
            self._blocks.append(place)

    def _pop_to(self, place: int) -> None:
        if self._blocks and self._blocks[-1] >= place:
            self._block += 1
        while len(self._open) > place:
            tag = self.tags[self._open.pop()]
            self._places[tag].pop()
            if tag in BLOCK:
                self._blocks.pop()

    def _find(self, names, stops) -> int:
        """The place of the innermost open element of these names, 0 if there is none or one of `stops` lies within it."""
        inner = max((self._places[tag][-1] for tag in names if self._places.get(tag)), default=0)
        if inner and any(self._places[tag][-1] > inner for tag in stops if self._places.get(tag)):
            return 0
        return inner

    def _start(self, name: str, attributes: str) -> None:
        if name == "br":
            self._text(" ")
            return
        if name in ("html", "body") and name in self.tags[:3]:
            return
        closes = CLOSES.get(name)
        if closes and (place := self._find(*closes)):
            self._pop_to(place)
        elif name in BLOCK:
            if place := self._find(("p",), SCOPES):
                self._pop_to(place)
            if name in HEADINGS and self.tags[self._open[-1]] in HEADINGS:
                self._pop_to(len(self._open) - 1)
        if name in BLOCK:
            self._block += 1
        if name in VOID:
            return
        up = self._open[-1]
        inside = self.inside[up] or name in ("article", "main")
        self.parent.append(up)
        self.tags.append(name)
        self.inside.append(inside)
        self.linked.append(self.linked[up] or name == "a")
        self.own_header.append(inside and (name == "header" and not self.dropped[up] or self.own_header[up]))
        self.dropped.append(self._drops(name, attributes, up))
        self._push(name)

    def _drops(self, name: str, attributes: str, up: int) -> bool:
        if name in NEVER:
            return True
        if name == "body":
            return False
        # A form that wraps the page is no reason to drop the article in it, and an article's own header holds its title.
        main = name == "main" or name == "article" and self._in_form(up) or name in HEADINGS and self.own_header[up]
        if self.dropped[up] and not main and not attributes:
            return True
        if name in ("form", "fieldset", "header"):
            return True
        if "=" in attributes or "hidden" in attributes:
            words = []
            for key, a, b, c in _ATTRIBUTE.findall(attributes):
                key, value = key.lower(), a or b or c
                if key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and re.search(
                        r"(display\s*:\s*none|visibility\s*:\s*hidden)", value, re.I):
                    return True
                if key == "role" and value.lower() == "main":
                    main = True
                if key in ("class", "id", "role"):
                    words += [w for name_ in value.split() for w in ["", *_NAMES.findall(name_)]]
            if not main:
                words = [w.lower() for w in words]
                for before, word in zip(["", *words], words):
                    if word in AROUND and before not in ABOUT:
                        return True
                    if word in HEADER and before not in ABOUT and not OWN_HEADER.intersection(words):
                        return True
        return self.dropped[up] and not main

    def _in_form(self, i: int) -> bool:
        while self.dropped[i] and self.tags[i] not in ("form", "fieldset"):
            if self.tags[i] not in ("div", "table", "tbody", "tr", "td", "section"):
                return False
            i = self.parent[i]
        return self.tags[i] in ("form", "fieldset")

    def _end(self, name: str) -> None:
        if name == "br":
            self._text(" ")
            return
        if name == "p" and not self._find(("p",), SCOPES):
            self._block += 1
            return
        if name in INLINE:  # an inline element ends only if no block element is open in it
            place = self._find((name,), ())
            if place and not (self._blocks and self._blocks[-1] > place):
                self._pop_to(place)
            return
        if name in ("body", "html"):
            return
        if place := self._find((name,), SCOPES - {name} if name not in ("table", "tr", "tbody", "thead", "tfoot") else ()):
            self._pop_to(place)


def _measures(page: _Page) -> tuple[list[float], list[int], list[int], list[int]]:
    """Of each element: points, characters, characters in links, links. One pass over texts, one up the tree."""
    n = len(page.tags)
    points, chars, in_links, links = [0.0] * n, [0] * n, [0] * n, [0] * n
    runs: dict[int, list] = {}
    for i, block, text, linked in page.texts:
        text = " ".join(text.split())
        if text:
            chars[i] += len(text)
            run = runs.setdefault(block, [i, 0, 0, 0])
            run[1] += len(text)
            run[2] += len(_COMMAS.findall(text))
            if linked:
                in_links[i] += len(text)
                run[3] += len(text)
    for i, size, commas, link in runs.values():
        points[i] += (1 + commas + size / 100) * (1 - link / size)
    for i in range(n - 1, 0, -1):
        up = page.parent[i]
        links[i] += page.tags[i] == "a"
        points[up] += points[i] / 2 if page.tags[i] in CONTAINERS else points[i]
        chars[up] += chars[i]
        in_links[up] += in_links[i]
        links[up] += links[i]
    return points, chars, in_links, links


def main_text(html: str | None) -> str:
    """The main text of one page: blocks in page order, joined by line breaks; empty if there is none."""
    if not html:
        return ""
    page = _Page(html)
    points, chars, in_links, links = _measures(page)
    density = [b / a if a else 0.0 for a, b in zip(chars, in_links)]
    places = [i for i in range(len(page.tags)) if page.tags[i] in CONTAINERS and points[i] > 0 and not page.dropped[i]]
    if not places:
        return ""
    # Of equal scores the outermost container, which comes first.
    best = max(places, key=lambda i: points[i] * (1 - density[i]))
    top, i = best, best
    while i >= 0:  # the article that the container is a part of, else its main element
        if page.tags[i] == "article" or page.tags[i] == "main" and page.tags[top] != "article":
            top = i
        i = page.parent[i]
    least = points[top] * (1 - density[top])
    roots = {top}
    if page.tags[top] not in ("html", "body"):
        around = page.parent[top]
        for i in (j for j in range(len(page.tags)) if page.parent[j] == around and chars[j] and density[j] < 1 / 3):
            if page.tags[top] == "article":
                like = page.tags[i] == "h1" or page.tags[i] == "article" and points[i] * (1 - density[i]) >= least / 5
            else:
                like = page.tags[i] not in CONTAINERS or points[i] * (1 - density[i]) >= least / 10
            if like:
                roots.add(i)
    within = [False] * len(page.tags)
    for i, tag in enumerate(page.tags):
        up = page.parent[i]
        if i in roots:
            within[i] = True
        elif up >= 0 and within[up]:
            menu = tag in ("ul", "ol", "div", "section", "table", "dl") and links[i] > 1 and density[i] >= 0.9
            comment = tag == "article" and page.inside[up] and page.tags[top] == "article" and not top <= i <= best
            within[i] = not (menu or comment)
    blocks: list[str] = []
    parts, now = [], -1
    for i, block, text, _ in page.texts:  # none of dropped elements
        if within[i]:
            if block != now:
                blocks.append(" ".join("".join(parts).split()))
                parts, now = [], block
            parts.append(text)
    blocks.append(" ".join("".join(parts).split()))
    return "\n".join(b for b in blocks if b)


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per row: key, url, text (main text, empty if there is none), n_chars (its code points).

    Pages are taken whole, one by one: repeated rows and null keys stay, a null or empty page has an empty text, an empty table
    gives an empty result, other columns are not looked at. Bytes that are not UTF-8 become replacement characters. White space
    is what Unicode calls so, no-break spaces included; a <br> is white space. Time and memory grow with a page's length.
    """
    prepare(pages.sparkSession)
    rows = pick(pages, key, url, html)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text((v.as_py() or b"").decode("utf-8", "replace")) for v in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(
                [len(t) for t in texts], pa.int64())], [key, url, "text", "n_chars"])

    types = [rows.schema[c].dataType.simpleString() for c in (key, url)]
    return rows.select(key, url, F.col(html).cast("binary")).mapInArrow(run, f"`{key}` {types[0]}, `{url}` {types[1]}, text string, n_chars long")
