"""Web pages to a node table, and field extraction by joining it with rule tables.

One Arrow-batched step parses each page once. What follows is relational: the rule table (a few
dozen rows written in this package) is broadcast, only nodes a rule names survive the join, and one
aggregate on the page builds the record.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Mapping, Sequence
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldglean.functions.scalars import strip
from fieldglean.rules.sites import RULE_SCHEMA
from fieldglean.session import ship_package

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
# Start tag -> open tags it closes implicitly.
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "body": {"head"}}
SCOPE = frozenset("html body div section article table tbody ul ol dl nav main form select".split())

NODE_COLUMNS = """node_id int, parent_id int, tag string, tags array<string>, idx array<int>,
    from_end array<int>, anchors array<struct<id:string,depth:int>>, attrs map<string,string>,
    text string, content string"""
NODE_TYPES = {
    "node_id": pa.int32(), "parent_id": pa.int32(), "tag": pa.string(), "tags": pa.list_(pa.string()), "idx": pa.list_(pa.int32()),
    "from_end": pa.list_(pa.int32()), "anchors": pa.list_(pa.struct([("id", pa.string()), ("depth", pa.int32())])),
    "attrs": pa.map_(pa.string(), pa.string()), "text": pa.string(), "content": pa.string(),
}


#: Plain markup: a start tag with quoted attributes, an end tag, a text, the doctype. The last group is the '<' of anything else.
_PLAIN = re.compile(r'<([a-zA-Z][a-zA-Z0-9]*)((?: [a-zA-Z][-a-zA-Z0-9_]*="[^"&]*")*)>|</([a-zA-Z][a-zA-Z0-9]*)>|([^<]+)|(<!(?i:doctype)[^>]*>)|(<)')
_START, _END, _TEXT, _DOCTYPE = 2, 3, 4, 5
_ATTRIBUTE = re.compile(r' ([a-zA-Z][-a-zA-Z0-9_]*)="([^"]*)"')
#: Elements whose content is no markup.
_RAW = frozenset((*HTMLParser.CDATA_CONTENT_ELEMENTS, *getattr(HTMLParser, "RCDATA_CONTENT_ELEMENTS", ()), "plaintext"))

#: Elements of so many levels are remembered while a page is handed on, about so many of them.
_SHALLOW, _KNOWN = 32, 1024

#: Tag of the row that stands for a page the parser gave up on.
ERROR = "#error"
#: A record batch holds about so many elements or characters of text, so that a large page leaves its step in pieces.
BATCH_NODES, BATCH_TEXT = 4096, 8 << 20


class _Paths:
    """The tag paths of all rules as one automaton per anchor id: a state is a step of some path.

    An element is in a set of states, known by its number: 0 is the empty one, ``root`` that of the page, ``ends`` has those in which
    a path ends. Sets and moves between them are made as pages show them; only tags and ids of rules make any.
    """

    def __init__(self, paths: Mapping[str, Iterable[str]]) -> None:
        self.start: dict[str, dict] = {}
        self.tags: set[str] = set()
        for anchor, tails in paths.items():
            for tail in tails:
                state = self.start.setdefault(anchor, {})
                for tag in tail.split("/") if tail else ():
                    self.tags.add(tag)
                    state = state.setdefault(tag, {})
                state[None] = True
        self.sets: list[list[dict]] = []
        self.numbers: dict[tuple[int, ...], int] = {}
        self.ends: set[int] = set()
        #: By set: moves by tag, for elements without an id of a rule.
        self.moves: list[dict[str, int]] = []
        self.marked: dict[tuple[int, str, str], int] = {}
        self.number([])
        self.root = self.number([self.start[""]] if "" in self.start else [])

    def number(self, states: list[dict]) -> int:
        key = tuple(map(id, states))
        if key not in self.numbers:
            self.numbers[key] = len(self.sets)
            if any(None in s for s in states):
                self.ends.add(len(self.sets))
            self.sets.append(states)
            self.moves.append({})
        return self.numbers[key]

    def enter(self, at: int, tag: str, own_id: str | None) -> int:
        """The set of an element from that of its parent."""
        known = tag in self.tags
        if own_id and own_id in self.start:
            move, key = self.marked, (at, tag if known else "", own_id)
        elif known:
            move, key, own_id = self.moves[at], tag, None
        else:
            return 0
        if key not in move:
            states = [s[tag] for s in self.sets[at] if tag in s]
            move[key] = self.number(states + [self.start[own_id]] if own_id else states)
        return move[key]


class _Reader(HTMLParser):
    """Streams a page past the rules: only elements they name are kept, with their texts.

    An element is a tuple (tag, number on the page, parent, ordinal, id, states, numbers of its children by tag). Closed ones that
    nothing refers to are forgotten.
    """

    def __init__(self, keep, content, paths: _Paths | None) -> None:
        super().__init__(convert_charrefs=True)
        self.keep, self.content, self.paths = keep, content, paths
        self.root = ("", -1, None, 0, None, paths.root if paths else 0, {})
        self.open: list[tuple] = []
        self.names: dict[str, int] = {}
        self.count = 0
        # Kept elements in page order, by number: [element, attributes, own text, whole text].
        self.kept: dict[int, list] = {}
        # Text pieces while an element whose whole text is wanted is open, and where such an element begins among them.
        self.pieces: list[str] = []
        self.begins: dict[int, int] = {}

    def read(self, markup: str) -> None:
        """A whole page. Plain markup takes one pattern; from the first piece that is none, the rest goes through the parser."""
        start, end, text = self.handle_starttag, self.handle_endtag, self.handle_data
        rest = len(markup)
        for piece in _PLAIN.finditer(markup):
            kind = piece.lastindex
            if kind == _START:
                tag, attrs = piece.group(1, 2)
                tag = tag.lower()
                if tag in _RAW:
                    rest = piece.start()
                    break
                start(tag, [(k.lower(), v) for k, v in _ATTRIBUTE.findall(attrs)] if attrs else ())
            elif kind == _END:
                end(piece[3].lower())
            elif kind == _TEXT:
                text(unescape(piece[4]))
            elif kind != _DOCTYPE:
                rest = piece.start()
                break
        if rest < len(markup):
            self.feed(markup[rest:])
            self.close()
        self.close_to(0)

    def close_to(self, depth: int) -> None:
        for e in reversed(self.open[depth:]):
            self.names[e[0]] -= 1
            if e[1] in self.begins:
                self.kept[e[1]][3] = "".join(self.pieces[self.begins.pop(e[1]):])
                if not self.begins:
                    self.pieces.clear()
        del self.open[depth:]

    def close_for(self, closing: set[str]) -> None:
        """Closes what a start tag ends without an end tag, the nearest of ``closing`` in its scope."""
        for depth in range(len(self.open) - 1, -1, -1):
            name = self.open[depth][0]
            if name in closing:
                self.close_to(depth)
                return
            if name in SCOPE:
                return

    def handle_starttag(self, tag: str, attrs: Sequence) -> None:
        names, line, node, paths = self.names, self.open, self.count, self.paths
        if tag in CLOSES:
            for c in CLOSES[tag]:
                if names.get(c):
                    self.close_for(CLOSES[tag])
                    break
        up = line[-1] if line else self.root
        counts, states = up[6], up[5]
        counts[tag] = ordinal = counts.get(tag, 0) + 1
        own_id = None
        for k, v in attrs:
            if k == "id":
                own_id = v or ""
        if own_id:
            states = paths.enter(states, tag, own_id) if paths else 0
        elif states:
            found = paths.moves[states].get(tag)
            states = paths.enter(states, tag, None) if found is None else found
        e = (tag, node, up, ordinal, own_id, states, {})
        self.count = node + 1
        if states in paths.ends if paths else self.keep(tag):
            whole = self.content(tag)
            self.kept[node] = [e, {k: v or "" for k, v in attrs}, None, "" if whole else None]
            if whole and tag not in VOID:
                self.begins[node] = len(self.pieces)
        if tag not in VOID:
            line.append(e)
            names[tag] = names.get(tag, 0) + 1

    def handle_endtag(self, tag: str) -> None:
        line = self.open
        if line and line[-1][0] == tag and line[-1][1] not in self.begins:
            line.pop()
            self.names[tag] -= 1
            return
        if not self.names.get(tag):
            return
        for depth in range(len(line) - 1, -1, -1):
            if line[depth][0] == tag:
                self.close_to(depth)
                return

    def handle_data(self, data: str) -> None:
        if not self.open:
            return
        top = self.open[-1]
        if not top[6] and top[1] in self.kept:
            record = self.kept[top[1]]
            record[2] = (record[2] or "") + data
        if self.begins:
            self.pieces.append(data)


def _nodes(markup: str, keep, content, paths: _Paths | None = None) -> Iterator[tuple]:
    """Rows of the elements that end one of ``paths``, else of those ``keep(tag)`` accepts; ``content(tag)`` asks for the whole text."""
    reader = _Reader(keep, content, paths)
    reader.read(markup)
    known: dict[int, tuple] = {}
    for e, attrs, own, text in reader.kept.values():
        tags, idx, from_end, anchors = _line(e, known)
        yield e[1], e[2][1], e[0], tags, idx, from_end, anchors, list(attrs.items()), own, text


def _line(e: tuple, known: dict[int, tuple]) -> tuple[list, list, list, list]:
    """Tags, ordinals, ordinals from the end and ids down to an element of a page read to its end.

    ``known`` holds those of some elements above earlier ones: of the first ``_SHALLOW`` levels, of which many elements share most.
    """
    missing = []
    while e[2] is not None and e[1] not in known:
        missing.append(e)
        e = e[2]
    tags, idx, from_end, anchors = map(list, known.get(e[1], ((), (), (), ())))
    if len(known) > _KNOWN:
        known.clear()
    for n in range(len(missing) - 1, -1, -1):
        tag, node, up, ordinal, own_id, _, _ = missing[n]
        tags.append(tag)
        idx.append(ordinal)
        from_end.append(up[6][tag] - ordinal + 1)
        if own_id:
            anchors.append({"id": own_id, "depth": len(tags)})
        if n and len(tags) <= _SHALLOW:
            known[node] = (tuple(tags), tuple(idx), tuple(from_end), tuple(anchors))
    return tags, idx, from_end, anchors


def html_nodes(pages: DataFrame, html: str = "html", carry: Sequence[str] = ("page_id",),
               tags: Iterable[str] | None = None, content: Iterable[str] | None = None,
               paths: Mapping[str, Iterable[str]] | None = None, errors: bool = False) -> DataFrame:
    """One row per element: path, ordinals, ids above it, attributes, own text, whole text.

    ``tags`` keeps only those elements, ``paths`` only those on one of the tag paths below an anchor
    id ('' is the root), and ``content`` fills the whole text only for those tags. So the step emits
    what the query reads and not every page once per nesting level.

    A page the parser gives up on has no elements. With ``errors`` it has one row, of tag ``#error``, whose text says why.
    """
    ship_package(pages.sparkSession)
    by_tag = frozenset(tags) if tags is not None else None
    full = frozenset(content) if content is not None else None
    wanted = {a: sorted(p) for a, p in paths.items()} if paths is not None else None
    carry = list(carry)
    fields = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in carry)

    def keep(tag: str) -> bool:
        return by_tag is None or tag in by_tag

    def whole(tag: str) -> bool:
        return full is None or tag in full

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _Paths(wanted) if wanted is not None else None
        for batch in batches:
            rows, at, size = [], [], 0

            def out() -> pa.RecordBatch:
                columns = zip(*rows) if rows else [()] * len(NODE_TYPES)
                arrays = [batch.column(c).take(pa.array(at, pa.int32())) for c in carry]
                arrays += [pa.array(list(col), kind) for col, kind in zip(columns, NODE_TYPES.values())]
                return pa.RecordBatch.from_arrays(arrays, [*carry, *NODE_TYPES])

            for i, markup in enumerate(batch.column(html)):
                try:
                    for row in _nodes(markup.as_py() or "", keep, whole, automaton):
                        rows.append(row)
                        at.append(i)
                        size += len(row[8] or "") + len(row[9] or "")
                        if len(rows) >= BATCH_NODES or size >= BATCH_TEXT:
                            yield out()
                            rows, at, size = [], [], 0
                except (AssertionError, ValueError, LookupError, NotImplementedError) as e:
                    if errors:
                        rows.append((-1, -1, ERROR, [ERROR], [1], [1], [], [], f"{type(e).__name__}: {e}", None))
                        at.append(i)
            yield out()

    return pages.select(*carry, html).mapInArrow(parse, f"{fields}, {NODE_COLUMNS}")


def page_errors(pages: DataFrame, html: str = "html", carry: Sequence[str] = ("page_id",)) -> DataFrame:
    """The pages the parser gave up on, and why: ``carry`` and ``error``."""
    found = html_nodes(pages, html, carry, tags=[], content=[], errors=True)
    return found.where(F.col("tag") == ERROR).select(*carry, F.col("text").alias("error"))


def rule_rows(rules: Iterable[dict]) -> list[dict]:
    """Rules with their path split into tags and ordinals.

    A step without an ordinal stands for any (0); ``last()`` and ``last()-1`` count from the end.
    """
    out = []
    for rule in rules:
        tags, idx, end = [], [], []
        for step in [s for s in rule["path"].split("/") if s]:
            name, _, pos = step.partition("[")
            pos = pos.rstrip("]")
            from_end = pos.startswith("last()")
            tags.append(name)
            idx.append(int(pos) if pos and not from_end else 0)
            end.append((1 - int(pos[6:] or 0)) if from_end else 0)
        out.append({**rule, "path_tags": tags, "path_idx": idx, "path_end": end})
    return out


def rule_frame(spark: SparkSession, rules: Iterable[dict]) -> DataFrame:
    names = [c.split()[0] for c in RULE_SCHEMA.replace("\n", " ").split(",")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rule_rows(rules)], RULE_SCHEMA)


def match_rules(nodes: DataFrame, rules: DataFrame, site: str = "site") -> DataFrame:
    """Nodes beside the rules that name them: same site, anchor id and tag path, fitting ordinals.

    An anchored path starts below an element with that id; anchor '' is a path from the root. ``row``
    holds the ordinals down to the repeated row of the rule, and is empty for a field of the page.
    """
    anchors = F.array_union(F.array(F.struct(F.lit("").alias("id"), F.lit(0).alias("depth"))), F.col("anchors"))
    spread = nodes.withColumn("__a", F.explode(anchors)).withColumn("anchor", F.col("__a.id"))
    rest = lambda c: F.slice(c, F.col("__a.depth") + 1, F.greatest(F.size(c) - F.col("__a.depth"), F.lit(0)))
    spread = spread.withColumns({"path_tags": rest(F.col("tags")), "rel_idx": rest(F.col("idx")),
                                 "rel_end": rest(F.col("from_end"))}).drop("__a")
    fits = lambda want, have: F.forall(F.zip_with(want, have, lambda w, h: (w == 0) | (w == h)), lambda x: x)
    hit = spread.join(F.broadcast(rules), [site, "anchor", "path_tags"])
    at_row = lambda c: F.get(c, F.col("skip_at") - 1)
    inside = (F.col("skip_at") == 0) | ((at_row(F.col("rel_idx")) > F.col("skip_first"))
                                      & (at_row(F.col("rel_end")) > F.col("skip_last")))
    return hit.filter(fits(F.col("path_idx"), F.col("rel_idx")) & fits(F.col("path_end"), F.col("rel_end")) & inside
                      ).withColumn("row", F.slice("rel_idx", F.lit(1), F.col("depth")))


def node_value(mode: Column) -> Column:
    """Text a rule asks for: own text, whole text, or a named attribute (``@name``)."""
    attr = F.try_element_at("attrs", F.substr(mode, F.lit(2)))
    return F.when(mode == "own", F.col("text")).when(mode.startswith("@"), attr).otherwise(F.col("content"))


def page_fields(matched: DataFrame, key: Sequence[str], fields: Sequence[str], text: Column,
                priority: str = "priority") -> DataFrame:
    """One row per key: per field the first non-empty text by rule priority, then page order."""
    value = F.nullif(text, F.lit(""))
    order = F.struct(priority, "node_id")
    return matched.withColumn("__v", value).filter(F.col("__v").isNotNull()).groupBy(*key).agg(
        *[F.min_by(F.when(F.col("field") == f, F.col("__v")), F.when(F.col("field") == f, order)).alias(f)
          for f in fields])


def matched_nodes(pages: DataFrame, rules: Sequence[dict], html: str = "html", carry: Sequence[str] = ("page_id",),
                  site: str | None = None) -> DataFrame:
    """Parse the pages once and keep the nodes the rules name, with their value.

    ``site`` is a constant for pages of one site; otherwise the pages carry a ``site`` column.
    """
    carry = list(carry) if site else [*carry, "site"]
    paths: dict[str, set[str]] = {}
    whole = set()
    for r in rule_rows(rules):
        paths.setdefault(r["anchor"], set()).add("/".join(r["path_tags"]))
        if r["mode"] == "content" and r["path_tags"]:
            whole.add(r["path_tags"][-1])
    # A rule may end on an id itself, whatever the tag: then every kept element gets its text.
    if any(r["mode"] == "content" and not r["path"] for r in rules):
        whole = None
    nodes = html_nodes(pages, html, carry, None, whole, paths)
    if site:
        nodes = nodes.withColumn("site", F.lit(site))
    return match_rules(nodes, rule_frame(pages.sparkSession, rules)).withColumn("value", strip(node_value(F.col("mode"))))


def links(nodes: DataFrame, key: Sequence[str], base: str = "") -> DataFrame:
    """Anchors with their target, base prefixed, in page order."""
    return nodes.filter((F.col("tag") == "a") & F.col("attrs")["href"].isNotNull()).select(
        *key, "node_id", F.concat(F.lit(base), F.col("attrs")["href"]).alias("href"), "text")
