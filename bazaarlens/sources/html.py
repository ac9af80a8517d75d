"""A2: HTML to a flat outline, the only step that runs Python workers.

An outline is linear in the page: every piece of text is stored once, and a node is an
interval over those pieces and over its descendants, so all later work (selectors, node
text, page text) is array expressions on the JVM side. Next to it stands an inverted index: for
each tag, class name and attribute name of the page the nodes that have it, in document order.
"""
from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterable, Iterator, Sequence
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, types as T

# send this module's code along with the job: executors need not have the package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# what is never NULL says so: its NULLs are then not asked for, value by value, when rows are made of the columns
NODE = T.StructType([
    T.StructField("idx", T.IntegerType(), False),      # position in document order
    T.StructField("last", T.IntegerType(), False),     # idx of the last descendant, own idx if none
    T.StructField("parent", T.IntegerType(), False),   # -1 at the top
    T.StructField("tag", T.StringType(), False),
    T.StructField("cls", T.StringType(), False),       # class names, one space apart
    T.StructField("attrs", T.MapType(T.StringType(), T.StringType(), False), False),
    T.StructField("s0", T.IntegerType(), False),       # text pieces [s0, s1) lie inside the node
    T.StructField("s1", T.IntegerType(), False),
    T.StructField("raw", T.StringType()),              # script/style source, NULL elsewhere
])
_POSTINGS = T.MapType(T.StringType(), T.ArrayType(T.IntegerType(), False), False)
OUTLINE = [
    T.StructField("nodes", T.ArrayType(NODE, False), False),
    T.StructField("strings", T.ArrayType(T.StringType(), False), False),
    T.StructField("string_nodes", T.ArrayType(T.IntegerType(), False), False),  # the node holding each piece
    T.StructField("parse_error", T.StringType()),                 # why a page could not be read; its outline is empty
    T.StructField("tag_index", _POSTINGS, False),
    T.StructField("class_index", _POSTINGS, False),
    T.StructField("attr_index", _POSTINGS, False),
]
_COLUMNS = tuple(f.name for f in OUTLINE)
_FIELDS = tuple(NODE.fieldNames())

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset(("script", "style", "template"))
_INLINE = frozenset("a abbr b big cite code em font i kbd mark q s samp small span strike strong sub sup tt u var".split())
_CLOSES_P = frozenset(
    "address article aside blockquote center dd details dir div dl dt fieldset figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr li main menu nav ol p pre section table tbody td tfoot th thead tr ul".split())
# a start tag ends an open sibling of these kinds, up to the enclosing holder
_SIBLINGS = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}
# an output batch ends at either bound, so large pages do not add up in a worker
_ROWS_PER_BATCH = 256
_CHARS_PER_BATCH = 8_000_000


# what a tag's source may be for `_tag` to read it; whatever else is left to the library
_WS = r"[ \t\n\r\f]"
_ATTR = rf"""[a-zA-Z_:][-a-zA-Z0-9_:.]*(?:="[^"]*"|='[^']*')?"""
_START = re.compile(rf"([a-zA-Z][a-zA-Z0-9]*)((?:{_WS}+{_ATTR})*){_WS}*(/?)")
_NAMED = re.compile(rf"""{_WS}([a-zA-Z_:][-a-zA-Z0-9_:.]*)(?:="([^"]*)"|='([^']*)')?""")
_END = re.compile(rf"/([a-zA-Z][a-zA-Z0-9]*){_WS}*")
_CDATA = frozenset(HTMLParser.CDATA_CONTENT_ELEMENTS)
_UNSURE = frozenset("iframe listing noembed noframes noscript plaintext textarea title xmp".split())  # not read alike by every version of the library
_TAGS_KEPT = 20_000
_LONGEST_KEPT = 200
_NODES_KEPT = 50_000  # of the shapes that a task keeps


def _unescaped(text: str) -> str:
    """Text with its entities read; that there is only ``&amp;`` is the usual case, and many of them are quick then."""
    n = text.count("&")
    if not n:
        return text
    return text.replace("&amp;", "&") if n == text.count("&amp;") else unescape(text)


class _Tag:
    """A start tag, read once for all pages that repeat it."""

    __slots__ = ("tag", "cls", "names", "attrs", "siblings", "closes_p", "void", "block", "raw", "closed", "shape", "values")

    def __init__(self, tag: str, attrs: list[tuple[str, str | None]], closed: bool = False) -> None:
        self.tag, self.attrs = tag, {}
        for key, value in attrs:
            self.attrs.setdefault(key, value or "")
        names = self.attrs.get("class", "").split()
        self.cls, self.names = " ".join(names), tuple(dict.fromkeys(names))
        self.siblings, self.closes_p = _SIBLINGS.get(tag), tag in _CLOSES_P
        self.void, self.block, self.raw = tag in _VOID, tag not in _INLINE, tag in _RAW
        self.closed = closed  # written as <tag/>: an end tag follows
        self.shape = "\n".join((tag, self.cls, "/" if closed else "", *self.attrs))  # all but the values of attributes
        self.values = tuple(self.attrs.values())


class _End(str):
    """The name of an end tag, from its source."""

    values = ()

    def __new__(cls, name: str, source: str = ""):
        self = super().__new__(cls, name)
        self.shape = source.lower()
        return self


class _Break:
    """A comment or declaration: text does not go on over it."""

    values, shape = (), "!"


_BREAK = _Break()
_Event = str | _Tag | _End | _Break
_KEPT: dict[str, _Event | None] = {}


def _tag(source: str) -> _Event | None:
    """What stands between < and > as an event; None where reading it needs the library."""
    if source in _KEPT:
        return _KEPT[source]
    event: _Event | None = None
    if start := _START.fullmatch(source):
        tag, attrs, closed = start[1].lower(), start[2], start[3] != ""
        if not (closed and tag in _CDATA):
            event = _Tag(tag, [(name.lower(), _unescaped(a or b)) for name, a, b in _NAMED.findall(attrs)], closed)
    elif end := _END.fullmatch(source):
        event = _End(end[1].lower(), source)
    elif source[:8].lower() == "!doctype" or (source[:3] == "!--" and source[3:].endswith("--")):
        event = _BREAK
    if len(source) <= _LONGEST_KEPT:
        if len(_KEPT) >= _TAGS_KEPT:
            _KEPT.clear()
        _KEPT[source] = event
    return event


def _plain_events(html: str) -> list[_Event] | None:
    """Texts and tags of a page whose every < begins a tag, comment or doctype of the usual form; None for other pages."""
    text, *parts = html.split("<")
    events: list[_Event] = [_unescaped(text)] if text else []
    kept, at, last = _KEPT, 0, len(parts)
    while at < last:
        source, closing, text = parts[at].partition(">")
        event = kept.get(source)
        if event is None:
            event = _tag(source)
        if event is None or not closing:
            return None
        at += 1
        events.append(event)
        if type(event) is _Tag:
            if event.tag in _CDATA:  # as it stands, up to the end tag
                name, body = event.tag, [text]
                while at < last and not parts[at][:len(name) + 2].lower() == f"/{name}>":
                    if parts[at].startswith("!--") or parts[at][:1] == "/" and parts[at][1:].lstrip()[:len(name)].lower() == name:
                        return None
                    body.append(parts[at])
                    at += 1
                if at == last:
                    return None
                text = "<".join(body)
                if text:
                    events.append(text)
                continue
            if event.tag in _UNSURE and not (at < last and not event.closed and parts[at][:len(event.tag) + 2].lower() == f"/{event.tag}>"):
                return None
        if text:
            events.append(_unescaped(text))
    return events


class _Events(HTMLParser):
    """Texts and tags of any page, by the library."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.events: list[_Event] = []

    def handle_starttag(self, tag, attrs):
        self.events.append(_Tag(tag, attrs))

    def handle_endtag(self, tag):
        self.events.append(_End(tag))

    def handle_comment(self, data):
        self.events.append(_BREAK)

    handle_decl = handle_pi = unknown_decl = handle_comment

    def handle_data(self, data):
        self.events.append(data)


def _events(html: str) -> tuple[list[_Event], str | None]:
    """Texts and tags of a page, and what made it unreadable, if anything did."""
    events = _plain_events(html)
    if events is not None:
        return events, None
    parser = _Events()
    try:
        parser.feed(html)
        parser.close()
    except (AssertionError, ValueError) as problem:  # markup that the tokenizer refuses
        return [], f"{type(problem).__name__}: {problem}"
    return parser.events, None


class _Outline:
    """Outlines of consecutive pages, column by column. Open elements of a page are also kept by tag name, so no end
    tag searches the whole stack."""

    def __init__(self) -> None:
        self.counts: list[int] = []
        self.last: list[int] = []
        self.parent: list[int] = []
        self.tags: list[_Tag] = []
        self.s0: list[int] = []
        self.s1: list[int] = []
        self.raw: list[str | None] = []
        self.string_counts: list[int] = []
        self.strings: list[str] = []
        self.holders: list[int] = []
        self.errors: list[str | None] = []

    def add(self, html: str) -> None:
        self.add_events(*_events(html))

    def add_events(self, events: list[_Event], error: str | None = None) -> None:
        self.errors.append(error)
        first, first_string = len(self.tags), len(self.strings)
        tags, parents, strings, holders, last, s1, raw = self.tags, self.parent, self.strings, self.holders, self.last, self.s1, self.raw
        opened: list[int] = []              # idx of the open elements
        depths: dict[str, list[int]] = {}   # of the open elements of each tag
        blocks: list[int] = []              # depths of the open elements that are not inline
        parts: list[str] = []               # of the text piece that may go on

        def close_down_to(depth: int) -> None:
            at, piece = len(tags) - first - 1, len(strings) - first_string
            for idx in opened[depth:]:
                node = tags[first + idx]
                last[first + idx], s1[first + idx] = at, piece
                depths[node.tag].pop()
                if node.block:
                    blocks.pop()
            del opened[depth:]

        def nearest(names: tuple[str, ...]) -> int:
            depth = -1
            for name in names:
                found = depths.get(name)
                if found and found[-1] > depth:
                    depth = found[-1]
            return depth

        def end_text() -> None:
            if len(parts) > 1:
                strings[-1] = "".join(parts)
            parts.clear()

        def end(name: str) -> None:
            if found := depths.get(name):
                close_down_to(found[-1])

        for event in events:
            kind = type(event)
            if kind is str:
                holder = opened[-1] if opened else -1
                if holder >= 0 and tags[first + holder].raw:
                    raw[first + holder] = (raw[first + holder] or "") + event
                else:
                    if not parts:
                        strings.append(event)
                        holders.append(holder)
                    parts.append(event)
                continue
            if parts:
                end_text()
            if kind is _End:
                end(event)
            elif kind is _Tag:
                if event.siblings:  # a start tag may end open elements
                    ended, around = event.siblings
                    depth = nearest(ended)
                    if depth >= 0 and depth > nearest(around):
                        close_down_to(depth)
                if event.closes_p and blocks and tags[first + opened[blocks[-1]]].tag == "p":
                    close_down_to(blocks[-1])
                idx, at = len(tags) - first, len(strings) - first_string
                parents.append(opened[-1] if opened else -1)
                tags.append(event)
                last.append(idx)
                self.s0.append(at)
                s1.append(at)
                raw.append(None)
                if not event.void:
                    depth = len(opened)
                    depths.setdefault(event.tag, []).append(depth)
                    if event.block:
                        blocks.append(depth)
                    opened.append(idx)
                if event.closed:
                    end(event.tag)
        end_text()
        close_down_to(0)
        self.counts.append(len(tags) - first)
        self.string_counts.append(len(strings) - first_string)

    def outline(self, html: str) -> tuple[list[list], list[str], list[int], str | None]:
        """One page: its nodes, text pieces, their holders, and what made it unreadable, if anything did."""
        at, piece = len(self.tags), len(self.strings)
        self.add(html)
        columns = zip(self.last[at:], self.parent[at:], self.tags[at:], self.s0[at:], self.s1[at:], self.raw[at:])
        nodes = [[idx, last, parent, node.tag, node.cls, node.attrs, s0, s1, raw] for idx, (last, parent, node, s0, s1, raw) in enumerate(columns)]
        return nodes, self.strings[piece:], self.holders[piece:], self.errors[-1]

    def _postings(self, names: Callable[[_Tag], Iterable[str]]) -> pa.Array:
        """One map a page: a name, and the nodes that have it."""
        sizes, keys, lengths, places, first = [], [], [], [], 0
        for count in self.counts:
            index: dict[str, list[int]] = {}
            for idx, node in enumerate(self.tags[first:first + count]):
                for name in names(node):
                    if name in index:
                        index[name].append(idx)
                    else:
                        index[name] = [idx]
            first += count
            sizes.append(len(index))
            keys += index
            for found in index.values():
                lengths.append(len(found))
                places += found
        return _maps(_offsets(sizes), pa.array(keys, pa.string()), _lists(lengths, pa.array(places, pa.int32())))

    def arrays(self, columns: Sequence[str], fields: Sequence[str]) -> dict[str, pa.Array]:
        """The wanted columns of the outline that do not depend on texts and values of attributes: those of the nodes, the holders and the index."""
        i32, text, tags = pa.int32(), pa.string(), self.tags
        shaped = {"idx": pa.array([idx for n in self.counts for idx in range(n)], i32)}
        for name, values in (("last", self.last), ("parent", self.parent), ("s0", self.s0), ("s1", self.s1)):
            if name in fields:
                shaped[name] = pa.array(values, i32)
        for name in ("tag", "cls"):
            if name in fields:
                shaped[name] = pa.array([getattr(node, name) for node in tags], text)
        if "attrs" in fields:
            shaped["attrs"] = _lists([len(node.attrs) for node in tags], pa.array([k for node in tags for k in node.attrs], text))
        out = {"nodes": _lists(self.counts, _structs(shaped))}
        if "string_nodes" in columns:
            out["string_nodes"] = _lists(self.string_counts, pa.array(self.holders, i32))
        for name, names in _NAMES.items():
            if name in columns:
                out[name] = self._postings(names)
        return out


_NAMES: dict[str, Callable[[_Tag], Iterable[str]]] = {
    "tag_index": lambda node: (node.tag,), "class_index": lambda node: node.names, "attr_index": lambda node: node.attrs}


class _Slots:
    """Where the texts of a page of a shape go: a page's texts are numbered, 0 being that before its first tag."""

    __slots__ = ("row", "n_nodes", "pieces", "raw", "as_it_stands")

    def __init__(self, row: int, outline: _Outline, as_it_stands: frozenset[int]) -> None:
        """Of the last page of an outline that was made from the numbers of the texts in their place."""
        n, k = outline.counts[-1], outline.string_counts[-1]
        self.row, self.n_nodes = row, n
        self.pieces = [int(number) for number in outline.strings[len(outline.strings) - k:]]
        self.raw = [(at, [int(number) for number in found.split()]) for at, found in enumerate(outline.raw[len(outline.raw) - n:]) if found]
        self.as_it_stands = as_it_stands


class _Shapes:
    """Pages to outlines. Sites fill templates, so the tags of a page, but for their attributes' values, are often those of an earlier page: its
    nodes and index are worked out once for such a shape, and only texts and values are read from every page. A page that is not of the
    usual form counts as a shape of its own."""

    def __init__(self, columns: Sequence[str] = _COLUMNS, fields: Sequence[str] = _FIELDS) -> None:
        self.columns, self.fields = columns, fields
        self.slots: dict[tuple[str, bytes], _Slots] = {}
        self.kept: dict[str, pa.Array] | None = None

    def arrays(self, pages: list[str]) -> list[pa.Array]:
        """The outlines of some pages, column by column."""
        known = 0 if self.kept is None else len(self.kept["nodes"])
        fresh, with_values, with_raw = _Outline(), "attrs" in self.fields, "raw" in self.fields
        rows, strings, counts, raw, values, errors = [], [], [], [], [], []
        for html in pages:
            read = _tags_and_texts(html)
            slots = read and self._slots(html, *read, known, fresh)
            if not slots:
                at, piece = len(fresh.tags), len(fresh.strings)
                fresh.add(html)
                rows.append(known + len(fresh.counts) - 1)
                strings += fresh.strings[piece:]
                counts.append(len(fresh.strings) - piece)
                if with_raw:
                    raw += fresh.raw[at:]
                if with_values:
                    for node in fresh.tags[at:]:
                        values += node.values
                errors.append(fresh.errors[-1])
                continue
            tags, texts = read
            rows.append(slots.row)
            strings += [_unescaped(text) if "&" in text else text for text in [texts[k] for k in slots.pieces]]
            counts.append(len(slots.pieces))
            if with_raw:
                nodes_raw = [None] * slots.n_nodes
                for at, numbers in slots.raw:
                    nodes_raw[at] = "".join([texts[k] if k in slots.as_it_stands else _unescaped(texts[k]) for k in numbers])
                raw += nodes_raw
            if with_values:
                for event in tags:
                    values += event.values
            errors.append(None)
        table = fresh.arrays(self.columns, self.fields) if self.kept is None or fresh.counts else self.kept
        if self.kept and table is not self.kept:
            table = {name: pa.concat_arrays([column, table[name]]) for name, column in self.kept.items()}
        self.kept = table
        if len(table["nodes"].values) > _NODES_KEPT:
            self.kept, self.slots = None, {}
        at = pa.array(rows, pa.int32())
        out = {name: column.take(at) for name, column in table.items()}
        text, nodes = pa.string(), out["nodes"]
        fields = {name: nodes.values.field(name) for name in nodes.type.value_type.names}
        if with_values:
            fields["attrs"] = _maps(fields["attrs"].offsets, fields["attrs"].values, pa.array(values, text))
        if with_raw:
            fields["raw"] = pa.array(raw, text)
        out["nodes"] = _lists(nodes.offsets, _structs({name: fields[name] for name in _FIELDS if name in self.fields}))
        out |= {"strings": _lists(counts, pa.array(strings, text)), "parse_error": pa.array(errors, text)}
        return [out[name] for name in _COLUMNS if name in self.columns]

    def _slots(self, html: str, tags: list[_Event], texts: list[str], known: int, fresh: _Outline) -> _Slots | None:
        key = ("\0".join([event.shape for event in tags]), bytes(map(bool, texts)))
        slots = self.slots.get(key)
        if slots is None and (events := _plain_events(html)) is not None:
            if [event for event in events if type(event) is not str] != tags:  # a script with a < of its own
                return None
            numbers: list[_Event] = []
            for k, text in enumerate(texts):
                if k:
                    numbers.append(tags[k - 1])
                if text:
                    numbers.append(f"{k} ")
            fresh.add_events(numbers)
            as_they_stand = frozenset(k for k, event in enumerate(tags, 1) if type(event) is _Tag and event.tag in _CDATA)
            slots = self.slots[key] = _Slots(known + len(fresh.counts) - 1, fresh, as_they_stand)
        return slots


def _tags_and_texts(html: str) -> tuple[list[_Event], list[str]] | None:
    """What stands between < and >, as events, and the texts before, between and after; None where a tag is not of the usual form."""
    pieces = html.replace("<", ">").split(">")  # texts and tags in turn, unless a < or > stands alone
    turns = [""] * (2 * len(pieces) - 1)
    turns[::2] = pieces
    turns[1::4], turns[3::4] = ["<"] * (len(pieces) // 2), [">"] * ((len(pieces) - 1) // 2)
    if len(pieces) % 2 and "".join(turns) == html:
        sources, texts = pieces[1::2], pieces[::2]
    else:
        text, *parts = html.split("<")
        if not parts:
            return [], [text]
        sources, closings, after = zip(*[part.partition(">") for part in parts])
        if "" in closings:
            return None
        texts = [text, *after]
    tags = list(map(_KEPT.get, sources))
    if None in tags:
        tags = [_tag(source) if tag is None else tag for tag, source in zip(tags, sources)]
        if None in tags:
            return None
    return tags, texts


def _offsets(sizes: list[int]) -> pa.Array:
    out, at = [0], 0
    for n in sizes:
        at += n
        out.append(at)
    return pa.array(out, pa.int32())


def _lists(sizes: list[int] | pa.Array, values: pa.Array) -> pa.Array:
    """Lists, by their sizes or offsets, without a NULL."""
    offsets = _offsets(sizes) if isinstance(sizes, list) else sizes
    return pa.ListArray.from_arrays(offsets, values, type=pa.list_(pa.field("element", values.type, nullable=False)))


def _maps(offsets: pa.Array, keys: pa.Array, values: pa.Array) -> pa.Array:
    """Maps without a NULL."""
    return pa.MapArray.from_arrays(offsets, keys, values, type=pa.map_(keys.type, pa.field("value", values.type, nullable=False)))


def _structs(fields: dict[str, pa.Array]) -> pa.Array:
    """Nodes; only their source may be NULL."""
    return pa.StructArray.from_arrays(list(fields.values()), fields=[pa.field(n, a.type, nullable=n == "raw") for n, a in fields.items()])


def _bounded(pages: list[str]) -> Iterator[tuple[int, int]]:
    """Start and end of consecutive runs of pages within the bounds; a larger page stands alone."""
    start, chars = 0, 0
    for at, html in enumerate(pages):
        if at > start and (at - start == _ROWS_PER_BATCH or chars + len(html) > _CHARS_PER_BATCH):
            yield start, at
            start, chars = at, 0
        chars += len(html)
    if pages:
        yield start, len(pages)


def _flatten_batches(batches: Iterator[pa.RecordBatch], columns: Sequence[str] = _COLUMNS, fields: Sequence[str] = _FIELDS) -> Iterator[pa.RecordBatch]:
    shapes = _Shapes(columns, fields)
    for batch in batches:
        html_at = batch.schema.names.index("html")
        keep = [i for i in range(batch.num_columns) if i != html_at]
        names = [batch.schema.names[i] for i in keep] + [name for name in _COLUMNS if name in columns]
        for at in range(0, batch.num_rows, _ROWS_PER_BATCH):  # only so many pages are Python texts at a time
            some = batch.slice(at, _ROWS_PER_BATCH)
            some = some.filter(some.column(html_at).is_valid())
            pages = some.column(html_at).to_pylist()
            for start, end in _bounded(pages):
                part = some.slice(start, end - start)
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in keep] + shapes.arrays(pages[start:end]), names=names)
        batch = some = part = pages = None  # or there would be two of them when the next one is read


def flatten_pages(pages: DataFrame, columns: Sequence[str] = _COLUMNS, fields: Sequence[str] = _FIELDS) -> DataFrame:
    """Replace ``html`` by the outline columns. Pages without HTML drop out (in the worker: a
    filter here would be copied, with whatever computes the HTML, down to the scan).

    Select only the columns you need first: whatever else is on the row travels through
    the Python worker as well. Likewise ``columns`` and ``fields`` name what is wanted of the outline and of its nodes:
    Spark copies all that a worker returns, read or not.
    """
    nodes = T.StructField("nodes", T.ArrayType(T.StructType([f for f in NODE if f.name in fields]), False), False)
    outline = [nodes if f.name == "nodes" else f for f in OUTLINE if f.name in columns]
    schema = T.StructType([f for f in pages.schema.fields if f.name != "html"] + outline)
    return pages.mapInArrow(lambda batches: _flatten_batches(batches, columns, fields), schema)
