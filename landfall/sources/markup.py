"""Row elements of XML files by the state of their markup, in files that many tasks read.

Files are scanned with the beginning of the closing row tag as separator. Whether a chunk lies in
a comment, a CDATA section or a processing instruction, and how deep row elements are nested there,
depends on all text before it. A first pass works out, for each file split, what it does to each state it
could begin with; a fold over these few rows gives the state it does begin with, and a second pass emits the
elements. A file whose row tags do not pair up is read flat: an element ends where the next one opens.
A comment (or the like) that is never closed is text.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from landfall.sources.edges import BEHIND, FULL, HEAD, SOUND, TAIL, TORN, WHOLE, Split, folded_by_file, place_of, records, scan_splits, stretches

#: Lexer states. In PLAIN nothing but row tags is markup.
TEXT, COMMENT, CDATA, INSTRUCTION, PLAIN = range(5)
_OPENS = {"<!-": COMMENT, "<![": CDATA, "<?": INSTRUCTION}
_ENDS = {COMMENT: "-->", CDATA: "]]>", INSTRUCTION: "?>"}
_SIGNS = ("<!--", "-->", "<![CDATA[", "]]>", "<?", "?>")
#: What a row tag does.
OPEN, CLOSE, EMPTY = "open", "close", "empty"


def separator(row_tag: str) -> str:
    return f"</{row_tag}"


class Lexer:
    """Row tags of a text; with ``loose``, only tags written without blanks or attributes, wherever they stand."""

    def __init__(self, row_tag: str, loose: bool = False) -> None:
        tag = re.escape(row_tag)
        if loose:
            tags = f"<{tag}>|</{tag}>"
        else:
            tags = f"</{tag}\\s*+>|<{tag}(?=[\\s/>])(?:[^>\"']|\"[^\"<]*\"|'[^'<]*'|[\"'])*+(?:>|\\Z)"
        self.plain = re.compile(tags, re.S)
        self.marked = self.plain if loose else re.compile(f"<!--|<!\\[CDATA\\[|<\\?|{tags}", re.S)
        self.loose = loose

    def has_signs(self, text: str) -> bool:
        return not self.loose and any(s in text for s in _SIGNS)

    def tags(self, text: str, state: int) -> tuple[list[tuple[str, int, int]], int, int]:
        """The row tags met from ``state``, the state after the text, and where what is still open began (-1: before the text)."""
        found, pos, since = [], 0, -1
        token = self.plain if state == PLAIN else self.marked
        while True:
            if state in _ENDS:
                end = text.find(_ENDS[state], pos)
                if end < 0:
                    return found, state, since
                pos, state = end + len(_ENDS[state]), TEXT
            m = token.search(text, pos)
            if m is None:
                return found, state, since
            tag, pos = m.group(), m.end()
            sign = _OPENS.get(tag[:2]) or _OPENS.get(tag[:3])
            if sign and tag in ("<!--", "<![CDATA[", "<?"):
                state, since = sign, m.start()
            else:
                found.append((CLOSE if tag[1] == "/" else EMPTY if tag.endswith("/>") else OPEN, m.start(), pos))


class _Lane:
    """What a stretch of text does to one state it could begin with. last: whether its last row tag opened, -1 if it has none."""

    def __init__(self, state: int) -> None:
        self.begin = self.state = state
        self.change, self.low, self.last, self.stays = 0, 0, -1, True

    def go(self, tags: list[tuple[str, int, int]], state: int, left: bool) -> None:
        self.state, self.stays = state, self.stays and not left
        for kind, _, _ in tags:
            if kind != EMPTY:
                self.change += 1 if kind == OPEN else -1
                self.low = min(self.low, self.change)
            self.last = int(kind == OPEN)

    def follow(self, other: _Lane) -> None:
        """What ``other`` has met comes next, and changes no state."""
        self.low, self.change = min(self.low, self.change + other.low), self.change + other.change
        self.last = self.last if other.last < 0 else other.last

    def row(self) -> tuple[int, ...]:
        return self.begin, self.state, self.change, self.low, self.last, int(self.stays)


_SUMS = ["file", "block", "id", "begin", "state", "change", "low", "last", "stays"]


def _summed(row_tag: str, loose: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A row for each stretch of a split and state it could begin with."""
    sep = separator(row_tag)

    def settle(lanes: list[_Lane], plain: _Lane) -> None:
        """Tags of text without any other markup count in every state that they are read in."""
        for lane in lanes:
            if lane.state not in _ENDS:
                lane.follow(plain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexer, before = Lexer(row_tag, loose), None
        for batch in batches:
            rows = []
            for part in stretches(batch):
                first = place_of(part)[1] == 0 and place_of(part) != before
                before = place_of(part)
                lanes, plain = [_Lane(s) for s in range(5)], _Lane(PLAIN)
                values = part.column("value").to_pylist()
                signs = lexer.has_signs("\n".join(values))
                for k, value in enumerate(values):
                    text = value if first and k == 0 else sep + value
                    if not (signs and lexer.has_signs(text)):
                        plain.go(lexer.tags(text, PLAIN)[0], PLAIN, False)
                        continue
                    settle(lanes, plain)
                    plain = _Lane(PLAIN)
                    seen = {state: lexer.tags(text, state) for state in {lane.state for lane in lanes}}
                    for lane in lanes:
                        tags, after, since = seen[lane.state]
                        lane.go(tags, after, after != lane.state or since >= 0)
                settle(lanes, plain)
                rows += [(*before, part.column("id")[0].as_py(), *lane.row()) for lane in lanes]
            columns = zip(*rows, strict=True) if rows else [()] * len(_SUMS)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=_SUMS)

    return run


def _walk(steps: list[list], torn: int | None) -> tuple[list[tuple], int, int, int, int]:
    """(block, state, depth, open) at the start of each split; then the state, the depth and the least depth at the end, and where what is open began."""
    state, depth, low, is_open, begun, starts = TEXT, 0, 0, 0, 0, {}
    for lanes in steps:
        block = lanes[0].block
        if torn is not None and block > torn and state != PLAIN:
            state, is_open = PLAIN, 0
        starts.setdefault(block, (block, state, depth, is_open))
        lane = lanes[state]
        low, depth = min(low, depth + lane.low), depth + lane.change
        is_open = is_open if lane.last < 0 else lane.last
        if lane.state in _ENDS and not (state in _ENDS and lane.stays):
            begun = block
        state = lane.state
    return list(starts.values()), state, depth, low, begun


_STARTS = pa.schema([
    ("_file", pa.int64()), ("_block", pa.int64()), ("state", pa.int32()), ("depth", pa.int64()), ("flat", pa.bool_()), ("fate", pa.int32()),
    ("alone", pa.bool_()),
])


def _folded(ordered: list) -> list[tuple]:
    """How each split of one file begins, and whether the file has no edges; a row or few for each split and state, in order."""
    steps = [ordered[i : i + 5] for i in range(0, len(ordered), 5)]
    starts, state, depth, low, begun = _walk(steps, None)
    torn = begun if state in _ENDS else None
    if torn is not None:
        starts, *_ = _walk(steps, torn)
    flat = torn is not None or depth != 0 or low < 0
    alone = len(starts) == 1 and not flat
    return [
        (ordered[0].file, b, s, o if flat else d, flat, SOUND if torn is None or b < torn else TORN if b == torn else BEHIND, alone)
        for b, s, d, o in starts
    ]


class _Elements(Split):
    """Puts the row elements of one file split together."""

    def __init__(self, part: pa.RecordBatch, lexer: Lexer, sep: str) -> None:
        super().__init__(part)
        self.lexer, self.sep, self.first = lexer, sep, self.place[1] == 0
        self.state, self.depth, self.fate = (part.column(n)[0].as_py() for n in ("state", "depth", "fate"))
        self.flat = part.column("flat")[0].as_py() or lexer.loose
        self.depth = min(self.depth, 1) if self.flat else self.depth
        self.began_inside = self.depth > 0
        self.text: list[str] = []  # of the element that is open
        self.doubt: list[str] = []  # since something opened that may never close

    def _emit(self, text: str) -> tuple:
        self.text.append(text)
        made = self.piece(HEAD if self.began_inside and not self.ended else FULL, "".join(self.text))
        self.text, self.ended = [], True
        return made

    def _rows(self, text: str, tags: list[tuple[str, int, int]]) -> Iterator[tuple]:
        begin = 0  # of the open element, in this text
        for kind, a, z in tags:
            if kind == CLOSE:
                if self.depth == 1:
                    yield self._emit(text[begin:z])
                self.depth = max(0, self.depth - 1)
            elif self.depth and not self.flat:
                self.depth += kind == OPEN
            elif self.depth and self.lexer.loose:
                continue
            else:
                if self.depth:  # not closed
                    yield self._emit(text[begin:a])
                self.depth, begin = int(kind == OPEN), a
                if kind == EMPTY:
                    yield self._emit(text[a:z])
        if self.depth:
            self.text.append(text[begin:])

    def add(self, part: pa.RecordBatch) -> Iterator[tuple]:
        values = part.column("value").to_pylist()
        signs = self.lexer.has_signs("\n".join(values))
        for value in values:
            text = value if self.first else self.sep + value
            self.first = False
            if not (signs and self.lexer.has_signs(text)):
                if self.doubt:
                    self.doubt.append(text)
                else:
                    yield from self._rows(text, [] if self.state in _ENDS else self.lexer.tags(text, PLAIN)[0])
                continue
            if self.doubt:
                text, self.doubt, self.state = "".join([*self.doubt, text]), [], TEXT
            tags, self.state, since = self.lexer.tags(text, self.state)
            if self.fate == TORN and self.state in _ENDS and since >= 0:
                text, self.doubt = text[:since], [text[since:]]
            yield from self._rows(text, tags)

    def close(self) -> Iterator[tuple]:
        torn = self.fate == TORN
        if self.doubt:
            text = "".join(self.doubt)
            yield from self._rows(text, self.lexer.tags(text, PLAIN)[0])
        begun_here = self.ended or not self.began_inside
        if self.text and torn and begun_here:
            yield self._emit("")
        elif self.text:
            yield self.piece(TAIL if begun_here else WHOLE, "".join(self.text))


def xml_elements(spark: SparkSession, paths: str | Sequence[str], row_tag: str, loose: bool = False) -> DataFrame:
    """``value`` elements with their origin, and whether they are ``closed``.

    Row tags may have attributes and blanks, elements of the same name may be nested in a row and belong
    to it, and an empty element is a row. What stands in comments is none. With ``loose``, rows are the text from
    an opening tag to the next closing one, both exactly as named, whatever is around them.
    """
    chunks = scan_splits(spark, paths, separator(row_tag))
    told = chunks.selectExpr("_file", "_block", "monotonically_increasing_id() AS id", "value")
    told = told.mapInArrow(_summed(row_tag, loose), ", ".join(f"{n} long" for n in _SUMS))
    ddl = "_file long, _block long, state int, depth long, flat boolean, fate int, alone boolean"
    starts = folded_by_file(told, ["block", "id", "begin"], _folded, _STARTS, ddl)
    # A few numbers for each file split, which the driver has planned one by one already.
    begun = chunks.join(F.broadcast(starts), ["_file", "_block"])
    columns = ["_file", "_block", "_source_file", "_source_ts", "value", "state", "depth", "flat", "fate"]
    # A file that is one split and closes all it opens has no edges.
    return records(begun.select(columns), begun.filter("NOT alone").select(columns), lambda part: _Elements(part, Lexer(row_tag, loose), separator(row_tag)), "")
