"""JSON arrays of any size, cut into their elements where they are read.

Files are scanned with '}' as the record separator. Whether a chunk lies in a string and
how deep it is nested depends on all text before it, so a first pass sums up each file
split for both cases, a small window turns these sums into the state each split begins
with, and a second pass emits every piece that ends at the array's own level. Only what
reaches over the edge of a split is shuffled. A file whose brackets or quotes do not pair up is cut by
another rule: element after element is decoded, and what is no JSON is an error up to the next place that
looks like the beginning of an element.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator, Sequence
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from landfall.functions.sql import lit, once
from landfall.functions.text import is_blank, strip_start
from landfall.sources.json_records import from_json
from landfall.sources.scan import scan_text

END = "}"
_STRING = r'"[^"]*(?:"|\z)'
#: Endings of files that are read unpacked, so that their size says nothing about their end.
_PACKED = r"(?i)\.(gz|bz2|deflate|zst|lz4|snappy)$"
#: The first name in the first element, by which an element's beginning is known again (short ones only).
_FIRST_KEY = r'^\s*\[?\s*\{\s*("(?:[^"\\]|\\.){0,200}")\s*:'
#: The root of a piece that is one element, of a file whose brackets do not pair up.
ELEMENT = 2
#: Characters that are decoded at first to find the end of an element, and those before the end of them that a cut may have changed.
_WINDOW, _MARGIN = 4096, 16
#: Pieces in a batch on their way out of a task.
_PIECES = 5000
_GAP = re.compile(r"[\s,]*")


def _removed(text: str, pattern: str) -> str:
    return f"regexp_replace({text}, {lit(pattern)}, '')"


def _depth(outside: str) -> str:
    return f"length(translate({outside}, ']}}', '')) - length(translate({outside}, '[{{', ''))"


def _scan(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Chunks with the parity of their quotes, and their change of depth if they begin outside or inside a string."""
    bare = _removed(f"concat(value, '{END}')", r"(?s)\\.")
    inside = _removed("_bare", r'^[^"]*(?:"|\z)')
    return scan_text(spark, paths, line_sep=END, extent=True).selectExpr("*", f"{bare} AS _bare").selectExpr(
        "_source_file", "_source_ts", "_size", "_block", "value",
        "(length(_bare) - length(replace(_bare, '\"', ''))) % 2 AS quotes",
        f"{_depth(_removed('_bare', _STRING))} AS out_depth",
        f"{_depth(_removed(inside, _STRING))} AS in_depth",
    )


def _runs(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Stretches of one file split; the first two columns are the file and the block."""
    files, blocks = batch.column(0).dictionary_encode().indices.to_numpy(), batch.column(1).to_numpy()
    change = np.flatnonzero((files[1:] != files[:-1]) | (blocks[1:] != blocks[:-1])) + 1
    edges = [0, *change.tolist(), batch.num_rows]
    return (batch.slice(a, b - a) for a, b in zip(edges, edges[1:]) if b > a)


def _ints(run: pa.RecordBatch, name: str) -> np.ndarray:
    return run.column(name).to_numpy(zero_copy_only=False).astype(np.int64)


_SUM = pa.schema([
    ("_source_file", pa.string()), ("_block", pa.int64()), ("_size", pa.int64()), ("id", pa.int64()), ("listed", pa.bool_()), ("key", pa.string()),
    ("quotes", pa.int64()), ("from_out", pa.int64()), ("from_in", pa.int64()), ("bytes", pa.int64()),
])


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each stretch of a split: its quotes, its change of depth from either start, its bytes."""
    for batch in batches:
        for at, run in enumerate(_runs(batch)):
            quotes = _ints(run, "quotes")
            odd = (np.cumsum(quotes) - quotes) % 2 == 1
            out, inside = _ints(run, "out_depth"), _ints(run, "in_depth")
            row = {
                "_source_file": run.column(0)[0].as_py(), "_block": run.column(1)[0].as_py(),
                "_size": run.column("_size")[0].as_py(), "id": run.column("id")[0].as_py(), "listed": run.column("listed")[0].as_py(),
                "key": run.column("key")[0].as_py(),
                "quotes": int(quotes.sum() % 2), "from_out": int(np.where(odd, inside, out).sum()),
                "from_in": int(np.where(odd, out, inside).sum()), "bytes": int(_ints(run, "bytes").sum()),
            }
            yield pa.RecordBatch.from_pylist([row], _SUM)


def _unpacked_sizes(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(file, unpacked): bytes of each packed file, less one if it does not end in a closing brace.

    A scan with another separator counts one byte too many unless the file ends in that one, as the scan of the
    chunks does for the brace. Both sums are equal where the file ends in neither; where it ends in a brace, this one is
    greater by one, and where it ends in a bracket, less by one.
    """
    packed = scan_text(spark, paths, line_sep="]").filter(F.col("_source_file").rlike(_PACKED))
    sums = packed.groupBy(F.col("_source_file").alias("file")).agg(F.sum(F.octet_length("value") + 1).alias("bytes"))
    return sums.select("file", (F.col("bytes") - 1).alias("unpacked"))


def _starts(chunks: DataFrame, ends: DataFrame) -> DataFrame:
    """A row for each file split with rows: the state it begins with and its place in the file."""
    listed = f"startswith({strip_start('value')}, '[')"
    summed = chunks.selectExpr(
        "_source_file", "_block", "_size", "monotonically_increasing_id() AS id", f"{listed} AS listed",
        f"CASE WHEN _block = 0 THEN regexp_extract(value, {lit(_FIRST_KEY)}, 1) END AS key",
        "quotes", "out_depth", "in_depth", f"octet_length(value) + {len(END)} AS bytes",
    ).mapInArrow(
        _sums,
        "_source_file string, _block long, _size long, id long, listed boolean, key string, quotes long, from_out long, from_in long, bytes long",
    )
    by_file = Window.partitionBy("_source_file").orderBy("_block", "id")  # a row for each batch of a split
    before, whole = by_file.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("_source_file")
    begun = summed.withColumn("quoted", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)
    change = F.when(F.col("quoted") == 0, F.col("from_out")).otherwise(F.col("from_in"))
    deep = begun.withColumn("change", change).select(
        "*",
        F.coalesce(F.sum("change").over(before), F.lit(0)).alias("depth"),
        F.first("listed").over(by_file).cast("long").alias("root"),
        (F.min("_block").over(whole) == F.col("_block")).alias("first"),
        (F.max("_block").over(whole) == F.col("_block")).alias("last"),
        F.sum("bytes").over(whole).alias("all_bytes"),
        (F.sum("quotes").over(whole) % 2).alias("ends_quoted"),
        F.sum("change").over(whole).alias("ends_deep"),
        F.first("key").over(by_file).alias("first_key"),
    )
    found = deep.join(ends, deep["_source_file"] == ends["file"], "left")
    found = found.withColumn("open", F.col("all_bytes") > F.coalesce("unpacked", "_size"))
    # The last chunk counted a closing brace that is not there if the file does not end in one.
    level = F.col("ends_deep") + F.col("open").cast("int")
    found = found.withColumn("damaged", (F.col("ends_quoted") != 0) | (level != 0))
    state = ("quoted", "depth", "root", "first", "last", "open", "damaged", "first_key")
    one = found.groupBy(deep["_source_file"], "_block").agg(F.min_by(F.struct(*state), "id").alias("s"))
    return one.select("_source_file", "_block", "s.*")


class _Split:
    """Puts the chunks of one file split together to pieces; the last chunk is held back, as the file may end in it."""

    def __init__(self, run: pa.RecordBatch) -> None:
        self.key = {n: run.column(n)[0].as_py() for n in ("_source_file", "_block", "_source_ts")}
        state = {n: run.column(n)[0].as_py() for n in ("quoted", "depth", "root", "first", "last", "open")}
        self.quoted, self.depth, self.root = state["quoted"], state["depth"], state["root"]
        self.first, self.last, self.open = state["first"], state["last"], state["open"]
        self.text: list[str] = []
        self.held: tuple[str, bool] | None = None
        self.ended = False

    @staticmethod
    def of(run: pa.RecordBatch) -> _Split:
        return _DamagedSplit(run) if run.column("damaged")[0].as_py() else _Split(run)

    def is_next(self, run: pa.RecordBatch) -> bool:
        return run.column(0)[0].as_py() == self.key["_source_file"] and run.column(1)[0].as_py() == self.key["_block"]

    def piece(self, kind: str, first: bool = False, last: bool = False) -> dict:
        made = self.key | {"root": self.root, "kind": kind, "first": first, "last": last, "value": "".join(self.text)}
        self.text = []
        return made

    def _settle(self) -> Iterator[dict]:
        value, ends = self.held
        self.text.append(value + END)
        if ends:
            yield self.piece("full" if self.ended or self.first else "head", first=self.first and not self.ended)
            self.ended = True

    def add(self, run: pa.RecordBatch) -> Iterator[dict]:
        quotes = _ints(run, "quotes")
        after = self.quoted + np.cumsum(quotes)
        depth = self.depth + np.cumsum(np.where((after - quotes) % 2 == 1, _ints(run, "in_depth"), _ints(run, "out_depth")))
        ends = (after % 2 == 0) & (depth == self.root)
        self.quoted, self.depth = int(after[-1] % 2), int(depth[-1])
        for value, end in zip(run.column("value").to_pylist(), ends.tolist(), strict=True):
            if self.held:
                yield from self._settle()
            self.held = value, end

    def close(self) -> Iterator[dict]:
        if self.last and self.open:
            self.text.append(self.held[0])
        else:
            yield from self._settle()
        if not self.ended and not (self.first and self.last):
            yield self.piece("whole", last=self.last)
        elif self.last:
            yield self.piece("full", first=not self.ended, last=True)
        else:
            yield self.piece("tail")


def _element_end(text: str, at: int) -> int | None:
    """Where the JSON value that begins at ``at`` ends; None if there is none.

    An error counts the lines of all text before it, so only a window of the text is decoded, and a wider one
    as long as the outcome could be that of the window's end.
    """
    width = _WINDOW
    while True:
        window, whole = text[at : at + width], at + width >= len(text)
        try:
            end = _DECODE(window)[1]
            if whole or window[0] in '{["' or end < width - _MARGIN:
                return at + end
        except json.JSONDecodeError as e:
            if whole or (e.pos < width - _MARGIN and not e.msg.startswith("Unterminated string")):
                return None
        except RecursionError:
            return None
        width *= 4


_DECODE = json.JSONDecoder().raw_decode


class _DamagedSplit(_Split):
    """Elements of one file split by themselves, whatever stood before it."""

    def __init__(self, run: pa.RecordBatch) -> None:
        super().__init__(run)
        key = run.column("first_key")[0].as_py()
        named = f"{re.escape(key)}\\s*:" if key else ""
        self.begins = re.compile(rf"(?:^|[\[,}}\s])\s*(\{{\s*{named})")
        self.listed, self.root = self.root == 1, ELEMENT
        self.chunks: list[str] = []

    def add(self, run: pa.RecordBatch) -> Iterator[dict]:
        self.chunks += run.column("value").to_pylist()
        return iter(())

    def _piece(self, kind: str, text: str) -> dict:
        self.text = [text]
        return self.piece(kind)

    def close(self) -> Iterator[dict]:
        text = END.join(self.chunks) + ("" if self.last and self.open else END)
        at, closed = 0, not self.last or not self.listed
        if self.first:
            at = re.match(r"\s*\[?" if self.listed else r"\s*", text).end()
        else:
            begin = self.begins.search(text)
            if begin is None and not self.last:
                yield self._piece("full", text)
                return
            at = begin.start(1) if begin else len(text)
            head = text[:at].rstrip()
            if begin is None and self.listed:
                closed = not head.endswith("}")  # closed, or torn within an element, which is an error by itself
                head = head.removesuffix("]")
            yield self._piece("head", head)
        size, filled = len(text), len(text.rstrip())
        while True:
            at = _GAP.match(text, at).end()
            if at == size:
                break
            if self.listed and text[at] == "]" and at + 1 >= filled:
                closed = True
                break
            end = _element_end(text, at)
            if end is None:
                begin = self.begins.search(text, at + 1)
                end = begin.start(1) if begin else size
                if begin is None and not self.last:
                    yield self._piece("tail", text[at:])
                    return
                closed = closed or begin is None  # torn: an error by itself
            yield self._piece("full", text[at:end])
            at = end
        if not closed:
            yield self._piece("full", "[")  # the bracket that nothing closes


_PIECE = pa.schema([
    ("_source_file", pa.string()), ("_block", pa.int64()), ("_source_ts", pa.timestamp("us", "UTC")), ("root", pa.int64()),
    ("kind", pa.string()), ("first", pa.bool_()), ("last", pa.bool_()), ("value", pa.string()),
])


def _pieces(wanted: Callable[[str], bool]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        split = None
        for batch in batches:
            for run in _runs(batch):
                if split is None or not split.is_next(run):
                    yield from split.close() if split else ()
                    split = _Split.of(run)
                yield from split.add(run)
        if split:
            yield from split.close()

    def run_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (p for p in pieces(batches) if wanted(p["kind"]))
        while few := list(islice(found, _PIECES)):
            yield pa.RecordBatch.from_pylist(few, _PIECE)

    return run_all


def _cut(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Pieces of the files: value, and whether it is the first or last one of a file; root is 1 in an array."""
    chunks = _scan(spark, paths)
    # One row for each file split, which the driver has planned one by one already.
    begun = chunks.join(F.broadcast(_starts(chunks, _unpacked_sizes(spark, paths))), ["_source_file", "_block"])
    begun = begun.select(
        "_source_file", "_block", "_source_ts", "value", "quotes", "out_depth", "in_depth",
        "quoted", "depth", "root", "first", "last", "open", "damaged", "first_key",
    )
    ddl = "_source_file string, _block long, _source_ts timestamp, root long, kind string, first boolean, last boolean, value string"
    full = begun.mapInArrow(_pieces(lambda kind: kind == "full"), ddl)
    # A file that is one split has no edges.
    edges = begun.filter("NOT (first AND last)").mapInArrow(_pieces(lambda kind: kind != "full"), ddl)
    place = F.expr("CASE kind WHEN 'head' THEN 0 WHEN 'whole' THEN 1 ELSE 2 END")
    order = Window.partitionBy("_source_file").orderBy("_block", "place")
    seams = edges.withColumn("place", place).withColumn("seam", F.sum(F.expr("cast(kind = 'tail' as int)")).over(order))
    joined = seams.groupBy("_source_file", "seam").agg(
        F.min("_source_ts").alias("_source_ts"), F.min("root").alias("root"), F.max("last").alias("last"),
        F.expr("array_join(transform(array_sort(collect_list(struct(_block, place, value))), p -> p.value), '') AS value"),
    )
    joined = joined.withColumn("first", F.col("seam") == 0)
    columns = ["value", "_source_file", "_source_ts", "root", "first", "last"]
    return full.select(columns).unionByName(joined.select(columns))


def json_arrays(spark: SparkSession, paths: str | Sequence[str], keep_non_objects: bool = True) -> DataFrame:
    """The elements of array files, or the objects of files that are none, as ``value``.

    A piece that is no JSON stays one null record with its text in ``_document``, and so
    does the end of an array that is not closed; blank files hold no records.
    """
    text = strip_start("value")
    ended = rf"regexp_replace({text}, '[\\x00-\\x20]+$', '')"
    inner = "substring(_text, 2)"
    lead = "if(first, '[', ',')"
    records = f"""CASE
        WHEN _text IS NULL THEN cast(NULL as array<string>)
        WHEN root = {ELEMENT} THEN {from_json("concat('[', _text, ']')", 'array<string>')}
        WHEN root = 0 THEN CASE WHEN {is_blank('_text')} THEN cast(array() as array<string>)
            WHEN NOT last THEN {from_json("concat('[', _text, ']')", 'array<string>')} END
        WHEN last AND NOT first AND {is_blank('_text')} THEN cast(array() as array<string>)
        WHEN NOT startswith(_text, {lead}) THEN NULL
        WHEN {is_blank(inner)} THEN CASE WHEN first THEN cast(array() as array<string>) END
        ELSE {from_json(f"concat('[', {inner}, ']')", 'array<string>')} END"""
    # The closing bracket of an array is taken off its last piece; without one the piece is no JSON.
    body = f"""CASE WHEN root = {ELEMENT} THEN regexp_replace(value, '^[\\\\s,]+|[\\\\s,]+$', '') WHEN root = 1 AND last THEN CASE WHEN endswith({ended}, ']') THEN
        substring({ended}, 1, length({ended}) - 1) END ELSE {text} END"""
    rows = _cut(spark, paths).selectExpr("*", f"{body} AS _text").selectExpr(
        "_source_file", "_source_ts", "value", f"{once(records)} AS _records"
    ).selectExpr(
        "_source_file", "_source_ts",
        "CASE WHEN _records IS NULL THEN value END AS _document",
        "explode(coalesce(_records, array(cast(NULL as string)))) AS value",
    )
    return rows if keep_non_objects else rows.filter("value IS NULL OR startswith(value, '{')")
