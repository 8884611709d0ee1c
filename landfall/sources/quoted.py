"""Delimited records whose quoted values hold line ends, in files that many tasks read.

Whether a line begins inside quotes depends on all text before it. A line is a function of
that one state, so a first pass composes the functions of each file split (only lines with
a quote say anything), a fold over these few rows gives the state each split begins with, and
a second pass puts lines together to records. Only what reaches over the edge of a split is
shuffled. A quote that no later one closes costs its own line: from there on, every line of the
file is a record again.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from landfall.functions.sql import lit
from landfall.sources.edges import BEHIND, FULL, HEAD, SOUND, TAIL, TORN, WHOLE, Split, folded_by_file, place_of, records, scan_splits, stretches


def quote_states(delimiter: str, quote: str) -> tuple[Callable[[str], bool], Callable[[str], bool]]:
    """Whether a line ends inside quotes if it begins outside, and if it begins inside them.

    Quotes open at the start of a value only; two of them inside are text; after the closing one
    the value goes on to the next delimiter.
    """
    d, q = re.escape(delimiter), re.escape(quote)
    inner = f"[^{q}]*+(?:{q}{q}[^{q}]*+)*+"
    rest = f"[^{d}]*+" if len(delimiter) == 1 else f"(?:(?!{d}).)*+"
    opens = f"(?:(?:{q}{inner}{q}|(?!{q})){rest}{d})*+{q}{inner}\\Z"
    outside, inside = re.compile(opens, re.S), re.compile(f"{inner}(?:\\Z|{q}{rest}{d}{opens})", re.S)
    return (lambda line: outside.match(line) is not None), (lambda line: inside.match(line) is not None)


def _summed(delimiter: str, quote: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A row for each stretch of a split: where it leads from either state, and whether it stays inside quotes if it begins there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        outside, inside = quote_states(delimiter, quote)
        for batch in batches:
            rows = []
            for part in stretches(batch):
                out, within, stays = False, True, True
                for line in part.column("line").drop_null().to_pylist():
                    out = inside(line) if out else outside(line)
                    within = inside(line) if within else outside(line)
                    stays = stays and within
                rows.append((*place_of(part), part.column("id")[0].as_py(), out, within, stays))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=["file", "block", "id", "out", "within", "stays"])

    return run


_STARTS = pa.schema([("_file", pa.int64()), ("_block", pa.int64()), ("inside", pa.bool_()), ("fate", pa.int32())])


def _folded(splits: list) -> list[tuple]:
    """The state each split of one file begins with, and what becomes of it; ``splits`` has a row or few for each, in order."""
    inside, begun, starts = False, None, {}
    for r in splits:
        starts.setdefault(r.block, inside)
        after = r.within if inside else r.out
        if after and not (inside and r.stays):
            begun = r.block
        inside = after
    fate = [SOUND if not inside or b < begun else TORN if b == begun else BEHIND for b in starts]
    return [(splits[0].file, b, i, f) for (b, i), f in zip(starts.items(), fate, strict=True)]


def _starts(lines: DataFrame, delimiter: str, quote: str) -> DataFrame:
    """(_file, _block, inside, fate) of each file split."""
    told = lines.selectExpr(
        "_file", "_block", "monotonically_increasing_id() AS id", f"CASE WHEN contains(value, {lit(quote)}) THEN value END AS line"
    ).mapInArrow(_summed(delimiter, quote), "file long, block long, id long, out boolean, within boolean, stays boolean")
    return folded_by_file(told, ["block", "id"], _folded, _STARTS, "_file long, _block long, inside boolean, fate int")


class _Lines(Split):
    """Puts the lines of one file split together to records."""

    def __init__(self, part: pa.RecordBatch, delimiter: str, quote: str) -> None:
        super().__init__(part)
        self.open = self.began_inside = part.column("inside")[0].as_py()
        self.fate, self.text, self.quote = part.column("fate")[0].as_py(), [], quote
        self.outside, self.inside = quote_states(delimiter, quote)

    def unchanged(self, part: pa.RecordBatch) -> bool:
        if self.fate == BEHIND:
            return True
        if self.open or any(self.outside(v) for v in part.column("value").to_pylist() if self.quote in v):
            return False
        self.ended = True
        return True

    def add(self, part: pa.RecordBatch) -> Iterator[tuple]:
        for line in part.column("value").to_pylist():
            if self.quote in line:
                self.open = self.inside(line) if self.open else self.outside(line)
            self.text.append(line)
            if not self.open:
                yield self.piece(HEAD if self.began_inside and not self.ended else FULL, "\n".join(self.text))
                self.text, self.ended = [], True

    def close(self) -> Iterator[tuple]:
        begun_here = self.ended or not self.began_inside
        if self.text and self.fate == TORN and begun_here:
            yield from (self.piece(FULL, line) for line in self.text)
        elif self.text:
            yield self.piece(TAIL if begun_here else WHOLE, "\n".join(self.text))


def quoted_records(spark: SparkSession, paths: str | Sequence[str], delimiter: str, quote: str) -> DataFrame:
    """``value`` records with their origin. A record ends at a line feed outside quotes; a carriage return before it goes."""
    lines = scan_splits(spark, paths, "\n")
    # Two numbers and two flags for each file split, which the driver has planned one by one already.
    begun = lines.join(F.broadcast(_starts(lines, delimiter, quote)), ["_file", "_block"])
    begun = begun.select("_file", "_block", "_source_file", "_source_ts", "value", "inside", "fate")
    found = records(begun, begun, lambda part: _Lines(part, delimiter, quote), "\n").drop("closed")
    return found.withColumn("value", F.expr(r"if(endswith(value, '\r'), substring(value, 1, length(value) - 1), value)"))
