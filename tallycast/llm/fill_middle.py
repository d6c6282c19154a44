"""Fill-in-the-middle transformation of whole texts.

A text is cut at two places into prefix, middle and suffix, which are put out in
another order between the marks ``<P>``, ``<S>`` and ``<M>``.  Cut places are
counted in units: code points, words (a run of other than spaces with the spaces
behind it; spaces before the first word are a unit too) or lines (with their line end).  The UTF-8 bytes of a text are divided
into blocks of ``BLOCK`` bytes; two Fenwick trees hold how many units and how
many code points start in each block.  Binary-lifting descent over the units
finds the block of a cut, counting the code points before it on the way; the
place within the block is then found in its bytes alone.

Draws come from the sha256 of a seed and the id, so a rerun gives the same rows.
Null and empty texts, texts that hold one of the marks and the share drawn as
plain are put out as they are: form ``plain``, ``prefix_chars`` and
``middle_chars`` null.  A null id draws like an empty one, repeated rows draw
alike.  Rows are independent: nothing is shuffled, other columns pass through
(one of a result's name is replaced), an empty table gives no rows, and a lost
executor costs its own tasks.  A task holds one slice of texts and its output;
the trees of a text take 16 bytes a block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallycast.llm.words import row_slices

BLOCK = 1 << 12
SLICE_BYTES = 1 << 20
MARKS = PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
RESULT = ("n", "form", "prefix_chars", "middle_chars", "output")
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def starts(data: np.ndarray, at: int, end: int, unit: str) -> np.ndarray:
    """Which bytes of ``data[at:end]`` start a unit, seen with one byte before them."""
    here = data[at:end]
    if unit == "point":
        return (here & 0xC0) != 0x80
    before = data[at - 1:at - 1 + len(here)] if at else np.concatenate([[np.uint8(0x0A)], here[:-1]])
    if unit == "line":
        out = before == 0x0A
    elif unit == "word":
        out = _SPACE[before] & ~_SPACE[here]
    else:
        raise ValueError(f"unknown unit: {unit}")
    if at == 0:
        out[:1] = True
    return out


class Fenwick:
    """Sums over a growing number of blocks; place k holds the last ``k & -k`` blocks up to k."""

    def __init__(self, counts: np.ndarray) -> None:
        total = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
        place = np.arange(len(total))
        self.tree = total - total[place - (place & -place)]
        self.size, self.total = len(counts), int(total[-1])


def descend(target: int, units: Fenwick, points: Fenwick) -> tuple[int, int, int]:
    """The block that holds unit number ``target`` (from 0), how many units lie before
    the block, and how many code points."""
    block = seen = passed = 0
    step = 1 << units.size.bit_length()
    while step:
        ahead = block + step
        if ahead <= units.size and seen + int(units.tree[ahead]) <= target:
            block, seen, passed = ahead, seen + int(units.tree[ahead]), passed + int(points.tree[ahead])
        step >>= 1
    return block, seen, passed


class Cutter:
    """Cut places of one text."""

    def __init__(self, raw: bytes, unit: str = "point") -> None:
        self.raw, self.unit = raw, unit
        self.data = np.frombuffer(raw, dtype=np.uint8)
        edges = range(0, len(raw), BLOCK)
        points = [int(np.count_nonzero(starts(self.data, at, at + BLOCK, "point"))) for at in edges]
        own = points if unit == "point" else [
            int(np.count_nonzero(starts(self.data, at, at + BLOCK, unit))) for at in edges]
        self.points, self.units = Fenwick(np.array(points, np.int64)), Fenwick(np.array(own, np.int64))

    def place(self, target: int) -> tuple[int, int]:
        """Byte place behind the first ``target`` units, and the code points before it."""
        if target >= self.units.total:
            return len(self.raw), self.points.total
        block, seen, passed = descend(target, self.units, self.points)
        at = block * BLOCK
        inside = int(np.flatnonzero(starts(self.data, at, at + BLOCK, self.unit))[target - seen])
        return at + inside, passed + int(np.count_nonzero(starts(self.data, at, at + inside, "point")))


def arranged(raw: bytes, draws: tuple[int, int, int, int], *, plain: int, spm: int, unit: str = "point") -> tuple:
    """``RESULT`` of one text; ``plain`` and ``spm`` are shares out of 100."""
    cutter = Cutter(raw, unit)
    n = cutter.units.total
    if not raw or any(mark.encode() in raw for mark in MARKS) or draws[2] % 100 >= 100 - plain:
        return n, "plain", None, None, raw
    low, high = sorted(draw % (n + 1) for draw in draws[:2])
    (a, before), (b, upto) = cutter.place(low), cutter.place(high)
    prefix, middle, suffix = raw[:a], raw[a:b], raw[b:]
    p, s, m = (mark.encode() for mark in MARKS)
    if draws[3] % 100 < spm:
        return n, "spm", before, upto - before, b"".join([s, suffix, p, prefix, m, middle])
    return n, "psm", before, upto - before, b"".join([p, prefix, s, suffix, m, middle])


def draws_of(key: Column, seed: str) -> list[Column]:
    """Four 32-bit numbers from the digest of the seed and an id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)]


def transform(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", seed: str = "1",
    plain: int = 10, spm: int = 20, unit: str = "point",
) -> DataFrame:
    """``docs`` without the text, with ``RESULT``: units, form, code points of prefix and
    middle, and the text as arranged."""
    others = [name for name in docs.columns if name not in {text, *RESULT}]
    rows = docs.select(
        *[F.col(f"`{name}`") for name in others], F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("output"),
        F.array(*draws_of(F.col(f"`{key}`"), seed)).alias("form"))
    schema = T.StructType([
        *[docs.schema[name] for name in others], T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
        T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()),
        T.StructField("output", T.StringType())])
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64())

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for part in row_slices(batch, "output", SLICE_BYTES):
                texts, draws = part.column("output").cast(pa.binary()), part.column("form").to_pylist()
                found = [arranged(one.as_py(), drawn, plain=plain, spm=spm, unit=unit)
                         for one, drawn in zip(texts, draws)]
                *columns, output = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-2], *[pa.array(column, kind) for column, kind in zip(columns, kinds)],
                     pa.array(output, pa.binary()).cast(pa.string())], names=schema.names)

    return rows.mapInArrow(batches, schema)


def restored(output: Column, form: Column) -> Column:
    """The text that ``transform`` arranged.  No mark can begin inside a text without
    marks and end in one beside it, so the parts between the three marks are exact."""
    parts = F.split(output, "<[PSM]>", -1)
    first, second, third = (F.get(parts, F.lit(k)) for k in (1, 2, 3))
    return (F.when(form == "psm", F.concat(first, third, second))
            .when(form == "spm", F.concat(second, third, first)).otherwise(output))
