"""Fill-in-middle transformation by displacement scatter.

Two cuts, drawn from a hash of the seed and the id, part a text into prefix, middle and suffix; the output puts the
middle last behind marks (`psm`: prefix, suffix, middle; `spm`: suffix, prefix, middle) or is the text itself (`plain`).

A batch of texts is one byte array. Its code points are scanned once for the byte positions of the cuts. A difference
array gets, at the start of every part, by how much further than the part before it is moved; its running sum
is the shift of every byte, and one scatter builds all outputs of the batch. `restore` finds the marks in the
outputs, derives the same shifts from them, and gathers every byte back: it needs the output and its form only.

Work is one projection over the rows, without a shuffle; a task holds about `SLICE` bytes of texts (or one longer text)
and a few integers for each of them.

Defined results: a null text counts as empty; an empty text and one that holds a mark are plain; a null id is drawn as
one without digits; equal rows give equal rows; other columns are left alone; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlens.llm.common import map_arrow

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARK = 3  # bytes of each mark
PLAIN, PSM, SPM = "plain", "psm", "spm"
SLICE = 4 << 20


def _bytes_of(column: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a column without nulls, and where each value begins (one more entry: the end)."""
    offsets = np.frombuffer(column.buffers()[1], "i4")[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return whole[offsets[0]:offsets[-1]], offsets - offsets[0]


def _strings(data: np.ndarray, offsets: np.ndarray) -> pa.StringArray:
    return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype("i4")), pa.py_buffer(data))


def _slices(column: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """(first row, number of rows) of runs of about `most` bytes."""
    _, offsets = _bytes_of(column)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        last = min(max(last, first + 1), len(column))
        yield first, last - first
        first = last


def displacement(begin: np.ndarray, first: np.ndarray, second: np.ndarray, end: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shift of every byte of the texts, where each output begins (and the last ends), positions of the marks P, S, M.

    Text i is the bytes `begin[i]` to `end[i]`, cut at `first[i]` and `second[i]`; texts follow each other without gaps.
    """
    moved, swapped = form != PLAIN, form == SPM
    size = end - begin + 3 * MARK * moved
    starts = np.r_[0, np.cumsum(size)]
    at = starts[:-1]
    head, tail = first - begin, end - second
    prefix = at + moved * np.where(swapped, 2 * MARK + tail, MARK)
    suffix = at + moved * np.where(swapped, MARK, 2 * MARK + head)
    middle = at + moved * (3 * MARK + head + tail)
    # A plain text is all prefix: its cuts are its end, where the two empty parts change nothing.
    places = np.stack([begin, first, second], 1).ravel()
    shifts = np.stack([prefix - begin, middle - first, suffix - second], 1).ravel()
    steps = np.zeros(int(end[-1]) + 1 if len(end) else 1, np.int64)
    np.add.at(steps, places, np.diff(shifts, prepend=0))
    marks = np.stack([prefix, suffix, middle], 1)[moved] - MARK
    return np.cumsum(steps[:-1]), starts, marks


def scatter(data: np.ndarray, offsets: np.ndarray, first: np.ndarray, second: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of the outputs of texts whose cuts are given in code points."""
    points = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    begin, end = offsets[:-1], offsets[1:]
    base = np.searchsorted(points, begin)
    plain = form == PLAIN
    cuts = [np.where(plain, end, points[np.minimum(base + np.where(plain, 0, c), len(points) - 1)]) for c in (first, second)]
    shift, starts, marks = displacement(begin, *cuts, end, form)
    out = np.empty(starts[-1], np.uint8)
    out[np.arange(len(data)) + shift] = data
    for place, mark in zip(marks.T, (PREFIX, SUFFIX, MIDDLE)):
        out[place[:, None] + np.arange(MARK)] = np.frombuffer(mark.encode(), np.uint8)
    return out, starts


def gather(data: np.ndarray, offsets: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of the texts behind outputs of the given forms."""
    moved, swapped = form != PLAIN, form == SPM
    begin, end = offsets[:-1], offsets[1:]
    known = np.zeros(256, bool)
    known[[ord(m[1]) for m in (PREFIX, SUFFIX, MIDDLE)]] = True
    found = np.flatnonzero((data[:-2] == ord("<")) & known[data[1:-1]] & (data[2:] == ord(">"))) if len(data) > 2 else np.empty(0, np.int64)
    row = np.searchsorted(offsets, found, "right") - 1
    found = found[moved[row] & (found + MARK <= end[row])] if len(found) else found
    if len(found) != 3 * moved.sum():
        raise ValueError("an output does not hold each mark once")
    marks = found.reshape(-1, 3)
    # Lengths of what stands behind the first, second and third mark.
    one, two, three = marks[:, 1] - marks[:, 0] - MARK, marks[:, 2] - marks[:, 1] - MARK, end[moved] - marks[:, 2] - MARK
    size = end - begin - 3 * MARK * moved
    starts = np.r_[0, np.cumsum(size)]
    first, second = starts[1:].copy(), starts[1:].copy()
    first[moved] = starts[:-1][moved] + np.where(swapped[moved], two, one)
    second[moved] = first[moved] + three
    shift, _, _ = displacement(starts[:-1], first, second, starts[1:], form)
    return data[np.arange(starts[-1]) + shift], starts


def _in_slices(batches: Iterator[pa.RecordBatch], text: str, build) -> Iterator[pa.RecordBatch]:
    """Batches of about SLICE bytes in `text`, and the column that `build` makes of each."""
    for whole in batches:
        for first, rows in _slices(whole.column(text), SLICE):
            part = whole.slice(first, rows)
            yield part, build(part)


def fill_in_middle(docs: DataFrame, seed: int = 1, plain_from: int = 90, spm_below: int = 20, text: str = "text") -> DataFrame:
    """doc_id, n (code points), form, prefix_chars, middle_chars (null if plain), output of every row."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    whole = F.coalesce(F.col(text), F.lit(""))

    def draw(k: int, below: Column) -> Column:
        return F.conv(F.substring("digest", 8 * k + 1, 8), 16, 10).cast("long") % below

    rows = docs.select("doc_id", whole.alias("text"), F.length(whole).cast("long").alias("n"), digest.alias("digest"))
    one, other = draw(0, F.col("n") + 1), draw(1, F.col("n") + 1)
    marked = F.contains("text", F.lit(PREFIX)) | F.contains("text", F.lit(SUFFIX)) | F.contains("text", F.lit(MIDDLE))
    form = F.when((F.col("n") == 0) | marked | (draw(2, F.lit(100)) >= plain_from), PLAIN).when(draw(3, F.lit(100)) < spm_below, SPM).otherwise(PSM)
    drawn = rows.select("doc_id", "n", form.alias("form"), F.least(one, other).alias("first"), F.greatest(one, other).alias("second"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def build(part: pa.RecordBatch) -> pa.Array:
            kinds = part.column("form").to_numpy(zero_copy_only=False).astype(str)
            return _strings(*scatter(*_bytes_of(part.column("text")), part.column("first").to_numpy(), part.column("second").to_numpy(), kinds))

        for part, output in _in_slices(batches, "text", build):
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], output], [*part.schema.names[:-1], "output"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    done = map_arrow(drawn, run, f"doc_id {kind}, n bigint, form string, first bigint, second bigint, output string")
    moved = F.col("form") != PLAIN
    return done.select("doc_id", "n", "form", F.when(moved, F.col("first")).alias("prefix_chars"),
                       F.when(moved, F.col("second") - F.col("first")).alias("middle_chars"), "output")


def restore(outputs: DataFrame) -> DataFrame:
    """`outputs` with a column `restored`: the text rebuilt from the columns `output` and `form` alone."""
    names = [c for c in outputs.columns if c != "restored"]
    schema = ", ".join(f"`{c}` {outputs.schema[c].dataType.simpleString()}" for c in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def build(part: pa.RecordBatch) -> pa.Array:
            kinds = part.column("form").to_numpy(zero_copy_only=False).astype(str)
            return _strings(*gather(*_bytes_of(part.column("output")), kinds))

        for part, restored in _in_slices(batches, "output", build):
            yield pa.RecordBatch.from_arrays([*part.columns, restored], [*part.schema.names, "restored"])

    return map_arrow(outputs.select(*names), run, f"{schema}, restored string")
