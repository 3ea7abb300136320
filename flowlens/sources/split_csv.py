"""CSV files whose quoted cells hold line breaks, cut into splits.

Where a record ends depends on whether the place is inside quotes, which a
task that starts in the middle of a file cannot tell. So:

1. Each file is cut into splits of ``split_bytes``. A task scans a split as if it
   began outside quotes and as if inside, and returns the state at its end for
   both: a function of two states.
2. The functions are composed along each file by a window: a split's state at
   its start is what the last constant function before it gives, flipped by the
   flips since. Only this table (one row a split) is shuffled.
3. Each task cuts the records that start in its split at the line ends outside
   quotes, reading on past its end to finish the last, and hands them to
   Spark's CSV parser as one text each.

Tasks read a split in blocks, so that they hold a block and the record under way,
whatever the size of the splits and files. The records of a block are one Arrow
array over its bytes.

A quote opens a cell only at the cell's start; elsewhere in an unquoted cell it
is an ordinary character. ``""`` in a quoted cell is one quote. Lines end with
``\\n`` or ``\\r\\n``. Lines of blanks are no records.
"""

from __future__ import annotations

import re
import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowlens.session import shared_dir
from flowlens.sources.files import open_input

# tasks run functions of this module; they travel by value
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SPLIT_BYTES = 32 << 20
MOST_TASKS = 20_000
BLOCK_BYTES = 1 << 20
PAST_BYTES = 1 << 16  # past the split, where only its last record is read
_OPEN = re.compile(rb'(?<=[,\n])"')
_CLOSE = re.compile(rb'[^"]*(?:""[^"]*)*("(?!")|\Z)')


def quoted_spans(data: bytes, before: bytes, inside: bool) -> tuple[list[int], list[int], bool]:
    """Starts and ends of the quoted stretches of ``data``, and whether its end
    lies in one. ``before`` is the byte ahead of it (a line end at the file's start)."""
    data, at = before + data, 1
    starts, ends = [], []
    if not inside and before == b'"' and data[1:2] == b'"':
        inside = True  # the second half of a doubled quote
        at = 2
        starts.append(0)
    elif inside:
        starts.append(0)
    while True:
        if not inside:
            found = _OPEN.search(data, at)
            if found is None:
                return starts, ends, False
            starts.append(found.start() - 1)
            at = found.end()
        found = _CLOSE.match(data, at)
        at = found.end()
        if found.group(1) is None or not found.group(1):
            ends.append(len(data) - 1)
            return starts, ends, True
        ends.append(at - 1)
        inside = False


def _byte_before(fh, start: int) -> bytes:
    if start == 0:
        return b"\n"
    fh.seek(start - 1)
    return fh.read(1)


def _blocks(fh, start: int, stop: int, past: bool):
    """The file from ``start`` in blocks, up to ``stop`` or, with ``past``, in smaller
    ones to its end. No block ends in a quote (unless what is read does): whether a
    quote is the second of two can be told in the block that holds it."""
    at = start
    fh.seek(start)
    while past or at < stop:
        parts, want = [], min(BLOCK_BYTES, stop - at) if at < stop else PAST_BYTES
        while got := fh.read(want if past else min(want, stop - at)):
            parts.append(got)
            at, want = at + len(got), 4096
            if not got.endswith(b'"'):
                break
        if not parts:
            return
        yield b"".join(parts)


def split_states_of(fh, start: int, size: int) -> list[bool]:
    """Whether the split's end lies inside quotes, if it begins outside and if inside."""
    before, states = _byte_before(fh, start), [False, True]
    for block in _blocks(fh, start, start + size, False):
        after = {state: quoted_spans(block, before, state)[2] for state in set(states)}
        before, states = block[-1:], [after[state] for state in states]
    return states


def _states(batches):
    for batch in batches:
        out = []
        for path, start, size in zip(*(c.to_pylist() for c in batch.columns)):
            with open_input(path) as fh:
                out.append((path, start, size, *split_states_of(fh, start, size)))
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)] if out else [pa.array([], t) for t in (
            pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_())], names=["path", "start", "size", "if_out", "if_in"])


def line_ends(data: bytes, starts: list[int], ends: list[int]) -> np.ndarray:
    """Places of the line feeds outside the quoted stretches."""
    feeds = np.flatnonzero(np.frombuffer(data, np.uint8) == 10)
    span = np.searchsorted(np.array(starts, np.int64), feeds, side="right") - 1
    stop = np.array(ends + [0], np.int64)[span]
    return feeds[(span < 0) | (feeds >= stop)]


def record_blocks(fh, start: int, size: int, inside: bool):
    """The records that start in a split, whole: (bytes, places of the line feeds that
    end a record of them). The file's last record may have no line feed: its place is the end."""
    before, at, end = _byte_before(fh, start), start, start + size
    ours = before == b"\n" and not inside  # else a record that began before the split is under way
    held: list[bytes] = []  # the record under way
    for block in _blocks(fh, start, end, True):
        starts, ends, after = quoted_spans(block, before, inside)
        feeds = line_ends(block, starts, ends)
        before, inside = block[-1:], after
        if len(feeds):
            begun = np.concatenate([[start], at + feeds[:-1] + 1])  # where each record starts, the first here or before
            own = feeds[begun < end] if ours else feeds[1:][begun[1:] < end]
            first = 0 if ours else int(feeds[0]) + 1
            if len(own):
                last = int(own[-1]) + 1
                ahead = b"".join(held)
                yield ahead + block[first:last], own - first + len(ahead)
                first = last
            if at + first >= end:
                return
            held, ours = [block[first:]], True
        elif ours:
            held.append(block)
        elif at + len(block) >= end:
            return
        at += len(block)
    rest = b"".join(held)
    if rest:
        yield rest, np.array([len(rest)])


def records(fh, start: int, size: int, inside: bool) -> list[bytes]:
    """The records that start in a split, whole."""
    out = []
    for data, feeds in record_blocks(fh, start, size, inside):
        first = 0
        for feed in feeds.tolist():
            out.append(data[first:feed].removesuffix(b"\r"))
            first = feed + 1
    return out


def record_texts(data: bytes, feeds: np.ndarray) -> pa.Array:
    """The records of a block as texts, without their line ends; bytes that are not UTF-8 are replaced."""
    if feeds[-1] == len(data):  # the file's last record, without a line feed
        return pa.array([data.removesuffix(b"\r").decode("utf-8", errors="replace")], pa.string())
    stops = feeds + 1
    try:
        data.decode("utf-8")
    except UnicodeDecodeError:
        parts = [data[a:b].decode("utf-8", errors="replace") for a, b in zip([0, *stops[:-1].tolist()], stops.tolist())]
        texts = pa.array(parts, pa.string())
    else:
        offsets = np.concatenate([[0], stops]).astype(np.int32)
        texts = pa.StringArray.from_buffers(len(stops), pa.py_buffer(offsets), pa.py_buffer(data))
    return pc.replace_substring_regex(texts, "\r?\n\\z", "")


def _cut(has_header: bool):
    def run(batches):
        for batch in batches:
            for path, start, size, inside in zip(*(c.to_pylist() for c in batch.columns)):
                header = has_header and start == 0
                with open_input(path) as fh:
                    for found in record_blocks(fh, start, size, inside):
                        texts = record_texts(*found)
                        if header:
                            texts, header = texts.slice(1), False
                        texts = texts.filter(pc.not_equal(pc.ascii_trim(texts, " \t\r\n\x0b\x0c"), ""))
                        if len(texts):
                            yield pa.RecordBatch.from_arrays([texts], names=["record"])

    return run


def split_states(spark: SparkSession, files: list[str], split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """``(path, start, size, inside)``: the splits of the files and whether each starts inside quotes."""
    listed = spark.read.format("binaryFile").load(list(files)).select("path", "length")
    starts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(split_bytes).cast("bigint")))
    splits = listed.where("length > 0").select("path", starts.alias("start"), "length")
    splits = splits.select("path", "start", F.least(F.lit(split_bytes).cast("bigint"), F.col("length") - F.col("start")).alias("size"))
    shared_dir(spark)
    states = _spread(splits).mapInArrow(_states, "path string, start bigint, size bigint, if_out boolean, if_in boolean")
    along = Window.partitionBy("path").orderBy("start")
    fixed = F.col("if_out") == F.col("if_in")
    states = states.withColumn("stretch", F.sum(fixed.cast("int")).over(along))
    own = Window.partitionBy("path", "stretch").orderBy("start")
    flips = F.sum((~fixed & F.col("if_out")).cast("int")).over(own)
    given = F.max((fixed & F.col("if_out")).cast("int")).over(own)  # what the constant function at the stretch's start gives
    after = (flips + given) % 2 == 1
    return states.withColumn("after", after).select("path", "start", "size", F.coalesce(F.lag("after").over(along), F.lit(False)).alias("inside"))


def _spread(splits: DataFrame) -> DataFrame:
    """A split a task, or a few where there are very many. The number is given,
    else the session would put rows as small as these into one task."""
    return splits.repartition(min(max(splits.count(), 1), MOST_TASKS))


def read_split_csv(spark: SparkSession, files: list[str], names: list[str], has_header: bool, options: dict,
                   split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """CSV files of one layout as text columns ``names``, read by splits."""
    # written once: counting and reading both need the states
    splits = split_states(spark, files, split_bytes).checkpoint()
    rows = _spread(splits).mapInArrow(_cut(has_header), "record string")
    schema = ", ".join(f"c{i} string" for i in range(len(names)))
    parsed = rows.select(F.from_csv("record", schema, {**options, "multiLine": "true"}).alias("r")).select("r.*")
    return parsed.toDF(*names)
