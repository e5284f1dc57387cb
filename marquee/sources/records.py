"""CSV records cut from the lines of split files.

A quoted field may hold line breaks, so a line is not a record, and a reader that knows
this must start at the beginning of a file: one task a file, however large. Here files are
read as lines, split like any text. A line break is inside a field if the number of quotes
before it in the file is odd. That number's parity is the sum of the parities of the parts
(file blocks) before, a table of a few numbers a part, and of the lines before in the part.
The lines are read twice and never shuffled: once for the parities of the parts, and once
to put the lines of each record together in the part's own task, in Arrow batches. Only the
pieces of records that cross the edges of parts, two a part, are shuffled.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, DataFrameReader, Window, functions as F, types as T
from pyspark.sql.streaming import DataStreamReader

# functions of this module travel with the plan: executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FILE, BLOCK = "_file", "_block"


def text_lines(reader: DataFrameReader | DataStreamReader, path: str | list[str]) -> DataFrame:
    """(value, _file, _block) of every line of CSV files, by ``spark.read`` or ``spark.readStream``; the files are split."""
    rows = reader.format("text").option("lineSep", "\n").load(path)
    return rows.select("value", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(BLOCK))


def first_line(lines: DataFrame) -> str | None:
    """The first line of one of the files (their headers must agree); one row reaches the driver."""
    starts = lines.where(F.col(BLOCK) == 0).groupBy(FILE).agg(F.first("value").alias("value"))
    row = starts.orderBy(FILE).select("value").first()
    return row[0].removeprefix("﻿").removesuffix("\r") if row else None


def cut_records(lines: DataFrame) -> DataFrame:
    """(record, is_first) of every record of the lines of ``text_lines``; is_first: its file's first one.

    Line breaks inside a record are single newlines. Empty records (blank lines) are left out. A file that ends inside
    a quoted field is an error, and so is one that is split differently when it is read again.
    """
    part = [FILE, BLOCK]
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    totals = lines.groupBy(*part).agg(F.sum((quotes % 2).cast("int")).alias("_odd"), F.count(F.lit(1)).alias("_n"))
    of_file = Window.partitionBy(FILE)
    before = of_file.orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    parts = totals.select("*", (F.sum("_odd").over(of_file) % 2).alias("_open"), F.count(F.lit(1)).over(of_file).alias("_of"),
                          (F.coalesce(F.sum("_odd").over(before), F.lit(0)) % 2).alias("_flip"))
    unclosed = F.raise_error(F.concat(F.lit("a quoted field isn't closed in "), F.col(FILE)))
    # files of one part begin outside of fields; only the parts of split files travel
    parts = parts.where(F.when(F.col("_open") == 1, unclosed).otherwise(F.col("_of") > 1)).select(
        F.col(FILE).alias("_f"), F.col(BLOCK).alias("_b"), F.col("_flip").cast("int").alias("_flip"), "_n")
    rows = lines.join(F.broadcast(parts), (F.col(FILE) == F.col("_f")) & (F.col(BLOCK) == F.col("_b")), "left")
    rows = rows.select(F.col("value").cast("binary").alias("value"), F.xxhash64(FILE).alias(FILE), BLOCK, "_flip", "_n")
    cut = rows.mapInArrow(_cut_parts, f"record binary, is_first boolean, {FILE} long, {BLOCK} long, _piece int")

    whole = cut.where("_piece is null").select("record", "is_first")
    pieces = cut.where("_piece is not null")
    # a record's pieces: its beginning at the end of a part, and what the parts after it begin with
    upto = Window.partitionBy(FILE).orderBy(BLOCK, "_piece").rowsBetween(Window.unboundedPreceding, 0)
    at = F.sum((F.col("_piece") == TAIL).cast("int")).over(upto).alias("_at")
    joined = pieces.select("*", at).groupBy(FILE, "_at").agg(
        F.array_sort(F.collect_list(F.struct(BLOCK, "_piece", F.col("record").cast("string").alias("value")))).alias("of"),
        F.max("is_first").alias("is_first"))
    joined = joined.select(F.array_join(F.transform("of", lambda x: x["value"]), "\n").alias("record"), "is_first")
    every = whole.select(F.col("record").cast("string").alias("record"), "is_first").unionByName(joined)
    every = every.select(F.regexp_replace(F.rtrim("record", F.lit("\r")), "\r\n", "\n").alias("record"), "is_first")
    return every.where(F.col("record") != "")


#: Pieces of records: what a part begins with inside of a field, and what it ends with.
HEAD, TAIL = 0, 1


def _cut_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records of each part, from its lines in order; the state goes from batch to batch."""
    part, flip, n = None, 0, None       # the part that is read, how it begins, its lines as counted before
    seen = 0                            # its lines so far
    inside = 0                          # 1: the next line continues a field
    held: list[bytes] = []              # the record that isn't closed yet
    piece: int | None = None            # HEAD: held is what the part begins with
    first = False                       # held, or the next record, is the file's first

    def row(text: bytes, kind: int) -> pa.RecordBatch:
        return _records(pa.array([text], pa.binary()), first, part, kind)

    def end() -> Iterator[pa.RecordBatch]:
        if part is None:
            return
        if n is None and part[1] != 0 or n is not None and n != seen:
            raise ValueError("a file was split differently when it was read again; run the job again")
        if held:
            yield row(b"\n".join(held), HEAD if piece == HEAD else TAIL)

    for batch in batches:
        files, blocks = batch.column(1), batch.column(2)
        edges = [0]
        if batch.num_rows > 1:
            change = pc.or_(pc.not_equal(files[1:], files[:-1]), pc.not_equal(blocks[1:], blocks[:-1]))
            edges += (pc.indices_nonzero(change).to_numpy() + 1).tolist()
        for a, b in zip(edges, [*edges[1:], batch.num_rows], strict=True):
            if a == b:
                continue
            here = (files[a].as_py(), blocks[a].as_py())
            if here != part:
                yield from end()
                part, n, seen, held = here, batch.column(4)[a].as_py(), 0, []
                flip = batch.column(3)[a].as_py() or 0
                inside, piece, first = flip, HEAD if flip else None, here[1] == 0
            values = batch.column(0)[a:b]
            seen += b - a
            odd = pc.bit_wise_and(pc.count_substring(values, '"'), 1).to_numpy(zero_copy_only=False)
            after = (inside + odd.cumsum()) & 1         # 1: the line ends inside of a field
            closes = (after == 0).nonzero()[0]
            inside = int(after[-1])
            if not len(closes):
                held += values.to_pylist()
                continue
            begin = 0
            if held or piece == HEAD:                   # the first close ends what is held
                begin = int(closes[0]) + 1
                text = b"\n".join([*held, *values[:begin].to_pylist()])
                yield row(text, HEAD) if piece == HEAD else _records(pa.array([text], pa.binary()), first, part, None)
                held, piece, first = [], None, False
                closes = closes[1:]
            if len(closes):
                offsets = pa.array([begin, *(closes + 1).tolist()], pa.int32())
                # offsets count from the batch's own buffers
                yield _records(pc.binary_join(pa.ListArray.from_arrays(offsets, pa.concat_arrays([values])), b"\n"), first, part, None)
                first, begin = False, int(closes[-1]) + 1
            held = values[begin:].to_pylist()
    yield from end()


def _records(texts: pa.Array, first: bool, part: tuple[int, int], piece: int | None) -> pa.RecordBatch:
    k = len(texts)
    fill = lambda v, t: pa.array([v] * k, t)
    return pa.RecordBatch.from_arrays([texts, pa.array([first, *[False] * (k - 1)], pa.bool_()), fill(part[0], pa.int64()), fill(part[1], pa.int64()),
                                       fill(piece, pa.int32())], ["record", "is_first", FILE, BLOCK, "_piece"])


def body_records(records: DataFrame, header: str) -> DataFrame:
    """(record) without the headers; a file whose header differs from ``header`` is an error."""
    other = F.raise_error(F.concat(F.lit("the header of a file differs from the first one's: "), F.col("record")))
    # a header that starts with a byte order mark is the same
    same = F.ltrim("record", F.lit("﻿")) == F.lit(header)
    return records.where(F.when(~F.col("is_first"), F.lit(True)).when(same, F.lit(False)).otherwise(other)).select("record")


def parsed(records: DataFrame, schema: T.StructType, options: dict[str, str]) -> DataFrame:
    """The fields of CSV records."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return records.select(F.from_csv("record", columns, options).alias("_r")).select("_r.*")
