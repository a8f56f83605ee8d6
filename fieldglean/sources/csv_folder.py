"""Folders of CSV files with differing headers, read in blocks that fall anywhere, also inside quoted fields.

A record ends at a line break with an even number of quotes before it in its file. So three steps over a table of blocks give what one
reader of the whole file would see: count the quotes and lines of each block, take their prefix sums over the blocks of a file, and
read from each block the records that begin in it. Headers come from the first record of a file alone; the driver sees the names of
the columns, not files or rows.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldglean.session import cut as written
from fieldglean.session import ship_package

#: Bytes of a block: one task reads one or a few of them, and the record that crosses its end.
BLOCK = 64 << 20
#: A record of more bytes is broken: with a quote that nothing closes it would be the rest of the file.
MAX_RECORD = 16 << 20
#: Blocks are dealt over at most so many tasks.
MAX_TASKS = 100_000
#: A batch of rows holds about so many characters.
BATCH_TEXT = 8 << 20
_PIECE = 1 << 20
#: Marks of a row: its file, the block it begins in, its place and line in the file.
MARKS = ("__path", "__start", "__m", "__line")

NO_HEADER = "no header line"
TWICE = "a column stands twice in the header"
FIELDS = "row with another number of fields than the header"
LONG = "record longer than the limit"
ENCODING = "not UTF-8"
UNREADABLE = "file cannot be read"


def _opened(path: str) -> io.BufferedReader:
    if path.startswith("/"):
        return io.BufferedReader(fs.LocalFileSystem().open_input_file(path), _PIECE)
    system, inner = fs.FileSystem.from_uri(quote(path, safe=":/@%"))
    return io.BufferedReader(system.open_input_file(inner), _PIECE)


def records(file, begin: int, end: int, odd: bool, fresh: bool, line: int, most: int) -> Iterator[tuple[int, int, bytes | None]]:
    """``(place, line, bytes)`` of the records of a file that begin in ``[begin, end)``; None for one of more than ``most`` bytes.

    ``odd`` says whether the quotes before ``begin`` are odd in number, ``fresh`` whether a record begins there, ``line`` is its line.
    """
    file.seek(begin)
    at, start, first, held, size = begin, begin if fresh else None, line, [], 0
    while at < end or start is not None:
        piece = file.readline(_PIECE)
        if not piece:
            break
        at += len(piece)
        odd ^= piece.count(b'"') % 2 == 1
        if start is not None:
            size += len(piece)
            if size <= most:
                held.append(piece)
            else:
                held.clear()
        if piece.endswith(b"\n"):
            line += 1
            if not odd:
                if start is not None:
                    yield start, first, b"".join(held) if size <= most else None
                start, first, held, size = at if at < end else None, line, [], 0
    if start is not None and size:
        yield start, first, b"".join(held) if size <= most else None


def _fields(record: bytes) -> list[str | None]:
    text = record.decode("utf-8").rstrip("\r\n")
    return [v or None for v in next(csv.reader([text], strict=False), [])] if text else []


def _header(file, most: int) -> tuple[list[str] | None, str | None]:
    for _, _, record in records(file, 0, 1, False, True, 1, most):
        if record is None:
            return None, LONG
        names = [v or f"_c{i}" for i, v in enumerate(_fields(record.removeprefix(b"\xef\xbb\xbf")))]
        if not any(n.strip() for n in names):
            return None, NO_HEADER
        return (None, TWICE) if len({n.lower() for n in names}) < len(names) else (names, None)
    return None, NO_HEADER


def _plain(path: Column) -> Column:
    return F.regexp_replace(path, "^file:/+", "/")


def headers(spark: SparkSession, folder: str, glob: str = "*.csv", most: int = MAX_RECORD) -> DataFrame:
    """``(path, length, header, reason)`` of the files of a folder: the names of the first record, or why there are none.

    Of a file only its first record is read. Empty files do not show.
    """
    ship_package(spark)
    listed = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder).select(_plain(F.col("path")).alias("path"), "length")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for path in batch.column("path").to_pylist():
                try:
                    with _opened(path) as file:
                        found.append(_header(file, most))
                except UnicodeDecodeError:
                    found.append((None, ENCODING))
                except OSError:
                    found.append((None, UNREADABLE))
            yield pa.RecordBatch.from_arrays([batch.column("path"), batch.column("length"), pa.array([h for h, _ in found], pa.list_(pa.string())),
                                              pa.array([r for _, r in found], pa.string())], ["path", "length", "header", "reason"])

    return listed.mapInArrow(read, "path string, length long, header array<string>, reason string")


def tasks(files: DataFrame, size: int) -> int:
    """Tasks for the blocks of the files: one each, up to a bound."""
    return int(min(files.agg(F.sum(F.ceil(F.col("length") / size)).alias("n")).first()["n"] or 1, MAX_TASKS))


def blocks(files: DataFrame, size: int) -> DataFrame:
    """``(path, header, begin, end, odd, fresh, line)``: the blocks of the files and in what state a reader comes to each.

    Each block but the last of a file is read once for its quotes and line breaks. A window group is a file's blocks, a row each.
    """
    last = F.floor((F.col("length") - 1) / size)
    cut = files.select("path", "header", "length", F.explode(F.sequence(F.lit(0), last.cast("long"))).alias("n"))
    cut = cut.select("path", "header", (F.col("n") * size).alias("begin"), F.least((F.col("n") + 1) * size, F.col("length")).alias("end"), "length")
    cut = cut.repartition(tasks(files, size), "path", "begin")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            quotes, lines, ends = [], [], []
            for path, begin, end, length in zip(*[batch.column(c).to_pylist() for c in ("path", "begin", "end", "length")]):
                q, n, last = 0, 0, b""
                if end < length:
                    with _opened(path) as file:
                        file.seek(begin)
                        left = end - begin
                        while left and (piece := file.read(min(left, _PIECE))):
                            q, n, last, left = q + piece.count(b'"'), n + piece.count(b"\n"), piece[-1:], left - len(piece)
                quotes.append(q)
                lines.append(n)
                ends.append(last == b"\n")
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("path", "header", "begin", "end")], pa.array(quotes, pa.int64()),
                                              pa.array(lines, pa.int64()), pa.array(ends, pa.bool_())],
                                             ["path", "header", "begin", "end", "quotes", "lines", "ends"])

    counted = cut.mapInArrow(count, "path string, header array<string>, begin long, end long, quotes long, lines long, ends boolean")
    w = Window.partitionBy("path").orderBy("begin")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    odd = F.coalesce(F.sum("quotes").over(before) % 2 == 1, F.lit(False))
    state = counted.select("path", "header", "begin", "end", odd.alias("odd"), F.lag("ends", 1, True).over(w).alias("after"),
                           (F.coalesce(F.sum("lines").over(before), F.lit(0)) + 1).alias("line"))
    return state.select("path", "header", "begin", "end", "odd", (F.col("after") & ~F.col("odd")).alias("fresh"), "line")


def read(spark: SparkSession, folder: str, glob: str = "*.csv", block: int = BLOCK, most: int = MAX_RECORD) -> tuple[DataFrame, DataFrame]:
    """(rows of all files by column name, what was left out).

    Columns are text, empty fields NULL, in the order of their names; names that differ in case are one. Rows carry ``MARKS``. Left out,
    as ``(path, line, reason)``: files without a usable header (line NULL), rows with another number of fields, records of more than
    ``most`` bytes or that are not UTF-8. Blank lines are no rows. The tables of files and blocks are written once to the checkpoint folder. A quote inside an unquoted field counts as a quote, too.
    """
    found = written(headers(spark, folder, glob, most))
    usable = found.filter("reason is null")
    names = F.explode("header").alias("name")
    # One row per column name comes to the driver.
    wanted = [r["name"] for r in usable.select(names).groupBy(F.lower("name").alias("l")).agg(F.min("name").alias("name")).orderBy("l").collect()]
    place = {n.lower(): i for i, n in enumerate(wanted)}

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string()] * len(wanted) + [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]

        def out(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows) if rows else [()] * len(kinds)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [*wanted, *MARKS, "__reason"])

        for batch in batches:
            for path, header, begin, end, odd, fresh, line in zip(*[batch.column(c).to_pylist() for c in (
                    "path", "header", "begin", "end", "odd", "fresh", "line")]):
                at = [place[n.lower()] for n in header]
                rows, held = [], 0
                with _opened(path) as file:
                    for start, first, record in records(file, begin, end, odd, fresh, line, most):
                        if start == 0:
                            continue
                        values, reason = [None] * len(wanted), None
                        try:
                            fields = _fields(record) if record is not None else None
                        except UnicodeDecodeError:
                            fields, reason = None, ENCODING
                        if fields is None:
                            reason = reason or LONG
                        elif not fields:
                            continue
                        elif len(fields) != len(at):
                            reason = FIELDS
                        else:
                            for i, v in zip(at, fields):
                                values[i] = v
                        rows.append((*values, path, begin, start, first, reason))
                        held += len(record or b"")
                        if held >= BATCH_TEXT or len(rows) >= 10_000:
                            yield out(rows)
                            rows, held = [], 0
                yield out(rows)

    fields = ", ".join([f"`{n.replace('`', '``')}` string" for n in wanted] + ["__path string, __start long, __m long, __line long, __reason string"])
    # The prefix sums have gathered a file's blocks; they are dealt out again.
    parsed = written(blocks(usable, block)).repartition(tasks(usable, block), "path", "begin").mapInArrow(parse, fields)
    no_rows = found.filter("reason is not null").select("path", F.lit(None).cast("long").alias("line"), "reason")
    broken = parsed.filter("__reason is not null").select(F.col("__path").alias("path"), F.col("__line").alias("line"), F.col("__reason").alias("reason"))
    return parsed.filter("__reason is null").drop("__reason"), no_rows.unionByName(broken)
