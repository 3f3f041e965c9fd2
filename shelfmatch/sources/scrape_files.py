"""Scrape files: delimited text with a header, comma or tab, quoted fields that may span lines.

Files may have any dialect and order their columns differently, and no file's name or layout comes to the driver: the task that
reads a part of a file reads the file's header first. Large files are cut into ranges of bytes. A range has the records that
begin in its lines; a line begins a record unless a quoted field is open there, so a first pass tells of each range whether
one is open behind it, for either case before it, and a file's ranges are gone through in order. A file that can't be read is
reported, and the others are read all the same.
"""

from __future__ import annotations

import codecs
import csv
import io
import re
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmatch.operators.listings import normalize_listings
from shelfmatch.operators.merge import last_per_key
from shelfmatch.schemas import SCRAPE_COLUMNS
from shelfmatch.session import open_filesystem

SAMPLE_CHARS = 4096  # fixed value: as much of a file as decides its dialect
LANDING = "normalized"  # fixed value: only files below this folder of a bucket are read
#: Bytes of a file that one task reads.
RANGE = 64 << 20
#: What opening a file costs, in bytes read: small files share a task by it.
OPENING = 4 << 20
#: Rows that leave a task at once.
ROWS = 10_000

Dialect = tuple[str, str, bool]
_RAW = ", ".join(f"{name} string" for name in SCRAPE_COLUMNS) + (
    ", path string, part_start long, row_order long, problem string")


def landed_files(spark: SparkSession, bucket: str) -> DataFrame:
    """``path, length`` of the files to read; their content is not touched."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(
        f"{bucket}/{LANDING}").select("path", "length")


def sniff_dialect(sample: str) -> tuple[str, str, bool]:
    """Separator, quote character, and whether spaces after a separator are to be skipped."""
    try:
        found = csv.Sniffer().sniff(sample, delimiters=",\t")
        return found.delimiter, found.quotechar or '"', bool(found.skipinitialspace)
    except csv.Error:
        return "\t" if "\t" in sample.partition("\n")[0] else ",", '"', False


def records(lines: Iterable[str], dialect: Dialect) -> Iterator[list[str]]:
    separator, quote, skip_space = dialect
    return csv.reader(lines, delimiter=separator, quotechar=quote, skipinitialspace=skip_space)


def known_columns(header: list[str]) -> list[str]:
    """The scrape column at each place, blank for any other; up to the last known one. A repeated name means its last."""
    named = [name if name in SCRAPE_COLUMNS and name not in header[i + 1:] else "" for i, name in enumerate(header)]
    while named and not named[-1]:
        named.pop()
    return named


def open_field_after(data: bytes, open_field: bool, dialect: Dialect) -> bool:
    """Whether a quoted field is open behind ``data``, which begins where a line does.

    A quote character opens a field only where a field begins; inside one, two of them stand for one.
    """
    separator, quote, skip_space = (re.escape(d).encode() if isinstance(d, str) else d for d in dialect)
    opening = re.compile(rb"(?:\A|[\r\n]|" + separator + rb")" + (b" *" if skip_space else b"") + quote)
    closing = re.compile(rb"(?:[^" + quote + rb"]++|" + quote * 2 + rb")*+" + quote)
    place = 0
    while found := (closing.match(data, place) if open_field else opening.search(data, place)):
        place, open_field = found.end(), not open_field
    return open_field


class ScrapeFile:
    """A file as its tasks see it: dialect, header, and the records of any range of bytes."""

    def __init__(self, path: str):
        self.files, self.path = open_filesystem(path)
        with self.files.open_input_stream(self.path) as stream:
            sample = codecs.getincrementaldecoder("utf-8")().decode(stream.read(4 * SAMPLE_CHARS))[:SAMPLE_CHARS]
        self.dialect = sniff_dialect(sample)
        with self._from(0) as (_, lines):
            self.columns = known_columns(next(records(lines, self.dialect), []))

    @contextmanager
    def _from(self, start: int) -> Iterator[tuple[list[int], Iterator[str]]]:
        """Where the next line begins, in a list of one, and the lines from ``start`` on."""
        with self.files.open_input_file(self.path) as file:
            file.seek(start)
            at = [start]

            def lines() -> Iterator[str]:
                with io.BufferedReader(_Raw(file), 1 << 20) as buffered:
                    for line in buffered:
                        at[0] += len(line)
                        # A line that only a carriage return ends is a line too.
                        yield from io.StringIO(line.decode("utf-8", "replace"), newline="")

            yield at, lines()

    def _line_start(self, place: int) -> int:
        """Where the first line begins that begins at ``place`` or behind it."""
        if not place:
            return 0
        with self.files.open_input_file(self.path) as file:
            file.seek(place - 1)
            with io.BufferedReader(_Raw(file), 1 << 16) as buffered:
                return place - 1 + len(buffered.readline())

    def open_after(self, start: int, stop: int) -> tuple[bool, bool]:
        """Whether a quoted field is open behind a range's lines: if none is before them, and if one is."""
        start, stop = self._line_start(start), self._line_start(stop)
        with self.files.open_input_file(self.path) as file:
            file.seek(start)
            data = file.read(stop - start)
        return open_field_after(data, False, self.dialect), open_field_after(data, True, self.dialect)

    def rows(self, start: int, stop: int, open_field: bool) -> Iterator[list[str]]:
        """Records that begin in a range's lines, without the header; blank lines are none."""
        begin, end = self._line_start(start), self._line_start(stop)
        if open_field:  # the record before goes on: it belongs to an earlier range
            with self._from(begin) as (at, lines):
                for line in lines:
                    begin, open_field = at[0], open_field_after(line.encode(), open_field, self.dialect)
                    if not open_field or begin >= end:
                        break
        with self._from(begin) as (at, lines):
            found = records(lines, self.dialect)
            if not start:
                next(found, None)
            while at[0] < end and (row := next(found, None)) is not None:
                if row:
                    yield row


class _Raw(io.RawIOBase):
    """What is left of an Arrow file, for Python's line reader."""

    def __init__(self, file):
        self.file = file

    def readable(self) -> bool:
        return True

    def readinto(self, target) -> int:
        data = self.file.read(len(target))
        target[:len(data)] = data
        return len(data)


def _problem(error: Exception) -> str:
    return f"{type(error).__name__}: {error}"


def ranges(files: DataFrame) -> DataFrame:
    """``path, start, stop, open_field`` of every range of the non-empty files of ``path, length``, dealt out to tasks.

    Ranges are few and tiny rows, which adaptive execution would all hand to one task: so their lengths are added up first, and
    there is a task for each range of a large file, and for each ``RANGE`` bytes of small ones; a few a core if there are as many.
    """
    files = files.filter("length > 0").select("path", "length")
    cut = files.withColumn("start", F.explode(F.expr(f"sequence(0L, length - 1, {RANGE}L)"))).withColumn(
        "stop", F.least("length", F.col("start") + RANGE))
    is_large = F.col("length") > RANGE
    found = files.agg(
        F.sum(F.when(is_large, F.ceil(F.col("length") / RANGE))).alias("ranges"), F.count_if(~is_large).alias("small"),
        F.sum(F.when(~is_large, F.col("length") + OPENING)).alias("small_bytes")).first()
    ranges_of_large = found["ranges"] or 1
    small_tasks = max(1, min(found["small"], max(
        4 * files.sparkSession.sparkContext.defaultParallelism, -(-(found["small_bytes"] or 0) // RANGE))))

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for path, start, stop in zip(batch["path"], batch["start"], batch["stop"]):
                try:
                    states = ScrapeFile(path).open_after(start, stop)
                except Exception:  # reported when its rows are read
                    states = (False, False)
                found.append((path, start, stop, *states))
            yield pd.DataFrame(found, columns=["path", "start", "stop", "after_closed", "after_open"])

    # Nothing is open where a file begins, so one range needs no look. A file's ranges, four values each, are gone through in order.
    large = cut.filter(is_large).repartition(ranges_of_large).mapInPandas(look, "path string, start long, stop long, after_closed boolean, after_open boolean")
    opened = large.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("start", "stop", "after_closed", "after_open"))).alias("parts")).select(
        "path", F.inline(F.expr("""aggregate(parts, cast(array() as array<struct<start:long,stop:long,open_field:boolean,after:boolean>>), (done, p) -> concat(done, array(
            named_struct('start', p.start, 'stop', p.stop, 'open_field', coalesce(try_element_at(done, -1).after, false), 'after',
                if(coalesce(try_element_at(done, -1).after, false), p.after_open, p.after_closed)))))"""))).drop("after")
    return cut.filter(~is_large).select("path", "start", "stop", F.lit(False).alias("open_field")).repartition(
        small_tasks).unionByName(opened.repartition(ranges_of_large))


def _parsed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [part.split()[0] for part in _RAW.split(", ")]
    for batch in batches:
        held: list[tuple] = []
        for path, start, stop, open_field in zip(*[batch[c] for c in ("path", "start", "stop", "open_field")]):
            try:
                file = ScrapeFile(path)
            except Exception as error:  # any file may be gone or not be text; the others still count
                held.append((*[None] * len(SCRAPE_COLUMNS), path, start, -1, _problem(error)))
                continue
            if not file.columns:
                continue
            at = {name: i for i, name in enumerate(file.columns) if name}
            places = [at.get(name, -1) for name in SCRAPE_COLUMNS]
            # A column that a file lacks counts as blank, as one does that a short row lacks.
            for order, row in enumerate(file.rows(start, stop, open_field)):
                held.append((*["" if not 0 <= i < len(row) else row[i] for i in places], path, start, order, None))
                if len(held) >= ROWS:
                    yield pd.DataFrame(held, columns=names)
                    held = []
        if held:
            yield pd.DataFrame(held, columns=names)


def scan_files(files: DataFrame) -> DataFrame:
    """Raw text rows of all files of ``path, length``, with ``path``, ``source_file``, ``part_start`` and ``row_order``.

    A file that can't be read is one row with a ``problem`` instead, once for each of its ranges.
    """
    return ranges(files).mapInPandas(_parsed, _RAW).withColumn("source_file", F.element_at(F.split("path", "/"), -1))


def unreadable_files(raw: DataFrame) -> DataFrame:
    return raw.filter("problem is not null").groupBy("path").agg(F.min("problem").alias("problem"))


def readable_rows(raw: DataFrame) -> DataFrame:
    return raw.filter("problem is null")


def stores_and_problems(raw: DataFrame, ingested_at: Column) -> DataFrame:
    """Typed stores as ``typed_scrapes`` has them, and every row with a ``problem``; with ``path`` and ``problem``.

    The task that parses a range drops all but its last row of each store, so no task sorts more than it has parsed.
    """
    order = ["source_file", "part_start", "row_order"]
    rows = normalize_listings(raw, ingested_at, F.col("source_file"), keep=[*order[1:], "path", "problem"])
    own = F.when(F.col("problem").isNull(), F.col("store_id")).otherwise(F.concat_ws("#", "path", "part_start"))
    return last_per_key(rows.withColumn("own", own), "own", order).drop("own", *order[1:])


def typed_scrapes(raw: DataFrame, ingested_at: Column) -> DataFrame:
    """Typed stores, one row per store: a later row of a file beats an earlier one, a later file's an earlier file's."""
    return stores_and_problems(readable_rows(raw), ingested_at).drop("path", "problem")


def read_scrapes(files: DataFrame, ingested_at: Column) -> DataFrame:
    return typed_scrapes(scan_files(files), ingested_at)
