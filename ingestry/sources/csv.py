"""CSV landing files (S3, S3a-S3g): every file is cut into byte ranges, every range is one task's.

Landing files differ in header, width, line endings and shape within a file, which one
`spark.read.csv` schema can't express without losing rows. So tasks parse them, into rows of
one schema:

    path, nth, _row_ordinal, _source_line, _src (header name -> value), _extra_columns

and one closing row per range with its number of rows, its error, if any, and the digest of
its bytes. A line of a CSV file may lie inside a quoted value, so where a range's first record
begins depends on all that is before it. That is found in two steps:

1. Each range of a file that has several (by `split` bytes) works out what it does to the
   parser's state, for both states that a line can begin in (inside quotes or not), and counts
   its lines; a line belongs to the range in which it begins.
2. These effects are composed over the ranges of a file, one narrow row each. Then each range
   skips to its first record border, parses the records that begin in it, and reads on where
   the last one ends beyond it.

A file of one range is not read twice. Numbers within the file are sums over the ranges before.
A file that can't be read to its end, or that isn't the listed version, fails alone: rows before
the fault count. Only a batch of rows is in memory at a time (step 1: a range). Fields of more
than 131,072 characters are a fault, as Python's reader sets that limit. Source columns stay
inside `_src`, so no header name can collide with a column of ours.
"""

from __future__ import annotations

import csv
import hashlib
import io
import re
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ingestry import schema as S
from ingestry.sources.files import filesystem
from ingestry.sources.files import version as object_version

# The functions below travel to the workers by value: they need no copy of the package there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BATCH_ROWS = 2000
BLOCK = 1 << 18
SPLIT_BYTES = 32 << 20
TASK_BYTES = 32 << 20  # ranges are dealt over so many tasks that each has about as much
CHANGED = "the source object changed after it was listed"
ROW_SCHEMA = (
    f"path string, nth int, {S.ROW_ORDINAL} long, _source_line long, _src map<string,string>, "
    f"{S.EXTRA_COLUMNS} array<string>, _rows long, _usable long, _error string, _digest string"
)
_KINDS = (
    pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.map_(pa.string(), pa.string()),
    pa.list_(pa.string()), pa.int64(), pa.int64(), pa.string(), pa.string(),
)
_NAMES = ("path", "nth", S.ROW_ORDINAL, "_source_line", "_src", S.EXTRA_COLUMNS, "_rows", "_usable", "_error", "_digest")
RANGE = "path string, version string, nth int, ranges int, start long, end long"
EFFECT = f"{RANGE}, first long, last long, open boolean, shut boolean, lines long, digest string, problem string"

_LINE = re.compile(rb"[^\r\n]*+(?:\r\n|\r|\n)")
_BREAK = re.compile(rb"\r\n|\r|\n")
# A quoted value and its closing quote, if there is one; quotes elsewhere mean nothing.
_QUOTED = re.compile(rb'(?<=[,\r\n])"[^"]*+(?:""[^"]*+)*+("?)')
_REST = re.compile(rb'[^"]*+(?:""[^"]*+)*+("?)')
_BOM = b"\xef\xbb\xbf"


def assign_chunks(df: DataFrame, *, chunk_size: int, ordinal: str = S.ROW_ORDINAL) -> DataFrame:
    """S3g: consecutive groups of `chunk_size` rows per file, numbered from 1."""
    if chunk_size < 1:
        raise ValueError("chunk_size must be at least 1")
    return df.withColumn(
        S.CHUNK_INDEX, (F.floor((F.col(ordinal) - 1) / chunk_size) + 1).cast("bigint")
    )


def _named(names: list[str], row: list[str]) -> tuple[dict[str, str | None], list[str] | None]:
    """Values by name (of columns with one name the last counts; missing trailing values are
    null) and surplus values."""
    values: dict[str, str | None] = dict(zip(names, row))
    for name in names[len(row):]:
        values[name] = None
    return values, row[len(names):] or None


def _header(reader) -> list[str]:
    return [name.strip().lower() for name in next(reader, [])]


def parse(raw) -> Iterator[tuple[int, dict[str, str | None], list[str] | None]]:
    """Line number, values by name and surplus values of each data row of a byte stream.

    BOM removed, header trimmed and lower-cased; blank lines are no rows. Bytes that aren't
    UTF-8 raise.
    """
    reader = csv.reader(io.TextIOWrapper(raw, encoding="utf-8-sig", newline=""))
    names = _header(reader)
    for row in reader:
        if row:
            yield reader.line_num, *_named(names, row)


BODY_SCHEMA = "source_object string, row_ordinal long, src map<string,string>, extra array<string>"


def parse_bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches (name, body) of whole files held in rows, to their rows: one body and a batch of
    rows are Python objects at a time, however many files a batch holds."""
    names = ("source_object", "row_ordinal", "src", "extra")
    kinds = (pa.string(), pa.int64(), pa.map_(pa.string(), pa.string()), pa.list_(pa.string()))
    rows = []
    for batch in batches:
        for name, body in zip(batch.column(0), batch.column(1)):
            name = name.as_py()
            for n, (_, values, extra) in enumerate(parse(io.BytesIO(body.as_py())), 1):
                rows.append((name, n, list(values.items()), extra))
                if len(rows) >= BATCH_ROWS:
                    yield _table(rows, names, kinds)
                    rows = []
    if rows:
        yield _table(rows, names, kinds)


def ends_in_quotes(data: bytes, begins_in_quotes: bool) -> bool:
    """Whether the line behind `data`, which are whole lines, begins inside a quoted value."""
    at = 0
    if not begins_in_quotes and data[:1] == b'"':
        begins_in_quotes, at = True, 1
    if begins_in_quotes:
        rest = _REST.match(data, at)
        if not rest[1]:
            return True
        at = rest.end()
    return any(not value[1] for value in _QUOTED.finditer(data, at))


def line_start(file, at: int, size: int) -> int:
    """The first line start at or after a position."""
    if at == 0:
        return 0
    file.seek(at - 1)
    begin, held = at - 1, b""
    while block := file.read(BLOCK):
        found = _BREAK.search(held + block)
        if found and not (found[0] == b"\r" and found.end() == len(held + block)):
            return begin + found.end()
        held = b"\r" if found else b""
        begin = file.tell() - len(held)
    return size


class Lines:
    """The lines of a file from a line start on, decoded one by one; `at` is where the next one
    begins. `quoted` puts a quote in front of the first, so that a reader takes up the value
    that it continues."""

    def __init__(self, file, at: int, *, quoted: bool = False, digest=None) -> None:
        self._file, self.at, self._mark, self._digest = file, at, '"' if quoted else "", digest
        self._lines: Iterator[bytes] = iter(())
        self._rest = b""
        file.seek(at)

    def _block(self) -> bytes:
        block = self._file.read(BLOCK)
        if self._digest is not None:
            self._digest.update(block)
        return block

    def __iter__(self) -> Lines:
        return self

    def __next__(self) -> str:
        line = next(self._lines, None)
        while line is None:
            block = self._block()
            data = self._rest + block
            lines = _LINE.findall(data)
            self._rest = data[sum(map(len, lines)):]
            if not block:
                if not data:
                    raise StopIteration
                lines, self._rest = [*lines, self._rest] if self._rest else lines, b""
            elif lines and not self._rest and lines[-1].endswith(b"\r"):  # its \n may follow
                self._rest = lines.pop()
            self._lines = iter(lines)
            line = next(self._lines, None)
        begin, mark = self.at, self._mark
        self.at += len(line)
        self._mark = ""
        return mark + (line.removeprefix(_BOM) if begin == 0 else line).decode()

    def drain(self) -> None:
        while self._block():
            pass


def _said(failure: Exception) -> str:
    return CHANGED if str(failure) == CHANGED else f"{type(failure).__name__}: {failure}"


def _table(rows: list[tuple], names, kinds) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(zip(*rows), kinds)], names=list(names))


def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 1; a file of one range is left to step 2."""
    names = [c.split()[0] for c in EFFECT.split(", ")]
    kind = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_()}
    kinds = [kind[c.split()[1]] for c in EFFECT.split(", ")]
    for batch in batches:
        for path, version, nth, ranges, start, end in zip(*(c.to_pylist() for c in batch.columns)):
            effect = (0, end, False, True, 0, None, None)
            if ranges > 1:
                try:
                    files, inner = filesystem(path)
                    if object_version(files, inner) != version:
                        raise RuntimeError(CHANGED)
                    size = int(version.split("-")[0])
                    with files.open_input_file(inner) as file:
                        first, last = line_start(file, start, size), line_start(file, end, size)
                        file.seek(start)
                        data = file.read(max(end, last) - start)
                    lines = data[first - start : last - start] if first < last else b""
                    effect = (
                        first, last, ends_in_quotes(lines, False), ends_in_quotes(lines, True), len(_BREAK.findall(lines)),
                        hashlib.sha256(data[: end - start]).hexdigest(), None,
                    )
                except Exception as failure:  # noqa: BLE001 - step 2 says so in the closing row
                    effect = (None, None, False, True, 0, None, _said(failure))
            yield _table([(path, version, nth, ranges, start, end, *effect)], names, kinds)


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 2: rows and the closing row of each range."""
    for batch in batches:
        for path, version, nth, ranges, first, last, quoted, lines_before, digest, problem in zip(*(c.to_pylist() for c in batch.columns)):
            n, usable, error, rows = 0, 0, None, []
            try:
                if problem:
                    raise RuntimeError(problem)
                files, inner = filesystem(path)
                if object_version(files, inner) != version:
                    raise RuntimeError(CHANGED)
                with files.open_input_file(inner) as file:
                    whole = hashlib.sha256() if ranges == 1 else None
                    names = _header(csv.reader(Lines(file, 0))) if first else None
                    lines = Lines(file, first, quoted=quoted, digest=whole)
                    try:
                        reader = csv.reader(lines)
                        if names is None:
                            names = _header(reader)
                        elif quoted and first < last:
                            next(reader, None)  # the end of a record that began before
                        while lines.at < last and (row := next(reader, None)) is not None:
                            if row:
                                n += 1
                                values, extra = _named(names, row)
                                rows.append((path, nth, n, lines_before + reader.line_num, list(values.items()), extra, None, None, None, None))
                                if len(rows) >= BATCH_ROWS:
                                    yield _table(rows, _NAMES, _KINDS)
                                    rows = []
                    finally:
                        if whole is not None:
                            lines.drain()
                            digest = whole.hexdigest()
                usable = n
                if object_version(files, inner) != version:
                    raise RuntimeError(CHANGED)
            except Exception as failure:  # noqa: BLE001 - the file fails alone; its closing row says why
                error = problem or _said(failure)
                usable = 0 if error == CHANGED else n
            rows.append((path, nth, None, None, None, None, n, usable, error, digest))
            yield _table(rows, _NAMES, _KINDS)


def byte_ranges(files: DataFrame, split: int = SPLIT_BYTES) -> DataFrame:
    """The ranges of the listed files (`path`, `version`); an empty file has one."""
    sized = files.selectExpr("path", "version", "CAST(split(version, '-')[0] AS BIGINT) AS _size")
    cut = sized.selectExpr("*", f"CAST(greatest(ceil(_size / {split}), 1) AS INT) AS ranges")
    return cut.selectExpr("*", "explode(sequence(0, ranges - 1)) AS nth").selectExpr(
        "path", "version", "nth", "ranges", f"CAST(nth AS BIGINT) * {split} AS start", f"least((nth + 1L) * {split}, _size) AS end"
    )


def read_files(files: DataFrame, *, split: int | None = None) -> DataFrame:
    """Rows and closing rows (`_row_ordinal` null) of the ranges of the listed files (`path`,
    `version`); `numbered` and `closings` make whole files of them."""
    ranges = byte_ranges(files, split or SPLIT_BYTES)
    size = ranges.agg(F.count("*").alias("n"), F.sum(F.col("end") - F.col("start")).alias("bytes")).first()
    width = files.sparkSession.sparkContext.defaultParallelism
    tasks = max(-(-(size["bytes"] or 0) // TASK_BYTES), min(size["n"], width), 1)
    # Ranges of a hash, not the hash itself: every task gets as many, and neighbours part.
    dealt = F.xxhash64("path", "nth")
    effects = ranges.repartitionByRange(tasks, dealt).mapInArrow(_effects, EFFECT)
    # A range behind which the state is the same whatever it was before, and how often the
    # state was turned round since the last such range.
    before = "OVER (PARTITION BY path ORDER BY nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    turns = effects.selectExpr(
        "*", "CASE WHEN open = shut THEN open END AS _fixed", "CASE WHEN open AND NOT shut THEN 1 ELSE 0 END AS _turn"
    ).selectExpr(
        "*", "sum(_turn) OVER (PARTITION BY path ORDER BY nth ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS _turns"
    )
    placed = turns.selectExpr(
        "*",
        f"last_value(CASE WHEN _fixed IS NOT NULL THEN struct(_fixed AS state, _turns AS turns) END, true) {before} AS _since",
        f"coalesce(sum(lines) {before}, 0) AS lines_before",
    ).selectExpr(
        "path", "version", "nth", "ranges", "first", "last",
        "coalesce(_since.state, false) <> (pmod(_turns - _turn - coalesce(_since.turns, 0), 2) = 1) AS quoted",
        "lines_before", "digest", "problem",
    )
    return placed.repartitionByRange(tasks, dealt).mapInArrow(_records, ROW_SCHEMA)


def numbered(pieces: DataFrame) -> DataFrame:
    """The data rows of `read_files` with their ordinals in the file. The first range of a file
    has no rows before it; what is before the others, one narrow row for each `split` bytes, goes
    to the rows, which stay where they are."""
    closing = pieces.filter(f"{S.ROW_ORDINAL} IS NULL").selectExpr(
        "path", "nth",
        "sum(_rows) OVER (PARTITION BY path ORDER BY nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS _before",
    )
    rows = pieces.filter(f"{S.ROW_ORDINAL} IS NOT NULL").join(F.broadcast(closing.filter("nth > 0")), ["path", "nth"], "left")
    return rows.selectExpr(
        "path", f"{S.ROW_ORDINAL} + coalesce(_before, 0) AS {S.ROW_ORDINAL}", "_source_line", "_src", S.EXTRA_COLUMNS
    )


def closings(pieces: DataFrame, *, split: int | None = None) -> DataFrame:
    """One row a file: its rows, the rows before its first fault, that fault, and the digest of
    its bytes (of the ranges' digests, so it names their size). Bounded by a file's ranges."""
    ranges = pieces.filter(f"{S.ROW_ORDINAL} IS NULL").groupBy("path").agg(
        F.sort_array(F.collect_list(F.struct("nth", "_rows", "_usable", "_error", "_digest"))).alias("_r")
    )
    return ranges.selectExpr(
        "path", "_r", f"coalesce(get(filter(_r, x -> x._error = '{CHANGED}'), 0), get(filter(_r, x -> x._error IS NOT NULL), 0)) AS _bad",
    ).selectExpr(
        "path",
        "aggregate(_r, 0L, (s, x) -> s + x._rows) AS _rows",
        f"CASE WHEN _bad IS NULL THEN aggregate(_r, 0L, (s, x) -> s + x._rows) WHEN _bad._error = '{CHANGED}' THEN 0L "
        "ELSE aggregate(filter(_r, x -> x.nth < _bad.nth), _bad._usable, (s, x) -> s + x._rows) END AS _usable",
        "_bad._error AS _error",
        f"CASE WHEN forall(_r, x -> x._digest IS NOT NULL) THEN concat('{split or SPLIT_BYTES}:', "
        "sha2(array_join(transform(_r, x -> x._digest), ''), 256)) END AS _digest",
    )


def with_fields(rows: DataFrame) -> DataFrame:
    """The canonical fields as columns beside `_src`; absent ones are null."""
    return rows.selectExpr("*", *[f"_src['{f}'] AS {f}" for f in S.CANONICAL_FIELDS], f"true AS {S.IS_CSV}")


def read_landing(
    spark: SparkSession, listing: DataFrame, *, chunk_size: int = S.DEFAULT_CHUNK_SIZE, split: int = SPLIT_BYTES
) -> DataFrame:
    """Data rows of the listed files with file name, ordinal and chunk. Numbering parses once
    more for the ranges' row counts; a job stages `read_files` instead."""
    rows = numbered(read_files(listing, split=split))
    names = listing.select("path", F.col("name").alias(S.SOURCE_OBJECT))
    return assign_chunks(with_fields(rows).join(names, "path"), chunk_size=chunk_size)


def eligible_files(spark: SparkSession, root: str) -> DataFrame:
    """S1 + S2: the CSV objects under `root`, empty ones included."""
    from ingestry.sources.landing import is_csv_sql, list_objects

    return list_objects(spark, root).filter(is_csv_sql("name"))
