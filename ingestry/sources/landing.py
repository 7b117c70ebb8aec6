"""Landing-area listing, eligibility, version pinning and upload naming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ingestry import schema as S
from ingestry.sources import files


def list_objects(spark: SparkSession, root: str) -> DataFrame:
    """Recursive listing (path, name relative to root, size, version, time), objects of zero
    bytes included. The driver sees the first level of folders only; tasks list what is below.
    version = size-time."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    top = str(fs.makeQualified(path).toString())
    folders = [str(s.getPath().toString()) for s in fs.listStatus(path) if s.isDirectory()]
    prefixes = [(top, False)] + [(f, True) for f in folders if not f.rpartition("/")[2].startswith(("_", "."))]
    rows = spark.createDataFrame(prefixes, "prefix string, deep boolean")
    width = min(len(prefixes), spark.sparkContext.defaultParallelism)
    found = rows.repartition(width, "prefix").mapInArrow(files.listed, files.LISTED)
    return described(found.selectExpr("path", "length", "timestamp_micros(modified) AS modificationTime"), top)


def described(objects: DataFrame, root: str) -> DataFrame:
    """path, name below root, size, version and time of listed (or streamed) objects."""
    df = objects.select("path", "length", "modificationTime")
    base = root.rstrip("/")
    return df.selectExpr(
        "path",
        f"regexp_replace(path, concat('^.*?', {_sql(base.split(':', 1)[-1].lstrip('/'))}, '/?'), '') AS name",
        "length AS size",
        "concat(CAST(length AS STRING), '-', CAST(unix_millis(modificationTime) * 1000 AS STRING)) AS version",
        "modificationTime AS modified_at",
    )


def _sql(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def is_csv_sql(name: str) -> str:
    """Case-insensitive `.csv` suffix."""
    return f"endswith(lower({name}), '.csv')"


def upload_triage(candidates: DataFrame, *, name: str, now_sql: str, unique_id_sql: str) -> DataFrame:
    """K6: safe object name `uploads/{yyyyMMddTHHmmssZ}-{id}-{safe}` or a refusal message."""
    base = f"regexp_extract(regexp_replace(replace(`{name}`, '\\\\', '/'), '/+$', ''), '([^/]*)$', 1)"
    safe = f"btrim(regexp_replace({base}, '[^A-Za-z0-9._-]+', '-'), '.-_')"
    df = candidates.selectExpr("*", f"{safe} AS safe_name")
    df = df.selectExpr("*", "lower(regexp_extract(safe_name, '^.+(\\\\.[^.]*)$', 1)) AS extension")

    refused = ((S.EXCEL_SUFFIXES, S.EXCEL_REFUSED), ((".pdf",), S.PDF_REFUSED), (S.IMAGE_SUFFIXES, S.IMAGE_REFUSED), (S.WORD_SUFFIXES, S.WORD_REFUSED))
    whens = " ".join(
        f"WHEN extension IN ({', '.join(map(_sql, suffixes))}) THEN {_sql(text)}" for suffixes, text in refused
    )
    message = (
        f"CASE WHEN safe_name = '' THEN {_sql(S.EMPTY_NAME)} WHEN extension = '.csv' THEN NULL {whens} ELSE {_sql(S.OTHER_REFUSED)} END"
    )
    return df.selectExpr("*", f"{message} AS message").selectExpr(
        "*",
        "message IS NULL AS accepted",
        f"CASE WHEN message IS NULL THEN concat('uploads/', date_format({now_sql}, "
        f"'yyyyMMdd\\'T\\'HHmmss\\'Z\\''), '-', {unique_id_sql}, '-', safe_name) END AS object_name",
    )


def archive(moves: DataFrame, processed_root: str) -> DataFrame:
    """K5: move committed files landing -> processed, only if unchanged since listing.

    `moves` are (path, name, version). Runs after the commit, in tasks; a row for each file says
    whether it is in its new place now. A failed move never fails the job (the ledger, not the
    move, decides what is read again), and a task that runs twice finds its moves done.
    """
    spark = moves.sparkSession
    dealt = moves.select("path", "name", "version").repartition(spark.sparkContext.defaultParallelism, "path")
    return dealt.mapInArrow(files.mover(processed_root), files.MOVED)
