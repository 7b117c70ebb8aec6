"""The shared per-batch core: classify -> split -> dedupe -> canonical rows + quarantine.

One declarative plan; nothing is collected. `Batch` builds each branch only when
asked, so a query pays only for the plan it uses. Callers that reuse several
branches in one job write `classified` to the shared folder first (see jobs).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ingestry import schema as S
from ingestry.functions import clean as C
from ingestry.functions import payload as P
from ingestry.operators import dedupe as D
from ingestry.operators import rules as R

QUARANTINE_COLUMNS = (
    "source_system",
    "source_object",
    "chunk_index",
    "row_ordinal",
    "student_id",
    R.REASON,
    R.DETAIL,
    R.FIELD,
    "record",
)

BOOKKEEPING = (S.FILE_ORDINAL, S.SOURCE_OBJECT, S.CHUNK_INDEX, S.ROW_ORDINAL, "_feed")


class Batch:
    """Lazy views of one batch of source records."""

    def __init__(
        self,
        records: DataFrame,
        *,
        as_of: str,
        source_system: str = S.CSV_SOURCE_SYSTEM,
        file_columns: Sequence[str] = S.CANONICAL_FIELDS,
        payload_sql: str | None = None,
        record_sql: str | None = None,
        missing_sql: str | None = None,
        scope: Sequence[str] = (S.SOURCE_OBJECT, S.CHUNK_INDEX),
        classified: DataFrame | None = None,
        marked: DataFrame | None = None,
    ) -> None:
        self.records = records
        self.as_of = as_of
        quoted = source_system.startswith("`") or source_system.startswith("'")
        self.system_sql = source_system if quoted else C.sql_str(source_system)
        self.cols = [c for c in file_columns if c in records.columns]
        self.payload_sql = payload_sql or P.raw_payload_sql(self.cols)
        line = "_source_line" if "_source_line" in records.columns else S.ROW_ORDINAL
        self.record_sql = record_sql or P.record_sql(self.payload_sql, line)
        self.missing_sql = missing_sql
        self.scope = tuple(scope)
        if classified is not None:
            self.__dict__["classified"] = classified
        if marked is not None:  # e.g. the marked batch staged once by a job
            self.__dict__["marked"] = marked

    @cached_property
    def classified(self) -> DataFrame:
        return R.classify(self.records, as_of=self.as_of, file_columns=self.cols, missing_sql=self.missing_sql)

    @cached_property
    def valid(self) -> DataFrame:
        return R.split(self.classified)[0]

    @cached_property
    def rejected(self) -> DataFrame:
        return R.split(self.classified)[1]

    @cached_property
    def marked(self) -> DataFrame:
        """Dedupe windows over ALL classified rows, validity as an extra partition key
        (rejects never mix with valid rows). Rejects, survivors and losers are then
        filters above one window, so they share its input exchange and the cascade
        runs once per plan. The filters test `reason_code` (not the partition key) so
        they are not pushed below the window."""
        flagged = self.classified.selectExpr("*", f"{R.REASON} IS NULL AS _valid")
        return D.mark_chunk_duplicates(flagged, scope=(*self.scope, "_valid"))

    @cached_property
    def survivors(self) -> DataFrame:
        return D.survivors(self.marked.filter(f"{R.REASON} IS NULL"))

    @cached_property
    def losers(self) -> DataFrame:
        return D.losers(self.marked.filter(f"{R.REASON} IS NULL"))

    @cached_property
    def students(self) -> DataFrame:
        keep = [f"`{c}`" for c in BOOKKEEPING if c in self.records.columns]
        return self.survivors.filter(f"({P.transform_failure_sql()}) IS NULL").selectExpr(
            *keep,
            *P.CANONICAL_SQL,
            f"{self.system_sql} AS source_system",
            f"{self.payload_sql} AS raw_payload",
        )

    def staged(self, path: str) -> Batch:
        """Write the marked batch once (all columns) and return a Batch reading it:
        students, rejects and losers are then cheap filters of one stored table. What the job
        must know of the batch as a whole is observed in that write (`observed`): its rows, and
        the newest time of a valid row (A4), null if there is none."""
        seen = Observation()
        valid = f"{R.REASON} IS NULL AND {D.KEPT_AT} IS NULL AND ({P.transform_failure_sql()}) IS NULL"
        watched = self.marked.observe(
            seen, F.count(F.lit(1)).alias("rows"), F.max(F.expr(f"CASE WHEN {valid} THEN unix_micros(_ts) END")).alias("newest")
        )
        watched.write.mode("overwrite").parquet(path)
        stored = self.marked.sparkSession.read.parquet(path)
        batch = Batch(
            self.records,
            as_of=self.as_of,
            source_system=self.system_sql,
            file_columns=self.cols,
            payload_sql=self.payload_sql,
            record_sql=self.record_sql,
            missing_sql=self.missing_sql,
            scope=self.scope,
            marked=stored,
        )
        batch.observed = seen.get
        return batch

    def _quarantine_rows(self, df: DataFrame) -> DataFrame:
        return df.selectExpr(
            f"{self.system_sql} AS source_system",
            f"`{S.SOURCE_OBJECT}` AS source_object",
            f"`{S.CHUNK_INDEX}` AS chunk_index",
            f"`{S.ROW_ORDINAL}` AS row_ordinal",
            ("CAST(student_id AS STRING)" if "student_id" in df.columns else "CAST(NULL AS STRING)")
            + " AS student_id",
            R.REASON,
            R.DETAIL,
            R.FIELD,
            f"{self.record_sql} AS record",
        )

    @cached_property
    def quarantine(self) -> DataFrame:
        """Rule rejects + duplicate losers + transform failures, as ONE filtered
        projection of the marked batch (one pass, one exchange)."""
        tf = P.transform_failure_sql()
        dup_detail = D.loser_detail_sql()
        rows = self.marked.filter(
            f"{R.REASON} IS NOT NULL OR {D.KEPT_AT} IS NOT NULL OR ({tf}) IS NOT NULL"
        ).selectExpr(
            *[f"`{c}`" for c in self.marked.columns if c not in (R.REASON, R.DETAIL, R.FIELD)],
            f"CASE WHEN {R.REASON} IS NOT NULL THEN {R.REASON} WHEN {D.KEPT_AT} IS NOT NULL "
            f"THEN '{S.DUPLICATE_STUDENT_ID}' ELSE '{S.TRANSFORM_FAILED}' END AS {R.REASON}",
            f"CASE WHEN {R.REASON} IS NOT NULL THEN {R.DETAIL} WHEN {D.KEPT_AT} IS NOT NULL "
            f"THEN {dup_detail} ELSE {tf} END AS {R.DETAIL}",
            f"CASE WHEN {R.REASON} IS NOT NULL THEN {R.FIELD} WHEN {D.KEPT_AT} IS NOT NULL "
            f"THEN 'student_id' END AS {R.FIELD}",
        )
        return self._quarantine_rows(rows)


def process(records: DataFrame, **kwargs) -> Batch:
    """Validate, dedupe within `scope`, project survivors, and gather every reject."""
    return Batch(records, **kwargs)
