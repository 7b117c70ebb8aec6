"""Staged JSON API pages: envelope extraction and page-chain audit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ingestry.schema import RECORD_LIST_KEYS as RECORD_KEYS


def _list_sql() -> str:
    """SQL: the record list of the parsed body `_v`, null if there is none."""
    lists = ", ".join(
        ["try_variant_get(_v, '$', 'array<variant>')"]
        + [f"try_variant_get(_v, '$.{k}', 'array<variant>')" for k in RECORD_KEYS]
    )
    return f"coalesce({lists})"


def staged_pages(raw: DataFrame, *, body: str = "body", name: str = "page_file") -> DataFrame:
    """One row per page from one parse of its body: number and links where it has them, and
    its records (objects of the list, as JSON text; null if there is no list)."""
    return raw.selectExpr(f"`{name}` AS page_file", f"try_parse_json(`{body}`) AS _v").selectExpr(
        "page_file",
        "try_variant_get(_v, '$.page', 'bigint') AS page",
        "try_variant_get(_v, '$.next_page', 'string') AS next_page",
        "nullif(coalesce(try_variant_get(_v, '$.next', 'string'), try_variant_get(_v, '$.next_url', 'string')), '') AS next_url",
        f"transform(filter({_list_sql()}, x -> schema_of_variant(x) LIKE 'OBJECT%'), x -> to_json(x)) AS records",
    )


def extract_records(
    pages: DataFrame, *, body: str = "body", keep: tuple[str, ...] = (), with_position: bool = False
) -> DataFrame:
    """The record list of each page as rows (`item` VARIANT) plus `page_error`.

    A top-level array, else the first of data/students/items/results whose value
    IS a list (an object under `data` is passed over); non-object items are dropped.
    A page without a list yields one row with `page_error` set (the run must fail).
    """
    ks = [f"`{k}`" for k in keep]
    parsed = pages.selectExpr(*ks, f"try_parse_json(`{body}`) AS _v").selectExpr(
        *ks, f"{_list_sql()} AS _items"
    )
    pos = ["item_pos"] if with_position else []
    errors = parsed.filter("_items IS NULL").selectExpr(
        *ks, *(["CAST(NULL AS INT) AS item_pos"] if with_position else []),
        "CAST(NULL AS VARIANT) AS item", "'could not find a record list in the API response' AS page_error",
    )
    items = (
        parsed.filter("_items IS NOT NULL")
        .selectExpr(*ks, "posexplode(_items) AS (item_pos, item)")
        .filter("schema_of_variant(item) LIKE 'OBJECT%'")
        .selectExpr(*ks, *pos, "item", "CAST(NULL AS STRING) AS page_error")
    )
    return items.unionByName(errors)


def chain_violations(pages: DataFrame, *, run: str = "run_id", page: str = "page") -> DataFrame:
    """Staged pages whose links would make the live pager fail.

    next target = page number from `next_url` (preferred) else `next_page`;
    non-numeric, non-advancing, repeated page numbers and links to a page that
    was never staged are violations. Aggregates and anti joins, no per-run collect.
    """
    resolved = pages.selectExpr(
        f"`{run}` AS run_id",
        f"`{page}` AS page",
        "next_page",
        "coalesce(try_cast(nullif(regexp_extract(next_url, '[?&]page=([0-9]+)', 1), '') AS BIGINT), "
        "try_cast(next_page AS BIGINT)) AS next_target",
        "next_url IS NULL AND next_page IS NOT NULL AND NOT next_page RLIKE '^[0-9]+$' AS bad_number",
    )
    bad = resolved.filter("bad_number").selectExpr("run_id", "page", "'non_numeric_next' AS problem")
    back = resolved.filter("NOT bad_number AND next_target <= page").selectExpr(
        "run_id", "page", "'non_advancing_next' AS problem"
    )
    repeated = (
        resolved.groupBy("run_id", "page")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .selectExpr("run_id", "page", "'repeated_page' AS problem")
    )
    present = resolved.selectExpr("run_id", "page AS next_target")
    missing = (
        resolved.filter("next_target IS NOT NULL AND next_target > page")
        .join(present, ["run_id", "next_target"], "left_anti")
        .selectExpr("run_id", "page", "'missing_page' AS problem")
    )
    return bad.unionByName(back).unionByName(repeated).unionByName(missing)
