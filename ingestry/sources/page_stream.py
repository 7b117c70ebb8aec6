"""Staged API pages as a streaming source (Python Data Source API).

A folder holds one JSON body a page, with the page's number as the digits of its file name; a
client that pages through the API puts them there. An offset is the number of pages read, so a
restarted stream goes on behind the last committed page and repeats none. Every page is one
partition: tasks read and parse them side by side.

Pages are offered up to the first number that is missing, so a page that arrives late holds
back those behind it instead of being passed over. A chain that can't be followed fails the
query: a body without a record list, a number in the body that isn't the file's, a next link
that doesn't lead to the following page, pages behind one that says it is the last.
"""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from ingestry.schema import RECORD_LIST_KEYS
from ingestry.sources.files import filesystem

cloudpickle.register_pickle_by_value(sys.modules[__name__])

NAME = "staged_pages"
SCHEMA = "page long, item_pos int, payload string"
_NUMBER = re.compile(r"([0-9]+)\.json$")


class BrokenChain(RuntimeError):
    """The pages can't be followed from one to the next."""


class Page(InputPartition):
    def __init__(self, path: str, number: int, followed: bool) -> None:
        self.path, self.number, self.followed = path, number, followed


def numbered_files(root: str) -> dict[int, str]:
    from pyarrow import fs

    files, inner = filesystem(root)
    found = files.get_file_info(fs.FileSelector(inner, allow_not_found=True))
    scheme = root[: len(root) - len(inner)] if root.endswith(inner) else ""
    return {int(m[1]): scheme + f.path for f in found if f.type == fs.FileType.File and (m := _NUMBER.search(f.base_name))}


def records(body) -> list | None:
    if isinstance(body, list):
        return body
    lists = (body.get(k) for k in RECORD_LIST_KEYS) if isinstance(body, dict) else ()
    return next((x for x in lists if isinstance(x, list)), None)


def next_number(body) -> int | None:
    """The number that the body's links lead to; an URL counts before a bare number."""
    if not isinstance(body, dict):
        return None
    link = body.get("next") or body.get("next_url")
    found = re.search(r"[?&]page=([0-9]+)", str(link)) if link else None
    if found:
        return int(found[1])
    if body.get("next_page") is None:
        return None
    if not re.fullmatch(r"[0-9]+", str(body["next_page"])):
        raise BrokenChain(f"next page {body['next_page']!r} is not a number")
    return int(body["next_page"])


def checked(body, page: Page) -> list:
    own = body.get("page") if isinstance(body, dict) else None
    if own is not None and own != page.number:
        raise BrokenChain(f"page {page.number}: its body says {own}")
    following = next_number(body)
    if following is not None and following != page.number + 1:
        raise BrokenChain(f"page {page.number}: its next page is {following}")
    linked = isinstance(body, dict) and any(k in body for k in ("next", "next_url", "next_page"))
    if linked and following is None and page.followed and not (body.get("next") or body.get("next_url")):
        raise BrokenChain(f"page {page.number}: it is the last, and others follow")
    found = records(body)
    if found is None:
        raise BrokenChain(f"page {page.number}: could not find a record list in the API response")
    return found


class PageStream(DataSourceStreamReader):
    def __init__(self, root: str, first: int) -> None:
        self._root, self._first = root, first

    def initialOffset(self) -> dict:
        return {"pages": 0}

    def latestOffset(self) -> dict:
        there, end = numbered_files(self._root), 0
        while self._first + end in there:
            end += 1
        return {"pages": end}

    def partitions(self, start: dict, end: dict) -> list[Page]:
        there = numbered_files(self._root)
        numbers = range(self._first + start["pages"], self._first + end["pages"])
        if gone := [n for n in numbers if n not in there]:
            raise BrokenChain(f"pages {gone[:5]} are gone")
        return [Page(there[n], n, n + 1 in there) for n in numbers]

    def read(self, partition: Page) -> Iterator[tuple]:
        files, inner = filesystem(partition.path)
        with files.open_input_stream(inner) as stream:
            body = json.loads(stream.read())
        for k, item in enumerate(checked(body, partition)):
            if isinstance(item, dict):
                yield partition.number, k, json.dumps(item, ensure_ascii=False, separators=(",", ":"))

    def commit(self, end: dict) -> None:
        """Nothing to release: pages stay where they are staged."""


class StagedPages(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> PageStream:
        return PageStream(self.options["path"], int(self.options.get("firstPage", 1)))


def register(spark: SparkSession) -> None:
    """Makes `spark.readStream.format("staged_pages").load(folder)` known to the session."""
    spark.dataSource.register(StagedPages)
