"""A source of paged answers: one partition per query, pages by cursor.

``spark.dataSource.register(CursorPages)`` and read with options ``queries`` (a JSON list),
``fetch`` ("module:function") and, if wanted, ``cap``. The function takes (query, cursor) and returns a
dict with ``rows`` (JSON texts), ``next`` (cursor or null) and ``total``. Reading stops at an
empty page, a missing or unmoving cursor, or the cap, without which all is read; an error raises,
so that it never looks like an empty answer. Rows carry the total that the service declares, and
``complete`` is false in the last row of a query that the cap cut short.
"""

from __future__ import annotations

import importlib
import json
import os
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class _Query(InputPartition):
    def __init__(self, number: int, text: str):
        self.number, self.text = number, text


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.queries = json.loads(options["queries"])
        self.fetch, self.cap = options["fetch"], int(options["cap"]) if options.get("cap") else None

    def partitions(self) -> list[_Query]:
        return [_Query(i, q) for i, q in enumerate(self.queries)]

    def read(self, partition: _Query) -> Iterator[tuple]:
        module, name = self.fetch.split(":")
        call = getattr(importlib.import_module(module), name)
        cursor, n = None, 0
        while True:
            page = call(partition.text, cursor)
            rows, ended = page["rows"], page.get("next") in (None, cursor)
            for i, row in enumerate(rows):
                last = self.cap is not None and n + 1 == self.cap
                cut = last and (i + 1 < len(rows) or not ended)
                yield (partition.text, n, row, page.get("total"), not cut)
                n += 1
                if last:
                    return
            if not rows or ended:
                return
            cursor = page["next"]


class CursorPages(DataSource):
    @classmethod
    def name(cls) -> str:
        return "cursor_pages"

    def schema(self) -> str:
        return "query string, pos int, payload string, total int, complete boolean"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


def landed(query: str, cursor: str | None) -> dict:
    """Pages that were landed as files <query>/<n>.json; the query is the folder."""
    n = int(cursor or 0)
    path = os.path.join(query, f"{n}.json")
    if not os.path.exists(path):
        return {"rows": [], "next": None, "total": None}
    with open(path) as f:
        page = json.load(f)
    return {"rows": [json.dumps(r, sort_keys=True) for r in page["rows"]], "next": str(n + 1), "total": page.get("total")}
