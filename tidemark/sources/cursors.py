"""A cursor API as a stream that goes on after a stop where its checkpoint stands.

With the option ``cursors``, a folder that the driver and all executors share and that belongs to one query as its checkpoint does, a
batch has a task a term, on executors; the offset is the number of pages of each term, and a task leaves the cursor at which it ended in the
folder. The first batch has ``pages`` pages a term, a later one as many as all before it, at most MOST, so batches are few. A task that
is run again starts at the same cursor, and holds the bodies of one Arrow batch.

Without it, for few pages, the offset is the cursor, a batch is ``pages`` pages a term, and the driver asks for pages. Page rules are those
of :mod:`tidemark.sources.paged`.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.errors import PySparkNotImplementedError
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition, SimpleDataSourceStreamReader

from tidemark.sources.paged import SCHEMA, Fetch, PageError, Request, batches

END = "\0end"
#: Most pages of a term in a batch.
MOST = 4096


def asked(fetch: Fetch, request: Request, at: dict) -> tuple[tuple, dict]:
    """The row of a page at a cursor and page number, and where the next one is."""
    page, term = fetch(request), request.term
    if page.after is not None and page.after == at["cursor"]:
        raise PageError(f"cursor {page.after} of {term} is repeated")
    if page.items == 0 and page.after is not None:
        raise PageError(f"page {at['page']} of {term} is empty but not the last")
    row = (term, at["page"], at["cursor"], page.total, page.items, page.after is None, page.body)
    return row, {"cursor": END if page.after is None else page.after, "page": at["page"] + 1}


class _Stream(SimpleDataSourceStreamReader):
    def __init__(self, fetch: Fetch, options: dict[str, str]) -> None:
        self.fetch, self.terms, self.pages = fetch, options["terms"].split("|"), int(options.get("pages", 1))
        self.first, self.last, self.predicate = (options.get(k, "") for k in ("first", "last", "predicate"))

    def initialOffset(self) -> dict:  # noqa: N802 - a name of the interface
        return {t: {"cursor": None, "page": 0} for t in self.terms}

    def _page(self, term: str, at: dict) -> tuple[tuple, dict]:
        return asked(self.fetch, Request(term, self.first, self.last, at["cursor"], self.predicate), at)

    def _walk(self, start: dict, stop) -> tuple[list[tuple], dict]:
        rows, now = [], {}
        for term in self.terms:
            at, n = start.get(term, {"cursor": None, "page": 0}), 0
            while at["cursor"] != END and not stop(term, at, n):
                row, at = self._page(term, at)
                rows.append(row)
                n += 1
            now[term] = at
        return rows, now

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        rows, now = self._walk(start, lambda term, at, n: n >= self.pages)
        return iter(rows), now

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:  # noqa: N802 - a name of the interface
        return iter(self._walk(start, lambda term, at, n: at == end[term])[0])


@dataclass
class _Pages(InputPartition):
    """Pages of a term from one number to another."""

    term: str
    start: int
    end: int


class _Spread(DataSourceStreamReader):
    """A task a term. The folder holds, for each term, a file named by each page number at which a task has ended, with the cursor there."""

    def __init__(self, fetch: Fetch, options: dict[str, str]) -> None:
        self.fetch, self.terms, self.pages, self.at = fetch, options["terms"].split("|"), int(options.get("pages", 1)), options["cursors"]
        self.first, self.last, self.predicate = (options.get(k, "") for k in ("first", "last", "predicate"))

    def _folder(self, term: str) -> tuple[fs.FileSystem, str]:
        system, at = fs.FileSystem.from_uri(self.at)
        return system, f"{at}/{hashlib.sha256(term.encode()).hexdigest()[:32]}"

    def _cursor(self, term: str, page: int) -> str | None:
        if page == 0:
            return None
        system, folder = self._folder(term)
        with system.open_input_stream(f"{folder}/{page:012d}") as f:
            return json.loads(f.read())

    def _leave(self, term: str, page: int, cursor: str | None) -> None:
        system, folder = self._folder(term)
        system.create_dir(folder, recursive=True)
        draft = f"{folder}/.{uuid.uuid4().hex}"
        with system.open_output_stream(draft) as f:
            f.write(json.dumps(cursor).encode())
        system.move(draft, f"{folder}/{page:012d}")

    def initialOffset(self) -> dict:  # noqa: N802 - a name of the interface
        return {t: 0 for t in self.terms}

    def latestOffset(self) -> dict:  # noqa: N802 - a name of the interface
        """The batches planned so far have ended, so the greatest page number of a term is where it stands."""
        now = {}
        for t in self.terms:
            system, folder = self._folder(t)
            names = [x.base_name for x in system.get_file_info(fs.FileSelector(folder, allow_not_found=True))]
            n = max((int(x) for x in names if x.isdecimal()), default=0)
            now[t] = n if self._cursor(t, n) == END else n + max(self.pages, min(n, MOST))
        return now

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [_Pages(t, start.get(t, 0), end[t]) for t in self.terms if start.get(t, 0) < end[t]]

    def _rows(self, part: _Pages) -> Iterator[tuple]:
        at = {"cursor": self._cursor(part.term, part.start), "page": part.start}
        while at["cursor"] != END and at["page"] < part.end:
            row, at = asked(self.fetch, Request(part.term, self.first, self.last, at["cursor"], self.predicate), at)
            yield row
        self._leave(part.term, part.end, at["cursor"])

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        yield from batches(self._rows(partition))


def cursor_stream(name: str, fetch: Fetch) -> type[DataSource]:
    """A streaming source of page bodies; options: terms ("a|b"), pages (a term and batch), cursors (a shared folder), first, last, predicate. Register it first."""

    class Cursors(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return SCHEMA

        def streamReader(self, schema) -> DataSourceStreamReader:  # noqa: N802 - a name of the interface
            if "cursors" not in self.options:  # Spark then asks for the simple reader
                raise PySparkNotImplementedError(errorClass="NOT_IMPLEMENTED", messageParameters={"feature": "streamReader"})
            return _Spread(fetch, dict(self.options))

        def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:  # noqa: N802 - a name of the interface
            return _Stream(fetch, dict(self.options))

    return Cursors
