"""A warehouse that takes candles by insert requests, as a sink of batch and streaming writes.

``df.write.format("candle_requests")`` sends rows in requests of ``rows`` (500) each, which tasks stage under names of their own;
what counts is only what the driver commits when all tasks have ended, so that neither a failed task nor one that ran twice leaves
duplicates. A streaming write commits each batch under its number; a batch that is run again finds its commit and adds nothing.
A batch write may be named by the option ``batch``, to the same effect.

The warehouse is named by the option ``client`` as module:function, which is called with the option ``target`` and gives an object
with put(request, rows), where rows are lists of values in the order of columns, commit(batch, requests) -> whether it was new, and
discard(requests). ``tidewick.sources.requests:folder_client`` keeps requests as files in a folder that all machines share.
"""

from __future__ import annotations

import importlib
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Row
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, DataSourceWriter, WriterCommitMessage

ROWS = 500


@dataclass
class Staged(WriterCommitMessage):
    requests: list[str]
    rows: int


def _client(options: dict):
    module, _, name = options["client"].partition(":")
    return getattr(importlib.import_module(module), name)(options["target"])


def _staged(options: dict, rows: Iterator[Row]) -> Staged:
    """Stage a task's rows; names tell its attempts apart. What a failed attempt has staged is never committed."""
    client, size, found, total = _client(options), int(options.get("rows", ROWS)), [], 0
    context = TaskContext.get()
    own = f"{context.partitionId() if context else 0:05d}-{uuid.uuid4().hex}"
    rows = iter(rows)
    while part := [list(row) for row in islice(rows, size)]:
        found.append(f"{own}-{len(found):05d}")
        client.put(found[-1], part)
        total += len(part)
    return Staged(found, total)


def _names(messages: list[Staged | None]) -> list[str]:
    return [name for m in messages if m for name in m.requests]


class RequestWriter(DataSourceWriter):
    def __init__(self, options: dict):
        self.options = options
        self.batch = options.get("batch") or uuid.uuid4().hex

    def write(self, iterator: Iterator[Row]) -> Staged:
        return _staged(self.options, iterator)

    def commit(self, messages: list[Staged | None]) -> None:
        client, names = _client(self.options), _names(messages)
        if not client.commit(self.batch, names):
            client.discard(names)

    def abort(self, messages: list[Staged | None]) -> None:
        _client(self.options).discard(_names(messages))


class RequestStreamWriter(DataSourceStreamWriter):
    def __init__(self, options: dict):
        self.options = options

    def write(self, iterator: Iterator[Row]) -> Staged:
        return _staged(self.options, iterator)

    def commit(self, messages: list[Staged | None], batchId: int) -> None:
        client, names = _client(self.options), _names(messages)
        if not client.commit(f"{self.options.get('batch', 'stream')}-{batchId}", names):
            client.discard(names)

    def abort(self, messages: list[Staged | None], batchId: int) -> None:
        _client(self.options).discard(_names(messages))


class CandleRequests(DataSource):
    @classmethod
    def name(cls) -> str:
        return "candle_requests"

    def writer(self, schema, overwrite: bool) -> RequestWriter:
        if overwrite:
            raise ValueError("rows can only be added")
        return RequestWriter(self.options)

    def streamWriter(self, schema, overwrite: bool) -> RequestStreamWriter:
        return RequestStreamWriter(self.options)


class FolderClient:
    """Requests as files of JSON lines below staged/, and for each committed batch a file below committed/ that names its requests.

    A commit's file is written whole under another name and then moved to its own, unless that is there.
    """

    def __init__(self, target: str):
        self.files, self.root = fs.FileSystem.from_uri(target) if "://" in target else (fs.LocalFileSystem(), target)

    def _write(self, name: str, text: str) -> None:
        self.files.create_dir(f"{self.root}/{name.rpartition('/')[0]}", recursive=True)
        with self.files.open_output_stream(f"{self.root}/{name}") as out:
            out.write(text.encode())

    def _there(self, name: str) -> bool:
        return self.files.get_file_info(f"{self.root}/{name}").type == fs.FileType.File

    def put(self, request: str, rows: list[list]) -> None:
        self._write(f"staged/{request}", "\n".join(json.dumps(row, default=str) for row in rows))

    def commit(self, batch: str, requests: list[str]) -> bool:
        if self._there(f"committed/{batch}"):
            return False
        new = f"committing/{batch}-{uuid.uuid4().hex}"
        self._write(new, "\n".join(requests))
        self.files.create_dir(f"{self.root}/committed", recursive=True)
        self.files.move(f"{self.root}/{new}", f"{self.root}/committed/{batch}")
        return True

    def discard(self, requests: list[str]) -> None:
        for name in requests:
            if self._there(f"staged/{name}"):
                self.files.delete_file(f"{self.root}/staged/{name}")

    def requests(self) -> list[str]:
        """The names of all committed requests."""
        found = self.files.get_file_info(fs.FileSelector(f"{self.root}/committed", allow_not_found=True))
        return [name for f in found for name in self.files.open_input_stream(f.path).read().decode().splitlines()]


def folder_client(target: str) -> FolderClient:
    return FolderClient(target)
