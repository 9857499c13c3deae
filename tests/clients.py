"""Exchanges and warehouses for tests, which Python workers import, too."""

from __future__ import annotations

import uuid
from pathlib import Path

from tidewick.sources import requests
from tidewick.sources.exchange import MINUTE


def every_minute(symbol: str, since: int, limit: int) -> list:
    first = -(-since // MINUTE)
    return [[k * MINUTE, 1.0, 2.0, 0.5, 1.5, float(k)] for k in range(first, min(first + limit, 10_000))]


asked: list[tuple] = []


def counted(*request) -> list:
    asked.append(request)
    return every_minute(*request)


class Breaking(requests.FolderClient):
    """Fails once, in the task that comes to a certain row, after it has staged others."""

    def put(self, request, rows):
        broken = Path(self.root, "broken")
        if any(r[2] == 77.0 for r in rows) and not broken.exists():
            broken.parent.mkdir(parents=True, exist_ok=True)
            broken.touch()
            raise OSError("lost")
        super().put(request, rows)


def breaking_client(target: str):
    return Breaking(target)


def failing_client(target: str):
    return type("Failing", (requests.FolderClient,), {"put": lambda self, request, rows: 1 / 0})(target)


def logging_client(target: str):
    """Leaves a file for each request."""

    def fetch(symbol: str, since: int, limit: int) -> list:
        Path(target, uuid.uuid4().hex).touch()
        return every_minute(symbol, since, limit)

    return fetch
