"""A polite client for paged JSON interfaces, and its pages as rows.

The transport is passed in (a function from path and parameters to status, headers and body), so
the library needs no HTTP package and tests need no network.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

Transport = Callable[[str, Mapping[str, object]], tuple[int, Mapping[str, str], str]]


@dataclass
class Client:
    get: Transport
    interval: float = 1.1  # seconds between requests
    retries: int = 5
    sleep: Callable[[float], None] = time.sleep
    clock: Callable[[], float] = time.monotonic
    _last: float | None = field(default=None, init=False)

    def fetch(self, path: str, **params: object) -> dict:
        """One page. Busy and failing servers are asked again, later each time; other errors raise."""
        for attempt in range(self.retries + 1):
            if self._last is not None:
                self.sleep(max(0.0, self.interval - (self.clock() - self._last)))
            self._last = self.clock()
            status, headers, body = self.get(path, params)
            if status == 200:
                return json.loads(body)
            if status != 429 and status < 500:
                raise OSError(f"{path}: status {status}")
            if attempt < self.retries:
                self.sleep(float(headers.get("Retry-After") or 2**attempt))
        raise OSError(f"{path}: status {status} after {self.retries + 1} requests")

    def items(self, path: str, page_size: int = 100, **params: object) -> Iterator[dict]:
        """The ``results`` of all pages."""
        page = 1
        while True:
            found = self.fetch(path, page=page, limit=page_size, **params).get("results") or []
            yield from found
            if len(found) < page_size:
                return
            page += 1


def payloads(spark: SparkSession, items: Iterator[dict], location_id: int | None = None, lat: float | None = None, lon: float | None = None) -> DataFrame:
    """Items as JSON rows for ``operators.ingest`` (one response's worth; the interface sets the bound)."""
    rows = [(json.dumps(i), location_id, lat, lon) for i in items]
    return spark.createDataFrame(rows, "payload string, location_id int, lat double, lon double")
