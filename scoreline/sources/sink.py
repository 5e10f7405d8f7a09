"""A sink that sends records in chunks, each task its own, in one pass over the rows."""

from __future__ import annotations

import hashlib
import json
import os
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import islice

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from ..session import let_workers_import

#: Records of one send.
MOST = 1000


def overloaded(message: str) -> bool:
    return any(x in message.lower() for x in ("overloaded", "too many requests"))


def with_patience(send: Callable[[], None], attempts: int = 3, delay: float = 0.5, sleep: Callable[[float], None] = time.sleep) -> None:
    """Sends again, a little later each time, while the receiver says that it is overloaded; any other error, and the last
    one, is the caller's."""
    for k in range(1, attempts + 1):
        try:
            return send()
        except Exception as e:
            if k == attempts or not overloaded(str(e)):
                raise
            sleep(delay * k)


def in_chunks(records: Iterator[str], most: int) -> Iterator[list[str]]:
    while chunk := list(islice(records, max(1, most))):
        yield chunk


@dataclass
class Sent(WriterCommitMessage):
    records: int
    chunks: list[str]


class RecordSink(DataSource):
    """``df.write.format("record_sink")``: each row as a JSON object, ``most`` of them a send, to a URL that takes arrays
    by POST, or to a folder as files of lines.

    A task sends what it has as it comes and tries again on overload (options attempts, delay); any other error fails
    the task. A folder shows a write's chunks once all of its tasks are done: they wait under a hidden name until the
    commit, and go if the write fails. A receiver at a URL sees a chunk again if its task runs again, under the same
    Idempotency-Key, which is made from the chunk's records.
    """

    @classmethod
    def name(cls) -> str:
        return "record_sink"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        if overwrite:
            raise ValueError("records can only be appended")
        return _SinkWriter(self.options)


class _SinkWriter(DataSourceWriter):
    def __init__(self, options):
        self.to, self.most = options["to"], int(options.get("most", MOST))
        self.attempts, self.delay = int(options.get("attempts", 3)), float(options.get("delay", 0.5))

    def write(self, iterator) -> Sent:
        n, chunks = 0, []
        lines = (json.dumps(r.asDict(True), default=str) for r in iterator)
        for k, chunk in enumerate(in_chunks(lines, self.most)):
            key = hashlib.sha256("\n".join([str(k), *chunk]).encode()).hexdigest()[:32]
            with_patience(lambda c=chunk, i=key: self._send(c, i), self.attempts, self.delay)
            n, chunks = n + len(chunk), [*chunks, key]
        return Sent(n, chunks)

    def _send(self, chunk: list[str], key: str) -> None:
        if "://" in self.to:
            from urllib.error import HTTPError
            from urllib.request import Request, urlopen

            head = {"Content-Type": "application/json", "Idempotency-Key": key}
            try:
                urlopen(Request(self.to, f"[{','.join(chunk)}]".encode(), head), timeout=60).close()
            except HTTPError as e:
                raise RuntimeError(f"{'Too many requests' if e.code == 429 else e.code}: {e.read()[:300].decode(errors='replace')}") from e
        else:
            os.makedirs(self.to, exist_ok=True)
            with open(f"{self.to}/.{key}.{os.getpid()}", "w", encoding="utf-8") as out:
                out.write("\n".join(chunk) + "\n")
            os.replace(f"{self.to}/.{key}.{os.getpid()}", f"{self.to}/.{key}")

    def commit(self, messages: list[Sent | None]) -> None:
        if "://" not in self.to:
            for key in (k for m in messages if m for k in m.chunks):
                os.replace(f"{self.to}/.{key}", f"{self.to}/{key}.json")

    def abort(self, messages: list[Sent | None]) -> None:
        if "://" not in self.to:
            for key in (k for m in messages if m for k in m.chunks):
                if os.path.exists(f"{self.to}/.{key}"):
                    os.remove(f"{self.to}/.{key}")


def record_sink(to: str, most: int = MOST, attempts: int = 3, delay: float = 0.5) -> Callable[[str, DataFrame], int]:
    """A sink for ingests: dataset and records to ``to``/dataset; gives the number of records sent."""

    def send(name: str, rows: DataFrame) -> int:
        let_workers_import(rows.sparkSession)
        rows.sparkSession.dataSource.register(RecordSink)
        seen = Observation()
        counted = rows.observe(seen, F.count(F.lit(1)).alias("rows"))
        counted.write.format("record_sink").mode("append").options(to=f"{to.rstrip('/')}/{name}", most=most, attempts=attempts, delay=delay).save()
        return seen.get["rows"]

    return send
