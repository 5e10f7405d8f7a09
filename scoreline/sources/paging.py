"""Scans over a paged list, newest first, as the source's list endpoint gives it."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from time import sleep as _sleep

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

#: A page at an offset, as a decoded document.
Fetch = Callable[[int], dict]


@dataclass
class Collected:
    summaries: list[dict]
    next_offset: int | None


def collect(fetch: Fetch, page_size: int, start: int = 0, max_pages: int = 10, stop_at: int | None = None) -> Collected:
    """Pages until an empty or short page, a known id, or ``max_pages``; only the last leaves a next offset.
    Summaries are one per id, the last seen, by ascending id."""
    seen: dict[int, dict] = {}
    offset, more = start, None
    for page in range(max_pages):
        rows = fetch(offset)["logs"]
        fresh = []
        for s in rows:
            if stop_at is not None and s["id"] <= stop_at:
                break
            fresh.append(s)
        seen.update({s["id"]: s for s in fresh})
        if len(fresh) < len(rows) or len(rows) < page_size:
            break
        offset += page_size
        more = offset if page == max_pages - 1 else None
    return Collected([seen[k] for k in sorted(seen)], more)


def collect_new(fetch: Fetch, page_size: int, last_id: int, max_pages: int = 10) -> Collected:
    """All that is newer than ``last_id``. If the pages allowed don't reach back to it, the next offset says where
    to go on, so that no gap is left behind."""
    return collect(fetch, page_size, 0, max_pages, last_id)


@dataclass(frozen=True)
class Stretch:
    """Entries of the ids above ``low`` up to ``high``; when planned, they began at ``offset``."""

    offset: int
    low: int
    high: int


def _ids(fetch: Fetch, offset: int) -> list[int]:
    return [s["id"] for s in fetch(offset)["logs"]]


def plan_oldest(fetch: Fetch, page_size: int, last_id: int, pages: int) -> list[Stretch]:
    """The oldest entries above ``last_id``, at most ``pages`` pages of them, a stretch for each page, oldest first.

    The page that reaches back to ``last_id`` is looked for by doubling steps and then by halves, so that a backlog of
    n pages costs about 2 log n requests and those of the pages taken. What is taken is the old end of the backlog: the
    last known id can move to its newest entry without leaving a gap.
    """

    def reaches(page: int) -> bool:
        ids = _ids(fetch, page * page_size)
        return len(ids) < page_size or min(ids) <= last_id

    top = 0
    while not reaches(top):
        top = 2 * top + 1
    low = (top - 1) // 2 + 1 if top else 0
    while low < top:  # the first page that reaches
        mid = (low + top) // 2
        low, top = (low, mid) if reaches(mid) else (mid + 1, top)
    out, known, page = [], last_id, top
    while page >= 0 and len(out) < pages:
        new = [i for i in _ids(fetch, page * page_size) if i > known]
        if new:
            out.append(Stretch(page * page_size, known, max(new)))
            known = max(new)
        page -= 1
    return out


def read_stretch(fetch: Fetch, page_size: int, part: Stretch) -> list[dict]:
    """The entries of a stretch, wherever they are by now: entries that came or went since have moved them."""
    seen: dict[int, dict] = {}
    offset, rows = part.offset, fetch(part.offset)["logs"]
    while offset and (not rows or rows[0]["id"] < part.high):  # entries have gone
        offset = max(0, offset - page_size)
        rows = fetch(offset)["logs"]
    while rows:
        seen.update({s["id"]: s for s in rows if part.low < s["id"] <= part.high})
        if len(rows) < page_size or rows[-1]["id"] <= part.low:
            break
        offset += page_size
        rows = fetch(offset)["logs"]
    return [seen[k] for k in sorted(seen)]


def with_retries(call: Callable[[], dict], attempts: int = 3, delay: float = 0.5, sleep: Callable[[float], None] = _sleep) -> dict:
    """Calls again after an error, waiting longer each time; the last error is raised."""
    for k in range(1, attempts + 1):
        try:
            return call()
        except Exception:
            if k == attempts:
                raise
            sleep(delay * k)
    raise ValueError("attempts must be positive")


class PagedListSource(DataSource):
    """``spark.read.format("paged_list")`` over a folder of pages ``<offset>.json`` or a URL template with
    ``{offset}``; each page is a partition, read where the task runs. Options: path, pages, page_size, start."""

    @classmethod
    def name(cls) -> str:
        return "paged_list"

    def schema(self) -> str:
        """In a batch: pages by offset. In a stream: summaries by id."""
        return "page_offset long, value string"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _ListStream(self.options)

    def reader(self, schema) -> DataSourceReader:
        return _PagedReader(self.options)


def read_page(path: str, offset: int) -> str | None:
    """A page's text; None where there is no such file."""
    from urllib.request import urlopen

    where = path.replace("{offset}", str(offset)) if "{offset}" in path else f"{path}/{offset}.json"
    try:
        if "://" in where:
            with urlopen(where, timeout=30) as r:
                text = r.read().decode()
        else:
            with open(where, encoding="utf-8") as r:
                text = r.read()
    except FileNotFoundError:
        return None
    json.loads(text)
    return text


class _ListStream(DataSourceStreamReader):
    """Summaries by id, the oldest new ones first: a batch is at most ``pages`` pages, each a partition that is read
    where its task runs; a longer backlog goes on in the next batch.

    An offset holds the last id of its batch and the batch's stretches, so that a batch that runs again is planned
    alike without a request. Spark does not tell a reader that starts anew which batch was the last, so each batch's
    offset is also kept in the folder ``progress``, the stream's own; it is written when the batch is planned, after
    Spark has logged it and before it runs.
    """

    def __init__(self, options):
        self.path, self.size, self.pages = options["path"], int(options.get("page_size", 100)), int(options.get("pages", 10))
        if "progress" not in options:
            raise ValueError("a stream of paged_list needs the option progress, a folder of its own")
        self.progress = options["progress"]
        self.at: dict | None = None

    def _fetch(self, offset: int) -> dict:
        return with_retries(lambda: json.loads(read_page(self.path, offset) or '{"logs": []}'))

    def _file(self):
        from pyarrow import fs

        where, folder = fs.FileSystem.from_uri(self.progress) if "://" in self.progress else (fs.LocalFileSystem(), self.progress)
        return where, folder, f"{folder}/last-batch.json"

    def _keep(self, offset: dict) -> None:
        where, folder, name = self._file()
        where.create_dir(folder)
        with where.open_output_stream(f"{name}.new") as out:
            out.write(json.dumps(offset).encode())
        where.move(f"{name}.new", name)

    def _kept(self) -> dict:
        where, _, name = self._file()
        if not where.get_file_info(name).is_file:
            return self.initialOffset()
        with where.open_input_stream(name) as got:
            return json.loads(got.read())

    def initialOffset(self) -> dict:
        return {"last_id": 0}

    def latestOffset(self) -> dict:
        self.at = self.at or self._kept()
        parts = plan_oldest(self._fetch, self.size, self.at["last_id"], self.pages)
        if not parts:
            return self.at
        return {"last_id": parts[-1].high, "parts": {str(k): vars(p) for k, p in enumerate(parts)}}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        if self.at != end:
            self.at = end
            self._keep(end)
        return [] if start == end else [InputPartition(Stretch(**p)) for p in end.get("parts", {}).values()]

    def read(self, partition) -> Iterator[tuple]:
        for s in read_stretch(self._fetch, self.size, partition.value):
            yield s["id"], json.dumps(s)


class _PagedReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.size = options["path"], int(options.get("page_size", 100))
        self.start, self.pages = int(options.get("start", 0)), int(options.get("pages", 1))

    def partitions(self):
        return [InputPartition(self.start + i * self.size) for i in range(self.pages)]

    def read(self, partition) -> Iterator[tuple]:
        if (text := read_page(self.path, partition.value)) is not None:
            yield partition.value, text
