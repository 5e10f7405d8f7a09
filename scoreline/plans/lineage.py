"""Run events of ingests and of published tables in the open lineage format, for any sink that takes a document."""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame

from ..streaming.ingest import DATASETS

SCHEMA_URL = "https://openlineage.io/spec/2-0-2/OpenLineage.json#/$defs/RunEvent"
TYPES = ("START", "COMPLETE", "FAIL")


class Lineage:
    """``Lineage(send)`` serves as ``on_event`` of :class:`BatchIngest`: one run id from START to its end."""

    def __init__(self, send: Callable[[dict], None], namespace: str = "scoreline", job: str = "ingest", source: str = "match-list", now: Callable[[], datetime.datetime] = lambda: datetime.datetime.now(datetime.timezone.utc)):
        self.send, self.namespace, self.job, self.source, self.now = send, namespace, job, source, now
        self.run_id = ""

    def __call__(self, kind: str, facts: dict) -> None:
        if kind not in TYPES:
            raise ValueError(f"no such event: {kind}")
        if kind == "START":
            self.run_id = str(uuid.uuid4())
        run: dict = {"runId": self.run_id, "facets": {"ingest": {"_producer": self.namespace, "_schemaURL": SCHEMA_URL, **{k: v for k, v in facts.items() if k != "error"}}}}
        if "error" in facts:
            run["facets"]["errorMessage"] = {"_producer": self.namespace, "_schemaURL": SCHEMA_URL, "message": facts["error"], "programmingLanguage": "python"}
        self.send(
            {
                "eventType": kind,
                "eventTime": self.now().isoformat(),
                "producer": self.namespace,
                "schemaURL": SCHEMA_URL,
                "run": run,
                "job": {"namespace": self.namespace, "name": self.job},
                "inputs": [{"namespace": self.namespace, "name": self.source}],
                "outputs": [{"namespace": self.namespace, "name": d} for d in DATASETS],
            }
        )


def sources(df: DataFrame, names: Callable[[str], str]) -> list[str]:
    """The datasets that a plan reads: the folders and files at the leaves of its analysed form, each by its name."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    found = set()
    for k in range(leaves.size()):
        leaf = leaves.apply(k)
        if leaf.getClass().getSimpleName() == "LogicalRelation" and hasattr(leaf.relation(), "location"):
            paths = leaf.relation().location().rootPaths()
            found |= {names(paths.apply(i).toString()) for i in range(paths.size())}
    return sorted(found)


class TableLineage:
    """Events of a refresh: START of a step, COMPLETE of each table that it writes, with what was read for it and its
    columns, FAIL of a step. All events of a run share its id as their parent."""

    def __init__(self, send: Callable[[dict], None], root: str, run_id: str, namespace: str = "scoreline", now: Callable[[], datetime.datetime] = lambda: datetime.datetime.now(datetime.timezone.utc)):
        self.send, self.root, self.run_id, self.namespace, self.now = send, root.rstrip("/").split(":", 1)[-1].lstrip("/"), run_id, namespace, now

    def name(self, path: str) -> str:
        """A table of the store by its name, any other file by its own without the ending."""
        at = path.split(":", 1)[-1].lstrip("/")
        if at.startswith(f"{self.root}/"):
            return at[len(self.root) + 1 :].split("/")[0]
        return at.rstrip("/").rsplit("/", 1)[-1].removesuffix(".parquet")

    def _event(self, kind: str, job: str, inputs: list[str], outputs: list[dict], facets: dict) -> None:
        parent = {"_producer": self.namespace, "_schemaURL": SCHEMA_URL, "run": {"runId": self.run_id}, "job": {"namespace": self.namespace, "name": "refresh"}}
        self.send(
            {
                "eventType": kind,
                "eventTime": self.now().isoformat(),
                "producer": self.namespace,
                "schemaURL": SCHEMA_URL,
                "run": {"runId": str(uuid.uuid5(uuid.NAMESPACE_URL, f"{self.run_id}/{job}")), "facets": {"parent": parent, **facets}},
                "job": {"namespace": self.namespace, "name": job},
                "inputs": [{"namespace": self.namespace, "name": n} for n in inputs],
                "outputs": outputs,
            }
        )

    def started(self, step: str) -> None:
        self._event("START", step, [], [], {})

    def failed(self, step: str, error: str) -> None:
        said = {"_producer": self.namespace, "_schemaURL": SCHEMA_URL, "message": error, "programmingLanguage": "python"}
        self._event("FAIL", step, [], [], {"errorMessage": said})

    def written(self, table: str, df: DataFrame, rows: int) -> None:
        fields = [{"name": f.name, "type": f.dataType.simpleString()} for f in df.schema]
        facets = {"schema": {"_producer": self.namespace, "_schemaURL": SCHEMA_URL, "fields": fields}}
        out = {"namespace": self.namespace, "name": table, "facets": facets, "outputFacets": {"outputStatistics": {"_producer": self.namespace, "_schemaURL": SCHEMA_URL, "rowCount": rows}}}
        self._event("COMPLETE", table, [n for n in sources(df, self.name) if n != table], [out], {})
