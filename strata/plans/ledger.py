"""The ledger of pipeline runs (PIPE-4): what a run has done, so that another can go on where it died.

A run adds a row when it starts, after each finished piece of work (a table ingested, a snapshot, a model table), and
when it ends.  A run that finds the last one unfinished, started with the same settings, takes over its id and its
instants (so "now" is the same for all of its tables) and leaves out what it has done; what a piece of work wrote is taken as
it is only while the table still points there.  The rows of ingested tables also tell a model step which landed
batches it has not seen, and the rows of model tables what their writes have observed (``sinks.metrics``).
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from strata.sinks.log import ControlLog

LEDGER_SCHEMA = "run_id string, step string, name string, location string, detail string"
START, END = "start", "end"


@dataclass
class Run:
    """One run and what it has finished: (step, name) -> location."""

    run_id: str
    settings: dict
    done: dict[tuple[str, str], str | None] = field(default_factory=dict)
    resumed: bool = False

    def has(self, step: str, name: str = "") -> bool:
        return (step, name) in self.done


class RunLedger:
    """The control table of runs; one run at a time writes to it."""

    def __init__(self, spark: SparkSession, name: str, root: str):
        self.log = ControlLog(spark, name, root, LEDGER_SCHEMA)

    def begin(self, settings: dict, instants: dict) -> Run:
        """Start a run, or take over the last one if it did not end and had the same ``settings``; ``instants`` are the
        points in time that a new run works with, and those of the run that is taken over otherwise."""
        self.log.ensure()
        last = self.log.rows().filter(F.col("step") == START).orderBy(F.desc("at")).limit(1).collect()
        if last:
            own = self.log.rows().filter(F.col("run_id") == last[0].run_id).collect()  # a row per table of one run
            known = json.loads(last[0].detail)
            if not any(r.step == END for r in own) and known["settings"] == settings:
                done = {(r.step, r.name): r.location for r in sorted(own, key=lambda r: r["at"]) if r.step != START}
                return Run(last[0].run_id, {**settings, **known["instants"]}, done, resumed=True)
        run = Run(uuid.uuid4().hex[:16], {**settings, **instants})
        self.log.add([(run.run_id, START, "", None, json.dumps({"settings": settings, "instants": instants}))])
        return run

    def loose(self) -> Run:
        """A run of one step alone, without a start or an end: its pieces are noted, and nothing goes on with it."""
        return Run(uuid.uuid4().hex[:16], {})

    def finished(self, run: Run, step: str, name: str = "", location: str | None = None, detail: str | None = None) -> None:
        """Note a finished piece of work."""
        self.log.add([(run.run_id, step, name, location, detail)])
        run.done[step, name] = location

    def end(self, run: Run, keep: int = 50) -> None:
        """Note the end; rows of all but the last ``keep`` runs go once the table has many files."""
        self.finished(run, END)
        starts = self.log.rows().filter(F.col("step") == START).orderBy(F.desc("at")).limit(keep)
        self.log.trim(F.col("run_id").isin(*[r.run_id for r in starts.collect()]))

    def landed_since(self, step: str) -> dict[str, list[str]]:
        """Per table the landed batches that were ingested after the last time that ``step`` was finished (by any run)."""
        rows = self.log.rows().filter(F.col("step").isin("ingest", step)).select("step", "name", "location", "at").collect()
        last = max((r["at"] for r in rows if r.step == step), default=None)
        out: dict[str, list[str]] = {}
        for r in sorted(rows, key=lambda r: r["at"]):
            if r.step == "ingest" and r.location and (last is None or r["at"] > last):
                out.setdefault(r.name, []).append(r.location)
        return out

    def last_detail(self, step: str) -> str | None:
        """What the last finished ``step`` noted."""
        found = self.log.rows().filter(F.col("step") == step).orderBy(F.desc("at")).limit(1).collect()
        return found[0].detail if found else None
