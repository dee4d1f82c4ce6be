"""What each step of the daily run read and wrote, and in which versions. From it a run
goes on at the step that failed, and leaves out steps whose inputs have not changed."""

from __future__ import annotations

import hashlib
import threading
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from mercato.sources import catalog, versions

TABLE = "run_ledger"
SCHEMA = (
    "run_id string, step string, status string, finished_at timestamp, seconds double, inputs string,"
    " reads map<string,string>, writes map<string,string>, error string"
)
ABSENT, PLAIN = "absent", "unversioned"
# Side-by-side steps append to one table.
_appending = threading.Lock()


@dataclass
class StepRecord:
    """Tables that a step has used, with the version it found or made."""

    reads: dict[str, str] = field(default_factory=dict)
    writes: dict[str, str] = field(default_factory=dict)


def state(spark: SparkSession, name: str) -> str:
    """The version of a name, or that it has none, or is not there."""
    number = versions.current(spark, name)
    if number is not None:
        return f"v{number}"
    return PLAIN if spark.catalog.tableExists(name) else ABSENT


def digest(*inputs: object) -> str:
    """What else a step depends on: parameters, landing files."""
    return hashlib.sha256(repr(inputs).encode()).hexdigest()[:16]


def note(
    spark: SparkSession, database: str, run_id: str, step: str, status: str, seconds: float, inputs: str,
    record: StepRecord, error: str | None = None,
) -> None:
    row = (run_id, step, status, seconds, inputs, record.reads, record.writes, error)
    kept = [f for f in SCHEMA.split(", ") if not f.startswith("finished_at")]
    df = spark.createDataFrame([row], ", ".join(kept)).withColumn("finished_at", F.current_timestamp())
    with _appending:
        catalog.append_log(df.select(*[f.split()[0] for f in SCHEMA.split(", ")]), f"{database}.{TABLE}")


def last_done(spark: SparkSession, database: str) -> dict[str, tuple[str, dict, dict]]:
    """For each step its inputs, reads and writes when it last ended well. One row for
    each step comes to the driver."""
    if not spark.catalog.tableExists(f"{database}.{TABLE}"):
        return {}
    done = spark.table(f"{database}.{TABLE}").where("status = 'done'")
    last = done.groupBy("step").agg(F.max_by(F.struct("inputs", "reads", "writes"), "finished_at").alias("x"))
    return {r["step"]: (r["x"]["inputs"], r["x"]["reads"], r["x"]["writes"]) for r in last.collect()}


def unchanged(spark: SparkSession, entry: tuple[str, dict, dict] | None, inputs: str) -> bool:
    """Whether the step would read and find what it read and left the last time. A step
    that wrote nothing is never taken as done."""
    if entry is None or entry[0] != inputs or not entry[2]:
        return False
    return all(state(spark, name) == version != ABSENT for used in entry[1:] for name, version in used.items())
