"""Validation as a gate on the build: measured while the rows are written, once.

Rows are flagged with the rules they break and written in one pass, sound ones
to the layer, broken ones to a quarantine beside it.  Counts per rule are
collected by the same pass.  If too many rows are broken the build stops: the
layer does not appear, the quarantine stays for a look.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from shelfwise.functions import labels
from shelfwise.functions.expr import count_where
from shelfwise.sources.panel import write_table

#: Column that names the part of a written row, a folder.
PART = "gate"
SOUND, BROKEN = "sound", "quarantine"


class GateError(ValueError):
    """Too many rows break the rules; ``report`` tells which."""

    def __init__(self, report: GateReport):
        super().__init__(f"{report.grade}: {report.broken} of {report.rows} rows break rules: {report.per_rule}")
        self.report = report


@dataclass(frozen=True)
class GateReport:
    """What the gate saw: rows, broken rows, rows per rule, grade and folders."""

    rows: int
    broken: int
    per_rule: dict[str, int]
    grade: str
    path: str

    @property
    def broken_pct(self) -> float:
        return self.broken * 100.0 / self.rows if self.rows else 0.0


def flagged(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """``df`` with ``broken_rules``, the names of the rules a row breaks; a rule that is null is not broken."""
    names = [F.when(F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()]
    return df.withColumn("broken_rules", F.array_compact(F.array(*names)))


def grade_of(pct: float, edges=labels.GRADE_EDGES, names=labels.GRADES) -> str:
    return next((name for edge, name in zip(edges, names, strict=False) if pct < edge), names[-1])


def gated_write(df: DataFrame, rules: Mapping[str, Column], path: str, stop: str | None = labels.GRADES[-1]) -> GateReport:
    """Write ``df`` below ``path``: sound rows to ``gate=sound``, broken ones to ``gate=quarantine``.

    One job reads ``df`` once; counts per rule are observed on the way.  Grades
    follow the share of broken rows.  With the grade ``stop`` the sound rows do
    not appear and :class:`GateError` is raised; None never stops.  An empty
    table passes.
    """
    seen = Observation(f"gate-{uuid.uuid4().hex}")
    rows = flagged(df, rules)
    has = lambda name: F.array_contains("broken_rules", name)
    broken = F.size("broken_rules") > 0
    counts = [F.count(F.lit(1)).alias("rows"), count_where(broken).alias("broken")]
    counts += [count_where(has(name)).alias(f"r{i}") for i, name in enumerate(rules)]
    part = F.when(broken, BROKEN).otherwise(SOUND)
    own = f"{path}.{uuid.uuid4().hex}"
    write_table(rows.observe(seen, *counts).withColumn(PART, part), own, partition_by=(PART,))
    found = seen.get
    per_rule = {name: found[f"r{i}"] for i, name in enumerate(rules)}
    pct = found["broken"] * 100.0 / found["rows"] if found["rows"] else 0.0
    report = GateReport(found["rows"], found["broken"], per_rule, grade_of(pct), path)
    where = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = where(own).getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration())
    if report.grade == stop:
        files.delete(where(f"{own}/{PART}={SOUND}"), True)
    files.delete(where(path), True)
    files.rename(where(own), where(path))
    if report.grade == stop:
        raise GateError(report)
    return report


def read_part(like: DataFrame, path: str, part: str) -> DataFrame:
    """The rows of a part, with the columns of ``like`` and their broken rules; none if nothing was written."""
    spark = like.sparkSession
    schema = like.schema.fieldNames()
    full = flagged(like.limit(0), {}).select(*schema, F.col("broken_rules").cast("array<string>"))
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{PART}={part}")
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        return full
    return spark.read.schema(full.schema).parquet(f"{path}/{PART}={part}")
