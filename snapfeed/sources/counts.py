"""Row counts as a by-product of the run that makes the rows: nothing runs twice."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class Counts:
    """Counts that are there once an action has run the frame they were taken from."""

    def __init__(self, observation: Observation):
        self._observation = observation

    def __getitem__(self, name: str) -> int:
        """The count; waits for the first action to end."""
        return int(self._observation.get[name] or 0)


def counted(df: DataFrame, **conditions: Column) -> tuple[DataFrame, Counts]:
    """``df`` with counts taken as its rows pass: ``rows``, and the rows that meet each
    condition, e.g. those a later filter drops."""
    observation = Observation()
    sums = {name: F.sum(F.when(c, F.lit(1).cast("bigint")).otherwise(F.lit(0).cast("bigint"))) for name, c in conditions.items()}
    observed = df.observe(observation, F.count(F.lit(1)).alias("rows"), *[s.alias(n) for n, s in sums.items()])
    return observed, Counts(observation)


@dataclass(frozen=True)
class Statement:
    """A statement that a script ran: its command and the rows it wrote."""

    command: str
    rows: int


def run_counted(spark: SparkSession, run) -> tuple[object, list[Statement]]:
    """Call ``run()`` and list the write statements that ran in this session meanwhile,
    in order, also those inside of a ``BEGIN ... END`` text. The rows come from the
    metrics that Spark keeps of each execution; the session keeps those of its last
    ``spark.sql.ui.retainedExecutions`` (1000) executions."""
    store = spark._jsparkSession.sharedState().statusStore()
    bus = spark.sparkContext._jsc.sc().listenerBus()
    bus.waitUntilEmpty()
    before = {e.executionId() for e in _listed(store.executionsList())}
    result = run()
    bus.waitUntilEmpty()
    done = [e for e in _listed(store.executionsList()) if e.executionId() not in before]
    statements = []
    for execution in sorted(done, key=lambda e: e.executionId()):
        values = store.executionMetrics(execution.executionId())
        for node in _listed(store.planGraph(execution.executionId()).allNodes()):
            if not node.name().startswith("Execute "):
                continue
            for metric in _listed(node.metrics()):
                if metric.name() == "number of output rows" and values.contains(metric.accumulatorId()):
                    text = str(values.apply(metric.accumulatorId()))
                    statements.append(Statement(node.name().removeprefix("Execute ").strip(), int(text.replace(",", ""))))
    return result, statements


def _listed(seq) -> list:
    return [seq.apply(i) for i in range(seq.size())]
