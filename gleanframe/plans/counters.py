"""What a run did, counted while it ran: no second scan of its inputs.

A watched table is passed on as it is; its counts come with the action that reads it. A task that runs twice
because its executor was lost may count twice, so the numbers describe the run, not the result.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gleanframe.operators import listing, records


def _seen(observation: Observation) -> dict:
    try:
        return observation.get
    except Py4JJavaError:  # no rows came to this point, and Spark left it out of the plan
        return {}


class RunCounters:
    """Counts by name, from several points of a flow."""

    def __init__(self):
        self._watched: list[tuple[Observation, list[str]]] = []

    def watch(self, rows: DataFrame, point: str, **counts: Column) -> DataFrame:
        """The same rows; ``counts`` are aggregates over them."""
        observation = Observation(point)
        self._watched.append((observation, list(counts)))
        return rows.observe(observation, *[column.alias(name) for name, column in counts.items()])

    def values(self) -> dict[str, int]:
        """All counts, once an action has read the watched tables; it waits for one."""
        return {name: found.get(name) or 0
                for observation, names in self._watched for found in [_seen(observation)] for name in names}

    # ---- points of the listing flows

    def responses(self, parsed: DataFrame) -> DataFrame:
        """Parsed responses: how many, and the requests that follow from them."""
        return self.watch(
            parsed, "responses", responses=F.count(F.lit(1)),
            requests=F.sum(listing.requests_of("page_num")))

    def items(self, rows: DataFrame) -> DataFrame:
        """Listing records: how many, how many lack a required field, and how many lack each."""
        missing = records.missing_fields(rows)
        return self.watch(
            rows, "items", items=F.count(F.lit(1)), items_lacking_fields=F.count_if(F.size(missing) > 0),
            **{f"missing_{name}": F.count_if(F.array_contains(missing, name)) for name in records.REQUIRED},
            _with_url=F.count("property_url"))

    def kept(self, rows: DataFrame) -> DataFrame:
        """Records after duplicates are gone."""
        return self.watch(rows, "kept", _kept=F.count(F.lit(1)))

    def report(self) -> dict[str, int]:
        """The counts for a reader: duplicates are the records with a URL that were not kept."""
        found = self.values()
        if "_kept" in found and "_with_url" in found:
            found["duplicates"] = found.pop("_with_url") - found.pop("_kept")
        return {name: value for name, value in found.items() if not name.startswith("_")}

    def table(self, spark: SparkSession) -> DataFrame:
        """The report as rows (counter, value), a handful."""
        return spark.createDataFrame(sorted(self.report().items()), "counter string, value long")
