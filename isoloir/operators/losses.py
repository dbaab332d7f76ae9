"""How many rows a plan leaves out, counted while it runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation


class Losses:
    """Counts that operators add to a plan; they are there once an action has run it.

    Counting costs no pass of its own. Where a plan is run several times, the first run counts;
    a run that stops early, as ``first`` does, counts what it has seen.
    """

    def __init__(self) -> None:
        self._observed: list[Observation] = []

    def watch(self, df: DataFrame, **counts: Column) -> DataFrame:
        """``df``, with aggregates of its rows under these names."""
        observation = Observation()
        self._observed.append(observation)
        return df.observe(observation, *[c.alias(name) for name, c in counts.items()])

    @property
    def counts(self) -> dict[str, int]:
        """Every count by name, ``_`` left out; waits for the first action on what is watched."""
        return {name: n for observation in self._observed for name, n in observation.get.items() if name != "_"}
