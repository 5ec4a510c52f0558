"""Gauge readings and occupations as streams."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

RUNS = "river string, perfil string, ts timestamp, run long"


def occupations(transects: DataFrame, tolerance: float) -> DataFrame:
    """Runs of a stream of transects (river, perfil, ts, chainage), kept per river as they arrive.

    A transect joins the run while it lies within ``tolerance`` of the run's first; else
    it starts the next. State: the run's number and its first chainage.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        run, first = state.get if state.exists else (-1, None)
        rows = pd.concat(list(batches)).sort_values(["ts", "perfil"])
        out = []
        for place in rows.chainage:
            if first is None or abs(place - first) > tolerance:
                run, first = run + 1, place
            out.append(run)
        state.update((int(run), float(first)))
        yield pd.DataFrame({"river": key[0], "perfil": rows.perfil, "ts": rows.ts, "run": out})

    return transects.groupBy("river").applyInPandasWithState(
        step, RUNS, "run long, first double", "append", GroupStateTimeout.NoTimeout
    )
