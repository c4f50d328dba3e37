"""Outages and running transfers of energy-storage stations over a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionflow.defaults import TRANSFER_GAP_MS
from sessionflow.functions.timeconv import time_ms
from sessionflow.operators.trips import just_opened
from sessionflow.plans.islands import islands, key_list


def station_outages(
    df: DataFrame,
    key: str | Sequence[str] = "stationId",
    ts: str = "dataTime",
    gap_ms: int = TRANSFER_GAP_MS,
) -> DataFrame:
    """Outages (``status`` true) and the running transfer of each station (``status`` false).

    An outage row starts when the station sends again and ends with the last row before the
    silence, so ``startTime - endTime`` is how long it lasted. A running transfer goes from its
    first to its last row; none is reported if the last row of the station opened it.

    An island says both: its start and the end of its predecessor make an outage, and the last
    one is the running transfer. Both rows come from one pass.
    """
    found = islands(df, key, time_ms(df, ts), gap_ms)
    outage = F.when(F.col("prev_end_ms").isNotNull(), _event(F.col("start_ms"), F.col("prev_end_ms"), True))
    running = F.when(
        F.col("is_last") & ~just_opened(), _event(F.col("start_ms"), F.col("end_ms"), False)
    )
    events = found.select(*key_list(key), F.explode(F.array(outage, running)).alias("event"))
    return events.where(F.col("event").isNotNull()).select(*key_list(key), "event.*")


def _event(start, end, status: bool):
    return F.struct(
        start.alias("startTime"), end.alias("endTime"), F.lit(status).alias("status")
    )


def outage_ms(events: DataFrame) -> DataFrame:
    """How long each outage of ``station_outages`` lasted."""
    return events.where("status").withColumn("outageMs", F.col("startTime") - F.col("endTime"))
