"""W4 online: calls admitted as they arrive, with a counter per UTC day.

The counter is keyed state of the stream, so it outlives micro-batches and
restarts on the same checkpoint.  Inside a micro-batch calls are taken by time,
then id; calls of earlier micro-batches came first.  On input that arrives in
that order the result is the batch ranking's (``quota.admit_calls``).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from strata.operators.quota import DEFAULT_MAX_CALLS_PER_DAY

STATE = "made int"


def reserve_calls(calls: DataFrame, ts: str, call_id: str, cap: int = DEFAULT_MAX_CALLS_PER_DAY) -> DataFrame:
    """Every call of a stream with ``call_date``, ``call_number`` (null when
    skipped) and ``admitted``.

    The state is one counter a day and is kept: a call that comes late for its
    day still meets the day's count.  No timer closes a day, since a query with
    timers never ends by itself.  Calls without a time form a day of their own.
    A task holds the times and ids of one day's calls in one micro-batch, which
    the source's read limit bounds."""

    def answer(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        made = state.get[0] if state.exists else 0
        rows = pd.concat(list(chunks), ignore_index=True)
        rows = rows.sort_values(["ts", "id"], kind="stable", na_position="last", ignore_index=True)
        number = pd.Series(range(made + 1, made + 1 + len(rows)), dtype="Int32")
        admitted = number <= cap
        state.update((made + int(admitted.sum()),))
        yield pd.DataFrame({"id": rows["id"], "ts": rows["ts"], "call_date": rows["call_date"], "call_number": number.where(admitted), "admitted": admitted.astype(bool)})

    given = calls.select(F.col(call_id).alias("id"), F.col(ts).alias("ts"), F.to_date(F.col(ts)).alias("call_date"))
    id_type, ts_type = (given.schema[c].dataType.simpleString() for c in ("id", "ts"))
    schema = f"id {id_type}, ts {ts_type}, call_date date, call_number int, admitted boolean"
    answered = given.groupBy("call_date").applyInPandasWithState(answer, schema, STATE, "append", GroupStateTimeout.NoTimeout)
    return answered.withColumnsRenamed({"id": call_id, "ts": ts})
