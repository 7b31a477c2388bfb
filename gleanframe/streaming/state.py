"""What the stateful streams keep per URL, in Spark's own state store."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql.streaming.state import GroupState

# Rows of a URL that were collected before they are sorted.
_CHUNK = 1 << 16


# By how much the times of rows are moved up for the watermark: to 2070.
EPOCH_MS = 100 * 365 * 86_400_000


def first_of_key(columns: list[str], ts: str, tie: str, delay_ms: int):
    """Pass on the first row of a key, by (ts, tie) within a batch and by arrival over batches, and forget the key
    ``delay_ms`` after that row's time. State: that time. Rows bring their moved time as ``_ms``."""
    def pass_on(_: tuple, frames: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        watermark = state.getCurrentWatermarkMs() + 1
        known = state.exists and state.get[0] + delay_ms > watermark
        first = None
        for frame in frames:  # read to their end in any case
            if not known:
                both = frame if first is None else pd.concat([first, frame])
                first = both.sort_values([ts, tie]).head(1)
        if first is not None:
            at = int(first["_ms"].iloc[0])
            state.update((at,))
            state.setTimeoutTimestamp(max(at + delay_ms, watermark))
            yield first[columns]
    return pass_on


def numbered_failures(key: str, order: list[str]):
    """Number the failures of a URL, going on from those before. State: how many there were.

    Of a URL only the order columns of one batch are held, which the batch's size bounds.
    """
    def number(_: tuple, frames: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(frames)).sort_values(order, kind="stable")
        before = state.get[0] if state.exists else 0
        state.update((before + len(rows),))
        for start in range(0, len(rows), _CHUNK):
            part = rows.iloc[start:start + _CHUNK]
            yield part.assign(attempt=np.arange(before + start + 1, before + start + len(part) + 1))[
                [key, *order, "attempt"]]
    return number
