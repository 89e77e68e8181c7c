"""Workers that are at work, as keyed state; and which version of their view is the current one."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from pagemill.sources.files import open_input, open_output, rename

CHANGES_DDL = "worker BIGINT, seq BIGINT, filename STRING, active BOOLEAN"
LATE_SECONDS = 3600
_POINTER = "_current"


def _last_of(messages: pd.DataFrame) -> tuple[int, str, str | None]:
    i = messages["seq"].to_numpy().argmax()
    return int(messages["seq"].iat[i]), messages["status"].iat[i], messages["filename"].iat[i]


class ActiveWorkers(StatefulProcessor):
    """Per worker the message with the largest seq decides; a row for every change.

    State `active` (seq, filename) is there while the worker is; `ended` (seq) expires.
    """

    def __init__(self, late_seconds: int = LATE_SECONDS):
        self._late = 1000 * late_seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._active = handle.getValueState("active", "seq BIGINT, filename STRING")
        self._ended = handle.getValueState("ended", "seq BIGINT", self._late)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        seq, status, filename = max(map(_last_of, rows), key=lambda r: r[0])
        active, ended = self._active.get(), self._ended.get()
        if any(state is not None and state[0] >= seq for state in (active, ended)):
            return  # a late message
        starts = status == "start"
        if starts:
            self._active.update((seq, filename))
        else:
            if active is not None:
                self._active.clear()
            self._ended.update((seq,))
        yield pd.DataFrame(
            {
                "worker": [int(key[0])],
                "seq": [seq],
                "filename": [filename if starts else None],
                "active": [starts],
            }
        )

    def close(self) -> None:
        pass


def name_place(table: str, place: str) -> None:
    """From now on `place` is the current version: one rename."""
    partial = f"{table}/{_POINTER}.{uuid.uuid4().hex}"
    with open_output(partial) as file:
        file.write(place.encode())
    rename(partial, f"{table}/{_POINTER}")


def named_place(table: str) -> str | None:
    try:
        with open_input(f"{table}/{_POINTER}") as file:
            return file.read().decode()
    except FileNotFoundError:
        return None
