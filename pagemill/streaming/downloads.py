"""Which download of a file is in effect, as keyed state that events reach in any order."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

EFFECTS_DDL = "key STRING, seq BIGINT, amount BIGINT, active BOOLEAN"


class DownloadsInEffect(StatefulProcessor):
    """Per file the first download after the last revert; a row whenever events came.

    Events have key, seq, amount, at and kind ('downloaded' or 'reverted'); seq grows with at. State: the
    last revert and the downloads after it, since a revert that is still to come may fall between them. Of
    those before the watermark, which no event to come precedes, the first is enough.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._state = handle.getValueState("effect", "reverted BIGINT, downloads BINARY")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        events = pd.concat(rows)
        reverted, held = self._state.get() or (-1, b"")
        back = events["kind"].to_numpy() == "reverted"
        seq = events["seq"].to_numpy(np.int64)
        reverted = max([int(reverted), *seq[back].tolist()])
        micros = events["at"].to_numpy("datetime64[us]").astype(np.int64)
        amount = events["amount"].fillna(0).to_numpy(np.int64)  # reverts have none
        came = np.column_stack([seq, amount, micros])[~back]
        # seq, amount, at
        downloads = np.vstack([np.frombuffer(held, np.int64).reshape(-1, 3), came])
        downloads = downloads[downloads[:, 0] > reverted]
        downloads = downloads[np.unique(downloads[:, 0], return_index=True)[1]]
        settled = downloads[:, 2] <= 1000 * timerValues.getCurrentWatermarkInMs()
        settled[:1] = False
        downloads = downloads[~settled]
        self._state.update((reverted, downloads.tobytes()))
        yield pd.DataFrame(
            {
                "key": [key[0]],
                "seq": [int(seq.max())],
                "amount": pd.array([int(downloads[0, 1]) if len(downloads) else None], "Int64"),
                "active": [len(downloads) > 0],
            }
        )

    def close(self) -> None:
        pass
