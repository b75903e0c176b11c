"""The sequential gate as keyed state: requests of a model wait for their time and meet the incumbent in order."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: What a decision needs of a request and its dossier, in the columns that the batch gate uses.
CARRIED = (
    "version string, approved_by string, seq bigint, micros bigint, metric_label string, score double, margin double, floor double"
)
#: Waiting requests are kept by slices of this many milliseconds: some values and one timer for each.
SLICE = 600_000
#: So many new requests of a model are held before they are written to its state.
HELD = 200_000
NAMES = [c.strip().split(" ")[0] for c in CARRIED.split(",")]
OUTPUT = (
    f"model string, {CARRIED}, incumbent_version string, incumbent_score double, "
    "_static struct<status: int, reason: string>, late boolean"
)


class PromotionProcessor(StatefulProcessor):
    """State of one model: its incumbent, and the waiting requests by slice of time with a timer at the first of each.

    Requests that are refused whatever the incumbent pass at once. Waiting ones are decided when the watermark reaches
    their millisecond; timers fire in order, so each slice meets the incumbent that all earlier ones left, and what the
    watermark has not reached of a slice waits for a new timer. Slices are removed as they are settled, so the state
    holds what came within the delay, and one row for the incumbent. The calls to the state grow with slices, not rows.
    A task holds ``HELD`` new requests, or those of one slice: a slice is written in parts, and part -1 has the time of
    its timer and the number of parts.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.incumbent = handle.getValueState("incumbent", "version string, score double")
        self.waiting = handle.getMapState("waiting", "slice bigint, part bigint", f"first bigint, parts bigint, requests array<struct<{CARRIED.replace(' ', ': ').replace(',:', ',')}>>")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.incumbent.update((initialState.incumbent_version, initialState.incumbent_score))

    def _row(self, key, carried, incumbent=(None, None), static=None, late=False) -> Row:
        return Row(*OUTPUT_NAMES)(key[0], *carried, *incumbent, static, late)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        mark, new, held = timerValues.getCurrentWatermarkInMs(), {}, 0
        for row in rows:
            if row["_tick"]:
                continue
            carried = tuple(row[c] for c in NAMES)
            ms = None if row["micros"] is None else row["micros"] // 1000
            # A watermark of 0 is none: nothing has been settled yet.
            if ms is not None and 0 < mark and ms <= mark:
                yield self._row(key, carried, late=True)
            elif row["_static"] is not None:
                yield self._row(key, carried, static=row["_static"])
            else:
                new.setdefault(ms // SLICE, []).append(carried)
                held += 1
                if held == HELD:
                    self._keep(new)
                    new, held = {}, 0
        self._keep(new)

    def _keep(self, new: dict[int, list[tuple]]) -> None:
        for at, requests in new.items():
            first, parts = min(map(_ms, requests)), 0
            if self.waiting.containsKey((at, -1)):
                known, parts = tuple(self.waiting.getValue((at, -1)))[:2]
                if first < known:
                    self.handle.deleteTimer(known)
                    self.handle.registerTimer(first)
                first = min(first, known)
            else:
                self.handle.registerTimer(first)
            self.waiting.updateValue((at, parts), (0, 0, requests))
            self.waiting.updateValue((at, -1), (first, parts + 1, []))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        at = expiredTimerInfo.getExpiryTimeInMs()
        mark, part = max(at, timerValues.getCurrentWatermarkInMs()), at // SLICE
        parts = tuple(self.waiting.getValue((part, -1)))[1]
        requests = sorted((tuple(r) for i in range(parts) for r in tuple(self.waiting.getValue((part, i)))[2]), key=_order)
        due = [r for r in requests if _ms(r) <= mark]
        rest = requests[len(due):]
        for i in range(1 if rest else 0, parts):
            self.waiting.removeKey((part, i))
        if rest:
            self.waiting.updateValue((part, 0), (0, 0, rest))
            self.waiting.updateValue((part, -1), (_ms(rest[0]), 1, []))
            self.handle.registerTimer(_ms(rest[0]))
        else:
            self.waiting.removeKey((part, -1))
        start = incumbent = tuple(self.incumbent.get()) if self.incumbent.exists() else (None, None)
        for carried in due:
            yield self._row(key, carried, incumbent)
            version, score, margin, floor = (carried[NAMES.index(c)] for c in ("version", "score", "margin", "floor"))
            # NaN is above every number here, as it is in the batch gate.
            bar = floor if incumbent[1] is None else incumbent[1] + margin
            if score != score or score >= bar:
                incumbent = (version, score)
        if incumbent is not start:
            self.incumbent.update(incumbent)

    def close(self) -> None:
        pass


OUTPUT_NAMES = ["model", *NAMES, "incumbent_version", "incumbent_score", "_static", "late"]


def _ms(carried: tuple) -> int:
    return carried[NAMES.index("micros")] // 1000


def _order(carried: tuple) -> tuple:
    """Micros, then seq, version and approver; nulls first, as Spark sorts them."""
    values = [carried[NAMES.index(c)] for c in ("micros", "seq", "version", "approved_by")]
    return tuple((v is not None, v) if v is not None else (False, 0) for v in values)


def in_order(rows: DataFrame, incumbents: DataFrame | None = None) -> DataFrame:
    """Every request once, with the incumbent that it met, or ``late``.

    ``rows`` are a stream with a watermark on ``ts``, enriched by ``gate.with_dossiers``, with the refusal in ``_static``
    and ``_tick`` for rows that only move the watermark. The state is handed the time as a number: Spark would drop
    rows behind the watermark unseen if it still knew the column.
    """
    slim = rows.withColumn("micros", F.unix_micros("ts")).select("model", *NAMES, "_static", "_tick")
    start = None if incumbents is None else incumbents.groupBy("model")
    out = slim.groupBy("model").transformWithState(
        statefulProcessor=PromotionProcessor(), outputStructType=OUTPUT, outputMode="Append", timeMode="eventTime",
        initialState=start,
    )
    return out.withColumn("ts", F.timestamp_micros("micros"))
