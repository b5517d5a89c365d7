"""Low-latency form: the last five results per team kept as streaming state."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

Write = Callable[[DataFrame, int], None]

# the processor travels with the query, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LAST = 5
GROUP = ["season", "league", "team"]
OUTPUT = "season string, league string, team string, match_id bigint, side string, at bigint, points int, form5 bigint, late boolean"
# Waiting rows are kept by hour, in microseconds.
HOUR = 3_600_000_000
# The watermarked column lies this far (1000 years) ahead of the rows' times, so that Spark drops none as late.
AHEAD = "INTERVAL 8760000 HOURS"
# Rows of a team travel together: in and out of the state, and in it. ``named`` and ``given`` say that match_id and points
# are not null; ``side`` is a place in the sorted names that stand beside the rows.
PLACE = np.dtype([("at", "<i8"), ("named", "?"), ("match_id", "<i8"), ("side", "<i4"), ("given", "?"), ("points", "<i4")])
FORM = np.dtype([*PLACE.descr, ("begun", "?"), ("form5", "<i8")])
KEYS = "season string, league string, team string"
PACKED = f"{KEYS}, rows binary, sides array<string>"
PACKED_FORM = f"{PACKED}, late boolean"
# Rows that a task looks at to find those of one team, and rows of a team that travel together.
AT_ONCE = 250_000
TOGETHER = 1_000

Rows = tuple[np.ndarray, list]


def ordered(name: str | None) -> tuple[bool, str]:
    """Sort key of a side: null first."""
    return name is not None, name or ""


def united(parts: list[Rows]) -> Rows:
    """All rows in the order of their places; of those that share one, the last one given."""
    names = sorted({name for _, sides in parts for name in sides}, key=ordered)
    spot = {name: i for i, name in enumerate(names)}
    moved = []
    for rows, sides in parts:
        if sides != names:
            rows = rows.copy()
            rows["side"] = np.array([spot[name] for name in sides], np.int32)[rows["side"]]
        moved.append(rows)
    rows = np.concatenate(moved)
    # stable, so what is given later stays behind
    rows = rows[np.lexsort((rows["side"], rows["match_id"], rows["named"], rows["at"]))]
    same = np.ones(max(len(rows) - 1, 0), bool)
    for name in ("at", "named", "match_id", "side"):
        same &= rows[name][1:] == rows[name][:-1]
    return rows[np.append(~same, True)] if same.any() else rows, names


def up_to(rows: np.ndarray, sides: list, last: tuple) -> np.ndarray:
    """Which rows stand at the place ``last`` (at, match_id, side) or before it."""
    at, match_id, side = last
    number = match_id or 0
    known = match_id is not None
    beside = np.array([ordered(name) <= ordered(side) for name in sides], bool)[rows["side"]]
    same_match = (rows["named"] == known) & (rows["match_id"] == number)
    before = (rows["named"] < known) | ((rows["named"] == known) & (rows["match_id"] < number)) | (same_match & beside)
    return (rows["at"] < at) | ((rows["at"] == at) & before)


def last_place(rows: np.ndarray, sides: list) -> tuple:
    row = rows[-1]
    return int(row["at"]), int(row["match_id"]) if row["named"] else None, sides[row["side"]]


def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of GROUP, match_id, side, points, at as rows of PACKED, one for up to TOGETHER rows of a team."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= AT_ONCE:
            yield from packed_rows(pa.Table.from_batches(held).combine_chunks())
            held, size = [], 0
    if size:
        yield from packed_rows(pa.Table.from_batches(held).combine_chunks())


def codes(column: pa.ChunkedArray) -> tuple[np.ndarray, pa.Array]:
    """Number of each value, null among them, and the values."""
    whole = column.combine_chunks().dictionary_encode(null_encoding="encode")
    return whole.indices.to_numpy().astype(np.int64), whole.dictionary


def packed_rows(table: pa.Table) -> Iterator[pa.RecordBatch]:
    if table["at"].null_count:
        raise ValueError("a row without match_time has no place in a stream")
    rows = np.empty(table.num_rows, PLACE)
    rows["at"] = table["at"].to_numpy()
    for name, valid in (("match_id", "named"), ("points", "given")):
        rows[name] = table[name].fill_null(0).to_numpy()
        rows[valid] = table[name].is_valid().to_numpy()
    side, names = codes(table["side"])
    names = names.to_pylist()
    sides = sorted(names, key=ordered)
    rows["side"] = np.array([sides.index(name) for name in names], np.int32)[side]
    group, keys = np.zeros(len(rows), np.int64), []
    for name in GROUP:
        own, values = codes(table[name])
        # renumbered each time, so numbers stay below that of the rows
        group = np.unique(group * len(values) + own, return_inverse=True)[1]
        keys.append((own, values))
    order = np.argsort(group, kind="stable")
    begin = np.flatnonzero(np.append(True, group[order][1:] != group[order][:-1]))
    ends = np.append(begin[1:], len(order))
    cuts = [(at, min(at + TOGETHER, end)) for low, end in zip(begin.tolist(), ends.tolist()) for at in range(low, end, TOGETHER)]
    first, rows = order[[low for low, _ in cuts]], rows[order]
    yield pa.RecordBatch.from_arrays(
        [
            *[values.take(pa.array(own[first])) for own, values in keys],
            pa.array([rows[low:high].tobytes() for low, high in cuts], pa.binary()),
            pa.array([sides] * len(cuts), pa.list_(pa.string())),
        ],
        names=[*GROUP, "rows", "sides"],
    )


def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of PACKED_FORM as rows of OUTPUT."""
    for batch in batches:
        for start in range(0, batch.num_rows, TOGETHER):
            part = batch.slice(start, TOGETHER)
            made = [np.frombuffer(rows, FORM) for rows in part["rows"].to_pylist()]
            owner = pa.array(np.repeat(np.arange(len(made)), [len(rows) for rows in made]))
            rows = np.concatenate(made)
            # flattened, the names of a row begin behind those of the rows before it
            names = part["sides"].flatten()
            counts = np.array([len(sides) for sides in part["sides"]], np.int64)
            spot = rows["side"] + (np.cumsum(counts) - counts)[owner.to_numpy()]
            yield pa.RecordBatch.from_arrays(
                [
                    *[part[name].take(owner) for name in GROUP],
                    pa.array(rows["match_id"], mask=~rows["named"]), names.take(pa.array(spot)), pa.array(rows["at"]),
                    pa.array(rows["points"], mask=~rows["given"]), pa.array(rows["form5"], mask=~rows["begun"]),
                    part["late"].take(owner),
                ],
                names=[*GROUP, "match_id", "side", "at", "points", "form5", "late"],
            )


class LastFive(StatefulProcessor):
    """Holds rows back until the watermark has passed them, then emits them in time order.

    State per team: the waiting rows by hour, the hours that have any, the points of the last five emitted
    rows, the place of the last of them, and the time of the one timer that is set. A batch writes the hours
    of its rows; a timer reads the hours that are due and no others. A row that belongs before an emitted
    one is late: it is passed on as such and changes nothing. Times are whole microseconds, so they do
    not depend on the time zone of a Python worker. Rows come and go packed, as Python takes far longer for
    each row that Spark hands it than for the rows in it.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "hour bigint", "rows binary, sides array<string>")
        self.hours = handle.getValueState("hours", "hours array<bigint>")
        self.recent = handle.getValueState("recent", "points array<int>")
        self.last = handle.getValueState("last", "at bigint, match_id bigint, side string")
        self.timer = handle.getValueState("timer", "at bigint")

    def handleInitialState(self, key: Any, initialState: Row, timerValues: Any) -> None:
        """What a batch job knows of a team when the stream starts."""
        self.recent.update((list(initialState.recent),))
        self.last.update((initialState.at, initialState.match_id, initialState.side))

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        last = tuple(self.last.get()) if self.last.exists() else None
        arrived: list[Rows] = []
        for row in rows:
            own, sides = np.frombuffer(row.rows, PLACE), list(row.sides)
            late = up_to(own, sides, last) if last else np.zeros(len(own), bool)
            if late.any():
                yield self._row(key, own[late], sides, None, True)
                own = own[~late]
            if len(own):
                arrived.append((own, sides))
        if not arrived:
            return
        new, sides = united(arrived)
        by_hour = new["at"] // HOUR
        cuts = np.flatnonzero(np.append(True, by_hour[1:] != by_hour[:-1])).tolist()
        known = set(self.hours.get()[0]) if self.hours.exists() else set()
        hours = by_hour[cuts].tolist()
        for hour, low, high in zip(hours, cuts, [*cuts[1:], len(new)]):
            own = (new[low:high], sides)
            self._keep(hour, *(united([self._of(hour), own]) if hour in known else own))
        if not known.issuperset(hours):
            self.hours.update((sorted(known.union(hours)),))
        self._set_timer(min(int(new["at"][0]), self._due()))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        self.timer.clear()
        hours = list(self.hours.get()[0]) if self.hours.exists() else []
        recent = list(self.recent.get()[0]) if self.recent.exists() else []
        last = None
        while hours and hours[0] * HOUR <= watermark:
            rows, sides = self._of(hours[0])
            due = int(np.searchsorted(rows["at"], watermark, side="right"))
            if due:
                ready = rows[:due]
                yield self._row(key, ready, sides, recent, False)
                given = zip(ready["given"][-LAST:].tolist(), ready["points"][-LAST:].tolist())
                recent = [*recent, *[points if known else None for known, points in given]][-LAST:]
                last = last_place(ready, sides)
                self._keep(hours[0], rows[due:], sides)
            if due < len(rows):
                break
            hours.pop(0)
        if last:
            self.recent.update((recent,))
            self.last.update(last)
        self.hours.update((hours,)) if hours else self.hours.clear()
        if hours:
            self._set_timer(int(self._of(hours[0])[0]["at"][0]))

    @staticmethod
    def _row(key: Any, rows: np.ndarray, sides: list, recent: list | None, late: bool) -> Row:
        """Packed rows with their form, given the points of those before them; late rows have none."""
        season, league, team = key
        made = np.zeros(len(rows), FORM)
        for name in PLACE.names:
            made[name] = rows[name]
        if not late:
            points = np.append([point or 0 for point in recent], np.where(rows["given"], rows["points"], 0)).astype(np.int64)
            total = np.append(0, np.cumsum(points))
            here = np.arange(len(recent), len(points))
            made["form5"] = total[here] - total[np.maximum(here - LAST, 0)]
            made["begun"] = here > 0
        return Row(season=season, league=league, team=team, rows=made.tobytes(), sides=sides, late=late)

    def _of(self, hour: int) -> Rows:
        """Waiting rows of an hour that has some, in order."""
        rows, sides = self.waiting.getValue((hour,))
        return np.frombuffer(rows, PLACE), list(sides)

    def _keep(self, hour: int, rows: np.ndarray, sides: list) -> None:
        if len(rows):
            self.waiting.updateValue((hour,), (rows.tobytes(), sides))
        else:
            self.waiting.removeKey((hour,))

    def _due(self) -> float:
        return self.timer.get()[0] * 1000 if self.timer.exists() else float("inf")

    def _set_timer(self, at: int) -> None:
        """One timer per team, at the earliest waiting row, rounded up to whole milliseconds."""
        due = int(-(-at // 1000))
        if self.timer.exists():
            if self.timer.get()[0] <= due:
                return
            self.handle.deleteTimer(self.timer.get()[0])
        self.handle.registerTimer(due)
        self.timer.update((due,))


def tails(teams: DataFrame) -> DataFrame:
    """State of each team after ``teams`` (a batch, columns as for ``form_and_late``): one row with the points of its
    last five rows and the place of the last one. Spark keeps five rows of a team and task before the shuffle."""
    rows = teams.withColumn("at", F.unix_micros("match_time"))
    order = ["at", "match_id", "side"]
    newest = Window.partitionBy(*GROUP).orderBy(*[F.desc(name) for name in order])
    kept = rows.withColumn("_place", F.row_number().over(newest)).where(F.col("_place") <= LAST)
    listed = F.sort_array(F.collect_list(F.struct(*order, F.col("points").cast("int").alias("points")))).alias("rows")
    return kept.groupBy(*GROUP).agg(listed).select(
        *GROUP, F.col("rows.points").alias("recent"), *[F.element_at(f"rows.{name}", -1).alias(name) for name in order]
    )


def form_and_late(teams: DataFrame, delay: str, history: DataFrame | None = None) -> DataFrame:
    """Stream of team rows to stream of form: points of the team's five games before each one.

    ``teams`` has GROUP, match_id, side, points and ``match_time`` (timestamp). Rows may come up to
    ``delay`` out of order; they are emitted once the watermark has passed them, so the result
    equals the batch window. Rows that belong before an emitted row of their team are emitted at once
    with ``late`` set and without form, so no row is lost: give them a sink of their own (``split_late``) and
    send their matches to ``incremental``, which takes matches of any age.

    ``history`` (from ``tails``) is where the first batch of a stream starts; its teams go on from there.
    """
    rows = teams.select(
        *GROUP, "match_id", "side", F.col("points").cast("int").alias("points"),
        F.unix_micros("match_time").alias("at"), F.expr(f"match_time + {AHEAD}").alias("clock"),
    )
    start = history.groupBy(*GROUP) if history is not None else None
    return (
        rows.withWatermark("clock", f"{delay} {AHEAD.removeprefix('INTERVAL ').lower()}")
        .drop("clock")
        .mapInArrow(packed, PACKED)
        .groupBy(*GROUP)
        .transformWithState(LastFive(), PACKED_FORM, "Append", "EventTime", start)
        .mapInArrow(unpacked, OUTPUT)
        .withColumn("match_time", F.timestamp_micros("at"))
        .drop("at")
    )


def last_five(teams: DataFrame, delay: str, history: DataFrame | None = None) -> DataFrame:
    """``form_and_late`` without the late rows."""
    return form_and_late(teams, delay, history).where("not late").drop("late", "points")


def split_late(form: Write, late: Write) -> Write:
    """Writes rows in time and late rows of a batch of ``form_and_late`` apart."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            form(batch.where("not late").drop("late", "points"), batch_id)
            late(batch.where("late").drop("late", "form5"), batch_id)
        finally:
            batch.unpersist()

    return write
