"""Ordered state on streams: each key's events in event-time order, however they arrive.

Keys are dealt to groups, and the state of a group lies in rows that hold many events or many keys each: a call from Python to
the state store costs far more than a row, and a value with columns is converted field by field, so what a row holds is packed
into bytes and compressed. Spark hands rows to Python value by value as well, so an event comes as one JSON text, and what is given goes back as
data frames (``Framed``). Events wait in chunks, sorted by (time, event id) and named by their first time. A
timer ends the first second that waits once the watermark has passed it; then the events of all seconds that the watermark has
passed, and no others, are merged from their chunks and taken in order. An event is written and read once, beside those that
share a chunk with the watermark. What is kept of a key lies in one of the pages of its group; a key without events for
``idle`` milliseconds is forgotten.
"""

import json
import pickle
import random
from collections import namedtuple
from collections.abc import Iterator
from copy import copy
from heapq import heappop, heappush, heapreplace
from itertools import chain, islice
from operator import itemgetter
from types import SimpleNamespace
from zlib import compress, crc32, decompress

import pandas as pd
from pyspark.sql import DataFrame, Row, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from clickloom.functions.numeric import seconds

DELAY, IDLE = "30 minutes", "90 days"
SECOND = 1000
# Groups of keys, pages of a group, events that arrive and are sorted together, rows of a chunk, entries kept in a page.
GROUPS, PAGES = 1024, 8
ARRIVALS, CHUNK, INLINE = 10_000, 250, 20
# Rows of a data frame that goes back to Spark.
FRAME = 10_000


def second_end(us: int) -> int:
    """The end, in milliseconds, of the second that holds this time in microseconds."""
    return (us // 1_000_000 + 1) * SECOND


def place(row: tuple) -> tuple:
    """The order of rows that begin with a time and an id."""
    return row[0], row[1] is not None, row[1] or ""


def packed(value) -> tuple[bytes]:
    """Plain values (numbers, texts, None, and tuples, lists and dicts of them) as a row of the state. Sorted events are much
    alike, and each lies on disk in the store and in its checkpoint."""
    return (compress(pickle.dumps(value, pickle.HIGHEST_PROTOCOL), 1),)


def unpacked(row: tuple):
    return pickle.loads(decompress(row[0]))


class TimeOrdered(StatefulProcessor):
    """Base of the ordered processors. ``fields`` names what is kept of a waiting event beside ``us`` and ``event_id``,
    ``memory`` what is kept of a key, with its first value. Without ``keys``, columns of text, a group is one key."""

    fields: tuple[str, ...] = ()
    memory: dict[str, object] = {}

    def __init__(self, idle: int, keys: tuple[str, ...] = ()):
        self.idle, self.keys = idle, keys

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.event = namedtuple("Event", ("us", "event_id", *self.keys, *self.fields))
        self.waiting = handle.getMapState("waiting", "us long, chunk long", "events binary")
        self.alarms = handle.getMapState("alarms", "us long, chunk long", "alarms binary")
        self.pages = handle.getMapState("pages", "page long", "keys binary")
        self.served: dict[tuple, int] = {}

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        rows = iter(rows)
        for first in islice(rows, 1):
            places = [first.__fields__.index(name) for name in self.event._fields]
            rows = map(itemgetter(*places), map(tuple, chain((first,), rows)))
        self.await_time(rows)
        return iter(())

    def await_time(self, rows: Iterator[tuple]) -> None:
        """Let events, values in the order of ``event``, wait for the watermark."""
        ends = []
        while events := list(islice(rows, ARRIVALS)):
            events.sort(key=place)
            self.keep(self.waiting, events)
            ends += [events[0][0], events[-1][0]]
        for until in {second_end(min(ends)), second_end(max(ends))} if ends else ():
            self.handle.registerTimer(until)

    def keep(self, chunks, rows: list[tuple]) -> None:
        """Store sorted rows in chunks, column by column, which compresses best."""
        for at in range(0, len(rows), CHUNK):
            part = rows[at:at + CHUNK]
            chunks.updateValue((part[0][0], random.getrandbits(62)), packed(tuple(zip(*part))))

    def due(self, chunks, before: int) -> Iterator[tuple]:
        """Take the rows before a time from their chunks, in order. A chunk is opened when its first row is due."""
        names = sorted((tuple(n) for n in chunks.keys() if n[0] < before), reverse=True)
        heap, rows = [], {}
        while names or heap:
            while names and (not heap or names[-1][0] <= heap[0][0][0]):
                name = names.pop()
                held = list(zip(*unpacked(chunks.getValue(name))))
                chunks.removeKey(name)
                now = [r for r in held if r[0] < before]
                if len(now) < len(held):
                    self.keep(chunks, held[len(now):])
                rows[name] = iter(now)
                row = next(rows[name])
                heappush(heap, (place(row), name, row))
            _, name, row = heap[0]
            yield row
            after = next(rows[name], None)
            if after is None:
                heappop(heap)
                del rows[name]
            else:
                heapreplace(heap, (place(after), name, after))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        at = expiredTimerInfo.getExpiryTimeInMs()
        mark = at if timerValues is None else max(at, timerValues.getCurrentWatermarkInMs())
        if self.served.get(tuple(key), mark - 1) >= mark:
            return
        self.served[tuple(key)] = mark
        opened: dict[int, dict] = {}
        touched: dict[tuple, SimpleNamespace] = {}

        def known(who):
            if who not in touched:
                page = crc32(repr(who).encode()) % PAGES
                if page not in opened:
                    opened[page] = self.read_page(page)
                touched[who] = opened[page].setdefault(who, self.blank())
            return touched[who]

        for row in self.due(self.waiting, mark // SECOND * 1_000_000):
            event = self.event._make(row)
            who = tuple([getattr(event, k) for k in self.keys]) or tuple(key)
            state, until = known(who), second_end(event.us)
            if state.last is not None and until > state.last + self.idle:
                yield from self.pause(who, state, state.last + self.idle)
                self.forget(who, state)
            state.last = until
            yield from self.take(who, state, event)
        for _, _, who in self.due(self.alarms, mark * 1000 + 1):
            known(who)

        alarms = []
        for who, state in touched.items():
            if state.last is None:  # forgotten since the alarm was set
                wake = None
            else:
                yield from self.pause(who, state, mark)
                wake = self.wake(state, mark)
            if wake is None:
                self.forget(who, state)
                del opened[crc32(repr(who).encode()) % PAGES][who]
                continue
            if state.wake is None or state.wake <= mark:
                state.wake = wake
                alarms.append((wake * 1000, None, who))
            self.settle(who, state)
        for page, states in opened.items():
            self.write_page(page, states)
        self.keep(self.alarms, sorted(alarms, key=lambda a: a[0]))
        ahead = {second_end(n[0]) for n in [min(self.waiting.keys(), default=None)] if n}
        ahead |= {n[0] // 1000 for n in [min(self.alarms.keys(), default=None)] if n}
        for until in ahead:
            self.handle.registerTimer(until)

    def blank(self) -> SimpleNamespace:
        """What is kept of a key without events."""
        return SimpleNamespace(last=None, wake=None, **{n: copy(first) for n, first in self.memory.items()})

    def read_page(self, page: int) -> dict[tuple, SimpleNamespace]:
        if not self.pages.containsKey((page,)):
            return {}
        names = ["last", "wake", *self.memory]
        return {who: SimpleNamespace(**dict(zip(names, kept))) for who, *kept in unpacked(self.pages.getValue((page,)))}

    def write_page(self, page: int, states: dict[tuple, SimpleNamespace]) -> None:
        if states:
            rows = [(who, s.last, s.wake, *[getattr(s, n) for n in self.memory]) for who, s in states.items()]
            self.pages.updateValue((page,), packed(rows))
        elif self.pages.containsKey((page,)):
            self.pages.removeKey((page,))

    def take(self, who: tuple, state: SimpleNamespace, event) -> Iterator[Row]:
        """The output of the next event in order."""
        return iter(())

    def pause(self, who: tuple, state: SimpleNamespace, at: int) -> Iterator[Row]:
        """What is due at a time, after the events before it were taken."""
        return iter(())

    def wake(self, state: SimpleNamespace, mark: int) -> int | None:
        """When the key has something due without further events; None if it can be forgotten."""
        end = state.last + self.idle
        return end if end > mark else None

    def settle(self, who: tuple, state: SimpleNamespace) -> None:
        """Move what is too much for a page to state of its own."""

    def forget(self, who: tuple, state: SimpleNamespace) -> None:
        """Clear what is kept of the key; an alarm that is set stays known."""
        vars(state).update(vars(self.blank()) | {"wake": state.wake})

    def close(self) -> None:
        pass


class Framed(StatefulProcessor):
    """``processor`` over events that are JSON texts in a column ``event``; what it gives comes as data frames with the columns
    ``names``. A frame holds one key's rows of a call, in parts if there are many."""

    def __init__(self, processor: TimeOrdered, names: list[str]):
        self.processor, self.names = processor, names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.processor.init(handle)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        texts = chain.from_iterable(frame["event"].tolist() for frame in rows)
        self.processor.await_time(map(itemgetter(*self.processor.event._fields), map(json.loads, texts)))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        found = self.processor.handleExpiredTimer(key, timerValues, expiredTimerInfo)
        while part := list(islice(found, FRAME)):
            # As objects: a column of whole numbers stays one.
            yield pd.DataFrame({n: pd.Series(c, dtype=object) for n, c in zip(self.names, map(list, zip(*part)))})

    def close(self) -> None:
        self.processor.close()


def ordered(events: DataFrame, keys: list[str], processor: TimeOrdered, output: str, delay: str) -> DataFrame:
    """The output of ``processor``, which was made for ``keys``, over the events of each of them."""
    rows = events.withColumn("us", F.unix_micros("timestamp")).withWatermark("timestamp", delay)
    fields = dict.fromkeys(["us", "event_id", *processor.keys, *processor.fields])
    event = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    dealt = rows.select("timestamp", event.alias("event"), F.pmod(F.xxhash64(*keys), F.lit(GROUPS)).alias("group"))
    framed = Framed(processor, T.StructType.fromDDL(output).names)
    return dealt.groupBy("group").transformWithStateInPandas(
        statefulProcessor=framed, outputStructType=output, outputMode="Append", timeMode="EventTime")


# Rows that are given for every event: a named tuple is made several times faster than a row.
Position = namedtuple("Position", ("session_id", "event_id", "us", "session_sequence"))


class Positions(TimeOrdered):
    """Numbers the events of a key."""

    memory = {"count": 0}

    def take(self, who, state, event):
        state.count += 1
        yield Position(who[0], event.event_id, event.us, state.count)


def session_positions(events: DataFrame, delay: str = DELAY, idle: str = IDLE) -> DataFrame:
    """The position of each event in its session, as ``operators.ordered.number_rows`` gives it."""
    found = ordered(events.select("session_id", "event_id", "timestamp"), ["session_id"],
                    Positions(1000 * seconds(idle), ("session_id",)),
                    "session_id string, event_id string, us long, session_sequence long", delay)
    return found.withColumn("timestamp", F.timestamp_micros("us")).drop("us")


class SessionLists(TimeOrdered):
    """Collects the event types and properties of each session in chunks. A full chunk comes at once, the last one when no
    event can lengthen the session any more. Many entries leave the page for parts of their own."""

    # The properties travel as two lists. An entry has what ``fields`` names.
    fields = ("event_type", "names", "texts")
    memory = {"start": None, "latest": None, "chunk": 0, "parts": 0, "held": 0, "entries": []}

    def __init__(self, idle: int, gap: int, chunk_size: int, keys: tuple[str, ...] = ()):
        super().__init__(idle, keys)
        self.gap, self.chunk_size = gap, chunk_size

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.parts = handle.getMapState("parts", "who string, part int", "entries binary")

    def take(self, who, state, event):
        if state.latest is not None and event.us - state.latest > self.gap:
            yield from self.cut(who, state)
            state.start, state.chunk = None, 0
        state.start, state.latest = event.us if state.start is None else state.start, event.us
        state.entries.append((event.event_type, event.names, event.texts))
        if state.held + len(state.entries) == self.chunk_size:
            yield from self.cut(who, state)
            state.chunk += 1

    def cut(self, who, state):
        """The entries held, as one row."""
        entries = []
        for part in range(state.parts):
            entries += unpacked(self.parts.getValue((repr(who), part)))
            self.parts.removeKey((repr(who), part))
        entries += state.entries
        state.parts, state.held, state.entries = 0, 0, []
        if entries:
            kinds, names, texts = map(list, zip(*entries))
            yield Row(session_id=who[0], user_id=who[1], start=state.start, chunk=state.chunk, entries=len(kinds),
                      event_sequence=kinds, names=names, texts=texts)

    def pause(self, who, state, at):
        if state.latest is not None and second_end(state.latest + self.gap) <= at:
            yield from self.cut(who, state)
            state.start, state.latest, state.chunk = None, None, 0

    def wake(self, state, mark):
        return None if state.latest is None else second_end(state.latest + self.gap)

    def settle(self, who, state):
        if len(state.entries) > INLINE:
            self.parts.updateValue((repr(who), state.parts), packed(state.entries))
            state.parts, state.held, state.entries = state.parts + 1, state.held + len(state.entries), []


def session_sequences(events: DataFrame, gap: str = "30 minutes", chunk_size: int = 1000, delay: str = DELAY) -> DataFrame:
    """Ordered event types and properties of each session, in chunks, as ``operators.sessions.session_sequences`` gives
    them."""
    pause = seconds(gap) * 1_000_000
    # A session outlives its gap by a second at most; its key can be forgotten then.
    processor = SessionLists(pause // 1000 + 2 * SECOND, pause, chunk_size, ("session_id", "user_id"))
    rows = events.select("session_id", "user_id", "event_id", "timestamp", "event_type",
                         F.map_keys("properties").alias("names"), F.map_values("properties").alias("texts"))
    found = ordered(rows, ["session_id", "user_id"], processor,
                    "session_id string, user_id string, start long, chunk long, entries int, event_sequence array<string>, "
                    "names array<array<string>>, texts array<array<string>>", delay)
    maps = F.zip_with("names", "texts", F.map_from_arrays)
    return found.select("session_id", "user_id", F.timestamp_micros("start").alias("session_start"), "chunk", "entries",
                        "event_sequence", maps.alias("event_properties"))


class WindowLists(TimeOrdered):
    """Collects the event types of a key in every sliding window that holds them, in chunks, once the window is over.

    Events are kept by slide, so a window reads the events of its slides and nothing else, and a slide is dropped with the
    last window that holds it. Many events of a slide leave the page for parts of their own.
    """

    # A slide has its start, the number of its parts and the event types that are in none.
    fields = ("event_type",)
    memory = {"done": None, "slides": []}

    def __init__(self, idle: int, size: int, slide: int, chunk_size: int, keys: tuple[str, ...] = ()):
        super().__init__(idle, keys)
        self.size, self.slide, self.chunk_size = size, slide, chunk_size

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.parts = handle.getMapState("parts", "who string, start long, part int", "kinds binary")

    def take(self, who, state, event):
        start = event.us // 1000 // self.slide * self.slide
        if not state.slides or state.slides[-1][0] != start:
            yield from self.pause(who, state, start)
            state.slides.append((start, 0, []))
        state.slides[-1][2].append(event.event_type)

    def ends(self, state) -> list[int]:
        """The ends of the windows that hold events and were not given yet."""
        ends = {start + step for start, _, _ in state.slides for step in range(self.slide, self.size + 1, self.slide)}
        return sorted(e for e in ends if state.done is None or e > state.done)

    def pause(self, who, state, at):
        for end in self.ends(state):
            if end > at:
                break
            kinds = []
            for start, parts, held in state.slides:
                if end - self.size <= start < end:
                    for part in range(parts):
                        kinds += unpacked(self.parts.getValue((repr(who), start, part)))
                    kinds += held
            for chunk, first in enumerate(range(0, len(kinds), self.chunk_size)):
                part = kinds[first:first + self.chunk_size]
                yield Row(user_id=who[0], start=end - self.size, chunk=chunk, entries=len(part), event_sequence=part)
        for start, parts, _ in state.slides:
            if start + self.size <= at:
                for part in range(parts):
                    self.parts.removeKey((repr(who), start, part))
        state.slides = [s for s in state.slides if s[0] + self.size > at]
        state.done = at

    def wake(self, state, mark):
        return next(iter(self.ends(state)), None)

    def settle(self, who, state):
        for at, (start, parts, kinds) in enumerate(state.slides):
            if len(kinds) > INLINE:
                self.parts.updateValue((repr(who), start, parts), packed(kinds))
                state.slides[at] = (start, parts + 1, [])


def behavior_sequences(events: DataFrame, size: str = "1 hour", slide: str = "10 minutes", chunk_size: int = 1000,
                       delay: str = DELAY) -> DataFrame:
    """Ordered event types of each user and window, in chunks, as ``operators.windows.behavior_sequences`` gives them."""
    length = 1000 * seconds(size)
    # A key's last window is over a size after its last event.
    processor = WindowLists(length + 2 * SECOND, length, 1000 * seconds(slide), chunk_size, ("user_id",))
    found = ordered(events.select("user_id", "event_id", "timestamp", "event_type"), ["user_id"], processor,
                    "user_id string, start long, chunk long, entries int, event_sequence array<string>", delay)
    return found.select("user_id", F.timestamp_millis("start").alias("window_start"),
                        F.timestamp_millis(F.col("start") + length).alias("window_end"), "chunk", "entries", "event_sequence")
