"""Usage limits over a request log.

Fixed windows need only running totals. The sliding log depends on its own earlier decisions; it
is folded over sorted rows in chunks of bounded size. What a chunk makes of any log it could begin with is described by a small
table of steps, so the chunks of a key are described side by side, their tables are followed in order, and the decisions
are made side by side again.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.operators.ordered import CHUNK_ROWS, positioned, running_totals
from marlstone.workspace import written


def micros(ts: str, kind: T.DataType) -> Column:
    """Microseconds since the epoch; a timestamp without zone is read as UTC."""
    if isinstance(kind, T.TimestampNTZType):
        return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', {ts})")
    return F.unix_micros(ts)


def fixed_window(
    log: DataFrame, ts: str, tie: str, tokens: str, seconds: int, max_requests: int, max_tokens: int, **sizes: int
) -> DataFrame:
    """Add ``window_no``, ``allowed`` and the usage shares before the request.

    A request passes while the window's earlier requests and tokens are below their limits. Counting refused
    requests too gives the same answer: totals only grow, so after the first refusal all are refused.
    """
    window = F.expr("_micros div " + str(seconds * 1_000_000))
    placed = log.withColumn("_micros", micros(ts, log.schema[ts].dataType)).withColumn("window_no", window).drop("_micros")
    before = running_totals(
        placed, ["window_no"], [ts, tie], {"_requests": F.lit(1), "_tokens": F.col(tokens)}, inclusive=False, **sizes
    )
    return (
        before.withColumn("allowed", (F.col("_requests") < max_requests) & (F.col("_tokens") < max_tokens))
        .withColumn("request_share", F.least(F.col("_requests"), F.lit(max_requests)) / max_requests)
        .drop("_requests", "_tokens")
    )


# --- sliding log ----------------------------------------------------------------------

NO_KEY = "\u0000"  # stands for a missing key
STATE = "_key string, _at bigint"


class _Log:
    """Times of the admitted requests still inside the window, of one key."""

    def __init__(self, limit: int, window: int):
        self.limit, self.window = limit, window
        self.times: deque[int] = deque()

    def ask(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Decisions and places left for requests in time order.

        While the log is full nothing passes until its first entry expires, so a run of refusals is one step.
        """
        allowed = np.zeros(len(at), dtype=bool)
        remaining = np.zeros(len(at), dtype=np.int64)
        i = 0
        while i < len(at):
            now = int(at[i])
            while self.times and now - self.times[0] > self.window:
                self.times.popleft()
            if len(self.times) >= self.limit:
                first = self.times[0] if self.times else now
                i = max(i + 1, int(np.searchsorted(at, first + self.window, side="right")))
                continue
            self.times.append(now)
            allowed[i] = True
            remaining[i] = self.limit - len(self.times)
            i += 1
        return allowed, remaining


def _sorted(rows: DataFrame, seeds: DataFrame | None, key: str, span: str) -> DataFrame:
    """Rows and carried log entries by (key, span) and chunk, the entries of a chunk before its rows."""
    listed = rows.select(key, F.col(span).alias("_span"), "_chunk", F.lit(0).alias("_seed"), "_at", "_tie")
    if seeds is not None:
        blank = F.lit("0").cast(rows.schema["_tie"].dataType)
        listed = listed.unionByName(
            seeds.select(key, F.col(span).alias("_span"), "_chunk", F.lit(1).alias("_seed"), "_at", blank.alias("_tie"))
        )
    return listed.repartition(key, "_span").sortWithinPartitions(key, "_span", "_chunk", F.desc("_seed"), "_at", "_tie")


class _Fold:
    """The log of the (key, span) at hand while sorted batches go by."""

    def __init__(self, key: str, limit: int, window: int):
        self.key, self.limit, self.window = key, limit, window
        self.group, self.chunk, self.log = None, None, None

    def stretches(self, pdf: pd.DataFrame) -> Iterator[tuple[int, int, tuple | None]]:
        """(low, high, finished) per stretch of one chunk; finished is (key, chunk, times) of the chunk before it."""
        keys, spans, chunks = (pdf[c].to_numpy() for c in (self.key, "_span", "_chunk"))
        cut = (keys[1:] != keys[:-1]) | (spans[1:] != spans[:-1]) | (chunks[1:] != chunks[:-1])
        edges = [0, *(np.flatnonzero(cut) + 1).tolist(), len(pdf)]
        for low, high in zip(edges, edges[1:], strict=False):
            group, chunk, finished = (keys[low], spans[low]), chunks[low], None
            if group != self.group or chunk != self.chunk:
                finished = self.finished()
                if group != self.group:
                    self.log = _Log(self.limit, self.window)
                self.group, self.chunk = group, chunk
            yield low, high, finished

    def finished(self) -> tuple | None:
        return None if self.group is None else (self.group[0], self.chunk, list(self.log.times))

    def ask(self, seeds: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Decisions for a stretch; its carried entries come first and enter the log unasked."""
        n = int(seeds.sum())
        self.log.times.extend(at[:n].tolist())
        allowed, remaining = self.log.ask(at[n:])
        return np.concatenate([np.zeros(n, dtype=bool), allowed]), np.concatenate([np.zeros(n, dtype=np.int64), remaining])


def _decisions(rows: DataFrame, seeds: DataFrame | None, key: str, limit: int, window: int) -> DataFrame:
    tie = rows.schema["_tie"].dataType.simpleString()

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state = _Fold(key, limit, window)
        for pdf in batches:
            if len(pdf) == 0:
                continue
            seed, at = pdf["_seed"].to_numpy(), pdf["_at"].to_numpy()
            parts = [state.ask(seed[low:high], at[low:high]) for low, high, _ in state.stretches(pdf)]
            allowed, remaining = (np.concatenate(x) for x in zip(*parts, strict=True))
            out = pd.DataFrame({"_tie": pdf["_tie"].to_numpy(), "allowed": allowed, "remaining": remaining})
            yield out[seed == 0]

    return _sorted(rows, seeds, key, "_chunk").mapInPandas(fold, f"_tie {tie}, allowed boolean, remaining bigint")


def _trailing(rows: DataFrame, seeds: DataFrame | None, key: str, limit: int, window: int, span: str = "_chunk") -> DataFrame:
    """(key, _chunk, _at): the log at the end of each chunk, at most ``limit`` rows. The chunks of a span run one after the other."""
    schema = T.StructType([rows.schema[key], rows.schema["_chunk"], T.StructField("_at", T.LongType())])

    def table(ends: list[tuple]) -> pd.DataFrame:
        listed = [(k, c, t) for k, c, times in ends for t in times]
        return pd.DataFrame(listed, columns=schema.names)

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state = _Fold(key, limit, window)
        for pdf in batches:
            if len(pdf) == 0:
                continue
            seed, at, ends = pdf["_seed"].to_numpy(), pdf["_at"].to_numpy(), []
            for low, high, finished in state.stretches(pdf):
                if finished is not None:
                    ends.append(finished)
                state.ask(seed[low:high], at[low:high])
            if any(times for *_, times in ends):
                yield table(ends)
        last = state.finished()
        if last is not None and last[2]:
            yield table([last])

    return _sorted(rows, seeds, key, span).mapInPandas(fold, schema)


#: Admissions between two looks for logs that have become alike.
_MERGE_EVERY = 48
_BEYOND = (1 << 63) - 1  # a time after the chunk


def _last_admitted(at: np.ndarray, log: list[int], limit: int, window: int) -> list[int]:
    """The last ``2 * limit`` times of ``log`` and of what it admits from ``at``."""
    folded = _Log(limit, window)
    folded.times.extend(log[-limit:])
    allowed, _ = folded.ask(at)
    return [*log, *at[allowed].tolist()][-2 * limit :]


def transfer(at: np.ndarray, limit: int, window: int) -> list[tuple[int, int, list[int]]]:
    """What a chunk with the sorted times ``at`` makes of a log: rows (entry, from, times).

    Let x_1 <= ... <= x_limit be the log (missing entries: long ago) and a_1 < a_2 < ... what is admitted after it. Then
    a_j = max(a_(j-1) + 1, the first request that comes after a_(j-limit) has expired), counted in requests, where a_(j-limit) is an entry of the log for
    j <= limit. Both steps keep the order, so a_j is the largest of what the entries give alone: the log with only entry i
    at x_i gives some a_j, and that is a step function of x_i. Here are those functions, for the last ``2 * limit`` admissions: the row (i, from, times) holds for
    x_i from ``from`` on; times beyond the chunk are ``_BEYOND``. Of the a_j that lie in the chunk the last ``limit`` are the outgoing log.
    """
    n = len(at)
    free = np.append(np.searchsorted(at, at + window, side="right"), n)  # the first request that finds an admission expired
    within = int(free[0])  # requests of the chunk that an entry of the log can block
    # an entry blocks none, or all up to the last one of some time
    counts = np.concatenate([[0], np.flatnonzero(np.append(at[1:within] != at[: within - 1], True)) + 1])
    entry, blocked = np.repeat(np.arange(limit), len(counts)), np.tile(counts, limit)
    column = np.arange(len(entry))  # of each (entry, blocked) in the arrays below, which hold each course once
    last: deque[np.ndarray] = deque(maxlen=2 * limit)
    previous = np.full(len(entry), -1, dtype=np.int64)
    done = 0
    while True:
        if done < limit:
            wait = np.where(entry == done, blocked, 0)
        else:
            wait = free[last[-limit]]
        previous = np.minimum(np.maximum(previous + 1, wait), n)
        if previous.min() >= n and len(last) >= limit:
            break
        last.append(previous)
        done += 1
        if done >= 2 * limit and done % _MERGE_EVERY == 0:
            courses, back = np.unique(np.stack(last), axis=1, return_inverse=True)
            column = back.ravel()[column]
            last.extend(list(courses))
            previous = last[-1]
            if courses.shape[1] == 1:  # whatever the log was, the rest of the chunk is the same
                first = int(previous[0]) + 1
                ends = _last_admitted(at[first:], at[courses[:, 0]].tolist(), limit, window)
                return [(i, -_BEYOND, ends) for i in range(limit)]
    times = np.append(at, _BEYOND)[np.stack(last)[:, column]]
    rows = []
    for i in range(limit):
        mine = times[:, entry == i]
        steps = [0, *(np.flatnonzero((mine[:, 1:] != mine[:, :-1]).any(axis=0)) + 1).tolist()]
        # entry i blocks b requests when at[b - 1] still comes within the window after it
        rows += [(i, int(at[counts[b] - 1]) - window if b else -_BEYOND, mine[:, b].tolist()) for b in steps]
    return rows


def passed_on(log: list[int], table: list[tuple[int, int, list[int]]], limit: int) -> list[int]:
    """The log after a chunk that ``table`` describes."""
    padded = [-_BEYOND] * (limit - len(log)) + sorted(log)
    best: list[int] = []
    for i in range(limit):
        times = max((row for row in table if row[0] == i and row[1] <= padded[i]), key=lambda row: row[1])[2]
        best = list(map(max, best, times)) if best else times
    admitted = [t for t in best if t < _BEYOND]
    before = padded if len(best) < 2 * limit else []  # a short chunk may leave entries of the log where they are
    return [t for t in [*before, *admitted] if t > -_BEYOND][-limit:]


def _settle(rows: DataFrame, first: DataFrame | None, key: str, limit: int, window: int) -> DataFrame | None:
    """Log entries each chunk starts with, or None when there are none at all.

    The chunks of keys with several ones are described by ``transfer``, all side by side. Then the log of a key is passed from chunk to chunk through
    these tables, which are far smaller than the chunks; no request is read in that pass.
    """
    groups = written(rows.select(key, "_chunk").distinct(), "groups")
    several = groups.groupBy(key).agg(F.max("_chunk").alias("_last"), F.count(F.lit(1)).alias("_n")).where("_n > 1").select(key, "_last")
    if several.isEmpty():
        return first
    described = rows.join(several, key).where("_chunk < _last").select(key, "_chunk", F.lit(0).alias("_seed"), "_at", "_tie", F.col("_chunk").alias("_span"))
    schema = T.StructType([rows.schema[key], rows.schema["_chunk"], *T._parse_datatype_string("_entry int, _from bigint, _times array<bigint>").fields])

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[np.ndarray] = []
        group = None

        def table() -> pd.DataFrame:
            found = transfer(np.concatenate(held), limit, window)
            return pd.DataFrame([(*group, *row) for row in found], columns=schema.names)

        for pdf in batches:
            keys, chunks, at = (pdf[c].to_numpy() for c in (key, "_chunk", "_at"))
            edges = [0, *(np.flatnonzero((keys[1:] != keys[:-1]) | (chunks[1:] != chunks[:-1])) + 1).tolist(), len(pdf)]
            for low, high in zip(edges, edges[1:], strict=False):
                if low < high:
                    if group != (keys[low], chunks[low]):
                        if held:
                            yield table()
                        group, held = (keys[low], chunks[low]), []
                    held.append(at[low:high])
        if held:
            yield table()

    tables = written(described.repartition(key, "_chunk").sortWithinPartitions(key, "_chunk", "_at", "_tie").mapInPandas(describe, schema), "transfers")
    opening = tables.where("false").select(key, F.col("_from").alias("_at")) if first is None else first.join(several, key, "left_semi").select(key, "_at")
    blank = F.lit(None).cast("array<bigint>").alias("_times")
    begun = opening.select(key, F.lit(-1).cast(rows.schema["_chunk"].dataType).alias("_chunk"), F.lit(-1).alias("_entry"), F.col("_at").alias("_from"), blank)
    ordered = tables.unionByName(begun).repartition(key).sortWithinPartitions(key, "_chunk", "_entry", "_from")

    def follow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, chunk, log, table = None, None, [], []

        def closed() -> Iterator[tuple]:
            nonlocal log
            if table:
                log = passed_on(log, table, limit)
                yield from ((name, chunk, t) for t in log)

        out: list[tuple] = []
        for pdf in batches:
            for k, c, i, start, times in zip(*(pdf[x].tolist() for x in (key, "_chunk", "_entry", "_from", "_times")), strict=True):
                if (k, c) != (name, chunk):
                    out += closed()
                    log, name, chunk, table = (log if k == name else []), k, c, []
                if i < 0:
                    log.append(start)
                else:
                    table.append((i, start, list(times)))
            if out:
                yield pd.DataFrame(out, columns=[key, "_chunk", "_at"])
                out = []
        out += closed()
        if out:
            yield pd.DataFrame(out, columns=[key, "_chunk", "_at"])

    kind = T.StructType([rows.schema[key], rows.schema["_chunk"], T.StructField("_at", T.LongType())])
    ends = written(ordered.mapInPandas(follow, kind), "trailing")
    later = F.lead("_chunk").over(Window.partitionBy(key).orderBy("_chunk"))
    links = groups.join(several, key, "left_semi").withColumn("_next", later).where("_next IS NOT NULL")
    incoming = ends.join(links, [key, "_chunk"]).select(key, F.col("_next").alias("_chunk"), "_at")
    return incoming if first is None else incoming.unionByName(first)


def sliding_log(
    log: DataFrame,
    key: str,
    ts: str,
    tie: str,
    limit: int,
    seconds: int,
    carried: DataFrame | None = None,
    chunk_rows: int = CHUNK_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """Decisions (all columns + allowed, remaining) and the trailing log (_key, _at) of every key.

    A request is admitted while fewer than ``limit`` admitted ones lie within the last ``seconds``; refused requests are not kept.
    ``carried`` is the trailing log of an earlier call, for requests that come in batches. ``tie`` is a unique id.
    Requests without a key share one log.
    """
    window, own = seconds * 1_000_000, "_key"
    asked = log.select(
        F.coalesce(F.col(key).cast("string"), F.lit(NO_KEY)).alias(own),
        micros(ts, log.schema[ts].dataType).alias("_at"),
        F.col(tie).alias("_tie"),
    )
    rows = written(positioned(asked, [own, "_at", "_tie"], chunk_rows).drop("_pos"), "requests")
    first = None
    if carried is not None:
        first = carried.join(rows.groupBy(own).agg(F.min("_chunk").alias("_chunk")), own).select(own, "_chunk", "_at")
    seeds = _settle(rows, first, own, limit, window)
    decided = _decisions(rows, seeds, own, limit, window).withColumnRenamed("_tie", tie)
    last = rows.groupBy(own).agg(F.max("_chunk").alias("_chunk"))
    final = rows.join(last, [own, "_chunk"], "left_semi")
    final_seeds = None if seeds is None else seeds.join(last, [own, "_chunk"], "left_semi")
    ends = _trailing(final, final_seeds, own, limit, window).select(own, "_at")
    if carried is not None:
        ends = ends.unionByName(carried.select(own, "_at").join(rows.select(own).distinct(), own, "left_anti"))
    return log.join(decided, tie), ends
