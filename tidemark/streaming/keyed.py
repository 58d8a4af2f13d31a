"""Keyed state of the feeds: what one run, import or dataset remembers between micro-batches.

A key may hold a third of all rows, and its state belongs to one task. So rows are thinned before they
reach it, inside the tasks that read them: no more stays of a key than its state could need.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

PENDING, TIMED_OUT = "pending", "timed_out"
#: The bucket of rows without a run, which are run 0 there.
NO_RUN = -1
#: A bucket's entries are read together, by one call, up to so many for each one that is asked for.
READ_TOGETHER = 8
#: A task holds so many rows of runs, or entries and ends of datasets, at a time.
HELD = 1 << 16


def codes(batch: pa.RecordBatch, keys: list[str]) -> np.ndarray:
    """A number for each distinct combination of the key columns, nulls included."""
    out = np.zeros(batch.num_rows, np.int64)
    for name in keys:
        found = batch.column(name).dictionary_encode(null_encoding="encode")
        joined = out * len(found.dictionary) + found.indices.to_numpy(zero_copy_only=False)
        out = np.unique(joined, return_inverse=True)[1]
    return out


def group_starts(sorted_codes: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.append(np.ones(min(len(sorted_codes), 1), bool), sorted_codes[1:] != sorted_codes[:-1]))


# First n --------------------------------------------------------------------------------------------


def until_target(run: np.ndarray, us: np.ndarray, event: np.ndarray, files: np.ndarray, target: int) -> np.ndarray:
    """Of each run in some rows: the first row, and those that accept files until these rows alone reach
    ``target``, as indices by run and time."""
    order = np.lexsort((event, us, run))
    starts = group_starts(run[order])
    sums = np.cumsum(files[order])
    first = np.zeros(len(order), bool)
    first[starts] = True
    had = np.repeat((sums - files[order])[starts], np.diff(np.append(starts, len(order))))
    before = sums - files[order] - had
    return order[first | ((files[order] > 0) & (before < target))]


def thin_files(target: int):
    """Of each run (run_id, us, event_id, files) in a batch of rows: the first row, and those that
    accept files, in time order, until the batch alone reaches ``target``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            us, event, files = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("us", "event_id", "files"))
            yield batch.take(pa.array(until_target(codes(batch, ["run_id"]), us, event, files, target)))

    return work


FILES = "bucket int, run_id array<bigint>, us array<bigint>, event_id array<bigint>, files array<bigint>"


def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of ``HELD`` rows or somewhat more, and a last one."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= HELD:
            yield pa.concat_batches(held)
            held, rows = [], 0
    if rows:
        yield pa.concat_batches(held)


def buckets_of_files(target: int):
    """Thinned rows (bucket, run_id, us, event_id, files) of a task, those of a bucket in one row."""
    thin = thin_files(target)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in thin(together(batches)):
            batch = batch.take(pa.array(np.argsort(batch.column("bucket").to_numpy(), kind="stable")))
            bucket = batch.column("bucket").to_numpy()
            starts = group_starts(bucket)
            offsets = pa.array(np.append(starts, len(bucket)).astype(np.int32))
            names = FirstN.COLUMNS
            lists = [pa.ListArray.from_arrays(offsets, batch.column(n).fill_null(0)) for n in names]
            yield pa.RecordBatch.from_arrays([pa.array(bucket[starts]), *lists], ["bucket", *names])

    return work


class FirstN(StatefulProcessor):
    """Of the runs of a bucket, the row at which each has ``target`` files, once. A run that rests for
    ``keep_ms`` (and a 64th of that at most) is forgotten.

    A call to the state costs more than a run's rows, and what a key costs falls on a bucket, so calls are
    few: each run has an entry of its own, entries are read together where the bucket holds few others, and
    that of a run which has its files is only written again so that it stays."""

    COLUMNS = ["run_id", "us", "event_id", "files"]

    def __init__(self, target: int, keep_ms: int) -> None:
        self.target, self.slack = target, keep_ms // 64
        self.keep_ms = keep_ms + self.slack

    def init(self, handle: StatefulProcessorHandle) -> None:
        schema = "started bigint, total bigint, fired boolean, written bigint"
        self.runs = handle.getMapState("runs", "run_id bigint", schema, self.keep_ms)
        self.size = handle.getValueState("size", "runs bigint")

    def entries(self, names: list[tuple]) -> dict[tuple, tuple]:
        """What is known of some runs. ``size`` is the number of entries or, where some were forgotten
        since they were last read together, more."""
        size = known = (self.size.get() or (0,))[0]
        if size <= READ_TOGETHER * len(names):
            found = dict(self.runs.iterator()) if size else {}
            size = len(found)
        else:
            asked = {name: self.runs.getValue(name) for name in names}
            found = {name: entry for name, entry in asked.items() if entry}
        size += sum(name not in found for name in names)
        if size != known:
            self.size.update((size,))
        return found

    def thinned(self, chunks: Iterator[pd.DataFrame]) -> np.ndarray:
        """The rows that decide, by run and time. Rows of a chunk are dropped before the next one comes."""
        held = np.zeros((len(self.COLUMNS), 0), np.int64)
        for chunk in chunks:
            rows = np.stack([np.concatenate(chunk[name].to_list()) for name in self.COLUMNS])
            held = np.concatenate([held, rows], axis=1)
            held = held[:, until_target(*held, self.target)]
        return held

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        run, us, _, files = self.thinned(rows)
        starts = group_starts(run)
        names = [(r,) for r in run[starts].tolist()]
        entries = self.entries(names)
        reached = []
        for name, start, end in zip(names, starts, np.append(starts[1:], len(run)), strict=True):
            started, total, fired, written = entries.get(name, (int(us[start]), 0, False, 0))
            if fired and now - written < self.slack:
                continue
            started = min(started, int(us[start]))
            sums = total + np.cumsum(files[start:end])
            if not fired and sums[-1] >= self.target:
                fired = True
                at = int(np.argmax(sums >= self.target))
                elapsed = (int(us[start + at]) - started + 500) // 1000 / 1000
                run_id = None if key[0] == NO_RUN else name[0]
                reached.append((run_id, self.target, True, elapsed, int(sums[at])))
            self.runs.updateValue(name, (started, int(sums[-1]), fired, now))
        if reached:
            columns = ["run_id", "target_files", "reached", "elapsed_sec", "accepted_files"]
            yield pd.DataFrame(reached, columns=columns).astype({"run_id": "Int64"})

    def close(self) -> None:
        pass


# Import status --------------------------------------------------------------------------------------


def thin_polls(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each import (project_id, import_id, us, status, outcome) in a batch of rows: the first and
    the last poll, and the first that ends the wait."""
    for batch in batches:
        if not batch.num_rows:
            continue
        own = codes(batch, ["project_id", "import_id"])
        status = codes(batch, ["status"])
        us = batch.column("us").to_numpy(zero_copy_only=False)
        waits = np.array([o == PENDING for o in batch.column("outcome").to_pylist()])
        order = np.lexsort((status, us, own))
        starts = group_starts(own[order])
        keep = np.zeros(len(order), bool)
        keep[starts] = True
        keep[np.append(starts[1:], len(order)) - 1] = True
        ended = np.lexsort((status, us, waits, own))
        firsts = ended[group_starts(own[ended])]
        kept = np.unique(np.concatenate([order[keep], firsts]))
        yield batch.take(pa.array(kept))


class ImportWatch(StatefulProcessor):
    """The end of each import, once: a status that ends the wait before the deadline, else a row without
    a status when the deadline passes. An import that ended is forgotten after ``keep_ms``."""

    def __init__(self, timeout_ms: int, keep_ms: int, event_clock: bool) -> None:
        self.timeout_ms, self.keep_ms, self.event_clock = timeout_ms, keep_ms, event_clock

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        schema = "first bigint, deadline bigint, ended boolean"
        self.watch = handle.getValueState("watch", schema)

    def now(self, timers) -> int:
        return timers.getCurrentWatermarkInMs() if self.event_clock else timers.getCurrentProcessingTimeInMs()

    def ended(self, key, first: int, status: str | None, outcome: str, us: int, timers) -> Row:
        forget = max(self.now(timers), us // 1000 if self.event_clock else 0) + self.keep_ms
        self.handle.registerTimer(forget)
        self.watch.update((first, forget, True))
        waited = (us - first) / 1e6
        return Row(project_id=key[0], import_id=key[1], status=status, outcome=outcome, waited_sec=waited)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        first, deadline, over = self.watch.get() if self.watch.exists() else (None, None, False)
        if over:
            return
        for row in sorted(rows, key=lambda r: (r["us"], r["status"] or "")):
            if first is None:
                first = row["us"]
                start = first // 1000 if self.event_clock else self.now(timerValues)
                deadline = start + self.timeout_ms
                self.handle.registerTimer(deadline)
            late = self.event_clock and row["us"] // 1000 >= deadline
            if late or row["outcome"] != PENDING:
                self.handle.deleteTimer(deadline)
                if late:
                    end = first + self.timeout_ms * 1000
                    yield self.ended(key, first, None, TIMED_OUT, end, timerValues)
                else:
                    yield self.ended(key, first, row["status"], row["outcome"], row["us"], timerValues)
                return
        if first is not None:
            self.watch.update((first, deadline, False))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if not self.watch.exists():
            return
        first, deadline, over = self.watch.get()
        if over:
            self.watch.clear()
        elif expiredTimerInfo.getExpiryTimeInMs() >= deadline:
            end = first + self.timeout_ms * 1000
            yield self.ended(key, first, None, TIMED_OUT, end, timerValues)

    def close(self) -> None:
        pass


# Flushes --------------------------------------------------------------------------------------------

BLOCK = "dataset_id string, lane int, entries array<string>, finished boolean"


def blocks_of(size: int):
    """Rows (dataset_id, entry, finished) of a task as blocks: full ones in a lane of the task, the rest
    and the ends of datasets in the dataset's own lane, 0."""
    schema = pa.schema(
        [("dataset_id", pa.string()), ("lane", pa.int32()), ("entries", pa.list_(pa.string())), ("finished", pa.bool_())]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lane = TaskContext.get().partitionId() + 1
        open_blocks: dict[str | None, list[str]] = {}
        ends: set[str | None] = set()
        held = 0

        def packed(blocks: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([dict(zip(schema.names, b, strict=True)) for b in blocks], schema)

        def rest() -> pa.RecordBatch:
            blocks = [(d, 0, open_blocks.get(d, []), d in ends) for d in open_blocks.keys() | ends]
            open_blocks.clear()
            ends.clear()
            return packed(blocks)

        for batch in batches:
            full = []
            rows = zip(*(batch.column(n).to_pylist() for n in ("dataset_id", "entry", "finished")), strict=True)
            for dataset, entry, finished in rows:
                if finished:
                    ends.add(dataset)
                if entry is None:
                    continue
                own = open_blocks.setdefault(dataset, [])
                own.append(entry)
                held += 1
                if len(own) == size:
                    full.append((dataset, lane, open_blocks.pop(dataset), False))
                    held -= size
            if full:
                yield packed(full)
            if held + len(ends) >= HELD:
                yield rest()
                held = 0
        if open_blocks or ends:
            yield rest()

    return work


class Flusher(StatefulProcessor):
    """Flushes of exactly ``size`` entries of a dataset; what is left over waits for the next
    micro-batch, ``wait_ms`` at most, or until the dataset is finished."""

    def __init__(self, size: int, wait_ms: int) -> None:
        self.size, self.wait_ms = size, wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "entry string")
        self.timer = handle.getValueState("timer", "deadline bigint")

    def flush(self, dataset: str | None, entries: list[str], reason: str) -> Row:
        name = hashlib.blake2b("\n".join(entries).encode(), digest_size=16).hexdigest()
        return Row(dataset_id=dataset, flush_id=name, reason=reason, entries=entries)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        dataset, lane = key
        if lane:
            for row in rows:
                yield self.flush(dataset, list(row["entries"]), "full")
            return
        entries = [r[0] for r in self.waiting.get()] if self.waiting.exists() else []
        finished = False
        for row in rows:
            entries += row["entries"]
            finished |= row["finished"]
            while len(entries) >= self.size:
                yield self.flush(dataset, entries[: self.size], "full")
                entries = entries[self.size :]
        if finished and entries:
            yield self.flush(dataset, entries, "finished")
            entries = []
        self.keep(entries, timerValues)

    def keep(self, entries: list[str], timers) -> None:
        timed = self.timer.get()[0] if self.timer.exists() else None
        if entries:
            self.waiting.put([(e,) for e in entries])
            if timed is None:
                timed = timers.getCurrentProcessingTimeInMs() + self.wait_ms
                self.handle.registerTimer(timed)
                self.timer.update((timed,))
        else:
            self.waiting.clear()
            if timed is not None:
                self.handle.deleteTimer(timed)
                self.timer.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        entries = [r[0] for r in self.waiting.get()] if self.waiting.exists() else []
        self.timer.clear()
        self.waiting.clear()
        if entries:
            yield self.flush(key[0], entries, "waited")

    def close(self) -> None:
        pass
