"""Rows that lend one another single features: each row's classes go once, packed, to where the borrowing rows are scored."""

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.models.leaves import Ensemble
from meterflow.session import range_partitions

# lent values that a task holds at a time, and the least rows worth a block or a task of their own
_ITEMS, _FEW = 1 << 22, 1 << 14
# rows worked on at a time, so that they stay in the processor's caches
_SLICE = 1 << 14
_LENT = ("block bigint, counts binary, places binary, lent binary, own_places binary, own_classes binary, "
         "known binary, target binary, prediction binary")
_SUMS = "known bigint, losses array<double>"


def _number(value: int, kind=np.uint64) -> np.ndarray:
    return np.array(value, kind)


# the numbers of XXH64; bits 0 and 32 of its last product make the lowest bit of the hash, and are moved to the highest here
_P1, _P2, _P4 = map(_number, (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x85EBCA77C2B2AE63))
_P5, _LAST = 0x27D4EB2F165667C5, _number(0x165667B19E3779F9 * ((1 << 63) + (1 << 31)) % (1 << 64))
_27, _29, _31, _33, _37 = map(_number, (27, 29, 31, 33, 37))
_SIGN = _number(63, np.int64)


@dataclass(frozen=True)
class Trial:
    """One feature, by its place in the vector (-1: not in the model), shuffled by the turns' hashes of its keys."""

    feature: int
    turns: tuple[int, ...]


def borrowing_place(places: np.ndarray, rows: int, turns: Sequence[int]) -> np.ndarray:
    """The place that borrows from each place: the way back of ``training.shuffled_place``.

    Every turn swaps pairs, so it is its own way back, and the turns are made in reverse. ``turns`` holds each turn's
    ``xxhash64(turn, *keys)``; hashing goes on from there with the pair, as Spark's does.
    """
    at, count = places.astype(np.int64), _number(rows, np.int64)
    steps = [(_number(turn % rows, np.int64), _number((turn + _P5 + 8) % (1 << 64))) for turn in reversed(turns)]
    for start in range(0, len(at), _SLICE):
        part = at[start:start + _SLICE]
        mirror, spare, pair = np.empty_like(part), np.empty_like(part), np.empty_like(part)
        for centre, seed in steps:
            np.subtract(centre, part, mirror)
            np.add(mirror, count, spare)
            low = mirror.view(np.uint64)
            np.minimum(low, spare.view(np.uint64), low)  # a number below zero is far above the other one
            np.maximum(part, mirror, pair)
            _mix(pair.view(np.uint64), spare.view(np.uint64), seed)
            np.right_shift(pair, _SIGN, pair)  # all ones: the hash is odd, the pair stays
            np.subtract(mirror, part, part)
            np.bitwise_and(part, pair, part)
            np.subtract(mirror, part, part)
    return at


def _mix(value: np.ndarray, spare: np.ndarray, seed: np.ndarray) -> None:
    """Puts the lowest bit of XXH64 of whole numbers into the highest bit, in place."""
    np.multiply(value, _P2, value)
    np.right_shift(value, _33, spare)
    np.left_shift(value, _31, value)
    np.bitwise_or(value, spare, value)
    np.multiply(value, _P1, value)
    np.bitwise_xor(value, seed, value)
    np.right_shift(value, _37, spare)
    np.left_shift(value, _27, value)
    np.bitwise_or(value, spare, value)
    np.multiply(value, _P1, value)
    np.add(value, _P4, value)
    np.right_shift(value, _33, spare)
    np.bitwise_xor(value, spare, value)
    np.multiply(value, _P2, value)
    np.right_shift(value, _29, spare)
    np.bitwise_xor(value, spare, value)
    np.multiply(value, _LAST, value)


def trial_losses(scored: DataFrame, rows: int, ensemble: Ensemble, trials: Sequence[Trial],
                 finish: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """One row: ``known`` targets, and the sums of squared errors of the rows as they are, then of each trial (``loss_0``, ...).

    ``scored`` has ``row`` (from 0, without gaps), ``vector``, ``target`` and ``prediction``. Every row finds who borrows
    from it and sends its class there; a block of neighbouring rows receives the lent classes of all trials and is
    scored in one task. Blocks and what is in work at once are bounded by ``_ITEMS`` values, whatever the size of the table.
    """
    held = max(1, _ITEMS // len(trials))
    parts = range_partitions(scored.sparkSession)
    size = min(held, 1 << 16, max(_FEW, -(-rows // parts)))
    tasks = max(1, min(parts, -(-rows // _FEW)))
    blocks, kind, asked = -(-rows // size), ensemble.kind, [trial.feature for trial in trials]

    def packed(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        chunk = pa.Table.from_batches(batches)
        row = chunk["row"].to_numpy()
        vectors = np.concatenate([part.flatten().to_numpy() for part in chunk["vector"].chunks])
        classes = ensemble.classes(vectors.reshape(len(row), ensemble.width))
        target = chunk["target"].fill_null(0.0).to_numpy()
        known = chunk["target"].is_valid().to_numpy().astype(np.uint8)
        own = (row % size).astype(np.uint16), classes.T, known, target, chunk["prediction"].to_numpy()
        own_starts, own = dealt(row[None], own)

        to = np.empty((len(trials), len(row)), np.int64)
        lent = np.zeros(to.shape, kind)
        for i, trial in enumerate(trials):
            to[i] = borrowing_place(row, rows, trial.turns)
            if trial.feature >= 0:
                lent[i] = classes[trial.feature]
        starts, (places, lent) = dealt(to, ((to % size).astype(np.uint16).ravel(), lent.ravel()))
        columns = [[] for _ in range(9)]
        for block in np.flatnonzero(np.diff(starts[0::len(trials)]) + np.diff(own_starts)).tolist():
            here = starts[block * len(trials):(block + 1) * len(trials) + 1]
            mine, theirs = slice(*own_starts[block:block + 2]), slice(here[0], here[-1])
            fields = [block, np.diff(here).astype(np.uint32), places[theirs], lent[theirs], *[values[mine] for values in own]]
            for column, value in zip(columns, fields, strict=True):
                column.append(value if value is block else value.tobytes())
        names = [field.split()[0] for field in _LENT.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), *[pa.array(c, pa.binary()) for c in columns[1:]]], names)

    def dealt(to: np.ndarray, values: Sequence[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
        """Values by the block they go to, inside a block by the line of ``to``, and where each line of each block starts."""
        block = (to // size).astype(np.min_scalar_type(blocks))
        counts = np.stack([np.bincount(line, minlength=blocks) for line in block], axis=1)
        order = np.argsort(block.ravel(), kind="stable")
        return np.concatenate([[0], np.cumsum(counts.ravel())]), [part[order] for part in values]

    def lend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, count = [], 0
        for batch in batches:
            while batch.num_rows:
                taken = batch.slice(0, held - count)
                batch = batch.slice(taken.num_rows)
                waiting.append(taken)
                count += taken.num_rows
                if count == held:
                    yield packed(waiting)
                    waiting, count = [], 0
        if count:
            yield packed(waiting)

    def judge(key: tuple, table: pa.Table) -> pa.Table:
        def numbers(name: str, dtype) -> np.ndarray:
            return np.frombuffer(b"".join(table[name].to_pylist()), dtype)

        width = min(size, rows - key[0].as_py() * size)
        places = numbers("own_places", np.uint16)
        order = np.argsort(places, kind="stable")
        counts = numbers("counts", np.uint32).reshape(-1, len(trials))
        if not np.array_equal(places[order], np.arange(width)) or (counts.sum(axis=0) != width).any():
            raise ValueError(f"block {key[0]} of {width} rows received {len(places)}: row numbers have gaps or repeats")
        lent = np.empty(len(trials) * width, kind)
        to = np.repeat(np.tile(np.arange(len(trials)) * width, len(counts)), counts.ravel()) + numbers("places", np.uint16)
        lent[to] = numbers("lent", kind)
        lent = lent.reshape(len(trials), width)
        own = np.ascontiguousarray(numbers("own_classes", kind).reshape(width, ensemble.width)[order].T)
        known, target, prediction = (numbers(*column)[order] for column in (
            ("known", np.uint8), ("target", np.float64), ("prediction", np.float64)))
        losses = np.zeros(len(trials) + 1)
        for start in range(0, width, _SLICE):
            part = slice(start, start + _SLICE)
            minutes = finish(ensemble.scores(own[:, part], asked, lent[:, part]))
            if not np.allclose(minutes[0], prediction[part], rtol=1e-9, atol=1e-9, equal_nan=True):
                raise ValueError("the trees alone do not give the model's predictions")
            errors = (minutes - target[part])[:, known[part] == 1]
            losses += (errors * errors).sum(axis=1)
        return pa.table({"known": [int(known.sum())], "losses": [losses.tolist()]},
                        pa.schema([("known", pa.int64()), ("losses", pa.list_(pa.float64()))]))

    sums = scored.repartition(tasks, "row").mapInArrow(lend, _LENT).groupBy("block").applyInArrow(judge, _SUMS)
    # all sums in one aggregate, so that they are added up in one order: a trial without effect has the very loss of no trial
    return sums.agg(F.sum("known").alias("known"), *[F.sum(F.col("losses")[i]).alias(f"loss_{i}") for i in range(len(trials) + 1)])
