"""Linear recurrences over columns of any length, in parts that fit together.

y_t = x_t + w_1 y_{t-1} + ... + w_k y_{t-k} looks sequential. But what a part's end depends on is its own inputs and the k
values before it, and on the latter linearly: every part is run from zeros, the effects of the values before are added
afterwards. So parts run beside each other, and only their small ends are passed along. ``run`` does so inside a column,
``incoming`` between the parts of a table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import materialize
from .timeline import tasks_for

# Parts whose ends meet in one task; longer tables of parts are folded level by level.
FAN = 256
# Parts a task follows.
TASK_PARTS = 8_192


def companion(weights: np.ndarray) -> np.ndarray:
    """One step of the recurrence on the last values, newest first."""
    k = len(weights)
    out = np.zeros((k, k))
    if k:
        out[0] = weights
        out[np.arange(1, k), np.arange(k - 1)] = 1.0
    return out


def newest(before: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The last values (newest first) after ``values`` followed on ``before`` (newest first)."""
    k = len(before)
    return np.concatenate((before[::-1], values))[len(values):][::-1] if k else before


def run(x: np.ndarray, weights: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
    """The recurrence on every column of x (rows, columns); ``before`` holds the values before, newest first."""
    return run_many(x[None], np.asarray(weights)[None], None if before is None else before[None])[0]


def part_length(rows: int, order: int) -> int:
    """Rows of the parts that ``run_many`` cuts a column into."""
    return max(order, int(np.sqrt(rows)) + 1)


def run_many(x: np.ndarray, weights: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
    """The recurrence on series of equal length: x (series, rows, columns), weights (series, k), ``before`` (series, k, columns)."""
    count, rows, columns = x.shape
    k = weights.shape[1]
    lags = [j for j in range(1, k + 1) if weights[:, j - 1].any()]
    if not lags or not rows:
        return x.copy()
    length = part_length(rows, k)
    parts = -(-rows // length)
    y = np.zeros((count, parts * length, columns))
    y[:, :rows] = x
    # row within a part first, so that a step touches memory in one piece
    y = np.ascontiguousarray(y.reshape(count, parts, length, columns).transpose(2, 0, 1, 3))
    effect = np.zeros((length, count, k))  # of the values before a part on its rows
    for t in range(length):
        for j in lags:
            w = weights[:, j - 1]
            if j <= t:
                y[t] += w[:, None, None] * y[t - j]
                effect[t] += w[:, None] * effect[t - j]
            else:
                effect[t, :, j - t - 1] += w
    y = np.ascontiguousarray(y.transpose(2, 1, 0, 3))
    effect = np.ascontiguousarray(effect.transpose(1, 0, 2))
    state = before if before is not None else np.zeros((count, k, columns))
    for part in y:
        if state.any():
            part += effect @ state
        state = part[:, ::-1][:, :k]
    return y.transpose(1, 0, 2, 3).reshape(count, parts * length, columns)[:, :rows]


def _steps(weights: np.ndarray, n: int, kept: dict) -> np.ndarray:
    """``n`` steps at once."""
    if n not in kept:
        kept[n] = np.linalg.matrix_power(companion(weights), n)
    return kept[n]


def _follow(parts: list[dict], start: np.ndarray, weights: list[np.ndarray], columns: list[int]) -> list[np.ndarray]:
    """States before each part and after the last: several recurrences (weights, columns) side by side in one flat array."""
    kept: list[dict] = [{} for _ in weights]
    states = [start]
    for part in parts:
        state, out, at = states[-1], np.array(part["end"], float), 0
        for w, c, powers in zip(weights, columns, kept):
            size = len(w) * c
            if size and state[at:at + size].any():
                out[at:at + size] += (_steps(w, part["n"], powers) @ state[at:at + size].reshape(len(w), c)).ravel()
            at += size
        states.append(out)
    return states


def incoming(ends: DataFrame, keys: list[str], recurrences) -> DataFrame:
    """The values before each part: rows (keys, part, state), from rows (keys, part, n, end, params).

    ``end`` is the flat end of part ``part`` (numbered from 0) of ``n`` rows when run from zeros; ``recurrences(params)``
    gives the lists of weights and column counts. Parts are folded ``FAN`` at a time until one fold holds a series, then
    states are handed down again; no task sees more than ``FAN`` ends.
    """
    kinds = {f.name: f.dataType.simpleString() for f in ends.schema}
    named = ", ".join(f"`{c}` {kinds[c]}" for c in keys)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                weights, columns = recurrences(np.asarray(r["params"], float))
                last = _follow(r["parts"], np.zeros(len(r["parts"][0]["end"])), weights, columns)[-1]
                out.append({"part": r["__fold"], "n": sum(p["n"] for p in r["parts"]), "end": last.tolist(), "params": r["params"]})
            made = [pa.array([r[c] for r in out], t) for c, t in (("part", pa.int64()), ("n", pa.int64()), ("end", pa.list_(pa.float64())), ("params", pa.list_(pa.float64())))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keys), *made], names=[*keys, "part", "n", "end", "params"])

    def hand_down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, numbers, states = [], [], []
            for i, r in enumerate(batch.drop_columns(keys).to_pylist()):
                weights, columns = recurrences(np.asarray(r["params"], float))
                start = np.zeros(len(r["parts"][0]["end"])) if r["state"] is None else np.asarray(r["state"], float)
                at += [i] * len(r["parts"])
                numbers += [p["part"] for p in r["parts"]]
                states += _follow(r["parts"], start, weights, columns)[:-1]
            made = [pa.array(numbers, pa.int64()), pa.array([s.tolist() for s in states], pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(pa.array(at, pa.int64())) for c in keys), *made], names=[*keys, "part", "state"])

    def packed(level: DataFrame, count: int) -> DataFrame:
        # dealt out by their number: the rows are small, but each takes its time
        dealt = level.withColumn("__fold", group).repartition(tasks_for(count, TASK_PARTS), *keys, "__fold")
        return dealt.groupBy(*keys, "__fold").agg(
            F.sort_array(F.collect_list(F.struct("part", "n", "end"))).alias("parts"), F.first("params").alias("params"), *([F.first("state").alias("state")] if "state" in level.columns else [])
        )

    most, count = ends.agg(F.coalesce(F.max("part"), F.lit(0)), F.count(F.lit(1))).first()
    levels, counts = [ends], [count]
    group = F.floor(F.col("part") / FAN).cast("long")
    while most >= FAN:
        folded = packed(levels[-1], counts[-1]).mapInArrow(fold, f"{named}, part long, n long, end array<double>, params array<double>")
        levels.append(materialize(folded))
        counts.append(levels[-1].count())
        most //= FAN
    states = None
    for level, count in zip(reversed(levels), reversed(counts)):
        if states is None:
            rows = level.withColumn("state", F.lit(None).cast("array<double>"))
        else:
            above = states.select(*[F.col(c).alias(f"__a_{c}") for c in keys], F.col("part").alias("__fold_of"), "state")
            cond = group == F.col("__fold_of")
            for c in keys:
                cond = cond & F.col(c).eqNullSafe(F.col(f"__a_{c}"))
            rows = level.join(above, cond).drop("__fold_of", *[f"__a_{c}" for c in keys])
        states = materialize(packed(rows, count).mapInArrow(hand_down, f"{named}, part long, state array<double>"))
    return states
