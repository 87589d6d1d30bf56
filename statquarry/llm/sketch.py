"""Count-min sketch with counters that stop at two, kept as bit planes and merged in a tree.

Every partition counts its own values into ``depth`` rows of cells.  Two planes hold a saturating counter: "one or more"
and "two or more".  Planes of a few partitions are merged at a time, so no task ever holds more than ``FAN`` copies of a
block.  A merged counter is at least the number of the value's occurrences as far as two, so a value counted below two
occurs once: nothing that repeats is missed, and values that collide are only let through to the exact pass.

The number of cells follows the number of values up to ``max_cells``; this bounds the planes sent to every task
(``depth * max_cells / 8`` bytes).  Beyond it the sketch lets more values pass, and the exact pass does more work.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statquarry.llm.arrays import M1, mix, release

BLOCK_BITS = 19
FAN = 48
SCHEMA = "line int, block int, part int, once binary, twice binary"


def cells(values: np.ndarray, line: int, bits: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix(values ^ (np.uint64(line + 1) * M1)) >> np.uint64(64 - bits)).astype(np.int64)


def _pack(inside: np.ndarray, bits: int) -> bytes:
    plane = np.zeros(1 << bits, bool)
    plane[inside] = True
    return zlib.compress(np.packbits(plane).tobytes(), 1)


def _planes(arrays: Iterator[np.ndarray], depth: int, bits: int) -> Iterator[pa.RecordBatch]:
    """Bit planes of one partition, from its arrays of values."""
    block_bits = min(BLOCK_BITS, bits)
    counted: list[list[np.ndarray]] = [[np.zeros(0, np.int64), np.zeros(0, np.int64)] for _ in range(depth)]
    waiting: list[np.ndarray] = []

    def fold() -> None:
        values = np.concatenate(waiting) if waiting else np.zeros(0, np.uint64)
        waiting.clear()
        for line in range(depth):
            once, counts = np.unique(cells(values, line, bits), return_counts=True)
            before, twice = counted[line]
            again = np.intersect1d(before, once, assume_unique=True)
            counted[line] = [np.union1d(before, once), np.union1d(twice, np.union1d(once[counts > 1], again))]

    for values in arrays:
        waiting.append(values)
        if sum(map(len, waiting)) > 1 << 20:
            fold()
    fold()
    part = TaskContext.get().partitionId()
    rows = []
    for line, (once, twice) in enumerate(counted):
        edges = np.arange((1 << (bits - block_bits)) + 1) << block_bits
        one, two = np.searchsorted(once, edges), np.searchsorted(twice, edges)
        for block in np.flatnonzero(np.diff(one)):
            base = int(block) << block_bits
            rows.append(
                (line, int(block), part, _pack(once[one[block] : one[block + 1]] - base, block_bits),
                 _pack(twice[two[block] : two[block + 1]] - base, block_bits))
            )
    if rows:
        line, block, parts, once, twice = zip(*rows)
        yield pa.RecordBatch.from_arrays(
            [pa.array(line, pa.int32()), pa.array(block, pa.int32()), pa.array(parts, pa.int32()),
             pa.array(once, pa.binary()), pa.array(twice, pa.binary())],
            names=["line", "block", "part", "once", "twice"],
        )
    del counted, rows
    release()


def _merge(group: pd.DataFrame) -> pd.DataFrame:
    once = twice = None
    for a, b in zip(group["once"], group["twice"]):
        one, two = (np.frombuffer(zlib.decompress(x), np.uint8) for x in (a, b))
        if once is None:
            once, twice = one.copy(), two.copy()
        else:
            twice |= two | (once & one)
            once |= one
    return pd.DataFrame(
        {"line": [group["line"].iloc[0]], "block": [group["block"].iloc[0]], "part": [group["part"].iloc[0] // FAN],
         "once": [zlib.compress(once.tobytes(), 1)], "twice": [zlib.compress(twice.tobytes(), 1)]}
    )


class Sketch:
    """Merged planes of one kind; travels to the tasks in a broadcast variable."""

    def __init__(self, planes: dict[tuple[int, int], bytes], depth: int, bits: int):
        self.planes, self.depth, self.bits = planes, depth, bits

    def __getstate__(self):
        return {"planes": self.planes, "depth": self.depth, "bits": self.bits}

    def __setstate__(self, state):
        self.__dict__.update(state)

    def _lines(self) -> list[np.ndarray]:
        if "open" not in self.__dict__:
            block = 1 << min(BLOCK_BITS, self.bits)
            self.open = []
            for line in range(self.depth):
                plane = np.zeros((1 << self.bits) // 8, np.uint8)
                for (at, number), data in self.planes.items():
                    if at == line:
                        low = number * block // 8
                        plane[low : low + block // 8] = np.frombuffer(zlib.decompress(data), np.uint8)
                self.open.append(plane)
        return self.open

    def passes(self, values: np.ndarray) -> np.ndarray:
        """Whether the estimate of each value reaches the sketch's level (two, or one)."""
        keep = np.ones(len(values), bool)
        for line, plane in enumerate(self._lines()):
            at = cells(values, line, self.bits)
            keep &= (plane[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
        return keep


def sketch_bits(expected: int, cells_per_value: int, max_cells: int) -> int:
    """Cells (as a power of two) for so many values."""
    wanted = max(1 << 12, min(max_cells, max(1, expected) * cells_per_value))
    return min((wanted - 1).bit_length(), max_cells.bit_length() - 1)


def build(
    df: DataFrame, arrays: Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]], level: str, depth: int, bits: int
) -> Sketch:
    """Sketch of the values that ``arrays`` draws from the batches of ``df``; ``level`` is ``once`` or ``twice``."""
    rows = df.mapInArrow(lambda batches: _planes(arrays(batches), depth, bits), SCHEMA)
    parts = df.rdd.getNumPartitions()
    while parts > FAN:
        rows = rows.groupBy("line", "block", F.expr(f"part div {FAN}")).applyInPandas(lambda group: _merge(group), SCHEMA)
        parts = -(-parts // FAN)
    # the last level takes all parts of a block, also if the plan that ran had more of them than the frame reported
    rows = rows.groupBy("line", "block").applyInPandas(lambda group: _merge(group), SCHEMA)
    found = rows.select("line", "block", level).collect()  # at most depth * max_cells / 8 bytes, whatever the input
    return Sketch({(r[0], r[1]): bytes(r[2]) for r in found}, depth, bits)
