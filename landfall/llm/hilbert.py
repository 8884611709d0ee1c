"""The Hilbert curve: index of a cell, as a column expression and for numpy arrays.

Both follow the transposed-bits formulation: undo the rotations from the top bit
down, Gray-decode over the dimensions, then interleave the bits.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def curve_column(levels: list[Column], bits: int) -> Column:
    """Index of the cell with the given integer levels (0 to 2**bits - 1), a long; built-in functions only."""
    n = len(levels)
    if n * bits > 62:
        raise ValueError("the index needs more than 62 bits")
    turns = [(1 << b, i) for b in range(bits - 1, 0, -1) for i in range(n)]

    def turn(x: Column, s: Column) -> Column:
        q, i, low = s["q"], s["i"], s["q"] - 1
        here, first = F.get(x, i), F.get(x, F.lit(0))
        is_set = here.bitwiseAND(q) != 0
        swap = F.when(is_set, F.lit(0)).otherwise(first.bitwiseXOR(here).bitwiseAND(low))
        flip = F.when(is_set, low).otherwise(swap)
        return F.transform(
            x,
            lambda v, k: v.bitwiseXOR(F.when(k == 0, flip).otherwise(F.when(k == i, swap).otherwise(F.lit(0)))),
        )

    x = F.array(*[c.cast("int") for c in levels])
    if turns:
        steps = F.array(*[F.struct(F.lit(q).alias("q"), F.lit(i).alias("i")) for q, i in turns])
        x = F.aggregate(steps, x, turn)
    # Gray code: every dimension is XORed with all before it.
    grey = F.transform(x, lambda v, k: F.aggregate(F.slice(x, 1, k + 1), F.lit(0), lambda a, b: a.bitwiseXOR(b)))
    last = lambda g: F.get(g, F.lit(n - 1))
    halves = F.array(*[F.lit(1 << b) for b in range(1, bits)]) if bits > 1 else F.array().cast("array<int>")
    tail = lambda g: F.aggregate(
        halves, F.lit(0), lambda t, q: F.when(last(g).bitwiseAND(q) != 0, t.bitwiseXOR(q - 1)).otherwise(t)
    )
    done = F.transform(F.array(grey), lambda g: F.struct(g.alias("g"), tail(g).alias("t")))
    places = F.array(*[F.struct(F.lit(b).alias("b"), F.lit(i).alias("i")) for b in range(bits - 1, -1, -1) for i in range(n)])
    return F.get(
        F.transform(
            done,
            lambda d: F.aggregate(
                places,
                F.lit(0).cast("long"),
                lambda h, p: h * 2 + F.call_function("shiftright", F.get(d["g"], p["i"]).bitwiseXOR(d["t"]), p["b"]).bitwiseAND(F.lit(1)),
            ),
        ),
        F.lit(0),
    )


def curve_index(levels: np.ndarray, bits: int) -> np.ndarray:
    """Index of each row of ``levels`` (rows x dimensions, 0 to 2**bits - 1) as int64."""
    x = levels.astype(np.int64).T.copy()
    n = len(x)
    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        for i in range(n):
            is_set = (x[i] >> b) & 1 == 1
            swap = np.where(is_set, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(is_set, low, swap)
            if i:
                x[i] ^= swap
    x = np.bitwise_xor.accumulate(x, axis=0)
    tail = np.zeros_like(x[0])
    for b in range(1, bits):
        tail ^= ((x[-1] >> b) & 1) * ((1 << b) - 1)
    x ^= tail
    index = np.zeros_like(tail)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            index = (index << 1) | ((x[i] >> b) & 1)
    return index
