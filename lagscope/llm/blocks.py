"""Comparing the members of groups of any size, some of them very large, in tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def blocks_of(members: DataFrame, keys: list[str], size: int) -> DataFrame:
    """``members`` (with id) of groups of two or more, once for each pair of blocks
    (i <= j) they take part in; side is the member's own block.

    A group of n members has about n / size blocks. Groups are counted before
    anything is moved, and the blocks of a large one are spread over tasks.
    """
    counts = members.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    n_blocks = F.ceil(F.col("_n") / size).cast("int")
    return (
        members.join(counts, keys)
        .withColumn("_blocks", n_blocks)
        .withColumn("side", F.pmod(F.xxhash64("id"), F.col("_blocks")).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
        .withColumn("i", F.least("side", "_other"))
        .withColumn("j", F.greatest("side", "_other"))
        .drop("_n", "_blocks", "_other")
    )


def dealt(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of a key side by side in one partition."""
    return df.repartition(*keys).sortWithinPartitions(*keys)


def grouped(frames: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Frames of whole groups, from frames that are sorted by the keys."""
    held: list[pd.DataFrame] = []
    for frame in frames:
        if not len(frame):
            continue
        last = frame[keys].iloc[-1]
        open_rows = (frame[keys] == last).all(axis=1).to_numpy()
        # Rows of the last key go to the end, as the frame is sorted.
        cut_at = int(np.argmax(open_rows))
        if cut_at:
            yield pd.concat([*held, frame.iloc[:cut_at]], ignore_index=True)
            held = []
        elif held and not (held[-1][keys].iloc[-1] == last).all():
            yield pd.concat(held, ignore_index=True)
            held = []
        held.append(frame.iloc[cut_at:])
    if held:
        yield pd.concat(held, ignore_index=True)


def slices(frame: pd.DataFrame, keys: list[str]) -> Iterator[tuple[int, int]]:
    """(start, end) of each group of a sorted frame."""
    changed = np.zeros(len(frame), bool)
    changed[0] = True
    for k in keys:
        values = frame[k].to_numpy()
        changed[1:] |= values[1:] != values[:-1]
    starts = np.flatnonzero(changed)
    yield from zip(starts, [*starts[1:], len(frame)], strict=True)
