"""How many parts a frame is dealt to, so that a task's rows do not grow with the input."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame

#: Rows of a table of lifetimes (each fans out to months) that one task takes, and the fewest worth a task of their own.
MOST, LEAST = 100_000, 5_000


def parts_for(frame: DataFrame, most: int = MOST, least: int = LEAST) -> int:
    """Parts of at most ``most`` rows on average; below that, the session's shuffle partitions, but none under ``least`` rows, and two at least.

    Counts the frame in a job of its own, so pass a table or what is cheap to read.
    Adaptive execution merges partitions by their compressed bytes before they
    fan out; a number given to ``repartition`` it leaves alone.
    """
    rows = frame.count()
    session = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(2, math.ceil(rows / most), min(session, math.ceil(rows / least)))
