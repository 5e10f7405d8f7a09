"""Where the rows of player tables lie: in parts by month and by a hash bucket of the player.

What a refresh of some players reads and writes is the parts of their buckets, and what a refresh of some days
reads and writes is those of their months; a table's layout is the expression that names its parts.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of players that one bucket is meant to hold, over all months.
ROWS_PER_BUCKET = 50_000_000
MOST_BUCKETS = 4096

Parts = Callable[[str], bool]


def buckets_for(rows: int) -> int:
    """A power of two that grows with the table, so that a bucket of a month stays a few files."""
    return min(MOST_BUCKETS, 1 << max(0, math.ceil(math.log2(max(1, rows) / ROWS_PER_BUCKET))))


def bucket(buckets: int, key: str = "steamid") -> str:
    return f"pmod(xxhash64({key}), {buckets})"


def by_month_and_player(buckets: int, day: str = "match_date") -> str:
    return f"concat(coalesce(date_format({day}, 'yyyy-MM'), 'none'), '~', {bucket(buckets)})"


def by_player(buckets: int) -> str:
    return f"concat('all~', {bucket(buckets)})"


def buckets_of(by: str | None) -> int | None:
    """The number of buckets of a layout; None for one without."""
    m = re.search(r"pmod\(xxhash64\(steamid\), (\d+)\)", by or "")
    return int(m[1]) if m else None


def touched(players: DataFrame, buckets: int) -> set[int]:
    """The buckets of these players: at most as many small numbers as there are buckets come to the driver."""
    return {r[0] for r in players.select(F.expr(bucket(buckets)).alias("b")).distinct().collect()}


def parts_of(buckets: Iterable[int] | None = None, month: Parts | None = None) -> Parts:
    """Parts of these buckets and months; None for all of them."""
    some = None if buckets is None else {str(b) for b in buckets}

    def wanted(part: str) -> bool:
        when, _, b = part.partition("~")
        return (month is None or month(when)) and (some is None or not b or b in some)

    return wanted
