"""Backfill planning (C9, A5): which months must be generated to reach a row target.

The original tool ran one job per month, newest first, and stopped as soon as the rows
generated so far reached the target (or the end month was passed). The same decision is
one query: a month is needed when the rows of all *newer* months in the range stay below
the target. Rows are counted, not file lines (no header line per file), and the range is
closed: ``[oldest, newest]``.

:func:`gallop_until_target` decides while it makes the months, and makes few more than the
ones needed; the other functions decide from counts at hand.

The running sum is a window without partition over the **monthly aggregate** (one row
per month, so the frame is bounded by the calendar, not by the data).
"""

from __future__ import annotations

from collections.abc import Callable, Hashable, Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def months_until_target(
    monthly: DataFrame,
    month_column: str,
    count_column: str,
    target: int,
    newest: str | None = None,
    oldest: str | None = None,
    output: str = "rows_before",
    within: tuple[str, ...] | list[str] = (),
) -> DataFrame:
    """Months (newest first) whose newer months hold fewer than ``target`` rows.

    ``monthly``: one row per month (per ``within`` group, e.g. site and corner) with its row
    count. ``newest``/``oldest`` bound the range (inclusive, compared with ``month_column``
    as given, e.g. ``"1996-03"``).
    """
    frame = monthly
    if newest is not None:
        frame = frame.where(F.col(month_column) <= F.lit(newest))
    if oldest is not None:
        frame = frame.where(F.col(month_column) >= F.lit(oldest))
    before = (
        Window.partitionBy(*within)
        .orderBy(F.col(month_column).desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return frame.withColumn(output, F.coalesce(F.sum(count_column).over(before), F.lit(0)).cast("bigint")).where(
        F.col(output) < F.lit(target)
    )


def keep_until_target(
    result: DataFrame,
    target: int,
    month_column: str = "target_date",
    within: tuple[str, ...] | list[str] = ("site", "corner"),
) -> DataFrame:
    """Rows of the months a newest-first backfill would have published.

    ``result`` holds several months (``month_column``) per ``within`` group; a month is kept
    when the rows of the newer months of its group stay below ``target``. The decision is a
    window over one count per (group, month); the rows are kept by a semi join on it.
    """
    within = list(within)
    counts = result.groupBy(*within, month_column).agg(F.count(F.lit(1)).alias("__fc_rows"))
    needed = months_until_target(counts, month_column, "__fc_rows", target, within=within).select(
        *within, month_column
    )
    keys = within + [month_column]
    return result.join(needed, keys, "left_semi")


def runs_of(months: Sequence, wanted: Mapping[Hashable, Sequence]) -> dict[tuple, list]:
    """The keys by each run of neighbouring months they want: ``{(oldest, newest): [key, ...]}``.

    ``months`` is the calendar, newest first; a key whose wanted months have gaps is in several
    runs. Keys and months are configuration and calendar.
    """
    place = {m: k for k, m in enumerate(months)}
    out: dict[tuple, list] = {}
    for key, own in wanted.items():
        at = sorted(place[m] for m in own)
        cuts = [0, *[k for k in range(1, len(at)) if at[k] != at[k - 1] + 1], len(at)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a < b:
                out.setdefault((months[at[b - 1]], months[at[a]]), []).append(key)
    return out


def gallop_until_target(
    keys: Sequence[Hashable],
    months: Sequence,
    target: int,
    evaluate: Callable[[list, object, object], Mapping[tuple, int]],
    known: Mapping[tuple, int] | None = None,
) -> list[tuple]:
    """The (key, month) pairs a newest-first backfill has to make until every key has ``target``
    rows or no month is left (C9, A5).

    ``months``, newest first, are evaluated in ranges of 1, 2, 4, ... months, for the keys that
    are still short; what lies beyond the last range needed is never looked at.
    ``evaluate(keys, oldest, newest)`` makes these months and returns their rows by (key, month)
    (a pair left out has none). ``known`` holds the rows of pairs that count but are not made.
    A month is needed when the rows of all newer months of its key stay below ``target``.
    """
    rows, made, size = dict(known or {}), set(), 1

    def unseen(key) -> list:
        """The next months of a key to make, newest first."""
        total, out = 0, []
        for m in months:
            if total >= target or len(out) == size:
                break
            if (key, m) in rows:
                total += rows[key, m]
            else:
                out.append(m)
        return out

    while True:
        wanted = {key: own for key in keys if (own := unseen(key))}
        if not wanted:
            break
        for (oldest, newest), some in runs_of(months, wanted).items():
            found = evaluate(some, oldest, newest)
            span = months[months.index(newest):months.index(oldest) + 1]
            pairs = [(key, m) for key in some for m in span]
            rows.update({p: found.get(p, 0) for p in pairs})
            made.update(pairs)
        size *= 2
    needed = []
    for key in keys:
        total = 0
        for m in months:
            if total >= target:
                break
            if (key, m) in made:
                needed.append((key, m))
            total += rows[key, m]
    return needed
