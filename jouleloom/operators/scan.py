"""Ordered scans over one timeline per key: gaps, previous value, running sum, any-flag.

Short timelines are one window each. Long ones are split into segments (extra partition columns
whose order follows the row order): windows run inside a segment, one small row per segment is
carried over to the next ones, and no task ever holds a whole long timeline. Where the first
segment column is null the key is whole and takes no part in that.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jouleloom.operators.exact import LIMBS, joined, limbs

_START = Window.unboundedPreceding


@dataclass(frozen=True)
class Order:
    """Partition keys, row order (ascending, nulls first) and optional segment columns."""

    keys: Sequence[str]
    order: Sequence[str]
    segment: Sequence[str] = field(default_factory=tuple)

    @property
    def part(self) -> list[str]:
        return [*self.keys, *self.segment]

    def forward(self):
        return Window.partitionBy(*map(_q, self.part)).orderBy(*[_c(c).asc_nulls_first() for c in self.order])

    def backward(self):
        return Window.partitionBy(*map(_q, self.part)).orderBy(*[_c(c).desc_nulls_last() for c in self.order])

    def whole(self):
        # Ordered like the other forward windows, so that all share one sort.
        return self.forward().rowsBetween(_START, Window.unboundedFollowing)

    def segments(self, reverse: bool = False):
        cols = [_c(c).desc() if reverse else _c(c).asc() for c in self.segment]
        return Window.partitionBy(*map(_q, self.keys)).orderBy(*cols)


def _q(name: str) -> str:
    return f"`{name}`"


def _c(name: str) -> Column:
    return F.col(_q(name))


_POS = "scan~pos"
_BACK = "scan~back"
SUMMED = "sum~"


def _limb(out: str, name: str) -> str:
    return f"{name}~{out}"


def scan(
    df: DataFrame,
    order: Order,
    *,
    position: str | None = None,
    lags: dict[str, str] | None = None,
    sums: dict[str, str] | None = None,
    gaps: Sequence[str] = (),
    flags: dict[str, str] | None = None,
) -> DataFrame:
    """Add scan results in one pass.

    position -- output name of the 1-based row position within the key
    lags     -- output -> input column: the previous row's value
    sums     -- output -> input column: running sum; null where the input is null. Sums of broken
                numbers are exact (see exact.py): segments don't change a bit of them
    gaps     -- columns to find the nearest non-null value for, at or before and at or after
                (`lo(c)`, `hi(c)`), and its position (`lo_at(c)`, and `hi_at(c)` from the end);
                these and the row's own positions are left for `interpolate`
    flags    -- output -> input boolean column: true if it is true anywhere in the key

    The reverse windows come first and the forward ones last, so a following scan in the same
    order finds its rows sorted already.
    """
    lags, sums, flags = lags or {}, sums or {}, flags or {}
    split = bool(order.segment)
    broken = [out for out, c in sums.items() if isinstance(df.schema[c].dataType, T.FractionalType)]
    parts = {_limb(out, name): part for out in broken for name, part in limbs(_c(sums[out]).cast("double")).items()}
    given = sums
    sums = {out: c for out, c in sums.items() if out not in broken} | {f"{SUMMED}{name}": name for name in parts}
    df = df.withColumns(parts)
    fw = order.forward()
    upto, down, whole = fw.rowsBetween(_START, 0), order.backward().rowsBetween(_START, 0), order.whole()

    rows = df
    if gaps:
        # The next non-null value is the last one in reverse order: a frame to the end of the
        # partition would rescan it for every row.
        rows = rows.withColumn(_BACK, F.row_number().over(order.backward()).cast("bigint"))
        rows = rows.withColumns(_nearest(gaps, hi, hi_at, _BACK, down))
    local: dict[str, Column] = {}
    if position or gaps or (split and lags):
        local[_POS] = F.row_number().over(fw).cast("bigint")
    for out, c in lags.items():
        local[out] = F.lag(_c(c)).over(fw)
    for out, c in sums.items():
        local[out] = F.sum(_c(c)).over(upto)
    for out, c in flags.items():
        local[out] = F.max(_c(c)).over(whole)
    rows = rows.withColumns(local)
    if gaps:
        rows = rows.withColumns(_nearest(gaps, lo, lo_at, _POS, upto))
    if split:
        rows = _carry_over(rows, order, lags, sums, gaps, flags)
    if given:
        totals = {out: joined({name: _c(SUMMED + _limb(out, name)) for name in LIMBS}) if out in broken else _c(out) for out in given}
        rows = rows.withColumns({out: F.when(_c(given[out]).isNotNull(), total) for out, total in totals.items()})
        rows = rows.drop(*parts, *[SUMMED + name for name in parts])
    if gaps:
        return rows
    if position:
        rows = rows.withColumn(position, _c(_POS))
    return rows.drop(_POS, _BACK)


def _nearest(gaps: Sequence[str], value, at, position: str, window) -> dict[str, Column]:
    """Last non-null value of every column in the window, and its position."""
    found = {value(c): F.last(_c(c), ignorenulls=True).over(window) for c in gaps}
    for c in gaps:
        where = F.when(_c(c).isNotNull(), _c(position))
        found[at(c)] = F.last(where, ignorenulls=True).over(window)
    return found


def lo(column: str) -> str:
    return f"lo~{column}"


def lo_at(column: str) -> str:
    return f"lo~at~{column}"


def hi(column: str) -> str:
    return f"hi~{column}"


def hi_at(column: str) -> str:
    return f"hi~at~{column}"


def _point(column: str, at: str) -> Column:
    return F.when(_c(column).isNotNull(), F.struct(_c(at).alias("at"), _c(column).alias("v")))


def _carry_over(rows: DataFrame, order: Order, lags, sums, gaps, flags) -> DataFrame:
    """Add what earlier and later segments contribute to every segment."""
    aggs = [F.count(F.lit(1)).alias("c~n")]
    for out, c in lags.items():
        aggs.append(F.max_by(_c(c), _c(_POS)).alias(f"c~lag~{out}"))
    for out, c in sums.items():
        aggs.append(F.sum(_c(c)).alias(f"c~sum~{out}"))
    for c in gaps:
        aggs.append(F.max(_point(c, _BACK)).alias(f"c~first~{c}"))
        aggs.append(F.max(_point(c, _POS)).alias(f"c~last~{c}"))
    for out in flags:
        aggs.append(F.max(_c(out)).alias(f"c~flag~{out}"))
    # Whole keys have no segment: nothing is carried, and the filter reaches down to the source.
    in_parts = rows.where(_c(order.segment[0]).isNotNull())
    per_segment = in_parts.groupBy(*map(_c, order.part)).agg(*aggs)

    ws, wr = order.segments(), order.segments(reverse=True)
    before, after = ws.rowsBetween(_START, -1), wr.rowsBetween(_START, -1)
    numbered = per_segment.withColumns(
        {
            "k~before": F.coalesce(F.sum("`c~n`").over(before), F.lit(0)),
            "k~after": F.coalesce(F.sum("`c~n`").over(after), F.lit(0)),
        }
    )

    def moved(c: str, by: str) -> Column:
        point = _c(c)
        return F.when(point.isNotNull(), F.struct((point["at"] + _c(by)).alias("at"), point["v"].alias("v")))

    carried = [*map(_c, order.part), _c("k~before"), _c("k~after")]
    for out in lags:
        carried.append(F.lag(_c(f"c~lag~{out}")).over(ws).alias(f"k~lag~{out}"))
    for out in sums:
        carried.append(F.sum(_c(f"c~sum~{out}")).over(before).alias(f"k~sum~{out}"))
    for c in gaps:
        last, first = moved(f"c~last~{c}", "k~before"), moved(f"c~first~{c}", "k~after")
        carried.append(F.last(last, ignorenulls=True).over(before).alias(f"k~lo~{c}"))
        carried.append(F.last(first, ignorenulls=True).over(after).alias(f"k~hi~{c}"))
    for out in flags:
        anywhere = Window.partitionBy(*map(_q, order.keys))
        carried.append(F.max(_c(f"c~flag~{out}")).over(anywhere).alias(f"k~flag~{out}"))
    joined = rows.join(numbered.select(*carried), list(order.part), "left")

    done: dict[str, Column] = {}
    for out in lags:
        done[out] = F.when(_c(_POS) == 1, _c(f"k~lag~{out}")).otherwise(_c(out))
    for out in sums:  # null before the first number
        carried_sum = _c(f"k~sum~{out}")
        done[out] = F.coalesce(_c(out) + carried_sum, _c(out), carried_sum)
    for c in gaps:
        for value, at, side, by in ((lo, lo_at, "lo", "k~before"), (hi, hi_at, "hi", "k~after")):
            carried_point = _c(f"k~{side}~{c}")
            done[value(c)] = F.coalesce(_c(value(c)), carried_point["v"])
            done[at(c)] = F.coalesce(_c(at(c)) + F.coalesce(_c(by), F.lit(0)), carried_point["at"])
    for out in flags:
        done[out] = F.coalesce(_c(f"k~flag~{out}"), _c(out))
    for here, by in ((_POS, "k~before"), (_BACK, "k~after")):
        if here in rows.columns:
            done[here] = _c(here) + F.coalesce(_c(by), F.lit(0))
    helpers = [c for c in joined.columns if c.startswith("k~")]
    return joined.withColumns(done).drop(*helpers)


def interpolate(df: DataFrame, columns: Sequence[str], order: Order, **also) -> DataFrame:
    """Linear interpolation by row position; `also` is passed on to the same scan.

    Gaps at either end stay null. Positions count rows, not time. Results are doubles.
    """
    if not columns:
        return scan(df, order, **also)
    typed = df.withColumns({c: _c(c).cast("double") for c in columns})
    scanned = scan(typed, order, gaps=columns, **also)

    def filled(c: str) -> Column:
        back, ahead = _c(_POS) - _c(lo_at(c)), _c(_BACK) - _c(hi_at(c))
        step = (_c(hi(c)) - _c(lo(c))) / F.nullif(back + ahead, F.lit(0))
        return F.coalesce(_c(c), _c(lo(c)) + back * step).alias(c)

    helpers = {g(c) for c in columns for g in (lo, lo_at, hi, hi_at)} | {_POS, _BACK}
    return scanned.select(*[filled(c) if c in columns else _c(c) for c in scanned.columns if c not in helpers])


def row_positions(df: DataFrame, order: Order, out: str) -> DataFrame:
    """0-based position of a row within its key."""
    return scan(df, order, position=out).withColumn(out, _c(out) - 1)
