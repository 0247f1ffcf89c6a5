"""Joins of points in time to validity windows ``[valid_from, valid_to)``.

``range_join``  — left (or inner) join keeping every matching window, so
                  overlapping windows fan out exactly like the SQL form.
``asof_join``   — the same result for non-overlapping windows, computed with
                  a running ``last`` instead of a join.
``range_join_dyadic`` — the range join for windows of very mixed length: each is
                  covered by one or two aligned intervals of a power-of-two length.
``asof_carried`` — the as-of join over contiguous runs of (keys, time), each of which
                  carries its last window on to the next ones.

The first two split time into buckets (``unit="auto"`` picks hour … year from the
windows' lengths) and work on (keys, bucket):
a plain range predicate with no equality would be planned as a nested-loop
join. Each window is exploded into the buckets it covers, up to the latest
window start (``horizon``): no window starts after it, so the windows that
outlive its bucket are the same for every later point. They are copied into
``TAILS`` tail buckets, and later points are spread over these by a hash of
their own bucket; an end far away, open or not, costs ``TAILS`` rows. The horizon
comes from the window side only, so the large point side is read once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..schemas import FAR_FUTURE
from ..session import materialise as write_and_read

DEFAULT_BROADCAST_ROWS = 200_000        # exploded window rows that may be broadcast ...
DEFAULT_BROADCAST_BYTES = 64 << 20      # ... if they also take no more than this
TAILS = 8                               # buckets that share the points after the horizon
MAX_SPREAD = 3.0                        # buckets that windows may cover on average, for unit="auto"
_B = "__vb_bucket"
_W = "__w_"


def _bucket(col: Column, unit: str) -> Column:
    return F.date_trunc(unit, col).cast("timestamp_ntz")


# Bucket units, smallest first, with their step and length in seconds.
UNITS = {
    "HOUR": ("INTERVAL 1 HOUR", 3600),
    "DAY": ("INTERVAL 1 DAY", 86400),
    "WEEK": ("INTERVAL 7 DAY", 7 * 86400),
    "MONTH": ("INTERVAL 1 MONTH", 31 * 86400),
    "QUARTER": ("INTERVAL 3 MONTH", 92 * 86400),
    "YEAR": ("INTERVAL 1 YEAR", 366 * 86400),
}


def _step(unit: str) -> Column:
    return F.expr(UNITS[unit][0])


def pick_unit(unit: str, rows: int, spread: dict[str, int]) -> str:
    """``auto``: the smallest unit in which the windows cover at most ``MAX_SPREAD`` buckets on average.

    ``spread`` has the number of (window, bucket) rows per unit, so many short
    windows and a few long ones are judged by the rows they make, not by a mean length.
    """
    if unit != "auto":
        return unit
    return next((name for name in UNITS if spread[name] <= MAX_SPREAD * rows), "YEAR")


@dataclass(frozen=True)
class WindowStats:
    """What one aggregate over the written windows tells."""
    horizon: Column            # latest start, a literal (NULL without windows: nothing can match)
    unit: str
    exploded_rows: int         # at most
    exploded_bytes: int        # at most, as rows in memory


def _seconds(col: Column) -> Column:
    return F.unix_seconds(col.cast("timestamp"))


def measure_windows(windows: DataFrame, valid_from: str, valid_to: str, unit: str) -> WindowStats:
    """Measure the materialised windows: two small aggregates over Parquet, no row leaves its task."""
    wanted = windows.filter(F.col(valid_from) < F.col(valid_to))
    last = wanted.agg(F.max(valid_from)).first()[0]
    horizon = F.lit(last).cast("timestamp_ntz")
    lasts = _seconds(F.least(F.col(valid_to), horizon)) - _seconds(F.col(valid_from))
    # A calendar unit can be this much shorter than its nominal length (February, leap years).
    per_unit = {u: F.sum(F.floor(lasts / (length * 0.9)) + 2) for u, (_, length) in UNITS.items()}
    text = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in windows.schema.fields if f.dataType.typeName() in ("string", "binary")]
    width = F.lit(32 + 16 * (len(windows.columns) + 1))
    for t in text:
        width = width + t
    found = wanted.agg(F.count(F.lit(1)).alias("n"), F.max(width).alias("w"), *[e.alias(u) for u, e in per_unit.items()],
                       F.count_if(F.col(valid_to) > horizon).alias("beyond"),
                       *[F.sum(F.floor(lasts / length) + 1).alias(f"mean_{u}") for u, (_, length) in UNITS.items()]).first()
    if not found["n"]:
        return WindowStats(horizon, "DAY" if unit == "auto" else unit, 0, 0)
    unit = pick_unit(unit, found["n"], {u: found[f"mean_{u}"] for u in UNITS})
    rows = found[unit] + TAILS * found["beyond"]
    return WindowStats(horizon, unit, rows, rows * found["w"])


def explode_windows(windows: DataFrame, valid_from: str, valid_to: str, unit: str,
                    horizon: Column) -> DataFrame:
    """One row per (window, bucket it covers or tail it reaches); empty and NULL windows drop out."""
    last = _bucket(horizon, unit)
    end = F.least(F.col(valid_to) - F.expr("INTERVAL 1 MICROSECOND"), horizon)
    covered = F.sequence(_bucket(F.col(valid_from), unit), _bucket(end, unit), _step(unit))
    tails = F.array(*[F.timestamp_add("SECOND", F.lit(i + 1), last) for i in range(TAILS)])
    none = F.array().cast("array<timestamp_ntz>")
    return (windows
            .filter(F.col(valid_from) < F.col(valid_to))
            .withColumn(_B, F.explode(F.concat(covered, F.when(F.col(valid_to) > last + _step(unit), tails).otherwise(none)))))


def _point_bucket(at: str, unit: str, horizon: Column) -> Column:
    """A point's own bucket, or one of the tails (some seconds into the horizon's bucket) after the horizon's."""
    own, last = _bucket(F.col(at), unit), _bucket(horizon, unit)
    tail = F.timestamp_add("SECOND", F.pmod(F.xxhash64(own), F.lit(TAILS)).cast("int") + 1, last)
    return F.when(own > last, tail).otherwise(own)


def materialise(df: DataFrame) -> DataFrame:
    """Write the (window) side once to the shared checkpoint folder.

    The window statistics, the size check and the join then all read the
    written copy instead of recomputing the window pipeline, and lineage is
    cut, so a lost executor does not force a rebuild of it.
    """
    return write_and_read(df, "windows")


def bounded(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows (a count: one number leaves each task)."""
    return df.count() <= max_rows


@dataclass(frozen=True)
class PreparedWindows:
    """A window table exploded into buckets, with what joining it needs."""
    exploded: DataFrame        # columns prefixed with ``__w_``
    on: tuple[str, ...]
    valid_from: str
    valid_to: str
    payload: tuple[str, ...]
    unit: str
    horizon: Column
    broadcast: bool            # size proven by measured rows and bytes

    def point_bucket(self, at: str) -> Column:
        """The bucket a point falls in, or its tail after the horizon's."""
        return _point_bucket(at, self.unit, self.horizon)


def prepare_windows(windows: DataFrame, valid_from: str, valid_to: str, on: Sequence[str] = (),
                    unit: str = "auto",
                    broadcast_rows: int | None = DEFAULT_BROADCAST_ROWS,
                    broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> PreparedWindows:
    """Materialise, measure and explode the window side once."""
    payload = [c for c in windows.columns if c not in (*on, valid_from, valid_to)]
    windows = materialise(windows.select(*on, valid_from, valid_to, *payload))
    stats = measure_windows(windows, valid_from, valid_to, unit)
    w = explode_windows(windows, valid_from, valid_to, stats.unit, stats.horizon)
    w = w.select(*[F.col(c).alias(_W + c) for c in w.columns])
    proven = (broadcast_rows is not None and stats.exploded_rows <= broadcast_rows
              and stats.exploded_bytes <= broadcast_bytes)
    return PreparedWindows(w, tuple(on), valid_from, valid_to, tuple(payload), stats.unit, stats.horizon, proven)


def join_prepared(points: DataFrame, prepared: PreparedWindows, at: str, how: str = "left",
                  bucket_col: str | None = None) -> DataFrame:
    """Join points to prepared windows. ``bucket_col`` names a bucket column the
    points already carry (``prepared.point_bucket(at)``), e.g. one they were
    partitioned on, so the join can reuse that partitioning."""
    if how not in ("left", "inner"):
        raise ValueError("range_join supports how='left' or 'inner'")
    clash = set(prepared.payload) & set(points.columns)
    if clash:
        raise ValueError(f"window columns also on the point side: {sorted(clash)}")
    # Where the size isn't proven: Spark's estimate after the explode may be far too small,
    # so keep it from auto-broadcasting; sort-merge spills safely.
    w = F.broadcast(prepared.exploded) if prepared.broadcast else prepared.exploded.hint("merge")
    b = bucket_col or _B
    p = points if bucket_col else points.withColumn(_B, prepared.point_bucket(at))
    cond = [p[k] == w[_W + k] for k in prepared.on]
    cond += [p[b] == w[_W + _B],
             p[at] >= w[_W + prepared.valid_from],
             p[at] < w[_W + prepared.valid_to]]
    joined = p.join(w, on=cond, how=how)
    return joined.select(*[p[c] for c in points.columns],
                         *[w[_W + c].alias(c) for c in prepared.payload])


def range_join(points: DataFrame, windows: DataFrame, at: str, valid_from: str, valid_to: str,
               on: Sequence[str] = (), how: str = "left", unit: str = "auto",
               broadcast_rows: int | None = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """``points ⟕ windows`` on equal ``on`` keys and ``valid_from <= at < valid_to``.

    Output: every point column, then every window column except the keys and
    the two bounds. Windows are broadcast only when their exploded form has at
    most ``broadcast_rows`` rows (``None``: never) and ``DEFAULT_BROADCAST_BYTES``; otherwise both sides
    shuffle on (keys, bucket) and AQE splits skewed buckets.
    """
    if how not in ("left", "inner"):
        raise ValueError("range_join supports how='left' or 'inner'")
    payload = [c for c in windows.columns if c not in (*on, valid_from, valid_to)]
    clash = set(payload) & set(points.columns)
    if clash:
        raise ValueError(f"window columns also on the point side: {sorted(clash)}")
    prepared = prepare_windows(windows, valid_from, valid_to, on, unit, broadcast_rows)
    return join_prepared(points, prepared, at, how)


def asof_join(points: DataFrame, windows: DataFrame, at: str, valid_from: str, valid_to: str,
              on: Sequence[str] = (), unit: str = "auto", salt: int = 1) -> DataFrame:
    """Left as-of join: the window with the latest start ``<= at``, kept if ``at < valid_to``.

    Equals ``range_join`` when windows of a key do not overlap (check with
    ``quality.overlapping_windows``); overlapping windows are not fanned out.
    Works inside (keys, bucket) partitions, so no key needs one task. With
    ``salt > 1`` a hot (key, bucket) is split further: every window marker is
    copied into each salt partition (markers are few), and each point takes a
    salt from a hash of its own columns, so a retried task splits the same way.
    """
    payload = [c for c in windows.columns if c not in (*on, valid_from, valid_to)]
    windows = materialise(windows.select(*on, valid_from, valid_to, *payload))
    stats = measure_windows(windows, valid_from, valid_to, unit)
    unit, horizon = stats.unit, stats.horizon
    w = explode_windows(windows, valid_from, valid_to, unit, horizon)
    mark = "__asof_mark"
    hit = "__asof_hit"
    kind = "__asof_kind"
    salt_col = "__asof_salt"
    markers = w.select(*on, _B,
                       F.explode(F.sequence(F.lit(0), F.lit(max(salt, 1) - 1))).alias(salt_col),
                       F.greatest(F.col(valid_from), F.col(_B)).alias(mark),
                       F.lit(0).alias(kind),
                       F.struct(valid_from, valid_to, *payload).alias(hit))
    pts = points.select(*on, _point_bucket(at, unit, horizon).alias(_B),
                        F.pmod(F.xxhash64(*points.columns), F.lit(max(salt, 1))).cast("int").alias(salt_col),
                        F.col(at).alias(mark), F.lit(1).alias(kind),
                        F.lit(None).cast(markers.schema[hit].dataType).alias(hit),
                        F.struct(*points.columns).alias("__asof_point"))
    markers = markers.withColumn("__asof_point", F.lit(None).cast(pts.schema["__asof_point"].dataType))
    both = pts.unionByName(markers)
    win = (Window.partitionBy(*on, _B, salt_col).orderBy(F.col(mark).asc_nulls_first(), F.col(kind))
           .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = both.withColumn(hit, F.last(hit, ignorenulls=True).over(win)).filter(F.col(kind) == 1)
    inside = (F.col(f"{hit}.{valid_from}") <= F.col(mark)) & (F.col(mark) < F.col(f"{hit}.{valid_to}"))
    found = found.withColumn(hit, F.when(inside, F.col(hit)))
    return found.select("__asof_point.*", *[F.col(f"{hit}.{c}").alias(c) for c in payload])


TICK_SECONDS = 1800                     # the smallest aligned interval: a half hour
STEP_BITS = 3                           # a level's intervals are 2^3 of the level below
DYADIC_LEVELS = 16                      # 2^45 half hours: any timestamp
HELD, HELD_MOST = 16, 1024              # windows in an interval, on average and at most, for lower levels to join a higher one


def _ticks(col: Column, tick: int, up: bool = False) -> Column:
    micros = F.unix_micros(col.cast("timestamp"))
    size = tick * 1_000_000
    down = (micros - F.pmod(micros, F.lit(size))) / size
    return (down + (F.pmod(micros, F.lit(size)) > 0).cast("int") if up else down).cast("long")


def _own_level(n: Column) -> Column:
    """The smallest level whose interval is as long as ``n`` ticks."""
    return sum((n > (1 << STEP_BITS * level)).cast("int") for level in range(DYADIC_LEVELS - 1))


def dyadic_cover(first: Column, end: Column, level: Column | int) -> Column:
    """array<bigint>: the level's aligned intervals that the ticks ``[first, end)`` touch: one or two at their own level or a higher one."""
    bits = F.lit(level) * STEP_BITS if isinstance(level, int) else level * STEP_BITS
    return F.sequence(F.call_function("shiftright", first, bits), F.call_function("shiftright", end - 1, bits))


def asked_levels(spans: DataFrame, on: Sequence[str]) -> dict[int, int]:
    """For each level that is the own one of some window the level where it is looked for.

    A level costs a row for each point, so lower levels join a higher one while its intervals then hold ``HELD`` windows
    on average (as a window meets them) and ``HELD_MOST`` at most. One aggregate over the windows for each level that stays.
    """
    present, asked = sorted(spans.agg(F.collect_set("__level")).first()[0]), {}
    while present:
        top, low = present[-1], present[-1]
        if len(present) > 1:
            held = (spans.where(F.col("__level") <= top)
                    .select(*on, "__level", F.explode(dyadic_cover(F.col("__first"), F.col("__end"), top)).alias("__bucket"))
                    .groupBy(*on, "__bucket").agg(*[F.count_if(F.col("__level") >= x).cast("double").alias(f"n{x}") for x in present]))
            found = held.agg(*[f(c).alias(f"{name}{x}") for x in present for name, f, c in (
                ("square", F.sum, F.col(f"n{x}") * F.col(f"n{x}")), ("rows", F.sum, F.col(f"n{x}")), ("most", F.max, F.col(f"n{x}")))]).first()
            low = next(x for x in present if x == top or (found[f"square{x}"] <= HELD * found[f"rows{x}"] and found[f"most{x}"] <= HELD_MOST))
        asked |= {x: top for x in present if x >= low}
        present = [x for x in present if x < low]
    return asked


@dataclass(frozen=True)
class DyadicWindows:
    """Windows cut into aligned intervals, and the levels that any of them uses."""
    pieces: DataFrame          # columns prefixed with ``__w_``, and __level, __bucket
    levels: tuple[int, ...]
    broadcast: bool            # size proven by measured rows and bytes


def dyadic_windows(windows: DataFrame, valid_from: str, valid_to: str, on: Sequence[str], tick: int = TICK_SECONDS,
                   broadcast_rows: int | None = DEFAULT_BROADCAST_ROWS, broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DyadicWindows:
    """Write, measure and cut the window side: an interval or two for each window. Windows that are empty or have no key drop out."""
    columns = windows.columns
    wanted = windows.filter(F.col(valid_from) < F.col(valid_to)).dropna(subset=list(on)) if on else windows.filter(F.col(valid_from) < F.col(valid_to))
    spans = wanted.withColumns({"__first": _ticks(F.col(valid_from), tick), "__end": _ticks(F.col(valid_to), tick, up=True)})
    spans = materialise(spans.withColumn("__level", _own_level(F.col("__end") - F.col("__first"))))
    asked = asked_levels(spans, on)
    level = F.col("__level")
    for own, top in asked.items():
        level = F.when(F.col("__level") == own, F.lit(top)).otherwise(level)
    spans = spans.withColumn("__level", level)
    cut = spans.select(*[F.col(c).alias(_W + c) for c in columns], "__level",
                       F.explode(dyadic_cover(F.col("__first"), F.col("__end"), F.col("__level"))).alias("__bucket"))
    text = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in cut.schema.fields if f.dataType.typeName() in ("string", "binary")]
    width = F.lit(32 + 16 * len(cut.columns))
    for t in text:
        width = width + t
    found = cut.agg(F.count(F.lit(1)).alias("n"), F.max(width).alias("w")).first()
    proven = broadcast_rows is not None and found["n"] <= broadcast_rows and found["n"] * (found["w"] or 0) <= broadcast_bytes
    return DyadicWindows(cut, tuple(sorted(set(asked.values()))), proven)


def range_join_dyadic(points: DataFrame, windows: DataFrame, at: str, valid_from: str, valid_to: str, on: Sequence[str] = (),
                      how: str = "left", tick: int = TICK_SECONDS, broadcast_rows: int | None = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """``range_join`` for windows of any mixture of lengths; open ends must be filled.

    Each window is one row or two, whatever its length, and each point asks once a level that some window uses, so
    one window of thirty years among half-hourly ones costs some rows more and neither a bucket size that
    suits it nor a row a half hour. A window's intervals are disjoint: a pair meets once. With one level a point
    is one row, and ``left`` is the join's own. With several, the points that met no window are those whose
    (keys, time) isn't among the pairs' (written once).
    """
    if how not in ("left", "inner"):
        raise ValueError("range_join_dyadic supports how='left' or 'inner'")
    on = list(on)
    payload = [c for c in windows.columns if c not in (*on, valid_from, valid_to)]
    if clash := set(payload) & set(points.columns):
        raise ValueError(f"window columns also on the point side: {sorted(clash)}")
    w = dyadic_windows(windows.select(*on, valid_from, valid_to, *payload), valid_from, valid_to, on, tick, broadcast_rows)
    mine = _ticks(F.col(at), tick)
    asked = F.array(*[F.struct(F.lit(level).alias("level"), F.shiftright(mine, STEP_BITS * level).alias("bucket")) for level in w.levels])
    asked = asked if w.levels else F.array().cast("array<struct<level:int,bucket:bigint>>")
    one = len(w.levels) == 1
    probes = points.withColumn("__probe", asked[0]) if one else points.select("*", F.explode(asked).alias("__probe"))
    side = F.broadcast(w.pieces) if w.broadcast else w.pieces.hint("merge")
    cond = [probes[k] == side[_W + k] for k in on]
    cond += [probes["__probe.level"] == side["__level"], probes["__probe.bucket"] == side["__bucket"],
             probes[at] >= side[_W + valid_from], probes[at] < side[_W + valid_to]]
    pairs = probes.join(side, cond, how if one else "inner").select(*[probes[c] for c in points.columns], *[side[_W + c].alias(c) for c in payload])
    if one or how == "inner":
        return pairs
    pairs = write_and_read(pairs, "pairs")
    met = pairs.select(*[F.col(c).alias(f"__m_{c}") for c in [*on, at]]).distinct()
    alone = points.join(met, [points[c] == met[f"__m_{c}"] for c in [*on, at]], "left_anti")
    return pairs.unionByName(alone, allowMissingColumns=True)


def asof_carried(points: DataFrame, windows: DataFrame, at: str, valid_from: str, valid_to: str, on: Sequence[str] = ()) -> DataFrame:
    """``asof_join`` without buckets, tails or salt; for windows of a key that don't overlap.

    Window starts and points are dealt into contiguous runs of (keys, time) by one range exchange, so
    a key of any size is as many runs as it needs, wherever its points lie. Within a run the last
    start is found by a running ``last``. A key that came over from earlier runs
    gets their last window: one row a run (its last key and that key's last window) is all that is looked at across runs.
    """
    on, own = list(on), "__asof_point"
    payload = [c for c in windows.columns if c not in (*on, valid_from, valid_to)]
    if clash := set(payload) & set(points.columns):
        raise ValueError(f"window columns also on the point side: {sorted(clash)}")
    key = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(on)], F.lit(0).alias("one")).alias("__key")
    starts = windows.where(F.col(valid_from) < F.col(valid_to)).select(
        key, F.col(valid_from).alias("__mark"), F.lit(0).alias("__kind"), F.lit(0).cast("long").alias("__spread"),
        F.struct(valid_from, valid_to, *payload).alias("__hit"))
    pts = points.select(key, F.col(at).alias("__mark"), F.lit(1).alias("__kind"), F.xxhash64(*points.columns).alias("__spread"),
                        F.struct(*points.columns).alias(own))
    both = pts.unionByName(starts, allowMissingColumns=True)
    order = ["__mark", "__kind", "__spread"]                          # equal times may be dealt to several runs: starts come first
    runs = write_and_read(both.repartitionByRange("__key", *order).withColumn("__run", F.spark_partition_id()), "asof-runs")
    inside = Window.partitionBy("__run", "__key").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    runs = runs.withColumn("__last", F.last("__hit", ignorenulls=True).over(inside))
    place = F.struct("__key", *order)
    ends = runs.groupBy("__run").agg(F.max_by(F.struct("__key", "__last"), place).alias("__end"))
    ends = ends.select("__run", F.col("__end.__key").alias("__key"), F.col("__end.__last").alias("__from"))
    # the runs that begin with a key get the last window of the runs that ended with it: two rows a run
    heads = runs.groupBy("__run").agg(F.min("__key").alias("__key"))
    chain = (heads.select("__run", "__key", F.lit(None).cast(runs.schema["__hit"].dataType).alias("__from"), F.lit(0).alias("__tail"))
             .unionByName(ends.withColumn("__tail", F.lit(1))))
    before = Window.partitionBy("__key").orderBy("__run", "__tail").rowsBetween(Window.unboundedPreceding, -1)
    carried = chain.withColumn("__carried", F.last("__from", ignorenulls=True).over(before)).where("__tail = 0").select(
        F.col("__run").alias("__r"), F.col("__key").alias("__k"), "__carried")
    carried = write_and_read(carried.where("__carried IS NOT NULL"), "asof-heads")
    found = runs.where("__kind = 1").join(F.broadcast(carried), (F.col("__run") == F.col("__r")) & F.col("__key").eqNullSafe(F.col("__k")), "left")
    hit = F.coalesce("__last", "__carried")
    hit = F.when((hit[valid_from] <= F.col("__mark")) & (F.col("__mark") < hit[valid_to]), hit)
    return found.select(f"{own}.*", *[hit[c].alias(c) for c in payload])
