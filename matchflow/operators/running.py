"""Running statistics over ordered groups, exact and safe for hot groups.

``running`` computes what an expanding or rolling window computes, one output row per input
row. A plain window sends each group to one task, which fails once a single group holds a large
part of the table. Here a group above ``rows_per_chunk`` rows is cut along its order column:

1. count the rows per group (map-side combined; only the keys are read);
2. for the groups above the limit, take quantiles of the order column as cut points;
3. run the ordinary window inside each (group, chunk);
4. summarise each chunk of a hot group to one row, prefix-sum those rows over the chunks that
   come before, and merge the result into the rows of the chunk.

If no group is above the limit, only step 1 and the ordinary window run. The two tables that are
broadcast hold at most one row per hot group and one row per chunk. A group is hot only above
``rows_per_chunk`` rows, so N input rows give fewer than N / rows_per_chunk hot groups and fewer
than 2 N / rows_per_chunk chunks: at most 100,000 short rows for 10^12 input rows at the default.

Cut points only decide where a group is cut, never a result, so their approximate quantiles
leave the statistics exact. Rows that share the leading order value stay in one chunk unless they
are themselves too many; then they are cut along the next order columns, down to plain copies of
one row. RANGE frames (``peers=True``) need them together; callers aggregate to one row per order
value first. Order columns after the first that are text are not cut along.

The same merge step takes a per-group ``initial`` state, which is how the streaming jobs carry
statistics from one micro-batch to the next.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window, WindowSpec

from matchflow.functions.columns import seconds_since
from matchflow.session import materialise

ROWS_PER_CHUNK = 20_000_000
ROWS_PER_CHUNK_CONF = "spark.matchflow.rowsPerChunk"
MAX_CHUNKS = 1 << 14  # of one group: 3 * 10^11 rows at the default size; chunks of larger groups grow
LEAST_GRID, LARGEST_GRID = 2000, 1 << 16  # quantiles that cut points are chosen from

CHUNK = "__chunk"
_CUTS = "__cuts"
_ALL = "__all"
_RANK = "__rank"
_TAIL = "__tail"
_INITIAL_TAIL = "__initial_tail"
_CARRY_TAIL = "__carry_tail"
_COPY = "__copy"
_HELPERS = (_CUTS, _COPY, _RANK, _TAIL, _INITIAL_TAIL, _CARRY_TAIL)


class Stat:
    """A running statistic: how to build its state, merge two states and read the result."""

    depth = 0  # number of preceding rows the statistic needs to see

    def __init__(self, value: Column | str):
        self.value = F.col(value) if isinstance(value, str) else value

    def state(self, v: Column, window: WindowSpec | None) -> Column:
        raise NotImplementedError

    def prefix(self, s: Column, first: Column, before: WindowSpec) -> Column:
        """State over the rows of ``before``; ``first`` is the state of the first chunk."""
        raise NotImplementedError

    def merge(self, a: Column, b: Column) -> Column:
        raise NotImplementedError

    def result(self, s: Column) -> Column:
        raise NotImplementedError


def _over(aggregate: Column, window: WindowSpec | None) -> Column:
    return aggregate if window is None else aggregate.over(window)


class Total(Stat):
    """Running sum."""

    def state(self, v, window):
        return F.struct(_over(F.sum(v), window).alias("s"))

    def prefix(self, s, first, before):
        return F.struct(F.sum(s["s"]).over(before).alias("s"))

    def merge(self, a, b):
        return F.struct(F.coalesce(a["s"] + b["s"], a["s"], b["s"]).alias("s"))

    def result(self, s):
        return s["s"]


class Count(Total):
    """Running count of the rows for which ``value`` is true (all rows by default)."""

    def __init__(self, value: Column | str | None = None):
        super().__init__(F.lit(True) if value is None else value)
        self.value = F.coalesce(self.value.cast("boolean"), F.lit(False)).cast("bigint")


class Low(Stat):
    """Running minimum."""

    def state(self, v, window):
        return F.struct(_over(F.min(v), window).alias("v"))

    def prefix(self, s, first, before):
        return F.struct(F.min(s["v"]).over(before).alias("v"))

    def merge(self, a, b):
        return F.struct(F.least(a["v"], b["v"]).alias("v"))

    def result(self, s):
        return s["v"]


class High(Low):
    """Running maximum."""

    def state(self, v, window):
        return F.struct(_over(F.max(v), window).alias("v"))

    def prefix(self, s, first, before):
        return F.struct(F.max(s["v"]).over(before).alias("v"))

    def merge(self, a, b):
        return F.struct(F.greatest(a["v"], b["v"]).alias("v"))


class Mean(Stat):
    """Running mean."""

    def state(self, v, window):
        v = v.cast("double")
        return F.struct(_over(F.count(v), window).alias("n"), _over(F.sum(v), window).alias("s"))

    def prefix(self, s, first, before):
        return F.struct(F.sum(s["n"]).over(before).alias("n"), F.sum(s["s"]).over(before).alias("s"))

    def merge(self, a, b):
        return F.struct(
            (F.coalesce(a["n"], F.lit(0)) + F.coalesce(b["n"], F.lit(0))).alias("n"),
            F.coalesce(a["s"] + b["s"], a["s"], b["s"]).alias("s"),
        )

    def result(self, s):
        return F.try_divide(s["s"], s["n"])


class Std(Stat):
    """Running standard deviation; ``ddof`` 1 for the sample form, 0 for the population form.

    The state is (count, mean, sum of squared deviations), merged with the pairwise update of
    Chan et al., so that no large sums of squares are subtracted from each other.
    """

    def __init__(self, value: Column | str, ddof: int = 1):
        super().__init__(value)
        self.ddof = ddof

    def state(self, v, window):
        v = v.cast("double")
        n = _over(F.count(v), window)
        return F.struct(
            n.alias("n"), _over(F.avg(v), window).alias("mean"), (_over(F.var_pop(v), window) * n).alias("m2")
        )

    def prefix(self, s, first, before):
        # deviations are taken from the first chunk's mean, so that only the spread between
        # chunks is squared and summed
        away = s["mean"] - first["mean"]
        n = F.sum(s["n"]).over(before)
        moved = F.sum(s["n"] * away).over(before)
        between = F.sum(s["n"] * away * away).over(before) - F.try_divide(moved * moved, n)
        return F.struct(
            n.alias("n"),
            (first["mean"] + F.try_divide(moved, n)).alias("mean"),
            (F.sum(s["m2"]).over(before) + F.greatest(between, F.lit(0.0))).alias("m2"),
        )

    def merge(self, a, b):
        na, nb = F.coalesce(a["n"], F.lit(0)), F.coalesce(b["n"], F.lit(0))
        delta = b["mean"] - a["mean"]
        both = (na > 0) & (nb > 0)
        mean = a["mean"] + delta * nb / (na + nb)
        m2 = a["m2"] + b["m2"] + delta * delta * na * nb / (na + nb)
        return F.struct(
            (na + nb).alias("n"),
            F.when(both, mean).otherwise(F.coalesce(a["mean"], b["mean"])).alias("mean"),
            F.when(both, m2).otherwise(F.coalesce(a["m2"], b["m2"])).alias("m2"),
        )

    def result(self, s):
        return F.when(s["n"] > self.ddof, F.sqrt(s["m2"] / (s["n"] - self.ddof)))


class Tail(Stat):
    """A statistic over the last rows only; it carries those rows instead of a summary."""

    def local(self, v: Column, ordered: WindowSpec, rank: Column, tail: Column | None) -> Column:
        raise NotImplementedError


class RollingMean(Tail):
    """Mean of the last ``size`` rows, fewer at the start of a group."""

    def __init__(self, value: Column | str, size: int):
        super().__init__(value)
        self.size = size
        self.depth = size - 1

    def local(self, v, ordered, rank, tail):
        v = v.cast("double")
        frame = ordered.rowsBetween(-(self.size - 1), Window.currentRow)
        total, n = F.coalesce(F.sum(v).over(frame), F.lit(0.0)), F.count(v).over(frame)
        if tail is None or self.size == 1:
            return F.try_divide(total, n)
        missing = F.lit(self.size) - rank
        reached = F.slice(tail, F.greatest(F.size(tail) - missing + 1, F.lit(1)), missing)
        reached = F.filter(reached, lambda x: x.isNotNull())
        use = (missing > 0) & tail.isNotNull()
        more = F.when(use, F.aggregate(reached, F.lit(0.0), lambda a, x: a + x.cast("double")))
        more_n = F.when(use, F.size(reached))
        return F.try_divide(total + F.coalesce(more, F.lit(0.0)), n + F.coalesce(more_n, F.lit(0)))


class Previous(Tail):
    """Value of the row before, null on the first row of a group."""

    depth = 1

    def local(self, v, ordered, rank, tail):
        lagged = F.lag(v).over(ordered)
        return lagged if tail is None else F.when(rank > 1, lagged).otherwise(F.try_element_at(tail, F.lit(-1)))


# --- cutting hot groups -------------------------------------------------------------------


def _axis(df: DataFrame, name: str) -> Column:
    """The leading order column as a double that never reverses the order."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.NumericType):
        return F.col(name).cast("double")
    if isinstance(dtype, T.DateType):
        return F.unix_date(name).cast("double")
    if isinstance(dtype, T.TimestampNTZType):
        return seconds_since(name, "1970-01-01")
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(name).cast("double")
    raise TypeError(f"order column {name} must be numeric, a date or a timestamp, not {dtype.simpleString()}")


def attach(df: DataFrame, other: DataFrame, keys: Sequence[str], bounded: bool = False) -> DataFrame:
    """Left join on null-safe keys; ``bounded`` marks a side whose size is proven small."""
    renamed = other.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys])
    return df.join(F.broadcast(renamed) if bounded else renamed, on, "left").drop(*[f"__r_{k}" for k in keys])


def rows_per_chunk(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(ROWS_PER_CHUNK_CONF, str(ROWS_PER_CHUNK)))


def _hot_groups(df: DataFrame, keys: Sequence[str], limit: int | None) -> DataFrame:
    rows = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
    return rows.filter(F.col("__rows") > (limit or rows_per_chunk(df)))


def has_hot_groups(df: DataFrame, keys: Sequence[str], limit: int | None = None) -> bool:
    """Whether some group has more rows than one task should sort. Reads only the keys."""
    return not _hot_groups(df, keys, limit).isEmpty()


def hot_cuts(
    profile: DataFrame, keys: Sequence[str], order: Sequence[str], limit: int | None = None
) -> DataFrame | None:
    """One row per group above ``limit`` rows: its keys and its ascending cut points.

    None if no group is that large. ``profile`` is the frame to be cut, or a cheaper one with the
    same key and order columns and at least its rows. The cut points are written out, because
    approximate quantiles may come out differently when a plan is run again, and every branch
    of the plan must cut at the same points.
    """
    keys, limit = list(keys), limit or rows_per_chunk(profile)
    axis = profile.select(*keys, _axis(profile, order[0]).alias("__axis"))
    hot = _hot_groups(axis, keys, limit)
    if hot.isEmpty():
        return None
    largest = hot.agg(F.max("__rows")).first()[0]
    grid_size = max(LEAST_GRID, min(LARGEST_GRID, 4 * -(-largest // limit)))
    shares = ",".join(repr(i / grid_size) for i in range(1, grid_size))
    grid = F.split(F.lit(shares), ",").cast("array<double>")
    quantiles = (
        attach(axis, hot, keys, bounded=True)
        .filter(F.col("__rows").isNotNull())
        .groupBy(*keys)
        .agg(
            F.percentile_approx("__axis", grid, 10 * grid_size).alias("__grid"),
            F.first("__rows").alias("__rows"),
        )
    )
    chunks = F.least(F.lit(MAX_CHUNKS), F.ceil(F.col("__rows") / F.lit(limit))).cast("int")
    step = F.lit(grid_size) / chunks
    cuts = F.transform(
        F.sequence(F.lit(1), chunks - 1), lambda i: F.get(F.col("__grid"), F.floor(i * step).cast("int") - 1)
    )
    return materialise(quantiles.filter(F.col("__grid").isNotNull()).select(*keys, cuts.alias(_CUTS)), "cuts")


def _numbered(df: DataFrame, keys: Sequence[str], column: str, cuts: DataFrame, cuts_as: str, chunk_as: str) -> DataFrame:
    """Add the cut points of each row's group and the number of them below the row."""
    out = attach(df, cuts.withColumnRenamed(_CUTS, cuts_as), keys, bounded=True)
    axis = _axis(df, column)
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(MAX_CHUNKS.bit_length()))])

    def search(at: Column, step: Column) -> Column:  # binary search
        return at + F.when(F.get(F.col(cuts_as), at + step - 1) < axis, step).otherwise(F.lit(0))

    return out.withColumn(chunk_as, F.when(F.col(cuts_as).isNotNull(), F.aggregate(steps, F.lit(0), search)))


def _splittable(df: DataFrame, column: str) -> bool:
    dtype = df.schema[column].dataType
    if isinstance(dtype, T.DecimalType):
        return dtype.precision <= 15
    return isinstance(dtype, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType))


def cut(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    cuts: DataFrame | None,
    limit: int | None = None,
    split_ties: bool = True,
) -> DataFrame:
    """Number the chunks of hot groups: 0.. in those, null in all others.

    Without hot groups ``df`` comes back as it is. Rows that share the leading order value end up
    in one chunk. If those are too many for a chunk, they are cut again along the next order
    column, and copies that agree in all order columns along an arbitrary but fixed number, which
    is then the last order column. A value with that many rows is always a cut point itself, so
    its rows are the last ones of their chunk and can be numbered on without disturbing others.
    """
    if cuts is None:
        return df
    out = _numbered(df, keys, order[0], cuts, _CUTS, CHUNK)
    if not split_ties:
        return out
    out = out.withColumn(CHUNK, F.col(CHUNK).cast("bigint"))
    tied_keys, level_cuts = list(keys), _CUTS
    for at, after in zip(order, [*order[1:], _COPY]):
        axis = _axis(out, at)
        tied_keys.append(at)
        tied = out.filter(F.array_contains(level_cuts, axis) & (F.abs(axis) < 2**53))
        if after != _COPY and not _splittable(df, after):
            break
        if not has_hot_groups(tied, tied_keys, limit):
            break
        if after == _COPY:  # written out, so that every copy keeps its number
            out = materialise(out.withColumn(_COPY, F.monotonically_increasing_id()), "copies")
            tied = out.filter(F.array_contains(level_cuts, axis) & (F.abs(axis) < 2**53))
        next_cuts = f"{_CUTS}_{after}"
        fine = hot_cuts(tied, tied_keys, [after], limit)
        out = _numbered(out, tied_keys, after, fine, next_cuts, "__fine")
        # chunks of tied rows come after the other rows of the coarse chunk
        number = F.col(CHUNK) * (2 * MAX_CHUNKS) + F.coalesce(F.col("__fine") + 1, F.lit(0))
        out = out.withColumn(CHUNK, number).drop("__fine")
        level_cuts = next_cuts
    return out.drop(*[c for c in out.columns if c.startswith(f"{_CUTS}_")])


# --- states -------------------------------------------------------------------------------


def _depth(stats: dict[str, Stat]) -> int:
    return max((s.depth for s in stats.values()), default=0)


def _valued(df: DataFrame, stats: dict[str, Stat]) -> DataFrame:
    return df.withColumns({f"__v{i}": s.value for i, s in enumerate(stats.values())})


def _group_state(df: DataFrame, by: Sequence[str], order: Sequence[str], stats: dict[str, Stat]) -> DataFrame:
    """One row per group: the state of every statistic and the last rows, oldest first.

    The summaries combine map-side. The last rows come from a row-number limit, which Spark
    applies per task before the shuffle, so a hot group moves ``depth`` rows per task.
    """
    sums = [s.state(F.col(f"__v{i}"), None).alias(f"__s{i}") for i, s in enumerate(stats.values()) if not s.depth]
    state = df.groupBy(*by).agg(*sums) if sums else None
    depth = _depth(stats)
    if depth:
        last = Window.partitionBy(*by).orderBy(*[F.col(o).desc() for o in order])
        values = [F.col(f"__v{i}").alias(f"v{i}") for i, s in enumerate(stats.values()) if s.depth]
        tails = (
            df.withColumn("__back", F.row_number().over(last))
            .filter(F.col("__back") <= depth)
            .groupBy(*by)
            .agg(F.sort_array(F.collect_list(F.struct((-F.col("__back")).alias("rank"), *values))).alias(_TAIL))
        )
        state = tails if state is None else attach(state, tails, by)
    return state


def _last(tail: Column, depth: int) -> Column:
    return F.slice(tail, F.greatest(F.size(tail) - depth + 1, F.lit(1)), depth)


def _joined(old: Column, new: Column, depth: int) -> Column:
    """The last rows of two runs of rows, either of which may be missing."""
    return F.coalesce(_last(F.concat(old, new), depth), new, old)


def _carry(hot: DataFrame, keys: Sequence[str], order: Sequence[str], stats: dict[str, Stat]) -> DataFrame:
    """State before each chunk of the hot groups: one row per chunk."""
    chunks = _group_state(hot, [*keys, CHUNK], order, stats)
    by_chunk = Window.partitionBy(*keys).orderBy(CHUNK)
    before = by_chunk.rowsBetween(Window.unboundedPreceding, -1)
    summed = [(i, s) for i, s in enumerate(stats.values()) if not s.depth]
    chunks = chunks.withColumns({f"__f{i}": F.first(f"__s{i}").over(by_chunk) for i, _ in summed})
    out = [s.prefix(F.col(f"__s{i}"), F.col(f"__f{i}"), before).alias(f"__c{i}") for i, s in summed]
    depth = _depth(stats)
    if depth:  # every chunk holds a row, so the last `depth` chunks hold the last `depth` rows
        near = F.flatten(F.collect_list(_TAIL).over(by_chunk.rowsBetween(-depth, -1)))
        out.append(_last(near, depth).alias(_CARRY_TAIL))
    return chunks.select(*keys, CHUNK, *out)


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    stats: dict[str, Stat],
    *,
    peers: bool = False,
    initial: DataFrame | None = None,
    profile: DataFrame | None = None,
    limit: int | None = None,
    already_cut: bool = False,
    keep_chunks: bool = False,
) -> DataFrame:
    """Add one column per entry of ``stats``, each computed over the rows up to the current one.

    Rows that agree in all ``order`` columns come in an arbitrary order; with ``peers`` all
    rows that share the (single) order value see the same result. No ``keys`` means one group
    over the whole table. ``initial`` is a state from ``advance``.

    Two calls over the same keys and order share one shuffle and one sort: ``cut`` the frame,
    run the first call with ``keep_chunks`` and both with ``already_cut``.
    """
    columns = [c for c in df.columns if c not in (CHUNK, *_HELPERS)]
    if not keys:
        keys, df = [_ALL], df.withColumn(_ALL, F.lit(0))
        profile = None if profile is None else profile.withColumn(_ALL, F.lit(0))
    keys = list(keys)
    if not already_cut:
        cuts = hot_cuts(df if profile is None else profile, keys, order, limit)
        df = cut(df, keys, order, cuts, limit, split_ties=not peers)
    hot = CHUNK in df.columns
    if _COPY in df.columns:
        order = [*order, _COPY]
    base = _valued(df, stats)
    depth = _depth(stats)

    ordered = Window.partitionBy(*keys, *([CHUNK] if hot else [])).orderBy(*order)
    if peers:
        upto = ordered.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    else:
        upto = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = {f"__s{i}": s.state(F.col(f"__v{i}"), upto) for i, s in enumerate(stats.values()) if not s.depth}
    if depth:
        local[_RANK] = F.row_number().over(ordered)
    out = base.withColumns(local)
    if hot:
        carry = _carry(base.filter(F.col(_CUTS).isNotNull()), keys, order, stats)
        out = attach(out, carry, [*keys, CHUNK], bounded=True)
    if initial is not None:
        names = {f"__s{i}": f"__i{i}" for i, s in enumerate(stats.values()) if not s.depth}
        out = attach(out, initial.withColumnsRenamed({**names, _TAIL: _INITIAL_TAIL}), keys)

    tail = F.col(_CARRY_TAIL) if hot else None
    if initial is not None:
        tail = _joined(F.col(_INITIAL_TAIL), tail, depth) if hot else F.col(_INITIAL_TAIL)
    results = {}
    for i, (name, stat) in enumerate(stats.items()):
        if stat.depth:
            before = None if tail is None else tail[f"v{i}"]
            results[name] = stat.local(F.col(f"__v{i}"), ordered, F.col(_RANK), before)
            continue
        state = F.col(f"__s{i}")
        if hot:
            state = stat.merge(F.col(f"__c{i}"), state)
        if initial is not None:
            state = stat.merge(F.col(f"__i{i}"), state)
        results[name] = stat.result(state)
    keep = [c for c in columns if c not in results and c != _ALL]
    kept = [c for c in (CHUNK, _CUTS, _COPY) if c in df.columns] if keep_chunks else []
    return out.select(*keep, *[c.alias(n) for n, c in results.items()], *kept)


def advance(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    stats: dict[str, Stat],
    initial: DataFrame | None = None,
) -> DataFrame:
    """Per-group state after ``df``, to be passed as ``initial`` for the rows that follow."""
    fresh = _group_state(_valued(df, stats), keys, order, stats)
    if initial is None:
        return fresh
    names = [f"__s{i}" for i, s in enumerate(stats.values()) if not s.depth]
    depth = _depth(stats)
    tails = [_TAIL] if depth else []
    old = initial.select(*[F.col(k).alias(f"__r_{k}") for k in keys], *[F.col(n).alias(f"__old{n}") for n in names + tails])
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys])
    both = fresh.join(old, on, "full")
    out = [F.coalesce(F.col(k), F.col(f"__r_{k}")).alias(k) for k in keys]
    for i, stat in enumerate(stats.values()):
        if not stat.depth:
            out.append(stat.merge(F.col(f"__old__s{i}"), F.col(f"__s{i}")).alias(f"__s{i}"))
    if depth:
        out.append(_joined(F.col(f"__old{_TAIL}"), F.col(_TAIL), depth).alias(_TAIL))
    return both.select(*out)
