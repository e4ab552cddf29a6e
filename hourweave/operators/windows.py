"""Lags, rolling statistics, sequences and gaps per entity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourweave.functions.timeutil import HOUR, KEY, hours
from hourweave.operators.ranking import daily, over_segments, own_rows, segments

LAGS = (1, 24, 168)
EPOCH = "1970-01-01 00:00:00"


def lag_features(
    df: DataFrame, value: str, lags: Sequence[int] = LAGS, key: str = KEY, ts: str = HOUR, segment_rows: int = 50_000
) -> DataFrame:
    """The value n rows earlier in the same entity, gaps or not."""
    return over_segments(
        df, [key], [ts], daily(ts), max(lags),
        lambda w: {f"{value}_lag_{n}": F.lag(value, n).over(w) for n in lags},
        segment_rows,
    )


def lag_features_calendar(
    df: DataFrame, value: str, lags: Sequence[int] = LAGS, key: str = KEY, ts: str = HOUR, step: Column | None = None
) -> DataFrame:
    """The value n hours earlier in the same entity, null if that hour is absent.

    Values are reduced to one per (key, hour) first, sent to the hours that look back at them and gathered there, for any
    number of lags at once. Rows are never collected: the gathered lags, one row per (key, hour), are joined back to them,
    where adaptive execution splits an hour with many rows over tasks. Rows that repeat (key, ts) all stay and get the
    same lags; a lag that meets several values takes the largest. Rows with a null key part have none. `step` replaces
    the hour as unit.
    """
    unit = step if step is not None else hours(1)
    names = {n: f"{value}_lag_{n}h" for n in lags}
    known = F.col(key).isNotNull() & F.col(ts).isNotNull()
    values = df.filter(known).groupBy(F.col(key).alias("_k"), F.col(ts).alias("_t")).agg(F.max(value).alias("_v"))
    sends = F.array(*[F.struct(F.lit(n).alias("_n"), F.col("_v").alias("_v")) for n in lags])
    sent = values.select("_k", "_t", F.inline(sends)).withColumn("_t", F.col("_t") + unit * F.col("_n"))
    gathered = sent.groupBy("_k", "_t").agg(*[F.max(F.when(F.col("_n") == n, F.col("_v"))).alias(name) for n, name in names.items()])
    return df.join(gathered, (F.col(key) == F.col("_k")) & (F.col(ts) == F.col("_t")), "left").drop("_k", "_t")


def rolling_stats(
    df: DataFrame,
    value: str,
    means: Sequence[int] = (168, 720),
    stds: Sequence[int] = (168,),
    key: str = KEY,
    ts: str = HOUR,
    segment_rows: int = 50_000,
) -> DataFrame:
    """Rolling mean and sample deviation over the last n rows, null until n values are there.

    Positions are cut into blocks of n. The last n rows are the block so far and the rest of the block before, so a window is
    a running sum from the front and one from the back, each built once per row. Nothing is subtracted: an outlier leaves
    no error behind once it is out of the window. Deviations are merged from means and squared distances to them.
    """
    sent, w = segments(df, [key], [ts], daily(ts), max([*means, *stds]) - 1, segment_rows)
    helpers, stats = [], {}
    for n in dict.fromkeys([*means, *stds]):
        block = F.floor(F.col("_pos") / n)
        sides = {"f": Window.partitionBy(key, "_seg", f"_b{n}").orderBy("_pos"), "b": Window.partitionBy(key, "_seg", f"_b{n}").orderBy(F.desc("_pos"))}
        made = {"n": F.count(value), "s": F.sum(value), "v": F.var_pop(value)}
        sent = sent.withColumn(f"_b{n}", block)
        for side, over in sides.items():
            running = over.rowsBetween(Window.unboundedPreceding, 0)
            sent = sent.withColumns({f"_{side}{name}{n}": made[name].over(running) for name in ("n", "s", "v") if name != "v" or n in stds})
        # a whole block has nothing before it
        whole = (F.col("_pos") + 1) % n == 0
        early = {name: F.when(~whole, F.lag(f"_b{name}{n}", n - 1).over(w)) for name in ("n", "s", "v") if name != "v" or n in stds}
        sent = sent.withColumns({f"_e{name}{n}": c for name, c in early.items()})
        count = F.col(f"_fn{n}") + F.coalesce(f"_en{n}", F.lit(0))
        total = F.coalesce(f"_fs{n}", F.lit(0.0)) + F.coalesce(f"_es{n}", F.lit(0.0))
        if n in means:
            stats[f"{value}_ma_{n}"] = F.when(count == n, total / n)
        if n in stds:
            a, b = F.col(f"_fn{n}"), F.coalesce(f"_en{n}", F.lit(0))
            apart = F.when((a > 0) & (b > 0), F.col(f"_fs{n}") / a - F.col(f"_es{n}") / b).otherwise(0.0)
            squares = F.coalesce(F.col(f"_fv{n}") * a, F.lit(0.0)) + F.coalesce(F.col(f"_ev{n}") * b, F.lit(0.0)) + apart * apart * a * b / n
            stats[f"{value}_std_{n}"] = F.when(count == n, F.sqrt(squares / F.nullif(F.lit(n - 1), F.lit(0))))
        helpers += [c for c in sent.columns if c.startswith("_") and c.endswith(str(n)) and c[1] in "bfe"]
    order = [f"{value}_ma_{n}" for n in means] + [f"{value}_std_{n}" for n in stds]
    return own_rows(sent.withColumns({name: stats[name] for name in order})).drop(*set(helpers))


def sequence_windows(
    df: DataFrame,
    value: str,
    history: int = 24,
    horizon: int = 1,
    key: str = KEY,
    ts: str = HOUR,
    segment_rows: int = 50_000,
) -> DataFrame:
    """(history values, next values) per entity; only runs without a missing hour or value.

    The hour of a row is the last hour of its horizon.
    """
    n = history + horizon
    framed = over_segments(
        df, [key], [ts], daily(ts), n - 1,
        lambda w: {
            "_first": F.lag(ts, n - 1).over(w),
            "_all": F.collect_list(value).over(w.rowsBetween(1 - n, 0)),
        },
        segment_rows,
    )
    complete = (F.col("_first") + hours(n - 1) == F.col(ts)) & (F.size("_all") == n)
    return framed.filter(complete).select(
        key, ts,
        F.slice("_all", 1, history).alias("history"),
        F.slice("_all", history + 1, horizon).alias("target"),
    )


def sequence_chunks(
    df: DataFrame, columns: Sequence[str], length: int, key: str = KEY, ts: str = HOUR,
) -> DataFrame:
    """Rows stored once for windows of up to `length` hours: (key, chunk, slots), a struct of `columns` per hour of a chunk.

    A chunk holds `length` hours, so a window ends in one chunk and reaches back into one more at most. Hours without a row are
    null. Of rows that repeat (key, hour) each column keeps its smallest value; rows with a null key part are left out. `ts` must lie on
    full hours. At most `length` slots meet in one array, whatever a key holds.
    """
    number = F.floor(F.timestamp_diff("SECOND", F.lit(EPOCH).cast("timestamp_ntz"), F.col(ts)) / 3600)
    hourly = df.where(F.col(key).isNotNull() & F.col(ts).isNotNull()).groupBy(F.col(key), number.alias("_hour")).agg(*[F.min(c).alias(c) for c in columns])
    slot = F.struct(F.pmod("_hour", F.lit(length)).cast("int").alias("slot"), F.struct(*columns).alias("values"))
    packed = hourly.groupBy(F.col(key), F.floor(F.col("_hour") / length).alias("chunk")).agg(F.collect_list(slot).alias("_held"))
    by_slot = F.map_from_entries("_held")
    return packed.select(key, "chunk", F.transform(F.sequence(F.lit(0), F.lit(length - 1)), lambda i: F.try_element_at(by_slot, i)).alias("slots"))


def sequence_index(chunks: DataFrame, history: int, horizon: int, past: Sequence[str], future: Sequence[str] = (), target: Sequence[str] = (), key: str = KEY) -> DataFrame:
    """Windows as (key, chunk, offset): where in its chunk the last hour of a window lies. No value is copied.

    A window is one only where each of its `history` hours has all `past` columns and each of its `horizon` hours all `future`
    and `target` columns.
    """
    return _window_ends(chunks, history, horizon, past, [*future, *target], key).select(key, "chunk", "offset")


def sequences(
    chunks: DataFrame, history: int, horizon: int, past: Sequence[str], future: Sequence[str] = (), target: Sequence[str] = (), key: str = KEY, ts: str = HOUR,
    index: DataFrame | None = None,
) -> DataFrame:
    """Encoder and decoder arrays per window: `<column>_history`, and `<column>_future` of what is known ahead or wanted.

    `chunks` of `history + horizon` hours or more. Each chunk is sent once more, to the one after it; windows are cut from the two
    where they are used, so that no shuffle holds a value more than twice. With `index`, as a sample of `sequence_index`, only
    those windows are read. The hour of a row is the last hour of its horizon. Columns of the future and the target must differ.
    """
    ends = _window_ends(chunks, history, horizon, past, [*future, *target], key, index)
    last = F.lit(EPOCH).cast("timestamp_ntz") + F.make_dt_interval(hours=(F.col("chunk") * F.col("_length") + F.col("offset")).cast("int"))
    window = F.slice("_slots", F.col("_length") + F.col("offset") + 2 - history - horizon, history + horizon)
    cut = ends.select(key, last.alias(ts), window.alias("_window"))
    early, late = F.slice("_window", 1, history), F.slice("_window", history + 1, horizon)
    pick = lambda part, c: F.transform(part, lambda s: s[c])
    return cut.select(key, ts, *[pick(early, c).alias(f"{c}_history") for c in past], *[pick(late, c).alias(f"{c}_future") for c in [*future, *target]])


def _window_ends(
    chunks: DataFrame, history: int, horizon: int, past: Sequence[str], ahead: Sequence[str], key: str, index: DataFrame | None = None,
) -> DataFrame:
    """(key, chunk, offset, _slots, _length) per window; `_slots` are those of the chunk before and of the chunk."""
    n = history + horizon
    earlier = chunks.select(F.col(key).alias("_k"), (F.col("chunk") + 1).alias("_c"), F.col("slots").alias("_before"))
    nothing = F.transform("slots", lambda s: F.when(F.lit(False), s))
    both = chunks.join(earlier, (F.col(key) == F.col("_k")) & (F.col("chunk") == F.col("_c")), "left").select(
        key, "chunk", F.size("slots").alias("_length"), F.concat(F.coalesce("_before", nothing), "slots").alias("_slots"))

    def runs(columns: Sequence[str]) -> Column:
        """Hours in a row that have all of `columns`, up to and with each slot; 0 before the first."""
        def complete(s: Column) -> Column:
            whole = s.isNotNull()
            for c in columns:
                whole = whole & s[c].isNotNull()
            return whole

        grow = lambda a, s: F.concat(a, F.array(F.when(complete(s), F.element_at(a, -1) + 1).otherwise(0)))
        return F.aggregate("_slots", F.array(F.lit(0)), grow)

    def whole_window(offset: Column) -> Column:
        at = F.col("_length") + offset + 1
        return (F.col("_ahead")[at] >= horizon) & (F.col("_past")[at - horizon] >= history)

    offsets = F.filter(F.sequence(F.lit(0), F.col("_length") - 1), whole_window)
    found = both.where(F.assert_true(F.col("_length") >= n, f"chunks of {n} hours or more wanted").isNull()).withColumns({"_past": runs(past), "_ahead": runs(ahead)})
    if index is not None:
        # at most one offset per hour of a chunk
        wanted = index.groupBy(F.col(key).alias("_k"), F.col("chunk").alias("_c")).agg(F.collect_set("offset").alias("_wanted"))
        found = found.join(wanted, (F.col(key) == F.col("_k")) & (F.col("chunk") == F.col("_c")))
        offsets = F.array_intersect(offsets, "_wanted")
    return found.select(key, "chunk", "_length", "_slots", F.explode(offsets).alias("offset"))


#: Bucket widths in seconds below the day, each inside the one before.
GRAINS = {"DAY": 86_400, "HOUR": 3_600, "MINUTE": 60, "SECOND": 1}


def gap_grain(df: DataFrame, key: Sequence[str] = (KEY,), ts: str = HOUR, most: int = 1_000_000) -> str:
    """The widest grain at which no (entity, bucket) holds more than `most` rows; seconds where none does."""
    for grain, width in GRAINS.items():
        largest = df.groupBy(*key, _bucket(ts, width).alias("_b")).count().agg(F.max("count")).first()[0]
        if largest is None or largest <= most:
            return grain
    return "SECOND"


def _bucket(ts: str, width: int) -> Column:
    return F.floor(F.timestamp_diff("SECOND", F.lit(EPOCH).cast("timestamp_ntz"), F.col(ts)) / width)


def time_gaps(df: DataFrame, key: Sequence[str] = (KEY,), ts: str = HOUR, grain: str = "DAY") -> DataFrame:
    """Each row's distance in seconds to the previous one of its entity (`gap_seconds`, null for the first).

    Works within days; the first row of a day continues from the last of the entity's
    previous day, which comes from a table with one row per entity and day. Feeds with many rows a day take a finer
    `grain`, as `gap_grain` finds it: hours then continue inside days, minutes inside hours, seconds inside minutes.
    """
    widths = list(GRAINS)[: list(GRAINS).index(grain) + 1]
    names = [f"_b{i}" for i in range(len(widths))]
    tagged = df.select(*key, ts, daily(ts).alias("_b0"), *[_bucket(ts, GRAINS[g]).alias(n) for g, n in zip(widths[1:], names[1:])])
    inside = Window.partitionBy(*key, *names).orderBy(ts)
    carry = None
    for i, name in enumerate(names):
        above = names[:i]
        lasts = tagged.groupBy(*key, *above, name).agg(F.max(ts).alias("_last"))
        # one row per bucket of an entity, or of the wider bucket around it
        across = Window.partitionBy(*key, *above).orderBy(name)
        here = lasts.select(*key, *above, name, F.lag("_last").over(across).alias("_carry"))
        if carry is not None:
            here = here.join(carry.withColumnRenamed("_carry", "_above"), [*key, *above]).withColumn("_carry", F.coalesce("_carry", "_above")).drop("_above")
        carry = here
    previous = F.coalesce(F.col("_in"), F.when(F.col("_rn") == 1, F.col("_carry")))
    return (
        tagged.withColumn("_in", F.lag(ts).over(inside))
        .withColumn("_rn", F.row_number().over(inside))
        .join(carry, [*key, *names])
        .withColumn("previous_ts", previous)
        .withColumn("gap_seconds", F.timestamp_diff("SECOND", F.col("previous_ts"), F.col(ts)))
        .select(*key, ts, "previous_ts", "gap_seconds")
    )


def time_gap_summary(gaps: DataFrame, by: Sequence[str] = (), step_seconds: int = 3600) -> DataFrame:
    """Steps of exactly one hour, longer ones, and the longest."""
    gap = F.col("gap_seconds")
    return gaps.groupBy(*by).agg(
        F.count_if(gap == step_seconds).alias("one_hour_steps"),
        F.count_if(gap > step_seconds).alias("longer_gaps"),
        F.max(gap).alias("longest_gap_seconds"),
    )


def first_gaps(gaps: DataFrame, k: int = 10, ts: str = HOUR, key: Sequence[str] = (KEY,), step_seconds: int = 3600) -> DataFrame:
    """The first k gaps in time."""
    return gaps.filter(F.col("gap_seconds") > step_seconds).orderBy(ts, *key).limit(k)


def global_hours(df: DataFrame, ts: str = HOUR) -> DataFrame:
    """Distinct hours, for gap checks over the whole table."""
    return df.select(ts).filter(F.col(ts).isNotNull()).distinct()
