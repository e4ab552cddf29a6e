"""Mixing sources to target weights by block quotas and a splitting tree.

1. Each source's rows fall into blocks by a hash of their id and size, about `BLOCK_ROWS` rows each: hash order is the
   random order of the source, and block k is its k-th stretch.
2. A source's target is its share by weight of the words asked for, at most `max_passes` times its size; what a capped
   source leaves is shared by the others by weight (the water level is found with two window sums over the sources).
3. The target becomes whole passes over all blocks, then whole blocks of one more pass, then rows of a last block, chosen
   largest first while they fit, with the best-fitting row on top where that comes nearer.
4. The blocks of all sources are partitioned among `shards` output shards of equal block counts by a binary tree: each
   node draws how many of each source's blocks go left from the multivariate hypergeometric distribution (one source
   after the other, by inverting the distribution function of the hypergeometric one), the rest goes right. Quotas add
   up exactly on every level. A shard takes the next blocks of its quota in the source's order, so shards are disjoint.
5. Inside a shard rows are ordered by a hash of row and pass: the shuffle is local.

Everything is DataFrame functions; randomness is hashes of `seed`, so reruns agree. What is joined back to the rows
is one row per source (its passes, whole blocks and shard limits) and the rows of the last blocks.

Sources are read as text and ordered by code point, null last; weights are given in that order. Defined results: rows
of size 0 (null, empty, white space) are taken zero words and never change a quota, and are in a mix as often as their
block is; rows repeated with id, source and size are drawn together; a source without words has target 0 and stays out;
an empty table gives none; columns of the input are kept and clashing names are avoided.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourweave.llm.common import col, fresh
from hourweave.session import materialise

BLOCK_ROWS = 512
SHARDS = 64
#: Sources times shards that are sent to all tasks as limits, about 8 bytes each; more are joined by a shuffle.
BROADCAST_LIMITS = 2_000_000
#: Blocks summed in one window; a source with more has its sums added up on two levels.
SUPER = 1024


def _uniform(*parts: Column) -> Column:
    """In (0, 1), from a hash."""
    return (F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") + 0.5) / F.lit(float(1 << 53))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is written and evaluated once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _log_factorial(n: Column) -> Column:
    """ln n!, by Stirling's series shifted by eight, with an error below 1e-12."""

    def of(x: Column) -> Column:
        series = 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * x * x * x * x * x)
        product = (x - 1) * (x - 2) * (x - 3) * (x - 4) * (x - 5) * (x - 6) * (x - 7) * (x - 8)
        return (x - 0.5) * F.log(x) - x + 0.5 * math.log(2 * math.pi) + series - F.log(product)

    return _let(n.cast("double") + 9.0, of)


def _hypergeometric(total: Column, marked: Column, drawn: Column, u: Column) -> Column:
    """How many of `marked` among `total` are in a sample of `drawn`: the smallest x whose distribution function reaches u.

    Terms are added over twelve standard deviations on both sides of the mean; what lies outside is under 1e-30.
    """
    of = F.struct(total.cast("long").alias("t"), marked.cast("long").alias("m"), drawn.cast("long").alias("d"), u.alias("u"))
    return _let(of, lambda v: _let(_support(v["t"], v["m"], v["d"]), lambda s: _inverse(v["t"], v["m"], v["d"], v["u"], s["low"], s["high"])))


def _support(total: Column, marked: Column, drawn: Column) -> Column:
    t, m, d = (x.cast("double") for x in (total, marked, drawn))
    mean = d * m / F.greatest(t, F.lit(1.0))

    def around(spread: Column) -> Column:
        low = F.greatest(F.lit(0).cast("long"), drawn + marked - total, F.floor(mean - spread)).cast("long")
        return F.struct(low.alias("low"), F.least(drawn, marked, F.ceil(mean + spread)).cast("long").alias("high"))

    return _let(12 * F.sqrt(F.greatest(mean * (1 - m / F.greatest(t, F.lit(1.0))), F.lit(0.0))) + 12, around)


def _inverse(total: Column, marked: Column, drawn: Column, u: Column, low: Column, high: Column) -> Column:
    first = F.exp(
        _log_factorial(marked) - _log_factorial(low) - _log_factorial(marked - low)
        + _log_factorial(total - marked) - _log_factorial(drawn - low) - _log_factorial(total - marked - drawn + low)
        - _log_factorial(total) + _log_factorial(drawn) + _log_factorial(total - drawn))
    start = F.struct(first.alias("p"), F.lit(0.0).alias("sum"), high.alias("x"), F.lit(False).alias("done"))

    def add(acc: Column, x: Column) -> Column:
        reached = acc["sum"] + acc["p"]
        here = ~acc["done"] & (reached >= u)
        ratio = (marked - x).cast("double") * (drawn - x) / ((x + 1).cast("double") * (total - marked - drawn + x + 1))
        return F.struct(
            F.when(x < high, acc["p"] * ratio).otherwise(F.lit(0.0)).alias("p"), reached.alias("sum"),
            F.when(here, x).otherwise(acc["x"]).alias("x"), (acc["done"] | here).alias("done"))

    return F.when(low >= high, low).otherwise(F.aggregate(F.sequence(low, F.greatest(low, high)), start, add, lambda acc: acc["x"]))


def targets(sizes: DataFrame, weights: Sequence[float], share: float = 1.0, max_passes: int = 3) -> DataFrame:
    """`source, rows, words` with `target`. Weights repeat over the sources in code point order, null last."""
    ordered = Window.orderBy(F.col("source").isNull(), F.col("source"))
    ranked = sizes.withColumn("rank", F.row_number().over(ordered) - 1)
    given = F.array(*[F.lit(float(w)) for w in weights])
    ranked = ranked.withColumn("weight", F.when(F.col("words") > 0, F.element_at(given, F.pmod("rank", F.lit(len(weights))).cast("int") + 1)).otherwise(0.0))
    ranked = ranked.withColumn("cap", (max_passes * F.col("words")).cast("double"))
    # sources reach their caps in the order of cap / weight; the level is what is left over the weight that is left
    filling = Window.orderBy(F.col("ratio").isNull(), "ratio", "rank")
    ranked = ranked.withColumn("ratio", F.when(F.col("weight") > 0, F.col("cap") / F.col("weight")))
    before = F.coalesce(F.sum(F.when(F.col("weight") > 0, F.col("cap"))).over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("weight").over(filling.rowsBetween(0, Window.unboundedFollowing))
    everything = Window.partitionBy()
    ranked = ranked.withColumn("level", F.when(F.col("weight") > 0, (share * F.sum("words").over(everything) - before) / left))
    ranked = ranked.withColumn("place", F.row_number().over(filling))
    # the first source that stays below its cap sets the level of all after it
    level = F.min(F.when(F.col("level") < F.col("ratio"), F.struct("place", "level"))).over(everything)["level"]
    target = F.when(F.col("weight") == 0, 0.0).otherwise(F.least(F.col("cap"), F.coalesce(level, F.lit(math.inf)) * F.col("weight")))
    return ranked.select("source", "rank", "rows", "words", target.alias("target"))


def _plan(slim: DataFrame, weights: Sequence[float], share: float, max_passes: int, block_rows: int) -> tuple[DataFrame, DataFrame, Column]:
    """Per source: `passes`, `blocks`, `whole` and the words still wanted from block `whole`; the rows with their block."""
    sizes = slim.groupBy("source").agg(F.count("*").alias("rows"), F.sum("size").alias("words"))
    aims = materialise(targets(sizes, weights, share, max_passes), "mix-targets")
    aims = aims.withColumns({
        "blocks": F.greatest(F.ceil(F.col("rows") / block_rows), F.lit(1)),
        "passes": F.when(F.col("words") > 0, F.least(F.lit(max_passes), F.floor(F.col("target") / F.col("words")))).otherwise(0).cast("int"),
    }).withColumn("rest", F.greatest(F.col("target") - F.col("passes") * F.col("words"), F.lit(0.0)))
    block = F.pmod("order", F.col("blocks")).cast("long")
    dealt = slim.join(F.broadcast(aims.select("source", "blocks")) if aims.count() <= BROADCAST_LIMITS else aims.select("source", "blocks"), aims["source"].eqNullSafe(slim["source"])).drop(aims["source"])
    dealt = dealt.withColumn("block", block).drop("blocks")
    summed = dealt.groupBy("source", "block").agg(F.sum("size").alias("words")).withColumn("super", F.floor(F.col("block") / SUPER))
    supers = summed.groupBy("source", "super").agg(F.sum("words").alias("words"))
    outer = supers.withColumn("outer", F.coalesce(F.sum("words").over(Window.partitionBy("source").orderBy("super").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("words")
    inner = F.sum("words").over(Window.partitionBy("source", "super").orderBy("block").rowsBetween(Window.unboundedPreceding, 0))
    running = summed.withColumn("inner", inner).alias("b").join(
        outer.alias("o"), F.col("b.source").eqNullSafe(F.col("o.source")) & (F.col("b.super") == F.col("o.super"))
    ).select("b.source", "block", (F.col("inner") + F.col("outer")).alias("end"), "words")
    met = running.alias("r").join(aims.alias("a"), F.col("r.source").eqNullSafe(F.col("a.source"))).where(F.col("end") > F.col("rest"))
    # the first block whose end lies beyond what is wanted
    last = met.groupBy(F.col("a.source").alias("source")).agg(F.min(F.struct("block", (F.col("end") - F.col("r.words")).alias("before"))).alias("m"))
    joined = aims.alias("a").join(last.alias("l"), F.col("a.source").eqNullSafe(F.col("l.source")), "left")
    plan = joined.select("a.*", F.coalesce("m.block", "blocks").alias("whole"), F.coalesce(F.col("rest") - F.col("m.before"), F.lit(0.0)).alias("wanted"))
    return materialise(plan, "mix-plan"), dealt


def _last_rows(dealt: DataFrame, plan: DataFrame) -> DataFrame:
    """`source, id, size` of the rows drawn from each source's last block, which holds about `block_rows` rows."""
    ends = plan.where("wanted > 0").select(F.col("source").alias("s"), "whole", "wanted")
    inside = dealt.join(F.broadcast(ends) if plan.count() <= BROADCAST_LIMITS else ends, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("whole")))
    items = inside.groupBy("s", "wanted", "order", "id", "size").agg(F.sum("size").alias("words")).where("words > 0")
    packed = items.groupBy("s", "wanted").agg(F.sort_array(F.collect_list(F.struct((-F.col("words")).alias("minus"), "order", "id", "size"))).alias("items"))
    nothing = F.struct(F.col("wanted").alias("left"), F.array().cast(packed.schema["items"].dataType).alias("taken"))

    def fit(acc: Column, item: Column) -> Column:
        fits = -item["minus"] <= acc["left"]
        return F.struct(F.when(fits, acc["left"] + item["minus"]).otherwise(acc["left"]).alias("left"), F.when(fits, F.array_append(acc["taken"], item)).otherwise(acc["taken"]).alias("taken"))

    filled = packed.withColumn("fit", F.aggregate("items", nothing, fit))
    over = F.array_except(F.col("items"), F.col("fit.taken"))
    # the smallest row left over overshoots least
    best = F.try_element_at(over, F.lit(-1))
    filled = filled.withColumn("best", best)
    nearer = F.coalesce(-F.col("best.minus") - F.col("fit.left") < F.col("fit.left"), F.lit(False))
    taken = F.when(nearer, F.array_append(F.col("fit.taken"), F.col("best"))).otherwise(F.col("fit.taken"))
    return filled.select("s", F.explode(taken).alias("t")).select("s", F.col("t.id").alias("i"), F.col("t.size").alias("z"), F.col("t.order").alias("o"))


def split_quotas(plan: DataFrame, shards: int, seed: int) -> DataFrame:
    """`source, limits`: the number of a source's blocks in the first 1, 2, ... shards, from `source, rank, quota`.

    One row per tree node holds the quotas of all sources; levels double the nodes.
    """
    nodes = plan.agg(F.sort_array(F.collect_list(F.struct("rank", "quota"))).alias("quotas")).where(F.size("quotas") > 0)
    nodes = nodes.select(F.lit(0).alias("from"), F.lit(shards).alias("to"), F.lit(1).cast("long").alias("node"), "quotas")
    total = F.aggregate("quotas", F.lit(0).cast("long"), lambda acc, q: acc + q["quota"])
    nodes = nodes.withColumn("grand", total)
    for _ in range(math.ceil(math.log2(shards)) if shards > 1 else 0):
        middle = F.floor((F.col("from") + F.col("to")) / 2).cast("int")
        wide = F.col("to") - F.col("from") > 1
        # shards get equal numbers of blocks; the first ones one more where it does not come out even
        ends = lambda k: F.floor(F.col("grand") * k / shards)
        room = F.when(wide, (ends(middle) - ends(F.col("from"))).cast("long")).otherwise(total)
        start = F.struct(room.alias("room"), total.alias("left"), F.array().cast(nodes.schema["quotas"].dataType).alias("got"))

        def draw(acc: Column, q: Column) -> Column:
            x = _hypergeometric(acc["left"], q["quota"], acc["room"], _uniform(F.lit(seed), F.col("node"), q["rank"]))
            return F.struct((acc["room"] - x).alias("room"), (acc["left"] - q["quota"]).alias("left"), F.array_append(acc["got"], F.struct(q["rank"].alias("rank"), x.alias("quota"))).alias("got"))

        drawn = nodes.withColumn("left", F.aggregate("quotas", start, draw, lambda acc: acc["got"]))
        right = F.zip_with("quotas", "left", lambda a, b: F.struct(a["rank"].alias("rank"), (a["quota"] - b["quota"]).alias("quota")))
        halves = F.array(
            F.struct(F.col("from"), F.when(wide, middle).otherwise(F.col("to")).alias("to"), (F.col("node") * 2).alias("node"), F.when(wide, F.col("left")).otherwise(F.col("quotas")).alias("quotas")),
            F.struct(F.when(wide, middle).otherwise(F.col("to")).alias("from"), F.col("to"), (F.col("node") * 2 + 1).alias("node"), right.alias("quotas")),
        )
        nodes = materialise(drawn.select("grand", F.inline(halves)).where(F.col("from") < F.col("to")).select("from", "to", "node", "quotas", "grand"), "mix-tree")
    leaves = nodes.select(F.col("from").alias("shard"), F.inline("quotas"))
    per_source = leaves.groupBy("rank").agg(F.sort_array(F.collect_list(F.struct("shard", "quota"))).alias("q"))
    zero = F.struct(F.lit(0).cast("long").alias("sum"), F.array().cast("array<bigint>").alias("limits"))
    add = lambda acc, q: F.struct((acc["sum"] + q["quota"]).alias("sum"), F.array_append(acc["limits"], acc["sum"] + q["quota"]).alias("limits"))
    return per_source.select("rank", F.aggregate("q", zero, add, lambda acc: acc["limits"]).alias("limits"))


def draw_mix(
    docs: DataFrame, size: Column, weights: Sequence[float], id_column: str = "doc_id", source: str = "source", share: float = 1.0,
    max_passes: int = 3, shards: int = SHARDS, block_rows: int = BLOCK_ROWS, seed: int = 11, prefix: str = "mix_", text: str | None = "text",
) -> DataFrame:
    """`docs` with `mix_size`, `mix_source_size`, `mix_target` and `mix_draws`, an array of (pass, shard, position).

    A row is in the mix once for each of its draws; `mix_rows` makes rows of them. Rows are told apart by id, size and `text`,
    where the table has it; rows that agree in all of them are drawn alike.
    """
    p = prefix
    names = {k: fresh(p + k, docs.columns) for k in ("size", "source_size", "target", "draws")}
    helper = fresh("row__order", docs.columns)
    text_id, text_source = col(id_column).cast("string"), col(source).cast("string")
    # ids may be null or repeated: the text tells rows apart too
    whole = [col(text).cast("string")] if text is not None and text.lower() in {c.lower() for c in docs.columns} else []
    order = F.xxhash64(F.lit(seed), text_id, size, *whole)
    slim = materialise(docs.select(text_id.alias("id"), text_source.alias("source"), size.cast("long").alias("size"), order.alias("order")), "mix-rows")
    plan, dealt = _plan(slim, weights, share, max_passes, block_rows)
    last = materialise(_last_rows(dealt, plan), "mix-last-rows")
    some = last.select("s", F.lit(1).alias("has_last")).distinct()
    quota = F.col("passes").cast("long") * F.col("blocks") + F.col("whole") * (F.col("rest") > 0).cast("long")
    plan = plan.withColumn("whole", F.when(F.col("rest") > 0, F.col("whole")).otherwise(0))
    quotas = plan.alias("p").join(some, F.col("p.source").eqNullSafe(F.col("s")), "left").select(
        "p.rank", (quota + F.coalesce("has_last", F.lit(0))).alias("quota"))
    limits = split_quotas(quotas.where("quota > 0"), shards, seed)
    per_source = materialise(plan.join(limits, "rank", "left").select(
        F.col("source").alias("of__source"), "words", "target", "blocks", "passes", "whole", "limits"), "mix-sources")
    small = per_source.count() * shards <= BROADCAST_LIMITS
    rows = docs.withColumn(helper, order).withColumn(names["size"], size.cast("long"))
    rows = rows.join(F.broadcast(per_source) if small else per_source, text_source.eqNullSafe(F.col("of__source")), "left")
    chosen = last.select(F.col("s").alias("last__source"), F.col("i").alias("last__id"), F.col("z").alias("last__size"), F.col("o").alias("last__order"), F.lit(True).alias("last__row"))
    same = text_id.eqNullSafe(F.col("last__id")) & text_source.eqNullSafe(F.col("last__source")) & (col(names["size"]) == F.col("last__size")) & (col(helper) == F.col("last__order"))
    rows = rows.join(F.broadcast(chosen) if chosen.count() <= BROADCAST_LIMITS else chosen, same, "left")
    block = F.pmod(col(helper), F.col("blocks")).cast("long")
    # pass k goes through the blocks from another one on, so that a shard's stretch is not the same stretch every time
    turn = lambda k: F.pmod(block + k * (F.floor(F.col("blocks") / 3) + 1), F.col("blocks"))
    whole = F.transform(F.slice(F.array(*[F.lit(k) for k in range(max_passes)]), 1, F.coalesce("passes", F.lit(0))), lambda k: F.struct(k.alias("pass"), (k * F.col("blocks") + turn(k)).alias("at")))
    extra = (block < F.col("whole")) | F.coalesce("last__row", F.lit(False))
    once_more = F.array(F.struct(F.col("passes").alias("pass"), (F.col("passes") * F.col("blocks") + F.least(block, F.col("whole"))).alias("at")))
    draws = F.when(F.coalesce(extra, F.lit(False)), F.concat(whole, once_more)).otherwise(whole)
    shard = lambda at: F.size(F.filter("limits", lambda x: x <= at))
    found = F.transform(draws, lambda d: F.struct(d["pass"].alias("pass"), shard(d["at"]).alias("shard"), F.xxhash64(F.lit(seed + 1), col(helper), d["pass"]).alias("position")))
    return rows.select(
        *[col(c) for c in docs.columns], col(names["size"]), F.coalesce("words", F.lit(0)).alias(names["source_size"]),
        F.coalesce("target", F.lit(0.0)).alias(names["target"]), found.alias(names["draws"]))


def mix_rows(docs: DataFrame, size: Column, weights: Sequence[float], shuffle: bool = False, **options) -> DataFrame:
    """The mixed corpus: the columns of `docs`, a row once for each draw; with `shuffle`, dealt to shards in their order."""
    drawn = draw_mix(docs, size, weights, **options)
    names = [c for c in drawn.columns if c not in docs.columns]
    draw = fresh("draw", docs.columns)
    rows = drawn.select(*[col(c) for c in docs.columns], F.explode(col(names[-1])).alias(draw))
    if shuffle:
        rows = rows.repartition(options.get("shards", SHARDS), F.col(f"{draw}.shard")).sortWithinPartitions(f"{draw}.shard", f"{draw}.position")
    return rows.drop(draw)
