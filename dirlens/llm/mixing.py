"""Mixing sources to target weights along a time-varying curriculum, in DataFrame functions alone.

1. *Integrate*: a schedule gives each source a weight on every segment of training time [0, 1].
   Weights become shares within a segment; their integral is the source's cumulative demand curve
   and, at time 1, its effective weight. The word total of all documents is shared by effective
   weight. A target stops at ``max_epochs`` times its source's size and the excess is reshared
   among the others by weight until none is above, in closed form over the sources in order of
   size per weight.
2. *Take*: documents of a source stand in a fixed pseudo-random order. A target takes whole epochs
   and then a last part of one: hash buckets of about ``BUCKET`` documents are taken in order while
   they fit, and the one bucket that would overshoot is filled document by document, largest first.
   Sums run within buckets and then over buckets, so a source with a third of all rows is spread
   over many tasks.
3. *Invert*: each copy's offset in its source's word stream is looked up on the inverse of the
   demand curve, which gives its training position in [0, 1). Documents are range-sorted by it.

Defined results: a null text has size 0; a null source is a source of its own, after all others.
Sizes of 0 are taken along with their bucket, but not carried on to, and add nothing. A source with no words has target 0.
Rows with repeated or null ids are documents of their own. Equal input gives equal output whatever
its partitioning. A very long text is counted whole, and taken whole or not at all. Other columns,
whatever their names, stay as they came. Empty input gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import cut
from .common import carried, n_words, own_columns

BUCKET = 1024
MAX_EPOCHS = 3
#: Weights of the sources in order, repeated.
CYCLE = (1, 2, 3)


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    # the text is part of the order, so rows that share an id, or have none, spread over the buckets
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size"),
                       F.md5(F.coalesce(F.col(text_col), F.lit(""))).alias("text"))
    name = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("size").cast("string"), F.col("text"))
    return base.withColumn("h", F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("long")).drop("text")


def _demand(sources: DataFrame, schedule: DataFrame | None, cycle: Sequence[float]) -> DataFrame:
    """Adds weight (effective), starts and cums: the demand curve's corners, time and share."""
    if schedule is None:
        pick = F.element_at(F.array(*[F.lit(float(w)) for w in cycle]),
                            (F.pmod(F.col("rank") - 1, F.lit(len(cycle))) + 1).cast("int"))
        return sources.select("*", pick.alias("weight"), F.array(F.lit(0.0), F.lit(1.0)).alias("starts"),
                              F.array(F.lit(0.0), F.lit(1.0)).alias("cums"))
    # a row for each source and segment: the segments of the schedule, a small parameter, as an array
    grid = schedule.select("start").distinct()
    segments = grid.withColumn("stop", F.coalesce(F.lead("start").over(Window.orderBy("start")), F.lit(1.0)))
    given = schedule.groupBy(F.col("source").alias("__s"), F.col("start").alias("__t")).agg(
        F.max(F.col("weight").cast("double")).alias("w"))
    line = segments.agg(F.collect_list(F.struct("start", "stop"))).scalar()
    cells = (sources.select("rank", "source", F.inline(line))
             .join(given, F.col("source").eqNullSafe(F.col("__s")) & (F.col("start") == F.col("__t")), "left")
             .select("rank", "start", "stop", F.coalesce("w", F.lit(0.0)).alias("w")))
    whole = F.sum("w").over(Window.partitionBy("start"))
    first = F.max(F.when(F.col("start") == F.col("t0"), F.col("seg")))
    cells = cells.withColumn("seg", whole).withColumn("t0", F.min("start").over(Window.partitionBy("rank")))
    scale = cells.agg(first).scalar()
    cells = cells.withColumn(
        "part", F.when(F.col("seg") > 0, F.col("w") * scale / F.col("seg") * (F.col("stop") - F.col("start")))
        .otherwise(0.0))
    run = F.sum("part").over(Window.partitionBy("rank").orderBy("start"))
    corners = (cells.withColumn("run", run).groupBy("rank")
               .agg(F.sum("part").alias("weight"),
                    F.sort_array(F.collect_list(F.struct("stop", "run"))).alias("at")))
    share = F.transform("at", lambda x: F.when(F.col("weight") > 0, x["run"] / F.col("weight")).otherwise(x["stop"]))
    corners = corners.select("rank", "weight", F.concat(F.array(F.lit(0.0)), F.col("at.stop")).alias("starts"),
                             F.concat(F.array(F.lit(0.0)), share).alias("cums"))
    return sources.join(corners, "rank")


def targets(sized: DataFrame, schedule: DataFrame | None = None, cycle: Sequence[float] = CYCLE,
            max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: source, rank, source_size, docs, weight, target, starts, cums. The windows
    here run over one row per source."""
    sources = (sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
               .withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))))
    d = _demand(sources, schedule, cycle).withColumn("top", F.col("source_size") * F.lit(max_epochs))
    ratio = F.when(F.col("weight") > 0, F.col("top") / F.col("weight")).otherwise(F.lit(float("inf")))
    up = Window.orderBy("ratio", "rank").rowsBetween(Window.unboundedPreceding, -1)
    on = Window.orderBy("ratio", "rank").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy()
    d = (d.withColumn("ratio", ratio).withColumn("total", F.sum("source_size").over(every))
         .withColumn("below", F.coalesce(F.sum("top").over(up), F.lit(0)))
         .withColumn("ahead", F.sum("weight").over(on)))
    d = d.withColumn("full", (F.col("weight") > 0)
                     & ((F.col("total") - F.col("below")) * F.col("weight") >= F.col("top") * F.col("ahead")))
    d = (d.withColumn("spent", F.sum(F.when(F.col("full"), F.col("top")).otherwise(0)).over(every))
         .withColumn("open", F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("weight"))).over(every)))
    target = (F.when(F.col("full"), F.col("top").cast("double"))
              .when(F.col("open") > 0, (F.col("total") - F.col("spent")) * F.col("weight") / F.col("open"))
              .otherwise(0.0))
    return d.select("source", "rank", "source_size", "docs", "weight", target.alias("target"), "starts", "cums")


def _fill(items: Column, room: Column) -> Column:
    """Flags, in the items' order, of a greedy fill of ``room`` words."""
    start = F.struct(room.alias("room"), F.array().cast("array<boolean>").alias("took"))

    def step(acc, x):
        fits = x["size"] <= acc["room"]
        return F.struct(F.when(fits, acc["room"] - x["size"]).otherwise(acc["room"]).alias("room"),
                        F.concat(acc["took"], F.array(fits)).alias("took"))
    return F.aggregate(items, start, step, lambda acc: acc["took"])


def _carry(first: DataFrame, plan: DataFrame) -> DataFrame:
    """``first`` (rank, bucket, h, doc_id, size, offset, took) with what else fits taken too, and ``last``:
    the offset in the last part of an epoch. In a source, offset and size tell rows with words apart."""
    def left(room, taken):
        used = taken.groupBy("rank").agg(F.sum("size").alias("used"))
        return cut(room.join(used, "rank", "left")
                   .select("rank", "part", (F.col("room") - F.coalesce("used", F.lit(0))).alias("room")))

    room = left(plan.select("rank", "part", F.col("part").alias("room")), first.where("took"))
    rest, found = first.where("NOT took AND size > 0").drop("took"), None
    fields = ["rank", "bucket", "h", "doc_id", "size", "offset"]
    while True:
        near = cut(rest.join(room, "rank").where("size <= room"))
        if near.isEmpty():
            break
        order = Window.partitionBy("rank", "bucket").orderBy("h", "doc_id", "offset").rowsBetween(
            Window.unboundedPreceding, Window.currentRow)
        rows = near.withColumn("within", F.sum("size").over(order) - F.col("size"))
        sums = near.groupBy("rank", "bucket", "room").agg(F.sum("size").alias("words"))
        run = F.sum("words").over(Window.partitionBy("rank").orderBy("bucket"))
        sums = (sums.withColumn("before", run - F.col("words"))
                .withColumn("whole", F.col("before") + F.col("words") <= F.col("room"))
                .withColumn("split", ~F.col("whole") & (F.col("before") < F.col("room")))
                .select("rank", "bucket", "before", "whole", "split"))
        rows = (rows.join(sums, ["rank", "bucket"])
                .withColumn("base", F.col("part") - F.col("room") + F.col("before")))
        easy = rows.where("NOT split").select(*fields, (F.col("base") + F.col("within")).alias("last"),
                                              F.col("whole").alias("took"))
        item = F.struct((-F.col("size")).alias("less"), "h", "doc_id", "offset", "size", "base")
        open_ = (F.col("room") - F.col("before")).alias("open")
        hard = (rows.where("split").groupBy("rank", "bucket", open_).agg(F.sort_array(F.collect_list(item)).alias("items"))
                .withColumn("flags", _fill(F.col("items"), F.col("open")))
                .select("rank", "bucket", F.posexplode(F.arrays_zip("items", "flags")).alias("at", "x"))
                .select("rank", "bucket", "at", "x.items.*", F.col("x.flags").alias("took")))
        size = F.when(F.col("took"), F.col("size")).otherwise(0)
        so_far = F.sum(size).over(Window.partitionBy("rank", "bucket").orderBy("at")) - size
        hard = hard.withColumn("last", F.col("base") + so_far).select(*fields, "last", "took")
        more = cut(easy.union(hard))
        took = more.where("took")
        room = left(room, took)
        rest = more.where("NOT took").select(*fields)
        found = took if found is None else found.union(took)
    if found is None:
        return first.withColumn("last", F.col("offset"))
    return (first.join(found.select("rank", "offset", "size", "last"), ["rank", "offset", "size"], "left")
            .withColumn("took", F.col("took") | F.col("last").isNotNull())
            .withColumn("last", F.coalesce("last", "offset")))


def _time(share: Column) -> Column:
    """The demand curve's inverse at ``share``."""
    k = F.least(F.size(F.filter("cums", lambda c: c <= share)), F.size("cums") - 1)
    t0, t1 = F.element_at("starts", k), F.element_at("starts", k + 1)
    c0, c1 = F.element_at("cums", k), F.element_at("cums", k + 1)
    return F.when(c1 > c0, t0 + (share - c0) / (c1 - c0) * (t1 - t0)).otherwise(t0)


def mix(docs: DataFrame, schedule: DataFrame | None = None, cycle: Sequence[float] = CYCLE,
        max_epochs: int = MAX_EPOCHS, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source") -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, copies, positions.

    ``schedule`` has rows (source, start, weight): from time ``start`` to the next start the source
    has this weight (0 where it has no row). Without one the sources, by code point with null last,
    hold the weights of ``cycle`` throughout."""
    sized = cut(_sized(docs, id_col, text_col, source_col))
    plan = cut(targets(sized, schedule, cycle, max_epochs))
    whole = F.floor(F.col("target") + 0.5).cast("long")
    plan = (plan.withColumn("goal", whole)
            .withColumn("epochs", F.when(F.col("source_size") > 0, F.expr("goal div source_size")).otherwise(0))
            .withColumn("part", F.col("goal") - F.col("epochs") * F.col("source_size"))
            .withColumn("buckets", F.ceil(F.col("docs") / F.lit(BUCKET)).cast("long")))

    key = plan.select(F.col("source").alias("__source"), "rank", "buckets")
    rows = (sized.join(key, sized["source"].eqNullSafe(key["__source"]))
            .withColumn("bucket", F.shiftrightunsigned(F.col("h") * F.col("buckets"), 32))
            .select("rank", "bucket", "h", "doc_id", "size"))
    order = Window.partitionBy("rank", "bucket").orderBy("h", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("within", F.sum("size").over(order) - F.col("size"))
    sums = rows.groupBy("rank", "bucket").agg(F.sum("size").alias("words"))
    sums = sums.withColumn("before", F.sum("words").over(Window.partitionBy("rank").orderBy("bucket")) - F.col("words"))
    sums = (sums.join(plan.select("rank", "part"), "rank")
            .withColumn("took", F.col("before") + F.col("words") <= F.col("part"))
            .withColumn("split", ~F.col("took") & (F.col("before") < F.col("part")))
            .select("rank", "bucket", "before", "took", "split", (F.col("part") - F.col("before")).alias("room")))
    rows = rows.join(sums, ["rank", "bucket"])
    fields = ["rank", "bucket", "h", "doc_id", "size", (F.col("before") + F.col("within")).alias("offset")]
    easy = rows.where("NOT split").select(*fields, "took")
    late = 4 * (F.col("within") + F.col("size")) > 3 * F.col("room")
    item = F.struct(late.alias("late"), F.when(late, -F.col("size")).otherwise(0).alias("less"),
                    "h", "doc_id", "size", "within", "before")
    hard = (rows.where("split").groupBy("rank", "bucket", "room").agg(F.sort_array(F.collect_list(item)).alias("items"))
            .withColumn("flags", _fill(F.col("items"), F.col("room")))
            .select("rank", "bucket", F.explode(F.arrays_zip("items", "flags")).alias("x"))
            .select("rank", "bucket", "x.items.*", F.col("x.flags").alias("took"))
            .select(*fields, "took"))
    done = _carry(cut(easy.union(hard)), plan).join(plan.drop("docs", "weight", "buckets", "part", "source"), "rank")
    copies = (F.col("epochs") + F.col("took").cast("long")).cast("int")

    def place(c):
        offset = F.when(c < F.col("epochs"), F.col("offset")).otherwise(F.col("last"))
        at = (c.cast("long") * F.col("source_size") + offset) / F.greatest("goal", F.lit(1))
        return _time(F.least(at, F.lit(1.0)))
    done = done.withColumn("copies", copies).withColumn(
        "positions", F.when(F.col("copies") > 0, F.transform(F.sequence(F.lit(0), F.col("copies") - 1), place))
        .otherwise(F.array().cast("array<double>")))
    return done.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"),
                       "copies", "positions").orderBy(F.try_element_at("positions", F.lit(1)).asc_nulls_last(), "doc_id")


def training_order(docs: DataFrame, schedule: DataFrame | None = None, cycle: Sequence[float] = CYCLE,
                   max_epochs: int = MAX_EPOCHS, id_col: str = "doc_id", text_col: str = "text",
                   source_col: str = "source") -> DataFrame:
    """The mix itself: a row for each copy taken, with the document's own columns, range-sorted by
    training position."""
    plan = (mix(docs, schedule, cycle, max_epochs, id_col, text_col, source_col).where("copies > 0")
            .groupBy(F.col("doc_id").alias("plan_id"), F.col("size").alias("words"))
            .agg(F.sort_array(F.collect_list("positions")).alias("lists")))
    rows = carried(docs, F.col(id_col).alias("id"), n_words(F.col(text_col)).alias("size"))
    twin = Window.partitionBy("id", "size").orderBy(F.col("own").getField(text_col).asc_nulls_first())
    rows = rows.withColumn("twin", F.row_number().over(twin))
    rows = rows.join(plan, F.col("id").eqNullSafe(F.col("plan_id")) & (F.col("size") == F.col("words")))
    return own_columns(rows.select("own", F.explode(F.try_element_at("lists", F.col("twin"))).alias("at")).orderBy("at"))
