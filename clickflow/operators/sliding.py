"""Sliding-window live metrics (5 minute windows sliding by 1 minute).

Each metric is one ``DataFrame -> DataFrame`` function used by batch and by
Structured Streaming:

* ``mode="stream"``: the direct form the streaming layer needs — one
  stateful aggregation over ``window(ts)`` with ``approx_count_distinct``
  (exact distinct and chained aggregations are not allowed in update mode).
* ``mode="batch"``: every window boundary is a whole minute, so the minute
  bucket decides window membership. Sums per window are differences: an event
  adds its counts at the first window that holds its minute and takes them back after
  the last (combined by minute before the shuffle), and a running sum over the minutes
  of the log gives every window.
  Distinct users are exact by the same means: the minutes of a user, merged into
  runs of windows, add one at the start of a run and take it back after its end
  (no distinct aggregate, no fan-out of users). Metrics with a key per window
  combine events per (minute, key) first and only expand those rows into their
  five windows. A hot key combines map-side in all of them.
* ``mode="sketch"`` (active users): one mergeable distinct sketch per minute,
  which can be stored, and windows as unions of five of them.

Output columns are the same in both modes (``window_start``, ``window_end``
+ metric columns).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickflow.functions.timefns import ntz_lit

# Window length, slide, watermark delay, top-list length.
WINDOW = "5 minutes"
WINDOW_MINUTES = 5
SLIDE = "1 minute"
STAGES = ("view", "cart", "purchase")
WATERMARK = "10 minutes"
TOP_K = 10


def _win(ts: Column) -> Column:
    return F.window(ts, WINDOW, SLIDE).alias("window")


def _bounds() -> list[Column]:
    return [F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end")]


def _by_window_start(pm: DataFrame, keys: list[str], *aggs: Column) -> DataFrame:
    """Batch form: fan the per-minute rows out to their windows and group by
    ``window_start`` (not the window struct), so every per-window result is
    hash-partitioned on the column it is joined and ranked on."""
    fanned = pm.select("*", _win(F.col("minute")))
    g = fanned.groupBy(F.col("window.start").alias("window_start"), *keys).agg(*aggs)
    return g.withColumn("window_end", F.col("window_start")
                        + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(WINDOW_MINUTES)))


def _minute(ts: str) -> Column:
    return F.date_trunc("minute", F.col(ts)).cast("timestamp_ntz").alias("minute")


def _avg(sum_col: str, cnt_col: str) -> Column:
    return F.try_divide(F.sum(sum_col).cast("double"), F.sum(cnt_col))


# --- windows by differences -----------------------------------------------------

def _minute_number(ts: str) -> Column:
    """Whole minutes since 1970 of a TIMESTAMP_NTZ (independent of the session zone)."""
    return F.floor(F.unix_timestamp(F.col(ts)) / 60).cast("bigint")


def _minute_time(number: Column) -> Column:
    return ntz_lit("1970-01-01") + F.make_dt_interval(F.lit(0), F.lit(0), number.cast("int"))


def _user_runs(events: DataFrame, ts: str, **when: Column | None) -> DataFrame:
    """w, and per name of ``when`` the change of the number of distinct users from window w - 1
    to window w (windows named by their start minute), among the events its condition holds for.

    One row per user is shuffled, with its distinct minutes: at most the minutes of the log."""
    known = events.filter(F.col("user_id").isNotNull()).select(
        "user_id", *[F.when(F.lit(True) if c is None else c, _minute_number(ts)).alias(n) for n, c in when.items()])
    sets = known.groupBy("user_id").agg(*[F.sort_array(F.collect_set(n)).alias(n) for n in when])
    names = list(when)

    def changes(name: str) -> Column:
        m, k = F.col(name), WINDOW_MINUTES
        starts = F.filter(m, lambda x, i: (i == 0) | (x - F.get(m, i - 1) > k))
        ends = F.filter(m, lambda x, i: (i == F.size(m) - 1) | (F.get(m, i + 1) - x > k))
        row = lambda w, d: F.struct(w.alias("w"), *[
            F.lit(d if n == name else 0).cast("bigint").alias(n) for n in names])
        return F.concat(F.transform(starts, lambda x: row(x - (k - 1), 1)), F.transform(ends, lambda x: row(x + 1, -1)))

    return sets.select(F.inline(F.concat(*[changes(n) for n in names])))


def _event_changes(events: DataFrame, ts: str, **sums: Column) -> DataFrame:
    """w and the changes of ``sums``: an event counts from the first window that holds its minute
    to the last."""
    m = _minute_number(ts)
    sides = F.explode(F.array(F.struct((m - (WINDOW_MINUTES - 1)).alias("w"), F.lit(1).alias("sign")),
                              F.struct((m + 1).alias("w"), F.lit(-1).alias("sign")))).alias("x")
    rows = events.select(*[c.alias(n) for n, c in sums.items()], sides)
    return rows.select("x.w", *[(F.col(n) * F.col("x.sign")).alias(n) for n in sums])


def _running(changes: list[DataFrame], cols: list[str], held: str) -> DataFrame:
    """w and the running sums of ``cols`` over the changes (frames with w and some of the columns),
    for every window in which ``held`` is positive.

    Changes are summed by window start (combined before the shuffle), and run within a day:
    a day holds 1,440 windows at most, whatever its events. What the days before add up to is
    one row a day. Between two changes the sums stand, so the windows there repeat them."""
    rows = changes[0]
    for c in changes[1:]:
        rows = rows.unionByName(c, allowMissingColumns=True)
    per = rows.groupBy("w").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in cols])
    per = (per.filter(F.col("w").isNotNull()).withColumn("day", F.floor(F.col("w") / 1440)).repartition("day"))
    order = Window.orderBy("day")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    # one row for each day of the log
    days = per.groupBy("day").agg(F.min("w").alias("first"), *[F.sum(c).alias(c) for c in cols]).select(
        "day", F.lead("first").over(order).alias("_until"),
        *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_{c}") for c in cols])
    inside = Window.partitionBy("day").orderBy("w")
    until_now = inside.rowsBetween(Window.unboundedPreceding, 0)
    sums = per.join(F.broadcast(days), "day").select(
        "w", F.coalesce(F.lead("w").over(inside), "_until").alias("next"),
        *[(F.sum(c).over(until_now) + F.col(f"_{c}")).alias(c) for c in cols])
    stood = F.explode(F.sequence(F.col("w"), F.col("next") - 1)).alias("w")
    return sums.filter((F.col(held) > 0) & (F.col("next") > F.col("w"))).select(stood, *cols)


def _window_bounds(rows: DataFrame) -> DataFrame:
    """``rows`` with w as window_start and window_end."""
    start = _minute_time(F.col("w"))
    return rows.select(start.alias("window_start"),
                       (start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(WINDOW_MINUTES))).alias("window_end"),
                       *[c for c in rows.columns if c != "w"])


def active_users(events: DataFrame, ts: str = "event_time", mode: str = "batch") -> DataFrame:
    """window_start, window_end, active_users, total_events."""
    if mode == "stream":
        g = events.groupBy(_win(F.col(ts))).agg(
            F.approx_count_distinct("user_id").alias("active_users"),
            F.count(F.lit(1)).alias("total_events"))
        return g.select(*_bounds(), "active_users", "total_events")
    timed = events.filter(F.col(ts).isNotNull())
    sums = _running([_user_runs(timed, ts, active_users=None),
                     _event_changes(timed, ts, total_events=F.lit(1).cast("bigint"))],
                    ["active_users", "total_events"], "total_events")
    return _window_bounds(sums)


#: log2 of the sketches' buckets; the standard error of an estimate is about 1.04 / sqrt(2 ** SKETCH_BITS).
SKETCH_BITS = 12


def minute_sketches(events: DataFrame, ts: str = "event_time") -> DataFrame:
    """m (minute number), sketch (a mergeable distinct sketch of the minute's users), total_events:
    a table to store, and to merge into any windows."""
    return events.filter(F.col(ts).isNotNull()).groupBy(_minute_number(ts).alias("m")).agg(
        F.hll_sketch_agg("user_id", SKETCH_BITS).alias("sketch"), F.count(F.lit(1)).alias("total_events"))


def active_users_from_sketches(sketches: DataFrame) -> DataFrame:
    """window_start, window_end, estimate, total_events of every window that holds a minute of ``sketches``."""
    k = WINDOW_MINUTES
    fanned = sketches.select(F.explode(F.sequence(F.col("m") - (k - 1), F.col("m"))).alias("w"), "sketch", "total_events")
    return _window_bounds(fanned.groupBy("w").agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"), F.sum("total_events").alias("total_events")))


def sketch_error(exact: Column, estimate: Column, deviations: float = 5) -> Column:
    """Whether an estimate lies within ``deviations`` standard errors of the exact count."""
    return F.abs(estimate - exact) <= F.greatest(F.lit(1.0), exact * (deviations * 1.04 / 2 ** (SKETCH_BITS / 2)))


def active_users_approx(events: DataFrame, ts: str = "event_time") -> DataFrame:
    """Active users of every window exactly and by stored minute sketches, and whether the
    estimate lies within the sketches' error bound."""
    from clickflow.plans.joins import materialize
    by_sketch = active_users_from_sketches(materialize(minute_sketches(events, ts)))
    exact = active_users(events, ts)
    return exact.join(by_sketch.select("window_start", "estimate"), "window_start").select(
        "window_start", "window_end", "active_users", "total_events", "estimate",
        sketch_error(F.col("active_users"), F.col("estimate")).alias("estimate_in_bound"))


def product_views(events: DataFrame, ts: str = "event_time", mode: str = "batch") -> DataFrame:
    """Views per window x product x brand x category: view_count, avg_price."""
    keys = ["product_id", "brand", "category_code"]
    views = events.filter(F.col("event_type") == "view")
    if mode == "stream":
        g = views.groupBy(_win(F.col(ts)), *keys).agg(
            F.count(F.lit(1)).alias("view_count"), F.avg("price").alias("avg_price"))
    else:
        return _finish_views(views.groupBy(_minute(ts), *keys).agg(
            F.count(F.lit(1)).alias("n"), F.sum("price").alias("sp"), F.count("price").alias("cp")))
    return g.select(*_bounds(), *keys, "view_count", "avg_price")


def _finish_views(pm: DataFrame) -> DataFrame:
    keys = ["product_id", "brand", "category_code"]
    g = _by_window_start(pm, keys, F.sum("n").alias("view_count"), _avg("sp", "cp").alias("avg_price"))
    return g.select("window_start", "window_end", *keys, "view_count", "avg_price")


def purchases(events: DataFrame, ts: str = "event_time", mode: str = "batch") -> DataFrame:
    """Purchases per window: purchase_count, total_revenue, avg_basket_value
    (mean price), purchasing_users."""
    p = events.filter(F.col("event_type") == "purchase")
    if mode == "stream":
        g = p.groupBy(_win(F.col(ts))).agg(
            F.count(F.lit(1)).alias("purchase_count"),
            F.sum("price").alias("total_revenue"),
            F.avg("price").alias("avg_basket_value"),
            F.approx_count_distinct("user_id").alias("purchasing_users"))
        return g.select(*_bounds(), "purchase_count", "total_revenue", "avg_basket_value", "purchasing_users")
    p = p.filter(F.col(ts).isNotNull())
    sums = _running([_user_runs(p, ts, purchasing_users=None),
                     _event_changes(p, ts, n=F.lit(1).cast("bigint"), **_price_sums(F.col("price")))],
                    ["purchasing_users", "n", "sp", "cp"], "n")
    return _window_bounds(sums).select(
        "window_start", "window_end", F.col("n").alias("purchase_count"), *_basket(), "purchasing_users")


def _price_sums(price: Column) -> dict[str, Column]:
    return {"sp": F.coalesce(price, F.lit(0)), "cp": price.isNotNull().cast("bigint")}


def _basket() -> list[Column]:
    """Revenue and mean price from sums: NULL where no price is known."""
    return [F.when(F.col("cp") > 0, F.col("sp").cast("double")).alias("total_revenue"),
            F.try_divide(F.when(F.col("cp") > 0, F.col("sp").cast("double")), F.col("cp")).alias("avg_basket_value")]


def event_distribution(events: DataFrame, ts: str = "event_time", mode: str = "batch") -> DataFrame:
    """Events per window x event_type: event_count."""
    if mode == "stream":
        g = events.groupBy(_win(F.col(ts)), "event_type").agg(F.count(F.lit(1)).alias("event_count"))
    else:
        return _finish_events(events.groupBy(_minute(ts), "event_type").agg(F.count(F.lit(1)).alias("n")))
    return g.select(*_bounds(), "event_type", "event_count")


def _finish_events(pm: DataFrame) -> DataFrame:
    g = _by_window_start(pm, ["event_type"], F.sum("n").alias("event_count"))
    return g.select("window_start", "window_end", "event_type", "event_count")


def brand_activity(events: DataFrame, ts: str = "event_time", mode: str = "batch") -> DataFrame:
    """Events with a brand per window x brand x event_type: event_count,
    total_value (sum of price)."""
    b = events.filter(F.col("brand").isNotNull())
    keys = ["brand", "event_type"]
    if mode == "stream":
        g = b.groupBy(_win(F.col(ts)), *keys).agg(
            F.count(F.lit(1)).alias("event_count"), F.sum("price").alias("total_value"))
    else:
        return _finish_brands(b.groupBy(_minute(ts), *keys).agg(F.count(F.lit(1)).alias("n"),
                                                                F.sum("price").alias("sv")))
    return g.select(*_bounds(), *keys, "event_count", "total_value")


def _finish_brands(pm: DataFrame) -> DataFrame:
    keys = ["brand", "event_type"]
    g = _by_window_start(pm, keys, F.sum("n").alias("event_count"),
                         F.sum("sv").cast("double").alias("total_value"))
    return g.select("window_start", "window_end", *keys, "event_count", "total_value")


def window_totals(events: DataFrame, ts: str = "event_time") -> DataFrame:
    """Every window with its users, events, purchases and events by stage, by running sums:
    two rows per minute and one per user, of each task, are shuffled."""
    timed = events.filter(F.col(ts).isNotNull())
    kind = F.col("event_type")
    price = F.when(kind == "purchase", F.col("price"))
    counted = {"total_events": F.lit(1).cast("bigint"),
               **{f"{s}_events": F.coalesce((kind == s).cast("bigint"), F.lit(0)) for s in STAGES}, **_price_sums(price)}
    users = _user_runs(timed, ts, active_users=None, purchasing_users=kind == "purchase")
    sums = _running([users, _event_changes(timed, ts, **counted)],
                    ["active_users", "purchasing_users", *counted], "total_events")
    return _window_bounds(sums).select("*", *_basket()).drop("sp", "cp")


def minute_counts(events: DataFrame, ts: str = "event_time") -> DataFrame:
    """minute, product_id, brand, category_code, event_type, n: what the top lists of windows count."""
    return events.groupBy(_minute(ts), "product_id", "brand", "category_code", "event_type").agg(
        F.count(F.lit(1)).alias("n"))


def view_counts(counts: DataFrame) -> DataFrame:
    """view_count per window, product, brand and category from ``minute_counts``."""
    return _by_window_start(counts.filter(F.col("event_type") == "view"), ["product_id", "brand", "category_code"],
                            F.sum("n").alias("view_count"))


def brand_counts(counts: DataFrame) -> DataFrame:
    """event_count per window, brand and event type from ``minute_counts``."""
    return _by_window_start(counts.filter(F.col("brand").isNotNull()), ["brand", "event_type"],
                            F.sum("n").alias("event_count"))


def per_window_topk(metric: DataFrame, by: str, tie: list[str], k: int = TOP_K) -> DataFrame:
    """Rank rows within each window by ``by`` desc (ties: ``tie`` asc) and
    keep k; planned as a per-window group limit before the full sort."""
    w = Window.partitionBy("window_start").orderBy(
        F.col(by).desc(), *[F.col(c).asc_nulls_last() for c in tie])
    return metric.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def top_products(events: DataFrame, ts: str = "event_time", k: int = TOP_K,
                 views: DataFrame | None = None) -> DataFrame:
    views = product_views(events, ts) if views is None else views
    return per_window_topk(views, "view_count", ["product_id", "brand", "category_code"], k)


def top_brands(events: DataFrame, ts: str = "event_time", k: int = TOP_K,
               brands: DataFrame | None = None) -> DataFrame:
    brands = brand_activity(events, ts) if brands is None else brands
    return per_window_topk(brands, "event_count", ["brand", "event_type"], k)


def micro_batch_topk(batch: DataFrame, by: str, tie: list[str], k: int = TOP_K) -> DataFrame:
    """Top k over all windows present in one micro-batch (the faithful form
    of the streaming sink: one global top list per trigger)."""
    w = Window.orderBy(F.col(by).desc(), *[F.col(c).asc_nulls_last() for c in tie])
    # a micro-batch's update output is bounded by the state touched in one
    # trigger; the global top-k is planned as a single limited sort.
    return batch.orderBy(F.col(by).desc(), *[F.col(c).asc_nulls_last() for c in tie]).limit(k) \
        .withColumn("rank", F.row_number().over(w))
