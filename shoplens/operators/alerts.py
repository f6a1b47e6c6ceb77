"""Coupon-abuse alert: sliding window per device (WIN1), behaviour fold (AGG6), predicate (FLT5), document id and
last-write-wins per device-minute (PRJ10, WIN2 / SNK4).

A device alerts for a window when at least ``min_uids`` distinct users took a coupon on it and nobody clicked an
item in that window.  At most one alert per device and minute survives: the last firing window of the minute.

Scale notes
-----------
A 5 min / 5 s sliding window copies every row into 60 windows.  ``candidate_buckets`` cuts that down exactly:
a window of length W touches at most two adjacent W-long tumbling buckets, so a firing window implies that its two
buckets together hold ≥ ``min_uids`` distinct coupon users.  Only rows of such (device, bucket) pairs are expanded.
The candidate search is itself cheap and skew-proof: a distinct over (device, bucket, user) of coupon rows,
aggregated map-side, then a count per (device, bucket pair).  Nothing is gathered per device.

``block_fold`` is the fold of the batch form: panes merged into windows as prefixes and suffixes of window-long blocks,
two copies of a pane.  The live form (``streaming.jobs.alert_ring``) keeps each device's panes as state.  ``window_fold``
copies events into their windows: it first aggregates per (window, device, event id) - ``collect_set`` of coupon users / items (bounded by the
distinct users and items of one window) and a count - and then per (window, device), whose rows are as many as there are
event ids.  So the event list holds every id that occurs, as a multiset.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplens.functions.columns import bound, dated_index, doc_id, event_time
from shoplens.operators.keyed import latest_by_key
from shoplens.schemas import ALERT_INDEX_PREFIX

# The two event ids the rule reads.
COUPON = "coupon"
CLICK = "clickItem"

DEFAULT_WINDOW_SECONDS = 300
DEFAULT_SLIDE_SECONDS = 5
DEFAULT_MIN_UIDS = 3


def _base(events: DataFrame) -> DataFrame:
    return events.select("mid", "uid", "evid", "itemid", "ts", event_time("ts").alias("event_time"))


def candidate_buckets(events: DataFrame, window_seconds: int = DEFAULT_WINDOW_SECONDS,
                      min_uids: int = DEFAULT_MIN_UIDS) -> DataFrame:
    """(mid, bucket) pairs that may hold a firing window; a superset of every firing window's rows."""
    w_ms = window_seconds * 1000
    bucket = F.floor(F.col("ts") / w_ms)
    # one scan: each coupon user of bucket b counts for the pairs (b-1, b) and (b, b+1), named by their first bucket
    pair_users = (events.where(F.col("evid") == COUPON)
                  .select("mid", "uid", F.explode(F.array(bucket - 1, bucket)).alias("p")))
    hot = (pair_users.groupBy("mid", "p").agg(F.count_distinct("uid").alias("n"))
           .where(F.col("n") >= min_uids))
    return hot.select("mid", F.explode(F.array(F.col("p"), F.col("p") + 1)).alias("bucket"))


def _per_event_id() -> list:
    """Aggregates of the rows of one (window or pane, device, event id)."""
    coupon = F.col("evid") == COUPON
    return [F.collect_set(F.when(coupon, F.col("uid"))).alias("c_uids"),
            F.collect_set(F.when(coupon, F.col("itemid"))).alias("c_items"),
            F.count(F.lit(1)).alias("n")]


def _per_device() -> list:
    """Aggregates over the event ids of one (window, device)."""
    return [F.array_sort(F.array_distinct(F.flatten(F.collect_list("c_uids")))).alias("uids"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("c_items")))).alias("item_ids"),
            F.coalesce(F.bool_or(F.col("evid") == CLICK), F.lit(False)).alias("has_click"),
            F.sum("n").alias("n_events"), _events_text()]


def _events_text():
    """``id:count`` of every event id, sorted by id."""
    entry = F.when(F.col("evid").isNotNull(), F.struct("evid", "n"))
    return F.array_join(F.transform(F.array_sort(F.collect_list(entry)), lambda e: F.concat(e["evid"], F.lit(":"), e["n"].cast("string"))), ",").alias("events")


def _folded(agg: DataFrame) -> DataFrame:
    return agg.select("mid", F.unix_millis(F.col("window.start")).alias("window_start"),
                      F.unix_millis(F.col("window.end")).alias("ts"), "uids", "item_ids", "has_click", "n_events", "events")


def window_fold(events: DataFrame, window_seconds: int = DEFAULT_WINDOW_SECONDS,
                slide_seconds: int = DEFAULT_SLIDE_SECONDS) -> DataFrame:
    """WIN1 + AGG6: per (window, device): coupon users, coupon items, event-id counts, click flag."""
    window = F.window("event_time", f"{window_seconds} seconds", f"{slide_seconds} seconds")
    per_id = events.groupBy(window.alias("window"), "mid", "evid").agg(*_per_event_id())
    return _folded(per_id.groupBy("window", "mid").agg(*_per_device()))


def pane_fold(events: DataFrame, window_seconds: int = DEFAULT_WINDOW_SECONDS,
              slide_seconds: int = DEFAULT_SLIDE_SECONDS, min_uids: int | None = None) -> DataFrame:
    """WIN1 + AGG6 through panes: the same rows as ``window_fold``; with ``min_uids`` (batch) those of firing windows only.

    A sliding window of length W and slide S is the union of W/S consecutive S-long panes (5-second slices).
    Events are folded per (device, pane, event id) first — a partial aggregate, so a device sending thousands of
    events per pane ships a row per event id, pane and task.  Needs W to be a multiple of S (5 min / 5 s is).

    Windows are dealt by the W-long block that their last pane lies in.  A pane is in windows of its own block and the
    next, so two copies of it are shuffled, not one for each window.  A (device, block) holds the panes of two window
    lengths at most and is folded into its windows there; which of them fire is decided by clicks and coupon users alone,
    before anything else is put together.  A stream copies closed panes into their windows instead.
    """
    if window_seconds % slide_seconds:
        raise ValueError("pane form needs the window length to be a multiple of the slide")
    if events.isStreaming:
        return _pane_stream(events, window_seconds, slide_seconds)
    k, slide = window_seconds // slide_seconds, slide_seconds * 1000
    timed = events.where(F.col("event_time").isNotNull()).withColumn("pane", F.floor(F.unix_millis("event_time") / slide))
    panes = timed.groupBy("mid", "pane", "evid").agg(*_per_event_id())
    block = F.floor(F.col("pane") / k)
    copies = panes.select("mid", F.explode(F.array(block, block + 1)).alias("block"), F.struct("pane", "evid", "c_uids", "c_items", "n").alias("x"))
    held = copies.groupBy("mid", "block").agg(F.collect_list("x").alias("xs"))
    ends = F.sequence(F.col("block") * k, F.col("block") * k + (k - 1))

    def lies(pane, e):
        return (pane > e - k) & (pane <= e)

    def distinct(rows, column):
        return F.array_distinct(F.flatten(F.transform(rows, lambda x: x[column])))

    if min_uids is None:
        wanted = F.filter(ends, lambda e: F.exists("xs", lambda x: lies(x["pane"], e)))
    else:
        clicks = F.transform(F.filter("xs", lambda x: x["evid"] == CLICK), lambda x: x["pane"])
        coupons = F.filter("xs", lambda x: F.size(x["c_uids"]) > 0)
        unclicked = bound(clicks, lambda ps: F.filter(ends, lambda e: ~F.exists(ps, lambda p: lies(p, e))))
        wanted = bound(coupons, lambda xs: F.filter(unclicked, lambda e: F.size(distinct(F.filter(xs, lambda x: lies(x["pane"], e)), "c_uids")) >= min_uids))

    def fold(e):
        return bound(F.filter("xs", lambda x: lies(x["pane"], e)), lambda rows: F.struct(
            e.alias("e"), F.array_sort(distinct(rows, "c_uids")).alias("uids"), F.array_sort(distinct(rows, "c_items")).alias("item_ids"),
            F.exists(rows, lambda x: F.coalesce(x["evid"] == CLICK, F.lit(False))).alias("has_click"),
            _n_events(rows).alias("n_events"), _counts_text(rows).alias("events")))

    ts = (F.col("w.e") + 1) * slide
    return held.select("mid", F.explode(F.transform(wanted, fold)).alias("w")).select(
        "mid", (ts - window_seconds * 1000).cast("long").alias("window_start"), ts.cast("long").alias("ts"),
        "w.uids", "w.item_ids", "w.has_click", "w.n_events", "w.events")


def _pane_stream(events: DataFrame, window_seconds: int, slide_seconds: int) -> DataFrame:
    panes = events.groupBy(F.window("event_time", f"{slide_seconds} seconds").alias("pane"), "mid", "evid").agg(*_per_event_id())
    # a pane lies in a window exactly when its last instant (window_time = end - 1 µs) does, since panes are
    # aligned to the slide; window_time keeps the event-time mark, so the same code runs as a chained stream
    window = F.window(F.window_time("pane"), f"{window_seconds} seconds", f"{slide_seconds} seconds")
    per_id = panes.groupBy(window.alias("window"), "mid", "evid").agg(
        F.flatten(F.collect_list("c_uids")).alias("c_uids"), F.flatten(F.collect_list("c_items")).alias("c_items"), F.sum("n").alias("n"))
    return _folded(per_id.groupBy("window", "mid").agg(*_per_device()))


def _n_events(ids):
    """Events in a list of (event id, count) entries."""
    return F.aggregate(ids, F.lit(0).cast("long"), lambda n, x: n + x["n"])


def _counts_text(ids):
    """``id:count`` of every event id in a list of (event id, count) entries, sorted by id."""
    names = F.array_sort(F.array_distinct(F.filter(F.transform(ids, lambda x: x["evid"]), lambda x: x.isNotNull())))
    return F.array_join(F.transform(names, lambda name: F.concat(name, F.lit(":"), _n_events(F.filter(ids, lambda x: x["evid"] == name)).cast("string"))), ",")


def block_fold(events: DataFrame, window_seconds: int = DEFAULT_WINDOW_SECONDS, slide_seconds: int = DEFAULT_SLIDE_SECONDS,
               min_uids: int = DEFAULT_MIN_UIDS) -> DataFrame:
    """WIN1 + AGG6 + FLT5 through blocks of panes: of the firing windows, each constant stretch's last and those that are
    the last of a minute - all that WIN2 can keep.

    Time is cut into panes of a slide and blocks of a window's length, so the window that ends with pane e holds the
    panes of e's block up to e and those of the block before that have not left it: a prefix of one block and a suffix of
    the other.  A pane is copied twice, into its own block, which it enters at its place, and into the next, which it
    leaves a window's length later.  A window's content changes at these places only, so there is one fold for each of
    them and for each block's start, and it holds until the next.  A (device, block) has as many panes as a window at most,
    however many events.  Needs the window to be a multiple of the slide.
    """
    if window_seconds % slide_seconds:
        raise ValueError("block form needs the window length to be a multiple of the slide")
    k, slide = window_seconds // slide_seconds, slide_seconds * 1000
    timed = events.where(F.col("ts").isNotNull()).withColumn("pane", F.floor(F.col("ts") / slide))
    panes = timed.groupBy("mid", "pane", "evid").agg(*_per_event_id())  # a row for each event id of a pane
    panes = panes.select("mid", "pane", "c_uids", "c_items", F.coalesce(F.col("evid") == CLICK, F.lit(False)).alias("click"), F.array(F.struct("evid", "n")).alias("ids"))
    block = F.floor(F.col("pane") / k)

    def place(at, e, enters):
        return F.struct(at.cast("long").alias("block"), e.cast("long").alias("e"), F.lit(enters).cast("boolean").alias("enters"))

    places = F.array(place(block, F.col("pane"), True), place(block + 1, F.col("pane") + k, False), place(block + 1, (block + 1) * k, None))
    rows = panes.select("mid", F.explode(places).alias("at"), "c_uids", "c_items", "click", "ids").select("mid", "at.*", "c_uids", "c_items", "click", "ids")
    w = Window.partitionBy("mid", "block").orderBy("e")
    upto, beyond = w.rangeBetween(Window.unboundedPreceding, 0), w.rangeBetween(1, Window.unboundedFollowing)

    def held(column: str, distinct: bool):
        both = F.concat(F.collect_list(F.when(F.col("enters"), F.col(column))).over(upto), F.collect_list(F.when(~F.col("enters"), F.col(column))).over(beyond))
        return F.array_sort(F.array_distinct(F.flatten(both))) if distinct else F.flatten(both)

    click = F.coalesce(F.bool_or(F.col("enters") & F.col("click")).over(upto), F.lit(False)) | F.coalesce(F.bool_or(~F.col("enters") & F.col("click")).over(beyond), F.lit(False))
    folds = rows.select("mid", "e", F.coalesce(F.min("e").over(beyond), (F.col("block") + 1) * k).alias("till"), F.lag("e").over(w).alias("before"),
                        held("c_uids", True).alias("uids"), click.alias("click"), held("c_items", True).alias("item_ids"), held("ids", False).alias("ids"))
    fired = folds.where((F.size("uids") >= min_uids) & ~F.col("click") & ~F.col("e").eqNullSafe(F.col("before")))

    def minute(e):
        return F.floor((e + 1) * slide / 60000)

    ends = F.filter(F.sequence("e", F.col("till") - 1), lambda e: (e == F.col("till") - 1) | (minute(e) < minute(e + 1)))
    names = F.array_sort(F.array_distinct(F.filter(F.transform("ids", lambda x: x["evid"]), lambda x: x.isNotNull())))

    def counted(name):
        own = F.filter("ids", lambda x: x["evid"] == name)
        return F.concat(name, F.lit(":"), F.aggregate(own, F.lit(0).cast("long"), lambda n, x: n + x["n"]).cast("string"))

    total = F.aggregate("ids", F.lit(0).cast("long"), lambda n, x: n + x["n"])
    out = fired.select("mid", F.explode(ends).alias("e"), "uids", "item_ids", total.alias("n_events"), F.array_join(F.transform(names, counted), ",").alias("events"))
    ts = (F.col("e") + 1) * slide
    return out.select("mid", (ts - window_seconds * 1000).cast("long").alias("window_start"), ts.cast("long").alias("ts"), "uids", "item_ids", "n_events", "events")


def judge_ring(panes: dict[int, list], first: int, last: int, k: int, slide_ms: int, min_uids: int) -> list[tuple]:
    """WIN1 + AGG6 + FLT5 over one device's panes (number → [coupon users, coupon items, event id → count]): of the windows
    that end with the panes ``first`` .. ``last``, the last firing one of each minute, as (end pane, users, items, events, count).

    Walks the places where a pane enters or leaves and keeps counts, so each pane is added once and taken out once."""
    places = sorted({first, *(p for p in panes if first < p <= last), *(p + k for p in panes if first < p + k <= last)})
    uids, items, ids = Counter(), Counter(), Counter()
    found: dict[int, tuple] = {}
    for p in (p for p in panes if p < first < p + k):
        _merge(panes[p], uids, items, ids, 1)
    for e, till in zip(places, [*places[1:], last + 1]):
        if e in panes:
            _merge(panes[e], uids, items, ids, 1)
        if e - k in panes and e > first:
            _merge(panes[e - k], uids, items, ids, -1)
        if len(uids) >= min_uids and not ids[CLICK]:
            events = ",".join(f"{i}:{n}" for i, n in sorted((i, n) for i, n in ids.items() if n and i is not None))
            fold = (sorted(uids), sorted(items), events, sum(ids.values()))
            for minute in range((e + 1) * slide_ms // 60000, till * slide_ms // 60000 + 1):
                end = min(till - 1, -(-(minute + 1) * 60000 // slide_ms) - 2)  # the last window of the minute
                if end >= e and (end + 1) * slide_ms // 60000 == minute:
                    found[minute] = (end, *fold)
    return [found[m] for m in sorted(found)]


def _merge(pane: list, uids: Counter, items: Counter, ids: Counter, sign: int) -> None:
    for held, own in ((uids, pane[0]), (items, pane[1])):
        for x in own:
            held[x] += sign
            if not held[x]:
                del held[x]
    for i, n in pane[2].items():
        ids[i] += sign * n


def _windows(events: DataFrame, window_seconds: int, slide_seconds: int) -> DataFrame:
    """Each row once per sliding window holding it, keyed by the window's start (epoch ms, a fixed-width key)."""
    w = F.window("event_time", f"{window_seconds} seconds", f"{slide_seconds} seconds")
    return events.select("mid", "uid", "evid", "itemid", F.unix_millis(w.start).alias("window_start"))


def firing_windows(events: DataFrame, window_seconds: int = DEFAULT_WINDOW_SECONDS,
                   slide_seconds: int = DEFAULT_SLIDE_SECONDS, min_uids: int = DEFAULT_MIN_UIDS) -> DataFrame:
    """WIN1 + AGG6 + FLT5 in two phases (batch).

    Phase 1 decides which (window, device) pairs fire using fixed-width aggregates only — event counts per event id
    and the number of distinct coupon users (a distinct over (window, device, user), then a count) — all combined
    map-side, so a device with a third of all rows never gathers its rows in one task.  Phase 2 collects the user
    and item sets for the firing pairs alone.  Same result as ``firing(window_fold(...))``.
    """
    keys = ["window_start", "mid"]
    ex = _windows(events, window_seconds, slide_seconds)
    stats = (ex.groupBy(*keys, "evid").agg(F.count(F.lit(1)).alias("n")).groupBy(*keys)
             .agg(F.sum("n").alias("n_events"), F.coalesce(F.bool_or(F.col("evid") == CLICK), F.lit(False)).alias("has_click"),
                  _events_text())
             .where(~F.col("has_click")))
    coupons = ex.where(F.col("evid") == COUPON)
    n_uids = (coupons.select(*keys, "uid").distinct()
              .groupBy(*keys).agg(F.count(F.lit(1)).alias("n_uids"))
              .where(F.col("n_uids") >= min_uids))
    fired = stats.join(n_uids, keys, "inner")
    sets = (coupons.join(fired.select(*keys), keys, "left_semi")
            .groupBy(*keys)
            .agg(F.array_sort(F.collect_set("uid")).alias("uids"),
                 F.array_sort(F.collect_set("itemid")).alias("item_ids")))
    out = fired.join(sets, keys, "inner")
    return out.select(
        "mid", "window_start", (F.col("window_start") + window_seconds * 1000).alias("ts"),
        "uids", "item_ids", "n_events", "events")


def firing(folded: DataFrame, min_uids: int = DEFAULT_MIN_UIDS) -> DataFrame:
    """FLT5: at least ``min_uids`` distinct coupon users and no click (``min_uids`` 4 gives the strict '> 3' rule)."""
    return folded.where((F.size("uids") >= min_uids) & ~F.col("has_click")).drop("has_click")


def as_documents(alerts: DataFrame, prefix: str = ALERT_INDEX_PREFIX) -> DataFrame:
    """PRJ10: document id ``<mid>-<minute of ts>`` and the dated index name."""
    return alerts.select(doc_id("mid", "ts").alias("doc_id"), dated_index(prefix, "ts").alias("index_name"),
                         *alerts.columns)


def event_list(events: str = "events"):
    """The event ids of an alert as an array, each as often as it occurred, from their ``id:count`` text."""
    def repeated(entry):
        return F.array_repeat(F.regexp_extract(entry, r"^(.*):(\d+)$", 1), F.regexp_extract(entry, r"^(.*):(\d+)$", 2).cast("int"))
    return F.when(F.col(events) != "", F.flatten(F.transform(F.split(events, ","), repeated))).otherwise(F.array().cast("array<string>"))


def records(alert_docs: DataFrame) -> DataFrame:
    """Alert documents as records of ``schemas.COUPON_ALERT``, the event list written out."""
    return alert_docs.select("mid", "uids", "item_ids", event_list().alias("events"), "ts")


def coupon_alerts(events: DataFrame, window_seconds: int = DEFAULT_WINDOW_SECONDS,
                  slide_seconds: int = DEFAULT_SLIDE_SECONDS, min_uids: int = DEFAULT_MIN_UIDS,
                  prefilter: bool = True, two_phase: bool = False, panes: bool = False, blocks: bool = True) -> DataFrame:
    """WIN2 in batch: one alert document per (device, minute) — the last firing window ending in that minute.

    ``prefilter`` folds only candidate (device, bucket) rows.  The default fold goes through blocks of panes, two copies of
    a pane instead of one of each event for every window; it needs the window to be a multiple of the slide, else, or with
    ``blocks=False``, events are copied into their windows and folded there, one aggregate over one scan.
    ``two_phase`` instead decides firing with fixed-width aggregates and collects sets for firing windows only —
    for feeds where a single device carries a large share of all coupon users — at the price of reading the
    candidate rows three times.  ``panes`` folds events into 5-second panes and these into windows — for
    dense feeds, where a device sends many events per slide.  All forms give the same result.
    """
    base = _base(events)
    if prefilter:
        w_ms = window_seconds * 1000
        cands = candidate_buckets(base, window_seconds, min_uids)
        base = (base.withColumn("bucket", F.floor(F.col("ts") / w_ms))
                .join(cands, ["mid", "bucket"], "left_semi").drop("bucket"))
    if two_phase:
        fired = firing_windows(base, window_seconds, slide_seconds, min_uids)
    elif panes:
        fired = firing(pane_fold(base, window_seconds, slide_seconds, min_uids), min_uids)
    elif blocks and window_seconds % slide_seconds == 0:
        fired = block_fold(base, window_seconds, slide_seconds, min_uids)
    else:
        fired = firing(window_fold(base, window_seconds, slide_seconds), min_uids)
    docs = as_documents(fired)
    return latest_by_key(docs, ["doc_id"], ["ts"])


def preview(df: DataFrame, n: int = 100) -> DataFrame:
    """ORD2 / SNK10: the first ``n`` rows for a look (a debug preview; the limit is the feature)."""
    return df.limit(n)
