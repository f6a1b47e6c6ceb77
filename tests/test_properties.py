"""Property tests: exact optimisations equal the plain forms on random inputs."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from shoplens.operators import alerts, dau, sales
from shoplens.schemas import EVENT_LOG, ORDER_DETAIL, ORDER_INFO, STARTUP_LOG

T0 = 1_704_067_200_000
EVIDS = ["coupon", "coupon", "coupon", "clickItem", "addCart", "addFavor", "addComment"]

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

event = st.tuples(
    st.sampled_from(["hot", "hot", "hot", "m1", "m2"]),     # one device holds most rows
    st.integers(0, 6).map(lambda i: f"u{i}"),
    st.sampled_from(EVIDS),
    st.integers(0, 3).map(str),
    st.integers(0, 1_500_000),                           # 25 minutes, crossing several 5-minute buckets
)


def _events(spark, rows):
    return spark.createDataFrame(
        [dict(mid=m, uid=u, appid="a", area="x", os="ios", type="event", evid=e, pgid="1", npgid="1", itemid=i,
              ts=T0 + dt) for m, u, e, i, dt in rows], EVENT_LOG)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


@SETTINGS
@given(st.lists(event, min_size=0, max_size=60))
def test_alert_forms_agree(spark, rows):
    df = _events(spark, rows)
    plain = _rows(alerts.coupon_alerts(df, prefilter=False, two_phase=False, blocks=False))
    assert _rows(alerts.coupon_alerts(df, prefilter=False)) == plain
    assert _rows(alerts.coupon_alerts(df, prefilter=True, two_phase=False)) == plain
    assert _rows(alerts.coupon_alerts(df, prefilter=True, two_phase=True)) == plain
    assert _rows(alerts.coupon_alerts(df, prefilter=False, panes=True)) == plain
    assert _rows(alerts.coupon_alerts(df, prefilter=True, panes=True)) == plain
    # every alert: at least 3 distinct users, no click, one per device-minute
    ids = [r[0] for r in plain]
    assert len(ids) == len(set(ids))


start = st.tuples(st.sampled_from(["hot", "hot", "a", "b"]), st.integers(0, 3 * 86_400_000))


@SETTINGS
@given(st.lists(start, min_size=0, max_size=40))
def test_first_log_forms_agree_and_hours_sum(spark, rows):
    df = spark.createDataFrame([dict(mid=m, uid="1", appid="a", area="x", os="ios", ch="c", type="startup", vs="1",
                                     ts=T0 + t) for m, t in rows], STARTUP_LOG)
    a = dau.first_log_per_device(df, "aggregate")
    b = dau.first_log_per_device(df, "window")
    assert _rows(a) == _rows(b)
    assert a.count() == len({(m, (T0 + t) // 86_400_000) for m, t in rows})
    for day in ("2024-01-01", "2024-01-02"):
        total = dau.dau_total(a, day).collect()[0]["dau"]
        assert total == sum(r["dau"] for r in dau.dau_hours(a, day).collect())


pair = st.tuples(st.integers(0, 4), st.integers(-200, 200))


@SETTINGS
@given(st.lists(pair, min_size=0, max_size=30), st.integers(1, 150))
def test_interval_join_equals_brute_force(spark, details, ttl):
    base = 36_000  # 10:00:00
    orders = spark.createDataFrame([dict(id=str(o), create_time="2024-01-01 10:00:%02d" % o, user_id="1",
                                         order_status="1", total_amount=1.0) for o in range(5)], ORDER_INFO)

    def hms(sec):
        return "2024-01-01 %02d:%02d:%02d" % (sec // 3600, sec % 3600 // 60, sec % 60)

    det = spark.createDataFrame([dict(id=f"d{i}", order_id=str(o), sku_name="x", sku_id="1", order_price="1.00",
                                      sku_num="1", detail_time=hms(base + o + off))
                                 for i, (o, off) in enumerate(details)], ORDER_DETAIL)
    got = sorted(r["order_detail_id"] for r in sales.sale_details(orders, det, ttl).collect())
    want = sorted(f"d{i}" for i, (o, off) in enumerate(details) if abs(off) <= ttl)
    assert got == want
    # join rows never exceed detail rows
    assert len(got) <= len(details)


key = st.one_of(st.none(), st.sampled_from(["hot", "hot", "hot", "k1", "k2", "k3"]))


@SETTINGS
@given(st.lists(key, min_size=0, max_size=8), st.lists(key, min_size=0, max_size=30))
def test_detail_pairs_equal_a_full_outer_join(spark, order_keys, detail_keys):
    from pyspark.sql import functions as F
    o = spark.createDataFrame([(k,) for k in order_keys], "id string")
    d = spark.createDataFrame([(f"d{i}", k) for i, k in enumerate(detail_keys)], "id string, order_id string")
    full = (o.select(F.col("id").alias("o_id"))
            .join(d.select(F.col("id").alias("order_detail_id"), F.col("order_id").alias("d_order_id")),
                  F.col("o_id") == F.col("d_order_id"), "full_outer"))
    state = (F.when(F.col("o_id").isNotNull() & F.col("d_order_id").isNotNull(), F.lit("both"))
             .when(F.col("o_id").isNotNull(), F.lit("order_only")).otherwise(F.lit("detail_only")))
    want = full.select(F.coalesce("o_id", "d_order_id").alias("order_id"), "order_detail_id", state.alias("s"))
    key_of = lambda r: tuple("" if v is None else v for v in r)
    assert sorted(map(key_of, sales.detail_pairs(o, d).collect())) == sorted(map(key_of, want.collect()))


@SETTINGS
@given(st.lists(event, min_size=0, max_size=60))
def test_pane_fold_equals_window_fold_on_every_window(spark, rows):
    from pyspark.sql import functions as F
    df = _events(spark, rows).withColumn("event_time", F.timestamp_millis("ts"))
    assert _rows(alerts.pane_fold(df)) == _rows(alerts.window_fold(df))
