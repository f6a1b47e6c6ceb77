"""Record schemas of the five input streams and the two outputs, and the stream → topic table.

Field lists follow the domain records exactly; numbers and times travel as text, as they do in the JSON payloads.
``ts`` is epoch milliseconds.
"""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, DoubleType, IntegerType, LongType, StringType, StructField,
                               StructType)


def _strings(*names: str) -> list[StructField]:
    return [StructField(n, StringType(), True) for n in names]


STARTUP_LOG = StructType(_strings("mid", "uid", "appid", "area", "os", "ch", "type", "vs")
                         + [StructField("ts", LongType(), True)])

EVENT_LOG = StructType(_strings("mid", "uid", "appid", "area", "os", "type", "evid", "pgid", "npgid", "itemid")
                       + [StructField("ts", LongType(), True)])

ORDER_INFO = StructType(
    _strings("id", "province_id", "consignee", "order_comment", "consignee_tel", "order_status", "payment_way",
             "user_id", "img_url")
    + [StructField("total_amount", DoubleType(), True)]
    + _strings("expire_time", "delivery_address", "create_time", "operate_time", "tracking_no", "parent_order_id",
               "out_trade_no", "trade_body"))

# order_detail carries no time of its own; ``detail_time`` is the arrival time (a Kafka timestamp in live feeds).
ORDER_DETAIL = StructType(_strings("id", "order_id", "sku_name", "sku_id", "order_price", "img_url", "sku_num",
                                   "detail_time"))

USER_INFO = StructType(_strings("id", "login_name", "user_level", "birthday", "gender")
                       + [StructField("seq", LongType(), True)])

SALE_DETAIL = StructType(
    _strings("order_detail_id", "order_id", "order_status", "create_time", "user_id", "sku_id", "user_gender")
    + [StructField("user_age", IntegerType(), True)]
    + _strings("user_level")
    + [StructField("sku_price", DoubleType(), True)]
    + _strings("sku_name", "dt"))

COUPON_ALERT = StructType([
    StructField("mid", StringType(), True),
    StructField("uids", ArrayType(StringType()), True),
    StructField("item_ids", ArrayType(StringType()), True),
    StructField("events", ArrayType(StringType()), True),
    StructField("ts", LongType(), True),
])

CHANGE_EVENT = StructType([
    StructField("db_table", StringType(), True),
    StructField("table_name", StringType(), True),
    StructField("entry_type", StringType(), True),
    StructField("event_type", StringType(), True),
    StructField("after", ArrayType(StructType([StructField("name", StringType(), True),
                                               StructField("value", StringType(), True)])), True),
])

# Raw logs before routing: the union of both log kinds (``type`` decides the topic).
RAW_LOG = StructType(_strings("type", "mid", "uid", "appid", "area", "os", "ch", "vs", "evid", "pgid", "npgid",
                              "itemid") + [StructField("ts", LongType(), True)])

# Topic names of the five streams.
TOPIC_START = "TOPIC_START"
TOPIC_EVENT = "TOPIC_EVENT"
TOPIC_ORDER_INFO = "TOPIC_ORDER_INFO"
TOPIC_ORDER_DETAIL = "TOPIC_ORDER_DETAIL"
TOPIC_USER_INFO = "TOPIC_USER_INFO"

STREAMS = {
    "startup": (TOPIC_START, STARTUP_LOG),
    "event": (TOPIC_EVENT, EVENT_LOG),
    "order_info": (TOPIC_ORDER_INFO, ORDER_INFO),
    "order_detail": (TOPIC_ORDER_DETAIL, ORDER_DETAIL),
    "user_info": (TOPIC_USER_INFO, USER_INFO),
}

ALERT_INDEX_PREFIX = "coupon_alert"
SALE_DETAIL_INDEX_PREFIX = "sale_detail"
