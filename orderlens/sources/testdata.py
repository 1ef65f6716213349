"""Adapter from the driver tables to order events.

The driver's ``events`` table (event_id, ts, user_id, event_type, value,
props) becomes an order-event stream with a fixed, documented mapping, so
the same rows can be rebuilt in DuckDB SQL for the correctness oracle
(see ``orderlens.plans.oracle``). ``orders`` + ``lineitem`` + ``part`` give
order lines with real products.

Mapping (fixed values):
  purchase -> order_created; signup -> order_item_added when event_id is
  even, else order_confirmed; click -> order_shipped; view ->
  order_delivered; error -> order_cancelled.
  order_id    = 'ORD-' || user_id || '-' || day of month of ts
  customer_id = 'CUST-' || lpad(user_id, 6, '0')
  total       = round(value * 10, 2)
  province    = nation name of nation (user_id % 25); city = its region name
  payment     = PAYMENT_METHODS[user_id % 5]
  ingest lag  = props.k * 5 milliseconds (kafka / processing time)
  Shipping address and payment method ride only on order_created and
  order_confirmed, as in the producer; other types carry neither.
  items       = event_id % 3 + 1 items on order_created: equal shares of the
  total in whole cents, the last one taking what is left; quantities 1 to 4.
Injected faults (by event_id): %101 order_id NULL; %103 type 'bogus';
%107 total 999999.0; %109 ts + 60 days; %113 ts - 400 days; %127 the raw
message body is not JSON; %131 the first item's subtotal is 1 too high; %137
its quantity is 0; %139 its product name is missing; %149 customer_id NULL;
%157 the timestamp in the raw message has no time of day.
Order headers: total = sum of the order's lines, 1 too high where the order
number is a multiple of 97.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens import schemas as S

NATIONS = 25
INGEST_LAG_MS_PER_K = 5
CARRIERS = ("SEUR", "MRW", "Correos", "DHL", "GLS")
TOPIC_PARTITIONS = 6
ROW_GROUP_BYTES = 8 << 20

SOURCE_TYPE_MAP = (
    ("purchase", "order_created"),
    ("click", "order_shipped"),
    ("view", "order_delivered"),
    ("error", "order_cancelled"),
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def geo_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation ⋈ region: nation key -> province (nation) and city (region)."""
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey, "left").select(
        F.col("n_nationkey").alias("geo_key"),
        F.col("n_name").alias("geo_province"),
        F.col("r_name").alias("geo_city"),
    )
    # nation and region are fixed-size dimensions (25 and 5 rows): the
    # planner's own size check (file statistics against
    # spark.sql.autoBroadcastJoinThreshold) broadcasts them, and would fall
    # back to a sort-merge join (AQE re-plans from measured sizes) if not.
    return geo


def _sql_list(values) -> str:
    return "array(" + ", ".join(f"'{v}'" for v in values) + ")"


def _mapped_type_sql() -> str:
    whens = "".join(f" WHEN event_type = '{src}' THEN '{dst}'" for src, dst in SOURCE_TYPE_MAP)
    return ("CASE WHEN event_type = 'signup' AND event_id % 2 = 0 THEN 'order_item_added'"
            f" WHEN event_type = 'signup' THEN 'order_confirmed'{whens} END")


def order_events(spark: SparkSession, sf_dir: str, faults: bool = True) -> DataFrame:
    """Parsed-shape order events (the output shape of ``parse_events``).

    Batch keeps ``event_timestamp`` as TIMESTAMP_NTZ (the driver data type);
    the streaming path casts it to TIMESTAMP for watermarks. The columns are
    SQL expressions: one parse in the JVM instead of hundreds of Python ->
    JVM calls to assemble the same expression trees.
    """
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    geo = geo_dimension(spark, sf_dir)
    df = ev.join(geo, (ev.user_id % NATIONS) == geo.geo_key, "left")

    on = "true" if faults else "false"
    # The mapped type and the message key feed many fields: computed once.
    df = df.selectExpr(
        "*",
        f"{_mapped_type_sql()} AS _mapped",
        "concat('ORD-', CAST(user_id AS STRING), '-', CAST(dayofmonth(ts) AS STRING)) AS _key",
    )
    addressed = "_mapped IN ('order_created', 'order_confirmed')"
    # The items of a row come from the row itself: no join, no grouping.
    total, share = "round(value * 10, 2)", "floor(round(value * 10, 2) * 100 / (event_id % 3 + 1)) / 100"
    items = f"""transform(sequence(0L, event_id % 3), k -> named_struct(
        'product_id', concat('P-', CAST(event_id + k AS STRING)),
        'product_name', CASE WHEN NOT ({on} AND event_id % 139 = 0 AND k = 0) THEN concat('Product ', CAST(event_id + k AS STRING)) END,
        'quantity', CAST(CASE WHEN {on} AND event_id % 137 = 0 AND k = 0 THEN 0 ELSE 1 + (event_id + k) % 4 END AS INT),
        'unit_price', floor({share} * 100 / (1 + (event_id + k) % 4)) / 100,
        'subtotal', CASE WHEN k < event_id % 3 THEN {share} ELSE round({total} - {share} * (event_id % 3), 2) END
            + CASE WHEN {on} AND event_id % 131 = 0 AND k = 0 THEN 1.0D ELSE 0.0D END))"""
    ingest = f"timestamp_micros(unix_micros(CAST(ts AS TIMESTAMP)) + CAST(get_json_object(props, '$.k') AS BIGINT) * {INGEST_LAG_MS_PER_K} * 1000)"
    address = (
        "named_struct('street', concat('Street ', CAST(user_id AS STRING)), 'city', geo_city, "
        "'province', geo_province, 'postal_code', lpad(CAST(user_id % 100000 AS STRING), 5, '0'), 'country', 'ES')"
    )
    payload = f"""named_struct(
        'items', CASE WHEN _mapped = 'order_created' THEN {items} END,
        'total_amount', CASE WHEN {on} AND event_id % 107 = 0 THEN 999999.0D ELSE round(value * 10, 2) END,
        'currency', '{S.CONTRACT_CURRENCY}',
        'shipping_address', CASE WHEN {addressed} THEN {address} END,
        'payment_method', CASE WHEN {addressed}
            THEN element_at({_sql_list(S.PAYMENT_METHODS)}, CAST(user_id % {len(S.PAYMENT_METHODS)} + 1 AS INT)) END,
        'status', CASE WHEN _mapped = 'order_item_added' THEN 'created' ELSE regexp_replace(_mapped, '^order_', '') END,
        'notes', CASE WHEN _mapped = 'order_created' THEN '' END,
        'cancellation_reason', CASE WHEN _mapped = 'order_cancelled' THEN 'customer_request' END,
        'tracking_number', CASE WHEN _mapped = 'order_shipped' THEN concat('ES', lpad(CAST(event_id AS STRING), 9, '0')) END,
        'carrier', CASE WHEN _mapped = 'order_shipped'
            THEN element_at({_sql_list(CARRIERS)}, CAST(event_id % {len(CARRIERS)} + 1 AS INT)) END)"""
    return df.selectExpr(
        "_key AS message_key",
        "CAST(event_id AS STRING) AS event_id",
        f"CASE WHEN {on} AND event_id % 103 = 0 THEN 'bogus' ELSE _mapped END AS event_type",
        f"CASE WHEN {on} AND event_id % 101 = 0 THEN CAST(NULL AS STRING) ELSE _key END AS order_id",
        f"CASE WHEN NOT ({on} AND event_id % 149 = 0) THEN concat('CUST-', lpad(CAST(user_id AS STRING), 6, '0')) END"
        " AS customer_id",
        f"ts + CASE WHEN {on} AND event_id % 109 = 0 THEN INTERVAL 60 DAYS ELSE INTERVAL 0 DAYS END"
        f" - CASE WHEN {on} AND event_id % 113 = 0 THEN INTERVAL 400 DAYS ELSE INTERVAL 0 DAYS END AS event_timestamp",
        f"{payload} AS payload",
        f"'{S.DEFAULT_TOPIC}' AS kafka_topic",
        f"CAST(user_id % {TOPIC_PARTITIONS} AS INT) AS kafka_partition",
        "event_id AS kafka_offset",
        f"CAST({ingest} AS TIMESTAMP_NTZ) AS kafka_timestamp",
        f"CAST({ingest} AS TIMESTAMP_NTZ) AS processing_time",
    )


def raw_messages(spark: SparkSession, sf_dir: str, faults: bool = True) -> DataFrame:
    """Kafka-shaped raw records (key, value, topic, partition, offset,
    timestamp) whose JSON bodies encode ``order_events``.

    Timestamps alternate between the ``+00:00`` and ``Z`` offset forms; with
    faults on, every 127th body is not JSON at all and every 157th timestamp is a
    bare date.
    """
    ev = order_events(spark, sf_dir, faults=faults)
    eid = F.col("kafka_offset")
    text_ts = F.concat(
        F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
        F.when(eid % 2 == 0, F.lit("+00:00")).otherwise(F.lit("Z")),
    )
    text_ts = F.when(F.lit(faults) & (eid % 157 == 0), F.date_format("event_timestamp", "yyyy-MM-dd")).otherwise(text_ts)
    body = F.to_json(
        F.struct(
            F.col("event_id"),
            F.col("event_type"),
            F.col("order_id"),
            F.col("customer_id"),
            text_ts.alias("timestamp"),
            F.col("payload"),
        )
    )
    body = F.when(F.lit(faults) & (eid % 127 == 0), F.concat(F.lit("not-json:"), F.col("event_id"))).otherwise(body)
    return ev.select(
        F.col("message_key").cast("binary").alias("key"),
        body.cast("binary").alias("value"),
        F.col("kafka_topic").alias("topic"),
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
        F.col("kafka_timestamp").cast("timestamp").alias("timestamp"),
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order line with product, quantity, prices.

    product_id = 'P-' || partkey, unit_price = round(extendedprice /
    quantity, 2), subtotal = round(extendedprice, 2).
    """
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice")
    return li.select(
        F.concat(F.lit("ORD-"), F.col("l_orderkey").cast("string")).alias("order_id"),
        F.col("l_linenumber").alias("line_number"),
        F.concat(F.lit("P-"), F.col("l_partkey").cast("string")).alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.round(F.col("l_extendedprice") / F.col("l_quantity"), 2).alias("unit_price"),
        F.round(F.col("l_extendedprice"), 2).alias("subtotal"),
    )


def order_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One order_created header per order: order_id, customer_id, total, time.
    The total is the sum of the order's lines, but 1 too high where the order
    number is a multiple of 97; an order without lines keeps its own total."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    sums = order_lines(spark, sf_dir).groupBy("order_id").agg(F.round(F.sum("subtotal"), 2).alias("lines_total"))
    key = F.concat(F.lit("ORD-"), F.col("o_orderkey").cast("string"))
    wrong = F.when(F.col("o_orderkey") % 97 == 0, 1.0).otherwise(0.0)
    return o.withColumn("order_id", key).join(sums, "order_id", "left").select(
        "order_id",
        F.concat(F.lit("CUST-"), F.lpad(F.col("o_custkey").cast("string"), 6, "0")).alias("customer_id"),
        F.round(F.coalesce(F.col("lines_total") + wrong, "o_totalprice"), 2).alias("total_amount"),
        F.col("o_orderdate").alias("event_timestamp"),
    )


def desk_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """order_created events of the ``orders`` table as its customers' market
    segments place them: one desk a segment is the customer, so several orders
    fall on one instant (a day's midnight). Orders whose number is a multiple
    of 7 are created again two minutes later."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return o.join(c, o.o_custkey == c.c_custkey).selectExpr(
        "concat('DESK-', c_mktsegment) AS customer_id", "concat('ORD-', CAST(o_orderkey AS STRING)) AS order_id",
        "'order_created' AS event_type", "o_orderkey", "o_orderdate",
        "explode(sequence(0, CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END)) AS again",
    ).selectExpr(
        "customer_id", "order_id", "event_type", "concat(order_id, '-', CAST(again AS STRING)) AS event_id",
        "o_orderdate + make_interval(0, 0, 0, 0, 0, 2 * again, 0) AS event_timestamp")


def write_raw_files(spark: SparkSession, sf_dir: str, path: str, faults: bool = True) -> str:
    """Write ``raw_messages`` as Parquet files under ``path``, for a file stream.
    Row groups are small, so that several tasks can read (and parse) a file."""
    raw_messages(spark, sf_dir, faults=faults).write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    return path
