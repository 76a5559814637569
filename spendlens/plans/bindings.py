"""The driver's tables read as the offer domain.

Each view is portable SQL over the raw tables (or over other views), so the same text defines the
input of a query in Spark and in the SQL check. Views map columns; every one of them covers its
source tables whole.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

RAW = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)

VIEWS = {
    # ---- dimensions
    "category": """
        SELECT r_regionkey AS category_id,
               CASE r_regionkey WHEN 0 THEN 'dining' WHEN 1 THEN 'retail' WHEN 2 THEN 'travel'
                                WHEN 3 THEN 'luxury' ELSE 'grocery' END AS category_name
        FROM {region}""",
    "merchant": """
        SELECT s.s_suppkey AS merchant_id, s.s_name AS merchant_name, n.n_regionkey AS category_id,
               s.s_nationkey AS location_id,
               CAST(15 + 10 * (s.s_suppkey % 6) AS DOUBLE) / 100 AS merchant_margin_rate,
               CAST(10 + s.s_suppkey % 26 AS DOUBLE) / 1000 AS platform_fee_rate
        FROM {supplier} s JOIN {nation} n ON s.s_nationkey = n.n_nationkey""",
    "campaign": """
        SELECT p_type AS campaign_id, concat('Campaign ', p_type) AS campaign_name,
               DATE '2024-01-01' AS campaign_start_date, DATE '2024-12-31' AS campaign_end_date,
               CAST(sum(p_size) AS BIGINT) AS campaign_weight
        FROM {part} GROUP BY p_type""",
    "offer": """
        SELECT p_partkey AS offer_id, p_type AS campaign_id,
               CAST(substr(p_brand, 7) AS BIGINT) % (SELECT max(s_suppkey) + 1 FROM {supplier}) AS merchant_id,
               CASE WHEN p_size % 2 = 0 THEN 'fixed_cashback' ELSE 'percent_cashback' END AS offer_type,
               CAST(p_size AS DOUBLE) AS minimum_spend_amount,
               CASE WHEN p_size % 2 = 0 THEN CAST(5 * (1 + p_size % 7) AS DOUBLE) ELSE CAST(0 AS DOUBLE) END
                 AS reward_amount,
               CAST(5 + p_size % 11 AS DOUBLE) / 100 AS reward_multiplier,
               CAST(10 + p_size AS DOUBLE) AS max_reward_amount,
               CASE p_size % 5 WHEN 0 THEN 'draft' WHEN 1 THEN 'expired' ELSE 'active' END AS offer_status,
               DATE '2024-01-01' AS offer_start_date, DATE '2024-12-31' AS offer_end_date
        FROM {part}""",
    "order_history": """
        SELECT o_custkey, count(*) AS n_orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS spend
        FROM {orders} GROUP BY o_custkey""",
    "card": """
        SELECT c.c_custkey AS tokenized_cardmember_id, c.c_mktsegment AS segment_id, c.c_nationkey AS location_id,
               coalesce(h.spend, CAST(0 AS DOUBLE)) AS historical_spend_90d,
               coalesce(h.n_orders, 0) AS historical_transaction_count_90d,
               c.c_acctbal AS balance, c.c_acctbal >= 0 AS is_test_eligible, c.c_acctbal < 9000 AS is_control_eligible,
               CASE WHEN c.c_custkey % 10 < 7 THEN 'test' WHEN c.c_custkey % 10 < 9 THEN 'control' ELSE 'holdout' END
                 AS assignment_group
        FROM {customer} c LEFT JOIN {order_history} h ON c.c_custkey = h.o_custkey""",
    "consent": """
        SELECT c_custkey AS consent_id, c_custkey AS tokenized_cardmember_id,
               c_acctbal > -500 AS analytics_consent_flag, c_nationkey <> 7 AS merchant_reporting_consent_flag
        FROM {customer}""",
    "risk_rule": """
        SELECT concat('rule_', p_type) AS risk_rule_id,
               CASE p_type WHEN 'ECONOMY' THEN 'duplicate_redemption' WHEN 'LARGE' THEN 'refund_after_reward'
                           WHEN 'MEDIUM' THEN 'high_redemption_velocity' WHEN 'PROMO' THEN 'merchant_location_anomaly'
                           ELSE 'reward_gaming_pattern' END AS risk_rule_name,
               lower(p_type) AS risk_category,
               CASE p_type WHEN 'LARGE' THEN 'critical' WHEN 'MEDIUM' THEN 'medium' ELSE 'high' END AS severity,
               concat('Rule of ', p_type) AS risk_rule_description, p_type <> 'SMALL' AS is_active
        FROM {part} GROUP BY p_type""",
    # ---- offer interactions and purchases, from the event stream (k is the product of an event)
    "event": """
        SELECT event_id, user_id, event_type, ts, CAST(ts AS DATE) AS event_day, value,
               CAST(substr(props, 7, length(props) - 7) AS BIGINT) AS k
        FROM {events}""",
    "tx": """
        SELECT e.event_id AS transaction_id, e.user_id AS tokenized_cardmember_id, o.merchant_id,
               e.ts AS transaction_timestamp, e.event_day AS transaction_date, e.value AS transaction_amount,
               CASE e.event_type WHEN 'purchase' THEN 'settled' ELSE 'refunded' END AS transaction_status
        FROM {event} e JOIN {offer} o ON e.k = o.offer_id WHERE e.event_type IN ('purchase', 'error')""",
    "act": """
        SELECT event_id AS activation_id, user_id AS tokenized_cardmember_id, k AS offer_id,
               ts AS activation_timestamp, event_day AS activation_date,
               ts + INTERVAL '30' DAY AS offer_expiry_timestamp,
               CASE WHEN value >= 100 THEN 'Expired' ELSE 'Active' END AS activation_status
        FROM {event} WHERE event_type = 'click'""",
    "imp": """
        SELECT e.event_id AS impression_id, e.user_id AS tokenized_cardmember_id, e.k AS offer_id, o.campaign_id,
               o.merchant_id, e.ts AS impression_timestamp, e.event_day AS impression_date
        FROM {event} e JOIN {offer} o ON e.k = o.offer_id WHERE e.event_type = 'view'""",
    "assignment": """
        SELECT event_id AS assignment_id, user_id AS tokenized_cardmember_id, k AS offer_id,
               CASE WHEN user_id % 10 < 7 THEN 'test' WHEN user_id % 10 < 9 THEN 'control' ELSE 'holdout' END
                 AS assignment_group,
               event_day AS assignment_date
        FROM {event} WHERE event_type = 'signup'""",
    # ---- test and control purchases, from orders and their lines
    "li": """
        SELECT l.l_orderkey * 8 + l.l_linenumber AS line_id, l.l_orderkey AS transaction_id,
               o.o_custkey AS tokenized_cardmember_id, l.l_suppkey AS merchant_id, l.l_suppkey AS offer_id,
               p.p_type AS campaign_id, make_date(year(CAST(l.l_shipdate AS DATE)), month(CAST(l.l_shipdate AS DATE)), 1)
                 AS transaction_date,
               l.l_shipdate AS ship_time, l.l_extendedprice AS transaction_amount,
               CAST(floor(l.l_extendedprice * l.l_discount) AS DOUBLE) AS calculated_reward_amount,
               l.l_returnflag, l.l_linestatus,
               CASE WHEN o.o_custkey % 10 < 7 THEN 'test' WHEN o.o_custkey % 10 < 9 THEN 'control'
                    ELSE 'holdout' END AS assignment_group
        FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey JOIN {part} p ON l.l_partkey = p.p_partkey""",
    "history": """
        SELECT l.l_orderkey AS transaction_id, o.o_custkey AS tokenized_cardmember_id, l.l_suppkey AS merchant_id,
               m.category_id, CAST(o.o_orderdate AS DATE) AS transaction_date, l.l_extendedprice AS transaction_amount,
               CAST(o.o_orderdate AS DATE) >= DATE '2001-01-01' AND CAST(o.o_orderdate AS DATE) < DATE '2001-04-01' AS recent
        FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey
             LEFT JOIN {merchant} m ON l.l_suppkey = m.merchant_id""",
    "test": """
        SELECT line_id AS matched_redemption_id, transaction_id, tokenized_cardmember_id, merchant_id, offer_id,
               campaign_id, transaction_date, transaction_amount, calculated_reward_amount
        FROM {li} WHERE assignment_group = 'test'""",
    "control": """
        SELECT line_id AS control_transaction_id, transaction_id, tokenized_cardmember_id, merchant_id, offer_id,
               campaign_id, transaction_date, transaction_amount
        FROM {li} WHERE assignment_group = 'control'""",
    "cell_offer": """
        SELECT merchant_id AS offer_id, campaign_id, merchant_id,
               min(transaction_amount) AS minimum_spend_amount, max(calculated_reward_amount) AS reward_amount
        FROM {li} GROUP BY merchant_id, campaign_id""",
    # ---- raw text form of purchases, with values that do not parse
    "raw_tx": """
        SELECT event_id AS transaction_id, user_id AS tokenized_cardmember_id, k AS merchant_id,
               CASE WHEN event_type = 'signup' THEN 'unknown' ELSE CAST(ts AS STRING) END AS transaction_timestamp,
               CAST(event_day AS STRING) AS transaction_date,
               CASE WHEN event_type = 'error' THEN 'n/a' WHEN event_type = 'view' THEN concat('-', CAST(k AS STRING))
                    ELSE CAST(CAST(value AS DECIMAL(18,2)) AS STRING) END AS transaction_amount,
               event_type AS transaction_status
        FROM {event}""",
    # ---- a feed with lost keys and copies, a feed of redemptions, and terms that overlap and leave gaps
    "raw_feed": """
        SELECT concat(CAST(event_id AS STRING), '/', CAST(copy AS STRING)) AS line,
               concat(CAST(event_id AS STRING), '/', CAST(copy AS STRING)) AS source_line,
               CASE WHEN event_id % 50 = 7 THEN NULL ELSE event_id END AS transaction_id, user_id AS tokenized_cardmember_id,
               CASE WHEN event_type = 'signup' THEN 'unknown' ELSE CAST(ts AS STRING) END AS transaction_timestamp,
               CAST(event_day AS STRING) AS transaction_date,
               CASE WHEN event_type = 'error' THEN 'n/a' WHEN event_type = 'view' THEN NULL
                    ELSE CAST(CAST(value AS DECIMAL(18,2)) AS STRING) END AS transaction_amount
        FROM (SELECT *, 1 AS copy FROM {event} UNION ALL SELECT *, 2 AS copy FROM {event} WHERE event_id % 3 = 0)""",
    "redemption_feed": """
        SELECT event_id AS transaction_id, user_id AS tokenized_cardmember_id, k AS offer_id, ts AS transaction_timestamp,
               event_day AS transaction_date
        FROM {event} WHERE event_type IN ('purchase', 'click')""",
    "lease": """
        SELECT o_custkey AS member_id, CAST(o_orderdate AS DATE) AS effective_start_date,
               CASE WHEN o_orderkey % 211 = 0 THEN NULL
                    ELSE CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 500 AS INTEGER) AS DATE) END AS effective_end_date
        FROM {orders}""",
    # ---- two states of the merchant dimension and of the customer dimension
    "merchant_v2": """
        SELECT merchant_id, merchant_name, category_id, location_id,
               CASE WHEN location_id < 12 THEN merchant_margin_rate + CAST(1 AS DOUBLE) / 8
                    ELSE merchant_margin_rate END AS merchant_margin_rate, platform_fee_rate
        FROM {merchant}""",
    "member_v1": """
        SELECT c_custkey AS member_id, c_name AS member_name, c_nationkey AS location_id, c_mktsegment AS segment_id
        FROM {customer} WHERE c_acctbal >= 0""",
    "member_v2": """
        SELECT c.c_custkey AS member_id, c.c_name AS member_name, c.c_nationkey AS location_id,
               CASE WHEN h.n_orders > 12 THEN 'VIP' ELSE c.c_mktsegment END AS segment_id
        FROM {customer} c LEFT JOIN {order_history} h ON c.c_custkey = h.o_custkey WHERE c.c_nationkey <> 3""",
    # ---- supplemental purchases that lack some columns, and control purchases with the rest
    "tx_full": """
        SELECT t.transaction_id, t.tokenized_cardmember_id, t.merchant_id, m.category_id, m.location_id,
               t.transaction_timestamp, t.transaction_date, t.transaction_amount, t.transaction_status,
               c.segment_id AS shopper_behavior_type, c.segment_id, false AS is_test_group, false AS is_control_group
        FROM {tx} t JOIN {merchant} m ON t.merchant_id = m.merchant_id
             JOIN {card} c ON t.tokenized_cardmember_id = c.tokenized_cardmember_id""",
    "supplement": """
        SELECT activation_id AS transaction_id, tokenized_cardmember_id, offer_id AS merchant_id,
               activation_timestamp AS transaction_timestamp, activation_date AS transaction_date,
               CAST(offer_id AS DOUBLE) AS transaction_amount, 'settled' AS transaction_status
        FROM {act}""",
    "control_event": """
        SELECT i.impression_id AS transaction_id, i.tokenized_cardmember_id, i.merchant_id,
               i.impression_timestamp AS transaction_timestamp, i.impression_date AS transaction_date,
               CAST(i.offer_id AS DOUBLE) AS transaction_amount, c.segment_id AS shopper_behavior_type, c.segment_id
        FROM {imp} i JOIN {card} c ON i.tokenized_cardmember_id = c.tokenized_cardmember_id""",
}

_REF = re.compile(r"{([a-z]\w*)}")


_SCHEMAS: dict[str, StructType] = {}


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Scan with the schema found on the first read, which saves a footer job on each later one."""
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


class Domain:
    """Lazy access to the raw tables and views of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._made: dict[str, DataFrame] = {}

    def shared(self, name: str, build):
        """Build an intermediate result once."""
        key = f"shared {name}"
        if key not in self._made:
            self._made[key] = build()
        return self._made[key]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._made:
            if name in RAW:
                self._made[name] = read_parquet(self.spark, f"{self.folder}/{name}.parquet")
            elif name in VIEWS:
                refs = dict.fromkeys(_REF.findall(VIEWS[name]))
                self._made[name] = self.spark.sql(VIEWS[name], **{r: getattr(self, r) for r in refs})
            else:
                raise AttributeError(name)
        return self._made[name]


def with_views(sql: str, extra: dict[str, str] | None = None) -> str:
    """Prefix a query with the views it uses, as common table expressions."""
    texts = {**VIEWS, **(extra or {})}
    order: list[str] = []

    def visit(text: str) -> None:
        for ref in dict.fromkeys(_REF.findall(text)):
            if ref in texts and ref not in order:
                visit(texts[ref])
                order.append(ref)

    visit(sql)
    plain = {name: _REF.sub(lambda m: m.group(1) if m.group(1) in RAW else f"v_{m.group(1)}", texts[name])
             for name in order}
    body = _REF.sub(lambda m: m.group(1) if m.group(1) in RAW else f"v_{m.group(1)}", sql)
    if body.lstrip().upper().startswith("WITH"):
        body = f"SELECT * FROM ({body})"
    head = ", ".join(f"v_{name} AS ({text})" for name, text in plain.items())
    return f"WITH {head} {body}" if head else body
