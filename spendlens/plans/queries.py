"""Query catalogue: every operator over the driver's tables, with the SQL it is checked against."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.exprs import derive, fingerprint, money_sum
from ..operators import abuse, assignment, cleaning, eligibility, experiment, finance, lineage, marts, matching, privacy
from ..operators import incrementality as inc
from ..operators import profiling, quality, risk, scd
from ..sources import lake
from ..sources.contracts import CELL, RELATIONS, SCD_METADATA, ScdSpec, TableSpec
from .bindings import Domain, with_views
from .checksql import STEPS, checks, hashed, image, mavg, msum, pos

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CHECK_SQL: dict[str, str] = {}
RUN = "run"


def query(sql: str | None):
    """Register a function of the domain under its name, with its SQL (None: no SQL form)."""

    def register(fn: Callable[[Domain], DataFrame]):
        @wraps(fn)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Domain(spark, folder))

        QUERIES[fn.__name__] = run
        if sql is not None:
            CHECK_SQL[fn.__name__] = with_views(sql, STEPS)
        return fn

    return register


def once(fn: Callable[[Domain], DataFrame]) -> Callable[[Domain], DataFrame]:
    """An intermediate result that several parts of one query share is built once per domain."""

    @wraps(fn)
    def shared(d: Domain):
        return d.shared(fn.__name__, lambda: fn(d))

    return shared


def cell_key(*more: str) -> str:
    return ", ".join((*CELL, *more))


CELL_SQL = cell_key()

# ============================================================== bronze and silver


@query(f"""SELECT o_orderkey, 'orders' AS source_table_name,
       {image('', 'o_orderkey', 'o_custkey', 'o_orderstatus', 'o_totalprice', 'o_orderdate', 'o_orderpriority')}
       AS record_hash FROM {{orders}}""")
def bronze_fingerprint(d):
    return lake.add_source_columns(d.orders, "orders", RUN).select("o_orderkey", "source_table_name", "record_hash")


@query("""SELECT c_custkey, sha256(concat(length(CAST(c_custkey AS VARCHAR)), ':', c_custkey, length(c_name), ':', c_name,
       length(c_mktsegment), ':', c_mktsegment)) AS record_hash FROM {customer}""")
def bronze_fingerprint_prefixed(d):
    return d.customer.select(
        "c_custkey", fingerprint(["c_custkey", "c_name", "c_mktsegment"], length_prefixed=True).alias("record_hash")
    )


@query("""SELECT * FROM {lineitem} QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
       ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
       l_shipdate) = 1""")
def silver_dedupe(d):
    return cleaning.first_per_key(d.lineitem, ["l_orderkey", "l_linenumber"])


RAW_TX = TableSpec(
    "fact_transactions", "transaction_id", "", timestamps=("transaction_timestamp",), dates=("transaction_date",),
    numerics=("transaction_amount",),
)
CAST_SQL = """SELECT transaction_id, tokenized_cardmember_id, merchant_id,
    TRY_CAST(transaction_timestamp AS TIMESTAMP) AS transaction_timestamp,
    TRY_CAST(transaction_date AS DATE) AS transaction_date, TRY_CAST(transaction_amount AS DOUBLE) AS transaction_amount,
    transaction_status FROM {raw_tx}"""


def zoneless(df: DataFrame) -> DataFrame:
    return df.withColumn("transaction_timestamp", F.col("transaction_timestamp").cast("timestamp_ntz"))


@query(CAST_SQL)
def silver_cast_dates(d):
    return zoneless(cleaning.clean(d.raw_tx, RAW_TX))


@query(f"""SELECT * FROM ({CAST_SQL}) WHERE transaction_amount >= 0 AND transaction_timestamp IS NOT NULL
       AND transaction_date IS NOT NULL AND merchant_id IS NOT NULL""")
def silver_strict(d):
    needed = ("transaction_id", "tokenized_cardmember_id", "merchant_id", "transaction_amount",
              "transaction_timestamp", "transaction_date")
    return zoneless(cleaning.clean_strict(d.raw_tx, RAW_TX, needed, ["transaction_amount"]))


ROW_RULES = (
    cleaning.RowRule("E01", "transaction_amount is not a number", "try_cast(transaction_amount AS DOUBLE) IS NULL"),
    cleaning.RowRule("E02", "transaction_amount is negative", "try_cast(transaction_amount AS DOUBLE) < 0"),
    cleaning.RowRule("E03", "transaction_timestamp does not parse",
                     "try_cast(transaction_timestamp AS TIMESTAMP) IS NULL"),
    cleaning.RowRule("E04", "transaction_date differs from the timestamp",
                     "to_date(try_cast(transaction_timestamp AS TIMESTAMP)) <> try_cast(transaction_date AS DATE)"),
    cleaning.RowRule("E05", "transaction_status is not accepted",
                     "transaction_status NOT IN ('purchase', 'click', 'error', 'view')"),
)


@query("""SELECT 'raw_tx' AS source_table_name, transaction_id, code AS validation_error_code,
       message AS validation_error_message FROM (
       SELECT transaction_id, 'E01' AS code, 'transaction_amount is not a number' AS message FROM {raw_tx}
         WHERE TRY_CAST(transaction_amount AS DOUBLE) IS NULL
       UNION ALL SELECT transaction_id, 'E02', 'transaction_amount is negative' FROM {raw_tx}
         WHERE TRY_CAST(transaction_amount AS DOUBLE) < 0
       UNION ALL SELECT transaction_id, 'E03', 'transaction_timestamp does not parse' FROM {raw_tx}
         WHERE TRY_CAST(transaction_timestamp AS TIMESTAMP) IS NULL
       UNION ALL SELECT transaction_id, 'E04', 'transaction_date differs from the timestamp' FROM {raw_tx}
         WHERE CAST(TRY_CAST(transaction_timestamp AS TIMESTAMP) AS DATE) <> TRY_CAST(transaction_date AS DATE)
       UNION ALL SELECT transaction_id, 'E05', 'transaction_status is not accepted' FROM {raw_tx}
         WHERE transaction_status NOT IN ('purchase', 'click', 'error', 'view'))""")
def quarantine(d):
    bad = cleaning.quarantined(d.raw_tx, ROW_RULES, "raw_tx", RUN, "events")
    ident = F.get_json_object("record_payload", "$.transaction_id").cast("bigint").alias("transaction_id")
    return bad.select("source_table_name", ident, "validation_error_code", "validation_error_message")


@query("""SELECT * FROM {raw_tx} WHERE TRY_CAST(transaction_amount AS DOUBLE) >= 0
       AND CAST(TRY_CAST(transaction_timestamp AS TIMESTAMP) AS DATE) = TRY_CAST(transaction_date AS DATE)
       AND transaction_status IN ('purchase', 'click', 'error', 'view')""")
def accepted_rows(d):
    return cleaning.accepted(d.raw_tx, ROW_RULES)


@query("""SELECT 'orders/' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS source_file_path,
       count(DISTINCT o_orderpriority) AS run_count, count(*) AS row_count
       FROM {orders} GROUP BY 1 HAVING count(DISTINCT o_orderpriority) > 1""")
def repeated_source_files(d):
    log = d.orders.select(
        F.concat(F.lit("orders/"), F.col("o_orderdate").cast("date").cast("string")).alias("source_file_path"),
        F.col("o_orderpriority").alias("pipeline_run_id"),
    )
    return lake.repeated_files(log)


@query("""SELECT o_orderkey, 'orders/' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS source_file_path FROM {orders}
       WHERE CAST(o_orderdate AS DATE) NOT IN (SELECT CAST(l_shipdate AS DATE) FROM {lineitem} WHERE l_linestatus = 'F'
       AND l_returnflag = 'A' AND l_tax = 0)""")
def unseen_source_files(d):
    def path(column: str):
        day = F.col(column).cast("date").cast("string")
        return F.concat(F.lit("orders/"), day).alias("source_file_path")

    done = d.lineitem.filter("l_linestatus = 'F' AND l_returnflag = 'A' AND l_tax = 0").select(path("l_shipdate"))
    return lake.unseen_files(d.orders.select("o_orderkey", path("o_orderdate")), done)


@query("""SELECT 'orders' AS table_name, count(*) AS row_count FROM {orders}
       UNION ALL SELECT 'lineitem', count(*) FROM {lineitem} UNION ALL SELECT 'events', count(*) FROM {events}""")
def table_rows(d):
    tables = {"orders": d.orders, "lineitem": d.lineitem, "events": d.events}
    return lake.table_profile(tables).select("table_name", "row_count")


@query("""SELECT 'lineitem' AS table_name, (SELECT count(*) FROM {lineitem}) AS source_rows,
       (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM {lineitem})) AS target_rows,
       'passed' AS status""")
def layer_counts(d):
    raw = d.lineitem.withColumn("line_id", F.col("l_orderkey") * 8 + F.col("l_linenumber"))
    clean = cleaning.clean(raw, TableSpec("lineitem", "line_id", ""))
    return quality.row_counts_agree({"lineitem": raw}, {"lineitem": clean}, at_most=True)


# ============================================================== eligibility and set operations


@query("""SELECT c.tokenized_cardmember_id, c.segment_id, p.consent_id FROM {card} c
       JOIN {consent} p USING (tokenized_cardmember_id)
       WHERE p.analytics_consent_flag AND p.merchant_reporting_consent_flag""")
def consent_eligible(d):
    pool = eligibility.consenting_cardmembers(d.card, d.consent)
    return pool.select("tokenized_cardmember_id", "segment_id", "consent_id")


@query("""SELECT o.offer_id, o.offer_status, o.campaign_id, c.campaign_name FROM {offer} o
       LEFT JOIN {campaign} c USING (campaign_id) WHERE o.offer_status IN ('active', 'expired')""")
def offer_pool(d):
    return eligibility.offer_pool(d.offer, d.campaign).select("offer_id", "offer_status", "campaign_id", "campaign_name")


STATUS_SQL = """SELECT a.assignment_id, a.tokenized_cardmember_id, a.assignment_group,
       CASE WHEN a.assignment_group = 'test' AND NOT coalesce(c.is_test_eligible, false) THEN 'ineligible'
            WHEN a.assignment_group = 'control' AND NOT coalesce(c.is_control_eligible, false) THEN 'ineligible'
            ELSE 'eligible' END AS assignment_status
       FROM {assignment} a LEFT JOIN {card} c USING (tokenized_cardmember_id)"""
STATUS_COLUMNS = ("assignment_id", "tokenized_cardmember_id", "assignment_group", "assignment_status")


@query(STATUS_SQL)
def assignment_status(d):
    return eligibility.with_assignment_status(d.assignment, d.card).select(*STATUS_COLUMNS)


@query(f"SELECT * FROM ({STATUS_SQL}) WHERE assignment_group = 'test' AND assignment_status = 'eligible'")
def eligible_test(d):
    return eligibility.eligible_group(eligibility.with_assignment_status(d.assignment, d.card), "test").select(
        *STATUS_COLUMNS)


@query(f"SELECT * FROM ({STATUS_SQL}) WHERE assignment_group = 'control' AND assignment_status = 'eligible'")
def eligible_control(d):
    return eligibility.eligible_group(eligibility.with_assignment_status(d.assignment, d.card), "control").select(
        *STATUS_COLUMNS)


@query("SELECT * FROM {risk_rule} WHERE is_active")
def active_risk_rules(d):
    return eligibility.active_rules(d.risk_rule)


@query("""SELECT m.merchant_id, m.merchant_name, m.category_id, c.category_name FROM {merchant} m
       LEFT JOIN {category} c USING (category_id)""")
def merchant_category(d):
    joined = d.merchant.join(matching.small_side(d.category), "category_id", "left")
    return joined.select("merchant_id", "merchant_name", "category_id", "category_name")


FULL = """transaction_id, tokenized_cardmember_id, merchant_id, category_id, location_id, transaction_timestamp,
       transaction_date, transaction_amount, transaction_status, shopper_behavior_type, segment_id, is_test_group,
       is_control_group"""


@query(f"""SELECT {FULL} FROM {{tx_full}} UNION ALL SELECT transaction_id, tokenized_cardmember_id, merchant_id, NULL,
       NULL, transaction_timestamp, transaction_date, transaction_amount, transaction_status, NULL, NULL, true, false
       FROM {{supplement}}""")
def supplemental_union(d):
    flags = {"is_test_group": F.lit(True), "is_control_group": F.lit(False)}
    return cleaning.append_rows(d.tx_full, d.supplement, flags)


CONTROL_TX = """SELECT e.transaction_id, e.tokenized_cardmember_id, e.merchant_id, m.category_id, m.location_id,
       e.transaction_timestamp, e.transaction_date, e.transaction_amount, 'settled' AS transaction_status,
       e.shopper_behavior_type, e.segment_id, false AS is_test_group, true AS is_control_group
       FROM {control_event} e LEFT JOIN {merchant} m USING (merchant_id)"""


@query(CONTROL_TX)
def control_to_tx(d):
    return cleaning.control_as_transactions(d.control_event, d.merchant)


@query(f"SELECT {FULL} FROM {{tx_full}} UNION ALL {CONTROL_TX}")
def transactions_with_control(d):
    return cleaning.append_rows(d.tx_full, cleaning.control_as_transactions(d.control_event, d.merchant))


# ============================================================== versioned dimensions

MERCHANT_SCD = ScdSpec(
    "dim_merchant_clean", "dim_merchant_scd", "merchant_id",
    ("merchant_name", "category_id", "location_id", "merchant_margin_rate", "platform_fee_rate"),
)
OFFER_SCD = ScdSpec(
    "dim_offer_clean", "dim_offer_scd", "offer_id",
    ("campaign_id", "merchant_id", "minimum_spend_amount", "reward_amount", "offer_start_date", "offer_end_date"),
)
CAMPAIGN_SCD = ScdSpec(
    "dim_campaign_clean", "dim_campaign_scd", "campaign_id",
    ("campaign_name", "campaign_start_date", "campaign_end_date"),
)
MEMBER_SCD = ScdSpec("members", "members_scd", "member_id", ("member_name", "location_id", "segment_id"))


def scd_shape(df: DataFrame, spec: ScdSpec) -> DataFrame:
    """Without run id, rule version and clock columns."""
    return df.select("surrogate_scd_id", spec.key, *spec.tracked, *SCD_METADATA[:4])


def snapshot_sql(spec: ScdSpec, view: str, start: str) -> str:
    tracked = ", ".join(spec.tracked)
    return f"""SELECT 'scd_' || sha256(concat_ws('||', CAST({spec.key} AS VARCHAR), '{start}', h)) AS surrogate_scd_id,
       {spec.key}, {tracked}, DATE '{start}' AS effective_start_date, CAST(NULL AS DATE) AS effective_end_date,
       true AS is_current, h AS scd_record_hash
       FROM (SELECT *, {image('__NULL__', *spec.tracked)} AS h FROM {{{view}}})"""


@query(snapshot_sql(MERCHANT_SCD, "merchant", "2026-01-01"))
def scd_snapshot_merchant(d):
    return scd_shape(scd.first_snapshot(d.merchant, MERCHANT_SCD, RUN), MERCHANT_SCD)


@query(snapshot_sql(OFFER_SCD, "offer", "2026-01-01"))
def scd_snapshot_offer(d):
    return scd_shape(scd.first_snapshot(d.offer, OFFER_SCD, RUN), OFFER_SCD)


@query(snapshot_sql(CAMPAIGN_SCD, "campaign", "2026-01-01"))
def scd_snapshot_campaign(d):
    return scd_shape(scd.first_snapshot(d.campaign, CAMPAIGN_SCD, RUN), CAMPAIGN_SCD)


@once
def merchant_history(d: Domain) -> DataFrame:
    first = scd.first_snapshot(d.merchant, MERCHANT_SCD, RUN, start="1995-01-01")
    return scd.merge(first, d.merchant_v2, MERCHANT_SCD, "1998-06-01", RUN)


@query("SELECT * FROM {scd_state}")
def scd2_merge_merchant(d):
    return scd_shape(merchant_history(d), MERCHANT_SCD)


@query("SELECT * FROM {scd_state} WHERE is_current")
def current_scd_rows(d):
    return scd_shape(scd.current_rows(merchant_history(d)), MERCHANT_SCD)


@query(f"""WITH o AS (SELECT *, {image('__NULL__', *MEMBER_SCD.tracked)} AS h FROM {{member_v1}}),
       n AS (SELECT *, {image('__NULL__', *MEMBER_SCD.tracked)} AS h FROM {{member_v2}})
       SELECT 'scd_' || sha256(concat_ws('||', CAST(member_id AS VARCHAR), CAST(effective_start_date AS VARCHAR), h))
              AS surrogate_scd_id, member_id, member_name, location_id, segment_id, effective_start_date,
              effective_end_date, effective_end_date IS NULL AS is_current, h AS scd_record_hash
       FROM (SELECT o.*, DATE '2026-01-01' AS effective_start_date, CASE WHEN o.h IS DISTINCT FROM n.h
                    THEN DATE '2026-06-30' END AS effective_end_date
             FROM o LEFT JOIN n USING (member_id)
             UNION ALL SELECT n.*, DATE '2026-07-01', NULL FROM n LEFT JOIN o USING (member_id)
             WHERE o.h IS DISTINCT FROM n.h)""")
def scd2_merge_members(d):
    first = scd.first_snapshot(d.member_v1, MEMBER_SCD, RUN)
    return scd_shape(scd.merge(first, d.member_v2, MEMBER_SCD, "2026-07-01", RUN, close_missing=True), MEMBER_SCD)


@query("""SELECT l.line_id, l.transaction_id, l.merchant_id, CAST(l.ship_time AS DATE) AS ship_date,
       s.merchant_margin_rate, s.platform_fee_rate
       FROM {li} l LEFT JOIN {scd_state} s ON l.merchant_id = s.merchant_id
        AND CAST(l.ship_time AS DATE) >= s.effective_start_date
        AND (s.effective_end_date IS NULL OR CAST(l.ship_time AS DATE) <= s.effective_end_date)""")
def pit_join(d):
    facts = d.li.select("line_id", "transaction_id", "merchant_id", F.col("ship_time").cast("date").alias("ship_date"))
    rates = ("merchant_margin_rate", "platform_fee_rate")
    return scd.as_of_join(facts, merchant_history(d), "merchant_id", "ship_date", rates)


# ============================================================== matching


@once
def ready(d: Domain) -> tuple[DataFrame, DataFrame]:
    act = matching.activation_offers(matching.match_ready_activations(d.act), matching.offer_rules(d.offer))
    return matching.match_ready_transactions(d.tx), act


@once
def matched(d: Domain) -> DataFrame:
    return matching.match_redemptions(d.tx, d.act, d.offer, RUN)


MATCH_SHAPE = """matched_redemption_id, transaction_id, activation_id, offer_id, campaign_id, merchant_id,
       tokenized_cardmember_id, transaction_timestamp, transaction_date, transaction_amount, activation_timestamp,
       offer_expiry_timestamp, minimum_spend_amount, reward_amount, calculated_reward_amount"""
MATCH_LIST = tuple(MATCH_SHAPE.replace("\n", " ").replace(" ", "").split(","))
REASON = f"'{matching.CHOICE_REASON}' AS match_deduplication_reason, '{matching.MATCH_RULES}' AS match_rule_version"


@query("SELECT * FROM {ready_tx}")
def match_ready_tx(d):
    return matching.match_ready_transactions(d.tx)


@query("SELECT * FROM {ready_act}")
def match_ready_act(d):
    return matching.match_ready_activations(d.act)


@query("SELECT * FROM {rules}")
def offer_rules(d):
    return matching.offer_rules(d.offer)


@query("SELECT * FROM {act_offer}")
def activation_offer_join(d):
    return ready(d)[1]


@query("SELECT * FROM {pairs}")
def range_join_candidates(d):
    return matching.candidates(*ready(d))


@query("SELECT * FROM {pairs}")
def range_join_merge(d):
    return matching.candidates(*ready(d), strategy="merge")


@query("SELECT * FROM {pairs}")
def range_join_broadcast(d):
    return matching.candidates(*ready(d), strategy="broadcast")


@query("""SELECT a.*, o.offer_type, o.minimum_spend_amount, o.reward_amount, o.reward_multiplier, o.max_reward_amount,
       o.offer_status FROM {act} a LEFT JOIN {offer} o USING (offer_id)""")
def activation_terms(d):
    return matching.activation_terms(d.act, d.offer)


@query(" UNION ALL ".join(f"""(SELECT '{label}' AS key_name, CAST({key} AS VARCHAR) AS key_value, count(*) AS row_count
       FROM {{{view}}} GROUP BY {key} ORDER BY row_count DESC, {key} LIMIT 10)""" for label, view, key in (
       ("transaction_card", "ready_tx", "tokenized_cardmember_id"), ("transaction_merchant", "ready_tx", "merchant_id"),
       ("activation_offer", "ready_act", "offer_id"))))
def join_heavy_keys(d):
    tx, act = matching.match_ready_transactions(d.tx), matching.match_ready_activations(d.act)
    return profiling.heavy_keys({
        "transaction_card": (tx, "tokenized_cardmember_id"), "transaction_merchant": (tx, "merchant_id"),
        "activation_offer": (act, "offer_id")})


@query(f"""SELECT {hashed('mred_', 'transaction_id', 'activation_id', 'offer_id')} AS matched_redemption_id,
       transaction_id, activation_id, offer_id, reward_amount AS calculated_reward_amount FROM {{pairs}}""")
def matched_redemption_rows(d):
    rows = matching.matched_rows(matching.candidates(*ready(d)), RUN)
    return rows.select("matched_redemption_id", "transaction_id", "activation_id", "offer_id",
                       "calculated_reward_amount")


@query(f"SELECT {MATCH_SHAPE}, {REASON} FROM {{matched}}")
def redemption_top1(d):
    best = matching.best_per_transaction(matching.matched_rows(matching.candidates(*ready(d)), RUN))
    return best.select(*MATCH_LIST, "match_deduplication_reason", "match_rule_version")


@query(f"SELECT {MATCH_SHAPE}, {REASON} FROM {{matched}}")
def matched_redemptions(d):
    return matched(d).select(*MATCH_LIST, "match_deduplication_reason", "match_rule_version")


@query("""SELECT transaction_id, activation_id, offer_id, calculated_reward_amount FROM {capped_pairs}
       QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY calculated_reward_amount DESC,
       activation_timestamp, offer_id, activation_id) = 1""")
def matched_redemptions_capped(d):
    rows = matching.match_redemptions(d.tx, d.act, d.offer, RUN, policy="capped")
    return rows.select("transaction_id", "activation_id", "offer_id", "calculated_reward_amount")


@query("""SELECT activation_id, tokenized_cardmember_id, offer_id, activation_timestamp, offer_expiry_timestamp,
       decides_after FROM (SELECT *, max(offer_expiry_timestamp) OVER (PARTITION BY tokenized_cardmember_id, offer_id
       ORDER BY activation_timestamp, activation_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS decides_after
       FROM {act_offer}) WHERE decides_after IS NULL OR decides_after < offer_expiry_timestamp""")
def deciding_windows(d):
    return matching.deciding_windows(ready(d)[1]).select(
        "activation_id", "tokenized_cardmember_id", "offer_id", "activation_timestamp", "offer_expiry_timestamp",
        "decides_after")


@query("SELECT transaction_id, offer_id, count(*) AS candidate_count FROM {pairs} GROUP BY ALL")
def candidate_counts(d):
    return matching.candidate_counts(*ready(d))


@query("SELECT * FROM {redeemed}")
def first_redemption(d):
    return matching.first_redemption(d.tx, d.act, d.offer)


@query("""SELECT *, candidates / transactions AS candidates_per_transaction,
       candidates / activations AS candidates_per_activation
       FROM (SELECT (SELECT count(*) FROM {ready_tx}) AS transactions, (SELECT count(*) FROM {ready_act}) AS activations,
                    (SELECT count(*) FROM {act_offer}) AS activation_offers, (SELECT count(*) FROM {pairs}) AS candidates)""")
def join_profile(d):
    tx, act = ready(d)
    return profiling.join_safety(tx, matching.match_ready_activations(d.act), act)


# ============================================================== rewards and finance


@once
def redeemed(d: Domain) -> DataFrame:
    return matching.first_redemption(d.tx, d.act, d.offer)


@once
def liability(d: Domain) -> DataFrame:
    owner = F.expr("CASE merchant_id % 3 WHEN 0 THEN 'merchant' WHEN 1 THEN 'platform' ELSE 'shared' END")
    return finance.reward_liability(redeemed(d), owner)


@once
def settled(d: Domain) -> DataFrame:
    return finance.settlements(d.tx.filter("transaction_status = 'settled'"), d.merchant, liability(d))


@once
def recon(d: Domain) -> DataFrame:
    return finance.reconciliation(d.tx, settled(d))


@query("""SELECT t.transaction_id, o.offer_type,
       CASE o.offer_type WHEN 'fixed_cashback' THEN CAST(round(CAST(o.reward_amount AS DECIMAL(18,2)), 2) AS DOUBLE)
            ELSE CAST(round(least(CAST(t.transaction_amount AS DECIMAL(18,2)) * CAST(o.reward_multiplier AS DECIMAL(9,4)),
                 CAST(o.max_reward_amount AS DECIMAL(18,2))), 2) AS DOUBLE) END AS calculated_reward_amount
       FROM {event} e JOIN {offer} o ON e.k = o.offer_id JOIN {tx} t ON e.event_id = t.transaction_id""")
def reward_amount(d):
    joined = d.event.join(matching.small_side(d.offer), F.col("k") == F.col("offer_id")).select(
        F.col("event_id").alias("transaction_id"), "offer_type", "reward_amount", "reward_multiplier",
        "max_reward_amount")
    amounts = d.tx.select("transaction_id", "transaction_amount")
    rewarded = derive(joined.join(amounts, "transaction_id"), {"calculated_reward_amount": R.reward_amount()})
    return rewarded.select("transaction_id", "offer_type", "calculated_reward_amount")


@query("""SELECT o_orderkey, owner AS liability_owner, reward AS reward_amount,
       CASE owner WHEN 'merchant' THEN reward WHEN 'platform' THEN 0.0
            ELSE CAST(round(CAST(reward AS DECIMAL(18,2)) * 0.75, 2) AS DOUBLE) END AS merchant_funded_amount,
       CASE owner WHEN 'merchant' THEN 0.0 WHEN 'platform' THEN reward
            ELSE CAST(CAST(reward AS DECIMAL(18,2)) - round(CAST(reward AS DECIMAL(18,2)) * 0.75, 2) AS DOUBLE) END
         AS platform_funded_amount
       FROM (SELECT o_orderkey, o_totalprice AS reward, CASE o_orderstatus WHEN 'F' THEN 'merchant' WHEN 'O'
             THEN 'platform' ELSE 'shared' END AS owner FROM {orders})""")
def funding_split(d):
    owner = F.expr("CASE o_orderstatus WHEN 'F' THEN 'merchant' WHEN 'O' THEN 'platform' ELSE 'shared' END")
    rows = d.orders.select("o_orderkey", owner.alias("liability_owner"), F.col("o_totalprice").alias("reward_amount"))
    return derive(rows, R.funding_split())


@query("SELECT * FROM {liability}")
def reward_liability(d):
    return liability(d)


@query("SELECT * FROM {settled}")
def settlements(d):
    return settled(d)


@query("SELECT * FROM {recon}")
def reconciliation(d):
    return recon(d)


@query(f"""SELECT liability_date AS business_date, offer_id, campaign_id, merchant_id, liability_owner,
       {msum('reward_amount')} AS reward_amount, {msum('merchant_funded_amount')} AS merchant_funded_amount,
       {msum('platform_funded_amount')} AS platform_funded_amount, {msum('reward_amount')} AS accrued_liability,
       CAST(0 AS DOUBLE) AS paid_liability, CAST(0 AS DOUBLE) AS reversed_liability,
       {msum('reward_amount')} AS remaining_liability FROM {{liability}} GROUP BY ALL""")
def liability_summary(d):
    return marts.liability_summary(liability(d))


@query(f"""SELECT settlement_date, merchant_id, {msum('gross_transaction_amount')} AS gross_transaction_amount,
       {msum('platform_fee_amount')} AS platform_fee_amount,
       {msum('merchant_settlement_amount')} AS merchant_settlement_amount,
       {msum('merchant_funded_amount')} AS merchant_funded_amount,
       {msum('platform_funded_amount')} AS platform_funded_amount,
       {msum('merchant_net_after_reward')} AS merchant_net_after_reward, count(*) AS settlement_count
       FROM {{settled}} GROUP BY ALL""")
def settlement_summary(d):
    return marts.settlement_summary(settled(d))


@query(f"""SELECT *, {pos('matched_count', 'transaction_count')} AS match_rate FROM (
       SELECT reconciliation_date, merchant_id, count(*) AS transaction_count,
       count(*) FILTER (reconciliation_status = 'matched') AS matched_count,
       count(*) FILTER (reconciliation_status = 'mismatched') AS mismatched_count,
       {msum('settlement_delta')} AS total_settlement_delta, {mavg('settlement_delta')} AS average_settlement_delta,
       count(*) FILTER (abs(settlement_delta) > 1.0) AS large_delta_count FROM {{recon}} GROUP BY ALL)""")
def recon_health(d):
    return marts.reconciliation_health(recon(d))


# ============================================================== daily marts


@query("SELECT * FROM {spend}")
def merchant_daily_spend(d):
    return marts.merchant_daily_spend(d.tx)


@query("SELECT * FROM {rewards}")
def merchant_daily_rewards(d):
    return marts.merchant_daily_rewards(matched(d))


@once
def merchant_daily(d: Domain) -> DataFrame:
    spend = marts.merchant_daily_spend(d.tx, unique_ids=True)
    rewards = marts.merchant_daily_rewards(matched(d), unique_ids=True)
    return marts.merchant_daily_economics(spend, rewards, d.merchant)


@once
def offer_daily(d: Domain) -> DataFrame:
    return marts.offer_daily_economics(marts.offer_daily_spend(matched(d), unique_ids=True), d.offer, d.campaign)


@query("SELECT * FROM {merchant_daily}")
def merchant_daily_economics(d):
    return merchant_daily(d)


@query("SELECT * FROM {offer_daily}")
def offer_daily_economics(d):
    return offer_daily(d)


@query(f"""SELECT *, {pos('activations', 'impressions')} AS activation_rate,
       {pos('redemptions', 'activations')} AS redemption_rate,
       1.0 - ({pos('redemptions', 'activations')}) AS breakage_rate,
       {pos('reward_cost', 'redemptions')} AS cost_per_redemption FROM (
       SELECT business_date, offer_id, campaign_id, merchant_id, coalesce(i.n, 0) AS impressions,
              coalesce(a.n, 0) AS activations, coalesce(m.n, 0) AS redemptions,
              coalesce(m.spend, 0.0) AS gross_redeemed_spend, coalesce(m.reward, 0.0) AS reward_cost
       FROM (SELECT impression_date AS business_date, offer_id, campaign_id, merchant_id, count(*) AS n
             FROM {{imp}} GROUP BY ALL) i
       FULL JOIN (SELECT a.activation_date AS business_date, a.offer_id, o.campaign_id, o.merchant_id, count(*) AS n
             FROM {{act}} a JOIN {{offer}} o USING (offer_id) GROUP BY ALL) a
            USING (business_date, offer_id, campaign_id, merchant_id)
       FULL JOIN (SELECT transaction_date AS business_date, offer_id, campaign_id, merchant_id, count(*) AS n,
                  {msum('transaction_amount')} AS spend, {msum('calculated_reward_amount')} AS reward
             FROM {{matched}} GROUP BY ALL) m USING (business_date, offer_id, campaign_id, merchant_id))""")
def offer_funnel(d):
    terms = d.offer.select("offer_id", "campaign_id", "merchant_id")
    act = d.act.join(matching.small_side(terms), "offer_id")
    return marts.offer_funnel(d.imp, act, matched(d))


@query(f"""SELECT *, {pos('activations', 'impressions')} AS activation_rate,
       {pos('redemptions', 'activations')} AS redemption_rate FROM (
       SELECT c.segment_id, count(*) AS cardmember_count, CAST(sum(s.impressions) AS BIGINT) AS impressions,
       CAST(sum(s.activations) AS BIGINT) AS activations, CAST(sum(s.redemptions) AS BIGINT) AS redemptions,
       {msum('s.spend')} AS redeemed_spend, {msum('s.reward')} AS reward_cost
       FROM (SELECT tokenized_cardmember_id, count(*) FILTER (step = 1) AS impressions,
             count(*) FILTER (step = 2) AS activations, count(*) FILTER (step = 3) AS redemptions,
             coalesce(CAST(sum(CAST(spend AS DECIMAL(18,4))) AS DOUBLE), 0.0) AS spend,
             coalesce(CAST(sum(CAST(reward AS DECIMAL(18,4))) AS DOUBLE), 0.0) AS reward
             FROM (SELECT tokenized_cardmember_id, 1 AS step, NULL AS spend, NULL AS reward FROM {{imp}}
             UNION ALL SELECT tokenized_cardmember_id, 2, NULL, NULL FROM {{act}}
             UNION ALL SELECT tokenized_cardmember_id, 3, transaction_amount, calculated_reward_amount FROM {{matched}})
             GROUP BY 1) s LEFT JOIN {{card}} c USING (tokenized_cardmember_id) GROUP BY 1)""")
def segment_response(d):
    return marts.segment_response(d.imp, d.act, matched(d), d.card)


@query(f"""SELECT *, {pos('reward_cost_amount', 'gross_spend_amount')} AS reward_share_of_spend FROM (
       SELECT m.category_id, count(DISTINCT t.merchant_id) AS merchant_count, count(*) AS transaction_count,
       {msum('t.transaction_amount')} AS gross_spend_amount, count(x.transaction_id) AS redemption_count,
       coalesce({msum('x.calculated_reward_amount')}, 0.0) AS reward_cost_amount
       FROM {{tx}} t LEFT JOIN {{matched}} x ON t.transaction_id = x.transaction_id
       LEFT JOIN {{merchant}} m ON t.merchant_id = m.merchant_id GROUP BY 1)""")
def category_performance(d):
    return marts.category_performance(d.tx, matched(d), d.merchant)


# ============================================================== incrementality, profitability, risk


@once
def group_lift(d: Domain) -> DataFrame:
    return inc.group_lift(d.li, "line_id")


def lifted(d: Domain) -> DataFrame:
    return group_lift(d).drop(*inc.SHOWN_TERMS)


@once
def incremental(d: Domain) -> DataFrame:
    return inc.valued(inc.scaled_revenue(group_lift(d)), d.merchant)


@once
def features(d: Domain) -> DataFrame:
    return inc.features(incremental(d))


@once
def risks(d: Domain) -> DataFrame:
    return risk.cannibalization(features(d))


@query("SELECT * FROM {test_cells}")
def test_group_spend(d):
    return inc.test_group_spend(d.test, two_level=True)


@query("SELECT * FROM {control_cells}")
def control_group_spend(d):
    return inc.control_group_spend(d.control, two_level=True)


@query("SELECT * FROM {lifted}")
def test_control_lift(d):
    return lifted(d)


@query("SELECT * FROM {scaled}")
def scaled_incremental_revenue(d):
    return inc.scaled_revenue(lifted(d))


@query("SELECT * FROM {inc}")
def incrementality_enriched(d):
    return incremental(d)


@query("SELECT * FROM {base}")
def profitability_base(d):
    return inc.profitability_base(incremental(d))


@query("SELECT * FROM {net}")
def net_merchant_profit(d):
    return inc.net_profit(inc.profitability_base(incremental(d)))


@query("SELECT * FROM {classed}")
def profitability_class(d):
    return inc.profit_class(inc.net_profit(inc.profitability_base(incremental(d))))


@query("SELECT * FROM {feat}")
def roas_efficiency(d):
    return features(d)


@query("SELECT * FROM {flagged}")
def cannibal_flags(d):
    return risk.flags(features(d))


@query("SELECT * FROM {scored}")
def cannibal_score(d):
    return risk.score(risk.flags(features(d)))


@query("SELECT * FROM {levelled}")
def risk_level(d):
    return risk.classify(risk.score(risk.flags(features(d))))


FEATURE_ONLY = """normalized_merchant_margin_rate, normalized_platform_fee_rate, control_transaction_count,
       lift_direction, estimated_incremental_cogs_amount, platform_fee_revenue_base_amount,
       incremental_revenue_positive_flag, net_profit_positive_flag, profitability_explanation"""


@query(f"SELECT * EXCLUDE ({FEATURE_ONLY}) FROM {{risk}}")
def risk_reasons(d):
    return risks(d)


@query("""SELECT business_date, offer_id, campaign_id, merchant_id, a + b + c + e AS cannibalization_risk_score,
       CASE WHEN a + b + c + e >= 80 THEN 'critical' WHEN a + b + c + e >= 50 THEN 'high'
            WHEN a + b + c + e >= 25 THEN 'medium' ELSE 'low' END AS cannibalization_risk_level
       FROM (SELECT *, CASE WHEN net_merchant_profit_amount < 0 THEN 40 ELSE 0 END AS a,
             CASE WHEN lift_percentage <= 0.05 THEN 25 ELSE 0 END AS b, CASE WHEN total_cost_roas < 2 THEN 20 ELSE 0 END AS c,
             CASE WHEN spend_lift_but_profit_loss_flag THEN 15 ELSE 0 END AS e FROM {feat})""")
def practice_score(d):
    return risk.practice_score(features(d)).select(*CELL, "cannibalization_risk_score", "cannibalization_risk_level")


TOP = "cannibalization_risk_score, net_merchant_profit_amount"


@query(f"""SELECT {cell_key()}, {TOP}, total_cost_roas FROM {{risk}}
       ORDER BY cannibalization_risk_score DESC, net_merchant_profit_amount, {cell_key()} LIMIT 20""")
def top_risk_rows(d):
    order = [F.desc("cannibalization_risk_score"), "net_merchant_profit_amount"]
    narrow = risks(d).select(*CELL, "cannibalization_risk_score", "net_merchant_profit_amount", "total_cost_roas")
    return profiling.top_rows(narrow, order, CELL, 20)


@query(f"""SELECT {cell_key()}, cannibalization_risk_level, {TOP} FROM {{risk}}
       WHERE cannibalization_risk_level IN ('critical', 'high')
       ORDER BY cannibalization_risk_score DESC, net_merchant_profit_amount, {cell_key()} LIMIT 30""")
def top_review_rows(d):
    narrow = risks(d).filter("requires_merchant_review_flag").select(
        *CELL, "cannibalization_risk_level", "cannibalization_risk_score", "net_merchant_profit_amount")
    return profiling.top_rows(
        narrow, [F.desc("cannibalization_risk_score"), "net_merchant_profit_amount"], CELL, 30)


@query(f"""SELECT {cell_key()}, {TOP}, cannibalization_risk_detail FROM {{risk}}
       WHERE cannibalization_risk_level = 'critical'
       ORDER BY cannibalization_risk_score DESC, net_merchant_profit_amount, {cell_key()} LIMIT 30""")
def top_critical_rows(d):
    narrow = risks(d).filter("cannibalization_risk_level = 'critical'").select(
        *CELL, "cannibalization_risk_score", "net_merchant_profit_amount", "cannibalization_risk_detail")
    return profiling.top_rows(
        narrow, [F.desc("cannibalization_risk_score"), "net_merchant_profit_amount"], CELL, 30)


@query("""SELECT business_date, offer_id, campaign_id, merchant_id, lift_per_cardmember,
       CASE WHEN lift_per_cardmember <= 0 THEN 'no_lift' WHEN lift_per_cardmember <
            CASE WHEN test_cardmember_count > 0 THEN total_test_reward_amount / test_cardmember_count ELSE 0.0 END
            THEN 'weak_lift_possible_cannibalization' ELSE 'strong_lift' END AS incrementality_quality FROM {inc}""")
def incrementality_quality(d):
    per_user = "CASE WHEN test_cardmember_count > 0 THEN total_test_reward_amount / test_cardmember_count ELSE 0D END"
    labelled = derive(incremental(d), {
        "reward_per_user": per_user,
        "incrementality_quality": R.incrementality_quality("lift_per_cardmember", "reward_per_user")})
    return labelled.select(*CELL, "lift_per_cardmember", "incrementality_quality")


@query(f"""SELECT *, CASE WHEN incremental_profit < 0 AND lift_per_user <= 5 THEN 'high' WHEN incremental_profit < 0
       THEN 'medium' ELSE 'low' END AS simple_risk FROM (
       SELECT *, lift_per_user * test_users AS incremental_revenue,
              lift_per_user * test_users * margin_rate - reward_cost - platform_fee AS incremental_profit,
              CASE WHEN reward_cost <> 0 THEN lift_per_user * test_users / reward_cost ELSE 0.0 END AS simple_roas
       FROM (SELECT *, test_spend / test_users - control_spend / control_users AS lift_per_user FROM (
       SELECT t.campaign_id, t.test_spend, t.test_users, c.control_spend, c.control_users, CAST(0.4 AS DOUBLE) AS margin_rate,
       t.reward_cost, t.reward_cost / 8 AS platform_fee FROM
       (SELECT campaign_id, {msum('transaction_amount')} AS test_spend, count(DISTINCT tokenized_cardmember_id)
        AS test_users, {msum('calculated_reward_amount')} AS reward_cost FROM {{test}} GROUP BY 1) t JOIN
       (SELECT campaign_id, {msum('transaction_amount')} AS control_spend, count(DISTINCT tokenized_cardmember_id)
        AS control_users FROM {{control}} GROUP BY 1) c USING (campaign_id))))""")
def simple_economics(d):
    t = d.test.groupBy("campaign_id").agg(
        money_sum("transaction_amount").alias("test_spend"),
        F.countDistinct("tokenized_cardmember_id").alias("test_users"),
        money_sum("calculated_reward_amount").alias("reward_cost"))
    c = d.control.groupBy("campaign_id").agg(
        money_sum("transaction_amount").alias("control_spend"),
        F.countDistinct("tokenized_cardmember_id").alias("control_users"))
    given = t.join(c, "campaign_id").withColumns(
        {"margin_rate": F.lit(0.4), "platform_fee": F.col("reward_cost") / 8})
    return derive(given, R.simple_economics())


@query(f"""SELECT merchant_id, coalesce({msum("CASE WHEN l_linestatus = 'O' THEN transaction_amount END")}, 0.0)
       AS spend_before, coalesce({msum("CASE WHEN l_linestatus = 'F' THEN transaction_amount END")}, 0.0) AS spend_during,
       coalesce({msum("CASE WHEN l_linestatus = 'F' THEN transaction_amount END")}, 0.0)
       - coalesce({msum("CASE WHEN l_linestatus = 'O' THEN transaction_amount END")}, 0.0) AS naive_lift
       FROM {{li}} GROUP BY 1""")
def before_after_lift(d):
    return profiling.period_lift(d.li, "l_linestatus", "transaction_amount", "O", "F", "merchant_id")


# ============================================================== profiling


@query("""SELECT user_id, count(*) AS row_count FROM {events} GROUP BY 1 ORDER BY row_count DESC, user_id LIMIT 10""")
def top_keys(d):
    return profiling.top_keys(d.events, "user_id")


@query("SELECT efficiency_status, count(*) AS row_count FROM {feat} GROUP BY 1")
def value_distribution(d):
    return profiling.value_distribution(features(d), "efficiency_status")


@query("SELECT primary_cannibalization_risk_driver, count(*) AS row_count FROM {risk} GROUP BY 1")
def driver_distribution(d):
    return profiling.value_distribution(risks(d), "primary_cannibalization_risk_driver")


RISK_FLAGS = (
    "weak_lift_flag", "negative_lift_flag", "negative_net_profit_flag", "low_total_cost_roas_flag",
    "high_reward_cost_share_flag", "positive_spend_lift_but_profit_loss_flag",
    "reward_cost_exceeds_incremental_margin_flag", "test_control_spend_near_parity_flag",
)


@query("SELECT " + ", ".join(f"count(*) FILTER ({f}) AS {f.removesuffix('_flag')}_count" for f in RISK_FLAGS)
       + " FROM {flagged}")
def flag_summary(d):
    return profiling.flag_summary(risk.flags(features(d)), RISK_FLAGS)


@query("""SELECT min(cannibalization_risk_score) AS min_score, CAST(sum(cannibalization_risk_score) AS BIGINT) / count(*)
       AS avg_score, max(cannibalization_risk_score) AS max_score FROM {scored}""")
def score_minmax(d):
    return profiling.score_range(risk.score(risk.flags(features(d))), "cannibalization_risk_score")


@query("""SELECT campaign_id, count(*) AS transaction_count,
       CAST(sum(CAST(transaction_amount AS DECIMAL(18,2))) AS DOUBLE) AS total_spend,
       CAST((CAST(sum(CAST(transaction_amount AS DECIMAL(18,2))) * 200 AS BIGINT) + count(*)) // (2 * count(*)) AS DOUBLE)
         / 100 AS avg_transaction_amount,
       min(transaction_amount) AS min_transaction_amount, max(transaction_amount) AS max_transaction_amount
       FROM {li} GROUP BY 1""")
def category_spend(d):
    return profiling.spend_summary(d.li, "campaign_id")


@query("""SELECT *, impressions / assignments AS impression_rate, activations / impressions AS activation_rate
       FROM (SELECT (SELECT count(*) FROM {assignment}) AS assignments, (SELECT count(*) FROM {imp}) AS impressions,
       (SELECT count(*) FROM {act}) AS activations)""")
def funnel_rates(d):
    return profiling.funnel_totals(d.assignment, d.imp, d.act)


@query("""SELECT 'lineitem' AS table_name, 'l_orderkey' AS key_column, count(*) AS row_count,
       count(*) FILTER (l_orderkey IS NULL) AS null_count, count(*) - count(DISTINCT l_orderkey) AS duplicate_count
       FROM {lineitem}""")
def pk_quality(d):
    return quality.key_quality(d.lineitem, "lineitem", "l_orderkey")


@query("""SELECT count(*) AS row_count, count(*) FILTER (l_extendedprice < 0) AS negative_price,
       count(*) FILTER (l_discount NOT BETWEEN 0 AND 0.05) AS discount_out_of_band,
       count(*) FILTER (l_shipdate IS NULL) AS null_ship_date FROM {lineitem}""")
def range_counters(d):
    return profiling.range_counters(d.lineitem, {
        "negative_price": "l_extendedprice < 0", "discount_out_of_band": "l_discount NOT BETWEEN 0 AND 0.05D",
        "null_ship_date": "l_shipdate IS NULL"})


# ============================================================== row rules and calendar


@query("""SELECT calendar_date, strftime(calendar_date, '%Y%m%d') AS date_id, year(calendar_date) AS year,
       quarter(calendar_date) AS quarter, month(calendar_date) AS month, monthname(calendar_date) AS month_name,
       CAST(strftime(calendar_date, '%U') AS BIGINT) AS week_of_year, dayname(calendar_date) AS day_of_week,
       day(calendar_date) AS day_of_month, isodow(calendar_date) >= 6 AS is_weekend,
       strftime(calendar_date, '%m-%d') IN ('01-01', '07-04', '12-25') AS is_holiday,
       CASE strftime(calendar_date, '%m-%d') WHEN '01-01' THEN 'New Year''s Day' WHEN '07-04' THEN 'Independence Day'
            WHEN '12-25' THEN 'Christmas Day' END AS holiday_name
       FROM (SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE)
             AS calendar_date FROM {orders})""")
def calendar_dim(d):
    span = d.orders.agg(
        F.min("o_orderdate").cast("date").alias("first"), F.max("o_orderdate").cast("date").alias("last"))
    days = span.select(F.explode(F.sequence("first", "last")).alias("calendar_date"))
    return derive(days, R.calendar_columns())


@query("""SELECT line_id, category_name, m AS seasonality_multiplier,
       CAST(round(CAST(transaction_amount AS DECIMAL(18,2)) * CAST(m AS DECIMAL(9,4)), 2) AS DOUBLE) AS seasonal_amount
       FROM (SELECT l.line_id, c.category_name, l.transaction_amount, CAST(CASE
         WHEN c.category_name = 'dining' AND isodow(l.ship_time) >= 6 THEN 1.15
         WHEN c.category_name = 'retail' AND month(l.ship_time) >= 11 THEN 1.25
         WHEN c.category_name = 'travel' AND month(l.ship_time) IN (6, 7, 11, 12) THEN 1.20
         WHEN c.category_name = 'luxury' AND month(l.ship_time) >= 11 THEN 1.15 ELSE 1.0 END AS DOUBLE) AS m
       FROM {li} l JOIN {merchant} s ON l.merchant_id = s.merchant_id
            JOIN {category} c ON s.category_id = c.category_id)""")
def seasonality(d):
    places = matching.small_side(d.merchant.select("merchant_id", "category_id"))
    joined = d.li.join(places, "merchant_id").join(matching.small_side(d.category), "category_id")
    adjusted = derive(joined, R.seasonality("ship_time"))
    return adjusted.select("line_id", "category_name", "seasonality_multiplier", "seasonal_amount")


@query("""SELECT event_id, least(value / 500, 1.0) AS risk_score, CASE WHEN least(value / 500, 1.0) >= 0.90 THEN 'open'
       WHEN least(value / 500, 1.0) >= 0.75 THEN 'reviewed' ELSE 'confirmed_false_positive' END AS risk_event_status
       FROM {events}""")
def risk_event_status(d):
    scored = d.events.select("event_id", F.least(F.col("value") / 500, F.lit(1.0)).alias("risk_score"))
    return derive(scored, {"risk_event_status": R.risk_event_status()})


@query("""SELECT tokenized_cardmember_id, CASE WHEN historical_transaction_count_90d > 0 THEN
       CAST((CAST(CAST(historical_spend_90d AS DECIMAL(18,2)) * 200 AS BIGINT) + historical_transaction_count_90d)
            // (2 * historical_transaction_count_90d) AS DOUBLE) / 100 END AS average_ticket_size,
       greatest(0.05, least(0.80, balance / 10000)) AS clamped_rate FROM {card}""")
def average_ticket(d):
    out = derive(d.card, {
        "average_ticket_size": R.average_ticket("historical_spend_90d", "historical_transaction_count_90d"),
        "clamped_rate": R.margin_clamp("balance / 10000")})
    return out.select("tokenized_cardmember_id", "average_ticket_size", "clamped_rate")


# ============================================================== quality


@query("""SELECT DISTINCT l_partkey AS orphan_key FROM {lineitem} WHERE l_partkey NOT IN
       (SELECT p_partkey FROM {part} WHERE p_size > 10)""")
def orphan_keys(d):
    return quality.orphan_keys(d.lineitem, "l_partkey", d.part.filter("p_size > 10"), "p_partkey")


@query("SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM {lineitem} GROUP BY ALL HAVING count(*) > 1")
def duplicate_grain(d):
    return quality.duplicate_grain(d.lineitem, ["l_orderkey", "l_linenumber"])


@query(checks("gold_merchant_daily", "{merchant_daily}", "business_date, merchant_id", [
    ("null_required", "critical", "business_date IS NULL OR merchant_id IS NULL OR gross_spend_amount IS NULL"),
    ("negative_metric", "high", "transaction_count < 0 OR gross_spend_amount < 0 OR reward_cost_amount < 0"),
    ("invalid_rate", "high", "redemption_rate NOT BETWEEN 0 AND 1 OR merchant_margin_rate NOT BETWEEN 0 AND 1"),
    ("redeemed_over_transactions", "high", "redeemed_transaction_count > transaction_count"),
    ("formula_mismatch", "high", "abs(platform_fee_amount - gross_spend_amount * platform_fee_rate) > 0.01"),
]))
def checks_merchant_daily(d):
    return quality.check_merchant_daily(merchant_daily(d))


@query(checks("gold_offer_daily", "{offer_daily}", CELL_SQL, [
    ("null_required", "critical", "offer_id IS NULL OR gross_redeemed_spend_amount IS NULL"),
    ("negative_metric", "high", "gross_redeemed_spend_amount < 0 OR reward_cost_amount < 0"),
    ("invalid_ratio", "high", "reward_to_redeemed_spend_ratio NOT BETWEEN 0 AND 1"),
    ("redeemed_over_matched", "high", "redeemed_transaction_count > matched_redemption_count"),
    ("formula_mismatch", "high", "gross_redeemed_spend_amount > 0 AND abs(reward_to_redeemed_spend_ratio "
     "- reward_cost_amount / gross_redeemed_spend_amount) > 0.0001"),
]))
def checks_offer_daily(d):
    return quality.check_offer_daily(offer_daily(d))


@query(checks("gold_offer_incrementality", "{inc}", CELL_SQL, [
    ("null_required", "critical", "offer_id IS NULL OR lift_per_cardmember IS NULL"),
    ("invalid_count", "high", "test_cardmember_count <= 0 OR control_cardmember_count <= 0"),
    ("negative_amount", "high", "total_test_spend_amount < 0 OR total_control_spend_amount < 0"),
    ("invalid_rate", "high", "merchant_margin_rate NOT BETWEEN 0 AND 1 OR platform_fee_rate NOT BETWEEN 0 AND 1"),
    ("invalid_direction", "high", "lift_direction NOT IN ('positive_lift', 'negative_lift', 'no_lift')"),
    ("lift_formula", "high", "abs(lift_per_cardmember - (average_test_spend_per_cardmember "
     "- average_control_spend_per_cardmember)) > 0.01"),
    ("revenue_formula", "high", "abs(incremental_revenue_amount - lift_per_cardmember * test_cardmember_count) > 0.01"),
    ("lift_percentage_formula", "high", "average_control_spend_per_cardmember > 0 AND abs(lift_percentage - "
     "lift_per_cardmember / average_control_spend_per_cardmember) > 0.0001"),
    ("value_formula", "high", "abs(estimated_incremental_value_after_reward - incremental_revenue_amount * "
     "(merchant_margin_rate - platform_fee_rate) + total_test_reward_amount) > 0.01"),
]))
def checks_incrementality(d):
    return quality.check_incrementality(incremental(d))


@query(checks("gold_incrementality_features", "{feat}", CELL_SQL, [
    ("null_required", "critical", "offer_id IS NULL OR net_merchant_profit_amount IS NULL"),
    ("invalid_rate", "high", "merchant_margin_rate NOT BETWEEN 0 AND 1 OR platform_fee_rate NOT BETWEEN 0 AND 1"),
    ("negative_cost", "high", "funded_reward_cost_amount < 0 OR total_offer_cost_amount < 0"),
    ("invalid_profitability_status", "high", "profitability_status NOT IN ('profitable', 'unprofitable', 'break_even')"),
    ("invalid_efficiency_status", "high", "efficiency_status IS NULL"),
    ("margin_formula", "high", "abs(estimated_incremental_margin_amount - incremental_revenue_amount * "
     "merchant_margin_rate) > 0.01"),
    ("cogs_formula", "high", "abs(estimated_incremental_cogs_amount + estimated_incremental_margin_amount "
     "- incremental_revenue_amount) > 0.01"),
    ("platform_fee_formula", "high", "abs(estimated_incremental_platform_fee_amount - "
     "greatest(incremental_revenue_amount, 0.0) * platform_fee_rate) > 0.01"),
    ("net_profit_formula", "high", "abs(net_merchant_profit_amount - estimated_incremental_margin_amount + "
     "funded_reward_cost_amount + estimated_incremental_platform_fee_amount) > 0.01"),
    ("total_cost_formula", "high", "abs(total_offer_cost_amount - funded_reward_cost_amount - "
     "estimated_incremental_platform_fee_amount) > 0.01"),
    ("roas_formula", "high", "total_offer_cost_amount <> 0 AND abs(total_cost_roas - incremental_revenue_amount / "
     "total_offer_cost_amount) > 0.0001"),
    ("profitability_label", "high", "(net_merchant_profit_amount > 0) <> (profitability_status = 'profitable')"),
    ("decision_flags", "high", "spend_lift_but_profit_loss_flag AND profitable_incremental_offer_flag"),
]))
def checks_features(d):
    return quality.check_features(features(d))


@query(checks("gold_offer_cannibalization_risk", "{risk}", CELL_SQL, [
    ("null_required", "critical", "offer_id IS NULL OR cannibalization_risk_score IS NULL"),
    ("invalid_risk_level", "high", "cannibalization_risk_level NOT IN ('low', 'medium', 'high', 'critical')"),
    ("invalid_primary_driver", "high", "primary_cannibalization_risk_driver IS NULL"),
    ("negative_score", "high", "cannibalization_risk_score < 0"),
    ("risk_points", "high", "negative_lift_risk_points <> CASE WHEN negative_lift_flag THEN 25 ELSE 0 END"),
    ("risk_score", "high", "cannibalization_risk_score NOT BETWEEN 0 AND 140"),
    ("risk_level", "high", "(cannibalization_risk_score >= 80) <> (cannibalization_risk_level = 'critical')"),
    ("merchant_review_flag", "high", "requires_merchant_review_flag <> (cannibalization_risk_score >= 50)"),
    ("offer_redesign_flag", "high", "cannibalization_risk_level = 'critical' AND NOT requires_offer_redesign_flag"),
    ("safe_to_scale_flag", "high", "safe_to_scale_flag AND cannibalization_risk_score >= 25"),
    ("primary_driver", "high", "primary_cannibalization_risk_driver = 'weak_lift' AND NOT weak_lift_flag"),
]))
def checks_cannibalization(d):
    return quality.check_cannibalization(risks(d))


@query("""SELECT 'dim_merchant_scd' AS table_name, check_name, failure_count, severity,
       CASE WHEN failure_count = 0 THEN 'passed' ELSE 'failed' END AS status FROM (
       SELECT 'null_required' AS check_name, count(*) AS failure_count, 'critical' AS severity FROM {scd_state}
         WHERE surrogate_scd_id IS NULL OR merchant_id IS NULL OR is_current IS NULL
       UNION ALL SELECT 'end_before_start', count(*), 'high' FROM {scd_state}
         WHERE effective_end_date < effective_start_date
       UNION ALL SELECT 'current_with_end_date', count(*), 'high' FROM {scd_state}
         WHERE is_current AND effective_end_date IS NOT NULL
       UNION ALL SELECT 'not_exactly_one_current', count(*), 'critical' FROM (SELECT 1 FROM {scd_state}
         GROUP BY merchant_id HAVING count(*) FILTER (is_current) <> 1)
       UNION ALL SELECT 'duplicate_surrogate', count(*), 'critical' FROM (SELECT 1 FROM {scd_state}
         GROUP BY surrogate_scd_id HAVING count(*) > 1))""")
def checks_scd(d):
    return quality.check_scd(merchant_history(d), MERCHANT_SCD)


RELATION_SQL = """SELECT table_name, check_name, failure_count, 'critical' AS severity,
       CASE WHEN failure_count = 0 THEN 'passed' ELSE 'failed' END AS status FROM (
       SELECT 'fact_offer_redemptions' AS table_name, 'redemption_to_transaction' AS check_name,
              (SELECT count(DISTINCT transaction_id) FROM {redeemed} WHERE transaction_id NOT IN
               (SELECT transaction_id FROM {tx})) AS failure_count
       UNION ALL SELECT 'fact_control_group_transactions', 'control_transaction_to_transaction',
              (SELECT count(DISTINCT transaction_id) FROM {control_event} WHERE transaction_id NOT IN
               (SELECT transaction_id FROM {tx}))
       UNION ALL SELECT 'fact_reward_liability', 'reward_liability_to_redemption',
              (SELECT count(DISTINCT redemption_id) FROM {liability} WHERE redemption_id NOT IN
               (SELECT redemption_id FROM {redeemed}))
       UNION ALL SELECT 'fact_reward_liability', 'reward_liability_to_transaction',
              (SELECT count(DISTINCT transaction_id) FROM {liability} WHERE transaction_id NOT IN
               (SELECT transaction_id FROM {tx}))
       UNION ALL SELECT 'fact_merchant_settlements', 'settlement_to_transaction',
              (SELECT count(DISTINCT transaction_id) FROM {settled} WHERE transaction_id NOT IN
               (SELECT transaction_id FROM {tx}))
       UNION ALL SELECT 'fact_data_quality_reconciliation', 'reconciliation_to_transaction',
              (SELECT count(DISTINCT transaction_id) FROM {recon} WHERE transaction_id NOT IN
               (SELECT transaction_id FROM {tx})))"""


@once
def finance_tables(d: Domain) -> dict[str, DataFrame]:
    return {
        "fact_transactions": d.tx, "fact_offer_redemptions": redeemed(d),
        "fact_control_group_transactions": d.control_event, "fact_reward_liability": liability(d),
        "fact_merchant_settlements": settled(d), "fact_data_quality_reconciliation": recon(d),
    }


@query(RELATION_SQL)
def checks_relations(d):
    """The relations of the finance tables; risk events are not derived from transactions here."""
    tables = finance_tables(d)
    return quality.check_relations(tables, [r for r in RELATIONS if r.child in tables and r.parent in tables])


@query("""SELECT table_name, check_name, failure_count, 'high' AS severity,
       CASE WHEN failure_count = 0 THEN 'passed' ELSE 'failed' END AS status FROM (
       SELECT 'fact_reward_liability' AS table_name, 'reward_funding_split' AS check_name, (SELECT count(*) FROM
         {liability} WHERE round(abs(merchant_funded_amount + platform_funded_amount - reward_amount), 4) > 0.01)
         AS failure_count
       UNION ALL SELECT 'fact_merchant_settlements', 'merchant_settlement_amount_formula', (SELECT count(*) FROM
         {settled} WHERE round(abs(gross_transaction_amount - platform_fee_amount - merchant_settlement_amount), 4) > 0.01)
       UNION ALL SELECT 'fact_merchant_settlements', 'merchant_net_after_reward_formula', (SELECT count(*) FROM
         {settled} WHERE round(abs(merchant_settlement_amount - merchant_funded_amount - merchant_net_after_reward), 4)
         > 0.01)
       UNION ALL SELECT 'fact_data_quality_reconciliation', 'reconciliation_delta_formula', (SELECT count(*) FROM
         {recon} WHERE round(abs(transaction_amount - merchant_settlement_amount - platform_fee_amount
         - settlement_delta), 4) > 0.01))""")
def money_formulas(d):
    return quality.check_money(finance_tables(d))


RELEASE = TableSpec("lineitem", "l_orderkey", "l_orderkey bigint, l_linenumber int, l_comment string")
RELEASE_SQL = """SELECT 'lineitem' AS table_name, check_name, failure_count, 'critical' AS severity,
       CASE WHEN failure_count = 0 THEN 'passed' ELSE 'failed' END AS status FROM (
       SELECT 'minimum_row_count' AS check_name, CAST(count(*) = 0 AS BIGINT) AS failure_count FROM {lineitem}
       UNION ALL SELECT 'required_columns', CAST(1 AS BIGINT)
       UNION ALL SELECT 'primary_key_uniqueness', count(*) - count(DISTINCT l_orderkey)
                 + 2 * count(*) FILTER (l_orderkey IS NULL) FROM {lineitem})"""


@query(RELEASE_SQL)
def release_checks(d):
    return quality.check_release(d.lineitem, RELEASE)


GATES = (
    quality.Check("accepted_type", "event_type NOT IN ('purchase', 'click', 'view')", "medium"),
    quality.Check("value_in_range", "NOT (value BETWEEN 0 AND 250)", "high"),
    quality.Check("user_present", "user_id IS NULL", "critical"),
)
GATE_SQL = checks("events", "{events}", "", [
    ("accepted_type", "medium", "event_type NOT IN ('purchase', 'click', 'view')"),
    ("value_in_range", "high", "NOT (value BETWEEN 0 AND 250)"),
    ("user_present", "critical", "user_id IS NULL"),
])


@query(GATE_SQL)
def silver_gates(d):
    return quality.check_rows(d.events, "events", GATES)


@once
def some_checks(d: Domain) -> DataFrame:
    return quality.check_rows(d.events, "events", GATES).unionByName(quality.check_release(d.lineitem, RELEASE))


@query(f"""SELECT count(*) AS total, count(*) FILTER (status = 'passed') AS passed,
       count(*) FILTER (status = 'failed') AS failed FROM ({GATE_SQL} UNION ALL BY NAME {RELEASE_SQL})""")
def check_summary(d):
    return quality.summarize(some_checks(d))


@query(f"""SELECT table_name, count(*) FILTER (status = 'failed') AS failed_checks,
       CASE min(CASE WHEN status = 'passed' THEN 9 WHEN severity = 'critical' THEN 0 WHEN severity = 'high' THEN 1
                WHEN severity = 'medium' THEN 2 ELSE 3 END)
            WHEN 0 THEN 'fail' WHEN 1 THEN 'quarantine' WHEN 2 THEN 'flag' WHEN 3 THEN 'warn' ELSE 'promote' END AS action,
       min(CASE WHEN status = 'passed' THEN 9 WHEN severity = 'critical' THEN 0 WHEN severity = 'high' THEN 1
           WHEN severity = 'medium' THEN 2 ELSE 3 END) >= 2 AS may_promote
       FROM ({GATE_SQL} UNION ALL BY NAME {RELEASE_SQL}) GROUP BY 1""")
def promotion_gate(d):
    return quality.promotion(some_checks(d))


@query("""SELECT * FROM (SELECT 'c_custkey' AS column_name, 'bigint' AS expected_type, 'bigint' AS actual_type,
         'matched' AS drift, count(c_custkey) AS value_count FROM {customer}
       UNION ALL SELECT 'c_name', 'string', 'string', 'matched', count(c_name) FROM {customer}
       UNION ALL SELECT 'c_phone', 'string', NULL, 'missing', CAST(0 AS BIGINT)
       UNION ALL SELECT 'c_acctbal', 'decimal(18,2)', 'double', 'type_changed', count(c_acctbal) FROM {customer}
       UNION ALL SELECT 'c_nationkey', NULL, 'int', 'unexpected', count(c_nationkey) FROM {customer}
       UNION ALL SELECT 'c_mktsegment', NULL, 'string', 'unexpected', count(c_mktsegment) FROM {customer})""")
def schema_drift(d):
    return quality.schema_drift(
        d.customer, "c_custkey bigint, c_name string, c_phone string, c_acctbal decimal(18,2)")


@query("""SELECT tokenized_cardmember_id, offer_id, count(*) FILTER (assignment_group = 'test') AS test_assignments,
       count(*) FILTER (assignment_group = 'control') AS control_assignments FROM
       (SELECT tokenized_cardmember_id, offer_id, CASE WHEN assignment_id % 2 = 0 THEN 'test' ELSE 'control' END
        AS assignment_group FROM {assignment}) GROUP BY 1, 2
       HAVING count(DISTINCT assignment_group) = 2""")
def mixed_groups(d):
    by_turn = F.expr("CASE WHEN assignment_id % 2 = 0 THEN 'test' ELSE 'control' END")
    return quality.mixed_groups(d.assignment.withColumn("assignment_group", by_turn))


@query("""SELECT assignment_id, tokenized_cardmember_id, offer_id FROM {assignment} a WHERE assignment_group = 'control'
       AND EXISTS (SELECT 1 FROM {imp} i WHERE i.tokenized_cardmember_id = a.tokenized_cardmember_id
                   AND i.offer_id = a.offer_id)""")
def exposed_controls(d):
    hits = quality.exposed_controls(d.assignment, d.imp)
    return hits.select("assignment_id", "tokenized_cardmember_id", "offer_id")


@query("""SELECT i.impression_id, i.tokenized_cardmember_id, i.offer_id FROM {imp} i WHERE NOT EXISTS
       (SELECT 1 FROM {assignment} a WHERE a.assignment_group = 'control' AND a.offer_id = i.offer_id
        AND a.tokenized_cardmember_id = i.tokenized_cardmember_id)""")
def control_without_assignment(d):
    rows = quality.control_without_assignment(d.imp, d.assignment)
    return rows.select("impression_id", "tokenized_cardmember_id", "offer_id")


# ============================================================== abuse


@query("""SELECT tokenized_cardmember_id, offer_id, count(*) AS redemption_count, min(transaction_id)
       AS first_transaction_id FROM {matched} GROUP BY 1, 2 HAVING count(*) > 1""")
def abuse_duplicates(d):
    return abuse.duplicate_redemptions(matched(d))


REFUNDABLE = "CASE WHEN merchant_id % 2 = 0 THEN 'refunded' ELSE transaction_status END"


@query(f"""SELECT l.transaction_id, l.reward_liability_id, l.tokenized_cardmember_id, l.merchant_id, l.reward_amount,
       t.transaction_status, t.transaction_amount FROM {{liability}} l JOIN
       (SELECT transaction_id, {REFUNDABLE} AS transaction_status, transaction_amount FROM {{tx}}) t USING (transaction_id)
       WHERE t.transaction_status IN ('refunded', 'reversed')""")
def abuse_refund_after_reward(d):
    later = d.tx.withColumn("transaction_status", F.expr(REFUNDABLE))
    return abuse.refunds_after_reward(later, liability(d))


@query("""SELECT * FROM (SELECT user_id AS tokenized_cardmember_id, event_id AS transaction_id, ts, count(*) OVER
       (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 24 HOUR PRECEDING AND CURRENT ROW) AS events_in_window
       FROM {events}) WHERE events_in_window >= 5""")
def abuse_velocity(d):
    rows = d.events.select(
        F.col("user_id").alias("tokenized_cardmember_id"), F.col("event_id").alias("transaction_id"), "ts")
    return abuse.redemption_velocity(rows, "ts", 86400, 5)


@query("""SELECT tokenized_cardmember_id, transaction_date, count(DISTINCT location_id) AS location_count,
       count(*) AS transaction_count FROM {tx} JOIN {merchant} USING (merchant_id) GROUP BY 1, 2
       HAVING count(DISTINCT location_id) > 2""")
def abuse_location(d):
    return abuse.location_anomalies(d.tx, d.merchant, 2)


@query("""SELECT *, redemption_count / transaction_count AS redemption_share FROM (SELECT tokenized_cardmember_id,
       count(*) AS transaction_count, count(m.transaction_id) AS redemption_count FROM {tx} t LEFT JOIN
       (SELECT transaction_id FROM {matched}) m USING (transaction_id) GROUP BY 1)
       WHERE redemption_count >= 2 AND redemption_count / transaction_count >= 0.1""")
def abuse_gaming(d):
    return abuse.reward_gaming(d.tx, matched(d), 2, 0.1)


EVENT_SQL = f"""SELECT {hashed('fraud_', 't.transaction_id', 'risk_rule_id')} AS fraud_event_id, t.transaction_id,
       r.redemption_id, t.tokenized_cardmember_id, t.merchant_id, k.risk_rule_id, k.risk_rule_name, k.risk_category,
       k.severity AS risk_severity, t.risk_score, t.transaction_timestamp AS event_timestamp,
       t.transaction_date AS event_date, CASE WHEN t.risk_score >= 0.90 THEN 'open' WHEN t.risk_score >= 0.75
       THEN 'reviewed' ELSE 'confirmed_false_positive' END AS risk_event_status,
       k.risk_rule_description AS risk_event_description
       FROM (SELECT *, round(least(transaction_amount / 100, 1.0), 4) AS risk_score, CASE transaction_status WHEN 'refunded' THEN
             'refund_after_reward' ELSE 'high_redemption_velocity' END AS risk_rule_name FROM {{tx}}) t
       JOIN {{risk_rule}} k ON k.risk_rule_name = t.risk_rule_name AND k.is_active
       LEFT JOIN (SELECT transaction_id, min(redemption_id) AS redemption_id FROM {{redeemed}} GROUP BY 1) r
         ON t.transaction_id = r.transaction_id"""


@once
def risk_event_rows(d: Domain) -> DataFrame:
    rule = F.expr("CASE transaction_status WHEN 'refunded' THEN 'refund_after_reward' "
                  "ELSE 'high_redemption_velocity' END")
    hits = d.tx.withColumns(
        {"risk_score": F.round(F.least(F.col("transaction_amount") / 100, F.lit(1.0)), 4), "risk_rule_name": rule})
    return abuse.risk_events(hits, d.risk_rule, redeemed(d))


@query(EVENT_SQL)
def risk_events(d):
    return risk_event_rows(d)


@query(f"""SELECT event_date, e.merchant_id, o.offer_id, risk_rule_name, risk_category, risk_severity,
       count(*) AS risk_event_count, {mavg('risk_score')} AS average_risk_score,
       count(*) FILTER (risk_event_status = 'open') AS open_event_count,
       count(*) FILTER (risk_event_status = 'reviewed') AS reviewed_event_count
       FROM ({EVENT_SQL}) e LEFT JOIN {{matched}} o ON e.transaction_id = o.transaction_id
       GROUP BY ALL""")
def abuse_summary(d):
    return marts.abuse_summary(risk_event_rows(d), matched(d))


# ============================================================== privacy


@query(f"""SELECT merchant_id, campaign_id,
       CASE WHEN n >= 50 THEN n END AS protected_cohort_size, CASE WHEN tn >= 50 THEN ts END AS visible_test_spend,
       CASE WHEN cn >= 50 THEN cs END AS visible_control_spend,
       CASE WHEN tn >= 50 AND cn >= 50 THEN (ts / tn - cs / cn) * tn END AS visible_incremental_spend,
       CASE WHEN tn >= 50 THEN rw END AS visible_reward_cost, n < 50 AS is_suppressed,
       CASE WHEN n < 50 THEN 'cohort_below_50' END AS suppression_reason
       FROM (SELECT merchant_id, campaign_id, count(DISTINCT tokenized_cardmember_id) AS n,
         count(DISTINCT tokenized_cardmember_id) FILTER (assignment_group = 'test') AS tn,
         count(DISTINCT tokenized_cardmember_id) FILTER (assignment_group = 'control') AS cn,
         coalesce(CAST(sum(CAST(transaction_amount AS DECIMAL(18,4))) FILTER (assignment_group = 'test') AS DOUBLE), 0.0) AS ts,
         coalesce(CAST(sum(CAST(transaction_amount AS DECIMAL(18,4))) FILTER (assignment_group = 'control') AS DOUBLE), 0.0) AS cs,
         coalesce(CAST(sum(CAST(calculated_reward_amount AS DECIMAL(18,4))) FILTER (assignment_group = 'test') AS DOUBLE), 0.0) AS rw
       FROM {{li}} WHERE assignment_group IN ('test', 'control') GROUP BY 1, 2)""")
def privacy_lift(d):
    return privacy.cohort_lift(d.test, d.control, ["merchant_id", "campaign_id"])


@query("""SELECT 'tokenized_cardmember_id' AS column_name, 'sensitive' AS kind, count(*) AS exposed_values FROM {matched}
       UNION ALL SELECT 'transaction_id', 'sensitive', count(*) FROM {matched}
       UNION ALL SELECT 'activation_id', 'sensitive', count(*) FROM {matched}""")
def column_gate(d):
    return privacy.column_gate(matched(d))


def pii_sql(kind: str, pattern: str) -> str:
    found = f"len(regexp_extract_all(text, '{pattern}'))"
    return (f"SELECT 'text' AS column_name, '{kind}' AS info_type, CAST(coalesce(sum({found}), 0) AS BIGINT) AS match_count, "
            f"count(*) FILTER ({found} > 0) AS row_count FROM " + "{documents}")


@query(" UNION ALL ".join(pii_sql(k, p) for k, p in privacy.PII_PATTERNS.items()))
def pii_scan(d):
    return privacy.pii_scan(d.documents, ["text"])


@query("SELECT doc_id, info_type, quote FROM (" + " UNION ALL ".join(
    f"SELECT doc_id, '{k}' AS info_type, unnest(regexp_extract_all(text, '{p}')) AS quote FROM " + "{documents}"
    for k, p in privacy.PII_PATTERNS.items()) + ")")
def pii_quotes(d):
    return privacy.pii_quotes(d.documents, "doc_id", "text")


#: Stands for the secret a deployment would pass.
CATALOGUE_SALT = "catalogue"


@query(f"""SELECT transaction_id, sha256('{CATALOGUE_SALT}' || CAST(tokenized_cardmember_id AS VARCHAR)) AS tokenized_cardmember_id,
       merchant_id, transaction_amount FROM {{tx}}""")
def masked_transactions(d):
    narrow = d.tx.select("transaction_id", "tokenized_cardmember_id", "merchant_id", "transaction_amount")
    return privacy.masked(narrow, ["tokenized_cardmember_id"], CATALOGUE_SALT)


ENTITLED = """SELECT 'desk_' || CAST(location_id % 4 AS VARCHAR) AS grantee, merchant_id FROM {merchant}"""


def entitlements(d: Domain) -> DataFrame:
    desk = F.concat(F.lit("desk_"), (F.col("location_id") % 4).cast("string"))
    return d.merchant.select(desk.alias("grantee"), "merchant_id")


@query(f"""SELECT e.grantee, l.line_id, l.merchant_id, l.transaction_amount FROM {{li}} l JOIN ({ENTITLED}) e
       USING (merchant_id)""")
def entitled_rows(d):
    rows = privacy.entitled_rows(d.li.select("line_id", "merchant_id", "transaction_amount"), entitlements(d))
    return rows.select("grantee", "line_id", "merchant_id", "transaction_amount")


@query(f"""SELECT line_id, merchant_id, transaction_amount FROM {{li}} WHERE merchant_id IN
       (SELECT merchant_id FROM ({ENTITLED}) WHERE grantee = 'desk_1')""")
def row_filter(d):
    rows = d.li.select("line_id", "merchant_id", "transaction_amount")
    return privacy.visible_to(rows, entitlements(d), "desk_1")


# ============================================================== lineage


@query("""SELECT 'gold_merchant_daily' AS gold_table_name, 'gmd_' || CAST(transaction_date AS VARCHAR) || '_' ||
       CAST(merchant_id AS VARCHAR) AS gold_row_id, 'fact_transactions_clean' AS source_table_name,
       'transaction_id' AS source_primary_key_column, CAST(transaction_id AS VARCHAR) AS source_primary_key_value,
       'gross_spend_input' AS source_role FROM {tx}
       UNION ALL SELECT 'gold_merchant_daily', 'gmd_' || CAST(transaction_date AS VARCHAR) || '_' ||
       CAST(merchant_id AS VARCHAR), 'fact_matched_offer_redemptions_clean', 'matched_redemption_id',
       matched_redemption_id, 'reward_cost_input' FROM {matched}""")
def lineage_detail(d):
    return lineage_rows(d)


def lineage_rows(d: Domain) -> DataFrame:
    grain = ("transaction_date", "merchant_id")
    spend = lineage.detail(d.tx, "gold_merchant_daily", "gmd", grain, "fact_transactions_clean",
                           "transaction_id", "gross_spend_input")
    reward = lineage.detail(matched(d), "gold_merchant_daily", "gmd", grain, "fact_matched_offer_redemptions_clean",
                            "matched_redemption_id", "reward_cost_input")
    return spend.unionByName(reward)


@query("""SELECT 'gold_merchant_daily' AS gold_table_name, 'gmd_' || CAST(transaction_date AS VARCHAR) || '_' ||
       CAST(merchant_id AS VARCHAR) AS gold_row_id, s AS source_table_name, r AS source_role, count(*) AS source_row_count,
       'transaction_amount >= 0' AS filter_condition, 'sum' AS aggregation_formula FROM (
       SELECT transaction_date, merchant_id, 'fact_transactions_clean' AS s, 'gross_spend_input' AS r FROM {tx}
       UNION ALL SELECT transaction_date, merchant_id, 'fact_matched_offer_redemptions_clean', 'reward_cost_input'
       FROM {matched}) GROUP BY ALL""")
def lineage_summary(d):
    return lineage.summary(lineage_rows(d), "transaction_amount >= 0", "sum")


# ============================================================== experiment


def moments_sql(source: str, p: str) -> str:
    return f"""SELECT campaign_id, n AS {p}_n, s / 100.0 / n AS {p}_mean,
       CASE WHEN n > 1 THEN greatest(0.0, (q - s * s / n) / (n - 1)) / 10000.0 END AS {p}_var FROM (
       SELECT campaign_id, count(*) AS n, CAST(sum(c) AS DOUBLE) AS s, CAST(sum(c * CAST(c AS HUGEINT)) AS DOUBLE) AS q
       FROM (SELECT campaign_id, tokenized_cardmember_id,
             CAST(sum(CAST(transaction_amount AS DECIMAL(18,2))) * 100 AS BIGINT) AS c FROM {source} GROUP BY 1, 2)
       GROUP BY 1)"""


BOTH_MOMENTS = f"({moments_sql('{test}', 'test')}) t JOIN ({moments_sql('{control}', 'control')}) c USING (campaign_id)"
SIX = ("test_n", "test_mean", "test_var", "control_n", "control_mean", "control_var")


def rounded(df: DataFrame, columns) -> DataFrame:
    return df.withColumns({c: F.round(c, 2) for c in columns})


@query(f"""SELECT campaign_id, test_n, round(test_mean, 2) AS test_mean, control_n, round(control_mean, 2) AS control_mean,
       round(mean_difference, 2) AS mean_difference, round(se, 2) AS standard_error,
       round(mean_difference - 1.96 * se, 2) AS ci_low, round(mean_difference + 1.96 * se, 2) AS ci_high,
       mean_difference - 1.96 * se > 0 OR mean_difference + 1.96 * se < 0 AS is_significant
       FROM (SELECT *, test_mean - control_mean AS mean_difference, sqrt(test_var / test_n + control_var / control_n) AS se
       FROM {BOTH_MOMENTS})""")
def significance(d):
    out = experiment.significance(d.test, d.control, ["campaign_id"]).drop("test_var", "control_var")
    return rounded(out, ("test_mean", "control_mean", "mean_difference", "standard_error", "ci_low", "ci_high"))


@query(f"""SELECT campaign_id, test_n, control_n, round((test_mean - control_mean) /
       sqrt((test_var + control_var) / 2.0), 6) AS standardized_difference,
       abs((test_mean - control_mean) / sqrt((test_var + control_var) / 2.0)) <= 0.1 AS is_balanced
       FROM {BOTH_MOMENTS}""")
def balance(d):
    out = experiment.balance(d.test, d.control, ["campaign_id"])
    return out.select("campaign_id", "test_n", "control_n",
                      F.round("standardized_difference", 6).alias("standardized_difference"), "is_balanced")


@query(f"""SELECT campaign_id, tokenized_cardmember_id, spend FROM (SELECT campaign_id, tokenized_cardmember_id,
       CAST(sum(CAST(transaction_amount AS DECIMAL(18,2))) AS DOUBLE) AS spend FROM {{li}} GROUP BY 1, 2)
       JOIN ({moments_sql('{li}', 'g')}) USING (campaign_id) WHERE abs(spend - g_mean) > 3.0 * sqrt(g_var)""")
def outliers(d):
    return experiment.outliers(d.li, ["campaign_id"]).select("campaign_id", "tokenized_cardmember_id", "spend")


TOLERANCES = {"historical_spend_90d": 4_000_000.0, "historical_transaction_count_90d": 16.0, "balance": 16_000.0}


def positioned(where: str) -> str:
    steps = ", ".join(f"floor({f} / {w * 0.25}) AS b{i}" for i, (f, w) in enumerate(TOLERANCES.items()))
    return f"""SELECT *, row_number() OVER (PARTITION BY segment_id, b0, b1, b2
       ORDER BY tokenized_cardmember_id % 64, tokenized_cardmember_id) AS position
       FROM (SELECT *, {steps} FROM {{card}} WHERE {where})"""


@query(f"""SELECT t.segment_id, t.tokenized_cardmember_id AS test_tokenized_cardmember_id,
       c.tokenized_cardmember_id AS control_tokenized_cardmember_id,
       1.0 - ({' + '.join(f'abs(t.{f} - c.{f}) / {w}' for f, w in TOLERANCES.items())}) / 3 AS match_quality_score
       FROM ({positioned("assignment_group = 'test'")}) t
       JOIN ({positioned("assignment_group = 'control'")}) c USING (segment_id, b0, b1, b2, position)""")
def control_matching(d):
    test, control = d.card.filter("assignment_group = 'test'"), d.card.filter("assignment_group = 'control'")
    return experiment.match_controls(test, control, ["segment_id"], TOLERANCES)


#: The day before which history counts, and what one unit of distance is for each numeric feature.
HISTORY_UNTIL = dt.date(2001, 4, 1)
HISTORY_TOLERANCES = {
    "customer_tenure_months": 12.0, "historical_spend_90d": 150_000.0, "historical_transaction_count_90d": 2.0,
    "average_ticket_size": 100_000.0, "merchant_affinity_score": 0.5, "category_affinity_score": 0.5,
}
HISTORY_SQL = f"""SELECT c.tokenized_cardmember_id, c.segment_id, c.location_id, c.assignment_group,
       coalesce(s.spend, 0.0) AS historical_spend_90d, coalesce(s.n, 0) AS historical_transaction_count_90d,
       CASE WHEN s.n > 0 THEN s.spend / s.n ELSE 0.0 END AS average_ticket_size,
       coalesce(m.share, 0.0) AS merchant_affinity_score, coalesce(g.share, 0.0) AS category_affinity_score,
       coalesce(12 * (year(DATE '{HISTORY_UNTIL}') - year(f.first)) + month(DATE '{HISTORY_UNTIL}') - month(f.first), 0)
         AS customer_tenure_months
       FROM {{card}} c
       LEFT JOIN (SELECT tokenized_cardmember_id, count(DISTINCT transaction_id) AS n,
                  CAST(sum(CAST(transaction_amount AS DECIMAL(18,2))) AS DOUBLE) AS spend FROM {{history}}
                  WHERE recent GROUP BY 1) s USING (tokenized_cardmember_id)
       LEFT JOIN (SELECT tokenized_cardmember_id, CAST(max(n) AS DOUBLE) / sum(n) AS share FROM (
                  SELECT tokenized_cardmember_id, merchant_id, count(*) AS n FROM {{history}} WHERE recent GROUP BY 1, 2)
                  GROUP BY 1) m USING (tokenized_cardmember_id)
       LEFT JOIN (SELECT tokenized_cardmember_id, CAST(max(n) AS DOUBLE) / sum(n) AS share FROM (
                  SELECT tokenized_cardmember_id, category_id, count(*) AS n FROM {{history}} WHERE recent GROUP BY 1, 2)
                  GROUP BY 1) g USING (tokenized_cardmember_id)
       LEFT JOIN (SELECT tokenized_cardmember_id, min(transaction_date) AS first FROM {{history}}
                  WHERE transaction_date < DATE '{HISTORY_UNTIL}' GROUP BY 1) f USING (tokenized_cardmember_id)"""


def history(d: Domain) -> DataFrame:
    cards = d.card.select("tokenized_cardmember_id", "segment_id", "location_id", "assignment_group")
    return assignment.history_features(d.history, cards, HISTORY_UNTIL)


@query(HISTORY_SQL)
def card_history(d):
    return history(d)


@query(f"""WITH f AS ({HISTORY_SQL}),
       pairs AS (SELECT t.segment_id, t.tokenized_cardmember_id AS t, c.tokenized_cardmember_id AS c,
         {" + ".join(f"abs(t.{f} - c.{f}) / {w!r}" for f, w in HISTORY_TOLERANCES.items())}
           + CASE WHEN t.location_id = c.location_id THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS distance
         FROM f t JOIN f c USING (segment_id) WHERE t.assignment_group = 'test' AND c.assignment_group = 'control'),
       chosen AS (SELECT list_reduce(list({{'t': [t], 'c': [c], 'd': [distance]}} ORDER BY distance, t % 64, t, c % 64, c), lambda a, b:
         CASE WHEN list_contains(a.t, b.t[1]) OR list_contains(a.c, b.c[1]) THEN a ELSE
           {{'t': list_concat(a.t, b.t), 'c': list_concat(a.c, b.c), 'd': list_concat(a.d, b.d)}} END) AS x
         FROM pairs WHERE 1.0 - distance / 8 >= 0.75 GROUP BY segment_id)
       SELECT unnest(x.t) AS test_tokenized_cardmember_id, unnest(x.c) AS control_tokenized_cardmember_id,
         unnest(x.d) AS distance, 1.0 - unnest(x.d) / 8 AS match_quality_score FROM chosen""")
def control_assignment(d):
    """All pairs, closest first, in the SQL; growing radii in Spark."""
    cards = history(d)
    test, control = cards.filter("assignment_group = 'test'"), cards.filter("assignment_group = 'control'")
    return assignment.assign_controls(test, control, ["segment_id"], ["location_id"], HISTORY_TOLERANCES)


# ============================================================== interval law, quantiles, detection, quarantine


@query("""SELECT member_id, effective_start_date, effective_end_date, covered_until,
       CASE WHEN effective_start_date <= covered_until THEN 'overlap' ELSE 'gap' END AS fault FROM (
       SELECT *, max(coalesce(effective_end_date, DATE '9999-12-31')) OVER (PARTITION BY member_id
         ORDER BY effective_start_date, coalesce(effective_end_date, DATE '9999-12-31') ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
         AS covered_until FROM {lease})
       WHERE effective_start_date <= covered_until OR effective_start_date > covered_until + 1""")
def interval_faults(d):
    return scd.interval_faults(d.lease, "member_id")


@query("""WITH v AS (SELECT *, max(coalesce(effective_end_date, DATE '9999-12-31')) OVER (PARTITION BY member_id
         ORDER BY effective_start_date, coalesce(effective_end_date, DATE '9999-12-31') ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
         AS until FROM {lease})
       SELECT 'member' AS table_name, check_name, failure_count, severity, 'failed' AS status FROM (
       SELECT 'overlapping_versions' AS check_name, count(*) AS failure_count, 'critical' AS severity FROM v WHERE effective_start_date <= until
       UNION ALL SELECT 'gaps_between_versions', count(*), 'high' FROM v WHERE effective_start_date > until + 1)""")
def checks_intervals(d):
    """Planted overlaps and gaps: terms of members that begin when an order was made."""
    return quality.check_intervals(d.lease, ScdSpec("customer", "member", "member_id", ("effective_end_date",)))


QUARTILES = """SELECT campaign_id, count(*) AS card_count, quantile_disc(spend, 0.25) AS first_quartile,
       quantile_disc(spend, 0.5) AS median_spend, quantile_disc(spend, 0.75) AS third_quartile FROM (
       SELECT campaign_id, tokenized_cardmember_id, CAST(sum(CAST(transaction_amount AS DECIMAL(18,2))) AS DOUBLE) AS spend
       FROM {li} GROUP BY 1, 2) GROUP BY 1"""


@query(f"""SELECT *, first_quartile - 1.5 * (third_quartile - first_quartile) AS lower_fence,
       third_quartile + 1.5 * (third_quartile - first_quartile) AS upper_fence FROM ({QUARTILES})""")
def spend_quantiles(d):
    return experiment.spend_quantiles(d.li, ["campaign_id"])


@query(f"""SELECT campaign_id, tokenized_cardmember_id, spend, median_spend, lower_fence, upper_fence FROM (
       SELECT campaign_id, tokenized_cardmember_id, CAST(sum(CAST(transaction_amount AS DECIMAL(18,2))) AS DOUBLE) AS spend
       FROM {{li}} GROUP BY 1, 2) JOIN (SELECT campaign_id, median_spend, first_quartile - 1.5 * (third_quartile - first_quartile)
       AS lower_fence, third_quartile + 1.5 * (third_quartile - first_quartile) AS upper_fence FROM ({QUARTILES})) USING (campaign_id)
       WHERE spend < lower_fence OR spend > upper_fence""")
def quantile_outliers(d):
    return experiment.quantile_outliers(d.li, ["campaign_id"])


DETECTED = f"""WITH t AS (SELECT transaction_id, tokenized_cardmember_id, merchant_id, transaction_timestamp, transaction_date,
         {REFUNDABLE} AS transaction_status FROM {{tx}}),
       x AS (SELECT * FROM {{redemption_feed}}),
       hits AS (
         SELECT transaction_id, 'duplicate_redemption' AS risk_rule_name, n - 1 AS evidence FROM (SELECT *, count(*) OVER w AS n,
           row_number() OVER (w ORDER BY transaction_timestamp, transaction_id) AS place FROM x
           WINDOW w AS (PARTITION BY tokenized_cardmember_id, offer_id)) WHERE place > 1
         UNION ALL SELECT l.transaction_id, 'refund_after_reward', 4 FROM {{liability}} l JOIN t USING (transaction_id)
           WHERE t.transaction_status IN ('refunded', 'reversed')
         UNION ALL SELECT transaction_id, 'high_redemption_velocity', n - 4 FROM (SELECT transaction_id, count(*) OVER (
           PARTITION BY tokenized_cardmember_id ORDER BY transaction_timestamp RANGE BETWEEN INTERVAL 24 HOUR PRECEDING AND CURRENT ROW) AS n
           FROM x) WHERE n >= 5
         UNION ALL SELECT t.transaction_id, 'merchant_location_anomaly', n - 2 FROM t JOIN (SELECT tokenized_cardmember_id, transaction_date,
           count(DISTINCT location_id) AS n FROM t JOIN {{merchant}} USING (merchant_id) GROUP BY 1, 2) USING (tokenized_cardmember_id, transaction_date)
           WHERE n > 2
         UNION ALL SELECT x.transaction_id, 'reward_gaming_pattern', m - 1 FROM x JOIN (SELECT tokenized_cardmember_id, m FROM
           (SELECT tokenized_cardmember_id, count(*) AS m FROM x GROUP BY 1) JOIN (SELECT tokenized_cardmember_id, count(*) AS n FROM t GROUP BY 1)
           USING (tokenized_cardmember_id) WHERE m >= 2 AND CAST(m AS DOUBLE) / n >= 0.1) USING (tokenized_cardmember_id))
       SELECT transaction_id, risk_rule_name, CAST(max(evidence) AS DOUBLE) AS evidence,
         round(least(0.5::DOUBLE + 0.1::DOUBLE * CAST(max(evidence) AS DOUBLE), 1.0::DOUBLE), 4) AS risk_score FROM hits GROUP BY 1, 2"""


def detection_inputs(d: Domain) -> tuple[DataFrame, ...]:
    return d.tx.withColumn("transaction_status", F.expr(REFUNDABLE)), d.redemption_feed, liability(d), d.merchant


@query(DETECTED)
def detected_hits(d):
    return abuse.detected_hits(*detection_inputs(d))


@query(f"""SELECT risk_rule_name, risk_event_status, count(*) AS event_count, count(DISTINCT transaction_id) AS transaction_count,
       {msum('risk_score')} AS total_score FROM (SELECT e.*, CASE WHEN risk_score >= 0.90 THEN 'open' WHEN risk_score >= 0.75
       THEN 'reviewed' ELSE 'confirmed_false_positive' END AS risk_event_status FROM ({DETECTED}) e
       JOIN {{risk_rule}} k USING (risk_rule_name) JOIN {{tx}} USING (transaction_id) WHERE k.is_active) GROUP BY 1, 2""")
def detected_events(d):
    """Events of the active rules that detection has found, by rule and status."""
    events = abuse.detected_events(*detection_inputs(d), d.risk_rule, redeemed(d))
    return events.groupBy("risk_rule_name", "risk_event_status").agg(
        F.count("*").alias("event_count"), F.countDistinct("transaction_id").alias("transaction_count"), money_sum("risk_score").alias("total_score"))


FEED_RULES = cleaning.contract_rules(
    TableSpec("feed", "transaction_id", "", timestamps=("transaction_timestamp",), dates=("transaction_date",), numerics=("transaction_amount",)),
    ("transaction_id", "transaction_timestamp", "transaction_date", "transaction_amount"))
FEED = TableSpec("feed", "transaction_id", "", timestamps=("transaction_timestamp",), dates=("transaction_date",), numerics=("transaction_amount",))
FEED_JUDGED = """SELECT *, (CASE WHEN transaction_id IS NULL THEN 1 ELSE 0 END)
       + (CASE WHEN transaction_amount IS NOT NULL AND TRY_CAST(transaction_amount AS DOUBLE) IS NULL THEN 1 ELSE 0 END)
       + (CASE WHEN transaction_timestamp IS NOT NULL AND TRY_CAST(transaction_timestamp AS TIMESTAMP) IS NULL THEN 1 ELSE 0 END) AS broken
       FROM {raw_feed}"""


def fed(d: Domain) -> DataFrame:
    return cleaning.sorted_out(d.raw_feed, FEED, FEED_RULES, place=("line",))


@query(f"""SELECT code, count(*) AS row_count, count(DISTINCT line) AS record_count FROM (
       SELECT unnest(list_filter([CASE WHEN transaction_id IS NULL THEN 'E01' END,
         CASE WHEN transaction_amount IS NOT NULL AND TRY_CAST(transaction_amount AS DOUBLE) IS NULL THEN 'E02' END,
         CASE WHEN transaction_timestamp IS NOT NULL AND TRY_CAST(transaction_timestamp AS TIMESTAMP) IS NULL THEN 'E03' END],
         lambda c: c IS NOT NULL)) AS code, line FROM {{raw_feed}}) GROUP BY 1""")
def quarantine_codes(d):
    rejected = fed(d).filter(F.col(cleaning.OUTCOME) == cleaning.REJECTED)
    rows = cleaning.quarantine_records(rejected, "feed", RUN)
    return rows.groupBy(F.col("validation_error_code").alias("code")).agg(
        F.count("*").alias("row_count"), F.countDistinct(F.get_json_object("record_payload", "$.source_line")).alias("record_count"))


@query(f"""SELECT rows_in, clean_rows, rejected_rows, duplicate_rows, rows_in - clean_rows - rejected_rows - duplicate_rows AS lost_rows
       FROM (SELECT count(*) AS rows_in, count(*) FILTER (broken > 0) AS rejected_rows,
       count(DISTINCT CASE WHEN broken = 0 THEN transaction_id END) AS clean_rows,
       count(*) FILTER (broken = 0) - count(DISTINCT CASE WHEN broken = 0 THEN transaction_id END) AS duplicate_rows
       FROM ({FEED_JUDGED}))""")
def quarantine_balance(d):
    """Rows in = clean + rejected + surplus copies; the copies are counted apart from the dedupe."""
    kept = fed(d).groupBy().agg(F.count_if(F.col(cleaning.OUTCOME) == cleaning.ACCEPTED).alias("clean_rows"),
                                F.count_if(F.col(cleaning.OUTCOME) == cleaning.REJECTED).alias("rejected_rows"))
    counted = cleaning.surplus_rows(d.raw_feed, "transaction_id", FEED_RULES)
    none = F.lit(0).cast("bigint")
    rows = kept.select(none.alias("rows_in"), "clean_rows", "rejected_rows", none.alias("duplicate_rows")).unionByName(
        counted.select(F.col("row_count").alias("rows_in"), none.alias("clean_rows"), none.alias("rejected_rows"), F.col("duplicate_count").alias("duplicate_rows")))
    sums = rows.agg(*(F.sum(c).alias(c) for c in rows.columns))
    return derive(sums, {"lost_rows": "rows_in - clean_rows - rejected_rows - duplicate_rows"})
