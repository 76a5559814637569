"""A small raw lake in the full domain schema, derived from the driver's tables."""

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from spendlens.operators import finance, matching
from spendlens.plans.bindings import Domain
from spendlens.sources import contracts as C
from spendlens.sources.lake import Lake


def shaped(df, spec):
    """Cast to the contract; columns the source lacks become typed nulls."""
    fields = StructType.fromDDL(spec.schema).fields
    return df.select(*(
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields
    ))


def write_raw(spark, root, folder):
    d = Domain(spark, folder)
    lake = Lake(spark, root)
    redemptions = matching.first_redemption(d.tx, d.act, d.offer)
    liability = finance.reward_liability(redemptions)
    settled = finance.settlements(d.tx, d.merchant, liability)
    control = d.act.join(d.offer.select("offer_id", "campaign_id", "merchant_id"), "offer_id").select(
        F.concat(F.lit("c"), F.col("activation_id").cast("string")).alias("control_transaction_id"),
        F.concat(F.lit("t"), F.col("activation_id").cast("string")).alias("transaction_id"),
        "tokenized_cardmember_id", "merchant_id", "campaign_id", "offer_id",
        F.col("activation_timestamp").alias("transaction_timestamp"),
        F.col("activation_date").alias("transaction_date"),
        (F.col("offer_id") + 20).cast("double").alias("transaction_amount"),
        F.lit(0.8).alias("match_quality_score"))
    control_tx = control.withColumn("transaction_status", F.lit("refunded"))
    days = d.tx.select(F.col("transaction_date").alias("calendar_date")).distinct()
    tables = {
        "dim_category": d.category,
        "dim_location": d.nation.select(F.col("n_nationkey").alias("location_id"), F.col("n_name").alias("state")),
        "dim_segment": d.card.select("segment_id").distinct(),
        "dim_risk_rule": d.risk_rule,
        "dim_merchant": d.merchant,
        "dim_campaign": d.campaign,
        # a reward never above the spend it asks for, as the mart's ratio check demands
        "dim_offer": d.offer.withColumn(
            "minimum_spend_amount", F.greatest("minimum_spend_amount", "reward_amount")),
        "dim_cardmember_token": d.card,
        "dim_privacy_consent": d.consent,
        "dim_date": days.withColumn("date_id", F.date_format("calendar_date", "yyyyMMdd")),
        "fact_transactions": d.tx.select(*(F.col(c).cast("string") if c == "transaction_id" else c
                                           for c in d.tx.columns)).unionByName(
            control_tx.select(*d.tx.columns)),
        "fact_offer_customer_assignment": d.assignment,
        "fact_offer_impressions": d.imp,
        "fact_offer_activations": d.act,
        "fact_offer_redemptions": redemptions,
        "fact_control_group_transactions": control,
        "fact_reward_liability": liability,
        "fact_merchant_settlements": settled,
        "fact_fraud_risk_events": d.tx.filter("transaction_status = 'refunded'").select(
            F.concat(F.lit("f"), F.col("transaction_id").cast("string")).alias("fraud_event_id"), "transaction_id",
            F.col("transaction_date").alias("event_date"), F.col("transaction_timestamp").alias("event_timestamp"),
            F.lit(0.9).alias("risk_score")),
        "fact_data_quality_reconciliation": finance.reconciliation(d.tx, settled),
    }
    for spec in C.SOURCE_TABLES:
        lake.write(shaped(tables[spec.name], spec), "raw", spec.name)
    return lake
