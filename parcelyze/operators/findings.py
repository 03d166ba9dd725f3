"""Grounded root-cause findings for flagged sellers (retrieve -> classify ->
draft -> validate), as column expressions over ALL flagged sellers at once.

One plan: z-scores -> top-N flagged -> joined to the stage breakdown ->
dominant stage -> narrative + recommendation -> groundedness check. There is
no per-seller loop or query; every step is a projection over the joined rows.
Numbers are formatted HALF_UP by one shared formatter, so the narrative and
the validator always agree on the text of a number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import fmt_fixed, r2
from . import analytics as A
from . import stats as S

# Stage labels (in tie-break order), recommendation texts,
# narrative template pieces and validator notes.
STAGE_PROCESSING = "processing (purchase -> approval)"
STAGE_PICKUP = "carrier pickup (approval -> carrier)"
STAGE_SHIPPING = "shipping (carrier -> customer)"
RECOMMENDATION = {
    STAGE_PICKUP: ("Investigate this seller's carrier hand-off process (warehouse pickup scheduling or "
                   "carrier capacity) — this is where the delay is concentrated, not in order processing "
                   "or in-transit time."),
    STAGE_SHIPPING: ("Investigate this seller's carrier/route choice for in-transit delay — processing and "
                     "pickup are not the bottleneck. Consider comparing carriers used by on-time sellers in "
                     "the same region."),
    STAGE_PROCESSING: ("Investigate this seller's order-processing/approval workflow — delay is concentrated "
                       "before the item even reaches a carrier, suggesting an internal operational bottleneck."),
}
NARRATIVE = ("Seller {seller} shows an average delivery delay of {delay} days across {orders} "
             "single-seller orders (z-score {z} vs. the seller population). The largest contributor "
             "is the '{stage}' stage, averaging {stage_days} days, compared to {proc}d processing and "
             "{ship}d shipping for the other stages.")
GROUNDED_NOTE = "all figures traced to retrieved SQL/statistical context"
UNGROUNDED_NOTE = "UNGROUNDED figures found: "
DECIMAL_NUMBER = r"(-?\d+\.\d+)"


def dominant_stage(proc: Column, pickup: Column, ship: Column) -> Column:
    """AG2: argmax of the three stage averages, NULL -> 0, earlier stage wins ties."""
    p, c, s = (F.coalesce(x, F.lit(0.0)) for x in (proc, pickup, ship))
    return (F.when((p >= c) & (p >= s), F.lit(STAGE_PROCESSING))
            .when(c >= s, F.lit(STAGE_PICKUP)).otherwise(F.lit(STAGE_SHIPPING)))


def _template(**parts) -> Column:
    out, rest = [], NARRATIVE
    while "{" in rest:
        pre, _, tail = rest.partition("{")
        key, _, rest = tail.partition("}")
        out += [F.lit(pre), parts[key]]
    out.append(F.lit(rest))
    return F.concat(*out)


def groundedness(narrative: Column, sources: list[Column]):
    """AG5: every decimal number in the text must be one of the formatted
    source numbers. Returns (grounded, notes)."""
    found = F.array_distinct(F.regexp_extract_all(narrative, F.lit(DECIMAL_NUMBER), 1))
    src = F.filter(F.array(*sources), lambda x: x.isNotNull())
    bad = F.array_sort(F.array_except(found, src))
    grounded = F.size(bad) == 0
    listed = F.concat(F.lit("{"), F.array_join(F.transform(bad, lambda x: F.concat(
        F.lit("'"), x, F.lit("'"))), ", "), F.lit("}"))
    return grounded, F.when(grounded, F.lit(GROUNDED_NOTE)).otherwise(
        F.concat(F.lit(UNGROUNDED_NOTE), listed))


def draft_findings(ctx: DataFrame) -> DataFrame:
    """AG2-AG6 over a context frame with seller_id, order_count, avg_delay_days,
    avg_processing_days, avg_carrier_pickup_days, avg_shipping_days, z_score
    (z may be NULL: printed as 0.00 but not a grounding source)."""
    proc = F.coalesce("avg_processing_days", F.lit(0.0))
    pick = F.coalesce("avg_carrier_pickup_days", F.lit(0.0))
    ship = F.coalesce("avg_shipping_days", F.lit(0.0))
    stage = dominant_stage(F.col("avg_processing_days"), F.col("avg_carrier_pickup_days"),
                           F.col("avg_shipping_days"))
    stage_days = (F.when(stage == STAGE_PROCESSING, proc)
                  .when(stage == STAGE_PICKUP, pick).otherwise(ship))
    z = F.col("z_score")
    narrative = _template(
        seller=F.col("seller_id"), delay=fmt_fixed("avg_delay_days", 1),
        orders=F.col("order_count").cast("string"),
        z=fmt_fixed(F.coalesce(z, F.lit(0.0)), 2), stage=stage,
        stage_days=fmt_fixed(stage_days, 1), proc=fmt_fixed(proc, 1), ship=fmt_fixed(ship, 1))
    rec = (F.when(stage == STAGE_PICKUP, F.lit(RECOMMENDATION[STAGE_PICKUP]))
           .when(stage == STAGE_SHIPPING, F.lit(RECOMMENDATION[STAGE_SHIPPING]))
           .otherwise(F.lit(RECOMMENDATION[STAGE_PROCESSING])))
    sources = [fmt_fixed(proc, 1), fmt_fixed(pick, 1), fmt_fixed(ship, 1),
               fmt_fixed("avg_delay_days", 1), F.when(z.isNotNull(), fmt_fixed(z, 2))]
    grounded, notes = groundedness(F.col("narrative"), sources)
    return (ctx.select("*", stage.alias("dominant_stage"), narrative.alias("narrative"),
                       rec.alias("recommendation"))
            .select(
                "seller_id", F.col("order_count").cast("int").alias("order_count"),
                r2("avg_delay_days").alias("avg_delay_days"),
                r2(F.coalesce(z, F.lit(0.0))).alias("z_score"),
                "dominant_stage",
                F.create_map(F.lit(STAGE_PROCESSING), proc, F.lit(STAGE_PICKUP), pick,
                             F.lit(STAGE_SHIPPING), ship).alias("stage_breakdown"),
                "narrative", "recommendation", grounded.alias("grounded"),
                notes.alias("grounding_notes")))


def investigate(fact: DataFrame, sellers: DataFrame) -> DataFrame:
    """AG1 + AG6: findings for a set of (seller_id, z_score) rows; sellers with
    no single-seller orders produce nothing (inner join). ``sellers`` is read by
    one join only: a limited set that is not stable between two evaluations
    cannot lose a seller."""
    return draft_findings(A.root_cause_breakdown(fact, sellers.select("seller_id", "z_score")))


def seller_findings(fact: DataFrame, top_n: int | None = 5, min_orders: int = 10,
                    z_threshold: float = 1.5) -> DataFrame:
    """AG7: z-scores -> top-N flagged sellers -> findings, one plan."""
    z = S.seller_zscore(fact, min_orders, z_threshold)
    return investigate(fact, S.flagged_sellers(z, top_n))
