"""Propensity scoring (Step 8) and the publish-pass segment (Step 9)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortkit.functions import rulebook as R
from cohortkit.functions.dates import month_key_from_text
from cohortkit.functions.rules import least_in, typed_null
from cohortkit.functions.tiers import final_lead_segment, tier_segment
from cohortkit.params import RunParams

NEED_DECILES = ["decile_acc", "decile_ci", "decile_med", "decile_inv", "decile_lp", "decile_lt"]
NEED_HML = ["hml_acc", "hml_ci", "hml_med", "hml_inv", "hml_lp", "hml_lt"]
SCORING_COLUMNS = [
    "po_num", "pol_num", "sagt_cd", "cus_type", "near_vip_cat", "vip_cat", "lead_segment",
    "final_lead_segment", *NEED_DECILES, *NEED_HML, "offer_acc", "offer_ci", "offer_edu", "offer_inv",
    "offer_term", "offer_ul", "top2_hp_model", "hp_model", "hp_rules", "offer_lt", "onb_mth_yr",
]


def new_model_month(new_need: DataFrame, month_key: str) -> DataFrame:
    """Rows of the new-customer model whose ``yyyy-MM`` month is the run month.

    The original joins on a key computed from the right side's month text; the
    left side's key is one constant, so filtering the right side first gives
    the same rows and lets the join use the owner alone.
    """
    return new_need.where(month_key_from_text("month") == F.lit(month_key))


def _offer(c: str) -> Column:
    return F.when(F.col(c).between(*R.TOP3), F.lit(1)).otherwise(F.lit(0))


def _hit(cols, bounds, key: str) -> Column:
    return F.when(least_in(cols, *bounds) & F.col(key).isNotNull(), F.lit(1)).otherwise(F.lit(0))


def with_propensity(leads: DataFrame, need: DataFrame, new_need: DataFrame, p: RunParams,
                    owners: DataFrame | None = None) -> DataFrame:
    """Attach both propensity models to the leads (left joins on the owner).

    With ``owners`` (the size-checked cohort owners) both models are first cut
    to them, map-side, so that neither whole model is shuffled.
    """
    nd = need.select(F.col("cli_num").alias("po_num"), F.col("cli_num").alias("_need_key"),
                     *NEED_DECILES, *NEED_HML)
    nn = new_model_month(new_need, p.month_key).select(
        "po_num", F.col("po_num").alias("_new_key"), *R.NEW_MODEL_DECILES)
    if owners is not None:
        keys = owners.select("po_num")
        nd, nn = nd.join(keys, "po_num", "left_semi"), nn.join(keys, "po_num", "left_semi")
    return leads.join(nd, "po_num", "left").join(nn, "po_num", "left")


def scoring_columns() -> dict[str, Column]:
    """Scoring-pass columns (name → expression) over a :func:`with_propensity` frame."""
    cols = {
        "lead_segment": tier_segment("near_vip_cat", "vip_cat"),
        "final_lead_segment": final_lead_segment("near_vip_cat", "vip_cat", "cus_type", "_need_key", "_new_key"),
    }
    cols.update({c: F.col(c) for c in NEED_DECILES + NEED_HML})
    cols.update({
        "offer_acc": typed_null("int"),
        "offer_ci": _offer("ci_decile"),
        "offer_edu": typed_null("int"),
        "offer_inv": _offer("invst_decile"),
        "offer_term": typed_null("int"),
        "offer_ul": typed_null("int"),
        "top2_hp_model": _hit(R.EXISTING_HIT_DECILES, R.TOP2, "_need_key"),
        "hp_model": _hit(R.EXISTING_HIT_DECILES, R.TOP3, "_need_key"),
        "hp_rules": _hit(R.NEW_MODEL_DECILES, R.TOP3, "_new_key"),
        "offer_lt": _offer("lt_decile"),
    })
    return cols


def score_leads(final: DataFrame, need: DataFrame, new_need: DataFrame, p: RunParams,
                owners: DataFrame | None = None) -> DataFrame:
    """Step 8: one row per lead × propensity match, 31 columns."""
    base = final.drop(*[c for c in NEED_DECILES + NEED_HML if c in final.columns])
    df = with_propensity(base, need, new_need, p, owners)
    return df.select("po_num", "pol_num", "sagt_cd", "cus_type", "near_vip_cat", "vip_cat",
                     *[c.alias(n) for n, c in scoring_columns().items()], "onb_mth_yr")
