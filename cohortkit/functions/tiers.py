"""Business classifications built from the rule book."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortkit.functions import rulebook as R
from cohortkit.functions.rules import band, bound_predicate, classify, least_in


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def agent_relationship(sa_channel, sa_trmn_dt, sagt_cd, wa_cd_1, wa_cd_2) -> Column:
    """Relationship of the servicing agent to the policy (ordered rules)."""
    ch = _c(sa_channel)
    sagt = _c(sagt_cd)
    return classify(
        [
            (_c(sa_trmn_dt).isNotNull() & ch.isin(*R.ORPHAN_CHANNELS), R.REL_ORPHANED),
            ((ch == R.AGENCY_CHANNEL) & ((sagt == _c(wa_cd_1)) | (sagt == _c(wa_cd_2))), R.REL_ORIGINAL),
            (ch == R.AGENCY_CHANNEL, R.REL_REASSIGNED),
            (ch == R.COLLECTOR_CHANNEL, R.REL_COLLECTOR),
            (ch.isin(*R.SM_CHANNELS), R.REL_SM),
        ],
        R.REL_UNKNOWN,
    )


def status_decode(stat_cd) -> Column:
    c = _c(stat_cd)
    return classify([(c == code, label) for code, label in R.STATUS_DECODE], R.STATUS_DEFAULT)


def age_band(age) -> Column:
    return band(age, R.AGE_BANDS, R.AGE_DEFAULT)


def city_category(city) -> Column:
    c = _c(city)
    rules = [(c == name, name) for name in R.NAMED_CITIES]
    rules.append((c.isNull(), R.CITY_UNKNOWN))
    return classify(rules, R.CITY_OTHER)


def income_band(income) -> Column:
    return band(income, R.INCOME_BANDS, R.INCOME_DEFAULT)


def premium_band(total) -> Column:
    return band(total, R.PREMIUM_BANDS, R.PREMIUM_DEFAULT)


def policy_count_band(n) -> Column:
    return band(n, R.POLICY_COUNT_BANDS, R.POLICY_COUNT_DEFAULT)


def new_or_existing(first_join_dt, window_start: dt.date, month_end: dt.date) -> Column:
    """'New' when the first join date is in [window start, month end], else 'Existing'."""
    c = _c(first_join_dt)
    return classify([(c.between(F.lit(window_start), F.lit(month_end)), R.CUS_NEW)], R.CUS_EXISTING)


def _tier(total, long_tenure_cnt, table, default) -> Column:
    t, n = _c(total), _c(long_tenure_cnt)
    rules = []
    for lo, hi, needs_tenure, label in table:
        cond = (t >= lo) if hi is None else bound_predicate(t, "range", (lo, hi))
        if needs_tenure:
            cond = cond & (n >= 1)
        rules.append((cond, label))
    return classify(rules, default)


def value_tier(total, long_tenure_cnt) -> Column:
    return _tier(total, long_tenure_cnt, R.VALUE_TIERS, R.VALUE_TIER_DEFAULT)


def near_tier(total, long_tenure_cnt) -> Column:
    return _tier(total, long_tenure_cnt, R.NEAR_TIERS, R.NEAR_TIER_DEFAULT)


def _tier_rules(near_vip_cat, vip_cat):
    near, vip = _c(near_vip_cat), _c(vip_cat)
    return [
        ((near != R.NEAR_TIER_DEFAULT) & (vip != R.SILVER), R.SEG_NEAR_VIP),
        (vip != R.VALUE_TIER_DEFAULT, R.SEG_VIP),
    ]


def lead_segment(near_vip_cat, vip_cat, cus_type, mthly_incm) -> Column:
    """First-pass segment: Near VIP, VIP, New (with income), Others."""
    rules = _tier_rules(near_vip_cat, vip_cat)
    rules.append(((_c(cus_type) == R.CUS_NEW) & (_c(mthly_incm) >= R.NEW_INCOME_MIN), R.SEG_NEW))
    return classify(rules, R.SEG_OTHERS)


def tier_segment(near_vip_cat, vip_cat) -> Column:
    """Segment from the tiers only (scoring pass)."""
    return classify(_tier_rules(near_vip_cat, vip_cat), R.SEG_OTHERS)


def final_lead_segment(near_vip_cat, vip_cat, cus_type, need_key, new_key) -> Column:
    """Scoring-pass segment: tiers, then propensity, then 'Unknown' on missing deciles."""
    rules = _tier_rules(near_vip_cat, vip_cat)
    ct = _c(cus_type)
    rules += [
        ((ct == R.CUS_EXISTING) & least_in(R.EXISTING_HIT_DECILES, *R.TOP2), R.SEG_HIGH_PROPENSITY),
        ((ct == R.CUS_NEW) & least_in(R.NEW_MODEL_DECILES, *R.TOP3), R.SEG_NEW),
        (_c(need_key).isNotNull() & _any_null(R.EXISTING_HIT_DECILES), R.SEG_UNKNOWN),
        (_c(new_key).isNotNull() & _any_null(R.NEW_MODEL_DECILES), R.SEG_UNKNOWN),
    ]
    return classify(rules, R.SEG_OTHERS)


def _any_null(cols) -> Column:
    from cohortkit.functions.rules import any_null
    return any_null(cols)


def publish_segment(lead_segment_col, cus_type, top2_hp_model, hp_rules) -> Column:
    """Publish-pass segment: keep VIP tiers, then model hits, then 'Unknown'."""
    seg, ct = _c(lead_segment_col), _c(cus_type)
    top2, rules_hit = _c(top2_hp_model), _c(hp_rules)
    return classify(
        [
            (seg.isin(R.SEG_VIP, R.SEG_NEAR_VIP), seg),
            ((ct == R.CUS_EXISTING) & (top2 == 1), R.SEG_HIGH_PROPENSITY),
            ((ct == R.CUS_NEW) & (rules_hit == 1), R.SEG_NEW),
            ((ct == R.CUS_EXISTING) & top2.isNull(), R.SEG_UNKNOWN),
            ((ct == R.CUS_NEW) & rules_hit.isNull(), R.SEG_UNKNOWN),
        ],
        R.SEG_OTHERS,
    )
