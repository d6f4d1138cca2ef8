"""Rule tables of the monthly lead run.

Fixed values: every label, threshold and code below must equal the original
business rules for the results to match.  They are listed plainly, in the
order the rules are evaluated.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Fixed values (business rules) — do not reorder: first match wins.
# ---------------------------------------------------------------------------

# Agent relationship class (servicing agent vs. policy).
REL_ORPHANED = "Orphaned"
REL_ORIGINAL = "Original Agent"
REL_REASSIGNED = "Reassigned Agent"
REL_COLLECTOR = "Orphaned-Collector"
REL_SM = "Orphaned-Agent is SM"
REL_UNKNOWN = "Unknown"
ORPHAN_CHANNELS = ("01", "04", "97", "98")
AGENCY_CHANNEL = "01"
COLLECTOR_CHANNEL = "04"
SM_CHANNELS = ("97", "98")
ASSIGNED_RELATIONSHIPS = (REL_ORIGINAL, REL_REASSIGNED)

# Agent status decode.
STATUS_DECODE = (("01", "Active"), ("99", "Terminated"))
STATUS_DEFAULT = "Unknown"

# Customer age band on current age (inclusive integer bounds).
AGE_BANDS = (
    ("lt", 18, "1. <18"),
    ("between", (18, 25), "2. 18-25"),
    ("between", (26, 35), "3. 26-35"),
    ("between", (36, 45), "4. 36-45"),
    ("between", (46, 55), "5. 46-55"),
    ("between", (56, 65), "6. 56-65"),
    ("gt", 65, "7. >65"),
)
AGE_DEFAULT = "Unknown"

# City category.
NAMED_CITIES = ("Hà Nội", "Hồ Chí Minh")
CITY_UNKNOWN = "Unknown"
CITY_OTHER = "Others"

LIFESTAGE_DEFAULT = "Undefined Segmentation"

# Monthly income band: lowest band is strictly positive.
INCOME_BANDS = (
    ("open_range", (0, 20000), "1) < 20M"),
    ("range", (20000, 40000), "2) 20-40M"),
    ("range", (40000, 60000), "3) 40-60M"),
    ("range", (60000, 80000), "4) 60-80M"),
    ("ge", 80000, "5) 80M+"),
)
INCOME_DEFAULT = "6) Unknown"

# Total annualised premium band: lowest band is open below.
PREMIUM_BANDS = (
    ("lt", 20000, "1) < 20M"),
    ("range", (20000, 40000), "2) 20-40M"),
    ("range", (40000, 60000), "3) 40-60M"),
    ("range", (60000, 80000), "4) 60-80M"),
    ("ge", 80000, "5) 80M+"),
)
PREMIUM_DEFAULT = "6) Unknown"

# Policy-count band.
POLICY_COUNT_BANDS = (
    ("eq", 1, "1"),
    ("eq", 2, "2"),
    ("between", (3, 5), "3-5"),
    ("gt", 5, ">5"),
)
POLICY_COUNT_DEFAULT = "NA"

# New vs existing customer.
CUS_NEW = "New"
CUS_EXISTING = "Existing"

# Value tier: (lower inclusive, upper exclusive or None, needs a long-tenure policy, label).
VALUE_TIERS = (
    (20000, 65000, True, "Silver"),
    (65000, 150000, False, "Gold"),
    (150000, 300000, False, "Platinum"),
    (300000, None, False, "Platinum Elite"),
)
VALUE_TIER_DEFAULT = "Not VIP"

# Near tier, same layout.
NEAR_TIERS = (
    (15000, 20000, True, "Near Silver"),
    (55000, 60000, False, "Near Gold1"),
    (60000, 65000, False, "Near Gold2"),
)
NEAR_TIER_DEFAULT = "Not Near VIP"

# Lead segments.
SEG_NEAR_VIP = "Near VIP"
SEG_VIP = "VIP"
SEG_NEW = "New"
SEG_HIGH_PROPENSITY = "High Propensity"
SEG_UNKNOWN = "Unknown"
SEG_OTHERS = "Others"
SILVER = "Silver"
NEW_INCOME_MIN = 20000

# Scorecard tier indicators: (output column, lower-case tier value).
TIER_INDICATORS = (
    ("mdrt_ind", "mdrt"),
    ("fc_ind", "fc"),
    ("1maa_ind", "1maa"),
    ("3maa_ind", "3maa"),
)

# Exclusion reasons in priority order: (flag column, label).
EXCLUSION_REASONS = (
    ("in_banca", "1) Joint Banca"),
    ("in_dmtm", "2) Joint DMTM"),
    ("sagt_rltv", "3) Agent is the Owner/Insured/Beneficiary"),
    ("in_onb", "4) Past Campaign Customer"),
    ("repurchased", "5) Repurchased 0-2 months from Onboarding"),
    ("unassigned", "6) Unassigned"),
)
NOT_EXCLUDED = "Not Excluded"
EXCLUSION_FLAGS = ("in_banca", "in_dmtm", "sagt_rltv", "in_onb", "repurchased", "unassigned")

# Propensity models.
EXISTING_HIT_DECILES = ("decile_ci", "decile_inv", "decile_lt", "decile_lp", "decile_med")
NEW_MODEL_DECILES = ("ci_decile", "invst_decile", "lt_decile")
TOP2 = (1, 2)
TOP3 = (1, 3)
