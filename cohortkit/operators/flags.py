"""Exclusion flags (Steps 5–6): contact history, channel overlap, related party,
repurchase, unassigned.

The owner-keyed flags are presence tests.  Instead of one DISTINCT side table
and one join per flag, every source contributes narrow ``(owner, flags…)``
rows to a single union that is restricted to the cohort's owners and reduced
with one grouped ``max`` (partial aggregation on the map side), then joined
to the leads once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortkit.functions import rulebook as R
from cohortkit.functions.rules import yn
from cohortkit.operators.cohort import owner_facts, policy_history
from cohortkit.operators.common import DEFAULT_BROADCAST_ROWS, bounded_broadcast, links_of, staged_broadcast
from cohortkit.params import RunParams
from cohortkit.sources.tables import RoleTables

# ---- sources of the owner-keyed flags --------------------------------------

def recent_targets(targets: DataFrame, p: RunParams) -> DataFrame:
    """Campaign targets of batches started after the recency cut-off."""
    return targets.where(F.col("batch_start_date") > F.lit(p.recency_cutoff))


def recent_target_insureds(targets: DataFrame, links: DataFrame, p: RunParams,
                           target_key: str = "tgt_cust_id", link_key: str = "pol_num",
                           owners: DataFrame | None = None) -> DataFrame:
    """Insureds linked to recent campaign targets.

    The join key pair is a parameter: the original joins the target's customer
    id to the link's *policy* number; pass ``link_key="cli_num"`` to match on
    the insured instead.
    """
    tg = recent_targets(targets, p).select(F.col(target_key).alias("_k"))
    ins = links.where(F.col("link_typ") == F.lit("I")).select(F.col(link_key).alias("_k"),
                                                              F.col("cli_num").alias("po_num"))
    if owners is not None:   # only insureds who are cohort owners can match (map-side filter)
        ins = ins.join(owners.select("po_num"), "po_num", "left_semi")
    return ins.join(tg.distinct(), "_k", "left_semi").select("po_num").distinct()


def agent_channel_flags(agent_mart: DataFrame, p: RunParams) -> DataFrame:
    """Per agent: is it a Banca agent, is its location a DMTM location (prefix)."""
    loc = F.col("loc_cd")
    dmtm = reduce(lambda a, b: a | b, (loc.startswith(x) for x in p.dmtm_prefixes))
    return agent_mart.groupBy("agt_code").agg(
        F.max((F.col("channel") == F.lit(p.banca_channel)).cast("int")).alias("banca"),
        F.max(dmtm.cast("int")).alias("dmtm"),
    )


def channel_overlap_owners(policy_mart: DataFrame, agent_mart: DataFrame, p: RunParams,
                           agent_flags: DataFrame | None = None) -> DataFrame:
    """Per owner with any flag: joint-Banca and joint-DMTM indicators (0/1).

    One pass over the policy mart looks both agents up in one small per-agent
    flag table, so the two channel tests share all their work.
    """
    flags = agent_flags if agent_flags is not None else bounded_broadcast(agent_channel_flags(agent_mart, p))
    wa = flags.select(F.col("agt_code").alias("wa_code"), F.col("banca").alias("wb"), F.col("dmtm").alias("wd"))
    sa = flags.select(F.col("agt_code").alias("sa_code"), F.col("banca").alias("sb"), F.col("dmtm").alias("sd"))
    df = policy_mart.join(wa, "wa_code", "left").join(sa, "sa_code", "left")
    banca = F.greatest(F.coalesce("wb", F.lit(0)), F.coalesce("sb", F.lit(0)))
    dmtm = F.greatest(F.coalesce("wd", F.lit(0)), F.coalesce("sd", F.lit(0)))
    return (df.select("po_num", banca.alias("banca"), dmtm.alias("dmtm"))
            .where((F.col("banca") == 1) | (F.col("dmtm") == 1)))


def last_issue_dates(t: RoleTables, p: RunParams, facts: DataFrame | None = None) -> DataFrame:
    """Per owner: latest issue date in [month start, month end + N months].

    Read from ``facts`` (:func:`cohortkit.operators.cohort.owner_facts`), or
    from the policy history of every owner.
    """
    facts = facts if facts is not None else owner_facts(policy_history(t, p)[0], p)
    return facts.where(F.col("last_pol_iss").isNotNull()).select("po_num", "last_pol_iss")


def _agent_flags(t: RoleTables, p: RunParams) -> DataFrame:
    """Per-agent channel flags, size-checked once per role-table set."""
    memo = t.__dict__.setdefault("_memo", {})
    key = ("agent_flags", p.banca_channel, p.dmtm_prefixes)
    if key not in memo:
        memo[key] = bounded_broadcast(agent_channel_flags(t.agent_mart, p))
    return memo[key]


# ---- the single grouped pass ---------------------------------------------

def _flag_rows(df: DataFrame, **values: Column) -> DataFrame:
    cols = {"f_po": F.lit(0), "f_ins": F.lit(0), "f_banca": F.lit(0), "f_dmtm": F.lit(0),
            "last_pol_iss": F.lit(None).cast("date")}
    cols.update(values)
    return df.select("po_num", *[v.alias(k) for k, v in cols.items()])


def owner_flags(t: RoleTables, p: RunParams, owners: DataFrame | None = None,
                insured_keys: tuple[str, str] = ("tgt_cust_id", "pol_num"),
                facts: DataFrame | None = None) -> DataFrame:
    """Owner-keyed flags in one grouped pass: contact (owner, insured, either),
    Banca, DMTM and the latest repurchase date.

    ``owners`` restricts every source to the cohort before the aggregation (the
    large sources — insured links, policy mart, policy history — are cut to
    the cohort owners before their joins).
    """
    one = F.lit(1)
    tgt = recent_targets(t.targets, p).select(F.col("tgt_cust_id").alias("po_num"))
    mart = t.policy_mart
    if owners is not None:
        mart = mart.join(owners.select("po_num"), "po_num", "left_semi")
    parts = [
        _flag_rows(tgt, f_po=one),
        _flag_rows(recent_target_insureds(t.targets, t.links, p, *insured_keys, owners=owners), f_ins=one),
        _flag_rows(channel_overlap_owners(mart, t.agent_mart, p, _agent_flags(t, p)),
                   f_banca=F.col("banca"), f_dmtm=F.col("dmtm")),
        _flag_rows(last_issue_dates(t, p, facts), last_pol_iss=F.col("last_pol_iss")),
    ]
    rows = reduce(DataFrame.unionByName, parts)
    if owners is not None:
        rows = rows.join(owners.select("po_num"), "po_num", "left_semi")
    agg = rows.groupBy("po_num").agg(
        F.max("f_po").alias("_po"), F.max("f_ins").alias("_ins"), F.max("f_banca").alias("_banca"),
        F.max("f_dmtm").alias("_dmtm"), F.max("last_pol_iss").alias("last_pol_iss"))
    return agg.select(
        "po_num",
        yn(F.col("_po") == 1).alias("in_onb_po"),
        yn(F.col("_ins") == 1).alias("in_onb_ins"),
        yn((F.col("_po") == 1) | (F.col("_ins") == 1)).alias("in_onb"),
        yn(F.col("_banca") == 1).alias("in_banca"),
        yn(F.col("_dmtm") == 1).alias("in_dmtm"),
        "last_pol_iss",
    )


# ---- policy-keyed: party IDs and the related-party flag ---------------------

def party_ids(t: RoleTables, p: RunParams, policies: DataFrame | None = None, reuse: str | None = None) -> DataFrame:
    """Distinct (policy, party ID) of the listed link types; NULL IDs dropped.

    This is the set of IDs per policy as rows, so no policy's parties are ever
    gathered into one value.
    """
    lnk = t.links.where(F.col("link_typ").isin(*p.party_link_types)).select("pol_num", "cli_num")
    if policies is not None:
        # cut map-side to the (size-checked) policies, written once and, within
        # its bound, broadcast to the client table, which is then not shuffled
        lnk = lnk.join(policies.select("pol_num"), "pol_num", "left_semi")
        if reuse is not None:
            lnk = staged_broadcast(lnk, DEFAULT_BROADCAST_ROWS, reuse, "party_links")
    dtl = t.client_details.where(F.col("id_num").isNotNull()).select("cli_num", "id_num")
    return lnk.join(dtl, "cli_num", "inner").select("pol_num", "id_num").distinct()


def party_id_sets(pairs: DataFrame) -> DataFrame:
    """Array form of :func:`party_ids`: sorted ``COLLECT_SET`` per policy."""
    return pairs.groupBy("pol_num").agg(F.array_sort(F.collect_set("id_num")).alias("dpdnt_id_list"))


def related_party_flag(rows: DataFrame, pairs: DataFrame, id_col: str = "sagt_id_num",
                       out: str = "sagt_rltv") -> DataFrame:
    """'Y' when the row's agent ID is one of its policy's party IDs.

    Same truth table as ``ARRAY_CONTAINS(set, CAST(id AS STRING))``: a NULL
    set or a NULL ID gives 'N'.  Done as a presence join on (policy, ID).
    """
    hit = pairs.select("pol_num", F.col("id_num").alias("_rid"), F.lit(1).alias("_hit"))
    j = rows.join(hit, (rows.pol_num == hit.pol_num) & (rows[id_col].cast("string") == hit._rid), "left")
    return j.select(rows["*"], yn(F.col("_hit") == 1).alias(out))


def unassigned_flag(rel_col: str = "cus_agt_rltnshp") -> Column:
    """'N' for an assigned relationship (Original / Reassigned), else 'Y' (NULL → 'Y')."""
    return F.when(F.col(rel_col).isin(*R.ASSIGNED_RELATIONSHIPS), F.lit("N")).otherwise(F.lit("Y"))


def repurchased_flag(last_col: str = "last_pol_iss", iss_col: str = "pol_iss_dt") -> Column:
    """'N' when the latest issue date is not after this policy's; NULL → 'Y'."""
    return F.when(F.col(last_col) <= F.col(iss_col), F.lit("N")).otherwise(F.lit("Y"))
