"""The registered queries of this folder and their DuckDB SQL."""

from __future__ import annotations

from cohortkit.llm import (
    alignment,
    centroids,
    chat,
    decontaminate,
    fingerprint,
    html_text,
    near_dedup,
    packing,
    quality,
    secrets,
    sharding,
    toxicity,
    warc,
)

QUERIES = {
    "op1_quality_cnn": quality.op1,
    "op2_warc_salvage": warc.op2,
    "op3_iblt_fingerprint": fingerprint.op3,
    "op4_secret_worklist": secrets.op4,
    "op5_toxicity_chain": toxicity.op5,
    "op6_dart_minhash": near_dedup.op6,
    "op7_reply_tree_chat": chat.op7,
    "op8_best_fit_pack": packing.op8,
    "op9_decontaminate": decontaminate.op9,
    "op10_main_text": html_text.op10,
    "op11_shared_cuts": alignment.op11,
    "op12_hypergeometric_shards": sharding.op12,
    "op13_vantage_clusters": centroids.op13,
}

ORACLES = {
    "op2_warc_salvage": warc.OP2_SQL,
    "op7_reply_tree_chat": chat.OP7_SQL,
    "op9_decontaminate": decontaminate.OP9_SQL,
    "op13_vantage_clusters": centroids.OP13_SQL,
}
