"""The operators' registered queries: opN_<name>(spark, sf_dir)."""

from __future__ import annotations

from functools import wraps

from paneltide.llm import (
    collision_ann, curve_packing, decontamination, flow_mixing, impact_topk, lpt_sharding, partenum_join, quality_bayes,
    run_length_index, secret_scan, spelling_variants, store, wavelet, whitening,
)


def _shipped(query):
    @wraps(query)
    def run(spark, sf_dir):
        store.ship(spark)
        return query(spark, sf_dir)

    return run


QUERIES = {
    "op1_quality_bayes": quality_bayes.q_op1,
    "op2_wavelet_shards": wavelet.q_op2,
    "op3_curve_packing": curve_packing.q_op3,
    "op4_run_length_index": run_length_index.q_op4,
    "op5_impact_topk": impact_topk.q_op5,
    "op6_flow_mixing": flow_mixing.q_op6,
    "op7_secret_scan": secret_scan.q_op7,
    "op8_partenum_join": partenum_join.q_op8,
    "op9_collision_ann": collision_ann.q_op9,
    "op10_lpt_sharding": lpt_sharding.q_op10,
    "op11_whitening": whitening.q_op11,
    "op12_decontamination": decontamination.q_op12,
    "op13_spelling_variants": spelling_variants.q_op13,
}
QUERIES = {name: _shipped(query) for name, query in QUERIES.items()}
ORACLE_SQL: dict[str, str] = {
    "op5_impact_topk": impact_topk.SQL_OP5,
    "op8_partenum_join": partenum_join.SQL_OP8,
    "op12_decontamination": decontamination.SQL_OP12,
    "op13_spelling_variants": spelling_variants.SQL_OP13,
}
