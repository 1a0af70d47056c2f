"""Queries of this subpackage, with DuckDB SQL where it can express them."""

from . import bpe, collocations, exact_dedup, license_scan, maxent, near_dedup, packing, pii, quality, resampling, secrets_scan, topk, toxicity

QUERIES = {
    "op1_license_scan": license_scan.op1_license_scan,
    "op2_topk_search": topk.op2_topk_search,
    "op3_quality": quality.op3_quality,
    "op4_near_dedup": near_dedup.op4_near_dedup,
    "op5_secret_scan": secrets_scan.op5_secret_scan,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_bpe": bpe.op7_bpe,
    "op8_pii": pii.op8_pii,
    "op9_packing": packing.op9_packing,
    "op10_exact_dedup": exact_dedup.op10_exact_dedup,
    "op11_lm_scoring": maxent.op11_lm_scoring,
    "op12_resampling": resampling.op12_resampling,
    "op13_collocations": collocations.op13_collocations,
}

ORACLES = {
    "op2_topk_search": topk.ORACLE,
    "op4_near_dedup": near_dedup.ORACLE,
    "op10_exact_dedup": exact_dedup.ORACLE,
    "op13_collocations": collocations.ORACLE,
}
