"""The subpackage's registered queries, and SQL for those that it can express."""

from __future__ import annotations

from sluice.llm import (decontaminate, fingerprint, language, linededup, merkle, mixing, pii, setjoin, sharding,
                        simhash, spelling, toxicity, urlfilter)

QUERIES = {f.__name__: f for f in (
    linededup.op1_line_dedup, mixing.op2_temperature_mixing, setjoin.op3_ngram_jaccard_join, urlfilter.op4_url_filter,
    fingerprint.op5_iblt_fingerprint, pii.op6_pii_boosting, sharding.op7_hilbert_sharding, toxicity.op8_toxicity,
    decontaminate.op9_benchmark_decontamination, language.op10_language_id,
    spelling.op11_spelling_variants, merkle.op12_merkle_manifest, simhash.op13_simhash_ball)}

ORACLES = {"op2_temperature_mixing": mixing.ORACLE, "op9_benchmark_decontamination": decontaminate.ORACLE,
           "op11_spelling_variants": spelling.ORACLE, "op12_merkle_manifest": merkle.ORACLE}
