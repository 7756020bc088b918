"""Queries of this folder by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from scalargrid.llm import exact_dedup, licenses
from scalargrid.llm.exact_dedup import op10_exact_dedup
from scalargrid.llm.language import op3_rank_order_language
from scalargrid.llm.licenses import op12_rare_word_licences
from scalargrid.llm.mixing import op7_temperature_mixing
from scalargrid.llm.packing import op6_best_fit_packing
from scalargrid.llm.periodic import op13_periodic_runs
from scalargrid.llm.privacy import op1_weak_privacy
from scalargrid.llm.sharding import op9_hash_ring
from scalargrid.llm.simhash import op5_simhash_golay
from scalargrid.llm.sketches import op2_bottom_k
from scalargrid.llm.token_files import op4_token_files
from scalargrid.llm.toxicity import op8_gru_toxicity
from scalargrid.llm.whitening import op11_chebyshev_whitening

QUERIES = {
    "op1_weak_privacy": op1_weak_privacy,
    "op2_bottom_k": op2_bottom_k,
    "op3_rank_order_language": op3_rank_order_language,
    "op4_token_files": op4_token_files,
    "op5_simhash_golay": op5_simhash_golay,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_temperature_mixing": op7_temperature_mixing,
    "op8_gru_toxicity": op8_gru_toxicity,
    "op9_hash_ring": op9_hash_ring,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_chebyshev_whitening": op11_chebyshev_whitening,
    "op12_rare_word_licences": op12_rare_word_licences,
    "op13_periodic_runs": op13_periodic_runs,
}
ORACLES: dict[str, str] = {"op10_exact_dedup": exact_dedup.ORACLE_SQL, "op12_rare_word_licences": licenses.ORACLE_SQL}
