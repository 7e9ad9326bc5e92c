"""The registered queries of this package, with SQL where SQL can say the same."""

from __future__ import annotations

from logquarry.llm.extendible_hash import OP2_SQL, op2_extendible_hash
from logquarry.llm.filter_audit import OP13_SQL, op13_filter_diagrams
from logquarry.llm.fuzzy_lines import op4_fuzzy_lines
from logquarry.llm.hidden_markov import op12_baum_welch
from logquarry.llm.kneser_ney import op9_kneser_ney
from logquarry.llm.mixing import op3_golden_mix
from logquarry.llm.ring import op5_bounded_ring
from logquarry.llm.secrets import op7_randomness_battery
from logquarry.llm.simhash_vptree import op1_simhash_vptree
from logquarry.llm.token_counts import op6_digest_cache
from logquarry.llm.weak_quality import op10_weak_labels
from logquarry.llm.whitening import op11_chebyshev_whitening
from logquarry.llm.wu_manber import OP8_SQL, op8_wu_manber

QUERIES = {
    "op1_simhash_vptree": op1_simhash_vptree,
    "op2_extendible_hash": op2_extendible_hash,
    "op3_golden_mix": op3_golden_mix,
    "op4_fuzzy_lines": op4_fuzzy_lines,
    "op5_bounded_ring": op5_bounded_ring,
    "op6_digest_cache": op6_digest_cache,
    "op7_randomness_battery": op7_randomness_battery,
    "op8_wu_manber": op8_wu_manber,
    "op9_kneser_ney": op9_kneser_ney,
    "op10_weak_labels": op10_weak_labels,
    "op11_chebyshev_whitening": op11_chebyshev_whitening,
    "op12_baum_welch": op12_baum_welch,
    "op13_filter_diagrams": op13_filter_diagrams,
}
ORACLES = {
    "op2_extendible_hash": OP2_SQL,
    "op8_wu_manber": OP8_SQL,
    "op11_chebyshev_whitening": op11_chebyshev_whitening,
    "op13_filter_diagrams": OP13_SQL,
}
