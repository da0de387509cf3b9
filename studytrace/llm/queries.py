"""The corpus queries by name, and their SQL where SQL can express them."""

from __future__ import annotations

from studytrace.llm.credentials import OP4_SQL, op4_secret_ownership
from studytrace.llm.fingerprints import OP10_SQL, op10_spot_classes, op10_spot_signatures
from studytrace.llm.importance import op9_importance_resampling
from studytrace.llm.mixing import OP2_SQL, op2_poisson_mix
from studytrace.llm.order_minhash import op6_order_minhash
from studytrace.llm.personal import op13_crf_personal
from studytrace.llm.pieces import op8_sentencepiece
from studytrace.llm.search import OP3_SQL, op3_pivot_distance
from studytrace.llm.sharding import op5_histogram_sort
from studytrace.llm.substrings import op7_suffix_dedup
from studytrace.llm.toxicity import op1_nnpu_toxicity
from studytrace.llm.trie import OP12_SQL, op12_conversation_trie
from studytrace.llm.whitening import op11_mixed_precision_whitening

QUERIES = {
    f.__name__: f
    for f in (
        op1_nnpu_toxicity,
        op2_poisson_mix,
        op3_pivot_distance,
        op4_secret_ownership,
        op5_histogram_sort,
        op6_order_minhash,
        op7_suffix_dedup,
        op8_sentencepiece,
        op9_importance_resampling,
        op10_spot_signatures,
        op10_spot_classes,
        op11_mixed_precision_whitening,
        op12_conversation_trie,
        op13_crf_personal,
    )
}
SQL = {
    "op2_poisson_mix": OP2_SQL,
    "op3_pivot_distance": OP3_SQL,
    "op4_secret_ownership": OP4_SQL,
    "op10_spot_signatures": OP10_SQL,
    "op12_conversation_trie": OP12_SQL,
}
