"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from .decontamination import OP2_SQL, op2_winnowing
from .hard_negatives import OP12_SQL, op12_strassen_negatives
from .html_text import op8_host_paths
from .knn import OP6_SQL, op6_voronoi_top_k
from .language import op9_crf_language
from .licences import op7_rare_licence_words
from .ngram_trie import op13_elias_fano_scores
from .pii import op1_bootstrapped_pii
from .sentencepiece_viterbi import op5_sentencepiece
from .sharding import op3_feistel_shards
from .simhash import op4_simhash
from .substrings import OP10_SQL, op10_fixed_blocks
from .vector_codes import OP11_SQL, op11_hilbert_codes

QUERIES = {
    "op1_bootstrapped_pii": op1_bootstrapped_pii,
    "op2_winnowing": op2_winnowing,
    "op3_feistel_shards": op3_feistel_shards,
    "op4_simhash": op4_simhash,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_voronoi_top_k": op6_voronoi_top_k,
    "op7_rare_licence_words": op7_rare_licence_words,
    "op8_host_paths": op8_host_paths,
    "op9_crf_language": op9_crf_language,
    "op10_fixed_blocks": op10_fixed_blocks,
    "op11_hilbert_codes": op11_hilbert_codes,
    "op12_strassen_negatives": op12_strassen_negatives,
    "op13_elias_fano_scores": op13_elias_fano_scores,
}

ORACLE_SQL: dict[str, str] = {
    "op2_winnowing": OP2_SQL,
    "op6_voronoi_top_k": OP6_SQL,
    "op10_fixed_blocks": OP10_SQL,
    "op11_hilbert_codes": OP11_SQL,
    "op12_strassen_negatives": OP12_SQL,
}
