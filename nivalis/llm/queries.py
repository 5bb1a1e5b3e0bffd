"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from nivalis.llm.bpe import op6_bpe_encoding
from nivalis.llm.cross_tokenizer import op13_token_alignment
from nivalis.llm.language_id import op7_language_id
from nivalis.llm.lexical_search import OP12_SQL, op12_lexical_search
from nivalis.llm.mixing import OP8_SQL, op8_source_mixing
from nivalis.llm.ngram_join import OP9_SQL, op9_ngram_jaccard_join
from nivalis.llm.pitman_yor import op3_lm_scoring
from nivalis.llm.quality_classifier import op5_quality_classifier
from nivalis.llm.quality_rules import op4_quality_rules
from nivalis.llm.sharding import op10_sharding
from nivalis.llm.suffix_dedup import op1_suffix_dedup
from nivalis.llm.token_files import op11_token_files
from nivalis.llm.topk import OP2_SQL, op2_exact_topk

QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_exact_topk": op2_exact_topk,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_quality_rules": op4_quality_rules,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_bpe_encoding": op6_bpe_encoding,
    "op7_language_id": op7_language_id,
    "op8_source_mixing": op8_source_mixing,
    "op9_ngram_jaccard_join": op9_ngram_jaccard_join,
    "op10_sharding": op10_sharding,
    "op11_token_files": op11_token_files,
    "op12_lexical_search": op12_lexical_search,
    "op13_token_alignment": op13_token_alignment,
}

ORACLE_SQL: dict[str, str] = {
    "op2_exact_topk": OP2_SQL,
    "op8_source_mixing": OP8_SQL,
    "op9_ngram_jaccard_join": OP9_SQL,
    "op12_lexical_search": OP12_SQL,
}
