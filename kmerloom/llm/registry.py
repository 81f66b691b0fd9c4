"""The queries of this subpackage and, where SQL can express them, their DuckDB SQL."""

from .embedding_dedup import op1_embedding_dedup
from .exact_dedup import op13_exact_dedup
from .hard_negatives import op11_hard_negatives
from .html_text import op5_html_text
from .language_id import op10_language_id
from .mixing import mixing_targets, op7_mixing
from .oracles import EMBEDDINGS, EXACT, MIXING_TARGETS, NEGATIVES, PHRASES, QUALITY_COUNTS, SUFFIXES
from .phrases import op12_phrase_mining
from .pii import op6_pii_surrogates
from .quality import op4_quality_rules, quality_base_counts
from .sentencepieces import op8_sentencepieces
from .simhash import op3_simhash
from .suffix_dedup import op2_suffix_dedup
from .token_records import op9_token_records

QUERIES = {
    "op1_embedding_dedup": op1_embedding_dedup,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_simhash": op3_simhash,
    "op4_quality_rules": op4_quality_rules,
    "op5_html_text": op5_html_text,
    "op6_pii_surrogates": op6_pii_surrogates,
    "op7_mixing": op7_mixing,
    "op8_sentencepieces": op8_sentencepieces,
    "op9_token_records": op9_token_records,
    "op10_language_id": op10_language_id,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_phrase_mining": op12_phrase_mining,
    "op13_exact_dedup": op13_exact_dedup,
    "quality_base_counts": quality_base_counts,
    "mixing_targets": mixing_targets,
}

ORACLES: dict[str, str] = {
    "op1_embedding_dedup": EMBEDDINGS,
    "op2_suffix_dedup": SUFFIXES,
    "op11_hard_negatives": NEGATIVES,
    "op12_phrase_mining": PHRASES,
    "op13_exact_dedup": EXACT,
    "quality_base_counts": QUALITY_COUNTS,
    "mixing_targets": MIXING_TARGETS,
}
