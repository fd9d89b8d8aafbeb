"""The subpackage's queries and their SQL."""

from lodestone.llm.bpe import op10_bpe
from lodestone.llm.exact_dedup import OP7_SQL, op7_exact_dedup
from lodestone.llm.fingerprint import op5_fingerprint
from lodestone.llm.hard_negatives import OP11_SQL, op11_hard_negatives
from lodestone.llm.language_id import op1_language_id
from lodestone.llm.lm_score import OP8_SQL, op8_lm_score
from lodestone.llm.ngram_join import OP2_SQL, op2_ngram_join
from lodestone.llm.packing import op4_packing
from lodestone.llm.periodic_runs import op13_periodic_runs
from lodestone.llm.quality import op6_quality
from lodestone.llm.secret_scan import op3_secret_scan
from lodestone.llm.substring_dedup import op9_substring_dedup
from lodestone.llm.token_files import op12_token_files

QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_ngram_join": op2_ngram_join,
    "op3_secret_scan": op3_secret_scan,
    "op4_packing": op4_packing,
    "op5_fingerprint": op5_fingerprint,
    "op6_quality": op6_quality,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_lm_score": op8_lm_score,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_bpe": op10_bpe,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_token_files": op12_token_files,
    "op13_periodic_runs": op13_periodic_runs,
}
ORACLES = {"op11_hard_negatives": OP11_SQL, "op2_ngram_join": OP2_SQL, "op7_exact_dedup": OP7_SQL, "op8_lm_score": OP8_SQL}
