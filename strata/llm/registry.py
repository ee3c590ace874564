"""The registered queries of this subpackage and their DuckDB SQL, where SQL can state them."""

from __future__ import annotations

from strata.llm.decontaminate import op4_decontamination
from strata.llm.jaccard_join import op10_ngram_jaccard_join
from strata.llm.langid import op1_language_id
from strata.llm.licenses import op2_license_scan
from strata.llm.mixing import ORACLE_SQL as MIX_SQL
from strata.llm.mixing import op7_source_mix
from strata.llm.periodic_runs import op11_periodic_runs
from strata.llm.pii import op6_pii
from strata.llm.preferences import ORACLE_SQL as PREFERENCE_SQL
from strata.llm.preferences import op9_preference_format
from strata.llm.prefix_forest import op8_prefix_forest
from strata.llm.secret_scan import op5_secret_scan
from strata.llm.spelling import op12_spelling_variants
from strata.llm.substrings import op3_substring_dedup
from strata.llm.token_counts import op13_token_counts

QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_license_scan": op2_license_scan,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_decontamination": op4_decontamination,
    "op5_secret_scan": op5_secret_scan,
    "op6_pii": op6_pii,
    "op7_source_mix": op7_source_mix,
    "op8_prefix_forest": op8_prefix_forest,
    "op9_preference_format": op9_preference_format,
    "op10_ngram_jaccard_join": op10_ngram_jaccard_join,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_token_counts": op13_token_counts,
}

ORACLE_SQL: dict[str, str] = {
    "op7_source_mix": MIX_SQL,
    "op9_preference_format": PREFERENCE_SQL,
}
