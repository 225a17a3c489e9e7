"""The registered queries of this subpackage."""

from __future__ import annotations

from .alignment import op13_cross_tokenizer_alignment
from .byte_bpe import op11_byte_bpe
from .exact_dedup import OP4_SQL, op4_exact_dedup
from .fingerprints import op2_fingerprints
from .hard_negatives import OP12_SQL, op12_hard_negatives
from .html_wrappers import op10_html_wrappers
from .jaccard_join import op5_ngram_jaccard_join
from .licenses import op9_license_scan
from .mixing import op6_mix_sources
from .packing import op8_packing
from .quality import op7_quality_classifier
from .records import op3_token_records
from .secrets import op1_secret_scan

QUERIES = {f.__name__: f for f in (op1_secret_scan, op2_fingerprints, op3_token_records, op4_exact_dedup, op5_ngram_jaccard_join, op6_mix_sources, op7_quality_classifier, op8_packing, op9_license_scan, op10_html_wrappers, op11_byte_bpe, op12_hard_negatives, op13_cross_tokenizer_alignment)}

#: DuckDB SQL of those queries that SQL expresses on whole tables.
ORACLE_SQL: dict[str, str] = {"op4_exact_dedup": OP4_SQL, "op12_hard_negatives": OP12_SQL}
