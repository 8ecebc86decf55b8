"""The queries of this subpackage and the SQL they must agree with."""

from __future__ import annotations

from . import (
    alignment,
    capture_index,
    collocations,
    exact_dedup,
    katz,
    mixing,
    neighbours,
    ngram_join,
    packing,
    quality_rules,
    secret_ledger,
    sharding,
    site_quality,
)

QUERIES = {
    "op9_capture_index": capture_index.op9_capture_index,
    "op10_ngram_join": ngram_join.op10_ngram_join,
    "op1_mixing": mixing.op1_mixing,
    "op2_secret_ledger": secret_ledger.op2_secret_ledger,
    "op3_katz": katz.op3_katz,
    "op4_sharding": sharding.op4_sharding,
    "op5_site_quality": site_quality.op5_site_quality,
    "op6_packing": packing.op6_packing,
    "op7_quality_rules": quality_rules.op7_quality_rules,
    "op8_exact_dedup": exact_dedup.op8_exact_dedup,
    "op11_alignment": alignment.op11_alignment,
    "op12_collocations": collocations.op12_collocations,
    "op13_neighbours": neighbours.op13_neighbours,
}

SQL = {
    "op1_mixing": mixing.SQL,
    "op2_secret_ledger": secret_ledger.SQL,
    "op8_exact_dedup": exact_dedup.SQL,
    "op9_capture_index": capture_index.SQL,
    "op10_ngram_join": ngram_join.SQL,
    "op12_collocations": collocations.SQL,
}
