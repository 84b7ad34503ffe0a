"""The registered queries of the subpackage and their oracle SQL."""

from __future__ import annotations

from versus.llm.ann import op4_ann
from versus.llm.bpe import op2_bpe
from versus.llm.langid import op5_langid
from versus.llm.licenses import op9_licenses
from versus.llm.line_dedup import op3_line_dedup
from versus.llm.lm import op1_lm_score
from versus.llm.merkle import op12_manifest
from versus.llm.near_dedup import ORACLE as NEAR_ORACLE
from versus.llm.near_dedup import op10_near_dedup
from versus.llm.negatives import ORACLE as NEGATIVE_ORACLE
from versus.llm.negatives import op13_hard_negatives
from versus.llm.packing import op6_packing
from versus.llm.pii import op8_pii
from versus.llm.quality import ORACLE as QUALITY_ORACLE
from versus.llm.quality import op7_quality
from versus.llm.suffixes import op11_suffix_dedup

QUERIES = {
    "op1_lm_score": op1_lm_score,
    "op2_bpe": op2_bpe,
    "op3_line_dedup": op3_line_dedup,
    "op4_ann": op4_ann,
    "op5_langid": op5_langid,
    "op6_packing": op6_packing,
    "op7_quality": op7_quality,
    "op8_pii": op8_pii,
    "op9_licenses": op9_licenses,
    "op10_near_dedup": op10_near_dedup,
    "op11_suffix_dedup": op11_suffix_dedup,
    "op12_manifest": op12_manifest,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLE: dict[str, str] = {**QUALITY_ORACLE, **NEAR_ORACLE, **NEGATIVE_ORACLE}
