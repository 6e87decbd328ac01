"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from lectern.llm import ann, fill_middle, filter_audit, language_id, line_dedup, media, mixing, ngram_join, packing, pii, quality_classifier, quality_rules, sentence_spans

QUERIES = {
    "op1_quality_rules": quality_rules.op1_quality_rules,
    "op2_line_dedup": line_dedup.op2_line_dedup,
    "op3_packing": packing.op3_packing,
    "op4_pii": pii.op4_pii,
    "op5_ann": ann.op5_ann,
    "op6_ngram_join": ngram_join.op6_ngram_join,
    "op7_sentence_spans": sentence_spans.op7_sentence_spans,
    "op8_quality_classifier": quality_classifier.op8_quality_classifier,
    "op9_language_id": language_id.op9_language_id,
    "op10_mixing": mixing.op10_mixing,
    "op11_filter_audit": filter_audit.op11_filter_audit,
    "op12_progressive_jpeg": media.op12_progressive_jpeg,
    "op13_fill_middle": fill_middle.op13_fill_middle,
}

ORACLES = {
    "op1_quality_rules": quality_rules.ORACLE,
    "op2_line_dedup": line_dedup.ORACLE,
    "op10_mixing": mixing.ORACLE,
    "op11_filter_audit": filter_audit.ORACLE,
    "op13_fill_middle": fill_middle.ORACLE,
}
