"""Queries of the training-data operators and the SQL of those that SQL can express."""

from __future__ import annotations

from carrel.llm import chat, collocations, imatch, language, lattice, media, packing, periods, quality, sentence_pieces, sentences, simhash, suffixes

QUERIES = {
    "op1_sentence_pieces": sentence_pieces.op1_sentence_pieces,
    "op2_simhash_near_dedup": simhash.op2_simhash_near_dedup,
    "op3_quality_classifier": quality.op3_quality_classifier,
    "op4_chat_formatting": chat.op4_chat_formatting,
    "op5_suffix_merge_dedup": suffixes.op5_suffix_merge_dedup,
    "op6_best_fit_packing": packing.op6_best_fit_packing,
    "op7_media_columns": media.op7_media_columns,
    "op8_lattice_near_dedup": lattice.op8_lattice_near_dedup,
    "op9_sentence_spans": sentences.op9_sentence_spans,
    "op10_language_id": language.op10_language_id,
    "op11_phrase_collocations": collocations.op11_phrase_collocations,
    "op12_document_fingerprints": imatch.op12_document_fingerprints,
    "op13_periodic_runs": periods.op13_periodic_runs,
}
ORACLES: dict[str, str] = {
    "op4_chat_formatting": chat.ORACLE,
    "op11_phrase_collocations": collocations.ORACLE,
}
