"""Registered queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

from perkmill.llm import bpe, collocations, decontaminate, language, lines, minhash, paragraphs, quality, quotes, surrogates, toxicity, trie, vectors

QUERIES = {
    f.__name__: f for f in (
        surrogates.op1_pii_surrogates, quotes.op2_quotation_linking, vectors.op3_embedding_near_dedup,
        paragraphs.op4_paragraph_dedup, decontaminate.op5_decontamination, minhash.op6_minhash_near_dedup,
        bpe.op7_bpe_round_trip, language.op8_language_id, quality.op9_quality_classifier, toxicity.op10_toxicity,
        collocations.op11_phrase_collocations, lines.op12_line_dedup, trie.op13_conversation_trie)
}

ORACLE_SQL = {"op5_decontamination": decontaminate.OP5_SQL, "op6_minhash_near_dedup": minhash.OP6_SQL,
              "op3_embedding_near_dedup": vectors.OP3_SQL, "op11_phrase_collocations": collocations.OP11_SQL,
              "op12_line_dedup": lines.OP12_SQL, "op13_conversation_trie": trie.OP13_SQL}
