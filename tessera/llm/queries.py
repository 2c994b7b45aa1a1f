"""The registered queries of the training-data operators."""

from __future__ import annotations

from . import chat, decontamination, embedding_dedup, line_dedup, mixing, neighbours, prefix_trie, quality, repair, sharding, simhash_dedup, token_output, toxicity

LLM_QUERIES = {
    "op1_decontamination": decontamination.contaminated_documents,
    "op2_quality": quality.score_documents,
    "op3_sharding": sharding.shard_documents,
    "op4_toxicity": toxicity.grade_documents,
    "op5_simhash": simhash_dedup.group_documents,
    "op6_neighbours": neighbours.nearest_embeddings,
    "op7_mixing": mixing.mix_documents,
    "op8_chat": chat.format_conversations,
    "op9_lines": line_dedup.dedup_lines,
    "op10_tokens": token_output.token_sequences,
    "op11_trie": prefix_trie.conversation_trie,
    "op12_embedding_dedup": embedding_dedup.dedup_embeddings,
    "op13_repair": repair.repair_conversations,
}
