"""One query per operator of this package, by name; SQL where it can express the rows."""

from __future__ import annotations

from sievewright.llm import decontamination, drake, entropy_secrets, hash_forest, jump_shards, near_dedup, ngram_trie, packing, pii, prefix_trie, token_counts, token_files, toxicity

QUERIES = {
    "op1_feistel_pseudonyms": pii.query,
    "op2_best_fit_packing": packing.query,
    "op3_jump_shards": jump_shards.query,
    "op4_positional_index": decontamination.query,
    "op5_elias_fano_trie": ngram_trie.query,
    "op6_token_files": token_files.query,
    "op7_nearest_examples": toxicity.query,
    "op8_hash_forest": hash_forest.query,
    "op9_probminhash": near_dedup.query,
    "op10_token_counts": token_counts.query,
    "op11_prefix_trie": prefix_trie.query,
    "op12_entropy_secrets": entropy_secrets.query,
    "op13_drake_bounds": drake.query,
}

#: The others rest on hashes, vocabularies or models that SQL lacks; tests hold them against brute force.
ORACLES: dict[str, str] = {
    "op4_positional_index": decontamination.ORACLE_SQL, "op11_prefix_trie": prefix_trie.ORACLE_SQL, "op12_entropy_secrets": entropy_secrets.ORACLE_SQL, "op13_drake_bounds": drake.ORACLE_SQL}
