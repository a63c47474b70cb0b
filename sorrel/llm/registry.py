"""The corpus queries and, where SQL can express one, its SQL."""

from __future__ import annotations

from sorrel.llm.collocations import OP12_SQL, op12_phrase_collocations
from sorrel.llm.decontamination import op10_decontamination
from sorrel.llm.embeddings import OP11_SQL, op11_embedding_range_join
from sorrel.llm.licences import op4_licence_classifier
from sorrel.llm.lines import OP5_SQL, op5_line_dedup
from sorrel.llm.packing import op8_concatenate_and_cut
from sorrel.llm.periodic import op13_periodic_runs
from sorrel.llm.quality import OP3_SQL, op3_line_first_quality
from sorrel.llm.secrets import OP2_SQL, op2_trigram_secret_scan
from sorrel.llm.sharding import op9_consistent_hash_shards
from sorrel.llm.simhash import op6_simhash_pigeonring
from sorrel.llm.substrings import OP1_SQL, op1_substring_dedup
from sorrel.llm.token_files import op7_flat_token_files

QUERIES = {f.__name__: f for f in (op1_substring_dedup, op2_trigram_secret_scan, op3_line_first_quality, op4_licence_classifier, op5_line_dedup, op6_simhash_pigeonring, op7_flat_token_files, op8_concatenate_and_cut, op9_consistent_hash_shards, op10_decontamination, op11_embedding_range_join, op12_phrase_collocations, op13_periodic_runs)}
ORACLE_SQL = {"op1_substring_dedup": OP1_SQL, "op3_line_first_quality": OP3_SQL, "op2_trigram_secret_scan": OP2_SQL, "op5_line_dedup": OP5_SQL, "op11_embedding_range_join": OP11_SQL, "op12_phrase_collocations": OP12_SQL}
