"""The registered queries of this package and the SQL of those that SQL can express."""

from __future__ import annotations

from roostline.llm.compression import op4_compression_bands
from roostline.llm.hard_negatives import OP11_SQL, op11_hard_negatives
from roostline.llm.interleaving import OP13_SQL, op13_proportional_interleaving
from roostline.llm.line_templates import OP10_SQL, op10_line_dedup
from roostline.llm.packing import op7_packing
from roostline.llm.planes import op5_bit_planes
from roostline.llm.prefix_trie import OP12_SQL, op12_prefix_trie
from roostline.llm.quality import op2_quality_classifier
from roostline.llm.secrets import OP3_SQL, op3_secret_scans
from roostline.llm.signature_trees import op8_ngram_jaccard_join
from roostline.llm.small_worlds import op1_nearest_neighbours
from roostline.llm.suffix_pieces import op6_sentencepiece
from roostline.llm.toxicity import op9_toxicity

QUERIES = {
    "op1_nearest_neighbours": op1_nearest_neighbours,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_secret_scans": op3_secret_scans,
    "op4_compression_bands": op4_compression_bands,
    "op5_bit_planes": op5_bit_planes,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_packing": op7_packing,
    "op8_ngram_jaccard_join": op8_ngram_jaccard_join,
    "op9_toxicity": op9_toxicity,
    "op10_line_dedup": op10_line_dedup,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_proportional_interleaving": op13_proportional_interleaving,
}

SQL = {
    "op3_secret_scans": OP3_SQL,
    "op10_line_dedup": OP10_SQL,
    "op11_hard_negatives": OP11_SQL,
    "op12_prefix_trie": OP12_SQL,
    "op13_proportional_interleaving": OP13_SQL,
}
