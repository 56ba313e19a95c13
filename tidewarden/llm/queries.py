"""The operators' registered queries and the SQL of those that SQL can express."""

from __future__ import annotations

from tidewarden.llm.centroids import OP13_SQL, op13_centroid_clusters
from tidewarden.llm.cross_parsing import op12_language
from tidewarden.llm.divergence import OP11_SQL, op11_source_divergence
from tidewarden.llm.embedding_dedup import op2_embedding_near_dedup
from tidewarden.llm.grading import op7_ordinal_quality
from tidewarden.llm.line_dedup import op1_fuzzy_lines
from tidewarden.llm.mixing import op6_source_mix
from tidewarden.llm.ngram_join import op5_ngram_jaccard_join
from tidewarden.llm.packing import op8_retrieval_packing
from tidewarden.llm.quality_rules import op4_quality_rules
from tidewarden.llm.sharding import op3_virtual_slots
from tidewarden.llm.substring_dedup import op10_suffix_dedup
from tidewarden.llm.token_counts import op9_token_counts

QUERIES = {
    f.__name__: f
    for f in (op1_fuzzy_lines, op2_embedding_near_dedup, op3_virtual_slots, op4_quality_rules, op5_ngram_jaccard_join,
              op6_source_mix, op7_ordinal_quality, op8_retrieval_packing, op9_token_counts, op10_suffix_dedup,
              op11_source_divergence, op12_language, op13_centroid_clusters)
}
SQL: dict[str, str] = {"op11_source_divergence": OP11_SQL, "op13_centroid_clusters": OP13_SQL}
