"""Queries of this subpackage, by name, and the DuckDB SQL of those that SQL
can express.  ``__spark_entry__`` adds them when the subpackage is present."""

from __future__ import annotations

from quarry.llm.collocations import OP12_SQL, op12_collocations
from quarry.llm.decontamination import op2_decontamination
from quarry.llm.embedding_dedup import op7_embedding_dedup
from quarry.llm.language import op9_language
from quarry.llm.mixing import OP11_SQL, op11_mixing
from quarry.llm.packing import op8_packing
from quarry.llm.pii import op3_pii
from quarry.llm.prefix_trie import OP13_SQL, op13_prefix_trie
from quarry.llm.quality import op1_quality
from quarry.llm.simhash import op4_simhash
from quarry.llm.suffix_dedup import op5_suffix_dedup
from quarry.llm.token_counts import op6_token_counts
from quarry.llm.toxicity import op10_toxicity

QUERIES = {
    "op1_quality": op1_quality,
    "op2_decontamination": op2_decontamination,
    "op3_pii": op3_pii,
    "op4_simhash": op4_simhash,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_token_counts": op6_token_counts,
    "op7_embedding_dedup": op7_embedding_dedup,
    "op8_packing": op8_packing,
    "op9_language": op9_language,
    "op10_toxicity": op10_toxicity,
    "op11_mixing": op11_mixing,
    "op12_collocations": op12_collocations,
    "op13_prefix_trie": op13_prefix_trie,
}

#: every pair by brute force: for the small tables of the correctness check
_OP7_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e,
         embedding IS NOT NULL AND len(embedding) > 0
           AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
           AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS usable
  FROM embeddings),
pairs AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE a.usable AND b.usable AND list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (
  SELECT vec_id, vec_id AS r FROM v
  UNION SELECT reach.vec_id, pairs.b FROM reach JOIN pairs ON reach.r = pairs.a),
least AS (SELECT vec_id, MIN(r) AS component_id FROM reach GROUP BY vec_id),
links AS (SELECT a AS vec_id, COUNT(*) AS n FROM pairs GROUP BY a)
SELECT vec_id, COALESCE(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM least LEFT JOIN links USING (vec_id)
"""

ORACLE_SQL: dict[str, str] = {"op7_embedding_dedup": _OP7_SQL, "op11_mixing": OP11_SQL,
                              "op12_collocations": OP12_SQL,
                              "op13_prefix_trie": OP13_SQL}
