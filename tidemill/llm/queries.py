"""The registered queries of the training-data operators, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from tidemill.llm.chat import OP1_SQL, op1_snapshot_collapse
from tidemill.llm.decontaminate import op8_prefix_filtered_windows
from tidemill.llm.infill import OP13_SQL, op13_chunk_infill
from tidemill.llm.language_model import op7_pitman_yor_scores
from tidemill.llm.neardup import op9_bottom_k_neardup
from tidemill.llm.packing import op3_bulk_best_fit
from tidemill.llm.privacy import op4_information_sanitising
from tidemill.llm.repetition import op10_suffix_repetition
from tidemill.llm.rotation_codes import OP12_SQL, op12_rotation_codes
from tidemill.llm.tokens import op2_heap_merge_counts
from tidemill.llm.turn_trie import OP11_SQL, op11_turn_id_trie
from tidemill.llm.url_lists import OP6_SQL, op6_temporal_lists
from tidemill.llm.warc import op5_warc_derivatives

QUERIES = {f.__name__: f for f in (
    op1_snapshot_collapse, op2_heap_merge_counts, op3_bulk_best_fit, op4_information_sanitising, op5_warc_derivatives,
    op6_temporal_lists, op7_pitman_yor_scores, op8_prefix_filtered_windows, op9_bottom_k_neardup,
    op10_suffix_repetition, op11_turn_id_trie, op12_rotation_codes,
    op13_chunk_infill)}

#: Windows of 13 words of both tables, joined as they are.
OP8_SQL = r"""
WITH iw AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, w[i:i + 12] AS win FROM iw, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS t(i) WHERE len(w) > 0),
dw AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
n AS (SELECT DISTINCT len(win) AS k FROM win),
dwin AS (SELECT doc_id, i, w[i:i + k - 1] AS win, k FROM dw, n, unnest(range(1, len(w) - k + 2)) AS t(i) WHERE len(w) >= k),
hit AS (SELECT doc_id, i, k, item_id FROM dwin JOIN win USING (win)),
cover AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hit, unnest(range(i, i + k)) AS t(p) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * n_hit >= len(w) AS contaminated
FROM dw LEFT JOIN cover USING (doc_id) LEFT JOIN items USING (doc_id)
"""

#: All pairs that share a shingle, exact similarities, and reachability.
OP9_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
s AS (SELECT DISTINCT doc_id, w[i:i + 3] AS s FROM w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS t(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
r(doc_id, other) AS (SELECT doc_id, doc_id FROM w UNION SELECT r.doc_id, l.b FROM r JOIN l ON r.other = l.a),
c AS (SELECT doc_id, min(other) AS component_id FROM r GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM c LEFT JOIN n USING (doc_id)
"""

ORACLE = {"op1_snapshot_collapse": OP1_SQL, "op6_temporal_lists": OP6_SQL, "op8_prefix_filtered_windows": OP8_SQL,
          "op9_bottom_k_neardup": OP9_SQL, "op11_turn_id_trie": OP11_SQL,
          "op12_rotation_codes": OP12_SQL, "op13_chunk_infill": OP13_SQL}
