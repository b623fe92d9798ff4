"""Registered queries of the training-data operators."""

from __future__ import annotations

from demandlens.llm import (
    align,
    best_fit,
    bpe_tree,
    ef_ids,
    golay,
    html_tree,
    katz,
    langid,
    lexical,
    lz,
    packing,
    pca_dedup,
    pii,
)
from demandlens.llm.common import table


def op1_lz(spark, sf_dir):
    return lz.compare(table(spark, sf_dir, "documents"))


def op2_bpe_tree(spark, sf_dir):
    return bpe_tree.encode_decode(table(spark, sf_dir, "documents"))


def op3_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


def op4_ef_ids(spark, sf_dir):
    return ef_ids.write_and_read(table(spark, sf_dir, "documents"))


def op5_html_tree(spark, sf_dir):
    return html_tree.extract(table(spark, sf_dir, "pages"))


def op6_katz(spark, sf_dir):
    return katz.score(table(spark, sf_dir, "documents"))


def op7_pii_lstm(spark, sf_dir):
    return pii.find(table(spark, sf_dir, "documents"))


def op8_pca_dedup(spark, sf_dir):
    return pca_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_langid(spark, sf_dir):
    return langid.identify(table(spark, sf_dir, "documents"))


def op10_golay(spark, sf_dir):
    return golay.near_duplicates(table(spark, sf_dir, "documents"))


def op11_lexical(spark, sf_dir):
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_align(spark, sf_dir):
    return align.align_corpus(table(spark, sf_dir, "documents"))


def op13_best_fit(spark, sf_dir):
    return best_fit.pack(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_lz": op1_lz,
    "op2_bpe_tree": op2_bpe_tree,
    "op3_packing": op3_packing,
    "op4_ef_ids": op4_ef_ids,
    "op5_html_tree": op5_html_tree,
    "op6_katz": op6_katz,
    "op7_pii_lstm": op7_pii_lstm,
    "op8_pca_dedup": op8_pca_dedup,
    "op9_langid": op9_langid,
    "op10_golay": op10_golay,
    "op11_lexical": op11_lexical,
    "op12_align": op12_align,
    "op13_best_fit": op13_best_fit,
}

#: SQL of the operators whose results plain SQL can give on these tables.
ORACLE: dict[str, str] = {
    "op8_pca_dedup": """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
good AS (
  SELECT * FROM v
  WHERE label IS NOT NULL AND e IS NOT NULL AND list_count(e) = len(e)
    AND list_bool_and(list_transform(e, lambda x: isfinite(x))) AND list_bool_or(list_transform(e, lambda x: x <> 0))),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e)) / sqrt(list_dot_product(b.e, b.e)) >= 0.98),
reach AS (
  SELECT vec_id AS v, vec_id AS r FROM v
  UNION
  SELECT reach.v, links.b FROM reach JOIN links ON reach.r = links.a)
SELECT v.vec_id, coalesce(n.n, 0) AS n_links, c.component_id, v.vec_id = c.component_id AS kept
FROM v
JOIN (SELECT v AS vec_id, min(r) AS component_id FROM reach GROUP BY v) c ON c.vec_id = v.vec_id
LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a) n ON n.vec_id = v.vec_id
""",
    "op11_lexical": r"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
sizes AS (SELECT row, doc_id, CAST(len(terms) AS BIGINT) AS n FROM d WHERE len(terms) > 0),
corpus AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM sizes),
tf AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM d) GROUP BY ALL),
q AS (
  SELECT item, item_id, term, count(*) AS times
  FROM (SELECT item, item_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT row_number() OVER () AS item, item_id, text FROM benchmark))
  GROUP BY ALL),
w AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf, corpus GROUP BY term),
scores AS (
  SELECT item, any_value(item_id) AS item_id, any_value(doc_id) AS doc_id, CAST(sum(
      times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // total)))) AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN w USING (term) JOIN sizes USING (row), corpus
  GROUP BY item, row),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS rank
  FROM scores WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 20
""",
}
