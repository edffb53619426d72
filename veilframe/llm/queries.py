"""One query for each corpus operator, over its whole table with production parameters, and DuckDB SQL where SQL can say the same."""

from __future__ import annotations

from functools import lru_cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilframe.llm import (
    block_naming, chat_perspectives, curve_packing, embedding_forest, heap_codes, html_main_text, licence_digests, ngram_join, quality_resampling, quality_rules,
    sharded_search, toxicity_channel, unigram_pieces,
)
from veilframe.llm.common import table


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def _vocabulary(path: str) -> unigram_pieces.Vocabulary:
    """The trie of a model file, built once in a process."""
    return unigram_pieces.build(unigram_pieces.read_pieces(Path(path).read_bytes()))


def op1_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_noisy_channel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_channel.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_perspective_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rendered = chat_perspectives.rotate(table(spark, sf_dir, "conversations"))
    spans = F.array_join(F.transform("spans", lambda s: F.concat_ws("-", s["start"], s["end"])), ",")
    return rendered.select("conv_id", "piece", "perspective", "text", spans.alias("spans"), "n_messages")


def op4_risk_controlled_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.apply_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curve_packing.pack(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op6_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_forest.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


def op7_lsh_forest_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def op8_host_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_main_text.extract(table(spark, sf_dir, "pages"))


def op9_licence_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licence_digests.scan(table(spark, sf_dir, "documents"), licence_digests.known_licences(spark))


def op10_unigram_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unigram_pieces.digests(unigram_pieces.encode_documents(table(spark, sf_dir, "documents"), _vocabulary(tokenizer_file("piece_bpe_32k.model"))))


def op11_heap_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return heap_codes.compress(table(spark, sf_dir, "embeddings"))


def op12_sharded_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharded_search.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_block_naming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_naming.deduplicate(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f for f in (
        op1_importance_resampling, op2_noisy_channel_toxicity, op3_perspective_rotation, op4_risk_controlled_rules, op5_curve_packing,
        op6_projection_forest, op7_lsh_forest_join, op8_host_suffix_array, op9_licence_digests, op10_unigram_pieces, op11_heap_lloyd, op12_sharded_postings, op13_block_naming,
    )
}


def _canonical_sql(text: str) -> str:
    out = f"regexp_replace(lower({text}), '{licence_digests.COPYRIGHT_LINE.replace('(?md)', '(?m)')}', '', 'g')"
    out = f"' ' || regexp_replace({out}, '{licence_digests.OTHER}', ' ', 'g') || ' '"
    for other, one in licence_digests.SPELLINGS:
        out = f"replace({out}, ' {other} ', ' {one} ')"
    return f"trim(regexp_replace({out}, ' +', ' ', 'g'))"


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _lloyd_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Lloyd's rounds one after the other, every part compared with every entry in each."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (
  SELECT row, p, any_value(v) AS v, arg_min(e, d * {entries} + e) AS e, min(d) AS d
  FROM (SELECT row, s.p, s.v, c.e, CAST(list_sum(list_transform(range(1, len(s.v) + 1), lambda i: (s.v[i] - c.v[i]) * (s.v[i] - c.v[i]))) AS BIGINT) AS d FROM slices s JOIN c{r} c ON c.p = s.p)
  GROUP BY row, p),""")
        if r < rounds:
            steps.append(f"""
c{r + 1} AS MATERIALIZED (
  SELECT c.p, c.e, coalesce(m.v, c.v) AS v FROM c{r} c LEFT JOIN (
    SELECT p, e, list(x ORDER BY i) AS v FROM (
      SELECT p, e, i, CAST(floor(CAST(sum(v[i]) AS DOUBLE) / count(*)) AS BIGINT) AS x FROM a{r}, range(1, len(v) + 1) AS t(i) GROUP BY p, e, i) GROUP BY p, e) m ON m.p = c.p AND m.e = c.e),""")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) - 1 AS row, vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
slices AS MATERIALIZED (SELECT row, p, v[p * (len(v) // {parts}) + 1:(p + 1) * (len(v) // {parts})] AS v FROM kept, range({parts}) AS t(p)),
c0 AS MATERIALIZED (SELECT p, row AS e, v FROM slices WHERE row < {entries}),{''.join(steps)}
coded AS MATERIALIZED (
  SELECT row, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY row)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(v[i] AS VARCHAR), ',' ORDER BY p, e, i)) FROM c{rounds}, range(1, len(v) + 1) AS t(i)) AS codebooks_sha256
FROM kept JOIN coded USING (row)"""


def _search_sql() -> str:
    """Scores of all documents for all items, from the definition."""
    terms = r"unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term"
    return f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, text FROM documents),
found AS MATERIALIZED (SELECT row, term, count(*) AS tf FROM (SELECT row, {terms} FROM d) GROUP BY 1, 2),
sizes AS MATERIALIZED (SELECT row, CAST(sum(tf) AS BIGINT) AS n FROM found GROUP BY 1),
total AS MATERIALIZED (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes),
asked AS MATERIALIZED (SELECT row_number() OVER () AS item, item_id, text FROM (SELECT DISTINCT item_id, text FROM benchmark)),
wanted AS (SELECT DISTINCT item, term FROM (SELECT item, {terms} FROM asked)),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w FROM (SELECT term, count(*) AS df FROM found GROUP BY 1), total),
scored AS (
  SELECT item, row, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // terms)))) AS BIGINT) AS score
  FROM wanted JOIN weights USING (term) JOIN found USING (term) JOIN sizes USING (row), total GROUP BY 1, 2)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM scored JOIN d USING (row) JOIN asked USING (item) WHERE score > 0) WHERE rank <= 10"""


ORACLES = {
    "op11_heap_lloyd": _lloyd_sql(),
    "op12_sharded_postings": _search_sql(),
    "op13_block_naming": r"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS plain FROM documents),
ranked AS (SELECT *, row_number() OVER w AS place, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY plain) AS group_size FROM d WINDOW w AS (PARTITION BY plain ORDER BY n DESC, doc_id NULLS LAST, row))
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(plain) AS text_sha256 FROM ranked""".replace("\\", "\\"),
    "op3_perspective_rotation": """
WITH turns AS (
  SELECT conv_id, turn, coalesce(nullif(role, ''), 'unknown') AS speaker, coalesce(text, '') AS text FROM conversations),
cut AS (
  SELECT *, (row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, speaker, text) - 1) // 4096 AS piece FROM turns),
people AS (SELECT DISTINCT conv_id, speaker AS perspective FROM turns WHERE speaker <> 'system'),
shown AS (
  SELECT t.conv_id, piece, perspective, turn, speaker, text, speaker = perspective AS own,
         CASE WHEN speaker = 'system' THEN '<|system|>' WHEN speaker = perspective THEN '<|assistant|>' ELSE '<|user name=' || speaker || '|>' END || chr(10) AS head,
         text || '<|end|>' || chr(10) AS body
  FROM cut t JOIN people p ON t.conv_id IS NOT DISTINCT FROM p.conv_id),
placed AS (
  SELECT *, sum(length(head) + length(body)) OVER (PARTITION BY conv_id, piece, perspective ORDER BY turn NULLS FIRST, speaker, text ROWS UNBOUNDED PRECEDING) AS until FROM shown)
SELECT conv_id, CAST(piece AS BIGINT) AS piece, perspective, string_agg(head || body, '' ORDER BY turn NULLS FIRST, speaker, text) AS text,
       coalesce(string_agg(CAST(until - length(body) AS BIGINT) || '-' || CAST(until AS BIGINT), ',' ORDER BY turn NULLS FIRST, speaker, text) FILTER (WHERE own), '') AS spans,
       CAST(count(*) AS INTEGER) AS n_messages
FROM placed GROUP BY conv_id, piece, perspective""",
    "op9_licence_digests": f"""
WITH known AS (
  SELECT sha256({_canonical_sql('body')}) AS digest, min(licence) AS licence
  FROM (VALUES {', '.join(f'({_quoted(n)}, {_quoted(b)})' for n, b in licence_digests.KNOWN)}) AS k(licence, body) GROUP BY 1),
whole AS (SELECT doc_id, text, sha256(nullif({_canonical_sql('text')}, '')) AS digest FROM documents),
lines AS (SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line FROM documents),
named AS (
  SELECT doc_id, text, string_agg(DISTINCT k.licence, ',' ORDER BY k.licence) AS line_licences
  FROM lines JOIN known k ON k.digest = sha256({_canonical_sql('line')}) GROUP BY doc_id, text)
SELECT w.doc_id, w.digest, k.licence, coalesce(n.line_licences, '') AS line_licences
FROM whole w LEFT JOIN known k ON k.digest = w.digest LEFT JOIN named n ON n.doc_id = w.doc_id AND n.text = w.text""",
}
