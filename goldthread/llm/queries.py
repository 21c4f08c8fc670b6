"""One query per operator, each over its whole table with production parameters."""

from __future__ import annotations

from goldthread.llm import (
    chat, decontaminate, lexical, line_dedup, line_rules, main_text, mix, near_dup, piece_ids, ring, spelling, token_files, warc,
)
from goldthread.llm.registry import LLM_ORACLES, LLM_QUERIES, register, table

__all__ = ["LLM_ORACLES", "LLM_QUERIES"]


@register("op10_ring_sharding")
def op10_ring_sharding(spark, folder):
    return ring.shard_documents(table(spark, folder, "documents"))


@register("op1_cube_mix")
def op1_cube_mix(spark, folder):
    return mix.mix_report(table(spark, folder, "documents"))


@register("op8_line_frequency", sql=r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents
), words AS (
  SELECT r, doc_id, source, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM docs
), spots AS (
  SELECT r, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM words)
), again AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM spots) WHERE n > 1
), repeated AS (
  SELECT r, count(DISTINCT i + d) AS n FROM again, (VALUES (0), (1), (2)) AS v(d) GROUP BY r
), lines AS (
  SELECT r, doc_id, source, t, line,
         regexp_extract_all(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS lw
  FROM (SELECT r, doc_id, source, t, unnest(string_split(t, chr(10))) AS line FROM docs)
), full_lines AS (
  SELECT r, doc_id, source, t, line, array_to_string(lw, ' ') AS norm, len(lw) AS n FROM lines WHERE len(lw) > 0
), dups AS (
  SELECT r, count(*) - count(DISTINCT line) AS n FROM full_lines GROUP BY r
), shared AS (
  SELECT source, norm, count(DISTINCT t) AS n_docs, arg_min(t, doc_id) AS owner FROM full_lines GROUP BY source, norm
), frequent AS (
  SELECT source, norm, owner FROM shared WHERE n_docs > 20
), removed AS (
  SELECT r, sum(n) AS n FROM full_lines l JOIN frequent f ON l.source IS NOT DISTINCT FROM f.source AND l.norm = f.norm
  WHERE l.t <> f.owner GROUP BY r
), base AS (
  SELECT w.doc_id, len(w.w) AS n_words, len(array_to_string(w.w, '')) AS word_chars,
         len(t) - len(translate(t, '#*$%&|<>', '')) AS n_symbols, coalesce(dups.n, 0) AS n_dup_lines,
         coalesce(repeated.n, 0) AS n_repeat_words, coalesce(removed.n, 0)::BIGINT AS removed_words
  FROM words w LEFT JOIN dups USING (r) LEFT JOIN repeated USING (r) LEFT JOIN removed USING (r)
)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_words - removed_words >= n_words * 0.3 AS kept
FROM base
""")
def op8_line_frequency(spark, folder):
    return line_rules.quality_report(table(spark, folder, "documents"))


@register("op7_prefix_decontaminate", sql=r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), items AS (
  SELECT item_id::VARCHAR AS item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), wins AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM items WHERE len(w) > 0)
), spots AS (
  SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, (SELECT DISTINCT n FROM wins) WHERE len(w) >= n)
), hits AS (
  SELECT r, i, s.n, item_id FROM spots s JOIN wins v ON s.n = v.n AND s.win = v.win
), hit AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r
), named AS (
  SELECT r, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT r, item_id FROM hits) GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(named.n, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
""")
def op7_prefix_decontaminate(spark, folder):
    found = decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.drop("text_key")


@register("op6_lsh_forest")
def op6_lsh_forest(spark, folder):
    return near_dup.near_duplicates(table(spark, folder, "documents"))


@register("op3_arrow_tokens")
def op3_arrow_tokens(spark, folder):
    import public_tokenizers

    return token_files.tokenized(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@register("op4_relational_chat", sql=r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), marked AS (
  SELECT *, row_number() OVER w AS i, lag(role) OVER w IS NOT DISTINCT FROM role AS joins,
         length(regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g')) AS n,
         length(regexp_replace(role, '<(\\*)\|', '<\1\\|', 'g')) + 5 * (length(role) - length(replace(role, chr(10), ''))) AS m
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(n + CASE WHEN joins AND i > 1 THEN 10 ELSE 12 + m + 1 + 11 END)::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id
""")
def op4_relational_chat(spark, folder):
    probe = "<|im_end|><|im_start|>assistant ok"
    extra = spark.range(2).selectExpr(
        "-1L AS conv_id", "id AS turn", "if(id = 0, 'user', 'assistant') AS role", f"'{probe}' AS text")
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return chat.chat_report(turns.unionByName(extra))


@register("op9_warc_shards")
def op9_warc_shards(spark, folder):
    return warc.archive_report(table(spark, folder, "pages"))


@register("op5_tag_path_text")
def op5_tag_path_text(spark, folder):
    return main_text.extract(table(spark, folder, "pages"))


@register("op2_fuzzy_lines")
def op2_fuzzy_lines(spark, folder):
    return line_dedup.line_report(table(spark, folder, "documents"))


@register("op13_distinct_chunks")
def op13_distinct_chunks(spark, folder):
    import public_tokenizers

    return piece_ids.encode_documents(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@register("op12_mask_search", sql=r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), items AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), stats AS (
  SELECT count(*) FILTER (len(w) > 0) AS n_docs, sum(len(w))::BIGINT AS n_terms FROM docs
), postings AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM docs) WHERE term IN (SELECT term FROM items) GROUP BY r, term
), weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM postings GROUP BY term), stats
), scored AS (
  SELECT item_id, r, sum(weights.w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * len(docs.w) * n_docs) // n_terms)))))::BIGINT AS score
  FROM items JOIN postings USING (term) JOIN weights USING (term) JOIN docs USING (r), stats GROUP BY item_id, r
)
SELECT item_id, rank, doc_id, score
FROM (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank
      FROM scored JOIN docs USING (r) WHERE score > 0)
WHERE rank <= 50
""")
def op12_mask_search(spark, folder):
    return lexical.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@register("op11_kd_spelling", sql=r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+') AS w
  FROM documents
), runs AS (
  SELECT run, coalesce(doc_id::VARCHAR, '') || ':' || run AS named, count(*) AS n
  FROM (SELECT r, doc_id, unnest(w) AS run FROM docs) GROUP BY r, doc_id, run
), bits AS (
  SELECT [list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
          FOR i IN range(256)] AS place
), bytes AS (
  SELECT run, n, [(strpos('0123456789ABCDEF', h[2 * i + 1]) - 1) * 16 + strpos('0123456789ABCDEF', h[2 * i + 2]) - 1 FOR i IN range(len(h) // 2)] AS b
  FROM (SELECT run, n, hex(named) AS h FROM runs)
), hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c >> 8, place[(xor(c, x) & 255) + 1])), 4294967295) AS h FROM bytes, bits
), spelled AS (
  SELECT CASE WHEN h % 97 = 0 THEN run[:h % len(run)] || run[h % len(run) + 2:] ELSE run END AS word, n FROM hashed
), words AS (
  SELECT word, sum(n)::BIGINT AS n FROM spelled WHERE len(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), cut AS (
  SELECT word, n, i, word[:i - 1] || word[i + 1:] AS rest FROM (SELECT word, n, unnest(range(1, len(word) + 1)) AS i FROM words)
), near AS (
  SELECT a.word, b.word AS form, b.n AS form_n FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word
), best AS (
  SELECT word, count(*) AS n_near, arg_min(form, (-form_n, form)) AS form, max(form_n) AS form_n FROM near GROUP BY word
), named AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 2 * w.n THEN form END AS form, CASE WHEN form_n >= 2 * w.n THEN form_n END AS form_n
  FROM words w LEFT JOIN best USING (word)
), chain AS (
  WITH RECURSIVE steps AS (
    SELECT word, word AS root, form AS ahead FROM named
    UNION ALL SELECT s.word, s.ahead, n.form FROM steps s JOIN named n ON n.word = s.ahead
  ) SELECT word, root FROM steps WHERE ahead IS NULL
)
SELECT word, form, root, n, n_near, form_n FROM named JOIN chain USING (word)
""")
def op11_kd_spelling(spark, folder):
    return spelling.variants(table(spark, folder, "documents"))
