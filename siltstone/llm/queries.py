"""The queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm import (
    bpe,
    decontamination,
    exact_dedup,
    html_text,
    line_dedup,
    merkle,
    ngram_join,
    quality,
    spelling,
    suffix_array,
    token_files,
    toxicity,
    warc,
)
from siltstone.llm.registry import query, table, tokenizer_path


@query()
def op1_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_array.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


@query("""
  SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
         doc_id = max(doc_id) OVER same AS kept, text_sha256
  FROM (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
  WINDOW same AS (PARTITION BY text_sha256)
""")
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"), keep="largest")


@query()
def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path("byte_bpe_50k.tiktoken")
    encoded = bpe.encode(table(spark, sf_dir, "documents"), path)
    return bpe.decode(encoded, path).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256")
    )


@query()
def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_texts(table(spark, sf_dir, "documents"))


@query()
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model)
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query()
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


@query()
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs, model)
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@query("""
  WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
       s AS (SELECT page_id, strlen(html) AS payload_bytes, unhex(sha1(html))::BIT::VARCHAR AS bits,
                    min(page_id) OVER (PARTITION BY sha256(html)) AS response
             FROM p)
  SELECT page_id, payload_bytes,
         array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + 16 * substr(bits, 5 * i + 1, 1)::INT + 8 * substr(bits, 5 * i + 2, 1)::INT
             + 4 * substr(bits, 5 * i + 3, 1)::INT + 2 * substr(bits, 5 * i + 4, 1)::INT
             + substr(bits, 5 * i + 5, 1)::INT, 1) FOR i IN range(32)], '') AS payload_digest,
         CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
         CASE WHEN page_id <> response THEN response END AS refers_to
  FROM s
""")
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query("""
  WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
       l AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d),
       k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
       o AS (SELECT key, min(doc_id) AS owner FROM k WHERE length(key) >= 10
             GROUP BY key HAVING min(doc_id) <> max(doc_id)),
       m AS (SELECT k.doc_id, k.line, k.pos, coalesce(o.owner <> k.doc_id, false) AS gone
             FROM k LEFT JOIN o ON k.key = o.key)
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
         sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
  FROM m GROUP BY doc_id
""")
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")
    )


@query("""
  WITH RECURSIVE crc AS (
    SELECT [list_reduce(list_prepend(i::UBIGINT, range(8)::UBIGINT[]),
              lambda c, b: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END)
            FOR i IN range(256)] AS t),
  d AS (
    SELECT doc_id, source,
           CASE WHEN list_reduce(list_prepend(4294967295::UBIGINT, [ascii(x)::UBIGINT FOR x IN string_split(doc_id::VARCHAR, '')]),
                                 lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)::BIGINT])) % 2 = 1
                THEN replace(text, chr(10), '') ELSE text END AS now,
           coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
             || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
           coalesce(strlen(text) || ':' || text, '-') AS tail
    FROM documents, crc),
  leaves AS (
    SELECT doc_id, source, sha256(head || tail) AS leaf, sha256(head || coalesce(strlen(now) || ':' || now, '-')) AS present FROM d),
  placed AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p FROM leaves),
  up(source, lvl, l) AS (
    SELECT source, 0, list(leaf ORDER BY p) FROM placed GROUP BY source
    UNION ALL
    SELECT source, lvl + 1, [sha256(array_to_string(l[3 * i + 1:3 * i + 3], '')) FOR i IN range((len(l) + 2) // 3)]
    FROM up WHERE len(l) > 1),
  subs AS (
    SELECT source, l[1] AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS g FROM up WHERE len(l) = 1),
  top(lvl, l) AS (
    SELECT 0, list(subroot ORDER BY g) FROM subs
    UNION ALL
    SELECT lvl + 1, [sha256(array_to_string(l[3 * i + 1:3 * i + 3], '')) FOR i IN range((len(l) + 2) // 3)]
    FROM top WHERE len(l) > 1),
  steps AS (
    SELECT doc_id, leaf, placed.source, p, lvl, l, p // (3::BIGINT ** lvl)::BIGINT AS node
    FROM placed JOIN up ON placed.source IS NOT DISTINCT FROM up.source WHERE len(l) > 1
    UNION ALL
    SELECT doc_id, leaf, placed.source, p, 100 + lvl, l, g // (3::BIGINT ** lvl)::BIGINT
    FROM placed JOIN subs ON placed.source IS NOT DISTINCT FROM subs.source, top WHERE len(l) > 1),
  sides AS (
    SELECT source, p, lvl, array_to_string(l[node - node % 3 + 1:node], '') AS before,
           array_to_string(l[node + 2:node - node % 3 + 3], '') AS after
    FROM steps),
  paths AS (
    SELECT source, p, string_agg(before || after, '' ORDER BY lvl) AS proof, list(before || '|' || after ORDER BY lvl) AS path
    FROM sides GROUP BY source, p),
  folded AS (
    SELECT placed.doc_id, leaf, subroot, (SELECT l[1] FROM top WHERE len(l) = 1) AS root,
           sha256(coalesce(proof, '')) AS proof_sha256,
           list_reduce(list_prepend(present, coalesce(path, [])), lambda h, s: sha256(split_part(s, '|', 1) || h || split_part(s, '|', 2)))
             AS folded_root
    FROM placed JOIN subs ON placed.source IS NOT DISTINCT FROM subs.source
    LEFT JOIN paths ON placed.source IS NOT DISTINCT FROM paths.source AND placed.p = paths.p)
  SELECT *, folded_root = root AS verified FROM folded
""")
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(2)) == 0
    rows = merkle.verified(table(spark, sf_dir, "documents"), {"text": F.replace("text", F.lit("\n"), F.lit(""))}, tampered)
    return rows.withColumn("proof_sha256", F.sha2(merkle.proof_text(F.col("path")), 256)).drop("path")


@query("""
  WITH RECURSIVE crc AS (
    SELECT [list_reduce(list_prepend(i::UBIGINT, range(8)::UBIGINT[]),
              lambda c, b: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END)
            FOR i IN range(256)] AS t),
  runs AS (
    SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
    GROUP BY ALL),
  marked AS (
    SELECT run, n, xor(4294967295::UBIGINT, list_reduce(list_prepend(4294967295::UBIGINT,
             list_transform(range(1, 2 * strlen(coalesce(doc_id::VARCHAR, '') || ':' || run), 2),
               lambda i: ('0x' || substr(hex(coalesce(doc_id::VARCHAR, '') || ':' || run), i, 2))::UBIGINT)),
             lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)::BIGINT]))) AS h
    FROM runs, crc),
  words AS (
    SELECT CASE WHEN h % 97 = 0 THEN run[:(h % length(run))::BIGINT] || run[(h % length(run))::BIGINT + 2:] ELSE run END AS word,
           sum(n)::BIGINT AS n
    FROM marked GROUP BY 1 HAVING length(word) >= 5 AND sum(n) >= 3),
  cut AS (
    SELECT word, n, length(word) AS len, p, word[:p] || word[p + 2:] AS rest
    FROM (SELECT word, n, unnest(range(length(word))) AS p FROM words)),
  pairs AS (
    SELECT a.word, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.p = b.p AND a.rest = b.rest AND a.len = b.len AND a.word <> b.word
    UNION
    SELECT a.word, b.word, b.n FROM words a JOIN cut b ON a.word = b.rest
    UNION
    SELECT b.word, a.word, a.n FROM words a JOIN cut b ON a.word = b.rest),
  best AS (
    SELECT word, count(*) AS n_near, max(near_n) AS best_n, min(near ORDER BY near_n DESC, near) FILTER (WHERE near_n = top) AS best
    FROM (SELECT *, max(near_n) OVER (PARTITION BY word) AS top FROM pairs) GROUP BY word),
  forms AS (
    SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 2 * w.n THEN best END AS form,
           CASE WHEN best_n >= 2 * w.n THEN best_n END AS form_n
    FROM words w LEFT JOIN best USING (word)),
  walk(word, last, depth) AS (
    SELECT word, word, 0 FROM forms
    UNION ALL
    SELECT walk.word, forms.form, depth + 1 FROM walk JOIN forms ON walk.last = forms.word WHERE forms.form IS NOT NULL)
  SELECT forms.*, ends.root FROM forms JOIN (SELECT word, max_by(last, depth) AS root FROM walk GROUP BY word) ends USING (word)
""")
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


@query()
def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_text.extract(pages, html_text.fit(pages))
