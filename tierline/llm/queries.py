"""Registered queries of the training-data operators: one per operator, over
the whole tables, with the DuckDB SQL where SQL can state the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm import (
    collocations,
    decontaminate,
    exact_dedup,
    lines,
    manifest,
    mixing,
    ppm,
    quality,
    quality_rules,
    sharding,
    simhash,
    tokens,
    toxicity,
)
from tierline.llm.common import table

N_SHARDS = 24


def q_op1_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mixture(table(spark, sf, "documents"))


def q_op2_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.classify(table(spark, sf, "documents"), table(spark, sf, "labels"))


def q_op3_sharding(spark: SparkSession, sf: str) -> DataFrame:
    return (sharding.shard_records(table(spark, sf, "documents"), [1.0] * N_SHARDS)
            .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                    "slot", "grown_shard"))


def q_op4_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality.classify(table(spark, sf, "documents"), table(spark, sf, "labels"))


def q_op5_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark")).select(
        "doc_id", "item_id", "question_found", "question_shingles", "answer_found", "answer_shingles")


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def q_op6_token_ids(spark: SparkSession, sf: str) -> DataFrame:
    return tokens.tokens(table(spark, sf, "documents"), tokenizer_path())


def q_op7_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf, "documents"))


def q_op8_lm_score(spark: SparkSession, sf: str) -> DataFrame:
    return ppm.score_texts(table(spark, sf, "documents"))


def q_op9_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf, "documents"))


def q_op10_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return lines.dedup_lines(docs).select(
        "doc_id", "n_lines", "lines_removed", "chunks_removed",
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


def q_op10_passage_dedup(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return lines.dedup_passages(docs).select(
        "doc_id", "n_lines", "lines_removed", "runs_removed",
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


def q_op11_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return collocations.collocations(table(spark, sf, "documents"))


def q_op12_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality_rules.classify(table(spark, sf, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "kept", F.round("posterior", 3).alias("posterior"))


def q_op13_manifest(spark: SparkSession, sf: str) -> DataFrame:
    return manifest.manifest(table(spark, sf, "documents"))


LLM_QUERIES = {
    "op1_mixing": q_op1_mixing,
    "op2_toxicity": q_op2_toxicity,
    "op3_sharding": q_op3_sharding,
    "op4_quality": q_op4_quality,
    "op5_decontamination": q_op5_decontamination,
    "op6_token_ids": q_op6_token_ids,
    "op7_simhash": q_op7_simhash,
    "op8_lm_score": q_op8_lm_score,
    "op9_exact_dedup": q_op9_exact_dedup,
    "op10_line_dedup": q_op10_line_dedup,
    "op10_passage_dedup": q_op10_passage_dedup,
    "op11_collocations": q_op11_collocations,
    "op12_quality_rules": q_op12_quality_rules,
    "op13_manifest": q_op13_manifest,
}

LLM_ORACLE = {
    "op10_line_dedup": """
        WITH l AS (SELECT doc_id, text, i, line, len(ls) AS n,
                          ('0x' || substr(md5(line), 1, 8))::BIGINT AS h
                   FROM (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents
                         WHERE text IS NOT NULL), unnest(ls) WITH ORDINALITY AS u(line, i)),
        c AS (SELECT *, CASE WHEN i = n OR (i >= 2 AND (lag(h) OVER w * 31 + h) % 2 = 0)
                             THEN 1 ELSE 0 END AS cut
              FROM l WINDOW w AS (PARTITION BY doc_id, text ORDER BY i)),
        k AS (SELECT *, coalesce(sum(cut) OVER (PARTITION BY doc_id, text ORDER BY i
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos FROM c),
        p AS (SELECT doc_id, text, pos, count(*) AS n_lines,
                     string_agg(line, chr(10) ORDER BY i) AS chunk FROM k GROUP BY ALL),
        r AS (SELECT *, n_lines >= 2 AND row_number() OVER
                     (PARTITION BY chunk, n_lines >= 2 ORDER BY doc_id, pos) > 1 AS gone FROM p)
        SELECT doc_id, sum(n_lines)::INT AS n_lines,
               coalesce(sum(n_lines) FILTER (gone), 0)::INT AS lines_removed,
               (count(*) FILTER (gone))::INT AS chunks_removed,
               sha256(coalesce(string_agg(chunk, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS text_sha256
        FROM r GROUP BY doc_id, text""",
    "op10_passage_dedup": """
        WITH l AS (SELECT doc_id, text, i, line FROM
                   (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents
                    WHERE text IS NOT NULL), unnest(ls) WITH ORDINALITY AS u(line, i)),
        u AS (SELECT doc_id, text, i, 1 AS size, line AS unit FROM l
              WHERE len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) > 50
              UNION ALL
              SELECT a.doc_id, a.text, a.i, 2, a.line || chr(10) || b.line
              FROM l a JOIN l b ON a.doc_id = b.doc_id AND a.text = b.text AND b.i = a.i + 1),
        r AS (SELECT *, rank() OVER (PARTITION BY unit ORDER BY doc_id, i) > 1 AS again FROM u),
        g AS (SELECT DISTINCT doc_id, text, i + k AS i FROM r, range(2) AS o(k) WHERE again AND k < size),
        s AS (SELECT l.*, g.i IS NOT NULL AS gone FROM l LEFT JOIN g
              ON g.doc_id = l.doc_id AND g.text = l.text AND g.i = l.i),
        t AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id, text ORDER BY i), false)
                     AS starts FROM s)
        SELECT doc_id, count(*)::INT AS n_lines, (count(*) FILTER (gone))::INT AS lines_removed,
               (count(*) FILTER (starts))::INT AS runs_removed,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS text_sha256
        FROM t GROUP BY doc_id, text""",
    "op5_decontamination": """
        WITH iw AS (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}]+') AS w
                    FROM benchmark),
        cut AS (SELECT item_id, w, (2 * len(w) + 2) // 3 AS c FROM iw WHERE len(w) > 0),
        parts AS (SELECT item_id, 'q' AS part, w[1:greatest(c, 5)] AS p FROM cut
                  UNION ALL SELECT item_id, 'a', w[least(c, greatest(len(w) - 5, 0)) + 1:] FROM cut),
        ish AS (SELECT DISTINCT item_id, part, array_to_string(p[i:i + 4], ' ') AS s
                FROM (SELECT item_id, part, p, unnest(range(1, greatest(len(p) - 4, 1) + 1)) AS i
                      FROM parts WHERE len(p) > 0)),
        totals AS (SELECT item_id, count(*) FILTER (part = 'q') AS nq, count(*) FILTER (part = 'a') AS na
                   FROM ish GROUP BY item_id),
        dw AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}]+') AS w
               FROM documents),
        dsh AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
                FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i
                      FROM dw WHERE len(w) > 0)),
        found AS (SELECT doc_id, item_id, count(*) FILTER (part = 'q') AS fq, count(*) FILTER (part = 'a') AS fa
                  FROM dsh JOIN ish USING (s) GROUP BY doc_id, item_id)
        SELECT doc_id, item_id, fq::INT AS question_found, nq::INT AS question_shingles,
               fa::INT AS answer_found, na::INT AS answer_shingles
        FROM found JOIN totals USING (item_id) WHERE fq >= 0.8 * nq AND fa >= 0.8 * na""",
    "op9_exact_dedup": """
        WITH n AS (SELECT doc_id, translate(coalesce(text, ''),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
                   FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
        FROM n WINDOW w AS (PARTITION BY t)""",
    "op11_collocations": r"""
        WITH p AS (SELECT row_number() OVER () AS id, coalesce(lang, 'und') AS lang,
                          string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[.,;:!?\x0A-\x0D]') AS ps FROM documents),
        q AS (SELECT id, lang, i, regexp_extract_all(piece, '[^\x20\x09]+') AS w
              FROM p, unnest(ps) WITH ORDINALITY AS u(piece, i)),
        nn AS (SELECT lang, sum(len(w))::BIGINT AS n FROM q GROUP BY lang),
        g AS (SELECT lang, len(ws)::INT AS m, ws, count(*) AS f
              FROM (SELECT lang, w[i:i + m - 1] AS ws FROM
                    (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i
                     FROM (SELECT lang, w, unnest([1, 2, 3, 4, 5]) AS m FROM q) WHERE len(w) >= m))
              GROUP BY lang, ws HAVING count(*) >= 100),
        c AS (SELECT g.lang, g.ws, g.f AS a, k, l.f AS l, r.f AS r, n,
                     ((1000::HUGEINT * g.f * n) // (l.f::HUGEINT * r.f))::BIGINT AS score
              FROM (SELECT *, unnest(range(1, m)) AS k FROM g WHERE m >= 2) g
              JOIN g l ON l.lang = g.lang AND l.ws = g.ws[1:k]
              JOIN g r ON r.lang = g.lang AND r.ws = g.ws[k + 1:]
              JOIN nn ON nn.lang = g.lang),
        b AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY lang, ws ORDER BY score, k) = 1),
        s AS (SELECT lang, ws[i:i + k - 1] AS ws, max(f) AS longer
              FROM (SELECT *, unnest(range(1, m - k + 2)) AS i
                    FROM (SELECT *, unnest(range(2, m)) AS k FROM g WHERE m >= 3)) GROUP BY ALL),
        z AS (SELECT b.lang, array_to_string(b.ws, ' ') AS phrase, a, l, r, n, score
              FROM b LEFT JOIN s ON s.lang = b.lang AND s.ws = b.ws WHERE s.ws IS NULL OR 100 * longer < 100 * a)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
               phrase, a, l, r, n, score FROM z QUALIFY rank <= 2000""",
    "op12_quality_rules": r"""
        WITH RECURSIVE d AS (
          SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t,
                 regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
                 list_filter(string_split(coalesce(text, ''), chr(10)),
                             lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM documents),
        x AS (SELECT row, i, w[i:i + 2] AS win FROM (SELECT row, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
        again AS (SELECT row, i FROM x QUALIFY count(*) OVER (PARTITION BY row, win) > 1),
        reps AS (SELECT row, count(DISTINCT i + k) AS n FROM again, range(3) AS o(k) GROUP BY row),
        m AS (SELECT d.row, doc_id, len(w) AS n_words, len(list_distinct(w)) AS n_distinct,
                     coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
                     length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols,
                     length(t) - length(translate(t, '.!?', '')) AS n_marks,
                     len(regexp_extract_all(t, '[^\p{L}\x20\x09-\x0D]')) AS n_other,
                     len(regexp_extract_all(t, '\p{Lu}')) AS n_capitals,
                     len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
                     coalesce(reps.n, 0) AS n_repeat_words
              FROM d LEFT JOIN reps ON reps.row = d.row),
        v AS (SELECT *, CASE WHEN n_words = 0 THEN [0, 0, 0, 0, 0, 0, 0, 0] ELSE [
                CASE WHEN word_chars BETWEEN 3 * n_words AND 10 * n_words THEN 1
                     WHEN 2 * word_chars < 5 * n_words OR word_chars > 14 * n_words THEN 2 ELSE 0 END,
                CASE WHEN 100 * n_symbols <= n_words THEN 1 WHEN 10 * n_symbols >= n_words THEN 2 ELSE 0 END,
                CASE WHEN 10 * n_repeat_words <= n_words THEN 1
                     WHEN 10 * n_repeat_words >= 3 * n_words THEN 2 ELSE 0 END,
                CASE WHEN n_lines < 2 THEN 0 WHEN 10 * n_dup_lines <= n_lines THEN 1
                     WHEN 10 * n_dup_lines >= 3 * n_lines THEN 2 ELSE 0 END,
                CASE WHEN 10 * n_other <= word_chars THEN 1 WHEN 10 * n_other >= 3 * word_chars THEN 2 ELSE 0 END,
                CASE WHEN n_words BETWEEN 3 * n_marks AND 60 * n_marks THEN 1
                     WHEN 2 * n_words < 3 * n_marks OR n_words > 200 * n_marks THEN 2 ELSE 0 END,
                CASE WHEN 100 * n_capitals <= 15 * word_chars THEN 1
                     WHEN 100 * n_capitals >= 40 * word_chars THEN 2 ELSE 0 END,
                CASE WHEN n_words < 50 THEN 0 WHEN n_distinct * n_distinct >= 16 * n_words THEN 1
                     WHEN n_distinct * n_distinct < 4 * n_words THEN 2 ELSE 0 END] END AS votes FROM m),
        pat AS MATERIALIZED (SELECT votes, count(*) AS n FROM v GROUP BY votes),
        pr AS MATERIALIZED (SELECT votes, n, j, votes[j] AS vote FROM pat, range(1, 9) AS r(j)),
        start AS (SELECT k, j, CASE WHEN k = 0 THEN 0.8 ELSE 0.2 / 8 END::DOUBLE AS share0,
                         CASE WHEN k = 0 THEN 0.9 WHEN k = j THEN 0.1 ELSE 0.8 END::DOUBLE AS good0
                  FROM range(9) AS a(k), range(1, 9) AS b(j)),
        em AS (
          SELECT 0 AS round, k, j, share0 AS share, good0 AS good FROM start
          UNION ALL
          SELECT round + 1, k, j, share, least(rate, first_value(rate) OVER (PARTITION BY j ORDER BY k),
                                               CASE WHEN k = j THEN 0.5 ELSE 1 END)
          FROM (
            SELECT round, k, j,
                   (weight + 5 * share0) / (sum(weight) OVER (PARTITION BY j) + 5) AS share,
                   (yes + 5 * good0) / (voted + 5) AS rate
            FROM (SELECT round, q.k, pr.j, sum(q.w) AS weight,
                         sum(CASE WHEN vote = 1 THEN q.w ELSE 0 END) AS yes,
                         sum(CASE WHEN vote > 0 THEN q.w ELSE 0 END) AS voted
                  FROM (SELECT round, votes, k, n * p / sum(p) OVER (PARTITION BY votes) AS w
                        FROM (SELECT round, votes, n, k,
                                     first(share) * exp(sum(CASE vote WHEN 1 THEN ln(good) WHEN 2 THEN ln(1 - good)
                                                            ELSE 0 END)) AS p
                              FROM em JOIN pr ON pr.j = em.j WHERE round < 30 GROUP BY round, votes, n, k)) q
                  JOIN pr ON pr.votes = q.votes GROUP BY round, q.k, pr.j)
            JOIN start USING (k, j))),
        post AS (SELECT votes, sum(p) FILTER (k = 0) / sum(p) AS posterior
                 FROM (SELECT votes, k, first(share) * exp(sum(CASE vote WHEN 1 THEN ln(good) WHEN 2 THEN ln(1 - good)
                                                               ELSE 0 END)) AS p
                       FROM em JOIN pr ON pr.j = em.j WHERE round = 30 GROUP BY votes, k) GROUP BY votes)
        SELECT doc_id, n_words::BIGINT AS n_words, word_chars, n_symbols::BIGINT AS n_symbols,
               n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
               n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
               NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND posterior >= 0.5 AS kept,
               round(posterior, 3) AS posterior
        FROM v JOIN post USING (votes)""",
    "op13_manifest": r"""
        WITH RECURSIVE f AS (
          SELECT row_number() OVER () AS row, doc_id, source, text,
                 coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
                 || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
                 flatten(list_transform(string_split(doc_id::VARCHAR, ''),
                         lambda c: list_transform(range(8), lambda k: (ord(c) >> k) & 1))) AS bits FROM documents),
        e AS (SELECT *, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
                     replace(text, chr(10), '') AS cut,
                     doc_id IS NULL OR (list_reduce(list_prepend(4294967295::BIGINT, bits), lambda s, b:
                         xor(s >> 1, CASE WHEN xor(s, b) & 1 = 1 THEN 3988292384 ELSE 0 END)) & 1) = 1 AS hit FROM f),
        p AS (SELECT row, doc_id, source, leaf,
                     CASE WHEN hit THEN sha256(head || coalesce(strlen(cut) || ':' || cut, '-')) ELSE leaf END AS now,
                     dense_rank() OVER (ORDER BY source NULLS FIRST) AS tree,
                     row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
                     count(*) OVER (PARTITION BY source) AS n FROM e),
        nodes AS (SELECT 0 AS level, tree, pos, leaf AS d, n FROM p
                  UNION ALL SELECT level + 1, tree, pos // 3, sha256(string_agg(d, '' ORDER BY pos)), (n + 2) // 3
                  FROM nodes WHERE n > 1 GROUP BY level, tree, pos // 3, n),
        tops AS (SELECT tree - 1 AS pos, d, count(*) OVER () AS n FROM nodes WHERE n = 1),
        upper AS (SELECT 0 AS level, pos, d, n FROM tops
                  UNION ALL SELECT level + 1, pos // 3, sha256(string_agg(d, '' ORDER BY pos)), (n + 2) // 3
                  FROM upper WHERE n > 1 GROUP BY level, pos // 3, n),
        sides AS MATERIALIZED (
          SELECT level, tree, pos, coalesce(string_agg(d, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
                 coalesce(string_agg(d, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
          FROM (SELECT level, tree, pos, d FROM nodes WHERE n > 1 UNION ALL SELECT level, 0, pos, d FROM upper WHERE n > 1)
          WINDOW w AS (PARTITION BY level, tree, pos // 3 ORDER BY pos)),
        own AS (SELECT row, tree, 0 AS level, pos, now AS d, '' AS proof FROM p
                UNION ALL SELECT row, tree, level + 1, own.pos // 3, sha256(l || d || r), proof || l || r
                FROM own JOIN sides USING (level, tree) WHERE sides.pos = own.pos),
        went AS (SELECT row, tree, 0 AS level, tree - 1 AS pos, d, proof FROM own QUALIFY level = max(level) OVER (PARTITION BY row)
                 UNION ALL SELECT row, went.tree, went.level + 1, went.pos // 3, sha256(l || d || r), proof || l || r
                 FROM went JOIN sides ON sides.level = went.level AND sides.tree = 0 AND sides.pos = went.pos),
        done AS (SELECT row, d, proof FROM went QUALIFY level = max(level) OVER (PARTITION BY row))
        SELECT doc_id, leaf, tops.d AS subroot, top.d AS root, sha256(proof) AS proof_sha256, done.d AS folded_root,
               done.d = top.d AS verified
        FROM p JOIN done USING (row) JOIN tops ON tops.pos = p.tree - 1 JOIN upper top ON top.n = 1""",
}
