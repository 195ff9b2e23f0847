"""The registered queries of the corpus operators, and SQL to compare them with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    cap_filters,
    chat_format,
    exact_dedup,
    kd_shards,
    lexical_search,
    lm_scoring,
    packing,
    phrases,
    quality,
    sentence_pieces,
    simhash,
    token_files,
    url_rules,
)
from tidemark.llm.common import new_folder, stored, table


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.piece_digests(packing.pack(table(spark, sf_dir, "documents")))


def op2_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_pieces.round_trip(table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents")).drop("row", "kept")


def op4_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_shards.shard(table(spark, sf_dir, "documents"))


# The rules of the contract: fixed values.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_rules.judge(table(spark, sf_dir, "pages"), rules)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path)
    return token_files.token_digests(spark, path)


def op9_cap_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cap_filters.near_vectors(table(spark, sf_dir, "embeddings"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents")).drop("row")


# The conversation that the contract adds: fixed values.
ADDED_CONVERSATION = """
    SELECT -7L AS conv_id, 0L AS turn, 'user' AS role, '</s>[INST] ok [/INST]' AS text
    UNION ALL SELECT -7L, 1L, 'assistant', '</s>[INST] ok [/INST]'
"""


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    formatted = chat_format.examples(given.unionByName(spark.sql(ADDED_CONVERSATION)))
    return chat_format.conversation_digests(stored(formatted, "chat-examples"))


def op11_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return lm_scoring.score(docs, lm_scoring.fit(docs))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = lexical_search.build_index(table(spark, sf_dir, "documents"))
    return lexical_search.search(index, table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_sentence_pieces": op2_sentence_pieces,
    "op3_simhash": op3_simhash,
    "op4_kd_shards": op4_kd_shards,
    "op5_url_rules": op5_url_rules,
    "op6_quality": op6_quality,
    "op7_token_files": op7_token_files,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_cap_filters": op9_cap_filters,
    "op10_chat_format": op10_chat_format,
    "op11_lm_scores": op11_lm_scores,
    "op12_collocations": op12_collocations,
    "op13_lexical_search": op13_lexical_search,
}

ORACLE_SQL: dict[str, str] = {
    "op5_url_rules": r"""
        WITH rest AS (
            SELECT page_id, CASE WHEN contains(url, '://')
                       THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
            FROM pages
        ), parsed AS (
            SELECT page_id,
                   translate(regexp_extract(rest, '^([^/?#]*)', 1),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM rest
        ), rules(rule_host, rule_path, rule_verdict) AS (
            VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
                   ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'),
                   ('com', '/de/', 'block')
        ), best AS (
            SELECT p.page_id, p.host, p.path,
                   arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
                   arg_max(rule_verdict, length(rule_host || rule_path)) AS rule_verdict
            FROM parsed p LEFT JOIN rules
              ON (p.host = rule_host OR ends_with(p.host, '.' || rule_host))
             AND starts_with(p.path, rule_path)
            GROUP BY ALL
        )
        SELECT page_id, host, path, rule, coalesce(rule_verdict, 'allow') AS verdict FROM best
    """,
    "op8_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS text,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g'))
                       AS text_sha256
            FROM documents
        ), w AS (
            SELECT *, first_value(doc_id) OVER (
                       PARTITION BY text_sha256 ORDER BY length(text) DESC, doc_id NULLS LAST
                   ) AS keep_id,
                   count(*) OVER (PARTITION BY text_sha256) AS group_size
            FROM d
        )
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM w
    """,
    "op10_chat_format": r"""
        WITH c AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
            FROM conversations
            UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
        ), sized AS (
            SELECT *,
                   20 + length(regexp_replace(role, '([<\[])(\\*)(/?(?:s>|INST\]))', '\1\\\2\3', 'g'))
                      + length(regexp_replace(text, '([<\[])(\\*)(/?(?:s>|INST\]))', '\1\\\2\3', 'g'))
                       AS written,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS number,
                   count(*) OVER (PARTITION BY conv_id) AS n
            FROM c
        ), placed AS (
            SELECT *, sum(written) OVER (PARTITION BY conv_id ORDER BY number) AS upto FROM sized
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY number))
                   AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY number) FILTER (role = 'assistant'), ''))
                   AS loss_sha256,
               sum(upto) FILTER (role = 'assistant' OR number = n)::BIGINT AS formatted_chars
        FROM placed GROUP BY conv_id
    """,
    "op12_collocations": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, doc, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece
            FROM (SELECT lang, row_number() OVER () AS doc,
                         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
                  FROM documents)
        ), numbered AS (
            SELECT lang, row_number() OVER () AS piece, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces
        ), placed AS (
            SELECT lang, piece, unnest(words) AS w, unnest(range(len(words))) AS place FROM numbered
        ), followed AS (
            SELECT lang, w AS w1, lead(w, 1) OVER p AS w2, lead(w, 2) OVER p AS w3, lead(w, 3) OVER p AS w4,
                   lead(w, 4) OVER p AS w5
            FROM placed WINDOW p AS (PARTITION BY piece ORDER BY place)
        ), counts AS (
            SELECT lang, 1 AS k, w1 AS phrase, count(*) AS f FROM followed GROUP BY ALL
            UNION ALL SELECT lang, 2, w1 || ' ' || w2, count(*) FROM followed WHERE w2 IS NOT NULL GROUP BY ALL
            UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3, count(*) FROM followed
                      WHERE w3 IS NOT NULL GROUP BY ALL
            UNION ALL SELECT lang, 4, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4, count(*) FROM followed
                      WHERE w4 IS NOT NULL GROUP BY ALL
            UNION ALL SELECT lang, 5, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 || ' ' || w5, count(*) FROM followed
                      WHERE w5 IS NOT NULL GROUP BY ALL
        ), totals AS (
            SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE k = 1 GROUP BY lang
        ), candidates AS (
            SELECT * FROM counts WHERE k > 1 AND f >= 100
        ), halves AS (
            SELECT lang, f, array_to_string(string_split(phrase, ' ')[1:k - 1], ' ') AS phrase FROM candidates
            UNION ALL
            SELECT lang, f, array_to_string(string_split(phrase, ' ')[2:k], ' ') FROM candidates
        ), covering AS (
            SELECT lang, phrase, max(f) AS f FROM halves GROUP BY ALL
        ), cuts AS (
            SELECT c.lang, c.phrase, c.f AS a, cut,
                   array_to_string(string_split(c.phrase, ' ')[1:cut], ' ') AS head,
                   array_to_string(string_split(c.phrase, ' ')[cut + 1:c.k], ' ') AS tail
            FROM candidates c LEFT JOIN covering USING (lang, phrase), (SELECT unnest([1, 2, 3, 4]) AS cut)
            WHERE cut < c.k AND coalesce(covering.f < c.f, true)
        ), scored AS (
            SELECT cuts.lang, cuts.phrase, a, cut, l.f AS l, r.f AS r, n,
                   ((1000::HUGEINT * a * n) // (l.f::HUGEINT * r.f))::BIGINT AS score
            FROM cuts JOIN totals USING (lang)
            JOIN counts l ON l.lang = cuts.lang AND l.phrase = head
            JOIN counts r ON r.lang = cuts.lang AND r.phrase = tail
        ), lowest AS (
            SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest
        )
        SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
    """,
    "op13_lexical_search": r"""
        WITH d AS (
            SELECT doc_id, row_number() OVER () AS doc,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM documents
        ), sizes AS (
            SELECT doc_id, doc, len(terms) AS n FROM d WHERE len(terms) > 0
        ), figures AS (
            SELECT count(*) AS big_n, sum(n)::BIGINT AS l FROM sizes
        ), postings AS (
            SELECT doc, term, count(*) AS tf FROM (SELECT doc, unnest(terms) AS term FROM d) GROUP BY ALL
        ), weights AS (
            SELECT term, floor(1000 * ln((2.0::DOUBLE * big_n + 2) / (2.0::DOUBLE * count(*) + 1)))::BIGINT AS w
            FROM postings, figures GROUP BY term, big_n
        ), wanted AS (
            SELECT item_id, item, term, count(*) AS times FROM (
                SELECT item_id, row_number() OVER () AS item,
                       unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                           'abcdefghijklmnopqrstuvwxyz'),
                                                 '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
                FROM benchmark
            ) GROUP BY ALL
        ), scored AS (
            SELECT item_id, item, doc_id, doc,
                   sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * big_n) // l))))::BIGINT
                       AS score
            FROM wanted JOIN weights USING (term) JOIN postings USING (term) JOIN sizes USING (doc), figures
            GROUP BY ALL
        ), ranked AS (
            SELECT item_id, doc_id, score, row_number() OVER (
                       PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST, doc)::INTEGER AS rank
            FROM scored WHERE score > 0
        )
        SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
    """,
}
