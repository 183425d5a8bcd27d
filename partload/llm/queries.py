"""The registered queries of the corpus operators, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partload.llm import (
    fingerprints, langid, lines, minhash, mixing, packing, quality, quotes, ranked, substring, vectors, warc,
    whitening,
)
from partload.llm.common import read


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def near_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    params = minhash.NearParams(shingle=3, percent=85)
    return minhash.near_duplicates(read(spark, sf_dir, "documents"), params)


def repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring.remove_repeats(
        read(spark, sf_dir, "documents"), substring.RepeatParams(window=35)
    )
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def packed_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def document_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return judged.select("doc_id", "model", "trusted", "symbols", "perplexity", "threshold", "kept")


def document_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read(spark, sf_dir, "documents"))


def near_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(read(spark, sf_dir, "embeddings"))


def document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(read(spark, sf_dir, "documents"))


def archived_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def linked_quotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = quotes.link_quotations(read(spark, sf_dir, "conversations"))
    return linked.withColumn("chat", quotes.chat_text()).drop("clean")


def mixed_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix(read(spark, sf_dir, "documents"))
    return mixing.words_taken(plan).select("doc_id", "size", "source_size", "target", "taken")


def distinct_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.drop_repeated_lines(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def whitened_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings"))


def ranked_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.ranked(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


QUERIES = {
    "op11_ranked_documents": ranked_documents,
    "op12_distinct_lines": distinct_lines,
    "op13_whitened_embeddings": whitened_embeddings,
    "op1_linked_quotations": linked_quotations,
    "op2_document_languages": document_languages,
    "op3_packed_sequences": packed_sequences,
    "op7_document_fingerprints": document_fingerprints,
    "op8_mixed_sources": mixed_sources,
    "op4_near_embeddings": near_embeddings,
    "op5_document_quality": document_quality,
    "op6_near_documents": near_documents,
    "op10_archived_pages": archived_pages,
    "op9_repeated_passages": repeated_passages,
}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLES: dict[str, str] = {
    "op1_linked_quotations": r"""
        WITH RECURSIVE m AS (
            SELECT row_number() OVER (
                ORDER BY conv_id NULLS FIRST, turn NULLS FIRST, role NULLS FIRST, coalesce(text, '')) AS place,
                conv_id, turn, role, replace(coalesce(text, ''), chr(13), '') AS text
            FROM conversations
        ), l AS (
            SELECT place, conv_id, i, raw,
                length(regexp_replace(regexp_extract(raw, '^[ \t]*((?:>[ \t]*)+)', 1), '[^>]', '', 'g')) AS level,
                trim(regexp_replace(lower(regexp_replace(raw, '^[ \t]*((?:>[ \t]*)+)', '')), '\s+', ' ', 'g')) AS words
            FROM (SELECT *, unnest(string_split(text, chr(10))) AS raw,
                    generate_subscripts(string_split(text, chr(10)), 1) AS i FROM m)
        ), o AS (
            SELECT *, level = 0 AND NOT (regexp_matches(words, '(wrote|writes|said):$')
                AND coalesce(lead(level) OVER (PARTITION BY place ORDER BY i), 0) > 0) AS own
            FROM l
        ), g AS (
            SELECT *, i - row_number() OVER (PARTITION BY place, level ORDER BY i) AS run FROM l WHERE words <> ''
        ), p AS (
            SELECT place, conv_id, level, run, string_agg(words, ' ' ORDER BY i) AS words, count(*) AS n
            FROM g GROUP BY ALL
        ), offer AS (
            SELECT conv_id, words, min(place) AS origin FROM (
                SELECT conv_id, place, string_agg(words, ' ' ORDER BY i) AS words FROM o
                WHERE own AND words <> '' GROUP BY conv_id, place
                UNION ALL SELECT conv_id, place, words FROM p WHERE level = 0
                UNION ALL SELECT conv_id, place, words FROM g WHERE level = 0
            ) GROUP BY conv_id, words
        ), vote AS (
            SELECT v.place, v.level, v.run, f.origin, v.weight FROM (
                SELECT place, conv_id, level, run, words, n AS weight FROM p WHERE level > 0
                UNION ALL
                SELECT g.place, g.conv_id, g.level, g.run, g.words, 1
                FROM g JOIN p USING (place, level, run) WHERE g.level > 0 AND p.n > 1
            ) AS v JOIN offer AS f ON f.conv_id IS NOT DISTINCT FROM v.conv_id AND f.words = v.words
                AND f.origin < v.place
        ), quoted AS (
            SELECT place, max_by(origin, (votes, origin)) AS origin FROM (
                SELECT place, origin, sum(weight) AS votes FROM vote WHERE level = 1 GROUP BY place, origin
            ) GROUP BY place
        ), found AS (
            SELECT place, count(*) AS linked FROM (SELECT DISTINCT place, level, run FROM vote) GROUP BY place
        ), reply AS (
            SELECT m.*, coalesce(q.origin, lag(m.place) OVER (PARTITION BY conv_id ORDER BY m.place)) AS up
            FROM m LEFT JOIN quoted AS q USING (place)
        ), tree AS (
            SELECT place, [place] AS path FROM reply WHERE up IS NULL
            UNION ALL
            SELECT r.place, list_append(t.path, r.place) FROM tree AS t JOIN reply AS r ON r.up = t.place
        ), shape AS (
            SELECT place, max(level)::INTEGER AS levels,
                regexp_replace(coalesce(string_agg(raw, chr(10) ORDER BY i) FILTER (WHERE own), ''),
                    '^\s*\n|\s+$', '', 'g') AS clean
            FROM o GROUP BY place
        )
        SELECT r.conv_id, r.turn, r.role, s.levels,
            (SELECT count(*) FROM p WHERE p.place = r.place AND level > 0)::INTEGER AS passages,
            coalesce(f.linked, 0)::INTEGER AS linked, u.turn AS reply_to,
            row_number() OVER (PARTITION BY r.conv_id ORDER BY t.path) - 1 AS reply_index,
            '<|' || coalesce(r.role, 'unknown') || '|>' || chr(10) || s.clean || chr(10) AS chat
        FROM reply AS r JOIN tree AS t USING (place) JOIN shape AS s USING (place)
            LEFT JOIN found AS f USING (place) LEFT JOIN m AS u ON u.place = r.up
    """,
    "op4_near_embeddings": """
        WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
        u AS (
            SELECT vec_id, e FROM v
            WHERE e IS NOT NULL AND len(e) = len(list_filter(e, lambda x: x IS NOT NULL AND isfinite(x)))
                AND list_sum(list_transform(e, lambda x: x * x)) > 0
        ), link AS (
            SELECT x.vec_id AS a, y.vec_id AS b
            FROM u AS x JOIN u AS y ON x.vec_id <> y.vec_id AND len(x.e) = len(y.e)
            WHERE list_cosine_similarity(x.e, y.e) >= 0.95
        ), reach AS (
            SELECT vec_id AS a, vec_id AS b FROM v
            UNION
            SELECT r.a, l.b FROM reach AS r JOIN link AS l ON l.a = r.b
        ), n AS (SELECT a, count(*) AS n FROM link GROUP BY a)
        SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, low AS component_id, low = vec_id AS kept
        FROM v JOIN (SELECT a, min(b) AS low FROM reach GROUP BY a) AS r ON r.a = vec_id
            LEFT JOIN n ON n.a = vec_id
    """,
    "op6_near_documents": r"""
        WITH RECURSIVE d AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ), s AS (
            SELECT DISTINCT doc_id, unnest(CASE
                WHEN len(w) = 0 THEN []
                WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))
            END) AS g
            FROM d
        ), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        link AS (
            SELECT x.doc_id AS a, y.doc_id AS b
            FROM s AS x JOIN s AS y ON x.g = y.g AND x.doc_id <> y.doc_id
                JOIN n AS p ON p.doc_id = x.doc_id JOIN n AS q ON q.doc_id = y.doc_id
            GROUP BY x.doc_id, y.doc_id, p.n, q.n
            HAVING 100 * count(*) >= 85 * (p.n + q.n - count(*))
        ), reach AS (
            SELECT doc_id AS a, doc_id AS b FROM d
            UNION
            SELECT r.a, l.b FROM reach AS r JOIN link AS l ON l.a = r.b
        )
        SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, min(r.b) AS component_id,
            min(r.b) = d.doc_id AS kept
        FROM d JOIN reach AS r ON r.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
        GROUP BY d.doc_id, n.n
    """,
    "op10_archived_pages": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
        h AS (SELECT page_id, html, strlen(html)::BIGINT AS bytes, sha1(html) AS hex FROM p),
        d AS (
            SELECT page_id, html, bytes, array_to_string(list_transform(range(0, 32), lambda i:
                substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                    ((('0x' || substr(hex, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31) + 1,
                    1)), '') AS payload_digest
            FROM h
        ), f AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS first FROM d)
        SELECT page_id, bytes AS payload_bytes, payload_digest,
            CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN page_id > first THEN first END AS refers_to
        FROM f
    """,
    "op11_ranked_documents": r"""
        WITH t AS (
            SELECT doc_id, unnest(regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM documents
        ), c AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
        l AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM c GROUP BY doc_id),
        g AS (SELECT count(*) AS N_, sum(n)::BIGINT AS L_ FROM l),
        w AS (
            SELECT term, floor(1000 * ln((2 * N_ + 2) / (2 * count(*) + 1)))::BIGINT AS w
            FROM c, g GROUP BY term, N_
        ), q AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM benchmark
        ), s AS (
            SELECT item_id, doc_id,
                sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * N_) // L_))))::BIGINT AS score
            FROM q JOIN w USING (term) JOIN c USING (term) JOIN l USING (doc_id), g
            GROUP BY item_id, doc_id HAVING score > 0
        )
        SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank,
            doc_id, score
        FROM s QUALIFY rank <= 10
    """,
    "op12_distinct_lines": r"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
        l AS (
            SELECT r, doc_id, unnest(string_split(text, chr(10))) AS line,
                generate_subscripts(string_split(text, chr(10)), 1) AS i
            FROM d
        ), k AS (
            SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM l
        ), f AS (
            SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10
            GROUP BY key HAVING count(DISTINCT doc_id) > 1
        ), g AS (SELECT k.*, coalesce(k.doc_id > f.first, false) AS gone FROM k LEFT JOIN f USING (key))
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
            sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
        FROM g GROUP BY r, doc_id
    """,
    "op9_repeated_passages": rf"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
        win AS (
            SELECT r, i, md5(array_to_string(w[i:i + 34], ' ')) AS h
            FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)
        ), twice AS (SELECT h FROM win GROUP BY h HAVING count(*) > 1),
        gone AS (
            SELECT DISTINCT r, i + k AS i
            FROM win SEMI JOIN twice USING (h), (SELECT unnest(range(0, 35)) AS k)
        ), left_over AS (
            SELECT r, list(word ORDER BY i) AS kept
            FROM (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d)
                ANTI JOIN gone USING (r, i)
            GROUP BY r
        )
        SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(len(kept), 0))::BIGINT AS n_removed,
            sha256(coalesce(array_to_string(kept, ' '), '')) AS kept_sha256
        FROM d LEFT JOIN left_over USING (r)
    """,
}
