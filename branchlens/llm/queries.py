"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from branchlens.session import scratch_path

from . import (conversation_repair, filter_audit, line_winnow, lm_automaton, mixing, packing, pii_feistel, prefix_tree_join,
               quality_fm, rp_forest, substring_anchors, topk_pivots, warc)
from .tables import table


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document by a factorisation machine (whole texts)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~quality_fm.is_held_out())
    model = quality_fm.train(docs, labels)
    scored = quality_fm.score(docs, model)
    return scored.select("doc_id", quality_fm.is_held_out().alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents without windows of 50 words that a smaller doc_id also has."""
    kept = substring_anchors.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def tokeniser_paths() -> tuple[str, str]:
    """The public vocabulary files, found on each machine that has the package."""
    import public_tokenizers
    return public_tokenizers.path(packing.TOKENISER), public_tokenizers.path(packing.RANKS)


def op3_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    return packing.pack(packing.tokenise(table(spark, sf_dir, "documents"), *tokeniser_paths()))


def op4_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probability of every document under the n-gram automaton of the training documents."""
    return lm_automaton.score_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


#: Example key of the registered query; a production job passes its own secret.
EXAMPLE_KEY = b"branchlens example key"


def op5_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with format-preserving pseudonyms in place of personal data."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii_feistel.pseudonymise(docs, EXAMPLE_KEY)


def op6_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings with cosine >= 0.95, by a random-projection forest."""
    return rp_forest.near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines deleted from every document as later repeats of a run, by winnowing."""
    kept = line_winnow.drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 4-word shingle sets have a Jaccard similarity of 0.85 or more."""
    return prefix_tree_join.similar_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that the mix takes, by Pareto order sampling."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    mixed = mixing.apply_mix(docs, mixing.plan_mix(docs))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five highest integer inner products of every query row, by a pivot-distance index."""
    return topk_pivots.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC archives (chunks, segments, revisits) and read back from them."""
    path = f"{scratch_path(spark, 'warc')}/archives"
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.read_pages(spark, path, payloads=False).drop("payload")


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every damaged conversation, by big-integer path weights."""
    conversations = table(spark, sf_dir, "conversations")
    return conversation_repair.repair_report(conversations, conversation_repair.damage(conversations))


def op13_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every order of the five filters removes at every step, by Lehmer-rank differences."""
    return filter_audit.audit(filter_audit.masks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


QUERIES = {
    "op1_quality": op1_quality,
    "op2_substrings": op2_substrings,
    "op3_pack": op3_pack,
    "op4_lm": op4_lm,
    "op5_pseudonyms": op5_pseudonyms,
    "op6_vectors": op6_vectors,
    "op7_lines": op7_lines,
    "op8_jaccard": op8_jaccard,
    "op9_mix": op9_mix,
    "op10_topk": op10_topk,
    "op11_warc": op11_warc,
    "op12_conversations": op12_conversations,
    "op13_audit": op13_audit,
}

#: SQL exists where DuckDB can express the operator and its limits.
ORACLE: dict[str, str] = {
    "op2_substrings": r"""
        WITH split AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        windows AS (
            SELECT doc_id, pos, array_to_string(list_slice(w, pos, pos + 49), ' ') AS run
            FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 49)) AS pos FROM split WHERE len(w) >= 50)),
        judged AS (SELECT doc_id, pos, min(doc_id) OVER (PARTITION BY run) < doc_id AS repeated FROM windows),
        covered AS (
            SELECT DISTINCT doc_id, unnest(generate_series(pos, pos + 49)) AS at_word FROM judged WHERE repeated),
        words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS at_word FROM split),
        kept AS (
            SELECT x.doc_id, count(*) AS n_words, count(c.at_word) AS n_removed,
                   string_agg(x.word, ' ' ORDER BY x.at_word) FILTER (c.at_word IS NULL) AS text
            FROM words x LEFT JOIN covered c ON c.doc_id = x.doc_id AND c.at_word = x.at_word GROUP BY x.doc_id)
        SELECT d.doc_id, coalesce(k.n_words, 0) AS n_words, coalesce(k.n_removed, 0) AS n_removed,
               sha256(coalesce(k.text, '')) AS kept_sha256
        FROM documents d LEFT JOIN kept k USING (doc_id)""",
    "op7_lines": """
        WITH raw AS (
            SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line,
                   generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents WHERE text IS NOT NULL),
        trimmed AS (SELECT doc_id, pos, line, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS t FROM raw),
        numbered AS (
            SELECT doc_id, pos, t, row_number() OVER w AS n, lead(t) OVER w AS t2, lead(pos) OVER w AS pos2
            FROM trimmed WHERE t <> '' WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
        placed AS (
            SELECT *, first_value(doc_id) OVER w AS first_doc, first_value(n) OVER w AS first_n
            FROM numbered WHERE t2 IS NOT NULL WINDOW w AS (PARTITION BY t, t2 ORDER BY doc_id, n)),
        repeated AS (SELECT * FROM placed WHERE first_doc < doc_id OR first_n + 2 <= n),
        gone AS (SELECT doc_id, pos FROM repeated UNION SELECT doc_id, pos2 FROM repeated),
        kept AS (
            SELECT r.doc_id, count(*) FILTER (r.t <> '') AS n_lines, count(g.pos) AS n_removed,
                   coalesce(string_agg(r.line, chr(10) ORDER BY r.pos) FILTER (g.pos IS NULL), '') AS text
            FROM trimmed r LEFT JOIN gone g ON g.doc_id = r.doc_id AND g.pos = r.pos GROUP BY r.doc_id)
        SELECT d.doc_id, coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_removed, 0) AS n_removed,
               sha256(coalesce(k.text, '')) AS kept_sha256
        FROM documents d LEFT JOIN kept k USING (doc_id)""",
    "op8_jaccard": r"""
        WITH RECURSIVE split AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
        shingles AS (
            SELECT DISTINCT doc_id, array_to_string(list_slice(w, pos, pos + 3), ' ') AS s
            FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 3))) AS pos
                  FROM split WHERE len(w) > 0)),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        common AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both
            FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
        links AS (
            SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
            WHERE 100 * n_both >= 85 * (x.n + y.n - n_both)),
        reach(doc_id, least) AS (
            SELECT doc_id, doc_id FROM documents
            UNION SELECT l.b, r.least FROM reach r JOIN links l ON l.a = r.doc_id),
        parts AS (SELECT doc_id, min(least) AS component_id FROM reach GROUP BY doc_id)
        SELECT p.doc_id, coalesce(s.n, 0) AS n_shingles, p.component_id
        FROM parts p LEFT JOIN sizes s USING (doc_id)""",
    "op10_topk": """
        WITH scaled AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        pairs AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
            FROM scaled q JOIN scaled c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM pairs)
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5""",
    "op6_vectors": """
        WITH RECURSIVE good AS (
            SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id
            WHERE list_cosine_similarity(a.v, b.v) >= 0.95),
        reach(vec_id, least) AS (
            SELECT vec_id, vec_id FROM embeddings
            UNION SELECT l.b, r.least FROM reach r JOIN links l ON l.a = r.vec_id),
        parts AS (SELECT vec_id, min(least) AS component_id FROM reach GROUP BY vec_id),
        degrees AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
        SELECT p.vec_id, coalesce(d.n_links, 0) AS n_links, p.component_id, p.vec_id = p.component_id AS kept
        FROM parts p LEFT JOIN degrees d USING (vec_id)""",
    "op11_warc": """
        WITH sized AS (
            SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
        placed AS (
            SELECT page_id, n, sha256(html) AS digest, first_value(page_id) OVER w AS first_id,
                   n >= 100 AND row_number() OVER w > 1 AS again
            FROM sized WINDOW w AS (PARTITION BY html ORDER BY page_id NULLS LAST))
        SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
               CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN again THEN first_id END::DOUBLE AS refers_to, NULL::VARCHAR AS fault FROM placed""",
    "op12_conversations": r"""
        WITH RECURSIVE keyed AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
        coded AS (
            SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(k, ''),
                   lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
                   lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x) ELSE xor(crc >> 1, 3988292384 * (crc & 1)) END),
                   4294967295::BIGINT) % 20 AS kind FROM keyed),
        damaged AS (
            SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                   CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
            FROM coded, generate_series(1, CASE WHEN kind = 3 THEN 2 ELSE 1 END) WHERE kind <> 0),
        placed AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n,
                   left(role, 1) AS r, right(regexp_replace(text, '[\x20\x09-\x0D]+$', ''), 1) AS last_char FROM damaged),
        faulty AS (
            SELECT *, last_char = '' AS blank,
                   last_char <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 AS duplicate,
                   lag(r) OVER (PARTITION BY conv_id ORDER BY n) AS before FROM placed),
        judged AS (SELECT *, NOT blank AND NOT duplicate AND last_char NOT IN ('.', '!', '?') AS truncated FROM faulty),
        counted AS (
            SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                   count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
                   count(*) FILTER (truncated) AS truncated,
                   count(*) FILTER (before IS NOT NULL AND before || r NOT IN ('su', 'ua', 'au')) AS illegal
            FROM judged GROUP BY conv_id),
        inserts(q, here, head, paid, lines) AS (VALUES
            ('-', '-', '', 0, ''), ('-', 'u', 'I', 3, 'user:' || chr(10)),
            ('-', 'a', 'II', 6, 'user:' || chr(10) || 'assistant:' || chr(10)),
            ('s', 's', '', 0, ''), ('s', 'u', 'I', 3, 'user:' || chr(10)),
            ('s', 'a', 'II', 6, 'user:' || chr(10) || 'assistant:' || chr(10)),
            ('u', 'u', '', 0, ''), ('u', 'a', 'I', 3, 'assistant:' || chr(10)),
            ('a', 'a', '', 0, ''), ('a', 'u', 'I', 3, 'user:' || chr(10))),
        legal(here, r, to_q) AS (VALUES ('-', 's', 's'), ('-', 'u', 'u'), ('s', 'u', 'u'), ('a', 'u', 'u'), ('u', 'a', 'a')),
        edits AS (
            SELECT j.conv_id, j.n, i.q, x.to_q, i.paid + x.cost AS cost, i.head || x.letter AS letters, i.lines || x.line AS lines
            FROM judged j, inserts i, LATERAL (
                SELECT i.here AS to_q, 4 AS cost, 'D' AS letter, '' AS line
                UNION ALL SELECT l.to_q, CASE WHEN l.r = j.r THEN 0 ELSE 3 END + CASE WHEN j.truncated THEN 3 ELSE 0 END,
                       CASE WHEN l.r = j.r THEN 'K' ELSE 'R' END,
                       CASE WHEN l.r = j.r THEN j.role WHEN l.r = 'u' THEN 'user' ELSE 'assistant' END || ':' || j.text || chr(10)
                FROM legal l WHERE l.here = i.here AND (l.r = j.r OR l.r <> 's') AND NOT j.blank AND NOT j.duplicate) x),
        paths(conv_id, n, q, best) AS (
            SELECT conv_id, 0::BIGINT, '-', {'cost': 0, 'audit': '', 'lines': ''} FROM counted
            UNION ALL
            SELECT p.conv_id, e.n, e.to_q, min({'cost': p.best.cost + e.cost, 'audit': p.best.audit || e.letters,
                                               'lines': p.best.lines || e.lines})
            FROM paths p JOIN edits e ON e.conv_id IS NOT DISTINCT FROM p.conv_id AND e.n = p.n + 1 AND e.q = p.q
            GROUP BY p.conv_id, e.n, e.to_q),
        ends AS (
            SELECT p.conv_id, min({'cost': p.best.cost + i.paid, 'audit': p.best.audit || i.head,
                                   'lines': p.best.lines || i.lines}) AS best
            FROM paths p JOIN counted c ON c.conv_id IS NOT DISTINCT FROM p.conv_id AND c.n = p.n
            JOIN inserts i ON i.q = p.q AND i.here IN ('-', 'a') GROUP BY p.conv_id)
        SELECT o.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate,
               coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal,
               coalesce(e.best.cost, 0)::BIGINT AS cost, coalesce(e.best.audit, '') AS audit,
               sha256(coalesce(regexp_replace(e.best.lines, '\n$', ''), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) o
        LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
        LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM o.conv_id""",
    "op13_audit": r"""
        WITH letters(l, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
        orders AS (
            SELECT a.l || b.l || c.l || d.l || e.l AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
            FROM letters a, letters b, letters c, letters d, letters e
            WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31),
        texts AS (
            SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        failed AS (
            SELECT doc_id, part, CASE WHEN len(w) < 200 THEN 1 ELSE 0 END
                   + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
                   + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 4 ELSE 0 END
                   + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
                   + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS mask FROM texts),
        marked AS (
            SELECT part, mask, doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL) AS good,
                   doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL) AS toxic FROM failed),
        counts AS (
            SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
            FROM marked GROUP BY ALL),
        runs AS (
            SELECT c.*, o.filter_order, s.step, o.bits[s.step] AS bit,
                   coalesce(list_bool_or(list_transform(o.bits[1:s.step - 1], lambda b: b & c.mask <> 0)), false) AS gone
            FROM counts c, orders o, generate_series(1, 5) s(step)),
        steps AS (
            SELECT part, filter_order, step, bit,
                   coalesce(sum(n) FILTER (NOT gone AND mask & bit = 0), 0)::BIGINT AS kept,
                   coalesce(sum(n) FILTER (NOT gone AND mask & bit <> 0), 0)::BIGINT AS removed,
                   coalesce(sum(n) FILTER (gone AND mask & bit <> 0), 0)::BIGINT AS redundant,
                   coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails,
                   coalesce(sum(good) FILTER (NOT gone AND mask & bit <> 0), 0)::BIGINT AS good_lost,
                   coalesce(sum(toxic) FILTER (NOT gone AND mask & bit <> 0), 0)::BIGINT AS toxic_lost
            FROM runs GROUP BY part, filter_order, step, bit)
        SELECT part, filter_order, step::INTEGER AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
               (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM steps""",
}
