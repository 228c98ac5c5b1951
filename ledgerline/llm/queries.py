"""The registered queries of the corpus operators, with production parameters, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import stored, table
from ledgerline.llm.line_quality import BOILERPLATE, NAVIGATION
from ledgerline.session import scratch_path

END_ID = 2
WINDOW = 4096
TOKEN_LIMIT = 2048
MIX_WEIGHTS, MIX_EPOCHS, MIX_SHARDS = [1, 2, 3], 3, 16
PROBE = "\\### Assistant: </turn> ok"


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def conversations_and_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and conversation -7 whose texts look like control strings."""
    from ledgerline.llm.chat_format import message_events

    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text")
    )
    return message_events(table(spark, sf_dir, "conversations")).unionByName(message_events(probe))


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerline.llm import chat_format as c

    chats = c.format_chats(conversations_and_probe(spark, sf_dir))
    turns = F.transform(c.read_turns(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = c.read_loss_text(F.col("formatted"), F.col("loss_spans"))
    read = chats.select("conv_id", turns.alias("turns"), loss.alias("loss"), F.length("formatted").cast("long").alias("formatted_chars"))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join("turns", ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerline.llm import source_mix as m

    sizes = m.sized(table(spark, sf_dir, "documents"))
    goals = m.targets(sizes, MIX_WEIGHTS, MIX_EPOCHS)
    return m.taken_words(sizes, goals, m.write_shards(m.mix_sources(sizes, goals, MIX_SHARDS)))


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerline.llm.near_dedup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerline.llm.line_quality import clean_lines

    return clean_lines(table(spark, sf_dir, "documents")).drop("cleaned")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerline.llm.language_id import fold
    from ledgerline.llm.toxicity import learn_toxicity, score_toxicity

    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False))
    model = learn_toxicity(docs, table(spark, sf_dir, "labels"), ~held_out)
    return score_toxicity(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op7_pivot_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerline.llm.pivot_search import search

    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerline.llm.packing import pack_documents

    pieces = pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(), END_ID, WINDOW)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerline.llm.token_files import read_token_files, write_token_files

    out = scratch_path(spark, "llm", "token_files")
    write_token_files(table(spark, sf_dir, "documents"), out, tokenizer_path(), END_ID)
    return read_token_files(spark, out, with_ids=False)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerline.llm.token_counts import count_tokens

    return count_tokens(table(spark, sf_dir, "documents"), tokenizer_path(), TOKEN_LIMIT)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerline.llm.language_id import fold, identify_languages, learn_languages

    docs = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 4) == 2
    model = learn_languages(docs, F.coalesce(~held_out, F.lit(True)))
    return identify_languages(docs, model).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score", "hit_rate"
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerline.llm.hard_negatives import mine_negatives

    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label)


def op12_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerline.llm import token_align as t

    a, b = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
    aligned = t.align_documents(table(spark, sf_dir, "documents"), a, b)
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)).alias("groups_sha256")
    kept = stored(aligned.withColumn("row_id", F.monotonically_increasing_id()).select("*", digest).drop("groups"), "aligned")
    counts = stored(t.link_counts(kept), "link_counts")
    scored = t.score_links(kept, counts, t.most_pairs(a, b))
    rows = kept.select("row_id", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256").join(scored.hint("merge"), "row_id", "left")
    number = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    return rows.select("doc_id", "n_a", "n_b", "n_groups", "n_links", number("n_best"), number("count_sum"), "groups_sha256")


def op13_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerline.llm.simhash_dedup import simhash_duplicates

    return simhash_duplicates(table(spark, sf_dir, "documents"), words=3)


QUERIES = {
    "op1_chat_format": op1_chat_format,
    "op2_source_mix": op2_source_mix,
    "op3_near_dedup": op3_near_dedup,
    "op4_quality_rules": op4_quality_rules,
    "op5_toxicity": op5_toxicity,
    "op6_packing": op6_packing,
    "op7_pivot_search": op7_pivot_search,
    "op8_token_files": op8_token_files,
    "op9_token_counts": op9_token_counts,
    "op10_language_id": op10_language_id,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_token_align": op12_token_align,
    "op13_simhash_dedup": op13_simhash_dedup,
}

#: DuckDB SQL where SQL can express the query; the others are tested against brute force in tests/llm.
ORACLE: dict[str, str] = {
    "op1_chat_format": r"""
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
            UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text)) AS turns_sha256,
               CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(23 + length(replace(replace(role, '\', '\\'), '<|', '<\|'))
                           + length(replace(replace(text, '\', '\\'), '<|', '<\|'))) AS BIGINT) AS formatted_chars
        FROM t GROUP BY conv_id
    """,
    "op2_source_mix": r"""
        WITH d AS (
            SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents
        ), s AS (
            SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                   CAST(1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS DOUBLE) AS w, 3.0::DOUBLE * sum(size) AS cap
            FROM d GROUP BY source
        ), o AS (
            SELECT *, CAST(sum(source_size) OVER () AS DOUBLE) AS total, row_number() OVER (ORDER BY cap / w, source NULLS LAST) AS k,
                   (CAST(sum(source_size) OVER () AS DOUBLE) - coalesce(sum(cap) OVER p, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER p, 0)) AS lev
            FROM s WINDOW p AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        ), g AS (
            SELECT source, source_size, CASE WHEN total > 0 THEN least(cap, w * (SELECT arg_min(lev, k) FROM o WHERE w * lev <= cap)) ELSE 0 END AS target FROM o
        ), b AS (
            SELECT d.doc_id, g.source, g.source_size, CAST(round(target) AS BIGINT) AS quota, e, b, least(512, d.size - b * 512) AS words
            FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source,
                 unnest(range(CAST(ceil(round(target) / g.source_size) AS BIGINT))) x(e), unnest(range(CAST(ceil(d.size / 512.0) AS BIGINT))) y(b)
            WHERE d.size > 0 AND round(target) > 0
        ), t AS (
            SELECT doc_id, words, quota - coalesce(sum(words) OVER (PARTITION BY source ORDER BY e, substr(md5(concat_ws('/', 'mix', e, doc_id, b)), 1, 15), doc_id, b
                                                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room
            FROM b
        ), u AS (SELECT doc_id, sum(greatest(0, least(words, room))) AS taken, count(*) FILTER (room > 0) AS blocks FROM t GROUP BY doc_id)
        SELECT d.doc_id, d.size, g.source_size, g.target, CAST(coalesce(u.taken, 0) AS BIGINT) AS taken, coalesce(u.blocks, 0) AS blocks
        FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source LEFT JOIN u ON u.doc_id = d.doc_id
    """,
    "op4_quality_rules": r"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
        l AS (SELECT r, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS w FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d)),
        m AS (
            SELECT r, line, len(w) AS n, array_to_string(w, ' ') AS x, lower(array_to_string(w, ' ')) AS low,
                   coalesce(list_sum(list_transform(w, lambda y: length(y))), 0) AS chars, len(regexp_extract_all(line, '[#*$%&|<>]')) AS symbols,
                   len(list_filter(w, lambda y: y LIKE '%!!')) AS shouts,
                   len(list_filter(w, lambda y: y IN ('|', '>', '»', '•', '·', '::', '/', '-', '–', '—'))) AS seps
            FROM l
        ), f AS (
            SELECT *, n > 0 AND (
                (n < 4 AND NOT regexp_matches(x, '[.!?…:;"''”»)\]。！？]$')) OR (n >= 3 AND 2 * shouts > n) OR 10 * symbols > chars
                OR (seps >= 2 AND 4 * seps >= n) OR (n <= 6 AND regexp_matches(low, '{NAVIGATION}')) OR (n <= 40 AND regexp_matches(low, '{BOILERPLATE}'))
            ) AS fails FROM m
        ), q AS (
            SELECT r, CAST(sum(n) AS BIGINT) AS n_words, CAST(sum(chars) AS BIGINT) AS word_chars, CAST(sum(symbols) AS BIGINT) AS n_symbols,
                   count(*) FILTER (n > 0) - count(DISTINCT line) FILTER (n > 0) AS n_dup_lines, count(*) FILTER (n > 0) AS n_lines,
                   count(*) FILTER (fails) AS n_removed_lines, CAST(coalesce(sum(n) FILTER (fails), 0) AS BIGINT) AS n_removed_words
            FROM f GROUP BY r
        ), g AS (
            SELECT r, i, w[i] || chr(1) || w[i + 1] || chr(1) || w[i + 2] AS gram
            FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM (SELECT r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d))
        ), c AS (
            SELECT r, count(DISTINCT i + k) AS n_repeat_words
            FROM (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS times FROM g), (VALUES (0), (1), (2)) v(k) WHERE times > 1 GROUP BY r
        ), z AS (
            SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, n_lines, n_removed_lines, n_removed_words
            FROM d JOIN q USING (r) LEFT JOIN c USING (r)
        )
        SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
               NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 2 * n_removed_words <= n_words AS kept
        FROM z
    """.replace("{NAVIGATION}", NAVIGATION).replace("{BOILERPLATE}", BOILERPLATE),
    "op7_pivot_search": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
        ), scored AS (
            SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
                   CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: coalesce(z[1], 0) * coalesce(z[2], 0))) AS BIGINT) AS score
            FROM v a JOIN v b ON a.vec_id <> b.vec_id
            WHERE a.vec_id % 20 = 0
        )
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
        FROM scored
        QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 20
    """,
    "op11_hard_negatives": """
        WITH v AS (
            SELECT vec_id, r.label AS label, r.q AS q FROM (
                SELECT vec_id, max(struct_pack(
                    label := CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END,
                    q := list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)))) AS r
                FROM embeddings
                WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                  AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
                GROUP BY vec_id)
        ), scored AS (
            SELECT a.vec_id AS anchor_id, b.vec_id AS vec_id, a.label = b.label AS same,
                   CAST(coalesce(list_sum(list_transform(list_zip(a.q, b.q), lambda z: coalesce(z[1], 0) * coalesce(z[2], 0))), 0) AS BIGINT) AS score
            FROM v a JOIN v b ON a.vec_id <> b.vec_id
            WHERE a.vec_id % 50 = 0
        ), p AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
        ), n AS (
            SELECT p.anchor_id, positive_id, positive_score, s.vec_id AS negative_id, s.score AS negative_score,
                   row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS k
            FROM p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
             AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
        )
        SELECT anchor_id, positive_id, CAST(k AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE k <= 3
    """,
}
