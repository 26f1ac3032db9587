"""The operators as registered queries, and SQL for those that SQL can express.

Each query applies its operator, with production parameters, to the whole of its table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.llm.common import held_out, table
from podium.llm.decontaminate import contaminated
from podium.llm.exact_dedup import exact_duplicates
from podium.llm.html_extract import extract_pages
from podium.llm.langid import identify_languages
from podium.llm.lattice_lm import score_texts
from podium.llm.lexical_search import search
from podium.llm.packing import packed
from podium.llm.pii import KINDS, TERM, digest, private_spans
from podium.llm.prefix_trie import prefix_trie
from podium.llm.quality import score_quality
from podium.llm.simhash import near_duplicates
from podium.llm.substring_dedup import without_repeats
from podium.llm.warc import archived


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), size=4, threshold=4)
    printed = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select("doc_id", printed.alias("fingerprint"), "component_id")


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = held_out("doc_id", 7, 2)
    found = score_texts(table(spark, sf_dir, "documents"), learn_from=~held, group="lang")
    return found.select(
        "doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify_languages(docs, learn_from=~held_out("doc_id", 4, 2))
    return found.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "lang_pred", "score")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = without_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"), keep="largest")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    found = score_quality(docs, labels, learn_from=~held_out("doc_id", 3, 1))
    return found.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "score", "predicted")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = private_spans(table(spark, sf_dir, "documents"))
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = (
        (F.size("spans") - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS)
    )
    base = digest(F.col("spans"), KINDS)
    return found.select(
        "doc_id",
        *counts,
        F.sha2(base.cast("binary"), 256).alias("base_sha256"),
        digest(F.col("spans"), (*KINDS, TERM)).alias("spans"),
    )


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived(table(spark, sf_dir, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_extraction": op1_html_extraction,
    "op2_simhash": op2_simhash,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_language_id": op4_language_id,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_packing": op6_packing,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_quality": op8_quality,
    "op9_pii": op9_pii,
    "op10_decontamination": op10_decontamination,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_lexical_search": op12_lexical_search,
    "op13_warc": op13_warc,
}

# Words and five-word shingles as the decontamination operator makes them.
_WORDS = (
    "string_split(trim(regexp_replace(lower(coalesce(text, '')), '[^\\p{L}\\p{M}\\p{N}]+', ' ', 'g')), ' ')"
)
_SHINGLES = (
    "unnest(list_transform(range(len(words) - 4), lambda i: array_to_string(words[i + 1:i + 5], ' ')))"
)

SQL = {
    "op5_substring_dedup": r"""
        WITH texts AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
            FROM documents
        ), windows AS (
            SELECT doc_id, unnest(range(len(words) - 19)) AS pos,
                   unnest(list_transform(range(len(words) - 19),
                                         lambda i: array_to_string(words[i + 1:i + 20], ' '))) AS key
            FROM texts WHERE len(words) >= 20
        ), repeated AS (
            SELECT doc_id, pos FROM windows
            QUALIFY row_number() OVER (PARTITION BY key ORDER BY doc_id, pos) > 1
        ), gone AS (
            SELECT DISTINCT doc_id, unnest(range(pos, pos + 20)) AS place FROM repeated
        ), placed AS (
            SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS place FROM texts
        ), kept AS (
            SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS kept, count(*) AS n
            FROM placed ANTI JOIN gone USING (doc_id, place)
            GROUP BY doc_id
        )
        SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed,
               sha256(coalesce(kept, '')) AS kept_sha256
        FROM texts LEFT JOIN kept USING (doc_id)
    """,
    "op7_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER same AS keep_id,
               count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op10_decontamination": f"""
        WITH item_words AS (SELECT item_id AS id, {_WORDS} AS words FROM benchmark),
        doc_words AS (SELECT doc_id AS id, {_WORDS} AS words FROM documents),
        items AS (SELECT id AS item_id, {_SHINGLES} AS shingle FROM item_words WHERE len(words) >= 5),
        sizes AS (SELECT item_id, count(*) AS n FROM items GROUP BY item_id),
        wanted AS (SELECT item_id, n, shingle, count(*) AS times
                   FROM items JOIN sizes USING (item_id) GROUP BY ALL),
        docs AS (SELECT id AS doc_id, {_SHINGLES} AS shingle, unnest(range(len(words) - 4)) AS place
                 FROM doc_words WHERE len(words) >= 5),
        starts AS (SELECT DISTINCT doc_id, place, item_id, n FROM docs JOIN wanted USING (shingle)),
        counted AS (
            SELECT s.doc_id, s.item_id, s.place, s.n, d.shingle, count(*) AS times
            FROM starts s JOIN docs d
              ON d.doc_id = s.doc_id AND d.place BETWEEN s.place AND s.place + s.n - 1
            GROUP BY ALL
        ), compared AS (
            SELECT c.doc_id, c.item_id, c.place, c.n, sum(c.times) AS size,
                   coalesce(sum(least(c.times, w.times)), 0) AS shared
            FROM counted c LEFT JOIN wanted w ON w.item_id = c.item_id AND w.shingle = c.shingle
            GROUP BY ALL
        ), short AS (
            SELECT DISTINCT id AS item_id, len(words) AS k, array_to_string(words, ' ') AS whole
            FROM item_words WHERE len(words) < 5 AND words[1] <> ''
        ), grams AS (
            SELECT id AS doc_id, k, unnest(range(len(words) - k + 1)) AS place,
                   unnest(list_transform(range(len(words) - k + 1),
                                         lambda i: array_to_string(words[i + 1:i + k], ' '))) AS whole
            FROM doc_words, (SELECT DISTINCT k FROM short) WHERE len(words) >= k
        ), found AS (
            SELECT doc_id, item_id, shared / (size + n - shared) AS similarity, place AS first_word,
                   CAST(size + 4 AS BIGINT) AS n_words
            FROM compared WHERE shared / (size + n - shared) >= 0.8
            UNION ALL
            SELECT doc_id, item_id, 1.0, place, k FROM short JOIN grams USING (k, whole)
        )
        SELECT * FROM found WHERE doc_id IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, first_word) = 1
    """,
    "op11_prefix_trie": r"""
        WITH turns AS (
            SELECT conv_id AS c, turn, md5(concat(strlen(r), ':', r, t)) AS digest,
                   len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS words
            FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations)
            WHERE conv_id IS NOT NULL
        ), numbered AS (
            SELECT c, digest, words, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, digest) - 1 AS pos FROM turns
        ), convs AS (
            -- crc32 of the decimal id, a byte and a bit at a time.
            SELECT DISTINCT c, c - c % 20 AS first, xor(4294967295, list_reduce(
                list_prepend(4294967295, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT))),
                lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]),
                                         lambda x, y: xor(x >> 1, 3988292384 * (x & 1))))) % 4 AS h
            FROM turns
        ), parts AS (
            SELECT v.c, 0 AS part, pos, digest, words FROM convs v JOIN numbered n ON n.c = v.first AND pos < h
            UNION ALL
            SELECT v.c, 1 AS part, pos, digest, words FROM convs v JOIN numbered n ON n.c = v.c AND pos >= h
        ), rebuilt AS (
            SELECT c, row_number() OVER so_far AS d, md5(string_agg(digest, '') OVER so_far) AS prefix, words
            FROM parts WINDOW so_far AS (PARTITION BY c ORDER BY part, pos ROWS UNBOUNDED PRECEDING)
            UNION ALL
            SELECT c, 0, '', 0 FROM convs
        ), sizes AS (SELECT c, max(d) AS size FROM rebuilt GROUP BY c),
        nodes AS (
            SELECT d, prefix, min(c) AS rep, count(*) AS n_convs, any_value(words) AS words,
                   sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE d = size), '')) AS ends_sha256
            FROM rebuilt JOIN sizes USING (c) GROUP BY d, prefix
        ), passed AS (SELECT c, d, rep FROM rebuilt JOIN nodes USING (d, prefix)),
        parents AS (
            SELECT nodes.rep, nodes.d, passed.rep AS up FROM nodes LEFT JOIN passed ON passed.c = nodes.rep AND passed.d = nodes.d - 1
        ), children AS (SELECT up AS rep, d - 1 AS d, count(*) AS n FROM parents WHERE up IS NOT NULL GROUP BY ALL),
        valued AS (
            SELECT rep, d, n_convs, coalesce(n, 0) AS n_children, (n_convs - 1) * words AS saved, ends_sha256
            FROM nodes LEFT JOIN children USING (rep, d)
        ), totals AS (
            SELECT p.rep, p.d, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
            FROM valued v JOIN passed p ON p.c = v.rep AND p.d <= v.d GROUP BY ALL
        )
        SELECT rep AS conv_id, d AS depth, up AS parent_conv_id, n_convs, n_children, n_leaves,
               CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256
        FROM valued JOIN totals USING (rep, d) JOIN parents USING (rep, d)
    """,
    "op12_lexical_search": r"""
        WITH doc_terms AS (
            SELECT row_number() OVER () AS doc, doc_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM documents
        ), item_terms AS (
            SELECT item, item_id, term, count(*) AS times
            FROM (SELECT row_number() OVER () AS item, item_id, unnest(regexp_extract_all(
                      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
                  FROM (SELECT DISTINCT item_id, text FROM benchmark))
            GROUP BY ALL
        ), sizes AS (SELECT doc, count(*) AS n FROM doc_terms GROUP BY doc),
        total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes),
        counted AS (
            SELECT doc, doc_id, term, count(*) AS tf
            FROM doc_terms WHERE term IN (SELECT term FROM item_terms) GROUP BY ALL
        ), weights AS (
            SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM counted, total GROUP BY term, docs
        ), scored AS (
            SELECT item, item_id, doc_id, doc, CAST(sum(
                times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms)))) AS BIGINT) AS score
            FROM item_terms JOIN counted USING (term) JOIN weights USING (term) JOIN sizes USING (doc), total
            WHERE doc_id IS NOT NULL
            GROUP BY ALL
        )
        SELECT item_id, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
               doc_id, score
        FROM scored WHERE score > 0
        QUALIFY row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) <= 20
    """,
    "op13_warc": """
        WITH payloads AS (
            SELECT page_id, url, encode(coalesce(html, '')) AS payload FROM pages
        ), firsts AS (
            SELECT *, CASE WHEN octet_length(payload) >= 100 THEN min(page_id) OVER (PARTITION BY payload) END AS first
            FROM payloads
        )
        SELECT page_id, url, CAST(octet_length(payload) AS BIGINT) AS payload_bytes, sha256(payload) AS payload_digest,
               CASE WHEN page_id IS DISTINCT FROM first AND first IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
        FROM firsts
    """,
}
