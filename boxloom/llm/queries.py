"""The registered queries of the training-data operators, with production parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boxloom.llm.alignment import align_tokens, count_links
from boxloom.llm.byte_bpe import encode_bytes
from boxloom.llm.chat import END, START, render_perspectives
from boxloom.llm.decontaminate import contained_items
from boxloom.llm.langid import identify_language
from boxloom.llm.line_quality import sample_labels, score_quality
from boxloom.llm.minhash import near_duplicates
from boxloom.llm.page_text import extract_main_text
from boxloom.llm.pieces import encode_pieces
from boxloom.llm.quality_rules import STOP_WORDS, apply_rules, rules_sql
from boxloom.llm.ranked_search import rank_documents
from boxloom.llm.sharding import uniform_shards
from boxloom.llm.suffix_dedup import remove_repeats

#: Words of a passage, at least.
PASSAGE = 51


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _texts(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "documents").select("doc_id", "text")


def _fold(folds: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds


def op1_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 24 shards under the law of equal row counts; whole rows are dealt."""
    body = F.coalesce("text", F.lit("")).cast("binary")
    return uniform_shards(_table(spark, folder, "documents"), 24, seed=20).select(
        "doc_id", (F.octet_length(body) + 8).cast("bigint").alias("size"), F.crc32(body).alias("text_crc32"), F.lit("rows").alias("law"),
        "shard", F.col("slot").cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return apply_rules(_texts(spark, folder)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op3_page_text(spark: SparkSession, folder: str) -> DataFrame:
    return extract_main_text(_table(spark, folder, "pages").select("page_id", "url", "html")).drop("html")


def op4_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    learn = docs.where(_fold(5) != 0).select("text", "lang")
    found = identify_language(docs.select("doc_id", "text"), learn)
    held_out = F.coalesce(_fold(5) == 0, F.lit(False)).alias("held_out")
    return found.select("doc_id", held_out, "lang_pred", "score", "rejected")


def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """One row for each document and benchmark item that it contains."""
    docs = _texts(spark, folder)
    found = contained_items(docs, _table(spark, folder, "benchmark"), percent=80)
    return found.select("doc_id", F.explode("contained").alias("x")).select(
        "doc_id", "x.*", (F.col("x.n_shared") / F.col("x.n_item")).alias("containment")
    )


def op6_chat(spark: SparkSession, folder: str) -> DataFrame:
    return render_perspectives(_table(spark, folder, "conversations"))


def op7_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return encode_pieces(_texts(spark, folder)).select("doc_id", "n_ids", "ids", "decoded_same")


def op8_line_quality(spark: SparkSession, folder: str) -> DataFrame:
    labels = sample_labels(_table(spark, folder, "labels").where(_fold(3) != 1))  # two times SAMPLE rows at most
    docs = _texts(spark, folder)
    learn = docs.join(F.broadcast(labels), "doc_id").select("text", "quality")
    held_out = F.coalesce(_fold(3) == 1, F.lit(False)).alias("held_out")
    return score_quality(docs, learn).select("doc_id", held_out, "score", "predicted")


def op9_minhash(spark: SparkSession, folder: str) -> DataFrame:
    docs = _texts(spark, folder)
    return near_duplicates(docs, percent=85).select("doc_id", "n_shingles", "component_id", "kept")


def op10_suffix_array(spark: SparkSession, folder: str) -> DataFrame:
    """The digests of what strings of 400 bytes leave, and the text without repeated passages of over 50 words either."""
    docs = _texts(spark, folder)
    return remove_repeats(docs, length=400, words=PASSAGE).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", F.col("rest").alias("text")
    )


def op11_alignment(spark: SparkSession, folder: str) -> DataFrame:
    aligned = align_tokens(_texts(spark, folder))
    digest = F.when(F.col("groups") == "", F.lit("")).otherwise(F.sha2("groups", 256)).alias("groups_sha256")
    return count_links(aligned.select("doc_id", "n_a", "n_b", "n_groups", "n_links", digest, "links"))


def op12_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return rank_documents(_texts(spark, folder), _table(spark, folder, "benchmark"), top=10)


def op13_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = _texts(spark, folder).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return encode_bytes(docs, decode=True).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_quality_rules": op2_quality_rules,
    "op3_page_text": op3_page_text,
    "op4_language": op4_language,
    "op5_decontamination": op5_decontamination,
    "op6_chat": op6_chat,
    "op7_pieces": op7_pieces,
    "op8_line_quality": op8_line_quality,
    "op9_minhash": op9_minhash,
    "op10_suffix_array": op10_suffix_array,
    "op11_alignment": op11_alignment,
    "op12_ranked_search": op12_ranked_search,
    "op13_byte_bpe": op13_byte_bpe,
}

_WORD = r"[^\x20\x09-\x0D]+"
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _joined(spans: str) -> str:
    """Spans that touch or overlap made one."""
    return f"""(SELECT doc_id, min(s) AS s, max(e) AS e FROM (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY s, e) AS g FROM (
            SELECT *, CASE WHEN s <= max(e) OVER (PARTITION BY doc_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh
            FROM {spans})) GROUP BY doc_id, g)"""


def _left(spans: str) -> str:
    """The hexadecimal bytes between spans, in order."""
    return f"""(SELECT doc_id, a, substr(h, 2 * a + 1, 2 * (z - a)) AS part FROM (
            SELECT doc_id, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s), 0) AS a, s AS z FROM {spans}
            UNION ALL SELECT doc_id, coalesce(max(e), 0), any_value(n) FROM b LEFT JOIN {spans} USING (doc_id) GROUP BY doc_id) JOIN b USING (doc_id))"""


_SPACE = r"[\x20\x09-\x0D]"
_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)

SQL: dict[str, str] = {
    "op2_quality_rules": rf"""
        WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
        w AS (
            SELECT *, list_filter(string_split_regex(text, '{_SPACE}+'), lambda x: x <> '') AS ws,
                list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM t),
        win AS (SELECT r, i, array_to_string(ws[i:i + 7], ' ') AS s FROM (
            SELECT r, ws, unnest(range(1, len(ws) - 6)) AS i FROM w)),
        twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS n FROM win) WHERE n > 1),
        cover AS (
            SELECT r, sum(least(8, d)) AS n_repeat_words FROM (
                SELECT r, coalesce(i - lag(i) OVER (PARTITION BY r ORDER BY i), 8) AS d FROM twice) GROUP BY r),
        c AS (
            SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
                CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
                CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
                CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, len(ls) AS n_lines,
                len(list_filter(ws, lambda x: lower(x) IN ({_STOP}))) AS n_stop_words,
                length(regexp_replace(text, '[^!]', '', 'g')) AS n_exclamations
            FROM w LEFT JOIN cover USING (r)),
        b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM c)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
            NOT base_failed AND {rules_sql()} AS kept FROM b""",
    "op5_decontamination": r"""
        WITH raw AS (
            SELECT 0 AS side, doc_id AS id, text FROM documents
            UNION ALL SELECT 1, item_id, text FROM benchmark),
        cut AS (
            SELECT side, id, row_number() OVER () AS row_no, list_filter(list_transform(
                string_split_regex(text, '[\x20\x09-\x0D]+'),
                lambda w: regexp_replace(lower(w), '^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$', '', 'g')),
                lambda w: w <> '') AS ws FROM raw WHERE text IS NOT NULL),
        item AS (
            SELECT id AS item_id, row_no AS item_no, least(len(ws), 5) AS width, unnest(list_distinct(list_transform(
                range(1, len(ws) - least(len(ws), 5) + 2),
                lambda i: array_to_string(ws[i:i + least(len(ws), 5) - 1], ' ')))) AS sh
            FROM cut WHERE side = 1 AND len(ws) > 0),
        widths AS (SELECT DISTINCT width FROM item),
        doc AS (
            SELECT id AS doc_id, row_no, width, unnest(list_distinct(list_transform(
                range(1, len(ws) - width + 2), lambda i: array_to_string(ws[i:i + width - 1], ' ')))) AS sh
            FROM cut, widths WHERE side = 0 AND len(ws) >= width),
        size AS (SELECT item_no, count(*) AS n_item FROM item GROUP BY item_no),
        hit AS (
            SELECT doc_id, row_no, item_id, item_no, count(*) AS n_shared
            FROM doc JOIN item USING (width, sh) GROUP BY ALL)
        SELECT doc_id, item_id, n_item, n_shared, n_shared / n_item AS containment
        FROM hit JOIN size USING (item_no) WHERE 100 * n_shared >= 80 * n_item""",
    "op6_chat": f"""
        WITH t AS (SELECT conv_id, turn, role AS speaker, coalesce(text, '') AS body, CASE WHEN conv_id IS NULL THEN {{'turn': turn, 'role': role, 'body': coalesce(text, '')}} END AS alone FROM conversations),
        p AS (SELECT DISTINCT conv_id AS c, alone AS d, speaker AS perspective FROM t WHERE speaker <> 'system'),
        b AS (
            SELECT conv_id, alone, perspective, turn, speaker, body,
                CASE WHEN speaker = 'system' THEN 'system' WHEN speaker = perspective THEN 'assistant' ELSE 'user' END AS role
            FROM t JOIN p ON conv_id IS NOT DISTINCT FROM c AND alone IS NOT DISTINCT FROM d),
        h AS (
            SELECT *, '{START}' || role || CASE WHEN role = 'user' AND speaker IS NOT NULL THEN ' name=' || speaker ELSE '' END
                || chr(10) AS head FROM b),
        s AS (SELECT *, head || body || '{END}' || chr(10) AS segment FROM h),
        o AS (
            SELECT *, CAST(coalesce(sum(length(segment)) OVER (PARTITION BY conv_id, alone, perspective
                ORDER BY turn NULLS FIRST, speaker NULLS FIRST, body ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM s)
        SELECT conv_id, perspective, turn, speaker, role, segment, start,
            CASE WHEN role = 'assistant' THEN start + length(head) END AS mask_start,
            CASE WHEN role = 'assistant' THEN start + length(segment) - 1 END AS mask_end FROM o""",
    "op9_minhash": rf"""
        WITH RECURSIVE d AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '{_WORD}') AS ws FROM documents),
        sh AS (SELECT doc_id, unnest(list_distinct(list_transform(range(1, greatest(len(ws) - 4, 1) + 1), lambda i: hash(array_to_string(ws[i:i + 4], ' '))))) AS x
            FROM d WHERE len(ws) > 0),
        size AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
        link AS (
            SELECT a, b FROM (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b USING (x) WHERE a.doc_id <> b.doc_id GROUP BY ALL)
            JOIN size p ON p.doc_id = a JOIN size q ON q.doc_id = b WHERE 100 * c >= 85 * (p.n + q.n - c)),
        reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b),
        least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
        FROM documents JOIN least USING (doc_id) LEFT JOIN size USING (doc_id)""",
    "op10_suffix_array": rf"""
        WITH b AS (SELECT doc_id, coalesce(text, '') AS t, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
        bytes AS (SELECT doc_id, i AS s, i + 400 AS e FROM (
            SELECT doc_id, i, count(*) OVER (PARTITION BY k) AS m FROM (
                SELECT doc_id, i, md5(substr(h, 2 * i + 1, 800)) AS k FROM (SELECT doc_id, h, unnest(range(n - 399)) AS i FROM b))) WHERE m > 1),
        w AS (SELECT doc_id, regexp_extract_all(t, '{_WORD}') AS ws, regexp_extract_all(t, '{_SPACE}+') AS ss, CAST(regexp_matches(t, '^{_SPACE}') AS INT) AS lead FROM b),
        one AS (SELECT doc_id, i, strlen(ws[i]) AS l, CASE WHEN i - 1 + lead > 0 THEN strlen(ss[i - 1 + lead]) ELSE 0 END AS gap
            FROM (SELECT *, unnest(range(1, len(ws) + 1)) AS i FROM w)),
        place AS (SELECT doc_id, i, e - l AS s, e FROM (SELECT *, CAST(sum(gap + l) OVER (PARTITION BY doc_id ORDER BY i) AS BIGINT) AS e FROM one)),
        passage AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY k) AS m FROM (
            SELECT doc_id, i, md5(array_to_string(ws[i:i + {PASSAGE - 1}], ' ')) AS k FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - {PASSAGE - 2})) AS i FROM w))) WHERE m > 1),
        exact AS {_joined("bytes")},
        every AS {_joined(f"(SELECT * FROM bytes UNION ALL SELECT doc_id, p.s, q.e FROM passage x JOIN place p USING (doc_id, i) JOIN place q USING (doc_id) WHERE q.i = x.i + {PASSAGE - 1})")},
        kept AS (SELECT doc_id, sha256(unhex(string_agg(part, '' ORDER BY a))) AS kept_sha256 FROM {_left("exact")} GROUP BY doc_id),
        rest AS (SELECT doc_id, string_agg(decode(unhex(regexp_replace(regexp_replace(part, '^([89AB][0-9A-F])+', ''),
            '([CD][0-9A-F]|E[0-9A-F]([89AB][0-9A-F])?|F[0-9A-F]([89AB][0-9A-F]){{0,2}})$', ''))), '' ORDER BY a) AS text FROM {_left("every")} GROUP BY doc_id)
        SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, coalesce(runs, 0) AS n_spans, kept_sha256, text
        FROM b JOIN kept USING (doc_id) JOIN rest USING (doc_id)
        LEFT JOIN (SELECT doc_id, sum(e - s) AS gone, count(*) AS runs FROM exact GROUP BY doc_id) USING (doc_id)""",
    "op12_ranked_search": rf"""
        WITH t AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '{_TERM}') AS ws FROM documents),
        d AS (SELECT r, doc_id, len(ws) AS n, ws FROM t WHERE len(ws) > 0),
        whole AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS total FROM d),
        item AS (
            SELECT row_number() OVER () AS k, item_id, regexp_extract_all(translate(text, '{_UPPER}', '{_UPPER.lower()}'), '{_TERM}') AS ws
            FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL)),
        q AS (SELECT k, item_id, term, count(*) AS times FROM (SELECT k, item_id, unnest(ws) AS term FROM item) GROUP BY ALL),
        p AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, n, unnest(ws) AS term FROM d) GROUP BY ALL),
        f AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, whole GROUP BY term, n_docs),
        scored AS (
            SELECT k, item_id, r, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * n_docs) // total)))) AS BIGINT) AS score
            FROM q JOIN p USING (term) JOIN f USING (term), whole GROUP BY ALL)
        SELECT item_id, CAST(place AS INT) AS rank, doc_id, score FROM (
            SELECT *, row_number() OVER (PARTITION BY k ORDER BY score DESC, doc_id NULLS LAST) AS place FROM scored WHERE score > 0)
        WHERE place <= 10""",
}
