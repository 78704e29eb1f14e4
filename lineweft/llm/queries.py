"""The registered queries of the operators, over whole tables, and their SQL where there is one."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lineweft.llm import bpe, decontaminate, exact, jaccard, lattice, licences, negatives, quality, search, substrings, tokenfiles, warc, wrappers
from lineweft.llm.tables import table
from lineweft.session import cut_lineage, shared_folder


def op1_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    vocabulary = bpe.RankVocabulary(
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    )
    return bpe.token_digests(bpe.encode(table(spark, folder, "documents", "doc_id", "text"), vocabulary), vocabulary)


def op2_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact.mark_copies(table(spark, folder, "documents", "doc_id", "text"))


def op3_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_scores(
        table(spark, folder, "documents", "doc_id", "text"), table(spark, folder, "labels", "doc_id", "quality")
    )


def op4_lattice_model(spark: SparkSession, folder: str) -> DataFrame:
    return lattice.score_texts(
        table(spark, folder, "documents", "doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model")
    )


def op5_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    left = substrings.drop_repeated(table(spark, folder, "documents", "doc_id", "text"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    judged = decontaminate.contaminated_words(
        table(spark, folder, "documents", "doc_id", "text"), table(spark, folder, "benchmark")
    )
    names = F.array_join(F.sort_array(F.transform("items", lambda item: item.cast("string"))), ",")
    return judged.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(names, 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


def op7_licence_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = licences.licence_scan(table(spark, folder, "documents", "doc_id", "text"))
    return found.withColumn("licences", F.array_join("licences", ","))


def op8_token_files(spark: SparkSession, folder: str) -> DataFrame:
    files = f"{shared_folder(spark)}/lineweft-tokens-{uuid.uuid4().hex}"
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    tokenfiles.write_tokens(table(spark, folder, "documents", "doc_id", "text"), files, tokenizer, end_id=2)
    return tokenfiles.read_documents(spark, files)


def op9_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    read = wrappers.extract(pages, cut_lineage(wrappers.infer_wrappers(pages)))
    return read.select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))


def op10_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.similar_documents(table(spark, folder, "documents", "doc_id", "text"))


def op11_warc(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages", "page_id", "url", "html")
    archives = warc.write_archives(pages, f"{shared_folder(spark)}/lineweft-warc-{uuid.uuid4().hex}")
    records = warc.read_archives(archives, payloads=False)
    kind = pages.schema["page_id"].dataType
    unread = F.raise_error(F.concat(F.col("path"), F.lit(": "), F.col("error"))).cast("bigint")
    return records.select(
        warc.source_id().cast(kind).alias("page_id"),
        F.when(F.col("error").isNull(), F.col("payload_bytes")).otherwise(unread).alias("payload_bytes"),
        "payload_digest",
        "record_type",
        warc.source_id(name="x-refers-to-source-id").cast(kind).alias("refers_to"),
    )


def op12_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return search.search(
        table(spark, folder, "documents", "doc_id", "text"), table(spark, folder, "benchmark", "item_id", "text")
    )


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings", "vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("bigint") + 1) % 10)
    return negatives.mine(vectors.withColumn("label", F.coalesce(moved, F.col("label").cast("bigint"))))


QUERIES = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_lattice_model": op4_lattice_model,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_decontamination": op6_decontamination,
    "op7_licence_scan": op7_licence_scan,
    "op8_token_files": op8_token_files,
    "op9_html_extraction": op9_html_extraction,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_warc": op11_warc,
    "op12_ranked_search": op12_ranked_search,
    "op13_hard_negatives": op13_hard_negatives,
}

def _licence_sql() -> str:
    def canonical(text):
        out = f"regexp_replace(lower({text}), '{licences.COPYRIGHT_LINE}', '\\1', 'g')"
        for spelling, usual in licences.SPELLINGS:
            out = f"replace({out}, '{spelling}', '{usual}')"
        return out

    def words(text):
        return f"trim(regexp_replace({text}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"

    known = ", ".join(f"({at}, '{name}', '{text}')" for at, (name, text) in enumerate(licences.KNOWN))
    return f"""
WITH known AS (SELECT {words(canonical("t"))} AS unit, arg_min(name, no) AS licence
  FROM (VALUES {known}) AS k(no, name, t) GROUP BY 1),
prepared AS (SELECT doc_id, {canonical("coalesce(text, '')")} AS lines FROM documents),
units AS (SELECT doc_id, 0 AS place, lines AS unit FROM prepared UNION ALL
  SELECT doc_id, unnest(range(1, len(l) + 1)), unnest(l) FROM (SELECT doc_id, string_split(lines, chr(10)) AS l FROM prepared)),
hits AS (SELECT doc_id, max(licence) FILTER (place = 0) AS whole_licence, string_agg(DISTINCT licence, ',' ORDER BY licence) AS licences,
  count(DISTINCT place) FILTER (place > 0) AS n_lines
  FROM units JOIN known ON {words("units.unit")} = known.unit WHERE known.unit <> '' GROUP BY doc_id)
SELECT doc_id, whole_licence, coalesce(licences, '') AS licences, coalesce(n_lines, 0) AS n_lines
FROM prepared LEFT JOIN hits USING (doc_id)"""


_ASCII_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = rf"regexp_extract_all({_ASCII_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
_ITEM_WORDS = rf"regexp_extract_all({_ASCII_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE = {
    "op2_exact_dedup": """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
    "op5_substring_dedup": r"""
WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
starts AS (SELECT doc_id, unnest(range(1, len(w) - 18)) AS s,
  unnest([md5(array_to_string(list_slice(w, i, i + 19), ' ')) for i in range(1, len(w) - 18)]) AS k FROM docs WHERE len(w) >= 20),
ranked AS (SELECT doc_id, s, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS nth FROM starts),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS p FROM ranked WHERE nth > 1),
words AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS word FROM docs),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS text FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)""",
    "op6_decontamination": f"""
WITH docs AS (SELECT doc_id, {_ITEM_WORDS} AS w FROM documents),
items AS (SELECT item_id, {_ITEM_WORDS} AS w FROM benchmark),
sized AS (SELECT item_id, w, least(13, len(w)) AS n FROM items WHERE len(w) > 0),
cut AS (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM sized),
known AS (SELECT DISTINCT item_id, n, list_slice(w, s, s + n - 1) AS k FROM cut),
sizes AS (SELECT DISTINCT n FROM known),
places AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM docs, sizes WHERE len(w) >= n),
hits AS (SELECT doc_id, s, known.n AS n, item_id FROM places JOIN known ON places.n = known.n AND list_slice(w, s, s + places.n - 1) = k),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id),
named AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
  string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS names FROM hits GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN words USING (doc_id) LEFT JOIN named USING (doc_id)""",
    "op7_licence_scan": _licence_sql(),
    "op11_warc": """
WITH sized AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
digests AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS payload_digest FROM sized),
ranked AS (SELECT *, row_number() OVER w AS nth, first(page_id) OVER w AS first_id FROM digests
  WINDOW w AS (PARTITION BY payload_digest ORDER BY page_id DESC NULLS LAST))
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND nth > 1 THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND nth > 1 THEN first_id END AS refers_to
FROM ranked""",
    "op12_ranked_search": f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents),
sums AS (SELECT count(*) AS n_docs, sum(len(w))::BIGINT AS n_terms FROM docs WHERE len(w) > 0),
asked AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
lists AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM docs) SEMI JOIN asked USING (term) GROUP BY ALL),
weights AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM lists GROUP BY term), sums),
norms AS (SELECT r, doc_id, 10 + (90 * len(w) * n_docs) // n_terms AS m FROM docs, sums WHERE len(w) > 0),
parts AS (SELECT r, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * m)) AS part
  FROM lists JOIN norms USING (r) JOIN weights USING (term)),
scored AS (SELECT item_id, doc_id, sum(part)::BIGINT AS score FROM asked JOIN parts USING (term) GROUP BY item_id, r, doc_id),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank, doc_id, score
  FROM scored WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10""",
    "op13_hard_negatives": """
WITH rows AS (SELECT row_number() OVER () AS r, vec_id,
  CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label,
  [floor(256 * x::DOUBLE)::BIGINT for x in embedding] AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
  AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
pairs AS (SELECT a.r AS a, a.vec_id AS anchor_id, a.label AS own, c.r AS c, c.vec_id, c.label,
  coalesce(list_sum([a.v[i] * c.v[i] for i in range(1, least(len(a.v), len(c.v)) + 1)]), 0)::BIGINT AS score
  FROM rows a, rows c WHERE a.vec_id % 100 = 0),
positives AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id NULLS LAST, c) AS nth
  FROM pairs WHERE own = label AND a <> c),
negatives AS (SELECT p.anchor_id, p.a, p.c AS p, p.vec_id AS positive_id, p.score AS positive_score, n.vec_id AS negative_id,
  n.score AS negative_score, row_number() OVER (PARTITION BY p.a, p.c ORDER BY n.score DESC, n.vec_id NULLS LAST, n.c) AS rank
  FROM positives p JOIN pairs n ON p.a = n.a AND n.label <> n.own AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
  WHERE p.nth <= 5)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 10""",
}
