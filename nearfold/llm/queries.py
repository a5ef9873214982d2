"""One query for each operator over its whole table, and the SQL it is checked with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nearfold.llm.align import align, groups_digest
from nearfold.llm.ann import nearest
from nearfold.llm.bpe import bpe_decode, bpe_encode
from nearfold.llm.collocations import collocations
from nearfold.llm.common import id_crc, read_table
from nearfold.llm.decontam import leaks
from nearfold.llm.langid import fit_dictionaries, identify
from nearfold.llm.lm import score_documents
from nearfold.llm.packing import pack_documents
from nearfold.llm.pii import KINDS as PII_KINDS
from nearfold.llm.pii import pseudonymize
from nearfold.llm.secrets import PATTERNS as SECRET_PATTERNS
from nearfold.llm.secrets import scan_secrets, spans_text
from nearfold.llm.sharding import bounded_shards
from nearfold.llm.simhash import simhash_components
from nearfold.llm.warc import archive_pages, page_rows


def tokenizer(name: str) -> str:
    """Place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_compression_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = id_crc() % 4 == 2
    dictionaries = fit_dictionaries(docs.where(~held_out))
    found = identify(docs.select("doc_id", "text"), dictionaries)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "margin", "rejected")


def op2_bounded_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = bounded_shards(read_table(spark, sf_dir, "documents"))
    return placed.withColumns(
        {"law": F.lit("rows"), "grown_shard": F.lit(None).cast("int")}
    ).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "moved")


def op3_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op4_salvaged_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_rows(archive_pages(read_table(spark, sf_dir, "pages")))


def op5_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op6_variable_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents"))


def op7_simhash_ball(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = simhash_components(read_table(spark, sf_dir, "documents"))
    return grouped.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op8_owned_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(read_table(spark, sf_dir, "documents"))

    def of(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("found", lambda s: s["kind"] != "live")
    return found.select(
        "doc_id", *[of(kind).alias(f"n_{kind}") for kind in SECRET_PATTERNS],
        F.sha2(spans_text(base), 256).alias("base_sha256"), spans_text(F.col("found")).alias("spans"),
        of("live").alias("n_live"),
    )


def op9_backoff_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = id_crc() % 10 == 0
    scored = score_documents(read_table(spark, sf_dir, "documents"), ~held_out)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op10_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonymize(docs).select(
        "doc_id", "text", *[F.col(f"pii.{kind}").alias(f"n_{kind}") for kind in PII_KINDS]
    )


def op11_toivonen_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read_table(spark, sf_dir, "documents"))


def op12_hashed_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = align(
        read_table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model")
    )
    return aligned.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
        groups_digest("groups").alias("groups_sha256"),
    )


def op13_batched_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer("word_bpe_49k.json")
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = docs.select("doc_id", bpe_encode("text", path).alias("ids"))
    decoded = encoded.select("doc_id", "ids", bpe_decode("ids", path).alias("decoded"))
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_compression_language, op2_bounded_ring, op3_permutation_index, op4_salvaged_archive,
            op5_spaced_seeds, op6_variable_packing, op7_simhash_ball, op8_owned_secrets,
            op9_backoff_automaton, op10_feistel_pseudonyms, op11_toivonen_phrases,
            op12_hashed_alignment, op13_batched_bpe,
        )
    }


ARCHIVE_SQL = """WITH sized AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes,
         sha1(coalesce(html, '')) AS payload_digest FROM pages),
grouped AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS largest FROM sized)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> largest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> largest THEN largest END AS refers_to
FROM grouped"""


def secrets_sql() -> str:
    """The same spans from positions in the lists of matches and of the text between them."""
    matched = " UNION ALL ".join(
        f"""SELECT r, source, '{kind}' AS kind, {rank} AS rank, {least} AS least,
  regexp_extract_all(t, $p${pattern}$p$, 0) AS ms, regexp_extract_all(t, $p${pattern}$p$, {group}) AS vs,
  string_split_regex(t, $p${pattern}$p$) AS ps FROM texts WHERE regexp_matches(t, $p${pattern}$p$)"""
        for rank, (kind, (pattern, group, least)) in enumerate(SECRET_PATTERNS.items())
    )
    return f"""WITH texts AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, source FROM documents),
matched AS ({matched}),
places AS (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM matched),
spans AS MATERIALIZED (
  SELECT r, source, kind, rank, vs[i] AS v,
         (list_sum(list_transform(ps[1:i], lambda x: length(x)))
          + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0))::BIGINT AS s,
         length(ms[i]) AS n
  FROM places WHERE length(vs[i]) >= least),
owners AS (SELECT v, count(DISTINCT coalesce(source, chr(0))) AS owners FROM spans GROUP BY v),
live AS (
  SELECT DISTINCT r, 'live' AS kind, 3 AS rank, s + n - length(v) AS s, s + n AS e
  FROM spans JOIN owners USING (v)
  WHERE owners <= 2 AND len(list_distinct(string_split(v, ''))) >= 6),
found AS (SELECT r, kind, rank, s, s + n AS e FROM spans UNION ALL SELECT * FROM live),
listed AS (
  SELECT r, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex, count(*) FILTER (kind = 'live') AS n_live,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) FILTER (kind <> 'live') AS base,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) AS spans
  FROM found GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
       coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live
FROM texts LEFT JOIN listed USING (r)"""

PHRASES_SQL = r"""WITH pieces AS (
  SELECT row_number() OVER () AS p, lang, w FROM (
    SELECT coalesce(lang, 'und') AS lang, list_filter(
      string_split_regex(unnest(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')), '[\x20\x09]+'), lambda x: x <> '') AS w
    FROM documents) WHERE len(w) > 0),
grams AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM pieces, range(1, 6) s(k) WHERE len(w) >= k)),
freq AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang),
cand AS MATERIALIZED (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM freq WHERE k > 1),
inside AS (
  SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT lang, a, w, m, unnest(range(1, k - m + 2)) AS i FROM cand, range(2, 5) s(m) WHERE m < k)
  GROUP BY ALL),
kept AS (
  SELECT cand.* FROM cand LEFT JOIN inside USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 100 * a),
cuts AS (SELECT *, unnest(range(1, k)) AS c FROM kept),
scored AS (
  SELECT cuts.lang, cuts.phrase, a, x.f AS l, y.f AS r, n, c,
         ((1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts JOIN total USING (lang)
  JOIN freq x ON x.lang = cuts.lang AND x.phrase = array_to_string(cuts.w[1:c], ' ')
  JOIN freq y ON y.lang = cuts.lang AND y.phrase = array_to_string(cuts.w[c + 1:cuts.k], ' ')),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000"""


def oracle_sql() -> dict[str, str]:
    return {
        "op4_salvaged_archive": ARCHIVE_SQL, "op8_owned_secrets": secrets_sql(),
        "op11_toivonen_phrases": PHRASES_SQL,
    }
