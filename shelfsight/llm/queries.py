"""One query for each operator over the driver tables, with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfsight.llm.common import documents
from shelfsight.llm.decontaminate import decontaminate
from shelfsight.llm.exact_dedup import exact_groups
from shelfsight.llm.language_id import fit, held_out, identify
from shelfsight.llm.line_dedup import line_dedup
from shelfsight.llm.merkle import manifest, verified
from shelfsight.llm.mixing import mix
from shelfsight.llm.prefix_trie import ordered_turns, prefix_trie, rebuilt
from shelfsight.llm.quality import quality_scores
from shelfsight.llm.secrets import scan_secrets
from shelfsight.llm.simhash import simhash_groups
from shelfsight.llm.substring_dedup import substring_dedup
from shelfsight.llm.token_counts import token_counts
from shelfsight.llm.warc import page_records, read_warc, write_warc
from shelfsight.staging import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def good_label() -> Column:
    """Labelled documents of good quality that are not toxic."""
    return (F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    docs = documents(spark, sf_dir).select("doc_id", "text", "source")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    digest = F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest, "contaminated")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of equal texts of every document."""
    groups = exact_groups(documents(spark, sf_dir).select("doc_id", "text"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("_digest")).alias("text_sha256"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from the documents that are not held out."""
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang").withColumn("held_out", held_out("doc_id"))
    model = fit(docs.where(~F.col("held_out")))
    return identify(docs.drop("lang"), model).select("doc_id", "held_out", "lang_pred", "score", "rejected")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without passages of twenty words that an earlier place has."""
    kept = substring_dedup(documents(spark, sf_dir).select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op6_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fingerprint of every document and the smallest id linked to it."""
    return simhash_groups(documents(spark, sf_dir).select("doc_id", "text"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The importance of every document and whether it is resampled."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_scores(docs, labels, good_label())


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that ten sources or more share."""
    kept = line_dedup(documents(spark, sf_dir).select("doc_id", "text", "source"))
    digest = F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    return kept.select("doc_id", "n_lines", "n_removed", F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("kept_chars"), digest)


def op9_token_counts(spark: SparkSession, sf_dir: str, model: str = "piece_bpe_32k.model") -> DataFrame:
    """Bytes and tokens of every document; ``model`` is a file of the public tokenizers."""
    import public_tokenizers

    counted = token_counts(documents(spark, sf_dir).select("doc_id", "text"), Path(public_tokenizers.path(model)).read_bytes())
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    found = scan_secrets(documents(spark, sf_dir).select("doc_id", "text"))
    digest = F.sha2("base_spans", 256).alias("base_sha256")
    return found.select("doc_id", "n_assign", "n_access", "n_hex", digest, "spans", "n_pair")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The proof of every document, and whether its row, altered for some, still leads to the root."""
    altered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    more = {"n_chars": F.col("n_chars").cast("decimal(20,0)") + 1}
    proofs = verified(manifest(documents(spark, sf_dir), changed=more, changed_where=altered))
    return proofs.withColumnRenamed("key", "doc_id")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations, each led by turns of one whose id 5 divides."""
    turns = ordered_turns(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    conv = F.col("conv_id")
    return prefix_trie(*rebuilt(turns, conv - conv % 5, F.crc32(conv.cast("string")) % 9, 8))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record, read back from the archives that were written."""
    path = scratch_path(spark, "warc")
    write_warc(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"), path)
    return page_records(read_warc(spark, path))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_mix_sources, op2_decontaminate, op3_exact_dedup, op4_language_id, op5_substring_dedup,
        op6_simhash_dedup, op7_quality, op8_line_dedup, op9_token_counts, op10_secret_scan, op11_merkle_manifest, op12_prefix_trie,
        op13_warc,
    )
}

SQL: dict[str, str] = {
    "op1_mix_sources": r"""
WITH RECURSIVE docs AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
        ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':7'), 1, 9))::BIGINT AS place
    FROM documents
), sources AS (
    SELECT source, sum(size)::BIGINT AS n,
        ([5, 2, 1])[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
    FROM docs GROUP BY source
), whole AS (SELECT sum(n)::BIGINT AS total, sum(w)::BIGINT AS weight FROM sources),
ranked AS (
    SELECT *, row_number() OVER (ORDER BY n::DOUBLE / w, source NULLS LAST) AS k,
        sum(3 * n) OVER o AS clamped, sum(w) OVER o AS gone
    FROM sources
    WINDOW o AS (ORDER BY n::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
    SELECT (total - coalesce(clamped, 0))::BIGINT AS words, (weight - coalesce(gone, 0))::BIGINT AS weight
    FROM ranked, whole AS t(total, weight)
    WHERE w * (total - coalesce(clamped, 0)) <= 3 * n * (weight - coalesce(gone, 0))
    ORDER BY k LIMIT 1
), targets AS (
    SELECT source, n, CASE WHEN w * words > 3 * n * weight THEN (3 * n)::DOUBLE
        ELSE (w * words)::BIGINT::DOUBLE / weight::DOUBLE END AS target
    FROM sources, level
), rest AS (
    SELECT *, CASE WHEN n > 0 THEN floor(target / n)::BIGINT ELSE 0 END AS q FROM targets
), cells AS (
    SELECT source, place, sum(size)::BIGINT AS words FROM docs GROUP BY source, place
), placed AS (
    SELECT *, coalesce(sum(words) OVER (PARTITION BY source ORDER BY place
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier FROM cells
)
SELECT d.doc_id, d.size, r.n AS source_size, r.target,
    (d.size * (r.q + CASE WHEN p.earlier + p.words / 2 <= r.target - r.q * r.n AND r.target - r.q * r.n > 0
        THEN 1 ELSE 0 END))::BIGINT AS taken
FROM docs d
JOIN rest r ON d.source IS NOT DISTINCT FROM r.source
JOIN placed p ON d.source IS NOT DISTINCT FROM p.source AND d.place = p.place
""",
    "op2_decontaminate": r"""
WITH words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), items AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), patterns AS (
    SELECT DISTINCT item_id, least(13, len(w)) AS size, array_to_string(w[s:s + least(13, len(w)) - 1], ' ') AS body
    FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS s FROM items WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT size FROM patterns),
found AS (
    SELECT doc_id, s, size, item_id FROM (
        SELECT doc_id, s, size, array_to_string(w[s:s + size - 1], ' ') AS body
        FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS s FROM words, sizes WHERE len(w) >= size)
    ) JOIN patterns USING (size, body)
), hit AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit
    FROM (SELECT doc_id, unnest(range(s, s + size)) AS place FROM found) GROUP BY doc_id
), named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM words LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
""",
    "op3_exact_dedup": r"""
WITH bare AS (
    SELECT doc_id, length(coalesce(text, '')) AS chars,
        sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256
    FROM documents
)
SELECT doc_id, first_value(doc_id) OVER o AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
    row_number() OVER o = 1 AS kept, text_sha256
FROM bare
WINDOW o AS (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id)
""",
}

SQL["op5_substring_dedup"] = r"""
WITH words AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
    SELECT doc_id, s, array_to_string(w[s:s + 19], ' ') AS body
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM words WHERE len(w) >= 20)
), ranked AS (
    SELECT doc_id, s, row_number() OVER (PARTITION BY body ORDER BY doc_id, s) > 1 AS again FROM windows
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS place FROM ranked WHERE again
), placed AS (
    SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS place FROM words
), kept AS (
    SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY place) AS text
    FROM placed ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
    sha256(coalesce(text, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""

SQL["op8_line_dedup"] = r"""
WITH lines AS (
    SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS place
    FROM documents WHERE length(text) > 0
), bare AS (SELECT *, trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body FROM lines),
gone AS (SELECT body FROM bare WHERE body <> '' GROUP BY body HAVING count(DISTINCT source) >= 10),
kept AS (
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE g.body IS NOT NULL) AS n_removed,
        coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE g.body IS NULL), '') AS text
    FROM bare LEFT JOIN gone g USING (body) GROUP BY doc_id
)
SELECT doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed,
    length(coalesce(k.text, ''))::BIGINT AS kept_chars, sha256(coalesce(k.text, '')) AS kept_sha256
FROM documents d LEFT JOIN kept k USING (doc_id)
"""

#: CRC-32 of a decimal number in DuckDB, which has no function for it. The constant is the reflected polynomial.
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split({0}::VARCHAR, ''), lambda d: ord(d)::BIGINT)),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
        lambda c, bit: xor(c >> 1, 3988292384 * (c & 1)))))"""
_LEAF = " || ".join(
    f"coalesce(octet_length(encode({c}::VARCHAR)) || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "{0}", "text")
)
SQL["op11_merkle_manifest"] = f"""
WITH RECURSIVE leaves AS (
    SELECT doc_id, lang, sha256({_LEAF.format("n_chars")}) AS leaf, CASE WHEN {_CRC.format("doc_id")} % 7 = 0
        THEN sha256({_LEAF.format("(n_chars::HUGEINT + 1)")}) ELSE sha256({_LEAF.format("n_chars")}) END AS claim,
        row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, sha256({_LEAF.format("n_chars")})) - 1 AS place
    FROM documents
), trees AS (
    SELECT lang, 0 AS level, place, leaf AS digest, count(*) OVER (PARTITION BY lang) AS n FROM leaves
    UNION ALL
    SELECT lang, level + 1, place // 2, sha256(string_agg(digest, '' ORDER BY place)), any_value((n + 1) // 2)
    FROM trees WHERE n > 1 GROUP BY lang, level, place // 2
), subroots AS (
    SELECT lang, digest AS subroot, level AS height, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS place
    FROM trees WHERE n = 1
), forest AS (
    SELECT 0 AS level, place, subroot AS digest, count(*) OVER () AS n FROM subroots
    UNION ALL
    SELECT level + 1, place // 2, sha256(string_agg(digest, '' ORDER BY place)), any_value((n + 1) // 2)
    FROM forest WHERE n > 1 GROUP BY level, place // 2
), steps AS (
    SELECT l.doc_id, l.lang, l.place, t.level AS rung, t.digest, t.place < (l.place >> t.level) AS before
    FROM leaves l JOIN trees t ON l.lang IS NOT DISTINCT FROM t.lang AND t.n > 1 AND t.place = xor(l.place >> t.level, 1)
    UNION ALL
    SELECT l.doc_id, l.lang, l.place, s.height + f.level, f.digest, f.place < (s.place >> f.level)
    FROM leaves l JOIN subroots s ON l.lang IS NOT DISTINCT FROM s.lang JOIN forest f ON f.n > 1 AND f.place = xor(s.place >> f.level, 1)
), rows AS (
    SELECT l.*, s.subroot, s.height + (SELECT max(level) FROM forest) AS rungs, (SELECT digest FROM forest WHERE n = 1) AS root
    FROM leaves l JOIN subroots s ON l.lang IS NOT DISTINCT FROM s.lang
), climbed AS (
    SELECT lang, place, 0::BIGINT AS rung, claim AS digest, rungs FROM rows
    UNION ALL
    SELECT c.lang, c.place, c.rung + 1, sha256(CASE WHEN s.digest IS NULL THEN c.digest
        WHEN s.before THEN s.digest || c.digest ELSE c.digest || s.digest END), c.rungs
    FROM climbed c LEFT JOIN steps s ON s.lang IS NOT DISTINCT FROM c.lang AND s.place = c.place AND s.rung = c.rung
    WHERE c.rung < c.rungs
), proofs AS (
    SELECT lang, place, sha256(string_agg(digest, '' ORDER BY rung)) AS proof FROM steps GROUP BY lang, place
)
SELECT r.doc_id, r.leaf, r.subroot, r.root, coalesce(p.proof, sha256('')) AS proof_sha256, c.digest AS folded_root,
    c.digest = r.root AS verified
FROM rows r JOIN climbed c ON c.lang IS NOT DISTINCT FROM r.lang AND c.place = r.place AND c.rung = r.rungs
LEFT JOIN proofs p ON p.lang IS NOT DISTINCT FROM r.lang AND p.place = r.place
"""

SQL["op12_prefix_trie"] = f"""
WITH turns AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
        coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
    SELECT conv_id, count(*) AS own, {_CRC.format("conv_id")} % 9 AS h, conv_id - conv_id % 5 AS lead_of FROM turns GROUP BY conv_id
), led AS (
    SELECT c.conv_id, c.h, least(c.h, coalesce(l.own, 0)) AS taken, c.own, c.lead_of FROM convs c LEFT JOIN convs l ON l.conv_id = c.lead_of
), built AS (
    SELECT l.conv_id, t.pos, t.role, t.text FROM led l JOIN turns t ON t.conv_id = l.lead_of AND t.pos <= l.h
    UNION ALL
    SELECT l.conv_id, t.pos - l.h + l.taken, t.role, t.text FROM led l JOIN turns t ON t.conv_id = l.conv_id AND t.pos > l.h
), paths AS (
    SELECT conv_id, pos AS depth, octet_length(encode(text)) AS bytes, string_agg(sha256(octet_length(encode(role)) || ':' || role || text), '') OVER (
        PARTITION BY conv_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS path FROM built
    UNION ALL SELECT conv_id, 0, 0, '' FROM led
), members AS (
    SELECT *, lead(path) OVER (PARTITION BY conv_id ORDER BY depth) IS NULL AS last,
        lag(path) OVER (PARTITION BY conv_id ORDER BY depth) AS parent FROM paths
), nodes AS (
    SELECT path, depth, any_value(parent) AS parent, any_value(bytes) AS bytes, min(conv_id) AS conv_id, count(*) AS n_convs,
        bool_and(last) AS childless, coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE last), '') AS ends
    FROM members GROUP BY path, depth
), sums AS (
    SELECT a.path, count(*) FILTER (WHERE d.childless) AS n_leaves, sum((d.n_convs - 1) * d.bytes)::BIGINT AS saved_tokens
    FROM nodes d JOIN members m ON m.conv_id = d.conv_id AND m.depth <= d.depth JOIN nodes a ON a.path = m.path
    GROUP BY a.path
)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs,
    (SELECT count(*) FROM nodes k WHERE k.parent = n.path) AS n_children, s.n_leaves, s.saved_tokens, sha256(n.ends) AS ends_sha256
FROM nodes n JOIN sums s ON s.path = n.path LEFT JOIN nodes p ON p.path = n.parent
"""

SQL["op13_warc"] = """
WITH sized AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest,
        coalesce(html, '') AS html
    FROM pages
), held AS (
    SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY html) END AS holder FROM sized
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN again THEN holder END AS refers_to, true AS intact
FROM (SELECT *, holder IS NOT NULL AND (page_id IS NULL OR page_id < holder) AS again FROM held)
"""


def all_queries() -> dict[str, Query]:
    return dict(QUERIES)


def all_sql() -> dict[str, str]:
    return dict(SQL)
