"""The registered queries of the operators, next to their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from paneloom.catalog.base import query, table
from paneloom.llm.audit import audit_filters
from paneloom.llm.bpe import encode_documents
from paneloom.llm.counts import count_tokens
from paneloom.llm.infill import infill, restored
from paneloom.llm.licenses import ANCHORS, COPYRIGHT, KNOWN, SPELLINGS, scan_licenses
from paneloom.llm.lines import dedup_lines
from paneloom.llm.lm import score_documents
from paneloom.llm.postings import decontaminate
from paneloom.llm.quality import judge_quality
from paneloom.llm.ranking import rank_quality
from paneloom.llm.setsketch import near_duplicates
from paneloom.llm.sharding import shard_documents
from paneloom.llm.substrings import dedup_substrings
from paneloom.llm.tasks import crc_of_id

#: Vocabulary files; every worker has them at the same place.
BYTE_BPE, PIECE_BPE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")

LOWER_SQL = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

BID_SQL = (
    "(-ln((CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR) || ':' || s), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE))"
)

# The CRC-32 of the sixteen four-bit remainders.
CRC_SQL = (
    "[0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948,"
    " 3988292384, 4027552580, 3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108]"
)

SHARD_SQL = f"""
WITH bids AS (
  SELECT doc_id, s, {BID_SQL} AS bid FROM (SELECT doc_id FROM documents), (SELECT unnest(range(25)) AS s)
), won AS (
  SELECT doc_id, arg_min(s, bid) FILTER (WHERE s < 24)::INTEGER AS shard, arg_min(s, bid)::INTEGER AS grown_shard FROM bids GROUP BY doc_id
), bytes AS (
  SELECT doc_id, len(h) // 2 + 8 AS size, list_transform(range(1, len(h), 2),
      lambda i: (instr('0123456789ABCDEF', h[i]) * 16 + instr('0123456789ABCDEF', h[i + 1]) - 17)::BIGINT) AS b
  FROM (SELECT doc_id, regexp_extract_all(hex(encode(coalesce(text, ''))), '.') AS h FROM documents)
), crc AS (
  SELECT doc_id, size, xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda c, x:
      xor(xor(xor(c, x) >> 4, {CRC_SQL}[(xor(c, x) & 15) + 1]) >> 4,
          {CRC_SQL}[(xor(xor(c, x) >> 4, {CRC_SQL}[(xor(c, x) & 15) + 1]) & 15) + 1])), 4294967295::BIGINT) AS text_crc32
  FROM bytes
)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id, text_crc32, size) - 1 AS slot, grown_shard
FROM won JOIN crc USING (doc_id)
"""


@query("op1_rendezvous_shards", SHARD_SQL)
def op1(spark: SparkSession, sf: str) -> DataFrame:
    """All documents dealt to 24 shards of equal weight, and their shard with one more."""
    return shard_documents(table(spark, sf, "documents"), (1.0,) * 24, (1.0,))


LINES_SQL = f"""
WITH lines AS (
  SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
), keyed AS (
  SELECT *, {LOWER_SQL.format("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS k FROM lines
), repeated AS (
  SELECT k, max(doc_id) AS last FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT keyed.*, last IS NOT NULL AND last <> doc_id AS gone FROM keyed LEFT JOIN repeated USING (k)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query("op2_line_dedup", LINES_SQL)
def op2(spark: SparkSession, sf: str) -> DataFrame:
    kept = dedup_lines(table(spark, sf, "documents"), min_chars=20, min_docs=3)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query("op3_bpe_round_trip")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    coded = encode_documents(table(spark, sf, "documents"), BYTE_BPE, decode=True)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op4_token_counts")
def op4(spark: SparkSession, sf: str) -> DataFrame:
    return count_tokens(table(spark, sf, "documents"), PIECE_BPE, limit=4096)


@query("op5_quality_rules")
def op5(spark: SparkSession, sf: str) -> DataFrame:
    return judge_quality(table(spark, sf, "documents"), table(spark, sf, "labels"), threshold=0.5).drop("probability")


@query("op6_language_model")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    held_out = crc_of_id() % 7 == 2
    scored = score_documents(table(spark, sf, "documents"), ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query("op7_quality_ranking")
def op7(spark: SparkSession, sf: str) -> DataFrame:
    held_out = crc_of_id() % 5 == 0
    scored = rank_quality(table(spark, sf, "documents"), table(spark, sf, "labels"), "quality", among=~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


NEAR_SQL = f"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all({LOWER_SQL.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) < 2 THEN [w[1]] ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s
  FROM texts WHERE len(w) > 0
), shingles AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets
), links AS (
  SELECT a, b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common, any_value(x.n) AS nx, any_value(y.n) AS ny
    FROM shingles x JOIN shingles y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id AND 5 * x.n >= 4 * y.n AND 5 * y.n >= 4 * x.n
    GROUP BY x.doc_id, y.doc_id
  ) WHERE 100 * common >= 80 * (nx + ny - common)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM sets UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), named AS (
  SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT doc_id, coalesce(len(s), 0)::BIGINT AS n_shingles, coalesce(component_id, doc_id) AS component_id,
  doc_id = coalesce(component_id, doc_id) AS kept
FROM documents LEFT JOIN sets USING (doc_id) LEFT JOIN named USING (doc_id)
"""


@query("op8_near_duplicates", NEAR_SQL)
def op8(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates(table(spark, sf, "documents"), size=2, percent=80).drop("version")


TERMS_SQL = "regexp_extract_all(" + LOWER_SQL.format("coalesce(text, '')") + ", '[0-9a-z\\x{80}-\\x{10FFFF}]+')"

DECONTAMINATION_SQL = f"""
WITH items AS (
  SELECT item_id, w, least(13, len(w)) AS size FROM (SELECT item_id, {TERMS_SQL} AS w FROM benchmark) WHERE len(w) > 0
), windows AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, size, array_to_string(w[i:i + size - 1], ' ') AS phrase
  FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS i FROM items)
), docs AS (
  SELECT doc_id, {TERMS_SQL} AS w FROM documents
), places AS (
  SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS phrase
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM docs, (SELECT DISTINCT size FROM windows))
), found AS (
  SELECT doc_id, i, places.size, item FROM places JOIN windows ON places.phrase = windows.phrase AND places.size = windows.size
), hits AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM found) GROUP BY doc_id
), owners AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN owners USING (doc_id)
"""


@query("op9_decontamination", DECONTAMINATION_SQL)
def op9(spark: SparkSession, sf: str) -> DataFrame:
    found = decontaminate(table(spark, sf, "documents"), table(spark, sf, "benchmark"), window=13, share=(1, 20))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated"
    )


def canonical_sql(text: str) -> str:
    out = f"regexp_replace({LOWER_SQL.format(text)}, '{COPYRIGHT}', '', 'g')"
    out = f"' ' || regexp_replace({out}, '[^a-z0-9]+', '  ', 'g') || ' '"
    for old, new in SPELLINGS.items():
        out = f"replace({out}, ' {old.replace(' ', '  ')} ', ' {new} ')"
    return f"sha256(trim(regexp_replace({out}, ' +', ' ', 'g')))"


KNOWN_SQL = ", ".join("({}, {})".format(*(f"""'{x.replace("'", "''")}'""" for x in pair)) for pair in KNOWN.items())
ANCHOR_SQL = " OR ".join(f"contains(lower(unit), '{a}')" for a in ANCHORS)

LICENSE_SQL = f"""
WITH known AS (
  SELECT license, {canonical_sql("text")} AS digest FROM (VALUES {KNOWN_SQL}) AS t(license, text)
), units AS (
  SELECT doc_id, true AS entire, text AS unit FROM documents
  UNION ALL SELECT doc_id, false, unnest(string_split(text, chr(10))) FROM documents
  UNION ALL SELECT doc_id, false, unnest(regexp_split_to_array(text, '\\n[ \\t\\r]*\\n')) FROM documents
), found AS (
  SELECT doc_id, entire, license FROM (SELECT doc_id, entire, {canonical_sql("unit")} AS digest FROM units WHERE {ANCHOR_SQL}) JOIN known USING (digest)
), named AS (
  SELECT doc_id, min(license) FILTER (WHERE entire) AS whole, count(DISTINCT license) FILTER (WHERE NOT entire) AS n_parts,
    coalesce(string_agg(DISTINCT license, ',' ORDER BY license) FILTER (WHERE NOT entire), '') AS parts
  FROM found GROUP BY doc_id
)
SELECT doc_id, whole, coalesce(n_parts, 0)::BIGINT AS n_parts, coalesce(parts, '') AS parts, n_parts IS NOT NULL AS licensed
FROM documents LEFT JOIN named USING (doc_id)
"""


@query("op10_license_scan", LICENSE_SQL)
def op10(spark: SparkSession, sf: str) -> DataFrame:
    found = scan_licenses(table(spark, sf, "documents"))
    return found.select(
        "doc_id",
        "whole",
        F.size("parts").cast("long").alias("n_parts"),
        F.array_join("parts", ",").alias("parts"),
        (F.col("whole").isNotNull() | (F.size("parts") > 0)).alias("licensed"),
    )


WORDS_SQL = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"

SUBSTRINGS_SQL = f"""
WITH texts AS (
  SELECT doc_id, {WORDS_SQL} AS w FROM documents
), words AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM texts
), windows AS (
  SELECT doc_id, i, sha256(array_to_string(w[i:i + 34], ' ')) AS phrase FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM texts WHERE len(w) >= 35)
), repeated AS (
  SELECT doc_id, i FROM windows WHERE phrase IN (SELECT phrase FROM windows GROUP BY phrase HAVING count(*) > 1)
), marked AS (
  SELECT words.doc_id, words.i, word, max(repeated.i) OVER (PARTITION BY words.doc_id ORDER BY words.i) AS last
  FROM words LEFT JOIN repeated ON words.doc_id = repeated.doc_id AND words.i = repeated.i
), kept AS (
  SELECT doc_id, count(*) FILTER (WHERE i < last + 35) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (WHERE last IS NULL OR i >= last + 35) AS body
  FROM marked GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(body, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (doc_id)
"""


@query("op11_substring_dedup", SUBSTRINGS_SQL)
def op11(spark: SparkSession, sf: str) -> DataFrame:
    kept = dedup_substrings(table(spark, sf, "documents"), window=35)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def draw_sql(group: int) -> str:
    return f"CAST('0x' || substr(sha256('1:' || CAST(doc_id AS VARCHAR)), {8 * group + 1}, 8) AS BIGINT)"


INFILL_SQL = f"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u FROM documents
), drawn AS (
  SELECT *, len(u) AS n, least({draw_sql(0)} % (len(u) + 1), {draw_sql(1)} % (len(u) + 1)) AS a, greatest({draw_sql(0)} % (len(u) + 1), {draw_sql(1)} % (len(u) + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR {draw_sql(2)} % 100 >= 90 THEN 'plain'
      WHEN {draw_sql(3)} % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM units
), parts AS (
  SELECT doc_id, n, form, text, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:n], '') AS s FROM drawn
)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p) END::BIGINT AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END::BIGINT AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
"""


@query("op12_fill_in_middle", INFILL_SQL)
def op12(spark: SparkSession, sf: str) -> DataFrame:
    made = infill(table(spark, sf, "documents"), plain=90, spm=20)
    whole = restored(F.col("output"), F.col("form"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(whole, 256).alias("restored_sha256")
    )


AUDIT_SQL = f"""
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, {WORDS_SQL} AS w FROM documents
), firsts AS (
  SELECT text, min(doc_id) AS first FROM texts GROUP BY text
), fails AS (
  SELECT texts.doc_id, part,
    CASE WHEN len(w) < 100 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(texts.text, '[^A-Z]', '', 'g')) > 10 * length(texts.text) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(texts.text, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN texts.doc_id > first THEN 'E' ELSE '' END AS failed
  FROM texts JOIN firsts ON texts.text = firsts.text
), marks AS (
  SELECT doc_id, max((quality = 1)::INTEGER) AS good, max((toxic = 1)::INTEGER) AS toxic FROM labels GROUP BY doc_id
), cells AS (
  SELECT part, failed, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
  FROM fails LEFT JOIN marks USING (doc_id) GROUP BY part, failed
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l
), steps AS (
  SELECT o AS filter_order, step::INTEGER AS step, o[step] AS own, o[1:step - 1] AS before
  FROM (
    SELECT a.l || b.l || c.l || d.l || e.l AS o, unnest(range(1, 6)) AS step FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5
  )
), counted AS (
  SELECT part, filter_order, step, own,
    sum(CASE WHEN translate(failed, before || own, '') = failed THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN contains(failed, own) AND translate(failed, before, '') = failed THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN contains(failed, own) AND translate(failed, before, '') <> failed THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN failed = own THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN contains(failed, own) AND translate(failed, before, '') = failed THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN contains(failed, own) AND translate(failed, before, '') = failed THEN toxic ELSE 0 END) AS toxic_lost
  FROM cells, steps GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
  good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM counted
"""


@query("op13_filter_audit", AUDIT_SQL)
def op13(spark: SparkSession, sf: str) -> DataFrame:
    return audit_filters(table(spark, sf, "documents"), table(spark, sf, "labels"))
