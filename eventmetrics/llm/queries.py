"""Each operator applied to its whole table, by the query's name, and SQL with the same result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from eventmetrics.llm.decontamination import contamination
from eventmetrics.llm.exact_dedup import duplicate_groups
from eventmetrics.llm.language_id import language_id
from eventmetrics.llm.licenses import (
    LICENCE_FILE,
    MIN_SIMILARITY,
    NOTICE,
    PARAGRAPH,
    PROPRIETARY,
    TEMPLATES,
    TOKEN,
    scan_licenses,
)
from eventmetrics.llm.line_dedup import line_dedup
from eventmetrics.llm.merkle import audit
from eventmetrics.llm.mixing import mixture
from eventmetrics.llm.near_dedup import near_duplicates
from eventmetrics.llm.packing import pack
from eventmetrics.llm.quality import quality
from eventmetrics.llm.resampling import resample
from eventmetrics.llm.sharding import shard_documents
from eventmetrics.llm.toxicity import toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup(docs)


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(_table(spark, sf_dir, "documents"))


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_groups(_table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(_table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_table(spark, sf_dir, "documents"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of the documents, taken as files: a repository for each source, a directory for each
    thousand ids, and a short text with a notice as a directory's licence file."""
    short_notice = F.col("text").rlike(NOTICE) & (F.length("text") <= 500)
    name = F.concat(F.when(short_notice, "LICENSE-").otherwise("text-"), F.col("doc_id").cast("string"))
    directory = F.floor(F.col("doc_id") / 1000).cast("string")
    files = _table(spark, sf_dir, "documents").select(
        "doc_id", F.concat_ws("/", "source", directory, name).alias("path"), "text")
    return scan_licenses(files).drop("text")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words that the mixture takes of each document."""
    return mixture(_table(spark, sf_dir, "documents"), columns=["doc_id"]).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(_table(spark, sf_dir, "documents"))


QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op1_line_dedup": op1_line_dedup,
    "op2_sharding": op2_sharding,
    "op3_minhash_near_dedup": op3_minhash_near_dedup,
    "op4_toxicity": op4_toxicity,
    "op5_decontamination": op5_decontamination,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_language_id": op7_language_id,
    "op8_packing": op8_packing,
    "op9_license_scan": op9_license_scan,
    "op10_quality": op10_quality,
    "op11_mixing": op11_mixing,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_merkle_manifest": op13_merkle_manifest,
}


def _license_sql() -> str:
    """The same as `scan_licenses` on the files of `op9_license_scan`."""
    templates = ", ".join(
        f"({i}, '{name}', '{text.replace(chr(39), chr(39) * 2)}')" for i, (name, text) in enumerate(TEMPLATES))
    tokens = f"regexp_extract_all(lower(notice), '{TOKEN}')"
    directory = "regexp_extract(path, '^(.*)/[^/]*$', 1)"
    return f"""WITH file AS (
  SELECT doc_id, text, source || '/' || CAST(doc_id // 1000 AS VARCHAR) || '/' ||
         CASE WHEN regexp_matches(text, '{NOTICE}') AND length(text) <= 500
              THEN 'LICENSE-' ELSE 'text-' END || CAST(doc_id AS VARCHAR) AS path
  FROM documents),
notice_part AS (
  SELECT doc_id, path, text, list_filter(string_split(text, chr(10)),
         lambda l: regexp_matches(l, '{NOTICE}')) AS lines,
         list_filter(string_split_regex(text, '{PARAGRAPH}'), lambda l: regexp_matches(l, '{NOTICE}')) AS parts
  FROM file),
notice AS (
  SELECT DISTINCT doc_id, path, notice FROM (
    SELECT doc_id, path, unnest(lines) AS notice FROM notice_part
    UNION ALL SELECT doc_id, path, unnest(parts) FROM notice_part
    UNION ALL SELECT doc_id, path, array_to_string(parts, chr(10) || chr(10)) FROM notice_part
    WHERE regexp_matches(text, '{NOTICE}')
    UNION ALL SELECT doc_id, path, text FROM notice_part
    WHERE regexp_matches(path, '{LICENCE_FILE}') AND text IS NOT NULL)),
template(template, license, notice) AS (VALUES {templates}),
distinct_notice AS (SELECT DISTINCT notice FROM notice),
token AS (SELECT notice, token, count(*) AS tf FROM (
  SELECT notice, unnest({tokens}) AS token FROM distinct_notice) GROUP BY ALL),
template_token AS (SELECT template, token, count(*) AS tf FROM (
  SELECT template, unnest({tokens}) AS token FROM template) GROUP BY ALL),
texts AS (SELECT (SELECT count(*) FROM distinct_notice) + {len(TEMPLATES)} AS n),
idf AS (SELECT token, ln((1.0 + (SELECT n FROM texts)) / (1 + count(*))) + 1 AS idf FROM (
  SELECT token FROM token UNION ALL SELECT token FROM template_token) GROUP BY token),
weight AS (SELECT notice, token, tf * idf AS w FROM token JOIN idf USING (token)),
template_weight AS (SELECT template, token, tf * idf AS w FROM template_token JOIN idf USING (token)),
norm AS (SELECT notice, sqrt(sum(w * w)) AS norm FROM weight GROUP BY notice),
template_norm AS (SELECT template, sqrt(sum(w * w)) AS template_norm FROM template_weight GROUP BY template),
scored AS (
  SELECT d.notice, t.license, round(d.dot / n.norm / m.template_norm, 6) AS similarity
  FROM (SELECT a.notice, b.template, sum(a.w * b.w) AS dot
        FROM weight a JOIN template_weight b USING (token) GROUP BY ALL) d
  JOIN norm n USING (notice) JOIN template_norm m USING (template) JOIN template t USING (template)),
matched AS (
  SELECT notice, struct_pack(claim := s.license = '{PROPRIETARY}', low := s.low, license := s.license) AS best
  FROM (SELECT notice, min(struct_pack(low := -similarity, license := license)) AS s FROM scored
        GROUP BY notice HAVING max(similarity) >= {MIN_SIMILARITY})),
own AS (
  SELECT doc_id, path, min(m.best) AS best FROM notice JOIN matched m USING (notice) GROUP BY ALL),
directory AS (SELECT {directory} AS above, min(best) AS best FROM own
              WHERE regexp_matches(path, '{LICENCE_FILE}') GROUP BY 1),
place AS (SELECT DISTINCT {directory} AS place FROM file),
chain AS (
  SELECT DISTINCT place, array_to_string(string_split(place, '/')[1:k], '/') AS above
  FROM (SELECT place, unnest(range(0, len(string_split(place, '/')) + 1)) AS k FROM place)),
inherited AS (
  SELECT place, arg_max(above, length(above)) AS above, arg_max(best, length(above)) AS best
  FROM chain JOIN directory USING (above) GROUP BY place)
SELECT f.doc_id, f.path, coalesce(o.best.license, i.best.license) AS license,
       CASE WHEN o.best IS NOT NULL THEN 'own' WHEN i.best IS NOT NULL THEN 'inherited'
            ELSE 'none' END AS license_basis,
       -coalesce(o.best.low, i.best.low) AS license_similarity,
       CASE WHEN o.best IS NOT NULL THEN f.path ELSE i.above END AS license_source
FROM file f LEFT JOIN own o USING (doc_id)
LEFT JOIN inherited i ON {directory.replace('path', 'f.path')} = i.place"""


# The checksum, byte by byte; DuckDB has none of its own.
_CRC_TABLE = """crc_table AS (
  SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda c, i:
         CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n)) AS crcs)"""


def _crc32_sql(text: str) -> str:
    """Unsigned crc32 of a text that is not empty, beside the one row of `crc_table`."""
    code = f"CAST('0x' || substr(hex(encode({text})), 2 * i + 1, 2) AS BIGINT)"
    return f"""xor(4294967295, list_reduce(
         list_transform(range(octet_length(encode({text}))), lambda i: {code}),
         lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1]), CAST(4294967295 AS BIGINT)))"""


_MIXING_SQL = r"""WITH document AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
  FROM documents),
weighed AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, 3 * source_size AS cap,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM document GROUP BY source),
-- The level at which the rest is shared, if the sources before are full.
levels AS (
  SELECT *, row_number() OVER fullest AS turn,
         CAST((SELECT sum(source_size) FROM weighed) - coalesce(sum(cap) OVER before, 0) AS DOUBLE) /
         CAST((SELECT sum(weight) FROM weighed) - coalesce(sum(weight) OVER before, 0) AS DOUBLE) AS level
  FROM weighed
  WINDOW fullest AS (ORDER BY cap / weight, source NULLS LAST),
         before AS (ORDER BY cap / weight, source NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT arg_min(level, turn) AS level FROM levels WHERE weight * level <= cap),
target AS (
  SELECT source, source_size, CASE WHEN weight * level > cap THEN CAST(cap AS DOUBLE)
                                   ELSE weight * level END AS target,
         CAST('0x' || substr(md5(coalesce('source:' || source, 'none')), 1, 8) AS BIGINT)
           / CAST(4294967296 AS DOUBLE) AS start
  FROM (SELECT w.*, l.level FROM weighed w CROSS JOIN level l)),
placed AS (
  SELECT doc_id, size, source_size, target, start,
         CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
         row_number() OVER (PARTITION BY d.source ORDER BY size DESC, doc_id NULLS FIRST) - 1 AS place
  FROM document d JOIN target t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST((floor(rate) + floor((place + 1) * (rate - floor(rate)) + start)
             - floor(place * (rate - floor(rate)) + start)) * size AS BIGINT) AS taken
FROM placed"""

_RESAMPLING_SQL = rf"""WITH {_CRC_TABLE},
document AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents),
target AS (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
  FROM benchmark),
feature AS (SELECT doc_id, unnest(words) AS word FROM document),
counted AS (
  SELECT word, sum(s) AS s, sum(t) AS t
  FROM (SELECT word, 1 AS s, 0 AS t FROM feature UNION ALL SELECT word, 0, 1 FROM target)
  GROUP BY word),
hashed AS (SELECT word, s, t, {_crc32_sql("word")} % 10000 AS bucket FROM counted CROSS JOIN crc_table),
bucket AS (SELECT bucket, CAST(sum(s) AS DOUBLE) AS s, CAST(sum(t) AS DOUBLE) AS t FROM hashed GROUP BY bucket),
total AS (SELECT sum(s) AS big_s, sum(t) AS big_t FROM bucket),
gain AS (
  SELECT word, CAST(floor(1000 * ln((b.t + 1) * (big_s + 10000) / ((b.s + 1) * (big_t + 10000)))) AS BIGINT) AS gain
  FROM hashed JOIN bucket b USING (bucket) CROSS JOIN total),
gained AS (SELECT doc_id, sum(gain) AS gain FROM feature JOIN gain USING (word) GROUP BY doc_id),
weighed AS (
  SELECT d.doc_id, len(words) AS n_features,
         CASE WHEN len(words) = 0 THEN 0
              ELSE CAST(floor(CAST(g.gain AS DOUBLE) / len(words)) AS BIGINT) END AS weight
  FROM document d LEFT JOIN gained g USING (doc_id)),
scored AS (
  SELECT *, weight + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT)
         + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM weighed),
eligible AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n
  FROM scored WHERE n_features >= 20)
SELECT s.doc_id, n_features, weight, score, CASE WHEN place <= n * 10 // 100 THEN place END AS rank
FROM scored s LEFT JOIN eligible e USING (doc_id)"""


def _merkle_sql() -> str:
    """Trees by recursion over levels; a leaf's path as one text for each level, folded in order."""
    def leaf(count: str) -> str:
        values = ("doc_id", "source", "lang", count, "text")
        return "sha256(" + " || ".join(
            f"coalesce(octet_length(encode(CAST({v} AS VARCHAR))) || ':' || CAST({v} AS VARCHAR), '-')"
            for v in values) + ")"

    def tree(name: str, start: str) -> str:
        return f"""{name}(tree, level, place, digest, n) AS (
  {start}
  UNION ALL
  SELECT tree, level + 1, place // 2, sha256(string_agg(digest, '' ORDER BY place)), (any_value(n) + 1) // 2
  FROM {name} WHERE n > 1 GROUP BY tree, level, place // 2)"""

    return f"""WITH RECURSIVE {_CRC_TABLE},
leaf AS (
  SELECT doc_id, lang, {leaf("n_chars")} AS leaf,
         CASE WHEN {_crc32_sql("CAST(doc_id AS VARCHAR)")} % 7 = 0 THEN {leaf("(n_chars + 1)")}
              ELSE {leaf("n_chars")} END AS candidate
  FROM documents CROSS JOIN crc_table),
placed AS (
  SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
         count(*) OVER (PARTITION BY lang) AS n
  FROM leaf),
{tree("node", "SELECT tree, 0, place, leaf, n FROM placed")},
subroot AS (SELECT tree, digest AS subroot FROM node WHERE n = 1),
{tree("top", "SELECT 0, 0, tree, subroot, (SELECT count(*) FROM subroot) FROM subroot")},
step AS (
  SELECT p.doc_id, 0 AS part, o.level, o.place, s.place AS beside, s.digest
  FROM placed p JOIN node o ON o.tree = p.tree AND o.n > 1 AND o.place = p.place >> o.level
  LEFT JOIN node s ON s.tree = o.tree AND s.level = o.level AND s.place = xor(o.place, 1)
  UNION ALL
  SELECT p.doc_id, 1, o.level, o.place, s.place, s.digest
  FROM placed p JOIN top o ON o.n > 1 AND o.place = p.tree >> o.level
  LEFT JOIN top s ON s.level = o.level AND s.place = xor(o.place, 1)),
path AS (
  SELECT doc_id, string_agg(digest, '' ORDER BY part, level) AS beside,
         list(CASE WHEN digest IS NULL THEN 'A' WHEN beside < place THEN 'L' || digest
              ELSE 'R' || digest END ORDER BY part, level) AS steps
  FROM step GROUP BY doc_id)
SELECT p.doc_id, leaf, subroot, t.digest AS root, sha256(coalesce(beside, '')) AS proof_sha256,
       list_reduce(coalesce(steps, []), lambda d, s: CASE s[1] WHEN 'A' THEN sha256(d)
                   WHEN 'L' THEN sha256(s[2:] || d) ELSE sha256(d || s[2:]) END, candidate) AS folded_root,
       folded_root = root AS verified
FROM placed p JOIN subroot USING (tree) JOIN top t ON t.n = 1 LEFT JOIN path USING (doc_id)"""


ORACLE_SQL = {
    "op1_line_dedup": r"""WITH texts AS (SELECT DISTINCT text FROM documents WHERE text IS NOT NULL),
split AS (SELECT text, string_split(text, chr(10)) AS lines FROM texts),
content AS (SELECT text, unnest(lines) AS content, unnest(range(1, len(lines) + 1)) AS place FROM split),
raw AS (
  SELECT text, place, string_split(trim(regexp_replace(content, '[\x20\x09\x0B-\x0D]+', ' ', 'g')), ' ') AS raw
  FROM content),
token AS (
  SELECT text, place, CASE WHEN len(list_filter(raw, lambda t: NOT regexp_matches(t, '[0-9]'))) = 0 THEN raw
         ELSE list_transform(raw, lambda t: CASE WHEN regexp_matches(t, '[0-9]') THEN '<*>' ELSE t END)
         END AS tokens FROM raw),
line AS (SELECT text, place, tokens, len(tokens) AS n, tokens[1:3] AS lead FROM token WHERE tokens[1] <> ''),
leaf AS (SELECT n, lead FROM line GROUP BY n, lead HAVING count(DISTINCT text) >= 3),
occurrence AS (SELECT DISTINCT text, tokens, n, lead FROM line SEMI JOIN leaf USING (n, lead)),
distinct_line AS (SELECT tokens, n, lead, count(*) AS texts FROM occurrence GROUP BY ALL),
placed AS (
  SELECT tokens, n, lead, texts, unnest(tokens) AS token, unnest(range(1, n + 1)) AS pos FROM distinct_line),
constant AS (
  SELECT n, lead, pos, token, TRUE AS constant FROM placed WHERE token <> '<*>'
  GROUP BY ALL HAVING sum(texts) >= 3),
template AS (
  SELECT tokens, n, lead,
         list(struct_pack(pos := pos, token := token) ORDER BY pos) FILTER (constant OR token = '<*>') AS parts
  FROM placed LEFT JOIN constant USING (n, lead, pos, token) GROUP BY tokens, n, lead
  HAVING count(constant) > 0 AND count(constant) >= count(*) FILTER (token <> '<*>') * 0.6),
recurring AS (
  SELECT n, lead, parts FROM occurrence JOIN template USING (tokens, n, lead)
  GROUP BY n, lead, parts HAVING count(DISTINCT text) >= 3),
dropped AS (SELECT DISTINCT tokens FROM template JOIN recurring USING (n, lead, parts)),
kept AS (
  SELECT c.text, list(c.content ORDER BY c.place) FILTER (d.tokens IS NULL) AS lines,
         count(*) AS n_lines, count(d.tokens) AS n_dropped
  FROM content c JOIN token t USING (text, place) LEFT JOIN dropped d ON t.tokens = d.tokens
  GROUP BY c.text)
SELECT doc_id, CASE WHEN k.text IS NULL THEN NULL ELSE coalesce(array_to_string(k.lines, chr(10)), '') END AS text,
       coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped
FROM documents LEFT JOIN kept k USING (text)""",
    "op6_exact_dedup": r"""WITH keys AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY text_sha256) AS kept, text_sha256
FROM keys""",
    "op9_license_scan": _license_sql(),
    "op11_mixing": _MIXING_SQL,
    "op12_importance_resampling": _RESAMPLING_SQL,
    "op13_merkle_manifest": _merkle_sql(),
}
