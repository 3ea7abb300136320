"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.llm.common import read_table
from flowlens.llm.decontam import contained_items
from flowlens.llm import langid, pii
from flowlens.llm.license_scan import TEMPLATES, THRESHOLD, license_scan, template_terms
from flowlens.llm.line_dedup import line_dedup
from flowlens.llm.merkle import merkle_manifest
from flowlens.llm.mixing import mix_sources
from flowlens.llm.ngram_join import jaccard_components
from flowlens.llm.periodic import periodic_runs
from flowlens.llm.simhash import simhash_components
from flowlens.llm.sql import JACCARD_SQL, manifest_sql
from flowlens.llm.suffix_dedup import substring_dedup
from flowlens.llm.toxicity import fit, score_toxicity
from flowlens.llm.winnow import fingerprint_text, fingerprints_and_edits


def remainder(id_col: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(n))


def document_path() -> Column:
    """Documents as a file tree: the source, then directories by hundreds of the
    id (two levels from 10,000 on), so the least ids lie nearest the root."""
    doc, hundreds = F.col("doc_id"), F.floor(F.col("doc_id") / 100)
    folders = (F.when(doc < 100, F.lit("")).when(doc < 10_000, F.concat(hundreds.cast("string"), F.lit("/")))
               .otherwise(F.concat(F.floor(doc / 10_000).cast("string"), F.lit("/"), F.pmod(hundreds, F.lit(100)).cast("string"), F.lit("/"))))
    return F.concat(F.coalesce("source", F.lit("none")), F.lit("/"), folders, doc.cast("string"))


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", document_path().alias("path"))
    return license_scan(docs).withColumnRenamed("id", "doc_id")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    fitted = fit(docs, read_table(spark, sf_dir, "labels"), remainder("doc_id", 5) != 0)
    held_out = F.coalesce(remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out")
    return (score_toxicity(docs.select("doc_id", "text", "lang"), fitted)
            .select("doc_id", held_out, "score", "predicted", "threshold", "flagged"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_components(read_table(spark, sf_dir, "documents"), k=3, max_bits=3)
    return found.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                        F.col("component").alias("component_id"))


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find_personal_data(docs, pii.fit(docs))
    return found.select("doc_id", *[f"n_{k}" for k in pii.KINDS],
                        F.sha2(F.col("base_spans").cast("binary"), 256).alias("base_sha256"), "spans", "n_added")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (mix_sources(read_table(spark, sf_dir, "documents"))
            .select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "copies"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup(read_table(spark, sf_dir, "documents"))
    return kept.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contained_items(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "n_shared", "n_item", "containment")


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    fitted = langid.fit(docs, remainder("doc_id", 3) != 1)
    held_out = F.coalesce(remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out")
    return langid.identify_language(docs.select("doc_id", "text"), fitted).select("doc_id", held_out, "lang_pred", "score")


def op10_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprints_and_edits(read_table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                        fingerprint_text(F.col("chosen")).alias("fingerprint"),
                        fingerprint_text(F.col("edited_chosen")).alias("edited_fingerprint"), "near_edited", "near_next")


def with_planted_run(docs: DataFrame) -> DataFrame:
    """``docs`` where, in every tenth document by hash, the words from one on repeat with one period."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = F.coalesce(h % 10 == 0, F.lit(False))
    words = F.when(chosen, F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    rows = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), words.alias("words"), F.size(words).cast("bigint").alias("n"))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    rows = rows.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    edited = F.expr("array_join(transform(words, (w, i) -> if(i < a, w, words[cast(a + (i - a) % p as int)])), ' ')")
    return rows.select("doc_id", F.when(F.col("n") > 0, edited).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_planted_run(read_table(spark, sf_dir, "documents").select("doc_id", "text")))
    best = F.array_max(F.expr("transform(runs, r -> struct(r.length as length, -r.start as start, -r.period as period))"))
    listed = F.array_join(F.expr("transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n'))"), "")
    return (found.select(F.col("id").alias("doc_id"), F.size("runs").cast("bigint").alias("n_runs"), best.alias("best"),
                         F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
            .select("doc_id", "n_runs", (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
                    F.expr("1000 * best.length div -best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256"))


def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_components(read_table(spark, sf_dir, "documents"), k=3, percent=90)
    return found.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = {"text": F.when(remainder("doc_id", 5) == 0, lowered).otherwise(F.col("text"))}
    out = merkle_manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"], found=found)
    proof = F.array_join(F.transform("path", lambda p: F.concat(p["left"], p["right"])), "")
    return out.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.sha2(proof, 256).alias("proof_sha256"), "folded_root", "verified")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_license_scan, op2_toxicity, op3_simhash, op4_personal_data, op5_mixing, op6_substring_dedup,
    op7_line_dedup, op8_language, op9_decontamination,
    op10_winnowing, op11_periodic_runs, op12_jaccard_join, op13_manifest, pipeline)}

_SQL_OP7 = r"""
WITH lines AS (
  SELECT doc_id, i, line, lower_az(btrim_ws(line)) AS k FROM (
    SELECT doc_id, unnest(range(1, len(p) + 1)) AS i, unnest(p) AS line
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS p FROM documents))
), frequent AS (
  SELECT k, max(doc_id) AS keeper FROM lines WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT l.doc_id, l.i, l.line, (f.k IS NOT NULL AND f.keeper <> l.doc_id) AS dropped FROM lines l LEFT JOIN frequent f USING (k)
)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CAST(dropped AS INT)) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
""".replace("lower_az(btrim_ws(line))", r"translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), "
            "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")

_SQL_OP9 = r"""
WITH texts AS (
  SELECT 0 AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark
), words AS (
  SELECT kind, id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM texts
), shingles AS (
  SELECT DISTINCT kind, id, array_to_string(w[i : least(i + 4, len(w))], ' ') AS s
  FROM (SELECT kind, id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM words WHERE len(w) > 0)
), items AS (
  SELECT id, s, count(*) OVER (PARTITION BY id) AS n FROM shingles WHERE kind = 1
)
SELECT d.id AS doc_id, i.id AS item_id, count(*) AS n_shared, any_value(i.n) AS n_item, count(*) / any_value(i.n) AS containment
FROM shingles d JOIN items i ON d.s = i.s WHERE d.kind = 0
GROUP BY d.id, i.id HAVING count(*) / any_value(i.n) >= 0.8
"""


def _sql_op1() -> str:
    terms = ", ".join(f"({i}, '{name}', '{t}', {n}.0)" for i, (name, text) in enumerate(TEMPLATES) for t, n in sorted(template_terms(text).items()))
    return rf"""
WITH template(template, licence, term, n) AS (VALUES {terms}
), vocabulary AS (SELECT DISTINCT term FROM template
), file AS (
  SELECT doc_id, coalesce(source, 'none') || '/' || CASE WHEN doc_id < 100 THEN '' WHEN doc_id < 10000 THEN (doc_id // 100) || '/'
         ELSE (doc_id // 10000) || '/' || ((doc_id // 100) % 100) || '/' END || doc_id AS path, coalesce(text, '') AS text FROM documents
), unit AS (
  SELECT doc_id, path, unnest(range(1, len(p) + 1)) AS line, unnest(p) AS t FROM (SELECT *, string_split(text, chr(10)) AS p FROM file)
), term AS (
  SELECT doc_id, path, line, lower(x) AS term, count(*) AS n
  FROM (SELECT doc_id, path, line, unnest(regexp_extract_all(t, '[A-Za-z0-9]+')) AS x FROM unit) GROUP BY ALL
), total AS (SELECT count(*) AS n FROM unit
), idf AS (
  SELECT v.term, ln((1 + (SELECT n FROM total)) / (1 + count(t.term))) + 1 AS idf FROM vocabulary v LEFT JOIN term t USING (term) GROUP BY v.term
), norm AS (
  SELECT doc_id, path, line, sqrt(sum(CASE WHEN idf IS NULL THEN (ln(1 + (SELECT n FROM total)) + 1) ** 2 ELSE (n * idf) ** 2 END)) AS norm
  FROM term LEFT JOIN idf USING (term) GROUP BY ALL
), tnorm AS (SELECT template, sqrt(sum((n * idf) ** 2)) AS norm FROM template JOIN idf USING (term) GROUP BY template
), cosine AS (
  SELECT u.doc_id, u.path, u.line, t.template, t.licence, round(sum(u.n * idf.idf * t.n * idf.idf) / any_value(x.norm) / any_value(m.norm), 6) AS score
  FROM term u JOIN template t ON u.term = t.term JOIN idf ON idf.term = t.term
  JOIN norm x ON x.doc_id = u.doc_id AND x.line = u.line JOIN tnorm m ON m.template = t.template GROUP BY ALL
), own AS (
  SELECT * FROM cosine WHERE score >= {THRESHOLD}
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, line, licence, template) = 1
), folder AS (
  SELECT regexp_replace(path, '/[^/]*$', '') AS folder, licence AS inherited FROM own
  QUALIFY row_number() OVER (PARTITION BY regexp_replace(path, '/[^/]*$', '') ORDER BY score DESC, path, line) = 1
), placed AS (SELECT doc_id, path, regexp_replace(path, '/[^/]*$', '') AS folder FROM file
), nearest AS (
  SELECT p.doc_id, f.folder, f.inherited FROM placed p JOIN folder f ON p.folder = f.folder OR starts_with(p.folder, f.folder || '/')
  QUALIFY row_number() OVER (PARTITION BY p.doc_id ORDER BY length(f.folder) DESC) = 1
)
SELECT p.doc_id, p.path, coalesce(o.licence, n.inherited) AS licence, o.score, CAST(o.line AS INT) AS line,
       CASE WHEN o.licence IS NOT NULL THEN p.path ELSE n.folder END AS declared_in
FROM placed p LEFT JOIN own o ON o.doc_id = p.doc_id LEFT JOIN nearest n ON n.doc_id = p.doc_id
"""


SQL = {"op1_license_scan": _sql_op1(), "op7_line_dedup": _SQL_OP7, "op9_decontamination": _SQL_OP9,
       "op12_jaccard_join": JACCARD_SQL, "op13_manifest": manifest_sql()}
