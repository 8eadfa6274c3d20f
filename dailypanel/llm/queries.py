"""The text operators applied to the given tables, with their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dailypanel.llm import audit, codes, ctw, exact, fingerprints, fm_index, licenses, lines, mixing, ngram_join, page_text, pieces, rules
from dailypanel.llm.common import read, sha256_hex, whole

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def register(build):
        QUERIES[build.__name__] = build
        if sql is not None:
            ORACLES[build.__name__] = sql
        return build

    return register


def model_path() -> str:
    """Where the installed vocabulary of the pieces is."""
    import public_tokenizers

    return str(public_tokenizers.path("piece_bpe_32k.model"))


LINES_SQL = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
hashed AS (SELECT *, ('0x' || substr(md5(line), 1, 8))::BIGINT AS h, max(i) OVER (PARTITION BY doc_id) AS n FROM lines),
rolled AS (SELECT *, (h + {lines.FACTOR} * coalesce(lag(h) OVER (PARTITION BY doc_id ORDER BY i), 0)) % {lines.MODULUS} AS r FROM hashed),
cut AS (
  SELECT *, i = n OR i BETWEEN 2 AND n - 2 AND lag(r) OVER (PARTITION BY doc_id ORDER BY i) > r AND r <= lead(r) OVER (PARTITION BY doc_id ORDER BY i) AS ends
  FROM rolled),
placed AS (SELECT *, coalesce(sum(ends::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos FROM cut),
chunks AS (SELECT doc_id, pos, count(*) AS k, string_agg(line, chr(10) ORDER BY i) AS body FROM placed GROUP BY doc_id, pos),
marked AS (
  SELECT doc_id, pos, k, body, k >= 2 AND regexp_matches(body, '[^\\x20\\x09-\\x0D]')
    AND row_number() OVER (PARTITION BY body, k >= 2 ORDER BY doc_id, pos) > 1 AS gone FROM chunks)
SELECT doc_id, sum(k)::BIGINT AS n_lines, count(*) AS n_chunks, coalesce(sum(k) FILTER (WHERE gone), 0)::BIGINT AS n_removed,
  coalesce(string_agg(body, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text
FROM marked GROUP BY doc_id
"""


@query(LINES_SQL)
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, name = lines.dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", f"{name}.*", "text")


@query()
def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, name = pieces.encode_documents(read(spark, sf_dir, "documents").select("doc_id", "text"), model_path())
    return out.select("doc_id", F.size(f"{name}.ids").cast("long").alias("n_pieces"), f"{name}.ids", f"{name}.round_trip")


@query()
def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_ngrams(read(spark, sf_dir, "documents"))


@query()
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, name = rules.judge(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "labels"))
    v = F.col(name)
    return out.select("doc_id", *[v[c].alias(c) for c in (*rules.BASE, "base_failed", "kept", "rule")])


MIXING_SQL = rf"""
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    -ln((('0x' || substr(md5('{mixing.SEED}:' || coalesce(doc_id::VARCHAR, 'null:' || md5(coalesce(text, '')))), 1, 12))::BIGINT + 1) / 281474976710656.0::DOUBLE)
      / greatest(0.05, 1 - 4 * len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]'))::DOUBLE / greatest(length(coalesce(text, '')), 1)) AS key
  FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS s, [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS w FROM docs GROUP BY source),
levels AS (  -- the level is where the sum of the capped targets reaches the total: try every source as the first uncapped one
  SELECT max((t.total - coalesce(c.cap, 0)) / c.rest) AS level FROM (SELECT sum(s)::DOUBLE AS total FROM per) t,
    (SELECT a.source, sum(3.0 * b.s) FILTER (WHERE 3.0 * b.s / b.w < 3.0 * a.s / a.w) AS cap, sum(b.w) FILTER (WHERE 3.0 * b.s / b.w >= 3.0 * a.s / a.w) AS rest
     FROM per a, per b GROUP BY a.source) c),
targets AS (SELECT source, s, least(level * w, 3.0 * s)::DOUBLE AS target FROM per, levels),
plans AS (SELECT *, CASE WHEN s > 0 THEN floor(target / s + 1e-9) ELSE 0 END AS epochs FROM targets),
ordered AS (
  SELECT d.doc_id, d.size, p.s, p.target, p.epochs, greatest(0, round(p.target - p.epochs * p.s)) AS budget,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM docs d JOIN plans p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, s AS source_size, round(target, 4) AS target, (epochs * size + greatest(0, least(size, budget - before)))::BIGINT AS taken FROM ordered
"""


@query(MIXING_SQL)
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, name = mixing.mix(read(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    m = F.col(name)
    return out.select("doc_id", m["size"].alias("size"), m["source_size"].alias("source_size"), F.round(m["target"], 4).alias("target"), m["taken"].alias("taken"))


@query()
def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, name = page_text.extract_pages(read(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "url", F.col(name).alias("text"), F.length(name).cast("long").alias("n_chars"))


LICENSES_SQL = """
SELECT doc_id, len(w)::BIGINT AS n_words, len(p)::BIGINT AS n_base, list_min(p) - 1 AS first_word, list_max(p) - 1 AS last_word,
  array_to_string(list_sort(list_distinct(list_transform(p, lambda x: CASE WHEN w[x] = 'mit' THEN 'mit' WHEN w[x] = 'apache' THEN 'apache' ELSE 'gpl' END))), ',') AS base_labels
FROM (SELECT doc_id, w, list_filter(generate_series(1, len(w)), lambda i: (w[i] = 'mit' AND w[i + 1] = 'license') OR (w[i] = 'apache' AND w[i + 1] = 'license')
    OR (w[i] = 'general' AND w[i + 1] = 'public' AND w[i + 2] = 'license')) AS p
  FROM (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents))
"""


@query()
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, name = licenses.scan_documents(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", f"{name}.*")


@query()
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fm_index.dedup_substrings(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", sha256_hex(F.col("kept")).alias("kept_sha256"))


@query()
def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.score_documents(read(spark, sf_dir, "documents"))


@query()
def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_edits(read(spark, sf_dir, "documents"))


def codes_sql(rounds: int = codes.ROUNDS) -> str:
    """One chain of tables a round: the nearest entry of every part by comparison with all of them, then the entries' means."""
    nearest = """(SELECT x.vec_id, x.p, any_value(x.x) AS x, min(d) AS d, arg_min(e, d * 16 + e) AS e FROM (
      SELECT x.*, b.e, list_sum(list_transform(range(1, len(x.x) + 1), lambda i: (x.x[i] - b.c[i]) * (x.x[i] - b.c[i])))::BIGINT AS d FROM parts x JOIN {b} b ON x.p = b.p) x GROUP BY x.vec_id, x.p)"""
    steps = ""
    for k in range(rounds):
        steps += f"""a{k} AS MATERIALIZED {nearest.format(b=f"b{k}")},
b{k + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM b{k} b LEFT JOIN (
  SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM (
    SELECT p, e, i, sum(x)::BIGINT AS s, count(*) AS n FROM (SELECT p, e, unnest(x) AS x, generate_subscripts(x, 1) AS i FROM a{k}) GROUP BY p, e, i) GROUP BY p, e) m ON b.p = m.p AND b.e = m.e),
"""
    return f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor({codes.SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (SELECT vec_id, p, v[p * (len(v) // 8) + 1 : (p + 1) * (len(v) // 8)] AS x FROM kept, range(8) t(p)),
b0 AS MATERIALIZED (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x AS c FROM parts WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT 16)),
{steps}last AS MATERIALIZED {nearest.format(b=f"b{rounds}")},
coded AS (SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM last GROUP BY vec_id),
books AS (SELECT sha256(string_agg(c::VARCHAR, ',' ORDER BY p, e, i)) AS sha FROM (SELECT p, e, unnest(c) AS c, generate_subscripts(c, 1) AS i FROM b{rounds}))
SELECT k.vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, sha AS codebooks_sha256 FROM kept k JOIN coded USING (vec_id), books
"""


@query(codes_sql())
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, name, books = codes.encode_vectors(read(spark, sf_dir, "embeddings"))
    return out.select("vec_id", f"{name}.*", F.lit(codes.books_sha256(books)).alias("codebooks_sha256"))


AUDIT_SQL = """
WITH words AS (SELECT *, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first FROM documents),
marks AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
failed AS (
  SELECT coalesce(lang, '') AS part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, concat(
    CASE WHEN len(w) < 100 THEN 'A' ELSE '' END, CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END,
    CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' ELSE '' END,
    CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END, CASE WHEN d.doc_id > first THEN 'E' ELSE '' END) AS fails
  FROM words d LEFT JOIN marks m ON d.doc_id = m.doc_id),
cells AS MATERIALIZED (SELECT part, fails, count(*) AS docs, sum(good) AS good, sum(toxic) AS toxic FROM failed GROUP BY ALL),
letters(l) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS MATERIALIZED (SELECT concat(a.l, b.l, c.l, d.l, e.l) AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
steps AS (SELECT filter_order, step, substr(filter_order, step, 1) AS now, '[' || substr(filter_order, 1, step - 1) || '-]' AS before FROM orders, (SELECT unnest(range(1, 6))::INT AS step)),
told AS (
  SELECT part, filter_order, step, docs, good, toxic, contains(fails, now) AS here, regexp_matches(fails, before) AS gone, fails = now AS alone, now FROM cells, steps),
rows AS (
  SELECT part, filter_order, step, now, coalesce(sum(docs) FILTER (WHERE NOT here AND NOT gone), 0)::BIGINT AS kept, coalesce(sum(docs) FILTER (WHERE here AND NOT gone), 0)::BIGINT AS removed,
    coalesce(sum(docs) FILTER (WHERE here AND gone), 0)::BIGINT AS redundant, coalesce(sum(docs) FILTER (WHERE alone), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (WHERE here AND NOT gone), 0)::BIGINT AS good_lost, coalesce(sum(toxic) FILTER (WHERE here AND NOT gone), 0)::BIGINT AS toxic_lost
  FROM told GROUP BY part, filter_order, step, now)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, now))::BIGINT AS shapley FROM rows
"""


@query(AUDIT_SQL)
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit_filters(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


COPIES_SQL = """
WITH same AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS s FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = min(doc_id) OVER g AS kept, sha256(s) AS text_sha256 FROM same WINDOW g AS (PARTITION BY s)
"""


@query(COPIES_SQL)
def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    digest = sha256_hex(exact.one_space(F.col("text"))).alias("text_sha256")
    out, name = exact.find_copies(docs, returns=[F.col("doc_id"), digest])
    return out.select("doc_id", f"{name}.*", "text_sha256")
