"""The queries of this subpackage: one for each operator, and the pipeline."""

from __future__ import annotations

from pyspark.sql import functions as F

from folio.llm import decontamination, fingerprints, language, license_scan, near_dedup, pieces, quality, repeats, runs, secret_scan, token_output, toxicity, vector_codes
from folio.llm.common import table


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op7_token_output(spark, sf_dir):
    return token_output.token_digest(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op5_fingerprints(spark, sf_dir):
    return fingerprints.fingerprint_report(table(spark, sf_dir, "documents"))


def op1_decontamination(spark, sf_dir):
    return decontamination.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_secret_scan(spark, sf_dir):
    return secret_scan.secrets(table(spark, sf_dir, "documents"))


def op3_near_dedup(spark, sf_dir):
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=2)


def op8_toxicity(spark, sf_dir):
    return toxicity.severities(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_quality(spark, sf_dir):
    return quality.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_sentencepiece(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.encoded(docs, tokenizer_path("piece_bpe_32k.model")).select("doc_id", "n_pieces", "round_trip", "piece_ids")


def op6_repeats(spark, sf_dir):
    return repeats.without_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op10_license_scan(spark, sf_dir):
    return license_scan.licenses(table(spark, sf_dir, "documents"))


def op11_language(spark, sf_dir):
    return language.identified(table(spark, sf_dir, "documents"))


def op12_periodic_runs(spark, sf_dir):
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return runs.periodic_runs(table(spark, sf_dir, "documents"), rewrite=runs.repeated_tail, seed=h)


def op13_vector_codes(spark, sf_dir):
    return vector_codes.vector_codes(table(spark, sf_dir, "embeddings"))


def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries():
    return {
        "op1_decontamination": op1_decontamination,
        "op2_sentencepiece": op2_sentencepiece,
        "op3_near_dedup": op3_near_dedup,
        "op4_secret_scan": op4_secret_scan,
        "op5_fingerprints": op5_fingerprints,
        "op6_repeats": op6_repeats,
        "op7_token_output": op7_token_output,
        "op8_toxicity": op8_toxicity,
        "op9_quality": op9_quality,
        "op10_license_scan": op10_license_scan,
        "op11_language": op11_language,
        "op12_periodic_runs": op12_periodic_runs,
        "op13_vector_codes": op13_vector_codes,
        "pipeline": pipeline,
    }


#: Shares of equal word pairs of all documents, counted over their common ones, and everything that can be reached by them.
NEAR_SQL = r"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 2 THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) ELSE w END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS m FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y, m = p.n AND m = q.n AS same FROM c JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * m >= 80 * (p.n + q.n - m)),
both_ways AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
r AS (SELECT doc_id AS node, doc_id AS reach FROM documents UNION SELECT r.node, b.y FROM r JOIN both_ways b ON b.x = r.reach),
k AS (SELECT node, min(reach) AS component_id FROM r GROUP BY node),
q AS (SELECT y, min(x) AS class_id FROM e WHERE same GROUP BY y)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept, coalesce(class_id, d.doc_id) AS class_id
FROM documents d JOIN k ON k.node = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN q ON q.y = d.doc_id"""

#: All strings of 200 bytes of all documents, by their MD5; the bytes are those of the text in hexadecimal.
REPEATS_SQL = """WITH t AS (SELECT doc_id, encode(coalesce(text, '')) AS b, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, a, md5(b[a + 1 : a + 200]) AS s FROM (SELECT doc_id, b, unnest(range(0, octet_length(b) - 199)) AS a FROM t)),
f AS (SELECT doc_id, a FROM w WHERE s IN (SELECT s FROM w GROUP BY s HAVING count(*) > 1)),
g AS (SELECT *, a > coalesce(lag(a) OVER (PARTITION BY doc_id ORDER BY a), -201) + 200 AS new FROM f),
i AS (SELECT *, sum(CAST(new AS INT)) OVER (PARTITION BY doc_id ORDER BY a) AS k FROM g),
p AS (SELECT doc_id, min(a) AS lo, max(a) + 200 AS hi FROM i GROUP BY doc_id, k),
o AS (SELECT p.*, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS last_hi FROM p),
x AS (SELECT o.doc_id, sum(hi - lo) AS gone, count(*) AS spans, string_agg(substr(h, 2 * last_hi + 1, 2 * (lo - last_hi)), '' ORDER BY lo) || substr(any_value(h), 2 * max(hi) + 1) AS kept
      FROM o JOIN t ON t.doc_id = o.doc_id GROUP BY o.doc_id)
SELECT t.doc_id, octet_length(b) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, coalesce(spans, 0) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256 FROM t LEFT JOIN x ON x.doc_id = t.doc_id"""


#: Stretches of equal words q apart, found from equal stretches of six words, which every run of twelve has; crc32 from its table.
RUNS_SQL = r"""WITH crc AS (SELECT list(v ORDER BY b) AS tab FROM (SELECT b, list_reduce(list_concat([b], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) t(b))),
d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
        xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))), lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1])), 4294967295) AS h FROM documents, crc),
e AS (SELECT doc_id, w, len(w) AS n, h, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a, 3 + (h // 10) % 8 AS parts FROM d),
m AS (SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(0, n), lambda i: CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % (1 + (n - a) // parts) + 1] END) ELSE w END AS w FROM e),
g AS (SELECT doc_id, i, array_to_string(w[i + 1 : i + 6], ' ') AS gram FROM (SELECT doc_id, w, unnest(range(0, n - 5)) AS i FROM m)),
p AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM g x JOIN g y ON x.doc_id = y.doc_id AND x.gram = y.gram AND x.i < y.i),
s AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS stretch FROM p),
f AS (SELECT doc_id, q, min(i) AS start, count(*) + 5 + q AS length FROM s GROUP BY doc_id, q, stretch),
r AS (SELECT doc_id, start, length, min(q) AS period FROM f WHERE length >= greatest(12, 2 * q) GROUP BY doc_id, start, length),
k AS (SELECT doc_id, count(*) AS n_runs, list({'start': start, 'length': length, 'period': period} ORDER BY length DESC, start, period) AS runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines FROM r GROUP BY doc_id)
SELECT m.doc_id, coalesce(n_runs, 0) AS n_runs, runs[1].start AS start, runs[1].length AS length, runs[1].period AS period, 1000 * runs[1].length // runs[1].period AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
  sha256(array_to_string(CASE WHEN runs IS NULL THEN w ELSE list_transform(list_filter(range(0, n), lambda i: len(list_filter(runs, lambda x: i >= x.start + x.period AND i < x.start + x.length)) = 0), lambda i: w[i + 1]) END, ' ')) AS collapsed_sha256
FROM m LEFT JOIN k ON k.doc_id = m.doc_id"""


def vector_codes_sql() -> str:
    """Every part measured against every entry, in a table expression for each round."""
    part = "v[part * (len(v) // 8) + 1 : (part + 1) * (len(v) // 8)]"
    near = """n{0} AS MATERIALIZED (SELECT vec_id, label, p.part, any_value(p.x) AS x, arg_min(e.entry, (d, e.entry)) AS entry, min(d) AS d FROM p
  JOIN (SELECT * FROM b{0}) e ON e.part = p.part, LATERAL (SELECT CAST(list_sum(list_transform(range(1, len(p.x) + 1), lambda i: (p.x[i] - e.c[i]) * (p.x[i] - e.c[i]))) AS BIGINT) AS d) GROUP BY vec_id, label, p.part)"""
    mean = """m{0} AS (SELECT part, entry, list(c ORDER BY i) AS c FROM (SELECT part, entry, i, CAST(sum(x[i]) - ((sum(x[i]) % count(*)) + count(*)) % count(*) AS BIGINT) // count(*) AS c FROM n{0}, LATERAL (SELECT unnest(range(1, len(x) + 1)) AS i) GROUP BY part, entry, i) GROUP BY part, entry),
b{1} AS MATERIALIZED (SELECT b{0}.part, b{0}.entry, coalesce(m{0}.c, b{0}.c) AS c FROM b{0} LEFT JOIN m{0} ON m{0}.part = b{0}.part AND m{0}.entry = b{0}.entry)"""
    steps = [f"""k AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
             f"p AS MATERIALIZED (SELECT vec_id, label, part, {part} AS x FROM k, range(8) t(part))",
             "b0 AS MATERIALIZED (SELECT part, rank - 1 AS entry, x AS c FROM (SELECT *, row_number() OVER (PARTITION BY part ORDER BY vec_id) AS rank FROM p) WHERE rank <= 16)"]
    for k in range(vector_codes.ROUNDS):
        steps += [near.format(k), mean.format(k, k + 1)]
    last = vector_codes.ROUNDS
    steps += [near.format(last), f"r AS (SELECT vec_id, label, string_agg(format('{{:02x}}', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM n{last} GROUP BY vec_id, label)"]
    sha = f"(SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) FROM b{last})"
    return f"WITH {', '.join(steps)}\nSELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, {sha} AS codebooks_sha256 FROM r"


def oracle_sql():
    """For the queries all of whose columns SQL can express; the others are held against brute force in tests/llm."""
    return {"op3_near_dedup": NEAR_SQL, "op6_repeats": REPEATS_SQL, "op12_periodic_runs": RUNS_SQL, "op13_vector_codes": vector_codes_sql()}
