"""The registered queries of the operators: thin digests of their results.

Each applies its operator with production parameters to its whole table.
``ORACLE`` has DuckDB SQL where SQL can express the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.session import unique_dir

#: id that ends a document in token files and packed sequences
END_ID = 2


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


# ------------------------------------------------------------ 1: licences

def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hirelens.llm.licenses import scan
    return scan(_table(spark, sf_dir, "documents"))


CANONICAL_LINES_SQL = r"""
  list_filter(list_transform(
    string_split(regexp_replace(regexp_replace(lower(text),
      '(?m)^[^\p{L}\p{N}\n]*(?:(?:copyright|©)[^\n]*(?:(?:19|20)[0-9]{2}|©|\(c\))[^\n]*|(?:\(c\)|©)[^\n]*|all rights reserved[^\p{L}\p{N}\n]*)$',
      '', 'g'), '[^\p{L}\p{N}\n]+', ' ', 'g'), chr(10)),
    lambda l: array_to_string(list_transform(string_split(trim(l), ' '), lambda w: coalesce(same[w], w)), ' ')),
  lambda x: x <> '')"""

OP1_SQL = """
WITH e AS (SELECT MAP {@same} AS same),
k AS (SELECT sha256(array_to_string(lines, ' ')) AS digest, min(license) AS license
      FROM (SELECT license, @lines AS lines FROM (VALUES @known) t(license, text), e) WHERE len(lines) > 0 GROUP BY 1),
d AS (SELECT doc_id, @lines AS lines FROM documents, e),
u AS (SELECT doc_id, unnest(lines) AS line FROM d),
f AS (SELECT doc_id, string_agg(DISTINCT license, ',' ORDER BY license) AS names FROM u JOIN k ON sha256(line) = k.digest GROUP BY doc_id)
SELECT d.doc_id, sha256(array_to_string(d.lines, ' ')) AS digest, k.license, coalesce(f.names, '') AS line_licenses
FROM d LEFT JOIN k ON sha256(array_to_string(d.lines, ' ')) = k.digest LEFT JOIN f ON d.doc_id = f.doc_id
"""


def _op1_sql() -> str:
    from hirelens.llm.license_texts import EQUIVALENT, KNOWN

    def quote(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    known = ", ".join(f"({quote(n)}, {quote(t)})" for n, t in KNOWN)
    same = ", ".join(f"{quote(a)}: {quote(b)}" for a, b in EQUIVALENT.items())
    return OP1_SQL.replace("@lines", CANONICAL_LINES_SQL).replace("@same", same).replace("@known", known)


# ---------------------------------------------------------- 2: substrings

def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hirelens.llm.substrings import dedup_windows
    out = dedup_windows(_table(spark, sf_dir, "documents"), words=20)
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


OP2_SQL = r"""
WITH w AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS ws FROM documents),
x AS (SELECT doc_id, i, array_to_string(ws[i:i + 19], ' ') AS k
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM w WHERE len(ws) >= 20)),
r AS (SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS n FROM x) WHERE n > 1),
v AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS j FROM w),
m AS (SELECT v.doc_id, word, j, max(CASE WHEN r.i IS NULL THEN 0 ELSE 1 END)
        OVER (PARTITION BY v.doc_id ORDER BY j ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone
      FROM v LEFT JOIN r ON v.doc_id = r.doc_id AND v.j = r.i),
g AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone = 1) AS n_removed,
        string_agg(word, ' ' ORDER BY j) FILTER (gone = 0) AS kept FROM m GROUP BY doc_id)
SELECT w.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN g ON w.doc_id = g.doc_id
"""


# ----------------------------------------------------------- 3: embeddings

def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hirelens.llm.embeddings import near_duplicates
    return near_duplicates(_table(spark, sf_dir, "embeddings"), cosine=0.95)


#: brute force, which the approximate search meets exactly where its recall is 1
OP3_SQL = """
WITH RECURSIVE e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_sum(list_transform(embedding, lambda x: abs(x))) > 0),
p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM e a JOIN e b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.95),
c AS (SELECT a AS node, b AS other FROM p UNION SELECT c.node, p.b FROM c JOIN p ON c.other = p.a),
l AS (SELECT node, least(node, min(other)) AS component_id FROM c GROUP BY node),
n AS (SELECT a AS node, count(*) AS n_links FROM p GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, coalesce(component_id, vec_id) AS component_id, coalesce(component_id, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN n ON vec_id = n.node LEFT JOIN l ON vec_id = l.node
"""


#: vectors with links that are known: of each vector of the table itself, a
#: scaled copy, two that lean away from it (one within the cosine, one mostly
#: beyond), one of a hub, and for some a second vector with the same id
LINKED_SQL = """
SELECT vec_id * 8 AS vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS embedding FROM embeddings
UNION ALL SELECT vec_id * 8 + 1, list_transform(embedding, lambda x: x::DOUBLE * 3) FROM embeddings WHERE vec_id % 3 = 0
UNION ALL SELECT vec_id * 8 + 2, list_transform(range(1, 1 + len(embedding)), lambda i: embedding[i]::DOUBLE * (1 + (i + vec_id) % 3 * 0.2)) FROM embeddings WHERE vec_id % 2 = 0
UNION ALL SELECT vec_id * 8 + 3, list_transform(range(1, 1 + len(embedding)), lambda i: embedding[i]::DOUBLE * (1 + (i + vec_id) % 2 * 0.9)) FROM embeddings WHERE vec_id % 2 = 1
UNION ALL SELECT vec_id * 8 + 4, list_transform(range(1, 1 + len(embedding)), lambda i: hub[i]::DOUBLE * (1 + (i * i + vec_id) % 7 * 0.03))
  FROM embeddings, (SELECT embedding AS hub FROM embeddings ORDER BY vec_id LIMIT 1) h WHERE vec_id % 3 = 1
UNION ALL SELECT vec_id * 8, list_transform(range(1, 1 + len(embedding)), lambda i: embedding[1 + len(embedding) - i]::DOUBLE) FROM embeddings WHERE vec_id % 5 = 0"""


def linked_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LINKED_SQL in Spark."""
    e = _table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("e"))
    i = F.col("vec_id")
    hub = e.orderBy("vec_id").limit(1).select(F.col("e").alias("hub"))  # one row

    def kind(part: DataFrame, at: int, vector) -> DataFrame:
        return part.select((i * 8 + at).alias("vec_id"), vector.alias("embedding"))
    one = F.lit(1.0)
    parts = [
        kind(e, 0, F.col("e")), kind(e.where(i % 3 == 0), 1, F.transform("e", lambda x: x * 3)),
        kind(e.where(i % 2 == 0), 2, F.transform("e", lambda x, k: x * (one + (k + 1 + i) % 3 * 0.2))),
        kind(e.where(i % 2 == 1), 3, F.transform("e", lambda x, k: x * (one + (k + 1 + i) % 2 * 0.9))),
        kind(e.where(i % 3 == 1).crossJoin(F.broadcast(hub)), 4, F.transform("hub", lambda x, k: x * (one + ((k + 1) * (k + 1) + i) % 7 * 0.03))),
        kind(e.where(i % 5 == 0), 0, F.reverse("e"))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def embedding_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The operator of op3 where there is something to find."""
    from hirelens.llm.common import written
    from hirelens.llm.embeddings import near_duplicates
    return near_duplicates(written(linked_vectors(spark, sf_dir), "linked-vectors"), cosine=0.95)


EMBEDDING_LINKS_SQL = f"""
WITH RECURSIVE e AS (SELECT row_number() OVER () AS r, vec_id, embedding AS v FROM ({LINKED_SQL})),
p AS (SELECT a.r AS a, b.r AS b FROM e a JOIN e b ON a.r <> b.r AND (a.vec_id <> b.vec_id OR a.v <> b.v) AND list_cosine_similarity(a.v, b.v) >= 0.95),
c AS (SELECT a AS node, b AS other FROM p UNION SELECT c.node, p.b FROM c JOIN p ON c.other = p.a),
l AS (SELECT node, min(e.vec_id) AS least FROM c JOIN e ON c.other = e.r GROUP BY node),
n AS (SELECT a AS node, count(*) AS n_links FROM p GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, least(vec_id, coalesce(least, vec_id)) AS component_id, vec_id <= coalesce(least, vec_id) AS kept
FROM e LEFT JOIN n ON e.r = n.node LEFT JOIN l ON e.r = l.node
"""


# -------------------------------------------------------------- 4: quality

def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hirelens.llm.quality import judge
    judged = judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return judged.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", "base_failed", "kept", "rule")


# -------------------------------------------------------------- 5: simhash

def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hirelens.llm.simhash import near_duplicates
    out = near_duplicates(_table(spark, sf_dir, "documents"), words=3, most=3)
    return out.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                      F.col("component").alias("component_id"))


# ---------------------------------------------------------------- 6: urls

#: fixed values: (host, path, verdict)
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hirelens.llm.urls import judge
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return judge(_table(spark, sf_dir, "pages"), rules)


OP6_SQL = r"""
WITH r(rh, rp, v) AS (VALUES ('com','/','allow'), ('example.com','/en/','block'), ('www.example.com','/en/','allow'),
                             ('net','/es/','block'), ('net','/fr/','block')),
a AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages),
p AS (SELECT page_id,
        coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
        coalesce(regexp_extract(rest, '^[^/?#]*(/[^?#]*)?', 1), '') AS path FROM a),
m AS (SELECT p.page_id, max_by(rh || rp, length(rh || rp)) AS rule, max_by(v, length(rh || rp)) AS v
      FROM p JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY p.page_id)
SELECT p.page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM p LEFT JOIN m ON p.page_id = m.page_id
"""


# -------------------------------------------------------------- 7: mixing

def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hirelens.llm.mixing import mix
    mixed = mix(_table(spark, sf_dir, "documents"), weights=[1, 2, 3], most=3, cut=True)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


OP7_SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
             ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size,
        ((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1)::DOUBLE AS w FROM d GROUP BY source),
c AS (SELECT *, source_size * 3 AS cap, (sum(source_size) OVER ())::BIGINT AS total, sum(w) OVER () AS total_w FROM s),
l AS (SELECT *, row_number() OVER o AS n,
        coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS cap_before,
        coalesce(sum(w) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS w_before
      FROM c WINDOW o AS (ORDER BY cap / w, source IS NULL, source)),
v AS (SELECT *, (total - cap_before)::DOUBLE / (total_w - w_before) AS lam FROM l),
f AS (SELECT min(n) AS first_n, min_by(lam, n) AS lam FROM v WHERE lam * w <= cap),
t AS (SELECT v.source, source_size, CASE WHEN first_n IS NULL OR n < first_n THEN cap::DOUBLE ELSE f.lam * w END AS target
      FROM v LEFT JOIN f ON true),
b AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM t),
e AS (SELECT *, round(target - whole * source_size)::BIGINT AS rest FROM b),
x AS (SELECT d.doc_id, d.size, e.source_size, e.target, whole, rest,
        (sum(size) OVER (PARTITION BY d.source, h))::BIGINT AS words,
        (sum(size) OVER (PARTITION BY d.source ORDER BY h))::BIGINT - (sum(size) OVER (PARTITION BY d.source, h))::BIGINT AS before
      FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target,
  whole * size + CASE WHEN before + words <= rest THEN size WHEN before >= rest THEN 0
                      ELSE (size::HUGEINT * (rest - before) // words)::BIGINT END AS taken
FROM x
"""


# ------------------------------------------------------------- 8: packing

PACK_COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hirelens.llm.packing import pack
    packed = pack(_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), END_ID)
    return packed.placed.select(*PACK_COLUMNS[:2], F.col("length").cast("long").alias("length"), *PACK_COLUMNS[3:])


# --------------------------------------------------------------- 9: lines

def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hirelens.llm.lines import dedup_lines
    out = dedup_lines(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_removed").alias("n_removed"),
                      F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


OP9_SQL = r"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos
           FROM documents WHERE text IS NOT NULL),
w AS (SELECT * FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
c AS (SELECT line, length(line) AS n, min((doc_id::HUGEINT << 31) + pos) AS place FROM w GROUP BY line),
b AS (SELECT line, place, n, n AS m FROM c WHERE n >= 20 UNION ALL SELECT line, place, n, n - 1 FROM c WHERE n >= 21),
k AS (SELECT line, place, n, m, 0 AS q, left(line, (m // 2)::BIGINT) AS part FROM b
      UNION ALL SELECT line, place, n, m, 1, right(line, (m - m // 2)::BIGINT) FROM b),
p AS (SELECT DISTINCT x.line AS a, x.n AS an, x.place AS ap, y.line AS b, y.n AS bn, y.place AS bp
      FROM k x JOIN k y ON x.m = y.m AND x.q = y.q AND x.part = y.part AND x.place > y.place),
near AS (SELECT DISTINCT a AS line FROM p WHERE CASE
      WHEN an = bn THEN len(list_filter(range(0, an), lambda i: left(a, i) = left(b, i) AND substr(a, i + 2) = substr(b, i + 2))) > 0
      WHEN an = bn + 1 THEN len(list_filter(range(0, an), lambda i: left(a, i) || substr(a, i + 2) = b)) > 0
      WHEN bn = an + 1 THEN len(list_filter(range(0, bn), lambda i: left(b, i) || substr(b, i + 2) = a)) > 0
      ELSE false END),
j AS (SELECT l.doc_id, l.pos, l.line,
        c.place IS NOT NULL AND (near.line IS NOT NULL OR (l.doc_id::HUGEINT << 31) + l.pos > c.place) AS gone
      FROM l LEFT JOIN c ON l.line = c.line LEFT JOIN near ON l.line = near.line),
d AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
        coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS kept FROM j GROUP BY doc_id)
SELECT x.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents x LEFT JOIN d ON x.doc_id = d.doc_id
"""


# ---------------------------------------------------------- 10: token files

def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hirelens.llm.tokenfiles import read_token_files, write_token_files
    folder = unique_dir(spark, "token-files")
    write_token_files(_table(spark, sf_dir, "documents"), folder, tokenizer_path("byte_bpe_50k.json"), END_ID)
    return read_token_files(spark, folder, with_ids=False)


# ------------------------------------------------------ 11: spelling variants

def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hirelens.llm.spelling import variant_groups
    return variant_groups(_table(spark, sf_dir, "documents"))


#: crc32 of the bytes of x, by the rule of its polynomial
CRC32_SQL = """
  (xor(list_reduce(list_prepend(4294967295, list_transform(range(1, octet_length(encode(@x)) + 1),
     lambda i: ('0x' || substr(hex(encode(@x)), 2 * i - 1, 2))::BIGINT)),
     lambda c, b: xor(c >> 8, crc.t[(xor(c, b) & 255) + 1])), 4294967295))"""
CRC32_TABLE_SQL = """
crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
     lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t)"""

OP11_SQL = (r"""
WITH RECURSIVE @table,
u AS (SELECT id, run, count(*) AS n FROM (
        SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(
          translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run
        FROM documents) GROUP BY id, run),
h AS (SELECT run, n, @crc AS h FROM (SELECT *, id || ':' || run AS x FROM u), crc),
k AS (SELECT CASE WHEN h % 97 = 0 THEN left(run, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, n FROM h),
w AS (SELECT word, sum(n)::BIGINT AS n FROM k WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
v AS (SELECT word, n, i, left(word, i) || substr(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM w)),
p AS (SELECT a.word, b.word AS other, b.n AS other_n FROM v a JOIN v b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
      UNION SELECT v.word, w.word, w.n FROM v JOIN w ON v.rest = w.word
      UNION SELECT w.word, v.word, v.n FROM v JOIN w ON v.rest = w.word),
b AS (SELECT word, count(*) AS n_near, arg_min(other, (-other_n, other)) AS best, max(other_n) AS best_n FROM p GROUP BY word),
f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 2 * w.n THEN best END AS form,
        CASE WHEN best_n >= 2 * w.n THEN best_n END AS form_n FROM w LEFT JOIN b ON w.word = b.word),
r AS (SELECT word, word AS tip, form AS next FROM f UNION ALL SELECT r.word, f.word, f.form FROM r JOIN f ON r.next = f.word)
SELECT f.word, form, r.tip AS root, n, n_near, form_n FROM f JOIN r ON f.word = r.word WHERE r.next IS NULL
""").replace("@table", CRC32_TABLE_SQL.strip()).replace("@crc", CRC32_SQL.replace("@x", "x"))


# ------------------------------------------------------------ 12: resampling

def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hirelens.llm.resampling import resample
    return resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


FOLDED_WORDS_SQL = r"""coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"""

OP12_SQL = (r"""
WITH @table,
d AS (SELECT doc_id, row_number() OVER () AS r, @words AS ws FROM documents),
e AS (SELECT r, unnest(ws) AS x FROM d),
g AS (SELECT unnest(@words) AS x FROM benchmark),
c AS (SELECT x, @crc % 10000 AS b FROM (SELECT x FROM e UNION SELECT x FROM g), crc),
s AS (SELECT b, count(*) AS s FROM e JOIN c USING (x) GROUP BY b),
t AS (SELECT b, count(*) AS t FROM g JOIN c USING (x) GROUP BY b),
a AS (SELECT (SELECT count(*) FROM e) AS s_all, (SELECT count(*) FROM g) AS t_all),
gain AS (SELECT x.b, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (s_all + 10000) / ((coalesce(s, 0) + 1)::DOUBLE * (t_all + 10000))))::BIGINT AS gain
         FROM (SELECT unnest(range(10000)) AS b) x LEFT JOIN s ON x.b = s.b LEFT JOIN t ON x.b = t.b, a),
m AS (SELECT r, sum(gain)::BIGINT AS total, count(*) AS n FROM e JOIN c USING (x) JOIN gain ON c.b = gain.b GROUP BY r),
q AS (SELECT doc_id, d.r, len(ws) AS n_features, CASE WHEN n IS NULL THEN 0 ELSE (total - ((total % n) + n) % n) // n END AS weight,
        ('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h FROM d LEFT JOIN m ON d.r = m.r),
z AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM q),
k AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS n FROM z WHERE n_features >= 20),
o AS (SELECT r, n FROM k WHERE n <= (SELECT count(*) * 10 // 100 FROM k))
SELECT doc_id, n_features::BIGINT AS n_features, weight::BIGINT AS weight, score::BIGINT AS score, o.n::BIGINT AS rank FROM z LEFT JOIN o ON z.r = o.r
""").replace("@table", CRC32_TABLE_SQL.strip()).replace("@words", FOLDED_WORDS_SQL).replace("@crc", CRC32_SQL.replace("@x", "x"))


# ------------------------------------------------------- 13: decontamination

def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from hirelens.llm.decontamination import find_leaks
    found = find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), words=10)
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


OP13_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, @words AS ws FROM documents),
i AS (SELECT item_id::VARCHAR AS item, @words AS ws FROM benchmark),
win AS (SELECT DISTINCT item, len(part) AS m, array_to_string(part, ' ') AS part FROM (
          SELECT item, ws[x:x + 9] AS part FROM (SELECT item, ws, unnest(range(1, len(ws) - 8)) AS x FROM i WHERE len(ws) >= 10)
          UNION ALL SELECT item, ws FROM i WHERE len(ws) BETWEEN 1 AND 9)),
pos AS (SELECT r, m, x, array_to_string(ws[x:x + m - 1], ' ') AS part FROM (
         SELECT r, ws, m, unnest(range(1, len(ws) - m + 2)) AS x FROM d, (SELECT DISTINCT m FROM win) WHERE len(ws) >= m)),
hit AS (SELECT r, x, pos.m, item FROM pos JOIN win ON pos.m = win.m AND pos.part = win.part),
n AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(x, x + m)) AS j FROM (SELECT DISTINCT r, x, m FROM hit)) GROUP BY r),
o AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hit GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n ON d.r = n.r LEFT JOIN o ON d.r = o.r
""".replace("@words", FOLDED_WORDS_SQL)


QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_embedding_dedup": op3_embedding_dedup,
    "op4_quality_rules": op4_quality_rules,
    "op5_simhash": op5_simhash,
    "op6_url_filter": op6_url_filter,
    "op7_source_mix": op7_source_mix,
    "op8_packing": op8_packing,
    "op9_line_dedup": op9_line_dedup,
    "op10_token_files": op10_token_files,
    "op11_spelling": op11_spelling,
    "op12_resampling": op12_resampling,
    "op13_decontamination": op13_decontamination,
    "embedding_links": embedding_links,
}

ORACLE = {
    "op1_license_scan": _op1_sql(),
    "op2_substring_dedup": OP2_SQL,
    "op3_embedding_dedup": OP3_SQL,
    "op6_url_filter": OP6_SQL,
    "op7_source_mix": OP7_SQL,
    "op9_line_dedup": OP9_SQL,
    "op11_spelling": OP11_SQL,
    "op12_resampling": OP12_SQL,
    "op13_decontamination": OP13_SQL,
    "embedding_links": EMBEDDING_LINKS_SQL,
}
