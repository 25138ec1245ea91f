"""Registered queries of this folder and their SQL (DuckDB), where SQL can express them."""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (byte_bpe, lattice_dedup, line_dedup, merkle, minhash_forest, mixing, pii, quality,
               rp_forest, secret_scan, substring_dedup, token_counts, turns)
from .common import table

REGISTRY = {}
ORACLES = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        REGISTRY[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return deco


@query("op1_rp_forest")
def op1_rp_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return rp_forest.search(vectors, vectors.where(F.col("vec_id") % 100 == 0), k=10)


@query("op2_quality")
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs, model)
    return scored.select("doc_id", quality.is_held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


OP3_SQL = """
WITH RECURSIVE valid AS (
  SELECT vec_id, label, [x::DOUBLE FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND label IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM valid a JOIN valid b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
groups AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(c.n, 0)::BIGINT AS n_links, g.component_id,
       e.vec_id = g.component_id AS kept
FROM embeddings e JOIN groups g ON g.a = e.vec_id LEFT JOIN counts c ON c.a = e.vec_id
"""


@query("op3_lattice_dedup", OP3_SQL)
def op3_lattice_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


OP4_SQL = r"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i,
         unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
frequent AS (SELECT k FROM keyed WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(f.k) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE f.k IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN frequent f ON keyed.k = f.k GROUP BY doc_id
"""


@query("op4_line_dedup", OP4_SQL)
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select(
        "doc_id", F.col("_llm_lines").alias("n_lines"), F.col("_llm_dropped").alias("n_dropped"),
        F.sha2("text", 256).alias("kept_sha256"))


OP5_SQL = r"""
WITH sizes AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
  FROM documents),
by_source AS (SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS r, 2.0::DOUBLE * source_size AS cap
  FROM by_source),
weighted AS (SELECT *, [5.0::DOUBLE, 2.0, 1.0][((r - 1) % 3 + 1)::INT] AS w FROM ranked),
filled AS (
  SELECT *, 1.5::DOUBLE * sum(source_size) OVER ()::DOUBLE - coalesce(sum(cap) OVER (
             ORDER BY cap / w, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remaining,
         sum(w) OVER (ORDER BY cap / w, r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest,
         row_number() OVER (ORDER BY cap / w, r) AS place
  FROM weighted),
level AS (
  SELECT arg_min(remaining / rest, place) AS level FROM filled WHERE NOT remaining * w > cap * rest),
targets AS (
  SELECT source, source_size,
         CASE WHEN remaining * w > cap * rest THEN cap ELSE level * w END AS target
  FROM filled, level)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM (
  SELECT s.*, source_size, target,
         CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
         ('0x' || substr(md5('17:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT::DOUBLE
           / 4503599627370496.0::DOUBLE AS u
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
"""


@query("op5_mixing", OP5_SQL)
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = mixing.rate_documents(table(spark, sf_dir, "documents"))
    return rated.select("doc_id", "size", "source_size", "target",
                        (F.col("size") * F.col("n_copies")).alias("taken"))


OP6_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ')
                               ELSE array_to_string(w[i:i + 4], ' ') END AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words
        WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT c.a, c.b FROM common c JOIN sizes x ON x.doc_id = c.a JOIN sizes y ON y.doc_id = c.b
  WHERE 100 * c.n >= 75 * (x.n + y.n - c.n)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
groups AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, g.component_id,
       d.doc_id = g.component_id AS kept
FROM documents d LEFT JOIN sizes s USING (doc_id) JOIN groups g ON g.a = d.doc_id
"""


@query("op6_minhash_forest", OP6_SQL)
def op6_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_forest.near_duplicates(table(spark, sf_dir, "documents"))


def tokenizer_file(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@query("op7_token_counts")
def op7_token_counts(spark: SparkSession, sf_dir: str, model: str = "piece_bpe_32k.model",
                     limit: int = 4096) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    counted = token_counts.count_tokens(docs, tokenizer_file(model))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


@query("op8_byte_bpe")
def op8_byte_bpe(spark: SparkSession, sf_dir: str,
                 ranks: str = "byte_bpe_multi_50k.tiktoken") -> DataFrame:
    import public_tokenizers
    docs = table(spark, sf_dir, "documents")
    return byte_bpe.round_trip(docs, tokenizer_file(ranks), public_tokenizers.PATTERN)


@query("op9_pii")
def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.spans_per_document(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone",
                        F.sha2("base", 256).alias("base_sha256"), "spans")


OP10_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS k
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM words WHERE len(w) >= 50)),
firsts AS (SELECT k, min(doc_id) AS low FROM windows GROUP BY k HAVING min(doc_id) < max(doc_id)),
hits AS (SELECT doc_id, list(i) AS starts
         FROM windows JOIN firsts USING (k) WHERE low < doc_id GROUP BY doc_id),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS j
  FROM (SELECT doc_id, unnest(starts) AS s FROM hits)),
flat AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS j FROM words),
kept AS (
  SELECT f.doc_id, string_agg(f.word, ' ' ORDER BY f.j) AS kept, count(*) AS n
  FROM flat f ANTI JOIN gone g ON g.doc_id = f.doc_id AND g.j = f.j GROUP BY f.doc_id)
SELECT w.doc_id, len(w.w)::BIGINT AS n_words, (len(w.w) - coalesce(k.n, 0))::BIGINT AS n_removed,
       sha256(coalesce(k.kept, '')) AS kept_sha256
FROM words w LEFT JOIN kept k ON k.doc_id = w.doc_id
"""


@query("op10_substring_dedup", OP10_SQL)
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


# crc32 of an ASCII text, as an unsigned number: the usual table (built from its rule), folded over it
CRC_TABLE_SQL = """crc AS (
  SELECT list_transform(range(256), lambda x: list_reduce(list_concat([x], range(8)), lambda c, k:
    xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END))) AS t)"""


def _crc(text: str) -> str:
    """DuckDB expression for the crc32 of ``text``, ``t`` being the table of ``CRC_TABLE_SQL``."""
    return (f"xor(4294967295::BIGINT, list_reduce(list_concat([4294967295::BIGINT], list_transform("
            f"string_split({text}, ''), lambda s: ascii(s)::BIGINT)), lambda c, b: "
            f"xor(t[(xor(c, b) & 255) + 1], c >> 8)))")


def _op11_sql(levels: int = 8, top_levels: int = 4) -> str:
    """Trees of at most 16 ** ``levels`` leaves a source and 16 ** ``top_levels`` sources."""
    def field(c):
        return f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')"

    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    fixed = " || ".join(map(field, ("doc_id", "source", "lang", "n_chars")))
    parts = [CRC_TABLE_SQL, f"""leaves AS (
  SELECT doc_id, source, sha256({fixed} || {field('text')}) AS leaf,
         CASE WHEN {_crc('doc_id::VARCHAR')} % 5 = 0 THEN sha256({fixed} || {field(lower)}) END AS tampered
  FROM documents, crc),
placed AS (
  SELECT *, coalesce(tampered, leaf) AS digest, row_number() OVER (
           PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM leaves)"""]

    def tree(name, start, n):
        parts.append(f"{name}0 AS ({start})")
        for k in range(n):
            parts.append(f"""{name}{k + 1} AS (
  SELECT *, CASE WHEN len(l{k}) > 1 THEN list_transform(range((len(l{k}) + 15) // 16), lambda i:
           sha256(array_to_string(l{k}[i * 16 + 1:i * 16 + 16], ''))) ELSE l{k} END AS l{k + 1}
  FROM {name}{k})""")

    def climb(name, start, n):
        """Siblings and folded digest of the node at ``place``, level by level."""
        parts.append(f"{name}0 AS ({start})")
        for k in range(n):
            at = f"(place // {16 ** k})"
            side = (f"coalesce(array_to_string(l{k}[{at} // 16 * 16 + 1:{at}], ''), '')",
                    f"coalesce(array_to_string(l{k}[{at} + 2:{at} // 16 * 16 + 16], ''), '')")
            parts.append(f"""{name}{k + 1} AS (
  SELECT * REPLACE (CASE WHEN len(l{k}) > 1 THEN sha256({side[0]} || digest || {side[1]}) ELSE digest END AS digest,
                    CASE WHEN len(l{k}) > 1 THEN proof || {side[0]} || {side[1]} ELSE proof END AS proof)
  FROM {name}{k})""")

    tree("s", "SELECT source, list(leaf ORDER BY place) AS l0 FROM placed GROUP BY source", levels)
    parts.append(f"""subroots AS (
  SELECT source, l{levels}[1] AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS rank
  FROM s{levels})""")
    tree("r", "SELECT list(subroot ORDER BY rank) AS l0 FROM subroots", top_levels)
    climb("c", f"SELECT p.doc_id, p.source, p.leaf, p.digest, p.place, '' AS proof, "
               f"s.* EXCLUDE (source) FROM placed p JOIN s{levels} s ON p.source IS NOT DISTINCT FROM s.source",
          levels)
    climb("t", f"SELECT c.doc_id, c.leaf, c.digest, c.proof, b.subroot, b.rank AS place, r.* "
               f"FROM c{levels} c JOIN subroots b ON c.source IS NOT DISTINCT FROM b.source, r{top_levels} r",
          top_levels)
    parts = ",\n".join(parts)
    return f"""WITH {parts}
SELECT doc_id, leaf, subroot, l{top_levels}[1] AS root, sha256(proof) AS proof_sha256,
       digest AS folded_root, digest = l{top_levels}[1] AS verified FROM t{top_levels}"""


@query("op11_merkle", _op11_sql())
def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, merkle.leaf(
        [lowered if c == "text" else F.col(c) for c in merkle.FIELDS]))
    rows = merkle.manifest(docs, carry={"tampered": tampered})
    rows = rows.withColumn("folded_root", merkle.folded(F.coalesce("tampered", "leaf"), F.col("path")))
    return rows.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root",
                       F.sha2(merkle.proof(F.col("path")), 256).alias("proof_sha256"), "folded_root",
                       (F.col("folded_root") == F.col("root")).alias("verified"))


OP12_SQL = fr"""
WITH RECURSIVE {CRC_TABLE_SQL},
parts AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_crc("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS d
  FROM conversations, crc),
spoilt AS (
  SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN d = 1 THEN '' WHEN d = 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM parts, range(CASE WHEN d = 0 THEN 0 WHEN d = 3 THEN 2 ELSE 1 END) WHERE d <> 0),
flagged AS (
  SELECT *, left(role, 1) AS x,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
         right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS e
  FROM spoilt),
faults AS (
  SELECT *, CASE WHEN e = '' THEN 'blank'
                 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                 WHEN e NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         i > 1 AND lag(x) OVER (PARTITION BY conv_id ORDER BY i) || x NOT IN ('su', 'ua', 'au') AS illegal
  FROM flagged),
inserts(s, k, place, added) AS (VALUES
  (0, 0, 0, ''), (0, 1, 2, 'U'), (0, 2, 3, 'UA'), (1, 0, 1, ''), (1, 1, 2, 'U'), (1, 2, 3, 'UA'),
  (2, 0, 2, ''), (2, 1, 3, 'A'), (2, 2, 2, 'AU'), (3, 0, 3, ''), (3, 1, 2, 'U'), (3, 2, 3, 'UA')),
reads(place, x, s) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
padding AS (SELECT *, replace(replace(added, 'U', chr(10) || 'user:'), 'A', chr(10) || 'assistant:') AS lines
            FROM inserts),
edits AS (
  SELECT s, place AS s2, repeat('I', k) || 'D' AS op, 5 * k + 2 AS c, 'D' AS e, '' AS x, lines FROM padding
  UNION ALL SELECT p.s, r.s, repeat('I', k) || 'K', 5 * k, 'K', r.x, lines FROM padding p JOIN reads r USING (place)
  UNION ALL SELECT s, CASE WHEN place = 2 THEN 3 ELSE 2 END, repeat('I', k) || 'R', 5 * k + 1, 'R', '',
                   lines || chr(10) || CASE WHEN place = 2 THEN 'assistant:' ELSE 'user:' END FROM padding),
best AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS i, 0 AS s, {{'c': 0, 'a': '', 'r': ''}} AS b FROM conversations
  UNION ALL
  SELECT b.conv_id, b.i + 1, m.s2, min({{
           'c': b.b.c + m.c + CASE WHEN f.fault = 'truncated' AND m.e <> 'D' THEN 5 ELSE 0 END,
           'a': b.b.a || m.op,
           'r': b.b.r || m.lines || CASE m.e WHEN 'D' THEN '' WHEN 'R' THEN f.text
                                    ELSE chr(10) || f.role || ':' || f.text END}})
  FROM best b JOIN faults f ON f.conv_id IS NOT DISTINCT FROM b.conv_id AND f.i = b.i + 1
    JOIN edits m ON m.s = b.s AND (m.e = 'D' OR f.fault NOT IN ('blank', 'duplicate'))
                AND (m.e <> 'K' OR m.x = f.x)
  GROUP BY b.conv_id, b.i, m.s2),
lengths AS (
  SELECT conv_id, max(i) AS n, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps,
         count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
         count(*) FILTER (WHERE fault = 'truncated') AS truncated, count(*) FILTER (WHERE illegal) AS illegal
  FROM faults GROUP BY conv_id),
ended AS (
  SELECT b.conv_id, min({{'c': b.b.c + 5 * p.k, 'a': b.b.a || repeat('I', p.k), 'r': b.b.r || p.lines}}) AS b
  FROM best b LEFT JOIN lengths l ON l.conv_id IS NOT DISTINCT FROM b.conv_id JOIN padding p ON p.s = b.s
  WHERE b.i = coalesce(l.n, 0) AND p.place IN (0, 3) GROUP BY b.conv_id)
SELECT e.conv_id, coalesce(l.gaps, 0)::BIGINT AS gaps, coalesce(l.blank, 0)::BIGINT AS blank,
       coalesce(l.duplicate, 0)::BIGINT AS duplicate, coalesce(l.truncated, 0)::BIGINT AS truncated,
       coalesce(l.illegal, 0)::BIGINT AS illegal, e.b.c::BIGINT AS cost, e.b.a AS audit,
       sha256(substr(e.b.r, 2)) AS repaired_sha256
FROM ended e LEFT JOIN lengths l ON l.conv_id IS NOT DISTINCT FROM e.conv_id
"""


@query("op12_turns", OP12_SQL)
def op12_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    spoilt = turns.damaged(table(spark, sf_dir, "conversations"))
    return turns.repair(spoilt, gone=F.col("gone"))


@query("op13_secrets")
def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.spans_per_document(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex",
                        F.sha2("base", 256).alias("base_sha256"), "spans")
