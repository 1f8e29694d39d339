"""The registered queries of this subpackage, each over its whole table, and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmark.llm import contamination, dedup, divergence, interactions, language, minhash, mixing, pages, quality, secrets, sharding, similarity, toxicity
from quillmark.llm.words import crc_remainder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard_records(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op2_weighted_fair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix_words(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return out.select("doc_id", "size", "source_size", "target", "taken", "virtual_finish")


def op3_language_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_remainder(F.col("doc_id"), 4) == 2
    model = language.train(docs.where(~held_out), "doc_id", "lang", "text")
    return language.label_languages(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")
    out = contamination.contaminated_spans(docs, items).drop("text")
    return out.select("doc_id", "n_words", contamination.hit_words().alias("n_hit"), F.size("hit_items").cast("long").alias("n_items"), contamination.items_digest().alias("items_sha256"), contamination.is_contaminated().alias("contaminated"))


def op5_exact_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.exact_copies(table(spark, sf_dir, "documents"))


def op6_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract_pages(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = similarity.similarity_classes(table(spark, sf_dir, "documents"), shingle=4, percent=85)
    return out.select("doc_id", "n_shingles", F.col("component").alias("component_id"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    base = [r.kind for r in secrets.BASE_RULES]
    counts = [F.size(secrets.of_kinds(F.col("secrets"), [k])).cast("long").alias(f"n_{k}") for k in base]
    digest = F.sha2(secrets.joined_spans(secrets.of_kinds(F.col("secrets"), base)).cast("binary"), 256)
    return found.select("doc_id", *counts, digest.alias("base_sha256"), secrets.joined_spans(F.col("secrets")).alias("spans"))


def op9_subword_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = crc_remainder(F.col("doc_id"), 5) == 0
    model = toxicity.train(docs.where(~held_out), table(spark, sf_dir, "labels").where(~held_out), "doc_id", "text", "toxic")
    return toxicity.score_toxicity(docs, model).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_weak_label_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = quality.score_quality(docs, quality.train(docs))
    return out.select("doc_id", F.col("quality").alias("score"), (F.col("quality") >= 0.5).alias("kept"))


def op11_fast_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = minhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), shingle=2, percent=80)
    return out.select("doc_id", "n_shingles", F.col("component").alias("component_id"), "kept")


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for k, v in globals().items() if k.startswith("op") and callable(v)}


OP5_SQL = r"""
WITH plain AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS text FROM documents),
copies AS (SELECT text, min(doc_id) AS keep_id, count(*) AS group_size FROM plain GROUP BY text)
SELECT doc_id, keep_id, group_size, row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1 AS kept, sha256(text) AS text_sha256 FROM plain JOIN copies USING (text)
"""


def _op8_sql() -> str:
    rules = [*secrets.BASE_RULES, *secrets.MORE_RULES]
    quoted = lambda x: x.replace("'", "''")
    parts = []
    for rank, r in enumerate(rules):
        p = quoted(r.pattern)
        measure = f"length(regexp_extract(m[i], '{p}', {r.group}))" if r.group else "length(m[i])"
        parts.append(f"""SELECT doc_id, {rank} AS rank, '{r.kind}' AS kind, pos AS start, pos + length(m[i]) AS stop FROM (
            SELECT doc_id, m, i, (list_sum(list_transform(s[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0))::BIGINT AS pos
            FROM (SELECT doc_id, m, s, unnest(range(1, len(m) + 1)) AS i FROM (SELECT doc_id, regexp_extract_all(text, '{p}') AS m, regexp_split_to_array(text, '{p}') AS s FROM documents WHERE text IS NOT NULL)))
            WHERE {measure} >= {r.least}""")
    spans = "string_agg({}, ',' ORDER BY start, rank)".format("kind || ':' || start || ':' || stop")
    kinds = ", ".join(f"count(*) FILTER (WHERE kind = '{r.kind}') AS n_{r.kind}" for r in secrets.BASE_RULES)
    last = len(secrets.BASE_RULES)
    return f"""WITH hit AS ({" UNION ALL ".join(parts)})
        SELECT doc_id, {kinds}, sha256(coalesce({spans} FILTER (WHERE rank < {last}), '')) AS base_sha256, coalesce({spans}, '') AS spans
        FROM (SELECT doc_id FROM documents) LEFT JOIN hit USING (doc_id) GROUP BY doc_id"""


#: CRC-32 a byte at a time, from a table made of its fixed polynomial.
OP1_SQL = r"""
WITH tab AS (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce(list_concat([i::BIGINT], range(8)::BIGINT[]), lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v FROM range(256) r(i))),
sized AS (SELECT doc_id, (strlen(coalesce(text, '')) + 8)::BIGINT AS size,
    xor(list_reduce(list_concat([4294967295], list_transform(string_split(regexp_replace(hex(encode(coalesce(text, ''))), '(..)', '\1,', 'g'), ',')[:-2], lambda h: ('0x' || h)::BIGINT)), lambda a, b: xor(a >> 8, t[xor(a & 255, b) + 1])), 4294967295)::BIGINT AS text_crc32
    FROM documents, tab),
scores AS (SELECT doc_id, s, md5(doc_id || ':' || s) AS h FROM (SELECT DISTINCT doc_id FROM documents), range(25) r(s)),
best AS (SELECT doc_id, arg_max(s, substr(h, 1, 13)) FILTER (WHERE s < 24)::INT AS shard, arg_max(s, substr(h, 1, 13))::INT AS grown_shard FROM scores GROUP BY doc_id)
SELECT doc_id, size, text_crc32, 'key' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY substr(md5(concat_ws(':', doc_id, text_crc32, size)), 1, 13), doc_id, text_crc32, size) - 1 AS slot, grown_shard FROM sized JOIN best USING (doc_id)
"""

OP2_SQL = r"""
WITH measured AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size, md5(coalesce(text, '')) AS digest FROM documents),
numbered AS (SELECT *, row_number() OVER (PARTITION BY doc_id, source, digest) AS nth FROM measured),
placed AS (SELECT *, (('0x' || substr(md5(concat_ws(':', doc_id, digest, size, CASE WHEN nth > 1 THEN nth END)), 1, 13))::BIGINT + 0.5) / 4503599627370496 AS place FROM numbered),
queue AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY place, doc_id, digest ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM placed),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1]::DOUBLE AS weight FROM measured GROUP BY source),
steps AS (SELECT *, row_number() OVER f AS spot, sum(weight) OVER (f ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest,
    sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_ FROM sizes WINDOW f AS (ORDER BY 3 * source_size / weight, source NULLS LAST)),
level AS (SELECT spot AS first_free, left_ AS l, rest AS r FROM steps WHERE 3 * source_size >= left_ * weight / rest ORDER BY spot LIMIT 1),
targets AS (SELECT source, source_size, CASE WHEN spot < first_free THEN 3.0 * source_size ELSE l * weight / r END::DOUBLE AS target FROM steps, level),
docs AS (SELECT doc_id, queue.source, digest, nth, size::BIGINT AS size, before::BIGINT AS before, source_size, target FROM queue JOIN targets ON queue.source IS NOT DISTINCT FROM targets.source),
pieces AS (SELECT *, unnest(range(0, (size + 63) // 64)) AS piece FROM docs WHERE target > 0),
entries AS (SELECT *, least(size, (piece + 1) * 64) AS upto, (before + c * source_size + least(size, (piece + 1) * 64))::DOUBLE / target AS ends FROM pieces, (VALUES (0), (1), (2)) AS copies(c)),
served AS (SELECT *, upto - piece * 64 AS words, coalesce(sum(upto - piece * 64) OVER (ORDER BY ends, source NULLS LAST, doc_id, digest, nth, c, piece ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place FROM entries),
taken AS (SELECT doc_id, source, digest, nth, sum(greatest(0, least(words, (SELECT sum(size) FROM docs) - place)))::BIGINT AS taken FROM served GROUP BY ALL)
SELECT docs.doc_id, size, source_size, target, coalesce(taken, 0) AS taken, CASE WHEN target > 0 THEN (before + size)::DOUBLE / target END AS virtual_finish
FROM docs LEFT JOIN taken ON docs.doc_id = taken.doc_id AND docs.source IS NOT DISTINCT FROM taken.source AND docs.digest = taken.digest AND docs.nth = taken.nth
"""

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP4_SQL = rf"""
WITH doc AS (SELECT doc_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item AS (SELECT item_id, w, least(13, len(w)) AS n FROM (SELECT item_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark) WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, n, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS g FROM item),
occurs AS (SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS pos, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS g FROM doc, (SELECT DISTINCT n FROM win) WHERE len(w) >= n),
hit AS (SELECT DISTINCT doc_id, pos, n, item_id FROM occurs JOIN win USING (n, g)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS p FROM hit) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS name FROM hit) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN words USING (doc_id) LEFT JOIN named USING (doc_id)
"""



def _jaccard_sql(shingle: int, percent: int, kept: str = "") -> str:
    return rf"""
WITH RECURSIVE doc AS (SELECT doc_id, w, least({shingle}, len(w)) AS n FROM (SELECT doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents)),
shingle AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS s FROM doc WHERE n > 0),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM common JOIN size x ON a = x.doc_id JOIN size y ON b = y.doc_id WHERE 100 * c >= {percent} * (x.n + y.n - c)),
reach AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
found AS (SELECT doc_id, coalesce(size.n, 0) AS n_shingles, least(doc_id, coalesce((SELECT min(b) FROM reach WHERE a = doc_id), doc_id)) AS component_id FROM doc LEFT JOIN size USING (doc_id))
SELECT doc_id, n_shingles, component_id{kept} FROM found
"""


OP7_SQL = _jaccard_sql(4, 85)
OP11_SQL = _jaccard_sql(2, 80, ", doc_id = component_id AS kept")

OP12_SQL = r"""
WITH words AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
known AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
failed AS (SELECT words.doc_id, part,
    CASE WHEN len(w) < 200 THEN 1 ELSE 0 END AS a, CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 1 ELSE 0 END AS b,
    CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) THEN 1 ELSE 0 END AS c, CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 1 ELSE 0 END AS d,
    CASE WHEN coalesce(min(words.doc_id) OVER (PARTITION BY text) < words.doc_id, false) THEN 1 ELSE 0 END AS e, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
    FROM words LEFT JOIN known USING (doc_id)),
masks AS (SELECT part, [a, b, c, d, e] AS m, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failed GROUP BY ALL),
letter(l, i) AS (VALUES ('A', 1), ('B', 2), ('C', 3), ('D', 4), ('E', 5)),
orders AS (SELECT v.l || w.l || x.l || y.l || z.l AS filter_order, [v.i, w.i, x.i, y.i, z.i] AS spots FROM letter v, letter w, letter x, letter y, letter z WHERE len(list_distinct([v.i, w.i, x.i, y.i, z.i])) = 5),
steps AS (SELECT filter_order, step, spots[step] AS own, spots[1:step - 1] AS earlier FROM orders, (SELECT unnest(range(1, 6))::INT AS step)),
told AS (SELECT part, filter_order, step, own, n, good, toxic, m[own] = 1 AS fails, list_sum(m) AS fallen, len(list_filter(earlier, lambda i: m[i] = 1)) > 0 AS gone FROM masks, steps),
counts AS (SELECT part, filter_order, step, own, coalesce(sum(n) FILTER (WHERE NOT fails AND NOT gone), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (WHERE fails AND NOT gone), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (WHERE fails AND gone), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (WHERE fails AND fallen = 1), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (WHERE fails AND NOT gone), 0)::BIGINT AS good_lost, coalesce(sum(toxic) FILTER (WHERE fails AND NOT gone), 0)::BIGINT AS toxic_lost FROM told GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, sum(removed) OVER (PARTITION BY part, own)::BIGINT AS shapley FROM counts
"""

OP13_SQL = rf"""
WITH doc AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS i, regexp_extract_all({LOWER}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
word AS (SELECT lang, source, i, unnest(w) AS term FROM doc),
kept AS (SELECT lang, term, count(*) AS n FROM word GROUP BY lang, term HAVING count(DISTINCT i) >= 30),
grp AS (SELECT DISTINCT lang, source FROM doc),
cell AS (SELECT grp.lang, grp.source, kept.term, coalesce(c.n, 0) AS n FROM grp JOIN kept ON grp.lang = kept.lang LEFT JOIN (SELECT lang, source, term, count(*) AS n FROM word GROUP BY ALL) c ON c.lang = grp.lang AND c.source = grp.source AND c.term = kept.term),
p AS (SELECT lang, source, term, n, 1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER g + 5 * count(*) OVER g) AS p FROM cell WINDOW g AS (PARTITION BY lang, source)),
q AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER g + 5 * count(*) OVER g) AS q FROM kept WINDOW g AS (PARTITION BY lang)),
pair AS (SELECT a.lang, a.source, b.source AS item, coalesce((SELECT sum(abs(x.p - y.p)) FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0)::BIGINT AS value FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source),
told AS (SELECT p.lang, source, p.term AS item, (p - q)::BIGINT AS value FROM p JOIN q ON p.lang = q.lang AND p.term = q.term WHERE n > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, value, (row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item))::INT AS rank FROM pair
UNION ALL SELECT * FROM (SELECT lang, source, 'term' AS part, item, value, (row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item))::INT AS rank FROM told) WHERE rank <= 50
"""


def oracle_sql() -> dict[str, str]:
    more = {"op11_fast_similarity": OP11_SQL, "op12_filter_audit": OP12_SQL, "op13_source_divergence": OP13_SQL}
    return more | {"op1_rendezvous_shards": OP1_SQL, "op2_weighted_fair_mix": OP2_SQL, "op4_decontaminate": OP4_SQL, "op7_jaccard_join": OP7_SQL, "op5_exact_copies": OP5_SQL, "op8_secret_scan": _op8_sql()}
