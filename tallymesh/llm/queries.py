"""One query per operator over its whole table, and SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TOKENIZER = "word_bpe_49k.json"
BYTE_TOKENIZER = "byte_bpe_50k.json"
RULES = "SELECT * FROM VALUES ('com/en/','block'),('example.com/en/7','allow'),('net/de/','block'),('example.net/de/8','allow'),('org/es/','block') AS t(rule, verdict)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import score_documents

    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .urlrules import judge

    return judge(table(spark, sf_dir, "pages"), spark.sql(RULES))


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .templates import extract

    return extract(table(spark, sf_dir, "pages"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), shingle=3, tau=2)


def op5_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .spans import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents"), window=35)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    return pack(table(spark, sf_dir, "documents"), tokenizer_path(), capacity=2048, end_id=1)


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontam import find_leaks

    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import warc_store

    return warc_store.index(*warc_store.write(table(spark, sf_dir, "pages"), least=0))


def op9_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .media import store_and_read

    return store_and_read(table(spark, sf_dir, "documents"))


def op10_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lines import line_report

    return line_report(table(spark, sf_dir, "documents"))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .divergence import audit

    return audit(table(spark, sf_dir, "documents"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .merkle import verify_documents

    return verify_documents(table(spark, sf_dir, "documents"))


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bpe import round_trip

    return round_trip(table(spark, sf_dir, "documents"), tokenizer_path(BYTE_TOKENIZER))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_quality, op2_url_rules, op3_html_text, op4_simhash, op5_spans, op6_packing, op7_decontaminate, op8_warc, op9_media, op10_lines, op11_divergence, op12_merkle, op13_bpe, pipeline)}

_OP2 = r"""
WITH r(rule, verdict) AS (VALUES ('com/en/','block'),('example.com/en/7','allow'),('net/de/','block'),('example.net/de/8','allow'),('org/es/','block')),
rules AS (SELECT rule, verdict, substr(rule, 1, instr(rule, '/') - 1) AS rh, substr(rule, instr(rule, '/')) AS rp FROM r),
cut AS (SELECT page_id, row_number() OVER () AS id, regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1) AS h, regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
p AS (SELECT page_id, id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM cut),
fit AS (SELECT p.id, max_by(rule, length(rule) * 1000 + length(rh)) AS rule, max_by(verdict, length(rule) * 1000 + length(rh)) AS verdict
        FROM p JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY p.id)
SELECT page_id, host, path, fit.rule AS rule, coalesce(fit.verdict, 'allow') AS verdict FROM p LEFT JOIN fit USING (id)
"""

_OP8 = r"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
d AS (SELECT page_id, octet_length(body) AS payload_bytes, sha1(body) AS h, min(page_id) OVER (PARTITION BY body) AS first FROM p),
b AS (SELECT *, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
       1 + CAST((CAST('0x' || substr(h, CAST((i * 5) // 4 + 1 AS BIGINT), 2) || '0' AS BIGINT) >> (12 - 5 - CAST((i * 5) % 4 AS INT))) & 31 AS BIGINT), 1)), '') AS payload_digest
      FROM (SELECT *, h || '00' AS hh FROM d))
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to FROM b
"""

_OP5 = r"""
WITH d AS (SELECT row_number() OVER () AS id, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
t AS (SELECT id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
win AS (SELECT t.id, t.p, array_to_string(d.w[t.p : t.p + 34], ' ') AS win FROM t JOIN d USING (id) WHERE t.p <= len(d.w) - 34),
twice AS (SELECT win FROM win GROUP BY win HAVING count(*) > 1),
hit AS (SELECT id, p FROM win SEMI JOIN twice USING (win)),
gone AS (SELECT t.id, t.p, t.word, max(hit.p) OVER (PARTITION BY t.id ORDER BY t.p ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) IS NOT NULL AS gone FROM t LEFT JOIN hit ON t.id = hit.id AND t.p = hit.p),
per AS (SELECT id, count(*) FILTER (gone) AS n, string_agg(word, ' ' ORDER BY p) FILTER (NOT gone) AS kept FROM gone GROUP BY id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN per USING (id)
"""

_OP7 = r"""
WITH d AS (SELECT row_number() OVER () AS id, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id::VARCHAR AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
spot AS (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS p FROM b WHERE len(w) > 0),
item AS (SELECT DISTINCT item_id, n, array_to_string(w[p : p + n - 1], ' ') AS win FROM spot),
place AS (SELECT d.id, s.n, unnest(range(1, len(d.w) - s.n + 2)) AS p FROM d, (SELECT DISTINCT n FROM item) s WHERE len(d.w) >= s.n),
hit AS (SELECT place.id, place.p, place.n, item.item_id FROM place JOIN d USING (id) JOIN item ON item.n = place.n AND item.win = array_to_string(d.w[place.p : place.p + place.n - 1], ' ')),
word AS (SELECT id, count(DISTINCT q) AS n_hit FROM (SELECT id, unnest(range(p, p + n)) AS q FROM hit) GROUP BY id),
named AS (SELECT id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT id, item_id FROM hit WHERE item_id IS NOT NULL) GROUP BY id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN word USING (id) LEFT JOIN named USING (id)
"""

_OP11 = r"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT id, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT id) >= 30),
size AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
grp AS (SELECT DISTINCT lang, source FROM d),
own AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
sums AS (SELECT lang, source, sum(n) AS total FROM own GROUP BY lang, source),
cell AS (SELECT g.lang, g.source, k.term, coalesce(o.n, 0) AS n,
                (1 + 1000000000 * (coalesce(o.n, 0) + 5)::HUGEINT // (coalesce(s.total, 0) + 5 * z.v)::HUGEINT)::BIGINT AS p,
                (1 + 1000000000 * (k.n + 5)::HUGEINT // (z.total + 5 * z.v)::HUGEINT)::BIGINT AS q
         FROM grp g JOIN kept k USING (lang) JOIN size z USING (lang) LEFT JOIN own o ON o.lang = g.lang AND o.source = g.source AND o.term = k.term LEFT JOIN sums s ON s.lang = g.lang AND s.source = g.source),
gap AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM cell a JOIN cell b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
found AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(gap.value, 0)::BIGINT AS value
          FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN gap ON gap.lang = a.lang AND gap.source = a.source AND gap.item = b.source
          UNION ALL SELECT lang, source, 'term', term, p - q FROM cell WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS r FROM found)
SELECT lang, source, part, item, value, r::INTEGER AS rank FROM ranked WHERE part = 'pair' OR r <= 50
"""


def _leaf_sql(n_chars: str) -> str:
    def said(c: str) -> str:
        return f"coalesce(octet_length(encode(({c})::VARCHAR)) || ':' || ({c})::VARCHAR, '-')"

    return f"sha256({' || '.join(map(said, ('doc_id', 'source', 'lang', n_chars, 'text')))})"


#: Unsigned CRC-32 of doc_id in decimal: for each character, eight shifts.
_CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
           lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda c, z: xor(c >> 1, 3988292384 * (c & 1)))), 4294967295)"""

_OP12 = f"""
WITH RECURSIVE leaf AS (SELECT doc_id, lang, {_leaf_sql('n_chars')} AS leaf, CASE WHEN coalesce({_CRC32} % 7 = 0, false) THEN {_leaf_sql('n_chars::HUGEINT + 1')} END AS forged FROM documents),
placed AS (SELECT *, row_number() OVER () AS id, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM leaf),
node(lang, k, pos, h, n) AS (
  SELECT lang, 0, pos, leaf, n FROM placed
  UNION ALL SELECT lang, k + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2 FROM node WHERE n > 1 GROUP BY lang, k, pos // 2, n),
sub AS (SELECT lang, k AS height, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM node WHERE n = 1),
top(k, pos, h, n) AS (
  SELECT 0, pos, subroot, n FROM sub
  UNION ALL SELECT k + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2 FROM top WHERE n > 1 GROUP BY k, pos // 2, n),
level AS (SELECT DISTINCT lang, k FROM node WHERE n > 1),
uplevel AS (SELECT DISTINCT k FROM top WHERE n > 1),
step AS (
  SELECT p.id, l.k, (p.pos >> l.k) & 1 AS right_of, s.h FROM placed p JOIN level l ON l.lang IS NOT DISTINCT FROM p.lang
  LEFT JOIN node s ON s.lang IS NOT DISTINCT FROM p.lang AND s.k = l.k AND s.pos = xor(p.pos >> l.k, 1)
  UNION ALL SELECT p.id, u.height + l.k, (u.pos >> l.k) & 1, s.h FROM placed p JOIN sub u ON u.lang IS NOT DISTINCT FROM p.lang CROSS JOIN uplevel l
  LEFT JOIN top s ON s.k = l.k AND s.pos = xor(u.pos >> l.k, 1)),
fold(id, k, h) AS (
  SELECT id, 0, coalesce(forged, leaf) FROM placed
  UNION ALL SELECT f.id, f.k + 1, sha256(CASE WHEN s.right_of = 1 THEN s.h || f.h ELSE f.h || coalesce(s.h, '') END) FROM fold f JOIN step s ON s.id = f.id AND s.k = f.k),
last AS (SELECT id, max_by(h, k) AS folded FROM fold GROUP BY id),
proof AS (SELECT id, sha256(coalesce(string_agg(h, '' ORDER BY k), '')) AS proof FROM step GROUP BY id)
SELECT p.doc_id, p.leaf, sub.subroot, r.h AS root, coalesce(proof.proof, sha256('')) AS proof_sha256, last.folded AS folded_root, last.folded = r.h AS verified
FROM placed p JOIN sub ON sub.lang IS NOT DISTINCT FROM p.lang JOIN last USING (id) LEFT JOIN proof USING (id) CROSS JOIN (SELECT h FROM top WHERE n = 1) r
"""

ORACLES = {"op2_url_rules": _OP2, "op5_spans": _OP5, "op7_decontaminate": _OP7, "op8_warc": _OP8, "op11_divergence": _OP11, "op12_merkle": _OP12}
