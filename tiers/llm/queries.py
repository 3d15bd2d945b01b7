"""The registered queries of the operators, with their production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiers.llm import (decontaminate, divergence, licenses, quality, runs, sentencepiece, sharding, simhash, substring,
                       token_counts, toxicity, url_lists, warc)
from tiers.llm.frame import DOCUMENT_COLUMNS, read, take
from tiers.session import shared_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


#: Bytes of a shard.
SHARD_BYTES = 1 << 20


@register("op1_sharding")
def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents are written by shard; every column comes from the shards as read back."""
    docs = take(read(spark, sf_dir, "documents"), *DOCUMENT_COLUMNS)
    path = shared_dir(spark, "llm", "shards")
    sharded = sharding.shard(docs, ["doc_id"], SHARD_BYTES, F.octet_length("text"))
    sharding.write_shards(sharded, path)
    done = sharding.read_shards(spark, path, schema=sharded.schema).select(
        "doc_id", "shard", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"))
    sizes = done.groupBy("shard").agg(F.sum("n_bytes").alias("shard_bytes"), F.count("*").alias("shard_rows"))
    return (done.join(sizes, "shard").withColumn("depth", F.length("shard"))
            .select("shard", "doc_id", "n_bytes", "shard_bytes", "shard_rows", "depth"))


SQL["op1_sharding"] = f"""
WITH r AS (
  SELECT doc_id, coalesce(strlen(text), 0) AS n_bytes,
         lpad(bin(('0x' || substr(md5('{{"doc_id":' || coalesce(doc_id::VARCHAR, 'null') || '}}'), 1, 15))::BIGINT), 60, '0') AS bits
  FROM documents),
n AS (
  SELECT d, substr(bits, 1, d) AS node, sum(n_bytes)::BIGINT AS bytes, count(*) AS n
  FROM r, range(0, 61) t(d) GROUP BY ALL),
fit AS (SELECT * FROM n WHERE bytes <= {SHARD_BYTES} OR n = 1),
leaf AS (
  SELECT r.doc_id, r.n_bytes, r.bits, min(d) AS depth
  FROM r JOIN fit ON substr(r.bits, 1, fit.d) = fit.node AND length(fit.node) = fit.d GROUP BY ALL)
SELECT doc_id, n_bytes, node AS shard, bytes AS shard_bytes, n AS shard_rows, depth::INTEGER AS depth
FROM leaf JOIN fit ON fit.d = leaf.depth AND fit.node = substr(leaf.bits, 1, leaf.depth)
"""


@register("op2_sentencepiece")
def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece.encode(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), k=2,
                                check=True)


@register("op3_license_scan")
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents"))


@register("op4_simhash")
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@register("op5_toxicity")
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    labels = read(spark, sf_dir, "labels").filter(~toxicity.held_out(F.col("doc_id")))
    model = toxicity.fit(docs, labels)
    scored = docs.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"),
                         toxicity.score(spark, model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@register("op6_decontamination")
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.overlaps(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).drop("text_key")


def _fetched(page_id: str) -> str:
    """When a page counts as fetched: a second of January 2024 that follows from its id (SQL of both engines)."""
    return f"(({page_id} * 7919) % 2592000)"


@register("op7_url_lists")
def op7_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as captures; every event is a dated list entry about the host, a domain above
    it or the address of the page that its user number names."""
    pages = read(spark, sf_dir, "pages").withColumn(
        "fetched_at", F.expr(f"timestamp_seconds(1704067200 + {_fetched('page_id')})"))
    kind = F.pmod("event_id", F.lit(3))
    domains = url_lists.domains(url_lists.host(F.col("url")))
    events = (read(spark, sf_dir, "events").join(pages.select("page_id", "url"), F.col("user_id") == F.col("page_id"))
              .select(F.col("event_type").alias("list"), F.when(kind == 2, "url").otherwise("domain").alias("kind"),
                      F.when(kind == 0, url_lists.host(F.col("url"))).when(kind == 1, F.element_at(domains, -1))
                      .otherwise(url_lists.address(F.col("url"))).alias("pattern"),
                      F.col("ts").cast("timestamp").alias("at"), F.when(F.col("value") < 50, "add").otherwise("remove").alias("action")))
    return (url_lists.judge(pages.select(F.col("page_id").alias("capture_id"), "url", "fetched_at"), events)
            .withColumnRenamed("capture_id", "page_id")
            .withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("fetched_at", "active_since")}))


_HOST = ("coalesce(regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]*)', 1)), "
         "'[.]+$', ''), '')")
SQL["op7_url_lists"] = f"""
WITH p AS (
  SELECT page_id, url, make_timestamp((1704067200 + {_fetched('page_id')}) * 1000000) AS fetched_at, {_HOST} AS host FROM pages),
q AS (
  SELECT *, CASE WHEN host = '' THEN '' ELSE host || regexp_replace(regexp_extract(
           url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/+$', '') END AS address,
         CASE WHEN host = '' THEN [] ELSE list_transform(range(1, greatest(1, len(string_split(host, '.')) - 1) + 1),
           lambda i: array_to_string(list_slice(string_split(host, '.'), i, len(string_split(host, '.'))), '.')) END AS domains FROM p),
e AS (
  SELECT event_type AS list, CASE WHEN event_id % 3 = 2 THEN 'url' ELSE 'domain' END AS kind,
         CASE event_id % 3 WHEN 0 THEN host WHEN 1 THEN domains[-1] ELSE address END AS pattern,
         ts AS at_time, coalesce(value < 50, false) AS added
  FROM events JOIN q ON user_id = page_id),
s AS (
  SELECT list, kind, pattern, at_time, bool_and(added) AS added,
         lead(at_time) OVER (PARTITION BY list, kind, pattern ORDER BY at_time) AS until
  FROM e WHERE list IS NOT NULL AND pattern IS NOT NULL AND at_time IS NOT NULL GROUP BY list, kind, pattern, at_time),
hits AS (
  SELECT page_id, s.list, s.pattern, s.at_time
  FROM q JOIN s ON s.added AND q.fetched_at >= s.at_time AND (s.until IS NULL OR q.fetched_at < s.until)
   AND ((s.kind = 'url' AND q.address = s.pattern) OR (s.kind = 'domain' AND list_contains(q.domains, s.pattern)))
  WHERE q.host <> ''),
best AS (
  SELECT page_id, count(*) AS n_active, string_agg(DISTINCT list, ',' ORDER BY list) AS lists,
         arg_min(pattern, (-length(pattern), pattern)) AS pattern FROM hits GROUP BY page_id),
since AS (SELECT page_id, pattern, min(at_time) AS active_since FROM hits GROUP BY ALL)
SELECT q.page_id, q.url, q.fetched_at, q.host, coalesce(n_active, 0) AS n_active, coalesce(lists, '') AS lists,
       best.pattern, active_since, n_active IS NOT NULL AS blocked
FROM q LEFT JOIN best USING (page_id) LEFT JOIN since ON since.page_id = q.page_id AND since.pattern = best.pattern
"""


@register("op8_warc_derivatives")
def op8_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a stored response, and the records derived from it."""
    pages = read(spark, sf_dir, "pages").select(
        "page_id", warc.record_id(F.lit("response"), F.col("page_id").cast("string"), F.col("url")).alias("record_id"),
        F.col("url").alias("target_uri"),
        F.expr(f"date_format(timestamp_seconds(1704067200 + {_fetched('page_id')}), \"yyyy-MM-dd'T'HH:mm:ss'Z'\")").alias("date"),
        F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                 F.octet_length("html").cast("string")).alias("http_headers"), F.col("html").alias("payload"))
    return warc.derive(pages, key="page_id")


def _duck_id(names: str) -> str:
    h = f"md5(concat_ws('|', {names}))"
    return (f"'<urn:uuid:' || substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-3' || substr({h}, 14, 3) || '-8' || "
            f"substr({h}, 18, 3) || '-' || substr({h}, 21, 12) || '>'")


def _duck_digest(x: str) -> str:
    groups = " || ".join(f"to_base(('0x' || substr(sha1({x}), {i}, 5))::BIGINT, 32, 4)" for i in range(1, 41, 5))
    return f"'sha1:' || translate(lower({groups}), '0123456789abcdefghijklmnopqrstuv', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567')"


def _duck_clean(x: str) -> str:
    x = f"regexp_replace({x}, '{warc.TAG}', '', 'g')"
    code = ("CASE WHEN regexp_matches(p, '^[0-9]{1,7};') THEN regexp_extract(p, '^([0-9]{1,7});', 1)::INTEGER "
            "WHEN regexp_matches(p, '^[xX][0-9A-Fa-f]{1,6};') THEN ('0x' || regexp_extract(p, '^[xX]([0-9A-Fa-f]{1,6});', 1))::INTEGER END")
    x = (f"(SELECT string_agg(CASE WHEN i = 1 THEN p WHEN code IS NULL THEN '&#' || p ELSE "
         f"chr(CASE WHEN code = 0 OR code > 1114111 OR code BETWEEN 55296 AND 57343 THEN 65533 ELSE code END) || "
         f"regexp_replace(p, '^[xX]?[0-9A-Fa-f]+;', '') END, '' ORDER BY i) FROM (SELECT p, i, {code} AS code FROM "
         f"(SELECT unnest(string_split({x}, '&#')) AS p, generate_subscripts(string_split({x}, '&#'), 1) AS i)))")
    for name, char in warc.REFERENCES:
        char = char.replace("'", "''")
        x = f"replace({x}, '&{name};', '{char}')"
    x = f"regexp_replace({x}, '&amp;?', '&', 'g')"
    x = f"regexp_replace({x}, '[ \\t\\r\\f\\v\\x{{a0}}]+', ' ', 'g')"
    x = f"regexp_replace({x}, ' ?\\n[ \\n]*', chr(10), 'g')"
    return f"regexp_replace({x}, '^[ \\n]+|[ \\n]+\\z', '', 'g')"


SQL["op8_warc_derivatives"] = f"""
WITH r AS (
  SELECT page_id, {_duck_id("'response', page_id::VARCHAR, url")} AS refers_to, url AS target_uri,
         strftime(make_timestamp((1704067200 + {_fetched('page_id')}) * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS date,
         'HTTP/1.1 200 OK' || chr(13) || chr(10) || 'Content-Type: text/html; charset=utf-8' || chr(13) || chr(10) ||
           'Content-Length: ' || strlen(html) AS source_headers, coalesce(html, '') AS payload FROM pages),
v AS (SELECT *, regexp_replace(payload, '{warc.HIDDEN}', '', 'g') AS shown FROM r),
u AS (
  SELECT *, replace({_duck_clean(f"regexp_extract(shown, '{warc.TITLE}', 1)")}, chr(10), ' ') AS title,
         {_duck_clean(f"regexp_replace(shown, '{warc.BLOCK}', chr(10), 'g')")} AS txt,
         list_transform(regexp_extract_all(shown, '{warc.LINK.replace("'", "''")}', 1),
                        lambda x: 'outlink: ' || regexp_replace(x, '&amp;?', '&', 'g') || chr(13) || chr(10)) AS links FROM v),
b AS (
  SELECT *, 'metadata' AS record_type, 'application/warc-fields' AS content_type,
         'title: ' || title || chr(13) || chr(10) || array_to_string(links, '') AS block FROM u
  UNION ALL SELECT *, 'conversion', 'text/plain', txt FROM u)
SELECT page_id, record_type, {_duck_id("refers_to, record_type")} AS record_id, refers_to, target_uri, date, content_type,
       strlen(block)::BIGINT AS content_length, {_duck_digest("block")} AS block_digest, source_headers,
       {_duck_digest("payload")} AS source_digest, block FROM b
"""


@register("op9_token_counts")
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts counted by an earlier call over the same shared folder are not encoded again."""
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    counts = token_counts.count_tokens(read(spark, sf_dir, "documents"), tokenizer,
                                       token_counts.shared_cache(spark, tokenizer))
    return counts.withColumn("over_limit", F.col("n_tokens") > 512)


@register("op10_quality_rules")
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    rules = quality.fit(docs, read(spark, sf_dir, "labels"))
    return quality.judge(take(docs, "doc_id", "text"), rules).select("doc_id", "verdict.*")


def _periodic(docs: DataFrame) -> DataFrame:
    """Documents whose id's checksum ends in 0 become periodic from a word on, as the query's contract fixes it."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = docs.select("doc_id", "text", h.alias("h"), F.floor(h / 10).alias("g"),
                        F.when(h % 10 == 0, F.expr("filter(split(text, '[\\\\x20\\\\x09-\\\\x0D]+'), x -> x != '')")).alias("words"))
    placed = words.withColumns({"n": F.size("words").cast("bigint")}).withColumn(
        "a", F.when(F.col("n") > 0, F.col("g") % F.col("n"))).withColumn(
        "p", F.expr("1 + (n - a) div (3 + g % 8)"))
    again = F.expr("transform(words, (x, i) -> if(i < a, x, words[cast(a + (i - a) % p as int)]))")
    return placed.select("doc_id", F.when(F.col("n") > 0, F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


@register("op13_periodic_runs")
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.detect(_periodic(read(spark, sf_dir, "documents"))).withColumn("best", runs.longest(F.col("runs")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"))


@register("op12_source_divergence")
def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    audit = divergence.Audit(read(spark, sf_dir, "documents"))
    return (audit.pairs().withColumn("part", F.lit("pair")).unionByName(audit.terms().withColumn("part", F.lit("term")))
            .select("lang", "source", "part", "item", "value", "rank"))


SQL["op12_source_divergence"] = r"""
WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text,
                  row_number() OVER () AS id FROM documents),
w AS (SELECT lang, source, id, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
k AS (SELECT lang, term, count(*) AS n FROM w GROUP BY ALL HAVING count(DISTINCT id) >= 3),
c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN k USING (lang, term) GROUP BY ALL),
l AS (SELECT lang, count(*) AS v, sum(n) AS total FROM k GROUP BY ALL),
g AS (SELECT lang, source, coalesce((SELECT sum(n) FROM c WHERE c.lang = x.lang AND c.source = x.source), 0) AS total
      FROM (SELECT DISTINCT lang, source FROM d) x),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
             (1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 1) // (g.total + l.v))::HUGEINT AS p,
             (1 + 1000000000::HUGEINT * (k.n + 1) // (l.total + l.v))::HUGEINT AS q
      FROM g JOIN l USING (lang) JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
s AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value FROM p WHERE n > 0 AND p > q)
SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms) QUALIFY part = 'pair' OR rank <= 200
"""


@register("op11_substring_dedup")
def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.remove_repeats(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept"), 256).alias("kept_sha256"))


SQL["op11_substring_dedup"] = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words, row_number() OVER () AS id FROM documents),
win AS (SELECT id, doc_id, i, md5(array_to_string(words[i:i + {substring.WINDOW - 1}], ' ')) AS h
        FROM (SELECT *, unnest(range(1, len(words) - {substring.WINDOW - 2})) AS i FROM d WHERE doc_id IS NOT NULL)),
low AS (SELECT h, min(doc_id) AS owner FROM win GROUP BY h),
dup AS (SELECT id, i FROM win JOIN low USING (h) WHERE doc_id > owner),
word AS (SELECT id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM d),
seen AS (SELECT id, word, i, coalesce(max(dup.i) OVER (PARTITION BY id ORDER BY i) > i - {substring.WINDOW}, false) AS gone
         FROM word LEFT JOIN dup USING (id, i)),
left_ AS (SELECT id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept FROM seen GROUP BY id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN left_ USING (id)
"""
