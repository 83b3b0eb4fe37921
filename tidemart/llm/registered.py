"""Registered queries of the training-data operators, with reference SQL where SQL can express them."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemart.llm import copies, decontam, html, merkle, mixing, near, ppm, quality, repeats, secrets, urls, warc, whitening
from tidemart.sources.scratch import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


URL_RULES = (
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"), ("block", "com", "/de/"),
)

_HOST = "translate(regexp_extract(after, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(rf"""
WITH RECURSIVE parts AS (
  SELECT page_id, url, html, coalesce(regexp_extract(url, '(?s)^.*?://(.*)$', 1), '') AS after FROM pages
), cut AS (
  SELECT page_id, url, html, coalesce({_HOST}, '') AS host,
    coalesce(regexp_extract(after, '^[^/?#]*([^?#]*)', 1), '') AS path,
    regexp_extract(after, '^[^/?#]*[^?#]*\?([^#]*)', 1) AS q
  FROM parts
), keyed AS (
  SELECT *, row_number() OVER () AS rn,
    CASE WHEN host <> '' THEN
      regexp_replace(host, '^www[.]', '')
      || regexp_replace(regexp_replace(path, '/index[.]html?$', '/', 'g'), '/+$', '')
      || '?' || coalesce(array_to_string(list_sort(list_filter(string_split(q, '&'),
         lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|ref|fbclid|gclid)(=|$)'))), '&'), '') END AS k
  FROM cut
), rules(verdict, h, p) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
         ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), fits AS (
  SELECT rn, h || p AS rule, verdict, row_number() OVER (PARTITION BY rn ORDER BY length(h || p) DESC) AS place
  FROM keyed JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
), judged AS (
  SELECT keyed.*, f.rule, f.verdict FROM keyed LEFT JOIN (SELECT * FROM fits WHERE place = 1) f USING (rn)
), inherited AS (
  SELECT k, max(verdict) AS top, min(verdict) AS low FROM judged WHERE verdict IS NOT NULL GROUP BY k
)
SELECT page_id, host, path, rule,
  coalesce(verdict, CASE WHEN top = 'block' AND low = 'block' THEN 'block' END, 'allow') AS verdict
FROM judged LEFT JOIN inherited USING (k)
""")
def op3_url_filters(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages")
    found = urls.verdicts(pages.select("page_id", "url"), URL_RULES, urls.link_edges(pages))
    return found.select("page_id", "host", "path", "rule", "verdict")


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


@query(rf"""
WITH w AS (
  SELECT row_number() OVER () AS rn, doc_id, coalesce(text, '') AS t, {_WORDS} AS ws FROM documents
), windows AS (
  SELECT rn, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
  FROM (SELECT rn, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)
), twice AS (
  SELECT rn, i FROM (SELECT rn, i, count(*) OVER (PARTITION BY rn, g) AS n FROM windows) WHERE n > 1
), repeats AS (
  SELECT rn, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) AS offsets(k) GROUP BY rn
), m AS (
  SELECT rn, doc_id, len(ws) AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS word_chars,
    length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols,
    length(t) - length(translate(t, '!', '')) AS n_bangs,
    length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')) AS n_capitals,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM w
), f AS (
  SELECT m.*, len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(r.n, 0) AS n_repeat_words
  FROM m LEFT JOIN repeats r USING (rn)
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 100 * n_symbols > 10 * n_words
    OR 100 * n_dup_lines > 40 * n_lines OR 100 * n_capitals > 30 * word_chars OR 100 * n_bangs > 20 * n_words
    OR word_chars > 15 * n_words) AS kept,
  CAST((n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT + 4 * (100 * n_symbols > 10 * n_words)::INT
    + 8 * (100 * n_dup_lines > 40 * n_lines)::INT + 16 * (100 * n_capitals > 30 * word_chars)::INT
    + 32 * (100 * n_bangs > 20 * n_words)::INT + 64 * (word_chars > 15 * n_words)::INT AS BIGINT) AS failed_bits
FROM f
""")
def op10_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    rows = quality.ledger(table(spark, sf, "documents"))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~quality.passes("base")).alias("base_failed"), quality.passes("v2").alias("kept"), "failed_bits",
    )


_LOWER = "translate({t}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TOKENS = r"regexp_extract_all(" + _LOWER.format(t="coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query(rf"""
WITH d AS (SELECT row_number() OVER () AS rn, doc_id, {_TOKENS} AS ws FROM documents),
b AS (SELECT item_id, ws, least(10, len(ws)) AS n FROM (SELECT item_id, {_TOKENS} AS ws FROM benchmark) WHERE len(ws) > 0),
grams AS (
  SELECT DISTINCT item_id, n, array_to_string(ws[i:i + n - 1], ' ') AS g
  FROM (SELECT item_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM b)
), lengths AS (SELECT DISTINCT n FROM grams),
windows AS (
  SELECT rn, n, i, array_to_string(ws[i:i + n - 1], ' ') AS g
  FROM (SELECT rn, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, lengths WHERE len(ws) >= n)
), hits AS (SELECT rn, i, windows.n, item_id FROM windows JOIN grams ON windows.n = grams.n AND windows.g = grams.g),
covered AS (
  SELECT rn, count(DISTINCT place) AS n_hit
  FROM (SELECT rn, unnest(range(i, i + n)) AS place FROM (SELECT DISTINCT rn, i, n FROM hits)) GROUP BY rn
), items AS (
  SELECT rn, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
  FROM (SELECT DISTINCT rn, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY rn
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (rn) LEFT JOIN items USING (rn)
""")
def op9_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    found = decontam.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


@query(rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(CAST(doc_id AS VARCHAR), '') AS tie, CAST(len({_WORDS}) AS BIGINT) AS size,
    coalesce(length(text) - length(translate(text, '#*$%&|<>!{{}}[]~^', '')), 0) AS noise
  FROM documents
), k AS (
  SELECT *, -ln((CAST(('0x' || substr(md5(tie), 1, 13)) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE)
    / (CAST(size + 1 AS DOUBLE) / CAST(size + 1 + 10 * noise AS DOUBLE)) AS key
  FROM d
), s AS (SELECT source, CAST(sum(size) AS HUGEINT) AS source_size FROM d GROUP BY source),
r AS (
  SELECT *, 3 * source_size AS full_size,
    [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::HUGEINT AS w
  FROM s
), filling AS (
  SELECT *, sum(source_size) OVER () AS total,
    coalesce(sum(full_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS given,
    sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_w
  FROM r WINDOW o AS (ORDER BY CAST(full_size AS DOUBLE) / w, source NULLS LAST)
), capped AS (SELECT *, full_size * open_w <= w * (total - given) AS full_up FROM filling),
goal AS (
  SELECT source, source_size, CASE WHEN full_up THEN CAST(full_size AS DOUBLE)
    ELSE CAST(w * (total - coalesce(sum(CASE WHEN full_up THEN full_size END) OVER (), 0)) AS DOUBLE)
      / CAST(sum(CASE WHEN NOT full_up THEN w END) OVER () AS DOUBLE) END AS target
  FROM capped
), plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / CAST(source_size AS DOUBLE)) AS BIGINT) ELSE 0 END AS epochs
  FROM goal
), budget AS (
  SELECT *, greatest(CAST(round(target) AS BIGINT) - epochs * CAST(source_size AS BIGINT), 0) AS words_left FROM plan
), ordered AS (
  SELECT k.doc_id, k.size, b.source_size, b.target, b.epochs, b.words_left,
    coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.tie, k.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used
  FROM k JOIN budget b ON k.source IS NOT DISTINCT FROM b.source
)
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target,
  CAST(epochs * size + greatest(least(size, words_left - used), 0) AS BIGINT) AS taken
FROM ordered
""")
def op6_mixing(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


@query()
def op1_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    return html.extract(table(spark, sf, "pages"))


@query(r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS hex FROM pages
), d AS (
  SELECT page_id, octet_length(encode(h)) AS payload_bytes, array_to_string(list_transform(range(8), lambda i:
    array_to_string(list_transform([15, 10, 5, 0], lambda s:
      substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((CAST('0x' || substr(hex, 5 * i + 1, 5) AS BIGINT) >> s) & 31) + 1, 1)), '')
    ), '') AS payload_digest
  FROM p
), g AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM g
""")
def op7_warc(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_archives(table(spark, sf, "pages"), path)
    found = warc.read_archives(spark, path)
    lost = F.raise_error(F.concat(F.lit("unreadable bytes in a new archive: "), F.col("gap").cast("string"))).cast("boolean")
    found = found.where(F.when(F.col("gap").isNotNull(), lost).otherwise(True))
    return found.select(
        warc.page_id(F.col("record_id")).alias("page_id"), "payload_bytes",
        F.regexp_replace("payload_digest", "^sha1:", "").alias("payload_digest"), "record_type",
        warc.page_id(F.col("refers_to")).alias("refers_to"),
    )


@query()
def op8_secret_scans(spark: SparkSession, sf: str) -> DataFrame:
    return secrets.scan(table(spark, sf, "documents"))


@query(rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format(t="coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 3], ' ') AS shingle
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 2))) AS i FROM d WHERE len(ws) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id < y.doc_id
  GROUP BY 1, 2
), links AS (
  SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)
), both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (
  SELECT doc_id, doc_id AS other FROM d UNION SELECT r.doc_id, w.b FROM reached r JOIN both_ways w ON r.other = w.a
), component AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d JOIN component USING (doc_id) LEFT JOIN n USING (doc_id)
""")
def op4_minhash_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return near.groups(table(spark, sf, "documents"), size=4)


@query()
def op5_lm_scoring(spark: SparkSession, sf: str) -> DataFrame:
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 1
    return ppm.scores(table(spark, sf, "documents"), held_out)


@query("""
WITH d AS (SELECT row_number() OVER () AS rn, doc_id, hex(encode(coalesce(text, ''))) AS hx FROM documents),
starts AS (
  SELECT rn, i, md5(substr(hx, 2 * i + 1, 800)) AS h
  FROM (SELECT rn, hx, unnest(range(0, length(hx) // 2 - 399)) AS i FROM d WHERE length(hx) >= 800)
), repeated AS (
  SELECT rn, i FROM starts SEMI JOIN (SELECT h FROM starts GROUP BY h HAVING count(*) > 1) USING (h)
), runs AS (
  SELECT rn, i, sum(CASE WHEN i > before + 400 OR before IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY rn ORDER BY i) AS run
  FROM (SELECT rn, i, lag(i) OVER (PARTITION BY rn ORDER BY i) AS before FROM repeated)
), spans AS (SELECT rn, min(i) AS low, max(i) + 400 AS high FROM runs GROUP BY rn, run),
pieces AS (SELECT rn, low, high, coalesce(lag(high) OVER (PARTITION BY rn ORDER BY low), 0) AS since FROM spans),
kept AS (
  SELECT rn, count(*) AS n_spans, sum(high - low) AS n_removed,
    string_agg(substr(hx, 2 * since + 1, 2 * (low - since)), '' ORDER BY low) || substr(any_value(hx), 2 * max(high) + 1) AS rest
  FROM pieces JOIN d USING (rn) GROUP BY rn
)
SELECT doc_id, CAST(length(hx) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(rest, hx))) AS kept_sha256
FROM d LEFT JOIN kept USING (rn)
""")
def op2_suffix_array_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return repeats.without_repeats(table(spark, sf, "documents")).drop("kept")


_PART = "CASE WHEN {v} IS NULL THEN '-' ELSE octet_length(encode(CAST({v} AS VARCHAR))) || ':' || {v} END"
_LEAF = "sha256(" + " || ".join(_PART.format(v=c) for c in ("doc_id", "source", "lang", "n_chars", "{text}")) + ")"
_CRC32 = """xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
  lambda c, b: list_reduce([0, 1, 2, 3, 4, 5, 6, 7]::BIGINT[],
    lambda r, k: xor(r >> 1, CASE WHEN r & 1 = 1 THEN 3988292384 ELSE 0 END), xor(c, b)), 4294967295::BIGINT), 4294967295)"""
_RUN = """SELECT level, tree, spot // 8 AS run, list(digest ORDER BY spot) AS ds FROM {levels} WHERE n > 1 GROUP BY level, tree, spot // 8"""
_STEP = """SELECT rn, w.level + 1, w.tree, w.spot // 8, (n + 7) // 8,
    sha256(array_to_string(list_transform(ds, lambda d, i: CASE WHEN i = spot % 8 + 1 THEN acc ELSE d END), '')),
    proof || array_to_string(list_filter(ds, lambda d, i: i <> spot % 8 + 1), '')
  FROM {walk} w JOIN {runs} r ON w.level = r.level AND w.tree = r.tree AND w.spot // 8 = r.run WHERE n > 1"""


@query(rf"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rn, *, CASE WHEN {_CRC32} % 3 = 0
    THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS later
  FROM documents
), h AS (
  SELECT rn, doc_id, lang, {_LEAF.format(text="text")} AS leaf, {_LEAF.format(text="later")} AS found FROM d
), p AS (
  SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, count(*) OVER (PARTITION BY lang) AS n,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, rn) - 1 AS spot
  FROM h
), inner_levels AS (
  SELECT 0 AS level, tree, spot, n, leaf AS digest FROM p
  UNION ALL
  SELECT level + 1, tree, spot // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY spot))
  FROM inner_levels WHERE n > 1 GROUP BY level, tree, n, spot // 8
), subroots AS (SELECT tree, digest FROM inner_levels WHERE n = 1),
top_levels AS (
  SELECT 0 AS level, 0 AS tree, tree AS spot, count(*) OVER () AS n, digest FROM subroots
  UNION ALL
  SELECT level + 1, tree, spot // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY spot))
  FROM top_levels WHERE n > 1 GROUP BY level, tree, n, spot // 8
), inner_runs AS ({_RUN.format(levels="inner_levels")}), top_runs AS ({_RUN.format(levels="top_levels")}),
inner_walk AS (
  SELECT rn, 0 AS level, tree, spot, n, found AS acc, '' AS proof FROM p
  UNION ALL {_STEP.format(walk="inner_walk", runs="inner_runs")}
), top_walk AS (
  SELECT rn, 0 AS level, 0 AS tree, tree AS spot, (SELECT count(*) FROM subroots) AS n, acc, proof FROM inner_walk WHERE n = 1
  UNION ALL {_STEP.format(walk="top_walk", runs="top_runs")}
)
SELECT doc_id, leaf, s.digest AS subroot, r.digest AS root, sha256(proof) AS proof_sha256, acc AS folded_root,
  acc = r.digest AS verified
FROM p JOIN subroots s USING (tree) JOIN (SELECT rn, acc, proof FROM top_walk WHERE n = 1) w USING (rn),
  (SELECT digest FROM top_levels WHERE n = 1) r
""")
def op12_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    return merkle.manifest(table(spark, sf, "documents"), changed={"text": merkle.lowered_third()})


@query()
def op13_embedding_whitening(spark: SparkSession, sf: str) -> DataFrame:
    return whitening.whiten(table(spark, sf, "embeddings"))


@query(rf"""
WITH d AS (SELECT row_number() OVER () AS rn, doc_id, {_WORDS} AS ws FROM documents),
starts AS (
  SELECT rn, doc_id, i, md5(array_to_string(ws[i:i + 12], ' ')) AS h
  FROM (SELECT rn, doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM d WHERE len(ws) >= 13)
), late AS (
  SELECT rn, i FROM starts JOIN (SELECT h, min(doc_id) AS low FROM starts GROUP BY h) USING (h) WHERE low < doc_id
), gone AS (SELECT DISTINCT rn, i + k AS at_word FROM late, (SELECT unnest(range(13)) AS k)),
words AS (SELECT rn, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS at_word FROM d),
kept AS (
  SELECT rn, count(*) AS n, string_agg(w, ' ' ORDER BY at_word) AS text FROM words ANTI JOIN gone USING (rn, at_word) GROUP BY rn
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rn)
""")
def op11_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return copies.without_copies(table(spark, sf, "documents")).drop("spans", "kept")
