"""The registered queries of these operators, each beside its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from quotelake.llm import (bagminhash, chat_windows, decontaminate, host_quality, interpolated_lm, lexical_search,
                           license_scan, merkle, mixing, sharding, substring_dedup, token_files, url_reputation)
from quotelake.llm.common import read_table

Build = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Build] = {}
ORACLES: dict[str, str] = {}

TOKENIZER, END_ID = "word_bpe_49k.json", 2

URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
             ("block", "net", "/es/"), ("block", "net", "/fr/")]

# Shards of the query: small, so that the given tables are split many times.
SHARD_BYTES = 256 * 1024

CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"


def query(sql: str | None = None) -> Callable[[Build], Build]:
    def register(build: Build) -> Build:
        QUERIES[build.__name__] = build
        if sql is not None:
            ORACLES[build.__name__] = sql
        return build
    return register


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Figures to six places, to be compared with those of another engine."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


# DuckDB: words of a text, and the 60-bit key of common.shuffle_key.
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _key(*parts: str) -> str:
    text = " || '|' || ".join(parts)
    return f"CAST('0x' || substr(md5({text}), 1, 15) AS BIGINT)"


_TEMPLATES = ", ".join([*(f"('{name}', '{name}', '{text}')" for name, text in license_scan.TEMPLATES.items()),
                        *(f"('{tag}', '{name}', '{tag}')" for tag, name in license_scan.TAGS.items())])
_TRIM = license_scan.PUNCTUATION.replace("'", "''")


@query(f"""
WITH files AS (
    SELECT doc_id, text, dir, dir || '/' || doc_id || '.txt' AS path FROM (
        SELECT *, source || '/' || doc_id // 512 || CASE WHEN doc_id % 4 > 0 THEN '/m' || doc_id % 5 ELSE '' END
               || CASE WHEN doc_id % 4 > 1 THEN '/n' || doc_id // 5 % 5 ELSE '' END AS dir FROM documents)),
templates(template, licence, text) AS (VALUES {_TEMPLATES}),
units AS (
    SELECT doc_id, -1 AS line, '' AS template, text FROM files
    UNION ALL SELECT doc_id, i, '', string_split(text, chr(10))[i] FROM files, unnest(range(1, len(string_split(text, chr(10))) + 1)) t(i)
    UNION ALL SELECT NULL, -2, template, text FROM templates),
tokens AS (
    SELECT doc_id, line, template, trim(unnest(regexp_extract_all(
        regexp_replace(lower(text), '{license_scan.TAG}[ \t(]+', '{license_scan.TAG}', 'g'), '[^\x20\x09-\x0D]+')), '{_TRIM}') AS term FROM units),
tf AS (SELECT doc_id, line, template, term, count(*) AS tf FROM tokens WHERE term <> '' GROUP BY ALL),
idf AS (
    SELECT term, ln((1 + (SELECT count(*) FROM files)) / (1 + count(DISTINCT doc_id) FILTER (line = -1))) + 1 AS idf
    FROM tf GROUP BY term),
weights AS (SELECT tf.*, tf * idf AS w FROM tf JOIN idf USING (term)),
unit AS (SELECT *, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id, line, template)) AS u FROM weights),
cosines AS (
    SELECT d.doc_id, d.line, t.template, sum(d.u * t.u) AS c
    FROM unit d JOIN unit t ON d.term = t.term AND d.line >= -1 AND t.line = -2 GROUP BY ALL),
own AS (
    SELECT doc_id, first(licence ORDER BY round(c, 9) DESC, template) AS licence
    FROM cosines JOIN templates USING (template) WHERE line >= 0 AND c >= {license_scan.STATEMENT} GROUP BY doc_id),
speaking AS (
    SELECT dir, first(licence ORDER BY path) AS given FROM files JOIN own USING (doc_id)
    WHERE doc_id IN (SELECT doc_id FROM cosines WHERE line = -1 AND c >= {license_scan.WHOLE} AND NOT starts_with(template, 'SPDX'))
    GROUP BY dir),
near AS (
    SELECT f.doc_id, s.dir, given, row_number() OVER (PARTITION BY f.doc_id ORDER BY length(s.dir) DESC) AS n
    FROM files f JOIN speaking s ON f.dir = s.dir OR starts_with(f.dir, s.dir || '/') OR s.dir = '')
SELECT f.doc_id, path, coalesce(licence, given) AS licence,
       CASE WHEN licence IS NOT NULL THEN 'statement' WHEN given IS NOT NULL THEN 'directory' END AS origin,
       CASE WHEN licence IS NULL THEN near.dir END AS from_dir
FROM files f LEFT JOIN own USING (doc_id) LEFT JOIN near ON near.doc_id = f.doc_id AND near.n = 1
""")
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as files: a directory per source and 512 numbers, in which a quarter of them
    lie; the others lie one and two directories below."""
    doc_id = F.col("doc_id")
    below = (F.when(doc_id % 4 > 0, F.concat(F.lit("/m"), doc_id % 5)).otherwise(""),
             F.when(doc_id % 4 > 1, F.concat(F.lit("/n"), F.floor(doc_id / 5) % 5)).otherwise(""))
    path = F.concat(F.col("source"), F.lit("/"), F.floor(doc_id / 512), *below, F.lit("/"), doc_id, F.lit(".txt"))
    files = read_table(spark, sf_dir, "documents").select(doc_id.alias("file_id"), path.alias("path"), "text")
    return license_scan.scan(files).withColumnRenamed("file_id", "doc_id")


@query(f"""
WITH hashed AS (
    SELECT doc_id, strlen(coalesce(text, '')) AS bytes,
           {_key("coalesce(CAST(doc_id AS VARCHAR), '-')", "coalesce(md5(text), '-')")} AS h
    FROM documents),
sums AS (
    SELECT d, h >> (60 - d) AS p, CAST(sum(bytes) AS BIGINT) AS total
    FROM hashed, range(0, 61) t(d) GROUP BY 1, 2),
fits AS (
    SELECT doc_id, bytes, h, d, total,
           row_number() OVER (PARTITION BY doc_id, h ORDER BY d) AS n
    FROM hashed JOIN sums ON h >> (60 - d) = p
    WHERE total <= {SHARD_BYTES} OR d = 60)
SELECT doc_id, bytes, substr(bin((h >> (60 - d)) + (1::BIGINT << d)), 2) AS shard,
       CAST(d AS INTEGER) AS depth, total AS shard_bytes, total > {SHARD_BYTES} AS oversized
FROM fits WHERE n = 1
""")
def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(read_table(spark, sf_dir, "documents"), SHARD_BYTES)


@query()
def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    files = token_files.write_token_files(
        read_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), END_ID)
    return token_files.token_digests(spark, files)


@query(f"""
WITH sized AS (
    SELECT doc_id, source, text, CAST(len({_WORDS}) AS BIGINT) AS size,
           {_key("'mix'", "coalesce(CAST(doc_id AS VARCHAR), '-')")} AS k FROM documents),
sources AS (
    SELECT source, sum(size) AS s, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
           WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w FROM sized GROUP BY source),
ordered AS (  -- sources that reach twice their size first do so at the lowest level
    SELECT source, s, w, row_number() OVER (ORDER BY 2.0 * s / w, source NULLS LAST) AS n,
           1.5 * sum(s) OVER () AS total FROM sources),
levels AS (
    SELECT *, (total - coalesce(sum(2 * s) OVER before, 0)) / sum(w) OVER after AS level FROM ordered
    WINDOW before AS (ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
           after AS (ORDER BY n ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
chosen AS (SELECT arg_min(level, n) FILTER (2.0 * s / w > level) AS level FROM levels),
targets AS (
    SELECT l.source, CAST(l.s AS BIGINT) AS source_size,
           round(CASE WHEN c.level IS NULL OR 2 * l.s <= c.level * l.w THEN 2.0 * l.s ELSE c.level * l.w END, 6) AS target
    FROM levels l, chosen c),
placed AS (
    SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY k, doc_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM sized)
SELECT doc_id, p.source, size, source_size, CAST(target AS DOUBLE) AS target,
       CAST(CASE WHEN size = 0 THEN 0 ELSE size * (CAST(floor(target) AS BIGINT) // source_size)
            + greatest(0, least(size, CAST(floor(target) AS BIGINT) % source_size - start)) END AS BIGINT) AS taken
FROM placed p JOIN targets t ON p.source IS NOT DISTINCT FROM t.source
""")
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(read_table(spark, sf_dir, "documents")).drop("key_a", "key_b")


_SHINGLES = r"""
    SELECT DISTINCT {key}, array_to_string(w[i:i + 4], ' ') AS shingle
    FROM (SELECT {key}, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') AS w FROM {table}),
         unnest(range(1, len(w) - 3)) t(i)"""


@query(f"""
WITH d AS ({_SHINGLES.format(key="doc_id", table="documents")}),
b AS ({_SHINGLES.format(key="item_id", table="benchmark")}),
n AS (SELECT item_id, count(*) AS n_shingles FROM b GROUP BY 1)
SELECT doc_id, item_id, count(*) AS n_found, n_shingles
FROM d JOIN b USING (shingle) JOIN n USING (item_id)
GROUP BY doc_id, item_id, n_shingles HAVING 100 * count(*) >= {decontaminate.PERCENT} * n_shingles
""")
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


_PRIOR = """
    SELECT CASE WHEN count(*) = 0 THEN 0.5 ELSE sum(bad) / sum(n) END AS mean,
           CASE WHEN count(*) = 0 THEN 2.0
                WHEN var_pop(bad / n) - sum(bad) / sum(n) * (1 - sum(bad) / sum(n)) * avg(1 / n) <= 0
                     OR sum(bad) / sum(n) IN (0.0, 1.0) THEN CAST(sum(n) AS DOUBLE)
                ELSE greatest(1.0, sum(bad) / sum(n) * (1 - sum(bad) / sum(n))
                     / (var_pop(bad / n) - sum(bad) / sum(n) * (1 - sum(bad) / sum(n)) * avg(1 / n)) - 1)
           END AS strength
    FROM {table} WHERE n > 0"""

_BOUND = "({rate} - {z} * sqrt({rate} * (1 - {rate}) / (n + strength + 1)))"


def _bound(prior: str, z: float) -> str:
    return _BOUND.format(rate=f"((bad + {prior} * strength) / (n + strength))", z=z)


@query()
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.find_repeats(read_table(spark, sf_dir, "documents")).drop("node")


@query(f"""
WITH w AS (SELECT doc_id, source, coalesce(text, '') AS t, {_WORDS} AS ws FROM documents),
grams AS (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i], ws[i + 1], ws[i + 2]) AS c
    FROM w, unnest(range(1, len(ws) - 1)) u(i)),
repeats AS (
    SELECT doc_id, count(DISTINCT i + k) AS r FROM grams, range(0, 3) o(k) WHERE c > 1 GROUP BY doc_id),
lines AS (
    SELECT doc_id, count(*) - count(DISTINCT line) AS r
    FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM w)
    WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
base AS (
    SELECT doc_id, source, CAST(len(ws) AS BIGINT) AS n_words,
           CAST(length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars,
           CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
           CAST(coalesce(lines.r, 0) AS BIGINT) AS n_dup_lines,
           CAST(coalesce(repeats.r, 0) AS BIGINT) AS n_repeat_words,
           len(ws) < {host_quality.MIN_WORDS}
               OR 100 * coalesce(repeats.r, 0) > {host_quality.MAX_REPEAT_PERCENT} * len(ws) AS base_failed
    FROM w LEFT JOIN lines USING (doc_id) LEFT JOIN repeats USING (doc_id)),
hosts AS (
    SELECT source, CAST(count(*) AS DOUBLE) AS n, CAST(count(*) FILTER (base_failed) AS DOUBLE) AS bad
    FROM base GROUP BY source),
prior AS ({_PRIOR.format(table="hosts")}),
verdicts AS (
    SELECT source, CAST(n AS BIGINT) AS host_n, CAST(bad AS BIGINT) AS host_bad, round(mean, 6) AS prior_rate,
           round(strength, 6) AS prior_strength, {_bound("mean", host_quality.HOST_Z)} AS low
    FROM hosts, prior)
SELECT base.*, host_n, host_bad, prior_rate, prior_strength, round(low, 6) AS host_low, low > {host_quality.MAX_HOST_RATE} AS host_failed,
       NOT (base_failed OR low > {host_quality.MAX_HOST_RATE}) AS kept
FROM base JOIN verdicts ON base.source IS NOT DISTINCT FROM verdicts.source
""")
def op7_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(host_quality.judge(read_table(spark, sf_dir, "documents")), "prior_rate", "prior_strength", "host_low")


@query()
def op8_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bagminhash.classes(read_table(spark, sf_dir, "documents"))


_SECOND = ", ".join(f"'{s}'" for s in url_reputation.SECOND_LEVEL)


def _last(n: int) -> str:
    return f"array_to_string(string_split(host, '.')[-{n}:], '.')"


@query(f"""
WITH parsed AS (
    SELECT page_id,
           translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1), '{url_reputation.UPPER}', '{url_reputation.LOWER}') AS host,
           regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path
    FROM pages),
once AS (SELECT doc_id AS page_id, max(CASE WHEN toxic = 1 OR quality = 0 THEN 1 ELSE 0 END) AS bad FROM labels GROUP BY 1),
hosts AS (
    SELECT host, CAST(count(bad) AS DOUBLE) AS n, CAST(coalesce(sum(bad), 0) AS DOUBLE) AS bad,
           CASE WHEN {_last(2)} IN ({_SECOND}) THEN {_last(2)} ELSE {_last(1)} END AS suffix,
           CASE WHEN {_last(2)} IN ({_SECOND}) THEN {_last(3)} ELSE {_last(2)} END AS domain
    FROM parsed LEFT JOIN once USING (page_id) GROUP BY host),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY ALL),
suffixes AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY ALL),
host_prior AS ({_PRIOR.format(table="hosts")}),
domain_prior AS ({_PRIOR.format(table="domains")}),
suffix_prior AS ({_PRIOR.format(table="suffixes")}),
suffix_rates AS (SELECT suffix, (bad + mean * strength) / (n + strength) AS suffix_rate FROM suffixes, suffix_prior),
domain_rates AS (
    SELECT domain, (bad + suffix_rate * strength) / (n + strength) AS domain_rate
    FROM domains JOIN suffix_rates USING (suffix), domain_prior),
blocked AS (
    SELECT host, domain, n, bad, {_bound("domain_rate", url_reputation.Z)} AS low
    FROM hosts JOIN domain_rates USING (domain), host_prior),
rules(kind, domain, start) AS (VALUES {", ".join(f"('{k}', '{d}', '{p}')" for k, d, p in URL_RULES)}),
matched AS (
    SELECT page_id, kind, domain || start AS rule,
           row_number() OVER (PARTITION BY page_id ORDER BY length(domain || start) DESC) AS nth
    FROM parsed JOIN rules ON (host = domain OR ends_with(host, '.' || domain)) AND starts_with(path, start))
SELECT p.page_id, p.host, path, rule, coalesce(kind, CASE WHEN low > {url_reputation.MAX_RATE} THEN 'block' ELSE 'allow' END) AS verdict,
       b.domain, CAST(n AS BIGINT) AS site_n, CAST(bad AS BIGINT) AS site_bad, round(low, 6) AS site_low
FROM parsed p JOIN blocked b USING (host) LEFT JOIN matched m ON m.page_id = p.page_id AND m.nth = 1
""")
def op9_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labels are outcomes of the pages with their number."""
    labels = read_table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"), ((F.col("toxic") == 1) | (F.col("quality") == 0)).alias("bad"))
    return _rounded(url_reputation.filter_urls(read_table(spark, sf_dir, "pages"), labels, URL_RULES), "site_low")


_HALF = f"""greatest({chat_windows.LEAST_HALF}, ({chat_windows.BUDGET} - {chat_windows.HISTORY}
                - coalesce(max(size) FILTER (before = 0 AND role = '{chat_windows.SYSTEM}') OVER (PARTITION BY conv_id), 0)) // 2)"""
_PROBE = CONTROL_TEXT.replace("'", "''")


@query(rf"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-1, 0, 'user', '{_PROBE}'), (-1, 1, 'assistant', '{_PROBE}')),
sized AS (
    SELECT *, len({_WORDS}) + {chat_windows.OVERHEAD} AS size,
           length('{chat_windows.START}') + length('{chat_windows.END}') + 2
           + length(replace(replace(replace(role, '\', '\s'), '<|', '<\p'), chr(10), '\n'))
           + length(replace(replace(text, '\', '\s'), '<|', '<\p')) AS chars FROM rows),
summed AS (
    SELECT *, coalesce(sum(size) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM sized),
spanned AS (SELECT *, {_HALF} AS half FROM summed),
ended AS (
    SELECT *, min(before) OVER s AS first, max(before + size) OVER s AS last, max(before + size) OVER (PARTITION BY conv_id) AS total,
           max(chars) FILTER (before = 0 AND role = '{chat_windows.SYSTEM}') OVER (PARTITION BY conv_id) AS system_chars
    FROM spanned WINDOW s AS (PARTITION BY conv_id, 2 * (before // half) + CASE WHEN size > half THEN 1 ELSE 0 END))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY before)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = '{chat_windows.TARGET}'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY before) FILTER (role = '{chat_windows.TARGET}'), '')) AS loss_sha256,
       CAST(sum(chars) + coalesce(sum(chars) FILTER (last < total AND last - before <= {chat_windows.HISTORY}
                AND NOT (before = 0 AND role = '{chat_windows.SYSTEM}')), 0)
            + coalesce(max(system_chars), 0) * (count(DISTINCT first) - 1) AS BIGINT) AS formatted_chars
FROM ended GROUP BY conv_id
""")
def op10_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL_TEXT).alias("text"))
    formatted = chat_windows.stage_table(chat_windows.windows(rows.unionByName(probe)), "chat")
    return chat_windows.digests(formatted)


@query(rf"""
WITH terms AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{lexical_search.UPPER}', '{lexical_search.LOWER}'), '{lexical_search.TERM}')) AS term
    FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY ALL),
sizes AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY 1),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes),
weights AS (
    SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * any_value(docs) + 2) / (2.0::DOUBLE * count(*) + 1))) AS BIGINT) AS w
    FROM tf, total GROUP BY term),
asked AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{lexical_search.UPPER}', '{lexical_search.LOWER}'), '{lexical_search.TERM}')) AS term
    FROM benchmark),
scores AS (
    SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // total.terms)))) AS BIGINT) AS score
    FROM asked JOIN tf USING (term) JOIN weights USING (term) JOIN sizes USING (doc_id), total GROUP BY ALL),
ranked AS (
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
    FROM scores WHERE score > 0)
SELECT * FROM ranked WHERE rank <= {lexical_search.TOP}
""")
def op11_block_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = lexical_search.build_index(read_table(spark, sf_dir, "documents"))
    return lexical_search.search(index, read_table(spark, sf_dir, "benchmark"))


# crc32 of an ASCII text, bit by bit.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, [ord(c)::BIGINT FOR c IN string_split({text}, '')]),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(0, 8)),
        lambda x, bit: xor(x >> 1, (x & 1) * 3988292384))), 4294967295)"""


def _sql_field(column: str) -> str:
    return f"coalesce(strlen(CAST({column} AS VARCHAR)) || ':' || CAST({column} AS VARCHAR), '-')"


def _sql_leaf(text: str = "text") -> str:
    return "sha256(" + " || ".join(_sql_field(text if c == "text" else c) for c in merkle.FIELDS) + ")"


# Levels of a tree: as many as MERKLE_SQL_ROWS leaves need.
_MERKLE_LEVELS = 11  # 3^11 leaves


def _sql_tree(name: str, key: str) -> str:
    """Levels of the trees over {name}_0 (key, pos, h): {name}_l has those of level l."""
    steps = []
    for i in range(_MERKLE_LEVELS):
        steps.append(f"""{name}_{i + 1} AS (
    SELECT {key}, pos // 3 AS pos, CASE WHEN max(n) = 1 THEN max(h) ELSE sha256(string_agg(h, '' ORDER BY pos)) END AS h,
           max(n) = 1 AS top, (max(n) + 2) // 3 AS n FROM {name}_{i} GROUP BY {key}, pos // 3)""")
    return ",\n".join(steps)


def _sql_path(tree: str, key: str) -> str:
    """Proof text and fold through the levels of a tree."""
    steps = []
    for i in range(_MERKLE_LEVELS):
        steps.append(f"""{tree}_p{i + 1} AS (
    SELECT p.doc_id, p.k, p.pos // 3 AS pos, proof || coalesce(before, '') || coalesce(after, '') AS proof,
           CASE WHEN n = 1 THEN fold ELSE sha256(coalesce(before, '') || fold || coalesce(after, '')) END AS fold, {key}
    FROM (SELECT p.*, max(s.n) AS n, string_agg(s.h, '' ORDER BY s.pos) FILTER (s.pos < p.pos) AS before,
                 string_agg(s.h, '' ORDER BY s.pos) FILTER (s.pos > p.pos) AS after
          FROM {tree}_p{i} p JOIN {tree}_{i} s ON s.{key} IS NOT DISTINCT FROM p.{key} AND s.pos // 3 = p.pos // 3
          GROUP BY ALL) p)""")
    return ",\n".join(steps)


_TAMPERED = f"CASE WHEN {_CRC.format(text='CAST(doc_id AS VARCHAR)')} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END"


@query(f"""
WITH leaves AS (
    SELECT doc_id, source, {_sql_leaf()} AS leaf, {_sql_leaf('(' + _TAMPERED + ')')} AS fold FROM documents),
a_0 AS (
    SELECT source, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, leaf AS h,
           count(*) OVER (PARTITION BY source) AS n, doc_id, fold FROM leaves),
{_sql_tree("a", "source")},
subroots AS (SELECT source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS spos FROM a_{_MERKLE_LEVELS}),
b_0 AS (SELECT 0 AS one, spos AS pos, subroot AS h, count(*) OVER () AS n FROM subroots),
{_sql_tree("b", "one")},
a_p0 AS (SELECT doc_id, pos AS k, pos, '' AS proof, fold, source FROM a_0),
{_sql_path("a", "source")},
b_p0 AS (SELECT doc_id, k, spos AS pos, proof, fold, p.source, 0 AS one
         FROM a_p{_MERKLE_LEVELS} p JOIN subroots s ON s.source IS NOT DISTINCT FROM p.source),
{_sql_path("b", "one").replace("SELECT p.doc_id, p.k,", "SELECT p.doc_id, p.k, p.source,")}
SELECT p.doc_id, h AS leaf, subroot, root, sha256(proof) AS proof_sha256, p.fold AS folded_root, p.fold = root AS verified
FROM b_p{_MERKLE_LEVELS} p JOIN a_0 l ON l.pos = p.k AND l.source IS NOT DISTINCT FROM p.source
JOIN subroots s ON s.source IS NOT DISTINCT FROM p.source, (SELECT h AS root FROM b_{_MERKLE_LEVELS})
""")
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every second document, by checksum of its id, is checked with its line feeds deleted."""
    struck = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    tampered = F.when(struck, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return merkle.verify(read_table(spark, sf_dir, "documents"), tampered)


@query()
def op13_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interpolated_lm.score(read_table(spark, sf_dir, "documents"))
