"""The registered queries of this package, and their SQL."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickloom.llm import (
    alignment, chat_format, decontaminate, language_id, line_index, merkle, packing, quality_model, rule_ledger,
    secret_scan, simhash, suffix_dedup, warc_zip)
from clickloom.llm.common import held_out, read


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), with_ids=False)


def op2_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = rule_ledger.ledger(read(spark, sf_dir, "documents"))
    return book.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       (~rule_ledger.passes(rule_ledger.POLICIES["base"])).alias("base_failed"),
                       rule_ledger.passes(rule_ledger.POLICIES["v2"]).alias("kept"), "failures")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op4_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = warc_zip.round_trip(read(spark, sf_dir, "pages"))
    return back.select(F.col("page_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                       F.col("refers_to").cast("long").alias("refers_to"))


def secret_model(docs: DataFrame) -> secret_scan.Model:
    samples = secret_scan.random_samples(docs.sparkSession).unionByName(secret_scan.identifier_samples(docs))
    return secret_scan.fit(samples)


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.scan(docs, secret_model(docs))
    counts = [F.size(F.filter("spans", lambda s: s["kind"] == p.name)).cast("long").alias(f"n_{p.name}")
              for p in secret_scan.PATTERNS]
    base = F.filter("spans", lambda s: s["kind"] != secret_scan.MARKOV)
    return found.select("doc_id", *counts, F.sha2(secret_scan.told(base), 256).alias("base_sha256"),
                        secret_scan.told(F.col("spans")).alias("spans"))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = r"\### Assistant: </turn> ok"
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(probe).alias("text"))
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    chats = chat_format.format_chats(turns)
    back = chats.select("conv_id", "valid", F.inline(F.array(F.struct(
        chat_format.turns_of(F.col("formatted")).alias("turns"),
        chat_format.loss_text(F.col("segments")).alias("learned"),
        F.length("formatted").cast("long").alias("formatted_chars")))))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
                       F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
                       "formatted_chars", "valid")


def fitted_quality(spark: SparkSession, sf_dir: str, docs: DataFrame) -> quality_model.Model:
    """The model learned from the rows of ``docs`` that are not held out."""
    labels = read(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return quality_model.fit(docs, labels.where(~held_out(F.col("doc_id"))))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality_model.score(docs, fitted_quality(spark, sf_dir, docs))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                         F.col(quality_model.COLUMN).alias("score"),
                         (F.col(quality_model.COLUMN) >= 0.5).cast("int").alias("predicted"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits(F.col("fingerprint")).alias("fingerprint"), "component_id")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.annotate(read(spark, sf_dir, "documents").select("doc_id", "text"),
                                   read(spark, sf_dir, "benchmark"))
    items = F.col("contamination.items")
    return found.select("doc_id", "contamination.n_words", decontaminate.n_hit().alias("n_hit"),
                        F.size(items).cast("long").alias("n_items"),
                        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
                        decontaminate.contaminated().alias("contaminated"), "contamination.longest")


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    network = language_id.fit(docs.where(~held_out(F.col("doc_id"))))
    found = language_id.identify(docs.select("doc_id", "text"), network)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                        F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))
    found = merkle.manifest(docs, F.col("n_chars").cast("long") + F.when(tampered, 1).otherwise(0))
    folded = merkle.folded(merkle.hex_text(F.col("shown")), F.col("path"))
    shown = [merkle.hex_text(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")]
    told = found.select("doc_id", *shown, merkle.proof_digest(F.col("path")).alias("proof_sha256"),
                        folded.alias("folded_root"))
    return told.withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alignment.align(read(spark, sf_dir, "documents"), with_groups=False)
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = line_index.LineIndex.build(docs).apply(docs)
    result = F.col(line_index.COLUMN)
    return found.select("doc_id", result["n_lines"].alias("n_lines"), result["n_dropped"].alias("n_dropped"),
                        F.sha2(result["kept"], 256).alias("kept_sha256"))


QUERIES = {
    "op1_packing": op1_packing,
    "op2_rule_ledger": op2_rule_ledger,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_warc_zip": op4_warc_zip,
    "op5_secret_scan": op5_secret_scan,
    "op6_chat_format": op6_chat_format,
    "op7_quality": op7_quality,
    "op8_simhash": op8_simhash,
    "op9_decontamination": op9_decontamination,
    "op10_language": op10_language,
    "op11_merkle": op11_merkle,
    "op12_alignment": op12_alignment,
    "op13_line_dedup": op13_line_dedup,
}
ORACLES = {
    "op2_rule_ledger": r"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS s FROM documents),
m AS (SELECT *, list_filter(regexp_split_to_array(s, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
        list_filter(string_split(s, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM t),
g AS (SELECT rid, unnest(range(1, len(w) - 3)) AS i, w FROM m WHERE len(w) >= 5),
k AS (SELECT rid, i, array_to_string(w[i:i + 4], ' ') AS gram FROM g),
d AS (SELECT rid, i FROM k QUALIFY count(*) OVER (PARTITION BY rid, gram) >= 2),
c AS (SELECT rid, count(DISTINCT i + j) AS n FROM d, range(5) AS r(j) GROUP BY rid),
x AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(s, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
        (length(s) - length(regexp_replace(s, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, len(l)::BIGINT AS n_lines,
        (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
        length(regexp_replace(s, '\P{Ll}+', '', 'g'))::BIGINT AS n_lower FROM m LEFT JOIN c USING (rid)),
f AS (SELECT *, (CASE WHEN n_words < 10 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
        + CASE WHEN word_chars < 2 * n_words THEN 4 ELSE 0 END + CASE WHEN word_chars > 20 * n_words THEN 8 ELSE 0 END
        + CASE WHEN 5 * n_symbols > n_words THEN 16 ELSE 0 END
        + CASE WHEN n_lines >= 4 AND 2 * n_dup_lines > n_lines THEN 32 ELSE 0 END
        + CASE WHEN 10 * n_lower < 3 * word_chars THEN 64 ELSE 0 END)::BIGINT AS failures FROM x)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failures & 3 <> 0 AS base_failed,
       failures = 0 AS kept, failures FROM f""",
    "op4_warc_zip": """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h) AS n, sha1(h) AS x, min(page_id) OVER (PARTITION BY h) AS first FROM p),
b AS (SELECT *, list_transform(string_split_regex(x, ''), lambda c: instr('0123456789abcdef', c) - 1) AS v FROM d)
SELECT page_id, n::BIGINT AS payload_bytes, array_to_string(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      1 + (((v[(5 * i) // 4 + 1] * 256 + coalesce(v[(5 * i) // 4 + 2], 0) * 16 + coalesce(v[(5 * i) // 4 + 3], 0))
        >> (7 - (5 * i) % 4)) & 31)::INT, 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to FROM b""",
    "op6_chat_format": r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS t FROM conversations
  UNION ALL SELECT -7, i, CASE i WHEN 0 THEN 'user' ELSE 'assistant' END, '\### Assistant: </turn> ok' FROM range(2) AS r(i)),
o AS (SELECT *, lag(role, 1, 'start') OVER w AS before, lead(role) OVER w AS after FROM c
      WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, t)),
e AS (SELECT *, length(role || t) + length(regexp_replace(role || t, '[^\\#:<]', '', 'g')) + 14 AS n FROM o)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || t || chr(10), '' ORDER BY turn NULLS FIRST, role, t)) AS turns_sha256,
  coalesce(sum(length(t)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(t, '' ORDER BY turn NULLS FIRST, role, t) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(n)::BIGINT AS formatted_chars,
  bool_and(before || '>' || role IN ('start>system', 'start>user', 'system>user', 'user>assistant', 'assistant>user'))
    AND coalesce(bool_or(after IS NULL AND role = 'assistant'), false) AS valid
FROM e GROUP BY conv_id""",
    "op9_decontamination": r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT row_number() OVER () AS item, coalesce(item_id::VARCHAR, '') AS item_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
s AS (SELECT item, item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS j FROM b WHERE len(w) > 0),
t AS (SELECT item, item_id, j, least(13, len(w)) AS n, array_to_string(w[j:j + 12], ' ') AS gram FROM s),
z AS (SELECT DISTINCT n FROM t),
p AS (SELECT rid, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM d, z WHERE len(w) >= n),
g AS (SELECT rid, n, i, array_to_string(w[i:i + n - 1], ' ') AS gram FROM p),
h AS (SELECT rid, i, item, item_id, j, n FROM g JOIN t USING (n, gram)),
c AS (SELECT rid, count(DISTINCT i + k) AS n_hit FROM h, range(13) AS r(k) WHERE k < n GROUP BY rid),
m AS (SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
      FROM (SELECT DISTINCT rid, item_id FROM h) GROUP BY rid),
r AS (SELECT rid, n, i, item, i - j AS diagonal, i - row_number() OVER (PARTITION BY rid, item, i - j ORDER BY i) AS run FROM h),
x AS (SELECT rid, max(k) AS longest FROM (SELECT rid, max(n) + count(*) - 1 AS k FROM r GROUP BY rid, item, diagonal, run)
      GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * n_hit >= len(w) AS contaminated,
  coalesce(longest, 0)::BIGINT AS longest
FROM d LEFT JOIN c USING (rid) LEFT JOIN m USING (rid) LEFT JOIN x USING (rid)""",
    "op11_merkle": r"""
WITH RECURSIVE d AS (SELECT *, lang AS l, doc_id::VARCHAR AS i, coalesce(list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(string_split_regex(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)), lambda x, y:
    list_reduce(list_prepend(xor(x, y), range(8)), lambda p, q: xor(p >> 1, 3988292384 * (p & 1)))), 0) AS crc FROM documents),
e AS (SELECT *, (doc_id IS NOT NULL AND xor(crc, 4294967295) % 7 = 0)::INT AS more FROM d),
f AS (SELECT row_number() OVER () AS rid, doc_id, l,
    coalesce(strlen(i) || ':' || i, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') AS head,
    coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars::VARCHAR, '-') AS stored,
    coalesce(strlen((n_chars + more)::VARCHAR) || ':' || (n_chars + more)::VARCHAR, '-') AS found,
    coalesce(strlen(text) || ':' || text, '-') AS tail FROM e),
g AS (SELECT rid, doc_id, l, sha256(head || stored || tail) AS leaf, sha256(head || found || tail) AS shown FROM f),
a AS (SELECT *, row_number() OVER (PARTITION BY l ORDER BY doc_id NULLS FIRST, leaf) - 1 AS lo,
    count(*) OVER (PARTITION BY l) AS n FROM g),
u AS (SELECT l, 0 AS level, lo AS k, n, leaf AS h FROM a UNION ALL
    SELECT l, level + 1, k // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY k)) FROM u WHERE n > 1
    GROUP BY l, level, k // 2, n),
s AS (SELECT l, h AS subroot, row_number() OVER (ORDER BY l NULLS FIRST) - 1 AS pos, count(*) OVER () AS m FROM u WHERE n = 1),
v AS (SELECT 0 AS level, pos AS k, m AS n, subroot AS h FROM s UNION ALL
    SELECT level + 1, k // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY k)) FROM v WHERE n > 1
    GROUP BY level, k // 2, n),
w AS (SELECT rid, level, 0 AS part, h FROM a JOIN u ON u.l IS NOT DISTINCT FROM a.l AND u.n > 1
      AND u.k = xor(a.lo >> level, 1)
    UNION ALL SELECT rid, v.level, 1, v.h FROM a JOIN s ON s.l IS NOT DISTINCT FROM a.l
      JOIN v ON v.n > 1 AND v.k = xor(s.pos >> v.level, 1)),
p AS (SELECT rid, string_agg(h, '' ORDER BY part, level) AS siblings FROM w GROUP BY rid),
x AS (SELECT rid, l, 0 AS level, lo AS k, n, shown AS h FROM a UNION ALL
    SELECT x.rid, x.l, x.level + 1, x.k // 2, (x.n + 1) // 2, sha256(CASE WHEN u.h IS NULL THEN x.h
      WHEN x.k % 2 = 1 THEN u.h || x.h ELSE x.h || u.h END)
    FROM x LEFT JOIN u ON u.l IS NOT DISTINCT FROM x.l AND u.level = x.level AND u.k = xor(x.k, 1) WHERE x.n > 1),
y AS (SELECT x.rid, 0 AS level, s.pos AS k, s.m AS n, x.h FROM x JOIN s ON s.l IS NOT DISTINCT FROM x.l WHERE x.n = 1 UNION ALL
    SELECT y.rid, y.level + 1, y.k // 2, (y.n + 1) // 2, sha256(CASE WHEN v.h IS NULL THEN y.h
      WHEN y.k % 2 = 1 THEN v.h || y.h ELSE y.h || v.h END)
    FROM y LEFT JOIN v ON v.level = y.level AND v.k = xor(y.k, 1) WHERE y.n > 1)
SELECT a.doc_id, a.leaf, s.subroot, v.h AS root, sha256(coalesce(p.siblings, '')) AS proof_sha256,
  y.h AS folded_root, y.h = v.h AS verified
FROM a JOIN s ON s.l IS NOT DISTINCT FROM a.l JOIN v ON v.n = 1 JOIN y ON y.rid = a.rid AND y.n = 1 LEFT JOIN p ON p.rid = a.rid""",
    "op13_line_dedup": r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT rid, doc_id, i, lines[i] AS line, translate(regexp_replace(lines[i],
    '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT *, unnest(range(1, len(lines) + 1)) AS i FROM d)),
c AS (SELECT key, max(doc_id) AS keeper FROM (SELECT DISTINCT rid, doc_id, key FROM l WHERE length(key) >= 20)
  GROUP BY key HAVING count(*) >= 3),
m AS (SELECT rid, i, line, c.keeper IS NOT NULL AND (doc_id IS NULL OR doc_id < c.keeper) AS gone
  FROM l LEFT JOIN c ON c.key = l.key)
SELECT any_value(d.doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m JOIN d USING (rid) GROUP BY rid""",
}
