"""The registered corpus queries; each derives its contract's columns from its operator's output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm import (
    chat_format,
    decontaminate,
    exact_dedup,
    html_extract,
    lexical_search,
    mixing,
    prefix_trie,
    pu_classifier,
    quality_rules,
    secret_scan,
    sharding,
    simhash,
    token_counts,
)
from granary.llm.registry import ORACLE, QUERIES, query

__all__ = ["ORACLE", "QUERIES"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# DuckDB SQL of the base measures and the rules; lists and thresholds come from the operator's tables
def _rules_sql() -> str:
    stop = ", ".join(f"'{word}'" for word in sorted({w for listed in quality_rules.STOP_WORDS.values() for w in listed}))
    other = "[\\x{370}-\\x{1DFF}\\x{2C80}-\\x{2DFF}\\x{3040}-\\x{D7FF}\\x{F900}-\\x{FDFF}\\x{20000}-\\x{3FFFF}]"
    broken = []
    for rule in quality_rules.RULES:
        value = f"CAST({rule.measure} AS DOUBLE)"
        if rule.per:
            value = f"{value} / nullif(CAST({rule.per} AS DOUBLE), 0)"
        judged = f"n_words >= {rule.from_words}" + (" AND 2 * n_other_script <= word_chars" if rule.latin else "")
        if rule.low is not None:
            broken.append(f"coalesce({value} < {rule.low}, false) AND {judged}")
        if rule.high is not None:
            broken.append(f"coalesce({value} > {rule.high}, false) AND {judged}")
    return f"""
    WITH base AS (
      SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
    ), cut AS (
      SELECT r, doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
      FROM base
    ), windows AS (
      SELECT r, len(w) AS n, unnest(range(1, len(w) - 3)) AS i, w FROM cut WHERE len(w) >= 5
    ), hashed AS (
      SELECT r, i, md5(array_to_string(w[i:i + 4], ' ')) AS h FROM windows
    ), twice AS (
      SELECT r, i FROM hashed QUALIFY count(*) OVER (PARTITION BY r, h) > 1
    ), covered AS (
      SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY r
    ), measured AS (
      SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
        length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
        len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
        coalesce(covered.n, 0) AS n_repeat_words,
        len(list_filter(w, lambda x: x IN ({stop}))) AS n_stop_words,
        length(t) - length(regexp_replace(t, '{other}', '', 'g')) AS n_other_script,
        len(list_filter(lines, lambda x: regexp_matches(x, '^\\s*[-*•‣]'))) AS n_bullet_lines,
        len(list_filter(lines, lambda x: regexp_matches(x, '(\\.\\.\\.|…)\\s*$'))) AS n_cut_lines
      FROM cut LEFT JOIN covered USING (r)
    ), failed AS (
      SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM measured
    )
    SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
      CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
      CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
      NOT base_failed AND NOT ({" OR ".join(broken)}) AS kept
    FROM failed
    """


@query("op9_quality_rules", _rules_sql())
def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.judge(table(spark, folder, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query("op5_sharding")
def op5_sharding(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.shard(table(spark, folder, "documents").select("doc_id", "text"), shards=8)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op2_source_mixing")
def op2_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    return mixing.decide(docs, mixing.plan(docs)).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies",
        "shards",
    )


@query("op3_token_counts")
def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, folder, "documents").select("doc_id", "text")
    counted = token_counts.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), limit=1024)
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


@query("op6_secret_scan")
def op6_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.find_secrets(table(spark, folder, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: ~s["linked"])
    return found.select(
        "doc_id",
        *[
            F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
            for kind in ("assign", "access", "hex")
        ],
        F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )


def _guarded_sql(text: str) -> str:
    """Length of a text with its backslashes doubled and its control strings broken up."""
    return (
        f"(length({text}) + length({text}) - length(replace({text}, '\\', ''))"
        f" + len(regexp_extract_all({text}, '[<\\[]/?(?:s>|INST\\])')))"
    )


CHAT_SQL = f"""
    WITH said AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
      UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
    )
    SELECT conv_id, count(*) AS n_turns,
      sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
      CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
      sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), ''))
        AS loss_sha256,
      CAST(sum(8 + {_guarded_sql("role")} + length(role) - length(replace(role, chr(10), ''))
               + {_guarded_sql("text")} + CASE WHEN role = 'assistant' THEN 0 ELSE 15 END) AS BIGINT) AS formatted_chars
    FROM said GROUP BY conv_id
    """


@query("op4_chat_format", CHAT_SQL)
def op4_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], turns.schema)
    return chat_format.read_back(chat_format.format_conversations(turns.union(added)))


@query("op7_simhash_dedup")
def op7_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents").select("doc_id", "text"))


@query("op10_quality_classifier")
def op10_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    network = pu_classifier.fit(docs, table(spark, folder, "labels").select("doc_id", "quality"))
    return pu_classifier.score(docs, network).select("doc_id", "held_out", "score", "predicted")


# every passage against every segment, without an index; words as the operator's pattern cuts them
LEAK_SQL = f"""
    WITH parted AS (
      SELECT DISTINCT item_id, text,
        CASE WHEN regexp_matches(text, '(?s)^(.*[.!?\\n])\\s+(\\S.*)$')
             THEN regexp_extract(text, '(?s)^(.*[.!?\\n])\\s+(\\S.*)$', 1) ELSE text END AS question
      FROM (SELECT item_id, coalesce(text, '') AS text FROM benchmark)
    ), items AS (
      SELECT item_id, row_number() OVER () AS item, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+') AS w,
        len(regexp_extract_all(lower(question), '[\\p{{L}}\\p{{N}}_]+')) AS asked
      FROM parted
    ), item_words AS (
      SELECT item, unnest(w) AS term, unnest(range(len(w))) AS i FROM items
    ), tf AS (
      SELECT item, i // {decontaminate.SEGMENT} AS seg, term, count(*) AS tf FROM item_words GROUP BY ALL
    ), segments AS (
      SELECT item, seg, sum(tf) AS length FROM tf GROUP BY ALL
    ), stats AS (
      SELECT count(*) AS n, avg(length) AS mean FROM segments
    ), df AS (
      SELECT term, count(*) AS df FROM tf GROUP BY term
    ), weights AS (
      SELECT item, seg, term, ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * {decontaminate.K1 + 1}
        / (tf + {decontaminate.K1} * ({1 - decontaminate.B} + {decontaminate.B} * length / mean)) AS weight
      FROM tf JOIN df USING (term) JOIN segments USING (item, seg) CROSS JOIN stats
    ), impacts AS (
      SELECT item, seg, term, weight / sum(weight) OVER (PARTITION BY item, seg) AS impact FROM weights
    ), docs AS (
      SELECT row_number() OVER () AS doc, doc_id,
        regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{N}}_]+') AS w
      FROM documents
    ), doc_words AS (
      SELECT doc, unnest(w) AS term, unnest(range(len(w))) // {decontaminate.SEGMENT} AS half FROM docs
    ), passages AS (
      SELECT doc, half, term FROM doc_words UNION SELECT doc, half - 1, term FROM doc_words WHERE half > 0
    ), scores AS (
      SELECT doc, half, item, seg, sum(impact) AS score FROM passages JOIN impacts USING (term) GROUP BY ALL
      HAVING sum(impact) >= {decontaminate.THRESHOLD} - {decontaminate.ROUNDING}
    ), found AS (
      SELECT doc, item, max(score) AS score FROM scores GROUP BY ALL
    ), item_shingles AS (
      SELECT item, asked, len(w) AS n, unnest(range(greatest(1, len(w) - 4))) AS i, w FROM items WHERE len(w) > 0
    ), doc_text AS (
      SELECT doc, ' ' || array_to_string(w, ' ') || ' ' AS t FROM docs WHERE doc IN (SELECT doc FROM found)
    ), hits AS (
      SELECT doc, item, score, asked, n, i,
        contains(t, ' ' || array_to_string(w[i + 1:i + {decontaminate.SHINGLE}], ' ') || ' ') AS hit
      FROM found JOIN item_shingles USING (item) JOIN doc_text USING (doc)
    ), shares AS (
      SELECT doc, item, score, asked, n, CAST(count(*) FILTER (hit) AS DOUBLE) / count(*) AS overlap
      FROM hits GROUP BY ALL
    ), covered AS (
      SELECT DISTINCT doc, item, unnest(range(i, least(i + {decontaminate.SHINGLE}, n))) AS p FROM hits WHERE hit
    ), covers AS (
      SELECT doc, item, count(*) FILTER (p < asked) AS q, count(*) FILTER (p >= asked) AS a
      FROM covered JOIN (SELECT DISTINCT item, asked FROM item_shingles) USING (item) GROUP BY ALL
    ), judged AS (
      SELECT doc, item, score, overlap, CASE WHEN asked > 0 THEN CAST(q AS DOUBLE) / asked ELSE 1 END AS question_overlap,
        CASE WHEN n > asked THEN CAST(a AS DOUBLE) / (n - asked) ELSE 1 END AS answer_overlap
      FROM shares JOIN covers USING (doc, item)
    )
    SELECT doc_id, item_id, round(score, 9) AS score, overlap, question_overlap, answer_overlap
    FROM judged JOIN docs USING (doc) JOIN items USING (item)
    WHERE overlap >= {decontaminate.OVERLAP} AND question_overlap >= {decontaminate.PART_COVER}
      AND answer_overlap >= {decontaminate.PART_COVER}
    """


@query("op1_decontamination", LEAK_SQL)
def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    items = decontaminate.question_and_answer(table(spark, folder, "benchmark"))
    found = decontaminate.find_leaks(table(spark, folder, "documents").select("doc_id", "text"), items)
    return found.withColumn("score", F.round("score", 9))


@query("op8_html_extract")
def op8_html_extract(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    return html_extract.extract(pages).select("page_id", "url", "text", "n_chars", "n_shared")


COPIES_SQL = """
    WITH whole AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
    SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
      row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
    FROM whole
    """


@query("op13_exact_dedup", COPIES_SQL)
def op13_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.duplicates(table(spark, folder, "documents").select("doc_id", "text"))


# CRC-32 by its table, which the SQL makes itself; a node is told by its turns one after another
TRIE_SQL = """
    WITH crc AS (
      SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, [0, 0, 0, 0, 0, 0, 0, 0]),
        lambda c, z: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS t
    ), said AS (
      SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id
          ORDER BY turn NULLS FIRST, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS i
      FROM conversations
    ), known AS (
      SELECT conv_id, count(*) AS own, conv_id - conv_id % 20 AS base,
        xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: ascii(x))),
          lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8)), 4294967295) % 4 AS h
      FROM said CROSS JOIN crc GROUP BY conv_id, t
    ), lent AS (
      SELECT k.conv_id, s.i AS d, role, text FROM known k JOIN said s ON s.conv_id = k.base AND s.i <= k.h
    ), taken AS (
      SELECT conv_id, h, count(l.d) AS taken FROM known LEFT JOIN lent l USING (conv_id) GROUP BY ALL
    ), rebuilt AS (
      SELECT * FROM lent
      UNION ALL SELECT conv_id, i - h + taken, role, text FROM said JOIN taken USING (conv_id) WHERE i > h
    ), rows AS (
      SELECT conv_id, d, text, string_agg(sha256(length(role) || ':' || role || text), ',') OVER
        (PARTITION BY conv_id ORDER BY d ROWS UNBOUNDED PRECEDING) AS node
      FROM rebuilt UNION ALL SELECT conv_id, 0, '', '' FROM known
    ), lengths AS (
      SELECT conv_id, max(d) AS turns FROM rows GROUP BY conv_id
    ), nodes AS (
      SELECT node, d, min(conv_id) AS conv_id, count(*) AS n_convs, min(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'))) AS words,
        sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (d = turns), '')) AS ends_sha256
      FROM rows JOIN lengths USING (conv_id) GROUP BY node, d
    ), linked AS (
      SELECT n.*, p.conv_id AS parent_conv_id, p.node AS parent
      FROM nodes n LEFT JOIN rows r ON r.conv_id = n.conv_id AND r.d = n.d - 1 LEFT JOIN nodes p ON p.node = r.node AND p.d = r.d
    ), children AS (
      SELECT parent AS node, d - 1 AS d, count(*) AS n_children FROM linked WHERE d > 0 GROUP BY ALL
    ), own AS (
      SELECT l.*, coalesce(n_children, 0) AS n_children FROM linked l LEFT JOIN children USING (node, d)
    ), totals AS (
      SELECT r.node, r.d, count(*) FILTER (o.n_children = 0) AS n_leaves, sum((o.n_convs - 1) * o.words) AS saved_tokens
      FROM own o JOIN rows r ON r.conv_id = o.conv_id AND r.d <= o.d GROUP BY ALL
    )
    SELECT conv_id, d AS depth, parent_conv_id, n_convs, n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256
    FROM own JOIN totals USING (node, d)
    """


@query("op12_prefix_trie", TRIE_SQL)
def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.trie(table(spark, folder, "conversations").select("conv_id", "turn", "role", "text"))


# every document against every item
RANK_SQL = """
    WITH docs AS (
      SELECT row_number() OVER () AS doc, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS t
      FROM documents
    ), whole AS (
      SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(t)) AS BIGINT) AS n_terms FROM docs WHERE len(t) > 0
    ), wanted AS (
      SELECT DISTINCT item, item_id, term FROM (
        SELECT item, item_id, unnest(regexp_extract_all(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
        FROM (SELECT row_number() OVER () AS item, * FROM benchmark))
    ), tf AS (
      SELECT doc, doc_id, n, term, count(*) AS tf
      FROM (SELECT doc, doc_id, len(t) AS n, unnest(t) AS term FROM docs) WHERE term IN (SELECT term FROM wanted) GROUP BY ALL
    ), df AS (
      SELECT term, count(*) AS df FROM tf GROUP BY term
    ), weighed AS (
      SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w FROM df CROSS JOIN whole
    ), scores AS (
      SELECT item, item_id, doc, doc_id,
        sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_terms)))) AS score
      FROM wanted JOIN weighed USING (term) JOIN tf USING (term) CROSS JOIN whole GROUP BY ALL
    )
    SELECT item_id, CAST(row_number() OVER best AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score
    FROM scores WHERE score > 0
    WINDOW best AS (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST)
    QUALIFY row_number() OVER best <= 10
    """


@query("op11_lexical_search", RANK_SQL)
def op11_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical_search.rank_documents(table(spark, folder, "documents"), table(spark, folder, "benchmark"), k=10)
