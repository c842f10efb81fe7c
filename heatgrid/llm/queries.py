"""The operators of this package as registered queries over whole tables, with oracle SQL where SQL can tell."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heatgrid.llm import (
    bpe,
    exact_dedup,
    hilbert,
    html_wrappers,
    licenses,
    line_dedup,
    mixing,
    near_dedup,
    periodic,
    pii,
    preference,
    quality,
    token_alignment,
    tokenizer_files,
)
from heatgrid.llm.shared import documents, stored

BPE_FILE = "byte_bpe_multi_50k.tiktoken"
# The vocabulary of byte_bpe_50k.json as ranks, which a faster library reads; tests hold the ids against it.
RANK_FILE = "byte_bpe_50k.tiktoken"
PIECE_FILE = "piece_bpe_32k.model"

SHARDS = 24
ENTROPY_PART = 0.95
MAX_REPEATS = 4.0


def op1_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, sf_dir), entropy_part=ENTROPY_PART, max_repeats=MAX_REPEATS)
    return mixed.drop("fingerprint")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark_duplicates(documents(spark, sf_dir))


def op3_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    dimensions = ["source", "lang", "n_chars", "doc_id"]
    return hilbert.curve_sharded(documents(spark, sf_dir), dimensions, SHARDS).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit(hilbert.LAW).alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "curve",
    )


def op4_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return preference.preference_examples(preference.branched(conversations))


def op5_quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = stored(quality.text_counts(documents(spark, sf_dir), "doc_id"), "counts")
    return quality.judged(counts).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality"
    )


def op6_context_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(pii.find_personal_data(documents(spark, sf_dir)), [*pii.KINDS, *pii.SEEDS])


def op7_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = near_dedup.near_duplicates(documents(spark, sf_dir))
    kept = (F.col("node") == F.col("keep_node")) & F.col("doc_id").eqNullSafe(F.col("class_id"))
    return marked.select("doc_id", "class_id", "class_size", kept.alias("kept"), F.hex("node").alias("text_md5"))


def op8_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(BPE_FILE)
    return bpe.round_trip_digests(documents(spark, sf_dir), path, public_tokenizers.PATTERN)


def op9_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.recognise(documents(spark, sf_dir))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.clean(documents(spark, sf_dir)).select(
        F.col("row.doc_id").alias("doc_id"), F.col("clean_text").alias("text"), "n_lines", "n_removed"
    )


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.run_digests(periodic.periodic_runs(periodic.planted(documents(spark, sf_dir))))


def op12_html_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_wrappers.main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def load_aligner() -> token_alignment.Aligner:
    path = public_tokenizers.path
    return tokenizer_files.aligner(path(RANK_FILE), public_tokenizers.PATTERN, path(PIECE_FILE))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = token_alignment.align(documents(spark, sf_dir), load_aligner, digest=True)
    return token_alignment.scored(aligned).select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        "n_best",
        "count_sum",
        F.col("groups").alias("groups_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_temperature_mix": op1_temperature_mix,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_hilbert_shards": op3_hilbert_shards,
    "op4_preference_pairs": op4_preference_pairs,
    "op5_quality_votes": op5_quality_votes,
    "op6_context_pii": op6_context_pii,
    "op7_dart_minhash": op7_dart_minhash,
    "op8_bpe_round_trip": op8_bpe_round_trip,
    "op9_license_rules": op9_license_rules,
    "op10_line_dedup": op10_line_dedup,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_html_wrappers": op12_html_wrappers,
    "op13_token_alignment": op13_token_alignment,
}

WORD = r"[^\x20\x09-\x0D]+"


def license_sql() -> str:
    """Both ways to cut a text, then the lookup and the rules, all from the operator's own tables."""

    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    known = ", ".join(f"{quoted(sentence)}: {quoted(name)}" for sentence, name in licenses.known_sentences().items())
    rules = " ".join(f"WHEN regexp_matches(ids, {quoted(rule)}) THEN {quoted(name)}" for name, rule in licenses.RULES)
    every = ", ".join(
        f"CASE WHEN regexp_matches(ids, {quoted(rule)}) AND NOT regexp_matches(ids, {quoted(unless)}) THEN {quoted(name)} END"
        for name, rule, unless in licenses.rules_by_name()
    )

    def cut(text: str) -> str:
        return f"string_split(regexp_replace({text}, {quoted(licenses.CUT)}, '\\1' || chr(10), 'g'), chr(10))"

    def parted(cuts: str) -> str:
        expression = f"regexp_replace(regexp_replace(s, {quoted(licenses.SPDX_LINE)}, ''), {quoted(licenses.SPDX_EXCEPTION)}, '', 'g')"
        each = f"list_transform(regexp_split_to_array({expression}, {quoted(licenses.SPDX_BETWEEN)}), lambda x: 'spdx-license-identifier: ' || x)"
        return f"flatten(list_transform({cuts}, lambda s: CASE WHEN regexp_matches(s, {quoted(licenses.SPDX_LINE)}) THEN {each} ELSE [s] END))"

    def found(cuts: str) -> str:
        names = f"list_transform({parted(cuts)}, lambda s: known[trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g'))])"
        return f"coalesce(array_to_string(list_filter({names}, lambda i: i IS NOT NULL), ' '), '')"

    plain = f"regexp_replace(t, {quoted(licenses.COMMENT)}, '\\1', 'g')"
    plain = f"regexp_replace({plain}, {quoted(licenses.LIST_MARK)}, chr(10) || chr(10), 'g')"
    plain = f"regexp_replace({plain}, {quoted(licenses.BEFORE_LIST)}, '\\1:' || chr(10) || chr(10), 'g')"
    paragraphs = f"regexp_split_to_array({plain}, {quoted(licenses.PARAGRAPH)})"
    wrapped = f"flatten(list_transform({paragraphs}, lambda p: {cut("replace(p, chr(10), ' ')")}))"
    return f"""
        WITH texts AS (SELECT doc_id, coalesce(text, '') AS t, MAP {{{known}}} AS known FROM documents),
        found AS (SELECT doc_id, {found(cut('t'))} AS sentence_ids, {found(wrapped)} AS wrapped_ids FROM texts),
        both_ids AS (SELECT *, ' ' || sentence_ids || ' | ' || wrapped_ids || ' ' AS ids FROM found)
        SELECT doc_id, CASE {rules} ELSE '' END AS licence, coalesce(array_to_string(list_filter([{every}], lambda i: i IS NOT NULL), ','), '') AS licences,
               sentence_ids, wrapped_ids FROM both_ids"""


ORACLES: dict[str, str] = {
    "op1_temperature_mix": f"""
        WITH RECURSIVE rows_in AS (
            SELECT doc_id, coalesce(source, '') AS source, md5(coalesce(text, '')) AS fingerprint,
                   CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) + 1 AS BIGINT) AS cost
            FROM documents),
        sources AS (SELECT source, CAST(sum(cost) AS DOUBLE) AS tokens FROM rows_in GROUP BY source),
        facts AS (
            SELECT sum(tokens) AS total, list(tokens ORDER BY source) AS sizes,
                   {ENTROPY_PART} * ln(CAST(count(*) AS DOUBLE)) AS target
            FROM sources),
        spread AS (  -- largest exponent with the entropy wanted, in units of 2 ** -30
            SELECT 0 AS step, CAST(0 AS BIGINT) AS low, CAST(1073741824 AS BIGINT) AS high
            UNION ALL
            SELECT step + 1, CASE WHEN enough THEN middle ELSE low END, CASE WHEN enough THEN high ELSE middle END
            FROM (SELECT *, ln(list_sum(powers)) - list_sum(list_transform(list_zip(powers, shares), lambda x: x[1] * ln(x[2])))
                         * (middle / 1073741824.0::DOUBLE) / list_sum(powers) >= target AS enough
                  FROM (SELECT *, list_transform(shares, lambda x: pow(x, middle / 1073741824.0::DOUBLE)) AS powers
                        FROM (SELECT step, low, high, (low + high) // 2 AS middle, target,
                                     list_transform(sizes, lambda x: x / total) AS shares
                              FROM spread, facts WHERE high - low > 1)))),
        unmixed AS (
            SELECT -list_sum(list_transform(sizes, lambda x: x / total * ln(x / total))) >= target AS spread_enough FROM facts),
        wide AS (
            SELECT CASE WHEN spread_enough THEN 1073741824 ELSE (SELECT max(low) FROM spread) END AS a FROM unmixed),
        seldom AS (  -- smallest exponent without too many repeats
            SELECT 0 AS step, CAST(0 AS BIGINT) AS low, CAST(1073741824 AS BIGINT) AS high
            UNION ALL
            SELECT step + 1, CASE WHEN enough THEN low ELSE middle END, CASE WHEN enough THEN middle ELSE high END
            FROM (SELECT *, list_max(list_transform(list_zip(powers, sizes), lambda x: x[1] / x[2])) * total
                         / list_sum(powers) <= {MAX_REPEATS} AS enough
                  FROM (SELECT *, list_transform(sizes, lambda x: pow(x / total, middle / 1073741824.0::DOUBLE)) AS powers
                        FROM (SELECT step, low, high, (low + high) // 2 AS middle, total, sizes
                              FROM seldom, facts WHERE high - low > 1)))),
        limited AS (
            SELECT list_max(list_transform(sizes, lambda x: pow(x / total, a / 1073741824.0::DOUBLE) / x)) * total
                   / list_sum(list_transform(sizes, lambda x: pow(x / total, a / 1073741824.0::DOUBLE))) <= {MAX_REPEATS} AS ok, a
            FROM facts, wide),
        chosen AS (
            SELECT (CASE WHEN ok THEN a ELSE (SELECT min(high) FROM seldom) END) / 1073741824.0::DOUBLE AS a FROM limited),
        plan AS (
            SELECT source, CAST(tokens AS BIGINT) AS tokens,
                   CAST(floor(pow(tokens / total, a) / list_sum(list_transform(sizes, lambda x: pow(x / total, a))) * total)
                        AS BIGINT) AS quota,
                   greatest(1, CAST(total AS BIGINT) // {mixing.BLOCK_TOKENS}) AS blocks
            FROM sources, facts, chosen),
        dealt AS (
            SELECT *, md5(concat_ws('|', '0', epoch, doc_id, fingerprint)) AS key
            FROM (SELECT r.*, quota, blocks, CAST(unnest(range(0, CAST(ceil(quota / tokens) AS BIGINT))) AS INT) AS epoch
                  FROM rows_in r JOIN plan p ON r.source = p.source WHERE quota > 0)),
        placed AS (
            SELECT *, coalesce(sum(cost) OVER (PARTITION BY source ORDER BY epoch, key
                                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
            FROM dealt),
        blocked AS (
            SELECT *, CAST(floor(CAST(before AS DOUBLE) * blocks / quota) AS BIGINT) AS block FROM placed WHERE before < quota)
        SELECT doc_id, source, epoch, cost AS n_tokens, block,
               row_number() OVER (PARTITION BY block ORDER BY key, source, doc_id) - 1 AS slot
        FROM blocked""",
    "op2_exact_dedup": """
        WITH norm AS (
            SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
            FROM documents)
        SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
        FROM norm""",
    "op4_preference_pairs": """
        WITH ids AS (
            SELECT conv_id, row_number() OVER (ORDER BY conv_id) - 1 AS r
            FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)),
        answers AS (
            SELECT conv_id, min(turn) AS first, max(turn) AS last
            FROM conversations WHERE role = 'assistant' GROUP BY conv_id),
        told AS (SELECT i.conv_id, r, first, last FROM ids i JOIN answers a ON i.conv_id = a.conv_id),
        forks AS (
            SELECT a.conv_id, b.conv_id AS other, CASE WHEN a.r % 2 = 0 THEN a.last ELSE a.first END AS cut,
                   CASE WHEN a.r % 2 = 0 THEN b.last ELSE b.first END AS other_cut
            FROM told a JOIN told b ON b.r = a.r + 1),
        both_sides AS (
            SELECT conv_id, 'chosen' AS side, turn, role, text FROM conversations
            UNION ALL
            SELECT c.conv_id, 'rejected', turn, role, text
            FROM conversations c LEFT JOIN forks f ON c.conv_id = f.conv_id WHERE cut IS NULL OR turn < cut
            UNION ALL
            SELECT f.conv_id, 'rejected', turn - other_cut + cut, role, text
            FROM forks f JOIN conversations c ON c.conv_id = f.other WHERE turn >= other_cut),
        placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id, side ORDER BY turn) AS pos FROM both_sides),
        partings AS (
            SELECT coalesce(a.conv_id, b.conv_id) AS conv_id,
                   min(CASE WHEN a.pos IS NULL OR b.pos IS NULL OR a.role <> b.role OR a.text <> b.text
                            THEN coalesce(a.pos, b.pos) END) AS parting
            FROM (FROM placed WHERE side = 'chosen') a
            FULL JOIN (FROM placed WHERE side = 'rejected') b ON a.conv_id = b.conv_id AND a.pos = b.pos
            GROUP BY 1),
        sides AS (
            SELECT p.conv_id, pos, side, role, text, pos < coalesce(parting, 1e9) AS shared,
                   '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS shown
            FROM placed p JOIN partings q ON p.conv_id = q.conv_id),
        ends AS (
            SELECT *, sum(length(shown)) OVER (PARTITION BY conv_id, side, shared ORDER BY pos) AS stop FROM sides)
        SELECT conv_id AS pair_id,
               CAST(count(*) FILTER (shared AND side = 'chosen') AS INT) AS n_common,
               coalesce(string_agg(shown, '' ORDER BY pos) FILTER (shared AND side = 'chosen'), '') AS prompt,
               coalesce(string_agg(shown, '' ORDER BY pos) FILTER (NOT shared AND side = 'chosen'), '') AS chosen,
               coalesce(string_agg(shown, '' ORDER BY pos) FILTER (NOT shared AND side = 'rejected'), '') AS rejected,
               coalesce(string_agg((stop - length(text) - 8) || ':' || stop, ',' ORDER BY pos)
                        FILTER (NOT shared AND side = 'chosen' AND role = 'assistant'), '') AS chosen_spans,
               coalesce(string_agg((stop - length(text) - 8) || ':' || stop, ',' ORDER BY pos)
                        FILTER (NOT shared AND side = 'rejected' AND role = 'assistant'), '') AS rejected_spans
        FROM ends GROUP BY conv_id""",
    "op9_license_rules": license_sql(),
    "op10_line_dedup": f"""
        WITH lines AS (
            SELECT doc_id, coalesce(source, '') AS site, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
            FROM documents),
        wordy AS (SELECT * FROM lines WHERE regexp_matches(line, '{line_dedup.wordy(line_dedup.MIN_WORDS)}')),
        spread AS (
            SELECT line, min(doc_id) AS first_doc FROM wordy
            GROUP BY line HAVING count(DISTINCT site) >= CASE
                WHEN regexp_matches(line, '{line_dedup.wordy(line_dedup.LONG_WORDS)}') THEN {line_dedup.LONG_SITES}
                ELSE {line_dedup.MIN_SITES} END),
        marked AS (
            SELECT l.*, s.line IS NOT NULL AND l.doc_id <> s.first_doc AS removed
            FROM lines l LEFT JOIN spread s ON l.line = s.line)
        SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT removed), '') AS text,
               count(*) AS n_lines, CAST(count(*) FILTER (removed) AS BIGINT) AS n_removed
        FROM marked GROUP BY doc_id""",
}
