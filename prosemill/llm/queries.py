"""The registered queries of the corpus operators, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from prosemill.llm import attention, curvepack, exactdedup, fim, hilbert, htmlmain, linededup, merkle, mixing, packing, quality, simhash, substring


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.passage_classes(table(spark, sf_dir, "documents"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.scored(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmlmain.main_text(table(spark, sf_dir, "pages"))


def op5_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.hilbert_shards(table(spark, sf_dir, "documents"), 40)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.line_dedup(table(spark, sf_dir, "documents"), 10)


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), 1024, 2)


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"))


def op9_attention_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attention.language_scores(table(spark, sf_dir, "documents"))


def op10_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"), 3)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return merkle.manifest_proofs(docs, merkle.lower_cased(docs))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(fim.fill_in_middle(table(spark, sf_dir, "documents")))


def op13_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curvepack.curve_packed(table(spark, sf_dir, "documents"), 2048, 1)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_substring_dedup,
        op2_exact_dedup,
        op3_quality_rules,
        op4_html_extraction,
        op5_hilbert_sharding,
        op6_line_dedup,
        op7_best_fit_packing,
        op8_source_mixing,
        op9_attention_scores,
        op10_simhash_dedup,
        op11_merkle_manifest,
        op12_fill_in_middle,
        op13_curve_packing,
    )
}

_UPPER, _LOWER = exactdedup.UPPER, exactdedup.LOWER
_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _field(c: str) -> str:
    return f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(_field(c) for c in (*merkle.FIELDS[:-1], text))})"


#: CRC-32 of the decimal doc_id, bit by bit.
_CRC = """xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
            lambda a, b: list_reduce([xor(a, b)] || [0::BIGINT, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""
_OTHERS = "ds[1:w.i % 16] || ds[w.i % 16 + 2:]"
_UP = f"sha256(array_to_string(ds[1:w.i % 16] || [w.d] || ds[w.i % 16 + 2:], '')), proof || array_to_string({_OTHERS}, '')"

ORACLE_SQL: dict[str, str] = {
    "op2_exact_dedup": f"""
        SELECT doc_id,
               max(doc_id) OVER same AS keep_id,
               count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept,
               sha256(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')) AS text_sha256
        FROM documents
        WINDOW same AS (PARTITION BY translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'))""",
    "op6_line_dedup": f"""
        WITH lines AS (
            SELECT doc_id, generate_subscripts(l, 1) AS i, unnest(l) AS line
            FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
        keyed AS (SELECT *, translate(trim(line, {_SPACES}), '{_UPPER}', '{_LOWER}') AS k FROM lines),
        gone AS (SELECT k FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT doc_id) >= 10)
        SELECT doc_id, count(*) AS n_lines, count(gone.k) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (gone.k IS NULL), '')) AS kept_sha256
        FROM keyed LEFT JOIN gone USING (k) GROUP BY doc_id""",
    "op11_merkle_manifest": f"""
        WITH RECURSIVE leafs AS (
            SELECT doc_id, source AS g, {_leaf('text')} AS d, {_CRC} % 5 = 0 AS hit, {_leaf(f"translate(text, '{_UPPER}', '{_LOWER}')")} AS changed FROM documents),
        placed AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id, d) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM leafs),
        nodes AS (
            SELECT g, 0 AS level, i, n, d FROM placed
            UNION ALL SELECT g, level + 1, i // 16, (n + 15) // 16, sha256(string_agg(d, '' ORDER BY i)) FROM nodes WHERE n > 1 GROUP BY g, level, i // 16, n),
        subs AS (SELECT g, d, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM nodes WHERE n = 1),
        tops AS (
            SELECT 0 AS level, i, n, d FROM subs
            UNION ALL SELECT level + 1, i // 16, (n + 15) // 16, sha256(string_agg(d, '' ORDER BY i)) FROM tops WHERE n > 1 GROUP BY level, i // 16, n),
        lists AS (SELECT g, level, i // 16 AS r, list(d ORDER BY i) AS ds FROM nodes WHERE n > 1 GROUP BY g, level, i // 16),
        top_lists AS (SELECT level, i // 16 AS r, list(d ORDER BY i) AS ds FROM tops WHERE n > 1 GROUP BY level, i // 16),
        walk AS (
            SELECT doc_id, g, i AS place, 0 AS level, i, n, CASE WHEN hit THEN coalesce(changed, d) ELSE d END AS d, '' AS proof FROM placed
            UNION ALL SELECT doc_id, w.g, place, w.level + 1, w.i // 16, (w.n + 15) // 16, {_UP}
                FROM walk w JOIN lists l ON l.g IS NOT DISTINCT FROM w.g AND l.level = w.level AND l.r = w.i // 16 WHERE w.n > 1),
        climb AS (
            SELECT doc_id, w.g, place, 0 AS level, s.i, s.n, w.d, proof, s.d AS subroot FROM walk w JOIN subs s ON s.g IS NOT DISTINCT FROM w.g WHERE w.n = 1
            UNION ALL SELECT doc_id, g, place, w.level + 1, w.i // 16, (w.n + 15) // 16, {_UP}, subroot
                FROM climb w JOIN top_lists l ON l.level = w.level AND l.r = w.i // 16 WHERE w.n > 1)
        SELECT c.doc_id, p.d AS leaf, subroot, t.d AS root, sha256(proof) AS proof_sha256, c.d AS folded_root, c.d = t.d AS verified, c.g AS source
        FROM climb c JOIN placed p ON p.g IS NOT DISTINCT FROM c.g AND p.i = c.place, (SELECT d FROM tops WHERE n = 1) t WHERE c.n = 1""",
    "op12_fill_in_middle": """
        WITH drawn AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
            [CAST('0x' || substr(sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')), 8 * k + 1, 8) AS BIGINT) FOR k IN range(4)] AS h FROM documents),
        cut AS (SELECT doc_id, text, len(u) AS n, u, least(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS a, greatest(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS b,
            CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 90 THEN 'plain' WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
        parts AS (SELECT doc_id, text, n, form, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:], '') AS s FROM cut)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
            sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(text) AS restored_sha256 FROM parts""",
}
