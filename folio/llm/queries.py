"""The registered queries of this subpackage and their DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm.ann import multiprobe_search
from folio.llm.decontaminate import template_leaks
from folio.llm.first_fit import first_fit_packing
from folio.llm.html_extract import consensus_extraction
from folio.llm.jaccard_join import grouped_prefix_join
from folio.llm.line_dedup import line_dedup
from folio.llm.packing import best_fit_packing
from folio.llm.periodic import longest_run, periodic_runs
from folio.llm.quality import co_trained_quality
from folio.llm.resampling import importance_resample
from folio.llm.substring_dedup import relative_lz_dedup
from folio.llm.suffix_dedup import suffix_array_dedup
from folio.llm.toxicity import compression_toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relative_lz_dedup(spark, _table(spark, sf_dir, "documents")).drop("factors")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing(spark, _table(spark, sf_dir, "documents")).drop("certified")


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouped_prefix_join(spark, _table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_array_dedup(spark, _table(spark, sf_dir, "documents"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return consensus_extraction(spark, _table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op6_multiprobe_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiprobe_search(spark, _table(spark, sf_dir, "embeddings"))


def op7_co_trained_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return co_trained_quality(spark, _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")).drop("crc")


def op8_compression_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression_toxicity(spark, _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return template_leaks(spark, _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("crc")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(spark, _table(spark, sf_dir, "documents"))


def op11_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resample(spark, _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("n_words")


def planted_loops(docs: DataFrame) -> DataFrame:
    """Documents of op12's contract: where crc32(doc_id) % 10 = 0, the words from a on repeat the first p of them."""
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(crc / 10)
    own = F.struct(words.alias("w"), g.alias("g"))

    def rewrite(s: F.Column) -> F.Column:
        n = F.size(s.w)
        a = (s.g % n).cast("int")
        looped = F.transform(F.array(F.struct(s.w.alias("w"), n.alias("n"), a.alias("a"), (1 + F.floor((n - a) / (3 + s.g % 8))).cast("int").alias("p"))),
                             lambda t: F.array_join(F.transform(F.sequence(F.lit(0), t.n - 1), lambda i: F.get(t.w, F.when(i < t.a, i).otherwise(t.a + (i - t.a) % t.p))), " "))
        return F.when(n > 0, looped[0])

    return docs.select("doc_id", F.when(crc % 10 == 0, F.transform(F.array(own), rewrite)[0]).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(spark, planted_loops(_table(spark, sf_dir, "documents")))
    best = longest_run(F.col("runs"))
    lines = F.transform("runs", lambda r: F.concat(r.start.cast("string"), F.lit(","), r.length.cast("string"), F.lit(","), r.period.cast("string"), F.lit("\n")))
    return (found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("kept_text").cast("binary"), 256).alias("collapsed_sha256")))


def op13_first_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_fit_packing(spark, _table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
    "op4_suffix_array_dedup": op4_suffix_array_dedup,
    "op5_html_extraction": op5_html_extraction,
    "op6_multiprobe_neighbours": op6_multiprobe_neighbours,
    "op7_co_trained_quality": op7_co_trained_quality,
    "op8_compression_toxicity": op8_compression_toxicity,
    "op9_template_decontamination": op9_template_decontamination,
    "op10_line_dedup": op10_line_dedup,
    "op11_target_resampling": op11_target_resampling,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_first_fit_packing": op13_first_fit_packing,
}

SPACE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLE: dict[str, str] = {
    "op10_line_dedup": f"""
        WITH lines AS (
            SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS place
            FROM documents),
        keyed AS (SELECT *, {LOWER.format(f"trim(line, {SPACE})")} AS key FROM lines),
        frequent AS (
            SELECT key, max(doc_id) AS last FROM (SELECT DISTINCT key, doc_id FROM keyed WHERE length(key) >= 40)
            GROUP BY key HAVING count(*) >= 5),
        judged AS (SELECT k.*, f.key IS NOT NULL AND k.doc_id < f.last AS gone FROM keyed k LEFT JOIN frequent f ON k.key = f.key)
        SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
        FROM judged GROUP BY doc_id""",
    "op1_substring_dedup": """
        WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
        windows AS (
            SELECT doc_id, place, hash(list_slice(w, place, place + 12)) AS h
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS place FROM words)),
        firsts AS (SELECT h, min(doc_id) AS first FROM windows GROUP BY h),
        gone AS (SELECT DISTINCT doc_id, unnest(range(place, place + 13)) AS place FROM windows JOIN firsts USING (h) WHERE first < doc_id),
        each AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM words),
        kept AS (
            SELECT e.doc_id, count(*) FILTER (WHERE g.place IS NOT NULL) AS n_removed,
                   string_agg(word, ' ' ORDER BY e.place) FILTER (WHERE g.place IS NULL) AS text
            FROM each e LEFT JOIN gone g ON e.doc_id = g.doc_id AND e.place = g.place GROUP BY e.doc_id)
        SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(k.n_removed, 0) AS BIGINT) AS n_removed,
               sha256(coalesce(k.text, '')) AS kept_sha256
        FROM words d LEFT JOIN kept k USING (doc_id)""",
}
# CRC-32 of a text's UTF-8 bytes; ``crc_table`` has one row, the 256 values of the reflected polynomial
CRC_TABLE = """crc_table AS (
            SELECT list(list_reduce(list_prepend(b, [0, 1, 2, 3, 4, 5, 6, 7]), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS steps
            FROM (SELECT unnest(range(256)) AS b))"""
CRC = """xor(4294967295, list_reduce(
                list_prepend(4294967295, list_transform(range(octet_length(encode({0}))), lambda i: CAST('0x' || substr(hex(encode({0})), 2 * i + 1, 2) AS BIGINT))),
                lambda c, b: xor(c >> 8, steps[1 + (xor(c, b) & 255)])))"""
ORACLE["op11_target_resampling"] = f"""
        WITH {CRC_TABLE},
        texts AS (SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
        wanted AS (SELECT regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
        own AS (SELECT doc_id, unnest(w) AS word FROM texts),
        goal AS (SELECT unnest(w) AS word FROM wanted),
        hashed AS (SELECT word, {CRC.format("word")} % 10000 AS bucket
                   FROM (SELECT word FROM own UNION SELECT word FROM goal), crc_table),
        counted AS (
            SELECT bucket, sum(s) AS s, sum(t) AS t
            FROM (SELECT word, count(*) AS s, 0 AS t FROM own GROUP BY word UNION ALL SELECT word, 0, count(*) FROM goal GROUP BY word) JOIN hashed USING (word)
            GROUP BY bucket),
        gains AS (
            SELECT bucket, floor(1000 * ln((CAST(t + 1 AS DOUBLE) * CAST(sum(s) OVER () + 10000 AS DOUBLE)) /
                                           (CAST(s + 1 AS DOUBLE) * CAST(sum(t) OVER () + 10000 AS DOUBLE)))) AS gain FROM counted),
        weights AS (SELECT doc_id, count(*) AS n, CAST(floor(sum(gain) / count(*)) AS BIGINT) AS weight FROM own JOIN hashed USING (word) JOIN gains USING (bucket) GROUP BY doc_id),
        scored AS (
            SELECT doc_id, len(w) AS n_features, coalesce(weight, 0) AS weight,
                   coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
            FROM texts LEFT JOIN weights USING (doc_id)),
        ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, 10 * count(*) OVER () // 100 AS drawn FROM scored WHERE n_features >= 20)
        SELECT doc_id, n_features, weight, score, CASE WHEN rank <= drawn THEN rank END AS rank FROM scored LEFT JOIN ranked USING (doc_id)"""
ORACLE["op12_periodic_runs"] = f"""
        WITH {CRC_TABLE},
        texts AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w, {CRC.format("CAST(doc_id AS VARCHAR)")} AS h FROM documents, crc_table),
        placed AS (SELECT doc_id, w, h, len(w) AS n, (h // 10) % greatest(len(w), 1) AS a, (h // 10) % 8 AS d FROM texts),
        looped AS (
            SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
                THEN list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + d)) END]) ELSE w END AS w
            FROM placed),
        each AS (SELECT doc_id, unnest(w) AS word, unnest(range(n)) AS i FROM looped),
        grams AS (SELECT doc_id, n, hash(list_slice(w, i + 1, i + 5)) AS g, i FROM (SELECT doc_id, n, w, unnest(range(n - 4)) AS i FROM looped)),
        pairs AS (SELECT x.doc_id, y.i - x.i AS q, x.i FROM grams x JOIN grams y ON x.doc_id = y.doc_id AND x.g = y.g AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
        islands AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pairs),
        matches AS (SELECT doc_id, q, min(i) AS start, count(*) + 4 + q AS length FROM islands GROUP BY doc_id, q, island HAVING count(*) + 4 + q >= greatest(6, 4 * q)),
        runs AS (
            SELECT * FROM matches m WHERE NOT EXISTS (
                SELECT 1 FROM matches o WHERE o.doc_id = m.doc_id AND o.q < m.q AND o.start <= m.start AND o.start + o.length >= m.start + m.length)),
        told AS (
            SELECT doc_id, count(*) AS n_runs, arg_min({{'start': start, 'length': length, 'period': q}}, (-length, start, q)) AS best,
                   sha256(string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q)) AS runs_sha256
            FROM runs GROUP BY doc_id),
        gone AS (SELECT DISTINCT doc_id, unnest(range(start + q, start + length)) AS i FROM runs),
        kept AS (SELECT e.doc_id, string_agg(word, ' ' ORDER BY e.i) AS text FROM each e ANTI JOIN gone g ON e.doc_id = g.doc_id AND e.i = g.i GROUP BY e.doc_id)
        SELECT l.doc_id, coalesce(n_runs, 0) AS n_runs, best.start AS start, best.length AS length, best.period AS period,
               CAST(floor(1000 * best.length / best.period) AS BIGINT) AS exponent_milli,
               coalesce(runs_sha256, sha256('')) AS runs_sha256, sha256(coalesce(k.text, '')) AS collapsed_sha256
        FROM looped l LEFT JOIN told t ON l.doc_id = t.doc_id LEFT JOIN kept k ON l.doc_id = k.doc_id"""
