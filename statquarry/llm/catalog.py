"""The operators of this folder as registered queries, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statquarry.llm import (
    decontaminate, fill_middle, html_text, mixing, packing, periodic, quality, simhash, substring_dedup, suffix_dedup,
    tokens, toxicity, warc,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function

    return register


TOKENIZER = "word_bpe_49k.json"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query(
    "op3_substring_dedup",
    r"""
    WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
    win AS (SELECT doc_id, i, array_to_string(ws[i:i + 49], ' ') AS s
            FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w)),
    least AS (SELECT s, min(doc_id) AS first FROM win GROUP BY s),
    gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM win JOIN least USING (s) WHERE first < doc_id),
    words AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM w),
    left_over AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept FROM words ANTI JOIN gone USING (doc_id, p)
                  GROUP BY doc_id),
    removed AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
    SELECT doc_id, len(ws) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
    FROM w LEFT JOIN left_over USING (doc_id) LEFT JOIN removed USING (doc_id)""",
)
def op3_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cut = substring_dedup.remove_repeated_words(table(spark, folder, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query(
    "op4_suffix_dedup",
    """
    WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
    win AS (SELECT doc_id, i, md5(b[i:i + 399]) AS s
            FROM (SELECT doc_id, b, unnest(range(1, octet_length(b) - 398)) AS i FROM d)),
    twice AS (SELECT s FROM win GROUP BY s HAVING count(*) > 1),
    hit AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM win SEMI JOIN twice USING (s)),
    run AS (SELECT doc_id, i, sum(CASE WHEN before IS NULL OR i > before + 400 THEN 1 ELSE 0 END)
                   OVER (PARTITION BY doc_id ORDER BY i) AS run FROM hit),
    span AS (SELECT doc_id, min(i) AS low, max(i) + 400 AS high FROM run GROUP BY doc_id, run),
    gap AS (SELECT doc_id, b, unnest(list_concat([1], highs)) AS low, unnest(list_concat(lows, [octet_length(b) + 1])) AS high
            FROM d JOIN (SELECT doc_id, list(low ORDER BY low) AS lows, list(high ORDER BY low) AS highs FROM span
                         GROUP BY doc_id) USING (doc_id)),
    left_over AS (SELECT doc_id, unhex(string_agg(CASE WHEN high > low THEN hex(b[low:high - 1]) ELSE '' END, '' ORDER BY low))
                         AS kept FROM gap GROUP BY doc_id),
    removed AS (SELECT doc_id, sum(high - low)::BIGINT AS n, count(*) AS spans FROM span GROUP BY doc_id)
    SELECT doc_id, octet_length(b)::BIGINT AS n_bytes, coalesce(n, 0)::BIGINT AS n_removed,
           coalesce(spans, 0)::BIGINT AS n_spans, sha256(coalesce(kept, b)) AS kept_sha256
    FROM d LEFT JOIN left_over USING (doc_id) LEFT JOIN removed USING (doc_id)""",
)
def op4_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cut = suffix_dedup.remove_repeated_bytes(table(spark, folder, "documents"))
    return cut.select(
        "doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query("op8_simhash_dedup")
def op8_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_copies(table(spark, folder, "documents"), shingle=3, bits=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


@query("op1_token_counts")
def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counted = tokens.count_tokens(table(spark, folder, "documents"), public_tokenizers.path(TOKENIZER))
    return counted.withColumn("over_limit", F.col("n_tokens") > 2048)


@query("op10_best_fit_packing")
def op10_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), public_tokenizers.path(TOKENIZER), capacity=4096, end=1)


@query("op5_quality_rules")
def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    trusted = table(spark, folder, "labels").where("quality = 1").select("doc_id")
    return quality.quality(table(spark, folder, "documents"), trusted)


@query("op2_toxicity")
def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op7_decontamination")
def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark")).drop("key")


@query("op9_html_extraction")
def op9_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.main_texts(table(spark, folder, "pages")).withColumn("n_chars", F.char_length("text").cast("long"))


@query("op6_warc")
def op6_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(table(spark, folder, "pages"), least_bytes=0)


@query(
    "op11_fill_in_middle",
    """
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
                      sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS x FROM documents),
    h AS (SELECT *, len(u) AS n, ('0x' || x[1:8])::BIGINT AS h1, ('0x' || x[9:16])::BIGINT AS h2,
                 ('0x' || x[17:24])::BIGINT AS h3, ('0x' || x[25:32])::BIGINT AS h4 FROM d),
    f AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS low, greatest(h1 % (n + 1), h2 % (n + 1)) AS high,
                 CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90
                      THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
    p AS (SELECT *, array_to_string(u[1:low], '') AS pre, array_to_string(u[low + 1:high], '') AS mid,
                 array_to_string(u[high + 1:], '') AS suf FROM f)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                  ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256
    FROM p""",
)
def op11_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    return fill_middle.restore(fill_middle.fill_in_middle(table(spark, folder, "documents"))).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"
    )


@query("op12_periodic_runs")
def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    texts = periodic.with_planted_runs(table(spark, folder, "documents"))
    found = periodic.periodic_runs(texts, id="id")
    ranked = F.transform("runs", lambda r: F.struct(r["length"].alias("length"), -r["start"], -r["period"], r.alias("run")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.withColumn("longest", F.array_max(ranked)["run"]).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "longest.start", "longest.length", "longest.period",
        F.expr("1000 * longest.length div longest.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("kept").cast("binary"), 256).alias("collapsed_sha256"),
    )


@query(
    "op13_source_mix",
    r"""
    WITH RECURSIVE d AS (
        SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
               ('0x' || md5('1:' || doc_id || ':' || md5(coalesce(text, '')))[1:13])::BIGINT AS draw FROM documents),
    s AS (SELECT source, source_size, CAST(1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS DOUBLE) AS w
          FROM (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source)),
    -- sources by the level at which they reach three times their size: how far does the level rise if the first ones do?
    o AS (SELECT *, 3.0::DOUBLE * source_size AS cap, sum(source_size) OVER () AS total, row_number() OVER pre AS j,
                 coalesce(sum(3 * source_size) OVER pre, 0) - 3 * source_size AS held, sum(w) OVER () - sum(w) OVER pre + w AS open_w
          FROM s WINDOW pre AS (ORDER BY source_size / w, w, source ROWS UNBOUNDED PRECEDING)),
    level AS (SELECT arg_min((total - held)::DOUBLE / open_w, j) AS level FROM o
              WHERE cap > w * ((total - held)::DOUBLE / open_w)),
    t AS (SELECT source, source_size, least(w * coalesce(level, 0), cap) AS target FROM o, level),
    m AS (SELECT d.*, source_size, target, floor(least(3.0::DOUBLE, target / nullif(source_size, 0)))::BIGINT AS whole,
                 least(3.0::DOUBLE, target / nullif(source_size, 0)) - whole AS chance
          FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
    q AS (SELECT *, (draw + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u FROM m),
    r AS (SELECT *, (u / (1.0::DOUBLE - u)) / (chance / (1.0::DOUBLE - chance)) AS odds FROM q WHERE chance > 0 AND size > 0),
    k AS (SELECT *, floor(odds / (1.0::DOUBLE + odds) * 1125899906842624.0::DOUBLE)::BIGINT AS rank FROM r),
    b AS (SELECT source, target - sum(whole * size)::BIGINT AS rest FROM m GROUP BY source, target),
    c AS (SELECT k.*, rest, sum(size) OVER (PARTITION BY k.source ORDER BY rank, doc_id) AS upto
          FROM k JOIN b ON k.source IS NOT DISTINCT FROM b.source),
    gap AS (SELECT source, rest - coalesce(max(upto) FILTER (upto <= rest), 0) AS gap FROM c GROUP BY source, rest),
    later AS (SELECT source, doc_id, size, rank, length(bin(size)) AS class FROM c WHERE upto > rest),
    best AS (SELECT * FROM later QUALIFY row_number() OVER (PARTITION BY source, class ORDER BY rank, doc_id) <= 4),
    cand AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY class DESC, rank, doc_id) AS j FROM best),
    fold AS (SELECT source, 0::BIGINT AS j, gap, NULL::BIGINT AS doc_id FROM gap
             UNION ALL
             SELECT f.source, f.j + 1, CASE WHEN x.size <= f.gap THEN f.gap - x.size ELSE f.gap END,
                    CASE WHEN x.size <= f.gap THEN x.doc_id END
             FROM fold f JOIN cand x ON x.source IS NOT DISTINCT FROM f.source AND x.j = f.j + 1),
    filled AS (SELECT source, min(gap) AS gap FROM fold GROUP BY source),
    nearest AS (SELECT arg_min(x.doc_id, (abs(x.size - f.gap), x.j)) AS doc_id
                FROM cand x JOIN filled f ON x.source IS NOT DISTINCT FROM f.source
                WHERE x.size < 2 * f.gap AND x.doc_id NOT IN (SELECT doc_id FROM fold WHERE doc_id IS NOT NULL) GROUP BY x.source),
    more AS (SELECT doc_id FROM c WHERE upto <= rest UNION ALL SELECT doc_id FROM fold WHERE doc_id IS NOT NULL
             UNION ALL SELECT doc_id FROM nearest)
    SELECT m.doc_id, size, source_size, target,
           size * (coalesce(whole, 0) + CASE WHEN more.doc_id IS NULL THEN 0 ELSE 1 END)::BIGINT AS taken
    FROM m LEFT JOIN more USING (doc_id)""",
)
def op13_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    found = mixing.mixed(table(spark, folder, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken")
