"""The registered queries of the training-data operators, and their SQL.

Each query applies its operator, with production parameters, to its whole table and
derives the columns of its contract from what the operator returns."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_repair_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from churnpanel.functions.scale import stage_path
    from churnpanel.llm.token_shards import read_digests, write_shards

    path = stage_path(spark, "token-shards")
    write_shards(_documents(spark, sf_dir), path, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return read_digests(spark, path)


def op2_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    from churnpanel.llm.suffix_dedup import digest, remove_repeats

    return digest(remove_repeats(_documents(spark, sf_dir)))


def op3_bayes_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from churnpanel.llm.near_dedup import near_duplicates

    return near_duplicates(_documents(spark, sf_dir), shingle=3, percent=85).select(
        "doc_id", "n_shingles", "component_id", "kept")


def op4_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each benchmark item that a document contains."""
    from churnpanel.llm.decontaminate import contained_items

    return contained_items(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(
        "doc_id", "item_id", "n_item", "n_shared")


def op5_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from churnpanel.llm.line_templates import drop_template_lines

    return drop_template_lines(_documents(spark, sf_dir)).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


#: Where documents of a source belong; other sources are "other".
DOMAINS = {f"src{i}": ("web", "books", "code", "news")[i % 4] for i in range(20)}
#: Target weights of the mixing tree, by path; nodes that are not named weigh 1.
WEIGHTS = {
    ("web",): 4, ("books",): 3, ("code",): 2, ("news",): 2,
    ("web", "en"): 6, ("web", "de"): 2, ("books", "en"): 3, ("books", "fr"): 3,
    ("web", "en", "src0"): 2, ("news", "es", "src3"): 3,
}


def with_domain(docs: DataFrame) -> DataFrame:
    named = F.create_map(*[F.lit(x) for pair in DOMAINS.items() for x in pair])
    return docs.withColumn("domain", F.coalesce(F.try_element_at(named, F.col("source")), F.lit("other")))


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mix of as many tokens as the corpus has, with up to three epochs."""
    from churnpanel.llm.mixing import mix_sources, word_count

    docs = with_domain(_documents(spark, sf_dir)).select(
        "doc_id", "domain", "lang", "source", word_count("text").alias("n_tokens"))
    return mix_sources(docs, ["domain", "lang", "source"], "n_tokens", F.col("all_tokens"), WEIGHTS, epochs=3, seed=17)


def op7_suffix_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    from churnpanel.llm.automaton_dedup import remove_repeated_windows

    return remove_repeated_windows(_documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op8_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    from churnpanel.llm.compression_bands import with_quality

    return with_quality(_documents(spark, sf_dir).select("doc_id", "text"), keep_text=False)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from churnpanel.llm.token_counts import with_token_counts

    docs = _documents(spark, sf_dir).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return with_token_counts(docs, public_tokenizers.path("piece_bpe_32k.model")).select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "n_tokens",
        (F.col("n_tokens") > 4096).alias("over_limit"))


def op10_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    from churnpanel.llm.toxicity import score_toxicity

    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    return score_toxicity(docs, labels).select("doc_id", "held_out", "score", "predicted")


def op11_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoded, then decoded from the ids alone."""
    from churnpanel.llm.bpe_transducer import with_decoded_text, with_token_ids

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ids = with_token_ids(_documents(spark, sf_dir).select("doc_id", "text"), path, public_tokenizers.PATTERN).drop("text")
    joined = F.array_join(F.col("token_ids").cast("array<string>"), " ")
    digests = ids.select("doc_id", "token_ids", F.size("token_ids").cast("long").alias("n_tokens"),
                         F.sha2(joined.cast("binary"), 256).alias("ids_sha256"))
    return with_decoded_text(digests, path).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """Every tenth document (by the hash of its id) made periodic from one word on."""
    words = docs.withColumn("_h", F.crc32(F.col("doc_id").cast("string").cast("binary")))
    split = words.withColumn("_w", F.when(F.col("_h") % 10 == 0, F.array_remove(F.split(
        F.coalesce("text", F.lit("")), "[\\x20\\x09-\\x0D]+"), "")))
    g, n = F.floor(F.col("_h") / 10), F.size("_w").cast("long")
    split = split.withColumns({"_a": F.when(n > 0, g % n), "_p": F.when(n > 0, 1 + F.floor((n - g % n) / (3 + g % 8)))})
    again = F.transform("_w", lambda w, i: F.when(i < F.col("_a"), w).otherwise(
        F.get("_w", (F.col("_a") + (i - F.col("_a")) % F.col("_p")).cast("int"))))
    changed = F.when(F.col("_p").isNotNull(), F.array_join(again, " ")).otherwise(F.col("text"))
    return split.withColumn("text", changed).drop("_h", "_w", "_a", "_p")


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from churnpanel.llm.periodic_runs import with_runs

    found = with_runs(with_planted_periods(_documents(spark, sf_dir).select("doc_id", "text")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.withColumn("_best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("_best.start")).alias("start"),
        F.col("_best.length").alias("length"), (-F.col("_best.period")).alias("period"),
        F.floor(F.col("_best.length") * 1000 / -F.col("_best.period")).cast("long").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from churnpanel.llm.filter_audit import RULES, audit, document_counts

    docs = _documents(spark, sf_dir).select("doc_id", "text", "lang")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality", "toxic")
    return audit(document_counts(docs, labels), RULES)


def registry() -> dict:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


def _op4_sql() -> str:
    """Exact containment of every item's five-word shingles in every document."""
    def shingles(table: str, key: str) -> str:
        words = ("list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
                 "'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')")
        return (f"(SELECT DISTINCT {key}, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), "
                f"lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s "
                f"FROM (SELECT {key}, {words} AS w FROM {table}))")
    return f"""WITH i AS {shingles('benchmark', 'item_id')}, n AS (SELECT item_id, count(*) AS n_item FROM i GROUP BY item_id),
        d AS {shingles('documents', 'doc_id')},
        h AS (SELECT doc_id, item_id, count(*) AS n_shared FROM d JOIN i USING (s) GROUP BY ALL)
        SELECT doc_id, item_id, n_item, n_shared FROM h JOIN n USING (item_id) WHERE n_shared * 100 >= n_item * 80"""


def _op6_sql() -> str:
    """The same budgets and prefixes, from windows over whole leaves."""
    domain = "CASE " + " ".join(f"WHEN source = '{s}' THEN '{d}'" for s, d in DOMAINS.items()) + " ELSE 'other' END"

    def weight(depth: int) -> str:
        cols = ["domain", "lang", "source"][:depth]
        hits = [(k, w) for k, w in WEIGHTS.items() if len(k) == depth]
        return "CASE " + " ".join(
            "WHEN " + " AND ".join(f"{c} = '{v}'" for c, v in zip(cols, k)) + f" THEN {w}" for k, w in hits
        ) + " ELSE 1 END"

    def level(depth: int) -> str:
        cols = ["domain", "lang", "source"][:depth]
        path, parent = ", ".join(cols), ", ".join(cols[:-1])
        by = f"PARTITION BY {parent} " if parent else ""
        order = f"ORDER BY capacity / weight::DOUBLE, {cols[-1]}"
        given = f"(SELECT budget FROM b{depth - 1} g WHERE " + " AND ".join(f"g.{c} = n.{c}" for c in cols[:-1]) + ")" \
            if parent else "(SELECT sum(tokens)::BIGINT FROM leaves)"
        return f"""
        n{depth} AS (SELECT {path}, sum(3 * tokens)::BIGINT AS capacity, ({weight(depth)})::BIGINT AS weight FROM leaves GROUP BY {path}),
        w{depth} AS (SELECT *, {given} - coalesce(sum(capacity) OVER ({by}{order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS lft,
          (sum(weight) OVER ({by}) - coalesce(sum(weight) OVER ({by}{order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS wgt FROM n{depth} n),
        f{depth} AS (SELECT *, min(CASE WHEN lft::DOUBLE / wgt >= capacity::DOUBLE / weight THEN 1 ELSE 0 END) OVER ({by}{order}) = 0 AS opn FROM w{depth}),
        g{depth} AS (SELECT *, first(CASE WHEN opn THEN lft END IGNORE NULLS) OVER ({by}{order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS l0,
          first(CASE WHEN opn THEN wgt END IGNORE NULLS) OVER ({by}{order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS w0 FROM f{depth}),
        b{depth} AS (SELECT {path}, CASE WHEN opn THEN least(floor((weight * l0)::DOUBLE / w0)::BIGINT, capacity) ELSE capacity END AS budget FROM g{depth})"""

    return f"""WITH d AS (SELECT doc_id, {domain} AS domain, lang, source,
          len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> ''))::BIGINT AS n_tokens FROM documents),
        leaves AS (SELECT domain, lang, source, sum(n_tokens)::BIGINT AS tokens FROM d GROUP BY ALL),
        {level(1)}, {level(2)}, {level(3)},
        p AS (SELECT b3.*, tokens, CASE WHEN tokens > 0 THEN least(budget // tokens, 3) ELSE 1 END AS n_full FROM b3 JOIN leaves USING (domain, lang, source)),
        r AS (SELECT *, CASE WHEN n_full >= 3 OR tokens = 0 THEN 0 ELSE budget % tokens END AS rest FROM p),
        s AS (SELECT d.*, n_full, rest, sum(n_tokens) OVER (PARTITION BY domain, lang, source
          ORDER BY md5('17:' || (n_full + 1) || ':' || doc_id)) AS upto FROM d JOIN r USING (domain, lang, source))
        SELECT doc_id, domain, lang, source, n_tokens, unnest(range(1, n_full + 1 + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END))::INT AS epoch FROM s"""


def _op13_sql() -> str:
    """Every order run step by step, over counts by failed filters."""
    words = "list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"
    return f"""WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, {words} AS w FROM documents),
        l AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
        f AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
          [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
           100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 3 * length(t),
           regexp_matches(t, '[#$%&*|]'), coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY t), false)] AS fails
          FROM d LEFT JOIN l ON d.doc_id = l.doc_id),
        c AS (SELECT part, good, toxic, fails, count(*) AS n FROM f GROUP BY ALL),
        i AS (SELECT unnest(range(1, 6)) AS x),
        o AS (SELECT [a.x, b.x, c.x, d.x, e.x] AS ord FROM i a, i b, i c, i d, i e
          WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
        s AS (SELECT ord, x AS step, ord[x] AS f, ord[1:x - 1] AS before,
          array_to_string(list_transform(ord, lambda y: 'ABCDE'[y]), '') AS filter_order FROM o, i),
        r AS (SELECT part, filter_order, step, f, good, toxic, n, fails, fails[f] AS hit,
          len(list_filter(before, lambda y: fails[y])) = 0 AS alive FROM c, s),
        g AS (SELECT part, filter_order, step, f, sum(n) FILTER (alive AND NOT hit) AS kept, sum(n) FILTER (alive AND hit) AS removed,
          sum(n) FILTER (hit AND NOT alive) AS redundant, sum(n) FILTER (hit AND len(list_filter(fails, lambda y: y)) = 1) AS unique_fails,
          sum(n) FILTER (alive AND hit AND good) AS good_lost, sum(n) FILTER (alive AND hit AND toxic) AS toxic_lost FROM r GROUP BY ALL)
        SELECT part, filter_order, step::INT AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
          coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
          coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
          coalesce(sum(removed) OVER (PARTITION BY part, f), 0)::BIGINT AS shapley FROM g"""


def oracle_sql() -> dict[str, str]:
    return {"op4_containment": _op4_sql(), "op6_source_mixing": _op6_sql(), "op13_filter_audit": _op13_sql()}
