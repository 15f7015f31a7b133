"""The package's named queries, each with the SQL that states the same result where SQL can."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from chatterlens.llm import (
    bottom_k,
    byte_pairs,
    decontaminate,
    importance,
    language_filters,
    license_scan,
    mixing,
    paragraphs,
    periodic_runs,
    permutation_index,
    token_alignment,
    token_counts,
    url_models,
)
from chatterlens.session import prepare

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function of (session, table folder) under its own name."""

    def register(build: Query) -> Query:
        QUERIES[build.__name__] = lambda spark, sf_dir: build(prepare(spark), sf_dir)
        if sql is not None:
            ORACLES[build.__name__] = sql
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(
    f"""
    WITH split AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
            '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents
    ), items AS (
        SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
            '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM benchmark
    ), starts AS (
        SELECT item_id, words, least(10, len(words)) AS size,
            unnest(generate_series(1, greatest(1, len(words) - 9))) AS pos
        FROM items WHERE len(words) > 0
    ), windows AS (
        SELECT DISTINCT item_id, size, array_to_string(words[pos:pos + size - 1], ' ') AS spelled FROM starts
    ), places AS (
        SELECT doc_id, words, size, unnest(generate_series(1, len(words) - size + 1)) AS pos
        FROM split, (SELECT DISTINCT size FROM windows) WHERE len(words) >= size
    ), hits AS (
        SELECT doc_id, pos, p.size, item_id
        FROM places p JOIN windows w ON w.size = p.size AND w.spelled = array_to_string(words[pos:pos + p.size - 1], ' ')
    ), hit_words AS (
        SELECT doc_id, count(DISTINCT place) AS n_hit
        FROM (SELECT doc_id, unnest(generate_series(pos, pos + size - 1)) AS place FROM hits) GROUP BY doc_id
    ), hit_items AS (
        SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
        FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
    )
    SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
        sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM split LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
    """
)
def op1_benchmark_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the benchmark items whose windows they contain."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.scan(docs, table(spark, sf_dir, "benchmark"))
    listed = F.concat_ws(",", F.array_sort(F.transform("hit_items", lambda item: item.cast("string"))))
    hit = decontaminate.n_hit()
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(listed, 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


@query(
    f"""
    WITH RECURSIVE split AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
            '[^\\x20\\x09-\\x0D]+') AS words FROM documents
    ), shingles AS (
        SELECT DISTINCT doc_id, array_to_string(words[pos:pos + 2], ' ') AS shingle
        FROM (SELECT doc_id, words, unnest(generate_series(1, greatest(1, len(words) - 2))) AS pos
              FROM split WHERE len(words) > 0)
    ), sizes AS (
        SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
    ), pairs AS (
        SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
        FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id != b.doc_id GROUP BY a.doc_id, b.doc_id
    ), links AS (
        SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
        WHERE 100 * shared >= 85 * (x.n + y.n - shared)
    ), reached(doc_id, other) AS (
        SELECT doc_id, doc_id FROM documents
        UNION
        SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other
    ), component AS (
        SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id
    )
    SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
    FROM documents d LEFT JOIN sizes USING (doc_id) JOIN component USING (doc_id)
    """
)
def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their component of near-duplicates: three-word shingles, similarity 0.85 or more."""
    found = bottom_k.near_duplicates(table(spark, sf_dir, "documents"), "doc_id", "text", length=3, percent=85)
    return found.select(
        F.col("id").alias("doc_id"),
        "n_shingles",
        "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"),
    )


@query()
def op2_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors found for every row whose id is divisible by 20."""
    found = permutation_index.nearest_vectors(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
    return found.withColumnRenamed("id", "vec_id")


@query()
def op3_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    filters = language_filters.learn(docs, ~held_out & F.col("doc_id").isNotNull(), "doc_id", "text", "lang")
    found = language_filters.identify(docs.select("doc_id", "text", held_out.alias("held_out")), filters)
    return found.select("doc_id", "held_out", "lang_pred", "score")


@query()
def op4_source_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uses of documents in a mixture as large as the corpus that repeats no source more than 1.25 times."""
    docs = table(spark, sf_dir, "documents")
    return mixing.mixture(docs, max_repeats=corpus_pipeline.MAX_REPEATS).withColumnRenamed("id", "doc_id")


def _licence_oracle() -> str:
    """SQL with the templates' weights written out."""
    idf, weights = license_scan.template_weights()
    idf_rows = ", ".join(f"('{term}', {value!r}::DOUBLE)" for term, value in idf)
    weight_rows = ", ".join(f"('{term}', {n}, '{licence}', {w!r}::DOUBLE)" for term, n, licence, w in weights)
    cue = "|".join(license_scan.CUES)
    return f"""
    WITH numbered AS (
        SELECT doc_id, text, coalesce(source, 'unknown') AS source, doc_id // 20 AS n FROM documents
    ), shelved AS (
        SELECT doc_id, text, lower(text) AS low, CASE WHEN n % 1000 = 0 THEN source
            WHEN n % 100 = 0 THEN source || '/s' || (n // 100)::VARCHAR
            ELSE source || '/s' || (n // 100)::VARCHAR || '/b' || (n // 10)::VARCHAR END AS directory,
            CASE WHEN n % 10 = 0 THEN 'LICENSE' ELSE 'd' || doc_id::VARCHAR || '.txt' END AS name
        FROM numbered
    ), files AS (
        SELECT *, directory || '/' || name AS path FROM shelved
    ), passages AS (
        SELECT DISTINCT doc_id, passage FROM (
            SELECT doc_id, unnest(string_split(low, chr(10))) AS passage FROM files WHERE regexp_matches(low, '{cue}')
            UNION ALL SELECT doc_id, unnest(string_split(regexp_replace(low, '{license_scan.COMMENT_BREAK}', ' ', 'g'), chr(10)))
            FROM files WHERE regexp_matches(low, '{cue}')
        ) WHERE regexp_matches(passage, '{cue}')
        UNION SELECT doc_id, low FROM files WHERE name = 'LICENSE' AND regexp_matches(low, '{cue}')
        UNION SELECT doc_id, left(ltrim(regexp_replace(low, '[ \\t\\r\\n]+', ' ', 'g'), ' '), {license_scan.HEAD}) FROM files WHERE name = 'LICENSE' AND regexp_matches(low, '{cue}')
    ), terms AS (
        SELECT doc_id, passage, term, count(*) AS n FROM (
            SELECT doc_id, passage, unnest(regexp_extract_all(passage, '{license_scan._TERM}')) AS term FROM passages
        ) GROUP BY ALL
    ), weighed AS (
        SELECT doc_id, passage, term, n * coalesce(idf, {license_scan.highest_idf()!r}::DOUBLE) AS w
        FROM terms LEFT JOIN (VALUES {idf_rows}) i(term, idf) USING (term)
    ), norms AS (
        SELECT doc_id, passage, sqrt(sum(w * w)) AS norm FROM weighed GROUP BY ALL
    ), scored AS (
        SELECT doc_id, passage, licence, round(sum(w * weight) / any_value(norm), 6) AS score
        FROM weighed JOIN (VALUES {weight_rows}) t(term, template, licence, weight) USING (term)
        JOIN norms USING (doc_id, passage) GROUP BY doc_id, passage, template, licence
    ), ranked AS (
        SELECT doc_id, passage, licence, max(score) AS score FROM scored GROUP BY ALL
    ), clear AS (
        SELECT *, coalesce(score > lead(score) OVER by_score
                AND 1 - score <= {license_scan.LEAD} * (1 - lead(score) OVER by_score), true) AS clear,
            row_number() OVER by_score AS place
        FROM ranked WINDOW by_score AS (PARTITION BY doc_id, passage ORDER BY score DESC, licence)
    ), tagged AS (
        SELECT doc_id, regexp_extract(text, '{license_scan.SPDX}', 1) AS licence FROM files
    ), own AS (
        SELECT doc_id, licence, score FROM (
            SELECT doc_id, licence, score, 1 AS later FROM clear WHERE place = 1 AND clear AND score >= {license_scan.THRESHOLD}
            UNION ALL SELECT doc_id, licence, 1.0, 0 FROM tagged WHERE licence <> '')
        QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY later, score DESC, licence) = 1
    ), held AS (
        SELECT directory, licence, score FROM own JOIN files USING (doc_id) WHERE name = 'LICENSE'
        QUALIFY row_number() OVER (PARTITION BY directory ORDER BY score DESC, licence) = 1
    ), above AS (
        SELECT DISTINCT directory, depth, array_to_string(string_split(directory, '/')[1:depth], '/') AS place
        FROM (SELECT directory, unnest(generate_series(0, len(string_split(directory, '/')))) AS depth FROM files)
    ), given AS (
        SELECT above.directory, place, licence, score FROM above JOIN held ON held.directory = place
        QUALIFY row_number() OVER (PARTITION BY above.directory ORDER BY depth DESC) = 1
    )
    SELECT f.doc_id, f.path, coalesce(o.licence, g.licence) AS licence,
        CASE WHEN o.licence IS NOT NULL THEN f.path ELSE place END AS licence_from,
        CASE WHEN o.licence IS NOT NULL THEN 'own' WHEN g.licence IS NOT NULL THEN 'inherited' END AS licence_how,
        coalesce(o.score, g.score) AS licence_score
    FROM files f LEFT JOIN own o USING (doc_id) LEFT JOIN given g USING (directory)
    """


@query(_licence_oracle())
def op5_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their own or inherited licence.

    The table has no paths, so every source is a tree: 20 ids to a number, ten numbers to a box, ten boxes to a
    shelf. The first of each box, shelf and ten shelves is the licence file of its directory.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.coalesce("source", F.lit("unknown")).alias("source"))
    n = F.floor(F.col("doc_id") / 20)
    shelf, box = (F.concat(F.lit(f"/{c}"), F.floor(n / size).cast("string")) for c, size in (("s", 100), ("b", 10)))
    place = F.when(n % 1000 == 0, F.col("source")).when(n % 100 == 0, F.concat("source", shelf)).otherwise(F.concat("source", shelf, box))
    name = F.when(n % 10 == 0, "LICENSE").otherwise(F.concat(F.lit("d"), F.col("doc_id").cast("string"), F.lit(".txt")))
    files = docs.select("doc_id", F.concat_ws("/", place, name).alias("path"), "text")
    return license_scan.licences(files).drop("text")


@query()
def op6_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their log weight, their draw, and whether the sample keeps them."""
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    found, least = importance.weighted(docs, labels)
    return found.select("doc_id", "log_weight", "draw", (F.col("draw") >= F.lit(least)).alias("kept"))


@query()
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their bytes and tokens, and whether they exceed 1024 tokens."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "text")
    counted = token_counts.token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 1024)


@query()
def op9_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages that a smaller document has too: where they stand, and the document that keeps them."""
    found = paragraphs.repeated_passages(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.col("kept_id").alias("kept_doc_id"),
        F.col("begin").alias("first_word"),
        (F.col("end") - F.col("begin")).alias("n_words"),
    )


@query(corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of ``corpus_pipeline`` over ``documents``."""
    return corpus_pipeline.run(spark, sf_dir)


@query()
def op10_url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with host, path, the rule that fits and the verdict of rule or models."""
    judged = url_models.judged(table(spark, sf_dir, "pages").select("page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """Documents of which one in ten says its words from a place on again and again, by a rule on the hash of the id."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    cut = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    rows = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), cut.alias("words"))
    rows = rows.withColumn("n", F.size("words")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    rows = rows.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    index = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    said = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.get("words", index(i).cast("int")))
    return rows.select("doc_id", F.when(F.col("n") > 0, F.array_join(said, " ")).otherwise(F.col("text")).alias("text"))


@query()
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the number of their periodic runs, the run of most periods, and digests of runs and rest."""
    docs = with_planted_runs(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periodic_runs.periodic_runs(docs)

    def order(one: Column, two: Column) -> Column:
        left, right = one["length"] * two["period"], two["length"] * one["period"]
        tie = F.when(one["start"] != two["start"], one["start"] - two["start"]).otherwise(one["period"] - two["period"])
        return F.when(left != right, F.signum(right - left)).otherwise(F.signum(tie)).cast("int")

    lines = F.transform("runs", lambda run: F.concat(F.concat_ws(",", run["start"], run["length"], run["period"]), F.lit("\n")))
    found = found.select(
        F.col("id").alias("doc_id"),
        F.size("runs").cast("long").alias("n_runs"),
        F.get(F.array_sort("runs", order), F.lit(0)).alias("most"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
    exponent = F.expr("1000 * most.length div most.period")
    return found.select(
        "doc_id", "n_runs", "most.start", "most.length", "most.period", exponent.alias("exponent_milli"), "runs_sha256", "collapsed_sha256"
    )


@query()
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the groups that two tokenizers have in common, and how usual their links are in the corpus."""
    byte_level, by_piece = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    aligned = token_alignment.align(table(spark, sf_dir, "documents"), byte_level, by_piece)
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    scored = token_alignment.with_link_scores(aligned.withColumn("groups_sha256", digest).drop("groups"))
    return scored.select(
        F.col("id").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )


@query()
def op13_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the number of their tokens, and digests of the ids and of the bytes that these decode to."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = byte_pairs.encode(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    decoded = byte_pairs.decode(encoded, path)
    return decoded.select(
        F.col("id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(byte_pairs.joined_ids(F.col("ids")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
