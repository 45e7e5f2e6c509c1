"""One registered query per operator, each over the whole of its table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    decontaminate,
    embedding_dedup,
    hard_negatives,
    html,
    language,
    licenses,
    minhash,
    periodic,
    quality,
    sentencepiece,
    suffix,
    toxicity,
    warc,
)
from tidemark.llm.common import id_part, read_table
from tidemark.session import work_dir


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base statistics and the verdict of the rule cascade for every document."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.apply_rules(docs, "doc_id", "text").select(
        F.col("id").alias("doc_id"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without passages of 200 bytes that occur elsewhere."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix.remove_repeats(docs, "doc_id", "text").select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html.extract(pages, "html").withColumn("n_chars", F.length("text").cast("long"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; labels are learned from the rows that are not held out."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "toxic")
    machine = toxicity.fit(
        docs, "doc_id", "text", labels.filter(id_part("doc_id", 3) != 1), "doc_id", "toxic"
    )
    rows = docs.select("doc_id", "text", (id_part("doc_id", 3) == 1).alias("held_out"))
    return toxicity.score(rows, "text", machine).select("doc_id", "held_out", "score", "predicted")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the licences whose notice it holds."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = F.transform("notices", lambda n: n["license"])
    return licenses.scan(docs, "text").select(
        "doc_id",
        F.size("notices").cast("long").alias("n_notices"),
        F.concat_ws(",", F.array_sort(F.array_distinct(found))).alias("licenses"),
        F.coalesce(F.array_max(F.transform("notices", lambda n: n["coverage"])), F.lit(0.0)).alias("best_coverage"),
    )


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under 85 % of common three-word shingles."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = minhash.near_duplicates(docs, "doc_id", "text", width=3, percent=85, bands=20, rows=5)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, with the benchmark items whose template it holds."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    items = read_table(spark, sf_dir, "benchmark").select("item_id", "text")
    found = decontaminate.contaminated(docs, "doc_id", "text", items, "item_id", "text")
    found = found.select(F.col("id").alias("found_id"), "items", "covered")
    return docs.join(found, F.col("doc_id").eqNullSafe(F.col("found_id")), "left").select(
        "doc_id",
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.concat_ws(",", F.col("items").cast("array<string>")).alias("items"),
        F.coalesce("covered", F.lit(0)).alias("covered_words"),
        F.col("found_id").isNotNull().alias("contaminated"),
        F.col("found_id").isNull().alias("kept"),
    )


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; learned from the rows that are not held out."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    part = id_part("doc_id", 4)
    profiles = language.learn(docs.filter(part != 2), "text", "lang")
    rows = docs.select("doc_id", "text", (part == 2).alias("held_out"))
    return language.predict(rows, "text", profiles).select("doc_id", "held_out", "lang_pred", "score")


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and hash of every document's ids, and the hash of the decoded text."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = public_tokenizers.path("piece_bpe_32k.model")
    return sentencepiece.digests(sentencepiece.encode(docs, "text", model, decode=True))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to bundles and read back."""
    folder = work_dir(spark, "warc")
    folder = folder if "://" in folder else f"file://{folder}"
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    index = warc.write(warc.with_revisits(pages, "page_id", "url", "html"), folder)
    return warc.read(index, folder).select(
        F.col("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector; some labels are shifted, components are whole 256ths."""
    rows = hard_negatives.usable(read_table(spark, sf_dir, "embeddings"), "vec_id", "label", "embedding")
    label = F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    whole = F.transform("v", lambda x: F.floor(F.lit(256.0) * x).cast("double"))
    index = hard_negatives.build(rows.select("id", label.alias("label"), whole.alias("v")))
    return hard_negatives.mine(index, F.col("id") % 100 == 0, positives=5, negatives=5, percent=80)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longest periodic run of every document, and digests of all runs and of the text without their repeats."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    docs = docs.select("doc_id", words.alias("words"))
    # Every tenth document, by the hash of its id, repeats a stretch of its words to the end.
    n, h = F.size("words"), F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    begin = g % n
    period = 1 + F.floor((n - begin) / (3 + g % 8))
    source = F.transform(
        F.sequence(F.lit(0).cast("bigint"), n - F.lit(1).cast("bigint")),
        lambda i: F.get("words", F.when(i < begin, i).otherwise(begin + (i - begin) % period).cast("int")),
    )
    docs = docs.withColumn("words", F.when((h % 10 == 0) & (n > 0), source).otherwise(F.col("words")))
    found = periodic.collapse_runs(docs, "words")
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    found = found.withColumn("longest", longest)
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.start")).alias("start"),
        F.col("longest.length").alias("length"),
        (-F.col("longest.period")).alias("period"),
        F.expr("(1000 * longest.length) div (-longest.period)").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector under a cosine of 0.95."""
    rows = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return embedding_dedup.near_duplicates(rows, "vec_id", "embedding", cosine=0.95).withColumnRenamed("id", "vec_id")


QUERIES = {
    "op1_quality": op1_quality,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_html_text": op3_html_text,
    "op4_toxicity": op4_toxicity,
    "op5_license_scan": op5_license_scan,
    "op6_near_duplicates": op6_near_duplicates,
    "op9_decontamination": op9_decontamination,
    "op7_language_id": op7_language_id,
    "op8_sentencepiece": op8_sentencepiece,
    "op10_warc": op10_warc,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_embedding_dedup": op13_embedding_dedup,
}

# Units, written out for the SQL.
_UNITS = (
    "kilometers|kilometres|kilometer|kilometre|kilograms|kilogram|centimeters|centimeter|percent|dollars|dollar|euros|euro|"
    "pounds|pound|cents|cent|meters|metres|meter|metre|grams|gram|liters|litres|liter|litre|miles|mile|inches|inch|feet|foot|"
    "hours|hour|minutes|minute|seconds|second|days|day|weeks|week|months|month|years|year|kg|mg|km|cm|mm|ml|lb|oz|kwh|mph|usd|eur"
)

ORACLE = {
    "op1_quality": r"""
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS text,
                list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t-\r]+'), lambda x: x <> '') AS w,
                list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \t-\r]')) AS l
            FROM documents),
        win AS (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS k
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d)),
        twice AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, k) > 1),
        gain AS (SELECT doc_id, least(8, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 8)) AS n FROM twice),
        cov AS (SELECT doc_id, sum(n) AS n FROM gain GROUP BY 1),
        s AS (
            SELECT doc_id, text, w, len(w)::BIGINT AS n_words, len(l)::BIGINT AS n_lines,
                length(regexp_replace(text, '[ \t-\r]+', '', 'g'))::BIGINT AS word_chars,
                length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
                (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
                coalesce(n, 0)::BIGINT AS n_repeat_words,
                length(regexp_replace(text, '[^\p{L}]+', '', 'g')) AS letters,
                length(regexp_replace(text, '[^\p{Lu}]+', '', 'g')) AS capitals
            FROM d LEFT JOIN cov USING (doc_id)),
        b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM s)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
            NOT (base_failed OR 10 * n_symbols > n_words OR 2 * capitals > letters OR 100 * n_dup_lines > 40 * n_lines
                OR word_chars < 2 * n_words OR word_chars > 20 * n_words OR 2 * letters < word_chars
                OR 10 * len(list_distinct(w)) < n_words) AS kept
        FROM b
    """,
    "op9_decontamination": rf"""
        WITH raw AS (
            SELECT 0 AS side, doc_id AS id, coalesce(text, '') AS text FROM documents
            UNION ALL SELECT 1, item_id, coalesce(text, '') FROM benchmark),
        a AS (SELECT side, id, regexp_replace(regexp_replace(text, '[\x{{e000}}-\x{{e002}}]', '', 'g'),
            '(\p{{N}})[.,:](\p{{N}})', '\1\2', 'g') AS text FROM raw),
        n1 AS (SELECT side, id, regexp_replace(text, '([\p{{Ll}}\p{{N}},;] )(\p{{Lu}}\p{{L}}*)', '\1' || chr(57344) || '\2', 'g') AS text FROM a),
        n2 AS (SELECT side, id, regexp_replace(text, '(\x{{e000}}\p{{L}}+ )(\p{{Lu}}\p{{L}}*)', '\1' || chr(57344) || '\2', 'g') AS text FROM n1),
        n3 AS (SELECT side, id, regexp_replace(text, '(\x{{e000}}\p{{L}}+ )(\p{{Lu}}\p{{L}}*)', '\1' || chr(57344) || '\2', 'g') AS text FROM n2),
        m AS (SELECT side, id, lower(regexp_replace(text, '(\p{{N}}+)', ' ' || chr(57345) || '\1 ', 'g')) AS text FROM n3),
        u AS (SELECT side, id, regexp_replace(text, '(\x{{e001}}\p{{N}}+ +)({_UNITS})\b', '\1' || chr(57346) || '\2', 'g') AS text FROM m),
        t AS (SELECT side, id,
            list_filter(regexp_split_to_array(text, '[^\p{{L}}\p{{N}}\x{{e000}}-\x{{e002}}]+'), lambda x: x <> '') AS v FROM u),
        w AS (SELECT side, id, v, list_transform(v, lambda x: CASE WHEN ord(x) BETWEEN 57344 AND 57346 THEN x[1] ELSE x END) AS w FROM t),
        items AS (SELECT id AS item, v, w, len(w) AS size FROM w WHERE side = 1 AND len(w) >= 5),
        first AS (SELECT v, min(item) AS item, any_value(w) AS w, any_value(size) AS size, list(DISTINCT item) AS ids FROM items GROUP BY v),
        iw AS (SELECT item, i AS item_at, least(size, 8) AS width, w[i:i + least(size, 8) - 1] AS k, v[i:i + least(size, 8) - 1] AS iv
            FROM (SELECT *, unnest(range(1, size - least(size, 8) + 2)) AS i FROM first)),
        dw AS (SELECT id, i AS place, width, w[i:i + width - 1] AS k, v[i:i + width - 1] AS dv
            FROM (SELECT id, v, w, width, unnest(range(1, len(w) - width + 2)) AS i
                FROM w, (SELECT DISTINCT width FROM iw) WHERE side = 0)),
        hit AS (SELECT DISTINCT id, item, item_at, place - item_at AS shift, width, k, iv, dv FROM dw JOIN iw USING (width, k)
            WHERE len(list_filter(k, lambda x: ord(x) NOT BETWEEN 57344 AND 57346)) > 0),
        slot AS (SELECT id, item, shift, item_at, unnest(k) AS kind, unnest(iv) AS iv, unnest(dv) AS dv FROM hit),
        broken AS (SELECT id, item, shift, iv FROM slot
            WHERE ord(kind) BETWEEN 57344 AND 57346 GROUP BY ALL HAVING min(dv) <> max(dv)),
        lost AS (SELECT DISTINCT id, item, shift, item_at FROM slot JOIN broken USING (id, item, shift, iv)
            WHERE ord(kind) BETWEEN 57344 AND 57346),
        good AS (SELECT DISTINCT id, item, item_at, width FROM hit ANTI JOIN lost USING (id, item, shift, item_at)),
        gain AS (SELECT id, item, least(width, coalesce(lead(item_at) OVER (PARTITION BY id, item ORDER BY item_at) - item_at, width)) AS n FROM good),
        cov AS (SELECT id, item, sum(n) AS n FROM gain GROUP BY 1, 2),
        bad AS (SELECT id, n, ids FROM cov JOIN first USING (item) WHERE 100 * n >= 50 * size),
        one AS (SELECT id, max(n)::BIGINT AS n, list_sort(list_distinct(flatten(list(ids)))) AS ids FROM bad GROUP BY id)
        SELECT doc_id, coalesce(len(ids), 0)::BIGINT AS n_items, coalesce(array_to_string(ids, ','), '') AS items,
            coalesce(n, 0)::BIGINT AS covered_words, n IS NOT NULL AS contaminated, n IS NULL AS kept
        FROM documents LEFT JOIN one ON doc_id = id
    """,
    "op10_warc": """
        WITH p AS (
            SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
            FROM pages),
        f AS (
            SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY 1)
        SELECT page_id, payload_bytes, payload_digest,
            CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN page_id > first THEN first END AS refers_to
        FROM p LEFT JOIN f USING (payload_digest)
    """,
    "op11_hard_negatives": """
        WITH r AS (
            SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
            FROM embeddings
            WHERE label IS NOT NULL AND len(embedding) > 0
                AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
        s AS (
            SELECT a.id AS anchor, r.id, a.label = r.label AS same, list_inner_product(a.v, r.v)::BIGINT AS score
            FROM r a JOIN r ON a.id <> r.id WHERE a.id % 100 = 0),
        p AS (
            SELECT anchor, id AS positive, score AS positive_score FROM s WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) <= 5)
        SELECT anchor AS anchor_id, positive AS positive_id,
            (row_number() OVER (PARTITION BY anchor, positive ORDER BY score DESC, id))::INTEGER AS rank,
            id AS negative_id, positive_score, score AS negative_score
        FROM p JOIN s USING (anchor)
        WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
        QUALIFY row_number() OVER (PARTITION BY anchor, positive ORDER BY score DESC, id) <= 5
    """,
    "op13_embedding_dedup": """
        WITH RECURSIVE v AS (
            SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
            WHERE len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
                AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        link AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
            WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
        reach AS (
            SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
        n AS (SELECT a, count(*) AS n FROM link GROUP BY a),
        low AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
        SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(b, vec_id)) AS component_id,
            vec_id <= coalesce(b, vec_id) AS kept
        FROM embeddings LEFT JOIN n ON n.a = vec_id LEFT JOIN low ON low.a = vec_id
    """,
}
