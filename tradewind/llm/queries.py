"""Registered queries of the training-data operators, and the SQL of those SQL can express."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm import (
    ann,
    filteraudit,
    langid,
    licenses,
    mixing,
    neardup,
    packing,
    quality,
    secrets,
    spelling,
    tokencount,
    topk,
    toxicity,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix_plan(_table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return plan.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).alias("taken"),
        "copies",
    )


def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.fit(docs, labels.filter(_remainder("doc_id", 5) != 0))
    return toxicity.tag(docs, model).select(
        "doc_id",
        (_remainder("doc_id", 5) == 0).alias("held_out"),
        F.col("toxicity.score").alias("score"),
        (F.col("toxicity.score") >= 0.5).cast("int").alias("predicted"),
        F.array_join(
            F.transform(
                F.col("toxicity.spans"), lambda s: F.concat_ws(":", s["start"], s["end"])
            ),
            ",",
        ).alias("spans"),
    )


def op3_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return neardup.near_duplicates(docs, words=4).select(
        "doc_id",
        "n_shingles",
        "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
        "class_id",
    )


def vocabulary() -> str:
    """The file of the tokenizer that op4 names."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs, vocabulary())


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").select("doc_id", "quality")
    model = quality.fit(docs, labels.filter(_remainder("doc_id", 5) != 0))
    return quality.score(docs, model).select(
        "doc_id",
        (_remainder("doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(_table(spark, sf_dir, "documents").select("doc_id", "text"))

    def listed(labels: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    base = F.col("places.label")
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places.start").cast("long").alias("first_word"),
        F.array_max("places.start").cast("long").alias("last_word"),
        listed(base).alias("base_labels"),
        listed(F.concat(base, F.col("similar.label"))).alias("labels"),
        "score",
    )


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.find_secrets(docs)
    base = [r.kind for r in secrets.BASE_RULES]

    def of(kinds: "list[str]") -> Column:
        return F.filter("found", lambda s: s["kind"].isin(kinds))

    def joined(spans: Column) -> Column:
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
        )

    return found.select(
        "doc_id",
        *[F.size(of([k])).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(joined(of(base)), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"),
        "blob",
    )


def _secrets_expected() -> str:
    """Per rule: pieces between the matches and the matches give the places of the matches."""
    parts = []
    for place, rule in enumerate(secrets.RULES):
        pattern = (rule.plain or rule.pattern).replace("'", "''")
        parts.append(
            f"""
            SELECT doc_id, {place} AS place, '{rule.kind}' AS kind,
                   len(list_aggregate([''] || pieces[:i] || found[:i - 1], 'string_agg', '')) AS s,
                   len(found[i]) AS n
            FROM (SELECT doc_id, regexp_split_to_array(text, '{pattern}') AS pieces,
                         regexp_extract_all(text, '{pattern}') AS found,
                         regexp_extract_all(text, '{pattern}', {rule.group}) AS wanted
                  FROM texts WHERE regexp_matches(text, '{pattern}')),
                 range(1, len(found) + 1) r(i)
            WHERE len(wanted[i]) >= {rule.least}"""
        )
    base = len(secrets.BASE_RULES)
    counts = ", ".join(
        f"count(*) FILTER (kind = '{r.kind}')::BIGINT AS n_{r.kind}" for r in secrets.BASE_RULES
    )
    listed = "string_agg(kind || ':' || s || ':' || (s + n), ',' ORDER BY s, place)"
    return f"""
        WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
        spans AS ({" UNION ALL ".join(parts)}),
        digests AS (
            SELECT doc_id, {counts}, sha256(coalesce({listed} FILTER (place < {base}), '')) AS b,
                   {listed} AS spans
            FROM spans GROUP BY doc_id)
        SELECT doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in secrets.BASE_RULES)},
               coalesce(b, sha256('')) AS base_sha256, coalesce(spans, '') AS spans,
               sha256(text) AS blob
        FROM texts LEFT JOIN digests USING (doc_id)
    """


def _remainder(key: str, n: int) -> Column:
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % n


def language_model(docs: DataFrame) -> langid.LanguageModel:
    """Learnt from text and language of the documents that are not held out."""
    rows = docs.select("doc_id", "text", "lang")
    return langid.fit(rows.filter(_remainder("doc_id", 4) != 2))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select(
        "doc_id", "text", "lang", (_remainder("doc_id", 4) == 2).alias("held_out")
    )
    model = language_model(docs)
    return langid.predict(docs.drop("lang"), model).select(
        "doc_id",
        "held_out",
        F.col("language.code").alias("lang_pred"),
        F.col("language.score").alias("score"),
        F.col("language.rejected").alias("rejected"),
    )


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    labels = _table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return filteraudit.audit(docs, labels)


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokencount.token_counts(docs, vocabulary(), limit=2048).select("doc_id", "tokens.*")


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return spelling.variants(docs).select("word", "form", "root", "n", "n_near", "form_n")


def _licenses_expected() -> str:
    """Templates are compared with every window of words, without any filter."""
    word = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

    def quoted(words: "list[str]") -> str:
        return "[" + ", ".join(f"'{w}'" for w in words) + "]"

    phrases = ", ".join(f"({quoted(p.split())}, '{label}')" for p, label in licenses.PHRASES)
    templates = ", ".join(
        f"({quoted(t.words)}, {quoted(t.must.split())}, {quoted(t.without.split() or ['-'])}, '{t.label}')"
        for t in licenses.TEMPLATES
    )
    step = max(len(t.text.split()) for t in licenses.TEMPLATES)
    small = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
        WITH texts AS (SELECT doc_id, {small.format("coalesce(text, '')")} AS text FROM documents),
        worded AS (SELECT doc_id, regexp_extract_all(text, '{word}') AS w FROM texts),
        places AS (
            SELECT doc_id, i - 1 AS start, label
            FROM (SELECT doc_id, w, p.words, p.label
                  FROM worded, (VALUES {phrases}) p(words, label)
                  WHERE list_has_all(w, p.words)),
                 range(1, len(w) + 1) r(i)
            WHERE w[i:i + len(words) - 1] = words),
        base AS (
            SELECT doc_id, count(*)::BIGINT AS n_base, min(start)::BIGINT AS first_word,
                   max(start)::BIGINT AS last_word
            FROM places GROUP BY doc_id),
        blocks AS (
            SELECT doc_id, w[{step} * i + 1:{step} * i + {2 * step}] AS w
            FROM worded, range(0, greatest(len(w) - {step} - 1, 0) // {step} + 1) r(i)),
        alike AS (
            SELECT doc_id, t.label, len(list_intersect(w, t.words))::DOUBLE / len(t.words) AS share
            FROM blocks, (VALUES {templates}) t(words, must, without, label)
            WHERE 100 * len(list_intersect(w, t.words)) >= {licenses.PERCENT} * len(t.words)
              AND list_has_all(w, t.must) AND NOT list_has_any(w, t.without)),
        labelled AS (
            SELECT doc_id, label, true AS base, 1.0::DOUBLE AS share FROM places
            UNION ALL SELECT doc_id, label, false, share FROM alike),
        joined AS (
            SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels,
                   string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
                   max(share) AS score
            FROM labelled GROUP BY doc_id)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word,
               last_word, coalesce(base_labels, '') AS base_labels,
               coalesce(labels, '') AS labels, coalesce(score, 0) AS score
        FROM worded LEFT JOIN base USING (doc_id) LEFT JOIN joined USING (doc_id)
    """


LLM_QUERIES = {
    "op7_licenses": op7_licenses,
    "op1_ann": op1_ann,
    "op5_topk": op5_topk,
    "op3_neardup": op3_neardup,
    "op4_packing": op4_packing,
    "op2_toxicity": op2_toxicity,
    "op6_quality": op6_quality,
    "op10_language": op10_language,
    "op8_secrets": op8_secrets,
    "op9_mixing": op9_mixing,
    "op11_filter_audit": op11_filter_audit,
    "op12_token_counts": op12_token_counts,
    "op13_spelling": op13_spelling,
}

LLM_EXPECTED = {
    "op7_licenses": _licenses_expected(),
    "op5_topk": """
        WITH whole AS (
            SELECT vec_id, [floor(64 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v
            FROM embeddings
            WHERE len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
              AND len(embedding) > 0 AND vec_id IS NOT NULL),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   list_sum([p[1] * p[2] FOR p IN list_zip(q.v, c.v)])::BIGINT AS score
            FROM whole q JOIN whole c
              ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v))
        SELECT query_id, row_number() OVER w::INT AS rank, vec_id, score FROM scored
        WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
        QUALIFY row_number() OVER w <= 20
    """,
    "op8_secrets": _secrets_expected(),
    "op13_spelling": """
        WITH RECURSIVE crc(t) AS (
            SELECT list(list_reduce(list_prepend(i, range(8)),
                lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY i)
            FROM range(256) r(i)),
        runs AS (
            SELECT coalesce(doc_id::VARCHAR, '') AS name,
                   unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{7,}')) AS run
            FROM documents),
        small AS (
            SELECT name, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run,
                   count(*) AS n
            FROM runs GROUP BY 1, 2),
        hashed AS (
            SELECT run, n, xor(list_reduce(
                list_prepend(4294967295, list_transform(range(1, strlen(name || ':' || run) + 1),
                    lambda i: ('0x' || substr(hex(encode(name || ':' || run)), (2 * i - 1)::INT, 2))::BIGINT)),
                lambda c, b: xor(t[((xor(c, b) & 255) + 1)::INT], c >> 8)), 4294967295) AS h
            FROM small, crc),
        cut AS (
            SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::INT)
                        || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n
            FROM hashed),
        words AS (
            SELECT word, sum(n)::BIGINT AS n FROM cut WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
        gaps AS (
            SELECT word, n, p, substr(word, 1, (p - 1)::INT) || substr(word, (p + 1)::INT) AS rest
            FROM words, range(1, length(word) + 1) r(p)),
        near AS (
            SELECT a.word, b.word AS other, b.n AS other_n FROM gaps a JOIN gaps b
                ON a.p = b.p AND a.rest = b.rest AND a.word <> b.word
            UNION SELECT a.word, b.word, b.n FROM gaps a JOIN words b ON a.rest = b.word
            UNION SELECT b.word, a.word, a.n FROM gaps a JOIN words b ON a.rest = b.word),
        best AS (
            SELECT word, count(*)::BIGINT AS n_near, max(other_n) AS best_n,
                   min(other) FILTER (other_n = most) AS best
            FROM (SELECT *, max(other_n) OVER (PARTITION BY word) AS most FROM near) GROUP BY word),
        forms AS (
            SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
                   CASE WHEN best_n >= 10 * w.n THEN best END AS form,
                   CASE WHEN best_n >= 10 * w.n THEN best_n END AS form_n
            FROM words w LEFT JOIN best b ON w.word = b.word),
        steps(word, here) AS (
            SELECT word, word FROM forms
            UNION ALL SELECT s.word, f.form FROM steps s JOIN forms f ON s.here = f.word WHERE f.form IS NOT NULL),
        roots AS (
            SELECT s.word, s.here AS root FROM steps s JOIN forms f ON s.here = f.word WHERE f.form IS NULL)
        SELECT f.word, form, root, n, n_near, form_n FROM forms f JOIN roots r ON f.word = r.word
    """,
    "op11_filter_audit": """
        WITH texts AS (
            SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
        firsts AS (SELECT text, min(doc_id) AS first FROM texts GROUP BY text),
        marks AS (
            SELECT doc_id, coalesce(max(quality) = 1, false) AS good,
                   coalesce(max(toxic) = 1, false) AS toxic
            FROM labels GROUP BY doc_id),
        counted AS (
            SELECT doc_id, part, text, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS w,
                   length(text) AS points,
                   length(regexp_replace(text, '[^A-Z]', '', 'g')) AS capitals
            FROM texts),
        failed AS (
            SELECT c.part, coalesce(m.good, false) AS good, coalesce(m.toxic, false) AS toxic,
                   CASE WHEN len(w) < 200 THEN 'A' ELSE '' END
                   || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
                   || CASE WHEN 100 * capitals > 3 * points THEN 'C' ELSE '' END
                   || CASE WHEN regexp_matches(c.text, '[#$%&*|]') THEN 'D' ELSE '' END
                   || CASE WHEN c.doc_id > f.first THEN 'E' ELSE '' END AS fails
            FROM counted c JOIN firsts f ON c.text = f.text LEFT JOIN marks m ON c.doc_id = m.doc_id),
        sums AS (
            SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS n_good,
                   count(*) FILTER (toxic) AS n_toxic
            FROM failed GROUP BY part, fails),
        letters(f) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
        orders AS (
            SELECT a.f || b.f || c.f || d.f || e.f AS filter_order
            FROM letters a
            JOIN letters b ON b.f <> a.f
            JOIN letters c ON c.f <> a.f AND c.f <> b.f
            JOIN letters d ON d.f <> a.f AND d.f <> b.f AND d.f <> c.f
            JOIN letters e ON e.f <> a.f AND e.f <> b.f AND e.f <> c.f AND e.f <> d.f),
        steps AS (
            SELECT filter_order, step::INT AS step, substr(filter_order, step::INT, 1) AS own,
                   substr(filter_order, 1, step::INT - 1) AS before
            FROM orders, range(1, 6) r(step)),
        applied AS (
            SELECT part, filter_order, step, own, n, n_good, n_toxic, fails,
                   strpos(fails, own) > 0 AS hit,
                   length(translate(fails, before, '')) < length(fails) AS gone
            FROM sums, steps),
        told AS (
            SELECT part, filter_order, step, own,
                   coalesce(sum(n) FILTER (NOT hit AND NOT gone), 0)::BIGINT AS kept,
                   coalesce(sum(n) FILTER (hit AND NOT gone), 0)::BIGINT AS removed,
                   coalesce(sum(n) FILTER (hit AND gone), 0)::BIGINT AS redundant,
                   coalesce(sum(n) FILTER (fails = own), 0)::BIGINT AS unique_fails,
                   coalesce(sum(n_good) FILTER (hit AND NOT gone), 0)::BIGINT AS good_lost,
                   coalesce(sum(n_toxic) FILTER (hit AND NOT gone), 0)::BIGINT AS toxic_lost
            FROM applied GROUP BY part, filter_order, step, own)
        SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
               (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
        FROM told
    """,
    "op9_mixing": """
        WITH sized AS (
            SELECT doc_id, source,
                   coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size
            FROM documents),
        totals AS (
            SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
        weighted AS (
            SELECT *, ([3.0::DOUBLE, 1.0, 2.0])[(row_number() OVER (
                       ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1] AS w
            FROM totals),
        levels AS (
            SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
                       - coalesce(sum(2.0::DOUBLE * source_size) OVER (f ROWS BETWEEN
                                  UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                      / (sum(w) OVER () - coalesce(sum(w) OVER (f ROWS BETWEEN
                                  UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
            FROM weighted
            WINDOW f AS (ORDER BY 2.0::DOUBLE * source_size / w, encode(source) NULLS LAST)),
        targets AS (
            SELECT source, source_size,
                   least(2.0::DOUBLE * source_size, w * max(level) OVER ()) AS target
            FROM levels),
        rates AS (
            SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate
            FROM targets),
        counted AS (SELECT source, count(*) AS n FROM sized GROUP BY source),
        named AS (
            SELECT s.*, r.source_size, r.target, r.rate, coalesce(s.doc_id::VARCHAR, '') AS name, c.n
            FROM sized s JOIN rates r ON s.source IS NOT DISTINCT FROM r.source
                 JOIN counted c ON s.source IS NOT DISTINCT FROM c.source),
        dealt AS (
            SELECT *, floor(('0x' || substr(md5('g:' || name), 1, 12))::BIGINT
                            / 281474976710656.0::DOUBLE * ceil(n / 1000.0::DOUBLE))::BIGINT AS stratum,
                   ('0x' || substr(md5('o:' || name), 1, 12))::BIGINT AS line
            FROM named),
        placed AS (
            SELECT *, row_number() OVER (PARTITION BY source, stratum
                                         ORDER BY size, line, doc_id NULLS LAST) AS place,
                   ('0x' || substr(md5('u:' || stratum || ':' || coalesce(source, '')), 1, 12))::BIGINT
                   / 281474976710656.0::DOUBLE AS begun,
                   rate - floor(rate) AS part
            FROM dealt),
        drawn AS (
            SELECT *, (floor(rate) + floor(place * part + begun)
                       - floor((place - 1) * part + begun))::INT AS copies
            FROM placed)
        SELECT doc_id, size, source_size, target, (size * copies)::BIGINT AS taken, copies FROM drawn
    """,
}
