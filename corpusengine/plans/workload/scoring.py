"""Term weights, templates, votes, places, sentiment and BM25."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusengine.functions import votes
from corpusengine.functions.text import split_java, tokens
from corpusengine.operators import bm25, evaluate, models, places, sentiment, templates
from corpusengine.operators.brands import brand_contains
from corpusengine.operators.each import each
from corpusengine.operators.lookup import attach
from corpusengine.operators.summary import sentence_tokens
from corpusengine.operators.tfidf import tfidf
from corpusengine.plans.workload.registry import (
    ARTICLES_SQL,
    SENTENCE_MARKS,
    articles,
    documents,
    query,
    stop_words,
    values,
    CLAUSE_MARKS,
)
from corpusengine.plans.workload.texts import CLAUSES_SQL, SENTENCE_TOKENS_SQL, SENTENCES_SQL
from corpusengine.session import stage
from corpusengine.sources import scan_parquet

# --- TF-IDF and templates -------------------------------------------------------------------------------------


def _tfidf_sql(id_col: str) -> str:
    return f"""
WITH counts AS (
  SELECT id, word, count(*) AS n
  FROM (SELECT {id_col} AS id, unnest(string_split(rtrim(text, ' '), ' ')) AS word FROM documents) GROUP BY id, word),
spread AS (SELECT word, count(*) AS df FROM counts GROUP BY word)
SELECT id AS {id_col}, word, n::double / (SELECT count(*) FROM spread)
  * ln((SELECT count(DISTINCT {id_col}) FROM documents)::double / df + 0.01) AS tfidf
FROM counts JOIN spread USING (word)"""


@query("tfidf", f"SELECT doc_id, word, round(tfidf, 12) AS tfidf FROM ({_tfidf_sql('doc_id')})")
def tfidf_by_document(spark, sf):
    weights = tfidf(documents(spark, sf), "doc_id", "text", "word")
    return weights.withColumn("tfidf", F.round("tfidf", 12))


@query("tfidf_by_class", f"SELECT lang, word, round(tfidf, 12) AS tfidf FROM ({_tfidf_sql('lang')})")
def tfidf_by_class(spark, sf):
    return tfidf(documents(spark, sf, "text", "lang"), "lang", "text", "word").withColumn("tfidf", F.round("tfidf", 12))


TEMPLATE_SQL = f"""
SELECT lang AS class, word, tfidf / sum(tfidf) OVER (PARTITION BY lang) AS tfidf
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY tfidf DESC, word) AS r FROM ({_tfidf_sql('lang')}))
WHERE r <= 500 AND regexp_matches(word, '[a-z]')"""


def _template(spark, sf):
    return templates.class_template(documents(spark, sf, "text", "lang"), "lang", "text", keep_pattern="[a-z]")


@query("class_template", f"SELECT class, word, round(tfidf, 10) AS tfidf FROM ({TEMPLATE_SQL})")
def class_template(spark, sf):
    return _template(spark, sf).withColumn("tfidf", F.round("tfidf", 10))


@query(
    "template_word_map",
    f"""SELECT word, string_agg(class, ' ' ORDER BY class) AS classes, round(sum(tfidf), 10) AS weight
FROM ({TEMPLATE_SQL}) GROUP BY word""",
)
def template_word_map(spark, sf):
    total = F.aggregate("classes", F.lit(0.0), lambda a, c: a + c["tfidf"])
    names = F.array_join(F.col("classes.class"), " ")
    return templates.template_word_map(_template(spark, sf)).select("word", names.alias("classes"), F.round(total, 10).alias("weight"))


@query(
    "template_lookup",
    f"""SELECT doc_id, class, count(*) AS hits, round(sum(tfidf), 9) AS weight
FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM documents) JOIN ({TEMPLATE_SQL}) USING (word)
GROUP BY doc_id, class""",
)
def template_lookup(spark, sf):
    words = each(documents(spark, sf), ["doc_id"], split_java("text"), "word")
    found = attach(words, stage(_template(spark, sf), "template"), "word")
    return found.groupBy("doc_id", "class").agg(F.count("*").alias("hits"), F.round(F.sum("tfidf"), 9).alias("weight"))


CLASSIFIED_SQL = f"""
SELECT d.doc_id, d.lang, coalesce(best.class, 'Unknown') AS "docClass" FROM documents d LEFT JOIN (
  SELECT doc_id, class FROM (
    SELECT doc_id, class, round(sum(tfidf), 9) AS score
    FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM documents) JOIN ({TEMPLATE_SQL}) USING (word)
    GROUP BY doc_id, class)
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, class) = 1) best USING (doc_id)"""


@query("template_classify", f'SELECT doc_id, "docClass" FROM ({CLASSIFIED_SQL})')
def template_classify(spark, sf):
    return templates.template_classify(documents(spark, sf), "doc_id", "text", _template(spark, sf))


@query("filter_match", f"""SELECT doc_id FROM ({CLASSIFIED_SQL}) WHERE lang = "docClass" AND "docClass" <> 'Unknown'""")
def filter_match(spark, sf):
    classified = templates.template_classify(documents(spark, sf), "doc_id", "text", _template(spark, sf))
    joined = classified.join(documents(spark, sf, "lang"), "doc_id")
    return joined.where((F.col("lang") == F.col("docClass")) & (F.col("docClass") != "Unknown")).select("doc_id")


@query(
    "template_accuracy",
    f"""SELECT count_if(lang = "docClass")::double / count_if("docClass" <> 'Unknown') AS accuracy FROM ({CLASSIFIED_SQL})""",
)
def template_accuracy(spark, sf):
    classified = templates.template_classify(documents(spark, sf), "doc_id", "text", _template(spark, sf))
    return templates.template_accuracy(classified.join(documents(spark, sf, "lang"), "doc_id"), "lang")


# --- votes and labels -----------------------------------------------------------------------------------------

MEMBERS = (3, 5, 7, 11, 13)
LABELS = ["时事", "军事", "汽车", "娱乐", "体育"]
BRANDS = [("ation",), ("schen",), ("eaux l",)]


def _member(k: int) -> str:
    return f"((doc_id * {k} + n_chars) % (3 * {k})) % 5"


def _predictions():
    return F.array(*(F.expr(_member(k)).cast("double") for k in MEMBERS))


VOTES_SQL = f"""
SELECT doc_id, p, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, p) AS r FROM (
  SELECT doc_id, p, count(*) AS n
  FROM (SELECT doc_id, unnest([{", ".join(map(_member, MEMBERS))}]) AS p FROM documents) GROUP BY doc_id, p)"""
LABELS_SQL = "['" + "', '".join(LABELS) + "']"
BRAND_SQL = "regexp_matches(text, '" + "|".join(b for (b,) in BRANDS) + "')"


@query("majority_vote", f"SELECT doc_id, p::double AS prediction FROM ({VOTES_SQL}) WHERE r = 1")
def majority_vote(spark, sf):
    return documents(spark, sf, "n_chars").select("doc_id", votes.majority_vote(_predictions()).alias("prediction"))


@query(
    "vote_labels_ranked",
    f"SELECT doc_id, string_agg({LABELS_SQL}[p + 1], ' ' ORDER BY r) AS labels FROM ({VOTES_SQL}) GROUP BY doc_id",
)
def vote_labels_ranked(spark, sf):
    ranked = votes.vote_labels_ranked(_predictions(), F.array(*map(F.lit, LABELS)))
    return documents(spark, sf, "n_chars").select("doc_id", F.array_join(ranked, " ").alias("labels"))


@query("brand_contains", f"SELECT doc_id, {BRAND_SQL} AS has_brand FROM documents")
def brands(spark, sf):
    return brand_contains(documents(spark, sf), "text", values(spark, "brand string", *BRANDS)).drop("text")


@query(
    "label_vote_rules",
    f"""WITH kept AS (
  SELECT doc_id, label, row_number() OVER (PARTITION BY doc_id ORDER BY r) AS r
  FROM (SELECT doc_id, {LABELS_SQL}[p + 1] AS label, r FROM ({VOTES_SQL})) JOIN documents USING (doc_id)
  WHERE label <> '汽车' OR {BRAND_SQL}),
firsts AS (SELECT doc_id, label AS lead_label FROM kept WHERE r = 1)
SELECT d.doc_id, coalesce(string_agg(k.label, ' ' ORDER BY k.r), '时事') AS "docClass"
FROM documents d LEFT JOIN firsts f USING (doc_id) LEFT JOIN kept k
  ON k.doc_id = d.doc_id AND (f.lead_label <> '军事' OR k.label NOT IN ('娱乐', '旅游', '体育', '汽车'))
GROUP BY d.doc_id""",
)
def label_vote_rules(spark, sf):
    df = brand_contains(documents(spark, sf, "text", "n_chars"), "text", values(spark, "brand string", *BRANDS))
    ranked = votes.vote_labels_ranked(_predictions(), F.array(*map(F.lit, LABELS)))
    return df.select("doc_id", votes.label_vote_rules(ranked, F.col("has_brand")).alias("docClass"))


@query(
    "label_index",
    """WITH classes AS (
  SELECT source, row_number() OVER (ORDER BY count(*) DESC, source) - 1 AS i FROM documents GROUP BY source)
SELECT doc_id, source, i::double AS "indexedClass" FROM documents JOIN classes USING (source)""",
)
def label_index(spark, sf):
    df = documents(spark, sf, "source")
    return models.train_label_index(df, "source").transform(df)


@query(
    "weighted_f1",
    """WITH p AS (SELECT doc_id % 4 AS label, (doc_id + n_chars) % 4 AS prediction FROM documents),
f AS (SELECT c, (SELECT count(*) FROM p WHERE label = c) AS labels, (SELECT count(*) FROM p WHERE prediction = c) AS predictions,
  (SELECT count(*) FROM p WHERE label = c AND prediction = c) AS hits FROM (SELECT unnest([0, 1, 2, 3]) AS c))
SELECT round(sum(2.0::double * hits / (labels + predictions) * labels) / sum(labels), 9) AS f1 FROM f""",
)
def weighted_f1(spark, sf):
    df = documents(spark, sf, "n_chars").select(
        (F.col("doc_id") % 4).alias("label"), ((F.col("doc_id") + F.col("n_chars")) % 4).alias("prediction")
    )
    return evaluate.weighted_f1(df, "label", "prediction").select(F.round("f1", 9).alias("f1"))


# --- places ---------------------------------------------------------------------------------------------------

PLACES_SQL = f"""
SELECT doc_id, place, count(*) AS n, min(pos) - 1 AS first_at FROM (
  SELECT doc_id, unnest(l) AS place, generate_subscripts(l, 1) AS pos FROM (
    SELECT doc_id, list_filter(string_split(CASE WHEN t IS NULL THEN c WHEN c IS NULL THEN t
      ELSE t || ' ' || t || ' ' || t || ' ' || c END, ' '), lambda x: x <> '') AS l
    FROM (SELECT doc_id, trim(title, E' \\n') AS t,
            CASE WHEN content <> '' THEN trim(content, E' \\n') END AS c FROM ({ARTICLES_SQL}))))
GROUP BY doc_id, place"""


def _places(spark, sf):
    return articles(spark, sf).select("doc_id", F.col("title").alias("t"), F.nullif("content", F.lit("")).alias("c"))


@query("place_count", PLACES_SQL)
def place_count(spark, sf):
    return places.place_count(_places(spark, sf), "doc_id", "t", "c").where(F.col("place").isNotNull())


REGION_SQL = f"""SELECT doc_id, string_agg(place, ' ' ORDER BY r) AS region FROM documents LEFT JOIN (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, first_at) AS r FROM ({PLACES_SQL}) QUALIFY r <= 3) USING (doc_id)
GROUP BY doc_id"""


@query("region", REGION_SQL)
def region(spark, sf):
    return places.region(_places(spark, sf), "doc_id", "t", "c")


# --- sentiment ------------------------------------------------------------------------------------------------

SENTIMENT = [("the", 1.0), ("that", -0.5), ("und", -1.0), ("la", 0.5), ("les", -0.25), ("was", -2.0), ("is", 0.5)]
ADVERBS = [("is", 1.5), ("de", 2.0), ("der", 0.5), ("and", 4.0), ("of", 0.25)]
NEGATIONS = [("for",), ("des",), ("in",), ("of",)]


def _values_sql(rows: list[tuple], columns: str) -> str:
    return f"(VALUES {', '.join('(' + ', '.join(map(repr, row)) + ')' for row in rows)}) AS v({columns})"


def _lexicons(spark):
    weighted = "word string, weight double"
    return values(spark, weighted, *SENTIMENT), values(spark, weighted, *ADVERBS), values(spark, "word string", *NEGATIONS)


@query(
    "lexicon_lookup",
    rf"""SELECT doc_id, count(s.weight) AS felt, count(a.adverb) AS adverbs, count(n.word) AS negations
FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[\p{{L}}\p{{N}}]+')) AS word FROM documents)
  LEFT JOIN (SELECT * FROM {_values_sql(SENTIMENT, "word, weight")}) s USING (word)
  LEFT JOIN (SELECT * FROM {_values_sql(ADVERBS, "word, adverb")}) a USING (word)
  LEFT JOIN (SELECT * FROM {_values_sql(NEGATIONS, "word")}) n USING (word) GROUP BY doc_id""",
)
def lexicon_lookup(spark, sf):
    words = each(documents(spark, sf), ["doc_id"], tokens("text", "word"), "word")
    found = attach(words, sentiment.modifier_dictionary(*_lexicons(spark)), "word", "left")
    return found.groupBy("doc_id").agg(
        F.count("weight").alias("felt"), F.count("adverb").alias("adverbs"), F.count_if("negates").alias("negations")
    )


SENTIMENT_SQL = rf"""
WITH words AS (
  SELECT doc_id, clause, unnest(l) AS word, generate_subscripts(l, 1) - 1 AS pos
  FROM (SELECT doc_id, clause, regexp_extract_all(text, '[\p{{L}}\p{{N}}]+') AS l FROM ({CLAUSES_SQL}))),
felt AS (
  SELECT doc_id, clause, pos, s.weight::double AS weight,
    coalesce(lag(pos) OVER (PARTITION BY doc_id, clause ORDER BY pos), 0) AS since
  FROM words JOIN (SELECT * FROM {_values_sql(SENTIMENT, "word, weight")}) s USING (word)),
changes AS (
  SELECT doc_id, clause, pos, a.adverb::double AS adverb, n.word IS NOT NULL AS negates
  FROM words LEFT JOIN (SELECT * FROM {_values_sql(ADVERBS, "word, adverb")}) a USING (word)
    LEFT JOIN (SELECT * FROM {_values_sql(NEGATIONS, "word")}) n USING (word)
  WHERE a.word IS NOT NULL OR n.word IS NOT NULL),
scored AS (
  SELECT f.doc_id, f.clause, f.pos, any_value(f.weight)
    * coalesce(product(CASE WHEN c.negates THEN -1.0::double ELSE 1.0 END * coalesce(c.adverb, 1.0)) FILTER (c.pos IS NOT NULL), 1.0)
    * CASE WHEN max(c.pos) FILTER (c.negates) < max(c.pos) FILTER (c.adverb IS NOT NULL) THEN 2.0::double
           WHEN max(c.pos) FILTER (c.negates) >= max(c.pos) FILTER (c.adverb IS NOT NULL) THEN 0.5 ELSE 1.0 END AS score
  FROM felt f LEFT JOIN changes c ON c.doc_id = f.doc_id AND c.clause = f.clause AND c.pos > f.since AND c.pos < f.pos
  GROUP BY f.doc_id, f.clause, f.pos)
SELECT doc_id, clause, coalesce(sum(score), 0.0::double) * CASE WHEN clause = 0 THEN 2 ELSE 1 END AS score
FROM (SELECT doc_id, 0 AS clause, NULL::double AS score FROM documents UNION ALL SELECT doc_id, clause, score FROM scored)
GROUP BY doc_id, clause"""


def _clauses(spark, sf):
    return sentiment.clause_sentiment(
        articles(spark, sf), "doc_id", "title", "content", *_lexicons(spark), marks=CLAUSE_MARKS
    )


@query("clause_sentiment", f"SELECT doc_id, clause, round(score, 9) AS score FROM ({SENTIMENT_SQL})")
def clause_sentiment(spark, sf):
    return _clauses(spark, sf).withColumn("score", F.round("score", 9))


SHARES_SQL = f"""
SELECT doc_id, coalesce(sum(score) FILTER (score >= 0), 0) AS pos, coalesce(-sum(score) FILTER (score < 0), 0) AS neg
FROM ({SENTIMENT_SQL}) GROUP BY doc_id"""
# Two decimals of a share by its exact value: DuckDB casts a double to a decimal from its digits, so by whole numbers.
ROUNDED_SQL = "((trunc(({0}) * 1152921504606846976.0::double)::hugeint * 100 + 576460752303423488) // 1152921504606846976)::double / 100"
PERCENT_SQL = f"""SELECT doc_id, CASE WHEN pos + neg = 0 THEN 0.5 ELSE {ROUNDED_SQL.format("pos / (pos + neg)")} END AS positive,
  CASE WHEN pos + neg = 0 THEN 0.5 ELSE {ROUNDED_SQL.format("neg / (pos + neg)")} END AS negative FROM ({SHARES_SQL})"""


@query("sentiment_percent", PERCENT_SQL)
def sentiment_percent(spark, sf):
    shares = sentiment.sentiment_percent(_clauses(spark, sf), "doc_id")
    return shares.select("doc_id", F.col("sentiment")[0].alias("positive"), F.col("sentiment")[1].alias("negative"))


@query(
    "sentiment_sign",
    f"""SELECT doc_id, CASE WHEN pos + neg = 0 THEN 0.0::double WHEN pos >= neg THEN 1.0::double ELSE -1.0::double END AS sign
FROM ({SHARES_SQL})""",
)
def sentiment_sign(spark, sf):
    return sentiment.sentiment_sign(_clauses(spark, sf), "doc_id").select("doc_id", F.col("sentiment")[0].alias("sign"))


# --- BM25 -----------------------------------------------------------------------------------------------------

# (doc_id, sent, term, tf, gain)
POSTINGS_SQL = f"""
SELECT doc_id, sent, term, tf, (ln(n_sents - df + 0.5) - ln(df + 0.5)) * tf * 2.5
  / (tf + 1.5 * (0.25 + 0.75 * length / (total::double / n_sents))) AS gain
FROM (
  SELECT *, count(*) OVER (PARTITION BY doc_id, term) AS df, sum(tf) OVER (PARTITION BY doc_id) AS total
  FROM (SELECT doc_id, n_sents, sent, length, term, count(*) AS tf FROM ({SENTENCE_TOKENS_SQL}) GROUP BY ALL))"""


def _sentences(spark, sf):
    return sentence_tokens(documents(spark, sf), "text", stop_words(spark, sf), marks=SENTENCE_MARKS)


@query(
    "term_stats",
    f"""SELECT doc_id, term, count(*) AS df, sum(tf)::bigint AS tf
FROM (SELECT doc_id, sent, term, count(*) AS tf FROM ({SENTENCE_TOKENS_SQL}) GROUP BY ALL) GROUP BY doc_id, term""",
)
def term_stats(spark, sf):
    return bm25.term_stats_in_row(_sentences(spark, sf), "doc_id", "tokens")


@query(
    "bm25_sentence_sim",
    f"""WITH p AS MATERIALIZED ({POSTINGS_SQL}),
numbers AS (SELECT doc_id, unnest(range(len(l))) AS sent, len(l) AS n FROM ({SENTENCES_SQL})),
pairs AS (SELECT doc_id, sent, unnest(range(n)) AS other FROM numbers)
SELECT pairs.doc_id, pairs.sent, pairs.other, round(coalesce(sum(a.tf * b.gain), 0), 6) AS sim
FROM pairs LEFT JOIN p a ON a.doc_id = pairs.doc_id AND a.sent = pairs.sent
  LEFT JOIN p b ON b.doc_id = pairs.doc_id AND b.sent = pairs.other AND b.term = a.term
GROUP BY pairs.doc_id, pairs.sent, pairs.other""",
)
def bm25_sentence_sim(spark, sf):
    """Every sentence against every one of its text."""
    return bm25.sentence_similarity(_sentences(spark, sf), "doc_id", "tokens", digits=6)


@query(
    "bm25_pair_sim",
    f"""WITH p AS MATERIALIZED ({POSTINGS_SQL}),
pairs AS (SELECT doc_id, unnest(range(len(l))) AS sent, 0 AS other FROM ({SENTENCES_SQL}))
SELECT pairs.doc_id, pairs.sent, pairs.other, round(coalesce(sum(a.tf * b.gain), 0), 6) AS sim
FROM pairs LEFT JOIN p a ON a.doc_id = pairs.doc_id AND a.sent = pairs.sent
  LEFT JOIN p b ON b.doc_id = pairs.doc_id AND b.sent = pairs.other AND b.term = a.term
GROUP BY pairs.doc_id, pairs.sent, pairs.other""",
)
def bm25_pair_sim(spark, sf):
    """Every sentence against the first of its text."""
    to_first = F.transform("tokens", lambda _, at: F.struct(at.alias("sent"), F.lit(0).alias("other")))
    sims = bm25.similarity_in_row(_sentences(spark, sf), "doc_id", "tokens", to_first)
    return sims.withColumn("sim", F.round("sim", 6))


@query(
    "bm25_similarity_sums",
    f"""WITH p AS MATERIALIZED ({POSTINGS_SQL})
SELECT a.doc_id, a.sent, round(sum(a.tf * b.gain) FILTER (a.sent = b.sent), 6) AS to_self,
  round(coalesce(sum(a.tf * b.gain) FILTER (a.sent <> b.sent), 0), 6) AS to_others
FROM p a JOIN p b ON a.doc_id = b.doc_id AND a.term = b.term GROUP BY a.doc_id, a.sent""",
)
def bm25_similarity_sums(spark, sf):
    sums = bm25.similarity_sums_in_row(_sentences(spark, sf), "doc_id", "tokens")
    return sums.select("doc_id", "sent", F.round("to_self", 6).alias("to_self"), F.round("to_others", 6).alias("to_others"))


@query(
    "bm25_search",
    r"""WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS l FROM documents),
q AS (SELECT item_id, term, count(*) AS query_tf
      FROM (SELECT item_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS term FROM benchmark) GROUP BY ALL),
p AS (SELECT doc_id, length, term, count(*) AS tf
      FROM (SELECT doc_id, len(l) AS length, unnest(l) AS term FROM d) GROUP BY ALL),
f AS (SELECT term, count(*) AS df FROM p GROUP BY term),
s AS (SELECT count(*)::double AS n, avg(len(l)) AS mean FROM d),
scores AS (
  SELECT item_id, doc_id, round(sum(query_tf * (ln(n - df + 0.5) - ln(df + 0.5)) * tf * 2.5
    / (tf + 1.5 * (0.25 + 0.75 * length / mean))), 6) AS score
  FROM q JOIN p USING (term) JOIN f USING (term), s GROUP BY item_id, doc_id)
SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place
FROM scores QUALIFY place <= 10""",
)
def bm25_search(spark, sf):
    words = tokens(F.lower("text"), "word")
    collection = documents(spark, sf).select("doc_id", words.alias("tokens"))
    queries = scan_parquet(spark, f"{sf}/benchmark.parquet").select("item_id", words.alias("tokens"))
    return bm25.bm25_search(collection, "doc_id", "tokens", queries, "item_id", "tokens", k=10)
