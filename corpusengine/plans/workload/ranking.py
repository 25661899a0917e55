"""Word and sentence ranks, keywords and summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusengine.operators import keywords as K, summary as S
from corpusengine.operators.each import each
from corpusengine.plans.workload.registry import (
    SENTENCE_MARKS,
    TAGGED_WORDS_SQL,
    documents,
    query,
    stop_words,
    tagged_articles,
)
from corpusengine.plans.workload.texts import CLEAN_SQL, KEPT_WORDS_SQL, SENTENCES_SQL
from corpusengine.plans.workload.scoring import POSTINGS_SQL

# --- words ----------------------------------------------------------------------------------------------------

LINKS_SQL = f"""
SELECT DISTINCT a.doc_id, a.word AS src, b.word AS dst
FROM (SELECT *, count(*) OVER (PARTITION BY doc_id) AS n FROM ({KEPT_WORDS_SQL})) a
JOIN ({KEPT_WORDS_SQL}) b ON a.doc_id = b.doc_id AND b.pos BETWEEN a.pos - 2 AND a.pos + 2 AND a.word <> b.word
WHERE a.n >= 3"""

# Rounds go on for a document while its largest change is above the limit.
WORD_RANK_SQL = f"""
WITH RECURSIVE links AS MATERIALIZED ({LINKS_SQL}),
sent AS MATERIALIZED (SELECT *, count(*) OVER (PARTITION BY doc_id, src) AS degree FROM links),
nodes AS MATERIALIZED (SELECT DISTINCT doc_id, word FROM ({KEPT_WORDS_SQL})),
rounds AS (
  SELECT doc_id, word, 1.0::double / count(*) OVER (PARTITION BY doc_id) AS score, 1.0::double AS moved, 0 AS round FROM nodes
  UNION ALL
  SELECT doc_id, word, score, max(change) OVER (PARTITION BY doc_id) AS moved, round
  FROM (
    SELECT r.doc_id, r.word, 0.15 + 0.85 * coalesce(i.inflow, 0) AS score,
      abs(0.15 + 0.85 * coalesce(i.inflow, 0) - r.score) AS change, r.round + 1 AS round
    FROM rounds r LEFT JOIN (
      SELECT s.doc_id, s.dst, sum(q.score / s.degree) AS inflow
      FROM sent s JOIN rounds q ON s.doc_id = q.doc_id AND s.src = q.word WHERE q.moved > 1e-4 GROUP BY s.doc_id, s.dst) i
      ON i.doc_id = r.doc_id AND i.dst = r.word
    WHERE r.moved > 1e-4 AND r.round < 200))
SELECT doc_id, word, round(score, 9) AS score FROM rounds
QUALIFY row_number() OVER (PARTITION BY doc_id, word ORDER BY round DESC) = 1"""


def _kept(spark, sf):
    words = K.tagged_words(tagged_articles(spark, sf), "title", "content")
    return K.kept_words(words, stop_words=stop_words(spark, sf))


def _words(df, column):
    return each(df, ["doc_id"], column, "w").select("doc_id", "w.word", "w.score")


@query("sliding_cooccurrence", LINKS_SQL)
def sliding_cooccurrence(spark, sf):
    return K.sliding_cooccurrence(_kept(spark, sf), "doc_id")


@query("textrank_words", WORD_RANK_SQL)
def textrank_words(spark, sf):
    return _words(K.textrank_words(_kept(spark, sf)), "ranked")


CANDIDATES_SQL = f"""
SELECT doc_id, word, score FROM ({WORD_RANK_SQL})
QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, word) <= 20"""


@query("candidate_words", CANDIDATES_SQL)
def candidate_words(spark, sf):
    return _words(K.textrank_words(_kept(spark, sf)), K.candidate_words("ranked"))


BOOSTED_SQL = f"""
SELECT c.doc_id, c.word, c.score * CASE WHEN t.word IS NULL THEN 1 ELSE 2 END AS score
FROM ({CANDIDATES_SQL}) c LEFT JOIN (SELECT DISTINCT doc_id, word FROM ({TAGGED_WORDS_SQL}) WHERE in_title) t
  ON t.doc_id = c.doc_id AND t.word = c.word"""


def _boosted(spark, sf):
    ranked = K.textrank_words(_kept(spark, sf))
    boosted = K.title_boost(K.candidate_words("ranked"), F.col("title_words"))
    return ranked.select("doc_id", F.col("words.word").alias("text"), boosted.alias("boosted"))


@query("title_boost", BOOSTED_SQL)
def title_boost(spark, sf):
    return _words(_boosted(spark, sf), "boosted")


# Candidates in order; a state is the list of words chosen so far.
CHOSEN_SQL = f"""
WITH RECURSIVE boosted AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, word) AS r FROM ({BOOSTED_SQL})),
walk AS (
  SELECT doc_id, r, [word] AS words, [score] AS scores FROM boosted WHERE r = 1
  UNION ALL
  SELECT w.doc_id, b.r,
    CASE WHEN len(w.words) >= 7 OR len(list_filter(w.words, lambda c: contains(c, b.word) OR contains(b.word, c))) > 0
      THEN w.words ELSE list_append(w.words, b.word) END,
    CASE WHEN len(w.words) >= 7 OR len(list_filter(w.words, lambda c: contains(c, b.word) OR contains(b.word, c))) > 0
      THEN w.scores ELSE list_append(w.scores, b.score) END
  FROM walk w JOIN boosted b ON b.doc_id = w.doc_id AND b.r = w.r + 1)
SELECT doc_id, words, scores FROM walk QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY r DESC) = 1"""


@query(
    "select_distinct_keywords",
    f"SELECT doc_id, unnest(words) AS word, unnest(scores) AS score FROM ({CHOSEN_SQL})",
)
def select_distinct_keywords(spark, sf):
    return _words(_boosted(spark, sf), K.select_distinct_keywords("boosted"))


@query(
    "adjacent_pairs",
    f"""SELECT word, after, count(*) AS n
FROM (SELECT word, lead(word) OVER (PARTITION BY doc_id ORDER BY pos) AS after FROM ({TAGGED_WORDS_SQL}))
WHERE after IS NOT NULL GROUP BY word, after""",
)
def adjacent_pairs(spark, sf):
    words = K.tagged_words(tagged_articles(spark, sf), "title", "content")
    pairs = each(words, [], K.adjacent_pairs(F.col("words.word")), "pair")
    return pairs.groupBy(F.col("pair.left").alias("word"), F.col("pair.right").alias("after")).agg(F.count("*").alias("n"))


# Each step merges the first pair of current keywords after the last merge.
MERGED_SQL = f"""
WITH RECURSIVE chosen AS MATERIALIZED ({CHOSEN_SQL}),
followed AS (SELECT doc_id, pos, word, lead(word) OVER (PARTITION BY doc_id ORDER BY pos) AS after FROM ({TAGGED_WORDS_SQL})),
pairs AS MATERIALIZED (
  SELECT f.doc_id, pos, word, after FROM followed f JOIN chosen c USING (doc_id)
  WHERE lower(word) <> lower(after) AND len(list_filter(words, lambda k: starts_with(word, k))) > 0
    AND len(list_filter(words, lambda k: starts_with(after, k))) > 0),
walk AS (
  SELECT doc_id, words, scores, -1::bigint AS at, 0 AS step FROM chosen
  UNION ALL
  SELECT doc_id, list_append(list_filter(words, lambda k: k <> word AND k <> after), word || after),
    list_append(list_filter(scores, lambda s, i: words[i] <> word AND words[i] <> after),
      greatest(scores[list_position(words, word)], scores[list_position(words, after)])), pos, step + 1
  FROM (SELECT w.*, p.pos, p.word, p.after FROM walk w JOIN pairs p ON p.doc_id = w.doc_id AND p.pos > w.at
          AND list_contains(w.words, p.word) AND list_contains(w.words, p.after)
        QUALIFY row_number() OVER (PARTITION BY w.doc_id ORDER BY p.pos) = 1))
SELECT doc_id, unnest(words) AS word, unnest(scores) AS score
FROM (SELECT * FROM walk QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY step DESC) = 1)"""


@query("merge_adjacent", MERGED_SQL)
def merge_adjacent(spark, sf):
    chosen = _boosted(spark, sf).select("doc_id", "text", K.select_distinct_keywords("boosted").alias("chosen"))
    return _words(chosen, K.merge_adjacent(F.col("chosen"), F.col("text")))


KEYWORDS_SQL = f"""
SELECT d.doc_id, CASE WHEN d.doc_id IN (SELECT doc_id FROM ({TAGGED_WORDS_SQL})) THEN coalesce(k.keywords, '') END AS keywords
FROM documents d LEFT JOIN (
  SELECT doc_id, string_agg(word, ' ' ORDER BY round(score, 9) DESC, word) AS keywords FROM ({MERGED_SQL}) GROUP BY doc_id) k USING (doc_id)"""


@query("keywords", KEYWORDS_SQL)
def keywords(spark, sf):
    return K.keywords(tagged_articles(spark, sf), "doc_id", "title", "content", stop_words(spark, sf))


# --- sentences ------------------------------------------------------------------------------------------------

CUES = ["the th", "des "]


def _sentences(spark, sf):
    return S.sentence_tokens(documents(spark, sf), "text", stop_words(spark, sf), marks=SENTENCE_MARKS)


@query(
    "sentence_weight_rules",
    f"""SELECT doc_id, sent, length(sentence) * CASE WHEN contains(sentence, 'the th') OR contains(sentence, 'des ') THEN 2
  WHEN sent = n - 1 THEN 0.9::double ELSE 1 END AS weight
FROM (SELECT doc_id, unnest(l) AS sentence, generate_subscripts(l, 1) - 1 AS sent, len(l) AS n FROM ({SENTENCES_SQL}))""",
)
def sentence_weight_rules(spark, sf):
    scores = F.transform("sentences", lambda s: F.length(s).cast("double"))
    weighed = S.sentence_weight_rules(F.col("sentences"), scores, CUES)
    return each(_sentences(spark, sf), ["doc_id"], weighed, "sent", "weight")


def _sentence_rank_sql(postings: str, sentences: str, key: str, rounds: str) -> str:
    """Ranks over the full similarity table, by pairs of sentences."""
    return f"""
WITH RECURSIVE p AS MATERIALIZED ({postings}),
sims AS MATERIALIZED (
  SELECT a.{key}, a.sent AS i, b.sent AS j, sum(a.tf * b.gain) AS sim
  FROM p a JOIN p b ON a.{key} = b.{key} AND a.term = b.term AND a.sent <> b.sent GROUP BY ALL),
shares AS MATERIALIZED (SELECT {key}, i, j, sim / total AS share
  FROM (SELECT *, sum(sim) OVER (PARTITION BY {key}, i) AS total FROM sims) WHERE total <> 0),
rounds AS (
  SELECT {key}, unnest(range(len(l))) AS sent, 1.0::double AS score, 1.0::double AS moved, 0 AS round FROM ({sentences})
  UNION ALL
  SELECT {key}, sent, score, max(change) OVER (PARTITION BY {key}) AS moved, round
  FROM (
    SELECT r.{key}, r.sent, 0.15 + 0.85 * coalesce(f.inflow, 0) AS score,
      abs(0.15 + 0.85 * coalesce(f.inflow, 0) - r.score) AS change, r.round + 1 AS round
    FROM rounds r LEFT JOIN (
      SELECT s.{key}, s.j, sum(s.share * q.score) AS inflow
      FROM shares s JOIN rounds q ON s.{key} = q.{key} AND s.i = q.sent WHERE q.moved > 1e-4 GROUP BY s.{key}, s.j) f
      ON f.{key} = r.{key} AND f.j = r.sent
    WHERE r.moved > 1e-4 AND r.round < {rounds}))
SELECT {key}, sent, round(score, 9) AS score FROM rounds
QUALIFY row_number() OVER (PARTITION BY {key}, sent ORDER BY round DESC) = 1"""


@query(
    "textrank_sentences",
    f"""SELECT doc_id, sent, power, floor(score / 10.0::double ** power * 10000 + 0.5) / 10000 AS score
FROM (SELECT *, CASE WHEN score = 0 THEN 0 ELSE floor(log10(abs(score)))::int END AS power
  FROM ({_sentence_rank_sql(POSTINGS_SQL, SENTENCES_SQL, 'doc_id', '200')}))""",
)
def textrank_sentences(spark, sf):
    """Ranks to convergence, as five digits and a power of ten: they can grow without bound.

    An infinite rank, or one that is no number, stands as it is, without a power.
    """
    ranked = S.textrank_sentences(_sentences(spark, sf))
    scores = each(ranked, ["doc_id"], "scores", "sent", "score")
    size = F.abs("score")
    power = F.when(size == 0, 0).when(size < float("inf"), F.floor(F.log10(size)))
    digits = F.floor(F.col("score") / F.pow(F.lit(10.0), F.col("power")) * 10000 + 0.5) / 10000
    return scores.withColumn("power", power.cast("int")).withColumn("score", F.coalesce(digits, "score"))


def _picks_sql(weights: str, limit: int) -> str:
    """(doc_id, sent, turn, weight) from (doc_id, sent, weight)."""
    return f"""
WITH RECURSIVE p AS MATERIALIZED ({POSTINGS_SQL}),
alike AS (SELECT doc_id, i, list(j) AS others FROM (
    SELECT a.doc_id, a.sent AS i, b.sent AS j, sum(a.tf * b.gain) AS sim
    FROM p a JOIN p b ON a.doc_id = b.doc_id AND a.term = b.term AND a.sent <> b.sent GROUP BY ALL HAVING sim >= 10)
  GROUP BY doc_id, i),
turns AS (SELECT doc_id, greatest(least({limit} // (length({CLEAN_SQL.format("text")}) // len(l)), len(l)) - 1, 1) AS turns
  FROM ({SENTENCES_SQL}) JOIN documents USING (doc_id) WHERE len(l) > 0),
ordered AS MATERIALIZED (
  SELECT s.doc_id, s.sent, s.weight, coalesce(a.others, []) AS others, t.turns,
    row_number() OVER (PARTITION BY s.doc_id ORDER BY s.weight DESC, s.sent DESC) AS r
  FROM ({weights}) s JOIN turns t USING (doc_id) LEFT JOIN alike a ON a.doc_id = s.doc_id AND a.i = s.sent),
walk AS (
  SELECT doc_id, r, [sent] AS picks FROM ordered WHERE r = 1
  UNION ALL
  SELECT w.doc_id, o.r, CASE WHEN list_has_any(o.others, w.picks) THEN w.picks ELSE list_append(w.picks, o.sent) END
  FROM walk w JOIN ordered o ON o.doc_id = w.doc_id AND o.r = w.r + 1 WHERE len(w.picks) < o.turns),
picks AS (SELECT doc_id, unnest(picks) AS sent, generate_subscripts(picks, 1) - 1 AS turn
  FROM (SELECT * FROM walk QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY r DESC) = 1))
SELECT picks.*, ordered.weight FROM picks JOIN ordered USING (doc_id, sent)"""


NUMBERED_SQL = f"SELECT doc_id, unnest(l) AS sentence, generate_subscripts(l, 1) - 1 AS sent, len(l) AS n FROM ({SENTENCES_SQL})"
# The sentences' lengths stand in for their ranks here.
PICKS_SQL = _picks_sql(f"SELECT doc_id, sent, length(sentence)::double AS weight FROM ({NUMBERED_SQL})", 600)


@query("redundancy_topk", PICKS_SQL)
def redundancy_topk(spark, sf):
    weights = F.transform("sentences", lambda s: F.length(s).cast("double"))
    size = F.coalesce(S.candidate_count("cleaned", "sentences", 600), F.lit(0))
    weighed = _sentences(spark, sf).withColumn("weights", weights).withColumn("size", size)
    picks = each(S.redundancy_topk(weighed), ["doc_id"], "picks", "turn", "pick")
    return picks.select("doc_id", "turn", F.col("pick.at").alias("sent"), "pick.weight")


@query(
    "length_budget_pick",
    f"""WITH RECURSIVE ordered AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY (size * 7) % 11 DESC, sent) AS r
  FROM (SELECT doc_id, length(unnest(l)) AS size, generate_subscripts(l, 1) - 1 AS sent FROM ({SENTENCES_SQL}))),
walk AS (
  SELECT doc_id, sent, r, size <= 200 AS kept, CASE WHEN size <= 200 THEN size ELSE 0 END AS used FROM ordered WHERE r = 1
  UNION ALL
  SELECT o.doc_id, o.sent, o.r, w.used + o.size <= 200, CASE WHEN w.used + o.size <= 200 THEN w.used + o.size ELSE w.used END
  FROM walk w JOIN ordered o ON o.doc_id = w.doc_id AND o.r = w.r + 1)
SELECT doc_id, sent FROM walk WHERE kept""",
)
def length_budget_pick(spark, sf):
    entries = F.transform(
        "sentences",
        lambda s, at: F.struct(at.alias("place"), s.alias("sentence"), (F.length(s) * 7 % 11).cast("double").alias("weight")),
    )
    kept = S.length_budget_pick(entries)
    split = S.sentence_tokens(documents(spark, sf), "text", marks=SENTENCE_MARKS)
    return each(split, ["doc_id"], kept, "entry").select("doc_id", F.col("entry.at").alias("sent"))


WEIGHTS_SQL = f"""
SELECT doc_id, sent, round(score * CASE WHEN sent = n - 1 THEN 0.9::double ELSE 1 END, 9) AS weight
FROM ({_sentence_rank_sql(POSTINGS_SQL, SENTENCES_SQL, "doc_id", "200")}) JOIN ({NUMBERED_SQL}) USING (doc_id, sent)"""


SUMMARY_SQL = f"""WITH RECURSIVE numbered AS MATERIALIZED ({NUMBERED_SQL}),
picked AS MATERIALIZED (
  SELECT p.*, s.sentence, min(f.sent) AS place
  FROM ({_picks_sql(WEIGHTS_SQL, 200)}) p JOIN numbered s USING (doc_id, sent)
    JOIN numbered f ON f.doc_id = s.doc_id AND f.sentence = s.sentence GROUP BY ALL),
ordered AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY weight DESC, place) AS r FROM picked),
walk AS (
  SELECT doc_id, sentence, place, r, length(sentence) <= 200 AS kept,
    CASE WHEN length(sentence) <= 200 THEN length(sentence) ELSE 0 END AS used FROM ordered WHERE r = 1
  UNION ALL
  SELECT o.doc_id, o.sentence, o.place, o.r, w.used + length(o.sentence) <= 200,
    CASE WHEN w.used + length(o.sentence) <= 200 THEN w.used + length(o.sentence) ELSE w.used END
  FROM walk w JOIN ordered o ON o.doc_id = w.doc_id AND o.r = w.r + 1),
joined AS (SELECT doc_id, string_agg(sentence, '。' ORDER BY place) AS summary FROM walk WHERE kept GROUP BY doc_id),
best AS (SELECT doc_id, count(*) AS n, max(sentence) FILTER (turn = 0) || '。' AS sentence FROM picked GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN b.n IS NULL THEN {CLEAN_SQL.format("text")} WHEN b.n = 1 THEN b.sentence
  ELSE coalesce(j.summary, b.sentence) END AS summary
FROM documents d LEFT JOIN best b USING (doc_id) LEFT JOIN joined j USING (doc_id)"""


@query("summary", SUMMARY_SQL)
def summary(spark, sf):
    return S.summary(documents(spark, sf), "doc_id", "text", stop_words=stop_words(spark, sf), marks=SENTENCE_MARKS)
