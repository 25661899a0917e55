"""Tokenising, cleaning, splitting, sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusengine import constants as C
from corpusengine.functions import text as T
from corpusengine.operators.each import each
from corpusengine.operators.joins import join_results
from corpusengine.operators.keywords import kept_words, remove_word_filter, tagged_words
from corpusengine.operators.lookup import drop_words
from corpusengine.operators.models import train_test_split_by_key
from corpusengine.operators.summary import sentence_tokens
from corpusengine.plans.workload.registry import (
    ARTICLES_SQL,
    CLAUSE_MARKS,
    CLAUSE_SPLIT,
    SENTENCE_MARKS,
    SENTENCE_SPLIT,
    STOP_WORDS_SQL,
    TAGGED_WORDS_SQL,
    articles,
    documents,
    query,
    stop_words,
    tagged_articles,
)
from corpusengine.session import scratch_path
from corpusengine.sources import (
    bad_lexicon_lines,
    register_view,
    scan_lexicon,
    scan_parquet,
    scan_word_list,
    write_parquet,
)


def _unnested(lists: str, of: str = "documents") -> str:
    return f"""SELECT doc_id, unnest(l) AS token, generate_subscripts(l, 1) - 1 AS pos
FROM (SELECT doc_id, {lists} AS l FROM {of})"""


def _exploded(df, tokens):
    return each(df, ["doc_id"], tokens, "pos", "token")


@query("tokenize_space", _unnested("list_filter(string_split(lower(text), ' '), lambda t: t <> '')"))
def tokenize_space(spark, sf):
    return _exploded(documents(spark, sf), T.tokenize_space("text"))


@query("tokenize_sep", _unnested(r"list_filter(string_split_regex(lower(text), '[|,.]+'), lambda t: t <> '')"))
def tokenize_sep(spark, sf):
    return _exploded(documents(spark, sf), T.tokenize_sep("text", "[|,.]+"))


@query("tokenize_white", _unnested(r"string_split_regex(regexp_replace(lower(text), '\s+$', ''), '\s')"))
def tokenize_white(spark, sf):
    return _exploded(documents(spark, sf), T.tokenize_white("text"))


@query("split_space_raw", _unnested("string_split(rtrim(text, ' '), ' ')"))
def split_space_raw(spark, sf):
    return _exploded(documents(spark, sf), T.split_java("text"))


@query("tokenize_word", _unnested(r"regexp_extract_all(text, '[\p{L}\p{N}]+')"))
def tokenize_word(spark, sf):
    return _exploded(documents(spark, sf), T.tokens("text", "word"))


@query("parse_tagged", f"SELECT doc_id, word, tag, count(*) AS n FROM ({TAGGED_WORDS_SQL}) GROUP BY ALL")
def parse_tagged(spark, sf):
    words = tagged_words(tagged_articles(spark, sf), "title", "content")
    pairs = each(words, ["doc_id"], "words", "w").select("doc_id", "w.word", "w.tag")
    return pairs.groupBy("doc_id", "word", "tag").agg(F.count("*").alias("n"))


@query(
    "stopword_filter",
    f"""WITH tokens AS ({_unnested("string_split(text, ' ')")})
SELECT * FROM tokens WHERE token NOT IN (SELECT word FROM ({STOP_WORDS_SQL}))""",
)
def stopword_filter(spark, sf):
    return drop_words(_exploded(documents(spark, sf), F.split("text", " ")), stop_words(spark, sf), "token")


KEPT_WORDS_SQL = f"""
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS pos, word FROM ({TAGGED_WORDS_SQL})
WHERE tag IN ('n', 'v') AND length(word) > 1 AND word NOT IN (SELECT word FROM ({STOP_WORDS_SQL}))"""


@query("keyword_pos_filter", KEPT_WORDS_SQL)
def keyword_pos_filter(spark, sf):
    words = tagged_words(tagged_articles(spark, sf), "title", "content")
    kept = kept_words(words, stop_words=stop_words(spark, sf))
    return each(kept, ["doc_id"], "kept", "pos", "word")


@query("contains_cjk", "SELECT doc_id, regexp_matches(text || '来', '[一-龥]') AS joined, regexp_matches(text, '[一-龥]') AS plain FROM documents")
def contains_cjk(spark, sf):
    joined = T.contains_cjk(F.concat("text", F.lit("来")))
    return documents(spark, sf).select("doc_id", joined.alias("joined"), T.contains_cjk("text").alias("plain"))


@query(
    "combine",
    f"""SELECT doc_id, CASE WHEN t IS NULL THEN c WHEN c IS NULL THEN t ELSE t || ' ' || c END AS words
FROM (SELECT doc_id, CASE WHEN lang <> 'fr' THEN title END AS t, CASE WHEN content <> '' THEN content END AS c
      FROM ({ARTICLES_SQL}))""",
)
def combine(spark, sf):
    df = articles(spark, sf, "lang")
    parts = df.select("doc_id", F.when(F.col("lang") != "fr", F.col("title")).alias("t"), F.nullif("content", F.lit("")).alias("c"))
    return parts.select("doc_id", T.combine("t", "c").alias("words"))


CLEAN_SQL = r"""trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
  {0}, '　+', ' ', 'g'), ' +', ' ', 'g'), '&nbsp;?', chr(10), 'g'), '\n+', chr(10), 'g'),
  ' ' || chr(9) || chr(10) || chr(13))"""


@query(
    "clean_text",
    f"""SELECT page_id, {CLEAN_SQL.format("replace(replace(html, '</p>', '&nbsp; '), '<li>', '　 &nbsp')")} AS cleaned FROM pages""",
)
def clean_text(spark, sf):
    pages = scan_parquet(spark, f"{sf}/pages.parquet", ["page_id", "html"], spread_by="page_id")
    html = F.replace(F.replace("html", F.lit("</p>"), F.lit("&nbsp; ")), F.lit("<li>"), F.lit("　 &nbsp"))
    return pages.select("page_id", T.clean_text(html).alias("cleaned"))


SENTENCES_SQL = f"""
SELECT doc_id, list_filter(list_transform(string_split_regex({CLEAN_SQL.format("text")}, '{SENTENCE_SPLIT}'),
  lambda s: trim(s)), lambda s: length(s) > 5) AS l FROM documents"""


@query("split_sentences", f"SELECT doc_id, unnest(l) AS sentence, generate_subscripts(l, 1) - 1 AS sent FROM ({SENTENCES_SQL})")
def split_sentences(spark, sf):
    cleaned = documents(spark, sf).select("doc_id", T.clean_text("text").alias("text"))
    return each(cleaned, ["doc_id"], T.split_sentences("text", SENTENCE_MARKS), "sent", "sentence")


CLAUSES_SQL = f"""SELECT doc_id, unnest(l) AS text, generate_subscripts(l, 1) - 1 AS clause
FROM (SELECT doc_id, string_split_regex(title || '。' || content, '{CLAUSE_SPLIT}') AS l FROM ({ARTICLES_SQL}))"""


@query("split_clauses", CLAUSES_SQL)
def split_clauses(spark, sf):
    clauses = T.split_clauses("title", "content", CLAUSE_MARKS)
    return each(articles(spark, sf), ["doc_id"], clauses, "clause", "text")


# (doc_id, sent, pos, term, length, n_sents): tokens of the sentences without stop words.
SENTENCE_TOKENS_SQL = rf"""
SELECT doc_id, n_sents, sent, term, row_number() OVER (PARTITION BY doc_id, sent ORDER BY pos) - 1 AS pos,
  count(*) OVER (PARTITION BY doc_id, sent) AS length
FROM (
  SELECT doc_id, n_sents, sent, unnest(tokens) AS term, generate_subscripts(tokens, 1) AS pos
  FROM (SELECT doc_id, n_sents, sent, regexp_extract_all(sentence, '[\p{{L}}\p{{N}}]+') AS tokens
        FROM (SELECT doc_id, len(l) AS n_sents, unnest(l) AS sentence, generate_subscripts(l, 1) - 1 AS sent
              FROM ({SENTENCES_SQL}))))
WHERE term NOT IN (SELECT word FROM ({STOP_WORDS_SQL}))"""


@query("tokenize_sentence", f"SELECT doc_id, sent, pos, term FROM ({SENTENCE_TOKENS_SQL})")
def tokenize_sentence(spark, sf):
    split = sentence_tokens(documents(spark, sf), "text", stop_words(spark, sf), marks=SENTENCE_MARKS)
    sentences = each(split, ["doc_id"], "tokens", "sent", "tokens")
    return each(sentences, ["doc_id", "sent"], "tokens", "pos", "term")


@query(
    "round_half_up_2",
    """SELECT doc_id, share, ((trunc(share * 1152921504606846976.0::double)::hugeint * 100 + 576460752303423488) // 1152921504606846976)::double / 100 AS rounded
FROM (SELECT doc_id, unnest([doc_id % 41 / 40.0::double, doc_id % 201 / 200.0::double,
  doc_id % 1000 / (doc_id % 1000 + n_chars + 1.0::double)]) AS share FROM documents)""",
)
def round_half_up_2(spark, sf):
    """Shares with exact ties and near ones among them."""
    thousandth = F.col("doc_id") % 1000
    shares = F.array(
        F.col("doc_id") % 41 / F.lit(40.0), F.col("doc_id") % 201 / F.lit(200.0), thousandth / (thousandth + F.col("n_chars") + F.lit(1.0))
    )
    rows = documents(spark, sf, "n_chars").select("doc_id", F.explode(shares).alias("share"))
    return rows.withColumn("rounded", T.round_half_up_2(F.col("share")))


ORIGIN_SQL = """SELECT doc_id, CASE WHEN list_contains(string_split_regex(trim(regexp_replace(named, '^[^\\n]*?[:：][ ]*', '')), '[-－]'), source)
  THEN '1' ELSE '0' END AS original
FROM (SELECT doc_id, source, CASE WHEN lang <> 'es' THEN
  lang || CASE WHEN doc_id % 2 = 0 THEN ': ' ELSE '：' END || 'src' || (doc_id % 7) || '－' || lang || '-src' || (doc_id % 20 - doc_id % 3)
  END AS named FROM documents)"""


def origin_line():
    """A label and three sites; null for one language."""
    sites = F.concat(
        F.col("lang"), F.when(F.col("doc_id") % 2 == 0, ": ").otherwise("："), F.lit("src"), F.col("doc_id") % 7, F.lit("－"),
        F.col("lang"), F.lit("-src"), F.col("doc_id") % 20 - F.col("doc_id") % 3,
    )
    return F.when(F.col("lang") != "es", sites)


@query("origin_flag", ORIGIN_SQL)
def origin_flag(spark, sf):
    df = documents(spark, sf, "lang", "source")
    return df.select("doc_id", T.origin_flag(F.col("source"), origin_line()).alias("original"))


# --- sources and sinks ----------------------------------------------------------------------------------------

# One dictionary line per document, in order of doc_id: some malformed, some without a number, words repeated.
_LEXICON_LINE = """concat(' ', source, CASE lang WHEN 'de' THEN '' ELSE '\\t' END, CASE lang WHEN 'fr' THEN 'x' ELSE '' END,
  n_chars, CASE WHEN doc_id % 5 = 0 THEN '\\tmore' ELSE ' ' END)"""


def _lexicon_file(spark, sf):
    path = scratch_path(spark, "lexicon")
    lines = documents(spark, sf, "source", "lang", "n_chars").select("doc_id", F.expr(_LEXICON_LINE).alias("value"))
    lines.orderBy("doc_id").select("value").write.text(path)
    return path


@query(
    "scan_lexicon",
    """SELECT source AS word, max_by(n_chars, doc_id)::double AS weight FROM documents
WHERE lang NOT IN ('de', 'fr') AND doc_id % 5 <> 0 GROUP BY source""",
)
def lexicon(spark, sf):
    return scan_lexicon(spark, _lexicon_file(spark, sf))


@query("bad_lexicon_lines", """SELECT count(*) AS bad_lines FROM documents
WHERE (lang = 'fr' AND doc_id % 5 <> 0) OR (lang = 'de' AND doc_id % 5 = 0)""")
def bad_lines(spark, sf):
    return bad_lexicon_lines(spark, _lexicon_file(spark, sf))


@query("scan_word_list", "SELECT word, count(*) AS n FROM (SELECT unnest(string_split_regex(text, '\\s+')) AS word FROM conversations) GROUP BY word")
def word_list(spark, sf):
    path = scratch_path(spark, "words")
    talk = scan_parquet(spark, f"{sf}/conversations.parquet", ["text"])
    each(talk, [], F.split("text", r"\s+"), "word").write.text(path)
    return scan_word_list(spark, path).groupBy("word").agg(F.count("*").alias("n"))


@query("scan_parquet", "SELECT doc_id, source, lang FROM documents WHERE lang = 'de'")
def scan(spark, sf):
    return scan_parquet(spark, f"{sf}/documents.parquet", ["doc_id", "source", "lang"]).where(F.col("lang") == "de")


@query("filter_not_class", "SELECT doc_id, source FROM documents WHERE lang <> 'de'")
def filter_not_class(spark, sf):
    return documents(spark, sf, "source", "lang").where(F.col("lang") != "de").select("doc_id", "source")


@query("doc_count", "SELECT count(*) AS n FROM documents")
def doc_count(spark, sf):
    return documents(spark, sf, "lang").agg(F.count("*").alias("n"))


@query("write_parquet", "SELECT doc_id, lang, n_chars FROM documents")
def write(spark, sf):
    path = scratch_path(spark, "copy")
    write_parquet(documents(spark, sf, "lang", "n_chars"), path, num_files=2)
    return scan_parquet(spark, path)


@query("register_view", "SELECT source, count(*) AS n, sum(n_chars) AS chars FROM documents GROUP BY source")
def view(spark, sf):
    register_view(documents(spark, sf, "source", "n_chars"), "corpus_documents")
    return spark.sql("SELECT source, count(*) AS n, sum(n_chars) AS chars FROM corpus_documents GROUP BY source")


@query(
    "select_star_plus",
    "SELECT page_id, url, length(html) AS size, url || ' ' || length(html) AS label FROM pages",
)
def select_star_plus(spark, sf):
    pages = scan_parquet(spark, f"{sf}/pages.parquet", ["page_id", "url", "html"], spread_by="page_id")
    sized = pages.withColumn("size", F.length("html").cast("long")).drop("html")
    return sized.select("*", T.combine("url", F.col("size").cast("string")).alias("label"))


@query("join_results", "SELECT d.doc_id, d.lang, d.source, g.quality, g.toxic FROM documents d JOIN labels g USING (doc_id)")
def join(spark, sf):
    groups = scan_parquet(spark, f"{sf}/labels.parquet")
    return join_results(documents(spark, sf, "lang", "source"), groups, "doc_id", ["quality", "toxic"])


@query(
    "remove_word_filter",
    f"""WITH tokens AS ({_unnested("string_split(replace(text, 'on', '某'), ' ')")})
SELECT token, count(*) AS n FROM tokens WHERE NOT contains(token, '某') AND token NOT IN (SELECT word FROM ({STOP_WORDS_SQL}))
GROUP BY token""",
)
def remove_filter(spark, sf):
    text = F.split(F.replace("text", F.lit("on"), F.lit(C.BANNED_SUBSTRINGS[0])), " ")
    kept = remove_word_filter(_exploded(documents(spark, sf), text), stop_words(spark, sf), "token")
    return kept.groupBy("token").agg(F.count("*").alias("n"))


@query("train_test_split", "SELECT doc_id, ('0x' || left(md5(doc_id::varchar), 8))::bigint % 100 < 80 AS in_train FROM documents")
def split(spark, sf):
    train, test = train_test_split_by_key(documents(spark, sf, "lang").drop("lang"), "doc_id")
    return train.withColumn("in_train", F.lit(True)).unionByName(test.withColumn("in_train", F.lit(False)))


@query(
    "train_test_split_text",
    "SELECT 'doc-' || doc_id AS name, ('0x' || left(md5('doc-' || doc_id), 8))::bigint % 100 < 80 AS in_train FROM documents",
)
def split_text(spark, sf):
    """By a key that is no number."""
    named = documents(spark, sf, "lang").select(F.concat(F.lit("doc-"), "doc_id").alias("name"))
    train, test = train_test_split_by_key(named, "name")
    return train.withColumn("in_train", F.lit(True)).unionByName(test.withColumn("in_train", F.lit(False)))


@query(
    "distinct_counts",
    """SELECT (SELECT count(DISTINCT doc_id) FROM documents) AS ids, count(*) AS tokens, count(DISTINCT word) AS words
FROM (SELECT unnest(string_split(rtrim(text, ' '), ' ')) AS word FROM documents)""",
)
def distinct_counts(spark, sf):
    df = documents(spark, sf)
    words = each(df, [], T.split_java("text"), "word").groupBy("word").agg(F.count("*").alias("n"))
    ids = df.agg(F.countDistinct("doc_id")).scalar()
    return words.agg(ids.alias("ids"), F.sum("n").alias("tokens"), F.count("*").alias("words"))
