"""Rules, extraction, scores and the pipeline against plain versions."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corpusengine.llm import dom, ranking, rules, signals, weighting, wrapper

WORD = re.compile("[^\x20\x09-\x0D]+")


def counts(text):
    words = WORD.findall(text or "")
    seen = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {i + k for i, t in enumerate(zip(words, words[1:], words[2:], strict=False)) if seen[t] > 1 for k in range(3)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_counts_equal_plain_ones(spark, odd, sf):
    for table in (odd, spark.read.parquet(f"{sf}/documents.parquet")):
        rows = rules.with_counts(table.select("doc_id", "text")).collect()
        assert all(tuple(r[c] for c in rules.COUNTS) == counts(r.text) for r in rows) and len(rows) == table.count()


def test_decisions_on_odd_documents(spark, odd, empty):
    limits = rules.Limits(most_repeated=1)
    got = rules.decide(odd, limits)
    assert got.count() == odd.count() and {r.doc_id for r in got.where("kept").collect()} == {6}
    kept = rules.apply_rules(odd, limits)
    assert [r.doc_id for r in kept.collect()] == [6] and kept.columns == odd.columns
    assert rules.apply_rules(empty).count() == 0


def test_lines_of_many_documents_go(spark):
    body = lambda k: " ".join(f"t{k}x{i}" for i in range(60))
    rows = [(k, f"Common Line here\n{body(k)}", "h") for k in range(40)]
    rows += [(k, "common line HERE\n" * 20 + " ".join(f"u{k}x{i}" for i in range(4)), "h") for k in range(50, 60)]
    rows += [(k, f"Common line here\n{body(7)}", "other") for k in range(200, 260)]  # copies of one text: one document
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    limits = rules.Limits(least_words=3, most_repeated=2, line_documents=20, line_share=0.1)
    kept = {r.doc_id: r.text for r in rules.apply_rules(frame, limits).collect()}
    assert all(kept[k] == body(k) for k in range(40)) and not any(k in kept for k in range(50, 60))
    assert all(kept[k] == f"Common line here\n{body(7)}" for k in range(200, 260))


def test_lines_are_counted_by_documents_that_differ_at_all(spark):
    shared = "\n".join(" ".join(f"s{k}x{i}" for i in range(30)) for k in range(10))
    body = lambda k: " ".join(f"t{k}x{i}" for i in range(30))
    rows = [(k, f"{shared}\n{body(k)}", "h") for k in range(200)]
    rows += [(1000 + k, " ".join(f"u{k}x{i}" for i in range(60)) + "\nA line of some" * (k < 51), "large") for k in range(26_000)]
    rows += [(50_000 + k, f"{shared}\n{body(7)}".replace(" ", " " * (k % 3 + 1)), "copies") for k in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r.doc_id: r.text for r in rules.apply_rules(frame).collect()}
    assert not any(k in kept for k in range(200))
    assert all("A line of some" not in kept[1000 + k] for k in range(51)) and all(50_000 + k in kept for k in range(60))


PAGE = '<html><body><div class="top">Menu A B</div><div><div id="x12">{}</div></div><div class="bot">All rights</div></body></html>'


def test_constant_parts_of_a_host_are_left_out(spark):
    rows = [(k, f"http://h.com/{k}", PAGE.format(f"<p>Body {k} &amp; more<p>of  it")) for k in range(6)]
    rows += [(9, None, None), (10, "x", ""), (11, "http://one/", "plain < text"), (11, "http://one/", "plain < text")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit(1)).withColumn("text", F.lit(2))
    got = wrapper.extract(frame).collect()
    found = {r.page_id: r.text for r in got}
    assert len(got) == len(rows) and all(found[k] == f"Body {k} & more\nof it" for k in range(6))
    assert (found[9], found[10], found[11]) == ("", "", "plain < text") and all(r.n_chars == len(r.text) for r in got)
    assert wrapper.extract(frame.where("1 = 0")).count() == 0


def texts_of(page):
    return [text for text, _ in dom.blocks(dom.parse(page))]


def test_titles_as_ids_and_open_quotes_lose_nothing():
    page = """<article><h2 id="related-work">Related work</h2><p>Body 0</p><section id="navigation-systems"><p>Stars</p></section>
<div id="related-posts"><p>More</p></div><h3 class="share">Sharing</h3><div class="share-bar">Tell</div></article>"""
    assert texts_of(page) == ["Related work", "Body 0", "Stars", "Sharing"]
    assert texts_of('<p>hello <a href="x>link</a> world</p>') == ["hello link world"]
    assert texts_of("<p>one <a title='>two</a> three</p>") == ["one two three"]
    # As in a browser, a quote that ends later holds everything before its end.
    assert texts_of('<p>a <b class="x>lost">c</b></p>') == ["a c"]
    assert texts_of("<p>" + '<a "' * 2000)[0].startswith("<a")


def shop(layout, k, article, note):
    head = "<div><span>Best shop of the town</span></div>" if layout else "<table><tr><td>Our old paper</td></tr></table><div><div>since 1900</div></div>"
    body = "".join(f"<p>{sentence}</p>" for sentence in article.split("|"))
    return f"<html><body>{head}<section><div>{body}</div></section><div><em>{note}</em></div><div><p>All rights and wrongs</p></div></body></html>"


@pytest.mark.parametrize("variants", [40, 4])
def test_an_article_with_many_variants_is_no_template(spark, variants):
    one = "The same article|that many pages hold, with other notes."
    rows = [(k, f"http://h.org/{k}", shop(1, k, one, f"note {k}")) for k in range(variants)]
    rows += [(100 + k, f"http://h.org/{k}", shop(1, k, f"Article {k}|of its own, number {k}.", f"note {100 + k}")) for k in range(20)]
    got = {r.page_id: r.text.split("\n") for r in wrapper.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for k in range(variants):
        assert got[k] == [*one.split("|"), f"note {k}"]
    for k in range(20):
        assert got[100 + k] == [f"Article {k}", f"of its own, number {k}.", f"note {100 + k}"]


def test_each_layout_of_a_host_has_its_template(spark):
    rows = [(k, f"http://h.org/{k}", shop(k % 2, k, f"Text {k}|and more {k}", f"n {k}")) for k in range(24)]
    # Copies of an error page, and empty pages, outnumber the rest and decide nothing.
    rows += [(100 + k, "http://h.org/e", "<html><body><b>Not found</b></body></html>") for k in range(60)] + [(200, "http://h.org/", None), (201, "http://h.org/", "")]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in wrapper.extract(table).collect()}
    for k in range(24):
        assert got[k] == f"Text {k}\nand more {k}\nn {k}"
    assert {got[100 + k] for k in range(60)} == {"Not found"} and got[200] == got[201] == ""
    _, templates = wrapper.induce(table)
    assert len({slot >> wrapper.LAYOUT_BITS for slot in templates.first().template}) == 2



def blocks(page):
    return [text for text, _ in dom.blocks(dom.parse(page))]


def test_articles_without_what_surrounds_them():
    page = """<title>t</title><header>Site</header><nav><ul><li>a<li>b</ul></nav><article><header><h1>Title&nbsp;</h1></header>
    <script>var x = "</p>";</script><p>One <b>two</b><br>three<p>Four<aside>side</aside><form><input>f</form>
    <div class="user-comments"><p>c</div><table><tr><td>x<td>y</table></article><div class="ad">buy</div><footer>&copy;"""
    assert blocks(page) == ["Title", "One two three", "Four", "x", "y"]
    assert blocks("a<div>b<!-- c --></div>d") == ["a", "b", "d"] and blocks("<p>a <i>b</p><ul><li>c<li>d") == ["a b", "c", "d"]
    assert blocks("<div>" * 3000 + "deep") == ["deep"] and blocks("<script>never closed") == []


def test_alignment_matches_like_parts():
    ours, theirs = (dom.layout([dom.parse(p)]) for p in ("<div class=a><p>x</div><div class=b>y</div>", "<div class=c>q</div><div class=b>z</div>"))
    theirs = dom.from_skeleton(dom.skeleton(theirs))
    assert [a.label for a, _ in dom.align(ours, theirs)] == ["#root", "div.b", "#text"]


def tree_of(texts, depth, kept=10**9):
    grams = Counter()
    for text in texts:
        grams.update(weighting.runs(text, depth).tolist())
    levels = []
    for d in range(depth + 1):
        level = Counter()
        for key, n in grams.items():
            level[(key >> 8) & ((1 << 8 * d) - 1), key % 256] += n
        totals = Counter()
        for (context, _), n in level.items():
            totals[context] += n
        most = {c for c, _ in totals.most_common(kept)}
        rows = [(c, b, n) for (c, b), n in level.items() if c in most]
        levels.append(tuple(np.array(x) for x in zip(*rows, strict=True)))
    return weighting.build(levels)


def plain_score(texts, depth, data):
    """Context-tree weighting by its recursion, one bit of one byte after the other."""
    tables = {}
    for text in texts:
        padded = b"\n" * depth + text
        for i in range(depth, len(padded)):
            for d in range(depth + 1):
                bits = f"{padded[i]:08b}"
                for k in range(8):
                    tables.setdefault((padded[i - d : i], bits[:k]), [0, 0])[int(bits[k])] += 1

    def kt(zeros, ones):
        return math.lgamma(zeros + 0.5) + math.lgamma(ones + 0.5) - math.lgamma(zeros + ones + 1) - math.log(math.pi)

    children = {}
    for context, bits in tables:
        if context:
            children.setdefault((context[1:], bits), []).append(context)

    def weighted(context, bits):
        own = kt(*tables.get((context, bits), (0, 0)))
        if len(context) == depth:
            return own
        split = sum(weighted(c, bits) for c in children.get((context, bits), []))
        return math.log(0.5) + np.logaddexp(own, split)

    total = 0.0
    padded = b"\n" * depth + data
    for i in range(depth, len(padded)):
        bits = f"{padded[i]:08b}"
        for k in range(8):
            chance, left = 0.0, 1.0
            for d in range(depth + 1):
                context = padded[i - d : i]
                counts = tables.get((context, bits[:k]), [0, 0])
                w = 1.0 if d == depth else math.exp(math.log(0.5) + kt(*counts) - weighted(context, bits[:k]))
                chance += left * w * (counts[int(bits[k])] + 0.5) / (sum(counts) + 1)
                left *= 1 - w
            total += math.log10(chance)
    return total


def test_tree_equals_the_recursion_and_sums_to_one():
    texts = [b"the cat sat on the mat\n", b"the hat\n", b"a cat at a mat\n"]
    tree = tree_of(texts, 2)
    for data in (b"the cat\n", b"mat hat\n"):
        assert abs(tree.score(data) - plain_score(texts, 2, data)) < 1e-3
    for small in (tree, tree_of(texts, 3, kept=5)):
        for table in small.logs:
            unseen = 256 - (table.shape[1] - 1)
            assert np.allclose((10.0 ** table[:, :-1]).sum(1) + unseen * 10.0 ** table[:, -1], 1, atol=1e-4)
    assert abs(weighting.build([(np.array([]),) * 3]).score(b"ab") - 16 * math.log10(0.5)) < 1e-6


def test_word_scores_equal_plain_ones(spark, odd, empty, sf, monkeypatch):
    monkeypatch.setattr(weighting, "SHARED_WORDS", 50)
    table = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    got = weighting.scored(table.withColumn("held", weighting.held_out()), ~F.col("held"), depth=2).collect()
    train = Counter()
    for r in table.collect():
        if r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 7 != 2:
            train.update(weighting.tokens(r.text or ""))
    n, v = sum(train.values()), len(train)
    wanted = Counter()
    for r in table.collect():
        found = weighting.tokens(r.text or "")
        base = sum(math.log10((train[t] + 1) / (n + v + 1)) for t in found)
        wanted[r.doc_id, len(found), sum(train[t] > 0 for t in found), n, round(base, 4)] += 1
    assert Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == wanted
    assert all(r.score < 0 for r in got)
    assert weighting.scored(empty.select("doc_id", "text"), F.lit(True), depth=2).count() == 0
    alone = weighting.scored(odd.where("doc_id = 8").select("doc_id", "text"), F.lit(False), depth=2).first()
    assert (alone.n_known, alone.base_score) == (0, 0.0) and abs(alone.score - 16 * math.log10(0.5)) < 1e-4


def test_scores_use_every_context(spark, monkeypatch):
    """More contexts of three bytes than were kept once, some runs shared with all tasks, the others joined."""
    monkeypatch.setattr(weighting, "SHARED_RUNS", 500)
    monkeypatch.setattr(weighting, "ROWS", 1000)
    draw = np.random.default_rng(3)
    texts = ["".join(chr(x) for x in draw.integers(48, 91, 300)) for _ in range(75)]
    texts = texts * 4 + ["the cat sat", "the cat", "żółw", ""]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spelt = [weighting.spelled(weighting.tokens(text)) for text in texts]
    got = {r.doc_id: r.score for r in weighting.scored(frame, F.col("doc_id") < 250, depth=3).collect()}
    tree, capped = tree_of(spelt[:250], 3), tree_of(spelt[:250], 3, kept=16_384)
    assert tree.logs[3].shape[0] > 16_384
    assert max(capped.score(text) / tree.score(text) for text in spelt[:300]) > 1.1
    assert all(abs(got[i] - tree.score(text)) < 0.002 * len(text) for i, text in enumerate(spelt[:300]))
    small = frame.where("doc_id >= 300")
    got = {r.doc_id: r.score for r in weighting.scored(small, F.col("doc_id") < 301, depth=5).collect()}
    assert all(abs(got[i] - plain_score(spelt[300:301], 5, spelt[i])) < 1e-6 for i in got) and len(got) == 4


def test_texts_are_looked_up_together(monkeypatch):
    """Sums, counts and rest of each text are those of a dictionary, for small keys and large ones, in several parts."""
    monkeypatch.setattr(weighting, "CHUNK", 64)
    rng = np.random.default_rng(2)
    for low, high in ((0, 90), (0, 1 << 56), (-(1 << 62), 1 << 62)):
        known = np.unique(rng.integers(low, high, 60))
        values = rng.normal(size=len(known))
        own = dict(zip(known.tolist(), values.tolist()))
        texts = [np.concatenate([rng.choice(known, n), rng.integers(low, high, n)]) for n in (0, 3, 50, 0, 40)]
        for table, chances in (((known, values), own), ((known[:0], values[:0]), {})):
            counts, sums, rest = weighting.look_up(table, texts)
            for k, text in enumerate(text.tolist() for text in texts):
                assert counts[k] == sum(x in chances for x in text) and abs(sums[k] - sum(chances.get(x, 0) for x in text)) < 1e-9
                assert sorted(rest[k].as_py()) == sorted(x for x in text if x not in chances)


def test_a_task_adds_up_its_own_counts(spark, monkeypatch):
    """Many batches give each run once per task, of all texts together, and rows are not added up again before they are dealt."""
    monkeypatch.setattr(weighting, "CHUNK", 4000)
    texts = ["the cat sat on the mat " * 40] * 1200
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    counts = weighting.count_corpus(docs.withColumn("_train", F.col("doc_id") % 7 != 2), 2)
    plan = counts._jdf.queryExecution().sparkPlan().toString()
    before, dealt = plan.split("RepartitionBy" if "RepartitionBy" in plan else "Exchange", 1)
    assert "HashAggregate" in before and "Aggregate" not in dealt
    rows = counts.where(F.col("kind") == weighting.RUN).collect()
    wanted, learned = Counter(), Counter()
    for k, text in enumerate(texts):
        found = Counter(weighting.paths(weighting.spelled(weighting.tokens(text)), 2).tolist()) if k == 0 else found
        wanted.update(found)
        if k % 7 != 2:
            learned.update(found)
    assert {r.key: (r.n, r.times) for r in rows} == {key: (learned[key], wanted[key]) for key in wanted}


def test_held_out_documents_are_judged_well(spark, sf):
    path = sf.replace("sf0.001", "sf0.01")
    docs, labels = (spark.read.parquet(f"{path}/{t}.parquet") for t in ("documents", "labels"))
    rows = ranking.scored(docs.select("doc_id", "text"), labels).join(labels, "doc_id").where(ranking.held_out())
    right = rows.where((F.col("score") >= 0.5).cast("int") == F.col("quality")).count()
    assert right >= 0.97 * rows.count() and rows.count() > 50


def test_all_labelled_rows_are_learned_from(spark):
    """every labelled row is in as many pairs as others of its class, and the threshold is that of all rows."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(900, len(signals.NAMES)))
    said = (x[:, 0] + x[:, 1] + 0.3 * rng.normal(size=900) > 0.8).astype(int).tolist()
    rows = spark.createDataFrame([(i, row) for i, row in enumerate(x.tolist())], "doc_id long, __signals array<double>").repartition(5)
    labels = spark.createDataFrame(list(enumerate(said)), "doc_id long, quality int")
    known = ranking.labelled(rows, labels, "quality", "doc_id")
    assert known.count() == 900
    counts = {value: said.count(value) for value in (0, 1)}
    place = known.withColumn("__signals", F.array(F.col("doc_id").cast("double") * (1 - 2 * F.col("quality")), F.lit(1.0)))
    most, least = max(counts.values()), min(counts.values())
    per_row = min(least, -(-ranking.PAIRS // most))
    gaps = [row.gap[0] for row in ranking.pairs(place, "quality", "doc_id", counts).collect()]
    assert len(gaps) == most * per_row and len(known.where("quality = 0").collect()) == most
    # A gap is -(good + bad). Partners are dealt in turn, so a row is in as many pairs as any other of its class, or one more.
    good = {i: 0 for i in range(900) if said[i]}
    numbers = ranking.numbered(known.where("quality = 1").select("doc_id", "__signals"), F.xxhash64("doc_id"))
    by_number = {row["__number"]: row.doc_id for row in numbers.collect()}
    for k in range(most * per_row):
        good[by_number[k % least]] += 1
    assert max(good.values()) - min(good.values()) <= 1 and min(good.values()) >= 1
    bad = sum(i for i in range(900) if not said[i])
    assert -sum(gaps) == bad * per_row + sum(i * n for i, n in good.items())
    ranked = ranking.numbered(known.select("doc_id"), F.xxhash64("doc_id"))
    assert sorted(row["__number"] for row in ranked.collect()) == list(range(900))
    found = ranking.fit(rows, labels)
    own = x @ np.array(found.weights) - found.threshold
    assert (own < 0).sum() == counts[0]
    assert ((own > 0) == np.array(said, dtype=bool)).mean() > 0.9


def test_labels_sent_or_joined_are_learned_from_alike(spark, sf, monkeypatch):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    sent = ranking.fit(docs, labels)
    monkeypatch.setattr(ranking, "SHARED_LABELS", 0)
    joined = ranking.fit(docs, labels)
    assert np.allclose(sent.weights, joined.weights, rtol=1e-6, atol=1e-9) and abs(sent.threshold - joined.threshold) < 1e-6


def test_scores_of_odd_documents(spark, odd, empty, sf):
    labels = spark.createDataFrame([(1, 0), (4, 1), (6, 1), (None, 1), (3, None)], "doc_id long, quality int")
    got = ranking.scored(odd, labels)
    assert got.columns == [c for c in odd.columns if c not in ("text", "score")] + ["score"] or got.count() == odd.count()
    assert ranking.passing(odd, labels).columns == odd.columns
    assert ranking.passing(empty, labels).count() == 0 and ranking.passing(odd, labels.where("1 = 0")).count() == odd.count()
    assert signals.signals("") == [0.0] * len(signals.NAMES) and len(signals.signals(" ")) == len(signals.NAMES)


def test_pipeline_stages_follow_each_other(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before = {r.doc_id: r for r in docs.collect()}
    for name, step in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stage(step(spark, docs, sf), name)
        now = {r.doc_id: r for r in docs.collect()}
        assert list(docs.columns) == ["doc_id", "text", "lang", "source", "n_chars"] and set(now) <= set(before) and now
        assert all(r.n_chars == len(r.text) for r in now.values())
        if name in ("quality_classifier", "near_duplicates"):
            assert all(r.text == before[i].text for i, r in now.items())
        before = now
    whole = corpus_pipeline.run(spark, sf)
    assert {r.doc_id for r in whole.collect()} == set(before)


def test_pipeline_on_odd_documents(spark, odd, empty, sf):
    for table in (odd, empty):
        docs = table
        for name, step in corpus_pipeline.STAGES:
            docs = corpus_pipeline.stage(step(spark, docs, sf), name)
        assert docs.count() >= 0
