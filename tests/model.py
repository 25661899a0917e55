"""Slow, plain restatements of the rules, used to check the Spark plans on small inputs."""

import math
from collections import Counter


def rank_words(words, window, d=0.85, max_rounds=200, min_diff=1e-4):
    links = {w: set() for w in words}
    if len(words) >= window:
        for i, left in enumerate(words):
            for right in words[i + 1 : i + window]:
                if left != right:
                    links[left].add(right)
                    links[right].add(left)
    score = {w: 1 / len(links) for w in links}
    for _ in range(max_rounds):
        new = {w: (1 - d) + d * sum(score[u] / len(links[u]) for u in sorted(links[w])) for w in links}
        moved = max((abs(new[w] - score[w]) for w in links), default=0)
        score = new
        if moved <= min_diff:
            break
    return {w: round(s, 9) for w, s in score.items()}


def parse(text):
    parts = [p.split("/") for p in text.split(" ")]
    return [(p[0], p[1]) for p in parts if len(p) > 1 and any(x != "" for x in p[1:])]


def keywords(title, content, stop, n=7, window=3, excluded="dftmbceopquyzrw"):
    words = parse(title) + parse(content)
    kept = [w for w, t in words if t[0] not in excluded and len(w.strip()) > 1 and w not in stop]
    ranked = sorted(rank_words(kept, window).items(), key=lambda e: (-e[1], e[0]))[: max(20, n)]
    in_title = {w for w, _ in parse(title)}
    boosted = sorted(((w, s * 2 if w in in_title else s) for w, s in ranked), key=lambda e: (-e[1], e[0]))
    chosen = []
    for w, s in boosted:
        if len(chosen) < n and not any(w in c or c in w for c, _ in chosen):
            chosen.append((w, s))
    text = [w for w, _ in words]
    for left, right in zip(text, text[1:]):
        now = dict(chosen)
        if left in now and right in now and left.lower() != right.lower():
            chosen = [e for e in chosen if e[0] not in (left, right)] + [(left + right, max(now[left], now[right]))]
    return " ".join(w for w, _ in sorted(chosen, key=lambda e: (-e[1], e[0])))


def similarities(sentences):
    n = len(sentences)
    mean = sum(map(len, sentences)) / n
    tf = [Counter(s) for s in sentences]
    df = Counter(t for counts in tf for t in counts)
    idf = {t: math.log(n - f + 0.5) - math.log(f + 0.5) for t, f in df.items()}

    def sim(i, j):
        total = 0.0
        for t in sentences[i]:
            wf = tf[j].get(t)
            if wf:
                total += idf[t] * wf * 2.5 / (wf + 1.5 * (0.25 + 0.75 * len(sentences[j]) / mean))
        return total

    return [[sim(i, j) for j in range(n)] for i in range(n)]


def rank_sentences(sims, d=0.85, max_rounds=200, min_diff=1e-4):
    n = len(sims)
    out = [sum(row[j] for j in range(n) if j != i) for i, row in enumerate(sims)]
    score = [1.0] * n
    for _ in range(max_rounds):
        new = [
            (1 - d) + sum(d * sims[j][i] / out[j] * score[j] for j in range(n) if j != i and out[j] != 0)
            for i in range(n)
        ]
        moved = max(abs(a - b) for a, b in zip(new, score))
        score = new
        if moved <= min_diff:
            break
    return [round(s, 9) for s in score]


def pick(sims, weights, size, threshold=10):
    size = min(size, len(weights))
    taken = []
    for i in sorted(range(len(weights)), key=lambda i: (-weights[i], -i)):
        if any(sims[i][p] >= threshold for p in taken):
            continue
        taken.append(i)
        if len(taken) >= size - 1:
            break
    return taken


def budget(lengths, weights, limit):
    used, kept = 0, []
    for i in sorted(range(len(lengths)), key=lambda i: (-weights[i], i)):
        if used + lengths[i] <= limit:
            used += lengths[i]
            kept.append(i)
    return sorted(kept)


def summary(cleaned, sentences, tokens, limit=200, cue="综上所述", max_rounds=200):
    if not sentences:
        return cleaned
    sims = similarities(tokens)
    scores = rank_sentences(sims, max_rounds=max_rounds)
    last = len(sentences) - 1
    weights = [
        round(s * (2 if cue in text else 0.9 if i == last else 1), 9) for i, (s, text) in enumerate(zip(scores, sentences))
    ]
    picks = pick(sims, weights, limit // (len(cleaned) // len(sentences)))
    if len(picks) == 1:
        return sentences[picks[0]] + "。"
    ordered = sorted(picks, key=lambda i: (sentences.index(sentences[i]), sentences[i], weights[i]))
    kept = budget([len(sentences[i]) for i in ordered], [weights[i] for i in ordered], limit)
    return "。".join(sentences[ordered[i]] for i in kept) if kept else sentences[picks[0]] + "。"


def clause_score(words, lexicon, adverbs, negations):
    total, last = 0.0, 0
    for j, word in enumerate(words):
        if word not in lexicon:
            continue
        between = range(last + 1, j)
        negs = [k for k in between if words[k] in negations]
        advs = [k for k in between if words[k] in adverbs]
        weight = (-1.0) ** len(negs)
        for k in advs:
            weight *= adverbs[words[k]]
        if negs and advs:
            weight *= 2 if max(negs) < max(advs) else 0.5
        total += weight * lexicon[word]
        last = j
    return total
