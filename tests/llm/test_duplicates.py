"""Near duplicates, vectors and aligned lines against brute force."""

import random

import numpy as np
import pytest

from corpusengine.llm import alignment, graph, lattice, minhash


def reach(links, ids):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {i: find(i) for i in ids}


def shingle_set(text, width):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + width]) for i in range(max(len(words) - width + 1, 1))} if words else set()


def linked(texts, width, share):
    sets = {i: shingle_set(t, width) for i, t in texts}
    return [
        (a, b)
        for a in sets
        for b in sets
        if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= share * len(sets[a] | sets[b])
    ]


def near_copies(seed, bases, copies, edits):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(500)]
    texts = []
    for _ in range(bases):
        base = [rng.choice(words) for _ in range(rng.randint(3, 120))]
        for _ in range(rng.randint(1, copies)):
            text = list(base)
            for _ in range(rng.randint(0, edits)):
                text[rng.randrange(len(text))] = rng.choice(words)
            texts.append(" ".join(text))
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("block", [256, 8])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    monkeypatch.setattr(minhash, "OUTSIDERS", block // 2)
    texts = near_copies(7, 25, 12, 5) + [(k, "alike " * 60 + f"x{k % 40}") for k in range(1000, 1060)]
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.doc_id: r for r in minhash.near_duplicates(frame, 3, 0.85).collect()}
    wanted = reach(linked(texts, 3, 85), [i for i, _ in texts])
    assert {i: r.component_id for i, r in got.items()} == wanted
    assert all(r.kept == (r.doc_id == r.component_id) and r.n_shingles == len(shingle_set(dict(texts)[i], 3)) for i, r in got.items())
    kept = minhash.without_near_duplicates(frame, 3, 0.85)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(wanted.values()))


def test_odd_documents(spark, odd, empty):
    got = sorted((r.doc_id or 99, r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(odd, 2, 0.8).collect())
    assert [r[:3] for r in got if r[0] not in (6, 7)] == [(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 4, 4), (4, 4, 4), (5, 4, 4), (8, 1, 8), (99, 4, 4)]
    assert sum(r[3] for r in got) == 7
    kept = minhash.without_near_duplicates(odd, 2, 0.8)
    assert kept.columns == odd.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 4, 6, 7, 8]
    assert minhash.near_duplicates(empty).count() == 0 and minhash.without_near_duplicates(empty).count() == 0


def test_estimates_are_corrected_for_chance():
    rng = np.random.default_rng(1)
    for similarity in (0.3, 0.85):
        shared, own = rng.integers(0, 1 << 63, 2000, np.uint64), rng.integers(0, 1 << 63, 2000, np.uint64)
        n = int(2000 * similarity)
        a, b = (np.unique(np.concatenate([shared[:n], x])) for x in (own[: (2000 - n) // 2], own[(2000 - n) // 2 : 2000 - n]))
        sketches = [minhash.packed(minhash.minima(x)) for x in (a, b)]
        assert minhash.may_reach(sketches, 0.85)[0, 1] == (similarity > 0.5)


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randint(0, 200), rng.randint(0, 200)) for _ in range(110)] + [(k, k + 1) for k in range(900, 940)]
    ids = {i for a, b in links if a != b for i in (a, b)}
    got = {r.id: r.component for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == reach(links, ids)
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def vectors(seed, groups, size):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(groups):
        center = rng.normal(size=size)
        for _ in range(rng.integers(1, 9)):
            rows.append((center + rng.normal(size=size) * rng.uniform(0, 0.35)).tolist())
    return rows


def test_vectors_equal_brute_force(spark):
    found = vectors(3, 120, 64)
    found += [found[0], found[0], [2 * x for x in found[1]], [0.0] * 64, [float("nan")] * 64, [], None, [float("inf")] + [1.0] * 63, [1.0, 2.0]]
    rows = [(k, v, "label") for k, v in enumerate(found)] + [(len(found), [None] + [1.0] * 63, "x")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, node string")
    got = {r.vec_id: r for r in lattice.near_vectors(frame).collect()}
    usable = [k for k, v in enumerate(found) if v and len(v) == 64 and np.isfinite(v).all() and any(v)]
    table = np.array([found[k] for k in usable])
    table /= np.linalg.norm(table, axis=1, keepdims=True)
    near = np.triu(table @ table.T >= 0.95, 1)
    links = [(usable[a], usable[b]) for a, b in np.argwhere(near)]
    wanted = reach(links, [r[0] for r in rows])
    degrees = np.bincount(np.array(links).ravel(), minlength=len(rows))
    right = [k for k in got if got[k].component_id == wanted[k] and got[k].n_links == degrees[k]]
    assert len(got) == len(rows) and len(right) >= 0.99 * len(rows) and len(links) > 50
    assert all(got[k].n_links == 0 and got[k].kept for k in range(len(rows)) if k not in usable)
    assert lattice.near_vectors(frame.where("1 = 0")).count() == 0


def test_lattice_points_are_nearest():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 8)) * 3
    point = lattice.nearest(x)
    doubled = np.rint(2 * point).astype(int)
    assert ((doubled % 2 == 0).all(1) | (doubled % 2 == 1).all(1)).all() and (point.sum(1) % 2 == 0).all()
    gap = ((x - point) ** 2).sum(1)
    assert (gap <= 1 + 1e-9).all()
    assert (((x[:, None] - point[:, None] - lattice.neighbours()) ** 2).sum(2).min(1) >= gap - 1e-9).all()


def test_large_component_counts_by_blocks(spark, monkeypatch):
    monkeypatch.setattr(lattice, "COUNTED", 16)
    rng = np.random.default_rng(4)
    center = rng.normal(size=64)
    rows = [(k, (center + rng.normal(size=64) * 0.12).tolist()) for k in range(150)]
    got = {r.vec_id: r.n_links for r in lattice.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    table = np.array([v for _, v in rows])
    table /= np.linalg.norm(table, axis=1, keepdims=True)
    assert got == dict(enumerate(((table @ table.T >= 0.95).sum(1) - 1).tolist()))


def passage(k, words=60):
    return " ".join(f"p{k}x{i}" for i in range(words))


def test_shared_passages_leave_the_later_document(spark):
    two = passage(1, 30) + "\n\n" + passage(2, 30)
    rows = [
        (1, f"first own line\n{passage(0)}\nlast own line"),
        (2, f"another text\n{passage(0)}"),
        (3, f"short shared line\n{two}"),
        (4, f"{two}\nshort shared line"),
        (5, passage(0).replace(" ", "  ")),
        (6, passage(3)),
    ] + [(k, f"intro {k}\n{passage(9)}\nend {k}") for k in range(100, 130)]
    got = {r.doc_id: r for r in alignment.without_overlaps(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    texts = dict(rows)
    assert all(got[k].text == texts[k] and got[k].n_removed == 0 for k in (1, 3, 6, 100))
    assert (got[2].text, got[2].sources) == ("another text", [1]) and got[4].text == "short shared line" and got[5].text == ""
    assert all(got[k].text == f"intro {k}\nend {k}" and got[k].sources == [100] for k in range(101, 130))


def test_blocks_are_found_whatever_their_lines_first_documents(spark):
    line = [f"line {k} has four more words" for k in range(10)]  # six words each, so seven lines are a block
    whole = "\n".join(line)
    rows = [(1, "\n".join(line[:5])), (2, "\n".join(line[5:])), (3, "x\n" + whole)]
    rows += [(k, f"own {k}\n{whole}\nend {k}") for k in range(4, 30)]
    rows += [(40, f"a\n{whole}\nb\n{whole}\nc")]  # twice
    one, two = ("\n".join(f"{name} {k} has four more words" for k in range(8)) for name in ("one", "two"))
    rows += [(50, f"p\n{one}\n{two}\nq"), (51, f"r\n{two}\n{one}\ns")]  # in another order
    got = {r.doc_id: r for r in alignment.without_overlaps(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    texts = dict(rows)
    assert all(got[k].text == texts[k] for k in (1, 2, 3, 50))
    assert all((got[k].text, got[k].n_removed) == (f"own {k}\nend {k}", 10) and 3 in got[k].sources for k in range(4, 30))
    assert got[40].text == "a\nb\nc" and got[51].text == "r\ns"


def test_windows_are_the_shortest_runs():
    rng = random.Random(5)
    for _ in range(300):
        rank, lines = 0, []
        for _ in range(rng.randrange(12)):
            rank += rng.choice([1, 1, 1, 2])
            lines.append({"rank": rank, "words": rng.randint(1, 9)})
        n = len(lines)
        fits = lambda i, j: sum(x["words"] for x in lines[i : j + 1]) >= 10 and lines[j]["rank"] - lines[i]["rank"] == j - i  # noqa: E731, B023
        held = {(i, j) for i in range(n) for j in range(i, n) if fits(i, j)}
        wanted = {(i, j) for i, j in held if not any((i, k) in held for k in range(i, j)) or not any((k, j) in held for k in range(i + 1, j + 1))}
        assert set(alignment.windows(lines, 10)) == wanted


def test_patience_pairs_rise_and_match():
    rng = random.Random(6)
    for _ in range(300):
        a, b = ([rng.randint(0, 12) for _ in range(rng.randint(0, 14))] for _ in "ab")
        pairs = alignment.patience(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(i < u and j < v for (i, j), (u, v) in zip(pairs, pairs[1:], strict=False))
        assert alignment.patience(a, a) == [(i, i) for i in range(len(a))]
    assert alignment.patience([1, 2, 3, 4, 5], [9, 1, 2, 8, 4, 5]) == [(0, 1), (1, 2), (3, 4), (4, 5)]


def test_lines_of_odd_documents(spark, odd, empty):
    got = alignment.without_overlaps(odd, least_words=2)
    assert got.columns == [*odd.columns, "n_lines", "n_removed", "sources"]
    rows = {(r.doc_id, r.source): r for r in got.collect()}
    assert got.count() == odd.count() and rows[(1, "a")].text is None and rows[(2, None)].text == ""
    assert rows[(4, "a")].n_removed == 0 and rows[(5, "b")].text == "" and rows[(5, "b")].sources == [4]
    assert alignment.without_overlaps(empty).count() == 0
