"""Near-duplicates, repeated passages and embeddings against brute force, and their edge cases."""

import random
import re

import numpy as np
import pytest

from orgweave.llm.embeddings import Rotation, near_vectors
from orgweave.llm.minhash import Near, near_duplicates, odd_sketch
from orgweave.llm.substring import Spans, cut, remove_repeats

DOC = "doc_id long, text string, bands string, id string"


def shingles(text, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def brute_components(rows, n, percent):
    sets = {i: shingles(t, n) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                k = len(sets[a] & sets[b])
                if 100 * k >= percent * (len(sets[a]) + len(sets[b]) - k):
                    x, y = find(a), find(b)
                    parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def variants(seed, copies, words, most):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(500)]
    base = [rng.choice(vocabulary) for _ in range(words)]
    out = []
    for _ in range(copies):
        t = list(base)
        for _ in range(rng.randint(0, most)):
            t[rng.randrange(words)] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(t))
    return out


@pytest.mark.parametrize(("n", "percent"), [(3, 85), (5, 80)])
def test_components_equal_brute_force(spark, n, percent):
    # a crowd of copies of which many are just too far from one another, copies of copies, and short texts
    texts = variants(1, 120, 60, 8) + variants(2, 40, 30, 3) + ["a b c d e f"] * 5 + ["A  B c\td e f"] + ["one two", "One  two", "one", "", " \n", None]
    rows = list(enumerate(texts))
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], DOC)
    got = {r["doc_id"]: r for r in near_duplicates(df, Near(shingle=n, percent=percent)).collect()}
    want = brute_components(rows, n, percent)
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == want
    assert all(r["kept"] == (i == r["component_id"]) for i, r in got.items())


def test_near_edge_cases(spark):
    assert near_duplicates(spark.createDataFrame([], DOC)).count() == 0
    rows = [(None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (2, None), (1, "word " * 30000), (3, "x y z u v w"), (8, "x y z u v w"), (None, "l m n o p"), (None, "l m n o p"), (None, None)]
    out = near_duplicates(spark.createDataFrame([(i, t, "", "") for i, t in rows], DOC)).collect()
    assert sorted((r["doc_id"], r["component_id"], r["kept"]) for r in out if r["doc_id"]) == [(1, 1, True), (2, 2, True), (3, 3, True), (3, 3, True), (3, 3, True), (8, 3, False)]
    assert sorted((r["component_id"] or 0, r["kept"]) for r in out if r["doc_id"] is None) == [(0, False), (0, True), (0, True), (3, False)]


def test_odd_sketch_counts_differences():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 1 << 63, 125, dtype=np.uint64)
    b = a.copy()
    b[:3] += np.uint64(1)
    bits = sum(int(x).bit_count() for x in (odd_sketch(a) ^ odd_sketch(b)).view(np.uint64).tolist())
    assert bits in (2, 4, 6) and not (odd_sketch(a) ^ odd_sketch(a)).any()


def sentences(rng, n):
    return [" ".join(f"v{rng.randrange(3000)}" for _ in range(rng.randint(5, 14))).capitalize() + "." for _ in range(n)]


def test_repeated_passages_go_once(spark):
    rng = random.Random(3)
    passage = sentences(rng, 9)
    texts = []
    for k in range(6):
        own = sentences(rng, 10)
        texts.append(" ".join(own[:5] + (passage if k in (1, 3, 4) else []) + own[5:]))
    texts += [texts[0], None, "", "x", "word " * 5000]
    df = spark.createDataFrame([(i, t, "", "") for i, t in enumerate(texts)], DOC).withColumnRenamed("bands", "n_removed")
    out = {r["doc_id"]: r for r in remove_repeats(df, Spans()).collect()}
    inside = " ".join(passage)
    assert inside in out[1]["text"] and out[1]["text"] == texts[1]
    for k in (3, 4):
        assert out[k]["n_removed"] > 0
        left = out[k]["text"].split()
        assert len(set(left) & set(inside.split()[15:-15])) < 30 and len(texts[k].split()) - len(left) == out[k]["words_removed"]
    for k in (0, 2, 5, 7, 8, 9):
        assert out[k]["text"] == texts[k] and out[k]["n_removed"] == 0
    assert out[6]["text"] == "" and out[6]["n_removed"] == out[6]["n_sentences"]
    assert remove_repeats(spark.createDataFrame([], DOC)).count() == 0
    twins = spark.createDataFrame([(1, texts[1], "", ""), (1, texts[1], "", ""), (None, texts[1], "", "")], DOC)
    assert sorted((r["doc_id"] or 0, r["text"] == texts[1]) for r in remove_repeats(twins).collect()) == [(0, False), (1, True), (1, True)]


def test_copies_with_short_last_sentences_become_empty(spark):
    rng = random.Random(8)
    body = [" ".join(sentences(rng, n)) for n in (4, 5, 7, 12)]
    texts = [f"{t} {tail}" for t, tail in zip(body, ("Very short end.", "End.", "So be it. Yes. No.", "A b. C."), strict=True)]
    own = [" ".join(sentences(rng, 4)) for _ in texts]
    rows = list(enumerate(texts + texts + [f"{a} {t} {b}" for a, t, b in zip(own, texts, own[::-1], strict=True)]))
    out = {r["doc_id"]: r for r in remove_repeats(spark.createDataFrame([(i, t, "", "") for i, t in rows], DOC)).collect()}
    for k in range(4):
        assert out[k]["text"] == texts[k]
        assert out[4 + k]["text"] == "" and out[4 + k]["n_removed"] == out[4 + k]["n_sentences"]
        assert not texts[k].split()[-1] in out[8 + k]["text"].split()


def test_passages_of_51_words_hold_a_span_wherever_they_stand():
    rng = random.Random(9)
    for k in range(3000):
        stop = rng.choice((0, 0.03, 0.1, 0.3))
        some = lambda n, v: [f"{v}{rng.randrange(20000)}" + "." * (rng.random() < stop) for _ in range(n)]  # noqa: E731, B023
        passage = some(51, "v")
        texts = [" ".join([*some(rng.randint(0, 40), "u"), *passage, *some(rng.randint(0, 40), "u")]) for _ in range(2)]
        one, two = (set(c.hash.tolist()) for c in cut([t.encode() for t in texts], Spans()))
        assert one & two


def test_only_long_sentences_are_cut():
    rng = random.Random(2)
    sizes = [rng.randint(1, 16) for _ in range(400)] + [40]
    text = " ".join(" ".join(f"v{rng.randrange(9000)}" for _ in range(n)) + "." for n in sizes)
    bound = next(iter(cut([text.encode()], Spans()))).words
    ends = np.cumsum([0, *sizes])
    assert bound[: len(sizes)].tolist() == ends[:-1].tolist() and len(bound) > len(ends)


def brute_removed(texts, p):
    """Words left of each text when every run of sentences, not only the shortest, is looked up."""
    bounds = [next(iter(cut([t.encode()], p))).words.tolist() for t in texts]
    words = [t.lower().split() for t in texts]
    seen, left = {}, []
    places = []
    for d, b in enumerate(bounds):
        runs = [(i, j) for i in range(len(b) - 1) for j in range(i + p.sentences, len(b)) if b[j] - b[i] >= p.words]
        places += [(d, i, j) for i, j in runs or [(0, len(b) - 1)] if b[-1]]
    for d, i, j in places:
        key = tuple(words[d][bounds[d][i] : bounds[d][j]])
        seen[key] = min(seen.get(key, (d, i)), (d, i))
    gone = [set() for _ in texts]
    for d, i, j in places:
        if seen[tuple(words[d][bounds[d][i] : bounds[d][j]])] != (d, i):
            gone[d].update(range(bounds[d][i], bounds[d][j]))
    for d, w in enumerate(words):
        left.append([x for k, x in enumerate(w) if k not in gone[d]])
    return left


def test_removal_equals_brute_force_over_all_runs(spark):
    rng = random.Random(21)
    lines = [" ".join(f"w{rng.randrange(800)}" for _ in range(rng.choice((1, 3, 6, 9, 14, 30)))) + rng.choice((".", "!", "", "\n")) for _ in range(60)]
    texts = [" ".join(rng.choice(lines) for _ in range(rng.randint(1, 14))) for _ in range(150)]
    texts += ["one two three"] * 3 + ["One short line of a whole text, eighteen words long, that stands three times and is one sentence here"] * 3
    p = Spans()
    out = {r["doc_id"]: r for r in remove_repeats(spark.createDataFrame([(i, t, "", "") for i, t in enumerate(texts)], DOC), p).collect()}
    want = brute_removed(texts, p)
    assert [out[i]["text"].lower().split() for i in range(len(texts))] == want
    assert out[len(texts) - 1]["text"] == out[len(texts) - 4]["text"] == "" and any(0 < len(w) < len(t.split()) for w, t in zip(want, texts, strict=True))


def test_columns_of_names_used_inside_and_hot_spans(spark):
    rng = random.Random(22)
    hot = " ".join(sentences(rng, 3))
    rows = [(k, " ".join([*sentences(rng, 3), hot, *sentences(rng, 2)])) for k in range(300)]
    clash = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", *(f"doc_id AS {c}" for c in ("_text", "_spans", "_id", "_th", "_kept_text", "_id0", "id", "th", "spans", "h", "a", "salt", "hot")))
    out = remove_repeats(clash).collect()
    assert len(out) == 300 and sum(hot in r["text"] for r in out) == 1 and all(r["_text"] == r["spans"] == r["doc_id"] for r in out)


def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = []
    for label in (0, 1):
        base = rng.standard_normal(16)
        for _ in range(60):
            rows.append((len(rows), (base + rng.standard_normal(16) * 0.12).tolist(), label))
        for _ in range(30):
            rows.append((len(rows), rng.standard_normal(16).tolist(), label))
    rows += [(len(rows) + k, rows[0][1], 0) for k in range(5)]
    odd = [(900, None, 0), (901, [0.0] * 16, 0), (902, [float("nan")] * 16, 0), (903, [1.0, None], 0), (904, rows[0][1], None), (905, [], 0), (None, rows[0][1], 0)]
    schema = "vec_id long, embedding array<double>, label int"
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows])
    link = (x @ x.T >= 0.98) & (label[:, None] == label[None, :])
    np.fill_diagonal(link, False)
    comp = np.arange(len(rows))
    for _ in range(len(rows)):
        comp = np.minimum(comp, np.where(link, comp[None, :], len(rows)).min(axis=1))
    got = {r["vec_id"]: r for r in near_vectors(spark.createDataFrame(rows + odd, schema), Rotation(block=16)).collect()}
    assert [(got[i]["n_links"], got[i]["component_id"]) for i in range(len(rows))] == list(zip(link.sum(axis=1).tolist(), comp.tolist(), strict=True))
    assert all(got[i]["n_links"] == 0 and got[i]["kept"] for i in (900, 901, 902, 903, 904, 905, None))
    assert near_vectors(spark.createDataFrame([], schema)).count() == 0


def test_rows_that_repeat_an_id_are_vectors_of_their_own(spark):
    rng = np.random.default_rng(11)
    one, two = rng.standard_normal(16), rng.standard_normal(16)
    close = lambda x: (x + rng.standard_normal(16) * 0.005).tolist()
    rows = [(1, close(one), 0), (1, close(two), 0), (1, close(two), 1)]
    rows += [(k, close(one), 0) for k in (4, 5, 6)] + [(k, close(two), 0) for k in (2, 7, 8, 9, 10)]
    rows += [rows[4], rows[4]]
    out = near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    got = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in out)
    assert got == sorted([(1, 5, 1), (1, 5, 1), (1, 0, 1), (4, 5, 1), (5, 5, 1), (5, 5, 1), (5, 5, 1), (6, 5, 1)] + [(k, 5, 1) for k in (2, 7, 8, 9, 10)])
