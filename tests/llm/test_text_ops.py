"""Language ID, licenses, BPE, search, language model, mixing and extraction, and the pipeline."""

import base64
import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from orgweave.llm import bpe, langid, licenses, lm, mixing, search, webtext

DOC = "doc_id long, text string, lang string, source string, score double, n_chars long"


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, 0.0, 0) for i, t, lang, s in rows], DOC)


def prose(rng, letters, n):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 8))) for _ in range(n))


@pytest.fixture(scope="module")
def two_languages():
    rng = random.Random(0)
    rows = [(k, prose(rng, "abcdeeé" if k % 2 else "stuvwxy", 30), "aa" if k % 2 else "ss", "src") for k in range(120)]
    return rows + [(900, None, "aa", "src"), (901, "", None, None), (902, "12 34 !!", "aa", None), (None, "abc abde", "aa", "src"), (903, "abcd " * 40000, None, "src")]


def test_language_id(spark, two_languages):
    out = {r["doc_id"]: r for r in langid.identify(table(spark, two_languages)).collect()}
    for i, _, lang, _ in two_languages[:120]:
        assert out[i]["lang_pred"] == lang and 0 < out[i]["score"] <= 1
        assert out[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
    assert [out[i]["lang_pred"] for i in (900, 901, 902)] == ["und"] * 3 and out[903]["lang_pred"] == "aa"
    clash = langid.identify(table(spark, two_languages).selectExpr("*", "doc_id AS _text", "doc_id AS text0")).collect()
    assert all(r["_text"] == r["text0"] == r["doc_id"] and r["lang_pred"] == out[r["doc_id"]]["lang_pred"] for r in clash)
    empty = langid.identify(table(spark, []).select("doc_id", "text", "lang"))
    assert empty.count() == 0 and "lang_pred" in empty.columns
    assert [r["lang_pred"] for r in langid.identify(table(spark, [(1, "abc", None, None)])).collect()] == ["und"]


def test_out_of_place_distance_by_hand():
    profiles = {"x": np.array([ord("a"), ord("b")]), "y": np.array([ord("b"), ord("c")])}
    own = langid.profile(*langid.ngrams("aab"), 3)
    got = langid.Ranker(profiles, 3).predict("aab")
    rank = {int(g): k for k, g in enumerate(own)}
    want = {n: sum(abs(rank[g] - p.tolist().index(g)) if g in p else 3 for g in rank) for n, p in profiles.items()}
    best = min(want, key=lambda n: (want[n], n))
    assert got == (best, pytest.approx(1 - want[best] / (3 * len(own))))


def test_language_model(spark, two_languages):
    out = {r["doc_id"]: r for r in lm.score(table(spark, two_languages), lm.Lbl(floor=30, frequent=40)).collect()}
    words = {i: (t or "").encode().lower().split() + [None] for i, t, _, _ in two_languages}
    known = Counter(w for i, ws in words.items() if i is not None and zlib.crc32(str(i).encode()) % 7 != 2 for w in ws)
    n, v = sum(known.values()), len(known)
    for i, ws in words.items():
        r = out[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(ws), sum(w in known for w in ws), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((known[w] + 1) / (n + v + 1)) for w in ws), abs=1e-6)
        assert r["score"] < 0 and not (r["held_out"] and i is None)
    assert lm.score(table(spark, [])).count() == 0
    assert [(r["base_score"], r["train_tokens"]) for r in lm.score(table(spark, [(None, "a b", None, None)]), lm.Lbl()).collect()] == [(0.0, 0)]


def dense(model, before):
    """All outputs' probabilities after some outputs, by the formula, without groups of tokens or batches."""
    p = model.p
    before = ([model.pad] * p.context + before)[-p.context :]
    q = sum(model.word[x].astype(float) * model.place[k] for k, x in enumerate(before[::-1]))
    soft = lambda x: np.exp(x - x.max()) / np.exp(x - x.max()).sum()
    outer = soft(model.group @ q + model.group_bias)
    inner = [soft(m @ q + b) for m, b in zip(model.member.astype(float), model.member_bias.astype(float), strict=True)]
    return np.array([outer[g] * inner[g][s] for g, s in zip(model.group_of, model.slot_of, strict=True)])


def test_scores_recomputed_word_by_word(spark, two_languages):
    p = lm.Lbl(floor=20, context=3)
    rows = [r for r in two_languages if r[0] != 903]
    train = [t for i, t, _, _ in rows if i is not None and zlib.crc32(str(i).encode()) % 7 != 2]
    found = lm.learn(table(spark, rows).where("crc32(cast(cast(doc_id as string) as binary)) % 7 <> 2").select("text"), p)
    v, model = found.vocabulary, found.model
    known = Counter(w for t in train for w in (t or "").lower().split())
    output = {x: int(lm.encode(lm.textvec.words([x.encode()]), v)[1][0]) for x in {*known, *(w for _, t, _, _ in rows for w in (t or "").lower().split())}}
    mass, kinds = Counter(), Counter()
    for x, n in known.items():
        mass[output[x]] += n
        kinds[output[x]] += 1
    table_of = {x: (o, 1.0 if o < v.words else (known[x] + 1) / (mass[o] + kinds[o] + 1)) for x, o in output.items()}
    out = {r["doc_id"]: r["score"] for r in lm.score(table(spark, rows), p).collect()}
    for i, t, _, _ in rows[:12]:
        before, total = [], 0.0
        for w in (t or "").lower().split():
            o, share = table_of[w]
            total += math.log10(dense(model, before)[o] * share)
            before.append(o)
        total += math.log10(dense(model, before)[v.words])
        assert out[i] == pytest.approx(total, rel=1e-4)
    assert dense(model, [1, 2, 3]).sum() == pytest.approx(1) and len(model.group_of) == v.words + 1 + v.classes
    # of the words of one class, and one word unseen, the shares are all there is
    assert all(share <= 1 for _, share in table_of.values()) and out[900] == out[901]


def test_vocabulary_and_draws_grow_with_the_corpus():
    p = lm.Lbl()
    assert [p.outputs(n) for n in (0, 10**4, 10**8, 10**10)] == [512, 520, 1312, 8512]
    updates = []
    model = lm.Model(np.ones(9), p)
    model._update = lambda stream, rate: updates.append(len(stream) - p.context)
    for n in (10**4, 10**6, 10**7):
        updates.clear()
        model.train(np.zeros(n + p.context, np.int32), 0.1)
        assert sum(updates) == n and max(updates) <= lm.MOST and len(updates) >= min(p.steps, n // p.least)


def test_model_beats_an_interpolated_bigram_on_new_texts(spark):
    """Texts that have copies in the training rows are left out: word pairs remember them, which is no knowledge of language."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    words = {r["doc_id"]: (r["text"] or "").lower().split() + [None] for r in docs.collect()}
    held = {i for i in words if zlib.crc32(str(i).encode()) % 7 == 2}
    one, two, five = Counter(), Counter(), set()
    runs = lambda ws: {tuple(ws[k : k + 5]) for k in range(len(ws) - 4)}
    for i, ws in words.items():
        if i not in held:
            one.update(ws)
            two.update(zip([0, *ws], ws, strict=False))
            five |= runs(ws)
    kinds, after = Counter(u for u, _ in two), Counter()
    for (u, _), n in two.items():
        after[u] += n
    new = {i for i in held if len(runs(words[i]) & five) * 10 <= len(runs(words[i]))}
    out = [r for r in lm.score(docs).collect() if r["doc_id"] in new]
    bigram, tokens, known_plain = 0.0, 0, {}
    for i in new:
        for u, w in zip([0, *words[i]], words[i], strict=False):
            plain = (one[w] + 1) / (sum(one.values()) + len(one) + 1) if w not in known_plain else known_plain[w]
            known_plain[w] = plain
            bigram -= math.log2((two[u, w] + kinds[u] * plain) / (after[u] + kinds[u]) if after[u] else plain)
            tokens += 1
    bits, unigram = (-sum(r[c] for r in out) * math.log2(10) / tokens for c in ("score", "base_score"))
    print(f"bits a held-out token of {len(new)} new texts: unigram {unigram:.2f}, bigram {bigram / tokens:.2f}, model {bits:.2f}")
    assert sum(r["n_tokens"] for r in out) == tokens and bits < min(bigram / tokens, unigram - 1)


def test_licenses():
    s = licenses.scan
    assert s("x All rights reserved.")[1:7] == (1, 1, 1, "reserved", "reserved", 0)
    assert s("cc by cc BY general public license")[1:5] == (3, 0, 4, "cc-by,gpl")
    assert "mit-notice" in s("Released under the terms of the MIT License.")[5] and s("under the MIT License")[5] == ""
    assert "gpl-notice" in s("This small work is licensed under the GNU General Public License, version 3.")[5]
    assert s(None) == s("") == (0, 0, None, None, "", "", 0, 0, 0.0)
    long = "word " * 50000 + "Licensed under the Apache License, Version 2.0."
    assert s(long)[5] == "apache" and s(long)[0] == 50008


def plain_wording(template):
    """A template's text with its optional regions left out, its first alternatives and fewest words taken."""
    import re

    while (t := re.sub(r"\[\[[^\[\]]*\]\]", " ", template)) != template:
        template = t
    return re.sub(r"\{\{(.*?)\}\}", lambda m: "some " * int(m[1][0]) if re.fullmatch(r"\d+-\d+", m[1]) else m[1].split("|")[0], template).split()


def test_whole_licenses_match_exactly():
    s = licenses.scan
    for label in ("mit", "isc", "bsd-2-clause", "bsd-3-clause", "apache-header", "gpl-header", "lgpl-header", "agpl-header"):
        words = plain_wording(licenses.TEMPLATES[label])
        found = s("x y. " + ", ".join(w.upper() for w in words) + " z")
        assert label in found[5].split(",") and found[8] == 1.0, label
        for k in (len(words) // 2, len(words) - 2):  # a mandatory word changed
            if words[k] != "some":
                found = s(" ".join([*words[:k], "not", *words[k + 1 :]]))
                assert label not in found[5].split(",") and (label not in ("mit", "bsd-2-clause") or found[8] == 0.75), (label, words[k])
    lgpl = s(" ".join(plain_wording(licenses.TEMPLATES["lgpl-header"])))
    assert set(lgpl[5].split(",")) == {"gpl", "lgpl-header"}
    three = s(" ".join(plain_wording(licenses.TEMPLATES["bsd-3-clause"])))
    assert "bsd-2-clause" not in three[5]
    mit = " ".join(plain_wording(licenses.TEMPLATES["mit"]))
    assert s(mit.replace("without restriction", "without restriction except for war"))[5:9:3] == ("mit-opening", 0.75)


def test_automaton_equals_regular_expression():
    import re

    a = licenses.Automaton("a [[b {{0-2}}]] {{c|d e}} f")
    pattern = re.compile(r"a( b( \w+){0,2})?( c| d e) f")
    rng = random.Random(1)
    for _ in range(3000):
        words = [rng.choice("abcdefg") for _ in range(rng.randint(0, 8))]
        text = " ".join(words)
        ends = [k for k in range(len(words) + 1) if pattern.fullmatch(" ".join(words[:k]))]
        assert a.accept([w.encode() for w in words], 0) == max(ends, default=-1), text


def test_scan_table(spark):
    rows = [(1, "All rights reserved", None, None), (1, "All rights reserved", None, None), (None, None, None, None)]
    out = licenses.scan_licenses(table(spark, rows)).collect()
    assert sorted((r["doc_id"] or 0, r["n_base"], r["score"]) for r in out) == [(0, 0, 0.0), (1, 1, 0.5), (1, 1, 0.5)]
    assert licenses.scan_licenses(table(spark, [])).count() == 0


@pytest.mark.parametrize(("chunk", "overlap"), [(1 << 15, 1 << 10), (60, 12), (9, 3)])
def test_bpe_equals_library(spark, chunk, overlap):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(2)
    texts = ["", None, "a", " \n\n  x  ", "don't we'll 12345 éß漢字 😀 !!! ...", "x" * 300, " " * 200, "<|endoftext|>"]
    texts += ["".join(rng.choice("ab 1'sé\n\t.,!漢") for _ in range(rng.randint(1, 400))) for _ in range(40)]
    rows = [(i, t, None, None) for i, t in enumerate(texts)] + [(3, texts[3], None, None), (None, "abc", None, None)]
    out = bpe.encode_documents(table(spark, rows), bpe.Bpe(path, public_tokenizers.PATTERN, chunk, overlap)).collect()
    assert len(out) == len(rows)
    by_id = dict((i, t) for i, t, _, _ in rows)
    for r in out:
        text = by_id[r["doc_id"]] or ""
        ids = library.encode_ordinary(text)
        sha = lambda b: hashlib.sha256(b).hexdigest()
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), sha(" ".join(map(str, ids)).encode()), sha(text.encode()))
    assert bpe.encode_documents(table(spark, []), bpe.Bpe(path, public_tokenizers.PATTERN)).count() == 0


def test_search_equals_brute_force(spark):
    rng = random.Random(4)
    vocabulary = [f"t{int(rng.paretovariate(0.6))}" for _ in range(400)]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 30))) for _ in range(400)] + ["T1 t2", "t1 T2", None, "", "q " * 9000]
    p = search.Bm25(k=7, shard=64, group=16, block=8)
    docs = spark.createDataFrame(list(enumerate(texts)) + [(None, "t1")], "doc long, text string")
    docs = docs.unionByName(docs.where("doc in (3, 400)"))
    asked = spark.createDataFrame([(i, t) for i, t in enumerate(texts) if i % 20 == 0 or i > 398] + [(400, texts[400]), (None, "t1")], "query long, text string")
    got = {}
    for r in search.top_k(docs, asked, p).collect():
        got.setdefault(r["query"], {})[r["rank"]] = (r["doc"], r["score"])
    words = [(t or "").lower().split() for t in texts]
    tf = [Counter(w) for w in words]
    df = Counter(x for c in tf for x in c)
    mean = sum(map(len, words)) / len(words)
    for i in range(len(texts)):
        if i % 20 == 0 or i > 398:
            score = {}
            for d, c in enumerate(tf):
                s = sum(math.log(1 + (len(texts) - df[x] + 0.5) / (df[x] + 0.5)) * c[x] * 2.2 / (c[x] + 1.2 * (0.25 + 0.75 * len(words[d]) / mean)) for x in set(words[i]) if x in c)
                if s > 0:
                    score[d] = s
            want = sorted(score, key=lambda d: (-round(score[d], 6), d))[:7]
            assert [got.get(i, {}).get(k + 1, (None,))[0] for k in range(len(want))] == want
            assert len(got.get(i, {})) == len(want)
    none = spark.createDataFrame([], "doc long, text string")
    assert search.top_k(none, asked, p).count() == 0 and search.top_k(docs, none.withColumnRenamed("doc", "query"), p).count() == 0


def test_search_skips_postings_and_keeps_one_threshold():
    rng = np.random.default_rng(3)
    n, p = 4096, search.Bm25(k=5, block=16)
    # documents of like words lie together, as in a crawl; the query asks for one region's words and frequent ones
    words = [np.unique(np.concatenate([rng.integers(0, 40, 12), 100 + d // 64 * 10 + rng.integers(0, 10, 3)])) for d in range(n)]
    tf = [rng.integers(1, 4, len(w)) for w in words]
    owner = np.repeat(np.arange(n), [len(w) for w in words])
    index = search.Index(np.arange(n), np.array([t.sum() for t in tf]), np.concatenate(words), owner, np.concatenate(tf), 30.0, p)
    df = np.bincount(np.concatenate(words), minlength=1000)
    terms = np.array([1, 2, 3, 4, 130, 131, 132])
    idf = np.log(1 + (n - df[terms] + 0.5) / (df[terms] + 0.5))
    docs, scores = index.search(terms, idf)
    full = np.zeros(n)
    for t, w in zip(terms, idf, strict=True):
        at = slice(index.at[index.of[np.searchsorted(index.terms, t)]], index.at[index.of[np.searchsorted(index.terms, t) + 1]])
        full[index.owner[at]] += w * index.impact[at]
    full = np.round(full, p.digits)
    want = np.lexsort((np.arange(n), -full))[:5]
    assert docs.tolist() == want.tolist() and scores.tolist() == full[want].tolist()
    first = index.read
    assert first < index.asked / 4
    # with the threshold known, less is read and the result is the same; above it nothing is
    assert index.search(terms, idf, scores[-1])[0].tolist() == docs.tolist() and index.read - first <= first
    before = index.read
    assert len(index.search(terms, idf, float(scores[0]) + 1e9)[0]) == 0 and index.read == before


def test_search_takes_rows_that_share_a_number_apart(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (1, "a c"), (2, "d")], "doc int, text string")
    asked = spark.createDataFrame([(7, "a"), (7, "a"), (7, "d")], "query int, text string")
    got = sorted((r["query"], r["rank"], r["doc"]) for r in search.top_k(docs, asked).collect())
    assert got == [(7, 1, 1), (7, 1, 2), (7, 2, 1)]


def test_mixing(spark):
    rng = random.Random(5)
    rows = [(k, "w " * rng.randint(1, 40), None, rng.choice(["a", "a", "a", "b", "c", None])) for k in range(400)]
    rows += [(7, "w w", None, "a"), (7, "w w", None, "a"), (None, "w", None, "c"), (500, None, None, "b"), (501, " ", None, "zero")]
    out = mixing.mix(table(spark, rows)).collect()
    again = mixing.mix(table(spark, rows).repartition(7)).collect()
    key = lambda r: (r["doc_id"] or -1, r["source"] or "", r["ord"], r["size"], r["taken"])
    assert sorted(map(key, out)) == sorted(map(key, again)) and len(out) == len(rows)
    total = sum(r["size"] for r in out)
    sizes, taken, target = Counter(), Counter(), {}
    for r in out:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert r["taken"] == r["copies"] * r["size"] <= 3 * r["size"]
    # shares by weight, capped at three times a source's size, again and again
    weight = dict(zip(["a", "b", "c", "zero", None], (5, 2, 1, 5, 2), strict=True))
    want, free = {}, set(weight)
    while True:
        left = total - sum(want.values())
        over = {s for s in free if left * weight[s] / sum(weight[x] for x in free) > 3 * sizes[s]}
        if not over:
            break
        want |= {s: 3 * sizes[s] for s in over}
        free -= over
    want |= {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
    for s in weight:
        assert target[s] == pytest.approx(want[s]) and abs(taken[s] - target[s]) <= 40
    mixed = mixing.mixed_documents(table(spark, rows))
    assert mixed.columns == table(spark, []).columns and mixed.count() == sum(r["copies"] for r in out)
    # columns of the names that the operator uses itself, a very long text, and many equal rows
    odd = [(k, "w " * 60_000 if k == 3 else "w x", None, "a") for k in range(9)] + [(None, "u v", None, "b")] * 2500
    clash = table(spark, odd).selectExpr("*", *(f"1 AS {c}" for c in ("pid", "psource", "did", "row", "copies", "ord", "of", "hash", "_pid")))
    again = mixing.mixed_documents(clash)
    assert again.columns == clash.columns and again.count() == sum(r["copies"] for r in mixing.mix(clash).collect()) > 2500
    assert mixing.mix(table(spark, [])).count() == 0 and mixing.mixed_documents(table(spark, [])).count() == 0


def brute_cut(gain, edges):
    best = None
    for mask in range(1 << len(gain)):
        x = [mask >> k & 1 for k in range(len(gain))]
        cost = sum(g for g, k in zip(gain, x, strict=True) if g > 0 and not k) - sum(g for g, k in zip(gain, x, strict=True) if g < 0 and k) + sum(c for i, j, c in edges if x[i] != x[j])
        best = cost if best is None else min(best, cost)
    return best


def test_minimum_cut_is_minimal():
    rng = random.Random(6)
    for _ in range(300):
        n = rng.randint(1, 8)
        gain = [rng.randint(-9, 9) or 1 for _ in range(n)]
        edges = [(i, j, rng.randint(1, 6)) for i in range(n) for j in range(i + 1, n) if rng.random() < 0.5]
        x = webtext.minimum_cut(gain, edges)
        cost = sum(g for g, k in zip(gain, x, strict=True) if g > 0 and not k) - sum(g for g, k in zip(gain, x, strict=True) if g < 0 and k) + sum(c for i, j, c in edges if x[i] != x[j])
        assert cost == brute_cut(gain, edges)


PAGE = """<html><head><title>T</title><script>var a="</p><p>no";</script></head><body><header><a href=/>Home</a></header><nav><ul><li><a href=1>A</a></ul></nav>
<div id="cookie-notice"><p>We use cookies to give you the best experience on our site. Please accept them.</p></div>
<article><h1>Big &amp; Title</h1><p>First <em>para</em>graph of the article, with several words, commas, and more. It goes on.<p>Short.</p>
<div class="ad">Buy now, cheap things are here. Really.</div><p>Last   one &lt;b&gt;&nbsp;of it all, quite long as well, since articles are like that.</p><form><label>Mail</label></form></article>
<section class="comments"><article class="comment"><p>I think this is a great article, thank you so much for writing it. Best, Bob.</p></article></section>
<aside><p>Some other thing that you would really like to read today, believe us.</p></aside><footer>&copy; 2020, long text, with commas, to fool you.</footer></body></html>"""


def test_extraction(spark):
    want = "Big & Title\n\nFirst paragraph of the article, with several words, commas, and more. It goes on.\n\nShort.\n\nLast one <b> of it all, quite long as well, since articles are like that."
    assert webtext.main_text(PAGE) == want
    assert [webtext.main_text(x) for x in (None, "", "<", "<p", "<!-- x", "<div><a href=x>y</a>")] == ["", "", webtext.main_text("<"), webtext.main_text("<p"), "", ""]
    long = "<article>" + "<p>" + "Many words, and more of them. " * 20000 + "</p>" * 2 + "<b>" * 2000 + "</article>"
    assert len(webtext.main_text(long)) > 500_000
    pages = spark.createDataFrame([(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (None, None, None, None)], "page_id long, url string, html string, text string")
    out = webtext.extract(pages).collect()
    assert sorted((r["page_id"] or 0, r["n_chars"]) for r in out) == [(0, 0), (1, len(want)), (1, len(want))]
    assert webtext.extract(pages.where("page_id > 5")).count() == 0


PROSE = "This is a paragraph of the article, with several words, commas, and more. It goes on for a while, as they do."


@pytest.mark.parametrize(
    "page",
    [
        '<article class="ad-free"><p>{}</p><p>{}</p></article>',
        '<div class="alert-story"><article><p>{}</p><p>{}</p></article></div>',
        '<div class="post no-comments"><p>{}</p><p>{}</p></div>',
        '<div class="post form-page"><p>{}</p><p>{}</p></div>',
        '<article><p data-hidden="false">{}</p><p title="A hidden gem">{}</p></article>',
        "<article><p class=intro data-x='<p hidden>'>{}</p><p id=\"hidden\" aria-label='ad nav footer'>{}</p></article>",
        '<body class="has-sidebar"><main><div><p>{}</p></div><section><p>{}</p></section></main>',
    ],
)
def test_names_that_only_look_like_boilerplate(page):
    assert webtext.main_text(page.format(PROSE, PROSE + " Yes.")) == f"{PROSE}\n\n{PROSE} Yes."


def test_boilerplate_by_its_names():
    for name in ("ad", "ad-slot", "sidebarAd", "comment-list", "comments", "cookie-notice", "site-footer", "nav_menu", "newsletter-box", "share-links"):
        page = f'<article><p>{PROSE}</p><div class="x {name}"><p>{PROSE} Not this.</p></div><p>{PROSE}</p></article>'
        assert webtext.main_text(page) == f"{PROSE}\n\n{PROSE}", name


def test_whole_blocks_count_and_nothing_else_is_dropped():
    inside = "<p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> be, in <canvas>a drawing</canvas> or <object>an object</object>, that number. It is even.</p>"
    assert webtext.main_text(f"<article>{inside}</article>") == "Let x=2 be, in a drawing or an object, that number. It is even."
    odds = [webtext.log_odds(webtext.blocks(f"<article><p>{text}</p></article>")[0]) for text in (PROSE, PROSE + " word" * 100, "word " * 100 + PROSE)]
    assert odds[1] == pytest.approx(odds[2]) and odds[1] > odds[0]
    deep = "<a href=x>" + "<b><i><u><s>" + "linked words " * 5 + "</s></u></i></b></a>"
    assert webtext.blocks(f"<p>{deep}</p>")[0].linked > 0.9


def test_labelling_is_the_cheapest_of_all(monkeypatch):
    rng = random.Random(12)
    parts = ["<p>Short.</p>", f"<p>{PROSE}</p>", "<ul><li><a href=x>Go</a></li><li>One, two.</li></ul>", "<div class='notice'><p>Mind this, please.</p></div>", "<h2>Part</h2>", "<footer>Some words</footer>", "<div>A few words here.</div>"]
    flipped = 0
    for _ in range(150):
        inner = "".join(rng.choice(parts) for _ in range(rng.randint(1, 4)))
        found = webtext.blocks(f"<div>{inner}</div><article>{rng.choice(parts)}{rng.choice(parts)}</article><p>{rng.choice(parts)}")
        gain = [round(webtext._SCALE * webtext.log_odds(b)) or -1 for b in found]
        edges = webtext.smoothness(found)
        keep = webtext.minimum_cut(gain, edges)
        cost = sum(abs(g) for g, k in zip(gain, keep, strict=True) if (g > 0) != k) + sum(c for i, j, c in edges if keep[i] != keep[j])
        assert cost == brute_cut(gain, edges)
        flipped += sum((g > 0) != k for g, k in zip(gain, keep, strict=True))
    assert flipped > 20  # neighbours overrule the classifier, marks included
    # a marked line of prose among marked lines of prose inside a long article: the cut, not the mark, keeps it
    monkeypatch.setitem(webtext.WEIGHTS, "bad", -5.0)
    page = f"<article><div class=story><div class=notice><p>{PROSE * 3}</p><p>Short one, here.</p><p>{PROSE * 3}</p></div></div></article>"
    found = webtext.blocks(page)
    assert all(b.bad for b in found) and webtext.log_odds(found[1]) < 0 < webtext.log_odds(found[0]) and webtext.main_text(page).count("Short one") == 1


def brute_pipeline(rows, p):
    """The pipeline's documents by plain Python: whole sets, all runs, one queue; ``{(id, text): copies}``."""
    import re

    from tests.llm.test_near import brute_components, brute_removed

    ranked = {}
    for i, t, lang, _ in rows:
        if i is not None and lang and t is not None and zlib.crc32(str(i).encode()) % 5:
            ranked.setdefault(lang, Counter())
            for g, n in zip(*langid.ngrams(t), strict=True):
                ranked[lang][int(g)] += int(n)
    profiles = {lang: [g for g, _ in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:400]] for lang, c in ranked.items()}

    def closeness(t):
        own = sorted(zip(*langid.ngrams(t), strict=True), key=lambda x: (-x[1], x[0]))[:400]
        far = [sum(abs(place.index(g) - k) if g in place else 400 for k, (g, _) in enumerate(own)) for place in profiles.values()]
        return 1 - min(far) / (400 * len(own)) if own else -1.0

    rows = [r for r in rows if closeness(r[1]) >= p.LEAST_SCORE]
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0))
    comp = brute_components([(k, r[1]) for k, r in enumerate(rows)], 5, 80)
    rows = [r for k, r in enumerate(rows) if comp[k][1] == k]
    left = brute_removed([r[1] for r in rows], p.Spans())
    rows = [(i, " ".join(w), s) for (i, _, _, s), w in zip(rows, left, strict=True) if w]
    size = [len(re.findall(mixing.WORD, t)) for _, t, _ in rows]
    total, names = sum(size), sorted({s for _, _, s in rows})
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    whole = {s: sum(n for (_, _, x), n in zip(rows, size, strict=True) if x == s) for s in names}
    target, free = {}, set(names)
    while True:
        level = (total - sum(target.values())) / max(1, sum(weight[s] for s in free))
        over = {s for s in free if level * weight[s] > 3 * whole[s]}
        if not over:
            break
        target |= {s: 3 * whole[s] for s in over}
        free -= over
    target |= {s: level * weight[s] for s in free}
    queue = []
    for s in names:
        for r in range(3):
            sent, done = sorted((hashlib.md5(f"mix|{r}|{i}|1".encode()).hexdigest(), k) for k, (i, _, x) in enumerate(rows) if x == s), 0
            for h, k in sent:
                done += size[k]
                queue.append(((r * whole[s] + done) / target[s], s, r, h, k))
    copies, used = Counter(), 0
    for _, _, _, _, k in sorted(queue):
        used += size[k]
        if used > total:
            break
        copies[rows[k][0]] += 1
    return {i: (t, copies[i]) for i, t, _ in rows if copies[i]}


def test_pipeline(spark, tmp_path):
    import corpus_pipeline as c

    rng = random.Random(8)
    words = [prose(rng, "abcdefghij", 1) for _ in range(3000)]
    text = lambda n: " ".join(rng.choice(words) + ("." if rng.random() < 0.15 else "") for _ in range(n))
    passage = text(90)
    rows = [(k, text(80), "aa", f"s{k % 2}") for k in range(60)]
    near = rows[0][1].split()
    near[3] = "changed"
    rows += [(100, rows[5][1], "aa", "s0"), (101, " ".join(near), "aa", "s1"), (102, text(40) + ". " + passage + ". " + text(40), "aa", "s0"), (103, text(40) + ". " + passage + ". " + text(40), "aa", "s1"), (104, None, "aa", "s0"), (105, "!!! ???", None, "s0")]
    table(spark, rows).drop("score").write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    found = {}
    for name, step in c.STAGES:
        docs = step(spark, docs, str(tmp_path))
        found[name] = docs.collect()
        if name != c.STAGES[-1][0]:
            assert set(docs.columns) == {"doc_id", "text", "lang", "source", "n_chars"}
            docs = spark.createDataFrame(found[name], docs.schema)
    ids = lambda name: sorted(r["doc_id"] for r in found[name])
    assert ids("language_id") == sorted(set(range(60)) | {100, 101, 102, 103})
    assert ids("minhash_near_dedup") == sorted(set(range(60)) | {102, 103})
    cut = {r["doc_id"]: r["text"] for r in found["substring_dedup"]}
    assert len(cut[103].split()) < 110 and len(cut[102].split()) >= 170 and all(cut[k] == t for k, t, _, _ in rows[:60])
    assert len(found["byte_bpe"]) == len(found["source_mixing"]) > 0
    out = c.run(spark, str(tmp_path)).collect()
    assert sorted(map(str, out)) == sorted(map(str, found["byte_bpe"]))
    want = brute_pipeline(rows, c)
    assert Counter(r["doc_id"] for r in out) == {i: n for i, (_, n) in want.items()}
    assert {r["doc_id"]: r["text"].lower().split() for r in found["source_mixing"]} == {i: t.split() for i, (t, _) in want.items()}


def test_pipeline_edge_cases(spark, tmp_path):
    import corpus_pipeline as c

    docs = table(spark, [(1, "a b c d e f", "aa", "s"), (1, "a b c d e f", "aa", "s"), (None, "a b c d e f", "aa", None), (None, None, None, None), (2, "", "aa", "s"), (3, "u v w " * 30_000, "aa", None), (1, "l m n o p", "aa", "s")])
    docs = docs.selectExpr("*", *(f"doc_id AS {x}" for x in ("rid", "_rid", "_text", "_pid", "held_out", "lang_pred", "id", "root")))
    kept = c.near(spark, docs, "")
    assert kept.columns == docs.columns and sorted((r["doc_id"] or 0, len(r["text"] or "")) for r in kept.collect()) == [(0, 0), (1, 9), (1, 11), (2, 0), (3, 180_000)]
    none = docs.where("doc_id > 9")
    for name, step in c.STAGES:
        docs, none = step(spark, docs, ""), step(spark, none, "")
        assert none.count() == 0 and docs.columns == none.columns, name
    assert docs.count() > 0


def test_long_queries_scored_together_are_exact():
    """Against plain sums: equal documents, thresholds, terms of all, many and few documents, and no term at all."""
    rng = np.random.default_rng(5)
    n, p = 700, search.Bm25(k=6, block=16, columns=40, rows=8)
    held = [np.unique(np.minimum(rng.zipf(1.3, rng.integers(0, 60)), 400)) for _ in range(n)]
    held[500:520] = [held[7]] * 20  # copies tie
    size = np.array([len(x) for x in held])
    tf = rng.integers(1, 4, size.sum())
    tf[np.repeat(np.isin(np.arange(n), [7, *range(500, 520)]), size)] = 1
    owner, length = np.repeat(np.arange(n), size), size + 1
    index = search.Index(np.arange(n) * 3, length, np.concatenate(held), owner, tf, float(length.mean()), p)
    idf = rng.random(401) * 5 + 0.01
    queries = [(held[d], idf[held[d]], 0.0) for d in [7, *range(40)]] + [(np.array([9999]), np.array([1.0]), 0.0)]
    impact = np.zeros((n, 401))
    impact[owner, np.concatenate(held)] = tf * (p.k1 + 1) / (tf + p.k1 * (1 - p.b + p.b * length / length.mean())[owner])
    found = index.search_many(queries)
    for (terms, w, _), (docs, scores) in zip(queries, found, strict=True):
        plain = np.round(impact[:, terms] @ w, 6) if terms.max(initial=0) < 401 else np.zeros(n)
        best = [d for d in np.lexsort((np.arange(n), -plain))[: p.k] if plain[d] > 0]
        assert docs.tolist() == [3 * d for d in best] and np.allclose(scores, plain[best], atol=2e-6)
        one = index.search(terms, w)
        assert one[0].tolist() == docs.tolist()
    again = index.search_many([(t, w, s[2] if len(s) > 2 else 0.0) for (t, w, _), (_, s) in zip(queries, found, strict=True)])
    assert all(a[0].tolist()[:3] == b[0].tolist()[:3] for a, b in zip(again, found, strict=True))
