"""Unit vectors, golden scores, planted parameters, graphs, files, the judge and streaming."""

import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from orgweave.functions import text as t
from orgweave.functions.similarity import add_metaphone, jaro_winkler_bytes, jaro_winkler_many, may_reach
from orgweave.operators import cluster, compare, judge, model, profile, report, score, tokens, train
from orgweave.operators.filters import filter_bad_records
from orgweave.plans import linkage, prepare
from orgweave.sources import files, tables


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "x string").select(column(F.col("x")).alias("y")).first()[0]


@pytest.mark.parametrize(
    ("function", "value", "want"),
    [
        (t.clean_name, "  ACME Corp.  ", "acme corp."), (t.clean_name, "", None), (t.clean_name, None, None), (t.clean_name, "a  b", "a b"),
        (t.normalize_name, "X Company (China)", "x"), (t.normalize_name, "Élan Pharma, Inc.", "élan pharma"), (t.normalize_name, "  ", None),
        (t.country_code, "us", "US"), (t.country_code, "FR; DE", "FR"), (t.country_code, "  ", None), (t.country_code, "Germany", "DE"), (t.country_code, "Atlantis", "Atlantis"),
        (t.first_significant_word, "the university of oslo", "oslo"), (t.first_significant_word, "university", "university"), (t.first_significant_word, " ", None),
        (t.token_set, "university of the arts", ["arts", "university"]), (t.token_set, None, []),
        (t.is_generic, "Investigative Site 001", True), (t.is_generic, "Harvard University", False), (t.is_generic, None, False),
        (t.soundex, "ashcraft", "A261"), (t.soundex, "tymczak", "T522"), (t.soundex, "pfister", "P236"), (t.soundex, "école", "E240"),
        (t.classify, "School of Law", "School"), (t.classify, None, "Unknown"),
        (t.alias_text, "['A', 'B']", ["A", "B"]), (t.alias_text, "[broken", ["[broken"]), (t.alias_text, "", None),
        (t.safe_double, "nan", None), (t.safe_double, "4.5", 4.5), (t.safe_long, "-2.9", -2),
    ],
)
def test_text(spark, function, value, want):
    assert one(spark, function, value) == want


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("{name=John, age=30}", {"name": "John", "age": "30"}), ("{a=null, url=http://x?id=3}", {"a": None, "url": "http://x?", "id": "3"}), (None, {}), ("", {}), ("{}", {}),
        ("a=1, a=2", {"a": "2"}), ("{x=1, 2, y=, z=q, }", {"x": "1, 2", "y": "", "z": "q,"}), ("none", {}),
    ],
)
def test_java_map(spark, text, want):
    assert t.with_java_map(spark.createDataFrame([(text,)], "x string"), "x", "m").first()["m"] == want


def test_tiers(spark):
    df = spark.createDataFrame([(x,) for x in (0.0, 0.5, 0.7, 0.95, 1.0)], "p double")
    assert [r[0] for r in df.select(t.tier(F.col("p"), low=False)).collect()] == [None, None, "0.5-0.7 (Low)", "0.85-0.95 (High)", "0.95-1.0 (Very High)"]
    assert [r[0] for r in df.select(t.tier(F.col("p"))).collect()][:2] == [None, "0-0.5 (Very Low)"]


def test_jaro_winkler_equals_duckdb():
    rng = random.Random(0)
    pairs = [("".join(rng.choice("abcé ") for _ in range(rng.randint(0, 9))), "".join(rng.choice("abcé ") for _ in range(rng.randint(0, 9)))) for _ in range(1500)]
    con = duckdb.connect()
    con.execute("CREATE TABLE p (k INT, a VARCHAR, b VARCHAR)")
    con.executemany("INSERT INTO p VALUES (?, ?, ?)", [(k, a, b) for k, (a, b) in enumerate(pairs)])
    want = con.sql("SELECT jaro_winkler_similarity(a, b) FROM p ORDER BY k").fetchall()
    assert all(jaro_winkler_bytes(a.encode(), b.encode()) == pytest.approx(w, abs=1e-12) for (a, b), (w,) in zip(pairs, want, strict=True) if a and b)
    for least in (0.8, 0.88, 0.95):
        can = may_reach([a.encode() for a, _ in pairs], [b.encode() for _, b in pairs], least)
        assert all(c or w < least for c, (w,) in zip(can, want, strict=True)) and not can.all()
    assert jaro_winkler_bytes(b"abcd", b"abxyzwqr") == pytest.approx(0.5833333333333334)
    rng = random.Random(5)
    text = lambda: "".join(rng.choice("abcé ") for _ in range(rng.randint(0, 70))).encode()
    left = [text() for _ in range(600)]
    right = [x[: rng.randint(0, 70)] + text()[:9] if k % 2 else text() for k, x in enumerate(left)]
    left, right = [*left, b"\0ab", b"ab"], [*right, b"ab", b"ab\0"]
    assert jaro_winkler_many(left, right).tolist() == [jaro_winkler_bytes(x, y) for x, y in zip(left, right, strict=True)]
    assert jaro_winkler_many([], []).tolist() == []


VOWELS = set("AEIOU")


def metaphone_word(text: str) -> str:
    """The rules again, letter by letter, to hold the expression against."""
    w = "".join(c for c in text.upper() if "A" <= c <= "Z")
    for start, to in (("AE", "E"), ("GN", "N"), ("KN", "N"), ("PN", "N"), ("WR", "R"), ("X", "S"), ("WH", "W")):
        if w.startswith(start):
            w = to + w[len(start) :]
            break
    out: list[str] = []

    def at(k: int) -> str:
        return w[k] if 0 <= k < len(w) else ""

    for k, c in enumerate(w):
        if c == at(k - 1) and c != "C":
            continue
        after = at(k + 1)
        if c in VOWELS:
            code = c if k == 0 else ""
        elif c == "B":
            code = "" if k == len(w) - 1 and at(k - 1) == "M" else "B"
        elif c == "C":
            if after and after in "IEY":
                code = "X" if w[k : k + 3] == "CIA" else "" if at(k - 1) == "S" else "S"
            elif after == "H":
                code = "K" if at(k - 1) == "S" else "X"
            else:
                code = "K"
        elif c == "D":
            code = "J" if after == "G" and at(k + 2) and at(k + 2) in "EIY" else "T"
        elif c == "G":
            if after == "H":
                code = "K" if at(k + 2) in VOWELS and at(k + 2) else ""
            elif after == "N":
                code = "" if k + 2 == len(w) or w[k:] == "GNED" else "K"
            elif after and after in "IEY" and at(k - 1) != "G":
                code = "" if at(k - 1) == "D" else "J"
            else:
                code = "K"
        elif c == "H":
            code = "H" if after in VOWELS and after and not (at(k - 1) and at(k - 1) in "CSPTG") else ""
        elif c == "K":
            code = "" if at(k - 1) == "C" else "K"
        elif c == "P":
            code = "F" if after == "H" else "P"
        elif c == "Q":
            code = "K"
        elif c == "S":
            code = "X" if after == "H" or w[k : k + 3] in ("SIO", "SIA") else "S"
        elif c == "T":
            code = "X" if w[k : k + 3] in ("TIA", "TIO") else "0" if after == "H" else "" if w[k : k + 3] == "TCH" else "T"
        elif c == "V":
            code = "F"
        elif c in "WY":
            code = c if after in VOWELS and after else ""
        elif c == "X":
            code = "KS"
        elif c == "Z":
            code = "S"
        else:
            code = c
        out.append(code)
    return "".join(out)


def test_metaphone(spark):
    known = {"Smith": "SM0", "Smyth": "SM0", "physics": "FSKS", "school": "SKL", "signed": "SNT", "": "", "123": "", "naïve": "NF"}
    draw = random.Random(5)
    words = [*known, *("".join(draw.choices("ABCDEFGHIKMNOPSTWXYZGHCI", k=draw.randint(1, 9))) for _ in range(3000))]
    found = {x["w"]: x["m"] for x in add_metaphone(spark.createDataFrame([(w,) for w in [*words, None]], "w string"), "w", "m").collect()}
    assert found == {w: metaphone_word(w) for w in words} | {None: None}
    assert {w: found[w] for w in known} == known


GOLDEN = [
    ({}, -1, -19.931567126628412),
    ({}, 0, -26.141395169932334),
    ({"name_normalized": 1, "country_match": 1, "city_match": 2}, 0, -5.843988328575276),
    ({"name_normalized": 2, "phonetic_match": 1, "country_match": 1, "city_match": 2}, 0, 3.9667942352289676),
    ({"name_normalized": 1, "phonetic_match": 1, "distinctive_match": 1, "token_overlap": 1, "containment_check": 1, "first_token_match": 3, "country_match": 1, "city_match": 2}, 0, 35.0324782655885),
    ({"name_normalized": 4, "phonetic_match": 1, "distinctive_match": 1, "token_overlap": 1, "containment_check": 4, "first_token_match": 3, "alias_match": 1, "country_match": -1, "city_match": -1}, 0, 56.36108079420205),
]


@pytest.mark.parametrize(("levels", "other", "want"), GOLDEN)
def test_golden_scores(spark, levels, other, want):
    found = compare.comparisons(model.default_settings())
    df = spark.createDataFrame([tuple(levels.get(c.name, other) for c in found)], ", ".join(f"gamma_{c.name} int" for c in found))
    r = score.add_scores(df, found, model.PRIOR).first()
    assert r["match_weight"] == pytest.approx(want, abs=1e-9) and r["match_probability"] == pytest.approx(2**want / (1 + 2**want))


def containment(spark, a, b):
    c = next(x for x in compare.comparisons(model.default_settings()) if x.name == "containment_check")
    df = spark.createDataFrame([(a, b)], "name_tokens_l array<string>, name_tokens_r array<string>")
    return df.select(compare.gamma(c)).first()[0]


def test_containment(spark):
    assert containment(spark, ["daegu", "university"], ["daegu", "foreign", "studies", "university"]) == 2
    assert containment(spark, ["a1"], ["b1"]) == 3 and containment(spark, [], []) == 4 and containment(spark, None, []) == -1
    assert containment(spark, ["a", "b", "c"], ["a", "b", "c", "d", "e"]) == 1


def test_dialect():
    sql = 'array_length(list_intersect("x_l", "x_r"), 1) >= 2 AND list_contains(list_transform("n_r", lambda x: LOWER(x)), LOWER(a_l)) AND len(b_l) = 1'
    assert compare.translate(sql) == "size(array_intersect(`x_l`, `x_r`)) >= 2 AND array_contains(transform(`n_r`, x -> LOWER(x)), LOWER(a_l)) AND size(b_l) = 1"


def test_expectation_maximisation_recovers_planted():
    rng = np.random.default_rng(0)
    m, u = [np.array([0.1, 0.9]), np.array([0.2, 0.1, 0.7]), np.array([0.3, 0.7])], [np.array([0.95, 0.05]), np.array([0.8, 0.15, 0.05]), np.array([0.9, 0.1])]
    n, share = 40_000, 0.25
    match = rng.random(n) < share
    g = np.stack([np.where(match, rng.choice(len(a), n, p=a), rng.choice(len(a), n, p=b)) for a, b in zip(m, u, strict=True)], axis=1)
    table, count = np.unique(g, axis=0, return_counts=True)
    got, prior, likelihood = train.expectation_maximisation(table, count.astype(float), u, rounds=100, tolerance=1e-7)
    assert all(np.abs(a - b).max() < 0.03 for a, b in zip(got, m, strict=True)) and abs(prior - share) < 0.02
    assert all(b >= a - 1e-6 for a, b in zip(likelihood, likelihood[1:])) and all(abs(x.sum() - 1) < 1e-9 for x in got)


def test_components(spark):
    path = [(k, k + 1) for k in range(100, 140)]
    star = [(7, k) for k in range(300, 320)]
    edges = [(f"n{a:04}", f"n{b:04}", 0.9) for a, b in path + star + [(1, 2)]] + [("n0002", "n0100", 0.5)]
    df = spark.createDataFrame(edges, "unique_id_l string, unique_id_r string, match_probability double")
    got = {r[0]: r[1] for r in cluster.clusters(df).collect()}
    assert {got[f"n{k:04}"] for k in range(100, 141)} == {"n0100"} and got["n0319"] == "n0007" and got["n0002"] == "n0001" and len(got) == 64
    stars = df.where("unique_id_l = 'n0007'")
    assert sorted(cluster.star_clusters(stars).collect()) == sorted(cluster.clusters(stars).collect())
    assert cluster.clusters(df.where("false")).count() == 0


def test_disambiguate(spark):
    rows = [("l2", "r", 0.9, "US", "US", "long name"), ("l1", "r", 0.9, "US", None, "x"), ("l3", "r", 0.9, "US", "US", "short"), ("l0", "q", 0.6, None, None, None)]
    df = spark.createDataFrame(rows, "unique_id_l string, unique_id_r string, match_probability double, country_code_l string, country_code_r string, name_l string")
    assert sorted((r["unique_id_r"], r["unique_id_l"]) for r in cluster.disambiguate(df).collect()) == [("q", "l0"), ("r", "l3")]
    assert {r["unique_id_r"]: r["unique_id_l"] for r in cluster.disambiguate(df, True).collect()} == {"q": "l0", "r": "l3"}


def test_files(spark, tmp_path):
    df = spark.createDataFrame([("a", "b", 0.99, True), ("a", "c", 0.6, False)], "unique_id_l string, unique_id_r string, match_probability double, llm_match boolean")
    assert files.load_parquet(spark, f"{tmp_path}/none") is None and files.load_json(f"{tmp_path}/none.json", spark) is None
    assert files.cached(spark, f"{tmp_path}/t", lambda: df).count() == 2 and files.cached(spark, f"{tmp_path}/t", lambda: 1 / 0).count() == 2
    assert files.save_results(df, f"{tmp_path}/out") == ["llm_confirmed", "llm_rejected", "high_confidence"]
    files.save_csv(df.withColumn("a", F.array("unique_id_l")), f"{tmp_path}/csv")
    assert spark.read.option("header", True).csv(f"{tmp_path}/csv").count() == 2
    settings = model.default_settings()
    files.save_model(settings, {"records": 1}, f"{tmp_path}/model.json", spark)
    assert files.load_model(f"{tmp_path}/model.json", spark) == settings


def test_judge(spark):
    cases = ['```\n{"match": true}\n```', '{"match": false}', "abc", None, '{"match": true, "confidence": 0.4, "reason": "' + "r" * 300 + '"}']
    df = spark.createDataFrame([(x,) for x in cases], "r string")
    got = [tuple(r) for r in df.select(*(v.alias(k) for k, v in judge.parse_response(F.col("r")).items())).collect()]
    assert got[:3] == [(True, 0.9, ""), (False, 0.1, ""), (None, 0.0, "parse_error: abc")] and got[3][0] is None and got[4] == (True, 0.4, "r" * 200)
    calls = []

    def flaky(text):
        calls.append(text)
        if len(calls) < 3:
            raise OSError("busy")
        return "ok " + text

    assert [r["response"] for r in judge.ask(spark.createDataFrame([("p",)], "prompt string").coalesce(1), flaky, wait=0.01).collect()] == ["ok p"]
    assert judge.ask(spark.createDataFrame([("p",)], "prompt string"), lambda x: 1 / 0, wait=0.01).first()["response"].startswith("error: ")
    assert judge.source_context("a.b", {"a.*": {"notes": "x"}})["notes"] == "x" and judge.source_context("z", {}) == judge.UNKNOWN_SOURCE
    m = spark.range(1).select(F.create_map(*map(F.lit, ("email", "a@b", "class", "", "name_aliases", "x, y,,z"))).alias("m"))
    assert m.select(judge.metadata_text(F.col("m"))).first()[0] == "email: a@b; aliases: x, y, z"
    contexts = {"a.*": {"description": "All of a."}, "a.b": {"description": "Only a.b.", "key_fields": ["name", "city"]}}
    sources = spark.createDataFrame([("a.b",), ("a.c",), ("z",), (None,)], "s string").select(judge.context_text(F.col("s"), contexts))
    unknown = "Unknown source table. No specific context available for this source."
    assert [r[0] for r in sources.collect()] == ["Only a.b. Telling fields: name, city.", "All of a.", unknown, unknown]
    found = spark.createDataFrame([("l1", "r1", "Ab Ltd", "a.c", {"email": "a@b", "noise": "n"})], "unique_id_l string, unique_id_r string, name_r string, source_table string, metadata map<string,string>")
    known = spark.createDataFrame([("l1", "Ab", ["Ab", "AB"], "Oslo", "NO")], "unique_id string, name string, all_names array<string>, city string, country_code string")
    out = judge.judge(found, known, lambda x: '{"match": true, "reason": "%s"}' % ("All of a." in x and "email: a@b" in x and "noise" not in x and "Oslo, NO" in x), contexts=contexts).first()
    assert out["llm_match"] and out["llm_reason"] == "True"
    assert m.select(judge.useful_metadata(F.col("m")), judge.useful_aliases(F.col("m"))).first()[:] == ({"email": "a@b"}, ["x", "y", "z"])


def organizations(spark):
    names = ["Novo Alpha Labs", "Zeta Quark Research Group", "Harmon Biologics Ltd", "Kappa Fusion Energy", "Orion Delta Foods", "Mirelle Textiles GmbH"]
    ref = [(f"o{k}", n, "x", "US", ("Boston", 1.0, 2.0), [n.upper()], (f"ror{k}", None), True) for k, n in enumerate(names)] + [("gone", "Gone Corporation", "x", "US", None, None, None, False)]
    inc = [(f"m{k}", n.replace("Labs", "Laboratories"), f"s{k % 2}", "e", f"{{country=United States, city=Boston, name_aliases={n}}}") for k, n in enumerate(names)] + [("bad", "tbd", "s0", "e", None)]
    return spark.createDataFrame(ref, tables.REFERENCE), spark.createDataFrame(inc, tables.INCOMING)


def linked(spark):
    ref, inc = organizations(spark)
    a = prepare.unify(tables.scan_reference(ref), "dim_org")
    b = prepare.unify(tables.scan_incoming(inc).drop("name_clean", "name_normalized", "name_prefix_5", "name_prefix_10"), "mismatched", carry=("source_table",))
    return prepare.prepare([a, b])


def test_pipeline(spark):
    left, right = linked(spark)
    assert left.count() == 6 and right.count() == 6
    out = {r["unique_id_r"]: r for r in linkage.link(left, right).collect()}
    assert {k: out[k]["unique_id_l"] for k in (f"mis_m{i}" for i in range(1, 6))} == {f"mis_m{i}": f"dim_o{i}" for i in range(1, 6)}
    assert all(r["cluster_id"] for r in out.values() if r["match_probability"] >= 0.85) and out["mis_m1"]["source_table"] == "s1"
    done, failed = linkage.link_by_source(left, right, ["s0", "s1"])
    assert sum(x.count() for x in done) == len(out) and not failed
    final = report.final_output(linkage.link(left, right), left)
    assert final.columns == ["mismatched_id", "dim_org_id", "confidence", "source_table", "matched_org_name"] and final.count() >= 5
    rates = prepare.feature_rates(left).first()
    assert rates["soundex_rate"] == 1.0 and rates["mean_tokens"] > 1


def test_unify_uses_present_columns(spark):
    df = spark.createDataFrame([(None, "Alpha Beta", None)], "source_id string, name string, name_normalized string")
    r = prepare.unify(df, "grid").first()
    assert r["unique_id"] == "grid_None" and r["name_normalized"] is None and r["name_clean"] == "alpha beta"


def test_training(spark):
    left, right = linked(spark)
    settings = train.train(left, right, model.default_settings(["name_normalized", "country_match", "city_match"]), max_pairs=100)
    level = settings["comparisons"][0]["comparison_levels"][1]
    assert 0 <= level["m_probability"] <= 1 and level["u_probability"] > 0.01
    assert train.estimate_prior(10, 100, 100) == 0.001 and train.estimate_prior(1, 0, 5) == 0.0


def test_tokens_and_profile(spark):
    df = spark.createDataFrame([("alpha beta",), ("alpha the",), ("of",), (None,)], "name_normalized string")
    idf = tokens.token_idf(df.where("name_normalized <> 'of'"))
    out = [r["distinctive_tokens"] for r in tokens.distinctive_tokens(df, idf).orderBy("name_normalized").collect()]
    assert out == [[], ["beta", "alpha"], ["alpha"], []]
    flat = spark.createDataFrame([(str(k), 1, float(x)) for k, x in enumerate((1, 2, 3, 5))], "token string, df int, idf double")
    assert tokens.corpus_stopwords(flat, 0.25).count() == 1
    kept, removed = filter_bad_records(spark.createDataFrame([("abcd", None), ("unknown clinic", None), ("Good name", None), ("Jane Doe", "SPONSOR_INVESTIGATOR")], "name string, rp_type string"))
    assert kept.count() == 1 and sorted(r["_remove_reason"] for r in removed.collect()) == ["generic_name", "person_record", "short_name"]
    df = spark.createDataFrame([("r1", "Alpha", None), ("r2", None, None)], "ror_id string, name string, city string")
    summary = profile.exploration_summary({"dim_org": df, "grid": df, "mismatched": df}, df, df.limit(0), ["ror_id", "city"])
    assert summary["ror_overlap"]["overlapping_ror_ids"] == 2 and summary["name_quality"]["generic_names_count"] == 0


def test_streaming(spark, tmp_path):
    from orgweave.streaming.scoring import score_stream

    left, right = linked(spark)
    raw = prepare.unify(tables.scan_incoming(organizations(spark)[1]).drop("name_clean", "name_normalized", "name_prefix_5", "name_prefix_10"), "mismatched")
    raw.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(raw.schema).parquet(f"{tmp_path}/in")
    left = left.persist()
    q = score_stream(stream, left, lambda b: prepare.prepare([b], [left])[0], f"{tmp_path}/out", f"{tmp_path}/check")
    q.awaitTermination(120)
    assert spark.read.parquet(f"{tmp_path}/out").select("unique_id_r").distinct().count() >= 5


def test_steps_are_timed_and_logged(spark, caplog):
    import logging

    from orgweave.sources import progress

    with caplog.at_level(logging.INFO, logger="orgweave"):
        assert progress.query(spark, "SELECT  id FROM\n range(5)").count() == 5
        assert list(progress.progress("ab", "letters")) == ["a", "b"]
        with pytest.raises(ValueError), progress.timed("bad"):
            raise ValueError
    said = caplog.text
    assert "SELECT id FROM range(5): 5 rows" in said and "letters: 1 of 2 (50 %)" in said and "bad failed" in said


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    from types import SimpleNamespace

    from orgweave.sources.staging import shared_dir

    conf = SimpleNamespace(get=lambda k, d=None: d)
    with pytest.raises(RuntimeError):
        shared_dir(SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master="spark://host:7077")))
