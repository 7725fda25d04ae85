"""Every registered query of the engine's own operators, held against its SQL in DuckDB."""

import duckdb
import pandas as pd
import pytest

from orgweave.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = "nation customer supplier part orders events documents labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{FOLDER}/{t}.parquet')")
    return con


def rows(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]
    return sorted(tuple("~" if pd.isna(v) else str(v) for v in r) for r in df.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    found = QUERIES[name](spark, FOLDER).toPandas()
    if name in ORACLE:
        want = duck.sql(ORACLE[name]).df()
        assert sorted(found.columns) == sorted(want.columns)
        assert rows(found) == rows(want)
    else:
        assert len(found)


def test_entry_point(spark):
    import __spark_entry__ as e

    assert set(QUERIES) <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).columns == ["unique_id_l", "unique_id_r", "match_weight", "match_probability"]


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """Documents whose names spell one sound in several ways: some pairs meet by the fourth rule alone."""
    names = ["Smith Valley Works", "Smyth Harbour Trust", "Katherine Road Lab", "Catherine Mill Group", "Robert Hill Press", "Rupert Lake House"]
    rows = [(k, f"{names[k % 6]} {'abcdefgh'[k % 8]}", "en", "web" if k % 5 < 3 else "books", 1) for k in range(80)]
    folder = str(tmp_path_factory.mktemp("planted"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    return folder


def test_whole_model_equals_brute_force(spark, planted):
    from orgweave.queries import _FOUND, _tokens

    l, r = ([x.asDict() for x in side.collect()] for side in _tokens(spark, planted))
    same = lambda a, b, *c: all(a[x] is not None and a[x] == b[x] for x in c)
    want = {}
    for a in l:
        for b in r:
            near = a["name_normalized"][:25] == b["name_normalized"][:25] and same(a, b, "country_code")
            rules = [same(a, b, "name_normalized"), near, same(a, b, "distinctive_token", "city"), same(a, b, "name_metaphone", "country_code", "city")]
            if any(rules):
                want[a["unique_id"], b["unique_id"]] = rules.index(True), int(a["distinctive_soundex"] == b["distinctive_soundex"])
    assert any(k == 3 for k, _ in want.values())
    pairs = [(x["unique_id_l"], x["unique_id_r"], x["match_key"]) for x in QUERIES["block_union_dedup"](spark, planted).collect()]
    assert sorted(pairs) == sorted((*p, k) for p, (k, _) in want.items())
    gammas = {(x["unique_id_l"], x["unique_id_r"]): x["gamma_phonetic_match"] for x in QUERIES["gamma_vectors"](spark, planted).collect()}
    assert gammas == {p: g for p, (_, g) in want.items()}
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{planted}/documents.parquet/*.parquet')")
    for name in ("block_union_dedup", "score_pairs", "score_waterfall"):
        assert rows(QUERIES[name](spark, planted).toPandas()) == rows(duck.sql(ORACLE[name]).df())
    steps = {x["step"] for x in QUERIES["score_waterfall"](spark, planted).collect()}
    assert steps == {"prior", *(c.name for c in _FOUND)}


def test_training_equals_plain_python(spark, planted):
    """Expectation maximisation pair by pair, without patterns and arrays."""
    from statistics import median

    from orgweave.operators import blocking, compare, train
    from orgweave.queries import _FOUND, _NEED, _tokens

    keys = sorted({c for rule in blocking.TRAINING_RULES for c in train.blocked_columns(rule)})
    every = blocking.block(*_tokens(spark, planted), ["true"], sorted({*_NEED, *keys}))
    pairs = [x.asDict() for x in compare.add_gammas(every, _FOUND).collect()]
    gamma = lambda x, c: x[f"gamma_{c.name}"]
    u = {c.name: [sum(gamma(x, c) == k for x in pairs) / sum(gamma(x, c) >= 0 for x in pairs) for k in range(len(c.gammas))] for c in _FOUND}
    seen = {}
    for rule in blocking.TRAINING_RULES:
        by = train.blocked_columns(rule)
        met = [x for x in pairs if all(x[f"{c}_l"] is not None and x[f"{c}_l"] == x[f"{c}_r"] for c in by)]
        free = [c for c in _FOUND if not c.columns & by]
        start = {c.name: [(1 + 9 * k / max(len(c.gammas) - 1, 1)) ** 2 for k in range(len(c.gammas))] for c in free}
        m, prior = {k: [x / sum(v) for x in v] for k, v in start.items()}, 0.3
        for _ in range(25 if met else 0):
            share = []
            for x in met:
                a, b = prior, 1 - prior
                for c in free:
                    if gamma(x, c) >= 0:
                        a, b = a * m[c.name][gamma(x, c)], b * max(u[c.name][gamma(x, c)], 1e-9)
                share.append(a / max(a + b, 1e-300))
            new = {}
            for c in free:
                total = sum(p for p, x in zip(share, met, strict=True) if gamma(x, c) >= 0)
                new[c.name] = [sum(p for p, x in zip(share, met, strict=True) if gamma(x, c) == k) / total for k in range(len(c.gammas))] if total else m[c.name]
            change = max(abs(a - b) for k in new for a, b in zip(new[k], m[k], strict=True))
            m, prior = new, min(max(sum(share) / len(met), 1e-12), 1 - 1e-12)
            if change < 1e-4:
                break
        for c in free:
            for k in {gamma(x, c) for x in met} - {-1}:
                seen.setdefault((c.name, k), []).append(m[c.name][k])
    found = {(x["comparison"], x["gamma"]): x["m"] for x in QUERIES["em_m_estimates"](spark, planted).collect()}
    assert found.keys() == seen.keys() and {c for c, _ in found} >= {"phonetic_match"}
    assert all(v == pytest.approx(median(seen[k]), abs=1e-9) for k, v in found.items())


def test_negatives_follow_positives(spark, tmp_path):
    # 24 copies of one text make 144 positives, so 288 draws and not 400
    texts = [(k, "same text here" if k % 20 < 12 and k < 40 else f"text number {k}", "en", "web", 1) for k in range(400)]
    spark.createDataFrame(texts, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    found = QUERIES["negative_pairs_hash"](spark, str(tmp_path)).toPandas()
    assert 250 < len(found) <= 288
    assert rows(found) == rows(duck.sql(ORACLE["negative_pairs_hash"]).df())
    out = {x["threshold"]: x for x in QUERIES["labelled_metrics"](spark, str(tmp_path)).collect()}
    assert all(x["tp"] + x["fn"] == 144 and x["fp"] + x["tn"] == len(found) for x in out.values())


def test_similarity_of_names_that_begin_apart(spark, duck):
    from orgweave.functions.similarity import add_similarity

    names = duck.sql("SELECT DISTINCT p_name FROM part ORDER BY 1 LIMIT 60").fetchall() + [("almond steel",), ("lamond steel",)]
    names = [n for n, in names]
    found = add_similarity(spark.createDataFrame([(a, b) for a in names for b in names], "a string, b string"), "a", "b", "similarity").collect()
    assert {(x["a"], x["b"]): x["similarity"] for x in found}["almond steel", "lamond steel"] > 0.9
    want = {(x["a"], x["b"]): duck.execute("SELECT jaro_winkler_similarity(?, ?)", [x["a"], x["b"]]).fetchone()[0] for x in found}
    assert all(x["similarity"] == pytest.approx(want[x["a"], x["b"]], abs=1e-12) for x in found)
