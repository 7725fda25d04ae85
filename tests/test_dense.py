"""Patterns of pairs that are counted in matrices, against those of rows of pairs."""

import random

import numpy as np
import pytest

from orgweave.functions.similarity import jaro_winkler_bytes, jaro_winkler_levels
from orgweave.operators import compare, dense, model, train


def test_levels_equal_one_by_one():
    rng = random.Random(3)
    text = lambda: bytes(rng.choice(b"abcde \xc3") for _ in range(rng.choice([0, 1, 2, 3, 5, 8, 16, 17, 31, 32, 33, 63, 64, 65, 100, 255, 256, 300])))
    a = [text() for _ in range(90)]
    b = [text() for _ in range(60)] + a[:40] + [x[::-1] for x in a[:20]] + [x[:-1] + b"z" for x in a] + [x[2:] for x in a]
    exact = np.array([[jaro_winkler_bytes(x, y) for y in b] for x in a])
    for least in ([0.8, 0.88, 0.95], [0.3, 0.55, 0.7]):
        want = (exact[..., None] >= np.array(least)).sum(axis=2)
        assert set(want.ravel()) == {0, 1, 2, 3}
        assert (jaro_winkler_levels(a, b, least) == want).all()
    assert jaro_winkler_levels([], b, [0.8]).shape == (0, len(b)) and jaro_winkler_levels(a, [], [0.8]).shape == (len(a), 0)


def _side(spark, s, seed):
    rng = random.Random(seed)
    words = ["alpha", "alpah", "beta", "betas", "university", "universty", "Élan", "gamma ray", "x", "y" * 40]
    some = lambda k: [rng.choice([*words, None]) for _ in range(rng.randrange(k))]
    rows = []
    for k in range(140):
        name = rng.choice([None, "", " ".join(rng.choice(words) for _ in range(rng.randrange(1, 4)))])
        kept = lambda x: None if rng.random() < 0.1 else x  # noqa: B023, E731
        rows.append((f"{s}{k}", name and name.upper(), name, kept(some(4)), kept(some(5)), kept(rng.choice(words)), kept(rng.choice(["A1", "B2"])), kept([name or "", *map(str, some(3))]), kept(rng.choice(["DE", "FR"])), kept(rng.choice(["oslo", "oslos", "bonn"])), rng.randrange(1, 4)))
    return spark.createDataFrame(rows, "unique_id string, name string, name_normalized string, distinctive_tokens array<string>, name_tokens array<string>, distinctive_token string, distinctive_soundex string, all_names array<string>, country_code string, city string, n int")


def test_matrices_equal_rows_of_pairs(spark, monkeypatch):
    l, r = (_side(spark, s, k) for k, s in enumerate("lr"))
    found = compare.comparisons(model.default_settings())
    assert dense.compiled(found, dict(l.dtypes))
    monkeypatch.setattr(dense, "STRIP", 7)
    for rule, cell in (("l.country_code = r.country_code AND l.city = r.city", 16), ("l.country_code = r.country_code", 2048)):
        free = [c for c in found if not c.columns & train.blocked_columns(rule)]
        columns = [*(f"gamma_{c.name}" for c in free), "n"]
        pairs = l.alias("l").selectExpr("*").join(r.alias("r"), train.F.expr(rule)).select(*(train.F.col(f"{s}.{c}").alias(f"{c}_{s}") for c in [*compare.needed_columns(free), "n"] for s in "lr"))
        want = sorted(map(tuple, train.patterns(pairs, free).select(columns).collect()))
        monkeypatch.setattr(dense, "CELL", cell)
        monkeypatch.setattr(dense.patterns, "__defaults__", (cell,))
        for least in (0, 300, 10**9):  # all keys in matrices, some, none
            assert sorted(map(tuple, train.rule_patterns(l, r, rule, free, least).select(columns).collect())) == want
    monkeypatch.setattr(dense, "DIRECT", 1)
    assert sorted(map(tuple, train.rule_patterns(l, r, rule, free, 0).select(columns).collect())) == want


def test_large_keys_make_no_rows_of_pairs(spark, monkeypatch):
    """Records of one country and city: 40,000 pairs, none of which is a row."""
    made = []
    monkeypatch.setattr(train, "add_gammas", lambda pairs, found: made.append(pairs.count()) or compare.add_gammas(pairs, found))
    sides = [spark.range(200).selectExpr(f"concat('{s}', id) AS unique_id", "concat('name ', id % 150) AS name_normalized", "'DE' AS country_code", "'bonn' AS city") for s in "lr"]
    found = compare.comparisons(model.default_settings(["name_normalized"]))
    u = {("name_normalized", k): 0.2 for k in range(5)}
    m = train.estimate_m(*sides, found, u, ["l.country_code = r.country_code AND l.city = r.city"])
    assert sum(made) == 0 and sum(m.values()) == pytest.approx(1)


def test_unknown_conditions_are_left_to_rows():
    kinds = {"x": "string", "y": "string", "t": "array<string>"}
    level = lambda sql, null=False: compare.Level(sql, is_null=null)
    build = lambda *sql: dense.compiled([compare.Comparison("c", (level("x_l IS NULL OR x_r IS NULL", True), *map(level, sql), level("ELSE")))], kinds)
    assert build("x_l = x_r") and build("jaro_winkler_similarity(x_l, x_r) >= 0.9")
    for sql in ("NOT x_l = x_r", "y_l = y_r", "x_l = y_r", "levenshtein(x_l, x_r) < 2", "x_l <> x_r", "size(t_l) = 1", "x_l = 'a'", "jaro_winkler_similarity(x_l, y_r) >= 0.9"):
        assert build(sql) is None, sql
    assert dense.compiled([compare.Comparison("c", (level("x_l = x_r"), level("ELSE")))], kinds) is None
