"""The default model: nine comparisons with their trained parameters, as settings."""

from __future__ import annotations

from .blocking import PREDICTION_RULES

PRIOR = 1e-6

_INTERSECT = "size(array_intersect({0}_l, {0}_r))"
_BOTH_DISTINCT = _INTERSECT.format("distinctive_tokens")
_BOTH_NAME = _INTERSECT.format("name_tokens")
_SIZES = "size(name_tokens_l)", "size(name_tokens_r)"


def _subset(a: str, b: str) -> str:
    return f"({_BOTH_NAME} = size({a}) AND size({a}) < size({b}))"


def _alias(a: str, b: str) -> str:
    return f"array_contains(transform(all_names_{b}, x -> lower(x)), lower(name_{a}))"


def _jw(column: str, least: float) -> str:
    return f"jaro_winkler_similarity({column}_l, {column}_r) >= {least}"


# For each comparison its column, and for each level its condition and the trained m and u.
LEVELS = {
    "name_normalized": ("name_normalized", [
        ("=", 0.09439256709082217, 9.641283977993769e-06),
        (_jw("name_normalized", 0.95), 0.0018490114964220556, 2.008600828748702e-06),
        (_jw("name_normalized", 0.88), 0.04602048653797184, 0.00013839259710078558),
        (_jw("name_normalized", 0.8), 0.29021342199310873, 0.0016995775912457141),
        ("ELSE", 0.4618190209646907, 0.9981503799268467)]),
    "phonetic_match": ("distinctive_soundex", [
        ("=", 0.4072576818327149, 0.001050291343259096),
        ("ELSE", 0.8398952775981493, 0.9989497086567409)]),
    "distinctive_match": ("distinctive_tokens", [
        ("size(distinctive_tokens_l) = 0 OR size(distinctive_tokens_r) = 0", 0.00011201233515597098, 0.0012670255300624397),
        (f"{_BOTH_DISTINCT} >= 2", 0.0942440403729413, 4.839194179794738e-05),
        (f"{_BOTH_DISTINCT} >= 1", 0.5600069570318617, 0.0020418989881465844),
        ("ELSE", 0.7428407956687446, 0.9966426835399931)]),
    "token_overlap": ("distinctive_tokens", [
        (f"{_BOTH_DISTINCT} >= 2", 0.0942440403729413, 4.839194179794738e-05),
        (f"{_BOTH_DISTINCT} >= 1", 0.5600069570318617, 0.0020418989881465844),
        ("ELSE", 0.3719772177851761, 0.9979097090700555)]),
    "containment_check": ("name_tokens", [
        ("array_sort(name_tokens_l) = array_sort(name_tokens_r)", 0.12192737915195988, 9.738627291288165e-06),
        (f"abs({_SIZES[0]} - {_SIZES[1]}) <= 1 AND {_BOTH_NAME} >= greatest({_SIZES[0]}, {_SIZES[1]}) - 1", 0.048415739684973765, 0.025987376329473223),
        (f"least({_SIZES[0]}, {_SIZES[1]}) <= 2 AND {_BOTH_NAME} >= 1", 0.11122311416343231, 0.0075115939863876074),
        (f"{_subset('name_tokens_l', 'name_tokens_r')} OR {_subset('name_tokens_r', 'name_tokens_l')}", 0.0016796342507550649, 0.0002710751926441036),
        ("ELSE", 0.7196209073634167, 0.9662202158642038)]),
    "first_token_match": ("distinctive_token", [
        ("=", 0.2794808570283122, 0.00017179822986502632),
        (_jw("distinctive_token", 0.9), 0.0033523004041527485, 0.00021070163241491816),
        (_jw("distinctive_token", 0.8), 0.007970203952620773, 0.0014467642622688465),
        ("ELSE", 0.8356182396555814, 0.9981707358754512)]),
    "alias_match": ("all_names", [
        (f"{_alias('l', 'r')} OR {_alias('r', 'l')}", 0.12142201698403544, 7.630264681834026e-06),
        ("ELSE", 0.8785779830159646, 0.9999923697353181)]),
    "country_match": ("country_code", [
        ("=", 0.7398051792775071, 0.1056003954988312),
        ("ELSE", 0.2601948207224929, 0.8943996045011688)]),
    "city_match": ("city", [
        ("=", 0.21539509444041485, 0.0018939023216589758),
        (_jw("city", 0.9), 0.00023753662236233032, 0.00013090222215697501),
        ("ELSE", 0.7828077506196068, 0.9979751954561841)]),
}


def default_settings(names: list[str] | None = None) -> dict:
    """Settings of the default model, or of some of its comparisons."""
    found = []
    for name, (column, levels) in LEVELS.items():
        if names is not None and name not in names:
            continue
        rows: list[dict] = [{"sql_condition": f"{column}_l IS NULL OR {column}_r IS NULL", "is_null_level": True}]
        for condition, m, u in levels:
            exact = condition == "="
            row = {"sql_condition": f"{column}_l = {column}_r" if exact else condition, "m_probability": m, "u_probability": u}
            rows.append(row | ({"tf_adjustment_column": column, "tf_adjustment_weight": 1.0} if exact and name == "name_normalized" else {}))
        found.append({"output_column_name": name, "comparison_levels": rows})
    return {
        "link_type": "link_only",
        "probability_two_random_records_match": PRIOR,
        "em_convergence": 1e-4,
        "max_iterations": 25,
        "unique_id_column_name": "unique_id",
        "blocking_rules_to_generate_predictions": [{"blocking_rule": r} for r in PREDICTION_RULES],
        "comparisons": found,
    }
