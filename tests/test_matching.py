from pyspark.sql import functions as F

from verigrid.operators import mapping, matching, resolve


def table(df, key, *cols):
    return {r[key]: tuple(r[c] for c in cols) for r in df.collect()}


def test_waterfall_claims_and_shared_fallbacks(spark):
    rows = [
        ("exact", 1, "T1"), ("exact", 3, "T9"),  # a primary row ignores its fallbacks
        ("late", 3, "T1"),  # T1 is claimed, so nothing is left
        ("late2", 4, "T1"), ("late2", 4, "T5"),  # the unclaimed candidate remains
        ("twin1", 3, "T2"), ("twin2", 4, "T2"),  # two fallbacks on one target
        ("two", 2, "T3"), ("two", 2, "T4"),  # ambiguous primary claims nothing
        ("free", 3, "T3"), ("rank", 3, "T6"), ("rank", 4, "T7"),
    ]
    data = [(r, k, f"M{k}", t) for r, k, t in rows]
    got = table(
        matching.match_waterfall(spark.createDataFrame(data, "row_id string, match_rank int, match_method string, target string"), "row_id"),
        "row_id", "match_rank", "candidate_count", "target", "target_claim_count",
    )
    assert got == {
        "exact": (1, 1, "T1", 1), "late2": (4, 1, "T5", 1), "twin1": (3, 1, "T2", 2), "twin2": (4, 1, "T2", 2),
        "two": (2, 2, "T4", 1), "free": (3, 1, "T3", 1), "rank": (3, 1, "T6", 1),
    }


def test_carry_context_fails_closed(spark):
    roles = [
        (1, "NORMAL_LEAF_CANDIDATE", None), (2, "RESOLVED_HEADING", "A"), (3, "NORMAL_LEAF_CANDIDATE", None),
        (4, "UNRESOLVED_HEADING_LIKE", None), (5, "NORMAL_LEAF_CANDIDATE", None), (6, "UNRESOLVED_HEADING_LIKE", None),
        (7, "RESOLVED_HEADING", "B"), (8, "NORMAL_LEAF_CANDIDATE", None),
    ]
    df = spark.createDataFrame([("f", "s", n, r, h) for n, r, h in roles], "file string, sheet string, row_no long, row_role string, heading_code string")
    for block in (1, 3, 1000):
        got = table(matching.carry_context(df, F.lit("OWN"), block), "row_no", "locality_code", "follows_unresolved")
        assert got == {
            1: ("OWN", False), 2: ("A", False), 3: ("A", False), 4: (None, False), 5: (None, True), 6: (None, True),
            7: ("B", False), 8: ("B", False),
        }


def test_precedence_does_not_fall_through_but_area_does(spark):
    rows = spark.createDataFrame([("a",), ("b",), ("c",), ("d",), ("e",)], "k string").withColumns(
        {"ok": F.lit(True), "out": F.col("k") == "e"}
    )
    cand = lambda pairs: spark.createDataFrame(pairs or [("-", 0)], "k string, target int")
    candidates = {
        "manual": cand([("a", 1), ("e", 1)]), "exact": cand([("b", 2)]), "alias": cand([("c", 3), ("c", 4)]),
        "spatial": cand([("a", 9), ("b", 2), ("c", 3), ("d", 5), ("d", 6), ("e", 7)]),
    }
    labels = {"manual": ("M", "Q1"), "exact": ("E", "Q2"), "alias": ("A", "Q3"), "spatial": ("S", "Q4")}
    strict = matching.precedence(rows, candidates, "k", F.col("out"), labels, "spatial", F.col("ok"), F.lit(False))
    assert table(strict, "k", "mapping_method", "accepted_target", "match_status") == {
        "a": ("M", 1, "MATCHED_WITH_CONFLICT"), "b": ("E", 2, "MATCHED"), "c": ("A", None, "AMBIGUOUS"),
        "d": ("S", None, "AMBIGUOUS"), "e": ("NON_GEOGRAPHIC_RULE", None, "NON_GEOGRAPHIC"),
    }
    area = matching.area_precedence(rows, candidates, "k", F.col("out"), F.col("ok"))
    assert table(area, "k", "mapping_method", "area_key", "match_status") == {
        "a": ("MANUAL_EXCEPTION", 1, "MATCHED_WITH_CONFLICT"), "b": ("COORDINATE_BOUNDARY", 2, "MATCHED"),
        "c": ("COORDINATE_BOUNDARY", 3, "MATCHED"), "d": ("NONE", 0, "AMBIGUOUS"), "e": ("NON_GEOGRAPHIC", 0, "NON_GEOGRAPHIC"),
    }


def test_resolution_by_extremes_equals_distinct_counts(spark):
    data = [("a", "x", 1.0), ("a", "x", 1.0), ("b", "x", None), ("b", "y", 2.0), ("c", None, None), ("d", "z", 3.0)]
    df = spark.createDataFrame(data, "k string, v string, m double")
    got = resolve.resolve_attributes(df, ["k"], {"v": F.col("v")}, money={"m": F.col("m")}, distinct_counts=True)
    assert table(got, "k", "v", "v_resolution_status", "distinct_v_count", "m", "m_resolution_status") == {
        "a": ("x", "RESOLVED", 1, 1.0, "RESOLVED_REPEATED_IDENTICAL"), "b": (None, "CONFLICT", 2, 2.0, "RESOLVED_SINGLE"),
        "c": (None, "MISSING", 0, None, "MISSING"), "d": ("z", "RESOLVED", 1, 3.0, "RESOLVED_SINGLE"),
    }


def test_mapping_gate(spark):
    import pytest

    schema = "k string, v string, approval_status string, is_active boolean"
    rules = lambda rows: spark.createDataFrame(rows, schema)
    good = rules([("a", "1", "APPROVED", True), ("a", "2", "PENDING_REVIEW", True), ("b", "0", "APPROVED", False)])
    assert mapping.active_mapping(good, "v", ["k"]).count() == 1
    for bad in (
        [("a", "1", "APPROVED", True), ("b", "2", "APPROVED", True)],
        [("a", "1", "APPROVED", True), ("a", "1", "APPROVED", True)],
    ):
        with pytest.raises(Exception, match="mapping cannot act"):
            mapping.active_mapping(rules(bad), "v", ["k"]).collect()
    state = mapping.mapping_state(rules([("a", "1", "PENDING_REVIEW", True)]), "v", ["k"]).first()
    assert state.mapping_state == "NO_ACTIVE_VERSION"


def test_token_classes(spark):
    rules = spark.createDataFrame([("r", "Road", False), ("f", "Flood", True)], "token string, sector string, is_flagged boolean")
    df = spark.createDataFrame([(1, ["r"]), (2, ["f", "r"]), (3, ["r", "zz"]), (4, []), (5, ["r"])], "id int, tokens array<string>")
    got = table(mapping.classify_tokens(df, "tokens", rules), "id", "standardized_sector", "is_flagged", "category_classification_status")
    assert got == {
        1: ("Road", False, "MAPPED_SINGLE"), 2: ("Multi-sector", True, "MAPPED_MULTI"), 3: (None, None, "UNAPPROVED_SOURCE_CATEGORY"),
        4: (None, None, "MISSING_SOURCE_CATEGORY"), 5: ("Road", False, "MAPPED_SINGLE"),
    }
