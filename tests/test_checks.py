"""Generic check semantics on tiny frames (NULL handling, group vs row counts)."""
from ledgerlark.operators.checks import Check, run_checks


def test_generic_checks(spark):
    df = spark.createDataFrame(
        [(1, "a", 0.5, "x"), (1, "b", 1.5, "x"), (2, None, None, "y"), (3, "z", 0.0, None), (3, "z", 1.0, "q")],
        "k int, v string, r double, p string")
    parent = spark.createDataFrame([("x",), ("y",)], "p string")
    checks = [
        Check("t", "unique", "k"),                                        # keys 1 and 3 duplicated -> 2 groups
        Check("t", "not_null", "v"),                                      # 1 row
        Check("t", "accepted_values", "v", values=("a", "b")),            # 'z' -> 1 value; NULL passes
        Check("t", "accepted_range", "r", low=0.0, high=1.0),             # 1.5 -> 1 row; NULL passes
        Check("t", "accepted_range", "r", low=0.0, inclusive=False, name="excl"),   # 0.0 -> 1 row
        Check("t", "expression", expression="k < 3", name="expr"),       # two rows with k = 3
        Check("t", "combination", columns=("k", "v")),                    # (3, z) twice -> 1 group
        Check("t", "relationships", "p", parent=("parent", "p")),         # 'q' -> 1 row; NULL passes
    ]
    res = {r.check_name: (r.n_violations, r.status) for r in run_checks({"t": df, "parent": parent}, checks).collect()}
    assert res["unique__t__k"] == (2, "error")
    assert res["not_null__t__v"] == (1, "error")
    assert res["accepted_values__t__v"] == (1, "error")
    assert res["accepted_range__t__r"] == (1, "error")
    assert res["excl"] == (1, "error")
    assert res["expr"] == (2, "error")
    assert res["combination__t__k_v"] == (1, "error")
    assert res["relationships__t__p"] == (1, "error")


def test_raw_blank_is_missing(spark):
    df = spark.createDataFrame([("a",), ("",), (" ",), ("a",)], "request_id string")
    res = run_checks({"raw_llm_requests": df}, [
        Check("raw_llm_requests", "not_null", "request_id", severity="warn"),
        Check("raw_llm_requests", "unique", "request_id", severity="warn"),
    ]).collect()
    by = {r.kind: r for r in res}
    assert by["not_null"].n_violations == 2 and by["not_null"].status == "warn"
    assert by["unique"].n_violations == 1


def test_fused_and_row_only_paths_agree(spark):
    """Row-level checks give the same counts whether they ride in the grouped pass or run alone,
    including zero counts (a check no row violates still reports 0, not a missing row)."""
    df = spark.createDataFrame([(1, 5.0), (2, -1.0), (2, None), (4, 7.0)], "k int, r double")
    row_checks = [
        Check("t", "not_null", "r"),                                  # 1 row
        Check("t", "accepted_range", "r", low=0.0),                   # -1.0 -> 1 row
        Check("t", "expression", expression="k > 0", name="never"),   # 0 rows
    ]
    alone = {r.check_name: r.n_violations for r in run_checks({"t": df}, row_checks).collect()}
    fused = {r.check_name: r.n_violations
             for r in run_checks({"t": df}, row_checks + [Check("t", "unique", "k")]).collect()}
    assert alone == {"not_null__t__r": 1, "accepted_range__t__r": 1, "never": 0}
    assert fused == {**alone, "unique__t__k": 1}


def test_offending_groups(spark):
    """The violating groups behind the counts: duplicate keys, duplicate combinations, unlisted values."""
    from ledgerlark.operators.checks import accepted_values_violations, combination_violations, unique_violations

    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "y"), (None, "z"), (None, "z")], "k string, v string")
    assert [tuple(r) for r in unique_violations(df, "t", "k").collect()] == [("a", 2)]
    assert {tuple(r) for r in combination_violations(df, ("k", "v")).collect()} == {("a", "x", 2), (None, "z", 2)}
    assert {tuple(r) for r in accepted_values_violations(df, "v", ("x", "y")).collect()} == {("z", 2)}
