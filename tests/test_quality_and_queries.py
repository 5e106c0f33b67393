"""Gate rules on a contaminated batch, scoring contract, batch duplicates and a
smoke run of every registered query at sf0.001."""

import os

import pytest
from pyspark.sql import functions as F

from telemetra.jobs import registry
from telemetra.operators import quality as Q

FIELDS = ["device", "batch", "grade", "inlet", "outlet", "flow", "load", "hours", "tripped", "valve", "seal"]
SCHEMA = ("device long, batch long, grade string, inlet double, outlet double, flow double, load double, hours long, "
          "tripped int, valve int, seal int")
SPEC = Q.GateSpec(required_columns=FIELDS, min_rows=20, numeric_columns=["inlet", "outlet", "flow", "load", "hours"],
                  categories={"grade": ["S", "T"]}, binary_columns=["tripped", "valve", "seal"], id_columns=[("device", "batch")],
                  positive_columns=["inlet", "outlet", "flow"], nonnegative_columns=["load", "hours"],
                  ordered_pair=("inlet", "outlet"), target="tripped", modes=["valve", "seal"])


def _rows():
    return [dict(zip(FIELDS, (k, k % 4, "ST"[k % 2], 20.0 + k, 31.0 + k, 3.5, 0.0, 7 * k, int(k % 8 == 0), int(k % 8 == 0), 0)))
            for k in range(24)]


def _verdicts(spark, rows, schema=SCHEMA, spec=SPEC):
    names = [c.split()[0] for c in schema.split(", ")]
    df = spark.createDataFrame([tuple(r[n] for n in names) for r in rows], schema)
    return df, {r["rule"]: r for r in Q.gate_rules(df, spec).collect()}


def test_clean_batch_passes(spark):
    df, rules = _verdicts(spark, _rows())
    assert all(r["passed"] for r in rules.values()) and len(rules) == 12
    assert Q.gate_verdict(Q.gate_rules(df, SPEC)).first()["gate_passed"] is True
    assert Q.gate_offenders(df, SPEC).count() == 0


@pytest.mark.parametrize("rule, failing, change", [
    ("min_rows", 0, lambda rows: rows[:19]),
    ("missing_rate", 3, lambda rows: [r | ({"flow": None, "grade": None} if i == 7 else {"load": float("nan")} if i == 9 else {})
                                      for i, r in enumerate(rows)]),
    ("missing_markers", 2, lambda rows: [r | ({"grade": " null "} if i in (3, 20) else {}) for i, r in enumerate(rows)]),
    ("duplicate_rate", 3, lambda rows: rows + [rows[11], rows[11], rows[23]]),
    ("unique_ids", 1, lambda rows: rows + [rows[2] | {"hours": 999}]),
    ("allowed_categories", 2, lambda rows: [r | ({"grade": "U"} if i < 5 else {"grade": "V"} if i == 6 else {}) for i, r in enumerate(rows)]),
    ("binary_domain", 2, lambda rows: [r | ({"seal": 4} if i == 1 else {"seal": -1} if i == 22 else {}) for i, r in enumerate(rows)]),
    ("physical_ranges", 4, lambda rows: [r | ({"outlet": 0.0} if i == 10 else {"hours": -2} if i == 13 else {"flow": -1.0} if i == 17
                                              else {}) for i, r in enumerate(rows)]),
    ("target_classes", 0, lambda rows: [r | {"tripped": 0, "valve": 0} for r in rows]),
    ("label_consistency", 2, lambda rows: [r | ({"seal": 1} if i in (5, 6) else {}) for i, r in enumerate(rows)])])
def test_each_rule_names_its_fault(spark, rule, failing, change):
    _, rules = _verdicts(spark, change(_rows()))
    assert not rules[rule]["passed"] and rules[rule]["failing"] == failing, rules[rule]
    assert rules["schema"]["passed"] and rules["numeric_types"]["passed"]


def test_schema_and_type_faults_of_one_batch(spark):
    rows = [r | {"flow": f"{r['flow']} l/s", "colour": "red", "grade": "W" if r["device"] == 4 else r["grade"]} for r in _rows()]
    schema = SCHEMA.replace("hours long, ", "").replace("flow double", "flow string") + ", colour string"
    df, rules = _verdicts(spark, rows, schema)
    assert rules["schema"]["failing"] == 2 and "hours" in rules["schema"]["detail"] and "colour" in rules["schema"]["detail"]
    assert rules["numeric_types"]["failing"] == 2 and rules["allowed_categories"]["failing"] == 1
    assert [tuple(r) for r in Q.gate_offenders(df, SPEC).collect()] == [("allowed_categories", "grade", "W", 1)]
    report = Q.gate_report(Q.gate_rules(df, SPEC), Q.gate_offenders(df, SPEC)).first()
    assert report["failed"] == "allowed_categories,numeric_types,schema" and not report["gate_passed"]
    assert '"value":"W","count":1' in report["offenders"] and "schema:2" in report["failing"]


@pytest.mark.parametrize("sent", [0, 1 << 20])
def test_duplicates_by_fingerprint_and_forced_collisions(spark, monkeypatch, sent):
    monkeypatch.setattr(Q, "SENT_FINGERPRINTS", sent)
    rows = [(1, "a", None), (1, "a", None), (2, None, 1.0), (None, "a", 1.0), (2, None, 1.0), (2, None, 1.0), (3, "c", 0.5)]
    df = spark.createDataFrame(rows, "x int, y string, z double")
    one = lambda cols: [F.lit(1).cast("long"), F.lit(2).cast("long")]
    for found in (Q.duplicate_rows(df), Q.duplicate_rows(df, fingerprint=one)):
        assert tuple(found.first())[:2] == (7, 3)
    assert Q.duplicate_rows(df, ["z"]).first()["duplicate_rows"] == 4
    assert Q.duplicate_rows(df.limit(0)).first()["duplicate_rate"] == 1.0
    assert {r["id_column"]: r["duplicates"] for r in Q.id_duplicates(df, ["x", ("x", "y"), "z"]).collect()} == {"x": 3, "x+y": 3, "z": 4}


def test_markers_are_counted_case_insensitive(spark):
    df = spark.createDataFrame([(" NA ",), ("?",), ("ok",), (None,)], "c string")
    assert Q.markers_by_column(df).first()["markers"] == 2


def test_contract_names_the_field(spark):
    df = spark.createDataFrame([("M", "300.5", "42.1"), ("X", "1.0", "2.0"), ("L", "abc", "1.0"),
                                ("L", "-100", None)], "Type string, speed string, torque string")
    out = Q.contract_violations(df, "Type", ["L", "M", "H"], ["speed"], ["torque"]).collect()
    assert out[0]["valid"]
    assert out[1]["violations"] == ["Type:category"]
    assert out[2]["violations"] == ["speed:type"]
    assert set(out[3]["violations"]) == {"speed:gt0", "torque:required"}


def test_contract_over_a_payload(spark):
    df = spark.createDataFrame([({"t": "M", "v": "1"},), ({"t": "M", "v": "nan", "w": "1", "a": "2"},), ({"v": "x"},), (None,)],
                               "p map<string,string>")
    out = Q.contract_violations(df, "t", ["M"], ["v"], [], payload="p").collect()
    assert [r["violations"] for r in out] == [[], ["v:finite", "a:unexpected", "w:unexpected"], ["t:required", "v:type"],
                                              ["t:required", "v:required"]]
    assert out[0]["valid"] and set(out[0].asDict()) == {"p", "violations", "valid"}


def test_batch_duplicates_point_to_first(spark):
    df = spark.createDataFrame([(1, 1, "M", 1.0), (1, 2, "M", 1.0), (1, 3, "L", 2.0), (2, 1, "M", 1.0), (1, 4, None, None),
                                (1, 7, None, None), (1, 7, None, None), (2, 5, "K", 1.0), (2, 5, "K", 1.0), (2, 5, "K", 1.0)],
                               "batch int, row_no int, t string, v double")
    d = Q.batch_duplicates(df, "batch", "row_no", ["t", "v"])
    assert sorted((r["batch"], r["row_no"], r["copies"], r["first_row"]) for r in d.collect()) == [
        (1, 2, 1, 1), (1, 7, 2, 4), (2, 5, 2, 5)]
    text = {r["batch"]: r for r in Q.duplicate_message(d, "batch", "row_no", 1).collect()}
    assert text[1]["message"] == "2->1" and text[1]["duplicate_rows"] == 3 and text[1]["originals"] == 2
    many = spark.createDataFrame([(1, i, "M", 1.0) for i in range(3000)], "batch int, row_no int, t string, v double")
    assert Q.batch_duplicates(many, "batch", "row_no", ["t", "v"]).count() == 2999


def test_sequence_gaps(spark):
    df = spark.createDataFrame([(v,) for v in [1, 2, 2, 3, 5, 6, 9]], "id long")
    # sorted diffs: 1,0,1,2,1,3 -> three differ from 1
    assert Q.sequence_gaps(df, "id").first()["gaps"] == 3


QUICK = [n for n in registry.queries() if not n.startswith(("e2_", "e4_"))]


@pytest.mark.parametrize("name", QUICK)
def test_registered_query_runs(spark, name):
    df = registry.queries()[name](spark, "/root/testdata/sf0.001")
    assert df.columns
    df.limit(5).collect()


def test_every_query_has_oracle_or_is_rows_only():
    rows_only = set(registry.queries()) - set(registry.oracle_sql())
    assert rows_only <= {"e2_iforest_embeddings", "e4_ocsvm_embeddings", "e3_neighbour_recall_customers"}
