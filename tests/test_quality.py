import pytest

from sparkmart.operators import quality as Q
from tests.conftest import SF


def result(df):
    return {(r["check"], r["column"]): (r["failing_rows"], r["total_rows"], r["severity"], r["passed"]) for r in df.collect()}


@pytest.fixture
def table(frame):
    return frame([("a", 1), ("a", None), (None, 3), (None, 4)], "k string, v int")


def test_row_count(table):
    assert result(Q.row_count(table, "t", 4))[("row_count", "*")] == (0, 4, "error", True)
    assert result(Q.row_count(table, "t", 10))[("row_count", "*")] == (6, 4, "error", False)


def test_missing_and_critical(table):
    found = result(Q.missing_values(table, "t", ["k"]))
    assert found[("missing", "k")] == (2, 4, "error", False)
    assert found[("missing", "v")] == (1, 4, "warn", False)


def test_duplicates_treat_missing_keys_as_equal(table):
    assert result(Q.duplicates(table, "t", ["k"]))[("duplicates", "k")] == (2, 4, "warn", False)


def test_empty_table(frame):
    empty = frame([], "k string")
    assert result(Q.check_table(empty, "t", keys=["k"]))[("row_count", "*")] == (1, 0, "error", False)
    assert result(Q.null_rate_gate(empty, "t", "k", 0))[("null_rate", "k")][3] is True


def test_enforce(table, caplog):
    with pytest.raises(Q.ValidationError, match="missing on k"):
        Q.enforce(Q.check_table(table, "t", critical=["k"]))
    assert len(Q.enforce(Q.check_table(table, "t", keys=["k"]))) == 4


def test_null_rate_gate(frame):
    df = frame([("a",)] * 99 + [(None,)], "k string")
    assert result(Q.null_rate_gate(df, "t", "k", 100))[("null_rate", "k")][3] is True
    assert result(Q.null_rate_gate(df, "t", "k", 100, 0.001))[("null_rate", "k")][3] is False


def test_column_tests(table):
    assert result(Q.not_null(table, "t", ["k"]))[("not_null", "k")][0] == 2
    assert result(Q.unique(table, "t", "k"))[("unique", "k")] == (1, 2, "error", False)
    assert result(Q.accepted_values(table, "t", "k", ["b"]))[("accepted_values", "k")][0] == 2


def test_mart_gate(frame):
    marts = {
        "brand_revenue": frame([("a",)], "brand string"),
        "product_revenue": frame([(str(i),) for i in range(9)], "product_name string"),
        "monthly_traffic": frame([(str(i),) for i in range(5)], "month string"),
    }
    failed = {r["table"] for r in Q.mart_gate(marts).collect() if not r["passed"]}
    assert failed == {"product_revenue"}


def test_require_unique(frame):
    Q.require_unique(frame([("a",), ("b",)], "k string"), "t", ["k"])
    with pytest.raises(Q.ValidationError, match="duplicates on k"):
        Q.require_unique(frame([("a",), ("a",)], "k string"), "t", ["k"])


def test_registered_mart_gate_sees_every_mart(spark, monkeypatch):
    """A product mart with fewer rows than it must have fails the query, though the brand mart is fine."""
    from sparkmart.plans import layer_queries

    whole = layer_queries.product_revenue
    monkeypatch.setattr(layer_queries, "product_revenue", lambda *a: whole(*a).limit(3))
    rows = layer_queries.R.queries["q_dq_mart_gate_all"].run(spark, SF).collect()
    assert {(r["table"], r["check"]) for r in rows if not r["passed"]} == {("product_revenue", "row_count")}
    assert {r["table"] for r in rows} == {"brand_revenue", "product_revenue", "monthly_traffic"}


def test_constraint_suite(frame, capsys):
    a = frame([("x", 1), ("x", None), (None, 3), (None, None)], "k string, v int")
    b = frame([], "k string, v int")
    asked = [
        *Q.declare("a", ["k", "v"], "k"),
        Q.Constraint("a", "k", "accepted_values", Q.WARN, ("y",)),
        *Q.declare("b", ["v"], "k"),
    ]
    suite = Q.constraint_suite({"a": a, "b": b}, asked)
    found = {(r["table"], r["check"], r["column"]): (r["failing_rows"], r["total_rows"], r["passed"]) for r in suite.collect()}
    assert found == {
        ("a", "not_null", "k"): (2, 4, False),
        ("a", "not_null", "v"): (2, 4, False),
        ("a", "accepted_values", "k"): (2, 4, False),
        ("a", "unique", "k"): (1, 2, False),
        ("b", "not_null", "v"): (0, 0, True),
        ("b", "unique", "k"): (0, 0, True),
    }
    with pytest.raises(Q.ValidationError):
        Q.enforce(suite)
    with pytest.raises(ValueError):
        Q.constraint_suite({"a": a}, asked)
    with pytest.raises(ValueError):
        Q.constraint_suite({"a": a}, [Q.Constraint("a", "k", "positive")])


def test_constraint_suite_scans_a_table_once(spark, tmp_path, capsys):
    path = str(tmp_path / "t")
    spark.range(100).selectExpr("id AS k", "id % 7 AS v").write.parquet(path)
    asked = [*Q.declare("t", ["k", "v"], "k"), Q.Constraint("t", "v", "accepted_values", Q.WARN, ("1",))]
    capsys.readouterr()
    Q.constraint_suite({"t": spark.read.parquet(path)}, asked).explain("formatted")
    plan = capsys.readouterr().out.split("\n\n")[0]
    assert plan.count("Scan parquet") == 1
