import json
from pathlib import Path

from shiftroll.operators import asof, drift
from shiftroll.sources import routes
from shiftroll.sources.tables import append_report, read_columns_csv, read_source, write_drift


def test_schema_drift(spark, rows):
    expected = spark.createDataFrame(
        [("t", "a"), ("t", "b"), ("gone", "x"), ("same", "a")], "table_name string, column_name string"
    )
    t = spark.createDataFrame([(1, None, "u"), (2, 5, "v")], "a int, extra int, _updated_on string")
    other = spark.createDataFrame([(1,)], "z int")
    got = drift.schema_drift(expected, {"t": t, "other": other, "same": t.select("a")})
    assert rows(got) == [
        ("gone", None, "missing_table", None),
        ("t", "b", "missing_column", None),
        ("t", "extra", "unexpected_column", 1),
    ]


def test_no_drift(spark):
    t = spark.range(3)
    expected = spark.createDataFrame([("t", "id")], "table_name string, column_name string")
    assert drift.schema_drift(expected, {"t": t}).count() == 0


def test_drift_of_a_column_list_file(spark, tmp_path, rows):
    path = tmp_path / "columns.csv"
    path.write_text("co,t,a\nco,t,updated_on\n\nco,u,a\n")
    actual = read_columns_csv(spark, str(path))
    expected = spark.createDataFrame([("t", "a"), ("t", "b")], "table_name string, column_name string")
    got = drift.column_drift(expected, actual)
    assert rows(got) == [("t", "b", "missing_column"), ("t", "updated_on", "unexpected_column")]
    out = tmp_path / "drift"
    write_drift(got, str(out))
    lines = [json.loads(line) for part in Path(out).glob("part-*.json") for line in part.open()]
    assert sorted(x["column_name"] for x in lines) == ["b", "updated_on"]


def test_report_tables_grow_per_tenant(spark, tmp_path):
    path = str(tmp_path / "report")
    append_report(spark.createDataFrame([("a", 1)], "tenant string, n int"), path)
    append_report(spark.createDataFrame([("a", 2), ("b", 3)], "tenant string, n int"), path)
    assert spark.read.parquet(path).count() == 3
    assert sorted(p.name for p in Path(path).glob("tenant=*")) == ["tenant=a", "tenant=b"]


def test_read_source_from_folder_or_database(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "co" / "t"))
    assert read_source(spark, str(tmp_path / "co"), "t").count() == 3
    spark.range(4).createOrReplaceTempView("co_t")
    assert spark.table("co_t").count() == 4


def test_routes(spark, rows):
    mapped = routes.migration_map(spark, [("b", "pb", "two", 2, 5), ("a", "pa", "one", 1)])
    assert [tuple(r) for r in routes.routes(mapped).collect()] == [
        ("a", "pa", "one", 1, 1, "tenant_one"),
        ("b", "pb", "two", 2, 5, "tenant_two"),
    ]
    assert routes.migration_map(spark, [("a", "other", "x", 9)], existing=mapped).count() == 0
    table = spark.createDataFrame([("a", 1), ("b", 2), ("unmapped", 3)], "s string, v int")
    assert rows(routes.attach_route(table, mapped, "s"), "v", "tenant", "payroll_number") == [
        (1, "tenant_one", 1), (2, "tenant_two", 5),
    ]
    by_payroll = spark.createDataFrame([("pb", 4)], "s string, v int")
    assert rows(routes.attach_route(by_payroll, mapped, "s", "payroll"), "v", "tenant") == [(4, "tenant_two")]


def dated(spark):
    return spark.createDataFrame(
        [(1, 7, "active", 1, "2024-01-01", "2024-01-02"), (2, 7, "terminated", 2, "2024-01-10", "2024-01-09"),
         (3, 7, "suspended", 2, "2024-01-10", "2024-01-09"), (4, 7, "active", 1, "2024-02-01", "2024-01-01"),
         (5, 8, "active", 1, "2024-01-15", "2024-01-15"), (6, 9, "active", 1, "2024-01-16", "2024-01-15")],
        "id long, employee_id long, status string, payroll_id int, effective_from string, recorded_at string",
    )


def test_as_of_takes_latest_then_recorded_then_id(spark, rows):
    got = asof.as_of(dated(spark), ["employee_id"], "2024-01-15")
    assert rows(got, "employee_id", "id", "status") == [(7, 3, "suspended"), (8, 5, "active")]


def test_worklist_and_payable(spark, rows):
    pending = spark.createDataFrame([(8,), (20,), (20,)], "employee_id long")
    work = asof.worklist(dated(spark), pending, 1, "2024-01-15")
    assert rows(work) == [(20,), (8,)]
    everyone = asof.worklist(dated(spark), pending, 2, "2024-01-15")
    assert rows(asof.payable(everyone, dated(spark), "2024-01-15")) == [
        (20, "active", 1), (7, "suspended", 0), (8, "active", 1),
    ]


def test_ytd_basis(spark, rows):
    ledger = spark.createDataFrame([(1, "X", 5)], "employee_id long, code string, amount_minor long")
    facts = spark.createDataFrame(
        [(1, "X", 100), (2, "X", 1), (2, "X", 2), (2, "Y", 4)], "employee_id long, code string, amount_minor long"
    )
    assert rows(asof.ytd_basis(ledger, facts)) == [(1, "X", 5, "ledger"), (2, "X", 3, "facts"), (2, "Y", 4, "facts")]
    assert rows(asof.ytd_basis(ledger.limit(0), facts)) == [(1, "X", 100, "facts"), (2, "X", 3, "facts"), (2, "Y", 4, "facts")]
