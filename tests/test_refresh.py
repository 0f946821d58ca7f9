import random

import pytest

from rosterflow.plans.load import publish_report
from rosterflow.plans.refresh import ReportSpec, check_reports, refresh_report, refresh_reports
from rosterflow.sources.grid import frame_to_grid

SENTINEL = "Not Assigned Yet"
QUERY = "id string, state_id string, name string"
REPORT = "id string, state_id string, name string, note string, call string"


def refresh(spark, rows, query, report, **options):
    q = spark.createDataFrame(query, QUERY)
    r = spark.createDataFrame(report, REPORT)
    return rows(refresh_report(q, r, "id", "state_id", **options))


def test_primary_then_secondary_then_new(spark, rows):
    query = [
        ("1", "901", "matched on primary"),
        ("2", "902", "moved from secondary to primary"),
        (SENTINEL, "903", "no primary yet"),
        ("4", "N/A", "newly listed"),
        ("5", "905", "matches nothing"),
        ("x", "N/A", "no usable key"),
        ("7", "1e3", "number written in another way"),
        ("8", None, "null secondary"),
    ]
    report = [
        ("1", "901", "old name", "n1", "c1"),
        (SENTINEL, "902", "old", "n2", "c2"),
        (SENTINEL, "903", "old", "n3", None),
        ("44", "N/A", "old", "never", "never"),
        ("77", "1000.0", "old", "n7", "c7"),
        ("99", "999", "left the query", "gone", "gone"),
    ]
    assert refresh(spark, rows, query, report) == sorted(
        [
            ("1", "901", "matched on primary", "n1", "c1"),
            ("2", "902", "moved from secondary to primary", "n2", "c2"),
            (SENTINEL, "903", "no primary yet", "n3", ""),
            ("4", "N/A", "newly listed", "", ""),
            ("5", "905", "matches nothing", "", ""),
            ("x", "N/A", "no usable key", "", ""),
            ("7", "1e3", "number written in another way", "n7", "c7"),
            ("8", "", "null secondary", "", ""),
        ],
        key=repr,
    )


def test_a_primary_match_hides_the_secondary_one(spark, rows):
    report = [("1", "901", "", "by primary", ""), ("2", "902", "", "by secondary", "")]
    assert refresh(spark, rows, [("1", "902", "q")], report) == [("1", "902", "q", "by primary", "")]


def test_several_notes_fan_out_and_copies_collapse(spark, rows):
    report = [("1", "901", "", "a", ""), ("1", "901", "", "b", ""), ("1", "901", "other", "b", None)]
    query = [("1", "901", "q"), ("1", "901", "q"), ("1", "902", "q")]
    assert refresh(spark, rows, query, report) == [
        ("1", "901", "q", "a", ""),
        ("1", "901", "q", "b", ""),
        ("1", "902", "q", "a", ""),
        ("1", "902", "q", "b", ""),
    ]


def test_blank_keys(spark, rows):
    query = [("", "", "q")]
    report = [("", "", "", "n", ""), (SENTINEL, "902", "", "m", "")]
    assert refresh(spark, rows, query, report) == [("", "", "q", "", "")]
    assert refresh(spark, rows, query, report, blank_keys_match=True) == [("", "", "q", "m", ""), ("", "", "q", "n", "")]
    # The sentinel of the query never matches the blanked one of the report.
    assert refresh(spark, rows, [(SENTINEL, "N/A", "q")], report, blank_keys_match=True) == [(SENTINEL, "N/A", "q", "", "")]


def test_without_secondary_identifier(spark, rows):
    q = spark.createDataFrame([("1", "a"), ("x", "b"), ("3", "c"), ("3", "c")], "id string, name string")
    r = spark.createDataFrame([("1", "old", "n")], "id string, name string, note string")
    wanted = sorted([("1", "a", "n"), ("x", "b", ""), ("3", "c", "")], key=repr)
    assert rows(refresh_report(q, r, "id")) == wanted
    assert rows(refresh_report(q, r, "id", "state_id")) == wanted


def test_sort_nulls_and_numbers(spark):
    q = spark.createDataFrame([(2, None), (1, 1.5), (3, 0.5)], "id int, score double")
    r = spark.createDataFrame([("1", "", "n")], "id string, score string, note string")
    got = [tuple(x) for x in refresh_report(q, r, "id", sort_by=["note", "id"], ascending=[False, True]).collect()]
    assert got == [("1", "1.5", "n"), ("2", "", ""), ("3", "0.5", "")]


def test_query_columns_beyond_the_reports_share_are_cut_from_failed_rows(spark, rows):
    q = spark.createDataFrame([("1", "a", "keep"), ("2", "b", "lost")], "id string, name string, extra string")
    r = spark.createDataFrame([("1", "old", "n")], "id string, name string, note string")
    assert rows(refresh_report(q, r, "id", query_columns=2)) == [("1", "a", "keep", "n"), ("2", "b", "", "")]


def test_column_checks(spark):
    q = spark.createDataFrame([("1", "a")], "id string, name string")
    clash = spark.createDataFrame([("1", "b", "c")], "id string, x string, name string")
    with pytest.raises(ValueError, match="share names"):
        refresh_report(q, clash, "id", query_columns=2)
    with pytest.raises(ValueError, match="primary identifier"):
        refresh_report(q, clash, "nope")
    twice = spark.createDataFrame([("1", "b", "c")], "id string, n string, m string").toDF("id", "n", "n")
    with pytest.raises(ValueError, match="repeats columns"):
        refresh_report(q, twice, "id", query_columns=1)
    lacks = spark.createDataFrame([("1", "9", "c")], "id string, state_id string, note string")
    with pytest.raises(ValueError, match="secondary identifier"):
        refresh_report(q, lacks, "id", "state_id")


def brute_force(query, report):
    """The refresh by nested loops over plain rows."""

    def number(text):
        try:
            return float(text)
        except ValueError:
            return None

    out = set()
    for q in query:
        hits = [r for r in report if r[0] == q[0] and q[0] not in ("", SENTINEL)]
        if not hits and q[1] != "N/A":
            hits = [r for r in report if r[1] != "N/A" and number(q[1]) is not None and number(r[1]) == number(q[1])]
        out |= {(*q, *r[3:]) for r in hits} if hits else {(*q, "", "")}
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", range(4))
def test_against_brute_force_with_a_hot_key(spark, rows, seed):
    pick = random.Random(seed)
    ids = [SENTINEL] * 10 + ["", "x", "7", "7", "7"] + [str(i) for i in range(20)]
    states = ["N/A"] * 8 + ["", "oops", "5", "5.0", "1e1"] + [str(i) for i in range(15)]
    query = [(pick.choice(ids), pick.choice(states), pick.choice("ab")) for _ in range(150)]
    report = [(pick.choice(ids), pick.choice(states), "old", pick.choice("mn"), pick.choice("pq")) for _ in range(60)]
    assert refresh(spark, rows, query, report) == brute_force(query, report)


@pytest.mark.parametrize("seed", range(2))
def test_shuffled_joins_agree_with_broadcast_ones(spark, rows, seed):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", -1)
    try:
        test_against_brute_force_with_a_hot_key(spark, rows, seed)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_query_side_is_read_once(spark, folder, capsys):
    spark.range(10).selectExpr("cast(id as string) id", "cast(id as string) state_id", "'n' name").write.parquet(f"{folder}/query")
    spark.range(5).selectExpr("cast(id as string) id", "cast(id as string) state_id", "'n' name", "'x' note").write.parquet(f"{folder}/report")
    df = refresh_report(spark.read.parquet(f"{folder}/query"), spark.read.parquet(f"{folder}/report"), "id", "state_id")
    df.explain("formatted")
    plan = capsys.readouterr().out
    assert plan.count("/query]") == 1
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def write_query(folder, name, sql):
    with open(f"{folder}/{name}.sql", "w") as f:
        f.write(sql)
    return f"{folder}/{name}.sql"


def test_report_set_with_parameters_renames_rules_and_labels(spark, folder, rows):
    spark.createDataFrame([("1", "A"), ("2", "B")], "id string, school string").createOrReplaceTempView("roster")
    old = spark.createDataFrame([(1, "1", "A", "done: yes")], "row_no long, id string, school string, remark string")
    grid = frame_to_grid(old, "row_no", header_row=3)
    path = write_query(folder, "roster", "SELECT id, school FROM roster WHERE school <= '{top}'")
    plain = write_query(folder, "plain", "SELECT id, school FROM roster WHERE school = '{' OR school = :only")
    specs = {
        "all": ReportSpec(
            path,
            grid,
            2,
            header_rows=3,
            renames={"remark": "note", "gone": "x"},
            formulas={"title": "concat(school, '-', id)"},
            labels={"green": [("done", "note", "note")]},
            rules=[("school", ["B"])],
        ),
        "some": ReportSpec(path, grid, 2, header_rows=3),
    }
    got = refresh_reports(spark, specs, "id", None, {"top": "A"}, {"top": "B"})
    assert rows(got["all"]) == [("1", "A", "done: yes", "A-1", "green"), ("2", "B", "", "B-2", None)]
    assert got["some"].columns == ["id", "school", "remark"]
    assert rows(check_reports(got, specs)["all"]) == [("1", "school", "A")]
    # Without parameters the text is taken as it is, braces included.
    only = refresh_reports(spark, {"one": ReportSpec(plain, grid, 2, header_rows=3, named={"only": "B"})}, "id")
    assert rows(only["one"]) == [("2", "B", "")]


def test_notes_from_another_report(spark, folder, rows):
    spark.createDataFrame([("1", "A")], "id string, school string").createOrReplaceTempView("roster2")
    other = spark.createDataFrame([(1, "1", "n")], "row_no long, id string, note string")
    spec = ReportSpec(
        write_query(folder, "q", "SELECT * FROM roster2"), frame_to_grid(other, "row_no"), 2, report_query_columns=1
    )
    assert rows(refresh_reports(spark, {"r": spec}, "id")["r"]) == [("1", "A", "n")]


def test_publish_replaces_a_report_it_reads(spark, rows):
    spark.sql("CREATE SCHEMA IF NOT EXISTS publishing")
    name = "publishing.tracker"
    first = spark.createDataFrame([("1", "a", "n")], "id string, name string, note string")
    assert "__v1_" in publish_report(first, name)
    for version in (2, 3, 4):
        query = spark.createDataFrame([("1", "b"), (str(version), "c")], "id string, name string")
        assert f"__v{version}_" in publish_report(refresh_report(query, spark.table(name), "id"), name)
    assert rows(spark.table(name)) == [("1", "b", "n"), ("4", "c", "")]
    kept = sorted(t.name for t in spark.catalog.listTables("publishing") if not t.isTemporary)
    assert [k.rpartition("_")[0] for k in kept] == ["", "tracker__v3", "tracker__v4"]


def test_publish_refuses_a_wider_report_and_leaves_the_old_one(spark, rows):
    spark.sql("CREATE SCHEMA IF NOT EXISTS publishing")
    name = "publishing.narrow"
    publish_report(spark.createDataFrame([("1", "n")], "id string, note string"), name)
    wide = spark.createDataFrame([("1", "n", "x")], "id string, note string, more string")
    with pytest.raises(ValueError, match="room for 2 columns"):
        publish_report(wide, name)
    assert rows(spark.table(name)) == [("1", "n")]
    publish_report(wide, name, max_columns=3)
    assert rows(spark.table(name)) == [("1", "n", "x")]
