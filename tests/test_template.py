import pytest

from rosterflow.plans.template import collect_entries, fill_templates, placeholders, template_slots

GOALS = [
    # seq, school, tag, year, category, goal, main, numerator, denominator
    (1, "North", "grad", 2023, "Data", "Rate", "80%", "8", "10"),
    (2, "North", "grad", 2024, "Data", "Rate", "90%", "9", "10"),
    (3, "North", "size", 2024, "Data", "Enrollment", "500", None, None),
    (4, "North", "aim", 2022, "Goal", "Enrollment", "95%", None, None),
    (5, "South", "grad", 2023, "Data", "Rate", "70%", "7", None),
    (6, "South", "grad", 2023, "Data", "Rate", "71%", "x", None),
]


@pytest.fixture
def entries(spark):
    schema = "seq int, School string, Tag string, `Academic Year` int, Category string, `Excellence Goal` string, `Main Data` string, Numerator string, Denominator string"
    return placeholders(spark.createDataFrame(GOALS, schema), "seq")


def test_placeholders(entries, rows):
    assert rows(entries) == sorted(
        [
            ("North", 2, "{grad%}", "90%"),
            ("North", 2, "{grad_num}", "9"),
            ("North", 2, "{grad_den}", "10"),
            ("North", 2, "{grad_year}", "2024"),
            ("North", 3, "{size}", "500"),
            ("North", 3, "{size_year}", "2024"),
            ("North", 4, "{aim}", "95%"),
            *[("South", s, t, v) for s, m, n in ((5, "70%", "7"), (6, "71%", "x"))
              for t, v in (("{grad%}", m), ("{grad_num}", n), ("{grad_den}", ""), ("{grad_year}", "2023"))],
        ],
        key=repr,
    )


def test_fill_templates(spark, entries, rows):
    templates = spark.createDataFrame(
        [("hs", "{school}: {grad%} of {grad_den}, {size}, {aim}, {none}. {grad%}"), ("ms", "{grad%}|{grad_num}|{grad_den}|{size}")],
        "template string, template_text string",
    )
    schools = spark.createDataFrame(
        [("North", "hs"), ("South", "ms"), ("East", "ms"), ("West", "none")], "School string, template string"
    )
    filled = fill_templates(schools, templates, entries, "School", "template")
    assert rows(filled, "School", "filled_text") == sorted(
        [
            ("North", "North: 90% of 10, 500, 95%, {none}. 90%"),
            ("South", "70%|7||{size}"),
            ("East", "{grad%}|{grad_num}|{grad_den}|{size}"),
            ("West", None),
        ],
        key=repr,
    )


def test_collected_maps_hold_only_what_the_template_uses(spark, entries):
    templates = spark.createDataFrame([("hs", "{grad%} {grad_num}")], "template string, template_text string")
    schools = spark.createDataFrame([("North", "hs")], "School string, template string")
    slots = template_slots(templates, "template", "template_text")
    got = collect_entries(entries, schools, slots, "School", "template").collect()
    assert [(r.School, r.entries) for r in got] == [("North", {"{grad%}": "90%", "{grad_num}": "9"})]
