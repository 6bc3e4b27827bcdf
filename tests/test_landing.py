"""Faults of delivered CSV files: malformed lines and headers."""

import os

import pytest

from conftest import rows
from tillwise.sources.scan import header_mismatches, landing_violations, malformed_lines, read_dataset, snapshot_path

DAY = "2001-08-01"
HEADER = "supplier_id,lead_time,reliability_score,country,store_id"
GOOD = "1,5,4.5,FRANCE,3"
BAD = ["x,5,4.5,FRANCE,3", "2,five,4.5,FRANCE,3", "3,5,4.5", "4,5,4.5,FRANCE,3,extra"]


def land(scratch, **files):
    folder = snapshot_path(scratch, "suppliers", DAY)
    os.makedirs(folder)
    for name, lines in files.items():
        with open(f"{folder}/{name}.csv", "w") as f:
            f.write("\n".join(lines) + "\n")
    return scratch


@pytest.fixture()
def landed(scratch):
    return land(scratch, a=[HEADER, GOOD, *BAD], b=[HEADER, "7,,,,"], c=[HEADER.replace("country", "country "), "8,1,1.0,ITALY,1"])


def test_malformed_lines_are_violations_and_not_rows(spark, landed):
    df = read_dataset(spark, landed, "suppliers", DAY)
    assert rows(df) == [(1, 5, 4.5, "FRANCE", 3), (7, None, None, None, None), (8, 1, 1.0, "ITALY", 1)]
    got = malformed_lines(spark, landed, "suppliers", DAY).collect()
    assert sorted(r.line for r in got) == sorted(BAD)
    assert all(r.dataset == "suppliers" and r.file.endswith("a.csv") for r in got)


@pytest.mark.parametrize("cols", [["supplier_id"], ["country"], ["store_id", "lead_time"]])
def test_the_same_lines_are_left_out_whatever_is_read(spark, landed, cols):
    df = read_dataset(spark, landed, "suppliers", DAY)
    assert rows(df.select(*cols)) == sorted((tuple(r[c] for c in cols) for r in df.collect()),
                                            key=lambda t: tuple((x is not None, x) for x in t))
    assert df.count() == 3


def test_header_that_differs_by_a_space_is_found(spark, landed):
    (r,) = header_mismatches(spark, landed, "suppliers", DAY).collect()
    assert r.file.endswith("c.csv") and r.header == HEADER.replace("country", "country ") and r.expected == HEADER


def test_counts_per_rule(spark, landed):
    got = landing_violations(spark, landed, DAY, ["suppliers"])
    assert rows(got) == [("header:suppliers", 1), ("malformed:suppliers", 4)]


def test_clean_delivery_has_no_violations(spark, scratch):
    land(scratch, a=[HEADER, GOOD], b=[HEADER])
    assert rows(landing_violations(spark, scratch, DAY, ["suppliers"])) == [("header:suppliers", 0), ("malformed:suppliers", 0)]
