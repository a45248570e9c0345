import datetime as dt

from conftest import as_dicts

from tallyspan.operators.audit import file_provenance, load_batches, row_count

TS = dt.datetime


def test_row_count(facts):
    assert as_dicts(row_count(facts({}, {}))) == [{"count": 2}]
    assert as_dicts(row_count(facts().limit(0))) == [{"count": 0}]


def test_load_batches_newest_first_and_null_on_top(facts):
    rows = facts(
        {"load_date": TS(2025, 1, 1, 0, 0, 0, 499_999)},
        {"load_date": TS(2024, 12, 31, 23, 59, 59, 500_000)},
        {"load_date": TS(2025, 1, 1, 0, 0, 0, 500_000)},
        {"load_date": None},
    )
    assert [tuple(r) for r in load_batches(rows).collect()] == [
        (None, 1), (TS(2025, 1, 1, 0, 0, 1), 1), (TS(2025, 1, 1), 2),
    ]


def test_files_latest_first(facts):
    rows = facts(
        {"source_file_name": "a", "load_date": TS(2025, 1, 1)},
        {"source_file_name": "a", "load_date": TS(2025, 1, 3)},
        {"source_file_name": None, "load_date": TS(2025, 1, 4)},
        {"source_file_name": "b", "load_date": None},
    )
    assert [tuple(r) for r in file_provenance(rows).collect()] == [
        ("b", None, None, 1),
        ("(null)", TS(2025, 1, 4), TS(2025, 1, 4), 1),
        ("a", TS(2025, 1, 1), TS(2025, 1, 3), 2),
    ]
