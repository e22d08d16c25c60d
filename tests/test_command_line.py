import pytest

from hourstar.__main__ import parse


def test_defaults_and_options():
    plain = parse(["A,B", "raw", "out", "2021-01-01", "2021-01-02"])
    assert (plain.layout, plain.database, plain.record_id_type, plain.time_zone) == ("file", None, "int", "Asia/Bangkok") and plain.period is None
    full = parse(["A", "r", "o", "s", "e", "--layout", "folder", "--database", "report", "--record-id-type", "bigint", "--period", "day"])
    assert (full.layout, full.database, full.record_id_type, full.period) == ("folder", "report", "bigint", "day")


@pytest.mark.parametrize("bad", [["A"], ["A", "r", "o", "s", "e", "--layout", "other"], ["A", "r", "o", "s", "e", "--record-id-type", "text"]])
def test_refused(bad):
    with pytest.raises(SystemExit):
        parse(bad)
