"""Row comparison for tests: values as the oracle compares them, in any order."""

from tools.compare_oracle import rows_of


def rows_equal(got, want):
    columns = want.columns
    assert sorted(got.columns) == sorted(columns)
    got_rows, want_rows = (rows_of(columns, [tuple(r) for r in df.select(*columns).collect()]) for df in (got, want))
    assert got_rows == want_rows
