"""The smallest test tables, and rows in a form that tests can compare."""

SF = "/root/testdata/sf0.001"


def rows_of(df, digits=9):
    """Rows as sorted tuples in column-name order, floats rounded."""
    names = sorted(df.columns)

    def plain(v):
        return round(v, digits) + 0.0 if isinstance(v, float) else v

    return sorted((tuple(plain(r[c]) for c in names) for r in df.collect()), key=repr)
