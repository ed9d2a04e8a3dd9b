"""What several test modules share besides fixtures."""

import datetime as dt

AS_OF = dt.date(2025, 12, 31)


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


def date(text):
    return dt.date.fromisoformat(text)
