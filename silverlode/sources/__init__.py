"""Extract files, stored tables and the run log."""

from silverlode.sources.bucketed import (
    BucketedTable,
    Buckets,
    bucketed_join,
    read_bucketed,
    write_bucketed,
)
from silverlode.sources.delimited import (
    SOURCE_FILE,
    read_extract,
    split_rejects,
)
from silverlode.sources.files import Files
from silverlode.sources.monthly import MonthlyTable
from silverlode.sources.statistics import extremes
from silverlode.sources.tables import LoadFailed, RunLog, Written, rejected_lines, write_version

__all__ = [
    "BucketedTable", "Buckets", "bucketed_join", "read_bucketed", "write_bucketed",
    "SOURCE_FILE", "read_extract", "split_rejects", "Files", "MonthlyTable", "extremes",
    "LoadFailed", "RunLog", "Written", "rejected_lines", "write_version",
]
