from tally.sources.commits import CommitLog, Conflict
from tally.sources.counts import KeptCounts
from tally.sources.insert_text import import_dump, read_insert_dump, write_insert_dump
from tally.sources.layout import interleaved, save_interleaved
from tally.sources.stored import StoredTable
from tally.sources.tables import ParquetTables, append, load, save

__all__ = [
    "CommitLog",
    "Conflict",
    "KeptCounts",
    "ParquetTables",
    "StoredTable",
    "append",
    "import_dump",
    "interleaved",
    "load",
    "read_insert_dump",
    "save",
    "save_interleaved",
    "write_insert_dump",
]
