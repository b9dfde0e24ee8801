"""Writers: chunked fixture JSON / CSV, multi-format export, incremental
insert-if-absent and compressed output."""

from relnorm.sinks.fixtures import (write_fixture_json, write_fixture_csv, export_tables,
                                    table_to_records)
from relnorm.sinks.incremental import insert_if_absent, append_distinct

__all__ = [n for n in dir() if not n.startswith("_")]
