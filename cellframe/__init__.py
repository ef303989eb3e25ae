"""Cells to typed tables, merges and joins on Spark DataFrames."""

from .model import CELL, MANIFEST, ROWS, ColumnSpec, ExportSpec
from .operators.aggregate import collect_sides, last_per_key, side_counts, word_count
from .operators.assemble import (
    assemble, assemble_from_pieces, assemble_from_rows, assemble_keyed, assemble_strings, assemble_tsv, dump_pairs,
    read_row_pieces, read_rows)
from .operators.decode_table import decode_columns, decode_rejects, rejected_rows
from .operators.joins import inner_join, merge_as_map, merge_by_key, tagged_union
from .operators.ordered import scan
from .operators.running import running_row
from .plans.export import TableReport, export, export_reports
from .session import COMPILED_METHODS, packed_scans, session_settings
from .sinks.keyed import KEY_ORDER, KeyedCells, read_keyed_cells, write_keyed_cells
from .sources.cells import compact, read_cells, read_orc, unpivot_to_cells
from .sources.lines import parse_delimited, read_lines, read_sequence, tag_source

__all__ = [
    "CELL", "COMPILED_METHODS", "KEY_ORDER", "MANIFEST", "ROWS", "ColumnSpec", "ExportSpec", "KeyedCells",
    "TableReport", "assemble",
    "assemble_from_pieces", "assemble_from_rows", "assemble_keyed", "assemble_strings", "assemble_tsv", "collect_sides",
    "compact", "decode_columns", "decode_rejects", "dump_pairs", "export", "export_reports", "inner_join", "last_per_key", "merge_as_map",
    "merge_by_key", "packed_scans", "parse_delimited", "read_cells", "read_keyed_cells", "read_lines", "read_orc",
    "read_row_pieces", "read_rows", "read_sequence", "rejected_rows", "running_row", "scan", "session_settings",
    "side_counts", "tag_source", "tagged_union", "unpivot_to_cells", "word_count", "write_keyed_cells",
]
