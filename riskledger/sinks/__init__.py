from riskledger.sinks.csv_reports import export_tables, write_csv, write_report_csv
from riskledger.sinks.tables import list_tables, replace_table, table_row_counts

__all__ = [
    "export_tables",
    "list_tables",
    "replace_table",
    "table_row_counts",
    "write_csv",
    "write_report_csv",
]
