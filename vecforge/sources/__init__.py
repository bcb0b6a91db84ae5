"""Sources and sinks: parquet tables, label-first CSV, split CSV layouts, report files."""
