"""Sources and sinks: parquet tables, JSONL/JSON/text/CSV readers and writers, test adapters."""
