"""Sources and sinks: driver-table fixtures, CSV scan/sink, Parquet staging."""
