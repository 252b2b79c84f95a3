"""Sources and sinks: governed CSV files, the given warehouse tables, and the
Parquet outputs of the engine."""
