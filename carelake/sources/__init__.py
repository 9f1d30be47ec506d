"""Sources and sinks: driver-table adapter, seed tables, snapshot store."""
