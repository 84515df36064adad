"""Sources and sinks: table access, CSV ingest, stored table layouts, customer history, test fixtures."""
