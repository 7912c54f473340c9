"""Table schemas, landing files, warehouse tables and the test-data adapter."""
