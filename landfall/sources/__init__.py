"""Sources and sinks: fixture views, label files, landing, warehouse tables."""
