"""Jobs that load outside data and reconcile it with the catalogue."""
