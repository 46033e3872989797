"""Sinks: chunk layout, reports, manifests, warehouse table, run log."""
