"""Plans: end-to-end validate / ingest / publish jobs built from the operators."""
