"""Input files, catalog tables and the shared scratch folder."""
