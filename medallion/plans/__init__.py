"""The trip-record preset: fixed values, models, marts and the whole run."""
