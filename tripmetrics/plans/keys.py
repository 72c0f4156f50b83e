"""Import every key module so the registry is complete."""

from . import keys_core, keys_etl, keys_fold, keys_marts, keys_quality, keys_serve, keys_stream  # noqa: F401
