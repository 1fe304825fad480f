"""Readers, writers, schemas, and the adapter from the driver tables to job roles."""
from ferrule.sources.io import *  # noqa: F401,F403
