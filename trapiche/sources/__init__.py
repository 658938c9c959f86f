"""Readers: loosely matching CSV feeds, processed tables, JSON records, model tables."""

from trapiche.sources.feeds import LINEAGE, UNREADABLE, drop_unreadable_files, read_feeds
from trapiche.sources.tables import read_model, read_processed, read_record

__all__ = [
    "LINEAGE",
    "UNREADABLE",
    "drop_unreadable_files",
    "read_feeds",
    "read_model",
    "read_processed",
    "read_record",
]
