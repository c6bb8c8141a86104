"""Incremental processing of arriving segments and page revisions."""
