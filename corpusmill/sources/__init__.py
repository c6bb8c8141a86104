"""Readers: segment indexes, compressed segments, ledgers, token shards, HTTP."""
