"""Structured Streaming drivers for the batch operators.

The original jobs are batch only; the one duty that is naturally a stream is
the erase-request table, which receives new batches of requests over time.
``erase_feed`` applies each arriving batch with the staged erase protocol.
"""

from tessera.streaming.erase_feed import start_erase_feed

__all__ = ["start_erase_feed"]
