"""Readers: event streams, lake tables, envelopes, dimensions and the driver-table adapter."""
