"""Wordgrove: analytics for labelled forests and word networks on Spark."""
