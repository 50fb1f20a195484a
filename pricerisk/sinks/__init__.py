"""Sinks: partitioned raw writes, table materialisation, alert and message outputs."""
