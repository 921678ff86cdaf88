"""Sinks: table writes, JDBC, DDL from data (K1-K8)."""
