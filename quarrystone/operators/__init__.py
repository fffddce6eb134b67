"""Relational, graph, temporal and audit operators; all are generic over column names."""
