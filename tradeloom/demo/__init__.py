"""The engine on the TPC-H-like test tables: raw shapes, queries, check SQL."""
