"""Scalar functions with the semantics that replication rules rely on."""
