"""Spark jobs for k-mer association analysis of two sample groups."""
