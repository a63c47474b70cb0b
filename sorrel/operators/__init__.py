"""Operators over association tables, intervals, genotypes, oligos and assays."""
