"""Inputs: role-table contracts, Parquet/ORC readers, partition union, test-table adapter."""
