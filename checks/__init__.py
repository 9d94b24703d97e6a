"""Inputs, queries and reference SQL for the correctness check and the bench."""
