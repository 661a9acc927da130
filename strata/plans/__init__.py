"""Logical plans: staging models, marts, serving queries, builds."""
