"""Whole plans built from the operators.

cohort    CohortBuild: every output for every scope, optional materialisation (Q1, Q4)
document  nested document assembly, JSON text and read-back (Q2, S6, S7, S8)
catalog   named queries over the test tables (the driver's queries())
job       spark-submit entry point: sources -> checkpointed build -> outputs
"""
