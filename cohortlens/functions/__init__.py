"""Scalar expressions, composed as Spark SQL text and parsed once JVM-side.

text     clean_text (P1), clean_year (P2), stage_rollup (P9)
numeric  pct with Python-exact rounding (P3), bit masks, regimen decode (P5), combined (P6)
display  dashboard formatting: counts, percents, heat wash, labels, headline (P10-P15)
sql      literal / quoting helpers
"""
