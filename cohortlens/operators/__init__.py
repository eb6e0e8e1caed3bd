"""DataFrame -> DataFrame operators of the cohort build.

prepare   cleaning, known-stage / blacklist / whitelist filters, distinct triples (F1-F3, U1)
scope     the all + per-year scope tags, year list (G1, F4, F5, T4, U3)
rollup    per-(scope, entity) rollups and the fact table (A3, J1)
summary   per-scope metrics, stage table, summary (A1, A5-A11, A14)
coverage  coverage grid, peak / trend, intensity, modality mix, flow (A2, J2, J4, A15, A16, Q5, Q6)
regimens  regimen counts and top-k with the folded tail (A4, T1, T2, A12, A13, P6, P7, F6, F7)
"""
