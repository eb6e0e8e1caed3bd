"""DuckDB oracle SQL for every registered query.

Written independently of the Spark plans: plain distinct counts over
deduplicated triples, ``arg_max`` for the last-wins lookup, ``string_agg`` for
regimen names and ``row_number`` for the ranking; one ``UNION ALL`` per scope
kind instead of the explode.  Only the dimension values come from the spec.
Tables ``customer`` and ``orders`` are the pre-registered views.
"""

from __future__ import annotations

from cohortlens.sources.tpch import CLINICAL_MODALITY_OF_ORDER, CLINICAL_STAGE_OF_SEGMENT, SUBSTAGES, THAI_DIGITS
from cohortlens.spec import (
    ALL_SCOPE,
    CLINICAL_SUBSTAGE_PATTERN,
    TPCH_UNKNOWN_SEGMENT,
    CohortSpec,
    active_only_variant,
    clinical_spec,
    tpch_spec,
)

VARIANT_DROP = ("5-LOW",)

# Fixed values, written out apart from the engine: white space that Python strips,
# the zeros of the decimal digit runs, and the grammar of a float literal.
WHITESPACE = [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
DIGIT_ZEROS = [
    0x0660, 0x06F0, 0x07C0, 0x0966, 0x09E6, 0x0A66, 0x0AE6, 0x0B66, 0x0BE6, 0x0C66, 0x0CE6, 0x0D66, 0x0DE6, 0x0E50, 0x0ED0, 0x0F20,
    0x1040, 0x1090, 0x17E0, 0x1810, 0x1946, 0x19D0, 0x1A80, 0x1A90, 0x1B50, 0x1BB0, 0x1C40, 0x1C50, 0xA620, 0xA8D0, 0xA900, 0xA9D0,
    0xA9F0, 0xAA50, 0xABF0, 0xFF10, 0x104A0, 0x10D30, 0x11066, 0x110F0, 0x11136, 0x111D0, 0x112F0, 0x11450, 0x114D0, 0x11650, 0x116C0,
    0x11730, 0x118E0, 0x11950, 0x11C50, 0x11D50, 0x11DA0, 0x11F50, 0x16A60, 0x16AC0, 0x16B50, 0x1D7CE, 0x1D7D8, 0x1D7E2, 0x1D7EC, 0x1D7F6,
    0x1E140, 0x1E2F0, 0x1E4F0, 0x1E950, 0x1FBF0,
]
FLOAT = r"^[+-]?([0-9]+(_[0-9]+)*(\.([0-9]+(_[0-9]+)*)?)?|\.[0-9]+(_[0-9]+)*)([eE][+-]?[0-9]+(_[0-9]+)*)?$"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def in_list(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def trim_ws(x: str) -> str:
    return f"trim(CAST({x} AS VARCHAR), {q(''.join(map(chr, WHITESPACE)))})"


def clean(x: str, sentinel: str) -> str:
    return f"COALESCE(NULLIF({trim_ws(x)}, ''), {q(sentinel)})"


def clean_year(x: str, sentinel: str) -> str:
    src = "".join(chr(zero + k) for zero in DIGIT_ZEROS for k in range(10))
    dst = "0123456789" * len(DIGIT_ZEROS)
    folded = f"translate({trim_ws(x)}, {q(src)}, {q(dst)})"
    num = f"TRY_CAST(replace({folded}, '_', '') AS DOUBLE)"
    parsed = (
        f"CASE WHEN regexp_matches({folded}, {q(FLOAT)}) AND abs({num}) < 9.2e18 "
        f"THEN CAST(CAST(trunc({num}) AS BIGINT) AS VARCHAR) END"
    )
    return f"COALESCE({parsed}, NULLIF({trim_ws(x)}, ''), {q(sentinel)})"


# round_even rounds like the shortest decimal string; Python rounds the exact
# binary value.  They differ only at non-dyadic ties (denominators such as 2000),
# which the test tables' stage sizes never produce.  The exact rule used on the
# Spark side (Dekker split in double arithmetic) does not survive DuckDB's
# expression evaluation, so the oracle keeps round_even; exactness is tested
# against Python's own round in tests/test_functions.py.
def pct(n: str, d: str, digits: int) -> str:
    return f"(CASE WHEN COALESCE({d}, 0) = 0 THEN 0.0 ELSE round_even(CAST({n} AS DOUBLE) / CAST({d} AS DOUBLE) * CAST(100 AS DOUBLE), {digits}) END)"


def values(rows, cols) -> str:
    body = ", ".join("(" + ", ".join(q(v) if isinstance(v, str) else str(v) for v in r) + ")" for r in rows)
    return f"(SELECT * FROM (VALUES {body}) AS t({', '.join(cols)}))"


def treatment_sql(encoding: str) -> str:
    if encoding in ("P", "T"):
        return "o.o_orderpriority"
    if encoding == "X":
        return "printf('M%02d', (o.o_orderkey + o.o_custkey) % 75)"
    pair = "o.o_orderpriority || '/' || o.o_orderstatus"
    if encoding == "W":
        return pair
    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in CLINICAL_MODALITY_OF_ORDER.items())
    return f"CASE {pair} {whens} ELSE {pair} END"


def stage_sql(encoding: str) -> str:
    if encoding != "C":
        return "c.c_mktsegment"
    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in CLINICAL_STAGE_OF_SEGMENT.items())
    return f"CASE c.c_mktsegment {whens} ELSE c.c_mktsegment END"


def trapped(encoding: str) -> str:
    """CTEs raw_entities and raw_events from clean_entities and clean_events."""
    if encoding != "T":
        return "raw_entities AS (SELECT * FROM clean_entities),\nraw_events AS (SELECT * FROM clean_events),"
    return """raw_entities AS (
  SELECT c_custkey,
         CASE WHEN c_custkey % 13 = 0 THEN '  ' WHEN c_custkey % 7 = 3 THEN chr(160) || (c_custkey - 1) || ' ' ELSE hn END AS hn,
         CASE WHEN c_custkey % 17 = 0 THEN NULL WHEN c_custkey % 19 = 0 THEN year || '.0' ELSE year END AS year,
         CASE WHEN c_custkey % 23 = 0 THEN ' ' || stage || chr(9) ELSE stage END AS stage,
         CASE WHEN c_custkey % 11 <> 0 THEN row_idx END AS row_idx
  FROM clean_entities),
raw_events AS (
  SELECT CASE WHEN row_idx % 29 = 0 THEN 'orphan' || hn WHEN row_idx % 31 = 0 THEN '' ELSE hn || ' ' END AS hn, year,
         CASE WHEN row_idx % 37 = 0 THEN NULL WHEN row_idx % 5 = 0 THEN 'BUILDING' ELSE stage END AS stage,
         CASE WHEN row_idx % 41 = 0 THEN treatment || chr(9) ELSE treatment END AS treatment,
         CASE WHEN hn <> '7' THEN row_idx END AS row_idx
  FROM clean_events),"""


# A row without an order key comes before all others.
ORDER = "COALESCE({}, -9223372036854775808)"


# Customers of one exported workbook or text file; files are read in order of their number.
BOOK = "CAST({} AS BIGINT) // 200"


def base(spec: CohortSpec, encoding: str, override: int | None = None, books: bool = False, unknown_year: str = "year") -> str:
    """CTEs: raw mapping, cleaning, F1, scopes, dimensions and the per-entity sets.

    With ``books`` events are in the order of the exported files."""
    event_order = f"({BOOK.format('o.o_custkey')}) * 1099511627776 + o.o_orderkey" if books else "o.o_orderkey"
    sent = spec.sentinel
    stages = spec.stage_codes
    reg_mods = spec.regimen_modalities()
    stage_dim = values([(i, s.code, s.label, s.name, s.color) for i, s in enumerate(spec.stages)], ["stage_ord", "stage", "label", "name", "color"])
    heat_dim = values([(i, h.value, h.label) for i, h in enumerate(spec.heatmap)], ["heat_ord", "treatment", "label"])
    act_dim = values([(i, m.value, m.short) for i, m in enumerate(reg_mods)], ["reg_ord", "treatment", "short"])
    den_col = "patients" if spec.denominator == "all" else "active_patients"
    k = spec.top_k
    min_share_sql = (
        f" AND CAST(r.n AS DOUBLE) / CAST(st.denominator AS DOUBLE) * 100.0 >= {float(spec.min_share)!r}"
        if spec.min_share is not None
        else ""
    )
    return f"""
cust_first AS (SELECT o_custkey AS custkey, min(o_orderdate) AS first_date FROM orders GROUP BY o_custkey),
clean_entities AS (
  SELECT c.c_custkey, CAST(c.c_custkey AS VARCHAR) AS hn, CAST(year(f.first_date) AS VARCHAR) AS year,
         {stage_sql(encoding)} AS stage, c.c_custkey AS row_idx
  FROM customer c LEFT JOIN cust_first f ON f.custkey = c.c_custkey),
clean_events AS (
  SELECT CAST(o.o_custkey AS VARCHAR) AS hn, CAST(year(o.o_orderdate) AS VARCHAR) AS year,
         {stage_sql(encoding)} AS stage, {treatment_sql(encoding)} AS treatment, {event_order} AS row_idx
  FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey),
{trapped(encoding)}
entities AS (
  SELECT * FROM (SELECT {clean('hn', sent)} AS hn, {clean_year('year', sent)} AS year, {clean('stage', sent)} AS stage, row_idx FROM raw_entities)
  WHERE stage IN {in_list(stages)}),
events AS (
  SELECT * FROM (SELECT {clean('hn', sent)} AS hn, {clean_year('year', sent)} AS year, {clean('stage', sent)} AS stage,
                        {clean('treatment', sent)} AS treatment, row_idx FROM raw_events)
  WHERE stage IN {in_list(stages)}),
unknown AS (SELECT hn, {clean_year(unknown_year, sent)} AS year FROM raw_entities WHERE stage = {q(TPCH_UNKNOWN_SEGMENT)}),
years AS (SELECT DISTINCT year FROM entities WHERE year <> {q(sent)} AND year <> {q(ALL_SCOPE)}),
scopes AS (SELECT {q(ALL_SCOPE)} AS scope UNION ALL SELECT year AS scope FROM years),
ent_s AS (SELECT {q(ALL_SCOPE)} AS scope, e.* FROM entities e
          UNION ALL SELECT e.year AS scope, e.* FROM entities e WHERE e.year IN (SELECT year FROM years)),
ev_s AS (SELECT {q(ALL_SCOPE)} AS scope, e.* FROM events e
         UNION ALL SELECT e.year AS scope, e.* FROM events e WHERE e.year IN (SELECT year FROM years)),
unk_s AS (SELECT {q(ALL_SCOPE)} AS scope, u.* FROM unknown u
          UNION ALL SELECT u.year AS scope, u.* FROM unknown u WHERE u.year IN (SELECT year FROM years)),
stage_dim AS {stage_dim},
heat_dim AS {heat_dim},
act_dim AS {act_dim},
pt AS (SELECT DISTINCT scope, hn, stage, treatment FROM ev_s WHERE treatment NOT IN {in_list(spec.non_active)}),
lookup AS (SELECT scope, hn, arg_max(stage, {ORDER.format('row_idx')}) AS stage FROM ent_s GROUP BY scope, hn),
psets AS (
  SELECT p.scope, p.hn, string_agg(a.short, ' + ' ORDER BY a.reg_ord) AS regimen, count(*) AS n_modalities
  FROM (SELECT DISTINCT scope, hn, treatment FROM pt) p JOIN act_dim a ON a.treatment = p.treatment
  GROUP BY p.scope, p.hn),
first_seen AS (
  SELECT e.scope, e.hn, min({ORDER.format('e.row_idx')}) AS first_idx FROM ev_s e
  WHERE e.treatment NOT IN {in_list(spec.non_active)} AND e.treatment IN (SELECT treatment FROM act_dim)
  GROUP BY e.scope, e.hn),
assigned AS (
  SELECT p.scope, p.hn, l.stage, p.regimen, p.n_modalities, f.first_idx
  FROM psets p JOIN lookup l ON l.scope = p.scope AND l.hn = p.hn
  JOIN first_seen f ON f.scope = p.scope AND f.hn = p.hn),
stage_counts AS (
  SELECT s.scope, d.stage_ord, d.stage, d.label, d.name, d.color,
         (SELECT count(DISTINCT e.hn) FROM ent_s e WHERE e.scope = s.scope AND e.stage = d.stage) AS patients,
         (SELECT count(*) FROM assigned a WHERE a.scope = s.scope AND a.stage = d.stage) AS active_patients,
         (SELECT count(*) FROM assigned a WHERE a.scope = s.scope AND a.stage = d.stage AND a.n_modalities >= 2) AS multimodal_patients
  FROM scopes s, stage_dim d),
stage_table AS (
  SELECT *, {pct('multimodal_patients', 'active_patients', spec.multimodal_digits)} AS multimodal_percent,
         {den_col} AS denominator FROM stage_counts),
coverage AS (
  SELECT s.scope, h.heat_ord, h.treatment, h.label, st.stage_ord, st.stage,
         (SELECT count(DISTINCT p.hn) FROM pt p WHERE p.scope = s.scope AND p.stage = st.stage AND p.treatment = h.treatment) AS count,
         st.denominator
  FROM scopes s, heat_dim h, stage_table st WHERE st.scope = s.scope),
heatmap AS (
  SELECT scope, heat_ord, treatment, label, stage_ord, stage, count,
         {pct('count', 'denominator', spec.coverage_digits)} AS percent FROM coverage),
regimen_counts AS (
  SELECT scope, stage, regimen, count(*) AS n, min(first_idx) AS first_idx FROM assigned GROUP BY scope, stage, regimen),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY scope, stage ORDER BY n DESC, first_idx ASC) AS rn FROM regimen_counts),
shown_flag AS (
  SELECT r.*, (r.rn <= {k}{min_share_sql}) AS shown
  FROM ranked r JOIN stage_table st ON st.scope = r.scope AND st.stage = r.stage),
folded AS (
  SELECT scope, stage, CAST(rn AS INTEGER) AS rank, regimen, n AS count FROM shown_flag WHERE shown
  UNION ALL
  SELECT scope, stage, {k + 1} AS rank, {q(spec.tail_label)} AS regimen, CAST(sum(n) AS BIGINT) AS count
  FROM shown_flag WHERE NOT shown GROUP BY scope, stage),
regimens AS (
  SELECT f.scope, f.stage, f.rank, f.regimen, f.count,
         {pct('f.count', 'st.denominator', spec.regimen_digits)} AS percent,
         {pct('f.count', 'max(f.count) OVER (PARTITION BY f.scope, f.stage)', spec.width_digits)} AS width,
         contains(f.regimen, ' + ') AS combined
  FROM folded f JOIN stage_table st ON st.scope = f.scope AND st.stage = f.stage
  WHERE f.count > 0),
summary AS (
  SELECT s.scope,
         (SELECT count(DISTINCT e.hn) FROM ent_s e WHERE e.scope = s.scope) AS known_patients,
         (SELECT count(*) FROM ev_s e WHERE e.scope = s.scope) AS treatment_events,
         {len(spec.stages)} AS stage_count,
         {f"CASE WHEN s.scope = {q(ALL_SCOPE)} THEN CAST({override} AS BIGINT) ELSE " if override is not None else ""}(SELECT count(DISTINCT u.hn) FROM unk_s u WHERE u.scope = s.scope){" END" if override is not None else ""} AS unknown_patients,
         (SELECT CAST(sum(active_patients) AS BIGINT) FROM stage_table t WHERE t.scope = s.scope) AS active_patients,
         (SELECT CAST(sum(multimodal_patients) AS BIGINT) FROM stage_table t WHERE t.scope = s.scope) AS multimodal_patients
  FROM scopes s),
summary_full AS (
  SELECT *, {pct('multimodal_patients', 'active_patients', spec.multimodal_digits)} AS multimodal_percent FROM summary)
"""


def with_base(select: str, encoding: str = "P", variant: bool = False, override: int | None = None, books: bool = False, unknown_year: str = "year", **params) -> str:
    spec = clinical_spec(**params) if encoding == "C" else tpch_spec(encoding, **params)
    if variant:
        spec = active_only_variant(spec, VARIANT_DROP)
    return "WITH " + base(spec, encoding, override, books, unknown_year).strip() + "\n" + select.strip()


def fmt_count(x: str) -> str:
    return f"format('{{:,}}', CAST(COALESCE({x}, 0) AS BIGINT))"


def fmt_pct(x: str) -> str:
    return f"regexp_replace(format('{{:,.1f}}', CAST(COALESCE({x}, 0) AS DOUBLE)), '\\.0$', '') || '%'"


HEADLINE = "'ผู้ป่วย ' || {mm} || ' จาก ' || {act} || ' รายได้รับตั้งแต่ 2 วิธีขึ้นไป'"


def scope_label(x: str) -> str:
    return f"CASE WHEN {x} = {q(ALL_SCOPE)} THEN 'รวมทุกปี' ELSE 'ปี ' || {x} END"


def messy_text_sql(key: str, v: str) -> str:
    return (
        f"CASE {key} % 7 WHEN 0 THEN chr(9) || {v} || ' ' WHEN 1 THEN chr(160) || {v} "
        f"WHEN 2 THEN {v} || chr(12288) WHEN 3 THEN '  ' WHEN 4 THEN NULL "
        f"WHEN 5 THEN chr(28) || {v} || chr(10) ELSE {v} END"
    )


def messy_year_sql(key: str, y: str) -> str:
    head, rest = f"substring({y}, 1, 1)", f"substring({y}, 2, 100)"
    variants = [
        y,
        f"{y} || '.0'",
        f"{y} || '.9'",
        f"'-' || {y} || '.5'",
        f"' ' || {y} || chr(9)",
        f"{y} || 'd'",
        f"{head} || 'e3'",
        f"{head} || '_' || {rest}",
        f"translate({y}, '0123456789', {q(THAI_DIGITS)})",
        f"{y} || 'abc'",
        "'nan'",
        "'inf'",
        "''",
        "NULL",
        f"chr(12288) || {y}",
        f"'.' || {y}",
        f"'+' || {y}",
        f"{head} || '__' || {rest}",
    ]
    whens = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(variants))
    return f"CASE {key} % {len(variants)} {whens} END"


def oracle_sql() -> dict[str, str]:
    sent = tpch_spec().sentinel
    substage = f"([{', '.join(q(s) for s in SUBSTAGES)}])[c_custkey % {len(SUBSTAGES)} + 1]"
    pat = q(CLINICAL_SUBSTAGE_PATTERN)
    raw_year = messy_year_sql("c_custkey", "year")
    out = {
        "clean_text": f"""
SELECT c_custkey, raw_stage, {clean('raw_stage', sent)} AS stage
FROM (SELECT c_custkey, {messy_text_sql('c_custkey', 'c_mktsegment')} AS raw_stage FROM customer)""",
        "clean_year": with_base(f"""
SELECT c_custkey, raw_year, {clean_year('raw_year', sent)} AS year
FROM (SELECT c_custkey, {raw_year} AS raw_year FROM raw_entities)"""),
        "stage_rollup": f"""
SELECT c_custkey, raw_stage,
       CASE WHEN regexp_matches(raw_stage, {pat}) THEN regexp_extract(raw_stage, {pat}, 1) ELSE {q(sent)} END AS stage
FROM (SELECT c_custkey, {substage} AS raw_stage FROM customer)""",
        "known_stage_filter": with_base("SELECT hn, year, stage, row_idx FROM entities"),
        "active_filter": with_base(
            "SELECT hn, year, stage, treatment, row_idx FROM events WHERE treatment IN (SELECT treatment FROM act_dim) "
            f"AND treatment NOT IN {in_list(tpch_spec().non_active)}"
        ),
        "non_active_filter": with_base(
            f"SELECT hn, year, stage, treatment, row_idx FROM events WHERE treatment NOT IN {in_list(tpch_spec().non_active)}"
        ),
        "distinct_entity_modality": with_base(
            f"SELECT DISTINCT hn, stage, treatment FROM events WHERE treatment NOT IN {in_list(tpch_spec().non_active)}"
        ),
        "years_list": with_base("SELECT year FROM years"),
        "scoped_entities": with_base("SELECT scope, hn, year, stage, row_idx FROM ent_s"),
        "stage_totals": with_base("SELECT scope, CAST(stage_ord AS INTEGER) AS stage_ord, stage, label, patients FROM stage_table"),
        "known_total": with_base("SELECT scope, known_patients, CAST(stage_count AS INTEGER) AS stage_count FROM summary_full"),
        "event_total": with_base("SELECT scope, treatment_events FROM summary_full"),
        "unknown_total": with_base("SELECT scope, unknown_patients FROM summary_full"),
        "unknown_total_override": with_base("SELECT scope, unknown_patients FROM summary_full", override=119),
        "summary": with_base(
            "SELECT scope, known_patients, treatment_events, CAST(stage_count AS INTEGER) AS stage_count, unknown_patients, "
            "active_patients, multimodal_patients, multimodal_percent FROM summary_full"
        ),
        "multimodal_by_stage": with_base(
            "SELECT scope, stage, patients, active_patients, multimodal_patients, multimodal_percent FROM stage_table"
        ),
        "coverage_heatmap": with_base(HEATMAP_SELECT),
        "coverage_heatmap_wide": with_base(HEATMAP_SELECT, "W"),
        "coverage_peak": with_base("""
SELECT scope, treatment, stage AS peak_stage, percent AS peak_percent, count AS peak_count FROM (
  SELECT *, row_number() OVER (PARTITION BY scope, treatment ORDER BY percent DESC, stage_ord ASC) AS rn FROM heatmap)
WHERE rn = 1"""),
        "coverage_trend": with_base(f"""
SELECT scope, treatment, first_percent, last_percent, last_percent - first_percent AS change FROM (
  SELECT scope, treatment,
         max(CASE WHEN stage_ord = 0 THEN percent END) AS first_percent,
         max(CASE WHEN stage_ord = {len(tpch_spec().stages) - 1} THEN percent END) AS last_percent
  FROM heatmap GROUP BY scope, treatment)"""),
        "heat_intensity": with_base("""
SELECT scope, treatment, stage,
       CASE WHEN count = 0 THEN NULL ELSE greatest(CAST(0.22 AS DOUBLE), CAST(0.86 AS DOUBLE) - percent / CAST(100 AS DOUBLE)) END AS wash,
       CASE WHEN count = 0 THEN NULL ELSE greatest(CAST(0.22 AS DOUBLE), CAST(0.86 AS DOUBLE) - percent / CAST(100 AS DOUBLE)) > CAST(0.53 AS DOUBLE) END AS dark_text,
       count = 0 AS empty
FROM heatmap"""),
        "stage_modality_flow": with_base("SELECT scope, stage, treatment, count AS n FROM heatmap WHERE count > 0"),
        "modality_mix_by_stage": with_base(MIX_SELECT),
        "entity_modality_set": with_base("""
SELECT p.scope, p.hn, CAST(p.n_modalities AS INTEGER) AS n_modalities, f.first_idx, p.regimen
FROM psets p JOIN first_seen f ON f.scope = p.scope AND f.hn = p.hn"""),
        "regimen_label": with_base("""
SELECT t.treatment, COALESCE(a.short, t.treatment) AS label, CAST(a.reg_ord AS INTEGER) AS regimen_ord
FROM (SELECT DISTINCT treatment FROM events) t LEFT JOIN act_dim a ON a.treatment = t.treatment"""),
        "entity_stage_lookup": with_base("SELECT scope, hn, stage, regimen, first_idx FROM assigned"),
        "regimen_counts": with_base("SELECT scope, stage, regimen, n, first_idx FROM regimen_counts"),
        "regimen_topk": with_base(REGIMEN_SELECT),
        "regimen_topk_wide": with_base(REGIMEN_SELECT, "W"),
        "active_denominator_heatmap": with_base(HEATMAP_SELECT, variant=True),
        "active_denominator_regimens": with_base(REGIMEN_SELECT, variant=True),
        "regimen_topk_min_share": with_base(REGIMEN_SELECT, variant=True, min_share=5.0),
        "clinical_regimen_topk": with_base(REGIMEN_SELECT, "C"),
        "clinical_coverage_heatmap": with_base(HEATMAP_SELECT, "C"),
        "clinical_summary": with_base(
            "SELECT scope, known_patients, treatment_events, CAST(stage_count AS INTEGER) AS stage_count, unknown_patients, "
            "active_patients, multimodal_patients, multimodal_percent FROM summary_full",
            "C",
        ),
        "clinical_multimodal_by_stage": with_base(
            "SELECT scope, stage, patients, active_patients, multimodal_patients, multimodal_percent FROM stage_table", "C"
        ),
        "dashboard_slice": with_base(f"""
SELECT scope, {scope_label('scope')} AS scope_label, {fmt_count('known_patients')} AS known_fmt,
       {fmt_pct('multimodal_percent')} AS multimodal_fmt, {fmt_count('stage_count')} AS stage_count_fmt,
       {fmt_count('treatment_events')} AS events_fmt, {fmt_count('unknown_patients')} AS unknown_fmt,
       {HEADLINE.format(mm=fmt_count('multimodal_patients'), act=fmt_count('active_patients'))} AS headline
FROM summary_full WHERE scope = {q(ALL_SCOPE)}"""),
        "dashboard_slice_latest": with_base(f"""
SELECT scope, {scope_label('scope')} AS scope_label, {fmt_count('known_patients')} AS known_fmt,
       {fmt_pct('multimodal_percent')} AS multimodal_fmt, {fmt_count('stage_count')} AS stage_count_fmt,
       {fmt_count('treatment_events')} AS events_fmt, {fmt_count('unknown_patients')} AS unknown_fmt,
       {HEADLINE.format(mm=fmt_count('multimodal_patients'), act=fmt_count('active_patients'))} AS headline
FROM summary_full WHERE scope = (SELECT max(year) FROM years)"""),
        "headline": with_base(
            f"SELECT scope, {HEADLINE.format(mm=fmt_count('multimodal_patients'), act=fmt_count('active_patients'))} AS headline FROM summary_full"
        ),
        "display_columns": with_base(f"""
SELECT scope, stage, {scope_label('scope')} AS scope_label, {fmt_count('patients')} AS patients_fmt,
       {fmt_pct('multimodal_percent')} AS multimodal_fmt, stage = {q(tpch_spec().small_n_stage)} AS caution,
       CASE WHEN stage = {q(tpch_spec().small_n_stage)} THEN ' · n น้อย ระวังการตีความ' ELSE '' END AS caution_note
FROM stage_table"""),
        "regimen_display": with_base(
            f"SELECT scope, stage, rank, {fmt_pct('percent')} AS percent_fmt, {fmt_count('count')} AS count_fmt FROM regimens"
        ),
        "document_roundtrip": with_base(HEATMAP_SELECT),
        "document_summary": with_base(
            """SELECT scope, known_patients AS "knownStagePatients", treatment_events AS "treatmentEvents", CAST(stage_count AS INTEGER) AS "stageCount",
       unknown_patients AS "unknownStagePatients", active_patients AS "activePatients", multimodal_patients AS "multimodalPatients",
       multimodal_percent AS "multimodalPercent" FROM summary_full""",
            "C",
        ),
        "document_stages": with_base("SELECT scope, CAST(stage_ord AS INTEGER) AS place, stage, label, name, color, patients FROM stage_table", "C"),
        "document_panels": with_base(
            """SELECT t.scope, CAST(t.stage_ord AS INTEGER) AS panel, t.stage, t.label, t.name AS stage_name, t.color, t.patients,
       t.active_patients AS "activePatients", t.multimodal_patients AS "multimodalPatients", t.multimodal_percent AS "multimodalPercent",
       CAST(row_number() OVER (PARTITION BY t.scope, t.stage ORDER BY r.rank) - 1 AS INTEGER) AS place, r.regimen, r.count, r.percent, r.width, r.combined
FROM stage_table t JOIN regimens r ON r.scope = t.scope AND r.stage = t.stage
UNION ALL
SELECT t.scope, CAST(t.stage_ord AS INTEGER), t.stage, t.label, t.name, t.color, t.patients, t.active_patients, t.multimodal_patients, t.multimodal_percent,
       NULL, NULL, NULL, NULL, NULL, NULL
FROM stage_table t WHERE NOT EXISTS (SELECT 1 FROM regimens r WHERE r.scope = t.scope AND r.stage = t.stage)""",
            "C",
        ),
        "document_heatmap": with_base(HEATMAP_SELECT, "C"),
        "document_heads": with_base(
            f"""SELECT 'years' AS part, CAST(row_number() OVER (ORDER BY year) - 1 AS INTEGER) AS place, year AS value FROM years
UNION ALL SELECT part, place, value FROM {values([("notes", i, n) for i, n in enumerate(clinical_spec().notes)], ["part", "place", "value"])}
UNION ALL SELECT 'sourceFile', 0, 'customer.parquet+orders.parquet'""",
            "C",
        ),
        "trap_regimen_topk": with_base(REGIMEN_SELECT, "T"),
        "trap_coverage_heatmap": with_base(HEATMAP_SELECT, "T"),
        "trap_summary": with_base(
            "SELECT scope, known_patients, treatment_events, CAST(stage_count AS INTEGER) AS stage_count, unknown_patients, "
            "active_patients, multimodal_patients, multimodal_percent FROM summary_full",
            "T",
        ),
        "trap_stage_totals": with_base("SELECT scope, stage, label, name, color, patients, active_patients, multimodal_patients FROM stage_table", "T"),
        "trap_stage_lookup": with_base("SELECT scope, hn, stage, first_idx FROM assigned", "T"),
        "variant_coverage_peak": with_base(
            """
SELECT scope, treatment, stage AS peak_stage, percent AS peak_percent, count AS peak_count FROM (
  SELECT *, row_number() OVER (PARTITION BY scope, treatment ORDER BY percent DESC, stage_ord ASC) AS rn FROM heatmap)
WHERE rn = 1""",
            variant=True,
        ),
        "variant_coverage_trend": with_base(
            f"""
SELECT scope, treatment, first_percent, last_percent, last_percent - first_percent AS change FROM (
  SELECT scope, treatment,
         max(CASE WHEN stage_ord = 0 THEN percent END) AS first_percent,
         max(CASE WHEN stage_ord = {len(tpch_spec().stages) - 1} THEN percent END) AS last_percent
  FROM heatmap GROUP BY scope, treatment)""",
            variant=True,
        ),
    }
    cell = "max(CASE WHEN treatment = '{}' AND stage = '{}' THEN percent END)"
    shown = [fmt_pct(cell.format(*c)) for c in (("Hormone", "I"), ("Hormone", "IV"), ("Radiation", "III"), ("Chemotherapy", "IV"))]
    out["clinical_heat_note"] = with_base(
        f"""
SELECT scope, 'ADT ' || {shown[0]} || ' ถึง ' || {shown[1]} || ' · รังสีสูงสุดที่ระยะ III ' || {shown[2]} || ' · เคมีบำบัดเด่นในระยะ IV ' || {shown[3]} AS note
FROM heatmap GROUP BY scope""",
        "C",
    )
    for what in ("summary", "heatmap"):
        out[f"document_parts_{what}"] = out[f"document_{what}"]
    out["document_parts_manifest"] = out["document_heads"]
    out["wide_entity_modality_set"] = with_base(
        """
SELECT p.scope, p.hn, CAST(p.n_modalities AS INTEGER) AS n_modalities, f.first_idx, p.regimen
FROM psets p JOIN first_seen f ON f.scope = p.scope AND f.hn = p.hn""",
        "X",
    )
    out["wide_regimen_topk"] = with_base(REGIMEN_SELECT, "X")
    out["wide_coverage_heatmap"] = with_base(HEATMAP_SELECT, "X")
    out["wide_multimodal_by_stage"] = with_base(
        "SELECT scope, stage, patients, active_patients, multimodal_patients, multimodal_percent FROM stage_table", "X"
    )
    out["wide_modality_mix"] = with_base(MIX_SELECT, "X")
    out |= ingest_sql()
    return {k: v.strip() for k, v in out.items()}


def ingest_sql() -> dict[str, str]:
    """The exported files' rows and order, from the tables they were written from."""
    book = BOOK.format("hn")
    odd = f"CASE WHEN ({book}) % 2 = 0 THEN year END"
    whole = {
        "entities": ("raw_entities", "hn, year, stage", "hn, year, stage"),
        "events": ("raw_events", "hn, year, stage, treatment", "hn, year, stage, treatment"),
        "unknown": (f"(SELECT * FROM raw_entities WHERE stage = {q(TPCH_UNKNOWN_SEGMENT)})", f"hn, {odd} AS year", "hn, year"),
    }
    out = {}
    for what, (table, in_books, in_text) in whole.items():
        above = 1 if what == "unknown" else 0  # a preamble row
        out[f"workbook_{what}"] = with_base(
            f"""
SELECT {in_books}, (SELECT count(DISTINCT {BOOK.format('c.c_custkey')}) FROM customer c WHERE {BOOK.format('c.c_custkey')} < {BOOK.format('t.hn')}) AS book_rank,
       row_number() OVER (PARTITION BY {book} ORDER BY row_idx) + {above} AS sheet_row
FROM {table} t""",
            "C",
        )
        out[f"text_{what}"] = with_base(f"SELECT {in_text}, row_number() OVER (ORDER BY {book}, row_idx) AS place FROM {table} t", "C")
    out["workbook_override"] = f"""
SELECT printf('book-%09d.xlsx', book) AS book,
       CASE book % 6 WHEN 1 THEN 'not counted' WHEN 3 THEN CAST(book + 1 AS VARCHAR) WHEN 4 THEN (book + 1) || '.75' WHEN 5 THEN ' ' || (book + 1) || ' ' END AS cell,
       CASE WHEN book % 6 >= 3 THEN book + 1 END AS override
FROM (SELECT DISTINCT {BOOK.format('c_custkey')} AS book FROM customer)"""
    out["workbook_summary"] = with_base(
        "SELECT scope, known_patients, treatment_events, CAST(stage_count AS INTEGER) AS stage_count, unknown_patients, "
        "active_patients, multimodal_patients, multimodal_percent FROM summary_full",
        "C",
        unknown_year=odd,
    )
    out["workbook_regimen_topk"] = with_base(REGIMEN_SELECT, "C", books=True)
    out["text_regimen_topk"] = with_base(REGIMEN_SELECT, "C", books=True)
    return out


HEATMAP_SELECT = "SELECT scope, CAST(heat_ord AS INTEGER) AS heat_ord, treatment, label, CAST(stage_ord AS INTEGER) AS stage_ord, stage, count, percent FROM heatmap"
REGIMEN_SELECT = "SELECT scope, stage, rank, regimen, count, percent, width, combined FROM regimens"
MIX_SELECT = f"""
SELECT scope, stage, treatment, label, n, {pct('n', 'sum(n) OVER (PARTITION BY scope, stage)', 1)} AS share FROM (
  SELECT p.scope, p.stage, p.treatment, a.short AS label, count(DISTINCT p.hn) AS n
  FROM pt p JOIN act_dim a ON a.treatment = p.treatment GROUP BY p.scope, p.stage, p.treatment, a.short)"""
