"""Cohort specification: the dimensions and parameters a build runs against.

A :class:`CohortSpec` carries everything that is domain specific (which stages
exist and in which order, which modalities count as active, which appear in the
coverage heatmap, how regimen names are spelled).  The operators are generic
DataFrame functions parameterised by it, so the same plan runs on the clinical
domain and on the TPC-H-shaped test tables.

Bitmask encoding.  Per-entity modality sets are ``bigint`` bitmasks, which keeps
every aggregate fixed width (``bit_or`` / ``min`` / ``count``) so Spark can
partially aggregate before the shuffle.  Bit positions are assigned here:

* active modality ``m``  -> bit ``regimen position of its short label``
* cell ``(s, v)``         -> bit ``s * len(cell_values) + v`` (heatmap rows, then
  the active modalities that are no heatmap row: coverage and modality mix)
* stage ``s``             -> bit ``s`` (for per-entity stage membership)

A mask of more than 63 bits is several bigint columns; cells beyond 63 are masks
by stage (``rollup.cell_rollup``).
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

MAX_BITS = 63
ALL_SCOPE = "all"


@dataclass(frozen=True)
class Stage:
    code: str
    label: str
    name: str
    color: str


@dataclass(frozen=True)
class Modality:
    value: str  # modality as it appears on the event row
    short: str  # short label used inside regimen names


@dataclass(frozen=True)
class HeatRow:
    value: str  # modality value
    label: str  # row label in the coverage heatmap


@dataclass(frozen=True)
class CohortSpec:
    stages: tuple[Stage, ...]
    modalities: tuple[Modality, ...]  # the active whitelist, in dimension order
    regimen_order: tuple[str, ...]  # short-label order inside a regimen name
    heatmap: tuple[HeatRow, ...]  # coverage rows, in display order
    non_active: tuple[str, ...]  # blacklist applied before coverage and sets
    sentinel: str = "ไม่ระบุ"
    tail_label: str = "อื่นๆ (รวม)"
    top_k: int = 6
    denominator: str = "all"  # 'all' = patients in stage, 'active' = active patients in stage
    coverage_digits: int = 0
    regimen_digits: int = 1
    width_digits: int = 1
    multimodal_digits: int = 0
    min_share: float | None = None  # optional extra cut-off for shown regimens (off by default)
    small_n_stage: str | None = None  # stage that carries the small-n caution flag (page parity)
    small_n_threshold: int | None = None  # optional: also flag any stage with fewer patients
    notes: tuple[str, ...] = field(default_factory=tuple)

    def __post_init__(self) -> None:
        if self.denominator not in ("all", "active"):
            raise ValueError("denominator must be 'all' or 'active'")
        if self.top_k < 1:
            raise ValueError("top_k must be positive")
        for what, values in (
            ("stage codes", [st.code for st in self.stages]),
            ("active modalities", [m.value for m in self.modalities]),
            ("heatmap rows", [h.value for h in self.heatmap]),
        ):
            if len(set(values)) != len(values):
                raise ValueError(f"duplicate {what}: each one owns a bit position")

    # -- derived dimension views -------------------------------------------------
    @property
    def stage_codes(self) -> list[str]:
        return [s.code for s in self.stages]

    @property
    def heat_values(self) -> list[str]:
        return [h.value for h in self.heatmap]

    @property
    def active_values(self) -> list[str]:
        return [m.value for m in self.modalities]

    def regimen_modalities(self) -> list[Modality]:
        """Active modalities sorted into regimen order; labels missing from the
        order list go last, keeping dimension order among themselves."""
        n = len(self.regimen_order)

        def key(item: tuple[int, Modality]) -> tuple[int, int]:
            i, m = item
            pos = self.regimen_order.index(m.short) if m.short in self.regimen_order else n
            return pos, i

        return [m for _, m in sorted(enumerate(self.modalities), key=key)]

    @property
    def cell_values(self) -> list[str]:
        """Modalities that own cells: heatmap rows first, then the other active ones."""
        return self.heat_values + [v for v in self.active_values if v not in self.heat_values]

    def cells_fit_one_mask(self) -> bool:
        return len(self.stages) * len(self.cell_values) <= MAX_BITS

    def with_params(self, **kw) -> CohortSpec:
        return replace(self, **kw)


# ---------------------------------------------------------------------------
# Fixed values of the clinical domain.  These must equal the source workbook's
# vocabulary for the results to match, so they are stated here as plain text, in
# their natural order, together.  Spelling (including "Immonotherapy") is kept.
# ---------------------------------------------------------------------------
CLINICAL_STAGES = (
    Stage("I", "ระยะ I", "ระยะเริ่มต้น", "#2E8B7F"),
    Stage("II", "ระยะ II", "ระยะลุกลามเฉพาะที่", "#2F6DB0"),
    Stage("III", "ระยะ III", "ระยะลุกลามต่อมน้ำเหลือง", "#D98A2B"),
    Stage("IV", "ระยะ IV", "ระยะแพร่กระจาย", "#C0453B"),
)
CLINICAL_MODALITIES = (
    Modality("Hormone", "ADT"),
    Modality("Radiation", "RT"),
    Modality("Surgery", "RP"),
    Modality("Chemotherapy", "Chemo"),
    Modality("Targeted Therapy", "ARPI"),
    Modality("Interventional", "IR"),
    Modality("Immonotherapy", "IO"),
    Modality("Other", "อื่นๆ"),
)
CLINICAL_REGIMEN_ORDER = ("RP", "RT", "ADT", "Chemo", "ARPI", "IR", "IO", "อื่นๆ")
CLINICAL_HEATMAP = (
    HeatRow("Hormone", "ฮอร์โมน (ADT)"),
    HeatRow("Radiation", "รังสีรักษา (RT)"),
    HeatRow("Surgery", "ผ่าตัด (RP)"),
    HeatRow("Chemotherapy", "เคมีบำบัด"),
    HeatRow("Targeted Therapy", "มุ่งเป้า (ARPI)"),
    HeatRow("Interventional", "หัตถการ (IR)"),
    HeatRow("Immonotherapy", "ภูมิคุ้มกัน (IO)"),
)
CLINICAL_NON_ACTIVE = ("Loss Follow-up", "Refer", "Supportive", "ปฏิเสธการรักษา", "ไม่ระบุ")
CLINICAL_NOTES = (
    "รวมระยะย่อย IIA/IIB/IIC เป็น II, IIIA/IIIB/IIIC เป็น III, IVA/IVB เป็น IV",
    "Heatmap นับต่อผู้ป่วยต่อวิธีการรักษา ส่วนเหตุการณ์การรักษาทั้งหมดมาจาก Treatment Data",
    "Regimen นับชุดวิธีการรักษาต่อผู้ป่วย โดยตัดกลุ่มประคับประคอง ส่งต่อ ปฏิเสธ ขาดติดตาม และไม่ระบุออกจากการจัดชุด",
)
CLINICAL_SUBSTAGE_PATTERN = r"^(IV|III|II|I)[A-C]?$"


def clinical_spec(**overrides) -> CohortSpec:
    """The published clinical configuration (all-patient denominators)."""
    spec = CohortSpec(
        stages=CLINICAL_STAGES,
        modalities=CLINICAL_MODALITIES,
        regimen_order=CLINICAL_REGIMEN_ORDER,
        heatmap=CLINICAL_HEATMAP,
        non_active=CLINICAL_NON_ACTIVE,
        small_n_stage="I",
        notes=CLINICAL_NOTES,
    )
    return spec.with_params(**overrides) if overrides else spec


def active_only_variant(spec: CohortSpec, drop: tuple[str, ...]) -> CohortSpec:
    """The snapshot variant: some active modalities removed from the regimen
    whitelist and every percentage taken over active patients of the stage."""
    keep = tuple(m for m in spec.modalities if m.value not in drop)
    return spec.with_params(modalities=keep, denominator="active")


# ---------------------------------------------------------------------------
# Test-table specs (TPC-H-shaped tables, see FIXTURES.md §3).  Market segments
# play the stages, order priority (optionally with status) plays the modality.
# ---------------------------------------------------------------------------
_SEGMENT_COLORS = ("#2E8B7F", "#2F6DB0", "#D98A2B", "#C0453B")
TPCH_STAGE_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD")
TPCH_UNKNOWN_SEGMENT = "MACHINERY"
TPCH_PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
TPCH_NON_ACTIVE_PRIORITY = "4-NOT SPECIFIED"
TPCH_STATUSES = ("F", "O", "P")
# Encoding X: labels in all, the first of them active, the first of those heatmap rows.
WIDE_LABELS, WIDE_ACTIVE, WIDE_HEAT = 75, 70, 66


def _tpch_stages() -> tuple[Stage, ...]:
    return tuple(
        Stage(code, f"Stage {i + 1}", code.title(), color)
        for i, (code, color) in enumerate(zip(TPCH_STAGE_SEGMENTS, _SEGMENT_COLORS))
    )


def tpch_spec(encoding: str = "P", **overrides) -> CohortSpec:
    """Encoding P: priority is the modality, short label drops the ``n-`` prefix.
    Encoding W: ``priority/status``, short label is first digit + status, and
    only the first seven active values are heatmap rows.
    Encoding T: as P, on input that holds the traps of SURVEY §1.1.
    Encoding X: more labels than a bigint has bits, derived from the order's keys."""
    actives = [p for p in TPCH_PRIORITIES if p != TPCH_NON_ACTIVE_PRIORITY]
    if encoding in ("P", "T"):
        mods = tuple(Modality(p, p.split("-", 1)[1]) for p in actives)
        heat = tuple(HeatRow(m.value, m.short.title()) for m in mods)
        non_active = (TPCH_NON_ACTIVE_PRIORITY,)
    elif encoding == "W":
        mods = tuple(Modality(f"{p}/{s}", f"{p[0]}{s}") for p in actives for s in TPCH_STATUSES)
        heat = tuple(HeatRow(m.value, m.short) for m in mods[:7])
        non_active = tuple(f"{TPCH_NON_ACTIVE_PRIORITY}/{s}" for s in TPCH_STATUSES)
    elif encoding == "X":
        labels = [f"M{k:02d}" for k in range(WIDE_LABELS)]
        mods = tuple(Modality(v, v.lower()) for v in labels[:WIDE_ACTIVE])
        heat = tuple(HeatRow(m.value, m.short) for m in mods[:WIDE_HEAT])
        non_active = tuple(labels[WIDE_ACTIVE : WIDE_ACTIVE + 2])
    else:
        raise ValueError(f"unknown encoding {encoding!r}")
    spec = CohortSpec(
        stages=_tpch_stages(),
        modalities=mods,
        regimen_order=tuple(m.short for m in mods),
        heatmap=heat,
        non_active=non_active,
        small_n_stage=TPCH_STAGE_SEGMENTS[0],
    )
    return spec.with_params(**overrides) if overrides else spec
