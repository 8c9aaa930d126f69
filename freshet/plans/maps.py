"""Node maps, rule tables and templates.

Everything below is a fixed value that results depend on: node codes are names
in the external model outputs, the other numbers are published parameters.
"""

from __future__ import annotations


def table(text: str) -> list[list[str]]:
    """Rows of a ``|``-separated text table."""
    return [[cell.strip() for cell in line.split("|")] for line in text.strip().splitlines()]


def nodes(cell: str) -> list[str]:
    return cell.split()


# Places in publication order.
PLACES = """
Upper Sacramento River
Antelope Creek
Battle Creek
Bear Creek
Big Chico Creek
Butte Creek
Clear Creek
Cottonwood Creek
Cow Creek
Deer Creek
Elder Creek
Mill Creek
Paynes Creek
Stony Creek
Thomes Creek
Upper-mid Sacramento River
Sutter Bypass
Bear River
Feather River
Yuba River
Lower-mid Sacramento River
Yolo Bypass
American River
Lower Sacramento River
Calaveras River
Cosumnes River
Mokelumne River
Merced River
Stanislaus River
Tuolumne River
San Joaquin River
""".strip().splitlines()

# Flow node of each place. place | CalSim II | CalSim 3
FLOW_NODES = table("""
Upper Sacramento River | C104 | C_SAC273
Antelope Creek | C11307 | C_ANT010
Battle Creek | C10803 | C_BTL006
Bear Creek | C11001 | C_BCN005
Big Chico Creek | C11501 | C_BCC004
Butte Creek | C217A | C_BTC012
Clear Creek | C3 | C_CLR009
Cottonwood Creek | C10802 | C_CWD003
Cow Creek | C10801 | C_COW003
Deer Creek | C11309 | C_DRC005
Elder Creek | C11303 | C_ELD005
Mill Creek | C11308 | C_MLC004
Paynes Creek | C11001 | C_PYN001
Stony Creek | C142A | C_STN004
Thomes Creek | C11304 | C_THM005
Upper-mid Sacramento River | C115 | C_SAC193
Bear River | C285 | C_CMPFW
Feather River | C203 | C_FTR059
Yuba River | C230 | C_YUB002
Lower-mid Sacramento River1 | C134 | C_SAC093
Lower-mid Sacramento River2 | C160 | C_SAC048
American River | C9 | C_NTOMA
Lower Sacramento River | C166 | C_SAC063
Calaveras River | C92 | C_NHGAN
Cosumnes River | C501 | C_CSM005
Mokelumne River | | C_CMCHE
Merced River | C561 | C_MCD050
Stanislaus River | C520 | C_STS059
Tuolumne River | C540 | C_TUO054
San Joaquin River | C630 | C_SJR081
""")
LOWER_MID = ("Lower-mid Sacramento River1", "Lower-mid Sacramento River2")
MOKELUMNE = "Mokelumne River"

# CalSim II diversions. place | diversion nodes | denominator nodes
# A denominator starting with + is added to the diversion itself.
DIVERSIONS_2 = table("""
Upper Sacramento River | D104 | C104
Butte Creek | C217B D217 | + C217A
Stony Creek | D17301 | C42
Upper-mid Sacramento River | D109 D112 D113A D113B D114 D118 D122A D122B D123 D124A D128_WTS D128 | C110
Bear River | D285 | + C285
Feather River | D201 D202 D7A D7B | C6
Yuba River | D230 | + C230
Lower-mid Sacramento River | D129A D134 D162 D165 | C128
American River | D302 | C9
Lower Sacramento River | D167 D168 D168A_WTS | C166
Calaveras River | D506A D506B D506C D507 | C92
Merced River | D562 D566 | C561
Stanislaus River | D528 | C520
Tuolumne River | D545 | C540
San Joaquin River | D637 D630B D630A D620B | + C637
""")

# CalSim II diversions shared by several creeks. group | place | own node | shared node
SHARED_2 = table("""
east | Antelope Creek | C11307 | D11305
east | Deer Creek | C11309 | D11305
east | Mill Creek | C11308 | D11305
west | Elder Creek | C11303 | D11301
west | Thomes Creek | C11304 | D11301
""")

# Mokelumne nodes of the separate east-side model.
MOKELUMNE_FLOW = "C91"
MOKELUMNE_DIVERSIONS = nodes("D503A D503B D503C D502A D502B")

# CalSim 3 diversions. place | diversion nodes | denominator nodes
DIVERSIONS_3 = table("""
Upper Sacramento River | D_SAC296_WTPFTH D_SAC296_02_SA D_SAC294_WTPBLV D_SAC294_03_PA D_SAC289_03_SA D_SAC281_02_NA D_SAC273_03_NA | C_SAC273
Antelope Creek | D_ANT010_05_NA | C_ANT010
Butte Creek | D_BTC045_ESL008 D_BTC043_10_NA D_BTC036_10_NA D_BTC012_09_SA2 D_BTC012_CRK005 | + C_BTC012
Deer Creek | D_DRC010_05_NA D_DRC005_05_NA | C_DRC005
Elder Creek | D_ELD012_04_NA | C_ELD005
Mill Creek | D_MLC006_05_NA | C_MLC004
Stony Creek | D_STN021_06_PA | C_STN026
Thomes Creek | D_THM012_04_NA | C_THM005
Upper-mid Sacramento River | D_SAC240_TCC001 D_SAC240_05_NA D_SAC224_04_NA D_SAC196_MTC000 D_SAC185_08N_NA D_SAC185_09_NA D_SAC178_08N_SA1 D_SAC162_09_SA2 D_SAC159_08S_SA1 D_SAC159_08N_SA1 D_SAC146_08S_NA1 D_SAC136_18_NA D_SAC136_18_SA D_SAC129_08S_NA2 D_SAC122_19_SA | C_SAC247
Bear River | D_BRR017_23_NA | + C_CMPFW
Feather River | D_THRMF_12_NU1 D_THRMF_11_NU1 D_THRMA_WEC000 D_THRMA_RVC000 D_THRMA_JBC000 | C_OROVL
Yuba River | D_YUB011_15S_NA2 | + C_YUB002
Lower-mid Sacramento River | D_SAC121_08S_SA3 D_SAC115_19_SA D_SAC109_08S_SA3 D_SAC109_19_SA D_SAC099_19_SA D_SAC091_19_SA D_SAC083_21_SA D_SAC082_22_SA1 D_SAC081_21_NA D_SAC078_22_SA1 D_SAC075_22_NA D_SAC074_21_SA D_SAC065_WTPBTB | C_SAC120
American River | D_AMR007_WTPFBN | C_NTOMA
Lower Sacramento River | D_SAC050_FPT013 D_SAC062_WTPSAC | C_SAC063
Calaveras River | D_LJC022_60S_PA1 D_CLV037_CACWD D_CLV026_60S_PA1 D_CLV026_WTPWDH | C_NHGAN
Mokelumne River | D_MOK050_60N_NA3 D_MOK050_60N_NA5 D_MOK039_60N_NA5 D_MOK035_60N_NA4 D_MOK035_60N_NU1 D_MOK035_WTPDWS D_MOK033_60N_NA5 | C_CMCHE
Merced River | D_MCD042_63_NA2 D_MCD021_63_NA4 | C_MCD050
Stanislaus River | D_STS030_61_NA4 D_STS004_61_NA6 | C_STS059
Tuolumne River | D_TUO047_61_NA3 D_TUO047_62_NA4 D_TUO015_61_NA3 D_TUO015_62_NA4 | C_TUO054
San Joaquin River | D_SJR062_50_PA1 D_SJR090_71_NA2 D_SJR081_61_NA5 D_SJR116_72_NA1 | + C_SJR072
""")

# How the action_5 formulas differ. Nodes left out; denominators replaced.
ACTION_5_WITHOUT = {"D_SAC289_03_SA", "D_BTC012_09_SA2", "D_MCD042_63_NA2"}
ACTION_5_DENOMINATORS = {"Lower Sacramento River": "C_SAC120"}

# The Yuba denominator as published for LTO_12a (compat only).
YUBA_COMPAT_DENOMINATOR = "D_YUB011_15S_NA2"
# Places whose LTO_12a proportion has no cap.
UNCAPPED_3 = ("Yuba River", "Stanislaus River")

# Bypass segments from upstream to downstream. bypass | segment | CalSim II | CalSim 3
BYPASS_SEGMENTS = table("""
Sutter Bypass | sutter1 | D117 | SP_SAC193_BTC003 SP_SAC188_BTC003 SP_SAC178_BTC003
Sutter Bypass | sutter2 | C135 | C_BTC003
Sutter Bypass | sutter3 | C136A | C_SBP024
Sutter Bypass | sutter4 | C137 | C_SSL001
Yolo Bypass | yolo1 | D160 | SP_SAC083_YBP037
Yolo Bypass | yolo2 | C157 | C_CSL005
""")
LAST_SEGMENTS = {"sutter4": "Sutter Bypass", "yolo2": "Yolo Bypass"}

# Delta node sets. measure | CalSim II | CalSim 3
DELTA_NODES = table("""
n_dlt_inflow_cfs | C400 C157 | C_SAC041 C_CSL005
s_dlt_inflow_cfs | C401B C504 C508 C644 | C_SAC029B D_SAC030_MOK014 C_MOK022 C_CLV004 C_SJR056
n_dlt_div_cfs | D403A D403B D403C D403D D404 | C_CSL004B DD_SAC017_SACS
s_dlt_div_cfs | D418 D419 D412 D410 D413 D409B D416 D408_OR D408_VC | D_OMR028_DMC000 D_OMR027_CAA000 DD_SJR026_SJRE DD_SJR013_SJRW DD_MOK004_MOK DD_OMR027_OMR D_RSL004_CCC004 D_OMR021_ORP000 D_VCT002_ORP000
""")

# CalSim II codes for CalSim 3 nodes; several nodes are summed. code | nodes
ALIASES = table("""
D117 | SP_SAC193_BTC003 SP_SAC188_BTC003 SP_SAC178_BTC003
D124 | SP_SAC159_BTC003
D125 | SP_SAC148_BTC003
D126 | SP_SAC122_SBP021
D160 | SP_SAC083_YBP037
C116 | C_SAC195
C134 | C_SAC093
C137 | C_SSL001
C160 | C_SAC048
C157 | C_CSL005
""")

# Share of flow entering a bypass. bypass | family | numerator | denominator
BYPASS_RATIOS = table("""
Sutter Bypass | calsim2 | D117 D124 D125 D126 | C116
Yolo Bypass | calsim2 | D160 | C134
Sutter Bypass | action_5 | SP_SAC193_BTC003 SP_SAC188_BTC003 SP_SAC178_BTC003 | C_SAC195
Yolo Bypass | action_5 | SP_SAC083_YBP037 | + C_SAC048
""")

# Nodes whose sum tells overtopping. bypass | CalSim II | CalSim 3
OVERTOPPED_NODES = table("""
Sutter Bypass | D117 D124 D125 D126 C137 | SP_SAC193_BTC003 SP_SAC188_BTC003 SP_SAC178_BTC003 SP_SAC159_BTC003 SP_SAC148_BTC003 SP_SAC122_SBP021 C_SSL001
Yolo Bypass | D160 C157 | SP_SAC083_YBP037 C_CSL005
""")
OVERTOPPED_CFS = 100.0

# Month x year matrices. dataset | CalSim II | CalSim 3
MATRIX_NODES = table("""
upper_sacramento_flows | C109 | C_SAC257
wilkins_flow | C129 | C_SAC129
freeport_flow | C400 | C_SAC041
vernalis_flow | C639 | C_SJR070
stockton_flow | C417A | C_SJR053A
cvp_exports | DEL_CVP_TOTAL | DEL_CVP_TOTAL_N DEL_CVP_TOTAL_S
swp_exports | DEL_SWP_TOTAL | DEL_SWP_PMI DEL_SWP_PAG DEL_SWP_PIN
""")

# Nodes of the miscellaneous flow table.
MISC_NODES = nodes("C134 C165 C116 C123 C124 C125 C109 D160 D166A D117 D124 D125 D126")
# Candidates compared for the bypass and lower-mid reaches.
CANDIDATE_NODES = nodes("C157 D160 D166A D117 D124 D125 D126 C166 C165 C134 C160")

# The place at whose junction a tributary's share is taken. place | junction
JUNCTIONS = dict(table("""
Upper Sacramento River | Upper-mid Sacramento River
Antelope Creek | Upper-mid Sacramento River
Battle Creek | Upper-mid Sacramento River
Bear Creek | Upper-mid Sacramento River
Big Chico Creek | Upper-mid Sacramento River
Butte Creek | Upper-mid Sacramento River
Clear Creek | Upper-mid Sacramento River
Cottonwood Creek | Upper-mid Sacramento River
Cow Creek | Upper-mid Sacramento River
Deer Creek | Upper-mid Sacramento River
Elder Creek | Upper-mid Sacramento River
Mill Creek | Upper-mid Sacramento River
Paynes Creek | Upper-mid Sacramento River
Stony Creek | Upper-mid Sacramento River
Thomes Creek | Upper-mid Sacramento River
Upper-mid Sacramento River | Upper-mid Sacramento River
Bear River | Feather River
Feather River | Lower-mid Sacramento River
Yuba River | Feather River
Lower-mid Sacramento River | Lower-mid Sacramento River
American River | Lower Sacramento River
Lower Sacramento River | Lower Sacramento River
Calaveras River | Calaveras River
Cosumnes River | Cosumnes River
Mokelumne River | Mokelumne River
Merced River | San Joaquin River
Stanislaus River | San Joaquin River
Tuolumne River | San Joaquin River
San Joaquin River | San Joaquin River
"""))
# Rivers that reach the delta by themselves.
NATAL_FIXED = ("Calaveras River", "Cosumnes River", "Mokelumne River")
BYPASSES = ("Sutter Bypass", "Yolo Bypass")

# Region codes of tagged runs are the place names in lower snake case.
REGION_LABELS = {
    p.lower().replace("-", "_").replace(" ", "_"): p for p in PLACES if p not in BYPASSES
}

# Hatchery rivers.
HATCHERY_PLACES = ["Battle Creek", "Feather River", "American River", "Mokelumne River", "Merced River"]

# Cross-channel gate, days closed by month, January first, and the later overrides.
GATE_DAYS_CLOSED = [31, 28, 31, 30, 20, 15, 0, 0, 0, 0, 0, 15]
GATE_OVERRIDES = {5: 28, 6: 8}

# Labels of the compared annual volumes: model, natural and proposed flows.
VOLUME_LABELS = ("calsim", "Natural flows Database flows", "Proposed Model EFF")

# Year classes. Wet and Above Normal are wet, the others dry.
WET_TYPES = ("Wet", "Above Normal")
DRY_TYPES = ("Critical", "Dry", "Below Normal")

# Monthly flows, January first. river | year type | kind | flows
TEMPLATES = table("""
Sacramento | Wet | proposed | 40000 40000 40000 40000 10700 10700 10700 1000 1000 4750 4750 4750
Sacramento | Wet | natural | 62000 48900 43200 37300 19200 9270 3140 1680 1280 3760 11600 30000
Sacramento | Dry | proposed | 18500 18500 18500 18500 4500 4500 4500 500 500 4750 4750 4750
Sacramento | Dry | natural | 14100 15700 15600 9560 4870 2100 781 626 564 2230 6060 10100
San Joaquin | Wet | proposed | 4500 4500 4500 4500 5038 5038 5038 2000 2000 300 300 300
San Joaquin | Wet | natural | 14566.04708 19385.33385 28678.57203 20474.8476 16403.78026 9007.285804 6470.732515 5570.717137 4372.616735 4358.370875 6803.769081 8721.041508
San Joaquin | Dry | proposed | 5000 5000 5000 5000 2359 2359 2359 2000 300 300 300 300
San Joaquin | Dry | natural | 3731.569149 7637.892379 5533.553387 4005.806462 2616.398723 2319.512281 2223.220098 3122.946727 1153.635494 1595.36601 1380.03132 2005.553837
""")
# Survival (percent) and the Sacramento flow it needs.
SURVIVAL_THRESHOLDS = [(3.0, 4279.0), (18.9, 10712.0), (50.8, 22872.0)]

# Places downstream of the Sacramento change, the floor value, the San Joaquin place.
DELTA_REACHES = (
    "Upper-mid Sacramento River",
    "Lower-mid Sacramento River1",
    "Lower-mid Sacramento River2",
    "Lower Sacramento River",
)
UPPER_SACRAMENTO = "Upper Sacramento River"
SAN_JOAQUIN = "San Joaquin River"
FLOOR_CFS = 100.0

# Regional disaggregation. region total | stream | node | weight
REGION_STREAMS = table("""
WilkinsSlough | Elder Creek | Elder Creek | 1
WilkinsSlough | Thomes Creek | Thomes Creek | 1
WilkinsSlough | Antelope Creek | Antelope Creek | 1
WilkinsSlough | Mill Creek | Mill Creek | 1
WilkinsSlough | Deer Creek | Deer Creek | 1
WilkinsSlough | Big Chico Creek | Big Chico Creek | 1
WilkinsSlough | Stony Creek | Stony Creek | 1
WilkinsSlough | | C184A | 1
WilkinsSlough | | I118 | 1
WilkinsSlough | | I123 | 1
RedBluff | Cow Creek | Cow Creek | 1
RedBluff | Cottonwood Creek | Cottonwood Creek | 1
RedBluff | Battle Creek | Battle Creek | 1
RedBluff | Paynes Creek | Paynes Creek | 1
RedBluff | Bear Creek | I109 | 0.5
RedBluff | | I112 | 1
YubaFeather | Bear River | Bear River | 1
YubaFeather | | I207 | 1
Eastside | Mokelumne River | Mokelumne River | 1
Eastside | Cosumnes River | Cosumnes River | 1
""")
# Delta flows of the climate run. place | nodes
CLIMATE_DELTA = table("""
North Delta | Hood_Outflow
South Delta | Eastside_Outflow DCC_Diversion SJR_Calaveras_Outflow SJR_FlowSplit_C417B
""")
# Weir nodes regressed on the river node, and the flow below which there is no spill.
SPILL_NODES = nodes("D117 D124 D125 D126")
SPILL_RIVER_NODE = "C112"
SPILL_THRESHOLD_CFS = 15000.0

# Scenario -> family, and which scenarios publish a dataset.
FAMILIES = {
    "biop_2008_2009": "calsim2",
    "biop_itp_2018_2019": "calsim2",
    "run_of_river": "calsim2",
    "eff": "calsim2",
    "LTO_12a": "calsim3",
    "LTO_12a_eff_dy": "calsim3",
    "action_5": "action_5",
}
ALL = tuple(FAMILIES)
MODEL_RUNS = ("biop_2008_2009", "biop_itp_2018_2019", "run_of_river", "LTO_12a", "action_5")
AVAILABLE = {
    "flows_cfs": ALL,
    "upper_sacramento_flows": ALL,
    "proportion_pulse_flows": ALL,
    "mean_flow": tuple(s for s in ALL if s != "action_5"),
    "proportion_flow_natal": tuple(s for s in ALL if s != "LTO_12a_eff_dy"),
    **{
        d: MODEL_RUNS
        for d in (
            "bypass_flows", "total_diverted", "proportion_diverted", "delta_flows", "delta_inflow",
            "delta_proportion_diverted", "delta_total_diverted", "proportion_flow_bypasses",
            "gates_overtopped", "freeport_flow", "vernalis_flow", "stockton_flow", "cvp_exports",
            "swp_exports",
        )
    },
    "delta_cross_channel_closed": MODEL_RUNS[:-1],
    "wilkins_flow": MODEL_RUNS[:-1],
    "san_joaquin_flows": ("eff", "LTO_12a_eff_dy", "action_5"),
    "hatchery_oct_nov_flows": ("biop_itp_2018_2019", "LTO_12a"),
    "hatchery_apr_may_flows": ("biop_itp_2018_2019", "LTO_12a"),
}


def column_of(family: str) -> int:
    """Column of a two-family table that follows the name column."""
    return 1 if family == "calsim2" else 2


def flow_map(family: str) -> list[tuple[str, str]]:
    """(node, place) pairs; one node may feed two places."""
    c = column_of(family)
    return [(row[c], row[0]) for row in FLOW_NODES if row[c]]


def diversion_terms(family: str, compat: bool = False) -> list[tuple[str, str, str, str]]:
    """Formula terms ``(metric, place, role, node)`` of the diversion proportion."""
    rows = DIVERSIONS_2 if family == "calsim2" else DIVERSIONS_3
    out = []
    for place, top, bottom in rows:
        num = [n for n in nodes(top) if family != "action_5" or n not in ACTION_5_WITHOUT]
        adds = bottom.startswith("+")
        den = bottom.lstrip("+ ")
        if family == "action_5":
            den = ACTION_5_DENOMINATORS.get(place, den)
        elif family == "calsim3" and compat and place == "Yuba River":
            den = YUBA_COMPAT_DENOMINATOR
        out += [("diverted", place, "num", n) for n in num]
        out += [("diverted", place, "den", n) for n in (num if adds else []) + [den]]
    return out


def bypass_ratio_terms(family: str) -> list[tuple[str, str, str, str]]:
    out = []
    for bypass, fam, top, bottom in BYPASS_RATIOS:
        if fam == family:
            num = nodes(top)
            den = (num if bottom.startswith("+") else []) + [bottom.lstrip("+ ")]
            out += [("bypass", bypass, "num", n) for n in num] + [("bypass", bypass, "den", n) for n in den]
    return out


def set_terms(rows: list[list[str]], metric: str, family: str) -> list[tuple[str, str, str, str]]:
    """Terms of plain node sums from a two-family table."""
    c = column_of(family)
    return [(metric, row[0], "num", n) for row in rows for n in nodes(row[c])]


def family_nodes(family: str) -> list[str]:
    """All node codes the formulas of a model family use, in order, to prune a scan."""
    if family == "climate":
        found = [n for row in REGION_STREAMS for n in (row[0], row[2])]
        found += [n for _, cell in CLIMATE_DELTA for n in nodes(cell)]
        found += [*SPILL_NODES, SPILL_RIVER_NODE]
        return list(dict.fromkeys(found))
    c = 1 if family == "calsim2" else 2
    found = [n for n, _ in flow_map(family)] + [t[3] for t in diversion_terms(family)]
    if family == "calsim2":
        found += [n for row in SHARED_2 for n in row[2:]]
        found += [t[3] for t in bypass_ratio_terms("calsim2")] + MISC_NODES
        found += [MOKELUMNE_FLOW, *MOKELUMNE_DIVERSIONS]
    else:
        found += [n for _, cell in ALIASES for n in nodes(cell)]
    found += [n for row in BYPASS_SEGMENTS for n in nodes(row[c + 1])]
    for rows in (DELTA_NODES, OVERTOPPED_NODES, MATRIX_NODES):
        found += [n for row in rows for n in nodes(row[c])]
    return list(dict.fromkeys(found))
