"""Column roles, limits and thresholds (fixed values of the domain)."""

from __future__ import annotations

TARGET = "kg_jr_h"
DATE = "fecha"
VARIETY = "variedad"
FARM = "fundo"
FORMAT = "formato"
FOLD = "fold_id"

NUMERIC = ["kg_ha", "pct_indus", "dpc", "p_baya", "ha", "dia_cosecha"]
CATEGORICAL = [FARM, FORMAT]
LEAKAGE = ["kg_jr", "h_ef"]

#: accepted range of each numeric column (low, high); None is open
RANGES = {
    "kg_jr_h": (0.0, None),
    "kg_ha": (0.0, None),
    "pct_indus": (0.0, 100.0),
    "dpc": (0.0, None),
    "p_baya": (0.0, None),
    "ha": (0.0, None),
    "dia_cosecha": (1.0, 366.0),
    "h_ef": (0.0, 24.0),
}

# person-day thresholds
NOVICE_DAYS = 30
VETERAN_DAYS = 180
VETERAN_SEASONS = 3
MAX_CREW = 35
LOW_BASELINE = 0.8
HISTORY_DAYS = 30
FARMS_DAYS = 90
NEW_ENTRANT_DAYS = 14
WEEKDAY_DAYS = 120
SHORT_DAY_HOURS = 6.0

# lag features
LAG_WINDOWS = [7, 14, 30, 90]
LAG_MIN = 3
SEASON_LOW, SEASON_HIGH = 380, 350
COLD_START = -1.0

PERSON_REQUIRED = ["worker_id", "fecha", "fundo", "variedad"]
PERSON_ALIASES = {
    "IDCOSECHADOR": "COSECHADOR_ID",
    "ID_COSECHADOR": "COSECHADOR_ID",
    "DNI": "COSECHADOR_ID",
    "IDSUPERVISOR": "ID_SUPERVISOR",
    "ID_SUP": "ID_SUPERVISOR",
    "TOTAL_HORAS": "HORAS_PERSONA",
}
#: header of the raw person-day file -> role name used by the operators
PERSON_ROLES = {
    "COSECHADOR_ID": "worker_id",
    "FECHA": "fecha",
    "FUNDO": "fundo",
    "VARIEDAD": "variedad",
    "FORMATO": "formato",
    "ETAPA": "etapa",
    "CAMPO": "campo",
    "GRUPO_ID": "grupo_id",
    "ID_SUPERVISOR": "id_supervisor",
    "TEMPORADAS": "temporadas",
    "KG_PERSONA": "kg",
    "HORAS_PERSONA": "horas",
    "TOTAL_JABAS": "total_jabas",
    "DIA_COSECHA_PERSONA": "dia_cosecha_persona",
    "BOLSA_FLAG": "bolsa_flag",
}

# reporting limits
VERDICT_LEVELS = [
    ("alta_confianza", 15.0, 0.10),
    ("confianza_aceptable", 22.0, 0.18),
    ("confianza_limitada", 35.0, 0.30),
]
VERDICT_WORST = "no_recomendado"
MAPE_CRITICAL = 25.0
GAP_WARN = 0.20
SUBGROUP_RATIO = 1.5
SUBGROUP_MIN = 10
KPI_MAPE = (15.0, 25.0)
KPI_R2 = (80.0, 60.0)
KPI_GAIN = (50.0, 25.0)
R2_TARGET, R2_AMBER = 0.90, 0.70
MAE_TARGET, MAE_AMBER_RATIO = 0.20, 2.0
GAP_TIE, MAPE_TIE = 0.005, 0.5
GATE_MAPE, GATE_GAP = 25.0, 18.0
MONTHS = ["Ene", "Feb", "Mar", "Abr", "May", "Jun", "Jul", "Ago", "Sep", "Oct", "Nov", "Dic"]
HA_EDGES = [(1.0, "≤1 ha"), (3.0, "1-3 ha"), (6.0, "3-6 ha")]
HA_LAST = ">6 ha"
QUARTILE_LABELS = ["Q1 bajo", "Q2", "Q3", "Q4 alto"]
