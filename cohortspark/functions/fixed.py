"""Fixed values of the clinical domain: item codes, plausible ranges, code sets, categories and signal lists."""

from cohortspark.functions.scalars import Bound, Rule

# Laboratory item codes and their signal.
LAB_ITEMS = {
    50868: "aniongap",
    50862: "albumin",
    51144: "bands",
    50882: "bicarbonate",
    50885: "bilirubin",
    50912: "creatinine",
    50902: "chloride",
    50931: "glucose",
    51221: "hematocrit",
    51222: "hemoglobin",
    50813: "lactate",
    51265: "platelet",
    50971: "potassium",
    51275: "ptt",
    51237: "inr",
    51274: "pt",
    50983: "sodium",
    51006: "bun",
    51300: "wbc",
    51301: "wbc",
    51463: "bacteria",
}

# Highest plausible laboratory value per item (values must also be above zero).
LAB_BOUNDS = {
    50862: Bound(high=10),
    50868: Bound(high=10000),
    51144: Bound(low=0, high=100),
    50882: Bound(high=10000),
    50885: Bound(high=150),
    50902: Bound(high=10000),
    50912: Bound(high=150),
    50931: Bound(high=10000),
    51221: Bound(high=100),
    51222: Bound(high=50),
    50813: Bound(high=50),
    51265: Bound(high=10000),
    50971: Bound(high=30),
    51275: Bound(high=150),
    51237: Bound(high=50),
    51274: Bound(high=150),
    50983: Bound(high=200),
    51006: Bound(high=300),
    51300: Bound(high=1000),
    51301: Bound(high=1000),
    51463: Bound(low=0),
}

# The item with text results, and the texts of its two classes (1 absent, 2 present).
BACTERIA_ITEM = 51463
BACTERIA_GROUPS = {
    1: ["NEG", "0", "O", "NONE"],
    2: ["FEW", "O9", "MOD-", "1", "MODERATE", "F", "MO", "F'", "RARE", "2", "M", "3", "MANY", "R", "SOME"],
}

# Vital-sign item codes with their plausible ranges; Fahrenheit items are converted.
_ABOVE_ZERO = {"low": 0, "low_in": False, "high_in": False}
VITAL_RULES = {
    "heartrate": [Rule((211, 220045), Bound(high=300, **_ABOVE_ZERO))],
    "sysbp": [Rule((51, 442, 455, 6701, 220179, 220050), Bound(high=400, **_ABOVE_ZERO))],
    "diasbp": [Rule((8368, 8440, 8441, 8555, 220180, 220051), Bound(high=300, **_ABOVE_ZERO))],
    "meanbp": [Rule((456, 52, 6702, 443, 220052, 220181, 225312), Bound(high=300, **_ABOVE_ZERO))],
    "resprate": [Rule((615, 618, 220210, 224690), Bound(high=70, **_ABOVE_ZERO))],
    "tempc": [
        Rule((223761, 678), Bound(70, 120, False, False), shift=32, scale=1.8),
        Rule((223762, 676), Bound(10, 50, False, False)),
    ],
    "spo2": [Rule((646, 220277), Bound(0, 100, False, True))],
    "glucose": [Rule((807, 811, 1529, 3745, 3744, 225664, 220621, 226537), Bound(low=0, low_in=False))],
}
EXTRA_VITAL_RULES = {
    "rbc": [Rule((3799,), Bound(high=13, high_in=False))],
    "specificgravity": [Rule((227471,), Bound(low=0, low_in=False))],
    "pedaledema": [Rule((6870,), Bound(low=0, low_in=False))],
}
APPETITE_ITEM = 225120
APPETITE_LEVELS = ["Poor", "Fair", "Good", "Very Good"]

# Diagnosis code sets.
CODE_SETS = {
    "label_cor_art": ["74685", "41401", "41406", "41412", "4142"],
    "diabetes_mellitus": [
        "24900", "24901", "24910", "24911", "24920", "24921", "24930", "24931", "24940", "24941",
        "24950", "24951", "24960", "24961", "24970", "24971", "24980", "24981", "24990", "24991",
        "25000", "25001", "25002", "25003", "64800", "64801", "64802", "64803", "64804", "7751",
    ],
    "ckd": ["5851", "5852", "5853", "5854", "5855", "5859"],
    "anemia_flag": [
        "2839", "2800", "2801", "2808", "2809", "2810", "2811", "2812", "2813", "2814", "2818", "2819",
        "2822", "2823", "28310", "28319", "28409", "28489", "2849", "2850", "2851", "7735", "7765",
    ],
}

# Groups of the free-text ethnicity.
ETHNICITY_GROUPS = {
    "white": [
        "WHITE", "WHITE - RUSSIAN", "WHITE - OTHER EUROPEAN", "WHITE - BRAZILIAN", "WHITE - EASTERN EUROPEAN",
    ],
    "black": [
        "BLACK/AFRICAN AMERICAN", "BLACK/CAPE VERDEAN", "BLACK/HAITIAN", "BLACK/AFRICAN", "CARIBBEAN ISLAND",
    ],
    "hispanic": [
        "HISPANIC OR LATINO", "HISPANIC/LATINO - PUERTO RICAN", "HISPANIC/LATINO - DOMINICAN",
        "HISPANIC/LATINO - GUATEMALAN", "HISPANIC/LATINO - CUBAN", "HISPANIC/LATINO - SALVADORAN",
        "HISPANIC/LATINO - CENTRAL AMERICAN (OTHER)", "HISPANIC/LATINO - MEXICAN",
        "HISPANIC/LATINO - COLOMBIAN", "HISPANIC/LATINO - HONDURAN", "SOUTH AMERICAN",
    ],
    "asian": [
        "ASIAN", "ASIAN - CHINESE", "ASIAN - ASIAN INDIAN", "ASIAN - VIETNAMESE", "ASIAN - FILIPINO",
        "ASIAN - CAMBODIAN", "ASIAN - OTHER", "ASIAN - KOREAN", "ASIAN - JAPANESE", "ASIAN - THAI",
    ],
    "alaska_native": [
        "AMERICAN INDIAN/ALASKA NATIVE", "AMERICAN INDIAN/ALASKA NATIVE FEDERALLY RECOGNIZED TRIBE",
    ],
    "unknown": [
        "UNKNOWN/NOT SPECIFIED", "UNABLE TO OBTAIN", "PATIENT DECLINED TO ANSWER", "OTHER", "MULTI RACE ETHNICITY",
    ],
    "portuguese": ["PORTUGUESE"],
    "middle_eastern": ["MIDDLE EASTERN"],
    "pacific_islander": ["NATIVE HAWAIIAN OR OTHER PACIFIC ISLANDER"],
}

# Age bins (closed on the left).
AGE_EDGES = [0, 9, 19, 29, 39, 49, 59, 69, 79, 89, 400]
AGE_LABELS = ["0-9", "10-19", "20-29", "30-39", "40-49", "50-59", "60-69", "70-79", "80-89", "90+"]

# Bins of the stay in hours (closed on the right).
STAY_EDGES = [8, 15, 23, 31, 39, 47, 55, 63, 71, 3694.271389]
STAY_LABELS = ["8-15", "16-23", "24-31", "32-39", "40-47", "48-55", "56-63", "64-71", ">72"]
STAY_CUTS = [8, 16, 24, 32, 40, 48, 72]

# Care units left out, and categories too rare for modelling.
CHILD_UNITS = ["NICU", "PICU"]
RARE_GROUPS = ["middle_eastern", "portuguese", "alaska_native", "pacific_islander"]

# Signal lists.
MORTALITY_VITALS = ["heartrate", "sysbp", "diasbp", "meanbp", "resprate", "tempc", "spo2"]
MORTALITY_LABS = [
    "albumin", "bun", "bilirubin", "lactate", "bicarbonate", "bands", "chloride", "creatinine", "glucose",
    "hemoglobin", "hematocrit", "platelet", "potassium", "ptt", "sodium", "wbc",
]
CKD_VITALS = [
    "heartrate", "sysbp", "diasbp", "meanbp", "resprate", "tempc", "spo2", "glucose", "rbc", "specificgravity",
    "pedaledema", "appetite_median",
]
CKD_LABS = [
    "aniongap", "albumin", "bands", "bicarbonate", "bilirubin", "creatinine", "chloride", "glucose", "hematocrit",
    "hemoglobin", "lactate", "platelet", "potassium", "ptt", "inr", "pt", "sodium", "bun", "wbc", "bacteria",
]
AGGREGATE_VITALS = [
    "heartrate", "sysbp", "diasbp", "meanbp", "resprate", "tempc", "spo2", "specificgravity", "appetite_median",
]
AGGREGATE_LABS = [
    "albumin", "bacteria", "glucose", "bun", "creatinine", "sodium", "potassium", "hemoglobin", "wbc", "hematocrit",
    "platelet", "ptt",
]
STATIC_FEATURES = [
    "gender", "ethnicity_grouped", "label_cor_art", "diabetes_mellitus", "anemia_flag", "age_group", "ckd",
]
LAB_FEATURE_SETS = {
    "all": CKD_LABS,
    "without_albumin_creatinine": [c for c in CKD_LABS if c not in ("albumin", "creatinine")],
    "albumin_creatinine": ["albumin", "creatinine"],
}

# Constants of the continuous risk label.
RISK_EXP, RISK_RATE, RISK_LINE, RISK_HOURS = 0.55, 0.66, 0.45, 48.0

# Signals of the vital-sign panel.
PANEL_VITALS = [
    "heartrate", "sysbp", "diasbp", "meanbp", "resprate", "tempc", "spo2", "glucose", "rbc", "specificgravity",
    "appetite_median",
]
