"""Names, positions, limits and formats that results depend on.

Nothing here is logic. Every value is a default that the functions take as a
parameter, so another data set only needs other arguments.
"""

# Incident table, source column -> target column.
INCIDENT_COLUMNS = {
    "iyear": "year",
    "country_txt": "country",
    "attacktype1_txt": "attack_type",
    "targtype1_txt": "target_type",
    "weaptype1_txt": "weapon_type",
    "nkill": "kills",
    "nwound": "wounds",
    "gname": "group_name",
    "summary": "summary",
}
OPTIONAL_INCIDENT_COLUMNS = ("summary",)
UNKNOWN = "Unknown"

# Activity log layout (zero-based positions in a headerless TSV).
ACTIVITY_WIDTH = 57
ACTIVITY_MIN_WIDTH = 8
ACTIVITY_DATE = "_c1"
ACTIVITY_CODE = "_c7"
CODE_LENGTH = 3
ACTIVITY_YEARS = (2015, 2016, 2017, 2018, 2019)

# Alpha-3 country code -> country name as the incident table spells it.
COUNTRY_NAMES = {
    "AFG": "Afghanistan", "IRQ": "Iraq", "PAK": "Pakistan",
    "SYR": "Syria", "IND": "India", "NGA": "Nigeria",
    "COL": "Colombia", "PHL": "Philippines", "YEM": "Yemen",
    "SOM": "Somalia", "LBY": "Libya", "EGY": "Egypt",
    "TUR": "Turkey", "RUS": "Russia", "UKR": "Ukraine",
    "GBR": "United Kingdom", "FRA": "France", "DEU": "Germany",
    "USA": "United States", "CHN": "China", "BRA": "Brazil",
    "MEX": "Mexico", "IDN": "Indonesia", "BGD": "Bangladesh",
    "THA": "Thailand", "KEN": "Kenya", "ETH": "Ethiopia",
    "SDN": "Sudan", "CMR": "Cameroon", "MLI": "Mali",
    "NER": "Niger", "BFA": "Burkina Faso", "LBN": "Lebanon",
    "ISR": "Israel", "IRN": "Iran", "SAU": "Saudi Arabia",
    "JOR": "Jordan", "MAR": "Morocco", "DZA": "Algeria",
    "TUN": "Tunisia", "LKA": "Sri Lanka", "NPL": "Nepal",
    "MMR": "Myanmar", "VNM": "Vietnam", "UZB": "Uzbekistan",
    "KAZ": "Kazakhstan", "AZE": "Azerbaijan", "GEO": "Georgia",
    "SRB": "Serbia", "HRV": "Croatia", "BIH": "Bosnia-Herzegovina",
    "ESP": "Spain", "ITA": "Italy", "GRC": "Greece",
    "POL": "Poland", "NLD": "Netherlands", "BEL": "Belgium",
    "SWE": "Sweden", "NOR": "Norway", "DNK": "Denmark",
    "ARG": "Argentina", "CHL": "Chile", "PER": "Peru",
    "VEN": "Venezuela", "GTM": "Guatemala", "CUB": "Cuba",
    "HTI": "Haiti", "DOM": "Dominican Republic",
    "GHA": "Ghana", "CIV": "Ivory Coast", "SEN": "Senegal",
    "COD": "Democratic Republic of the Congo",
    "UGA": "Uganda", "RWA": "Rwanda", "MOZ": "Mozambique",
    "ZWE": "Zimbabwe", "ZAF": "South Africa", "AGO": "Angola",
    "AUS": "Australia", "CAN": "Canada", "JPN": "Japan",
    "KOR": "South Korea", "TWN": "Taiwan",
}

# Severity by number of deaths, highest threshold first.
SEVERITY_STEPS = ((10, "high"), (3, "moderate"))
SEVERITY_ELSE = "low"

# The characters that separate words.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Record keys and the marks around the label in a report header.
RECORD_KEYS = ("system", "instruction", "input", "output")
REQUIRED_RECORD_KEYS = ("instruction", "output")
LABEL_OPEN = "— "
LABEL_CLOSE = " |"

# Splits and sampling.
SPLIT_FRACTIONS = {"train": 0.8, "val": 0.1, "test": 0.1}
SEED = 42

# Profile.
TOKEN_CAP = 800
TOKEN_BIN_WIDTH = 25
TOP_LABELS = 12
RECORD_PREVIEW = 120

# Chat markers of the Llama 3 Instruct format.
CHAT_BEGIN = "<|begin_of_text|>"
CHAT_ROLE_OPEN = "<|start_header_id|>"
CHAT_ROLE_CLOSE = "<|end_header_id|>"
CHAT_END_OF_TURN = "<|eot_id|>"
CONTEXT_LEAD = "\n\nContext: "

# Training schedule.
BATCH_SIZE = 2
GRADIENT_ACCUMULATION = 4
MAX_STEPS = 500
MAX_SEQUENCE_LENGTH = 2048
