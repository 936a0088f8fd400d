"""Fixed labels shared by counts and population denominators, so the two join."""

from __future__ import annotations

# Organisation levels and standing labels.
SUB_ICB = "Sub-ICB"
ICB = "ICB"
REGION = "Region"
PROVIDER = "Provider"
NATIONAL = "National"
ENGLAND = "England"
ALL_REGIONS = "All Regions"
TOTAL = "Total"
OTHER = "Other"
MISSING = "Missing/invalid"

# Code groups.
GENDER_GROUPS = {"Males": ["1"], "Females": ["2"]}
GENDER_DEFAULT = "Other/Not Stated/Not Known"

ETHNIC_GROUPS = {
    "White": ["A", "B", "C"],
    "Mixed": ["D", "E", "F", "G"],
    "Asian": ["H", "J", "K", "L"],
    "Black": ["M", "N", "P"],
    "Other": ["R", "S"],
}
ETHNIC_DEFAULT = "Not Stated/Not Known"

# Census categories; text patterns are tried in this order.
CENSUS_ETHNIC_PATTERNS = [
    ("Asian", "Asian"),
    ("Black", "Black"),
    ("Mixed", "Mixed"),
    ("White", "White"),
    ("Other", "Other"),
]
CENSUS_ETHNIC_MEASURES = [
    "Ethnic_group:_Asian_Asian_British_or_Asian_Welsh",
    "Ethnic_group:_Black_Black_British_Black_Welsh_Caribbean_or_African",
    "Ethnic_group:_Mixed_or_Multiple_ethnic_groups",
    "Ethnic_group:_Other_ethnic_group",
    "Ethnic_group:_White",
]
CENSUS_SEX = {"Females": ["Female"], "Males": ["Male"]}
CENSUS_AGE = {
    "Under65": [
        "Aged 4 years and under",
        "Aged 5 to 9 years",
        "Aged 10 to 15 years",
        "Aged 16 to 19 years",
        "Aged 20 to 24 years",
        "Aged 25 to 34 years",
        "Aged 35 to 49 years",
        "Aged 50 to 64 years",
    ],
    "65to74": ["Aged 65 to 74 years"],
    "75to84": ["Aged 75 to 84 years"],
    "85+": ["Aged 85 years and over"],
}

# Attendance and consultation codes that make a contact count.
ATTENDED = ["5", "6"]
CONTACT_CHANNELS = ["01", "02", "04", "11"]

# Region titles to short names.
REGION_SHORT_NAMES = {
    "EAST OF ENGLAND COMMISSIONING REGION": "East Of England",
    "LONDON COMMISSIONING REGION": "London",
    "MIDLANDS COMMISSIONING REGION": "Midlands",
    "NORTH EAST AND YORKSHIRE COMMISSIONING REGION": "North East And Yorkshire",
    "NORTH WEST COMMISSIONING REGION": "North West",
    "SOUTH EAST COMMISSIONING REGION": "South East",
    "SOUTH WEST COMMISSIONING REGION": "South West",
}

# Area codes merged in 2022, as old code -> (new code, short code).
AREA_RECODES = {
    "E38000182": ("E38000263", "01Y"),
    "E38000229": ("E38000261", "15M"),
    "E38000250": ("E38000259", "D2P2L"),
    "E38000220": ("E38000258", "15E"),
    "E38000026": ("E38000260", "06H"),
    "E38000242": ("E38000262", "78H"),
}

# One area split over three successors, with population weights.
SPLIT_COLUMNS = [
    "SubICB_Code", "SubICB_Name", "PopWeight", "SubICB26_Code", "SubICB26_Name",
    "ICB_Code", "ICB_Name", "Region_Code", "Region_Name",
]
SPLIT_ROWS = [
    ("D4U1Y", "NHS FRIMLEY (D4U1Y)", 0.18204175443292,
     "92A", "NHS SURREY AND SUSSEX ICB - 92A",
     "S9B9J", "NHS SURREY AND SUSSEX INTEGRATED CARE BOARD", "Y59", "South East"),
    ("D4U1Y", "NHS FRIMLEY (D4U1Y)", 0.229339252148803,
     "D9Y0V", "NHS HAMPSHIRE AND ISLE OF WIGHT ICB - D9Y0V",
     "QRL", "NHS HAMPSHIRE AND ISLE OF WIGHT INTEGRATED CARE BOARD", "Y59", "South East"),
    ("D4U1Y", "NHS FRIMLEY (D4U1Y)", 0.588618993418278,
     "U2G6B", "NHS THAMES VALLEY ICB - U2G6B",
     "S0E4D", "NHS THAMES VALLEY INTEGRATED CARE BOARD", "Y59", "South East"),
]
