"""Answer vocabularies of the triage features."""

from __future__ import annotations

# Cleaned answers per question of the text form, 44 features.
TEXT_VOCABULARY = {
    "Status": [
        "active leak  currently wet",
        "livable still in dwelling   building",
        "livable temporarily displaced",
        "no longer leaking  wet less than 1 day",
        "no longer leaking  wet more than 1 day",
        "no  no opening",
        "unlivable displaced",
        "yes  covered tarped",
        "yes  uncovered not tarped",
    ],
    "Levels": ["1 floor", "2 floors or more", "no"],
    "Rooms": ["1 2 rooms", "3 rooms", "4 rooms", "5 or more rooms", "no"],
    "Materials": [
        "cabinets",
        "ceiling",
        "contents  personal belongings ",
        "exterior contents  grill  patio furniture  etc  ",
        "exterior structure",
        "fixtures",
        "floors",
        "hardscapes   fence",
        "no",
        "roof",
        "siding",
        "vinyl floor covering",
        "walls",
        "windows",
    ],
    "Engagement": ["attorney", "contractor", "no", "public adjuster"],
    "source": ["electrical", "fireplace", "lightning", "other", "stove", "unknown", "water", "wildfire", "wind"],
}

# Answer codes per question of the coded form, 40 features.
CODE_VOCABULARY = {
    "PerilTypeID": ["DRAIN BCK", "HAIL", "OTHER", "PTFR", "PTTF", "PTWD", "PTWR", "WIND"],
    "Status": ["CSLS", "CSLT", "CSUD", "NA"],
    "Levels": ["LSOF", "LSTM", "NA"],
    "Rooms affected": ["NA", "RAMF", "RANA", "RANA,RAOT", "RAOT", "RAOT,RATF", "RATE", "RATF"],
    "materials": ["MDCB", "MDCE", "MDCO", "MDFI", "MDFL", "MDFL,MDFL", "MDNA", "MDWA", "MDWA,MDWA", "NA"],
    "Engagement": ["ETAT", "ETCO", "ETNO", "ETPA", "NA", "TPNO", "TPPA"],
}
