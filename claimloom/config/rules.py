"""Branch rules. Order matters: the first rule that matches gives the division."""

from __future__ import annotations

# Fixed values: (kind, values, division). Kinds: in (any of the ids), like (SQL pattern).
# fmt: off
BRANCH_DIVISIONS = [
    ("in", [
        "25CAT", "SY2X", "FS2A", "BL2A", "CC2A", "CN1A", "COFS2A", "DB2A", "NR2A", "CH2H", "NW2A", "SY2A", "2CAT",
        "TM2A", "WG2A", "12BAL", "13BAL", "46CAT", "ULL2A", "14CAT", "15CAT", "4CAT", "5CAT", "12CAT", "ALLCC2A",
        "SY2T", "35CAT", "42CAT", "39CAT", "40CAT", "19CAT", "22CAT", "SY2H",
    ], "New South Wales"),
    ("in", [
        "34CAT", "BR4A", "10TWE", "CA4A", "GC4A", "MACK4A", "BR4H", "MR4A", "WW4E", "RH4A", "10MKY", "SC4A",
        "TB4A", "TW4A", "3CAT", "7CAT", "10CAT", "13CAT", "17CAT", "45CAT", "43CAT", "23CAT", "24CAT", "48CAT",
        "38CAT", "36CAT", "37CAT", "32CAT", "27CAT", "BR4X", "47CAT",
    ], "Queensland"),
    ("in", [
        "AD5X", "AD5A", "AD5F", "DW5E", "MG5A", "NR5A", "MO5A", "PL5A", "MD5A", "CL5A", "RN5A", "44CAT", "21CAT",
    ], "South Australia"),
    ("in", ["HB7E", "HB7A", "LA7E", "BU7A", "BU7E", "CASE1", "33CAT"], "Tasmania"),
    ("in", [
        "ML3X", "11CAT", "AW3C", "BL3C", "BN3C", "GL3C", "ML3A", "MD3A", "SH3C", "ML3H", "QBECC3A", "WN3C", "CG3H",
        "WN3A", "WR3A", "1CAT", "6CAT", "16CAT", "16REG", "8CAT", "20CAT", "28CAT", "29CAT", "26CAT",
    ], "Victoria"),
    ("in", [
        "9CAT", "AL6A", "BB6A", "GR6A", "GR6E", "MB6E", "PR6A", "PR6H", "PR6X", "EP6A", "18CAT", "KB6A", "41CAT",
        "31CAT", "DW0A",
    ], "Western Australia"),
    ("in", ["MG5CAR", "CAR5A", "CAR3A", "MOT2A", "46MOT", "MOT5A", "SY2M"], "Motor"),
    ("in", ["FFAT1", "FFAT2", "FFAT4"], "FRS"),
    ("in", ["COO", "CEO", "MGT"], "Executive"),
    ("in", ["CONENG", "CONEXP"], "Construction & Engineering"),
    ("in", ["TPA1", "TPA2"], "TPA"),
    ("in", ["IT", "ITDEV"], "IT"),
    ("in", ["DRONE"], "Contractor Connection"),
    ("in", ["WG2M"], "Marine"),
    ("in", ["GBSC"], "GBSC"),
    ("in", ["PRIZE"], "Prize and Indemnity"),
    ("in", ["RPA2"], "Robotic process automation"),
    ("in", ["0000"], "Head office"),
    ("in", ["BTS"], "Business Transformation Strategy"),
    ("in", ["FIN"], "Finance"),
    ("in", ["HR"], "Human Resources"),
    ("like", ["%STRATA%"], "STRATA"),
    ("like", ["%MCKY"], "Licensee"),
    ("like", ["%RNET%"], "Contractor Connection"),
    ("like", ["%CFAS%"], "GTS"),
    ("like", ["BVL%"], "Building Validation"),
    ("like", ["CEG%"], "Construction & Engineering"),
    ("like", ["COP%"], "Code of Practice"),
    ("like", ["CPT%"], "Complaints"),
    ("like", ["POW%"], "Construction & Engineering"),
    ("like", ["TRI%"], "Triage"),
    ("like", ["%API%"], "IT"),
    ("like", ["%BLD%"], "Building Consultancy"),
    ("like", ["%VIR%"], "Virtual"),
    ("like", ["%BVL%"], "Building Validation"),
    ("like", ["%NSW%"], "New South Wales"),
    ("like", ["%QLD%"], "Queensland"),
    ("like", ["%TAS%"], "Tasmania"),
    ("like", ["%VIC%"], "Victoria"),
    ("like", ["%COM%"], "Commercial"),
    ("like", ["%MAR%"], "Marine"),
    ("like", ["%FRS%"], "FRS"),
    ("like", ["%VR%"], "Virtual"),
    ("like", ["%GT%"], "GTS"),
    ("like", ["%WA%"], "Western Australia"),
    ("like", ["%SA%"], "South Australia"),
    ("like", ["CC%"], "Contractor Connection"),
    ("like", ["%RACQ%"], "Queensland"),
    ("like", ["%L"], "Liability"),
    ("like", ["%E"], "Licensee"),
    ("like", ["%F"], "Fusion"),
]
# fmt: on

NO_DIVISION = "Other"

# Division -> service line. Divisions without an entry keep their own name, "Other" takes
# the branch id. Compared without regard to case ("Head office").
SERVICE_LINES = {
    "FRS": "GTS",
    "Liability": "GTS",
    "Construction & Engineering": "GTS",
    "GTS": "GTS",
    "Commercial": "GTS",
    "Marine": "GTS",
    "Virtual": "CCS",
    "Building Consultancy": "CCS",
    "Robotic process automation": "CCS",
    "Fusion": "CCS",
    "Licensee": "CCS",
    "Motor": "CCS",
    "GBSC": "CCS",
    "New South Wales": "CCS",
    "Prize and Indemnity": "CCS",
    "Queensland": "CCS",
    "South Australia": "CCS",
    "Tasmania": "CCS",
    "Victoria": "CCS",
    "STRATA": "CCS",
    "Western Australia": "CCS",
    "Head Office": "SS",
    "Human Resources": "SS",
    "IT": "SS",
    "Finance": "SS",
    "Executive": "SS",
    "Business Transformation Strategy": "SS",
    "BVL": "Contractor Connection",
    "Contractor Connection": "Contractor Connection",
}
