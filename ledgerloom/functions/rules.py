"""Rule tables of the notice domain. Everything here is a fixed value: words, names, patterns and formats that notices use."""

from __future__ import annotations

# Borough names and codes.
BOROUGHS = {
    "MANHATTAN": "Manhattan", "NEW YORK": "Manhattan", "MN": "Manhattan", "1": "Manhattan",
    "BRONX": "Bronx", "THE BRONX": "Bronx", "BX": "Bronx", "2": "Bronx",
    "BROOKLYN": "Brooklyn", "BK": "Brooklyn", "3": "Brooklyn",
    "QUEENS": "Queens", "QN": "Queens", "4": "Queens",
    "STATEN ISLAND": "Staten Island", "SI": "Staten Island", "5": "Staten Island",
}
BOROUGH_CODES = {"Manhattan": 1, "Bronx": 2, "Brooklyn": 3, "Queens": 4, "Staten Island": 5}

# Ordinal number words; "twenty first" to "ninety ninth" follow from TENS and the first nine.
ORDINALS = (
    "FIRST", "SECOND", "THIRD", "FOURTH", "FIFTH", "SIXTH", "SEVENTH", "EIGHTH", "NINTH", "TENTH", "ELEVENTH", "TWELFTH", "THIRTEENTH",
    "FOURTEENTH", "FIFTEENTH", "SIXTEENTH", "SEVENTEENTH", "EIGHTEENTH", "NINETEENTH",
)
TENS = ("TWENTY", "THIRTY", "FORTY", "FIFTY", "SIXTY", "SEVENTY", "EIGHTY", "NINETY")
TENTHS = ("TWENTIETH", "THIRTIETH", "FORTIETH", "FIFTIETH", "SIXTIETH", "SEVENTIETH", "EIGHTIETH", "NINETIETH")

# Street words.
SUFFIXES = {
    "ST": "STREET", "STR": "STREET", "AVE": "AVENUE", "AV": "AVENUE", "BLVD": "BOULEVARD", "BL": "BOULEVARD", "RD": "ROAD",
    "PL": "PLACE", "DR": "DRIVE", "PKWY": "PARKWAY", "PKY": "PARKWAY", "SQ": "SQUARE", "LN": "LANE", "CT": "COURT",
    "HWY": "HIGHWAY", "TER": "TERRACE", "TERR": "TERRACE", "EXPY": "EXPRESSWAY", "PLZ": "PLAZA", "CIR": "CIRCLE",
    "CONC": "CONCOURSE", "BWAY": "BROADWAY", "PROM": "PROMENADE", "TPKE": "TURNPIKE",
}
DIRECTIONS = {"E": "EAST", "W": "WEST", "N": "NORTH", "S": "SOUTH"}
STREET_TYPES = (
    "STREET", "AVENUE", "BOULEVARD", "ROAD", "PLACE", "DRIVE", "PARKWAY", "SQUARE", "LANE", "COURT", "HIGHWAY", "TERRACE", "EXPRESSWAY",
    "PLAZA", "CIRCLE", "CONCOURSE", "PROMENADE", "TURNPIKE", "WAY", "WALK", "SLIP", "ROW", "ALLEY", "PATH", "OVAL", "LOOP", "BROADWAY", "BOWERY",
)
STREET_ALIASES = {
    "AVENUE OF THE AMERICAS": "6 AVENUE", "AVENUE OF AMERICAS": "6 AVENUE", "SIXTH AVENUE": "6 AVENUE",
    "CENTRAL PARK W": "CENTRAL PARK WEST", "CPW": "CENTRAL PARK WEST", "PARK AVENUE S": "PARK AVENUE SOUTH",
    "FDR DRIVE": "FRANKLIN D ROOSEVELT DRIVE", "F D R DRIVE": "FRANKLIN D ROOSEVELT DRIVE",
    "FRANKLIN DELANO ROOSEVELT DRIVE": "FRANKLIN D ROOSEVELT DRIVE",
}
QUANTITY_WORDS = r"\b(?:tables?|chairs?|feet|foot|units?|floors?|stor(?:y|ies)|percent|square)\b"

# The forms of an address in running text. NAME stands for one word of a street name, TYPES for the street types.
ADDRESS_NUMBER = r"(?<![\w$,.\-/])(?P<number>\d{1,5}(?:\s?-\s?\d{1,5})?[A-Za-z]?)\s+"
ADDRESS_NAME = r"(?:[A-Z0-9][\w'’-]*\.?|(?i:ORDINALS)\b)"
ADDRESS_STREETS = (
    r"(?i:Avenue\s+of\s+(?:the\s+)?Americas)",
    r"(?:Central|Prospect)\s+Park\s+(?i:West|South|North|Southwest|East)\b",
    r"(?i:Avenue|Ave\.?)\s+[A-Z]\b(?![a-z'’])",
    r"(?:(?i:N|S|E|W|North|South|East|West)\.?\s+)?(?:NAME\s+){1,4}?(?:(?i:TYPES)\b\.?(?:\s+(?:South|North|East|West)\b)?)",
    r"(?:(?i:West\s+)?(?i:Broadway|Bowery))\b",
)
ADDRESS_BEFORE = (
    r"(?i:\b(?:at|located at|recorded at|owners? of|premises at|site at|building at|property at|issued at|address(?:es)? at|"
    r"of the building at|of)\s*(?:the\s+)?(?:[A-Za-z' ]{0,30}?)?)\s*$"
)
BOROUGH_AFTER = r"(?i)^[\s,(]*(?:in\s+)?(?:the\s+)?(Manhattan|Brooklyn|Bronx|Queens|Staten Island|New York(?:,?\s*NY)?)\b"

# Identifiers in running text.
IDENTIFIERS = {
    "bin": r"(?i)\bBIN\s*(?:No\.?|#|number)?[:\s]*(\d{7})\b",
    "bbl": r"(?i)\bBBL\s*(?:No\.?|#)?[:\s]*(\d{10})\b",
    "job_number": r"(?i)\b(?:Job|Application)\s*(?:No\.?|#|number)?[:\s]*([A-Z]?\d{8,9})\b",
    "ecb_violation": r"(?i)\bECB\s*(?:violation)?\s*(?:No\.?|#)?[:\s]*(\d{8,10}[A-Z]?)\b",
}
BLOCK_LOT = r"(?i)\bBlock\s*(?:No\.?|#)?\s*(\d{1,5})[,\s]+Lot\s*(?:No\.?|#)?\s*(\d{1,4})\b"

# Layout of a bulletin.
BULLETS = "•●▪◦·"
SECTIONS = {"bronx": "Bronx", "brooklyn": "Brooklyn", "manhattan": "Manhattan", "queens": "Queens", "staten island": "Staten Island"}
OTHER_SECTIONS = ("construction and design professionals", "construction professionals", "design professionals", "citywide", "multiple boroughs", "other")
MARKER = r"(?i)individual\s+enforcement\s+highlights"
BOILERPLATE = (r"(?i)^CONTACT:", r"(?i)^build safe\s*\|\s*live safe", r"^\d{1,2}$", r"(?i)^dobcommunications@", r"(?i)^Page \d+ of \d+$")
MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December")
MONEY = r"\$\s?(\d{1,3}(?:,\s?\d{3})+|\d+)(?:\.\d{2})?"
LEAD_PENALTY = (
    r"(?i)^\s*\$\s?(\d{1,3}(?:,\s?\d{3})+|\d+)(?:\.\d{2})?\s+(?:in\s+)?"
    r"(?:(?:total|combined|daily|mitigated|default|civil|additional|cumulative|aggregate)[,\s]+)*(?:penalt(?:y|ies)|fines?|violations?)\b"
)
RESPONDENT = (
    r"(?i)(?:issued\s+to|imposed\s+(?:on|upon)|issued\s+against|levied\s+(?:on|against)|assessed\s+(?:to|against)|"
    r"issued\s+for\s+the\s+benefit\s+of)\s+"
    r"(?:(?P<owner>(?:the\s+)?(?:property|building|home|unit|apartment|condominium|co-?op)?\s*owners?)[,:]?\s+)?"
    r"(?P<who>.+?)(?=,\s*(?:the\s+)?owners?\b|\s+the\s+owners?\b|\s(?:for|at|after|following|due|related|regarding|who|which|whose|"
    r"as\s+a\s+result|where|when|during|because|by)\b|;\s|"
    r"(?<!\bCo)(?<!\bInc)(?<!\bCorp)(?<!\bLtd)(?<!\bAssoc)(?<!\bCtr)(?<!\bSt)(?<!\bJr)(?<!\bSr)(?<!\bBros)(?<!\bMgmt)"
    r"(?<!\bDev)(?<!\bAve)(?<!\bCo)(?<!\bL\.P)(?<!\bN\.Y)\.\s+(?=[A-Z])|$)"
)
ROLES = (
    "Safety Registrant|Registered General Contractor|General Contractor|Tracking Number Holder|Construction Superintendent|Superintendent|"
    "Licensed Site Safety Manager|Site Safety Manager|Master Plumber|Licensed Master Plumber|Master Electrician|Licensed Master Electrician|"
    "Registered Architect|Professional Engineer|Special Rigger|Rigger|Sign Hanger|Licensed Sign Hanger|Filing Representative|Contractor|"
    "Expediter|Owner|Lessee|Tenant|Property Manager|Managing Agent"
)

# Wording of entries about licences and proceedings, which need no address.
PROFESSIONAL = (
    r"(?i)licen[sc]e|professional\s+certification|Directive\s+14|suspen|probation|revoke|revocation|disciplin|surrender|"
    r"Special\s+Enforcement\s+Team|SET\)|audit(?:ed)?\s+of|filing\s+(?:false|privileges)|Registered\s+Architect|"
    r"Professional\s+Engineer|OATH|stipulation|petition\s+for\s+padlock|summons"
)

# Words that do not tell one company name from another.
ENTITY_WORDS = (
    "llc", "inc", "corp", "co", "company", "assoc", "associates", "association", "condominium", "condo", "owners", "owner", "l p", "lp", "ltd",
    "the", "c o",
)

# County names of geocoder answers, and the age groups of sites.
COUNTIES = {"New York County": "Manhattan", "Kings County": "Brooklyn", "Bronx County": "Bronx", "Queens County": "Queens", "Richmond County": "Staten Island"}
DECADES = ((1961, 1969, "1961-69"), (1970, 1979, "1970s"), (1980, 1989, "1980s"), (1990, 1999, "1990s"), (2000, 2100, "2000+"))

# Wording tiers, strongest first: (tier, label, pattern).
WORDING = (
    ("strong", "privately owned public space", r"(?i)privately[\s-]+owned\s+public\s+spaces?"),
    ("strong", "POPS", r"\bPOPS\b"),
    ("moderate", "public plaza", r"(?i)public\s+plazas?"),
    ("moderate", "public space", r"(?i)public\s+spaces?"),
    ("moderate", "publicly accessible", r"(?i)publicly[\s-]+accessible"),
    ("moderate", "public access area", r"(?i)public\s+access\s+(?:area|space)s?"),
    ("moderate", "discretionary zoning", r"(?i)discretionary\s+zoning"),
    ("moderate", "zoning resolution ch.37", r"(?i)\b(?:ZR|Zoning\s+Resolution)\s*(?:§|Section)?\s*37-\d"),
    ("moderate", "public pedestrian path", r"(?i)public\s+pedestrian(?:/bike)?\s+path"),
    ("weak", "plaza", r"(?i)\bplazas?\b"),
    ("weak", "open air cafe", r"(?iu)open[\s-]+air\s+caf[eé]"),
    ("weak", "arcade", r"(?i)\barcades?\b"),
    ("weak", "through-block / covered pedestrian space", r"(?i)through[\s-]+block|covered\s+pedestrian"),
)

# Violation categories and the wordings that put an action into them.
CATEGORIES = {
    "access / closure": (
        r"padlock", r"\bchain(?:ed)?\b", r"locked", r"closed\s+to\s+the\s+public", r"\bclosed\b.*\bsign\b",
        r"(?:deny|denied|denying|disallow\w*|restrict\w*|limit\w*|prevent\w*)\s+(?:the\s+)?(?:public\s+)?access",
        r"access\s+(?:was\s+)?(?:denied|restricted|blocked|prevented)", r"blocking\s+the\s+public", r"cordon\w*", r"\bgated?\b",
        r"entrances?\s+(?:were|was)\s+(?:closed|blocked|locked)", r"not\s+(?:be\s+)?open\s+to\s+the\s+public", r"fenced\s+off",
    ),
    "seating": (r"\bseating\b", r"\bchairs?\b", r"\btables?\b", r"\bbench(?:es)?\b", r"\bledges?\b"),
    "landscaping": (r"landscap\w*", r"plantings?", r"planters?", r"\bplants?\b", r"\bflowers?\b", r"\blawn\b", r"\bgardens?\b"),
    "trees": (r"\btrees?\b",),
    "signage": (r"\bsignage\b", r"\bsigns?\b", r"\bplaques?\b", r"\bmarquee\b"),
    "fountain / water feature": (r"fountains?", r"water\s+features?", r"waterfalls?", r"\bponds?\b", r"reflecting\s+pool"),
    "bicycle parking": (r"bicycle", r"bike\s+(?:rack|parking)"),
    "maintenance": (
        r"maintain\w*", r"maintenance", r"\bbroken\b", r"\bdamaged?\b", r"deteriorat\w*", r"\bdebris\b", r"graffiti",
        r"not\s+(?:operational|functioning|working)", r"non-?function\w*", r"non-?operational", r"\bdisrepair\b",
        r"electrical\s+wiring", r"\blamp\s*posts?\b", r"\blighting\b", r"\bcracked\b",
    ),
    "unauthorized private use": (
        r"restaurants?", r"\bcaf[eé]s?\b", r"nurs(?:e)?ry\s+school", r"school", r"private\s+(?:use|event|party)", r"commercial\s+use",
        r"\bstorage\b", r"taken\s+over", r"outdoor\s+dining", r"\bkiosks?\b", r"\bvendors?\b", r"exclusive\s+use",
        r"without\s+.*certification", r"\bused\s+(?:by|for|as)\b",
    ),
    "unauthorized design modification": (
        r"without\s+(?:prior\s+)?(?:approval|permit|authorization|DCP|(?:the\s+)?required\s+approval)", r"design\s+changes?", r"unapproved",
        r"\bmodif\w*", r"\balter\w*", r"installed\s+.*without", r"\bmarquee\b", r"\benclos\w*", r"\bconvert\w*",
        r"changes\s+to\s+(?:a|the)\s+(?:public\s+)?plaza",
    ),
    "obstruction": (r"obstruct\w*", r"\bblock(?:ed|ing)\b", r"impeded?|impeding", r"\bspike", r"\bclutter\w*"),
    "hours": (
        r"\bhours\b", r"open\s+24", r"24[\s-]hour", r"closed\s+(?:at|during|after)\s+(?:night|hours)", r"after[\s-]hours", r"required\s+hours",
    ),
}
