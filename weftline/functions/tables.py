"""Fixed values of the normalisation: word lists and transliteration tables.

They decide which strings become equal, so they are data, not choices.
"""

# Legal-form words of business names.
LEGAL_TOKENS = """
inc incorporated llc llp lp lllp plc pllc pc pa ltd limited corp corporation co company cmpy pvt private pte opc the and of
dba trading enterprise enterprises group holdings holding services service solutions international intl industries industry
associates partners partnership ventures venture global technologies technology systems consulting consultants
""".split()

# Address abbreviations and their full forms.
ADDRESS_WORDS = {
    "rd": "road", "st": "street", "ave": "avenue", "av": "avenue", "blvd": "boulevard", "bd": "boulevard", "dr": "drive",
    "ln": "lane", "ct": "court", "hwy": "highway", "pkwy": "parkway", "pl": "place", "sq": "square", "ter": "terrace",
    "terr": "terrace", "cir": "circle", "apt": "apartment", "ste": "suite", "bldg": "building", "flr": "floor", "fl": "floor",
    "n": "north", "s": "south", "e": "east", "w": "west", "ne": "northeast", "nw": "northwest", "se": "southeast",
    "sw": "southwest", "mt": "mount", "ft": "fort", "po": "post", "p o": "post", "no": "number", "opp": "opposite",
    "nr": "near", "near": "near", "mkt": "market", "nagar": "nagar", "colony": "colony", "sector": "sector",
    "h no": "house", "hno": "house", "ho": "house", "shop": "shop", "complex": "complex", "tower": "tower",
    "towers": "tower", "rte": "route", "route": "route", "block": "block", "phase": "phase", "floor": "floor",
    "room": "room", "village": "village", "post": "post", "district": "district", "distt": "district", "dist": "district",
    "tal": "taluka", "tehsil": "tehsil", "state": "state", "country": "country", "unit": "unit", "suite": "suite",
    "building": "building", "cross": "cross", "main": "main", "old": "old", "new": "new",
}

# Codes of the US states and the capital district.
US_STATES = """
al ak az ar ca co ct de fl ga hi id il in ia ks ky la me md ma mi mn ms mo mt ne nv nh nj nm ny nc nd oh ok or pa ri sc sd
tn tx ut vt va wa wv wi wy dc
""".split()

# Address words that say nothing about the place.
GENERIC_ADDRESS_WORDS = "post near opposite unit number".split()

# Strings that a loaded table takes for missing.
NA_WORDS = ["#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null", ""]

# Devanagari vowels, vowel signs, consonants, other signs and digits, with their Latin forms.
VOWELS = {
    "अ": "a", "आ": "aa", "इ": "i", "ई": "ii", "उ": "u", "ऊ": "uu", "ऋ": "ri", "ऌ": "li",
    "ऍ": "e", "ए": "e", "ऐ": "ai", "ऑ": "o", "ऒ": "o", "ओ": "o", "औ": "au",
}
VOWEL_SIGNS = {
    "ा": "a", "ि": "i", "ी": "ii", "ु": "u", "ू": "uu", "ृ": "ri", "ॄ": "ri", "ॅ": "e",
    "े": "e", "ै": "ai", "ॉ": "o", "ो": "o", "ौ": "au", "्": "", "ॐ": "om",
}
CONSONANTS = {
    "क": "k", "ख": "kh", "ग": "g", "घ": "gh", "ङ": "n", "च": "ch", "छ": "chh", "ज": "j",
    "झ": "jh", "ञ": "n", "ट": "t", "ठ": "th", "ड": "d", "ढ": "dh", "ण": "n", "त": "t",
    "थ": "th", "द": "d", "ध": "dh", "न": "n", "प": "p", "फ": "ph", "ब": "b", "भ": "bh",
    "म": "m", "य": "y", "र": "r", "ल": "l", "ळ": "l", "ऴ": "l", "व": "v", "श": "sh",
    "ष": "sh", "स": "s", "ह": "h", "क़": "q", "ख़": "kh", "ग़": "g", "ज़": "z", "ड़": "r",
    "ढ़": "rh", "फ़": "f", "य़": "y", "ऩ": "n", "ऱ": "r",
}
OTHER_SIGNS = {"ँ": "n", "ं": "n", "ः": "h", "़": "", "ऽ": "'", "।": " ", "॥": " "}
DIGITS = {chr(0x0966 + i): str(i) for i in range(10)}
