"""Fixed values of the normalizer. They must stay as they are for results to agree."""

# Legal forms.
LEGAL = set(
    "inc incorporated corp corporation co company llc lc ltd limited llp lp plc pllc pc pa chtd lllp pvt private opc huf "
    "sarl sas sasu sa eurl sci snc scop scp sca selarl selas cie gmbh ag bv nv srl spa sl sprl oy ab as pty pte bhd sdn kk".split()
)
# Which legal form names a record, first that occurs.
LEGAL_ORDER = "llc llp inc corp ltd plc sarl sas sasu sa eurl sci gmbh pvt co cie lp pllc pc opc".split()
# Words left out of a name's core.
NAME_STOP = set("the & of de la le les du des d l a an".split())
# Words of names.
NAME_WORDS = {
    "corporation": "corp", "incorporated": "inc", "company": "co", "limited": "ltd", "private": "pvt",
    "brothers": "bros", "brother": "bro", "international": "intl", "internationale": "intl", "manufacturing": "mfg",
    "services": "svcs", "service": "svc", "technologies": "tech", "technology": "tech", "associates": "assoc",
    "association": "assoc", "department": "dept", "enterprises": "ent", "enterprise": "ent", "industries": "ind",
    "industry": "ind", "management": "mgmt", "government": "govt", "hospital": "hosp", "restaurant": "rest",
    "pharmaceuticals": "pharma", "pharmaceutical": "pharma", "laboratories": "labs", "laboratory": "lab",
    "solutions": "soln", "systems": "sys", "center": "ctr", "centre": "ctr", "national": "natl", "saint": "st",
    "sainte": "ste", "mount": "mt", "and": "&", "et": "&", "und": "&", "compagnie": "cie", "societe": "ste",
    "etablissements": "ets", "shree": "sri", "shri": "sri", "shre": "sri", "sree": "sri", "lakshmi": "laxmi",
    "laksmi": "laxmi", "ganesha": "ganesh", "krsna": "krishna",
}
# Words of addresses.
ADDRESS_WORDS = {
    "street": "st", "str": "st", "road": "rd", "avenue": "ave", "av": "ave", "avn": "ave", "aven": "ave",
    "boulevard": "blvd", "bd": "blvd", "boul": "blvd", "bvd": "blvd", "lane": "ln", "drive": "dr", "court": "ct",
    "place": "pl", "plaza": "plz", "square": "sq", "highway": "hwy", "parkway": "pkwy", "expressway": "expy",
    "freeway": "fwy", "terrace": "ter", "circle": "cir", "trail": "trl", "suite": "ste", "apartment": "apt",
    "building": "bldg", "floor": "fl", "flr": "fl", "room": "rm", "north": "n", "south": "s", "east": "e",
    "west": "w", "northeast": "ne", "northwest": "nw", "southeast": "se", "southwest": "sw", "mount": "mt",
    "fort": "ft", "saint": "st", "sainte": "ste", "number": "no", "num": "no", "nagar": "ngr", "nager": "ngr",
    "marg": "mg", "sector": "sec", "sect": "sec", "market": "mkt", "opposite": "opp", "near": "nr", "behind": "bhd",
    "colony": "col", "cross": "crs", "main": "mn", "phase": "ph", "extension": "extn", "ext": "extn",
    "industrial": "indl", "estate": "est", "junction": "jn", "jct": "jn", "chowk": "chk", "bazaar": "bazar",
    "bajar": "bazar", "galli": "gali", "mohalla": "mohala", "post": "po", "district": "dist", "distt": "dist",
    "tehsil": "teh", "village": "vill", "vpo": "vill", "taluka": "tal", "taluk": "tal", "layout": "lyt",
    "stage": "stg", "block": "blk", "plot": "plt", "complex": "cplx", "tower": "twr", "house": "hse",
    "bhawan": "bhavan", "rue": "rue", "r": "rue", "impasse": "imp", "chemin": "chem", "ch": "chem", "route": "rte",
    "allee": "all", "faubourg": "fbg", "quai": "qu", "cours": "crs", "passage": "pass", "residence": "res",
    "batiment": "bat", "cedex": "",
}
# Ordinals in words.
ORDINALS = {
    "first": "1", "second": "2", "third": "3", "fourth": "4", "fifth": "5", "sixth": "6", "seventh": "7",
    "eighth": "8", "ninth": "9", "tenth": "10", "premier": "1", "premiere": "1",
}
# States of one word.
STATES = {
    "alabama": "al", "alaska": "ak", "arizona": "az", "arkansas": "ar", "california": "ca", "colorado": "co",
    "connecticut": "ct", "delaware": "de", "florida": "fl", "georgia": "ga", "hawaii": "hi", "idaho": "id",
    "illinois": "il", "indiana": "in", "iowa": "ia", "kansas": "ks", "kentucky": "ky", "louisiana": "la",
    "maine": "me", "maryland": "md", "massachusetts": "ma", "michigan": "mi", "minnesota": "mn", "mississippi": "ms",
    "missouri": "mo", "montana": "mt", "nebraska": "ne", "nevada": "nv", "ohio": "oh", "oklahoma": "ok",
    "oregon": "or", "pennsylvania": "pa", "tennessee": "tn", "texas": "tx", "utah": "ut", "vermont": "vt",
    "virginia": "va", "washington": "wa", "wisconsin": "wi", "wyoming": "wy", "maharashtra": "mh", "mharastr": "mh",
    "karnataka": "ka", "telangana": "ts", "gujarat": "gj", "rajasthan": "rj", "kerala": "kl", "punjab": "pb",
    "haryana": "hr", "bihar": "br", "odisha": "od", "orissa": "od", "assam": "as", "jharkhand": "jh",
    "chhattisgarh": "cg", "chattisgarh": "cg", "uttarakhand": "uk", "uttaranchal": "uk", "goa": "ga", "sikkim": "sk",
    "tripura": "tr", "manipur": "mnp", "meghalaya": "ml", "mizoram": "mz", "nagaland": "nl", "delhi": "dl",
    "dilli": "dl", "puducherry": "py", "pondicherry": "py", "chandigarh": "chd",
}
# States of several words.
STATE_PHRASES = {
    "new hampshire": "nh", "new jersey": "nj", "new mexico": "nm", "new york": "ny", "north carolina": "nc",
    "north dakota": "nd", "south carolina": "sc", "south dakota": "sd", "rhode island": "ri", "west virginia": "wv",
    "district of columbia": "dc", "puerto rico": "pr", "uttar pradesh": "up", "madhya pradesh": "mp",
    "andhra pradesh": "ap", "arunachal pradesh": "ar", "himachal pradesh": "hp", "tamil nadu": "tn", "tamilnadu": "tn",
    "west bengal": "wb", "new delhi": "dl", "nai dilli": "dl", "jammu and kashmir": "jk", "jammu kashmir": "jk",
    "andaman and nicobar": "an", "dadra and nagar haveli": "dn", "daman and diu": "dd",
}
# Names of countries.
COUNTRIES = {
    "us": "us", "usa": "us", "u s": "us", "u s a": "us", "united states": "us", "united states of america": "us",
    "america": "us", "in": "india", "ind": "india", "india": "india", "bharat": "india", "republic of india": "india",
    "fr": "france", "fra": "france", "france": "france", "republique francaise": "france", "french republic": "france",
}
# Where a landmark follows, and how a second name is introduced.
LANDMARK = r"\b(?:near|nr|opp|opposite|behind|bhd|beside|besides|next to|adjacent to|adj to|in front of|close to|pres de|pres du|face a|face au|en face de|a cote de|derriere|a proximite de)\b\.?\s*([^,;]+)"
SECOND_NAME = r"\b(?:d\s*/\s*b\s*/\s*a|dba|t\s*/\s*a|trading as|doing business as|aka|a\s*/\s*k\s*/\s*a|formerly|formerly known as|fka)\b\.?"
# Letters of the nine Indic blocks, by their place in a block of 128.
INDIC_BLOCKS = range(0x0900, 0x0D80, 0x80)
VOWELS = {
    0x05: "a", 0x06: "aa", 0x07: "i", 0x08: "i", 0x09: "u", 0x0A: "u", 0x0B: "ri", 0x0C: "ri", 0x0D: "li", 0x0E: "e",
    0x0F: "e", 0x10: "ai", 0x11: "o", 0x12: "o", 0x13: "o", 0x14: "au",
}
CONSONANTS = {
    0x15: "k", 0x16: "kh", 0x17: "g", 0x18: "gh", 0x19: "ng", 0x1A: "ch", 0x1B: "chh", 0x1C: "j", 0x1D: "jh", 0x1E: "ny",
    0x1F: "t", 0x20: "th", 0x21: "d", 0x22: "dh", 0x23: "n", 0x24: "t", 0x25: "th", 0x26: "d", 0x27: "dh", 0x28: "n",
    0x29: "n", 0x2A: "p", 0x2B: "ph", 0x2C: "b", 0x2D: "bh", 0x2E: "m", 0x2F: "y", 0x30: "r", 0x31: "r", 0x32: "l",
    0x33: "l", 0x34: "l", 0x35: "v", 0x36: "sh", 0x37: "sh", 0x38: "s", 0x39: "h",
}
SIGNS = {
    0x3E: "aa", 0x3F: "i", 0x40: "i", 0x41: "u", 0x42: "u", 0x43: "ri", 0x44: "ri", 0x45: "e", 0x46: "e", 0x47: "e",
    0x48: "ai", 0x49: "o", 0x4A: "o", 0x4B: "o", 0x4C: "au",
}
MARKS = {0x01: "n", 0x02: "n", 0x03: "h"}
NUKTA, VIRAMA = 0x3C, 0x4D
# Spellings that a skeleton takes for one.
FOLDS = {"ph": "f", "bh": "b", "dh": "d", "th": "t", "kh": "k", "gh": "g", "sh": "s", "ch": "c", "ck": "k", "q": "k", "x": "ks", "w": "v", "z": "j", "y": "i", "c": "k"}
VOICED = {"g": "k", "d": "t", "b": "p", "j": "s"}
