"""Rule data for the organisation-name normaliser.

Every table is an ordered list of ``(find, replace)`` pairs applied left to
right with plain (non-regex) replace-all.  Order is part of the meaning:
later rules see the output of earlier ones.  Leading and trailing blanks
inside the patterns are significant (names are kept blank-padded while the
rules run).

FIXED VALUES: the tables below must equal the reference normaliser's rule
tables entry for entry, in the same order, for results to match.  They are
stated here as plain text.  The single-digit ordinal rules (40 entries) are
generated from a rule in ``ordinal_digit_rules`` instead of being listed.
"""

from __future__ import annotations

# ---------------------------------------------------------------- FIXED VALUES
# Stage N2: punctuation.  Symbols are deleted (replaced by nothing).
PUNCTUATION = [
    (" ST. ", " ST "),
    (" ASSOC.", " ASSOC "),
    ("..", ""),
    (".", ""),
    ("(", ""),
    (")", ""),
    (",", ""),
    (";", ""),
    (":", ""),
    ("-", ""),
    ("/", ""),
    ("@", ""),
    ("+", ""),
    ("*", ""),
    ("[", ""),
    ("]", ""),
    ("!", ""),
    ("|", ""),
    ("`", ""),
    ("=", ""),
    ("\\", ""),
    ("_", ""),
    ("{", ""),
    ("}", ""),
    ("%", ""),
    ("&", ""),
    ("#", ""),
]

# Stage N3: apostrophes.
APOSTROPHES = [
    (" 'S ", "S "),
    ("'S ", "S "),
    ("' ", ""),
    (" '", ""),
    ("S'", "S"),
    ("'N'", "N"),
    ("'", ""),
]

# Stage N5: spelling corrections.
SPELLING = [
    (" FREIND ", " FRIEND "),
    (" ASSOCATION ", " ASSOCIATION "),
    (" ASSOCIATON ", " ASSOCIATION "),
    (" ASOCIATION ", " ASSOCIATION "),
    (" ASSOCAITION", " ASSOCIATION "),
    (" ASSOCIAION ", " ASSOCIATION "),
    (" ASSOCAITION ", " ASSOCIATION"),
    (" ASSOCIATOPM ", " ASSOCIATION "),
    (" ASS ", " ASSOCIATION "),
    (" ASSOCN ", " ASSOCIATION "),
    (" ASSOCIATIONSACDA ", " ASSOCIATION SACDA "),
    (" CENTER ", " CENTRE "),
    (" GIUDE", "GUIDE "),
    (" CONGEGATION ", " CONGREGATION "),
    (" ORGANIZAT", " ORGANISAT"),
    (" DISTICT ", " DISTRICT "),
    (" DISRICT ", " DISTRICT "),
    (" DISABILLI ", " DISABILI "),
    (" AMATUER ", " AMATEUR "),
    (" BUSISNESS ", " BUSINESS "),
    (" VICARIGE ", " VICARAGE "),
    (" REHABILITAION ", " REHABILITATION "),
    (" PANAL ", " PANEL "),
    (" BRITAN ", " BRITAIN "),
    (" BRITANIA ", " BRITANNIA "),
    (" CUMBRA ", " CUMBRIA "),
    (" NEIGHBOR", " NEIGHBOUR"),
    (" COUNCILOR ", " COUNCILLOR "),
    (" MATHEW ", " MATTHEW "),
    (" VILLIAGE", " VILLAGE "),
    (" HERATAGE ", " HERITAGE "),
    (" SHEILD", " SHIELD "),
    (" COMUNITY ", " COMMUNITY "),
    (" COMUNITIES ", " COMMUNITIES "),
    (" COMMMUNITY ", " COMMUNITY "),
    (" COMITTEE ", " COMMITTEE "),
    (" COMMITEE ", " COMMITTEE "),
    (" INDEPENDANT ", " INDEPENDENT "),
    (" SYNDROMAE ", " SYNDROME "),
    (" WILDLIFW ", " WILDLIFE "),
    (" CENRE ", " CENTRE "),
    (" COMMUNITYYOUTH ", " COMMUNITY YOUTH "),
    (" AUTISMWEST ", " AUTISM WEST "),
    (" OFGOD ", " OF GOD "),
    (" INFORMARION ", " INFORMATION "),
    (" DEVELOPEMENT ", " DEVELOPMENT "),
    (" CHRITIAN ", " CHRISTIAN "),
    (" ROYALM ", " ROYAL "),
    (" LARYNGECOMY ", " LARYNGECTOMY "),
    (" ALCHOL ", " ALCOHOL "),
    (" RESARCH ", " RESEARCH "),
    (" REASEARCH ", " RESEARCH "),
    (" BEATY ", " BEAUTY "),
    (" CENTR ", " CENTRE "),
]

# Stage N6: company-suffix words, checked in this order against the end of
# the stripped name; on a hit every occurrence becomes "LTD ".
LTD_SUFFIXES = ["LIMITED", "LIMITE", "LIMIT", "LIMIT ", "LIMI", "LIMI", "LIM", "LIM"]

# Stage N7: abbreviations.
ABBREVIATIONS = [
    (" PUBLIC LIMITED COMPANY ", " PLC "),
    (" C I C ", " CIC "),
    (" COMMUNITY INTEREST COMPANY (CIC) ", "CIC"),
    (" COMMUNITY INTEREST COMPANY ", " CIC "),
    (" COMMUNITY INTEREST COMPAN ", " CIC "),
    (" COMMUNITY INTEREST COMPA ", " CIC "),
    (" COMMUNITY INTEREST COMP ", " CIC "),
    (" COMMUNITY INTEREST COM ", " CIC "),
    (" COMMUNITY INTEREST CO ", " CIC "),
    (" COUNCIL FOR VOLUNTARY SERVICES", " CVS "),
    (" COUNCIL FOR VOLUNTARY SERVICE", " CVS "),
    (" UNITED REFORMED CHURCH", " URC "),
    (" URC CHURCH", " URC "),
    (" UR CHURCH", " URC "),
    (" ALSO KNOWN AS", " AKA "),
    (" ROYAL ANTEDILUVIAN ORDER OF BUFFALOES", " RAOB "),
    (" ROYAL ANTIDILUVIAN ORDER OF BUFALLOES", " RAOB "),
    (" ROYAL ANTEDILUVIAN ORDER OF BUFFALOS", " RAOB "),
    (" CO OP", " COOPERATIVE "),
    (" CO OPS", " COOPERATIVE "),
    (" CO OPERATIVE", " COOPERATIVE "),
    (" CO OPERATIVES", " COOPERATIVE "),
    (" COOP ", " COOPERATIVE "),
    (" COOPS", " COOPERATIVE "),
    (" COOPERATIVES", " COOPERATIVE "),
    (" DEPARTMENT", " DEPT "),
    (" DEPARTMENTS", " DEPT "),
    (" DEPTS", " DEPT "),
    (" PROG ", " PROGRAMME "),
    (" PROGRAM ", " PROGRAMME "),
    (" ASSOCIATION", " ASSOC "),
    (" COMM ", " COMMUNITY "),
    (" SOCIETY ", " SOC "),
    (" SOCY ", " SOC "),
    (" SERV ", " SERVICE "),
    (" REGT ", " REGIMENT "),
    (" INFO ", " INFORMATION "),
    (" AVE ", " AVENUE "),
    (" THEATRE CO ", " THEATRE COMPANY "),
    (" AND CO ", "AND COMPANY "),
    (" CO LTD ", " COMPANY LTD "),
]

# Stage N9: stop words.
STOPWORDS = [
    (" THE ", " "),
    (" AND ", " "),
    (" OF ", " "),
    (" FOR ", " "),
    (" WITH ", " "),
    (" AT ", " "),
    (" TO ", " "),
    (" IN ", " "),
    (" ON ", " "),
    (" AN ", " "),
]

# Stages N12-N14: parent/teacher association handling.
PTA_ALIASES = [(" PTFA ", " PTA "), (" PSA ", " PTA ")]
PTA_ROLE_WORDS = [
    (" PARENTS ", " "),
    (" PARENT ", " "),
    (" TEACHERS ", " "),
    (" TEACHER ", " "),
    (" FRIENDS ", " "),
    (" FRIEND ", " "),
    (" STAFF ", " "),
    (" ASSOC ", " "),
]
COMMUNITY_ASSOC = (" CA ", " COMMUNITY ASSOC ")

# Stage N15: domain table (youth groups, schools, clubs, compass points,
# counties, place typos, football, ordinals).  The source lists
# " SCOUT GROUP " twice with the same replacement; a mapping keeps the
# first position, so it appears once here.
DOMAIN = [
    (" SCOUT GROUP ", " SCOUTS "),
    (" SCOUT ASSOC  ", "  SCOUTS  "),
    (" SCOUTS ASSOC  ", "  SCOUTS  "),
    (" SCOUT UNIT ", " SCOUTS "),
    (" SCOUT UNITS ", " SCOUTS "),
    (" SCOUTS UNIT ", " SCOUTS "),
    (" SCOUTS UNITS ", " SCOUTS "),
    (" SCOUT GROUPS ", " SCOUTS "),
    (" SCOUTS GROUP ", " SCOUTS "),
    (" SCOUTS GROUPS ", " SCOUTS "),
    (" SCOUT PACK ", " SCOUTS "),
    (" SCOUT PACKS ", " SCOUTS "),
    (" SCOUTS PACK ", " SCOUTS "),
    (" SCOUTS PACKS ", " SCOUTS "),
    (" BOY SCOUTS ", " SCOUTS "),
    (" GIRL GUIDE ", " GIRL GUIDES "),
    (" GIRL GUIDING ", " GIRL GUIDES "),
    (" GIRLGUIDING ", " GIRL GUIDES "),
    (" GIRL GUIDES ", " GUIDES "),
    (" GUIDE ASSOC ", " GUIDES "),
    (" GUIDES ASSOC ", " GUIDES "),
    (" GUIDE UNIT ", " GUIDES "),
    (" GUIDE UNITS ", " GUIDES "),
    (" GUIDES UNIT ", " GUIDES "),
    (" GUIDES UNITS ", " GUIDES "),
    (" GUIDE GROUP ", " GUIDES "),
    (" GUIDE GROUPS ", " GUIDES "),
    (" GUIDES GROUP ", " GUIDES "),
    (" GUIDES GROUPS ", " GUIDES "),
    (" GUIDE PACK ", " GUIDES "),
    (" GUIDE PACKS ", " GUIDES "),
    (" GUIDES PACK ", " GUIDES "),
    (" GUIDES PACKS ", " GUIDES "),
    (" BROWNIE ASSOC  ", " BROWNIES  "),
    (" BROWNIES ASSOC  ", " BROWNIES  "),
    (" BROWNIE UNIT ", " BROWNIES "),
    (" BROWNIE UNITS ", " BROWNIES "),
    (" BROWNIES UNIT ", " BROWNIES "),
    (" BROWNIES UNITS ", " BROWNIES "),
    (" BROWNIE GROUP ", " BROWNIES "),
    (" BROWNIE GROUPS ", " BROWNIES "),
    (" BROWNIES GROUP ", " BROWNIES "),
    (" BROWNIES GROUPS ", " BROWNIES "),
    (" BROWNIE PACK ", " BROWNIES "),
    (" BROWNIE PACKS ", " BROWNIES "),
    (" BROWNIES PACK ", " BROWNIES "),
    (" BROWNIES PACKS ", " BROWNIES "),
    (" BEAVER GROUP ", " BEAVERS "),
    (" BEAVER GROUPS ", " BEAVERS "),
    (" BEAVERS GROUP ", " BEAVERS "),
    (" BEAVERS GROUPS ", " BEAVERS "),
    (" BEAVER COLONY ", " BEAVERS "),
    (" BEAVERS COLONY ", " BEAVERS "),
    (" CESCHOOL ", " CE SCHOOL "),
    (" CPSCHOOL ", " CP SCHOOL "),
    (" RCSCHOOL ", " RC SCHOOL "),
    (" PRE SCHOOL ", " PRESCHOOL "),
    (" PLAY SCHOOL ", " PLAYSCHOOL "),
    (" WOMENS INSTITUTE ", " WI "),
    (" WOMEN INSTITUTE ", " WI "),
    (" WORKINGMENS ", " WORKING MENS "),
    (" WORKING MENS SOCIAL CLUB ", " WMC "),
    (" WORKING MENS CLUB ", " WMC "),
    (" WORKMENS CLUB ", " WMC "),
    (" WMC INSTITUTE ", " WMC "),
    (" SAINT ", " ST "),
    (" NORTH EAST ", " NE "),
    (" NORTH WEST ", " NW "),
    (" SOUTH EAST ", " SE "),
    (" SOUTH WEST ", " SW "),
    (" NORTHEAST ", " NE "),
    (" NORTHWEST ", " NW "),
    (" SOUTHEAST ", " SE "),
    (" SOUTHWEST ", " SW "),
    (" STH ", " SOUTH "),
    (" COF E ", " CE "),
    (" C OFE ", " CE "),
    (" COFE ", " CE "),
    (" MIDDLESEX ", " MIDDX "),
    (" BEDFORDSHIRE ", " BEDS "),
    (" BERKSHIRE ", " BERKS "),
    (" BUCKINGHAMSHIRE ", " BUCKS "),
    (" CAMBRIDGESHIRE ", " CAMBS "),
    (" HUNTINGDONSHIRE ", " HUNTS "),
    (" CHESHIRE ", " CHES "),
    (" DERBYSHIRE ", " DERBYS "),
    (" CO DURHAM ", " COUNTY DURHAM "),
    (" GLOUCESTERSHIRE ", " GLOS "),
    (" HAMPSHIRE ", " HANTS "),
    (" HAMPS ", " HANTS "),
    (" HEREFORDSHIRE ", " HEREFS "),
    (" HERTFORDSHIRE ", " HERTS "),
    (" ISLE OF WIGHT ", " IOW "),
    (" ISLE WIGHT ", " IOW "),
    (" LANCASHIRE ", " LANCS "),
    (" LEICESTERSHIRE ", " LEICS "),
    (" LINCOLNSHIRE ", " LINCS "),
    (" NORTHAMPTONSHIRE ", " NORTHANTS "),
    (" NLAND ", " NORTHUMBERLAND "),
    (" NOTTINGHAMSHIRE ", " NOTTS "),
    (" OXFORDSHIRE ", " OXON "),
    (" SHROPSHIRE ", " SALOP "),
    (" SHROPS ", " SALOP "),
    (" STAFFORDSHIRE ", " STAFFS "),
    (" WARWICKSHIRE ", " WARKS "),
    (" WILTSHIRE ", " WILTS "),
    (" WORCESTERSHIRE ", " WORCS "),
    (" YORKSHIRE ", " YORKS "),
    (" SOUTHAMPTION ", " SOUTHAMPTON "),
    (" SOTHAMPTON ", " SOUTHAMPTON "),
    (" BRIMINGHAM ", " BIRMINGHAM "),
    (" BHAM ", " BIRMINGHAM "),
    (" BIRMINGAHM ", " BIRMINGHAM "),
    (" PERY BARR ", " PERRY BARR "),
    (" GLAGOW ", " GLASGOW "),
    (" FOOTBALL CLUB ", " FC "),
    (" YOUNG MENS CHRISTIAN ASSOCIATION ", " YMCA "),
    (" YOUNG WOMENS CHRISTIAN ASSOCIATION ", " YWCA "),
    (" YOUNG MENS CHRISTIAN ASSOC ", " YMCA "),
    (" YOUNG WOMENS CHRISTIAN ASSOC ", " YWCA "),
    (" INCORPORATED ", " INC "),
    ("  AFC ", "  FC "),
    (" JUNIORS FC ", " JUNIOR FC "),
    (" JFC ", " JUNIOR FC "),
    (" ARLFC ", " AMATEUR RUGBY LEAGUE FC "),
    (" RUFC ", " RUGBY UNION FC "),
    (" RLFC ", " RUGBY LEAGUE FC "),
    (" RFC ", " RUGBY FC "),
    (" YFC ", " YOUTH FC "),
    (" NEWCASTLE UPON TYNE ", " NEWCASTLE "),
    (" NEWCASTLE TYNE ", " NEWCASTLE "),
    (" HOLME UPON SPALDING MOOR ", " HOLME SPALDING MOOR "),
    (" UPON ", "  "),
    (" 1ST ", " FIRST "),
    (" IST ", " FIRST "),
    (" 2ND ", " SECOND "),
    (" 3RD ", " THIRD "),
    (" FOURTH ", " 4 "),
    (" FIFTH ", " 5 "),
    (" SIXTH ", " 6 "),
    (" SEVENTH ", " 7 "),
    (" EIGHTH ", " 8 "),
    (" NINTH ", " 9 "),
    (" TENTH ", " 10 "),
    (" ELEVENTH ", " 11 "),
    (" TWELFTH ", " 12 "),
    (" THIRTEENTH ", " 13 "),
    (" FOURTEENTH ", " 14 "),
    (" FIFTEENTH ", " 15 "),
    (" SIXTEENTH ", " 16 "),
    (" SEVENTEENTH ", " 17 "),
    (" EIGHTEENTH ", " 18 "),
    (" NINETEENTH ", " 19 "),
    (" TWENTIETH ", " 20"),
]

# Stage N16: context rules, each applied only when the trigger word is in
# the name (checked in this order, on the name as it is at that point).
CONTEXT_RULES = [
    ("GUIDE", [(" BROWNIE ", " BROWNIES "), (" SCOUT ", " SCOUTS ")]),
    ("SCOUT", [(" CUB ", " CUBS "), (" SCOUT SCOUT ", " SCOUT ")]),
    ("SCHOOL", [(" ROMAN CATHOLIC ", " RC "), (" CATHOLIC ", " RC "),
                (" CHURCH ENGLAND ", " CE "), (" JUNIOR INFANT ", " JI ")]),
]

# Stage N17: ordinal words that append a digit token.
ORDINAL_APPEND = [(" FIRST ", " 1 "), (" SECOND ", " 2 "), (" THIRD ", " 3 ")]

# Stage N19: tail rules.
TAIL = [
    (" CO OPERAT", " COOPERAT"),
    (" CO ORDINAT", " COORDINAT"),
    (" PRIMARY CARE TRUST", " PCT"),
    (" NATIONAL HEALTH SERVICE ", " NHS "),
    (" A ", " "),
]

# Redaction phrases for the payment feeds (case-sensitive substrings).
REDACTION_PHRASES = [
    "SUCCESSFUL SUPPL",
    "SEE ATTACH",
    "REFER ATTACH",
    "CONTRACT WAS AWARD",
    "AWARDED SUPPLIERS",
    "SUCCESSFUL SUPPLIER",
    "PLEASE SEE",
    "NAMED IND",
    "REDACT",
    "PLEASE REFER",
]
# ------------------------------------------------------------ END FIXED VALUES


def ordinal_digit_rules() -> list[tuple[str, str]]:
    """Stage N18: ' dST ', ' dND ', ' dRD ', ' dTH ' -> ' d ' for d = 0..9.

    Generated in digit-major order (all four suffixes of 0, then of 1, ...).
    """
    out = []
    for d in range(10):
        for suffix in ("ST", "ND", "RD", "TH"):
            out.append((f" {d}{suffix} ", f" {d} "))
    return out
