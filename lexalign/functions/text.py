"""Text normalisation as column expressions; nothing here leaves the JVM."""

from __future__ import annotations

import unicodedata
from functools import cache, reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _folding() -> tuple[str, str]:
    """Latin letters whose compatibility decomposition is one ASCII character and marks, and that character."""
    found = {}
    for c in map(chr, range(0x80, 0x250)):
        base = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))
        if len(base) == 1 and base != c and ord(base) < 128:
            found[c] = base
    return "".join(found), "".join(found.values())


_FROM, _TO = _folding()
#: Spaces as Python's str.strip() and \s take them.
SPACE = r"[\s\x0B\x1C-\x1F\x85\xA0  -     　]"
_BLANKS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(c: Column, f) -> Column:
    """f(c), where c is worked out once however often f uses it; keeps expressions, and the code made from them, small."""
    return F.get(F.transform(F.array(c), f), F.lit(0))


def text_of(c: Column | str, compat_nan: bool = False) -> Column:
    """The text of a cell; a missing one is empty, or the word nan for parity with cells read as floats."""
    return F.coalesce(col(c).cast("string"), F.lit("nan" if compat_nan else ""))


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(_BLANKS))


def squeeze(c: Column) -> Column:
    return strip(F.regexp_replace(c, f"{SPACE}+", " "))


def _class(chars: list[str]) -> str:
    """A pattern for any of the characters, which are in order; neighbours make up a range."""
    spans: list[list[int]] = []
    for c in map(ord, chars):
        if spans and c == spans[-1][1] + 1:
            spans[-1][1] = c
        else:
            spans.append([c, c])
    return "[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in spans) + "]"


@cache
def _decompositions() -> tuple[str, str, str, str, str, str]:
    """Characters that decompose to one without marks, and that one; those that give several, these, and a pattern for
    them; a pattern for marks."""
    one, many, marks = {}, {}, []
    for c in map(chr, [*range(0x80, 0xAC00), *range(0xF900, 0x30000)]):
        if unicodedata.combining(c):
            marks.append(c)
        elif unicodedata.decomposition(c):
            base = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))
            if base != c:
                (one if len(base) == 1 else many)[c] = base
    return "".join(one), "".join(one.values()), "".join(many), "\x01".join(many.values()), _class([*many]), _class(marks)


_LEADS, _VOWELS, _TAILS = ("".join(map(chr, range(a, a + n))) for a, n in ((0x1100, 19), (0x1161, 21), (0x11A8, 27)))


def _decomposed(s: Column) -> Column:
    one, to, many, parts, any_many, marks = _decompositions()

    def syllable(x: Column) -> Column:
        i = F.ascii(x) - 0xAC00
        return F.concat(F.substring(F.lit(_LEADS), F.floor(i / 588).cast("int") + 1, F.lit(1)), F.substring(F.lit(_VOWELS), F.floor(i % 588 / 28).cast("int") + 1, F.lit(1)),
                        F.when(i % 28 > 0, F.substring(F.lit(_TAILS), (i % 28).cast("int"), F.lit(1))).otherwise(""))

    def apart(x: Column) -> Column:
        known = F.get(F.split(F.lit(parts), "\x01"), F.instr(F.lit(many), x) - 1)
        return F.when(x == "", x).when(x.between("가", "힣"), syllable(x)).otherwise(F.coalesce(known, x))

    whole = let(F.translate(s, one, to), lambda v: F.when(v.rlike(f"{any_many}|[가-힣]"), F.array_join(F.transform(F.split(v, ""), apart), "")).otherwise(v))
    return F.regexp_replace(whole, marks, "")


def fold(c: Column) -> Column:
    """Compatibility decomposition without combining marks; accented Latin letters by table, so that few texts need more."""
    return let(F.translate(c, _FROM, _TO), lambda s: F.when(s.rlike(r"[^\x00-\x7F]"), _decomposed(s)).otherwise(s))


def _quotes(c: Column) -> Column:
    return F.translate(c, "’`´", "'''")


#: What \b stands for in rules: an edge of a word of ASCII letters, digits and _, as in SQL. The JVM's own \b takes letters
#: of any script for word characters, and its versions differ.
_EDGE = r"(?:(?<=[0-9A-Za-z_])(?![0-9A-Za-z_])|(?<![0-9A-Za-z_])(?=[0-9A-Za-z_]))"


def replaced(c: Column, rules: list[tuple[str, str]]) -> Column:
    """The rules, pattern and replacement, one after the other."""
    return reduce(lambda x, r: F.regexp_replace(x, r[0].replace(r"\b", _EDGE), r[1]), rules, c)


def _half(c: Column) -> Column:
    """A phrase said twice is said once."""
    def once(words: Column) -> Column:
        n = F.size(words)
        middle = F.greatest(F.lit(1), F.floor(n / 2).cast("int"))
        twice = (n >= 2) & (n % 2 == 0) & (F.slice(words, 1, middle) == F.slice(words, middle + 1, n))
        return F.array_join(F.when(twice, F.slice(words, 1, middle)).otherwise(words), " ")

    return let(F.split(c, " "), once)


def normalize(c: Column | str) -> Column:
    """Lower case, no accents, straight quotes, no parentheses with their contents, single spaces; null is empty."""
    s = _quotes(fold(F.lower(strip(text_of(c)))))
    return squeeze(F.regexp_replace(s, r"\([^)]*\)", " "))


# Patterns and replacements that a cleaned name is defined by, in the order that they apply.
DOSES = [
    (r"(?i)\b\d+[\d.,*xX^eE\-\s/]*(?:spores/g|spores/l|spores|ufc/g|ufc/l|ufc|cfu/g|cfu/l|cfu|ui/mg|ui/g|ui|corps viraux/litre|corps viraux|g/l|g/kg|mg/kg|mg/l|%)\b", " "),
    (r"(?i)\b(min|max)\b\s*[\d.,]+\s*[a-z/%µ]+(?:/[a-z]+)?", " "),
    (r"(?i)\b[\d.,]+\s*(?:g|kg|mg|ug|µg|ml|l|%)(?:/[a-zA-Z]+)?", " "),
]
OPENINGS = [
    (r"\ba\s+base\s+d[’']", " "),
    (r"\ba\s+base\s+de\s+", " "),
    (r"\bbased\s+on\s+", " "),
]
TRANSLATIONS = [
    (r"\bsouche\b", "strain"),
    (r"\bhuiles?\b", "oil"),
    (r"\bsel\s+de\b", "salt"),
    (r"\bsel\s+d'\b", "salt "),
    (r"\bsel\b", "salt"),
    (r"\bcuivre\b", "copper"),
    (r"\bsoufre\b", "sulphur"),
    (r"\bacide\b", "acid"),
    (r"\bextrait\b", "extract"),
    (r"\bpheromones?\b", "pheromone"),
    (r"\bsp\b\.?", "subsp"),
    (r"\bsubsp\b\.?", "subsp"),
]
SPELLINGS = [
    (r"\bazadirachtine?\b", "azadirachtin"),
    (r"\blamb[ad]*a[\s-]*cyhalothrine?\b", "lambda-cyhalothrin"),
    (r"\bacetam[ei]pride?\b", "acetamiprid"),
    (r"\babamectine?\b", "abamectin"),
    (r"\bchlorpyri\s*phos\b", "chlorpyrifos"),
    (r"\bchlorpyrifos[\s-]+ethyl\b", "chlorpyrifos"),
    (r"\bimidach?lopride?\b", "imidacloprid"),
    (r"\bcypermethrine?\b", "cypermethrin"),
    (r"\bdeltamethrine?\b", "deltamethrin"),
    (r"\bthiameth?oxame?\b", "thiamethoxam"),
    (r"\bdimethoate?\b", "dimethoate"),
    (r"\blufenurone?\b", "lufenuron"),
    (r"\bmetam\s+(?:sodium|potassium)\b", "metam"),
    (r"\bphosphure\s+d[’']\s*al\b\.?", "aluminium phosphide"),
    (r"\bphosphure\s+d[’']\s*hy\b\.?", "phosphane"),
    (r"\bphosphure\s+de\s+magnesium\b", "magnesium phosphide"),
    (r"\bacetate\s+d[’']\s*ammonium\b", "ammonium acetate"),
    (r"\bhydrochlorure\s+de\s+trimethylamine\b", "trimethylamine hydrochloride"),
    (r"\barylex\s*active\b", "halauxifen-methyl"),
    (r"\bisoxabene?\b", "isoxaben"),
    (r"\bcycloxidime?\b", "cycloxydim"),
    (r"\bpropicinazole?\b", "propiconazole"),
    (r"\bpropiconazole?\b", "propiconazole"),
    (r"\bchlorothalonil\s+l\b", "chlorothalonil"),
    (r"\bdimethomophe?\b", "dimethomorph"),
    (r"\bdimethomorphe?\b", "dimethomorph"),
    (r"\bt+rifloxystrobine?\b", "trifloxystrobin"),
]
COPPER = [("hydroxyde", "copper hydroxide"), ("oxychlorure", "copper oxychloride"), ("sulfate", "copper sulfate"), ("oxyde", "copper oxide")]
NOISE_WORDS = [
    (r"\b(insecticide|fongicide|herbicide|acaricide|rodenticide|nematicide)\b", " "),
    (r"\b(sachet|piege|ec|sc|wp|sl|dg|gr|fs|ks|mg|ml|l|kg|g)\b", " "),
]
LAST = [(",", " "), (r"\s*-\s*", "-"), (r"[^a-z0-9+\- ]+", " ")]
UNITS_ALONE = ["g", "kg", "mg", "ml", "l", "%", "h", "a", "e", "x", "i"]
# End of the fixed values.


def clean_unit(c: Column | str) -> Column:
    """A unit's name ready to be matched: doses and formulation words gone, spellings and languages brought together."""
    s = _quotes(fold(F.lower(strip(text_of(c)))))
    s = F.translate(replaced(s, DOSES), "()", "  ")

    def metals(v: Column) -> Column:
        whole = F
        for word, name in COPPER:
            whole = whole.when((v.contains("cuivre") | v.contains("copper")) & v.contains(word), name)
        return whole.otherwise(v)

    s = let(replaced(s, OPENINGS + TRANSLATIONS + SPELLINGS), metals)
    return _half(squeeze(replaced(s, NOISE_WORDS + LAST)))


def is_trivial(c: Column | str) -> Column:
    """Whether a token says nothing: too short, a sign, a number, a unit."""
    return let(strip(col(c)), lambda t: (F.length(t) < 2) | t.rlike(r"^[\d\-+/\\%]+$") | t.isin(UNITS_ALONE) | ~t.rlike("(?i)[a-z]"))


# What the second generation of the cleaner drops.
DOSES_STRICT = [
    NOISE_WORDS[0],
    (r"\b\d+([.,]\d+)?\s*(%|sachet|piege|ec|sc|wp|sl|dg|gr|fs|ks|mg|ml|l|kg|g)\b", " "),
    (r"\s*-\s*", "-"),
    (r"[^a-z0-9+\-, ]+", " "),
]


def clean_unit_strict(c: Column | str) -> Column:
    """The second generation of clean_unit(): only numbers with units go, commas stay, any 2,4-d is 2,4-D."""
    s = squeeze(replaced(normalize(c), DOSES_STRICT))
    return let(s, lambda v: F.when(v.contains("2,4-d") | v.contains("2, 4-d") | v.contains("2 4-d"), "2,4-D").otherwise(v))


# Words that no company name keeps, and ways to say that there is no name.
COMPANY_WORDS = (
    r"(?<![\p{L}\p{N}_])(sarl|sas|ltd|spa|co|llc|inc|gmbh|france|tunisia|tunisie|limited|company|crop|protection|agrochemical|agrochemicals|"
    r"chemicals|chemical|sciences|science|agriculture|agricole)(?![\p{L}\p{N}_])"
)
UNSPECIFIED = ["non specifie", "non specifiee", "non specifiees", "non specifies", "none", "null", "nan", "", "non_specifie", "non-specifie"]
NO_NAME = "NON SPECIFIE"


def canonical_company(c: Column | str) -> Column:
    """Upper-case name without accents, punctuation, legal forms and places; NON SPECIFIE where nothing is left."""
    def kept(s: Column) -> Column:
        bare = squeeze(F.regexp_replace(F.regexp_replace(s, r"[^\p{L}\p{N}_\s]", " "), COMPANY_WORDS, ""))
        return F.upper(F.when(s.isin(UNSPECIFIED), "").otherwise(bare))

    return let(let(fold(F.lower(strip(text_of(c)))), kept), lambda n: F.when(n == "", NO_NAME).otherwise(n))


def audit_key(c: Column | str) -> Column:
    """Stripped, lower case, no accents; null stays null."""
    return fold(F.lower(strip(col(c).cast("string"))))


def simple_key(c: Column | str) -> Column:
    return F.lower(strip(text_of(c)))


def despaced(c: Column) -> Column:
    """Letters set apart by single spaces are joined, where over two parts are mostly one letter; wide gaps stay gaps."""
    def joined(v: Column) -> Column:
        parts = F.split(v, " ")  # wide gaps leave empty parts, which count
        apart = let(parts, lambda ps: (F.size(ps) > 2) & (F.size(F.filter(ps, lambda p: F.length(p) == 1)) > 0.6 * F.size(ps)))
        words = F.transform(F.split(v, r"\s{2,}"), lambda w: F.regexp_replace(w, " ", ""))
        return F.when(apart, F.array_join(words, " ")).otherwise(v)

    return let(c, joined)


def clean_spaces(c: Column | str) -> Column:
    """Each line stripped, despaced and its runs of blanks squeezed; blank lines go. Any line end ends a line."""
    lines = F.transform(F.split(text_of(c), "\r\n|\r|\n"), lambda x: F.regexp_replace(despaced(strip(x)), " +", " "))
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n")


# Ends of names that break off into cells of their own.
FRAGMENT_WORDS = """
SC OD EC WG SL WP EW GR SG SP FS CS DS WS AE AL CG DP SE DF DC WDG WSP ULV FL FC G AS
CO LTD LIMITED SA SARL SAS AG SPA CORP CORPORATION INC PLC BV GMBH
AGROCHEMICAL AGROCHEMICALS CROPSCIENCE CROPCHEM AGROSCIENCE LIFESCIENCE CHEMICAL CHEMICALS SCIENCE SCIENCES CHEM BIOTECH AGRI NUTRITION
INDUST INDUSTRIAS INDUSTRIES INDUSTR INDUSTRY INDUSTRIAL INDUSTRIE INTERNATIONAL INTER HOLDINGS HOLDING GROUP GLOBAL DEVELOPMENT RD
YSTA PHOSPHORUS PROTECTION PRODUCTS PRODUCT EUROPE FRANCE GERMANY SPAIN ITALY CHINA USA UK CHINE JAPAN INDIA SOCIETE
FABRICANT DISTRIBUTE DISTRIBUTED BY PAR FONGICIDE INSECTICIDE HERBICIDE PESTICIDE PESTICIDES
YER RTEVA TEVA COR DA RDA SAN AN SHA SHAR WIDE ARYSTA UPL ARISTEAS AGRO
AGRICOLE FLUIDES BELGIUM BELGIQUE NV CHEMISTRY TUNISIE TUNISIA
ESPAGNE ESPANA ESPAGNA ITALIE ITALIA ALLEMAGNE POLSKA POLOGNE PAYSBAS NEDERLAND NETHERLANDS SUISSE SWITZERLAND SUECIA SUEDE
PORTUGAL AUTRICHE AUSTRIA DANEMARK DENMARK FINLANDE FINLAND HONGRIE HUNGARY TCHEQUE CZECHIA SLOVAQUIE SLOVAKIA CROATIE
ROUMANIE ROMANIA BULGARIE BULGARY GRECE GREECE IRLANDE IRELAND MAROC MOROCCO ALGERIE ALGERIA EGYPTE EGYPT TURQUIE TURKEY
BRESIL BRAZIL MEXIQUE MEXICO ARGENTINE ARGENTINA AUSTRALIE AUSTRALIA COREE KOREA TAIWAN SINGAPOUR SINGAPORE ISRAEL ISRAE
""".split()
# Misreadings and what they stand for.
MISREADINGS = {
    "JJANGY": "JIANGYIN SULI CHEMICAL",
    "JJANGYIN": "JIANGYIN SULI CHEMICAL",
    "JJANGYIN SULI CHEMICAL": "JIANGYIN SULI CHEMICAL",
    "JTANGYIN SULI CHEMICAL": "JIANGYIN SULI CHEMICAL",
    "JLANGY IN SULI CHEMICAL": "JIANGYIN SULI CHEMICAL",
    "JIANGYIN SULI CHEMICA": "JIANGYIN SULI CHEMICAL",
    "ALBAU": "ALBAU GH EUROPE SARL",
}
# End of the fixed values.


def is_fragment(c: Column | str, suffixes: list[str] | None = None) -> Column:
    """Whether a cell is a broken-off end: blank, two letters or fewer, or only known ends and words of two letters."""
    known = FRAGMENT_WORDS if suffixes is None else suffixes

    def broken(t: Column) -> Column:
        return let(
            F.regexp_extract_all(F.upper(t), F.lit("[A-Z0-9]+"), 0),
            lambda words: F.when(t == "", True).when(F.size(words) == 0, False).otherwise((F.length(F.array_join(words, "")) <= 2) | F.forall(words, lambda w: w.isin(known) | (F.length(w) <= 2))),
        )

    return let(strip(text_of(c)), broken)


def corrected(c: Column | str, corrections: dict[str, str] = MISREADINGS) -> Column:
    """A cell that equals a key of corrections, whatever its case, becomes the value."""
    if not corrections:
        return col(c)
    table = F.create_map(*[F.lit(x) for k, v in corrections.items() for x in (k.upper(), v)])
    return F.coalesce(F.element_at(table, F.upper(strip(col(c)))), col(c))


def upper_squeezed(c: Column | str) -> Column:
    return F.upper(squeeze(text_of(c)))


def clean_cas(c: Column | str) -> Column:
    """Digits and hyphens of a registry number; empty if missing."""
    return F.regexp_replace(text_of(c), "[^0-9-]", "")


def reference_url(ident: Column | str, template: str) -> Column:
    """template with {id} filled in; empty without an id."""
    before, after = template.split("{id}")
    i = strip(text_of(ident))
    return F.when(i == "", "").otherwise(F.concat(F.lit(before), i, F.lit(after)))


# Section titles and the categories they stand for; two labels lack an S in the middle, as published.
CATEGORIES = {
    "INSECTICIDES": "INECTICIDE",
    "FONGICIDES": "FONGICIDE",
    "HERBICIDES": "HERBICIDE",
    "NÉMATICIDES": "NÉMATICIDE",
    "NEMATICIDES": "NÉMATICIDE",
    "RATICIDES": "RATICIDE",
}
# End of the fixed values.


def section_category(c: Column | str, titles: dict[str, str] = CATEGORIES) -> Column:
    """Label of the last title, in the order given, that stands in the text as a word of its own; null without one."""
    s = F.upper(text_of(c))
    found = [F.when(s.rlike(rf"(?<![\p{{L}}\p{{N}}_]){t}(?![\p{{L}}\p{{N}}_])"), F.lit(label)) for t, label in titles.items()]
    return F.coalesce(*reversed(found))


def is_registration_number(c: Column | str) -> Column:
    """A cell with a registration number such as I.076-11, F.018-18 or 16-011I., and not a formulation code."""
    s = F.regexp_replace(F.upper(strip(text_of(c))), " ", "")
    shape = s.rlike(r"\b[IF]\.A?\b|\b\d+-[A-Z0-9.]+\b|\b[A-Z0-9.]+-\d+\b") | s.startswith("I.") | s.startswith("F.") | s.contains("I.A.")
    return shape & ~s.isin("EC", "SC", "WG", "WP", "EW", "GR", "SG", "SP", "SL")
