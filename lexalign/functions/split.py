"""Mixtures split into units, and other one-to-many string functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _half, clean_spaces, clean_unit, is_fragment, is_trivial, let, normalize, squeeze, strip, text_of

_MARK = "§"


def split_mixture(c: Column | str, compat_nan: bool = False) -> Column:
    """Parts of a mixture, set apart by plus signs, semicolons, et or and; a chemical family at the end goes."""
    s = F.regexp_replace(strip(text_of(c, compat_nan)), r"(?i)\bfamille\s+chimique\b.*$", "")
    s = F.translate(s, "＋", "+")
    for pattern in (r"\s*\+\s*", r"\s*;\s*", r"(?i)\s+et\s+", r"(?i)\s+and\s+"):
        s = F.regexp_replace(s, pattern, f" {_MARK} ")
    return F.filter(F.transform(F.split(s, _MARK), strip), lambda p: p != "")


def first_of_each(items: Column, key) -> Column:
    """Items in order, of those with like keys only the first."""
    pairs = F.transform(items, lambda x: F.struct(key(x).alias("k"), x.alias("x")))
    once = let(pairs, lambda ps: let(F.transform(ps, lambda p: p["k"]), lambda ks: F.filter(ps, lambda p, i: F.array_position(ks, p["k"]) == i + 1)))
    return F.transform(once, lambda p: p["x"])


def split_units(c: Column | str, compat_nan: bool = False) -> Column:
    """split_mixture(), each part cleaned; trivial ones and repetitions go."""
    units = F.transform(split_mixture(c, compat_nan), clean_unit)
    return first_of_each(F.transform(F.filter(units, lambda u: ~is_trivial(u)), _half), normalize)


def fixed_slots(c: Column | str, slots: int = 4, none: str = "NON SPECIFIE") -> list[Column]:
    """The first parts between plus signs as slots columns; an unspecified formula has none in the first."""
    s = strip(text_of(c))
    parts = F.filter(F.transform(F.split(s, r"\+"), strip), lambda p: p != "")
    missing = normalize(s).isin("", "non specifie", "non specifiee", "none", "null", "nan")
    return [F.when(missing, F.lit(none if i == 0 else "")).otherwise(F.coalesce(F.get(parts, F.lit(i)), F.lit(""))) for i in range(slots)]


def split_loose(c: Column | str) -> Column:
    """Parts between commas, strokes and plus signs."""
    return F.transform(F.split(text_of(c), "[,/+]"), strip)


def split_wide(c: Column | str) -> Column:
    """Parts between gaps of two spaces or more."""
    return F.filter(F.transform(F.split(strip(text_of(c)), r"\s{2,}"), strip), lambda p: p != "")


def cell_entities(c: Column | str, is_product: bool = False) -> Column:
    """Entities of a cell: between strokes, if it has any and is no product; else its lines, broken-off ends glued on."""
    s = clean_spaces(c)
    lines = F.filter(F.split(s, "\n"), lambda x: x != "")
    glued = _glued(lines)
    if is_product:
        return glued
    parts = F.filter(F.transform(F.split(F.regexp_replace(s, "\n", " "), "/"), strip), lambda p: p != "")
    return F.when(s.contains("/"), parts).otherwise(glued)


def _glued(lines: Column) -> Column:
    """Lines with fragments joined to the line before: a mark stands before each line that begins an entity."""
    marked = F.transform(lines, lambda x, i: F.when((i > 0) & is_fragment(x), x).otherwise(F.concat(F.lit("\n"), x)))
    return F.filter(F.split(F.array_join(marked, " "), r"\s*\n"), lambda x: x != "")


def chunks(c: Column | str, most: int = 5000) -> Column:
    """A text in chunks of whole lines of up to most characters; a longer line stays whole.

    The newline behind the first line of a text counts, that behind the first of a later chunk does not.
    """
    s = text_of(c)
    state = F.struct(F.array().cast("array<string>").alias("done"), F.lit(None).cast("string").alias("now"), F.lit(0).alias("size"))

    def add(acc: Column, line: Column) -> Column:
        fits = acc["size"] + F.length(line) + 1 <= most
        return F.when(acc["now"].isNull(), F.struct(acc["done"].alias("done"), line.alias("now"), (F.length(line) + 1).alias("size"))).when(
            fits, F.struct(acc["done"].alias("done"), F.concat_ws("\n", acc["now"], line).alias("now"), (acc["size"] + F.length(line) + 1).alias("size"))
        ).otherwise(F.struct(F.concat(acc["done"], F.array(acc["now"])).alias("done"), line.alias("now"), F.length(line).alias("size")))

    folded = F.aggregate(F.split(s, "\n"), state, add, lambda acc: F.concat(acc["done"], F.array(acc["now"])))
    return F.when(F.length(s) <= most, F.array(s)).otherwise(F.filter(F.transform(folded, strip), lambda x: x != ""))


def repaired_row(cells: Column, width: int = 4, none: str = "Non spécifié") -> Column:
    """A row of width cells: short ones filled up, long ones cut; ways to say nothing become none in a row that fits."""
    clean = F.transform(cells, strip)
    named = F.transform(clean, lambda x: F.when(F.lower(x).isin("", "none", "null", "nan"), none).otherwise(x))
    filled = F.slice(F.concat(clean, F.array_repeat(F.lit(none), width)), 1, width)
    return F.when(F.size(cells) == width, named).otherwise(filled)


# Words of doses and uses, which are no name; what stands for a registration number.
USE_WORDS = [
    "l/ha", "cc/hl", "g/hl", "dose", "volume de", "kg/ha", "teigne",
    "mildiou", "thrips", "mineuse", "puceron", "acariens", "tuta absoluta",
    "traitement", "applications", "pulvérisation", "cultures",
]
NUMBER_LIKE = r"(?i)[A-Z0-9.\-/]{3,}"
# End of the fixed values.


def origin_row(cells: Column, none: str = "Non spécifié") -> Column:
    """Product, company, maker and country of a row of any width.

    The country comes last. Rows of four have only these, wider ones a substance first and, unless five cells have
    nothing like it, a registration number third; five cells with one have no maker. Short rows are filled up as they
    are; in others, cells that say nothing or speak of doses and uses become none.
    """
    def row(c: Column) -> Column:
        n = F.size(c)
        bare = (n == 5) & ~F.get(c, F.lit(2)).rlike(NUMBER_LIKE)
        shift = F.when(n == 4, 1).when(bare, 2).otherwise(3)
        maker = F.when((n == 5) & ~bare, F.lit(none)).otherwise(F.get(c, shift + 1))
        named = F.array(F.get(c, F.when(n == 4, 0).otherwise(1)), F.get(c, shift), maker, F.get(c, n - 1))
        said = F.transform(named, lambda x: F.when(F.lower(x).isin("", "none", "null", "nan") | F.lower(x).rlike("|".join(USE_WORDS)), none).otherwise(x))
        return F.when(n < 4, F.slice(F.concat(c, F.array_repeat(F.lit(none), 4)), 1, 4)).otherwise(said)

    return let(F.transform(cells, strip), row)


def positional_pairs(a: Column, b: Column) -> Column:
    """Pairs of items at like places, to the end of the shorter list."""
    n = F.least(F.size(a), F.size(b))
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda i: F.struct(F.get(a, i).alias("a"), F.get(b, i).alias("b"))))


def padded_at(items: Column, i: Column) -> Column:
    """The item at place i; a single item stands at all places, an empty list and places beyond give an empty string."""
    return F.when(F.size(items) == 1, F.get(items, F.lit(0))).otherwise(F.coalesce(F.get(items, i), F.lit("")))


def slashed(c: Column | str) -> Column:
    """Parts between strokes; the text itself if there are none."""
    s = text_of(c)
    parts = F.filter(F.transform(F.split(s, "/"), strip), lambda p: p != "")
    return let(parts, lambda ps: F.when(F.size(ps) > 0, ps).otherwise(F.array(s)))


def token_count(c: Column | str) -> Column:
    s = squeeze(text_of(c))
    return F.when(s == "", 0).otherwise(F.size(F.split(s, " ")))
