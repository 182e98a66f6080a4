"""DuckDB spellings of the text functions, for the SQL that states queries' results."""

from lexalign.functions import text as t


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def fold(x: str) -> str:
    return f"strip_accents(lower(trim({x}, ' ' || chr(9) || chr(10) || chr(13))))"


def quotes(x: str) -> str:
    return f"translate({x}, '’`´', '''''''')"


def rules(x: str, pairs: list[tuple[str, str]]) -> str:
    for a, b in pairs:
        x = f"regexp_replace({x}, {q(a)}, {q(b)}, 'g')"
    return x


def squeeze(x: str) -> str:
    return f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"


def normalize(x: str) -> str:
    return squeeze(rules(quotes(fold(f"coalesce({x}, '')")), [(r"\([^)]*\)", " ")]))


def half(x: str) -> str:
    w = f"string_split({x}, ' ')"
    return f"CASE WHEN len({w}) >= 2 AND len({w}) % 2 = 0 AND {w}[1 : len({w}) // 2] = {w}[len({w}) // 2 + 1 :] THEN array_to_string({w}[1 : len({w}) // 2], ' ') ELSE {x} END"


def clean_steps(rel: str, keep: str, x: str) -> str:
    """A query of rel: the columns keep, and x cleaned as u; step by step, so that the text stays short."""
    s = f"SELECT {keep}, {quotes(fold(f'coalesce({x}, {q(str())})'))} AS u FROM {rel}"
    s = f"SELECT {keep}, translate({rules('u', t.DOSES)}, '()', '  ') AS u FROM ({s})"
    for part in (t.OPENINGS + t.TRANSLATIONS, t.SPELLINGS):
        s = f"SELECT {keep}, {rules('u', part)} AS u FROM ({s})"
    copper = " ".join(f"WHEN contains(u, {q(w)}) THEN {q(n)}" for w, n in t.COPPER)
    s = f"SELECT {keep}, CASE WHEN contains(u, 'cuivre') OR contains(u, 'copper') THEN CASE {copper} ELSE u END ELSE u END AS u FROM ({s})"
    s = f"SELECT {keep}, {squeeze(rules('u', t.NOISE_WORDS + t.LAST))} AS u FROM ({s})"
    return f"SELECT {keep}, {half('u')} AS u FROM ({s})"


def trivial(x: str) -> str:
    alone = ", ".join(q(w) for w in t.UNITS_ALONE)
    return f"(length(trim({x})) < 2 OR regexp_full_match(trim({x}), '[\\d\\-+/\\\\%]+') OR trim({x}) IN ({alone}) OR NOT regexp_matches({x}, '(?i)[a-z]'))"


def mixture(x: str) -> str:
    s = rules(f"trim(coalesce({x}, ''))", [(r"(?i)\bfamille\s+chimique\b.*$", ""), (r"\s*\+\s*", " § "), (r"\s*;\s*", " § "), (r"(?i)\s+et\s+", " § "), (r"(?i)\s+and\s+", " § ")])
    return f"list_filter(list_transform(string_split({s}, '§'), lambda p: trim(p)), lambda p: p <> '')"


def status(x: str) -> str:
    from lexalign.functions.regulatory import STATUS_WORDS

    s = f"lower(trim(coalesce({x}, '')))"
    return "CASE " + " ".join("WHEN " + " OR ".join(f"contains({s}, {q(w)})" for w in words) + f" THEN {q(name)}" for name, words in STATUS_WORDS) + " ELSE 'unknown' END"
