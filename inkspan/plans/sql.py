"""Fragments of DuckDB SQL that the checks share."""

from __future__ import annotations

# Written out here, not taken from the operators, so that a mistake there shows.
SPACE_IN = r"\s\x0b\x1c-\x1f\x85\p{Z}"
SPACE, SOLID = f"[{SPACE_IN}]", f"[^{SPACE_IN}]"
JUNK = "|¦©°∫¬§±×÷¤¨¸˜"
FROM, TO = "|¦©°ſ∫", "IIooss"
SHORT = ["a", "i", "o", "an", "as", "at", "be", "by", "do", "go", "he", "if", "in", "is", "it", "me", "my", "no", "of", "on", "or", "so", "to", "up", "us", "we", "mr", "dr", "st", "vs"]
#: The rewrites of cleaning, in order; those of parentheses are left out in one variant.
REWRITES = [
    (r"([\p{L}\p{N}_])-[\s\x0b\x1c-\x1f\x85\p{Z}]*\n[\s\x0b\x1c-\x1f\x85\p{Z}]*([\p{L}\p{N}_])", r"\1\2"),
    (r"\n{3,}", "\n\n"), (r"[ \t]+", " "), (r" *\n *", "\n"), (r"[\s\x0b\x1c-\x1f\x85\p{Z}]([.,;:!?])", r"\1"),
    (r"\([\s\x0b\x1c-\x1f\x85\p{Z}]+", "("), (r"[\s\x0b\x1c-\x1f\x85\p{Z}]+\)", ")"),
    (r"[^\p{L}\p{N}_\s\x0b\x1c-\x1f\x85\p{Z}.,!?;:'\"\-\x{2013}\x{2014}()]", ""),
]


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def listed(items) -> str:
    return "[" + ", ".join(map(lit, items)) + "]"


def sub(x: str, pattern: str, to: str = "") -> str:
    return f"regexp_replace({x}, {lit(pattern)}, {lit(to)}, 'g')"


def strip(x: str) -> str:
    return sub(x, f"^{SPACE}+|{SPACE}+\\z")


def found(x: str, pattern: str) -> str:
    return f"regexp_extract_all({x}, {lit(pattern)})"


def count(x: str, pattern: str) -> str:
    return f"len({found(x, pattern)})"


def tokens(x: str) -> str:
    return found(x, f"{SOLID}+")


def words(x: str) -> str:
    return found(x, "[A-Za-z]+")


def rounded(x: str, digits: int = 4) -> str:
    m = f"{10**digits}.0::double"
    return f"floor(({x})::double * {m} + 0.5) / {m}"


def ratio(a: str, b: str) -> str:
    return f"case when ({b}) = 0 then 0.0::double else ({a})::double / ({b}) end"


def replaced(x: str) -> str:
    return f"replace(translate({x}, {lit(FROM)}, {lit(TO)}), chr(0), '')"


def clean(x: str, parentheses: bool = True) -> str:
    x = replaced(x)
    for pattern, to in REWRITES if parentheses else [*REWRITES[:5], REWRITES[7]]:
        x = sub(x, pattern, to)
    return strip(x)


def clean_flat(x: str) -> str:
    return strip(sub(sub(sub(x, *REWRITES[0]), f"{SPACE}+", " "), REWRITES[7][0]))


def junk(x: str) -> str:
    return count(x, f"[{JUNK}]")


def symbols(x: str) -> str:
    return count(x, rf"[^\p{{L}}\p{{N}}{SPACE_IN}{JUNK}]")


def non_alpha(x: str) -> tuple[str, str]:
    kept = f"list_filter({tokens(x)}, lambda t: not regexp_full_match(t, {lit("[.,;:!?\\-\"'()]+")}))"
    return f"len(list_filter({kept}, lambda t: not regexp_matches(t, '[a-zA-Z]')))", f"len({kept})"


def short(x: str) -> tuple[str, str]:
    letters = f"list_filter(list_transform({tokens(x)}, lambda t: regexp_replace(t, '[^a-zA-Z]', '', 'g')), lambda t: t <> '')"
    return f"len(list_filter({letters}, lambda t: length(t) <= 2 and not list_contains({listed(SHORT)}, lower(t))))", f"len({letters})"


def scores(x: str) -> dict[str, str]:
    """The five metrics of the column x, which must not be null."""
    ca = rounded(ratio(junk(x), f"length({x})"))
    na, st = rounded(ratio(*non_alpha(x))), rounded(ratio(*short(x)))
    comp = f"greatest(0.0::double, least(1.0::double, 1.0::double - (0.40::double * ({ca}) + 0.35::double * ({na}) + 0.25::double * ({st}))))"
    return {"character_anomaly_rate": ca, "non_alpha_token_rate": na, "short_token_rate": st, "symbol_rate": rounded(ratio(symbols(x), f"length({x})")), "composite_score": rounded(comp)}


def score_columns(x: str) -> str:
    return ", ".join(f"{v} as {k}" for k, v in scores(x).items())


METRICS = ("character_anomaly_rate", "non_alpha_token_rate", "short_token_rate", "symbol_rate", "composite_score")


def long_form(source: str, keep: str) -> str:
    """source: a query with the five metrics; keep: its other columns."""
    return " union all ".join(f"select {keep}, '{m}' as metric, {m} as value from ({source}) s_{k}" for k, m in enumerate(METRICS))


def statistics(long: str, by: str) -> str:
    """The corpus statistics of (by, metric, value)."""
    v = "cast(floor(value * 10000 + 0.5) as bigint)"
    at = lambda p: rounded(f"quantile_cont(v, {p}) / 10000")
    return (
        f"select {by}, metric, n, {rounded('s / n / 10000')} as mean, {rounded('sqrt(greatest(0.0::double, q / n - (s / n) * (s / n))) / 10000')} as std, p10, p50, p90 from ("
        f"select {by}, metric, count(*) as n, sum(v)::double as s, sum(v * v)::double as q, {at(0.1)} as p10, {at(0.5)} as p50, {at(0.9)} as p90 "
        f"from (select {by}, metric, {v}::double as v from ({long}) l) w group by {by}, metric) z"
    )


def segments(x: str, least: int = 200) -> str:
    """Paragraphs merged into segments, as a list."""
    paras = f"list_filter(list_transform(string_split_regex({x}, '\\n{{2,}}'), lambda p: {strip('p')}), lambda p: p <> '')"
    start = f"list_transform({paras}, lambda p: {{'s': []::varchar[], 'c': '', 'p': p}})"
    grown = "case when a.c = '' then b.p else a.c || chr(10) || chr(10) || b.p end"
    first = "{'s': []::varchar[], 'c': '', 'p': ''}"
    fold = (
        f"list_reduce({start}, lambda a, b: case when length({grown}) >= {least} then {{'s': list_append(a.s, {grown}), 'c': '', 'p': ''}} "
        f"else {{'s': a.s, 'c': {grown}, 'p': ''}} end, {first})"
    )
    return fold


def segment_list(fold: str) -> str:
    """The segments of a folded struct (see segments), the rest added to the last one."""
    f = f"({fold})"
    return f"case when {f}.c = '' then {f}.s when len({f}.s) = 0 then [{f}.c] else list_append({f}.s[:-2], {f}.s[-1] || chr(10) || chr(10) || {f}.c) end"
