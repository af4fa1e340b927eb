"""Quality metrics of scanned text; null and empty texts score as the empty text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkspan.config import COMPOSITE_WEIGHTS, JUNK_CHARS, SHORT_WORDS
from inkspan.text.classes import NOT_WS, WS_IN, c, ratio, rounded, text_of

JUNK = f"[{JUNK_CHARS}]"
PUNCT_ONLY = r"[.,;:!?\-\"'()]+"
#: Limits of a token, and tokens of which a count suffices: only punctuation, with a letter, with one or two letters.
BEGIN, END = f"(?<!{NOT_WS})", f"(?!{NOT_WS})"
OTHER = f"[^{WS_IN}a-zA-Z]*"
PUNCT_TOKEN = f"(?=[.,;:!?\\-\"'()]){BEGIN}{PUNCT_ONLY}{END}"
LETTER_TOKEN = f"{OTHER}[a-zA-Z]{NOT_WS}*"
SHORT_TOKEN = f"{BEGIN}{OTHER}[a-zA-Z](?:{OTHER}[a-zA-Z])?{OTHER}{END}"


def matches(x, pattern: str) -> Column:
    return F.regexp_count(text_of(x), F.lit(pattern))


def token_count(x) -> Column:
    return matches(x, f"{NOT_WS}+")


def junk_count(x) -> Column:
    return F.length(text_of(x)) - F.length(F.translate(text_of(x), JUNK_CHARS, ""))


def symbol_count(x) -> Column:
    """Characters that are neither alphanumeric nor space nor junk."""
    return matches(x, rf"[^\p{{L}}\p{{N}}{WS_IN}{JUNK_CHARS}]")


def anomaly_rate(x) -> Column:
    return ratio(junk_count(x), F.length(text_of(x)))


def symbol_rate(x) -> Column:
    return ratio(symbol_count(x), F.length(text_of(x)))


def non_alpha_parts(x) -> tuple[Column, Column]:
    """Tokens without an ASCII letter, tokens; tokens of punctuation alone don't count."""
    base = token_count(x) - matches(x, PUNCT_TOKEN)
    return base - matches(x, LETTER_TOKEN), base


def short_parts(x) -> tuple[Column, Column]:
    """Tokens of one or two letters that are no word, tokens with a letter."""
    letters = F.transform(F.regexp_extract_all(text_of(x), F.lit(SHORT_TOKEN), 0), lambda t: F.lower(F.regexp_replace(t, "[^a-zA-Z]", "")))
    return F.size(F.filter(letters, lambda t: ~t.isin(*SHORT_WORDS))), matches(x, LETTER_TOKEN)


def non_alpha_rate(x) -> Column:
    return ratio(*non_alpha_parts(x))


def short_rate(x) -> Column:
    return ratio(*short_parts(x))


def composite(anomaly: Column, non_alpha: Column, short: Column) -> Column:
    """1 less the weighted rates (already rounded), within [0, 1]."""
    a, n, s = COMPOSITE_WEIGHTS
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.lit(1.0) - (a * anomaly + n * non_alpha + s * short)))


METRICS = ("character_anomaly_rate", "non_alpha_token_rate", "short_token_rate", "symbol_rate", "composite_score")


def counts_of(x) -> dict[str, Column]:
    """What the metrics are made of, as whole numbers."""
    (non_alpha, base), (short, lettered) = non_alpha_parts(x), short_parts(x)
    return {"_chars": F.length(text_of(x)), "_junk": junk_count(x), "_symbols": symbol_count(x), "_non_alpha": non_alpha, "_base": base, "_short": short, "_lettered": lettered}


def with_scores(df, keep: list, text_col: str):
    """The columns ``keep`` and the metrics, each rounded to four digits.

    Three projections, so that every pattern is counted once and every rate computed once: Spark doesn't merge
    projections whose costly columns are used more than once.
    """
    names = [k if isinstance(k, str) else df.select(k).columns[0] for k in keep]
    counted = df.select(*keep, *[v.alias(k) for k, v in counts_of(text_col).items()])
    rates = zip(METRICS, ("_junk", "_non_alpha", "_short", "_symbols"), ("_chars", "_base", "_lettered", "_chars"), strict=False)
    rated = counted.select(*names, *[rounded(ratio(F.col(a), F.col(b))).alias(m) for m, a, b in rates])
    ca, na, st = map(F.col, METRICS[:3])
    return rated.select(*names, *METRICS[:4], rounded(composite(ca, na, st)).alias(METRICS[4]))


def score_columns(x) -> dict[str, Column]:
    """The metrics of a text, each rounded to four digits."""
    x = c(x)
    ca, na, st = (rounded(r) for r in (anomaly_rate(x), non_alpha_rate(x), short_rate(x)))
    return {
        "character_anomaly_rate": ca,
        "non_alpha_token_rate": na,
        "short_token_rate": st,
        "symbol_rate": rounded(symbol_rate(x)),
        "composite_score": rounded(composite(ca, na, st)),
    }
