"""Rule-based cleaning of scanned text; null stays null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkspan.config import REPLACE_FROM, REPLACE_TO
from inkspan.text.classes import WS, WS_IN, W, c, strip

KEPT = rf"[^\p{{L}}\p{{N}}_{WS_IN}.,!?;:'\"\-\x{{2013}}\x{{2014}}()]"


def steps(parentheses: bool = True) -> list[tuple[str, str]]:
    """The ordered rewrites after the character replacements."""
    out = [
        (rf"({W})-{WS}*\n{WS}*({W})", "$1$2"),
        (r"\n{3,}", "\n\n"),
        (r"[ \t]+", " "),
        (r" *\n *", "\n"),
        (rf"{WS}([.,;:!?])", "$1"),
    ]
    if parentheses:
        out += [(rf"\({WS}+", "("), (rf"{WS}+\)", ")")]
    return [*out, (KEPT, "")]


def _chain(x: Column, rules) -> Column:
    for pattern, to in rules:
        x = F.regexp_replace(x, pattern, to)
    return x


def replaced(x) -> Column:
    """Character replacements only."""
    return F.translate(c(x), REPLACE_FROM + "\0", REPLACE_TO)


def clean_tier1(x) -> Column:
    """Replacements, joined hyphenation, tidy spaces and punctuation, junk removed."""
    return strip(_chain(replaced(x), steps()))


def clean_eval(x) -> Column:
    """As clean_tier1, parentheses left alone."""
    return strip(_chain(replaced(x), steps(parentheses=False)))


def clean_flat(x) -> Column:
    """Joined hyphenation, all white space single, junk removed; no replacements."""
    return strip(_chain(c(x), [steps()[0], (f"{WS}+", " "), (KEPT, "")]))
