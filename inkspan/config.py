"""Fixed values and parameters of the archive pipeline."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, replace

# ---- Fixed values: they must equal the reference's for equal results. ----
#: Characters that scanning leaves behind.
JUNK_CHARS = "|¦©°∫¬§±×÷¤¨¸˜"
#: Single-character replacements made before junk is stripped; NUL is removed.
REPLACE_FROM, REPLACE_TO = "|¦©°ſ∫", "IIooss"
#: Words of at most two letters that are genuine.
SHORT_WORDS = ("a i o an as at be by do go he if in is it me my no of on or so to up us we mr dr st vs").split()
#: Words of older English that modern dictionaries lack.
WHITELIST = (
    "ye thee thou thy thine hath doth hast wilt shalt mayst wouldst couldst shouldst mightst art wert hadst "
    "hither thither whither wherein whereof thereof hereof hereby therein methinks perchance haply belike forsooth "
    "nay aye yea verily prithee pray forthwith heretofore henceforth notwithstanding "
    "publick musick logick ethick rhetorick connexion inflexion reflexion compleat shew shewed shewn staid spake writ "
    "honour colour labour neighbour favour centre theatre fibre lustre sceptre recognise organise realise civilise "
    "defence offence pretence licence esq viz ibid idem supra infra aforesaid aforementioned "
    "whereas whereby whereupon whereunto mr mrs dr sr jr rev hon gen"
).split()
#: Keywords by period, by which segments are scored.
PERIOD_KEYWORDS = {
    "wwi": (
        "war;european war;great war;world war;kaiser;wilhelm;germany;german;austria;allies;allied;entente;france;french;"
        "belgium;belgian;britain;british;trenches;western front;eastern front;submarine;u-boat;lusitania;armistice;peace;"
        "treaty;versailles;draft;conscription;selective service;military;army;navy;soldiers;troops;regiment;casualty;"
        "casualties;killed;wounded;liberty bonds;war bonds;wilson;congress;declaration of war;neutral;neutrality;battle;"
        "offensive;munitions;artillery;red cross"
    ).split(";"),
    "wwii": (
        "war;world war;second world war;hitler;nazi;fascist;axis;japan;japanese;pearl harbor;allies;allied;britain;british;"
        "france;french;russia;soviet;invasion;normandy;d-day;bombing;blitz;air raid;pacific;atlantic;draft;"
        "selective service;military;army;navy;marines;soldiers;troops;casualty;casualties;killed;wounded;rationing;ration;"
        "war bonds;roosevelt;churchill;stalin;surrender;victory;v-e day;v-j day;concentration camp;holocaust;atomic;"
        "hiroshima;nagasaki;battle;offensive;convoy;torpedo;red cross"
    ).split(";"),
}
#: Keywords by era, in the order in which the first match wins.
ERA_KEYWORDS = {
    "Revolutionary War / Colonial": (
        "revolution;colonial;patriot;1770;1775;1776;bunker hill;boston massacre;tea party;sons of liberty;faneuil;"
        "paul revere;samuel adams;crispus attucks;old state house;declaration of independence"
    ).split(";"),
    "Civil War / Abolition (1830s-1860s)": (
        "abolitionist;abolition;slavery;civil war;frederick douglass;liberator;anti-slavery;emancipation;phillis wheatley"
    ).split(";"),
    "WWI era (1914-1918)": "world war i;wwi;great war;1914;1915;1916;1917;1918;trench".split(";"),
    "Interwar (1919-1938)": "1919;prohibition;great depression;1929;1930s".split(";"),
    "WWII era (1939-1945)": (
        "world war ii;wwii;1939;1940;1941;1942;1943;1944;1945;pearl harbor;d-day;nazi;holocaust"
    ).split(";"),
    "Post-1945 / Modern": "jfk;kennedy;big dig;marathon bombing;2013".split(";"),
    "Boston landmarks / general history": (
        "boston common;beacon hill;navy yard;boston public library;cape cod;postcards"
    ).split(";"),
    "Other / Non-Boston": "indigenous;zulu;south africa".split(";"),
}
#: Question templates with their types, used in turn.
QA_TEMPLATES = (
    ("What did the {newspaper} report about the war on {date}?", "explanatory"),
    ("Find newspaper coverage of war events from {date} in the {newspaper}.", "document"),
    ("What war-related news appeared in the {newspaper} on {date}?", "explanatory"),
    ("Show me {newspaper} articles from {date} about military operations.", "document"),
    ("How did the {newspaper} cover the war effort on {date}?", "explanatory"),
)
PAGE_BREAK = "--- PAGE BREAK ---"
ID_PREFIX = "commonwealth:"
#: Weights of the composite score: character anomaly, non-alphabetic tokens, short tokens.
COMPOSITE_WEIGHTS = (0.40, 0.35, 0.25)
#: USD for a million tokens.
EMBEDDING_PRICES = {"small": 0.02, "large": 0.13}


@dataclass(frozen=True)
class Retry:
    """Back-off of a source that is read over a network."""

    max_retries: int = 5
    timeout: int = 20
    backoff: tuple = (2, 5, 10, 30, 60)


@dataclass(frozen=True)
class Config:
    """Parameters of a run; every step takes them as arguments, never from globals."""

    text_col: str = "raw_text"
    min_ingest_chars: int = 50
    min_extract_chars: int = 100
    segment_min_chars: int = 200
    segment_min_score: int = 2
    top_segments: int = 5
    chunk_chars: int = 1500
    tokens_per_word: float = 1.3
    image_width: int = 1500
    per_page: int = 100
    max_pages: int | None = None
    zipf_threshold: float = 1.5
    periods: tuple = ("wwi", "wwii")
    retry: Retry = field(default_factory=Retry)

    def for_test(self) -> Config:
        """The smoke-run variant: two pages of each listing."""
        return replace(self, max_pages=2)


def load_config(path: str | None = None, **overrides) -> Config:
    """Config from a JSON or YAML mapping of the field names, then the overrides; unknown names raise."""
    values: dict = {}
    if path:
        with open(path, encoding="utf-8") as f:
            if path.endswith((".yaml", ".yml")):
                import yaml

                values = yaml.safe_load(f) or {}
            else:
                values = json.load(f)
    values.update(overrides)
    if isinstance(values.get("retry"), dict):
        values["retry"] = Retry(**values["retry"])
    return Config(**values)
