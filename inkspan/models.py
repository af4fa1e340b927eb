"""Seams for models: each takes a backend that is made once in a worker, with a deterministic stand-in offline."""

from __future__ import annotations

import importlib.util
import json
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkspan.config import Config
from inkspan.text.classes import c
from inkspan.text.segments import cut_chunks

# What models are told.
CORRECTION = """### Instruction:
Correct the OCR errors in the following 19th-century historical text.
Preserve archaic spelling (e.g. publick, hath, ye, honour, connexion).
Do not modernise vocabulary or grammar.
If a passage cannot be confidently reconstructed, leave it as-is.
Return only the corrected text with no commentary.

### Input:
{text}

### Response:
"""
QA_RULES = """Given a newspaper excerpt from a specific date, create ONE focused question that
the excerpt directly answers, plus a concise 2-4 sentence answer.

Rules:
- The question must be specific enough that the given newspaper excerpt is a clear ground truth
- The answer must be based ONLY on the excerpt content
- Include specific dates, names, and events mentioned in the text
- Return JSON only -- no preamble, no markdown fences"""


def capabilities() -> dict[str, bool]:
    """Which optional libraries are installed."""
    return {n: importlib.util.find_spec(n) is not None for n in ("torch", "transformers", "openai", "PIL", "tiktoken", "sentencepiece")}


def same_text() -> Callable[[str], str]:
    """Stand-in of a corrector: gives a text back with its white space single."""
    return lambda prompt_text: " ".join(prompt_text.split())


def correct_texts(x, make: Callable[[], Callable[[str], str]] = same_text, size: int = Config.chunk_chars) -> Column:
    """Texts corrected chunk by chunk, the results joined by spaces. Null stays null."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = make()
        for s in batches:
            yield s.map(lambda t: None if t is None else " ".join(model(p) for p in cut_chunks(t, size)))

    return run(c(x))


def bpe_tokens(x, ranks: str, pattern: str) -> Column:
    """Tokens under a byte-pair vocabulary of ranks (base64 token and rank on each line); null and empty texts have 0."""
    import base64

    with open(ranks, "rb") as f:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}

    @F.pandas_udf("int")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import tiktoken

        encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        for s in batches:
            yield s.map(lambda t: len(encoding.encode_ordinary(t)) if t else 0)

    return run(c(x))


def no_pages() -> Callable[[bytes], str]:
    """Stand-in of a page reader: no text."""
    return lambda image: ""


def read_pages(content, make: Callable[[], Callable[[bytes], str]] = no_pages) -> Column:
    """Text of page images; a page that fails gives the empty text."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = make()

        def one(image):
            try:
                return model(image) if image is not None else ""
            except Exception:
                return ""

        for s in batches:
            yield s.map(one)

    return run(c(content))


def strip_fences(text: str) -> str:
    """An answer without the code fence around it."""
    t = text.strip()
    return re.sub(r"\s*```$", "", re.sub(r"^```(?:json)?\s*", "", t)) if t.startswith("```") else t


def parse_answer(text: str | None) -> dict | None:
    """The JSON object of an answer, fenced or not; None where there is none."""
    try:
        out = json.loads(strip_fences(text or ""))
        return out if isinstance(out, dict) else None
    except ValueError:
        return None


def parsed(x) -> Column:
    """struct<question, question_type, answer, confidence> of a model's answer, null where it is no JSON object."""
    t = F.trim(c(x))
    bare = F.when(t.startswith("```"), F.regexp_replace(F.regexp_replace(t, r"^```(?:json)?\s*", ""), r"\s*```$", "")).otherwise(t)
    s = F.from_json(bare, "question string, question_type string, answer string, confidence string")
    d = lambda n, v: F.coalesce(s[n], F.lit(v)).alias(n)
    return F.when(s.isNotNull() & F.try_parse_json(bare).isNotNull(), F.struct(d("question", ""), d("question_type", "explanatory"), d("answer", ""), d("confidence", "medium")))


def generate_pairs(articles: DataFrame, make: Callable[[], Callable[[str, str], str]]) -> DataFrame:
    """(ark_id, answer): a model's raw answers for articles, given QA_RULES and the article's prompt; null where it fails."""

    def run(batches):
        model = make()
        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                try:
                    out.append((r.ark_id, model(QA_RULES, r.prompt)))
                except Exception:
                    out.append((r.ark_id, None))
            yield pd.DataFrame(out, columns=["ark_id", "answer"])

    prompt = F.concat(
        F.lit("Newspaper: "), "newspaper", F.lit("\nDate: "), F.coalesce("issue_date", F.lit("unknown date")), F.lit("\nark_id: commonwealth:"), "ark_id",
        F.lit("\n\nExcerpt:\n"), F.substring(F.get("top_segments", F.lit(0))["text"], 1, 2000), F.lit("\n"),
    )
    return articles.select("ark_id", prompt.alias("prompt")).mapInPandas(run, "ark_id string, answer string")


def pairs_of_answers(articles: DataFrame, answers: DataFrame, order: str) -> DataFrame:
    """Full pairs of articles: made of a model's answer (ark_id, answer) where that is a JSON object, else of a template,
    used in turn by the article's number in the given order."""
    from inkspan.operators.articles import ground_truth, template_qa

    by_template = template_qa(articles, order)
    told = articles.join(answers.select("ark_id", parsed("answer").alias("_p")).where("_p is not null"), "ark_id")
    top = F.get("top_segments", F.lit(0))
    by_model = told.select(
        "_p.question", "_p.question_type", ground_truth().alias("ground_truths"), "_p.answer", "_p.confidence",
        F.format_string("pseudoGT_llm | war_score=%d | ocr=%s", top["score"], F.col("ocr_source")).alias("notes"), "period", order,
    )
    return by_template.join(by_model.select(order), order, "left_anti").unionByName(by_model)
