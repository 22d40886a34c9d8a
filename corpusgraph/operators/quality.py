"""Quality class of a page and whether it belongs to the default corpus."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusgraph.functions.text import AFTER, BEFORE

# The subject words of the default corpus, as a pattern.
SUBJECT = r"UFO|UAP|flying saucers?|flying discs?|flying disks?|orbs?|unidentified"


def quality(raw: Column, kept: Column, removed: Column, s: dict[str, Column]) -> Column:
    """empty, needs_review, aggressive_cleanup or clean; raw and kept are lengths, removed counts dropped lines."""
    ratio = kept.cast("double") / F.nullif(raw, F.lit(0))
    return (
        F.when((raw == 0) | (kept == 0), "empty")
        .when((kept < 320) & (s["sentence_like_blocks"] == 0) & (s["alpha_word_count"] < 28), "needs_review")
        .when((s["natural_language_score"] < F.lit(0.18)) & (s["sentence_like_blocks"] == 0), "needs_review")
        .when((ratio < F.lit(0.18)) | (removed > 40), "needs_review")
        .when(ratio < F.lit(0.45), "aggressive_cleanup")
        .otherwise("clean")
    )


def in_default(text: Column, quality_: Column, s: dict[str, Column], subject: str = SUBJECT) -> Column:
    """Whether a page goes to the default corpus; `subject` is a pattern of words that decide."""
    about = text.rlike(rf"(?i){BEFORE}({subject}){AFTER}")
    score, words = s["natural_language_score"], s["alpha_word_count"]
    return (
        F.when(quality_.isin("empty", "needs_review") | (F.length(text) < 180), False)
        .when(about, (score >= F.lit(0.28)) & (words >= 12))
        .otherwise((s["sentence_like_blocks"] >= 1) | ((score >= F.lit(0.32)) & (words >= 80)))
    )
