"""Section text and tokens."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: words left out of term counts ------------------------------------------
STOP_WORDS = (
    "with", "the", "and", "for", "from", "this", "that", "your", "have", "been", "which", "drug",
    "take", "taking", "medicine", "medicines", "doctor", "pharmacist", "nhs", "more", "also",
    "some", "other", "tell", "used", "may", "will", "does", "when", "they", "what", "about",
    "than", "then", "there", "these", "those", "such", "into", "over", "after", "before",
    "because", "should", "could", "would", "their", "them", "here", "very", "just", "like", "make",
    "most", "only", "same", "each", "well", "even", "much", "many", "know", "need", "sure", "feel",
    "stop", "start", "keep", "body", "time", "days", "week", "weeks", "include", "including",
    "contact", "call", "seek", "help", "away", "side", "effects", "effect",
)
# --- end of fixed values ------------------------------------------------------------------


def tokenise(text: Column, stop_words=STOP_WORDS) -> Column:
    """Lower-case runs of four or more letters a-z, in order, repeats kept, stop words left out."""
    words = F.regexp_extract_all(F.lower(text), F.lit("([a-z]{4,})"), F.lit(1))
    stops = [w for w in stop_words]
    if not stops:
        return words
    return F.filter(words, lambda w: ~w.isin(stops))


def section_text(heading: Column, text: Column, bullets: Column) -> Column:
    """Heading, paragraphs and bullets of one section as a single text."""
    blank = F.lit("")
    return F.concat_ws(
        " ",
        F.coalesce(heading, blank),
        F.coalesce(text, blank),
        bullets,
    )
