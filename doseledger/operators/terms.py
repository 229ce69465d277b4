"""Term frequencies of medicine pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from doseledger.functions.text import STOP_WORDS, section_text, tokenise


def term_counts(sections: DataFrame, stop_words=STOP_WORDS) -> DataFrame:
    """Frequency of each term per medicine and page type.

    Terms are counted inside each task first, so a frequent term or a dominant medicine shuffles
    as one row per task. Stop words go behind the count, once a term.
    """
    words = tokenise(section_text(F.col("heading"), F.col("text"), F.col("bullets")), ())
    counted = (
        sections.select("drug", "page_type", F.explode(words).alias("term"))
        .groupBy("drug", "term", "page_type")
        .agg(F.count(F.lit(1)).alias("frequency"))
        .select("drug", "term", "frequency", "page_type")
    )
    stops = list(stop_words)
    return counted.filter(~F.col("term").isin(stops)) if stops else counted


def top_terms(sections: DataFrame, n: int = 20, stop_words=STOP_WORDS) -> DataFrame:
    """The ``n`` most frequent (term, page type) pairs of every medicine; ties by term."""
    best = Window.partitionBy("drug").orderBy(
        F.desc("frequency"), F.asc("term"), F.asc_nulls_last("page_type")
    )
    return (
        term_counts(sections, stop_words)
        .withColumn("__rank", F.row_number().over(best))
        .filter(F.col("__rank") <= n)
        .orderBy(F.asc_nulls_last("drug"), "__rank")
        .drop("__rank")
    )


def summary_terms_join(summary: DataFrame, terms: DataFrame) -> DataFrame:
    """Gold summary rows beside the top terms of the same medicine."""
    return summary.join(terms, "drug").select(
        "drug", "total_items", "total_cost_gbp", "avg_nic_per_item", "term", "frequency", "page_type"
    )
