"""Sentences and answers rendered from columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tierline.functions.casting import timestamp_text

# The wording users of the retrieval results rely on.
CUSTOMER_SENTENCE = (
    "Customer %s has placed %d orders totaling %.2f in revenue. First seen %s; last seen %s."
)
NO_MATCH = "I couldn't find any matching customers in Gold."
CONTEXT_HEADER = "Question: %s\n\nGrounding context:"
CONTEXT_LINE = "  - %s  (distance=%.3f)"
ANSWER_LINE = (
    "\n\nAnswer (grounded): customer %s is the closest match with %d orders "
    "and %.2f lifetime revenue."
)


def customer_sentence(
    customer_id: Column, orders: Column, revenue: Column, first_seen: Column, last_seen: Column
) -> Column:
    return F.format_string(
        CUSTOMER_SENTENCE,
        customer_id,
        orders,
        revenue,
        timestamp_text(first_seen),
        timestamp_text(last_seen),
    )


def grounded_answer(question: Column, hits: Column) -> Column:
    """Answer text from an array of hits ordered best first; a fixed text when it is empty."""
    best = F.get(hits, F.lit(0))
    lines = F.transform(
        hits, lambda h: F.format_string(CONTEXT_LINE, h["text"], h["distance"])
    )
    answer = F.concat(
        F.format_string(CONTEXT_HEADER, question),
        F.lit("\n"),
        F.array_join(lines, "\n"),
        F.format_string(
            ANSWER_LINE,
            best["metadata"]["customer_id"],
            best["metadata"]["orders"],
            best["metadata"]["lifetime_revenue"],
        ),
    )
    return F.when(F.size(hits) > 0, answer).otherwise(F.lit(NO_MATCH))
