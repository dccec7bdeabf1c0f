"""Reading a judge's reply: decisions by line, and the ranking line."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# How a judge's reply writes a decision and the ranking.
DECISION = r"(?i)^(\d{1,9})[.\s:)\-]+\s*(KEEP|REJECT)"
RANKING = r"(?i)^TOP\s*15\s*[:：]"


def _lines(content: Column) -> Column:
    return F.split(F.trim(F.coalesce(content, F.lit(""))), "\n")


def decisions(content: Column, count: Column) -> Column:
    """array<string> of count decisions: KEEP unless a line says otherwise; the last line about an image counts."""
    parsed = F.filter(
        F.transform(
            _lines(content),
            lambda x: F.struct(
                F.try_to_number(F.regexp_extract(F.trim(x), DECISION, 1), F.lit("999999999")).cast("int").alias("n"),
                F.upper(F.regexp_extract(F.trim(x), DECISION, 2)).alias("d"),
            ),
        ),
        lambda s: s["n"].isNotNull(),
    )
    last = lambda i: F.element_at(F.filter(parsed, lambda s: s["n"] == i), -1)["d"]
    every = F.when(count > 0, F.sequence(F.lit(1), F.greatest(count, F.lit(1)))).otherwise(F.array().cast("array<int>"))
    return F.transform(every, lambda i: F.when(F.exists(parsed, lambda s: s["n"] == i), last(i)).otherwise("KEEP"))


def top15(content: Column, count: Column) -> Column:
    """array<int> of 0-based images of the first ranking line that names a valid one; repeats stay, any number."""
    ranking = F.transform(_lines(content), lambda x: F.trim(F.regexp_replace(x, "[*#]", "")))
    ranking = F.filter(ranking, lambda x: x.rlike(RANKING))
    numbers = F.transform(ranking, lambda x: F.split(F.regexp_replace(x, r"^[^:：]*[:：]", ""), ","))
    valid = F.transform(
        numbers,
        lambda a: F.filter(
            F.transform(a, lambda t: F.when(F.trim(t).rlike("^[0-9]{1,9}$"), F.trim(t).cast("int") - 1)),
            lambda i: i.isNotNull() & (i >= 0) & (i < count),
        ),
    )
    return F.coalesce(F.get(F.filter(valid, lambda a: F.size(a) > 0), F.lit(0)), F.array().cast("array<int>"))


def chosen(content: Column, count: Column) -> Column:
    """The images that stay: the ranking if there is one, else those to keep, in order."""
    top, d = top15(content, count), decisions(content, count)
    keep = F.filter(F.transform(d, lambda x, i: F.when(x == "KEEP", i)), lambda i: i.isNotNull())
    return F.when(F.size(top) > 0, top).otherwise(keep)


# What a call of the judge came to.
SKIPPED, REPLIED, FAILED = "skipped", "replied", "failed"


def outcome(content: Column) -> Column:
    """Of a reply's text alone: a blank or missing one has failed."""
    return F.when(F.coalesce(content.rlike(r"\S"), F.lit(False)), REPLIED).otherwise(FAILED)


def usage(reply: Column) -> Column:
    """struct(prompt, completion, total) of token counts of a JSON reply; 0 where missing."""
    n = lambda k: F.coalesce(F.get_json_object(reply, f"$.usage.{k}").cast("long"), F.lit(0))
    return F.struct(n("prompt_tokens").alias("prompt"), n("completion_tokens").alias("completion"), n("total_tokens").alias("total"))
