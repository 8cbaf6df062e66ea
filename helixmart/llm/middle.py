"""Fill-in-the-middle: one counted, possessive regular expression per row cuts a text and lays it out anew."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What counts as a unit, for counting; and the same as a possessive pattern, which never goes back over a unit.
LINES = (r"[^\n]*\n|[^\n]+", r"[^\n]*+\n|[^\n]++")
# Names of prefix, suffix and middle in the output.
MARKERS = ("<P>", "<S>", "<M>")


def _group(column: Column, place: int) -> Column:
    """The place-th group of eight hex digits as an unsigned integer."""
    return F.conv(F.substring(column, 8 * place + 1, 8), 16, 10).cast("long")


def _plain_text(marker: str) -> str:
    """The marker as itself inside a replacement."""
    return marker.replace("\\", "\\\\").replace("$", "\\$")


def transform(
    docs: DataFrame, unit: tuple[str, str] = LINES, markers: tuple[str, str, str] = MARKERS, percent: int = 100, percent_spm: int = 50,
    seed: int = 7, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(id, n, form, output, prefix_chars, middle_chars) of every text.

    A text has n units. The sha256 of ``seed:id`` draws where the prefix and the middle end, in units, whether a
    text stays plain (``percent`` of 100 are changed) and the order, suffix first or prefix first. One match of a
    pattern that counts the units captures the three parts; its replacement is the output.

    Edge cases: NULL texts count as empty; empty texts, and texts that hold a marker, are plain, with NULL
    lengths; parts may be empty; a NULL id draws as the empty text, and repeated rows draw alike; an empty table
    gives no rows. Texts of any length take one pass: possessive counting needs no stack. Other columns are not
    looked at.
    """
    prefix, suffix, middle = (_plain_text(m) for m in markers)
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("_id").cast("string"), F.lit(""))).cast("binary"), 256)
    rows = rows.select("*", drawn.alias("_h"), F.regexp_count("_text", F.lit(unit[0])).cast("long").alias("_n"))
    ends = [F.pmod(_group(F.col("_h"), i), F.col("_n") + 1) for i in (0, 1)]
    held = F.lit(False)
    for marker in markers:
        held = held | F.contains("_text", F.lit(marker))
    stays = (F.col("_text") == "") | held | (F.pmod(_group(F.col("_h"), 2), F.lit(100)) >= percent)
    order = F.when(F.pmod(_group(F.col("_h"), 3), F.lit(100)) < percent_spm, "spm").otherwise("psm")
    rows = rows.select("_id", "_text", "_n", F.least(*ends).alias("_a"), F.greatest(*ends).alias("_b"), F.when(stays, "plain").otherwise(order).alias("_form"))
    counted = F.concat(
        F.lit(rf"(?s)\A((?:{unit[1]}){{"), F.col("_a").cast("string"), F.lit(rf"}}+)((?:{unit[1]}){{"), (F.col("_b") - F.col("_a")).cast("string"), F.lit(r"}+)(.*)\z")
    )
    layout = F.when(F.col("_form") == "spm", f"{suffix}$3{prefix}$1{middle}$2").otherwise(f"{prefix}$1{suffix}$3{middle}$2")
    output = F.when(F.col("_form") == "plain", F.col("_text")).otherwise(F.regexp_replace("_text", counted, layout))
    rows = rows.select("_id", "_n", "_form", output.alias("_output"))
    parts = _parts("_output", "_form", markers)
    return rows.select(
        F.col("_id").alias(id_col), F.col("_n").alias("n"), F.col("_form").alias("form"), F.col("_output").alias("output"),
        F.length(parts["prefix"]).cast("long").alias("prefix_chars"), F.length(parts["middle"]).cast("long").alias("middle_chars"),
    )


def _parts(output: str, form: str, markers: tuple[str, str, str]) -> dict[str, Column]:
    """Prefix, suffix and middle of an output; NULL if plain. No part holds a marker, so each stands there once."""
    prefix, suffix, middle = markers
    after = lambda text, marker: F.substring_index(text, marker, -1)
    before = lambda text, marker: F.substring_index(text, marker, 1)
    whole = F.col(output)
    last, head = after(whole, middle), before(whole, middle)
    spm = F.col(form) == "spm"
    changed = F.col(form) != "plain"
    return {
        "prefix": F.when(changed, F.when(spm, after(head, prefix)).otherwise(after(before(head, suffix), prefix))),
        "suffix": F.when(changed, F.when(spm, after(before(head, prefix), suffix)).otherwise(after(head, suffix))),
        "middle": F.when(changed, last),
    }


def restore(coded: DataFrame, output: str = "output", form: str = "form", out: str = "restored", markers: tuple[str, str, str] = MARKERS) -> DataFrame:
    """Add the text that ``transform`` laid out, from the output and its form alone. A NULL output gives NULL."""
    parts = _parts(output, form, markers)
    whole = F.concat(parts["prefix"], parts["middle"], parts["suffix"])
    return coded.withColumn(out, F.when(F.col(form) == "plain", F.col(output)).otherwise(whole))
