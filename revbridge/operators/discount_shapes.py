"""Discount lists as they come (D07): what the bridge cannot or only half reads.

The bridge reads discounts with a schema, which turns a list that is none into NULL without
a word.  Here the text is parsed without one, as VARIANT, and every deviation from a list of
objects with a numeric amount and a catalog reference is a row with its reason.  Nothing of
the bridge's own reading changes: rows that are not named here are read whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revbridge.operators.base import ENTITY_KEYS

CYCLE = [*ENTITY_KEYS, "revenue_recognition_schedule_id", "rr_start_date", "discounts"]


def discount_faults(entity_cycles: DataFrame) -> DataFrame:
    """One row per fault: the cycle, `line` (from 0; NULL if the whole list is meant),
    `reason` and the `fragment` that has it.  A cycle without discounts (NULL or blank) has none.

    not JSON; object instead of a list (the bridge reads it as one line); neither list nor
    object; per line: no object, no amount, amount is no number, amount below zero, no
    catalog reference, other members."""
    text = F.trim(F.col("discounts").cast("string"))
    place = [*CYCLE[:-1]]
    rows = entity_cycles.select(*place, text.alias("text")).filter(F.col("text") != "")
    # generators keep what is parsed as a column: each text and each line is read once,
    # and rows without a fault go before anything is put together for them
    rows = rows.select(*place, "text", F.explode(F.array(F.try_parse_json("text"))).alias("v"))
    is_object = F.try_variant_get("v", "$", "map<string,variant>").isNotNull()
    lines = F.coalesce(F.try_variant_get("v", "$", "array<variant>"), F.when(is_object, F.array("v")))
    lines = rows.select(*place, "text", "v", F.posexplode_outer(lines).alias("line", "x"))
    lines = lines.select("*", F.explode(F.array(F.try_variant_get("x", "$", "map<string,variant>"))).alias("m"))
    line, m = F.col("line"), F.col("m")
    kind = F.schema_of_variant("v")  # an empty list and a JSON null have no line and no fault
    whole = (
        F.when(F.col("v").isNull(), "not JSON").when(line.isNull() & ~kind.rlike("^(ARRAY|VOID)"), "neither list nor object")
        .when((line == 0) & is_object, "object instead of a list")
    )
    kind_of = lambda name: F.schema_of_variant(m[name])
    absent = lambda name: kind_of(name).isNull() | (kind_of(name) == "VOID")
    number = F.coalesce(kind_of("amount").rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)"), F.lit(False))
    negative = F.coalesce(F.try_variant_get(m["amount"], "$", "double") < 0, F.lit(False))
    known = F.array(*[F.lit(c) for c in ("amount", "catalogReferenceId", "code")])
    others = F.size(F.array_except(F.map_keys("m"), known)) > 0
    no_object = line.isNotNull() & m.isNull()
    odd = m.isNotNull() & (~number | negative | absent("catalogReferenceId") | others)
    fault = lambda reason, line, fragment: F.when(reason.isNotNull(), F.struct(line.alias("line"), reason.alias("reason"), fragment.alias("fragment")))
    of_line = lambda reason: fault(reason, line, F.to_json("x"))
    faults = F.array_compact(F.array(
        fault(whole, F.lit(None).cast("int"), F.col("text")),
        of_line(F.when(no_object, "no object")),
        of_line(F.when(m.isNotNull(), F.when(absent("amount"), "no amount").when(~number, "amount is no number").when(negative, "amount below zero"))),
        of_line(F.when(m.isNotNull() & absent("catalogReferenceId"), "no catalog reference")),
        of_line(F.when(m.isNotNull() & others, "other members")),
    ))
    return lines.filter(whole.isNotNull() | no_object | odd).select(*place, F.explode(faults).alias("f")).select(*place, "f.*")


def fault_summary(faults: DataFrame) -> DataFrame:
    """Rows, cycles and an example per reason."""
    return faults.groupBy("reason").agg(
        F.count("*").alias("n_rows"), F.count_distinct(*CYCLE[:3], "rr_start_date").alias("n_cycles"), F.min("fragment").alias("example")
    )
