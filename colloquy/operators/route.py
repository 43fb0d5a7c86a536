"""Which kind of meeting a text is, and which prompts its passes take."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

GENERAL = "general"


def label_of(response: Column, labels: list[str]) -> Column:
    """The first label, longest first, that a classifier's answer holds; else general."""
    low, found = F.lower(response), None
    for label in sorted(labels, key=lambda x: (-len(x), x)):
        hit = F.contains(low, F.lit(label.lower()))
        found = F.when(hit, label) if found is None else found.when(hit, label)
    return F.lit(GENERAL) if found is None else found.otherwise(GENERAL)


#: Labels of meetings in the order in which rules look for them, and the words that tell them.
RULES = {
    "finance_committee": ("finance", "budget", "appropriation"),
    "committee_of_the_whole": ("committee of the whole",),
    "zoning_committee": ("zoning", "planning"),
    "city_council": ("council",),
}


def classify_rules(text: Column, chars: int = 2000, labels: list[str] | None = None) -> Column:
    """A label without a model, from the head of a text, by RULES; general where no rule holds or its label isn't among labels."""
    head = F.lower(F.substring(text, 1, chars))
    held = lambda *ws: head.rlike("|".join(r"(?U)\b" + w + r"\b" for w in ws))
    label = F.when(F.lit(False), GENERAL)
    for name, said in RULES.items():
        label = label.when(held(*said), name if labels is None or name in labels else GENERAL)
    return label.otherwise(GENERAL)


def route_of(label: Column, routes: dict[str, dict[str, str]], first: str | None = None, multi: str | None = None, final: str | None = None) -> Column:
    """struct<first,multi,final> of prompt names for a label, general by default; given names override."""
    listed = []
    for name, route in routes.items():
        listed += [F.lit(name), F.struct(*[F.lit(route[p]).alias(p) for p in ("first", "multi", "final")])]
    table = F.create_map(*listed)
    found = F.coalesce(F.try_element_at(table, label), F.try_element_at(table, F.lit(GENERAL)))
    given = {"first": first, "multi": multi, "final": final}
    return F.struct(*[(F.lit(given[p]) if given[p] else found[p]).alias(p) for p in given])


def missing_prompts(route: Column, prompts: list[str]) -> Column:
    """Prompt names of a route that don't exist."""
    named = F.array(route["first"], route["multi"], route["final"])
    return F.array_except(named, F.array(*[F.lit(p) for p in prompts]))
