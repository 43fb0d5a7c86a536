"""Token estimates, output budgets and costs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import SPACE

#: USD per million tokens, in and out, by provider and model, in order of lookup.
PRICES = {
    "openai": {
        "gpt-5.4": (2.50, 15.00),
        "gpt-4.1": (2.00, 8.00),
    },
    "anthropic": {
        "claude-mythos": (25.00, 125.00),
        "claude-opus": (5.00, 25.00),
        "claude-sonnet": (3.00, 15.00),
        "claude-haiku": (1.00, 5.00),
    },
}
#: Providers that run on the own machine and cost nothing per token.
LOCAL = ("ollama", "llamacpp", "codex_cli")


def estimate(text: Column) -> Column:
    """A quarter of the characters after white space is collapsed; 1 at least."""
    n = F.length(F.regexp_replace(text, SPACE, " "))
    return F.greatest(F.lit(1), F.floor(n / F.lit(4.0))).cast("long")


def output_budget(num_ctx: Column, prompt_tokens: Column, most: int = 2048) -> Column:
    return F.greatest(F.lit(1), F.least(F.lit(most), num_ctx - prompt_tokens - 1))


def tokens_from_words(words: int) -> int:
    """A token budget for a budget of words."""
    return int(words / 0.75)


def price(provider: Column, model: Column, prices: dict | None = None) -> Column:
    """struct(input_per_million, output_per_million) of a model: by exact name, else by the first known name in it."""
    provider, model = F.lower(F.trim(provider)), F.lower(F.trim(model))
    exact = contained = None
    for name, models in (prices or PRICES).items():
        for known, (into, out) in models.items():
            value = F.struct(F.lit(into).alias("input_per_million"), F.lit(out).alias("output_per_million"))
            same, inside = (provider == name) & (model == known), (provider == name) & F.contains(model, F.lit(known))
            exact = F.when(same, value) if exact is None else exact.when(same, value)
            contained = F.when(inside, value) if contained is None else contained.when(inside, value)
    return F.when(~provider.isin(*LOCAL), F.coalesce(exact, contained))


def cost(provider: Column, model: Column, input_tokens: Column, output_tokens: Column, prices: dict | None = None) -> Column:
    """USD of a run; null where there is no price."""
    p = price(provider, model, prices)
    return input_tokens / F.lit(1e6) * p["input_per_million"] + output_tokens / F.lit(1e6) * p["output_per_million"]


def pricing_summary(actual_provider: Column, actual_model: Column, reference_provider: Column, reference_model: Column, input_tokens: Column, output_tokens: Column) -> Column:
    """A run's prices by its own model, or by a reference model where one is named."""
    provider = F.coalesce(F.nullif(F.trim(reference_provider), F.lit("")), actual_provider)
    model = F.coalesce(F.nullif(F.trim(reference_model), F.lit("")), actual_model)
    return F.struct(
        F.lit(True).alias("enabled"),
        actual_provider.alias("actual_provider"),
        actual_model.alias("actual_model"),
        provider.alias("reference_provider"),
        model.alias("reference_model"),
        cost(provider, model, input_tokens, output_tokens).alias("estimated_cost"),
        input_tokens.alias("input_tokens"),
        output_tokens.alias("output_tokens"),
    )
