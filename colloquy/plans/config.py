"""Layered configuration, entities and prompt bundles, read from TOML."""

from __future__ import annotations

import os
import re
import tomllib
from dataclasses import dataclass, field

from ..operators.summarize import PROMPTS, ROUTES

REQUIRED_ENTITY = ("display_name", "entity")
REQUIRED_SYSTEM = ("root_data_dir",)


class ConfigError(ValueError):
    pass


def load(path: str) -> dict:
    """A TOML file; an error names the file that is missing or broken."""
    try:
        with open(path, "rb") as f:
            return tomllib.load(f)
    except FileNotFoundError as e:
        raise ConfigError(f"no configuration at {path}") from e
    except tomllib.TOMLDecodeError as e:
        raise ConfigError(f"broken configuration at {path}: {e}") from e


def entity_dir(config: dict, entity: str) -> str:
    return os.path.join(config.get("system", {}).get("root_data_dir", "./data"), entity)


def merged(config: dict, entity: str, local: dict | None = None) -> dict:
    """An entity's settings: system, then registry, then its own file, later ones winning; its own settings and
    meta tables are flattened."""
    registry = config.get("entities", {}).get(entity)
    if registry is None:
        raise ConfigError(f"unknown entity: {entity}")
    out = {**config.get("system", {}), **registry}
    for key, value in (local or {}).items():
        if key in ("settings", "meta") and isinstance(value, dict):
            out |= value
        else:
            out[key] = value
    return {**out, "entity": entity}


def resolve(path: str, entity: str) -> dict:
    """merged() of the files at a path and in the entity's folder."""
    config = load(path)
    local = os.path.join(entity_dir(config, entity), "config.toml")
    return merged(config, entity, load(local) if os.path.exists(local) else None)


def first_given(*values):
    """The first value that is not None: command line, entity, system, default."""
    return next((v for v in values if v is not None), None)


def storage(config: dict, entity: str) -> dict:
    """What an entity has on disk; nothing is changed."""
    folder = entity_dir(config, entity)
    walked = list(os.walk(folder))
    return {
        "entity": entity,
        "entity_dir": folder,
        "exists": os.path.isdir(folder),
        "config_exists": os.path.isfile(os.path.join(folder, "config.toml")),
        "file_count": sum(len(files) for _, _, files in walked),
        "dir_count": sum(len(folders) for _, folders, _ in walked),
    }


def wanted_sources(settings: dict, only: str | None = None) -> list[str]:
    """The sources to fetch for an entity: the one asked for, or all that it declares."""
    declared = settings.get("inputs", [])
    if not isinstance(declared, list):
        raise ConfigError(f"inputs of {settings.get('entity')} are not a list")
    wanted = [only] if only else declared
    names = [name for name in (str(w).strip().lower() for w in wanted) if name]
    if not names:
        raise ConfigError(f"{settings.get('entity')} declares no inputs")
    return names


def faults(config: dict, entity: str | None = None) -> list[str]:
    """What a configuration lacks."""
    out = [f"system.{k} is missing" for k in REQUIRED_SYSTEM if k not in config.get("system", {})]
    names = [entity] if entity else list(config.get("entities", {}))
    for name in names:
        found = config.get("entities", {}).get(name)
        if found is None:
            out.append(f"entity {name} is not registered")
        else:
            out += [f"entity {name}: {k} is missing" for k in REQUIRED_ENTITY if not found.get(k)]
    return out


def token_budget(max_tokens: int | None, max_words: int | None, num_ctx: int) -> int:
    """The tokens of a chunk, from tokens or words; it has to be below the context."""
    budget = int(max_words / 0.75) if max_words else max_tokens
    if budget is None or budget >= num_ctx:
        raise ConfigError(f"max_tokens ({budget}) must be below num_ctx ({num_ctx})")
    return budget


def model_entry(models: dict[str, dict], name: str) -> dict:
    """A model's entry, its name taken regardless of case."""
    for known, entry in models.items():
        if known.lower() == name.lower():
            return entry
    raise ConfigError(f"unknown model: {name}")


@dataclass
class PromptBundle:
    prompts: dict[str, str] = field(default_factory=lambda: dict(PROMPTS))
    routes: dict[str, dict[str, str]] = field(default_factory=lambda: dict(ROUTES))
    keywords: list[str] = field(default_factory=list)
    classifier: str | None = None
    #: What a classifier may answer.
    labels: list[str] = field(default_factory=lambda: list(ROUTES))

    def check(self) -> None:
        for label, route in self.routes.items():
            for step in ("first", "multi", "final"):
                if route.get(step) not in self.prompts:
                    raise ConfigError(f"route {label}: no prompt {route.get(step)!r} for {step}")
        if "general" not in self.routes:
            raise ConfigError("there is no general route")


def bundle_of(raw: dict, place: str = "bundle") -> PromptBundle:
    """A bundle from the tables of its file.

    [prompts.<name>] has each prompt's text, [prompt_router] a route of three
    prompts for each label, [classifier_prompt] the text that asks for a label,
    [classifier_types] the labels allowed, [density_keywords] the keywords.
    """

    def table(name: str) -> dict:
        found = raw.get(name, {})
        if not isinstance(found, dict):
            raise ConfigError(f"{place}: {name} is not a table")
        return found

    prompts = {}
    for name, entry in table("prompts").items():
        said = entry.get("text") if isinstance(entry, dict) else None
        if not isinstance(said, str) or not said.strip():
            raise ConfigError(f"{place}: prompt {name} has no text")
        prompts[name] = said
    routes, asked = table("prompt_router"), table("classifier_prompt").get("text", "")
    if not isinstance(asked, str):
        raise ConfigError(f"{place}: the classifier's prompt is not a text")
    labels, keywords = table("classifier_types").get("allowed", []), table("density_keywords").get("keywords", [])
    for name, listed in (("classifier_types.allowed", labels), ("density_keywords.keywords", keywords)):
        if not isinstance(listed, list) or not all(isinstance(x, str) for x in listed):
            raise ConfigError(f"{place}: {name} is not a list of texts")
    for label, route in routes.items():
        if not isinstance(route, dict):
            raise ConfigError(f"{place}: route {label} is not a table")
    bundle = PromptBundle(prompts, routes, keywords, asked if asked.strip() else None, labels)
    bundle.check()
    return bundle


def prompt_bundle(folders: list[str], profile: str) -> PromptBundle:
    """The bundle <folder>/<profile>/prompts.toml of the first folder that has one, else the built-in one."""
    for folder in folders:
        path = os.path.join(folder, profile, "prompts.toml")
        if os.path.exists(path):
            return bundle_of(load(path), path)
    return PromptBundle()


def _value(v) -> str:
    if isinstance(v, bool):
        return str(v).lower()
    if isinstance(v, (int, float)):
        return repr(v)
    if isinstance(v, list):
        return "[" + ", ".join(map(_value, v)) + "]"
    text = str(v).replace("\\", "\\\\").replace('"', '\\"').replace("\n", "\\n")
    return f'"{text}"'


def dump(config: dict, prefix: str = "") -> str:
    """TOML of nested dicts."""
    plain = [f"{k} = {_value(v)}" for k, v in config.items() if not isinstance(v, dict)]
    parts = ["\n".join(plain)] if plain else []
    for k, v in config.items():
        if isinstance(v, dict):
            name = f"{prefix}{k}"
            parts.append(f"[{name}]\n{dump(v, name + '.')}".rstrip())
    return "\n\n".join(parts) + ("\n" if not prefix else "")


def upsert_entity(path: str, entity: str, display_name: str, base: str = "", inputs: list[str] = ()) -> dict:
    """Register an entity, or replace its entry, in the file at path."""
    if not re.fullmatch("[a-z0-9_]+", entity):
        raise ConfigError(f"not a handle: {entity}")
    config = load(path)
    config.setdefault("entities", {})[entity] = {"display_name": display_name, "entity": entity, "base": base, "inputs": list(inputs)}
    _save(config, path)
    return config


def remove_entity(path: str, entity: str) -> dict:
    config = load(path)
    if config.get("entities", {}).pop(entity, None) is None:
        raise ConfigError(f"unknown entity: {entity}")
    _save(config, path)
    return config


def _save(config: dict, path: str) -> None:
    with open(path, "w", encoding="utf-8") as f:
        f.write(dump(config))


def scaffold(config: dict, entity: str, inputs: list[str] = ()) -> dict:
    """A first configuration of an entity: with people and titles where it looks like a public body."""
    civic = any(k in entity for k in ("city_council", "county_board"))
    out = {"settings": {"entity_type": "civic" if civic else "media"}, "sources": {i: {"enabled": False} for i in inputs}, "replacements": {}}
    return out | ({"titles": {}, "people": {}} if civic else {})
