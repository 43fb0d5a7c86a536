"""Command line: configuration, transcript, summary, index and search stages."""

from __future__ import annotations

import argparse
import json
import os
import shutil
import sys

from .plans import config


def _session():
    from pyspark.sql import SparkSession

    return SparkSession.builder.appName("colloquy").getOrCreate()


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="colloquy")
    top.add_argument("--config", default="colloquy.toml")
    groups = top.add_subparsers(dest="group", required=True)

    c = groups.add_parser("config").add_subparsers(dest="command", required=True)
    c.add_parser("list")
    add = c.add_parser("add")
    add.add_argument("entity")
    add.add_argument("--display-name", required=True)
    add.add_argument("--inputs", default="")
    for name in ("remove", "resolve", "init", "inspect"):
        c.add_parser(name).add_argument("entity")
    purge = c.add_parser("purge")
    purge.add_argument("entity")
    purge.add_argument("--yes", action="store_true", help="delete; without it, only tell what would go")
    c.add_parser("validate").add_argument("entity", nargs="?")

    f = groups.add_parser("source").add_subparsers(dest="command", required=True).add_parser("fetch")
    f.add_argument("entity")
    f.add_argument("--source", help="one source only; by default all that the entity declares")

    t = groups.add_parser("transcript").add_subparsers(dest="command", required=True)
    for name in ("slice", "normalize"):
        p = t.add_parser(name)
        p.add_argument("input")
        p.add_argument("output")
        p.add_argument("--force", action="store_true")
        p.add_argument("--dry-run", action="store_true", help="only count what would be done")
        if name == "slice":
            p.add_argument("--max-window", type=float, default=90.0)
            p.add_argument("--min-words", type=int, default=1)
            p.add_argument("--ids")
            p.add_argument("--texts")
            p.add_argument("--tracker")
        else:
            p.add_argument("--deep-clean", action="store_true")
            p.add_argument("--entity")

    i = groups.add_parser("intel").add_subparsers(dest="command", required=True).add_parser("run")
    i.add_argument("transcripts")
    i.add_argument("output")
    i.add_argument("--chunk-style", choices=("word", "sentence", "density"), default="word")
    i.add_argument("--max-tokens", type=int)
    i.add_argument("--max-words", type=int)
    i.add_argument("--num-ctx", type=int, default=8192)
    i.add_argument("--max-pass", type=int, default=3)
    i.add_argument("--force", action="store_true")
    i.add_argument("--dry-run", action="store_true", help="only count what would be done")
    i.add_argument("--print-prompts", action="store_true")
    i.add_argument("--entity")
    i.add_argument("--job-profile")
    i.add_argument("--prompts", action="append", default=[], help="a folder of prompt bundles, tried before those of the entity and of the project")
    for step in ("first", "multi", "final"):
        i.add_argument(f"--{step}-prompt", help="a prompt of the bundle in place of the route's")
    i.add_argument("--ledger", help="a folder of answers that were paid for, looked up before any call")
    i.add_argument("--provider")
    i.add_argument("--model")
    i.add_argument("--target")
    i.add_argument("--pricing-provider", default="")
    i.add_argument("--pricing-model", default="")
    i.add_argument("--files", help="a folder for the summaries as files")
    i.add_argument("--output-format", choices=("markdown", "yaml"), default="markdown")
    i.add_argument("--chunks", help="a folder for the first pass's chunks, for inspection")
    i.add_argument("--chunk-format", choices=("json", "text"), default="json")

    x = groups.add_parser("index")
    x.add_argument("transcripts")
    x.add_argument("output")
    x.add_argument("--summaries")
    x.add_argument("--ids", help="a tracker file of ids, which restores their case")
    x.add_argument("--cells", type=int, help="build an inverted file with so many cells; 0 chooses")
    x.add_argument("--texts", action="store_true", help="build a trigram index of the transcripts")
    s = groups.add_parser("search")
    s.add_argument("index")
    s.add_argument("transcripts")
    s.add_argument("query")
    s.add_argument("--strategy", choices=("hybrid", "literal"), default="hybrid")
    s.add_argument("--nprobe", type=int, help="cells of the inverted file that are searched; by default as many as exact results take")
    return top


def _items(raw: str) -> list[str]:
    return [x.strip().lower() for x in raw.split(",") if x.strip()]


def _config(args) -> int:
    if args.command == "add":
        config.upsert_entity(args.config, args.entity, args.display_name, inputs=_items(args.inputs))
    elif args.command == "remove":
        config.remove_entity(args.config, args.entity)
    elif args.command == "resolve":
        print(json.dumps(config.resolve(args.config, args.entity), indent=2))
    elif args.command == "inspect":
        print(json.dumps(config.storage(config.load(args.config), args.entity), indent=2))
    elif args.command == "list":
        print("\n".join(sorted(config.load(args.config).get("entities", {}))))
    elif args.command == "validate":
        faults = config.faults(config.load(args.config), args.entity)
        print("\n".join(faults) or "ok")
        return int(bool(faults))
    else:
        loaded = config.load(args.config)
        if args.entity not in loaded.get("entities", {}):
            raise config.ConfigError(f"unknown entity: {args.entity}")
        folder = config.entity_dir(loaded, args.entity)
        if args.command == "init":
            os.makedirs(folder, exist_ok=True)
            path = os.path.join(folder, "config.toml")
            if not os.path.exists(path):
                with open(path, "w", encoding="utf-8") as f:
                    f.write(config.dump(config.scaffold(loaded, args.entity, loaded["entities"][args.entity].get("inputs", []))))
        else:
            found = sum(len(names) for _, _, names in os.walk(folder))
            print(f"{folder}: {found} files" + ("" if args.yes else " would be deleted"))
            if args.yes:
                shutil.rmtree(folder, ignore_errors=True)
                config.remove_entity(args.config, args.entity)
    return 0


def _bundle(args, settings: dict) -> config.PromptBundle:
    """The bundle of the job's profile: from the folders given, the entity's, the project's, or the built-in one."""
    own = [os.path.join(config.entity_dir({"system": settings}, args.entity), "prompts")] if settings else []
    return config.prompt_bundle([*args.prompts, *own, "prompts"], config.first_given(args.job_profile, settings.get("job_profile"), "civic"))


def _summarize(spark, args):
    """The summary stage; options come from the command line, the entity, the system, and defaults, in this order."""
    from .plans import stages

    settings = config.resolve(args.config, args.entity) if args.entity else {}
    chosen = lambda name, given, default=None: config.first_given(given, settings.get(name), default)
    model = chosen("default_model", args.model, "extractive")
    known = settings.get("models", {})
    entry = config.model_entry(known, model) if known and args.model else {}
    budget = config.token_budget(config.first_given(args.max_tokens, entry.get("max_tokens"), 3000), args.max_words, config.first_given(entry.get("num_ctx"), args.num_ctx))
    bundle = _bundle(args, settings)
    if args.chunks and not args.dry_run:
        stages.chunk_files(spark, args.transcripts, args.chunks, args.chunk_style, budget, keywords=bundle.keywords, form=args.chunk_format)
    return stages.summarize_texts(
        spark, args.transcripts, args.output, args.force, bundle, chosen("llm_provider", args.provider, "ollama"), model, chosen("llm_provider_url", args.target, "https://localhost"),
        (args.pricing_provider, args.pricing_model), files=args.files, form=args.output_format, dry_run=args.dry_run, style=args.chunk_style, max_tokens=budget, max_pass=args.max_pass,
        ledger=args.ledger, first=args.first_prompt, multi=args.multi_prompt, final=args.final_prompt,
    )


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    try:
        if args.group == "config":
            return _config(args)
        from .plans import stages

        if args.group == "intel" and args.print_prompts:
            bundle = _bundle(args, config.resolve(args.config, args.entity) if args.entity else {})
            print("\n\n".join(f"[{k}]\n{v}" for k, v in bundle.prompts.items()))
            return 0
        spark = _session()
        if args.group == "source":
            out = stages.fetch_sources(spark, config.resolve(args.config, args.entity), args.source)
        elif args.group == "transcript" and args.command == "slice":
            ids = stages.id_map(spark, args.ids) if args.ids else None
            out = stages.slice_captions(spark, args.input, args.output, ids, args.max_window, args.min_words, args.force, args.texts, args.tracker, args.dry_run)
        elif args.group == "transcript":
            terms = config.resolve(args.config, args.entity).get("replacements", {}) if args.entity else {}
            out = stages.normalize_texts(spark, args.input, args.output, terms, args.deep_clean, args.force, dry_run=args.dry_run)
        elif args.group == "intel":
            out = _summarize(spark, args)
        elif args.group == "index":
            out = stages.build_index(spark, args.transcripts, args.summaries, args.output, ids=stages.id_map(spark, args.ids) if args.ids else None, cells=args.cells)
            if args.texts:
                stages.index_texts(spark, args.transcripts, args.output)
        else:
            stages.search_index(spark, args.index, args.transcripts, args.query, args.strategy, args.nprobe).show(25, 100)
            return 0
        print(f"{out.count()} rows")
        return 0
    except (config.ConfigError, ValueError) as e:
        print(f"error: {e}", file=sys.stderr)
        return 1
    except KeyboardInterrupt:
        return 130


if __name__ == "__main__":
    sys.exit(main())
