"""Run options and their command line."""

import argparse
import os
from dataclasses import dataclass, fields


@dataclass(frozen=True)
class RunConfig:
    input_dir: str = "input"
    pdf: str | None = None
    code: str = "HVQ_036"
    start_page: int | None = None
    end_page: int | None = None
    outdir: str = "output"
    limit: int = 0
    correct: bool = False
    model: str = "gemini-flash-lite-latest"
    no_cache: bool = False
    rpm: int = 0
    ocr: bool = False
    ocr_dpi: int = 200
    no_models: bool = False


def parse(argv: list[str] | None = None) -> RunConfig:
    p = argparse.ArgumentParser(prog="pagelore", description="PDF pages to normalised sentences and entities")
    for f in fields(RunConfig):
        flag = "--" + f.name.replace("_", "-")
        if f.type is bool or f.type == "bool":
            p.add_argument(flag, action="store_true")
        else:
            p.add_argument(flag, type=int if "int" in str(f.type) else str, default=f.default)
    return RunConfig(**vars(p.parse_args(argv)))


def api_key(config: RunConfig, env=os.environ) -> str | None:
    """The client's key; a run that corrects without one ends here, before any job."""
    if config.correct and not env.get("GEMINI_API_KEY"):
        raise SystemExit("GEMINI_API_KEY isn't set")
    return env.get("GEMINI_API_KEY")
